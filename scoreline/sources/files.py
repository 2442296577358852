"""Directories of whole documents: one file, one document, with where it lay and when it was written.

Spark's binary reader gives each file as a row, many files a task and none
larger than ``spark.sql.sources.binaryFile.maxLength``; it suits pretty-printed
JSON and fetched pages, which no line reader can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreline.schemas import CORRUPT, EVENTS
from scoreline.sources.events import NTZ_FORMAT

FILE_COLUMNS = ["path", "modified"]


def read_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, modified, text) of every file below ``path`` whose name matches ``pattern``; bytes that aren't UTF-8 are replaced."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    # Spark casts binary as it is; only valid text can be parsed and compared
    text = F.make_valid_utf8(F.col("content").cast("string"))
    return found.select("path", F.col("modificationTime").alias("modified"), text.alias("text"))


def read_documents(spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*") -> DataFrame:
    """Records of JSON files that each hold one object or an array of them, however they are laid out.

    A file that can't be parsed gives one row with its text in ``_corrupt_record``;
    every row has ``path`` and ``modified``.
    """
    files = read_files(spark, path, pattern)
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "timestampNTZFormat": NTZ_FORMAT}
    records = F.from_json("text", T.ArrayType(full), options)
    unread = F.array(F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema], F.col("text").alias(CORRUPT)))
    broken = records.isNull() | F.exists(records, lambda r: r[CORRUPT].isNotNull())
    rows = files.withColumn("records", F.when(broken, unread.cast(T.ArrayType(full))).otherwise(records))
    return rows.select(*FILE_COLUMNS, F.inline("records"))


def read_event_files(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """Events of a directory of JSON files, the readable ones."""
    rows = read_documents(spark, path, EVENTS, pattern)
    return rows.filter(F.col(CORRUPT).isNull()).select(*EVENTS.fieldNames())


def read_pages(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(page_id, url, html, modified) of a directory of fetched pages; a page's number is a hash of its path."""
    files = read_files(spark, path, pattern)
    return files.select(F.xxhash64("path").alias("page_id"), F.col("path").alias("url"), F.col("text").alias("html"), "modified")


def write_documents(df: DataFrame, path: str, column: str) -> None:
    """Each value of ``column`` as a file of its own. Files cost time by their number, whatever their size, so the
    rows are spread evenly over the tasks first."""
    tasks = 4 * df.sparkSession.sparkContext.defaultParallelism
    df.select(F.col(column).alias("value")).repartition(tasks).write.option("maxRecordsPerFile", 1).text(path)
