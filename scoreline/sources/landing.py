"""Landing payloads: JSON documents of (teams[], stadiums[], matches[], fetched_at, source_name).

A batch is written as JSON-lines documents of at most ``rows_per_doc`` entity
rows each, so neither writer nor reader ever holds a whole batch in one task.
They are cut by the task that has the rows, whose files are committed as one, so
nothing is shuffled; files are compressed and hold at most ``DOCS_PER_FILE``
documents, as a reader can't split them. The documents of a group map are dealt
out (see ``bounded``): equal records are counted first and cut into pieces;
pieces are dealt out by a hash of their content and number, and cut again at
the bound, so the documents are the same whenever a task is computed again. Whole-file pretty-printed documents (one per file) are read with
``multi_line=True``.

A batch has a folder of its own, ``ingest_date=<day>/batch=<instant>-<source>``,
which landing it again replaces; one without a ``_SUCCESS`` marker (a writer that
died) is read by nobody. Names sort as their instants, so the newest batch is
found from the folders. Files laid straight into a day's folder, or into a folder
without days, are read too.

A malformed document ends the read, or is set aside where the reader is
``tolerant``; fields that no schema names are then kept as text.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreline.functions import instant
from scoreline.schemas import CORRUPT, GROUP_MAP_PAYLOAD, MATCH_FIELDS, PAYLOAD, STADIUM_FIELDS, TEAM_FIELDS
from scoreline.session import scratch_path
from scoreline.sources.io import folder_names, loose_files, partition_values, path_exists

# Documents are cut on executors, which needn't have the package (see ``html_tables``).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ENTITIES = {"teams": TEAM_FIELDS, "stadiums": STADIUM_FIELDS, "matches": MATCH_FIELDS}
ROWS_PER_DOC = 5000
DOCS_PER_FILE = 64
NO_GROUP = "\u0000"  # stands for a null group, since a map has no null key


def chunk_key(df: DataFrame, rows_per_doc: int, cols: list[str] | None = None) -> Column:
    """Deterministic document number: content hash modulo ceil(rows / rows_per_doc)."""
    n = max(1, -(-df.count() // rows_per_doc))  # one-row control value
    return F.pmod(F.xxhash64(*(cols or df.columns)), F.lit(n)).alias("_chunk")


def bounded(df: DataFrame, rows_per_doc: int) -> DataFrame:
    """The rows of ``df``, numbered into documents (``_bucket``, ``_doc``) of at most ``rows_per_doc`` rows.

    Equal rows are counted with a partial aggregate (written once, so ``df`` is
    computed once), spread over buckets of about ``rows_per_doc`` rows by their
    content and number, and numbered inside a bucket.
    """
    cols = df.columns
    path = scratch_path(df.sparkSession, "records")
    obs = Observation()
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies"))
    counted = counted.withColumn("_hash", F.xxhash64(*cols))
    counted.observe(obs, F.sum("_copies").alias("rows")).write.parquet(path)
    n = max(1, -(-(obs.get["rows"] or 0) // rows_per_doc))
    stored = df.sparkSession.read.schema(counted.schema).parquet(path)
    each = stored.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    piece = F.floor((F.col("_copy") - 1) / rows_per_doc)
    dealt = each.withColumn("_bucket", F.pmod(F.xxhash64("_hash", piece), F.lit(n)))
    w = Window.partitionBy("_bucket").orderBy("_hash", *cols, "_copy")
    return dealt.withColumn("_doc", F.floor((F.row_number().over(w) - 1) / rows_per_doc)).select("_bucket", "_doc", *cols)


def _lists(rows_per_doc: int):
    """Cuts the rows of a task, batch by batch, into rows of one list each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, rows_per_doc):
                rows = b.slice(at, rows_per_doc).to_struct_array()
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays([0, len(rows)], rows)], ["rows"])

    return cut


def _docs(df: DataFrame, entity: str, rows_per_doc: int) -> DataFrame:
    """Bounded documents for one entity list, cut where the rows are: nothing is sorted, counted or shuffled."""
    present = [c for c in ENTITIES[entity] if c in df.columns]
    rows = df.select(*present)
    kind = T.StructType([T.StructField("rows", T.ArrayType(rows.schema))])
    # The other two lists are absent from this document (null -> omitted in JSON).
    return rows.mapInArrow(_lists(rows_per_doc), kind).select(F.col("rows").alias(entity))


def batch_folder(spark: SparkSession, fetched_at: str, source_name: str) -> str:
    """Where a batch lands; raises if its stamp is no instant, since nobody could tell whether it is the newest."""
    at = instant(F.lit(fetched_at))
    day, micros = spark.range(1).select(F.to_date(at).cast("string"), F.unix_micros(at)).first()
    if micros is None:
        raise ValueError(f"fetched_at must be an ISO-8601 instant, not {fetched_at!r}")
    utc = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=micros)
    return f"ingest_date={day}/batch={utc:%Y%m%dT%H%M%S.%f}-{quote(str(source_name), safe='')}"


def _write(docs: DataFrame, path: str, fetched_at: str, source_name: str) -> None:
    folder = batch_folder(docs.sparkSession, fetched_at, source_name)
    stamped = docs.withColumns({"fetched_at": F.lit(fetched_at), "source_name": F.lit(source_name)})
    # compressed files can't be split, so they are bounded
    w = stamped.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", DOCS_PER_FILE)
    w.json(f"{path}/{folder}")


def write_payload(
    path: str,
    fetched_at: str,
    source_name: str,
    rows_per_doc: int = ROWS_PER_DOC,
    **entities: DataFrame,
) -> None:
    """Land one batch (entities given as DataFrames) under ``path``, in place of what it landed before."""
    out = None
    for entity, df in entities.items():
        d = _docs(df, entity, rows_per_doc)
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    _write(out, path, fetched_at, source_name)


def days(spark: SparkSession, path: str) -> list[str]:
    """The folders of days, ascending; one whose day isn't known is no day."""
    return [d for d in partition_values(spark, path, "ingest_date") if not d.startswith("__")]


def landed_in(spark: SparkSession, path: str, day: str) -> list[str]:
    """The committed batches of a day, ascending by instant, after the files that lie there in no batch."""
    top = f"{path}/ingest_date={day}"
    committed = [f"{top}/batch={n}" for n in folder_names(spark, top, "batch", committed=True)]
    return loose_files(spark, top) + committed


def read_landing(
    spark: SparkSession, path: str, multi_line: bool = False, schema: T.StructType = PAYLOAD, tolerant: bool = False
) -> DataFrame:
    """Landing documents under ``path``; raises if none exists, or one can't be parsed and the reader isn't ``tolerant``."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"No landing payload found at {path}")
    known = days(spark, path)
    where = [f for day in known for f in landed_in(spark, path, day)] if known else [path]
    return _read(spark, where, schema, tolerant, multi_line)


def read_latest(spark: SparkSession, path: str, schema: T.StructType = PAYLOAD, tolerant: bool = False) -> DataFrame:
    """The documents of the most recent batch (of all sources that have its instant).

    Its day is the greatest that has landed anything, so only that folder is
    listed, however much has landed before, and only the newest batch is parsed.
    """
    for day in reversed(days(spark, path)):
        found = landed_in(spark, path, day)
        batches = [f for f in found if "/batch=" in f]
        if batches and len(batches) == len(found):
            instants = [f.rsplit("/batch=", 1)[1].split("-")[0] for f in batches]
            found = [f for f, at in zip(batches, instants) if at == max(instants)]
        if found:
            return latest_batch(_read(spark, found, schema, tolerant))
    return latest_batch(read_landing(spark, path, schema=schema, tolerant=tolerant))


OTHER = "other_fields"


def _read(spark: SparkSession, where: list[str], schema: T.StructType, tolerant: bool, multi_line: bool = False) -> DataFrame:
    if not where:
        return spark.createDataFrame([], schema)
    if not tolerant:
        return spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", multi_line).json(where)
    lines = spark.read.option("wholetext", multi_line).text(where).filter(F.trim("value") != "")
    read = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    doc = F.from_json("value", read, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    fields = F.from_json("value", "map<string,string>")
    other = F.map_filter(fields, lambda k, _: ~k.isin(*schema.fieldNames()))
    parsed = lines.withColumn("doc", doc)
    broken = F.col(f"doc.{CORRUPT}")
    rest = [c for c in lines.columns if c != "value"]
    return parsed.select(
        *[F.when(broken.isNull(), F.col(f"doc.{c}")).alias(c) for c in schema.fieldNames()],
        broken.alias(CORRUPT),
        F.when(broken.isNull() & (F.size(other) > 0), other).alias(OTHER),
        *rest,
    )


def sound(docs: DataFrame) -> DataFrame:
    """The documents of a tolerant read that could be parsed."""
    return docs.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def malformed(docs: DataFrame) -> DataFrame:
    """(document): the others, as they came."""
    return docs.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("document"))


def latest_batch(docs: DataFrame, ts_col: str = "fetched_at") -> DataFrame:
    """Documents of the most recent batch, compared as timestamps (never as
    file names or strings). The max is a one-row aggregate joined back. What a
    tolerant read couldn't parse has no stamp and stays with the batch."""
    ts = instant(ts_col)
    newest = docs.agg(F.max(ts).alias("_newest"))
    mine = ts == F.col("_newest")
    if CORRUPT in docs.columns:
        mine = mine | F.col(CORRUPT).isNotNull()
    return docs.join(F.broadcast(newest), mine).drop("_newest")


def explode_entity(docs: DataFrame, entity: str) -> DataFrame:
    """One row per entity record, stamped with its batch (``ingested_at``, ``source_name``)."""
    return docs.select(
        F.col("fetched_at").alias("ingested_at"), "source_name", F.inline(F.col(entity))
    ).select(*ENTITIES[entity], "ingested_at", "source_name")


def batch_summary(docs: DataFrame) -> DataFrame:
    """Per batch: how many records of each entity it carries (absent list -> 0)."""
    return docs.groupBy("fetched_at", "source_name").agg(
        *[F.coalesce(F.sum(F.size(F.col(e))), F.lit(0)).cast("long").alias(e) for e in ENTITIES]
    )


# --- group-map variant of the snapshot source ------------------------------------


def write_group_map(path: str, teams: DataFrame, fetched_at: str, source_name: str, rows_per_doc: int = ROWS_PER_DOC) -> None:
    """Teams as ``{group: [names]}`` documents of at most ``rows_per_doc`` names, however large one group is, as a batch."""
    rows = bounded(teams.select("group", "name"), rows_per_doc)
    lists = rows.groupBy("_bucket", "_doc", "group").agg(F.collect_list("name").alias("names"))
    docs = lists.select(F.create_map(F.coalesce(F.col("group"), F.lit(NO_GROUP)), "names").alias("groups"))
    _write(docs, path, fetched_at, source_name)


def read_group_map(spark: SparkSession, path: str) -> DataFrame:
    return read_landing(spark, path, schema=GROUP_MAP_PAYLOAD)


def flatten_group_map(docs: DataFrame) -> DataFrame:
    """``explode(map)`` then ``explode(array)`` -> (name, group, source_table)."""
    pairs = docs.select(F.explode("groups").alias("group", "names"))
    return pairs.select(
        F.explode("names").alias("name"),
        F.when(F.col("group") != NO_GROUP, F.col("group")).alias("group"),
        F.lit(None).cast("string").alias("source_table"),
    )
