"""Match-event files: one JSON object per event (or JSON lines), read with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scoreline.schemas import EVENTS
from scoreline.sources.io import path_exists

# Keep microseconds through the JSON text form.
NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
ROWS_PER_FILE = 500_000


def read_events(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame | None:
    """Batch sweep of an event directory; ``None`` when it is absent or empty."""
    if not path_exists(spark, path):
        return None
    df = (
        spark.read.schema(EVENTS).option("multiLine", multi_line).option("timestampNTZFormat", NTZ_FORMAT).json(path)
    )
    return None if df.isEmpty() else df


def write_json(df: DataFrame, path: str) -> None:
    """Append JSON lines as compressed files of at most ``ROWS_PER_FILE`` rows, since a reader can't split one."""
    w = df.write.mode("append").option("timestampNTZFormat", NTZ_FORMAT)
    w.option("compression", "gzip").option("maxRecordsPerFile", ROWS_PER_FILE).json(path)


def write_events(df: DataFrame, path: str) -> None:
    """Land events as JSON lines (see `write_json`)."""
    write_json(df.select(*EVENTS.fieldNames()), path)
