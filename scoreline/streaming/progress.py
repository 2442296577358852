"""What each micro-batch of a stream brought, kept as a table.

A stream that observes its input under `OBSERVED` reports rows in, rows rejected
and the latest stamp with its progress, counted in the job that does the work.
`keep` stores the progress of a query that has ended; `ProgressLog` listens to
one that goes on. Rows are kept by query and micro-batch, so progress that is
reported again, or a query that is started again, adds nothing twice.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from scoreline.operators.dedup import keep_latest
from scoreline.schemas import CORRUPT
from scoreline.sources.io import batch_ids, read_batches, write_batch

OBSERVED = "input"
PROGRESS = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("micro_batch", T.LongType()),
        T.StructField("rows_in", T.LongType()),
        T.StructField("rejected", T.LongType()),
        T.StructField("latest", T.TimestampNTZType()),
    ]
)


def observed(rows: DataFrame, stamp: str = "ingested_at") -> DataFrame:
    """``rows`` of a stream, counted as they pass."""
    bad = F.col(CORRUPT).isNotNull() if CORRUPT in rows.columns else F.lit(False)
    # as text: progress reports of stamps end at the second
    latest = F.max(stamp).cast("string")
    return rows.observe(OBSERVED, F.count(F.lit(1)).alias("rows_in"), F.count_if(bad).alias("rejected"), latest.alias("latest"))


def _row(progress) -> tuple | None:
    seen = progress.observedMetrics.get(OBSERVED)
    if seen is None or not seen["rows_in"]:
        return None
    latest = seen["latest"] and dt.datetime.fromisoformat(seen["latest"])
    return str(progress.id), int(progress.batchId), int(seen["rows_in"]), int(seen["rejected"]), latest


def _store(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    if rows:
        number = max(batch_ids(spark, path), default=-1) + 1
        write_batch(spark.createDataFrame(rows, PROGRESS).coalesce(1), path, number)


def keep(spark: SparkSession, query: StreamingQuery, path: str) -> None:
    """Store what ``query`` has reported: a row for each micro-batch that brought any."""
    _store(spark, path, [r for r in map(_row, query.recentProgress) if r])


class ProgressLog(StreamingQueryListener):
    """Stores the progress of running queries, ``every`` micro-batches at once; add it with ``spark.streams.addListener``."""

    def __init__(self, spark: SparkSession, path: str, every: int = 1):
        self.spark, self.path, self.every = spark, path, every
        self.held: list[tuple] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = _row(event.progress)
        if row:
            self.held.append(row)
        if len(self.held) >= self.every:
            self.flush()

    def onQueryIdle(self, event) -> None:
        self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        rows, self.held = self.held, []
        _store(self.spark, self.path, rows)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row for each micro-batch."""
    rows = read_batches(spark, path, PROGRESS)
    return keep_latest(rows, ["query", "micro_batch"], ["batch_id"]).select(*PROGRESS.fieldNames())


def freshness(progress: DataFrame) -> DataFrame:
    """One row: all rows in, all rejected, the latest stamp."""
    return progress.agg(
        F.coalesce(F.sum("rows_in"), F.lit(0)).alias("rows_in"),
        F.coalesce(F.sum("rejected"), F.lit(0)).alias("rejected"),
        F.max("latest").alias("latest"),
    )
