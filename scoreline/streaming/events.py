"""Match events as Structured Streaming jobs (bronze -> silver -> gold).

* ``land_events``: file-source stream of JSON event files into a bronze
  parquet table; the checkpoint records which files were taken, so each file
  lands once (a sweep that re-reads every file is what the batch dedup had to
  clean up after). A line that is no event is kept in ``_corrupt_record``;
  ``rejected`` reads those, everything else leaves them out.
* ``silver_events``: one batch folder per micro-batch with the event ids that
  silver hasn't yet, the first delivery of each. The state store (RocksDB)
  remembers the ids of the last ``delay``, so a micro-batch reads nothing of
  what is stored. What comes too late for the store is told by its stamp and
  compared exactly, with the batches alone whose filters may hold its ids.
* ``top_scorers``: goals per (player, team) of each silver batch that has no
  entry yet, one folder per batch; entries are compacted into totals, so a
  reader adds up a few of them.

Every write replaces the folder of its own batch, so replays and reruns change
nothing. The jobs are chained through tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from scoreline.functions import ntz
from scoreline.operators import gold, membership, silver
from scoreline.operators.dedup import keep_first
from scoreline.schemas import CORRUPT, EVENTS, EVENTS_LANDED
from scoreline.sources.buckets import Buckets
from scoreline.sources.events import NTZ_FORMAT
from scoreline.sources.io import batch_ids, path_exists, read_batches, write_batch
from scoreline.streaming import progress

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EPOCH = dt.datetime(1970, 1, 1)
INDEX_SCHEMA = T.StructType(
    [T.StructField("bits", T.LongType()), T.StructField("bucket", T.LongType()), T.StructField("bitmap", T.BinaryType())]
)
MARKS = T.StructType([T.StructField("latest", T.TimestampNTZType())])
GOALS = T.StructType(
    [
        T.StructField("player", T.StringType()),
        T.StructField("team", T.StringType()),
        T.StructField("goals", T.LongType()),
        T.StructField("source_batch", T.LongType()),
    ]
)


def event_stream(spark: SparkSession, in_dir: str, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(EVENTS_LANDED).option("timestampNTZFormat", NTZ_FORMAT)
    r = r.option("columnNameOfCorruptRecord", CORRUPT)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(in_dir)


def well_formed(landed: DataFrame) -> DataFrame:
    return landed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected(spark: SparkSession, bronze_path: str) -> DataFrame:
    """The landed lines that are no events."""
    return spark.read.schema(EVENTS_LANDED).parquet(bronze_path).filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def _run(writer, available_now: bool = True, every: str | None = None) -> StreamingQuery:
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q


def land_events(
    spark: SparkSession,
    in_dir: str,
    out_path: str,
    checkpoint: str,
    available_now: bool = True,
    max_files: int | None = None,
    progress_path: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Bronze: every new event file lands once in a parquet table
    (``max_files`` bounds the files per micro-batch; availableNow honours it).
    ``every`` is the interval of a job that goes on ('5 minutes').

    What each micro-batch brought is counted; with ``progress_path`` it is kept
    there (a job that goes on keeps it through a ``ProgressLog``).
    """
    rows = progress.observed(event_stream(spark, in_dir, max_files))
    if progress_path and not available_now:
        spark.streams.addListener(progress.ProgressLog(spark, progress_path))
    w = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    q = _run(w.option("path", out_path).outputMode("append"), available_now, every)
    if progress_path and available_now:
        progress.keep(spark, q, progress_path)
    return q


def with_state(events: DataFrame, delay: str) -> DataFrame:
    """Every delivery, and beside them, marked ``_first``, the ids that the state store hasn't seen.

    The store remembers an id until the watermark, the latest stamp less
    ``delay``, has passed the id's stamp by ``delay``; what is older than the
    watermark doesn't reach it (see `settle`).
    """
    stamp = F.coalesce(F.col("ingested_at"), ntz(EPOCH)).cast("timestamp")
    ids = events.select("event_id", stamp.alias("_at")).withWatermark("_at", delay)
    ids = ids.dropDuplicatesWithinWatermark(["event_id"]).select("event_id", F.lit(True).alias("_first"))
    return events.withColumn("_first", F.lit(False)).unionByName(ids, allowMissingColumns=True)


def candidate_batches(spark: SparkSession, out_path: str, ids: DataFrame, before: list[int]) -> list[int]:
    """The silver batches among ``before`` that may hold one of ``ids``, by the filters stored beside them."""
    index = read_batches(spark, index_path(out_path), INDEX_SCHEMA, before)
    found = membership.may_hold(index, ids, "event_id").select("batch_id").distinct()
    indexed = set(batch_ids(spark, index_path(out_path)))
    # numbers of folders; a batch without a filter is always looked at
    return sorted({r["batch_id"] for r in found.collect()} | {i for i in before if i not in indexed})


def index_path(out_path: str) -> str:
    return f"{out_path.rstrip('/')}_index"


def marks_path(out_path: str) -> str:
    return f"{out_path.rstrip('/')}_marks"


def settle(
    deliveries: DataFrame, firsts: DataFrame, out_path: str, batch_id: int, delay: str, restamped: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(new events, the latest stamp) of a micro-batch, given all its deliveries and the ids that the state store let through.

    A delivery stamped ``delay`` before the latest stamp so far, or not stamped,
    may have been too late for the store. Those, and with ``restamped`` all, are
    compared with the silver batches that may hold their ids.
    """
    spark = deliveries.sparkSession
    first = keep_first(deliveries, ["event_id"], ["ingested_at"])
    before = [i for i in batch_ids(spark, out_path) if i < batch_id]
    marked = [i for i in batch_ids(spark, marks_path(out_path)) if i < batch_id]
    last = read_batches(spark, marks_path(out_path), MARKS, marked[-1:]).select("latest")
    latest = deliveries.agg(F.max("ingested_at").alias("latest")).unionByName(last).agg(F.max("latest").alias("latest"))
    top = latest.first()["latest"] or EPOCH  # one-row control value
    late = F.coalesce(F.col("ingested_at") < ntz(top) - F.expr(f"INTERVAL {delay}"), F.lit(True))
    # merged: the sizes of what is cached or packed tell too little of the ids, and a wrong guess would send them all to the driver
    known = firsts.select(F.col("event_id").alias("_id")).hint("merge")
    in_time = first.filter(~late).join(known, F.col("event_id").eqNullSafe(F.col("_id")), "left_semi")
    doubtful = first.filter(late)
    if restamped:
        in_time, doubtful = in_time.limit(0), doubtful.unionByName(in_time)
    if before and not doubtful.isEmpty():
        where = candidate_batches(spark, out_path, doubtful.select("event_id"), before)
        seen = read_batches(spark, out_path, EVENTS, where).select(F.col("event_id").alias("_seen")).hint("merge")
        doubtful = doubtful.join(seen, F.col("event_id").eqNullSafe(F.col("_seen")), "left_anti")
    return in_time.unionByName(doubtful), spark.createDataFrame([(top,)], MARKS)


def silver_events(
    spark: SparkSession,
    bronze_path: str,
    out_path: str,
    checkpoint: str,
    available_now: bool = True,
    max_files: int | None = None,
    then=None,
    delay: str = "2 days",
    restamped: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Silver: the bronze table as a stream, each event once; ``then()`` runs after each micro-batch.

    All deliveries of an event are taken to carry its stamp, or stamps less than
    ``delay`` apart if the first one comes in time; ``restamped`` makes no such
    assumption and looks every new id up in the filters.
    """
    if not path_exists(spark, bronze_path):  # nothing landed yet: an empty table that the stream can start on
        spark.createDataFrame([], EVENTS_LANDED).write.mode("ignore").parquet(bronze_path)
    r = spark.readStream.schema(EVENTS_LANDED)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # the state store is asked once
        try:
            deliveries = batch.filter(~F.col("_first")).drop("_first")
            new, mark = settle(deliveries, batch.filter("_first"), out_path, batch_id, delay, restamped)
            n = write_batch(new, out_path, batch_id)
            stored = read_batches(batch.sparkSession, out_path, EVENTS, [batch_id])
            write_batch(membership.build(stored, "event_id", n), index_path(out_path), batch_id)
            write_batch(mark, marks_path(out_path), batch_id)
        finally:
            batch.unpersist()
        if then is not None:
            then()

    rows = with_state(well_formed(r.parquet(bronze_path)), delay)
    w = rows.writeStream.foreachBatch(upsert).outputMode("append").option("checkpointLocation", checkpoint)
    store = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)  # read when the query starts, and kept in its checkpoint
    try:
        return _run(w, available_now, every)
    finally:
        spark.conf.set(STATE_STORE, store)


def upsert_events(
    spark: SparkSession, bronze_path: str, store: Buckets, checkpoint: str, available_now: bool = True, max_files: int | None = None
) -> StreamingQuery:
    """The latest delivery of each event, kept in ``store`` (by event_id): new bronze files rewrite the buckets they touch."""
    r = spark.readStream.schema(EVENTS_LANDED)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        store.upsert(well_formed(batch), batch_id, lambda old, new: silver.events(old.unionByName(new)), EVENTS)

    w = r.parquet(bronze_path).writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return _run(w, available_now)


def read_silver(spark: SparkSession, silver_path: str) -> DataFrame:
    return read_batches(spark, silver_path, EVENTS).select(*EVENTS.fieldNames())


def top_scorers(spark: SparkSession, silver_path: str, totals_path: str, compact_every: int = 16) -> list[int]:
    """Gold: adds the goals of each silver batch that the totals haven't; returns those batches.

    Each batch has an entry of its own. Every ``compact_every`` batches the
    entries so far become one: the totals of all players through that batch.
    Entries are written once and replaced only by themselves, so a run that died
    can be repeated.
    """
    done = set(batch_ids(spark, totals_path))
    new = [i for i in batch_ids(spark, silver_path) if i not in done]
    for i in new:
        goals = gold.top_scorers(read_batches(spark, silver_path, EVENTS, [i]))
        write_batch(goals.withColumn("source_batch", F.lit(i).cast("long")), totals_path, i)
    if len(since_compacted(spark, totals_path)) >= compact_every:
        last = batch_ids(spark, totals_path)[-1]
        whole = read_top_scorers(spark, totals_path).withColumn("source_batch", F.lit(last).cast("long"))
        write_batch(whole, compact_path(totals_path), last)
    return new


def since_compacted(spark: SparkSession, totals_path: str) -> list[int]:
    """The entries that the last compacted totals don't hold; silver batches come one after another."""
    compacted = batch_ids(spark, compact_path(totals_path))
    return [i for i in batch_ids(spark, totals_path) if not compacted or i > compacted[-1]]


def compact_path(totals_path: str) -> str:
    return f"{totals_path.rstrip('/')}_compact"


def read_top_scorers(spark: SparkSession, totals_path: str) -> DataFrame:
    """Current goals per (player, team): the last compacted totals and the entries that aren't in them."""
    last = batch_ids(spark, compact_path(totals_path))[-1:]
    log = read_batches(spark, compact_path(totals_path), GOALS, last).unionByName(
        read_batches(spark, totals_path, GOALS, since_compacted(spark, totals_path))
    )
    return log.groupBy("player", "team").agg(F.sum("goals").alias("goals"))
