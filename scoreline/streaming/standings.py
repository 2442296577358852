"""Standings kept current from a stream of match updates.

Each micro-batch (``foreachBatch``) does work that follows what it brings:

* bronze: its rows, as a batch folder, by bucket of matches (a table that began
  without buckets goes on so);
* silver: the buckets of matches that its rows fall into are rewritten
  (keep-latest over their current rows and the new ones, see ``Buckets``);
* totals: what the old rows of these buckets gave each (group, team) is taken
  back, what the new ones give is added (``standings.deltas``);
* standings: groups in which anything moved are ranked again and applied to the
  SCD2 history as a new snapshot (partitioned by ``is_current``: the open
  versions plus only the versions closed by this batch; earlier history is never
  rewritten, see ``Tables.read_versions``); open versions of other groups pass
  through.

Everything is kept by batch id, and a replayed batch starts from what was
committed before its own id and replaces its own folders, so replays are
idempotent. The tables have names of their own (``stream_*``): a batch run may
share the root. Versions are stamped with the latest ``ingested_at`` stored so
far (the epoch if there is none), so rows without a stamp are kept too. Version
counts of each apply are observed in the write itself and stored together with
the live-match flag.

With ``only_live`` the gate stands before the work: while no match is open, in
silver or in what has arrived since, rows are landed in bronze and nothing else
is done; the first batch with an open match settles them all.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from scoreline.operators import quality, scd2, silver, standings
from scoreline.schemas import STANDINGS_COMPARE, STANDINGS_KEYS
from scoreline.session import SHUFFLES_GO, scratch_path, settings
from scoreline.sources.events import NTZ_FORMAT
from scoreline.sources.buckets import Buckets
from scoreline.sources.io import BATCH, BUCKET, Tables, batch_ids, loose_files, partition_values, snapshot_id

BRONZE, SILVER, STANDINGS, METRICS = "stream_bronze_matches", "stream_silver_matches", "stream_standings", "stream_metrics"
TOTALS = "stream_standings_totals"
#: A match stays in its bucket whatever else changes: meetings of a pair are numbered among all of them.
BUCKET_KEYS = ["home_team", "away_team"]
METRICS_SCHEMA = T.StructType(
    [
        T.StructField("is_live", T.BooleanType()),
        *[T.StructField(c, T.LongType()) for c in ("open_matches", "unchanged", "closed", "inserted", "total")],
        T.StructField("latest", T.TimestampNTZType()),
        T.StructField("settled", T.BooleanType()),
    ]
)
EPOCH = dt.datetime(1970, 1, 1)


def match_stream(spark: SparkSession, in_dir: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).option("timestampNTZFormat", NTZ_FORMAT)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(in_dir)


def silver_schema(batch: DataFrame, tiebreak: Sequence[str]) -> T.StructType:
    return silver.matches(batch.limit(0), list(tiebreak)).schema


def refresh(tables: Tables, tiebreak: Sequence[str] = (), buckets: int = 64, only_live: bool = False):
    """The per-micro-batch function for ``foreachBatch``."""

    store = Buckets(tables, SILVER, BUCKET_KEYS, buckets)

    def run(batch: DataFrame, batch_id: int) -> None:
        with settings(tables.spark, SHUFFLES_GO):
            settle(batch, batch_id)

    def settle(batch: DataFrame, batch_id: int) -> None:
        names, spark, bronze = batch.columns, tables.spark, tables.path(BRONZE)
        folder = lambda i: f"{bronze}/{BATCH}={snapshot_id(i)}"
        by_bucket = not any(loose_files(spark, folder(i)) for i in batch_ids(spark, bronze)[:1])
        with store.spread(batch.sparkSession):
            landed = batch.withColumn(BUCKET, store.number()) if by_bucket else batch
            if tables.append_batch(landed, BRONZE, batch_id, partition_by=[BUCKET] if by_bucket else None) == 0:
                return
        shape = silver_schema(batch, tiebreak)
        earlier = tables.read_batches(METRICS, METRICS_SCHEMA, [i for i in batch_ids(tables.spark, tables.path(METRICS)) if i < batch_id])
        last = earlier.orderBy(F.desc("batch_id")).first()  # one row a batch
        done = max([v for v in store.versions() if v < batch_id], default=-1)
        pending = [i for i in batch_ids(tables.spark, tables.path(BRONZE)) if done < i <= batch_id]
        arrived = tables.read_batches(BRONZE, batch.schema, pending).select(*names)
        stamp = arrived.agg(F.max("ingested_at").alias("t")).first()["t"]  # one-row control value
        stamp = max([t for t in (stamp, last and last["latest"]) if t is not None], default=EPOCH)
        if only_live and not (last and last["open_matches"]) and not quality.is_live(arrived).first()["is_live"]:
            waits = [(False, 0, 0, 0, 0, 0, stamp, False)]
            tables.append_batch(tables.spark.createDataFrame(waits, METRICS_SCHEMA), METRICS, batch_id)
            return

        def newest(old: DataFrame, new: DataFrame) -> DataFrame:
            known = old.select(*names, "meeting")
            return silver.matches(known.unionByName(new, allowMissingColumns=True), list(tiebreak))

        if by_bucket:
            came: dict[int, list[str]] = {}
            for i in pending:
                for b in partition_values(spark, folder(i), BUCKET):
                    came.setdefault(int(b), []).append(f"{folder(i)}/{BUCKET}={b}")
            landed_in = lambda folders: spark.read.schema(batch.schema).format(tables.fmt).load(folders)
            touched = store.merge(came, lambda folders: silver.typed_matches(landed_in(folders)), batch_id, newest, shape)
        else:
            touched = store.upsert(silver.typed_matches(arrived), batch_id, newest, shape)
        old = store.read(shape, before=batch_id, only=touched)
        new = store.read(shape, before=batch_id + 1, only=touched)

        prev = tables.snapshot_before(TOTALS, batch_id)
        delta = written(standings.deltas(old, new))
        before = delta.limit(0) if prev is None else tables.read(TOTALS, prev)
        tables.overwrite(standings.add_deltas(before, delta), TOTALS, batch_id)
        totals = tables.read(TOTALS, snapshot_id(batch_id))

        # groups in which anything moved
        moved = delta.select(F.col("group").alias("_g")).distinct()
        inside = F.col("group").eqNullSafe(F.col("_g"))
        incoming = standings.ranked(standings.from_totals(totals.join(moved, inside, "left_semi")))
        incoming = incoming.select(*standings.STANDINGS_COLUMNS)
        prev = tables.snapshot_before(STANDINGS, batch_id)
        if prev is None:
            merged = scd2.initial(incoming, stamp).withColumn("change", F.lit("inserted"))
        else:
            # only the open versions take part; closed history stays where it was written
            shape = scd2.initial(incoming, stamp).schema
            existing = scd2.current(tables.read(STANDINGS, prev, schema=shape))
            merged = scd2.merge(existing.join(moved, inside, "left_semi"), incoming, STANDINGS_KEYS, STANDINGS_COMPARE, stamp)
            others = existing.join(moved, inside, "left_anti").withColumn("change", F.lit("unchanged"))
            merged = merged.unionByName(others)
        obs = Observation(f"scd2_{batch_id}")
        c = F.col("change")
        observed = merged.observe(
            obs,
            F.count_if(c == "unchanged").alias("unchanged"),
            F.count_if(c == "closed").alias("closed"),
            F.count_if(c == "inserted").alias("inserted"),
            F.count(F.lit(1)).alias("total"),
        )
        tables.overwrite(observed.drop("change"), STANDINGS, batch_id, partition_by=["is_current"])
        counts = obs.get
        open_now = quality.is_live(new).first()["open_matches"] - quality.is_live(old).first()["open_matches"]
        open_now += last["open_matches"] if last else 0
        row = (open_now > 0, open_now, *(counts[k] for k in ("unchanged", "closed", "inserted", "total")), stamp, True)
        tables.append_batch(tables.spark.createDataFrame([row], METRICS_SCHEMA), METRICS, batch_id)

    return run


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: it is asked for several times."""
    path = scratch_path(df.sparkSession, "deltas")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_standings(
    spark: SparkSession,
    in_dir: str,
    tables: Tables,
    checkpoint: str,
    schema: T.StructType,
    tiebreak: Sequence[str] = (),
    available_now: bool = True,
    max_files: int | None = None,
    buckets: int = 64,
    only_live: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """``every`` is the interval of the trigger ('5 minutes') where the job goes on (``available_now=False``)."""
    w = (
        match_stream(spark, in_dir, schema, max_files)
        .writeStream.foreachBatch(refresh(tables, tiebreak, buckets, only_live))
        .option("checkpointLocation", checkpoint)
    )
    if every and not available_now:
        w = w.trigger(processingTime=every)
    q = (w.trigger(availableNow=True) if available_now else w).start()
    if available_now:
        q.awaitTermination()
    return q


def current(tables: Tables) -> DataFrame:
    return scd2.current(tables.read(STANDINGS)).select(*standings.STANDINGS_COLUMNS)


def silver_matches(tables: Tables, schema: T.StructType, tiebreak: Sequence[str] = (), buckets: int = 64) -> DataFrame:
    """The current silver matches, for match rows of ``schema``."""
    shape = silver_schema(tables.spark.createDataFrame([], schema), tiebreak)
    return Buckets(tables, SILVER, BUCKET_KEYS, buckets).read(shape)


def history(tables: Tables) -> DataFrame:
    """Every version: closed ones from all runs, open ones from the latest."""
    return tables.read_versions(STANDINGS)
