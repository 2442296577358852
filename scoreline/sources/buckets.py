"""Tables that are kept current by rewriting the buckets that a batch touches.

Rows are dealt to a fixed number of buckets by a hash of their key. Batch N
writes ``<table>/version=<N>/bucket=<b>`` for each bucket that its rows fall
into, with all rows of that bucket; a bucket's current rows are in its greatest
committed version. A batch builds on the versions before it and replaces its
own only, so it can be run again, and what a died run left is read by nobody.

What is stored lies by bucket, and a batch's rows are stored so too, packed,
before they are merged. A task reads whole buckets of both, or keeps its part of
a large one's keys, so neither is shuffled: shuffle files take three times the space.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import AbstractContextManager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreline.session import scratch_path, settings
from scoreline.sources.io import (
    BUCKET,
    VERSION,
    Tables,
    bucket_folders,
    delete,
    folder_bytes,
    partition_values,
    snapshot_id,
    version_ids,
    writer,
)

PART = "_part"
DEALT = [BUCKET, PART]
#: Packed bytes of buckets that one task of a `merge` reads: at least, and at most (some 4 million matches).
TASK_BYTES = 2 << 20, 80 << 20
Build = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass
class Buckets:
    """Table ``name`` of ``tables``, its rows dealt to ``count`` buckets by ``keys``.

    ``count`` and ``keys`` must stay as they were when the table began.
    """

    tables: Tables
    name: str
    keys: Sequence[str]
    count: int = 64

    @property
    def path(self) -> str:
        return self.tables.path(self.name)

    def number(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.count)).cast("int")

    def versions(self) -> list[int]:
        return version_ids(self.tables.spark, self.path)

    def folders(self, before: int | None = None, only: set[int] | None = None) -> dict[int, str]:
        return bucket_folders(self.tables.spark, self.path, before, only)

    def read(self, schema: T.StructType, before: int | None = None, only: set[int] | None = None) -> DataFrame:
        """The current rows, or those before a version, of all or of some buckets."""
        found = self.folders(before, only)
        spark = self.tables.spark
        if not found:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).format(self.tables.fmt).load(sorted(found.values()))

    def part(self, parts: int) -> Column:
        """The number of a row's part where its bucket is cut into ``parts``: a key lies in one."""
        return F.pmod(F.xxhash64(F.lit("part"), *self.keys), F.lit(parts)).cast("int")

    def dealt(self, rows: DataFrame) -> DataFrame:
        """``rows`` with `DEALT`, shuffled by it: each task has whole keys and few buckets.

        What groups by `DEALT` and the key needs no other shuffle, nor does the
        write of an `upsert` whose ``build`` leaves `DEALT` in.
        """
        partitions = int(self.tables.spark.conf.get("spark.sql.shuffle.partitions"))
        part = self.part(max(1, -(-2 * partitions // self.count)))
        return rows.withColumns({BUCKET: self.number(), PART: part}).repartition(*DEALT)

    def tasks(self, sizes: dict[int, int], bounds: tuple[int, int] = TASK_BYTES) -> list[tuple[list[int], int, int]]:
        """Buckets of so many bytes dealt to tasks: small ones together, a large one as ``(buckets, part, parts)``."""
        least, most = bounds
        cores = self.tables.spark.sparkContext.defaultParallelism
        most = min(most, max(least, sum(sizes.values()) // (2 * cores)))
        out: list[tuple[list[int], int, int]] = []
        held, room = [], most
        for b, n in sorted(sizes.items()):
            if n > most:
                parts = -(-n // most)
                out += [([b], p, parts) for p in range(parts)]
                continue
            if held and n > room:
                out.append((held, 0, 1))
                held, room = [], most
            held, room = [*held, b], room - n
        return [*out, (held, 0, 1)] if held else out

    def spread(self, spark: SparkSession) -> AbstractContextManager:
        """Settings for a write by bucket: a writer for each one instead of a sort, and code that is compiled once for tasks alike."""
        each = {"spark.sql.maxConcurrentOutputFileWriters": str(self.count), "spark.sql.codegen.useIdInClassName": "false"}
        return settings(spark, each)

    def upsert(self, rows: DataFrame, batch_id: int, build: Build, schema: T.StructType, task_bytes: tuple[int, int] = TASK_BYTES) -> set[int]:
        """Write version ``batch_id``: ``build(old, rows)`` for the buckets that ``rows`` touch; returns those.

        ``rows`` are stored by bucket until that is done; see `merge` for ``build``.
        """
        spark = self.tables.spark
        staged = scratch_path(spark, "staged")
        try:
            with self.spread(rows.sparkSession):
                writer(rows.withColumn(BUCKET, self.number()), "parquet").partitionBy(BUCKET).save(staged)
            came = {int(b): [f"{staged}/{BUCKET}={b}"] for b in partition_values(spark, staged, BUCKET)}
            read = lambda folders: spark.read.schema(rows.schema).parquet(*folders)
            return self.merge(came, read, batch_id, build, schema, task_bytes)
        finally:
            delete(spark, staged)

    def merge(
        self,
        came: dict[int, list[str]],
        read: Callable[[list[str]], DataFrame],
        batch_id: int,
        build: Build,
        schema: T.StructType,
        task_bytes: tuple[int, int] = TASK_BYTES,
    ) -> set[int]:
        """Write version ``batch_id`` of the buckets that rows ``came`` for, in folders that ``read`` reads; returns those.

        ``build(old, new)`` is asked for each task's keys by themselves: ``old``
        has all of their current rows, ``new`` all that came, each in a single
        partition, so what groups by the keys needs no shuffle. What it gives must
        lie in the same buckets; it may be `dealt` already.
        """
        spark, fmt = self.tables.spark, self.tables.fmt
        stored = self.folders(before=batch_id, only=set(came))
        sizes = {b: sum(folder_bytes(spark, f) for f in [*folders, *([stored[b]] if b in stored else [])]) for b, folders in came.items()}
        out = nothing = spark.createDataFrame([], schema)
        for n, (buckets, part, parts) in enumerate(self.tasks(sizes, task_bytes)):
            known = [stored[b] for b in buckets if b in stored]
            old = spark.read.schema(schema).format(fmt).load(known) if known else nothing
            new = read([f for b in buckets for f in came[b]])
            if parts > 1:
                old, new = (df.filter(self.part(parts) == part) for df in (old, new))
            built = build(old.coalesce(1), new.coalesce(1))
            if BUCKET not in built.columns:
                built = built.withColumn(BUCKET, self.number())
            # 2: Spark unites single partitions into a single one, and all tasks would be one
            built = built.select(*schema.fieldNames(), BUCKET).coalesce(2)
            out = out.unionByName(built) if n else built
        if not came:
            out = nothing.withColumn(BUCKET, self.number())
        with self.spread(spark):
            writer(out, fmt).partitionBy(BUCKET).save(f"{self.path}/{VERSION}={snapshot_id(batch_id)}")
        return set(came)

    def retain(self, before: int) -> int:
        """Delete the buckets that no version from ``before`` on builds on or reads; returns how many."""
        spark = self.tables.spark
        needed = set(self.folders(before).values())
        gone = 0
        for v in [v for v in self.versions() if v < before]:
            folder = f"{self.path}/{VERSION}={snapshot_id(v)}"
            for b in partition_values(spark, folder, BUCKET):
                if f"{folder}/{BUCKET}={b}" not in needed:
                    delete(spark, f"{folder}/{BUCKET}={b}")
                    gone += 1
        return gone
