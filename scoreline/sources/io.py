"""Table I/O on a shared file system (parquet by default, format configurable).

Append tables are plain directories, or one directory per batch,
``<table>/batch_id=<id>``, so a rerun or a replay of a batch replaces its own
rows and no others. Overwrite tables keep one directory per snapshot,
``<table>/snapshot=<id>``, with zero-padded ids: batch N reads the greatest
committed snapshot before N (``snapshot_before``) and writes snapshot N, so a
job never overwrites what it reads, reruns included, and readers take the
greatest committed snapshot. Tables kept in buckets (``sources.buckets``) have a
directory per version with those buckets that it rewrote. Directories without a ``_SUCCESS`` marker (a job
that died) are read by nobody. Row counts come from an ``Observation`` attached
to the write itself, not from a second job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SNAPSHOT = "snapshot"
VERSION, BUCKET = "version", "bucket"
# Partition columns come back from directory names as text; their real types.
BATCH = "batch_id"
PARTITION_TYPES = {"is_current": "boolean", "ingest_date": "date", SNAPSHOT: "long", BATCH: "long"}


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def folder_names(spark: SparkSession, path: str, prefix: str, committed: bool = False) -> list[str]:
    """The ``<name>`` of the ``prefix=<name>`` folders, ascending; only those with a _SUCCESS marker if ``committed``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    # one listing, however many folders there are
    pattern = f"{prefix}=*/_SUCCESS" if committed else f"{prefix}=*"
    found = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, pattern)) or []
    names = [(st.getPath().getParent() if committed else st.getPath()).getName() for st in found]
    return sorted(n.split("=", 1)[1] for n in names)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of a partition column, from the names of its folders, ascending."""
    return folder_names(spark, path, column)


def loose_files(spark: SparkSession, path: str) -> list[str]:
    """The data files that lie in ``path`` itself."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    found = [st.getPath() for st in fs.listStatus(p) if st.isFile()]
    return sorted(f.toString() for f in found if not f.getName().startswith(("_", ".")))


def _committed(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Ids of the ``prefix=<id>`` folders that have a _SUCCESS marker, ascending."""
    return folder_names(spark, path, prefix, committed=True)


def _snapshots(spark: SparkSession, path: str) -> list[str]:
    return _committed(spark, path, SNAPSHOT)


def batch_ids(spark: SparkSession, path: str) -> list[int]:
    """Committed batches of a batch-wise append table, ascending."""
    return [int(i) for i in _committed(spark, path, BATCH)]


def version_ids(spark: SparkSession, path: str) -> list[int]:
    """Committed versions of a table that is kept in buckets, ascending."""
    return [int(v) for v in _committed(spark, path, VERSION)]


def bucket_folders(spark: SparkSession, path: str, before: int | None = None, only: set[int] | None = None) -> dict[int, str]:
    """The folder of the current rows of each bucket (of those in ``only``), as of the versions before ``before``."""
    out: dict[int, str] = {}
    for v in reversed([v for v in version_ids(spark, path) if before is None or v < before]):
        if only is not None and only <= set(out):
            break
        folder = f"{path}/{VERSION}={snapshot_id(v)}"
        for b in map(int, partition_values(spark, folder, BUCKET)):
            if only is None or b in only:
                out.setdefault(b, f"{folder}/{BUCKET}={b}")
    return out


def writer(df: DataFrame, fmt: str, mode: str = "overwrite") -> DataFrameWriter:
    """A writer of ``fmt``; Parquet is packed by zstd, a third smaller than Spark's default."""
    w = df.write.mode(mode).format(fmt)
    return w.option("compression", "zstd") if fmt == "parquet" else w


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """The size of all files below ``path``."""
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength())


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet", partition_by: list[str] | None = None) -> int:
    """Write ``df`` as batch ``batch_id`` of an append table, in place of what that batch wrote before."""
    obs = Observation(f"batch_{batch_id}")
    out = df.drop(BATCH).observe(obs, F.count(F.lit(1)).alias("rows"))
    w = writer(out, fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(f"{path}/{BATCH}={snapshot_id(batch_id)}")
    return int(obs.get["rows"])


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType, ids: list[int] | None = None, fmt: str = "parquet"
) -> DataFrame:
    """The given committed batches (all if not given), with their ``batch_id``."""
    known = batch_ids(spark, path)
    wanted = known if ids is None else [i for i in known if i in set(ids)]
    full = T.StructType([f for f in schema if f.name != BATCH])
    if not wanted:
        return spark.createDataFrame([], T.StructType([*full.fields, T.StructField(BATCH, T.LongType())]))
    folders = [f"{path}/{BATCH}={snapshot_id(i)}" for i in wanted]
    return _typed(spark.read.schema(full).option("basePath", path).format(fmt).load(folders))


def check_schema(df: DataFrame, schema: T.StructType | None, name: str) -> None:
    """Raise if ``df`` hasn't the declared columns and types."""
    if schema is None:
        return
    have, want = dict(df.dtypes), {f.name: f.dataType.simpleString() for f in schema}
    if have != want:
        wrong = sorted(c for c in {*have, *want} if have.get(c) != want.get(c))
        raise ValueError(f"table {name}: columns {wrong} differ from its schema: {[(c, have.get(c), want.get(c)) for c in wrong]}")


def _typed(df: DataFrame) -> DataFrame:
    types = dict(df.dtypes)
    fix = {c: F.col(c).cast(t) for c, t in PARTITION_TYPES.items() if c in types and types[c] != t}
    return df.withColumns(fix) if fix else df


def snapshot_id(n: int) -> str:
    return f"{n:012d}"


@dataclass
class Tables:
    """Named tables under one root URI (object-store URIs are kept verbatim)."""

    spark: SparkSession
    root: str
    fmt: str = "parquet"

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def exists(self, name: str) -> bool:
        """A committed table: a snapshot or batch, a plain write (_SUCCESS) or a streaming sink (_spark_metadata)."""
        p = self.path(name)
        if not path_exists(self.spark, p):
            return False
        return bool(_snapshots(self.spark, p) or batch_ids(self.spark, p) or version_ids(self.spark, p)) or any(
            path_exists(self.spark, f"{p}/{marker}") for marker in ("_SUCCESS", "_spark_metadata")
        )

    def append_batch(
        self, df: DataFrame, name: str, batch_id: int, schema: T.StructType | None = None, partition_by: list[str] | None = None
    ) -> int:
        """Append ``df`` as batch ``batch_id`` (a rerun replaces it); returns rows written."""
        check_schema(df, schema, name)
        return write_batch(df, self.path(name), batch_id, self.fmt, partition_by)

    def read_batches(self, name: str, schema: T.StructType, ids: list[int] | None = None) -> DataFrame:
        return read_batches(self.spark, self.path(name), schema, ids, self.fmt)

    def append(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> int:
        """Append ``df``; returns the number of rows written (observed in the write job)."""
        obs = Observation(f"append_{name}")
        w = writer(df.observe(obs, F.count(F.lit(1)).alias("rows")), self.fmt, "append")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(self.path(name))
        return int(obs.get["rows"])

    def overwrite(
        self,
        df: DataFrame,
        name: str,
        batch_id: int,
        partition_by: list[str] | None = None,
        schema: T.StructType | None = None,
    ) -> int:
        """Write ``df`` as snapshot ``batch_id`` of table ``name``; returns rows written."""
        check_schema(df, schema, name)
        obs = Observation(f"overwrite_{name}_{batch_id}")
        w = writer(df.observe(obs, F.count(F.lit(1)).alias("rows")), self.fmt)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(f"{self.path(name)}/{SNAPSHOT}={snapshot_id(batch_id)}")
        return int(obs.get["rows"])

    def latest_snapshot(self, name: str) -> str | None:
        snaps = _snapshots(self.spark, self.path(name))
        return snaps[-1] if snaps else None

    def snapshot_before(self, name: str, batch_id: int) -> str | None:
        """The greatest committed snapshot before ``batch_id``: what a run, or a rerun, of it builds on."""
        before = [s for s in _snapshots(self.spark, self.path(name)) if s < snapshot_id(batch_id)]
        return before[-1] if before else None

    def retain(self, name: str, keep: int, only: str | None = None) -> int:
        """Delete all but the last ``keep`` committed snapshots; of each only the partition ``only`` if given.

        An SCD2 table is pruned with ``only="is_current=true"``: closed versions are history and stay.
        """
        fs, p = _fs(self.spark, self.path(name))
        old = _snapshots(self.spark, self.path(name))[: -max(1, keep)]
        for snap in old:
            folder = f"{SNAPSHOT}={snap}" + (f"/{only}" if only else "")
            fs.delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, folder), True)
        return len(old)

    def read(self, name: str, snapshot: str | None = None, schema: T.StructType | None = None) -> DataFrame:
        """The latest snapshot of an overwrite table, the current buckets of a table kept in buckets, or the whole append table.

        A partitioned write of zero rows leaves no data file to infer a schema
        from; ``schema`` then gives the (empty) table its columns."""
        p = self.path(name)
        snap = snapshot or self.latest_snapshot(name)
        if snap is None and not path_exists(self.spark, p):
            raise FileNotFoundError(f"table {name} does not exist at {p}")
        where: str | list[str] = f"{p}/{SNAPSHOT}={snap}" if snap is not None else p
        if snap is None and version_ids(self.spark, p):
            where = sorted(bucket_folders(self.spark, p).values())
        try:
            return _typed(self.spark.read.format(self.fmt).load(where))
        except AnalysisException as e:
            if schema is None or "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            return self.spark.createDataFrame([], schema)

    def read_versions(self, name: str) -> DataFrame:
        """An SCD2 table stored as one snapshot per run, partitioned by
        ``is_current``: the versions closed by every committed run plus the open
        versions of the latest one. Both conditions are partition filters, so
        only those directories are read; history is never rewritten, and a run
        that died before its commit adds nothing."""
        committed = _snapshots(self.spark, self.path(name))
        if not committed:
            raise FileNotFoundError(f"table {name} has no committed snapshot")
        p = self.path(name)
        folders = [f"{p}/{SNAPSHOT}={s}" for s in committed]
        every = _typed(self.spark.read.option("basePath", p).format(self.fmt).load(folders))
        return every.filter(~F.col("is_current") | (F.col(SNAPSHOT) == int(committed[-1]))).drop(SNAPSHOT)
