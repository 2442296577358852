"""Contiguous shards of equal bytes: global prefix sums from per-partition totals, cut at equal targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, narrow, partitions


def byte_shards(
    df: DataFrame, n_shards: int = 24, overhead: int = 8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Cut the rows, in the order of ``id_col``, into ``n_shards`` contiguous shards of nearly equal bytes.

    A row weighs the UTF-8 bytes of its text (null: none) plus ``overhead``.
    Rows are sorted into range partitions by id; each partition's bytes are
    summed, the sums of the partitions (one row each) are added up in order,
    and a row's place is its partition's start plus the running sum inside the
    partition. A shard holds the rows whose middle byte lies in its n-th equal
    share of all bytes, so shards differ by less than the largest row.

    Returns ``id_col``, size, text_crc32 (of the UTF-8 bytes; of no bytes for
    null), shard (from 0) and slot, the row's place in its shard, gapless from
    0. Ties of the id come in the order of checksum, size and place of reading:
    rows that differ in none are interchangeable. Null ids come first. An empty
    table gives no rows. Only three numbers a row are shuffled, never a text,
    and no partition needs more than its own rows: a hot id is spread by the
    place of reading.
    """
    spark = df.sparkSession
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = narrow(df, id_col, text_col).select(
        "id",
        (F.octet_length(body) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("uid"),
    )
    n = partitions(spark)
    order = [F.col(c).asc_nulls_first() for c in ("id", "text_crc32", "size", "uid")]
    # written once: the bounds of the ranges come from a sample, and both uses below must see the same
    ranged = materialize(rows.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), "shard-rows")
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(whole).alias("all_bytes"),
    )
    inside = Window.partitionBy("part").orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        ranged.withColumn("end", F.sum("size").over(running))
        .withColumn("nth", F.row_number().over(inside))
        .join(F.broadcast(totals), "part")  # as many rows as there are partitions
        .withColumn("middle", F.col("bytes_before") + F.col("end") - F.col("size") / 2)
        .withColumn("place", F.col("rows_before") + F.col("nth") - 1)
        .withColumn("shard", F.least(F.floor(F.col("middle") * n_shards / F.col("all_bytes")), F.lit(n_shards - 1)).cast("int"))
    )
    placed = materialize(placed.select("id", "size", "text_crc32", "shard", "place"), "shards")
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))  # a row for each shard
    return placed.join(F.broadcast(first), "shard").select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot")
    )
