"""Which batches may hold a key: a Bloom filter for each batch, as rows of bitmaps.

A key sets ``HASHES`` bits of its batch's filter, which has at least
``BITS_PER_KEY`` bits a key, in powers of two. The filter is stored as one row
for each 32,768 bits that has any set (Spark's own bitmap functions), so a batch
of any size is built by a partial aggregate and looked up by an equi-join. A key
that a batch holds is always found; one that it doesn't is taken for held with a
probability of about 1.2e-4, so what is found is compared exactly afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASHES = 6
BITS_PER_KEY = 24
BUCKET_BITS = 32_768  # fixed by Spark's bitmap functions


def filter_bits(keys: int) -> int:
    """Bits of a filter over ``keys`` keys."""
    return max(BUCKET_BITS, 1 << (BITS_PER_KEY * keys - 1).bit_length())


def _places(key: Column, bits: int) -> Column:
    """(which hash, bucket, bit) of a key; null is a key like any other."""
    place = lambda k: F.pmod(F.xxhash64(F.lit(k), key), F.lit(bits)) + 1
    return F.array(
        *[
            F.struct(
                F.lit(k).alias("k"),
                F.bitmap_bucket_number(place(k)).alias("bucket"),
                F.bitmap_bit_position(place(k)).alias("bit"),
            )
            for k in range(HASHES)
        ]
    )


def build(keys: DataFrame, key: str, n: int) -> DataFrame:
    """The filter over the ``n`` values of ``key``: (bits, bucket, bitmap)."""
    bits = filter_bits(n)
    places = keys.select(F.inline(_places(F.col(key), bits)))
    rows = places.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    return rows.select(F.lit(bits).cast("long").alias("bits"), "bucket", "bitmap")


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("getbit", byte, (bit % 8).cast("int")) == 1


def may_hold(index: DataFrame, keys: DataFrame, key: str, batch: str = "batch_id") -> DataFrame:
    """(key, batch): the batches of ``index`` (with a column ``batch``) that may hold each value of ``key``."""
    sizes = sorted(r["bits"] for r in index.select("bits").distinct().collect())  # powers of two: at most some 40
    if not sizes:
        return keys.select(key).join(index.select(batch).limit(0), F.lit(False))
    asked = keys.select(key).distinct()
    sized = F.array(*[F.struct(F.lit(b).cast("long").alias("bits"), _places(F.col(key), b).alias("places")) for b in sizes])
    probes = asked.select(key, F.inline(sized)).select(key, "bits", F.inline("places"))
    # merged: neither the filters nor the probes go through the driver
    met = probes.join(index.select(batch, "bits", "bucket", "bitmap").hint("merge"), ["bits", "bucket"])
    hits = met.filter(_is_set(F.col("bitmap"), F.col("bit"))).groupBy(key, batch).agg(F.count_distinct("k").alias("n"))
    return hits.filter(F.col("n") == HASHES).select(key, batch)
