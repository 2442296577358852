"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import scratch_path

MASK64 = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage with files that every executor can reach, so a lost
    executor costs the running tasks only.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def narrow(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text) alone: other columns, whatever their names, never meet an operator's own."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows, else as it is (shuffle join).

    ``df`` should be materialized: it is counted. Rows must be narrow (a few numbers).
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def map_texts(df: DataFrame, schema: StructType | str, each: Callable[[list, list], dict]) -> DataFrame:
    """Apply ``each(ids, texts) -> columns`` to (id, text) rows, a MB of text at a time."""
    types = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in sliced(batches):
            yield pa.RecordBatch.from_pydict(each(ids, texts), schema=types)

    return df.select("id", "text").mapInArrow(run, schema)


def sliced(batches: Iterable[pa.RecordBatch], max_bytes: int = 1_000_000) -> Iterator[tuple[list, list]]:
    """Lists of ids and texts; a slice ends once its texts reach ``max_bytes``.

    Only a slice's texts become Python strings, not those of the whole batch.
    """
    for b in batches:
        ids, texts = b.column("id"), b.column("text")
        start = size = 0
        for i, n in enumerate(pc.binary_length(texts).to_pylist()):
            size += n or 0
            if size >= max_bytes or i + 1 == len(texts):
                yield ids.slice(start, i + 1 - start).to_pylist(), texts.slice(start, i + 1 - start).to_pylist()
                start, size = i + 1, 0


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, remembered; forgets everything when too large."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, hashes: WordHashes, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``size``-word shingles of a whole text.

    A-Z are lower-cased, words are runs of characters other than space and
    U+0009-U+000D; a text of fewer words is one shingle; none without words.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(size, len(w))
    h = np.full(len(w) - k + 1, k, np.uint64)
    for j in range(k):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + w[j : len(w) - k + 1 + j])
    h.sort()
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


def words(text: Column) -> Column:
    """Native words: lower-cased, cut at spaces and U+0009-U+000D; none for null."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root): the smallest node reachable from each node of the undirected ``edges`` (a, b).

    Alternating large-star and small-star rounds: every round is two
    aggregations over the edges, whose number never grows, and a path halves
    its depth per round. Each round is written to the shared folder. A hub's
    edges are reduced by a partial minimum before the shuffle.
    """
    e = materialize(edges.filter("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), name)
    while True:
        # large star: a node's larger neighbours point to the smallest of its neighbourhood
        both = e.unionByName(e.selectExpr("b AS a", "a AS b"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        e1 = both.filter("b > a").join(low, "a").selectExpr("b AS a", "m AS b").filter("a <> b").distinct()
        # small star: a node's smaller neighbours and itself point to the smallest of them
        low = e1.groupBy("a").agg(F.min("b").alias("m"))
        e2 = e1.join(low, "a").selectExpr("CASE WHEN b = m THEN a ELSE b END AS a", "m AS b").filter("a <> b")
        e2 = materialize(e2.distinct(), name)
        # done when every edge leads from a node that has no other edge up to a root that has none
        stars = e2.groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("root"))
        loose = stars.filter("n > 1").limit(1).count() or stars.join(stars.select(F.col("a").alias("root")), "root", "left_semi").limit(1).count()
        if not loose:
            return stars.selectExpr("a AS node", "root").unionByName(stars.selectExpr("root AS node", "root").distinct())
        e = e2
