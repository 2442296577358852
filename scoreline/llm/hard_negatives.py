"""Hard negatives for anchors by bounds along a spanning tree of the anchors.

Scores are inner products of whole numbers. Anchors are put into trees of
bounded size, each the minimum spanning tree of its anchors. The scores of a
tree's root are exact; a child differs from its parent by an edge of length d,
so the score of a candidate of norm r lies within d * r of the parent's. Only
candidates whose bounds reach into the window that is asked for are scored
again; the others keep their bounds, which widen from edge to edge.

The first pass looks for each anchor's best rows of its own label, where the
window begins at the lower bound that as many rows reach as are asked for. The
second looks for rows of other labels in the windows that these positives open.

Candidates are laid in blocks, trees in batches, and each block meets each
batch in a group of its own: that is the whole search of a stated set of
queries against all rows, and no group grows with the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, partitions

LARGEST = np.iinfo(np.int64).max
#: Whole numbers up to here are exact as floating-point numbers.
EXACT = 2.0**53


def usable(df: DataFrame, scale: int, anchor: Column, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(id, label, vector, anchor) of the rows that take part, components as whole numbers."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{label_col}`").cast("long").alias("label"),
        vector.alias("v"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        finite.alias("finite"),
    ).filter("label IS NOT NULL AND v IS NOT NULL AND finite")
    return rows.select("id", "label", F.transform("v", lambda x: F.floor(x * scale)).alias("vector"), "anchor")


def matrix(vectors: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of whole numbers; shorter vectors end in zeros."""
    rows = [np.asarray(v, np.int64) for v in vectors.to_pylist()]
    out = np.zeros((len(rows), max((len(r) for r in rows), default=0)), np.int64)
    for k, r in enumerate(rows):
        out[k, : len(r)] = r
    return out


def packed(m: np.ndarray) -> bytes:
    """A matrix in the narrowest numbers that hold it."""
    least = np.min_scalar_type(min(int(m.min(initial=0)), -1 - int(m.max(initial=0))))
    return least.char.encode() + m.astype(least).tobytes()


def unpacked(data: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(data, np.dtype(data[:1].decode()), offset=1).reshape(rows, -1 if rows and len(data) > 1 else 0).astype(np.int64)


def spanning_tree(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge): the rows in the order in which a minimum spanning tree takes them, the place of
    each one's parent in that order (-1 for the first) and the distance to it."""
    x = m.astype(np.float64)
    n = len(x)
    order, parent, edge = np.zeros(n, np.int64), np.full(n, -1), np.zeros(n)
    best, link, todo = np.full(n, np.inf), np.zeros(n, np.int64), np.ones(n, bool)
    at = 0
    for k in range(n):
        if k:
            at = int(np.argmin(np.where(todo, best, np.inf)))
            parent[k], edge[k] = link[at], best[at]
        order[k], todo[at] = at, False
        d = np.sqrt(((x - x[at]) ** 2).sum(1))
        closer = todo & (d < best)
        best[closer], link[closer] = d[closer], k
    return order, parent, edge


def numbered(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``df`` (part, seq, ...) written, with dense numbers from 0 in place of part and seq, and how many there are."""
    kept = materialize(df, name)
    counts = kept.groupBy("part").agg(F.count("*").alias("n"))  # one row a task
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = kept.join(F.broadcast(counts.select("part", before.alias("before"))), "part")
    return out.withColumn("number", F.col("before") + F.col("seq")).drop("part", "seq", "before"), kept.count()


def chunks(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    held, rows = [], 0
    for b in batches:
        while rows + b.num_rows >= most:
            yield pa.Table.from_batches([*held, b.slice(0, most - rows)])
            b, held, rows = b.slice(most - rows), [], 0
        if b.num_rows:
            held.append(b)
            rows += b.num_rows
    if held:
        yield pa.Table.from_batches(held)


BLOB = "part long, seq long, n int, ids binary, none binary, labels binary, vectors binary"


def blob(t: pa.Table, order: np.ndarray, m: np.ndarray) -> dict:
    ids = t.column("id")
    none = ids.is_null().to_numpy()
    return {
        "n": pa.array([len(order)], pa.int32()),
        "ids": [ids.fill_null(LARGEST).to_numpy()[order].tobytes()],
        "none": [none[order].tobytes()],
        "labels": [t.column("label").to_numpy()[order].tobytes()],
        "vectors": [packed(m[order])],
    }


def laid_in_blocks(rows: DataFrame, block: int) -> DataFrame:
    """Rows in blocks of at most ``block``, one row each, sorted by label."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for seq, t in enumerate(chunks(batches, block)):
            order = np.argsort(t.column("label").to_numpy(), kind="stable")
            yield pa.RecordBatch.from_pydict({"part": [part], "seq": [seq], **blob(t, order, matrix(t.column("vector")))})

    return rows.select("id", "label", "vector").mapInArrow(run, BLOB)


def trees(anchors: DataFrame, size: int) -> DataFrame:
    """Anchors in spanning trees of at most ``size``, one row each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for seq, t in enumerate(chunks(batches, size)):
            m = matrix(t.column("vector"))
            order, parent, edge = spanning_tree(m)
            own = {"parents": [parent.tobytes()], "edges": [edge.tobytes()]}
            yield pa.RecordBatch.from_pydict({"part": [part], "seq": [seq], **blob(t, order, m), **own})

    # like ones side by side: edges are short, and equal vectors have edges of no length
    near = anchors.repartitionByRange(partitions(anchors.sparkSession), "label", "vector", "id")
    near = near.sortWithinPartitions("label", "vector", "id")
    return near.select("id", "label", "vector").mapInArrow(run, f"{BLOB}, parents binary, edges binary")


class Block:
    """The rows of one blob."""

    def __init__(self, t: pa.Table, k: int):
        get = lambda c, kind: np.frombuffer(t.column(c)[k].as_py(), kind)
        self.n = t.column("n")[k].as_py()
        self.ids, self.none, self.labels = get("ids", np.int64), get("none", bool), get("labels", np.int64)
        self.vectors = unpacked(t.column("vectors")[k].as_py(), self.n)
        self.largest = float(np.abs(self.vectors.astype(np.float64)).max(initial=0))
        if "parents" in t.column_names:
            self.parents, self.edges = get("parents", np.int64), get("edges", np.float64)
        self.floats = self.vectors.astype(np.float64)
        self.norms = np.sqrt((self.floats**2).sum(1))

    def id(self, k: int) -> int | None:
        return None if self.none[k] else int(self.ids[k])


def walk(tree: Block, rows: Block, wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple]:
    """(node, which rows, their scores) of every node of a tree.

    ``wanted(node, low, high)`` tells by their bounds which rows must be scored.
    """
    d = min(tree.vectors.shape[1], rows.vectors.shape[1])
    if tree.largest * rows.largest * max(d, 1) >= EXACT:
        # beyond what floating-point numbers hold: all rows by whole numbers of any size, held to 64 bits
        x = rows.vectors[:, :d].astype(object)
        for k in range(tree.n):
            score = (x * tree.vectors[k, :d].astype(object)).sum(1) if d else np.zeros(rows.n, object)
            yield k, np.arange(rows.n), np.array([min(max(int(s), -LARGEST), LARGEST) for s in score], object)
        return
    x = rows.floats[:, :d]
    children = np.bincount(tree.parents[1:], minlength=tree.n) if tree.n > 1 else np.zeros(1, np.int64)
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for k in range(tree.n):
        p = int(tree.parents[k])
        if p < 0:
            which = np.arange(rows.n)
            score = x @ tree.floats[k, :d]
            low = high = score
        else:
            # scores are whole numbers: the half covers what rounding may take from a bound
            reach = tree.edges[k] * (1 + 1e-9) * rows.norms + 0.5
            low, high = bounds[p][0] - reach, bounds[p][1] + reach
            which = np.flatnonzero(wanted(k, low, high))
            score = x[which] @ tree.floats[k, :d]
            low[which] = high[which] = score
            children[p] -= 1
            if not children[p]:
                del bounds[p]
        if children[k]:
            bounds[k] = low, high
        yield k, which, score


def first(score: np.ndarray, rows: Block, which: np.ndarray) -> np.ndarray:
    """The order of rows: higher scores first, then smaller ids, none last."""
    if score.dtype == object:
        return np.array(sorted(range(len(which)), key=lambda j: (-score[j], bool(rows.none[which[j]]), rows.ids[which[j]])), np.int64)
    return np.lexsort((rows.ids[which], rows.none[which], -score))


def best_positives(tree: Block, rows: Block, count: int) -> Iterator[tuple]:
    """(node, id, score): up to ``count`` best rows of each anchor's label among ``rows``, those of its own id aside."""

    def own(k: int) -> np.ndarray:
        return (rows.labels == tree.labels[k]) & ((rows.ids != tree.ids[k]) | (rows.none != tree.none[k]))

    def wanted(k: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        could = own(k)
        least = low[could]
        if len(least) > count:
            could &= high >= np.partition(least, len(least) - count)[len(least) - count]
        return could

    for k, which, score in walk(tree, rows, wanted):
        mine = own(k)[which]
        which, score = which[mine], score[mine]
        for j in first(score, rows, which)[:count]:
            yield k, rows.id(which[j]), int(score[j])


def best_negatives(tree: Block, rows: Block, positives: dict[int, list], count: int, low_pct: int, high_pct: int) -> Iterator[tuple]:
    """(node, number of the positive, id, score): up to ``count`` best rows of other labels in each positive's window."""

    def wanted(k: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        could = np.zeros(rows.n, bool)
        for _, _, score in positives.get(k, ()):
            could |= (100 * high >= low_pct * score) & (100 * low <= high_pct * score)
        return could & (rows.labels != tree.labels[k])

    for k, which, score in walk(tree, rows, wanted):
        other = rows.labels[which] != tree.labels[k]
        which, score = which[other], score[other]
        order = first(score, rows, which)
        which, score = which[order], score[order]
        for number, _, s in positives.get(k, ()):
            # sums of whole numbers of any size: no overflow at the ends of the range
            inside = np.flatnonzero((100 * score <= high_pct * s) & (100 * score >= low_pct * s))[:count]
            for j in inside:
                yield k, number, rows.id(which[j]), int(score[j])


def met(blocks: DataFrame, n_blocks: int, asked: DataFrame, n_trees: int, batch: int, each: Callable, schema: str) -> DataFrame:
    """``each(tree row, tree, rows)`` of every tree and every block, in groups of one block and a batch of trees."""
    last = -(-n_trees // batch) - 1
    left = blocks.withColumnRenamed("number", "block").withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(last))))
    right = asked.withColumn("batch", F.floor(F.col("number") / batch).cast("int"))
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
    names = [f.split()[0] for f in schema.split(", ")]

    def run(one: pa.Table, many: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if one.num_rows:
            rows = Block(one, 0)
            for k in range(many.num_rows):
                out += each(many, k, Block(many, k), rows)
        columns = list(zip(*out)) or [[] for _ in names]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})

    return left.groupBy("block", "batch").cogroup(right.groupBy("block", "batch")).applyInArrow(run, schema)


def top(df: DataFrame, keys: list[str], score: str, key: str, count: int) -> DataFrame:
    """The first ``count`` rows of each group, numbered from 1 in ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc_nulls_last(key))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


def hard_negatives(
    df: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    window: tuple[int, int] = (80, 100),
    scale: int = 256,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    block: int = 8192,
    tree: int = 256,
    batch: int = 64,
) -> DataFrame:
    """For each anchor and positive the best rows of other labels that score nearly as high as the positive.

    Returns ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``,
    ``positive_score`` and ``negative_score``. Components become floor(``scale``
    * x); a score is the inner product with the anchor, over the components that
    both have; higher ones come first, ties by smaller id, null ids last.
    Positives are the first ``positives`` rows of the anchor's label, negatives
    the first ``negatives`` rows of other labels whose score lies from
    ``window[0]`` to ``window[1]`` per cent of the positive's.

    ``anchor`` is a condition on ``df``; null is taken as false. Rows with a
    null label or vector, or with any null or non-finite component, take no
    part. Rows of the anchor's own id are no positives of it; repeated rows
    count each, but repeated anchors once; anchors of one id and different
    vectors are anchors each. Components and scores beyond 64 bits are held at
    the ends of that range. Empty tables, or tables without anchors, give no
    rows.

    A group holds one block of ``block`` rows and ``batch`` trees of ``tree``
    anchors; what it finds for an anchor is at most as many rows as are asked
    for, and Spark keeps that many of them before the shuffle too. Both passes
    read the same written blocks and trees.
    """
    rows = usable(df, scale, anchor, id_col, label_col, vector_col)
    anchors = materialize(rows.filter("anchor").drop("anchor").dropDuplicates(["id", "label", "vector"]), "anchors")
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    grown, n_trees = numbered(trees(anchors, tree), "anchor-trees")
    blocks, n_blocks = numbered(laid_in_blocks(rows, block), "candidate-blocks")
    if not n_trees or not n_blocks:
        return df.sparkSession.createDataFrame([], out)

    def near(many: pa.Table, k: int, one: Block, all_rows: Block) -> Iterator[tuple]:
        number = many.column("number")[k].as_py()
        for node, key, score in best_positives(one, all_rows, positives):
            yield number, node, key, score

    found = met(blocks, n_blocks, grown, n_trees, batch, near, "number long, node long, positive_id long, positive_score long")
    found = materialize(top(found, ["number", "node"], "positive_score", "positive_id", positives), "positives")
    # at most ``tree`` * ``positives`` entries
    entry = F.struct("node", F.col("rank").cast("long").alias("rank"), "positive_id", "positive_score")
    lists = found.groupBy("number").agg(F.sort_array(F.collect_list(entry)).alias("positives"))
    asked = grown.join(lists, "number")

    def hard(many: pa.Table, k: int, one: Block, all_rows: Block) -> Iterator[tuple]:
        number = many.column("number")[k].as_py()
        own: dict[int, list] = {}
        for p in many.column("positives")[k].as_py():
            own.setdefault(p["node"], []).append((p["rank"], p["positive_id"], p["positive_score"]))
        for node, which, key, score in best_negatives(one, all_rows, own, negatives, *window):
            _, positive, s = own[node][which - 1]
            yield number, node, which, one.id(node), positive, s, key, score

    schema = "number long, node long, which long, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    mined = top(met(blocks, n_blocks, asked, n_trees, batch, hard, schema), ["number", "node", "which"], "negative_score", "negative_id", negatives)
    return mined.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
