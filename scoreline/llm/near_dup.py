"""Near duplicates by b-bit MinHash over word shingles, with exact confirmation.

Texts of equal shingle sets form a class. A class has the minima of 128
permutations of its shingle hashes; the hashes of bands of them are its
buckets, and the low bits of all minima, packed into 32 bytes, its sketch. In a
bucket the sketches are compared by bit counts, corrected for chance
collisions; a bucket proposes a spanning forest of its most similar pairs, not
all pairs. Proposals are confirmed on full sets. Where a proposal fails, all
pairs across what is still apart are compared in blocks, by sketch and then on
full sets, so a link that the forest left out isn't lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, broadcast_if_small, components, map_texts, materialize, mix64, narrow, shingle_set

PERMUTATIONS = 128
LOW_BITS = 2
BAND_ROWS = 4  # 32 bands: a pair of similarity 0.8 shares none with probability 5e-8, of 0.85 with 6e-11
WORDS = PERMUTATIONS * LOW_BITS // 64
#: Standard errors below the threshold at which a sketch still proposes a pair.
MARGIN = 4.0

_RNG = np.random.default_rng(20240229)
FACTORS = _RNG.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _RNG.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)


def minima(shingles: np.ndarray, block: int = 512) -> np.ndarray:
    """The least value of each permutation over the shingles."""
    out = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), block):
        values = FACTORS[:, None] * shingles[None, i : i + block]
        values += OFFSETS[:, None]
        np.minimum(out, values.min(1), out=out)
    return out


def sketch(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima, packed into 64-bit words."""
    bits = (least >> np.uint64(16)) & np.uint64((1 << LOW_BITS) - 1)
    lanes = bits.reshape(WORDS, -1) << (np.arange(64 // LOW_BITS, dtype=np.uint64) * np.uint64(LOW_BITS))
    return np.bitwise_or.reduce(lanes, 1)


def bands(least: np.ndarray) -> np.ndarray:
    rows = least.reshape(-1, BAND_ROWS)
    h = np.arange(1, len(rows) + 1, dtype=np.uint64)
    for j in range(BAND_ROWS):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
    return h


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of sketches by bit counts; lanes that agree by chance are taken out."""
    apart = a ^ b
    apart = (apart | (apart >> np.uint64(1))) & np.uint64(0x5555555555555555)
    agree = 1 - np.bitwise_count(apart).sum(-1, dtype=np.int32) / PERMUTATIONS
    chance = 2.0**-LOW_BITS
    return (agree - chance) / (1 - chance)


def cutoff(threshold: float) -> float:
    chance = 2.0**-LOW_BITS
    p = chance + (1 - chance) * threshold
    return threshold - MARGIN * (p * (1 - p) / PERMUTATIONS) ** 0.5 / (1 - chance)


def forest(similar: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Pairs of a spanning forest of largest similarity over the pairs of at least ``least``."""
    m = len(similar)
    best, parent = np.full(m, -2.0), np.full(m, -1)
    todo, out = np.ones(m, bool), []
    for _ in range(m):
        i = int(np.argmax(np.where(todo, best, -3.0)))
        if best[i] >= least:
            out.append((int(parent[i]), i))
        todo[i] = False
        better = todo & (similar[i] > best)
        best[better] = similar[i][better]
        parent[better] = i
    return out


def groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows that agree in ``keys``, across batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(b.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change), b.num_rows]
        if held and any(held[-1].column(k)[-1].as_py() != b.column(k)[0].as_py() for k in keys):
            yield pa.Table.from_batches(held)
            held = []
        for s, e in zip(starts, starts[1:]):
            held.append(b.slice(s, e - s))
            if e < b.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def sketches_of(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint64).reshape(-1, WORDS)


def sets_of(t: pa.Table) -> list[np.ndarray]:
    """The shingle sets of the rows, as views of the table's numbers."""
    column = t.column("shingles").combine_chunks()
    at, values = column.offsets.to_numpy(), column.values.to_numpy()
    return [values[s:e] for s, e in zip(at, at[1:])]


def blocked(df: DataFrame, key: str, size: str, node: str, block: int) -> DataFrame:
    """A row for each pair of blocks that a row's block belongs to: columns i <= j and mine.

    A group of at most ``block`` rows is one block; a larger one is cut by the
    hash of ``node``, so no task gets more than two blocks of it at once.
    """
    n = F.ceil(F.col(size) / F.lit(block)).cast("int")
    own = df.withColumn("mine", F.pmod(F.xxhash64(node), n).cast("int"))
    pairs = own.withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
    return pairs.withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other")).drop("other")


def propose(members: DataFrame, least: float) -> DataFrame:
    """(a, b): the spanning forest of each pair of blocks of a bucket."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[int] = []
        b: list[int] = []
        for t in groups(batches, ["bucket", "i", "j"]):
            if t.num_rows < 2:
                continue
            s, nodes = sketches_of(t), t.column("cid").to_numpy()
            if t.num_rows == 2:
                pairs = [(0, 1)] if estimate(s[0], s[1]) >= least else []
            else:
                similar = np.empty((len(s), len(s)), np.float32)
                for k, x in enumerate(s):
                    similar[k] = estimate(x, s)
                mine, i, j = t.column("mine").to_numpy(), t.column("i")[0].as_py(), t.column("j")[0].as_py()
                if i != j:
                    similar[mine[:, None] == mine[None, :]] = -2.0
                pairs = forest(similar, least)
            a += [int(min(nodes[x], nodes[y])) for x, y in pairs]
            b += [int(max(nodes[x], nodes[y])) for x, y in pairs]
            if len(a) > 50_000:
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
                a, b = [], []
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    dealt = members.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "cid")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets share at least ``percent`` of their union."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    common = int(np.isin(a, b, assume_unique=True).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def complete(members: DataFrame, least: float, percent: int) -> DataFrame:
    """(a, b) components with a confirmed link, from all pairs across components of a family, block by block."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, ["fam", "i", "j"]):
            s, comp, mine = sketches_of(t), t.column("comp").to_numpy(), t.column("mine").to_numpy()
            sets = sets_of(t)
            sizes = np.array([len(x) for x in sets])
            cross = t.column("i")[0].as_py() != t.column("j")[0].as_py()
            root = {int(c): int(c) for c in comp}

            def find(c: int) -> int:
                while root[c] != c:
                    root[c] = root[root[c]]
                    c = root[c]
                return c

            out = set()
            for x in range(len(sets)):
                could = (estimate(s[x], s[x + 1 :]) >= least) & (comp[x + 1 :] != comp[x])
                if cross:
                    could &= mine[x + 1 :] != mine[x]
                n = sizes[x + 1 :]
                could &= 100 * np.minimum(n, sizes[x]) >= percent * np.maximum(n, sizes[x])
                for y in np.flatnonzero(could) + x + 1:
                    p, q = find(int(comp[x])), find(int(comp[y]))
                    if p != q and linked(sets[x], sets[y], percent):
                        root[max(p, q)] = min(p, q)
                        out.add((p, q))
            if out:
                a, b = zip(*out)
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    dealt = members.repartition("fam", "i", "j").sortWithinPartitions("fam", "i", "j", "cid")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def shingle_classes(texts: DataFrame, size: int) -> DataFrame:
    """(id, th, n_shingles, cid, sketch, buckets) of every row; nulls for a text without words.

    ``th`` is the hash of the text as Spark's xxhash64 gives it.
    """

    def each(ids: list, bodies: list) -> dict:
        out: dict[str, list] = {"th": [], "n_shingles": [], "cid": [], "sketch": [], "buckets": []}
        for t in bodies:
            s = shingle_set(t, hashes, size)
            least = minima(s) if len(s) else None
            out["th"].append(42 if t is None else signed(xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"), seed=42)))
            out["n_shingles"].append(len(s))
            out["cid"].append(class_id(s) if len(s) else None)
            out["sketch"].append(sketch(least).tobytes() if len(s) else None)
            out["buckets"].append(bands(least).view(np.int64) if len(s) else None)
        return {
            "id": pa.array(ids, pa.int64()),
            "th": pa.array(out["th"], pa.int64()),
            "n_shingles": out["n_shingles"],
            "cid": pa.array(out["cid"], pa.int64()),
            "sketch": pa.array(out["sketch"], pa.binary()),
            "buckets": pa.array(out["buckets"], pa.list_(pa.int64())),
        }

    hashes = WordHashes()
    return map_texts(texts, "id long, th long, n_shingles long, cid long, sketch binary, buckets array<long>", each)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def class_id(shingles: np.ndarray) -> int:
    return signed(xxhash.xxh3_64_intdigest(shingles.tobytes()))


def shingle_rows(texts: DataFrame, size: int) -> DataFrame:
    """(cid, shingles) of every text with words."""

    def each(ids: list, bodies: list) -> dict:
        sets = [s for s in (shingle_set(t, hashes, size) for t in bodies) if len(s)]
        return {
            "cid": pa.array([class_id(s) for s in sets], pa.int64()),
            "shingles": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
        }

    hashes = WordHashes()
    return map_texts(texts, "cid long, shingles array<long>", each)


def grouped(texts: DataFrame, percent: int, size: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Rows (id, th, n_shingles, cid), and classes (cid, component, keeper).

    ``component`` is the smallest id of the component, ``keeper`` the class that
    has it (of several the smallest).
    """
    rows = materialize(shingle_classes(texts, size), "shingle-classes")
    classes = materialize(
        rows.filter("n_shingles > 0")
        .groupBy("cid")
        .agg(
            # null ids last; the text's hash tells which row it is, as the id may be null or have several texts
            F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("least"),
            F.first("sketch").alias("sketch"),
            F.first("buckets").alias("buckets"),
        )
        .select("cid", F.col("least.id").alias("rep"), F.col("least.th").alias("th"), "sketch", "buckets"),
        "classes",
    )
    component = classes_linked(texts, classes, percent, size, block)
    named = classes.select("cid", "rep").join(component, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    # the smallest id of each component; a null one only if there is no other
    order = F.struct(F.col("rep").isNull().alias("none"), "rep", "cid")
    least = named.groupBy("root").agg(F.min(order).alias("least"))
    names = named.join(least, "root").select("cid", F.col("least.rep").alias("component"), F.col("least.cid").alias("keeper"))
    return rows.select("id", "th", "n_shingles", "cid"), materialize(names, "class-components")


def near_duplicates(
    df: DataFrame, percent: int = 80, size: int = 5, id_col: str = "doc_id", text_col: str = "text", block: int = 1024
) -> DataFrame:
    """Groups of texts linked by a Jaccard similarity of at least ``percent`` / 100 of their shingle sets.

    Returns a row for each row: ``id_col``, n_shingles, component_id (the
    smallest id that links reach, itself included) and kept (whether its id is
    that one). A-Z are lower-cased, words end at spaces and U+0009-U+000D, a
    text of fewer than ``size`` words is one shingle. Texts without words (null,
    empty, blank) have 0 shingles and are linked with nothing. Rows that repeat
    an id stand in its component; a null id joins a group but names none unless
    all its ids are null. An empty table gives no rows.

    Copies meet only in partial aggregates (the class of a set); buckets of any
    size are worked in blocks of ``block`` classes; links are proposed as
    forests. What the driver sees are counts. Sets are 64-bit hashes: two
    different shingles or sets are taken for one with probability 2^-64 a pair.
    """
    rows, names = grouped(narrow(df, id_col, text_col), percent, size, block)
    out = rows.join(names, "cid", "left").withColumn("c", F.when(F.col("cid").isNull(), F.col("id")).otherwise(F.col("component")))
    return out.select(
        F.col("id").alias(id_col), "n_shingles", F.col("c").alias("component_id"), F.col("id").eqNullSafe(F.col("c")).alias("kept")
    )


def drop_near_duplicates(
    df: DataFrame, percent: int = 80, size: int = 5, id_col: str = "doc_id", text_col: str = "text", block: int = 1024
) -> DataFrame:
    """The rows of ``df``, with all their columns, but for one document of each group of near duplicates.

    The one of the smallest id stays (see `near_duplicates`); of several texts
    with that id, or several rows of one text, one stays. Texts without words
    all stay.
    """
    texts = narrow(df, id_col, text_col)
    rows, names = grouped(texts, percent, size, block)
    best = rows.join(names, "cid").filter("cid = keeper AND id <=> component")
    # texts of one set under one id are one document: the smallest hash of them stays
    best = best.groupBy("cid", "id", "th").agg(F.count("*").alias("n"))
    best = best.groupBy("cid").agg(F.min(F.struct("th", "id", "n")).alias("best")).select("best.*")
    blank = rows.filter("cid IS NULL").select("th", "id", F.lit(1).cast("long").alias("n")).distinct()
    keep = materialize(best.unionByName(blank), "kept")
    key = F.col(f"`{id_col}`").cast("long")
    all_rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), key.alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("th")
    )

    def those(k: DataFrame) -> DataFrame:
        k = k.select(F.col("id").alias("kid"), F.col("th").alias("kth"))
        return all_rows.join(k, F.col("id").eqNullSafe(F.col("kid")) & (F.col("th") == F.col("kth")), "left_semi")

    out = those(keep.filter("n = 1"))
    if not keep.filter("n > 1").isEmpty():
        out = out.unionByName(those(keep.filter("n > 1")).dropDuplicates(["id", "th"]))
    return out.select("row.*")


def classes_linked(texts: DataFrame, classes: DataFrame, percent: int, size: int, block: int) -> DataFrame:
    """(cid, root) of the classes that have a link."""
    least = cutoff(percent / 100)
    buckets = classes.select("cid", F.explode("buckets").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = buckets.join(shared, "bucket").join(classes.select("cid", "sketch"), "cid")
    edges = materialize(propose(blocked(members, "bucket", "n", "cid", block), least), "proposals")

    # full sets of the classes that have a proposal
    ends = edges.selectExpr("a AS cid").unionByName(edges.selectExpr("b AS cid")).distinct()
    wanted = materialize(classes.join(ends, "cid").select("cid", F.col("rep").alias("wid"), F.col("th").alias("wth")), "proposed")
    handle = broadcast_if_small(wanted.select("wid", "wth"), 2_000_000)
    own = F.col("id").eqNullSafe(F.col("wid")) & (F.xxhash64("text") == F.col("wth"))
    some = texts.join(handle, own, "left_semi")
    sets = materialize(
        shingle_rows(some, size).dropDuplicates(["cid"]).join(wanted.select("cid"), "cid", "left_semi"), "full-sets"
    )
    left = edges.join(sets.select(F.col("cid").alias("b"), F.col("shingles").alias("sb")), "b")
    both = left.join(sets.select(F.col("cid").alias("a"), F.col("shingles").alias("sa")), "a")
    common = F.size(F.array_intersect("sa", "sb"))
    tested = materialize(
        both.withColumn("common", common).select(
            "a", "b", (100 * F.col("common") >= percent * (F.size("sa") + F.size("sb") - F.col("common"))).alias("linked")
        ),
        "tested",
    )
    first = materialize(components(tested.filter("linked"), "links"), "components")

    # families: what failed proposals hold together beside the confirmed links
    label = first.select(F.col("node").alias("cid"), F.col("root").alias("comp"))
    failed = tested.filter("NOT linked")
    failed = failed.join(label.withColumnRenamed("cid", "a").withColumnRenamed("comp", "ca"), "a", "left")
    failed = failed.join(label.withColumnRenamed("cid", "b").withColumnRenamed("comp", "cb"), "b", "left")
    apart = materialize(
        failed.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).filter("a <> b").distinct(), "apart"
    )
    family = components(apart, "families").select(F.col("node").alias("comp"), F.col("root").alias("fam"))
    inside = wanted.select("cid").join(label, "cid", "left").withColumn("comp", F.coalesce("comp", "cid")).join(family, "comp")
    inside = materialize(inside, "family-members")
    sized = inside.join(inside.groupBy("fam").agg(F.count("*").alias("n")), "fam")
    full = sized.join(classes.select("cid", "sketch"), "cid").join(sets, "cid")
    more = complete(blocked(full, "fam", "n", "cid", block // 2), least, percent)
    second = components(more, "late-links").select(F.col("node").alias("comp"), F.col("root").alias("late"))
    # a component that late links reach, or that was a single class
    everyone = wanted.select("cid").join(label, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    return everyone.join(second, "comp", "left").select("cid", F.coalesce("late", "comp").alias("root"))
