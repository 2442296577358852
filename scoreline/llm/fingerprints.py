"""Improbable-feature digests: rare byte windows of a text in chained Bloom filters.

Every window of 24 bytes has an entropy, in one of 1001 bins; how rare its bin
is in the whole corpus is its rank, the rarest first. A window is a feature if
it is the rarest of sufficiently many neighbourhoods of windows; texts of less
than three windows' length have all their windows of 8 bytes as features. Features enter
a Bloom filter of 2048 bits by five positions each; after 160 features the next
filter of the chain begins. Two filters are compared by the bits they have in
common beyond chance, against the most they could have.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import map_texts, mix64, narrow, partitions

SIZE = 24  # bytes of a window
REACH = 24  # windows of a neighbourhood
POPULAR = 6  # neighbourhoods that a feature must win, in texts long enough
PER_FILTER = 160
BITS = 2048
PROBES = 5
BINS = 1001
LOW = 150  # windows of fewer thousandths of the greatest entropy say nothing
SHORT = 3 * SIZE  # shorter texts have all their windows of 8 bytes as features
TINY = 8
PAD = 0xFF  # in no UTF-8 text

# c log2 c in steps of c, as integers, so that sums don't depend on their order
_C = np.arange(SIZE + 1)
_SCALED = np.round((_C * np.log2(np.maximum(_C, 1))) * (1 << 20)).astype(np.int64)
STEPS = np.diff(_SCALED)
MOST = int(_SCALED[-1])


class Joined:
    """Many texts in one array, kept apart by padding: where each begins and how many windows it has."""

    def __init__(self, texts: list[bytes]):
        gap = max(SIZE, REACH)
        lengths = np.array([len(t) for t in texts], np.int64)
        self.start = np.cumsum(lengths + gap) - lengths
        self.data = np.frombuffer(bytes([PAD]) * gap + (bytes([PAD]) * gap).join(texts) + bytes([PAD]) * gap, np.uint8)
        self.windows = np.where(lengths < SHORT, 0, lengths - SIZE + 1)

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """The text and the position of every window."""
        text = np.repeat(np.arange(len(self.windows)), self.windows)
        first = np.cumsum(self.windows) - self.windows
        return text, np.arange(len(text)) - first[text] + self.start[text]

    def entropies(self, at: np.ndarray) -> np.ndarray:
        """The bin of each window; entering and leaving bytes change the sum of c log c by a step of their count."""
        x = self.data
        before, after = np.zeros(len(x), np.uint8), np.zeros(len(x), np.uint8)
        for d in range(1, SIZE):
            same = x[d:] == x[:-d]
            before[d:] += same
            after[:-d] += same
        real = x != PAD
        entered = np.concatenate(([0], np.cumsum(np.where(real, STEPS[before], 0))))
        left = np.concatenate(([0], np.cumsum(np.where(real, STEPS[after], 0))))
        # up to the end of the previous text as much has left as entered, so sums may run through
        total = entered[at + SIZE] - left[at]
        return (MOST - total) * (BINS - 1) // MOST


def features(texts: list[bytes], rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the features of each text, in the order of their places, each once a text."""
    j = Joined(texts)
    text, at = j.places()
    never = np.int64(1) << 62
    order = np.full(len(j.data) + 2 * REACH, never, np.int64)
    order[at] = (rank[j.entropies(at)].astype(np.int64) << 36) + at
    # the rarest, leftmost of REACH windows from each place on
    low, width = order, 1
    while 2 * width <= REACH:
        low = np.minimum(low[: len(low) - width], low[width:])
        width *= 2
    if width < REACH:
        low = np.minimum(low[: len(low) - (REACH - width)], low[REACH - width :])
    won = low[at]
    won = won[won < never] & ((1 << 36) - 1)
    votes = np.bincount(won, minlength=len(j.data))
    least = np.clip(j.windows // 8, 1, POPULAR)
    chosen = votes[at] >= least[text]
    eligible = (order[at] >> 36) < BINS
    text, at = text[chosen & eligible], at[chosen & eligible]
    h = np.zeros(len(at), np.uint64)
    for k in range(SIZE):
        h = h * np.uint64(0x9E3779B97F4A7C15) + j.data[at + k]
    short = [(i, t[k : k + TINY]) for i, t in enumerate(texts) if len(t) < SHORT for k in range(max(1, len(t) - TINY + 1)) if t]
    if short:
        text = np.concatenate((text, [i for i, _ in short]))
        own = [int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "little") for _, t in short]
        h = np.concatenate((h, np.array(own, np.uint64)))
    h = mix64(h)
    by = np.lexsort((np.arange(len(h)), h, text))
    new = np.ones(len(h), bool)
    new[1:] = (text[by][1:] != text[by][:-1]) | (h[by][1:] != h[by][:-1])
    keep = np.sort(by[new])
    keep = keep[np.argsort(text[keep], kind="stable")]
    return text[keep], h[keep]


class Digest:
    """The chained filters of one text: features in each filter, and their bits."""

    def __init__(self, counts: np.ndarray, filters: np.ndarray):
        self.counts, self.filters = counts, filters
        self.ones = filters.sum(1).astype(np.int64)

    def __str__(self) -> str:
        packed = np.packbits(self.filters, axis=1)
        return ",".join(f"{n}:{base64.b64encode(f.tobytes()).decode()}" for n, f in zip(self.counts, packed))


def digests(texts: list[bytes], rank: np.ndarray) -> list[Digest]:
    text, h = features(texts, rank)
    n = np.bincount(text, minlength=len(texts))
    first = np.cumsum(n) - n
    chain = (np.arange(len(text)) - first[text]) // PER_FILTER
    links = -(-n // PER_FILTER)
    base = np.cumsum(links) - links
    filters = np.zeros((int(links.sum()), BITS), np.uint8)
    row = base[text] + chain
    for k in range(PROBES):
        filters[row, ((h >> np.uint64(11 * k)) & np.uint64(BITS - 1)).astype(np.int64)] = 1
    counts = np.bincount(row, minlength=len(filters))
    return [Digest(counts[b : b + k], filters[b : b + k]) for b, k in zip(base, links)]


def likeness(a: Digest, b: Digest) -> float:
    """0 to 1: for each filter of the shorter chain the best match in the other, weighed by its features.

    A match is the number of common bits beyond those that chance gives,
    against the most that the emptier filter allows. Chains of one length are
    compared both ways. Two empty digests are alike, an empty one and another
    aren't.
    """
    if not len(a.counts) or not len(b.counts):
        return float(len(a.counts) == len(b.counts))
    common = a.filters.astype(np.float32) @ b.filters.T.astype(np.float32)
    chance = np.outer(a.ones, b.ones) / BITS
    room = np.minimum.outer(a.ones, b.ones) - chance
    match = np.clip((common - chance) / np.maximum(room, 1e-9), 0.0, 1.0)
    one = float(match.max(1) @ a.counts / a.counts.sum())
    other = float(match.max(0) @ b.counts / b.counts.sum())
    if len(a.counts) == len(b.counts):
        return (one + other) / 2
    return one if len(a.counts) < len(b.counts) else other


def rarity(texts: DataFrame) -> np.ndarray:
    """The rank of each bin of entropy over the windows of all texts: the rarer, the lower."""

    def each(ids: list, bodies: list) -> dict:
        j = Joined([(t or "").encode("utf-8", "surrogatepass") for t in bodies])
        n = np.bincount(j.entropies(j.places()[1]), minlength=BINS)
        found = np.flatnonzero(n)
        return {"bin": pa.array(found, pa.int64()), "n": pa.array(n[found], pa.int64())}

    counts = np.zeros(BINS, np.int64)
    for r in map_texts(texts, "bin long, n long", each).groupBy("bin").agg(F.sum("n").alias("n")).collect():  # 1001 rows
        counts[r["bin"]] = r["n"]
    rank = np.empty(BINS, np.int64)
    rank[np.lexsort((-np.arange(BINS), counts))] = np.arange(BINS)
    rank[:LOW] = BINS  # never chosen
    return rank


def edited(text: str, following: str) -> str:
    """The last third of a text replaced by as many first characters of the following text, or all it has."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def place(i: int | None, h: int) -> tuple:
    """Where a row stands: descending ids, null last, then by the hash of its text."""
    return (i is None, -i if i is not None else 0, h)


def first_places(texts: DataFrame) -> list[tuple]:
    """The place of the first row of each bucket, in order: one for each range partition of (id, hash).

    Only the two numbers are shuffled. Equal ids with different texts may lie in several buckets.
    """
    n = partitions(texts.sparkSession)
    keys = texts.select("id", F.xxhash64("text").alias("h"))
    ranged = keys.repartitionByRange(n, F.col("id").desc_nulls_last(), "h").withColumn("part", F.spark_partition_id())
    first = F.min(F.struct(F.col("id").isNull().alias("none"), (-F.coalesce("id", F.lit(0))).alias("down"), "h"))
    tops = ranged.groupBy("part").agg(first.alias("first")).select("first.*")  # a row for each partition
    return sorted({(r["none"], r["down"], r["h"]) for r in tops.collect()})


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_chars: int = 2_000_000) -> DataFrame:
    """The digest of every whole text and of an edited version of it, and their likeness.

    Documents are taken in descending ``id_col`` (ties by a hash of the text,
    null ids last), and after the last comes the first. The edited text of a
    document ends in the beginning of the next one (`edited`). Returns
    ``id_col``, n_chars (code points), edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next. Null texts are empty; an
    empty text has an empty fingerprint. Equal texts have equal fingerprints.
    Repeated rows follow each other; a table of one row follows itself; an
    empty table gives no rows.

    A text is shuffled once, into its bucket, a range of (id, hash), so the next
    document stands beside it; a bucket's first row is also sent, as a guest, to
    the bucket before. Rows that repeat id and text follow themselves wherever
    they are: all but one of a task are worked out there. So neither an id nor a
    row that a third of the table has makes a bucket large. The driver holds a
    place for each partition and the corpus statistics, 1001 counts.
    """
    texts = narrow(df, id_col, text_col)
    spark = texts.sparkSession
    rank = spark.sparkContext.broadcast(rarity(texts))
    tops = spark.sparkContext.broadcast(first_places(texts))
    n = partitions(spark)
    result = (
        "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
    names = ["id", *(f.split()[0] for f in result.split(", "))]
    types = to_arrow_schema(spark.createDataFrame([], f"id long, {result}").schema)
    dealt_types = to_arrow_schema(spark.createDataFrame([], f"bucket int, guest boolean, h long, text string, id long, {result}").schema)

    def worked(ids: list, texts: list[str], following: list[int]) -> dict[str, list]:
        """The results of the first texts, one for each id, given the numbers of those that follow them."""
        changed = [edited(t, texts[k]) for t, k in zip(texts, following)]
        raw = [t.encode("utf-8", "surrogatepass") for t in [*texts, *changed]]
        found = digests(raw, rank.value)
        own, other = found[: len(texts)], found[len(texts) :]
        columns = (
            ids,
            [len(t) for t in texts[: len(ids)]],
            [hashlib.sha256(t).hexdigest() for t in raw[len(texts) :]],
            [str(d) for d in own[: len(ids)]],
            [str(d) for d in other],
            [likeness(a, b) for a, b in zip(own, other)],
            [likeness(a, own[k]) for a, k in zip(own, following)],
        )
        return dict(zip(names, columns))

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts to their buckets and, as guests, to the one before; the results of rows that a task has seen before."""
        seen: set[int] = set()  # id and hash in one number
        first = set(tops.value)
        own = TaskContext.get().partitionId()
        for ids, hashes, bodies in hashed(batches):
            out: dict[str, list] = {c: [] for c in ("bucket", "guest", "h", "text", "id")}
            repeats: list[tuple] = []
            for i, h, t in zip(ids, hashes, bodies):
                code = h if i is None else (i << 66) + h
                if code in seen:
                    repeats.append((i, code, t or ""))
                    continue
                seen.add(code)
                key = place(i, h)
                b = bisect_right(tops.value, key) - 1
                hosts = [(b, False)] + ([((b - 1) % len(tops.value), True)] if key in first else [])
                for bucket, guest in hosts:
                    for column, value in zip(out.values(), (bucket, guest, h, t or "", i)):
                        column.append(value)
            empty = [None] * len(out["id"])
            yield pa.RecordBatch.from_pydict({**out, **{c: empty for c in names[1:]}}, schema=dealt_types)
            if repeats:
                # each different one is worked out once
                once = {code: (i, t) for i, code, t in repeats}
                done = worked([i for i, _ in once.values()], [t for _, t in once.values()], list(range(len(once))))
                at = {code: k for k, code in enumerate(once)}
                rows = {c: [v[at[code]] for _, code, _ in repeats] for c, v in done.items()}
                m = len(repeats)
                spread = [(own + k) % len(tops.value) for k in range(m)]
                none = {"bucket": spread, "guest": [False] * m, "h": [None] * m, "text": [None] * m}
                yield pa.RecordBatch.from_pydict({**none, **rows}, schema=dealt_types)

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list, list]]:
        for b in batches:
            ids, hashes, bodies = (b.column(c).to_pylist() for c in ("id", "h", "text"))
            start = size = 0
            for k, t in enumerate(bodies):
                size += len(t) if t else 0
                if size >= max_chars:
                    yield ids[start : k + 1], hashes[start : k + 1], bodies[start : k + 1]
                    start, size = k + 1, 0
            if start < len(ids):
                yield ids[start:], hashes[start:], bodies[start:]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, bucket = 0, None

        def results(following: str) -> pa.RecordBatch:
            after = list(range(1, len(rows) + 1))
            return pa.RecordBatch.from_pydict(worked([i for i, _ in rows], [*(t for _, t in rows), following], after), schema=types)

        for b in batches:
            done = np.flatnonzero(~b.column("text").is_valid().to_numpy(zero_copy_only=False))
            if len(done):
                yield b.take(pa.array(done)).select(names)
            for at, guest, i, t in zip(*(b.column(c).to_pylist() for c in ("bucket", "guest", "id", "text"))):
                if t is None or (guest and bucket != at):
                    continue  # a result, or a guest that more than one task has sent
                bucket = at
                if rows and (guest or size >= max_chars):
                    yield results(t)
                    rows, size = [], 0
                if guest:
                    bucket = None
                else:
                    rows.append((i, t))
                    size += len(t)

    rows = texts.select("id", F.xxhash64("text").alias("h"), "text")
    sent = rows.mapInArrow(deal, f"bucket int, guest boolean, h long, text string, id long, {result}")
    sorted_rows = sent.repartitionById(n, F.col("bucket")).sortWithinPartitions(
        "bucket", "guest", F.col("id").desc_nulls_last(), "h"
    )
    return sorted_rows.mapInArrow(run, f"id long, {result}").withColumnRenamed("id", id_col)
