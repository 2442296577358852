"""Removal of repeated lines, exact or within one edit, by deletion neighbourhoods.

Two lines are within one edit if one is the other with a character replaced,
inserted or deleted. Lines emit the hashed variants that leave one character
out; lines that emit an equal variant meet. Variants carry the place of the
character for replacements (all lines of one such variant are within one edit
of each other) and none for insertions (lines that emit it meet the one line
that it equals), so a group's earliest line serves all its members and no pairs
are formed inside a group.

Only few lines need their variants: cut into four segments, a line within one
edit of another equals it outside of one segment. Lines that share the rest of
a segment with no other line have no partner; the others emit variants for the
places in that segment alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialize, mix64, narrow

SEGMENTS = 4
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def lines_of(texts: DataFrame) -> DataFrame:
    """(id, th, n, line): every line of every text; rows of one id and text are one document here."""
    return texts.select("id", F.xxhash64("text").alias("th"), F.posexplode(F.split("text", "\n", -1)).alias("n", "line"))


def rests(line: Column) -> Column:
    """The hashed rests of a line without each segment, as the shorter (or replaced) and as the longer of two."""
    n = F.length(line)
    out = []
    for extra in (0, 1):  # the segments are those of the shorter line
        short = n - extra
        for j in range(SEGMENTS):
            start, end = F.floor(short * j / SEGMENTS).cast("int"), F.floor(short * (j + 1) / SEGMENTS).cast("int") + extra
            rest = F.xxhash64(
                F.lit(j), short, F.substring(line, F.lit(1), start), F.substring(line, end + 1, F.greatest(n - end, F.lit(0)))
            )
            out.append(F.struct(rest.alias("rest"), F.lit(j).alias("j"), F.lit(extra).alias("extra")))
    return F.array(*out)


def variants(line: str, places: list[tuple[int, int]]) -> tuple[list[str], list[int]]:
    """Kinds and hashes of what a line emits for its shared segments (j, extra).

    A polynomial hash of the whole line gives the hash without any one
    character in constant time.
    """
    c = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(c)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(n, BASE, np.uint64))
        term = mix64(c + np.uint64(1)) * power
        prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(term, dtype=np.uint64)))
        gone = prefix[:-1] + (prefix[-1] - prefix[1:]) * INVERSE  # the hash of the line without each character
        kinds: list[str] = []
        hashes: list[int] = []
        cut = lambda short, j: (short * j // SEGMENTS, short * (j + 1) // SEGMENTS)
        if any(not extra for _, extra in places):
            kinds.append("self")
            hashes += mix64(prefix[-1:] ^ np.uint64(n)).view(np.int64).tolist()
        for j, extra in places:
            s, e = cut(n - extra, j)
            p = np.arange(s, e + extra)
            if extra:  # a partner is this line without the character
                kinds += ["less"] * len(p)
                hashes += mix64(gone[p] ^ np.uint64(n - 1)).view(np.int64).tolist()
            else:  # a partner has another character in its place
                kinds += ["swap"] * len(p)
                hashes += mix64(mix64(gone[p] + np.uint64(n)) + p.astype(np.uint64) + np.uint64(1)).view(np.int64).tolist()
    return kinds, hashes


def neighbourhoods(lines: DataFrame) -> DataFrame:
    """(h, first, kind, variant) from (h, first, line, places)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, (line, places) in enumerate(zip(b.column("line").to_pylist(), b.column("places").to_pylist())):
                kinds, hashes = variants(line, [(p["j"], p["extra"]) for p in places])
                own = pa.RecordBatch.from_arrays([b.column("h").slice(k, 1), b.column("first").slice(k, 1)], names=["h", "first"])
                own = own.take(pa.array(np.zeros(len(kinds), np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(kinds), pa.array(hashes, pa.int64())], names=["h", "first", "kind", "variant"]
                )

    first = lines.schema["first"].dataType.simpleString()
    return lines.mapInArrow(run, f"h long, first {first}, kind string, variant long")


def near_lines(lines: DataFrame, firsts: DataFrame, min_chars: int) -> DataFrame:
    """(h): lines whose first place comes after one of another line within one edit."""
    long = lines.filter(F.length("line") >= min_chars).withColumn("h", F.xxhash64("line"))
    emitted = long.select("h", F.explode(rests(F.col("line"))).alias("r")).select("h", "r.*")
    shared = emitted.groupBy("rest").agg(F.min("h").alias("x"), F.max("h").alias("y")).filter("x <> y").select("rest")
    shared = materialize(shared, "shared-rests")
    # again over all lines: those with a shared rest, each distinct line once
    some = long.select("h", "line", F.explode(rests(F.col("line"))).alias("r")).select("h", "line", "r.*")
    some = some.join(broadcast_if_small(shared, 4_000_000), "rest", "left_semi")
    some = some.groupBy("h").agg(F.min("line").alias("line"), F.collect_set(F.struct("j", "extra")).alias("places"))
    some = materialize(some.join(firsts.select("h", "first"), "h"), "lines-with-shared-rests")
    met = materialize(neighbourhoods(some), "variants")
    # the earliest of each kind serves all members of a variant
    who = F.struct("first", "h")
    best = met.groupBy("variant").agg(*(F.min(F.when(F.col("kind") == k, who)).alias(k) for k in ("swap", "self", "less")))
    partner = F.when(F.col("kind") == "swap", F.col("swap")).when(F.col("kind") == "less", F.col("self")).otherwise(F.col("less"))
    pairs = met.join(best, "variant").withColumn("p", partner).filter(F.col("p.first") < F.col("first"))
    pairs = pairs.select("h", F.col("p.h").alias("ph")).distinct()
    text = some.select("h", "line")
    both = pairs.join(text, "h").join(text.select(F.col("h").alias("ph"), F.col("line").alias("other")), "ph")
    return both.filter(F.levenshtein("line", "other", 1) >= 0).select("h").distinct()


def lines_to_drop(texts: DataFrame, min_chars: int) -> DataFrame:
    """(gid, gth, gone, exact): the numbers of a document's lines that go, and how many repeat a line exactly."""
    lines = lines_of(texts).filter(F.trim("line") != "")
    hashed = lines.select("id", "th", "n", F.xxhash64("line").alias("h"))
    firsts = materialize(hashed.groupBy("h").agg(F.min(F.struct("id", "th", "n")).alias("first")), "first-lines")
    near = near_lines(lines, firsts, min_chars).withColumn("near", F.lit(True))
    # stored, so that both sides of the next join are plain shuffles and a very common line can be split
    marked = materialize(firsts.join(near, "h", "left"), "marked-lines")
    decided = hashed.join(marked, "h")
    is_first = F.struct("id", "th", "n").eqNullSafe(F.col("first"))
    return (
        decided.filter(~is_first | F.col("near"))
        .groupBy(F.col("id").alias("gid"), F.col("th").alias("gth"))
        .agg(F.collect_set("n").alias("gone"), F.count_distinct(F.when(~is_first, F.col("n"))).alias("exact"))
    )


def remaining(text: Column, gone: Column) -> Column:
    """A text without the lines whose numbers are in ``gone`` (null: none)."""
    parts = F.split(text, "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), gone)
    # the lines are bound to a variable, so that the text isn't split again for each number
    both = F.array(F.struct(parts.alias("parts"), stay.alias("stay")))
    lines = F.transform(both, lambda b: F.transform(b["stay"], lambda i: F.get(b["parts"], i)))
    return F.when(gone.isNull(), text).otherwise(F.array_join(F.get(lines, F.lit(0)), "\n"))


def dedup_lines(df: DataFrame, min_chars: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Drop each line that repeats an earlier one, exactly or within one edit.

    Lines end at line feeds and are compared as they are. Places are ordered by
    id (nulls first), hash of the text and line number. A line goes if an equal
    line, or one within one edit (Levenshtein distance of 1), stands at an
    earlier place, whether that one stays or not; so the earliest always stays.
    Blank lines stay. Lines of less than ``min_chars`` code points are only
    compared exactly.

    Returns every row with all its columns, ``text_col`` without the lines that
    go, and a last column ``line_counts``: a struct of the text's number of
    lines, and of those dropped as exact and as near repeats. Null texts stay
    null, with 0 lines; an empty text has one blank line. Rows that repeat both
    id and text are one document: each keeps and loses the same lines. An empty
    table gives no rows. Lines of colliding 64-bit hashes are taken for equal.
    """
    gone = lines_to_drop(narrow(df, id_col, text_col), min_chars)
    key, text = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")
    # the rows travel as one struct, so no name of theirs can clash
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), key.alias("id"), F.xxhash64(text).alias("th"))
    found = rows.join(gone, F.col("id").eqNullSafe(F.col("gid")) & (F.col("th") == F.col("gth")), "left")
    text = F.col(f"row.`{text_col}`")
    exact = F.coalesce("exact", F.lit(0)).cast("long")
    counts = F.struct(
        F.coalesce(F.size(F.split(text, "\n", -1)), F.lit(0)).cast("long").alias("lines"),
        exact.alias("exact"),
        (F.coalesce(F.size("gone"), F.lit(0)) - exact).cast("long").alias("near"),
    )
    columns = [
        (remaining(text, F.col("gone")) if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in df.columns
    ]
    return found.select(*columns, counts.alias("line_counts"))
