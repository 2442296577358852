"""Benchmark decontamination by SimHash over windows of the items' sizes.

A window of a text as long as a benchmark item has a 64-bit SimHash of its
weighted word shingles. Items and windows whose SimHashes are within a Hamming
radius are found by a multi-index: the 64 bits are cut into blocks, so that two
hashes within the radius differ in few bits of some block; items are listed
under all block values that near, windows look up their own. What is found is
verified by the exact weighted similarity of the shingle sets.

A window that shares no shingle with an item has similarity 0 to it, so windows
are only laid where a text has a shingle of the benchmark: aligned as the items
have that shingle, for every item that has it.

Everything is built from DataFrame operations.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialize, narrow, words

BITS = 64
BLOCKS = 6
#: The side to which each bit leans where its vote is tied: the bits of pi.
LEANING = 0x243F6A8885A308D3


def block_bounds() -> list[tuple[int, int]]:
    cuts = [BITS * b // BLOCKS for b in range(BLOCKS + 1)]
    return list(zip(cuts, cuts[1:]))


def shingles(tokens: Column, size: int) -> Column:
    """The hash of the ``size`` words from each place on."""
    last = F.size(tokens) - size
    each = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.xxhash64(F.lit(size), *(F.get(tokens, i + k) for k in range(size))),
    )
    return F.when(last >= 0, each).otherwise(F.array().cast("array<long>"))


def simhash(weighted: Column, lean: float) -> Column:
    """The sign of the weighted vote of the shingles (array of (h, w)) on each bit.

    Each bit starts from a vote of ``lean`` to a fixed side. At half the weight
    of a shingle no vote of equal weights is tied, and a tie that would be isn't
    turned by a small change.
    """

    def vote(bit: Column) -> Column:
        return F.aggregate(
            weighted,
            F.when(F.call_function("getbit", F.lit(LEANING), bit.cast("int")) == 1, F.lit(lean)).otherwise(F.lit(-lean)),
            lambda s, x: s + F.when(F.call_function("getbit", x["h"], bit.cast("int")) == 1, x["w"]).otherwise(-x["w"]),
        )

    return F.aggregate(
        F.sequence(F.lit(0), F.lit(BITS - 1)),
        F.lit(0).cast("long"),
        lambda acc, bit: acc.bitwiseOR(
            F.when(vote(bit) > 0, F.call_function("shiftleft", F.lit(1).cast("long"), bit)).otherwise(F.lit(0).cast("long"))
        ),
    )


def blocks(fingerprint: Column) -> list[Column]:
    """The value of each block of bits."""
    return [
        F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).cast("int") for a, b in block_bounds()
    ]


def listed(fingerprint: Column, radius: int) -> Column:
    """(block, value) under which an item is found by every hash within ``radius``."""
    out = []
    for n, ((a, b), value) in enumerate(zip(block_bounds(), blocks(fingerprint))):
        flips = [sum(1 << k for k in c) for e in range(radius // BLOCKS + 1) for c in combinations(range(b - a), e)]
        each = F.transform(F.array(*map(F.lit, flips)), lambda m: value.bitwiseXOR(m))  # noqa: B023
        out.append(F.transform(each, block_entry(n)))
    return F.concat(*out)


def block_entry(n: int):
    return lambda v: F.struct(F.lit(n).alias("block"), v.cast("int").alias("value"))


def weight(df: Column, items: int) -> Column:
    """A shingle weighs more the fewer items have it."""
    return F.lit(1.0) + F.log(F.lit(float(items + 1)) / (df + 1))


def total(weighted: Column) -> Column:
    return F.aggregate(weighted, F.lit(0.0), lambda s, x: s + x["w"])


def benchmark_items(
    benchmark: DataFrame, id_col: str, text_col: str, size: int
) -> tuple[DataFrame, DataFrame, DataFrame, int, list[int]]:
    """Items (item, s, m, win), their shingles (h, df, places), ids (item, item_id), the number of items and the shingle sizes in use.

    Inside, ``item`` is the hash of an item's words: ids may be null or have several texts.
    """
    rows = narrow(benchmark, id_col, text_col).select(F.col("id").alias("item_id"), words(F.col("text")).alias("tokens"))
    rows = rows.filter(F.size("tokens") > 0).withColumn("item", F.xxhash64("tokens"))
    ids = materialize(rows.select("item", "item_id").distinct(), "benchmark-ids")
    n = ids.count()
    rows = rows.dropDuplicates(["item"]).withColumn("s", F.least(F.size("tokens"), F.lit(size)))
    pick = F.when(F.col("s") == 1, shingles(F.col("tokens"), 1))
    for s in range(2, size + 1):
        pick = pick.when(F.col("s") == s, shingles(F.col("tokens"), s))
    rows = rows.select("item", "s", pick.alias("hashes")).withColumn("m", F.size("hashes"))
    rows = materialize(rows.join(ids.groupBy("item").agg(F.count("*").alias("ids")), "item"), "benchmark-items")
    sizes = sorted(r["s"] for r in rows.select("s").distinct().collect()) or [size]  # at most ``size`` numbers
    places = rows.select("item", "s", "m", "ids", F.posexplode("hashes").alias("q", "h"))
    # an item counts once for each of its ids
    df = places.select("h", "item", "ids").distinct().groupBy("h").agg(F.sum("ids").alias("df"))
    # as many places as there are lengths and offsets in them, however many items share a shingle
    known = places.groupBy("h").agg(F.collect_set(F.struct("s", "m", "q")).alias("places"))
    known = materialize(df.join(known, "h"), "benchmark-shingles")
    weights = known.select("h", weight(F.col("df"), n).alias("w"))
    win = F.transform(F.array_sort(F.collect_list(F.struct("q", "h", "w"))), lambda x: F.struct(x["h"].alias("h"), x["w"].alias("w")))
    items = places.join(weights, "h").groupBy("item", "s", "m").agg(win.alias("win"))
    return items, known, ids, n, sizes


def laid(texts: DataFrame, known: DataFrame, items: int, sizes: list[int], threshold: float) -> DataFrame:
    """(id, th, windows): per text the windows (s, start, m) to test."""
    tokens = texts.select("id", F.xxhash64("text").alias("th"), words(F.col("text")).alias("tokens"))
    places = broadcast_if_small(known.select("h", "places"), 2_000_000)
    hits = None
    for s in sizes:
        own = tokens.select("id", "th", F.lit(s).alias("s"), F.posexplode(shingles(F.col("tokens"), s)).alias("p", "h"))
        hits = own if hits is None else hits.unionByName(own)
    hits = materialize(hits.join(places, "h"), "benchmark-hits")
    at = hits.select("id", "th", "p", "s", F.explode("places").alias("place")).filter(F.col("place.s") == F.col("s"))
    windows = at.select("id", "th", "s", (F.col("p") - F.col("place.q")).alias("start"), F.col("place.m").alias("m")).distinct()
    # known shingles inside each window: what comes before its end less what comes before its start, from one
    # running count over the text, in which a window's borders stand before the shingle of their place
    border = lambda side, pos: windows.select("id", "th", "s", pos.alias("pos"), F.lit(side).alias("side"), "start", "m")
    here = hits.select("id", "th", "s", F.col("p").alias("pos"), F.lit(2).alias("side")).distinct()
    marks = (
        border(0, F.col("start")).unionByName(border(1, F.col("start") + F.col("m"))).unionByName(here, allowMissingColumns=True)
    )
    upto = Window.partitionBy("id", "th", "s").orderBy("pos", "side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = marks.withColumn("n", F.sum((F.col("side") == 2).cast("long")).over(upto)).filter("side < 2")
    inside = F.max(F.when(F.col("side") == 1, F.col("n"))) - F.max(F.when(F.col("side") == 0, F.col("n")))
    counted = counted.groupBy("id", "th", "s", "start", "m").agg(inside.alias("n"))
    # a window needs shared weight of at least the threshold times the item's, so at least so many known shingles
    least = threshold / (1 + math.log(items + 1))
    enough = counted.filter(F.col("n") >= F.lit(least) * F.col("m"))
    return enough.groupBy("id", "th").agg(F.collect_list(F.struct("s", "start", "m")).alias("windows"))


def find_leaks(
    df: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.8,
    size: int = 5,
    radius: int = 23,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id, th, item, similarity, word_start, n_words): where a text holds what is nearly a benchmark item.

    ``item`` is the item's id. An id may be null or have several texts: each is
    an item, and a text's best match of those of one id (or of none) is given.

    A window as long as the item matches if the weights of the shingles that
    both have are at least ``threshold`` of the weights of those that either
    has. Shingles are ``size`` lower-cased words, all words for shorter items,
    and weigh the more the fewer items have them. Of several windows of a text
    that match an item the most similar is given, the first of equals; windows
    reach beyond neither end of the text. ``th`` is the hash of the text; rows
    that repeat id and text appear once. Null or blank texts and items match
    nothing; either table may be empty.

    ``radius`` is the Hamming distance of SimHashes within which every pair is
    found: three flips in each block. Simulated with the weights of an item and
    of a window with one word replaced, at a similarity of 0.80 to 0.82, hashes
    differ in 8.7 to 9.3 bits on average if the item's shingles are all its own,
    in 11.7 if most are shared by all items; none of 4,000 pairs of each of 8
    such items differed in more than 23 (up to 3.4% in more than 17). Equal windows
    are hashed and tested once, however many texts have them.
    """
    found, ids = matches(df, benchmark, threshold, size, radius, id_col, text_col, item_col, item_text_col)
    best = F.max(F.struct("similarity", (-F.col("word_start")).alias("before"), "n_words"))
    named = found.join(ids, "item").groupBy("id", "th", F.col("item_id").alias("item")).agg(best.alias("best"))
    return named.select("id", "th", "item", "best.similarity", (-F.col("best.before")).alias("word_start"), "best.n_words")


def matches(
    df: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.8,
    size: int = 5,
    radius: int = 23,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """What `find_leaks` gives, by the hash of the item's words in place of its id, and the ids of each (item, item_id)."""
    texts = narrow(df, id_col, text_col)
    items, known, ids, n, sizes = benchmark_items(benchmark, item_col, item_text_col, size)
    windows = materialize(laid(texts, known, n, sizes, threshold), "benchmark-windows")
    lean = (1 + math.log((n + 1) / 2)) / 2  # half the weight of a shingle of one item

    # the texts that have any window, and their windows' shingles
    some = broadcast_if_small(windows.select("id").distinct(), 1_000_000)
    own = texts.join(some, texts["id"].eqNullSafe(some["id"]), "left_semi").withColumn("th", F.xxhash64("text"))
    own = own.dropDuplicates(["id", "th"]).select("id", "th", words(F.col("text")).alias("tokens"))
    asked = windows.withColumnRenamed("id", "wid").withColumnRenamed("th", "wth")
    both = own.join(asked, F.col("id").eqNullSafe(F.col("wid")) & (F.col("th") == F.col("wth")))
    # the shingles of a text once; its windows are cut from them before they become rows
    all_of = F.array(F.struct(*(shingles(F.col("tokens"), s).alias(f"s{s}") for s in sizes)))

    def cut_from(own: Column, w: Column) -> Column:
        mine = F.lit(None).cast("array<long>")
        for s in sizes:
            mine = F.when(w["s"] == s, own[f"s{s}"]).otherwise(mine)
        first = F.greatest(w["start"], F.lit(0))
        part = F.slice(mine, first + 1, F.least(w["start"] + w["m"], F.size(mine)) - first)
        return F.struct(w["s"].alias("s"), w["m"].alias("m"), first.alias("word_start"), part.alias("part"))

    cuts = F.get(F.transform(all_of, lambda own: F.transform("windows", lambda w: cut_from(own, w))), F.lit(0))
    cut = both.select("id", "th", F.inline(cuts)).withColumn("length", F.size("part"))
    cut = materialize(cut.withColumn("wh", F.xxhash64("part")), "benchmark-cuts")

    # equal windows once, with the weights of their shingles
    each = cut.groupBy("wh", "s", "m").agg(F.first("part").alias("part"))
    each = each.select("wh", "s", "m", F.posexplode("part").alias("q", "h"))
    weights = broadcast_if_small(known.select("h", weight(F.col("df"), n).alias("w")), 2_000_000)
    weighed = each.join(weights, "h", "left").withColumn("w", F.coalesce("w", F.lit(1 + math.log(n + 1))))
    in_turn = F.array_sort(F.collect_list(F.struct("q", "h", "w")))
    win = F.transform(in_turn, lambda x: F.struct(x["h"].alias("h"), x["w"].alias("w")))
    fingerprinted = weighed.groupBy("wh", "s", "m").agg(win.alias("win")).withColumn("fp", simhash(F.col("win"), lean))
    fingerprinted = materialize(fingerprinted, "benchmark-hashes")
    probes = F.array(*(block_entry(b)(v) for b, v in enumerate(blocks(F.col("fp")))))
    asked = fingerprinted.select("wh", "s", "m", "fp", F.inline(probes))
    listing = items.withColumn("ifp", simhash(F.col("win"), lean)).select("item", "s", "m", "ifp", F.inline(listed(F.col("ifp"), radius)))
    near = asked.join(listing, ["s", "m", "block", "value"])
    near = near.filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))) <= radius).select("wh", "s", "m", "item").distinct()

    tested = near.join(fingerprinted.select("wh", "s", "m", "win"), ["wh", "s", "m"])
    tested = tested.join(items.select("item", "s", "m", F.col("win").alias("iwin")), ["item", "s", "m"])
    shared = total(F.array_intersect("win", "iwin"))
    similarity = shared / (total(F.array_distinct("win")) + total(F.array_distinct("iwin")) - shared)
    # sums of weights in different orders differ in the last digits
    same = tested.withColumn("similarity", F.round(similarity, 9)).filter(F.col("similarity") >= threshold)
    same = materialize(same.select("wh", "s", "m", "item", "similarity"), "benchmark-matches")
    found = cut.select("id", "th", "s", "m", "word_start", "length", "wh").join(same, ["wh", "s", "m"])
    best = F.max(F.struct("similarity", (-F.col("word_start")).alias("before"), (F.col("length") + F.col("s") - 1).alias("n_words")))
    found = found.groupBy("id", "th", "item").agg(best.alias("best")).select(
        "id", "th", "item", "best.similarity", (-F.col("best.before")).alias("word_start"), "best.n_words"
    )
    return found, ids


def drop_leaking(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``df``, with all their columns, whose text holds no benchmark item (see `find_leaks`)."""
    leaks, _ = matches(df, benchmark, id_col=id_col, text_col=text_col, **how)
    leaks = materialize(leaks.select(F.col("id").alias("lid"), F.col("th").alias("lth")).distinct(), "leaking")
    key, text = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), key.alias("id"), F.xxhash64(text).alias("th"))
    side = broadcast_if_small(leaks, 1_000_000)
    clean = rows.join(side, F.col("id").eqNullSafe(F.col("lid")) & (F.col("th") == F.col("lth")), "left_anti")
    return clean.select("row.*")
