"""Spelling variants by a dictionary of trie-node pairs.

A place in a word splits it into a node of the trie of all words, the letters
before it, and a node of the trie of all reversed words, the letters after it.
Nodes are numbered by a digest of their path, found letter by letter from the
node above, so no table of nodes has to be joined by every word at the root.
Two kinds of pairs (prefix node, suffix node) go into one dictionary:

* a *gap* pair at each place: the word itself, nothing left out;
* a *skip* pair at each letter: the word without that letter.

Words whose skip pairs are equal differ in that letter alone (replacement); a
word whose gap pair equals another's skip pair is that word with one letter
inserted. So equal pairs are neighbours, and all neighbours have equal pairs.
Letters after the first of a run are skipped for replacements only, so each
pair of neighbours meets at one entry.

An entry has one gap at most and one skip for each letter there is, so it is
bounded by the alphabet however many words there are. Neighbours are counted
and the best is chosen in the entry, without forming pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, narrow, partitions, sliced

#: The letters that runs are made of; only A-Z are lower-cased, so the others stand for themselves.
RUNS = re.compile("[a-zÀ-ÿ]+")
ALPHABET = 26 + 64


def counted_runs(df: DataFrame, garble: int | None, id_col: str, text_col: str, most: int = 200_000) -> DataFrame:
    """(word, n): how often each word stands, added up in each task before the shuffle.

    With ``garble`` the words are those of a test: where the crc32 of
    ``<id>:<run>`` is divisible by it, the letter at crc32 % length is left out;
    a null id leaves the run as it is.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for ids, texts in sliced(batches):
            for key, text in zip(ids, texts):
                if not text:
                    continue
                runs = RUNS.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))
                if garble and key is not None:
                    head = zlib.crc32(f"{key}:".encode())
                    own = Counter(runs)
                    for w in [w for w in own if zlib.crc32(w.encode(), head) % garble == 0]:
                        at = zlib.crc32(w.encode(), head) % len(w)
                        total[w[:at] + w[at + 1 :]] += own.pop(w)
                    total.update(own)
                else:
                    total.update(runs)
            if len(total) >= most:
                yield rows(total)
                total.clear()
        yield rows(total)

    def rows(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})

    parts = narrow(df, id_col, text_col).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def nodes(word: str) -> tuple[list[int], list[int], list[int], list[int]]:
    """Numbers of the prefixes of 0, 1, ... letters and of the suffixes from each place on; a second digest of each.

    The second digests tell apart what two different pairs of equal numbers spell.
    """

    def path(letters: list[bytes]) -> np.ndarray:
        h = blake2b(digest_size=16)
        out = [h.digest()]
        for c in letters:
            h.update(c)
            out.append(h.digest())
        return np.frombuffer(b"".join(out), np.int64).reshape(-1, 2)

    letters = [c.encode("utf-32-le") for c in word]
    forward, backward = path(letters), path(letters[::-1])[::-1]
    return forward[:, 0], backward[:, 0], forward[:, 1], backward[:, 1]


def pair_dictionary(words: DataFrame) -> DataFrame:
    """(prefix, suffix, check, gap, first, wid, n) of every gap and skip of every word (wid, word, n)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held: list[list[np.ndarray]] = []
            size = 0
            for wid, word, n in zip(*(b.column(c).to_pylist() for c in ("wid", "word", "n"))):
                m = len(word)
                p, s, p2, s2 = nodes(word)
                letters = np.frombuffer(word.encode("utf-32-le"), np.uint32)
                first = np.ones(m, bool)
                first[1:] = letters[1:] != letters[:-1]
                held.append([
                    np.concatenate([p, p[:-1]]),
                    np.concatenate([s, s[1:]]),
                    np.concatenate([p2 ^ (s2 << 1), p2[:-1] ^ (s2[1:] << 1)]),
                    np.repeat([True, False], [m + 1, m]),
                    np.concatenate([np.zeros(m + 1, bool), first]),
                    np.full(2 * m + 1, wid),
                    np.full(2 * m + 1, n),
                ])
                size += m
                if size > 100_000:
                    yield batch(held)
                    held, size = [], 0
            if held:
                yield batch(held)

    def batch(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=names)

    names = ["prefix", "suffix", "check", "gap", "first", "wid", "n"]
    schema = "prefix long, suffix long, check long, gap boolean, first boolean, wid long, n long"
    return words.select("wid", "word", "n").mapInArrow(run, schema)


def best(members: Column) -> Column:
    """Of structs (n, wid) the one of largest n, then of smallest wid."""
    return F.array_max(F.transform(members, lambda m: F.struct(m["n"].alias("n"), (-m["wid"]).alias("last"))))


def neighbours(words: DataFrame) -> DataFrame:
    """(wid, n_near, form_wid, form_n): how many near words a word has and the one of largest n."""
    member = F.struct("gap", "first", "n", "wid")
    entries = (
        pair_dictionary(words)
        .groupBy("prefix", "suffix", "check")
        .agg(F.collect_list(member).alias("members"))
        .filter(F.size("members") > 1)
    )
    # what a member is near to: a gap to the first letters of runs, a skip to the other skips and, as a first letter, to the gap
    near = lambda m: F.filter(
        "members",
        lambda o: (o["wid"] != m["wid"])
        & F.when(m["gap"], ~o["gap"] & o["first"]).otherwise(~o["gap"] | m["first"]),
    )
    each = F.transform("members", lambda m: F.struct(m["wid"].alias("wid"), near(m).alias("near")))
    found = entries.select(F.inline(F.filter(each, lambda e: F.size(e["near"]) > 0)))
    found = found.select("wid", F.size("near").alias("count"), best(F.col("near")).alias("best"))
    return found.groupBy("wid").agg(F.sum("count").alias("n_near"), F.max("best").alias("best")).select(
        "wid", "n_near", (-F.col("best.last")).alias("form_wid"), F.col("best.n").alias("form_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(wid, root): the last word that the chain from each word with a form (wid, form_wid) leads to.

    A form stands at least ``ratio`` times as often as its word, so chains are
    finite; each round doubles how far a word looks. The rounds are written to
    the shared folder.
    """
    reach = materialize(forms.selectExpr("wid", "form_wid AS root"), "spelling-roots")
    while True:
        onward = reach.selectExpr("wid AS root", "root AS further")
        longer = materialize(
            reach.join(onward, "root", "left").select(
                "wid", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            ),
            "spelling-roots",
        )
        if longer.filter("moved").isEmpty():
            return longer.select("wid", "root")
        reach = longer.select("wid", "root")


def spelling_variants(
    df: DataFrame,
    min_letters: int = 5,
    min_count: int = 3,
    ratio: int = 2,
    garble: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of at least ``min_letters`` letters that stands ``min_count`` times.

    Words are runs of the letters A-Z, a-z and U+00C0 to U+00FF in whole texts;
    only A-Z are lower-cased. Two words are near if they differ by one inserted,
    deleted or replaced letter; ``n_near`` counts a word's near words. ``form``
    is the near word that stands most often, of equals the first in code-point
    order, if it stands at least ``ratio`` (more than 1) times as often as the
    word, else null, as is ``form_n``; ``root`` is where the forms lead in the
    end, the word itself if it has none. Null and empty texts have no words,
    repeated rows count each, ids may be null; an empty table gives no rows.
    ``garble`` leaves out letters of some words for a test (see `counted_runs`).

    Counts are added up in each task before they are shuffled, so a frequent
    word is one row a task. A word of m letters has 2 m + 1 numbers in the
    dictionary, whatever its length; its letters are never copied. An entry has
    at most one word for each of the letters, beside the gap. Numbers are
    64-bit digests, and a third one must agree: different pairs are taken for
    one with a probability of 2^-128 or less a pair.
    """
    if ratio <= 1:
        raise ValueError("ratio must be more than 1, else forms can lead in a circle")
    spark = df.sparkSession
    words = counted_runs(df, garble, id_col, text_col)
    words = materialize(words.filter((F.length("word") >= min_letters) & (F.col("n") >= min_count)), "spelling-counts")
    # numbered in code-point order
    ordered = words.repartitionByRange(partitions(spark), "word").sortWithinPartitions("word")
    words = materialize(ordered.withColumn("wid", F.monotonically_increasing_id()), "spelling-words")
    near = materialize(neighbours(words), "spelling-neighbours")
    own = words.join(near, "wid", "left").withColumn("has", F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False)))
    own = materialize(
        own.select(
            "wid", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(F.col("has"), F.col("form_wid")).alias("form_wid"), F.when(F.col("has"), F.col("form_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    lead = roots(own.filter("form_wid IS NOT NULL"))
    names = words.select("wid", "word")
    out = (
        own.join(lead, "wid", "left")
        .join(names.selectExpr("wid AS form_wid", "word AS form"), "form_wid", "left")
        .join(names.selectExpr("wid AS root", "word AS root_word"), "root", "left")
    )
    return out.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
