"""Packing documents into sequences of a fixed number of tokens, best two fit.

Tokens are counted in one pass over the texts. What is packed is then known by
its length alone, and there are no more lengths than tokens in a sequence, so
the plan of all sequences is made from the histogram of lengths: a sequence is
filled greedily with the largest length that fits, then its smallest document
is replaced by two unpacked ones that fit the gap it leaves more tightly. What
is filled alike is filled at once, as often as the histogram allows, so the
plan has a few rows for each length however many documents there are. The
documents of a length are numbered in Spark (in salted groups, joined by prefix
sums) and look their sequence up in the plan by that number.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_texts, materialize, narrow
from .tokens import byte_alphabet

# The characters of Latin-1 that are letters and numbers in Unicode, and its white space.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = "\t-\r \u0085 "

PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+")
SEPARATORS = re.compile("[\x1c-\x1f]")


class Encoder:
    """Ids of texts as the tokenizers library gives them, remembered for words and their pieces.

    The tokenizer drops white space, lower-cases and never joins across its
    pieces, so a text's ids are those of its pieces in turn. Words within
    Latin-1 are cut by the pattern here and their pieces go to the library's
    model; the library cuts other words itself, and texts that hold a special
    string or one of the separators that only Python takes for white space go
    to it whole.
    """

    def __init__(self, path: str, most: int = 100_000):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.visible = {b: c for c, b in byte_alphabet().items()}
        self.most = most
        self.words: dict[str, bytes] = {}
        self.ids: dict[str, bytes] = {}

    def cut(self, text: str) -> list[str]:
        if SEPARATORS.search(text) or any(s in text for s in self.special):
            return [text]
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text.split()
        return text.lower().split()

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, word: str) -> bytes:
        if SEPARATORS.search(word) or any(s in word for s in self.special):
            return self.whole(word)
        try:
            word.encode("latin-1")
        except UnicodeEncodeError:
            return self.whole(word)
        known, out = self.ids, []
        for p in PIECES.findall(word.lower()):
            ids = known.get(p)
            if ids is None:
                shown = p.encode().decode("latin-1").translate(self.visible)
                tokens = [t.id for t in self.library.model.tokenize(shown)]
                ids = struct.pack(f"<{len(tokens)}I", *tokens)
                if len(p) <= 64:
                    known[p] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        for known in (self.words, self.ids):
            if len(known) >= self.most:
                known.clear()
        out = []
        for t in texts:
            words = self.cut(t)
            found = list(map(self.words.get, words))
            if None in found:
                for k, w in enumerate(words):
                    if found[k] is None:
                        found[k] = self.words.get(w) or self.word(w)
                        if len(w) <= 64:
                            self.words[w] = found[k]
            out.append(b"".join(found))
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def token_pieces(df: DataFrame, tokenizer: str, size: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(id, piece, start, length, ids_crc32): every text's ids and ``end_id``, cut after each ``size`` of them."""

    def each(ids: list, texts: list) -> dict:
        tail = np.array([end_id], "<u4").tobytes()
        out: dict[str, list] = {"id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
        for i, body in zip(ids, encoder(tokenizer).encode([t or "" for t in texts])):
            body += tail
            for k in range(0, len(body), 4 * size):
                part = body[k : k + 4 * size]
                row = (i, k // (4 * size), k // 4, len(part) // 4, zlib.crc32(part))
                for column, value in zip(out.values(), row):
                    column.append(value)
        return {**out, "piece": pa.array(out["piece"], pa.int32())}

    schema = "id long, piece int, start long, length long, ids_crc32 long"
    return map_texts(narrow(df, id_col, text_col), schema, each)


def plan_bins(counts: dict[int, int], size: int) -> list[tuple[list[int], int]]:
    """Fillings of sequences of ``size`` tokens and how often each is used: ([length, ...], times).

    ``counts`` has how many documents there are of each length (1 to ``size``).
    Each turn starts with the largest length left, fills greedily, improves by
    one replacement, and uses that filling until one of its lengths runs out.
    """
    left = dict(counts)
    lengths = sorted(left)

    def largest(most: int, used: dict[int, int]) -> int | None:
        """The largest length of at most ``most`` of which the filling leaves one."""
        k = bisect_right(lengths, most) - 1
        while k >= 0 and left[lengths[k]] <= used.get(lengths[k], 0):
            k -= 1
        return lengths[k] if k >= 0 else None

    plan = []
    while lengths:
        used: dict[int, int] = {}
        gap, filling = size, []
        while gap and (x := largest(gap, used)) is not None:
            filling.append(x)
            used[x] = used.get(x, 0) + 1
            gap -= x
        if gap and len(filling) > 1:
            # the smallest goes back; the best two for the gap it leaves come in its place if they fill more
            small = filling.pop()
            used[small] -= 1
            best, room = (small,), gap + small
            for k in range(bisect_right(lengths, room) - 1, -1, -1):
                a = lengths[k]
                if 2 * a < sum(best) or sum(best) == room:
                    break  # the larger of a better two would be larger
                if left[a] <= used.get(a, 0):
                    continue
                b = largest(min(a, room - a), used | {a: used.get(a, 0) + 1})
                if b is not None and a + b > sum(best):
                    best = (a, b)
            filling += best
            for x in best:
                used[x] = used.get(x, 0) + 1
        times = min(left[x] // n for x, n in used.items() if n)
        plan.append((filling, times))
        for x, n in used.items():
            left[x] -= n * times
        lengths = [x for x in lengths if left[x]]
    return plan


def pack(
    df: DataFrame,
    tokenizer: str,
    size: int = 4096,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = 64,
    group_rows: int = 1_000_000,
) -> DataFrame:
    """Pack all texts into sequences of at most ``size`` tokens.

    A text is its ids followed by ``end_id``; null is taken as empty, so every
    row gives at least one token. Only texts of more than ``size`` tokens are
    cut, after every ``size`` tokens. Returns a row for each piece: ``id_col``,
    piece (from 0), start (ids of its text before it), length, ids_crc32,
    sequence_id and offset (its place there; the pieces of a sequence lie side
    by side from 0). Equal lengths are dealt out in the order of id and piece,
    within ``salts`` groups by the hash of the id; repeated rows give repeated
    pieces with places of their own. An empty table gives no rows.

    The driver holds the histogram of lengths and the plan: at most ``size``
    lengths, whatever the input. Numbering the pieces of one length shuffles
    six numbers a piece; a length that all pieces have is spread over ``salts``
    groups, or over as many as hold ``group_rows`` pieces each.
    """
    counted = token_pieces(df, tokenizer, size, end_id, id_col, text_col)
    pieces = materialize(counted.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    salts = max(salts, -(-pieces.count() // group_rows))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(salts)))
    groups = materialize(salted.groupBy("length", "salt").agg(F.count("*").alias("n")), "piece-counts")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    counts = {r[0]: r[1] for r in groups.groupBy("length").agg(F.sum("n")).collect()}  # at most ``size`` rows

    # for each length: from which number on which slot is dealt out
    slots: dict[int, list[tuple[int, int, int]]] = {}
    dealt: dict[int, int] = {}
    sequence = 0
    for filling, times in plan_bins(counts, size):
        offset = 0
        for x in filling:
            slots.setdefault(x, []).append((dealt.get(x, 0), sequence, offset))
            dealt[x] = dealt.get(x, 0) + times
            offset += x
        sequence += times
    table = {x: np.array(v, np.int64).T for x, v in slots.items()}

    def place(batches):
        for b in batches:
            length, nth = b.column("length").to_numpy(), b.column("nth").to_numpy()
            seq, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for x in np.unique(length):
                own = np.flatnonzero(length == x)
                start, first, at = table[int(x)]
                k = np.searchsorted(start, nth[own], side="right") - 1
                seq[own], offset[own] = first[k] + nth[own] - start[k], at[k]
            cols = [b.column(c) for c in ("id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(seq), pa.array(offset)], names=names)

    names = [id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    order = Window.partitionBy("length", "salt").orderBy("uid")
    numbered = (
        salted.withColumn("own", F.row_number().over(order) - 1)
        .join(starts, ["length", "salt"])  # dealt out as the window is
        .select("id", "piece", "start", "length", "ids_crc32", (F.col("own") + F.col("before")).alias("nth"))
    )
    schema = f"`{id_col}` long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return numbered.mapInArrow(place, schema)
