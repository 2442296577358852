"""Language identification in two levels: the family first, then one-versus-one linear SVMs within it.

Features are hashed byte n-grams (1 to 4 bytes of lower-cased letters and
spaces), as frequencies of unit length. A model is a table of weights by
feature, so a text is scored by looking up each of its n-grams and averaging.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, narrow

# Families of languages by their ISO 639-1 codes; a code not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is", "af", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk", "be"),
    "finnic": ("fi", "et"),
    "indic": ("hi", "bn", "mr", "gu", "pa", "ne"),
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}

NOT_LETTERS = re.compile(r"[\W\d_]+")
UNDETERMINED = "und"


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def grams(text: str, bits: int) -> np.ndarray:
    """Hashed feature numbers of all n-grams of 1 to 4 bytes of a whole text."""
    b = np.frombuffer((" " + NOT_LETTERS.sub(" ", text.lower()) + " ").encode("utf-8", "surrogatepass"), np.uint8)
    b = b.astype(np.uint32)
    out, key = [], np.zeros(len(b), np.uint32)
    for n in range(4):
        if len(b) <= n:
            break
        key = (key[: len(b) - n] << np.uint32(8)) | b[n:]
        # a multiplicative hash; the length of the n-gram is part of it
        out.append(((key + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(32 - bits))
    return np.concatenate(out)


def vector(text: str, bits: int) -> np.ndarray:
    v = np.bincount(grams(text, bits), minlength=1 << bits).astype(np.float32)
    return v / np.linalg.norm(v)


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 12, seed: int = 0) -> np.ndarray:
    """A linear support vector machine (hinge loss, dual coordinate descent); y is +1 or -1."""
    rng = np.random.default_rng(seed)
    weight, alpha = np.zeros(x.shape[1], np.float32), np.zeros(len(y), np.float32)
    weigh = np.where(y > 0, (y < 0).sum(), (y > 0).sum()).astype(np.float32)
    bound = cost * weigh / weigh.mean()  # the rarer class costs more
    square = (x * x).sum(1)
    for _ in range(rounds):
        for i in rng.permutation(len(y)):
            gradient = y[i] * float(x[i] @ weight) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), bound[i])
            if new != alpha[i]:
                weight += np.float32((new - alpha[i]) * y[i]) * x[i]
                alpha[i] = new
    return weight


def slope(margins: np.ndarray, y: np.ndarray) -> float:
    """How fast a margin becomes certainty: the best of a grid by log loss."""
    grid = np.geomspace(0.5, 64, 22)
    loss = [np.logaddexp(0, -s * margins * y).mean() for s in grid]
    return float(grid[int(np.argmin(loss))])


class Model:
    """One machine for each pair of families and for each pair of languages in a family."""

    def __init__(self, texts: list[str], langs: list[str], bits: int):
        self.bits = bits
        x = np.stack([vector(t, bits) for t in texts]) if texts else np.zeros((0, 1 << bits), np.float32)
        langs_of = np.array(langs, dtype=object)
        family = np.array([FAMILY.get(v, v) for v in langs], dtype=object)
        self.langs: dict[str, list[str]] = {f: sorted(set(langs_of[family == f])) for f in sorted(set(family))}
        self.families = list(self.langs)
        self.machines: list[tuple[str, str]] = []
        weights, self.slopes = [], []
        levels = [(family, self.families), *((langs_of, v) for v in self.langs.values())]
        for labels, names in levels:
            for a, b in combinations(names, 2):
                own = (labels == a) | (labels == b)
                y = np.where(labels[own] == a, 1.0, -1.0).astype(np.float32)
                w = fit_svm(x[own], y)
                self.machines.append((a, b))
                self.slopes.append(slope(x[own] @ w, y))
                weights.append(w)
        # a row for each feature, so that one look-up serves all machines
        self.weights = np.stack(weights, 1) if weights else np.zeros((1 << bits, 0), np.float32)

    def decide(self, names: list[str], wins: dict[tuple[str, str], float]) -> tuple[str, float]:
        """The name with most certainty over its pairs, and its share."""
        if len(names) == 1:
            return names[0], 1.0
        p = {n: 0.0 for n in names}
        for a, b in combinations(names, 2):
            p[a] += wins[a, b]
            p[b] += 1 - wins[a, b]
        best = max(names, key=lambda n: p[n])
        return best, min(wins.get((best, n), 1 - wins.get((n, best), 1.0)) for n in names if n != best)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return UNDETERMINED, 0.0
        count = np.bincount(grams(text, self.bits), minlength=1 << self.bits).astype(np.float32)
        margins = (count @ self.weights) / np.linalg.norm(count)
        sure = 1 / (1 + np.exp(np.clip(-np.array(self.slopes) * margins, -60, 60)))
        wins = dict(zip(self.machines, sure.tolist()))
        family, share = self.decide(self.families, wins)
        lang, own = self.decide(self.langs[family], wins)
        return lang, share * own


def sample(df: DataFrame, per_lang: int, max_chars: int, id_col: str, text_col: str, lang_col: str, held: int) -> list:
    """At most ``per_lang`` labelled training texts of each language, chosen by a hash of the text.

    Equal texts count once. Only texts of at most ``max_chars`` characters are
    taken, so the sample is bounded in bytes, and a language that only longer
    texts have isn't learned; the choice doesn't depend on partitions or order.
    """
    key = F.col(f"`{id_col}`").cast("long")
    rows = df.select(key.alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")).filter(
        (F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(4)) != held)
        & F.col("lang").isNotNull()
        & F.col("text").rlike(r"\p{L}")
        & (F.length("text") <= max_chars)
    )
    # each task keeps its lowest hashes of each language; the rest is decided among those
    marked = rows.withColumn("h", F.xxhash64("text"))
    lowest = marked.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    share = {r["lang"]: min(1.0, 1.3 * per_lang / max(1, r["n"])) for r in lowest.collect()}
    if not share:
        return []
    cut = F.create_map(*[x for k, v in share.items() for x in (F.lit(k), F.lit(v))])[F.col("lang")]
    low = marked.filter((F.pmod("h", F.lit(1 << 30)) / float(1 << 30)) < cut)
    chosen = low.groupBy("lang", "h").agg(F.min("text").alias("text")).collect()
    by: dict[str, list] = {}
    for r in sorted(chosen, key=lambda r: (r["lang"], r["h"] % (1 << 30), r["h"])):
        by.setdefault(r["lang"], []).append(r["text"])
    return [(t, lang) for lang, texts in by.items() for t in texts[:per_lang]]


def fit(
    df: DataFrame, per_lang: int, max_chars: int, bits: int, held: int, id_col: str, text_col: str, lang_col: str
) -> Broadcast:
    learned = sample(df, per_lang, max_chars, id_col, text_col, lang_col, held)
    return df.sparkSession.sparkContext.broadcast(Model([t for t, _ in learned], [v for _, v in learned], bits))


def language_id(
    df: DataFrame,
    per_lang: int = 500,
    max_chars: int = 20_000,
    bits: int = 13,
    held: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Predict the language of every whole text.

    The classifier is fitted on a bounded sample: up to ``per_lang`` distinct
    texts of each label, of at most ``max_chars`` characters, from rows whose
    crc32(id) mod 4 is not ``held``. Each prediction uses the whole text.
    Returns ``id_col``, held_out, lang_pred and score (0 to 1: the certainty of
    the family times that of the language against its closest rival). A text
    that is null or has no letter is "und" with score 0, and so are all texts
    if nothing is labelled. Rows of a null id are not held out. Repeated rows
    give repeated rows. Scoring is one pass without a shuffle.
    """
    model = fit(df, per_lang, max_chars, bits, held, id_col, text_col, lang_col)

    def each(ids: list, texts: list) -> dict:
        found = [model.value.predict(t) for t in texts]
        return {
            id_col: ids,
            "held_out": [i is not None and zlib.crc32(str(i).encode()) % 4 == held for i in ids],
            "lang_pred": [lang for lang, _ in found],
            "score": [score for _, score in found],
        }

    schema = f"`{id_col}` long, held_out boolean, lang_pred string, score double"
    return map_texts(narrow(df, id_col, text_col), schema, each)


def keep_identified(
    df: DataFrame,
    min_score: float = 0.5,
    per_lang: int = 500,
    max_chars: int = 20_000,
    bits: int = 13,
    held: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The rows, with all their columns, whose language is identified with a score of at least ``min_score``.

    Rejects texts that are null or have no letter, and those that two languages
    claim alike (see `language_id`). Without any labelled text all rows stay:
    there is nothing to judge by. One pass, no shuffle.
    """
    model = fit(df, per_lang, max_chars, bits, held, id_col, text_col, lang_col)
    if not model.value.langs:
        return df
    place = df.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sure = [score >= min_score for score in (model.value.predict(t.as_py())[1] for t in b.column(place))]
            yield b.filter(pa.array(sure, pa.bool_()))

    return df.mapInArrow(run, df.schema)
