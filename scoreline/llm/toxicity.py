"""Toxicity by compression: two zstandard dictionaries, one of toxic and one of ordinary text.

A window of a text is compressed with either dictionary; what it loses in
length with the toxic one against the ordinary one is its gain. A text's score
is a calibrated function of its largest gains.

Both dictionaries hold the same frequent ordinary words, so that what they
share cancels out, and as many bytes of words of their own: the toxic one
words that are typical of toxic training texts. A word counts once for each
pair of neighbours it is met with, so that copies of one text can't make its
words typical.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, materialize, narrow

EDGES = b".,;:!?()[]{}\"'"


def tokens(text: str | None) -> list[bytes]:
    return [w for w in (x.strip(EDGES) for x in (text or "").lower().encode("utf-8", "surrogatepass").split()) if w]


def windows(words: list[bytes], size: int) -> list[bytes]:
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(0, len(words), size)]


def contexts(texts: list[str]) -> Counter:
    """word -> number of different pairs of neighbours it is met with."""
    met: dict[bytes, set] = defaultdict(set)
    for t in texts:
        words = [b"", *tokens(t), b""]
        for a, w, b in zip(words, words[1:], words[2:]):
            met[w].add(hash((a, b)))
    return Counter({w: len(v) for w, v in met.items()})


def joined(words: list[bytes], size: int) -> bytes:
    """The first words that fit ``size`` bytes, the first of them last: zstandard reaches the end of a dictionary cheapest."""
    out, used = [], 1
    for w in words:
        if used + len(w) + 1 > size:
            break
        out.append(w)
        used += len(w) + 1
    return b" " + b" ".join(reversed(out)) + b" "


class Classifier:
    """Dictionaries and the calibration of their gains, from texts and labels (1: toxic).

    ``counts`` is how many there are of each label where the texts were drawn,
    if other than here: scores mean the share of toxic texts there.
    """

    PARAMETERS = {
        "window_log": 17,
        "hash_log": 14,
        "chain_log": 14,
        "search_log": 4,
        "min_match": 4,
        "target_length": 32,
        "strategy": zstandard.STRATEGY_LAZY,
        "write_content_size": False,
        "write_checksum": False,
        "write_dict_id": False,
    }

    def __init__(
        self, texts: list[str], toxic: list[int], base: int = 12000, own: int = 4000, window: int = 8, counts: dict | None = None
    ):
        self.window = window
        self.coefficients: np.ndarray | None = None
        counts = counts or Counter(toxic)
        n = counts.get(0, 0) + counts.get(1, 0)
        self.base_rate = counts.get(1, 0) / n if n else 0.0
        if not 0 < self.base_rate < 1 or len(set(toxic)) < 2:
            return  # nothing to tell apart
        # half of the texts make the dictionaries, the other half calibrates their gains
        half = [zlib.crc32((t or "").encode("utf-8", "surrogatepass")) % 2 for t in texts]
        pick = lambda h, y: [t for t, k, v in zip(texts, half, toxic) if k == h and v == y]
        bad, good = contexts(pick(0, 1)), contexts(pick(0, 0))
        n_bad, n_good = sum(bad.values()) + 1, sum(good.values()) + 1
        odds = lambda w: math.log((bad[w] + 0.5) / n_bad) - math.log((good[w] + 0.5) / n_good)
        typical = sorted((w for w in bad if bad[w] >= 6 and odds(w) > 3.5), key=lambda w: (-bad[w] * odds(w), w))
        common = sorted((w for w in good if good[w] >= 3 and odds(w) < 0.5), key=lambda w: (-good[w], w))
        shared = joined(common, base)
        spare = set(shared.split())
        tail = joined(typical, own)
        other = joined([w for w in common if w not in spare], len(tail))
        self.toxic, self.ordinary = tail + shared, other + shared
        calibrate = pick(1, 1), pick(1, 0)
        x = np.array([self.features(t) for part in calibrate for t in part]).reshape(-1, 8)
        y = np.repeat([1.0, 0.0], [len(calibrate[0]), len(calibrate[1])])
        if len(calibrate[0]) and len(calibrate[1]):
            self.coefficients = logistic(x, y)
            # the labels are cut to a number each: back to the odds they have
            self.coefficients[0] += math.log(counts[1] / counts[0]) - math.log(len(calibrate[0]) / len(calibrate[1]))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "both"}

    def compressors(self) -> list:
        if "both" not in self.__dict__:
            p = zstandard.ZstdCompressionParameters(**self.PARAMETERS)
            self.both = []
            for content in (self.ordinary, self.toxic):
                d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(compression_params=p)
                self.both.append(zstandard.ZstdCompressor(dict_data=d, compression_params=p).compress)
        return self.both

    def features(self, text: str | None) -> list[float]:
        """Of the gains of all windows: the three largest, how many are of 3, 5 and 7 bytes, their mean, and their number."""
        ordinary, toxic = self.compressors()
        g = sorted((len(ordinary(w)) - len(toxic(w)) for w in windows(tokens(text), self.window)), reverse=True)
        top = [*g[:3], 0, 0, 0][:3]
        large = [math.log1p(sum(v >= least for v in g)) for least in (3, 5, 7)]
        return [*map(float, top), *large, sum(g) / len(g) if g else 0.0, math.log1p(len(g))]

    def score(self, text: str | None) -> float:
        if self.coefficients is None:
            return self.base_rate
        z = float(self.coefficients[0] + self.coefficients[1:] @ np.array(self.features(text)))
        return 1 / (1 + math.exp(-min(max(z, -60.0), 60.0)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 40) -> np.ndarray:
    """Intercept and weights of a logistic regression, by Newton's method."""
    a = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (p - y) + ridge * w
        curve = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + ridge * np.eye(a.shape[1])
        w -= np.linalg.solve(curve, gradient)
    return w


def sample(
    df: DataFrame, labels: DataFrame, per_label: int, max_chars: int, held: int, id_col: str, text_col: str, label_col: str
) -> tuple[list[tuple[str, int]], dict[int, int]]:
    """At most ``per_label`` distinct training texts of each label, by the hash of the text, and how many ids each label has."""
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("int").alias("toxic"))
    # several labels of one row: toxic if any says so
    known = known.filter("toxic IN (0, 1) AND id IS NOT NULL").groupBy("id").agg(F.max("toxic").alias("toxic"))
    known = known.filter(F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(5)) != held)
    texts = narrow(df, id_col, text_col).filter(F.length("text") <= max_chars)
    # ids that have such a text, each once, whatever the size of the tables
    met = materialize(known.join(texts.select("id").distinct(), "id", "left_semi"), "labelled")
    counts = {r["toxic"]: r["count"] for r in met.groupBy("toxic").count().collect()}
    if not counts:
        return [], {}
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, 2.0 * per_label / n)))])
    # the ids are thinned before they meet the texts, so the join moves a bounded number of texts
    some = met.filter((F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)) < share[F.col("toxic")])
    drawn = texts.join(F.broadcast(some), "id")  # at most 4 x per_label ids, more or less
    once = drawn.groupBy("toxic", F.xxhash64("text").alias("h")).agg(F.min("text").alias("text"))
    once = materialize(once, "labelled-texts")
    taken = [once.filter(F.col("toxic") == y).orderBy("h").limit(per_label).collect() for y in (0, 1)]
    return [(r["text"], r["toxic"]) for rows in taken for r in rows], counts


def toxicity(
    df: DataFrame,
    labels: DataFrame,
    per_label: int = 4000,
    max_chars: int = 20_000,
    window: int = 8,
    held: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """Score every whole text for toxicity.

    The dictionaries and the calibration are fitted on a bounded sample: up to
    ``per_label`` distinct texts of each label, of at most ``max_chars``
    characters, from rows whose crc32(id) mod 5 is not ``held``; a label that only
    longer texts have isn't learned. The calibration
    is corrected to the odds of the labels among all such rows (an id counts
    once), so a score means the same however many were cut. Windows are
    ``window`` words; all windows of the whole text are compressed. Returns
    ``id_col``, held_out, score (0 to 1) and predicted (1 if score >= 0.5). A
    null or empty text has no window and the score of no gain; without labels
    of both kinds every score is the share of toxic labels. Null ids are not
    held out; repeated rows give repeated rows. Scoring is one pass without a
    shuffle.
    """
    rows, counts = sample(df, labels, per_label, max_chars, held, id_col, text_col, label_col)
    model = df.sparkSession.sparkContext.broadcast(Classifier([t for t, _ in rows], [y for _, y in rows], window=window, counts=counts))

    def each(ids: list, texts: list) -> dict:
        scores = [model.value.score(t) for t in texts]
        return {
            id_col: ids,
            "held_out": [i is not None and zlib.crc32(str(i).encode()) % 5 == held for i in ids],
            "score": scores,
            "predicted": [int(s >= 0.5) for s in scores],
        }

    schema = f"`{id_col}` long, held_out boolean, score double, predicted int"
    return map_texts(narrow(df, id_col, text_col), schema, each)
