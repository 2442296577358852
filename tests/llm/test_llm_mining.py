"""Hard negatives, spelling variants and packing in order: against brute force, the library and their invariants."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scoreline.llm import hard_negatives, ordered_packing, spelling

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
NAN, INF = float("nan"), float("inf")

# --- hard negatives ---------------------------------------------------------------


def floors(v):
    return [int(np.floor(256 * x)) for x in v]


def mined(rows, every=5, count=5, low=80, high=100):
    """By definition: rows of (id, label, vector); ids None last."""
    rows = [
        (i, label, floors(v)) for i, label, v in rows
        if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = Counter()
    for i, label, v in {(i, label, tuple(v)) for i, label, v in rows if i is not None and i % every == 0}:
        scored = [(sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in rows]
        positives = sorted([s for s in scored if s[2] == label and s[1] != i], key=order)[:count]
        others = sorted([s for s in scored if s[2] != label], key=order)
        for p, positive, _ in positives:
            inside = [s for s in others if low * p <= 100 * s[0] <= high * p][:count]
            for rank, (n, negative, _) in enumerate(inside, 1):
                out[i, positive, rank, negative, p, n] += 1
    return out


def vectors(spark, rows):
    """Rows with extra columns whose names the operator uses itself."""
    return spark.createDataFrame(
        [(i, label, v, 1, "x", 2) for i, label, v in rows],
        "vec_id long, label int, embedding array<float>, number int, vector string, rank int",
    )


def check_mined(spark, rows, **how):
    got = hard_negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 5 == 0, block=16, tree=4, batch=2, **how)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(map(tuple, got.collect())) == mined(rows)


def clustered(seed, n=90):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, 6))
    return [
        (k, int(rng.integers(0, 3)), (centres[rng.integers(0, 4)] + rng.normal(size=6) * 0.2).astype(np.float32).tolist())
        for k in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_hard_negatives_equal_brute_force(spark, seed):
    check_mined(spark, clustered(seed))


def test_hard_negatives_of_odd_rows(spark):
    rows = clustered(3, 40)
    same = rows[7][2]
    rows += [
        (100, None, same), (105, 1, None), (110, 1, [1.0, None]), (115, 1, [NAN] * 6), (120, 1, [INF, 0.0]),
        (125, 1, []), (130, 2, [0.5]), (135, 2, same + [3.0]), (None, 1, same), (None, 0, same),
        (140, 0, same), (140, 0, same), (140, 1, same), (141, 0, same), (142, 0, same), (-5, 1, same), (-10, 2, [-x for x in same]),
    ]
    check_mined(spark, rows)


def test_scores_beyond_floating_point_are_exact(spark):
    rng = random.Random(4)
    big = lambda: [rng.choice([-1, 1]) * rng.random() * 2.0**20 for _ in range(3)]
    check_mined(spark, [(k, k % 2, np.array(big(), np.float32).tolist()) for k in range(30)])


def test_hard_negatives_of_nothing(spark):
    assert hard_negatives.hard_negatives(vectors(spark, []), F.col("vec_id") % 5 == 0).count() == 0
    assert hard_negatives.hard_negatives(vectors(spark, [(1, 1, [1.0])]), F.col("vec_id") % 5 == 0).count() == 0


def test_bounds_spare_scores_where_anchors_are_close():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(5, 16)) * 300
    anchors = np.floor(np.concatenate([c + rng.normal(size=(12, 16)) * 2 for c in centres])).astype(np.int64)
    order, parent, edge = hard_negatives.spanning_tree(anchors)
    assert sorted(order) == list(range(60)) and parent[0] == -1 and (parent[1:] < np.arange(1, 60)).all()
    for k in range(1, 60):
        assert edge[k] == pytest.approx(np.linalg.norm(anchors[order[k]] - anchors[order[parent[k]]]))

    def block(m, **more):
        b = hard_negatives.Block.__new__(hard_negatives.Block)
        b.n, b.vectors, b.floats, b.largest = len(m), m, m.astype(float), float(np.abs(m).max())
        b.norms = np.sqrt((b.floats**2).sum(1))
        b.__dict__.update(more)
        return b

    rows = np.floor(rng.normal(size=(400, 16)) * 100).astype(np.int64)
    tree, all_rows = block(anchors[order], parents=parent, edges=edge), block(rows)
    exact = rows @ anchors[order].T
    asked = np.sort(exact, 0)[-5]  # a window from the fifth best on
    scored = 0
    for k, which, score in hard_negatives.walk(tree, all_rows, lambda k, low, high: high >= asked[k]):
        scored += len(which)
        assert (score == exact[which, k]).all()
        assert set(np.flatnonzero(exact[:, k] >= asked[k])) <= set(which)
    assert scored < 0.3 * exact.size


# --- spelling variants --------------------------------------------------------------


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(rows, garble=None, min_letters=5, min_count=3, ratio=2):
    counts = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate({c: c + 32 for c in range(65, 91)})
            if garble and i is not None and (h := zlib.crc32(f"{i}:{w}".encode())) % garble == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_letters and n >= min_count}
    others = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if near(a, b):
            others[a].append(b)
            others[b].append(a)
    best = {w: min(o, key=lambda x: (-words[x], x)) for w, o in others.items() if o}
    form = {w: best[w] if w in best and words[best[w]] >= ratio * n else None for w, n in words.items()}
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(others[w]), words[form[w]] if form[w] else None))
    return out


def docs(spark, rows):
    return spark.createDataFrame(
        [(i, t, "w", 1, 2, True) for i, t in rows], "doc_id long, text string, word string, n int, wid int, gap boolean"
    )


def check_variants(spark, rows, **how):
    got = spelling.spelling_variants(docs(spark, rows), **how)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == variants(rows, **how)
    return got


def test_spelling_variants_equal_brute_force(spark):
    rng = random.Random(7)
    bases = ["".join(rng.choice("abÀß÷z") for _ in range(rng.randint(4, 9))) for _ in range(25)]
    rows = []
    for i in range(150):
        words = []
        for _ in range(30):
            w = list(rng.choice(bases))
            if rng.random() < 0.4:
                k = rng.randrange(len(w))
                w[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "bb", "É"])
            words.append("".join(w).upper() if rng.random() < 0.1 and "ß" not in w else "".join(w))
        rows.append((i % 40, rng.choice([" ", "-", "\n", "1"]).join(words)))
    got = check_variants(spark, rows, garble=7)
    assert sum(r[1] is not None for r in got) > 20


def test_runs_chains_and_odd_texts(spark):
    text = lambda w, n: " ".join([w] * n)
    long = "ab" * 4000
    rows = [
        (1, None), (2, ""), (3, "1 2 ..."), (None, text("aaaaa", 3)), (None, text("aaaaaa", 6)), (4, text("AAAAAAA", 12)),
        (5, text("abaaa", 24)), (5, text("baaaa", 24)), (6, text("aaaab", 23)), (7, text(long, 3)), (8, text(long + "a", 6)),
        (9, text("abcde", 3)), (9, text("abcdf", 6)), (9, text("abcdg", 6)), (10, text("ééééé", 3)), (10, text("éééée", 7)),
    ]
    got = {r[0]: r for r in check_variants(spark, rows)}
    assert got["aaaaa"][2] == "abaaa" and got["abcde"][1] == "abcdf" and got[long][1] == long + "a"
    check_variants(spark, rows, garble=1)
    assert spelling.spelling_variants(docs(spark, [])).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_variants(docs(spark, []), ratio=1)


# --- packing in order ------------------------------------------------------------------


def least_cost(places, penalties, size, window_cost):
    cost = [0.0]
    for j in range(1, len(places)):
        cost.append(
            penalties[j] + window_cost
            + min(cost[i] + ordered_packing.padding(places[j] - places[i], size) for i in range(j) if places[j] - places[i] <= size)
        )
    return cost[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 40), st.sampled_from([0.0, 3.0, 20.0])), min_size=1, max_size=60), st.sampled_from([16, 32, 48]))
def test_cuts_cost_least(steps, size):
    places, penalties = [], []
    for n, penalty in steps:
        places.append((places[-1] if places else 0) + n)
        penalties.append(penalty)
    places, penalties = ordered_packing.with_forced(places, penalties, size, 50.0)
    assert all(0 < b - a <= size for a, b in zip(places, places[1:]))
    cuts = ordered_packing.cheapest_cuts(places, penalties, size, 1.0)
    paid, before = 0.0, 0
    for c in cuts:
        assert c - before <= size
        paid += penalties[places.index(c)] + 1.0 + ordered_packing.padding(c - before, size)
        before = c
    assert before == places[-1]
    assert paid == pytest.approx(least_cost(places, penalties, size, 1.0))


PARTS = [*"ab s't re ve ll \n\téñÉßµª.!12²½\xa0\x85日本'Σİ́\x1c ", "<|endoftext|>", " the", "ing", "'re", "  ", "\n\n", "a. B", "<|end"]


def test_sentence_encoder_equals_the_library():
    e = ordered_packing.SentenceEncoder(BYTE_BPE)
    rng = random.Random(9)
    for _ in range(3000):
        t = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14)))
        ids, ends = e.encode(t)
        want = e.library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, t
        assert all(0 < x < len(want) for x in ends) and sorted(set(ends)) == list(ends)


def test_sentences_end_at_stops_and_line_breaks():
    e = ordered_packing.SentenceEncoder(BYTE_BPE)
    ids, ends = e.encode('It costs 3.14 now. "Really?" Yes!\nNew line')
    decode = lambda a, b: e.library.decode(np.frombuffer(ids, "<u4")[a:b].tolist())
    cuts = [0, *ends, len(ids) // 4]
    assert [decode(a, b) for a, b in zip(cuts, cuts[1:])] == ["It costs 3.14 now.", ' "Really?"', " Yes!", "\n", "New line"]


def test_packing_in_order(spark):
    rng = random.Random(11)
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b c"), (4, "a b c"), (None, "no id"), (None, None), (5, "wort " * 900)]
    for i in range(120):
        sentences = [" ".join("w" * rng.randint(1, 3) for _ in range(rng.randint(2, 9))) + "." for _ in range(rng.randint(0, 9))]
        rows.append((100 + i, " ".join(sentences)))
    df = spark.createDataFrame(
        [(i, t, 1, 2, "x") for i, t in rows], "doc_id long, text string, start int, length int, id string"
    ).coalesce(3)
    got = ordered_packing.pack_in_order(df, BYTE_BPE, size=64, line_tokens=500).collect()
    library = Tokenizer.from_file(BYTE_BPE)
    want = Counter((i, tuple([*library.encode(t or "", add_special_tokens=False).ids, 1])) for i, t in rows)
    ids_of = {}
    for i, ids in want:
        ids_of.setdefault(i, []).append(ids)
    by, covered = {}, Counter()
    for r in got:
        assert any(
            len(ids) == r["doc_tokens"] and zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"]
            for ids in ids_of[r["doc_id"]]
        )
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        covered[r["doc_id"], r["doc_tokens"]] += r["length"]
    assert covered == Counter({(i, len(ids)): 0 for i, ids in want}) + sum(
        (Counter({(i, len(ids)): n * len(ids)}) for (i, ids), n in want.items()), Counter()
    )
    padded = 0
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
        padded += ordered_packing.padding(at, 64)
    assert padded <= 0.15 * sum(r["length"] for r in got)
    assert ordered_packing.pack_in_order(df.limit(0), BYTE_BPE).count() == 0
