"""Tokens, packing and shards: against the library, brute force and their own invariants."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from scoreline.llm import packing, shards, tokens

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PARTS = [*"ab s't re ve ll \n\téñÉßµª.!12²½\xa0\x85日本'Σİ́\x1c ", "<|endoftext|>", " the", "ing", "'re", "  ", "\n\n", " 're", "<|end"]
ROWS = "doc_id long, text string, lang string, source string, n_chars long, size long, id string, piece int, length int"


def docs(spark, rows):
    """Documents with extra columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "s", None, 1, "x", 2, 3) for i, t in rows], ROWS)


EDGES = [(1, None), (2, ""), (3, " \n"), (4, "a b c"), (4, "a b c"), (4, "other text"), (None, "no id"), (5, "wort " * 9000)]


def texts(n, seed, most=14):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, most))) for _ in range(n)]


def test_prefix_counts_equal_the_library_at_every_prefix():
    c = tokens.PrefixCounter(BYTE_BPE)
    for t in texts(300, 1):
        want = [len(c.library.encode(t[:i], add_special_tokens=False).ids) for i in range(len(t) + 1)]
        assert c.prefixes(t).tolist() == want, t
    long = "x" * 3000 + " " * 3000 + "word " * 500
    assert c.prefixes(long)[-1] == len(c.library.encode(long, add_special_tokens=False).ids)


def test_longest_prefix_answers_budgets():
    c = tokens.PrefixCounter(BYTE_BPE)
    for t in texts(40, 2, 40):
        p = c.prefixes(t)
        for budget in (0, 1, 5, 100):
            fits = [i for i in range(len(t) + 1) if len(c.library.encode(t[:i], add_special_tokens=False).ids) <= budget]
            assert tokens.longest_prefix(p, budget) == max(fits)


def test_token_counts_of_edge_rows(spark):
    got = tokens.token_counts(docs(spark, EDGES), BYTE_BPE, limit=4).collect()
    library = Tokenizer.from_file(BYTE_BPE)
    want = Counter((i, len((t or "").encode()), len(library.encode(t or "").ids)) for i, t in EDGES)
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 4) for r in got)
    table = tokens.token_prefixes(docs(spark, EDGES[:5]), BYTE_BPE).collect()
    assert {len(r["prefix_tokens"]) for r in table} == {1, 3, 6}
    assert tokens.token_counts(docs(spark, []), BYTE_BPE).count() == 0


def test_encoder_equals_the_library():
    e = packing.Encoder(WORD_BPE, most=50)  # so small that it forgets
    for t in texts(600, 3):
        assert np.frombuffer(e.encode([t])[0], "<u4").tolist() == e.library.encode(t, add_special_tokens=False).ids, t


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), min_size=1, max_size=30))
def test_plan_packs_everything_once_within_bounds(counts):
    plan = packing.plan_bins(counts, 64)
    used = Counter()
    for filling, times in plan:
        assert 0 < sum(filling) <= 64 and times > 0
        for x in filling:
            used[x] += times
    assert used == Counter(counts)
    assert len(plan) <= 64
    total = sum(x * n for x, n in counts.items())
    assert sum(t for _, t in plan) <= 2 * total / 64 + 1


def test_two_that_fit_tighter_replace_the_smallest():
    # greedy: 6 then 3, one left over; 2 + 2 fill the gap that 3 leaves
    assert packing.plan_bins({6: 1, 3: 1, 2: 2}, 10)[0] == ([6, 2, 2], 1)


def test_packed_pieces(spark):
    rows = [*EDGES, *((100 + i, "w " * (7 * i % 90)) for i in range(80))]
    got = packing.pack(docs(spark, rows), WORD_BPE, size=100, salts=4).collect()
    library = Tokenizer.from_file(WORD_BPE)
    want = Counter()
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 100):
            part = np.array(ids[k : k + 100], "<u4")
            want[i, k // 100, k, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 100
    assert len(by) <= sum(r["length"] for r in got) / 100 * 1.1 + 1
    assert packing.pack(docs(spark, []), WORD_BPE).count() == 0


@pytest.mark.parametrize("n", [1, 3, 24])
def test_shards_are_contiguous_and_balanced(spark, n):
    rows = [*EDGES, *((10 + i, "é" * (i * 37 % 400)) for i in range(300)), *((999, "hot") for _ in range(150))]
    got = shards.byte_shards(docs(spark, rows), n_shards=n).collect()
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r)
    assert set(by) <= set(range(n))
    largest, mean = max(r["size"] for r in got), sum(r["size"] for r in got) / n
    last = -1
    for s in sorted(by):
        assert sorted(r["slot"] for r in by[s]) == list(range(len(by[s])))
        ids = [(-1 if r["doc_id"] is None else r["doc_id"]) for r in sorted(by[s], key=lambda r: r["slot"])]
        assert ids == sorted(ids) and ids[0] >= last
        last = ids[-1]
        assert abs(sum(r["size"] for r in by[s]) - mean) <= largest
    assert shards.byte_shards(docs(spark, [])).count() == 0
