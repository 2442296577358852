"""Near duplicates, repeated lines and benchmark leaks against brute force."""

import math
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scoreline.llm import decontaminate, line_dedup, near_dup
from scoreline.llm.common import components

ROWS = "doc_id long, text string, cid long, th long, n int, line string, h long, row string"
WORDS = [f"w{i}" for i in range(400)]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 0, 0, 0, "l", 0, "r") for i, t in rows], ROWS)


def shingles(t):
    low = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def linked_components(rows, percent):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    groups = {}
    for x in range(len(rows)):
        groups.setdefault(find(x), []).append(x)
    return list(groups.values())


def family_rows(seed):
    """Families of edited copies around the threshold, exact copies, short, blank and null texts."""
    rng = random.Random(seed)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO"), (6, "one"), (7, None)]
    for f in range(6):
        base = [rng.choice(WORDS) for _ in range(60)]
        for _ in range(25):
            t = list(base)
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = rng.choice(WORDS)
            rows.append((rng.randrange(10_000) * 7 + 10, " ".join(t)))
        rows += [(20_000 * 7 + f * 50 + k, " ".join(base)) for k in range(20)]
    rows = list({i: (i, t) for i, t in rows}.values())
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("percent,block", [(85, 1024), (80, 8)])
def test_components_equal_brute_force(spark, percent, block):
    rows = family_rows(percent)
    got = {r["doc_id"]: r for r in near_dup.near_duplicates(docs(spark, rows), percent=percent, block=block).collect()}
    for group in linked_components(rows, percent):
        least = min(rows[x][0] for x in group)
        for x in group:
            r = got[rows[x][0]]
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(shingles(rows[x][1])), least, rows[x][0] == least)


def test_near_duplicate_edge_rows(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (5, "quite another text"), (3, "A b c d e F"), (None, "a b c d e f"), (9, None), (9, None)]
    got = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in near_dup.near_duplicates(docs(spark, rows)).collect())
    assert got == Counter({(5, 3, False): 2, (5, 5, True): 1, (3, 3, True): 1, (None, 3, False): 1, (9, 9, True): 2})
    kept = near_dup.drop_near_duplicates(docs(spark, rows))
    assert kept.columns == docs(spark, rows).columns
    want = Counter([(5, "quite another text"), (3, "A b c d e F"), (9, None), (9, None)])
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == want
    twice = near_dup.drop_near_duplicates(docs(spark, [(1, "x y"), (1, "x y"), (2, "x y")])).collect()
    assert [(r["doc_id"], r["text"]) for r in twice] == [(1, "x y")]
    assert near_dup.near_duplicates(docs(spark, [])).count() == 0
    assert near_dup.drop_near_duplicates(docs(spark, [])).count() == 0


def test_near_copies_with_null_ids(spark):
    rng = random.Random(14)
    base = [f"v{i}" for i in range(60)]
    alter = lambda *at: " ".join(f"q{i}" if i in at else w for i, w in enumerate(base))
    other = [rng.choice(WORDS) for _ in range(60)]
    # 1 and 2 are linked by null ids only; two near copies without any id; one id of two texts
    rows = [(1, alter(0, 1)), (None, alter(0)), (None, alter(59)), (2, alter(58, 59)), (2, "quite another text of id two")]
    rows += [(None, " ".join(other)), (None, " ".join([*other[:-1], "end"]))]
    assert sorted(map(len, linked_components(rows, 92))) == [1, 2, 4]
    got = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in near_dup.near_duplicates(docs(spark, rows), percent=92).collect())
    assert got == Counter({(1, 1, True): 1, (None, 1, False): 2, (2, 1, False): 1, (2, 2, True): 1, (None, None, True): 2})
    kept = near_dup.drop_near_duplicates(docs(spark, rows), percent=92).collect()
    assert Counter(r["doc_id"] for r in kept) == Counter({1: 1, 2: 1, None: 1})


def test_text_hash_is_sparks(spark):
    rows = docs(spark, [(1, None), (2, ""), (3, "é" * 100)]).select(F.col("doc_id").alias("id"), "text")
    own = {r["id"]: r["th"] for r in near_dup.shingle_classes(rows, 5).collect()}
    assert own == {r["id"]: r["th"] for r in rows.select("id", F.xxhash64("text").alias("th")).collect()}


def test_components_of_a_path_a_star_and_a_cycle(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long"), "t").collect())
    assert got == {i: 1 for i in range(1, 41)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def test_lines_equal_brute_force(spark):
    rng = random.Random(4)
    base = ["".join(rng.choice("abé \U0001f600") for _ in range(n)) for n in (3, 15, 16, 17, 40, 80)] + ["aaaaaaaaaaaaaaaaaaaa"]
    rows = [(0, None), (1, ""), (2, "\n\n")]
    for i in range(3, 90):
        lines = []
        for _ in range(rng.randint(1, 6)):
            x = list(rng.choice(base))
            for _ in range(rng.randint(0, 2)):
                p = rng.randrange(len(x) + 1)
                x[p : p + rng.randint(0, 1)] = rng.choice(["", "a", "b"])
            lines.append("".join(x))
        rows.append((i, "\n".join(lines)))
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs(spark, rows)).collect()}
    seen = []
    for i, t in rows:
        stay, exact, near = [], 0, 0
        for x in t.split("\n") if t is not None else []:
            if x.strip(" ") == "":
                stay.append(x)
                continue
            if x in seen:
                exact += 1
            elif len(x) >= 16 and any(len(y) >= 16 and within_one(x, y) for y in seen):
                near += 1
            else:
                stay.append(x)
            seen.append(x)
        assert got[i]["text"] == (None if t is None else "\n".join(stay)), i
        assert (got[i]["line_counts"]["exact"], got[i]["line_counts"]["near"]) == (exact, near)


def test_line_edge_rows(spark):
    rows = [(2, "same line\nsame line"), (2, "same line\nsame line"), (None, "same line"), (3, "own")]
    out = line_dedup.dedup_lines(docs(spark, rows))
    assert out.columns == [*docs(spark, rows).columns, "line_counts"]
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter({(2, ""): 2, (None, "same line"): 1, (3, "own"): 1})
    assert line_dedup.dedup_lines(docs(spark, [])).count() == 0


def windows_brute(rows, bench):
    grams = lambda t, k: [tuple(w[i : i + k]) for w in [(t or "").lower().split()] for i in range(len(w) - k + 1)]
    items = {i: grams(t, min(5, len(t.split()))) for i, t in bench if t and t.split()}
    df = Counter(g for s in items.values() for g in set(s))
    weigh = lambda g: 1 + math.log((len(items) + 1) / (df[g] + 1))
    found = {}
    for d, t in rows:
        for i, item in items.items():
            own, m = grams(t, len(item[0])), len(item)
            for a in range(1 - m, len(own)):
                win = set(own[max(0, a) : a + m])
                if win & set(item):
                    s = sum(map(weigh, win & set(item))) / sum(map(weigh, win | set(item)))
                    found[d, i] = max(found.get((d, i), 0), s)
    return found


def test_leaks_equal_brute_force(spark):
    rng = random.Random(5)
    word = lambda: rng.choice(WORDS)
    bench = [(i, " ".join(word() for _ in range(rng.randint(8, 40)))) for i in range(30)]
    bench += [(100, "only three words"), (101, None), (102, "  "), (103, bench[0][1])]
    rows = [(1, None), (2, ""), (3, "Only THREE words"), (4, "has only three words inside")]
    for d in range(10, 120):
        body = [word() for _ in range(rng.randint(5, 120))]
        if d % 2:
            leak = rng.choice(bench[:30])[1].split()
            for _ in range(rng.choice([0, 0, 1, 2, 8])):
                leak[rng.randrange(len(leak))] = word()
            at = rng.randrange(len(body) + 1)
            body[at:at] = leak
        rows.append((d, " ".join(body).upper() if d % 3 else "\n".join(body)))
    rows.append((11, rows[5][1]))
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = {(r["id"], r["item"]): r["similarity"] for r in decontaminate.find_leaks(docs(spark, rows), items).collect()}
    want = windows_brute(rows, bench)
    assert {k for k, s in want.items() if s >= 0.86} <= set(got)
    assert all(want[k] >= s - 1e-6 and s >= 0.8 for k, s in got.items())
    assert (3, 100) in got and (4, 100) in got
    clean = decontaminate.drop_leaking(docs(spark, rows), items)
    assert clean.columns == docs(spark, rows).columns
    assert {r["doc_id"] for r in clean.collect()} >= {1, 2} and 3 not in {r["doc_id"] for r in clean.collect()}
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.drop_leaking(docs(spark, rows), none).count() == len(rows)
    assert decontaminate.find_leaks(docs(spark, []), items).count() == 0


def test_leaks_just_above_the_threshold(spark):
    rng = random.Random(12)
    bench, rows, similar = [], [], {}
    for i in range(200):
        m = (48, 50, 52, 54)[i % 4]  # even numbers of shingles of one weight: votes of none
        item = [f"x{rng.getrandbits(40)}" for _ in range(m + 4)]
        bench.append((i, " ".join(item)))
        item[rng.randrange(8, m - 8)] = f"y{i}"  # touches five shingles
        rows.append((i, " ".join([f"z{rng.getrandbits(40)}" for _ in range(6)] + item)))
        own, new = 1 + math.log(201 / 2), 1 + math.log(201)
        similar[i, i] = (m - 5) * own / (m * own + 5 * new)
    assert 0.8 <= min(similar.values()) and max(similar.values()) < 0.823
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = {(r["id"], r["item"]): r["similarity"] for r in decontaminate.find_leaks(docs(spark, rows), items).collect()}
    assert set(got) == set(similar)
    assert all(abs(got[k] - s) < 1e-6 for k, s in similar.items())


def test_items_of_one_id_or_none(spark):
    rng = random.Random(13)
    text = [" ".join(rng.choice(WORDS) for _ in range(20)) for _ in range(5)]
    # two texts of one id and of one length, null ids with texts, one text under two ids
    bench = [(1, text[0]), (1, text[1]), (None, text[2]), (None, text[3]), (7, text[4]), (8, text[4])]
    rows = [(i, f"before {t} after") for i, t in enumerate(text)] + [(9, "nothing of these")]
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = Counter((r["id"], r["item"]) for r in decontaminate.find_leaks(docs(spark, rows), items).collect())
    assert got == Counter([(0, 1), (1, 1), (2, None), (3, None), (4, 7), (4, 8)])
    assert [r["doc_id"] for r in decontaminate.drop_leaking(docs(spark, rows), items).collect()] == [9]


def test_blocks_list_every_hash_within_the_radius(spark):
    rng = random.Random(6)
    pairs = []
    for _ in range(200):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randint(0, 17)):
            y ^= 1 << b
        pairs.append(tuple(v - (1 << 64) if v >> 63 else v for v in (x, y)))
    df = spark.createDataFrame(pairs, "x long, y long")
    own = F.array(*(F.struct(F.lit(b).alias("block"), v.alias("value")) for b, v in enumerate(decontaminate.blocks(F.col("y")))))
    met = df.select(F.size(F.array_intersect(decontaminate.listed(F.col("x"), 17), own)).alias("n")).collect()
    assert min(r["n"] for r in met) > 0


def test_work_is_linear_in_the_hits_of_one_text(spark):
    item = " ".join(["ha"] * 150)
    rows = [(1, "ha " * 16_000), (2, "ha " * 149 + "end"), (3, "other words only here"), (4, ("ha " * 200 + "so ") * 60)]
    took = time.time()
    got = decontaminate.find_leaks(docs(spark, rows), spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert time.time() - took < 120
    assert {(r["id"], r["item"], r["word_start"], r["n_words"], r["similarity"]) for r in got} == {
        (1, 7, 0, 150, 1.0), (4, 7, 0, 150, 1.0),
    } | {(r["id"], 7, r["word_start"], r["n_words"], r["similarity"]) for r in got if r["id"] == 2}
