"""Personal data, language, toxicity, fingerprints and the pipeline."""

import bisect
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from scoreline.llm import fingerprints, language, pii, toxicity

ROWS = "doc_id long, text string, lang string, source string, n_chars long, score double, kind string, bucket int"


def docs(spark, rows):
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else None, "s", 0, 0.0, "k", 1) for r in rows], ROWS)


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(t):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, t or ""):
            d = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")),
                "card": 16 <= len(d) <= 19 and luhn(d),
                "phone": 8 <= len(d) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def test_entities_equal_the_patterns(spark):
    rng = random.Random(7)
    parts = [*"ab.@-+ ()0159_%\n😀é", "a@b.co", "1.2.3.4", "4111 1111 1111 1111", "4111111111111111", "+1 (386) 555-3733", "256.1.1.1", "..", "001.02.3.255"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))) for i in range(500)]
    rows += [(900, None), (901, ""), (902, "x@" + "a." * 20_000 + "b"), (903, "9" * 30_000), (904, "+1" + " " * 20_000 + "2345678"), (905, "a@b.cc" * 3000)]
    got = {r["doc_id"]: r for r in pii.pii_summary(docs(spark, rows)).collect()}
    for i, t in rows:
        spans = base_spans(t)
        shown = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert got[i]["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest(), (i, t and t[:200], shown[:200], got[i]["spans"][:200])
        assert [got[i][f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in spans) for k in PATTERNS]


def test_terms_that_reveal_an_entity(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = [(i, " ".join(word() for _ in range(30))) for i in range(200)]
    for i in range(200, 208):
        rows.append((i, " ".join([word(), "Xaverius", word(), "mail", "x.y@example.org", word(), "common", word()])))
    rows += [(i, f"{word()} common {word()} Xaverius? no: Xaveriusson") for i in range(208, 209)]
    rows += [(i, f"{word()} common {word()}") for i in range(209, 300)]
    # many copies of one passage tell nothing
    rows += [(i, "copied Unikum near z@example.org again") for i in range(300, 340)]
    got = {r["doc_id"]: r for r in pii.pii_summary(docs(spark, rows)).collect()}
    text = dict(rows)
    shown = {text[i][int(a) : int(b)] for i, r in got.items() for k, a, b in (s.split(":") for s in r["spans"].split(",") if s) if k == "term"}
    assert "Xaverius" in shown and "common" not in shown and "Unikum" not in shown and "Xaveriusson" not in shown
    assert got[208]["n_term"] == 1  # also where the entity itself isn't
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs(spark, [*rows, (999, None), (999, None)])).collect()}
    assert "x.y@" not in clean[200] and "[EMAIL]" in clean[200] and "Xaverius " not in clean[200]
    assert clean[0] == text[0] and clean[999] is None


def test_terms_of_an_entity_that_stands_once(spark):
    rng = random.Random(16)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    rows = [(i, " ".join(word() for _ in range(30))) for i in range(5000)]
    long = "Zebulon" * 30
    rows += [(9000, f"Quillfeather of 12 mail a@b.org, 77 1999, {long} {long} {long} Marwick q.v@example.org")]
    rows += [(9001, "Quillfeather was here")]
    got = {r["doc_id"]: r for r in pii.pii_summary(docs(spark, rows)).collect()}
    shown = {dict(rows)[9000][int(a) : int(b)] for k, a, b in (s.split(":") for s in got[9000]["spans"].split(",")) if k == "term"}
    # behind numbers, other addresses and long words, as whole words
    assert {"Marwick", long, "Quillfeather"} <= shown and got[9001]["n_term"] >= 1
    two = docs(spark, rows[-2:]).selectExpr("doc_id AS id", "text")
    near = [set(r["terms"]) for r in pii.contexts(two, pii.entities(two), 8).collect()]
    want = {"quillfeather", "mail", "org", long.lower(), "marwick", "example"}
    assert len(near) == 2 and all(v <= want for v in near) and want - {"example"} in near


def test_thresholds_do_not_move_with_the_corpus(spark):
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = [(i, " ".join(word() for _ in range(20))) for i in range(100)]
    rows += [(200, "Quillfeather Marwick: q.v@example.org"), (201, "Quillfeather was here"), (202, "Here too was once Quillfeathers"), (203, None)]
    rows += [(300 + i, f"Ashdown{i % 2} {word()} +1 386 555 3733 {word()}") for i in range(6)]
    rows += [(400 + i, f"Tenfold {word()}") for i in range(3)] + [(500, "Tenfold x@tenfold.org \u0301 Te\u0301nfold")]

    def terms(rows):
        got = pii.pii_spans(docs(spark, rows)).filter("kind = 'term'").collect()
        text = dict(rows)
        assert all(re.fullmatch("[^\\W\\d_]+", text[r["id"]][r["start"] : r["end"]].replace("\u0301", "")) for r in got)
        found = {(text[r["id"]][r["start"] : r["end"]], r["action"]) for r in got}
        return {(w, a) for w, a in found if w[0].isupper()}

    small = terms(rows)
    assert {("Quillfeather", "generalise"), ("Marwick", "generalise")} <= small
    assert ("Ashdown", "remove") in small and not {w for w, _ in small} & {"Tenfold", "Quillfeathers"}
    fresh = [(10_000 + i, " ".join(word() * 2 for _ in range(20))) for i in range(1000)]
    assert terms(rows + fresh) == small
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs(spark, rows)).collect()}
    assert clean[201] == "[EMAIL CONTEXT] was here" and clean[203] is None


def test_overlapping_spans_and_repeated_rows(spark):
    t = "call +1 (386) 555-3733, pay 4111 1111 1111 1111; from 1.2.3.4, me@x.org or +10.20.30.40"  # a phone that is an address too
    rows = [(1, t), (1, t), (None, t), (2, "plain")]
    clean = Counter((r["doc_id"], r["text"]) for r in pii.sanitise(docs(spark, rows)).collect())
    assert sum(n for (i, _), n in clean.items() if i == 1) == 2 and (2, "plain") in clean
    assert all(not re.search(r"\d", x) for (i, x) in clean if i != 2)
    got = pii.pii_summary(docs(spark, rows)).collect()
    assert Counter((r["doc_id"], r["n_ip"]) for r in got) == Counter({(1, 2): 2, (None, 2): 1, (2, 0): 1})
    assert pii.pii_summary(docs(spark, [])).count() == 0


LEXICON = {
    "en": "the of and to in that which weather house would".split(),
    "de": "der die und nicht wetter schön haus würde ich über".split(),
    "fr": "le la des et temps maison être où garçon très".split(),
    "es": "el los y tiempo casa año niño señor qué está".split(),
}


def spoken(n, seed):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice(LEXICON[v]) for _ in range(rng.randint(3, 40))), v) for i in range(n) for v in [rng.choice(list(LEXICON))]]


def test_languages_of_held_out_rows(spark):
    rows = spoken(600, 9) + [(1000, None, "en"), (1001, "12 34 !", "de"), (1002, "", None), (1003, "le temps des garçon", None), (None, "the house and weather", None)]
    got = language.language_id(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    held = [(i, v) for i, _, v in rows[:600] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(by[i]["held_out"] for i, _ in held)
    assert np.mean([by[i]["lang_pred"] == v for i, v in held]) > 0.97
    assert [by[i]["lang_pred"] for i in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "fr", "en"]
    assert all(0 <= r["score"] <= 1 for r in got)
    kept = language.keep_identified(docs(spark, rows))
    assert kept.columns == docs(spark, rows).columns
    assert {r["doc_id"] for r in kept.collect()} >= {i for i, _, _ in rows[:600]} | {1003}
    assert not {r["doc_id"] for r in kept.collect()} & {1000, 1001, 1002}


def test_language_without_labels_or_rows(spark):
    rows = [(1, "some text", None), (2, None, None)]
    assert {(r["lang_pred"], r["score"]) for r in language.language_id(docs(spark, rows)).collect()} == {("und", 0.0)}
    assert language.keep_identified(docs(spark, rows)).count() == 2
    assert language.language_id(docs(spark, [])).count() == 0
    one = [(i, f"text number {i}", "en") for i in range(20)]
    assert {r["lang_pred"] for r in language.language_id(docs(spark, one)).collect()} == {"en"}


def test_toxicity_of_held_out_rows(spark):
    rng = random.Random(10)
    plain = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    foul = "grumblik snarvox fletcharn zubbelwort krastipol".split()
    rows, labels = [], []
    for i in range(1500):
        w = [rng.choice(plain) for _ in range(rng.randint(20, 120))]
        bad = i % 4 == 0
        for _ in range(3 * bad):
            w.insert(rng.randrange(len(w)), rng.choice(foul))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    rows += [(2000, None), (2001, ""), (2002, rows[0][1]), (2002, rows[0][1])]
    labels += [(1, 1, None), (5000, 0, 1), (None, 0, 1), (2000, 1, 0)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs(spark, rows), table).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    held = [r for r in got if r["doc_id"] < 1500 and r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in range(1500) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r["predicted"] == (r["doc_id"] % 4 == 0) for r in held]) > 0.9
    none = spark.createDataFrame([], table.schema)
    assert {r["score"] for r in toxicity.toxicity(docs(spark, rows[:3]), none).collect()} == {0.0}
    assert toxicity.toxicity(docs(spark, []), table).count() == 0


def test_toxicity_means_the_same_when_labels_are_cut(spark):
    rng = random.Random(15)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 7)))
    rows = [(i, " ".join(word() for _ in range(30))) for i in range(1500)]
    table = spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i in range(1500)], "doc_id long, quality int, toxic int")
    # nothing in these texts tells the labels, so scores are the share of the label
    cut = toxicity.toxicity(docs(spark, rows), table, per_label=100).collect()
    assert 0.04 < np.mean([r["score"] for r in cut]) < 0.2
    assert np.mean([r["predicted"] for r in cut]) < 0.05


def entropy_bins(t):
    out = []
    for i in range(len(t) - fingerprints.SIZE + 1):
        counts = Counter(t[i : i + fingerprints.SIZE]).values()
        total = sum(int(fingerprints._SCALED[c]) for c in counts)
        out.append((fingerprints.MOST - total) * (fingerprints.BINS - 1) // fingerprints.MOST)
    return out


def test_entropies_equal_a_count_of_each_window():
    rng = random.Random(11)
    raw = [bytes(rng.choice(b"abc de\xc3\xa9") for _ in range(n)) for n in (0, 5, 100, 72, 300, 71)]
    j = fingerprints.Joined(raw)
    text, at = j.places()
    bins = j.entropies(at)
    for k, t in enumerate(raw):
        assert bins[text == k].tolist() == (entropy_bins(t) if len(t) >= fingerprints.SHORT else [])


def test_fingerprints_and_their_neighbours(spark):
    rng = random.Random(12)
    body = lambda n: " ".join("".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(2, 8))) for _ in range(n))
    rows = [(i, body(rng.randint(1, 400))) for i in range(1, 60)] + [(70, None), (71, ""), (72, body(30)), (72, body(30)), (None, "last")]
    rows += [(80, rows[3][1]), (81, "long " * 40_000)]
    got = fingerprints.fingerprints(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {}
    for i, t in rows:
        by.setdefault(i, []).append(t or "")
    order = sorted((i for i in by if i is not None and i != 72), reverse=True)
    res = {r["doc_id"]: r for r in got if r["doc_id"] != 72}
    for i, nxt in zip(order, order[1:]):
        if 72 in (i, nxt) or (i > 72 > nxt):
            continue
        t, u = by[i][0], by[nxt][0]
        k = len(t) // 3
        want = t[: len(t) - k] + u[:k]
        assert res[i]["n_chars"] == len(t) and res[i]["edited_sha256"] == hashlib.sha256(want.encode()).hexdigest(), i
    assert res[None]["edited_sha256"] == hashlib.sha256(("las" + ("long " * 40_000)[:1]).encode()).hexdigest()  # after the last the first
    assert res[80]["fingerprint"] == res[4]["fingerprint"] and res[70]["fingerprint"] == ""
    long = [r for r in got if 500 < r["n_chars"] < 10_000]
    assert min(r["near_edited"] for r in long) > 0.4 and max(r["near_next"] for r in long) < 0.3
    one = fingerprints.fingerprints(docs(spark, [(1, "alone " * 30)])).collect()
    assert one[0]["near_next"] == 1.0
    assert fingerprints.fingerprints(docs(spark, [])).count() == 0


def test_hot_ids_and_rows_are_spread(spark):
    rng = random.Random(31)
    rows = [(i, f"text {rng.random()} " * 12) for i in range(300)]
    rows += [(None, f"no id {rng.random()} " * 12) for _ in range(300)]  # a third without an id
    rows += [(None, None)] * 200 + [(7, "the same row " * 9)] * 100
    df = docs(spark, rows).repartition(6)
    got = fingerprints.fingerprints(df).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    order = sorted(
        ((i is None, -(i or 0), h, t or "") for (i, t), (h,) in zip(rows, docs(spark, rows).selectExpr("xxhash64(text)").collect())),
    )
    want = Counter()
    for (none, down, _, t), (_, _, _, u) in zip(order, order[1:] + order[:1]):
        k = len(t) // 3
        want[None if none else -down, len(t), hashlib.sha256((t[: len(t) - k] + u[:k]).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want
    # buckets: no task has more than twice the median
    texts = df.selectExpr("doc_id AS id", "text")
    tops = fingerprints.first_places(texts)
    places = sorted({fingerprints.place(r["id"], r["h"]) for r in texts.selectExpr("id", "xxhash64(text) AS h").collect()})
    sizes = sorted(Counter(bisect.bisect_right(tops, p) for p in places).values())
    assert len(sizes) >= 6 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_features_and_likeness_by_definition():
    rng = random.Random(32)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(n)).encode() for n in (0, 5, 60, 300, 3000)]
    rank = np.random.default_rng(3).permutation(fingerprints.BINS)
    found = fingerprints.digests(texts, rank)
    one, other = found[4], fingerprints.digests([texts[4][:2000] + texts[3]], rank)[0]
    for d in found:
        assert len(d.counts) == len(d.filters) and (d.counts[:-1] == fingerprints.PER_FILTER).all()
        assert (d.filters.sum(1) <= fingerprints.PROBES * d.counts).all()

    def best(f, others):
        scores = [0.0]
        for g in others:
            chance = f.sum() * g.sum() / fingerprints.BITS
            room = min(f.sum(), g.sum()) - chance
            scores.append(max(0.0, min(1.0, ((f & g).sum() - chance) / max(room, 1e-9))))
        return max(scores)

    def by_definition(a, b):
        way = lambda x, y: sum(n * best(f, y.filters) for n, f in zip(x.counts, x.filters)) / x.counts.sum()
        if len(a.counts) == len(b.counts):
            return (way(a, b) + way(b, a)) / 2
        return way(a, b) if len(a.counts) < len(b.counts) else way(b, a)

    for a, b in ((one, other), (one, found[3]), (found[3], found[2])):
        assert fingerprints.likeness(a, b) == pytest.approx(by_definition(a, b), abs=1e-5)
    assert fingerprints.likeness(one, one) == pytest.approx(1.0) and fingerprints.likeness(found[0], found[0]) == 1.0
    assert fingerprints.likeness(found[0], one) == 0.0


def test_pipeline_stages_keep_columns_and_chain(spark, tmp_path):
    rng = random.Random(13)
    rows = [(i, t, v) for i, t, v in spoken(120, 14)]
    rows = [(i, t + "\n" + " ".join(rng.choice(LEXICON[v]) for _ in range(30)), v) for i, t, v in rows]
    rows += [(500, None, "en"), (501, rows[0][1], "en"), (502, "12 34", "en"), (503, rows[1][1] + "\n" + rows[0][1].split("\n")[0], rows[1][2])]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, rows[5][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    table, sizes = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, table, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        if k < 4:
            assert out.columns == docs(spark, rows).columns
            table = out
        sizes.append({r["doc_id"] for r in out.collect()})
    assert not sizes[0] & {500, 502}
    assert 501 in sizes[0] and 501 not in sizes[1]  # all its lines stand in document 0
    assert 5 in sizes[2] and 5 not in sizes[3]  # a benchmark item
    assert sizes[4] == sizes[3]
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in run.collect()} == sizes[4]


