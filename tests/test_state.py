"""What is kept between batches: stream state and filters, bucketed tables, incremental standings, ranks by ranges, landing folders."""

import datetime as dt
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from scoreline.operators import membership, scd2, silver, standings
from scoreline.schemas import EVENTS
from scoreline.session import scratch_path
from scoreline.sources import events as events_src
from scoreline.sources import files, landing
from scoreline.sources.buckets import DEALT, Buckets
from scoreline.sources.io import Tables, batch_ids, path_exists, read_batches, write_batch
from scoreline.streaming import events as stream_events
from scoreline.streaming import progress
from scoreline.streaming import standings as stream_standings

DAY = dt.datetime(2024, 1, 1)


def event(i, day, player="p", kind="goal"):
    return (i, "A", "B", None, "A", player, kind, 1, DAY + dt.timedelta(days=day) if day is not None else None)


# --- membership --------------------------------------------------------------------


def test_filters_find_every_key_and_few_others(spark):
    root = scratch_path(spark, "t-filters")
    held = {0: [f"a{i}" for i in range(3000)] + [None], 1: [f"b{i}" for i in range(40)], 2: ["a7"], 3: []}
    for b, ids in held.items():
        df = spark.createDataFrame([(i,) for i in ids], "event_id string")
        write_batch(membership.build(df, "event_id", len(ids)), root, b)
    index = read_batches(spark, root, stream_events.INDEX_SCHEMA)
    assert index.filter("length(bitmap) <> 4096").count() == 0
    asked = ["a7", "a2999", "b3", None] + [f"x{i}" for i in range(2000)]
    keys = spark.createDataFrame([(i,) for i in asked], "event_id string")
    got = {(r["event_id"], r["batch_id"]) for r in membership.may_hold(index, keys, "event_id").collect()}
    want = {(k, b) for k in asked for b, ids in held.items() if k in ids}
    assert want <= got and len(got - want) <= 10
    assert membership.may_hold(index.limit(0), keys, "event_id").count() == 0
    assert membership.filter_bits(1) == 32_768 and membership.filter_bits(100_000) == 4_194_304


# --- event stream --------------------------------------------------------------------


def deliver(spark, root, rows, **how):
    events_src.write_events(spark.createDataFrame(rows, EVENTS), f"{root}/in")
    stream_events.land_events(spark, f"{root}/in", f"{root}/bronze", f"{root}/ck/l")
    stream_events.silver_events(spark, f"{root}/bronze", f"{root}/silver", f"{root}/ck/s", **how)


def silver_ids(spark, root):
    return sorted(r["event_id"] for r in stream_events.read_silver(spark, f"{root}/silver").collect())


def test_stored_events_are_read_for_late_deliveries_only(spark, monkeypatch):
    root, read = scratch_path(spark, "t-state"), []
    real = stream_events.candidate_batches
    monkeypatch.setattr(stream_events, "candidate_batches", lambda *a: read.append(real(*a)) or read[-1])
    deliver(spark, root, [event("e1", 0), event("e2", 0)])
    deliver(spark, root, [event("e3", 1), event("e2", 0)])  # a repeat that the state store knows
    deliver(spark, root, [event("e4", 30)])
    deliver(spark, root, [event("e5", 31)])
    assert read == [] and silver_ids(spark, root) == ["e1", "e2", "e3", "e4", "e5"]
    before = batch_ids(spark, f"{root}/silver")
    # a repeat and a first delivery, both too late for the store: only the batch that holds the repeat is read
    deliver(spark, root, [event("e1", 0), event("e0", 0), event("e5", 31), event("e6", 31)])
    assert silver_ids(spark, root) == ["e0", "e1", "e2", "e3", "e4", "e5", "e6"]
    assert len(read) == 1 and len(read[0]) == 1 and len(before) >= 4
    held = read_batches(spark, f"{root}/silver", EVENTS, read[0])
    assert "e1" in [r["event_id"] for r in held.collect()]
    assert path_exists(spark, f"{root}/ck/s/state/0/0")


def test_ids_are_not_sent_to_the_driver(spark, capsys):
    root = scratch_path(spark, "t-settle")
    rows = spark.createDataFrame([event("e1", 0), event("e2", 9), event("e3", 9)], EVENTS)
    write_batch(rows.limit(1), f"{root}/silver", 0)
    new, _ = stream_events.settle(rows, rows.select("event_id"), f"{root}/silver", 1, "2 days")
    assert sorted(r["event_id"] for r in new.collect()) == ["e2", "e3"]
    new.explain("simple")
    assert "Broadcast" not in capsys.readouterr().out


def test_a_dealt_batch_is_shuffled_once(spark, capsys):
    tables = Tables(spark, scratch_path(spark, "t-dealt"))
    store = Buckets(tables, "matches", ["home_team", "away_team"], 4)
    shape = "home_team string, away_team string, home_score int, away_score int, group string, matchday int, status string, ingested_at timestamp_ntz"
    rows = spark.createDataFrame(
        [("A", "B", 1, 0, "G", m, "finished", DAY) for m in (1, 1, 2, None)] + [(None, "B", 1, 0, "G", 1, "finished", DAY)], shape
    )
    plain = silver.matches(rows)
    dealt = silver.matches(store.dealt(rows), None, DEALT)
    assert sorted(map(str, dealt.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    dealt.explain("simple")
    out = capsys.readouterr().out.split("Initial Plan")[0]
    assert out.count("Exchange hashpartitioning") == out.count("REPARTITION_BY_COL") > 0  # by bucket and part only
    store.upsert(rows, 0, lambda old, new: silver.matches(store.dealt(new), None, DEALT), plain.schema)
    stored = store.read(plain.schema).select(*plain.columns)
    assert sorted(map(str, stored.collect())) == sorted(map(str, plain.collect()))


def test_restamped_and_unstamped_deliveries(spark):
    root = scratch_path(spark, "t-restamped")
    deliver(spark, root, [event("e1", 0), event("e1", 1), event("e2", None), event(None, 0)], restamped=True)
    deliver(spark, root, [event("e9", 40)], restamped=True)
    deliver(spark, root, [event("e1", 41), event("e2", 41), event("e2", None), event(None, 41), event("e3", 41)], restamped=True)
    rows = stream_events.read_silver(spark, f"{root}/silver").collect()
    assert sorted((r["event_id"] or "", r["ingested_at"] and (r["ingested_at"] - DAY).days) for r in rows) == [
        ("", 0), ("e1", 0), ("e2", None), ("e3", 41), ("e9", 40),
    ]


def test_totals_are_compacted(spark):
    root = scratch_path(spark, "t-compact")
    for b in range(5):
        rows = [event(f"{b}-{k}", b, player=f"p{k % 2}") for k in range(3)]
        write_batch(spark.createDataFrame(rows, EVENTS), f"{root}/silver", b)
        assert stream_events.top_scorers(spark, f"{root}/silver", f"{root}/gold", compact_every=2) == [b]
        # a reader adds up the totals and at most one entry
        assert len(stream_events.since_compacted(spark, f"{root}/gold")) < 2
        got = {(r["player"], r["goals"]) for r in stream_events.read_top_scorers(spark, f"{root}/gold").collect()}
        assert got == {("p0", 2 * (b + 1)), ("p1", b + 1)}
    assert batch_ids(spark, stream_events.compact_path(f"{root}/gold")) == [1, 3]
    assert stream_events.top_scorers(spark, f"{root}/silver", f"{root}/gold", compact_every=2) == []


# --- bucketed tables -----------------------------------------------------------------


def newest(old, new):
    return silver.events(old.unionByName(new))


def test_a_batch_rewrites_the_buckets_it_touches(spark):
    tables = Tables(spark, scratch_path(spark, "t-buckets"))
    store = Buckets(tables, "events", ["event_id"], 8)
    rows = lambda *r: spark.createDataFrame(list(r), EVENTS)
    state = lambda: sorted((r["event_id"], (r["ingested_at"] - DAY).days) for r in tables.read("events").collect())
    first = store.upsert(rows(*[event(f"e{i}", 0) for i in range(60)]), 0, newest, EVENTS)
    assert first == set(range(8)) and len(state()) == 60
    assert len(store.upsert(rows(event("e7", 1)), 1, newest, EVENTS)) == 1
    changed = [b for b, f in store.folders().items() if "version=000000000001" in f]
    assert len(changed) == 1 and len(store.folders()) == 8
    want = sorted([(f"e{i}", 1 if i == 7 else 0) for i in range(60)])
    assert state() == want
    store.upsert(rows(event("e7", 1)), 1, newest, EVENTS)  # run again
    assert state() == want
    # a version that died before its commit, and a batch of nothing
    died = tables.path("events") + "/version=000000000002/bucket=3"
    rows(event("zz", 5)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(died)
    assert state() == want
    assert store.upsert(rows(event("x", 1)).limit(0), 2, newest, EVENTS) == set() and state() == want
    store.upsert(rows(event("e7", 2)), 3, newest, EVENTS)
    assert store.retain(before=3) == 1  # the bucket of version 0 that version 1 replaced
    assert state() == sorted([(f"e{i}", 2 if i == 7 else 0) for i in range(60)])
    assert tables.exists("events")


# --- incremental standings -------------------------------------------------------------

MATCH = (
    "home_team string, away_team string, home_score int, away_score int, group string, matchday int, "
    "stadium string, status string, score string, ingested_at timestamp_ntz"
)


def random_match(rng, day):
    played = rng.random() < 0.7
    score = lambda: rng.choice([0, 1, 2, 3, None]) if played else None
    status = rng.choice(["finished", "finished", "finished", "scheduled", None]) if played else "scheduled"
    home, away = rng.sample(["T1", "T2", "T3", "T4", "T5", None], 2)
    return (
        home, away, score(), score(), rng.choice(["G1", "G2", "G3", None]), rng.choice([1, 2, 3, None]), "S", status, None,
        DAY + dt.timedelta(days=day, minutes=rng.randrange(1000)),
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_incremental_standings_equal_a_full_computation(spark, seed):
    rng = random.Random(seed)
    tables = Tables(spark, scratch_path(spark, "t-deltas"))
    run, everything = stream_standings.refresh(tables, buckets=4), None
    key = lambda r: str(tuple(r))
    for batch in range(4):
        # later batches correct, move and take back matches of earlier ones
        rows = [random_match(rng, rng.choice([batch, batch, 0])) for _ in range(25 if batch != 2 else 1)]
        df = spark.createDataFrame(rows, MATCH)
        run(df, batch)
        everything = df if everything is None else everything.unionByName(df)
        stored = stream_standings.silver_matches(tables, df.schema, buckets=4)
        full = standings.compute(stored).select(*standings.STANDINGS_COLUMNS)
        assert sorted(stream_standings.current(tables).collect(), key=key) == sorted(full.collect(), key=key)
        open_now = tables.read("stream_metrics").filter(F.col("batch_id") == batch).first()
        assert open_now["open_matches"] == stored.filter("status <> 'finished' OR status IS NULL").count()
    with_day = stored.filter("matchday IS NOT NULL")
    direct = silver.matches(everything.filter("matchday IS NOT NULL")).select(*with_day.columns)
    assert sorted(with_day.collect(), key=key) == sorted(direct.collect(), key=key)
    before = sorted(stream_standings.history(tables).collect(), key=key)
    run(df, 3)  # a replay
    assert sorted(stream_standings.history(tables).collect(), key=key) == before


def test_untouched_groups_keep_their_versions(spark):
    tables = Tables(spark, scratch_path(spark, "t-groups"))
    run = stream_standings.refresh(tables, buckets=4)
    match = lambda h, a, x, y, g, d: (h, a, x, y, g, d, "S", "finished", None, DAY + dt.timedelta(days=d))
    run(spark.createDataFrame([match("A", "B", 1, 0, "G", 1), match("C", "D", 1, 0, "H", 1)], MATCH), 0)
    run(spark.createDataFrame([match("B", "A", 2, 0, "G", 2)], MATCH), 1)
    counts = tables.read("stream_metrics").filter("batch_id = 1").first()
    assert (counts["unchanged"], counts["closed"], counts["inserted"]) == (2, 2, 2)
    now = {(r["team"], r["effective_from"].day) for r in scd2.current(tables.read("stream_standings")).collect()}
    assert now == {("A", 3), ("B", 3), ("C", 2), ("D", 2)}


def test_the_gate_stands_before_the_work(spark):
    tables = Tables(spark, scratch_path(spark, "t-gate"))
    run = stream_standings.refresh(tables, buckets=4, only_live=True)
    match = lambda d, status: ("A", "B", 1, 0, "G", d, "S", status, None, DAY + dt.timedelta(days=d))
    run(spark.createDataFrame([match(1, "finished")], MATCH), 0)
    assert tables.read("stream_bronze_matches").count() == 1 and not tables.exists("stream_standings")
    run(spark.createDataFrame([match(2, "live")], MATCH), 1)  # settles both
    assert {(r["team"], r["played"]) for r in stream_standings.current(tables).collect()} == {("A", 1), ("B", 1)}
    run(spark.createDataFrame([match(2, "finished")[:9] + (DAY + dt.timedelta(days=5),)], MATCH), 2)  # the open one ends
    assert {(r["team"], r["played"]) for r in stream_standings.current(tables).collect()} == {("A", 2), ("B", 2)}
    run(spark.createDataFrame([match(3, "finished")], MATCH), 3)
    assert {(r["team"], r["played"]) for r in stream_standings.current(tables).collect()} == {("A", 2), ("B", 2)}
    assert [r["settled"] for r in tables.read("stream_metrics").orderBy("batch_id").collect()] == [False, True, True, False]


def test_stored_matches_and_new_ones_are_merged_without_a_shuffle(spark, monkeypatch):
    built, rng, key = [], random.Random(5), lambda r: str(tuple(r))
    real = silver.matches
    monkeypatch.setattr(silver, "matches", lambda *a, **k: built.append(real(*a, **k)) or built[-1])
    # buckets by themselves, and each in parts
    monkeypatch.setattr(Buckets, "tasks", lambda self, sizes, bounds: [([b], p, 2) for b in sorted(sizes) for p in range(2)])
    tables = Tables(spark, scratch_path(spark, "t-merged"))
    run = stream_standings.refresh(tables, buckets=4)
    batches = [spark.createDataFrame([random_match(rng, day) for _ in range(40)], MATCH) for day in range(2)]
    for i, df in enumerate(batches):
        built.clear()
        run(df, i)
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in built[1:]]  # the first one is for its columns
    assert len(plans) == 8 and not any("Exchange" in p for p in plans)
    files = spark.read.parquet(tables.path("stream_silver_matches") + "/version=000000000001").selectExpr("_metadata.file_path f")
    assert files.distinct().count() > 4  # tasks of their own
    stored = stream_standings.silver_matches(tables, batches[0].schema, buckets=4).filter("matchday IS NOT NULL")
    direct = real(batches[0].unionByName(batches[1]).filter("matchday IS NOT NULL")).select(*stored.columns)
    assert sorted(stored.collect(), key=key) == sorted(direct.collect(), key=key)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_buckets_are_dealt_to_tasks_by_size(spark):
    store = Buckets(Tables(spark, scratch_path(spark, "t-tasks")), "matches", ["home_team"], 4)
    assert store.tasks({}) == []
    one, large = [([0], 0, 1), ([1, 2], 0, 1)], [([3], p, 3) for p in range(3)]
    assert sorted(store.tasks({0: 100, 1: 10, 2: 10, 3: 250}, (100, 100))) == sorted(one + large)


def test_bronze_that_began_without_buckets_goes_on_so(spark):
    tables = Tables(spark, scratch_path(spark, "t-flat"))
    match = lambda h, a, d: (h, a, 1, 0, "G", d, "S", "finished", None, DAY + dt.timedelta(days=d))
    tables.append_batch(spark.createDataFrame([match("A", "B", 1)], MATCH), "stream_bronze_matches", 0)  # landed, not settled
    run = stream_standings.refresh(tables, buckets=4)
    for _ in range(2):
        run(spark.createDataFrame([match("B", "C", 2)], MATCH), 1)
        bronze = tables.read("stream_bronze_matches")
        assert bronze.count() == 2 and "bucket" not in bronze.columns
        assert {(r["team"], r["points"]) for r in stream_standings.current(tables).collect()} == {("A", 3), ("B", 3), ("C", 0)}


def test_shuffle_files_of_a_batch_go_with_it(spark):
    keys = ["spark.sql.classic.shuffleDependency.fileCleanup.enabled"]
    seen, tables = [], Tables(spark, scratch_path(spark, "t-go"))
    real = tables.append_batch
    tables.append_batch = lambda *a, **k: seen.append([spark.conf.get(c, None) for c in keys]) or real(*a, **k)
    before = [spark.conf.get(c, None) for c in keys]
    stream_standings.refresh(tables, buckets=4)(spark.createDataFrame([("A", "B", 1, 0, "G", 1, "S", "finished", None, DAY)], MATCH), 0)
    assert seen and all(s == ["true"] for s in seen) and [spark.conf.get(c, None) for c in keys] == before


# --- ranks by ranges ---------------------------------------------------------------------


@pytest.mark.parametrize("partition", [[], ["g"]])
def test_rank_by_ranges_equals_rank(spark, partition):
    rng = random.Random(3)
    rows = [("hot" if k % 3 else rng.choice(["x", None]), k, rng.choice([None, 1, 2]), rng.randrange(9)) for k in range(900)]
    rows += [("hot", 5000, 1, 1)] * 20
    df = spark.createDataFrame(rows, "g string, a int, b int, c int")
    for order in (["a"], ["b", "c"], ["b", "a"]):
        got = standings.rank_by_ranges(df, partition, order, "r")
        spark.createDataFrame(rows, df.schema).createOrReplaceTempView("ranked_rows")
        by = ", ".join(f"{c} DESC NULLS LAST" for c in order)
        over = f"PARTITION BY {', '.join(partition)} ORDER BY {by}" if partition else f"ORDER BY {by}"
        want = spark.sql(f"SELECT *, rank() OVER ({over}) AS r FROM ranked_rows")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_no_window_holds_more_than_a_range(spark, capsys):
    n = 4000
    df = spark.range(n).select(F.lit("one").alias("g"), F.col("id").alias("a"))  # one group of unique scores
    hist = df.withColumn("_n", F.lit(1))
    before = standings.counts_before(hist, ["g"], [F.col("a").desc_nulls_last()], "_n", "before")
    before.explain("simple")
    windows = [x for x in capsys.readouterr().out.splitlines() if " Window [" in x]
    assert len(windows) == 2 and sum("_range" in x.split("], [")[1] for x in windows) == 1  # the other is over totals of ranges
    got = {r["a"]: r["before"] for r in before.collect()}
    assert got == {a: n - 1 - a for a in range(n)}
    ranges = spark.range(n).repartitionByRange(8, F.col("id").desc()).groupBy(F.spark_partition_id()).count().collect()
    assert len(ranges) == 8 and max(r["count"] for r in ranges) < 2 * n / 8
    small = spark.createDataFrame([("G", "A", 3, 1, 1), ("G", "B", 3, 1, 1), ("G", "C", 1, 0, 2)], "group string, team string, points int, goal_difference int, goals_for int")
    ranks = lambda df: sorted((r["team"], r["group_rank"]) for r in df.collect())
    assert ranks(standings.ranked(small)) == ranks(standings.ranked(small, ranges_from=0)) == [("A", 1), ("B", 1), ("C", 3)]


# --- as-of join ----------------------------------------------------------------------------


def test_as_of_join_equals_brute_force(spark, capsys):
    rng = random.Random(5)
    at = lambda h: DAY + dt.timedelta(hours=h)
    versions, facts = [], []
    for k in ["a", "b", None]:
        h = rng.randrange(40)
        for v in range(12):
            nxt = h + rng.randrange(1, 60)
            versions.append((k, v, at(h), None if v == 11 else at(nxt)))
            h = nxt
    for i in range(300):
        facts.append((i, rng.choice(["a", "b", "c", None]), None if rng.random() < 0.05 else at(rng.randrange(-20, 700))))
    facts += [(1000 + i, k, f) for i, (k, _, f, _) in enumerate(versions)]  # exactly on a border
    f = spark.createDataFrame(facts, "i int, k string, t timestamp_ntz")
    v = spark.createDataFrame(versions, "key string, v int, effective_from timestamp_ntz, effective_to timestamp_ntz")
    for bins in (1, 7, 64):
        out = scd2.as_of_join(f, v, {"k": "key"}, "t", {"v": "v"}, bins)
        want = {
            (i, next((x for q, x, a, b in versions if t is not None and q == k and a <= t and (b is None or t < b)), None))
            for i, k, t in facts
        }
        assert out.count() == len(facts) and {(r["i"], r["v"]) for r in out.collect()} == want
    out.explain("simple")
    p = capsys.readouterr().out
    assert "NestedLoop" not in p and "Cartesian" not in p
    assert scd2.as_of_join(f.limit(0), v, {"k": "key"}, "t", {"v": "v"}).count() == 0
    none = scd2.as_of_join(f.filter("t IS NULL"), v, {"k": "key"}, "t", {"v": "v"})
    assert none.count() == f.filter("t IS NULL").count() and none.filter("v IS NOT NULL").count() == 0
    assert scd2.as_of_join(f, v.limit(0), {"k": "key"}, "t", {"v": "v"}).filter("v IS NOT NULL").count() == 0


def test_as_of_join_lists_versions_of_small_keys_once(spark):
    at = lambda h: DAY + dt.timedelta(hours=h)
    versions = [(k, v, at(10 * v), at(10 * v + 10) if v < 9 else None) for k in ("hot", "cold", None) for v in range(10)]
    facts = [(i, "hot", at(i)) for i in range(100)] + [(100 + i, k, at(i)) for k in ("cold", None) for i in range(0, 100, 50)]
    f = spark.createDataFrame(facts, "i int, k string, t timestamp_ntz")
    v = spark.createDataFrame(versions, "key string, v int, effective_from timestamp_ntz, effective_to timestamp_ntz")

    def listed(many):
        out = scd2.as_of_join(f, v, {"k": "key"}, "t", {"v": "v"}, 20, many)
        rows = sorted((r["i"], r["k"] or "", r["v"]) for r in out.collect())
        assert rows == sorted((i, k or "", min(9, int((t - DAY).total_seconds() // 36000))) for i, k, t in facts)
        plan = out._jdf.queryExecution().optimizedPlan()
        join = plan.children().head() if plan.nodeName() == "Project" else plan
        right = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, join.right())
        return right.count()

    # no key is large: each version once; one is: its versions also under the bins they go on in
    assert listed(1000) == len(versions)
    assert len(versions) < listed(50) <= len(versions) + 20


# --- landing ---------------------------------------------------------------------------------


def teams(spark, *names):
    return spark.createDataFrame([(n, "G") for n in names], "name string, group string")


def names(docs):
    return sorted(r["name"] for r in landing.explode_entity(docs, "teams").collect())


def test_landing_twice_equals_landing_once(spark):
    path = scratch_path(spark, "t-land-twice")
    for _ in range(2):
        landing.write_payload(path, "2026-06-01T10:00:00+00:00", "snap/shot", teams=teams(spark, "A", "B"))
    assert names(landing.read_landing(spark, path)) == names(landing.read_latest(spark, path)) == ["A", "B"]
    # another source of the same instant is another batch, an earlier instant isn't the newest
    landing.write_payload(path, "2026-06-01T12:00:00+02:00", "html", teams=teams(spark, "C"))
    landing.write_payload(path, "2026-06-01T09:00:00+00:00", "html", teams=teams(spark, "D"))
    assert names(landing.read_latest(spark, path)) == ["A", "B", "C"]
    assert names(landing.read_landing(spark, path)) == ["A", "B", "C", "D"]
    # a writer that died is read by nobody
    died = f"{path}/{landing.batch_folder(spark, '2026-06-02T00:00:00+00:00', 'html')}"
    spark.createDataFrame([("{}",)], "value string").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").text(died)
    assert names(landing.read_latest(spark, path)) == ["A", "B", "C"]
    group_map = scratch_path(spark, "t-land-map")
    for _ in range(2):
        landing.write_group_map(group_map, teams(spark, "A", "B"), "2026-06-01T10:00:00+00:00", "html")
    assert landing.flatten_group_map(landing.read_group_map(spark, group_map)).count() == 2


def test_unreadable_stamps_are_refused_and_passed_over(spark):
    path = scratch_path(spark, "t-land-stamp")
    with pytest.raises(ValueError, match="27 June"):
        landing.write_payload(path, "27 June", "snapshot", teams=teams(spark, "A"))
    landing.write_payload(path, "2026-06-01T10:00:00+00:00", "snapshot", teams=teams(spark, "A"))
    # what an older writer left under no day, or straight under a day
    odd = '{"teams": [{"name": "X"}], "fetched_at": "27 June", "source_name": "s"}'
    old = '{"teams": [{"name": "B"}], "fetched_at": "2026-06-02T10:00:00+00:00", "source_name": "s"}'
    one = lambda line: spark.createDataFrame([(line,)], "value string")
    one(odd).write.text(f"{path}/ingest_date=__HIVE_DEFAULT_PARTITION__")
    assert names(landing.read_latest(spark, path)) == ["A"]
    one(old).write.text(f"{path}/ingest_date=2026-06-02")
    assert names(landing.read_latest(spark, path)) == ["B"]
    assert names(landing.read_landing(spark, path)) == ["A", "B"]


def test_malformed_documents_are_set_aside(spark):
    path = scratch_path(spark, "t-land-broken")
    landing.write_payload(path, "2026-06-01T10:00:00+00:00", "snapshot", teams=teams(spark, "A"))
    folder = f"{path}/{landing.batch_folder(spark, '2026-06-01T10:00:00+00:00', 'snapshot')}"
    extra = '{"teams": [{"name": "B"}], "owner": {"x": 1}, "fetched_at": "2026-06-01T10:00:00+00:00", "source_name": "snapshot"}'
    lines = ["{not json", '{"teams": "none"}', "[1", "", extra]
    spark.createDataFrame([(x,) for x in lines], "value string").write.mode("append").text(folder)
    for docs in (landing.read_latest(spark, path, tolerant=True), landing.read_landing(spark, path, tolerant=True)):
        assert names(landing.sound(docs)) == ["A", "B"]
        assert sorted(r["document"] for r in landing.malformed(docs).collect()) == sorted(lines[:3])
        kept = [r[landing.OTHER] for r in landing.sound(docs).collect() if r[landing.OTHER]]
        assert kept == [{"owner": '{"x":1}'}]
    with pytest.raises(Exception, match="(?i)malformed"):
        landing.read_latest(spark, path).collect()


# --- progress, files -----------------------------------------------------------------------------


def test_progress_of_each_micro_batch_is_kept(spark):
    root = scratch_path(spark, "t-progress")
    for rows in ([event("e1", 0), event("e2", 3)], [event("e3", 1)]):
        events_src.write_events(spark.createDataFrame(rows, EVENTS), f"{root}/in")
        spark.createDataFrame([("{not json",)], "value string").write.mode("append").text(f"{root}/in")
        stream_events.land_events(spark, f"{root}/in", f"{root}/bronze", f"{root}/ck", progress_path=f"{root}/progress")
    stream_events.land_events(spark, f"{root}/in", f"{root}/bronze", f"{root}/ck", progress_path=f"{root}/progress")  # nothing new
    kept = progress.read(spark, f"{root}/progress")
    rows = {(r["micro_batch"], r["rows_in"], r["rejected"], (r["latest"] - DAY).days) for r in kept.collect()}
    assert rows == {(0, 3, 1, 3), (1, 2, 1, 1)}
    total = progress.freshness(kept).first()
    assert (total["rows_in"], total["rejected"], (total["latest"] - DAY).days) == (5, 2, 3)
    assert progress.freshness(progress.read(spark, f"{root}/none")).first()["rows_in"] == 0


def test_a_listener_keeps_the_progress_of_a_job_that_goes_on(spark):
    root = scratch_path(spark, "t-listener")
    events_src.write_events(spark.createDataFrame([event("e1", 0)], EVENTS), f"{root}/in")
    log = progress.ProgressLog(spark, f"{root}/progress")
    spark.streams.addListener(log)
    try:
        rows = progress.observed(stream_events.event_stream(spark, f"{root}/in"))
        w = rows.writeStream.format("parquet").option("path", f"{root}/bronze").option("checkpointLocation", f"{root}/ck")
        q = w.trigger(processingTime="1 second").start()
        q.processAllAvailable()
        for _ in range(60):
            if batch_ids(spark, f"{root}/progress"):
                break
            time.sleep(0.5)
        q.stop()
    finally:
        spark.streams.removeListener(log)
    kept = progress.read(spark, f"{root}/progress").collect()
    assert [(r["micro_batch"], r["rows_in"], r["rejected"]) for r in kept] == [(0, 1, 0)]


def test_files_of_whole_documents(spark):
    path = scratch_path(spark, "t-files")
    one = json.dumps({"event_id": "a", "minute": 3, "ingested_at": "2024-01-01T00:00:00.000000"}, indent=2)
    many = json.dumps([{"event_id": "b"}, {"event_id": "c", "more": 1}], indent=2)
    bodies = [(one,), (many,), ('{"event_id": ',), ("",), ("[]",)]
    files.write_documents(spark.createDataFrame(bodies, "doc string"), path, "doc")
    events = files.read_event_files(spark, path, "part-*").collect()
    assert sorted((r["event_id"], r["minute"]) for r in events) == [("a", 3), ("b", None), ("c", None)]
    rows = files.read_documents(spark, path, EVENTS, "part-*")
    assert rows.filter("_corrupt_record IS NOT NULL").count() == 2  # the cut-off one and the empty one
    assert rows.filter("path IS NULL OR modified IS NULL").count() == 0
    pages = files.read_pages(spark, path, "part-*")
    assert pages.count() == 5 and pages.select("page_id").distinct().count() == 5


def test_a_job_that_goes_on_runs_at_its_interval(spark):
    root = scratch_path(spark, "t-every")
    tables = Tables(spark, f"{root}/tables")
    row = ("A", "B", 1, 0, "G", 1, "S", "finished", None, DAY)
    matches = spark.createDataFrame([row], MATCH)
    matches.write.option("timestampNTZFormat", events_src.NTZ_FORMAT).json(f"{root}/in")
    q = stream_standings.run_standings(
        spark, f"{root}/in", tables, f"{root}/ck", matches.schema, available_now=False, buckets=4, every="1 second"
    )
    try:
        q.processAllAvailable()
        assert q.isActive and {r["team"] for r in stream_standings.current(tables).collect()} == {"A", "B"}
    finally:
        q.stop()
