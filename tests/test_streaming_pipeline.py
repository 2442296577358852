"""Streaming jobs (two availableNow runs equal one batch run), the medallion
run, and the driver contract."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from scoreline.functions import ntz
from scoreline.operators import bronze, gold, silver, standings
from scoreline.plans import derive, medallion
from scoreline.schemas import EVENTS
from scoreline.session import scratch_path
from scoreline.sources import events as events_src
from scoreline.sources import landing
from scoreline.sources.io import Tables
from scoreline.streaming import events as stream_events
from scoreline.streaming import standings as stream_standings

EV = [
    ("e1", "A", "B", None, "A", "p1", "goal", 3, dt.datetime(2024, 1, 1, 0, 3)),
    ("e2", "A", "B", None, "B", "p2", "goal", 9, dt.datetime(2024, 1, 1, 0, 9)),
    ("e3", "A", "B", None, "A", "p1", "yellow_card", 12, dt.datetime(2024, 1, 1, 0, 12)),
]


def test_event_streams_equal_batch(spark):
    root = scratch_path(spark, "t-stream")
    first = spark.createDataFrame(EV[:2], EVENTS)
    second = spark.createDataFrame([EV[2], EV[0]], EVENTS)  # a new event and a repeat
    for arrived in (first, second):
        events_src.write_events(arrived, f"{root}/in")
        stream_events.land_events(spark, f"{root}/in", f"{root}/bronze", f"{root}/ck/l")
        stream_events.silver_events(spark, f"{root}/bronze", f"{root}/silver", f"{root}/ck/s")
        stream_events.top_scorers(spark, f"{root}/silver", f"{root}/log")
    bronze = spark.read.schema(EVENTS).parquet(f"{root}/bronze")
    assert bronze.count() == 4  # each file once
    silv = stream_events.read_silver(spark, f"{root}/silver")
    assert sorted(r["event_id"] for r in silv.collect()) == ["e1", "e2", "e3"]
    streamed = sorted(tuple(r) for r in stream_events.read_top_scorers(spark, f"{root}/log").collect())
    batch = sorted(tuple(r) for r in gold.top_scorers(silver.events(bronze)).collect())
    assert streamed == batch == [("p1", "A", 1), ("p2", "B", 1)]


def test_standings_stream_equals_batch(spark, sf_small):
    root = scratch_path(spark, "t-stream-standings")
    raw = derive.raw_matches(spark, sf_small)
    split = ntz(dt.datetime(1999, 1, 1))
    tables = Tables(spark, f"{root}/tables")
    for arrived in (raw.filter(F.col("ingested_at") < split), raw.filter(F.col("ingested_at") >= split)):
        arrived.write.mode("append").option("timestampNTZFormat", events_src.NTZ_FORMAT).json(f"{root}/in")
        stream_standings.run_standings(spark, f"{root}/in", tables, f"{root}/ck", raw.schema, derive.MATCH_ORDER[1:])
    streamed = sorted(tuple(r) for r in stream_standings.current(tables).collect())
    batch = sorted(
        tuple(r)
        for r in standings.compute(derive.matches(spark, sf_small)).select(*standings.STANDINGS_COLUMNS).collect()
    )
    assert streamed == batch
    metrics = tables.read("stream_metrics").orderBy("batch_id").collect()
    assert len(metrics) >= 2 and all(m["is_live"] for m in metrics)
    history = stream_standings.history(tables)
    closed = history.filter(~F.col("is_current")).count()
    assert closed > 0
    assert history.filter(F.col("is_current")).count() == len(batch)
    # one open version per key, and closed + open = every version written
    assert history.select("group", "team").filter(F.col("is_current")).distinct().count() == len(batch)


def test_medallion_two_runs(spark, sf_small):
    root = scratch_path(spark, "t-medallion")
    land = f"{root}/landing"
    tables = Tables(spark, f"{root}/tables")
    src = {
        "teams": derive.teams(spark, sf_small),
        "stadiums": derive.stadiums(spark, sf_small),
    }
    raw = derive.raw_matches(spark, sf_small)
    landing.write_payload(land, "2026-06-20T00:00:00+00:00", "snapshot", matches=derive.scheduled_matches(raw), **src)
    r1 = medallion.run(spark, tables, land, 1, dt.datetime(2026, 6, 20), enforce=False)
    # nothing played yet: no standings, and the not-empty check says so
    assert r1.rows["silver_standings"] == 0
    assert {c["check"]: c["passed"] for c in r1.checks}["standings_not_empty"] is False
    landing.write_payload(land, "2026-06-27T00:00:00+00:00", "snapshot", matches=derive.landing_matches(raw), **src)
    ev_dir = f"{root}/events"
    events_src.write_events(derive.events(spark, sf_small), ev_dir)
    r2 = medallion.run(spark, tables, land, 2, dt.datetime(2026, 6, 27), enforce=False, events_dir=ev_dir)
    scorers = sorted(tuple(r) for r in tables.read("gold_top_scorers").collect())
    assert scorers == sorted(tuple(r) for r in gold.top_scorers(derive.events(spark, sf_small)).collect())
    # a rerun with no new files lands nothing twice
    r3 = medallion.run(spark, tables, land, 3, dt.datetime(2026, 6, 28), enforce=False, events_dir=ev_dir)
    assert r3.rows["silver_events"] == r2.rows["silver_events"]
    cur = tables.read("gold_standings_current")
    # equal to the same operators applied to the batch-B rows without any I/O
    # (landing rows only carry the batch stamp, so ties within a batch break on
    # the remaining columns, not on the line-item lineage that M uses)
    text = derive.landing_matches(raw).select(*[F.col(c).cast("string") for c in derive.landing_matches(raw).columns])
    latest = silver.matches(bronze.stamp(text, "2026-06-27T00:00:00+00:00", "snapshot"))
    expect = standings.compute(latest).select(*standings.STANDINGS_COLUMNS)
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    assert sorted(cur.collect(), key=key) == sorted(expect.select(*cur.columns).collect(), key=key)
    assert r2.rows["bronze_matches"] == raw.count()
    assert {c["check"] for c in r2.checks} >= {"standings_not_empty", "all_standings_teams_known"}
    # run 3 saw the same payload: nothing closed, history unchanged, open set equal
    versions = tables.read_versions("silver_standings")
    assert versions.filter(~F.col("is_current")).count() == 0  # run 1 had no standings to close
    assert versions.filter(F.col("is_current")).count() == cur.count()
    from scoreline.operators import scd2
    assert scd2.as_of(versions, dt.datetime(2026, 6, 27, 12)).count() == cur.count()


def test_late_first_delivery_and_late_repeat(spark):
    root = scratch_path(spark, "t-late")
    old = dt.datetime(2023, 1, 1)
    late = ("e0", "A", "B", None, "A", "p9", "goal", 1, old)  # first delivered a year behind the others
    for arrived in ([EV[0], EV[1]], [late], [EV[0], late]):
        events_src.write_events(spark.createDataFrame(arrived, EVENTS), f"{root}/in")
        stream_events.land_events(spark, f"{root}/in", f"{root}/bronze", f"{root}/ck/l")
        stream_events.silver_events(spark, f"{root}/bronze", f"{root}/silver", f"{root}/ck/s")
        stream_events.top_scorers(spark, f"{root}/silver", f"{root}/log")
    got = stream_events.read_silver(spark, f"{root}/silver")
    assert sorted(r["event_id"] for r in got.collect()) == ["e0", "e1", "e2"]
    assert stream_events.top_scorers(spark, f"{root}/silver", f"{root}/log") == []  # nothing twice
    log = {(r["player"], r["goals"]) for r in stream_events.read_top_scorers(spark, f"{root}/log").collect()}
    assert log == {("p1", 1), ("p2", 1), ("p9", 1)}


def test_malformed_lines_are_kept_apart(spark):
    root = scratch_path(spark, "t-corrupt")
    events_src.write_events(spark.createDataFrame(EV[:1], EVENTS), f"{root}/in")
    spark.createDataFrame([("{not json",)], "value string").write.mode("append").text(f"{root}/in")
    stream_events.land_events(spark, f"{root}/in", f"{root}/bronze", f"{root}/ck/l")
    stream_events.silver_events(spark, f"{root}/bronze", f"{root}/silver", f"{root}/ck/s")
    assert [r["event_id"] for r in stream_events.read_silver(spark, f"{root}/silver").collect()] == ["e1"]
    assert [r[0] for r in stream_events.rejected(spark, f"{root}/bronze").collect()] == ["{not json"]
    spark.createDataFrame([("{not json",)], "value string").write.text(f"{root}/landing")
    with pytest.raises(Exception, match="(?i)malformed"):
        landing.read_landing(spark, f"{root}/landing").collect()


def test_events_stream_starts_before_anything_has_landed(spark):
    root = scratch_path(spark, "t-empty-stream")
    stream_events.silver_events(spark, f"{root}/bronze", f"{root}/silver", f"{root}/ck")
    assert stream_events.read_silver(spark, f"{root}/silver").count() == 0


MATCH = (
    "home_team string, away_team string, home_score int, away_score int, group string, matchday int, "
    "stadium string, status string, score string, ingested_at timestamp_ntz"
)


def test_standings_replay_null_stamps_and_shared_root(spark):
    tables = Tables(spark, scratch_path(spark, "t-replay"))
    t1 = dt.datetime(2026, 6, 1)
    first = spark.createDataFrame([("A", "B", 1, 0, "G", 1, "S", "finished", None, t1)], MATCH)
    second = spark.createDataFrame([("B", "A", 2, 0, "G", 2, "S", "finished", None, None)], MATCH)
    kept = spark.range(3).cache()  # the caller's cache survives
    kept.count()
    run = stream_standings.refresh(tables)
    run(first, 0)
    run(second, 1)  # no row has a stamp: they stay all the same
    snap = lambda: {
        n: sorted(map(str, tables.read(n).collect()))
        for n in ("stream_bronze_matches", "stream_silver_matches", "stream_standings", "stream_metrics")
    }
    before = snap()
    run(second, 1)
    assert snap() == before
    assert tables.read("stream_silver_matches").count() == 2 and tables.read("stream_bronze_matches").count() == 2
    assert {(r["team"], r["points"]) for r in stream_standings.current(tables).collect()} == {("A", 3), ("B", 3)}
    assert kept.is_cached
    kept.unpersist()
    # a batch run on the same root has tables of its own
    land = f"{tables.root}/landing"
    teams = spark.createDataFrame([("A", "G"), ("B", "G")], "name string, group string")
    matches = first.drop("ingested_at")
    landing.write_payload(land, "2026-06-01T00:00:00+00:00", "snapshot", teams=teams, matches=matches)
    medallion.run(spark, tables, land, 1, t1, enforce=False)
    assert tables.read("bronze_matches").count() == 1 and tables.read("silver_matches").count() == 1
    assert snap() == before


def test_rerun_of_a_batch_replaces_its_own_output(spark):
    root = scratch_path(spark, "t-rerun")
    land, tables = f"{root}/landing", Tables(spark, f"{root}/tables")
    teams = spark.createDataFrame([("A", "G"), ("B", "G")], "name string, group string")
    rows = [("A", "B", None, None, "G", 1, "S", "scheduled", None), ("B", "A", 1, 1, "G", 2, "S", "finished", "1–1")]
    fields = MATCH.replace(", ingested_at timestamp_ntz", "")
    landing.write_payload(land, "2026-06-01T00:00:00+00:00", "snapshot", teams=teams, matches=spark.createDataFrame(rows, fields))
    medallion.run(spark, tables, land, 1, dt.datetime(2026, 6, 1))
    rows[0] = ("A", "B", 3, 0, "G", 1, "S", "finished", "3–0")
    landing.write_payload(land, "2026-06-02T00:00:00+00:00", "snapshot", teams=teams, matches=spark.createDataFrame(rows, fields))
    medallion.run(spark, tables, land, 2, dt.datetime(2026, 6, 2))
    names = ["bronze_matches", "bronze_teams", "silver_teams", "silver_matches", "silver_standings", "gold_team_form"]
    state = lambda: {n: sorted(map(str, tables.read(n).collect())) for n in names} | {
        "history": sorted(map(str, tables.read_versions("silver_standings").collect()))
    }
    before = state()
    for aqe in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
        try:
            medallion.run(spark, tables, land, 2, dt.datetime(2026, 6, 2))
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        assert state() == before
    # a run that died before its commit adds nothing to the history
    path = f"{tables.path('silver_standings')}/snapshot=000000000003"
    died = tables.read("silver_standings").withColumn("effective_to", F.col("effective_from"))
    died.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy("is_current").parquet(path)
    assert state() == before
    tables.retain("silver_matches", 1)
    assert tables.snapshot_before("silver_matches", 2) is None and tables.read("silver_matches").count() == 2


def test_meetings_without_matchday_stay_apart(spark):
    fields = (
        "home_team string, away_team string, home_score string, away_score string, group string, matchday string, "
        "stadium string, status string, ingested_at string"
    )
    one = ("A", "B", "1", "0", None, None, None, "finished", "2026-06-01T00:00:00+00:00")
    two = ("A", "B", "2", "2", None, None, None, "finished", "2026-06-01T00:00:00+00:00")
    first = silver.matches(spark.createDataFrame([one, two], fields))
    assert sorted((r["home_score"], r["meeting"]) for r in first.collect()) == [(1, 1), (2, 2)]
    # a later batch with one of them replaces that one
    later = spark.createDataFrame([one[:8] + ("2026-06-02T00:00:00+00:00",)], fields)
    old = first.select(*[F.col(c).cast("string") for c in later.columns], "meeting")
    again = silver.matches(old.unionByName(later, allowMissingColumns=True))
    assert sorted((r["home_score"], r["ingested_at"][:10]) for r in again.collect()) == [(1, "2026-06-02"), (2, "2026-06-01")]


def test_entry_and_contract(spark):
    df = entry.entry(spark)
    assert df.columns == standings.STANDINGS_COLUMNS and df.count() > 0
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 50
