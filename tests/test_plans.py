"""Physical-plan properties that the scale design depends on."""

import datetime as dt

from pyspark.sql import functions as F

from scoreline.operators import gold, standings
from scoreline.operators.dedup import keep_latest
from scoreline.plans import derive
from scoreline.session import scratch_path
from scoreline.sources.io import Tables


def plan(df, capsys, mode="formatted"):
    capsys.readouterr()
    df.explain(mode)
    return capsys.readouterr().out


def test_keep_latest_aggregates_before_the_shuffle(spark, capsys):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b")], "key string, ts int, v string")
    p = plan(keep_latest(df, ["key"], ["ts"]), capsys, "simple")
    assert "partial_max" in p and "Window" not in p


def test_rank_window_runs_over_the_score_histogram(spark, capsys, sf_small):
    p = plan(standings.compute(derive.matches(spark, sf_small)), capsys, "simple")
    window_lines = [line for line in p.splitlines() if "Window [" in line]
    assert window_lines and all("sum(_n" in line for line in window_lines)
    # over full tuples the windows are those of (group, points); by group alone only points are ordered
    for line in window_lines:
        keys = line.split("], [")[1:]
        assert "points" in keys[0] or (keys[1].count("DESC") == 1 and "points" in keys[1]), line
    # the per-team aggregate is partial + final (map-side combine)
    assert "partial_count" in p


def test_fact_table_is_never_broadcast_by_the_static_planner(spark, capsys, sf_small):
    p = plan(derive.raw_matches(spark, sf_small), capsys, "simple")
    lines = p.splitlines()
    for i, line in enumerate(lines):
        if "FileScan parquet" in line and "lineitem" in line:
            above = "\n".join(lines[max(0, i - 3) : i])
            assert "BroadcastExchange" not in above


def test_filters_and_columns_reach_the_parquet_scan(spark, capsys, sf_small):
    t = Tables(spark, scratch_path(spark, "t-plans"))
    t.overwrite(derive.events(spark, sf_small), "silver_events", 1)
    p = plan(gold.top_scorers(t.read("silver_events")), capsys)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,goal)]" in p
    assert "ReadSchema: struct<team:string,player:string,event_type:string>" in p
    t.overwrite(derive.matches(spark, sf_small), "silver_matches", 1)
    p2 = plan(standings.compute(t.read("silver_matches")), capsys)
    assert "stadium" not in p2.split("ReadSchema:")[1].splitlines()[0]


def test_bronze_ingest_date_prunes_partitions(spark, capsys):
    t = Tables(spark, scratch_path(spark, "t-prune"))
    df = spark.createDataFrame(
        [("a", dt.date(2026, 6, 1)), ("b", dt.date(2026, 6, 2))], "name string, ingest_date date"
    )
    t.append(df, "bronze_teams", partition_by=["ingest_date"])
    q = t.read("bronze_teams").filter(F.col("ingest_date") == F.lit("2026-06-02").cast("date"))
    p = plan(q, capsys)
    assert "PartitionFilters: [isnotnull(ingest_date" in p
    assert [r["name"] for r in q.collect()] == ["b"]


def test_hot_keys_give_the_same_answers(spark):
    """One team plays a third of all matches and one match key is re-delivered
    as a third of all raw rows; results equal the plain window formulations."""
    from pyspark.sql import Window

    from tests.helpers import MATCH_SCHEMA

    n = 3000
    rows = []
    for i in range(n):
        if i % 3 == 0:
            rows.append(("HOT", f"opp{i}", i % 4, i % 3, "G1", 1 + i % 9, "S", "finished"))
        elif i % 3 == 1:
            rows.append(("K1", "K2", i % 5, 0, "G1", 1, "S", "finished"))  # same key, many deliveries
        else:
            rows.append((f"t{i}", f"u{i}", 1, 1, "G2" if i % 2 else "G1", 2, "S", "finished"))
    raw = spark.createDataFrame(rows, MATCH_SCHEMA).withColumn("seq", F.monotonically_increasing_id())
    raw = raw.cache()  # fixed ids for both formulations
    latest = keep_latest(raw, ["home_team", "away_team", "matchday"], ["seq"])
    w = Window.partitionBy("home_team", "away_team", "matchday").orderBy(F.col("seq").desc())
    ref = raw.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    assert sorted(latest.collect(), key=key) == sorted(ref.select(*latest.columns).collect(), key=key)

    m = derive.with_result(latest.drop("seq"))
    ours = standings.compute(m)
    agg = standings.aggregate(standings.unpivot_sides(m))
    wr = Window.partitionBy("group").orderBy(*[F.col(c).desc_nulls_last() for c in standings.RANK_ORDER])
    plain = agg.withColumn("group_rank", F.rank().over(wr))
    assert sorted(ours.collect(), key=key) == sorted(plain.select(*ours.columns).collect(), key=key)
    hot = ours.filter(F.col("team") == "HOT").first()
    assert hot["played"] == n // 3
    raw.unpersist()


def test_scd2_history_is_read_by_partition(spark, capsys):
    from scoreline.operators import scd2

    t = Tables(spark, scratch_path(spark, "t-versions"))
    snap = lambda rows: spark.createDataFrame(rows, "group string, team string, points long")
    v1 = scd2.initial(snap([("A", "x", 0), ("A", "y", 0)]), dt.datetime(2026, 6, 1))
    t.overwrite(v1, "st", 1, partition_by=["is_current"])
    open1 = scd2.current(t.read("st", "000000000001"))
    v2 = scd2.apply(open1, snap([("A", "x", 3), ("A", "y", 0)]), ["group", "team"], ["points"], dt.datetime(2026, 6, 2))
    t.overwrite(v2, "st", 2, partition_by=["is_current"])
    versions = t.read_versions("st")
    got = sorted((r["team"], r["points"], r["is_current"]) for r in versions.collect())
    assert got == [("x", 0, False), ("x", 3, True), ("y", 0, True)]
    p = plan(versions, capsys)
    assert "PartitionFilters: [" in p and "is_current" in p.split("PartitionFilters: [")[1].splitlines()[0]


def test_newest_batch_reads_only_its_folder(spark, capsys):
    from scoreline.sources import landing

    path = scratch_path(spark, "t-newest")
    teams = spark.createDataFrame([("A", "G1")], "name string, group string")
    for day in ("2026-06-01", "2026-06-02"):
        landing.write_payload(path, f"{day}T10:00:00+00:00", "snapshot", teams=teams)
    p = plan(landing.read_latest(spark, path), capsys)
    assert "ingest_date=2026-06-02" in p and "ingest_date=2026-06-01" not in p
    assert landing.read_latest(spark, path).count() == 1
