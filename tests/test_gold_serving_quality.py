"""Gold aggregates, serving reads, quality checks and the live gate."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from scoreline.operators import gold, quality, serving
from scoreline.operators.dedup import keep_first, keep_latest
from tests.helpers import by, matches_df

M = [
    ("A", "B", 2, 0, "G", 2, "S", "finished"),
    ("C", "A", 1, 1, "G", 1, "S", "finished"),
    ("A", "D", 0, 3, "G", 1, "S", "finished"),
    ("B", "C", None, None, "G", 3, "S", "scheduled"),
    ("D", "B", 1, 0, "G", 3, "S", "live"),
]


def test_team_form_orders_by_matchday_then_letter(spark):
    form = by([r.asDict() for r in gold.team_form(matches_df(spark, M)).collect()], "team")
    # matchday 1: D (vs C) and L (vs D) -> sorted D, L; matchday 2: W
    assert form["A"]["form"] == "DLW"
    assert form["B"]["form"] == "L"
    assert "D" in form and form["D"]["form"] == "W"


def test_team_form_repeats_letters_for_many_matches(spark):
    rows = [("A", f"X{i}", 1, 0, "G", 1, "S", "finished") for i in range(7)]
    form = by([r.asDict() for r in gold.team_form(matches_df(spark, rows)).collect()], "team")
    assert form["A"]["form"] == "W" * 7


def test_goals_by_matchday_rounding_half_up(spark):
    rows = [("A", "B", 1, 1, "G", 1, "S", "finished"), ("C", "D", 1, 0, "G", 1, "S", "finished")]
    rows += [("E", "F", 3, 0, "G", 1, "S", "finished"), ("G", "H", 0, 0, "G", 1, "S", "finished")]
    rows += [("I", "J", 0, 0, "G", 1, "S", "finished"), ("K", "L", 0, 0, "G", 1, "S", "finished")]
    rows += [("M", "N", 0, 0, "G", 1, "S", "finished"), ("O", "P", 0, 0, "G", 1, "S", "finished")]
    t = gold.goals_by_matchday(matches_df(spark, rows)).first()
    assert (t["goals"], t["matches_played"]) == (6, 8)
    assert t["avg_goals_per_match"] == 0.75
    rows2 = [("A", "B", 1, 0, "G", 2, "S", "finished")] * 7 + [("A", "B", 0, 0, "G", 2, "S", "finished")]
    t2 = gold.goals_by_matchday(matches_df(spark, rows2)).first()
    assert t2["avg_goals_per_match"] == 0.88  # 7/8 = 0.875 -> HALF_UP


def test_top_scorers_and_serving(spark):
    ev = spark.createDataFrame(
        [
            ("e1", "p1", "t1", "goal", dt.datetime(2024, 1, 1, 0, 1)),
            ("e2", "p1", "t1", "goal", dt.datetime(2024, 1, 1, 0, 2)),
            ("e3", "p2", "t2", "goal", dt.datetime(2024, 1, 1, 0, 3)),
            ("e4", "p3", "t2", "yellow_card", dt.datetime(2024, 1, 1, 0, 4)),
            ("e5", "p3", "t2", "view", dt.datetime(2024, 1, 1, 0, 4)),
        ],
        "event_id string, player string, team string, event_type string, ingested_at timestamp_ntz",
    )
    top = [r.asDict() for r in serving.top_scorers(gold.top_scorers(ev), 1).collect()]
    assert top == [{"player": "p1", "team": "t1", "goals": 2, "label": "p1 (t1)"}]
    recent = [r["event_id"] for r in serving.recent_events(ev, 2).collect()]
    assert recent == ["e5", "e4"]
    icons = {r["event_id"]: r["icon"] for r in serving.with_icons(ev).collect()}
    assert icons["e1"] == "⚽" and icons["e5"] == "•"


def test_group_table_labels_and_form_spacing(spark):
    st = spark.createDataFrame(
        [("G", "A", 1, 1, 0, 0, 2, 0, 3, 2, 1), ("G", "B", 1, 0, 0, 1, 0, 2, 0, -2, 2), ("H", "C", 0, 0, 0, 0, 0, 0, 0, 0, 1)],
        "group string, team string, played long, won long, drawn long, lost long, goals_for long, "
        "goals_against long, points long, goal_difference long, group_rank int",
    )
    t = serving.group_table(st, "G")
    assert t.columns == ["#", "Team", "P", "W", "D", "L", "GF", "GA", "GD", "Pts"]
    assert [r["Team"] for r in t.collect()] == ["A", "B"]
    assert [r["group"] for r in serving.group_list(st).collect()] == ["G", "H"]
    f = spark.createDataFrame([("A", "WDL")], "team string, form string")
    assert serving.form_spaced(f).first()["form"] == "W D L"


def test_quality_report_and_enforce(spark):
    st = spark.createDataFrame([("A", 3), ("B", -1), (None, 0)], "team string, points long")
    dim = spark.createDataFrame([("A",)], "name string")
    rep = quality.table_checks(st, "standings", not_null=["team"], non_negative=["points"], known=("team", dim, "name"))
    got = {r["check"]: r["failed_rows"] for r in rep.collect()}
    assert got == {
        "standings_not_empty": 0,
        "standings_no_null_team": 1,
        "standings_points_non_negative": 1,
        "all_standings_teams_known": 1,
    }
    with pytest.raises(ValueError, match="standings_no_null_team"):
        quality.enforce(rep)
    assert [r["team"] for r in quality.unknown(st, "team", dim, "name").collect()] == ["B"]
    empty = quality.table_checks(st.limit(0), "standings")
    assert empty.first()["failed_rows"] == 1


def test_finished_match_without_score_is_reported(spark):
    m = spark.createDataFrame(
        [("finished", 1, None), ("finished", 2, 1), ("scheduled", None, None)], "status string, home_score int, away_score int"
    )
    rep = quality.table_checks(m, "matches", rules={"finished_have_scores": quality.finished_without_score()})
    got = {r["check"]: r["failed_rows"] for r in rep.collect()}
    assert got["matches_finished_have_scores"] == 1


def test_live_gate_counts_null_status_as_live(spark):
    df = spark.createDataFrame([("finished",), (None,)], "status string")
    r = quality.is_live(df).first()
    assert r["is_live"] is True and r["open_matches"] == 1
    done = spark.createDataFrame([("finished",)], "status string")
    assert quality.is_live(done).first()["is_live"] is False
    assert quality.is_live(done.limit(0)).first()["is_live"] is False


def test_keep_latest_and_first_total_order(spark):
    df = spark.createDataFrame(
        [("k", 1, "old"), ("k", 3, "new"), ("k", 3, "newer"), ("j", None, "n"), ("j", 0, "z")],
        "key string, ts int, v string",
    )
    latest = {r["key"]: (r["ts"], r["v"]) for r in keep_latest(df, ["key"], ["ts"]).collect()}
    assert latest == {"k": (3, "newer"), "j": (0, "z")}
    first = {r["key"]: (r["ts"], r["v"]) for r in keep_first(df, ["key"], ["ts"]).collect()}
    assert first == {"k": (1, "old"), "j": (None, "n")}
    assert keep_latest(df, ["key"], ["ts"]).columns == df.columns


def test_empty_inputs(spark):
    empty = matches_df(spark, [])
    assert gold.team_form(empty).count() == 0
    assert gold.goals_by_matchday(empty).count() == 0
    trend = gold.goals_by_matchday(empty)
    assert serving.kpi_total_goals(trend).first()["total_goals"] == 0
    assert serving.kpi_avg_goals(trend).first()["avg_goals_per_match"] is None
    k = serving.kpi_matches_played(empty).first()
    assert (k["finished"], k["total"]) == (0, 0)
    f = serving.freshness(empty.withColumn("ingested_at", F.lit(None).cast("timestamp_ntz"))).first()
    assert f["available"] is False and f["latest_ingested_at"] is None
