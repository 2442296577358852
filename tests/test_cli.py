"""Command-line entry points on a tiny payload."""

import json

from scoreline import cli
from scoreline.session import scratch_path
from scoreline.sources import events as events_src
from scoreline.sources import landing
from tests.test_streaming_pipeline import EV


def test_cli_run_and_stream_events(spark, capsys):
    root = scratch_path(spark, "t-cli")
    teams = spark.createDataFrame([("A", "G"), ("B", "G")], "name string, group string")
    matches = spark.createDataFrame(
        [("A", "B", 2, 1, "G", 1, "S", "finished", "2–1")],
        "home_team string, away_team string, home_score int, away_score int, group string, matchday int, "
        "stadium string, status string, score string",
    )
    landing.write_payload(f"{root}/landing", "2026-06-01T00:00:00+00:00", "snapshot", teams=teams, matches=matches)
    from scoreline.schemas import EVENTS

    events_src.write_events(spark.createDataFrame(EV, EVENTS), f"{root}/events")
    capsys.readouterr()
    assert cli.main(["run", "--landing", f"{root}/landing", "--tables", f"{root}/t", "--batch-id", "1",
                     "--as-of", "2026-06-01T00:00:00", "--events", f"{root}/events"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["rows"]["gold_standings_current"] == 2 and out["rows"]["gold_top_scorers"] == 2
    assert all(c["passed"] for c in out["checks"])
    assert cli.main(["stream-events", "--input", f"{root}/events", "--tables", f"{root}/s", "--max-files-per-trigger", "1"]) == 0
    assert spark.read.parquet(f"{root}/s/stream_silver_events").count() == 3


def test_cli_land_then_run(spark, sf_small, capsys):
    root = scratch_path(spark, "t-cli-land")
    stamp = "2026-06-01T00:00:00+00:00"
    assert cli.main(["land", "--source", "snapshot", "--input", sf_small, "--landing", f"{root}/landing", "--fetched-at", stamp]) == 0
    assert cli.main(["land", "--source", "html", "--input", sf_small, "--landing", f"{root}/scraped", "--fetched-at", stamp]) == 0
    capsys.readouterr()
    assert cli.main(["run", "--landing", f"{root}/landing", "--tables", f"{root}/t", "--batch-id", "1",
                     "--as-of", "2026-06-01T00:00:00", "--no-enforce"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["rows"]["silver_stadiums"] > 0 and out["rows"]["silver_standings"] > 0


def test_cli_stream_standings_without_any_table(spark):
    root = scratch_path(spark, "t-cli-stream")
    from scoreline.schemas import MATCHES_STREAM

    rows = [("A", "B", "2", "1", "G", "1", "S", "finished", None, None, "x")]
    spark.createDataFrame(rows, MATCHES_STREAM).write.json(f"{root}/in")
    assert cli.main(["stream-standings", "--input", f"{root}/in", "--tables", f"{root}/t"]) == 0
    assert spark.read.parquet(f"{root}/t/stream_standings").count() == 2
