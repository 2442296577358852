"""What the rendered pages and the scraped matches put into shuffles."""

import re

from scoreline.operators import silver
from scoreline.plans import pages


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_boxes_are_written_after_the_shuffle(spark):
    rows = [(f"a{i % 3}" if i % 5 else None, "b & c", i % 4, 1 if i % 2 else None, i) for i in range(12)]
    matches = spark.createDataFrame(rows, "home_team string, away_team string, home_score int, away_score int, matchday int")
    out = pages.match_pages(matches)
    assert "footballbox" not in plan(out).split("Exchange hashpartitioning(_chunk")[1]
    (page,) = [r["html"] for r in out.collect()]
    boxes = page.split("<table")[1:]
    assert len(boxes) == 9 and all('<th class="faway">b &amp; c</th>' in b for b in boxes)  # no box without a name
    assert [('class="fscore"' in b) for b in boxes] == [bool(i % 2) for i in range(12) if i % 5]


def test_matches_without_a_matchday_are_shuffled_once(spark):
    first, second = "2026-06-20T00:00:00+00:00", "2026-06-27T00:00:00+00:00"
    rows = [
        ("a", "b", "1", "0", None, "finished", first),
        ("a", "b", "2", "0", None, "finished", first),
        ("a", "b", "3", "3", None, "finished", second),
        ("a", "b", "4", "0", "7", "finished", first),
        ("a", "b", "0", "4", "7", "finished", second),
        (None, None, "5", "5", None, "finished", first),
    ]
    bronze = spark.createDataFrame(
        rows, "home_team string, away_team string, home_score string, away_score string, matchday string, status string, ingested_at string"
    )
    out = silver.matches(bronze)
    assert not re.search(r"hashpartitioning\(home_team#\d+, away_team#\d+, _ts", plan(out))
    got = [(r["home_team"], r["matchday"], r["meeting"], r["home_score"]) for r in out.collect()]
    assert sorted(got, key=str) == sorted([("a", None, 1, 3), ("a", None, 2, 2), ("a", 7, 0, 0), (None, None, 1, 5)], key=str)
