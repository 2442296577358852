"""Serving reads: feed, top-k, per-group table, form strings, KPI tiles, freshness.

Each is a Spark query over the gold/silver tables; limits are the feature
(top-k) and compile to ``TakeOrderedAndProject``, never a driver-side sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreline.functions import FINISHED, event_icon, event_line, spaced

# Fixed display labels of the per-group table.
GROUP_TABLE_LABELS = {
    "group_rank": "#",
    "team": "Team",
    "played": "P",
    "won": "W",
    "drawn": "D",
    "lost": "L",
    "goals_for": "GF",
    "goals_against": "GA",
    "goal_difference": "GD",
    "points": "Pts",
}


def recent_events(events: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` most recent events (ties broken by event id)."""
    return events.orderBy(F.col("ingested_at").desc_nulls_last(), F.col("event_id").desc_nulls_last()).limit(n)


def with_icons(events: DataFrame) -> DataFrame:
    return events.withColumn("icon", event_icon("event_type"))


def with_lines(events: DataFrame) -> DataFrame:
    ev = with_icons(events)
    return ev.withColumn("line", event_line("minute", "icon", "player", "team", "home_team", "away_team"))


def top_scorers(scorers: DataFrame, n: int = 8) -> DataFrame:
    """Top ``n`` by goals; ties by player then team; with a ``player (team)`` label."""
    top = scorers.orderBy(F.col("goals").desc(), F.col("player").asc_nulls_last(), F.col("team").asc_nulls_last()).limit(n)
    return top.withColumn("label", F.concat(F.col("player"), F.lit(" ("), F.col("team"), F.lit(")")))


def standings_sorted(current: DataFrame) -> DataFrame:
    """The current standings by group, rank and team."""
    return current.orderBy(F.col("group").asc_nulls_first(), F.col("group_rank").asc_nulls_first(), "team")


def trend_sorted(trend: DataFrame) -> DataFrame:
    """Goals per matchday in the order of matchdays."""
    return trend.orderBy(F.col("matchday").asc_nulls_first())


def group_list(standings: DataFrame) -> DataFrame:
    return standings.select("group").dropna().distinct().orderBy("group")


def group_table(standings: DataFrame, group: str) -> DataFrame:
    t = standings.filter(F.col("group") == group).orderBy("group_rank", "team")
    return t.select(*[F.col(c).alias(label) for c, label in GROUP_TABLE_LABELS.items()])


def form_spaced(form: DataFrame) -> DataFrame:
    return form.withColumn("form", spaced("form"))


def kpi_matches_played(matches: DataFrame) -> DataFrame:
    return matches.agg(F.count_if(F.col("status") == FINISHED).alias("finished"), F.count(F.lit(1)).alias("total"))


def kpi_total_goals(trend: DataFrame) -> DataFrame:
    return trend.agg(F.coalesce(F.sum("goals"), F.lit(0)).cast("long").alias("total_goals"))


def kpi_distinct_teams(standings: DataFrame) -> DataFrame:
    return standings.agg(F.count_distinct("team").alias("teams"))


def kpi_avg_goals(trend: DataFrame) -> DataFrame:
    """The tile shows the unweighted mean of the rounded per-matchday
    averages; the weighted ratio is exposed beside it."""
    return trend.agg(
        F.round(F.avg("avg_goals_per_match"), 6).alias("avg_goals_per_match"),
        F.round(F.try_divide(F.sum("goals").cast("double"), F.sum("matches_played")), 6).alias("weighted_avg"),
    )


def kpis(matches: DataFrame, standings: DataFrame, trend: DataFrame) -> dict[str, DataFrame]:
    """The four KPI tiles, each a one-row aggregate."""
    return {
        "matches_played": kpi_matches_played(matches),
        "total_goals": kpi_total_goals(trend),
        "distinct_teams": kpi_distinct_teams(standings),
        "avg_goals": kpi_avg_goals(trend),
    }


def freshness(df: DataFrame, ts_col: str = "ingested_at") -> DataFrame:
    """Is data available, and how recent is it."""
    return df.agg(
        (F.count(F.lit(1)) > 0).alias("available"),
        F.max(ts_col).alias("latest_ingested_at"),
        F.count(F.lit(1)).alias("rows"),
    )
