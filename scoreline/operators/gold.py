"""Gold aggregates: current standings, top scorers, team form, goals per matchday."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreline.functions import FINISHED, round_ratio
from scoreline.operators.standings import unpivot_sides

# Column order of the current-standings table (goal difference before points).
CURRENT_COLUMNS = [
    "group",
    "team",
    "played",
    "won",
    "drawn",
    "lost",
    "goals_for",
    "goals_against",
    "goal_difference",
    "points",
    "group_rank",
]


def standings_current(scd2_table: DataFrame) -> DataFrame:
    """Open SCD2 versions only. A multi-file table has no row order; ``serving.standings_sorted`` reads it in order."""
    return scd2_table.filter(F.col("is_current")).select(*CURRENT_COLUMNS)


def top_scorers(events: DataFrame, goal_type: str = "goal") -> DataFrame:
    """Goals per (player, team); partial aggregation absorbs a prolific player."""
    return (
        events.filter(F.col("event_type") == goal_type)
        .groupBy("player", "team")
        .agg(F.count(F.lit(1)).alias("goals"))
    )


def team_form(matches: DataFrame) -> DataFrame:
    """Per team, the W/D/L letters of its finished matches by matchday (ties by letter).

    Rows are first counted per (team, matchday, letter) so the ordered list
    that is collected per team is bounded by 3 x matchdays, whatever the
    number of matches; the string is then rebuilt with ``repeat``.
    """
    sides = unpivot_sides(matches, carry=["matchday"], goals=False).select(
        "team", "matchday", F.coalesce(F.col("outcome"), F.lit("D")).alias("outcome")
    )
    per_day = sides.groupBy("team", "matchday", "outcome").agg(F.count(F.lit(1)).alias("n"))
    ordered = per_day.groupBy("team").agg(
        F.sort_array(F.collect_list(F.struct("matchday", "outcome", "n"))).alias("ordered")
    )
    return ordered.select(
        "team",
        F.array_join(F.transform("ordered", lambda x: F.repeat(x["outcome"], x["n"].cast("int"))), "").alias("form"),
    )


def goals_by_matchday(matches: DataFrame) -> DataFrame:
    """Goals, matches played and the rounded average per matchday (finished matches)."""
    return (
        matches.filter(F.col("status") == FINISHED)
        .groupBy("matchday")
        .agg(
            F.sum(F.col("home_score") + F.col("away_score")).cast("long").alias("goals"),
            F.count(F.lit(1)).alias("matches_played"),
        )
        .withColumn("avg_goals_per_match", round_ratio("goals", "matches_played", 2))
    )
