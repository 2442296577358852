"""Silver: normalise, deduplicate (keep-latest, total order) and type bronze rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreline.functions import instant, lenient_int, match_result
from scoreline.operators.dedup import keep_latest

SILVER_TEAM_COLUMNS = ["name", "group", "ingested_at", "source_name"]


def _order_ts(c: str = "ingested_at"):
    # Landing stamps are ISO-8601 text with an offset; order them as instants.
    return instant(c)


def teams(bronze: DataFrame) -> DataFrame:
    """Trim first, drop empty names, then keep the latest row per name."""
    t = bronze.withColumn("name", F.trim("name")).filter(F.col("name").isNotNull() & (F.col("name") != ""))
    t = t.select(*SILVER_TEAM_COLUMNS).withColumn("_ts", _order_ts())
    return keep_latest(t, ["name"], ["_ts"]).drop("_ts")


def typed_matches(bronze: DataFrame) -> DataFrame:
    """Lenient int typing of scores and matchday (junk -> null); what is an int already stays as it is."""
    text = [c for c, kind in bronze.dtypes if c in ("home_score", "away_score", "matchday") and kind != "int"]
    return bronze.withColumns({c: lenient_int(c) for c in text})


def with_meeting(matches: DataFrame, order: list[str], within: list[str] | None = None) -> DataFrame:
    """Number the meetings of a pair that carry no matchday (scraped boxes): ``meeting`` is 0 where a matchday
    is known, else the row's number among those of its pair and stamp, in the order of the other columns.

    A number that a row already has (from a stored silver table) stays. ``within``
    names columns that follow from the pair, by which the rows are shuffled already.
    """
    within = within or []
    if "meeting" not in matches.columns:
        matches = matches.withColumn("meeting", F.lit(None).cast("int"))
    known = F.col("matchday").isNotNull()
    done = matches.filter(known | F.col("meeting").isNotNull())
    done = done.withColumn("meeting", F.when(known, 0).otherwise(F.col("meeting")))
    return done.unionByName(_numbered(matches.filter(~known & F.col("meeting").isNull()), order, within))


def _numbered(matches: DataFrame, order: list[str], within: list[str]) -> DataFrame:
    """Matches without a matchday, numbered among those of their pair and stamp."""
    rest = [c for c in matches.columns if c not in ("home_team", "away_team", "matchday", "meeting", *order, *within)]
    w = Window.partitionBy(*within, "home_team", "away_team", order[0]).orderBy(*order[1:], *rest)
    return matches.withColumn("meeting", F.row_number().over(w))


def matches(bronze: DataFrame, tiebreak: list[str] | None = None, within: list[str] | None = None) -> DataFrame:
    """Latest row per (home_team, away_team, matchday, meeting), typed, with ``result``; ``within`` as in `with_meeting`."""
    t = typed_matches(bronze).withColumn("_ts", _order_ts())
    order = ["_ts"] + list(tiebreak or [])
    keys = [*(within or []), "home_team", "away_team", "matchday", "meeting"]
    if "meeting" in t.columns or within:
        latest = keep_latest(with_meeting(t, order, within), keys, order)
    else:
        # matches with a matchday and those without share no key; the latter are shuffled once, by pair, for both steps
        known = F.col("matchday").isNotNull()
        pairs = t.filter(~known).repartition("home_team", "away_team")
        latest = keep_latest(t.filter(known).withColumn("meeting", F.lit(0)), keys, order)
        latest = latest.unionByName(keep_latest(_numbered(pairs, order, []), keys, order))
    return latest.drop("_ts").withColumn("result", match_result("status", "home_score", "away_score"))


def stadiums(bronze: DataFrame) -> DataFrame:
    """Latest row per stadium name and city, names trimmed, capacity typed; nameless rows go."""
    t = bronze.withColumns({c: F.trim(c) for c in ("name", "city")}).filter("name <> ''")
    t = t.withColumn("capacity", lenient_int("capacity")).withColumn("_ts", _order_ts())
    columns = ["name", "city", "country", "capacity", "ingested_at", "source_name"]
    return keep_latest(t.select(*columns, "_ts"), ["name", "city"], ["_ts"]).drop("_ts")


def events(bronze: DataFrame) -> DataFrame:
    """Latest delivery per event id, minute typed."""
    e = bronze.withColumn("minute", lenient_int(F.col("minute").cast("string")))
    return keep_latest(e, ["event_id"], ["ingested_at"])
