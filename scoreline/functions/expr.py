"""Scalar column expressions. All built-in Spark functions (JVM side, codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: result labels, status,
# points per outcome, feed icons and the trailing team-marker pattern.
FINISHED = "finished"
HOME_WIN, AWAY_WIN, DRAW = "home_win", "away_win", "draw"
POINTS_WIN, POINTS_DRAW, POINTS_LOSS = 3, 1, 0
EVENT_ICONS = {
    "goal": "⚽",
    "yellow_card": "\U0001f7e8",
    "red_card": "\U0001f7e5",
    "substitution": "\U0001f504",
}
DEFAULT_ICON = "•"
TEAM_MARKER = r"(?U)\s*\([A-Za-z]+\)\s*$"  # white space as in Unicode


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(ts) -> Column:
    """A TIMESTAMP_NTZ literal from a naive datetime or ISO text, exactly:
    through text, so neither the Python nor the session time zone moves it."""
    if isinstance(ts, Column):
        return ts.cast("timestamp_ntz")
    text = ts.isoformat(sep=" ") if hasattr(ts, "isoformat") else str(ts)
    return F.lit(text).cast("timestamp_ntz")


def instant(c: str | Column) -> Column:
    """ISO-8601 text (with or without offset) -> timestamp; unparsable -> null
    (plain ``to_timestamp`` raises under ANSI mode)."""
    c = col(c)
    return F.coalesce(c.try_cast("timestamp"), F.try_to_timestamp(c))


def lenient_int(c: str | Column) -> Column:
    """Text -> int the way a non-ANSI cast does it: blanks around are ignored,
    a decimal part is cut off ('3.7' -> 3), anything else ('5d', '1e3') is null."""
    digits = F.regexp_extract(col(c).cast("string"), r"^[\x00-\x20]*([+-]?[0-9]+)(?:\.[0-9]*)?[\x00-\x20]*$", 1)
    return F.when(digits != "", digits).try_cast("int")


def match_result(status: str | Column, home: str | Column, away: str | Column) -> Column:
    """home_win / away_win / draw for a finished match with both scores, else null."""
    status, home, away = col(status), col(home), col(away)
    played = F.coalesce((status == F.lit(FINISHED)) & home.isNotNull() & away.isNotNull(), F.lit(False))
    return (
        F.when(~played, F.lit(None).cast("string"))
        .when(home > away, F.lit(HOME_WIN))
        .when(home < away, F.lit(AWAY_WIN))
        .otherwise(F.lit(DRAW))
    )


def side_outcome(result: str | Column, venue: str | Column) -> Column:
    """W / D / L seen from one side of the match; null when there is no result."""
    result, venue = col(result), col(venue)
    won = ((venue == "home") & (result == HOME_WIN)) | ((venue == "away") & (result == AWAY_WIN))
    lost = ((venue == "home") & (result == AWAY_WIN)) | ((venue == "away") & (result == HOME_WIN))
    return F.when(won, "W").when(result == DRAW, "D").when(lost, "L")


def points(outcome: str | Column) -> Column:
    o = col(outcome)
    return F.when(o == "W", POINTS_WIN).when(o == "D", POINTS_DRAW).otherwise(POINTS_LOSS)


def flag(c: Column) -> Column:
    return F.when(c, 1).otherwise(0)


def round_ratio(num: str | Column, den: str | Column, places: int = 2) -> Column:
    """HALF_UP rounded ratio; a zero divisor gives null instead of an error."""
    return F.round(F.try_divide(col(num).cast("double"), col(den)), places)


def strip_marker(name: str | Column) -> Column:
    return F.regexp_replace(col(name), TEAM_MARKER, "")


def event_icon(event_type: str | Column) -> Column:
    icons = F.create_map(*[F.lit(x) for kv in EVENT_ICONS.items() for x in kv])
    return F.coalesce(icons[col(event_type)], F.lit(DEFAULT_ICON))


def event_line(minute, icon, player, team, home, away) -> Column:
    """``12' <icon> player (team) - home vs away``; null if any part is null."""
    return F.concat(
        col(minute).cast("string"),
        F.lit("' "),
        col(icon),
        F.lit(" "),
        col(player),
        F.lit(" ("),
        col(team),
        F.lit(") — "),
        col(home),
        F.lit(" vs "),
        col(away),
    )


def spaced(s: str | Column) -> Column:
    """'WDL' -> 'W D L'."""
    return F.concat_ws(" ", F.split(col(s), ""))


def has_class(classes: str | Column, token: str) -> Column:
    """HTML class attribute contains ``token`` as a whole word."""
    return F.array_contains(F.split(F.coalesce(col(classes), F.lit("")), r"\s+"), token)
