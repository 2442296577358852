"""Declared schemas of every table the engine lands, reads or writes."""

from pyspark.sql import types as T

S = T.StringType()

# Bronze teams: both sources project onto this field set (missing -> null).
TEAM_FIELDS = ["name", "group", "source_table"]
TEAMS_RAW = T.StructType([T.StructField(c, S) for c in TEAM_FIELDS])

STADIUM_FIELDS = ["name", "city", "country", "capacity"]
STADIUMS_RAW = T.StructType([T.StructField(c, S) for c in STADIUM_FIELDS])

# Matches in landing form; every field is text until silver types it.
MATCH_FIELDS = [
    "home_team",
    "away_team",
    "home_score",
    "away_score",
    "group",
    "matchday",
    "stadium",
    "status",
    "score",
]
MATCHES_RAW = T.StructType([T.StructField(c, S) for c in MATCH_FIELDS])

# Match files of a stream: the landing fields with their stamp and source.
MATCHES_STREAM = T.StructType(
    [*MATCHES_RAW.fields, T.StructField("ingested_at", T.TimestampNTZType()), T.StructField("source_name", S)]
)

# One landing document: three entity lists plus the batch stamp.
PAYLOAD = T.StructType(
    [
        T.StructField("teams", T.ArrayType(TEAMS_RAW)),
        T.StructField("stadiums", T.ArrayType(STADIUMS_RAW)),
        T.StructField("matches", T.ArrayType(MATCHES_RAW)),
        T.StructField("fetched_at", S),
        T.StructField("source_name", S),
    ]
)

# Snapshot source variant: teams arrive as a map group -> list of names.
GROUP_MAP_PAYLOAD = T.StructType(
    [
        T.StructField("groups", T.MapType(S, T.ArrayType(S))),
        T.StructField("fetched_at", S),
        T.StructField("source_name", S),
    ]
)

# Match events, one JSON object each.
EVENTS = T.StructType(
    [
        T.StructField("event_id", S),
        T.StructField("home_team", S),
        T.StructField("away_team", S),
        T.StructField("group", S),
        T.StructField("team", S),
        T.StructField("player", S),
        T.StructField("event_type", S),
        T.StructField("minute", T.IntegerType()),
        T.StructField("ingested_at", T.TimestampNTZType()),
    ]
)

# Event files as they land: a line that is no event is kept as it came.
CORRUPT = "_corrupt_record"
EVENTS_LANDED = T.StructType([*EVENTS.fields, T.StructField(CORRUPT, S)])

# Columns whose change opens a new SCD2 version (goal_difference is derived).
STANDINGS_COMPARE = [
    "played",
    "won",
    "drawn",
    "lost",
    "goals_for",
    "goals_against",
    "points",
    "group_rank",
]
STANDINGS_KEYS = ["group", "team"]

# HTML extraction output: one row per <tr>.
HTML_ROWS = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("fetch", T.LongType()),
        T.StructField("table_no", T.IntegerType()),
        T.StructField("table_class", S),
        T.StructField("row_no", T.IntegerType()),
        T.StructField("cells", T.ArrayType(S)),
        T.StructField("cell_tags", T.ArrayType(S)),
        T.StructField("cell_classes", T.ArrayType(S)),
    ]
)
