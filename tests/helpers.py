from pyspark.sql import types as T

MATCH_SCHEMA = T.StructType(
    [
        T.StructField("home_team", T.StringType()),
        T.StructField("away_team", T.StringType()),
        T.StructField("home_score", T.IntegerType()),
        T.StructField("away_score", T.IntegerType()),
        T.StructField("group", T.StringType()),
        T.StructField("matchday", T.IntegerType()),
        T.StructField("stadium", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)


def matches_df(spark, rows):
    """Silver-shaped matches (result computed like silver does)."""
    from scoreline.plans.derive import with_result

    return with_result(spark.createDataFrame(rows, MATCH_SCHEMA))


def by(rows, key):
    return {r[key]: r for r in rows}
