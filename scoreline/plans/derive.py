"""Domain tables derived from the supplied TPC-H-style parquet tables.

The supplied corpus has no tournament in it, so matches, teams, stadiums and
match events are derived from it by fixed rules (documented in FIXTURES.md):

* a match is a line item: the ordering customer plays at home against the
  supplier, scores come from quantity and line number, the group is the
  customer's region, the matchday is the ship month, the stadium the part
  brand and the order status says finished / live / scheduled;
* an event is a row of ``events``; purchases are goals.

Join order is chosen so the line-item-sized side is shuffled as few times as
possible: customer⋈(nation⋈region) and orders⋈customer are order-sized, and the
fact side then meets part, orders and supplier. Suppliers are broadcast up to
a number of rows; no other join is hinted: AQE broadcasts what its runtime size
check admits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreline.functions import match_result
from scoreline.operators.dedup import keep_latest

MATCH_KEYS = ["home_team", "away_team", "matchday"]
# Latest row first: ingestion time, then the line item's own columns.
MATCH_ORDER = ["ingested_at", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]
SILVER_MATCH_COLUMNS = [
    "home_team",
    "away_team",
    "home_score",
    "away_score",
    "group",
    "matchday",
    "stadium",
    "status",
    "result",
    "ingested_at",
]

# Fixed values of the derivation: order status -> match status, and the
# event-type renaming (purchase is a goal; view keeps its name).
STATUS_OF_ORDER = {"F": "finished", "P": "live", "O": "scheduled"}
EVENT_TYPE_OF = {"purchase": "goal", "error": "yellow_card", "signup": "red_card", "click": "substitution"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def nation_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")


def broadcast_if_small(df: DataFrame, max_rows: int = 500_000) -> DataFrame:
    """``df``, of narrow rows, with a broadcast hint if it has at most ``max_rows`` of them (some 50 MB)."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def raw_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed raw match rows with repeats (the append-only bronze picture)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    nr = nation_region(spark, sf_dir)

    cust_region = cust.join(nr, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", "r_name")
    order_side = orders.join(cust_region, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_orderstatus", "c_name", "r_name"
    )
    # the fact side is shuffled for parts and orders; supplier names join it after that, from a copy in each executor
    j = (
        li.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(order_side, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(broadcast_if_small(supp), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    scheduled = F.col("o_orderstatus") == "O"
    status = F.when(F.col("o_orderstatus") == "F", STATUS_OF_ORDER["F"]).when(
        F.col("o_orderstatus") == "P", STATUS_OF_ORDER["P"]
    ).otherwise(STATUS_OF_ORDER["O"])
    return j.select(
        F.col("c_name").alias("home_team"),
        F.col("s_name").alias("away_team"),
        F.when(scheduled, F.lit(None)).otherwise(F.col("l_quantity").cast("int") % 6).alias("home_score"),
        F.when(scheduled, F.lit(None)).otherwise(F.col("l_linenumber") % 5).alias("away_score"),
        F.col("r_name").alias("group"),
        ((F.year("l_shipdate") - 1995) * 12 + F.month("l_shipdate")).cast("int").alias("matchday"),
        F.col("p_brand").alias("stadium"),
        status.alias("status"),
        F.col("l_shipdate").alias("ingested_at"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_quantity",
        "l_extendedprice",
    )


def latest_matches(raw: DataFrame) -> DataFrame:
    """Keep-latest per match key, lineage columns still attached."""
    return keep_latest(raw, MATCH_KEYS, MATCH_ORDER)


def with_result(df: DataFrame) -> DataFrame:
    return df.withColumn("result", match_result("status", "home_score", "away_score"))


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver matches ``M``: deduplicated, typed, classified."""
    return with_result(latest_matches(raw_matches(spark, sf_dir))).select(*SILVER_MATCH_COLUMNS)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match events ``E`` in the canonical event schema."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", F.get_json_object("props", "$.k").alias("_k")
    )
    k = F.col("_k")  # the JSON key is extracted once per row
    renamed = F.create_map(*[F.lit(x) for kv in EVENT_TYPE_OF.items() for x in kv])
    etype = F.coalesce(renamed[F.col("event_type")], F.col("event_type"))
    return ev.select(
        F.col("event_id").cast("string").alias("event_id"),
        k.alias("home_team"),
        ((k.try_cast("int") + 50) % 100).cast("string").alias("away_team"),
        F.lit(None).cast("string").alias("group"),
        k.alias("team"),
        F.col("user_id").cast("string").alias("player"),
        etype.alias("event_type"),
        F.minute("ts").alias("minute"),
        F.col("ts").alias("ingested_at"),
    )


def teams(spark: SparkSession, sf_dir: str, include_suppliers: bool = True) -> DataFrame:
    """Snapshot teams (name, group, source_table): customers, and suppliers unless excluded."""
    nr = nation_region(spark, sf_dir)
    cust = table(spark, sf_dir, "customer").join(nr, F.col("c_nationkey") == F.col("n_nationkey"))
    out = cust.select(F.col("c_name").alias("name"), F.col("r_name").alias("group"))
    if include_suppliers:
        supp = table(spark, sf_dir, "supplier").join(nr, F.col("s_nationkey") == F.col("n_nationkey"))
        out = out.unionByName(supp.select(F.col("s_name").alias("name"), F.col("r_name").alias("group")))
    return out.withColumn("source_table", F.lit(None).cast("string"))


def stadiums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stadiums (name, city, country, capacity) from ``part``."""
    return table(spark, sf_dir, "part").select(
        F.col("p_name").alias("name"),
        F.col("p_type").alias("city"),
        F.col("p_brand").alias("country"),
        F.col("p_size").alias("capacity"),
    )


def landing_matches(raw: DataFrame) -> DataFrame:
    """Raw matches as a source sends them: scores as numbers, the away score
    as decimal text ('2.0'), and the score line 'h–a' once both are known."""
    h, a = F.col("home_score"), F.col("away_score")
    return raw.select(
        "home_team",
        "away_team",
        "home_score",
        F.when(a.isNotNull(), F.format_string("%d.0", a)).alias("away_score"),
        "group",
        "matchday",
        "stadium",
        "status",
        F.when(h.isNotNull() & a.isNotNull(), F.format_string("%d–%d", h, a)).alias("score"),
    )


def scheduled_matches(raw: DataFrame) -> DataFrame:
    """An earlier snapshot of the same fixtures: nothing played yet."""
    return raw.select(
        "home_team",
        "away_team",
        F.lit(None).cast("int").alias("home_score"),
        F.lit(None).cast("string").alias("away_score"),
        "group",
        "matchday",
        "stadium",
        F.lit("scheduled").alias("status"),
        F.lit(None).cast("string").alias("score"),
    )
