"""Group standings: one row per (group, team) with W/D/L, goals, points, rank."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreline.functions import FINISHED, flag, points, side_outcome
from scoreline.session import scratch_path, shared_dir

RANK_ORDER = ["points", "goal_difference", "goals_for"]


def unpivot_sides(matches: DataFrame, carry: Sequence[str] = (), goals: bool = True) -> DataFrame:
    """Finished matches -> two rows each, one per side (team, group, gf, ga, result, venue, outcome).

    One scan of the input: ``inline(array(home, away))`` instead of a union
    of two projections of the same plan. ``carry`` columns ride along;
    ``goals=False`` leaves out group and scores (fields inside the generated
    structs are not pruned by the optimizer, so callers say what they need).
    """
    finished = matches.filter(F.col("status") == FINISHED)

    def side(team: str, gf: str, ga: str, venue: str) -> Column:
        fields = [F.col(team).alias("team")]
        if goals:
            fields += [F.col("group").alias("group"), F.col(gf).alias("gf"), F.col(ga).alias("ga")]
        return F.struct(
            *fields,
            F.col("result").alias("result"),
            F.lit(venue).alias("venue"),
            *[F.col(c).alias(c) for c in carry],
        )

    sides = finished.select(
        F.inline(
            F.array(
                side("home_team", "home_score", "away_score", "home"),
                side("away_team", "away_score", "home_score", "away"),
            )
        )
    )
    return sides.withColumn("outcome", side_outcome("result", "venue"))


def aggregate(sides: DataFrame) -> DataFrame:
    """Per (group, team): played, won, drawn, lost, goals_for, goals_against, points, goal_difference."""
    o = F.col("outcome")
    return (
        sides.groupBy("group", "team")
        .agg(
            F.count(F.lit(1)).alias("played"),
            F.sum(flag(o == "W")).cast("long").alias("won"),
            F.sum(flag(o == "D")).cast("long").alias("drawn"),
            F.sum(flag(o == "L")).cast("long").alias("lost"),
            F.sum("gf").cast("long").alias("goals_for"),
            F.sum("ga").cast("long").alias("goals_against"),
            F.sum(points(o)).cast("long").alias("points"),
        )
        .withColumn("goal_difference", F.col("goals_for") - F.col("goals_against"))
    )


#: What incremental standings are kept as: sums that deltas add to, and how many scores they hold.
SUMS = ["played", "won", "drawn", "lost", "goals_for", "goals_against", "points", "scored", "conceded"]


def deltas(old: DataFrame, new: DataFrame) -> DataFrame:
    """What replacing the matches ``old`` by ``new`` adds to each (group, team): `SUMS`, rows of zeros left out.

    Old rows are taken back and new ones added in one aggregate, so a match that
    is in both, or that moves between groups or teams, needs no case of its own.
    """
    sides = unpivot_sides(new).withColumn("_sign", F.lit(1)).unionByName(unpivot_sides(old).withColumn("_sign", F.lit(-1)))
    o, sign = F.col("outcome"), F.col("_sign")
    each = {
        "played": F.lit(1), "won": flag(o == "W"), "drawn": flag(o == "D"), "lost": flag(o == "L"),
        "goals_for": F.coalesce("gf", F.lit(0)), "goals_against": F.coalesce("ga", F.lit(0)), "points": points(o),
        "scored": flag(F.col("gf").isNotNull()), "conceded": flag(F.col("ga").isNotNull()),
    }
    moved = sides.groupBy("group", "team").agg(*[F.sum(sign * v).cast("long").alias(c) for c, v in each.items()])
    return moved.filter(F.exists(F.array(*SUMS), lambda x: x != 0))


def add_deltas(totals: DataFrame, delta: DataFrame) -> DataFrame:
    """The totals after ``delta``; a team without a finished match goes."""
    both = totals.select("group", "team", *SUMS).unionByName(delta.select("group", "team", *SUMS))
    added = both.groupBy("group", "team").agg(*[F.sum(c).cast("long").alias(c) for c in SUMS])
    return added.filter("played > 0")


def from_totals(totals: DataFrame) -> DataFrame:
    """The unranked standings that ``totals`` stand for, as `aggregate` gives them."""
    gf = F.when(F.col("scored") > 0, F.col("goals_for"))
    ga = F.when(F.col("conceded") > 0, F.col("goals_against"))
    rows = totals.withColumns({"goals_for": gf, "goals_against": ga}).drop("scored", "conceded")
    return rows.withColumn("goal_difference", F.col("goals_for") - F.col("goals_against"))


def rank_within(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[str],
    name: str = "group_rank",
) -> DataFrame:
    """SQL ``rank()`` over ``partition`` by ``order`` (each descending, nulls last).

    A plain window would put a whole partition into one task, and a group is a
    hot key (5 groups hold every team). The rank of a row is one plus the rows
    of its partition with a greater first column, plus those with the same one
    that sort before it. Both come from histograms (partial aggregation): over
    the distinct values of the first column per partition, and over the
    distinct tuples per partition and first column, whose windows are as many
    as there are values. The ranks are joined back by the tuple.
    """
    partition, order = list(partition), list(order)
    first, rest = order[0], order[1:]
    hist = df.groupBy(*partition, *order).agg(F.count(F.lit(1)).alias("_n"))
    before = lambda keys, by: (
        Window.partitionBy(*keys)
        .orderBy(*[F.col(c).desc_nulls_last() for c in by])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    top = hist.groupBy(*partition, first).agg(F.sum("_n").alias("_n"))
    above = F.coalesce(F.sum("_n").over(before(partition, [first])), F.lit(0))
    tops = [*partition, first]
    top = top.select(*[F.col(c).alias(f"_t{i}") for i, c in enumerate(tops)], above.alias("_above"))
    same = F.coalesce(F.sum("_n").over(before(tops, rest)), F.lit(0)) if rest else F.lit(0)
    hist = hist.withColumn("_same", same)
    hist = hist.join(top, [F.col(c).eqNullSafe(F.col(f"_t{i}")) for i, c in enumerate(tops)])
    keys = partition + order
    hist = hist.select(
        *[F.col(c).alias(f"_rk{i}") for i, c in enumerate(keys)], (F.col("_above") + F.col("_same") + 1).cast("int").alias(name)
    )
    cond = [F.col(c).eqNullSafe(F.col(f"_rk{i}")) for i, c in enumerate(keys)]
    return df.join(hist, cond, "inner").select(*df.columns, name)


def counts_before(hist: DataFrame, partition: Sequence[str], order: Sequence[Column], count: str, name: str) -> DataFrame:
    """``hist`` with the sum of ``count`` over the rows of its partition that come before a row in ``order``.

    The rows are range-partitioned by (partition, order) and written with the
    number of their range. Running sums are taken inside a range; the totals of
    the ranges, a row for each range that a partition lies in, give what comes
    before it. So one partition may hold all rows: no window sees more of them
    than a range has. ``order`` must tell the rows of a partition apart.
    """
    partition = list(partition)
    ranges = int(hist.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = hist.repartitionByRange(ranges, *[F.col(c).asc_nulls_first() for c in partition], *order)
    dealt = dealt.withColumn("_range", F.spark_partition_id())
    path = scratch_path(hist.sparkSession, "ranges")
    dealt.write.parquet(path)  # ranges come from a sample: both readers must see the same ones
    dealt = hist.sparkSession.read.schema(dealt.schema).parquet(path)
    inside = Window.partitionBy("_range", *partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = dealt.withColumn("_own", F.coalesce(F.sum(count).over(inside), F.lit(0)))
    totals = dealt.groupBy("_range", *partition).agg(F.sum(count).alias("_total"))
    earlier = Window.partitionBy(*partition).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    keys = ["_range", *partition]
    offsets = totals.select(
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(keys)], F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset")
    )
    both = own.join(offsets, [F.col(c).eqNullSafe(F.col(f"_o{i}")) for i, c in enumerate(keys)])
    return both.select(*hist.columns, (F.col("_own") + F.col("_offset")).alias(name))


def rank_by_ranges(df: DataFrame, partition: Sequence[str], order: Sequence[str], name: str = "group_rank") -> DataFrame:
    """`rank_within` for partitions of any size and any values: ranks come from the prefix sums of `counts_before`.

    The tuples of a partition and its order are counted first, so ties are one
    row and never lie across a border. ``df`` is read twice.
    """
    keys = [*partition, *order]
    hist = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    ranks = counts_before(hist, partition, [F.col(c).desc_nulls_last() for c in order], "_n", "_before")
    ranks = ranks.select(*[F.col(c).alias(f"_rk{i}") for i, c in enumerate(keys)], (F.col("_before") + 1).cast("int").alias(name))
    cond = [F.col(c).eqNullSafe(F.col(f"_rk{i}")) for i, c in enumerate(keys)]
    return df.join(ranks, cond, "inner").select(*df.columns, name)


#: Teams up to which a rank by two windows is cheaper than writing ranges.
RANGES_FROM = 1_000_000


def ranked(table: DataFrame, ranges_from: int = RANGES_FROM) -> DataFrame:
    """A stored table of unranked standings with its rank in the group, equal whichever way it is found."""
    if table.count() > ranges_from:
        return rank_by_ranges(table, ["group"], RANK_ORDER)
    return rank_within(table, ["group"], RANK_ORDER)


def compute(matches: DataFrame, materialize: bool = False) -> DataFrame:
    """Ranked standings from silver matches (finished matches only).

    The rank reads the per-team table twice (rows and score histogram).
    ``materialize`` first writes that table with a reliable ``checkpoint()``
    to the shared checkpoint folder, so the matches are aggregated once; the
    table holds one row per team, far fewer than matches.
    """
    agg = aggregate(unpivot_sides(matches))
    if materialize:
        shared_dir(agg.sparkSession)  # make sure a checkpoint folder is set
        return ranked(agg.checkpoint(eager=True))
    return rank_within(agg, ["group"], RANK_ORDER)


STANDINGS_COLUMNS = [
    "group",
    "team",
    "played",
    "won",
    "drawn",
    "lost",
    "goals_for",
    "goals_against",
    "points",
    "goal_difference",
    "group_rank",
]
