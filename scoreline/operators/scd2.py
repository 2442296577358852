"""Slowly changing dimension, type 2.

A table holds every version of a keyed row with ``effective_from``,
``effective_to`` (null while open) and ``is_current``. Applying a new snapshot:

* history (closed versions) passes through untouched and is never joined;
* open versions meet the new snapshot in ONE full outer join on the keys,
  null-safe so a null key matches itself;
* per joined pair, ``inline`` of a filtered array emits what survives: the
  unchanged open version, or the closed old version and/or the new version.

The stamp is a parameter, so a rerun with the same inputs is reproducible.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreline.functions import ntz

SCD_COLUMNS = ["effective_from", "effective_to", "is_current"]


def _ts(ts: dt.datetime | str | Column) -> Column:
    return ntz(ts)


def initial(df: DataFrame, ts) -> DataFrame:
    """First load: every row an open version stamped ``ts``."""
    return df.withColumns(
        {
            "effective_from": _ts(ts),
            "effective_to": F.lit(None).cast("timestamp_ntz"),
            "is_current": F.lit(True),
        }
    )


def merge(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    ts,
) -> DataFrame:
    """All rows of the new table version plus a ``change`` label per row:
    history, unchanged, closed or inserted."""
    keys, compare = list(keys), list(compare)
    attrs = [c for c in incoming.columns]
    out_cols = attrs + SCD_COLUMNS
    stamp = _ts(ts)
    is_open = F.coalesce(F.col("is_current"), F.lit(False))

    history = existing.filter(~is_open).select(F.lit("history").alias("change"), *out_cols)
    current = existing.filter(is_open).select(F.struct(*out_cols).alias("o"))
    new = incoming.select(F.struct(*attrs).alias("n"))

    on = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    j = current.join(new, on, "full_outer")
    o_in, n_in = F.col("o").isNotNull(), F.col("n").isNotNull()
    differs = F.lit(False)
    for c in compare:
        differs = differs | ~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
    changed = ~o_in | ~n_in | differs

    def rec(label: str, fields: list[Column]) -> Column:
        return F.struct(F.lit(label).alias("change"), *[f.alias(c) for f, c in zip(fields, out_cols)])

    unchanged = F.when(o_in & n_in & ~changed, rec("unchanged", [F.col(f"o.{c}") for c in out_cols]))
    closed = F.when(
        o_in & changed,
        rec("closed", [F.col(f"o.{c}") for c in attrs] + [F.col("o.effective_from"), stamp, F.lit(False)]),
    )
    inserted = F.when(
        n_in & changed,
        rec(
            "inserted",
            [F.col(f"n.{c}") for c in attrs] + [stamp, F.lit(None).cast("timestamp_ntz"), F.lit(True)],
        ),
    )
    versions = j.select(F.inline(F.filter(F.array(unchanged, closed, inserted), lambda x: x.isNotNull())))
    return history.unionByName(versions)


def apply(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], compare: Sequence[str], ts) -> DataFrame:
    """The new table version (``merge`` without the label)."""
    return merge(existing, incoming, keys, compare, ts).drop("change")


def changed_keys(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], compare: Sequence[str]) -> DataFrame:
    """Keys whose open version differs from the new snapshot: new, gone or changed."""
    keys = list(keys)
    current = existing.filter(F.coalesce(F.col("is_current"), F.lit(False))).select(F.struct(*incoming.columns).alias("o"))
    new = incoming.select(F.struct(*incoming.columns).alias("n"))
    on = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    j = current.join(new, on, "full_outer")
    differs = F.lit(False)
    for c in compare:
        differs = differs | ~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
    change = (
        F.when(F.col("o").isNull(), F.lit("new")).when(F.col("n").isNull(), F.lit("gone")).when(differs, F.lit("changed"))
    )
    return j.select(
        *[F.coalesce(F.col(f"o.{k}"), F.col(f"n.{k}")).alias(k) for k in keys], change.alias("change")
    ).filter(F.col("change").isNotNull())


def metrics(merged: DataFrame) -> DataFrame:
    """One row of version counts by change label, in one pass."""
    c = F.col("change")
    return merged.agg(
        F.count_if(c == "unchanged").alias("unchanged"),
        F.count_if(c == "closed").alias("closed"),
        F.count_if(c == "inserted").alias("inserted"),
        F.count_if(c == "history").alias("history"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(c.isin("unchanged", "inserted")).alias("current"),
    )


def as_of(table: DataFrame, ts) -> DataFrame:
    """The versions that were open at ``ts``."""
    t = _ts(ts)
    return table.filter((F.col("effective_from") <= t) & (F.col("effective_to").isNull() | (F.col("effective_to") > t)))


def as_of_join(
    facts: DataFrame, versions: DataFrame, on: dict[str, str], at: str, take: dict[str, str], bins: int = 64, many: int = 100_000
) -> DataFrame:
    """Each row of ``facts`` with the version of its key that was open at its own instant ``at``.

    ``on`` maps columns of ``facts`` to the key columns of ``versions`` (null
    matches null), ``take`` names what comes from the version; rows without an
    open version, or without an instant, have nulls there.

    It is an equi-join on the key. For keys with more than ``many`` facts, of
    which there are few, the time that the facts span is cut into ``bins``: a
    version of such a key is listed under the bins it was open in, a fact looks
    up its own bin, so a key with many facts and versions meets itself bin by
    bin. Versions of a key don't overlap, so that lists at most ``bins`` more of
    them for each of these keys; every other version is listed once.
    """
    low, high = facts.agg(F.min(at), F.max(at)).first()  # one-row control value
    span = (high - low).total_seconds() if low is not None else 0
    width = max(1, math.ceil(span / bins))

    def number(c: Column) -> Column:
        return F.floor((F.unix_micros(c.cast("timestamp")) - F.unix_micros(ntz(low).cast("timestamp"))) / (width * 1_000_000))

    keys = [F.col(k).alias(f"_k{i}") for i, k in enumerate(on.values())]
    taken = [F.col(c).alias(f"_v{i}") for i, c in enumerate(take)]
    shown = [F.col(f"_v{i}").alias(name) for i, name in enumerate(take.values())]
    if low is None:
        nothing = versions.select(*taken).limit(0)
        return facts.join(nothing, F.lit(False), "left").select(*facts.columns, *shown)
    # at most a row for each ``many`` facts
    large = facts.groupBy(*on).agg(F.count(at).alias("_n")).filter(F.col("_n") > many)
    large = F.broadcast(large.select(*[F.col(f).alias(f"_l{i}") for i, f in enumerate(on)], F.lit(True).alias("_large")))
    is_large = lambda names: [F.col(c).eqNullSafe(F.col(f"_l{i}")) for i, c in enumerate(names)]
    start, end = F.col("effective_from"), F.col("effective_to")
    ever = versions.filter((start <= ntz(high)) & (end.isNull() | (end > ntz(low))))
    listed = ever.select(*keys, *taken, start.alias("_from"), end.alias("_to"))
    start, end = F.col("_from"), F.col("_to")
    first = F.greatest(number(start), F.lit(0))
    last = F.when(end.isNull() | (end > ntz(high)), number(ntz(high))).otherwise(number(end))
    under = F.when(F.col("_large"), F.sequence(first, last)).otherwise(F.array(F.lit(0).cast("long")))
    listed = listed.join(large, is_large([f"_k{i}" for i in range(len(on))]), "left")
    listed = listed.withColumn("_vbin", F.explode(under)).drop("_large", *[f"_l{i}" for i in range(len(on))])
    own = facts.join(large, is_large(on), "left")
    own = own.withColumn("_bin", F.when(F.col("_large"), number(F.col(at))).otherwise(0)).select(*facts.columns, "_bin")
    met = [F.col(f).eqNullSafe(F.col(f"_k{i}")) for i, f in enumerate(on)]
    open_then = (F.col("_from") <= F.col(at)) & (F.col("_to").isNull() | (F.col(at) < F.col("_to")))
    joined = own.join(listed, [*met, F.col("_bin") == F.col("_vbin"), open_then], "left")
    return joined.select(*facts.columns, *shown)


def current(table: DataFrame) -> DataFrame:
    return table.filter(F.coalesce(F.col("is_current"), F.lit(False)))
