"""Deterministic deduplication.

``dropDuplicates`` keeps an arbitrary survivor, which over an append-only
bronze table can resurrect a stale row. Here the survivor is fixed by a total
order. It is written as an aggregate of ``max(struct(order..., rest...))``
rather than ``row_number()`` over a window: the partial aggregate collapses
every key to one row per map task before the shuffle, so a key that holds a
third of all rows costs one row per task in the exchange instead of landing
whole in a single sort. (A struct buffer isn't mutable in place, so Spark plans
sort aggregates: each task sorts its rows by key before the shuffle, and the
collapsed rows after it.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], fn) -> DataFrame:
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ranked = list(order) + [c for c in rest if c not in order]
    picked = df.groupBy(*keys).agg(fn(F.struct(*ranked)).alias("_pick"))
    return picked.select(*[F.col(f"_pick.{c}").alias(c) if c not in keys else F.col(c) for c in df.columns])


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key, the row that is greatest on ``order`` (descending, nulls last),
    remaining columns breaking any tie; other columns keep their position."""
    return _pick(df, keys, order, F.max)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key, the row that is least on ``order`` (ascending, nulls first)."""
    return _pick(df, keys, order, F.min)
