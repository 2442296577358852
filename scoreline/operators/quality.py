"""Data-quality checks and the live-match gate.

Every check is an aggregate over the table it guards (one pass per table);
results come back as rows ``(table, check, failed_rows, passed)``. Only the
few report rows ever reach the driver, in ``enforce``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreline.functions import FINISHED


def _rows(table: str, named: list[tuple[str, Column]]) -> list[Column]:
    return [
        F.struct(F.lit(table).alias("table"), F.lit(name).alias("check"), value.cast("long").alias("failed_rows"))
        for name, value in named
    ]


def table_checks(
    df: DataFrame,
    table: str,
    not_null: Sequence[str] = (),
    non_negative: Sequence[str] = (),
    known: tuple[str, DataFrame, str] | None = None,
    rules: dict[str, Column] | None = None,
) -> DataFrame:
    """Not-empty, no-null and non-negative checks, optional referential
    integrity of one column against a dimension column, and optional named
    ``rules`` (a row fails a rule when its predicate is true), in one aggregate."""
    src = df
    named: list[tuple[str, Column]] = []
    if known is not None:
        col, dim, dim_col = known
        names = dim.select(F.col(dim_col).alias("_known")).distinct()
        src = df.join(names, F.col(col) == F.col("_known"), "left")
    n = F.count(F.lit(1))
    named.append((f"{table}_not_empty", F.when(n == 0, 1).otherwise(0)))
    for c in not_null:
        named.append((f"{table}_no_null_{c}", F.count_if(F.col(c).isNull())))
    for c in non_negative:
        named.append((f"{table}_{c}_non_negative", F.count_if(F.col(c) < 0)))
    for name, failing in (rules or {}).items():
        named.append((f"{table}_{name}", F.count_if(F.coalesce(failing, F.lit(False)))))
    if known is not None:
        col = known[0]
        named.append(
            (f"all_{table}_{col}s_known", F.count_distinct(F.when(F.col("_known").isNull(), F.col(col))))
        )
    agg = src.agg(F.array(*_rows(table, named)).alias("r"))
    return agg.select(F.inline("r")).withColumn("passed", F.col("failed_rows") == 0)


def finished_without_score() -> Column:
    """A finished match lacking a score (it gets no result and no points)."""
    return (F.col("status") == FINISHED) & (F.col("home_score").isNull() | F.col("away_score").isNull())


def unknown(df: DataFrame, col: str, dim: DataFrame, dim_col: str) -> DataFrame:
    """Distinct values of ``df.col`` missing from ``dim.dim_col`` (one row each)."""
    names = dim.select(F.col(dim_col).alias(col))
    return df.select(col).filter(F.col(col).isNotNull()).join(names, col, "left_anti").distinct()


def report(checks: Iterable[DataFrame]) -> DataFrame:
    out = None
    for c in checks:
        out = c if out is None else out.unionByName(c)
    return out


def enforce(rep: DataFrame, unknown_values: DataFrame | None = None, shown: int = 20) -> list[dict]:
    """Raise with the failed checks and the first unknown values, sorted; return all report rows otherwise."""
    rows = [r.asDict() for r in rep.collect()]  # a handful of rows, one per check
    failed = {r["check"]: r["failed_rows"] for r in rows if not r["passed"]}
    if failed:
        names = [] if unknown_values is None else [r[0] for r in unknown_values.orderBy(unknown_values.columns[0]).limit(shown).collect()]
        raise ValueError(f"{len(failed)} of {len(rows)} checks found bad rows: {failed}" + (f"; unknown: {names}" if names else ""))
    return rows


def is_live(matches: DataFrame, done: Sequence[str] = (FINISHED,)) -> DataFrame:
    """One row: does any match have a status outside ``done``? A null status
    counts as live (it is not known to be done)."""
    finished = F.coalesce(F.col("status").isin(*done), F.lit(False))
    return matches.agg(
        F.coalesce(F.bool_or(~finished), F.lit(False)).alias("is_live"),
        F.count_if(~finished).alias("open_matches"),
    )
