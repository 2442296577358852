"""Source registry: a name -> reader (spark, folder of tables) returning the three entity DataFrames in landing form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Reader = Callable[..., dict[str, DataFrame]]
_SOURCES: dict[str, Reader] = {}
DEFAULT_SOURCE = "snapshot"


def register(name: str):
    def deco(fn: Reader) -> Reader:
        _SOURCES[name] = fn
        return fn

    return deco


def get_source(name: str | None = None) -> Reader:
    name = name or DEFAULT_SOURCE
    if name not in _SOURCES:
        raise ValueError(f"unknown source {name!r}; known: {sorted(_SOURCES)}")
    return _SOURCES[name]


def names() -> list[str]:
    return sorted(_SOURCES)


@register("snapshot")
def snapshot_source(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> dict[str, DataFrame]:
    """Teams, stadiums and matches derived from the supplied tables; the matches from ``raw`` ones, if they are stored."""
    from scoreline.plans import derive

    if raw is None:
        raw = derive.raw_matches(spark, sf_dir)
    return {
        "teams": derive.teams(spark, sf_dir),
        "stadiums": derive.stadiums(spark, sf_dir),
        "matches": derive.landing_matches(raw),
    }


@register("html")
def html_source(spark: SparkSession, sf_dir: str, pages: DataFrame | None = None) -> dict[str, DataFrame]:
    """Teams, stadiums and match boxes (score text split) scraped from HTML pages: the ``pages`` table of
    ``sf_dir``, or those given."""
    from scoreline.sources import html_tables

    if pages is None:
        pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = html_tables.extract(pages)
    return {
        "teams": html_tables.team_names(rows),
        "stadiums": html_tables.stadiums(rows),
        "matches": html_tables.scored_matches(rows),
    }


def land(spark: SparkSession, source: str, sf_dir: str, landing_dir: str, fetched_at: str) -> None:
    """Read a source and land its entities as one batch stamped ``fetched_at``."""
    from scoreline.sources import landing

    landing.write_payload(landing_dir, fetched_at, source, **get_source(source)(spark, sf_dir))
