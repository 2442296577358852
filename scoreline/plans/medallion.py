"""One batch run: landing -> bronze -> silver -> SCD2 standings -> gold -> checks.

Every stage is a DataFrame function; the only materialisation points are the
table writes. Silver is incremental: the silver snapshot before this batch
plus only the bronze rows of this batch are deduplicated (keep-latest), so a
run shuffles the new data and the current state, not all of bronze. The newest
payload is found from the landing folders and parsed once for all entities.
Bronze keeps a folder for each ``batch_id`` and overwrite tables a snapshot
(see ``sources.io``); every stage reads what was committed before ``batch_id``,
and the SCD2 stamp is a parameter, so rerunning a batch id replaces its own
output and reproduces it.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreline.functions import instant, lenient_int
from scoreline.operators import bronze, gold, quality, scd2, silver, standings
from scoreline.schemas import EVENTS, MATCHES_RAW, STADIUMS_RAW, STANDINGS_COMPARE, STANDINGS_KEYS, TEAMS_RAW
from scoreline.sources import landing
from scoreline.sources.buckets import Buckets
from scoreline.sources.io import Tables, snapshot_id

BRONZE = {"teams": TEAMS_RAW, "stadiums": STADIUMS_RAW, "matches": MATCHES_RAW}
SILVER = (
    ("silver_teams", "teams", silver.teams),
    ("silver_stadiums", "stadiums", silver.stadiums),
    ("silver_matches", "matches", silver.matches),
)


@dataclass
class RunReport:
    batch_id: int
    rows: dict[str, int] = field(default_factory=dict)
    checks: list[dict] = field(default_factory=list)


def _bronze(tables: Tables, docs: DataFrame, report: RunReport) -> DataFrame:
    """This batch's entities, and the documents that can't be read, into bronze, in place of what an earlier attempt
    of the batch wrote; returns the readable documents."""
    docs = docs.persist()  # parsed once for the three entities
    try:
        report.rows["bronze_rejected"] = tables.append_batch(landing.malformed(docs), "bronze_rejected", report.batch_id)
        for entity in BRONZE:
            rows = _entity(landing.sound(docs), entity)
            report.rows[f"bronze_{entity}"] = tables.append_batch(rows, f"bronze_{entity}", report.batch_id)
    finally:
        docs.unpersist()
    return landing.sound(docs)


def _entity(docs: DataFrame, entity: str) -> DataFrame:
    rows = bronze.align(landing.explode_entity(docs, entity), BRONZE[entity], keep=["ingested_at", "source_name"])
    rows = rows.withColumn("ingest_date", F.to_date(instant("ingested_at")))
    return rows.withColumn("capacity", lenient_int("capacity")) if entity == "stadiums" else rows


def _incremental(tables: Tables, name: str, entity: str, batch_id: int, docs: DataFrame, build) -> DataFrame:
    """``build`` over (the snapshot of ``name`` before this batch) + (this batch's bronze rows)."""
    schema = _entity(docs, entity).schema
    new = tables.read_batches(f"bronze_{entity}", schema, [batch_id]).drop("ingest_date", "batch_id")
    prev = tables.snapshot_before(name, batch_id)
    if prev is not None:
        old = tables.read(name, prev)
        kept = [c for c in [*new.columns, "meeting"] if c in old.columns]
        types = dict(new.dtypes)
        old = old.select(*[F.col(c).cast(types.get(c, "int")).alias(c) for c in kept])
        new = old.unionByName(new, allowMissingColumns=True)
    return build(new)


def _events(spark: SparkSession, tables: Tables, events_dir: str, checkpoint: str, batch_id: int, report: RunReport) -> None:
    """Event files -> bronze (each file once, file-stream checkpoint) -> silver (keep-latest per event id,
    only the buckets that new files touch) -> gold top scorers. No bronze yet -> skipped."""
    from scoreline.sources.io import path_exists
    from scoreline.streaming import events as stream_events

    if path_exists(spark, events_dir):
        stream_events.land_events(spark, events_dir, tables.path("bronze_match_events"), checkpoint)
    if not tables.exists("bronze_match_events"):
        report.rows["silver_events"] = 0
        return
    store = Buckets(tables, "silver_events", ["event_id"])
    stream_events.upsert_events(spark, tables.path("bronze_match_events"), store, f"{checkpoint}_silver")
    stored = store.read(EVENTS)
    report.rows["silver_events"] = stored.count()
    report.rows["gold_top_scorers"] = tables.overwrite(gold.top_scorers(stored), "gold_top_scorers", batch_id)


def run(
    spark: SparkSession,
    tables: Tables,
    landing_dir: str,
    batch_id: int,
    as_of: dt.datetime,
    teams_dim: DataFrame | None = None,
    enforce: bool = True,
    events_dir: str | None = None,
    keep_snapshots: int | None = None,
) -> RunReport:
    """Land the newest payload into bronze, rebuild silver incrementally, apply
    standings to the SCD2 history, rebuild gold, run the checks (raising on a
    failure when ``enforce``). With ``events_dir``, new event files are landed
    and silver events / gold top scorers rebuilt as well."""
    report = RunReport(batch_id)
    docs = _bronze(tables, landing.read_latest(spark, landing_dir, tolerant=True), report)

    # silver (incremental over the snapshots before this batch)
    for name, entity, build in SILVER:
        rows = _incremental(tables, name, entity, batch_id, docs, build)
        report.rows[name] = tables.overwrite(rows, name, batch_id)
    stored = tables.read("silver_matches", snapshot_id(batch_id))

    # SCD2 standings from the stored silver table. Each run writes one snapshot
    # partitioned by is_current: the open versions (rewritten, O(teams)) and
    # the versions it closed (written once); older history is not touched.
    incoming = standings.compute(stored, materialize=True).select(*standings.STANDINGS_COLUMNS)
    shape = scd2.initial(incoming, as_of).schema
    prev = tables.snapshot_before("silver_standings", batch_id)
    if prev is not None:
        open_versions = scd2.current(tables.read("silver_standings", prev, schema=shape))
        table = scd2.apply(open_versions, incoming, STANDINGS_KEYS, STANDINGS_COMPARE, as_of)
    else:
        table = scd2.initial(incoming, as_of)
    report.rows["silver_standings"] = tables.overwrite(table, "silver_standings", batch_id, partition_by=["is_current"])
    history = tables.read("silver_standings", snapshot_id(batch_id), schema=shape)

    # gold
    cur = gold.standings_current(history)
    report.rows["gold_standings_current"] = tables.overwrite(cur, "gold_standings_current", batch_id)
    report.rows["gold_team_form"] = tables.overwrite(gold.team_form(stored), "gold_team_form", batch_id)
    trend = gold.goals_by_matchday(stored)
    report.rows["gold_goals_by_matchday"] = tables.overwrite(trend, "gold_goals_by_matchday", batch_id)
    if events_dir is not None:
        _events(spark, tables, events_dir, tables.path("_checkpoints/bronze_match_events"), batch_id, report)

    # checks on every stored gold table
    dim = teams_dim if teams_dim is not None else tables.read("silver_teams", snapshot_id(batch_id))
    current = tables.read("gold_standings_current", snapshot_id(batch_id))
    form = tables.read("gold_team_form", snapshot_id(batch_id))
    trend = tables.read("gold_goals_by_matchday", snapshot_id(batch_id))
    checks = [
        quality.table_checks(current, "standings", not_null=["team"], non_negative=["points"], known=("team", dim, "name")),
        quality.table_checks(form, "team_form", not_null=["team", "form"]),
        quality.table_checks(trend, "goals_by_matchday", not_null=["matchday"], non_negative=["goals"]),
        quality.table_checks(
            stored, "matches", not_null=["home_team", "away_team"], rules={"finished_have_scores": quality.finished_without_score()}
        ),
    ]
    if "gold_top_scorers" in report.rows:
        scorers = tables.read("gold_top_scorers", snapshot_id(batch_id))
        checks.append(quality.table_checks(scorers, "top_scorers", not_null=["player"], non_negative=["goals"]))
    rep = quality.report(checks)
    if enforce:
        report.checks = quality.enforce(rep, quality.unknown(current, "team", dim, "name"))
    else:
        report.checks = [r.asDict() for r in rep.collect()]  # one row per check
    if keep_snapshots is not None:
        events = Buckets(tables, "silver_events", ["event_id"])
        events.retain(before=[0, *events.versions()][-keep_snapshots:][0])
        for name in [n for n in report.rows if not n.startswith("bronze_") and n != "silver_events"]:
            tables.retain(name, keep_snapshots, only="is_current=true" if name == "silver_standings" else None)
    return report
