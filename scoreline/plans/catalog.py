"""Query catalog: every registered key is a callable (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreline.functions import lenient_int, ntz
from scoreline.operators import bronze, gold, quality, scd2, serving, silver, standings
from scoreline.plans import derive, pages
from scoreline.schemas import EVENTS, STADIUMS_RAW, STANDINGS_COMPARE, STANDINGS_KEYS, TEAMS_RAW
from scoreline.session import SHUFFLES_GO, scratch_path, settings
from scoreline.sources import events as events_src
from scoreline.sources import files
from scoreline.sources import html_tables
from scoreline.sources import landing
from scoreline.sources.buckets import Buckets
from scoreline.sources.io import Tables, writer
from scoreline.sources.registry import get_source
from scoreline.streaming import events as stream_events
from scoreline.streaming import progress as stream_progress
from scoreline.streaming import standings as stream_standings_mod

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- standings (flagship) -------------------------------------------------


@query
def standings_ranked(spark, sf_dir):
    return standings.compute(_silver(spark, sf_dir), materialize=True).select(*standings.STANDINGS_COLUMNS)


@query
def standings_unranked(spark, sf_dir):
    return standings.aggregate(standings.unpivot_sides(_silver(spark, sf_dir)))


@query
def unpivot_sides(spark, sf_dir):
    return standings.unpivot_sides(_silver(spark, sf_dir))


@query
def silver_matches(spark, sf_dir):
    return derive.matches(spark, sf_dir)


@query
def silver_match_result(spark, sf_dir):
    return derive.with_result(derive.raw_matches(spark, sf_dir))


# --- shared inputs ----------------------------------------------------------

# Fixed parameters of the SCD2 snapshots: matchday cut-offs of the earlier ones (the last has every match) and stamps.
CUT0, CUT1 = 70, 79
T0, T1, T2 = dt.datetime(2026, 6, 13), dt.datetime(2026, 6, 20), dt.datetime(2026, 6, 27)
AS_OF = dt.datetime(2026, 6, 23)
KICK_OFF = dt.datetime(2026, 6, 10)
RECENT_N, TOP_N = 12, 8
SHOWN_GROUP = "AFRICA"


def _raw(spark, sf_dir):
    """The raw matches, for what is built from them twice: joined once per application and input folder, and stored."""

    def build(path):
        with settings(spark, SHUFFLES_GO):
            writer(derive.raw_matches(spark, sf_dir), "parquet").save(path)

    return spark.read.parquet(_once(spark, sf_dir, "raw_matches", build))


def _silver(spark, sf_dir):
    """The silver matches table, built from the raw tables once per application
    and input folder and stored in the shared folder; gold and serving read it,
    as gold reads the stored silver table in the layered design."""

    def build(root):
        Tables(spark, root).overwrite(derive.matches(spark, sf_dir), "silver_matches", 1)

    return Tables(spark, _once(spark, sf_dir, "silver", build)).read("silver_matches")


def _standings(spark, sf_dir, cutoff=None):
    m = _silver(spark, sf_dir)
    if cutoff is not None:
        m = m.filter(F.col("matchday") <= cutoff)
    return standings.compute(m, materialize=True).select(*standings.STANDINGS_COLUMNS)


def _scd2_inputs(spark, sf_dir):
    """The open versions as the earlier run stored them, and the current standings."""

    def build(root):
        Tables(spark, root).overwrite(scd2.initial(_standings(spark, sf_dir, CUT1), T1), "standings", 1)

    existing = Tables(spark, _once(spark, sf_dir, "standings_open", build)).read("standings")
    return existing, _standings(spark, sf_dir)


def _merged(spark, sf_dir):
    existing, incoming = _scd2_inputs(spark, sf_dir)
    return scd2.merge(existing, incoming, STANDINGS_KEYS, STANDINGS_COMPARE, T2)


def _merged_as(change):
    def q(spark, sf_dir):
        return _merged(spark, sf_dir).filter(F.col("change") == change).drop("change")

    return q


def _trend(spark, sf_dir):
    return gold.goals_by_matchday(_silver(spark, sf_dir))


# --- gold ---------------------------------------------------------------------


@query
def gold_standings_current(spark, sf_dir):
    existing, incoming = _scd2_inputs(spark, sf_dir)
    return gold.standings_current(scd2.apply(existing, incoming, STANDINGS_KEYS, STANDINGS_COMPARE, T2))


@query
def gold_top_scorers(spark, sf_dir):
    return gold.top_scorers(derive.events(spark, sf_dir))


@query
def gold_team_form(spark, sf_dir):
    return gold.team_form(_silver(spark, sf_dir))


@query
def gold_goals_by_matchday(spark, sf_dir):
    return _trend(spark, sf_dir)


# --- SCD2 ---------------------------------------------------------------------


@query
def scd2_initial(spark, sf_dir):
    return scd2.initial(_standings(spark, sf_dir, CUT1), T1)


@query
def scd2_changed_keys(spark, sf_dir):
    existing, incoming = _scd2_inputs(spark, sf_dir)
    return scd2.changed_keys(existing, incoming, STANDINGS_KEYS, STANDINGS_COMPARE)


QUERIES["scd2_closed"] = _merged_as("closed")
QUERIES["scd2_unchanged"] = _merged_as("unchanged")
QUERIES["scd2_inserted"] = _merged_as("inserted")


@query
def scd2_apply(spark, sf_dir):
    return _merged(spark, sf_dir).drop("change")


@query
def scd2_metrics(spark, sf_dir):
    return scd2.metrics(_merged(spark, sf_dir))


@query
def scd2_as_of(spark, sf_dir):
    return scd2.as_of(_merged(spark, sf_dir).drop("change"), AS_OF)


@query
def scd2_history(spark, sf_dir):
    """Three runs stored as snapshots (the last one twice, after an attempt that died), read as one history."""

    def build(root):
        t = Tables(spark, root)
        runs = {cutoff: _standings(spark, sf_dir, cutoff) for cutoff in (CUT0, CUT1, None)}
        for batch, (cutoff, stamp) in enumerate(((CUT0, T0), (CUT1, T1), (None, T2), (None, T2)), start=1):
            batch = min(batch, 3)
            incoming = runs[cutoff]  # a run repeated starts from the same standings
            prev = t.snapshot_before("standings", batch)
            if prev is None:
                table = scd2.initial(incoming, stamp)
            else:
                table = scd2.apply(scd2.current(t.read("standings", prev)), incoming, STANDINGS_KEYS, STANDINGS_COMPARE, stamp)
            t.overwrite(table, "standings", batch, partition_by=["is_current"])
        # a later run that died before its commit
        died = t.read("standings").withColumn("effective_to", ntz(T2))
        where = f"{t.path('standings')}/snapshot=000000000004"
        died.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy("is_current").parquet(where)

    return Tables(spark, _once(spark, sf_dir, "scd2_history", build)).read_versions("standings")


@query
def scd2_as_of_join(spark, sf_dir):
    """Matches with the standing that both teams had at kick-off, a fixed rule of the matchday around the three runs."""
    versions = scd2_history(spark, sf_dir)
    kick_off = ntz(KICK_OFF) + F.make_dt_interval(days=(F.col("matchday") % 21).cast("int"))
    rows = _silver(spark, sf_dir).select("home_team", "away_team", "matchday", "group", kick_off.alias("kick_off"))
    for side in ("home", "away"):
        take = {"points": f"{side}_points", "group_rank": f"{side}_rank"}
        rows = scd2.as_of_join(rows, versions, {"group": "group", f"{side}_team": "team"}, "kick_off", take)
    return rows


@query
def standings_overall_rank(spark, sf_dir):
    """All teams of all groups ranked as one: a single partition, cut into ranges."""
    rows = standings.aggregate(standings.unpivot_sides(_silver(spark, sf_dir)))
    return standings.rank_by_ranges(rows, [], standings.RANK_ORDER, "overall_rank").select(
        "group", "team", *standings.RANK_ORDER, "overall_rank"
    )


# --- serving --------------------------------------------------------------------


@query
def serve_recent_events(spark, sf_dir):
    return serving.recent_events(derive.events(spark, sf_dir), RECENT_N)


@query
def serve_event_icons(spark, sf_dir):
    return serving.with_icons(derive.events(spark, sf_dir)).select("event_id", "event_type", "icon")


@query
def serve_event_line(spark, sf_dir):
    return serving.with_lines(derive.events(spark, sf_dir)).select("event_id", "line")


@query
def serve_top_scorers(spark, sf_dir):
    return serving.top_scorers(gold.top_scorers(derive.events(spark, sf_dir)), TOP_N)


@query
def serve_standings_sorted(spark, sf_dir):
    return serving.standings_sorted(_gold(spark, sf_dir).read("gold_standings_current"))


@query
def serve_trend_sorted(spark, sf_dir):
    return serving.trend_sorted(_gold(spark, sf_dir).read("gold_goals_by_matchday"))


@query
def serve_group_list(spark, sf_dir):
    return serving.group_list(_standings(spark, sf_dir))


@query
def serve_group_table(spark, sf_dir):
    return serving.group_table(_standings(spark, sf_dir), SHOWN_GROUP)


@query
def serve_form_spaced(spark, sf_dir):
    return serving.form_spaced(gold.team_form(_silver(spark, sf_dir)))


@query
def serve_freshness(spark, sf_dir):
    return serving.freshness(_silver(spark, sf_dir), "ingested_at")


@query
def kpi_matches_played(spark, sf_dir):
    return serving.kpi_matches_played(_silver(spark, sf_dir))


@query
def kpi_total_goals(spark, sf_dir):
    return serving.kpi_total_goals(_trend(spark, sf_dir))


@query
def kpi_distinct_teams(spark, sf_dir):
    return serving.kpi_distinct_teams(_standings(spark, sf_dir))


@query
def kpi_avg_goals(spark, sf_dir):
    return serving.kpi_avg_goals(_trend(spark, sf_dir))


# --- quality and gate -----------------------------------------------------------


def _gold(spark, sf_dir) -> Tables:
    """The stored gold tables (current standings, goals per matchday, top
    scorers, team form), written once per application and input folder; the quality job
    checks what was stored, as a maintenance run after the gold build would."""

    def build(root):
        t = Tables(spark, root)
        t.overwrite(gold_standings_current(spark, sf_dir), "gold_standings_current", 1)
        t.overwrite(_trend(spark, sf_dir), "gold_goals_by_matchday", 1)
        t.overwrite(gold.top_scorers(derive.events(spark, sf_dir)), "gold_top_scorers", 1)
        t.overwrite(gold.team_form(_silver(spark, sf_dir)), "gold_team_form", 1)

    return Tables(spark, _once(spark, sf_dir, "gold", build))


def _teams_dim(spark, sf_dir):
    # The registered teams: customers only, so supplier sides are "unknown".
    return derive.teams(spark, sf_dir, include_suppliers=False)


@query
def dq_report(spark, sf_dir):
    g = _gold(spark, sf_dir)
    cur = g.read("gold_standings_current")
    trend = g.read("gold_goals_by_matchday")
    scorers = g.read("gold_top_scorers")
    return quality.report(
        [
            quality.table_checks(
                cur, "standings", not_null=["team"], non_negative=["points"], known=("team", _teams_dim(spark, sf_dir), "name")
            ),
            quality.table_checks(trend, "goals_by_matchday", not_null=["matchday"], non_negative=["goals"]),
            quality.table_checks(scorers, "top_scorers", not_null=["player"], non_negative=["goals"]),
            quality.table_checks(g.read("gold_team_form"), "team_form", not_null=["team", "form"]),
            quality.table_checks(
                _silver(spark, sf_dir),
                "matches",
                not_null=["home_team", "away_team"],
                rules={"finished_have_scores": quality.finished_without_score()},
            ),
        ]
    )


@query
def dq_unknown_teams(spark, sf_dir):
    return quality.unknown(_gold(spark, sf_dir).read("gold_standings_current"), "team", _teams_dim(spark, sf_dir), "name")


@query
def gate_live(spark, sf_dir):
    return quality.is_live(_silver(spark, sf_dir))


# --- landing, bronze, silver -----------------------------------------------------

# Fixed stamps of the two landing batches (an early all-scheduled snapshot,
# then the current one whose team names arrive padded).
BATCH_A = ("2026-06-20T00:00:00+00:00", "snapshot")
BATCH_B = ("2026-06-27T00:00:00+00:00", "snapshot")
_LANDED: dict[tuple[str, str, str], str] = {}


def _once(spark, sf_dir, what, build):
    """Write a fixture once per application and input folder; return its path."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _LANDED:
        path = scratch_path(spark, what)
        build(path)
        _LANDED[key] = path
    return _LANDED[key]


def _landing(spark, sf_dir):
    return landing.read_landing(spark, _landed(spark, sf_dir))


def _latest(spark, sf_dir):
    return landing.read_latest(spark, _landed(spark, sf_dir))


def _landed(spark, sf_dir):
    def build(path):
        raw = _raw(spark, sf_dir)
        src = get_source("snapshot")(spark, sf_dir, raw)
        landing.write_payload(
            path, *BATCH_A, teams=src["teams"], stadiums=src["stadiums"], matches=derive.scheduled_matches(raw)
        )
        padded = src["teams"].withColumn("name", F.concat(F.lit(" "), "name", F.lit("  ")))
        landing.write_payload(path, *BATCH_B, teams=padded, stadiums=src["stadiums"], matches=src["matches"])

    return _once(spark, sf_dir, "landing", build)


@query
def src_landing_json(spark, sf_dir):
    return landing.batch_summary(_landing(spark, sf_dir))


@query
def src_latest_batch(spark, sf_dir):
    return landing.batch_summary(_latest(spark, sf_dir))


@query
def src_explode_entities(spark, sf_dir):
    return landing.explode_entity(_latest(spark, sf_dir), "matches")


@query
def io_landing_roundtrip(spark, sf_dir):
    return landing.explode_entity(_landing(spark, sf_dir), "matches")


@query
def src_landing_tolerant(spark, sf_dir):
    """A batch landed twice, by a writer that died in between, and with a cut-off document for each nation and a
    document with an unknown field for each region among its files: what is read, and what is set aside."""

    def build(path):
        src = get_source("snapshot")(spark, sf_dir)
        for _ in range(2):
            landing.write_payload(path, *BATCH_B, teams=src["teams"], stadiums=src["stadiums"])
        folder = f"{path}/{landing.batch_folder(spark, *BATCH_B)}"
        nation, region = (derive.table(spark, sf_dir, t) for t in ("nation", "region"))
        broken = nation.select(F.concat(F.lit('{"teams": [{"name": "'), "n_name", F.lit('"')).alias("value"))
        stamp = f'"fetched_at": "{BATCH_B[0]}", "source_name": "{BATCH_B[1]}"'
        more = region.select(
            F.concat(F.lit('{"teams": [{"name": "'), "r_name", F.lit('"}], "owner": "'), "r_name", F.lit(f'", {stamp}}}')).alias("value")
        )
        broken.unionByName(more).write.mode("append").text(folder)
        died = f"{path}/{landing.batch_folder(spark, '2026-06-28T00:00:00+00:00', 'snapshot')}"
        more.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").text(died)

    docs = landing.read_latest(spark, _once(spark, sf_dir, "landing_tolerant", build), tolerant=True)
    good = landing.sound(docs)
    counts = [landing.explode_entity(good, e).agg(F.count("*").alias("n")).withColumn("kind", F.lit(e)) for e in ("teams", "stadiums")]
    counts.append(landing.malformed(docs).agg(F.count("*").alias("n")).withColumn("kind", F.lit("malformed")))
    owners = good.select(F.explode(landing.OTHER).alias("field", "value"))
    counts.append(owners.agg(F.count_distinct("value").alias("n")).withColumn("kind", F.lit("owners")))
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out.select("kind", "n")


@query
def src_registry(spark, sf_dir):
    return get_source("snapshot")(spark, sf_dir)["teams"]


@query
def src_group_map_flatten(spark, sf_dir):
    def build(path):
        landing.write_group_map(path, derive.teams(spark, sf_dir), *BATCH_B)

    return landing.flatten_group_map(landing.read_group_map(spark, _once(spark, sf_dir, "groupmap", build)))


@query
def bronze_align_schema(spark, sf_dir):
    cust = derive.teams(spark, sf_dir, include_suppliers=False).select("name", "group")
    supp = derive.table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.lit("group_stage").alias("source_table")
    )
    return bronze.align_all([cust, supp], TEAMS_RAW)


@query
def bronze_stamp(spark, sf_dir):
    st = bronze.align(derive.stadiums(spark, sf_dir), STADIUMS_RAW)
    return bronze.stamp(st, *BATCH_B).withColumn("capacity", lenient_int("capacity"))


@query
def silver_typed_cast(spark, sf_dir):
    """Scores as sources spell them, by matchday: plain, '5d', '5e3', '5.7', ' 5 ' and 'abc'."""
    latest = landing.explode_entity(_latest(spark, sf_dir), "matches")
    h, kind = F.col("home_score"), F.col("matchday").cast("int") % 6
    spelled = (
        F.when(kind == 1, F.concat(h, F.lit("d")))
        .when(kind == 2, F.concat(h, F.lit("e3")))
        .when(kind == 3, F.concat(h, F.lit(".7")))
        .when(kind == 4, F.concat(F.lit(" "), h, F.lit(" ")))
        .when(kind == 5, F.lit("abc"))
        .otherwise(h)
    )
    latest = latest.withColumn("home_score", spelled)
    return silver.typed_matches(latest).select("home_team", "away_team", "home_score", "away_score", "matchday", "status")


@query
def silver_teams(spark, sf_dir):
    return silver.teams(landing.explode_entity(_landing(spark, sf_dir), "teams"))


@query
def silver_stadiums(spark, sf_dir):
    return silver.stadiums(landing.explode_entity(_landing(spark, sf_dir), "stadiums"))


def _redelivered(spark, sf_dir):
    """Events plus a second, later delivery of every goal (the sweep re-reads files)."""
    e = derive.events(spark, sf_dir)
    again = e.filter(F.col("event_type") == "goal").withColumn(
        "ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 MINUTE")
    )
    return e.unionByName(again)


@query
def silver_events(spark, sf_dir):
    return silver.events(_redelivered(spark, sf_dir))


@query
def src_events_json(spark, sf_dir):
    path = _once(spark, sf_dir, "events_json", lambda p: events_src.write_events(derive.events(spark, sf_dir), p))
    return events_src.read_events(spark, path)


@query
def src_event_files(spark, sf_dir):
    """Events in pretty-printed files of up to 500, an object or an array each."""

    def build(path):
        e = derive.events(spark, sf_dir)
        rows = landing.bounded(e, 500).groupBy("_bucket", "_doc").agg(F.collect_list(F.struct(*EVENTS.fieldNames())).alias("l"))
        shape = {"pretty": "true", "timestampNTZFormat": events_src.NTZ_FORMAT}
        one, many = F.to_json(F.get("l", F.lit(0)), shape), F.to_json("l", shape)
        files.write_documents(rows.select(F.when(F.size("l") == 1, one).otherwise(many).alias("doc")), path, "doc")

    return files.read_event_files(spark, _once(spark, sf_dir, "event_files", build), "part-*")


@query
def html_team_names_files(spark, sf_dir):
    """Team names from pages that lie in a directory, one file a page."""

    def build(path):
        files.write_documents(_pages(spark, sf_dir, "team"), path, "html")

    pages_read = files.read_pages(spark, _once(spark, sf_dir, "page_files", build), "part-*")
    return html_tables.team_names(html_tables.extract(pages_read))


@query
def io_roundtrip(spark, sf_dir):
    def build(root):
        Tables(spark, root).overwrite(derive.matches(spark, sf_dir), "silver_matches", 1)

    return Tables(spark, _once(spark, sf_dir, "io_roundtrip", build)).read("silver_matches")


@query
def io_append(spark, sf_dir):
    def build(root):
        t = Tables(spark, root)
        e = derive.events(spark, sf_dir)
        t.append(e, "bronze_events")
        t.append(e, "bronze_events")

    return Tables(spark, _once(spark, sf_dir, "io_append", build)).read("bronze_events")


@query
def io_overwrite(spark, sf_dir):
    def build(root):
        t = Tables(spark, root)
        e = derive.events(spark, sf_dir)
        t.overwrite(e, "silver_events", 1)
        t.overwrite(e.filter(F.col("event_type") == "goal"), "silver_events", 2)

    return Tables(spark, _once(spark, sf_dir, "io_overwrite", build)).read("silver_events")


@query
def io_rerun(spark, sf_dir):
    """Two batches of events, each run twice: bronze and silver are as after one run of each."""

    def build(root):
        t = Tables(spark, root)
        e = derive.events(spark, sf_dir)
        again = e.filter(F.col("event_type") == "goal").withColumn(
            "ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 MINUTE")
        )
        for batch, rows in ((1, e), (1, e), (2, again), (2, again)):
            t.append_batch(rows, "bronze", batch, schema=EVENTS)
            new = t.read_batches("bronze", EVENTS, [batch]).drop("batch_id")
            prev = t.snapshot_before("silver", batch)
            t.overwrite(silver.events(new if prev is None else t.read("silver", prev).unionByName(new)), "silver", batch)

    t = Tables(spark, _once(spark, sf_dir, "io_rerun", build))
    parts = (("bronze", t.read_batches("bronze", EVENTS)), ("silver", t.read("silver")))
    layers = [df.select(F.lit(layer).alias("layer"), "event_id", "minute", "ingested_at") for layer, df in parts]
    return layers[0].unionByName(layers[1])


@query
def io_upsert(spark, sf_dir):
    """Two batches of events into a table kept in buckets, each run twice: the latest delivery of each event."""

    def build(root):
        store = Buckets(Tables(spark, root), "events", ["event_id"], 16)
        all_rows = _redelivered(spark, sf_dir)
        e = derive.events(spark, sf_dir)
        newest = lambda old, new: silver.events(old.unionByName(new))
        for batch, rows in ((1, e), (1, e), (2, all_rows.exceptAll(e)), (2, all_rows.exceptAll(e))):
            store.upsert(rows, batch, newest, EVENTS)

    return Tables(spark, _once(spark, sf_dir, "io_upsert", build)).read("events")


# --- HTML scraping job -------------------------------------------------------------


def _pages(spark, sf_dir, kind):
    """Rendered pages with the supplied ones, stored once: the queries below time the scraping."""
    render = {
        "team": lambda: pages.team_pages(spark, sf_dir),
        "stadium": lambda: pages.stadium_pages(spark, sf_dir),
        "match": lambda: pages.match_pages(_silver(spark, sf_dir)),
    }[kind]
    path = _once(spark, sf_dir, f"pages_{kind}", lambda p: writer(pages.with_supplied(spark, sf_dir, render()), "parquet").save(p))
    return spark.read.parquet(path)


def _rows_of(spark, sf_dir, kind):
    return html_tables.extract(_pages(spark, sf_dir, kind))


@query
def html_table_rows(spark, sf_dir):
    return html_tables.table_rows(_rows_of(spark, sf_dir, "team"))


@query
def html_team_names(spark, sf_dir):
    return html_tables.team_names(_rows_of(spark, sf_dir, "team"))


@query
def html_stadiums(spark, sf_dir):
    return html_tables.stadiums(_rows_of(spark, sf_dir, "stadium"))


@query
def html_match_boxes(spark, sf_dir):
    return html_tables.match_boxes(_rows_of(spark, sf_dir, "match"))


@query
def pipeline_html_standings(spark, sf_dir):
    """Pages -> scraped matches, scores split -> landing -> silver -> standings."""

    def build(root):
        entities = get_source("html")(spark, sf_dir, _pages(spark, sf_dir, "match"))
        landing.write_payload(f"{root}/landing", BATCH_B[0], "html", matches=entities["matches"])
        rows = landing.explode_entity(landing.read_latest(spark, f"{root}/landing"), "matches")
        Tables(spark, root).overwrite(silver.matches(rows), "silver_matches", 1)

    stored = Tables(spark, _once(spark, sf_dir, "html_standings", build)).read("silver_matches")
    return standings.compute(stored, materialize=True).select(*standings.STANDINGS_COLUMNS)


# --- streaming ------------------------------------------------------------------------

# Fixed arrival split of the two availableNow runs: events from this instant
# (plus a re-delivery of every earlier goal and the first delivery of some other
# earlier events) and matches shipped from this day arrive in the second run.
EVENT_SPLIT = dt.datetime(2024, 1, 16)
MATCH_SPLIT = dt.datetime(1999, 1, 1)


def _event_streams(spark, sf_dir):
    def build(root):
        e = derive.events(spark, sf_dir)
        before = F.col("ingested_at") < ntz(EVENT_SPLIT)
        # some early events are first delivered late, all early goals a second time
        held = (F.col("event_type") != "goal") & (F.col("event_id").try_cast("long") % 7 == 0)
        early = e.filter(before & ~held)
        late = e.filter(~before | held).unionByName(e.filter(before & (F.col("event_type") == "goal")))
        for arrived in (early, late):
            events_src.write_events(arrived, f"{root}/in")
            stream_events.land_events(
                spark, f"{root}/in", f"{root}/bronze", f"{root}/ckpt/land", progress_path=f"{root}/progress"
            )
            stream_events.silver_events(spark, f"{root}/bronze", f"{root}/silver", f"{root}/ckpt/silver")
            stream_events.top_scorers(spark, f"{root}/silver", f"{root}/gold_log")

    return _once(spark, sf_dir, "stream_events", build)


@query
def stream_events_land(spark, sf_dir):
    return spark.read.schema(EVENTS).parquet(f"{_event_streams(spark, sf_dir)}/bronze")


@query
def stream_events_dedup(spark, sf_dir):
    return stream_events.read_silver(spark, f"{_event_streams(spark, sf_dir)}/silver")


@query
def stream_top_scorers(spark, sf_dir):
    return stream_events.read_top_scorers(spark, f"{_event_streams(spark, sf_dir)}/gold_log")


@query
def serve_stream_freshness(spark, sf_dir):
    return stream_progress.freshness(stream_progress.read(spark, f"{_event_streams(spark, sf_dir)}/progress"))


@query
def stream_events_restamped(spark, sf_dir):
    """All events, then all once more with stamps beyond what the state store remembers: each id is looked up in
    the filters of the stored batches."""

    def build(root):
        e = derive.events(spark, sf_dir)
        again = e.withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 90 DAYS"))
        for arrived in (e, again):
            events_src.write_events(arrived, f"{root}/in")
            stream_events.land_events(spark, f"{root}/in", f"{root}/bronze", f"{root}/ckpt/land")
            stream_events.silver_events(
                spark, f"{root}/bronze", f"{root}/silver", f"{root}/ckpt/silver", max_files=4, restamped=True
            )

    return stream_events.read_silver(spark, f"{_once(spark, sf_dir, 'stream_restamped', build)}/silver")


@query
def stream_top_scorers_compacted(spark, sf_dir):
    """The same goals, the entries of all batches compacted into totals."""
    root = _event_streams(spark, sf_dir)

    def build(path):
        stream_events.top_scorers(spark, f"{root}/silver", f"{path}/gold", compact_every=1)

    return stream_events.read_top_scorers(spark, f"{_once(spark, sf_dir, 'stream_compacted', build)}/gold")


@query
def stream_standings_corrections(spark, sf_dir):
    """Every match first with other scores, in another group and by an early stamp, then as it is: all of the
    first standings are taken back."""

    def build(root):
        raw = _raw(spark, sf_dir)
        wrong = raw.withColumns(
            {
                "home_score": F.col("away_score"),
                "away_score": F.col("home_score") + 1,
                "group": F.lit("WRONG"),
                "ingested_at": ntz(dt.datetime(1970, 1, 1)),
            }
        )
        tables = Tables(spark, f"{root}/tables")
        for arrived in (wrong, raw):
            events_src.write_json(arrived, f"{root}/in")
            stream_standings_mod.run_standings(
                spark, f"{root}/in", tables, f"{root}/ckpt", raw.schema, tiebreak=derive.MATCH_ORDER[1:]
            )

    root = _once(spark, sf_dir, "stream_corrections", build)
    return stream_standings_mod.current(Tables(spark, f"{root}/tables"))


@query
def stream_standings(spark, sf_dir):
    def build(root):
        raw = _raw(spark, sf_dir)
        split = ntz(MATCH_SPLIT)
        tables = Tables(spark, f"{root}/tables")
        for arrived in (raw.filter(F.col("ingested_at") < split), raw.filter(F.col("ingested_at") >= split)):
            events_src.write_json(arrived, f"{root}/in")
            stream_standings_mod.run_standings(
                spark, f"{root}/in", tables, f"{root}/ckpt", raw.schema, tiebreak=derive.MATCH_ORDER[1:]
            )

    root = _once(spark, sf_dir, "stream_standings", build)
    return stream_standings_mod.current(Tables(spark, f"{root}/tables"))
