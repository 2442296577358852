"""Landing payloads, bronze/silver typing, table I/O, and the HTML extractor."""

import pytest
from pyspark.sql import functions as F

from scoreline.functions import lenient_int, strip_marker
from scoreline.operators import bronze, silver
from scoreline.schemas import TEAMS_RAW
from scoreline.session import scratch_path
from scoreline.sources import files, html_tables, landing
from scoreline.sources.io import Tables, path_exists
from scoreline.sources.registry import get_source, names


def test_lenient_int_matches_non_ansi_cast(spark):
    given = ["5", "3.7", "5a", None, "-2", "2.0", "5d", "5f", "1e3", " 4 ", "", "99999999999", "+7", "1.2.3"]
    df = spark.createDataFrame([(s,) for s in given], "s string")
    want = [5, 3, None, None, -2, 2, None, None, None, 4, None, None, 7, None]
    assert [r[0] for r in df.select(lenient_int("s")).collect()] == want


def test_marker_strip(spark):
    df = spark.createDataFrame([("Spain (H)",), ("Mexico  (X) ",), ("Plain",), ("A (B) C",)], "s string")
    assert [r[0] for r in df.select(strip_marker("s")).collect()] == ["Spain", "Mexico", "Plain", "A (B) C"]


def test_landing_roundtrip_latest_and_explode(spark):
    path = scratch_path(spark, "t-landing")
    teams = spark.createDataFrame([("A", "G1"), ("B", "G2")], "name string, group string")
    matches = spark.createDataFrame(
        [("A", "B", 1, 0, "G1", 1, "S", "finished", "1–0")],
        "home_team string, away_team string, home_score int, away_score int, group string, matchday int, "
        "stadium string, status string, score string",
    )
    landing.write_payload(path, "2026-06-01T10:00:00+00:00", "snapshot", rows_per_doc=1, teams=teams)
    landing.write_payload(path, "2026-06-02T09:00:00+02:00", "snapshot", teams=teams, matches=matches)
    docs = landing.read_landing(spark, path)
    summary = sorted((r["fetched_at"], r["teams"], r["matches"]) for r in landing.batch_summary(docs).collect())
    assert summary == [("2026-06-01T10:00:00+00:00", 2, 0), ("2026-06-02T09:00:00+02:00", 2, 1)]
    # latest is by instant, not by text
    latest = landing.latest_batch(docs)
    assert {r["fetched_at"] for r in latest.collect()} == {"2026-06-02T09:00:00+02:00"}
    m = landing.explode_entity(latest, "matches").first()
    assert (m["home_score"], m["away_score"], m["matchday"]) == ("1", "0", "1")  # text in landing form
    with pytest.raises(FileNotFoundError):
        landing.read_landing(spark, path + "-missing")


def test_documents_are_bounded_also_for_equal_records(spark):
    path = scratch_path(spark, "t-equal")
    rows = spark.range(12_000).select(F.lit("A").alias("name"), F.lit("G").alias("group"))
    landing.write_payload(path, "2026-06-01T00:00:00+00:00", "snapshot", rows_per_doc=500, teams=rows)
    sizes = [r[0] for r in landing.read_landing(spark, path).select(F.size("teams")).collect()]
    assert sum(sizes) == 12_000 and max(sizes) <= 500


def test_documents_are_cut_without_a_shuffle_and_compressed(spark, capsys):
    rows = spark.range(0, 3000, 1, 3).select(
        F.concat(F.lit("T"), "id").alias("name"), F.when(F.col("id") % 7 > 0, F.col("id") % 5).cast("string").alias("group")
    )
    docs = landing._docs(rows, "teams", 400)
    docs.explain("simple")
    assert "Exchange" not in capsys.readouterr().out
    assert max(len(r["teams"]) for r in docs.collect()) <= 400
    path = scratch_path(spark, "t-cut")
    landing.write_payload(path, "2026-06-01T00:00:00+00:00", "snapshot", rows_per_doc=10, teams=rows)
    back = landing.explode_entity(landing.read_landing(spark, path), "teams").select("name", "group")
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))
    files = [r["path"] for r in spark.read.format("binaryFile").load(f"{path}/*/*").select("path").collect()]
    files = [f for f in files if "/part-" in f]
    # a thousand rows a task: a hundred documents, over two files
    assert len(files) == 6 and all(f.endswith(".json.gz") for f in files)


def test_files_of_documents_are_spread_over_tasks(spark):
    path = scratch_path(spark, "t-files")
    df = spark.range(0, 400, 1, 1).select(F.concat(F.lit("d"), "id").alias("doc"))
    files.write_documents(df, path, "doc")
    found = files.read_files(spark, path, "part-*").select("path", "text").collect()
    assert sorted(r["text"].strip() for r in found) == sorted(f"d{i}" for i in range(400))
    tasks = {r["path"].rsplit("/", 1)[1][:10] for r in found}
    assert len(tasks) > spark.sparkContext.defaultParallelism


def test_pages_are_parsed_once(spark, capsys):
    pages = spark.createDataFrame([(1, "x")], "page_id long, html string")
    for names in (html_tables.team_names, html_tables.stadiums):
        names(html_tables.extract(pages)).explain("simple")
        assert capsys.readouterr().out.split("Initial Plan")[0].count("MapInArrow") == 1


def test_real_html_text_nesting_and_repeated_pages(spark):
    page = (
        '<table class="wikitable"><tr><th>No</th><th>Team</th></tr><tr><td>1</td><td>&nbsp;Chile</td></tr>'
        "<tr><td>2</td><td><a>Mexico</a>&#160;<span>(H)</span></td></tr></table>"
    )
    outer = (
        '<table class="wikitable"><tr><td>x</td></tr><tr><td><table><tr><th>Venue</th></tr></table></td><td>y</td></tr></table>'
    )
    box = '<table class="footballbox"><tr><th class="fhome">{}</th><th class="fscore">2–1</th><th class="faway">{}</th></tr></table>'
    pages = spark.createDataFrame(
        [(1, page), (2, outer), (3, box.format("A", "B")), (3, box.format("C", "D"))], "page_id long, html string"
    )
    rows = html_tables.extract(pages)
    assert sorted(r["name"] for r in html_tables.team_names(rows).collect()) == ["Chile", "Mexico"]
    # the header of a nested table counts for the enclosing one, and its rows are rows of it
    assert [(r["name"], r["city"]) for r in html_tables.stadiums(rows).collect()] == [("Venue", "Venue")]
    nested = [(r["table_no"], r["row_no"], r["cells"]) for r in rows.filter("page_id = 2").collect()]
    assert sorted(nested) == [(0, 0, ["x"]), (0, 1, ["Venue", "Venue", "y"]), (0, 2, ["Venue"]), (1, 0, ["Venue"])]
    boxes = html_tables.scored_matches(rows).collect()
    assert sorted((r["home_team"], r["home_score"], r["status"]) for r in boxes) == [("A", "2", "finished"), ("C", "2", "finished")]


def test_group_map_flatten(spark):
    path = scratch_path(spark, "t-groupmap")
    teams = spark.createDataFrame([("A", "G1"), ("B", "G1"), ("C", "G2")], "name string, group string")
    landing.write_group_map(path, teams, "2026-06-01T00:00:00+00:00", "snapshot", rows_per_doc=1)
    flat = landing.flatten_group_map(landing.read_group_map(spark, path))
    assert sorted((r["name"], r["group"]) for r in flat.collect()) == [("A", "G1"), ("B", "G1"), ("C", "G2")]


def test_bronze_align_and_silver_teams(spark):
    snap = spark.createDataFrame([(" A ", "G1")], "name string, group string")
    scraped = spark.createDataFrame([("A", "group_stage", 7)], "name string, source_table string, extra int")
    al = bronze.align_all([snap, scraped], TEAMS_RAW)
    assert al.columns == ["name", "group", "source_table"]
    st = bronze.stamp(al, "2026-06-01T00:00:00+00:00", "x")
    later = bronze.stamp(spark.createDataFrame([("A  ", "G9", None)], "name string, group string, source_table string"),
                         "2026-06-02T00:00:00+00:00", "y")
    empty = bronze.stamp(spark.createDataFrame([("  ", "G", None)], "name string, group string, source_table string"),
                         "2026-06-03T00:00:00+00:00", "z")
    out = silver.teams(st.unionByName(later).unionByName(empty)).collect()
    assert len(out) == 1 and out[0]["name"] == "A" and out[0]["group"] == "G9"


def test_silver_matches_keep_latest_not_stale(spark):
    rows = [
        ("A", "B", None, None, "G", "1", "S", "scheduled", "2026-06-01T00:00:00+00:00"),
        ("A", "B", "2", "1.0", "G", "1", "S", "finished", "2026-06-02T00:00:00+00:00"),
        ("A", "B", "x", "1", "G", "2", "S", "finished", "2026-06-02T00:00:00+00:00"),
    ]
    df = spark.createDataFrame(
        rows,
        "home_team string, away_team string, home_score string, away_score string, group string, matchday string, "
        "stadium string, status string, ingested_at string",
    )
    out = {r["matchday"]: r for r in silver.matches(df).collect()}
    assert out[1]["status"] == "finished" and out[1]["result"] == "home_win" and out[1]["away_score"] == 1
    assert out[2]["home_score"] is None and out[2]["result"] is None


def test_tables_snapshots_and_append(spark):
    t = Tables(spark, scratch_path(spark, "t-tables"))
    assert not t.exists("x")
    df = spark.range(5).withColumnRenamed("id", "v")
    assert t.overwrite(df, "x", 1) == 5
    assert t.overwrite(df.filter("v < 2"), "x", 2) == 2
    assert t.read("x").count() == 2 and t.read("x", "000000000001").count() == 5
    assert t.exists("x")
    assert t.append(df, "y") == 5 and t.append(df, "y") == 5
    assert t.read("y").count() == 10
    assert path_exists(spark, t.path("y"))
    with pytest.raises(FileNotFoundError):
        t.read("nope")


def test_registry():
    assert names() == ["html", "snapshot"]
    assert get_source() is get_source("snapshot")
    with pytest.raises(ValueError):
        get_source("nope")


PAGE = """<html><body>
<table class="wikitable sortable"><tr><th>Pos</th><th>Team</th><th>Pts</th></tr>
<tr><td>1</td><td><a>Spain</a> <span>(H)</span></td><td>7</td>
<tr><td>2</td><td>Uruguay &amp; Co</td><td>4</td></tr>
<tr><td>only</td></tr>
<tr><td>3</td><td>Spain</td><td>1</td></tr>
</table>
<table class="infobox"><tr><th>Team</th></tr><tr><td>x</td><td>Decoy</td></tr></table>
<table class="wikitable"><tr><th>Venue</th><th>City</th></tr><tr><td>Azteca</td><td>Mexico City</td></tr>
<tr><td>nested<table><tr><td>in</td></tr></table></td><td>c</td></tr></table>
<table class="footballbox"><tr><th class="fhome">Spain</th><th class="fscore">2–0</th><th class="faway">Uruguay</th></tr></table>
<table class="footballbox"><tr><th class="fhome">Mexico</th><th class="faway">Korea</th></tr></table>
</body></html>"""


def test_html_parser_rows():
    rows = html_tables.parse_tables(PAGE)
    t0 = [r for r in rows if r[0] == 0]
    assert [r[3] for r in t0] == [["Pos", "Team", "Pts"], ["1", "Spain(H)", "7"], ["2", "Uruguay & Co", "4"], ["only"], ["3", "Spain", "1"]]
    nested = [r for r in rows if r[0] == 3]
    assert nested == [(3, None, 0, ["in"], ["td"], [None])]
    outer = [r for r in rows if r[0] == 2]
    # the enclosing cell sees nested text, its row the nested cells, its table the nested row
    assert [r[3] for r in sorted(outer, key=lambda r: r[2])][-2:] == [["nestedin", "in", "c"], ["in"]]
    assert html_tables.parse_tables(None) == [] and html_tables.parse_tables("<p>no tables</p>") == []


def test_html_readers(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, PAGE), (3, None)], "page_id long, html string")
    rows = html_tables.extract(pages)
    teams = sorted((r["name"], r["source_table"]) for r in html_tables.team_names(rows).collect())
    assert teams == [("Spain", "group_stage"), ("Uruguay & Co", "group_stage")]
    venues = sorted((r["name"], r["city"]) for r in html_tables.stadiums(rows).collect())
    assert venues == [("Azteca", "Mexico City")] * 2 + [("nestedin", "in")] * 2  # as a search below the row finds them
    boxes = [tuple(r) for r in html_tables.match_boxes(rows).collect()]
    assert boxes == [("Spain", "Uruguay", "2–0")] * 2


def test_html_source_registry(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id long, html string")
    src = get_source("html")(spark, "", pages)
    assert set(src) == {"teams", "stadiums", "matches"}
    assert src["matches"].count() == 1
    assert src["teams"].filter(F.col("name") == "Spain").count() == 1


def test_unparsable_stamp_is_null_not_an_error(spark):
    from scoreline.functions import instant

    df = spark.createDataFrame([("2026-06-27T09:00:00+02:00",), ("garbage",), (None,)], "t string")
    got = [r[0] for r in df.select(instant("t").cast("string")).collect()]
    assert got[1:] == [None, None] and got[0] is not None


def test_empty_partitioned_snapshot_reads_with_declared_schema(spark):
    t = Tables(spark, scratch_path(spark, "t-empty"))
    empty = spark.createDataFrame([], "team string, is_current boolean")
    assert t.overwrite(empty, "st", 1, partition_by=["is_current"]) == 0
    got = t.read("st", schema=empty.schema)
    assert got.count() == 0 and got.columns == ["team", "is_current"]
    with pytest.raises(FileNotFoundError):
        t.read_versions("nothing_here")
