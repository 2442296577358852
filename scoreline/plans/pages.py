"""HTML pages rendered from the supplied tables, for the scraping job.

The supplied ``pages`` table holds web pages without any ``<table>``; to give
the extractor real tables with a known answer, pages are rendered here with
Spark from supplier⋈nation (standings-shaped tables), part (stadium tables)
and the silver matches (match boxes). Every page holds a bounded number of
rows (a key range, or a content-hash chunk), never a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreline.plans import derive
from scoreline.sources.landing import chunk_key

ROWS_PER_PAGE = 50
# Page-id offsets per page kind, header words, and the
# home-nation marker appended after each team name.
TEAM_PAGE_BASE, STADIUM_PAGE_BASE, MATCH_PAGE_BASE = 10**12, 2 * 10**12, 3 * 10**12
TEAM_HEADER = ("No", "Team", "Nation", "Pts")
STADIUM_HEADER = ("Stadium", "City", "Capacity")
MARKER = "(H)"


def esc(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _cells(tag: str, values: list[Column]) -> Column:
    parts = []
    for v in values:
        parts += [F.lit(f"<{tag}>"), v, F.lit(f"</{tag}>")]
    return F.concat(F.lit("<tr>"), *parts, F.lit("</tr>"))


def _header(words) -> str:
    return "<tr>" + "".join(f"<th>{w}</th>" for w in words) + "</tr>"


def _page(html_parts: Column) -> Column:
    return F.concat(F.lit("<html><body>"), html_parts, F.lit("</body></html>"))


def _join_sorted(col: str, text: str) -> Column:
    return F.array_join(F.transform(F.sort_array(F.collect_list(col)), lambda x: x[text]), "")


def team_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per supplier-key range; inside, one wikitable per nation, and a table nested in another."""
    s = derive.table(spark, sf_dir, "supplier").join(
        derive.nation_region(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")
    )
    row = _cells(
        "td",
        [
            F.col("s_suppkey").cast("string"),
            F.concat(F.lit('&nbsp;<a href="#">'), esc(F.col("s_name")), F.lit(f"</a>&#160;<span>{MARKER}</span>")),
            esc(F.col("n_name")),
            (F.col("s_suppkey") % 10).cast("string"),
        ],
    )
    rows = s.select(
        (F.floor(F.col("s_suppkey") / ROWS_PER_PAGE) + TEAM_PAGE_BASE).alias("page_id"),
        "n_nationkey",
        F.struct("s_suppkey", row.alias("html")).alias("r"),
    )
    tables = rows.groupBy("page_id", "n_nationkey").agg(
        F.concat(
            F.lit('<table class="wikitable sortable">' + _header(TEAM_HEADER)), _join_sorted("r", "html"), F.lit("</table>")
        ).alias("t")
    )
    nested = F.lit('<table class="navbox"><tr><td>nav<table class="plain"><tr><td>x&nbsp;</td></tr></table></td></tr></table>')
    body = F.concat(_join_sorted(F.struct("n_nationkey", "t"), "t"), nested)
    pages = tables.groupBy("page_id").agg(_page(body).alias("html"))
    return pages.select("page_id", F.concat(F.lit("https://example.org/teams/"), F.col("page_id")).alias("url"), "html")


def stadium_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per part-key range: an infobox that must be ignored, then the wikitable."""
    p = derive.table(spark, sf_dir, "part")
    row = _cells("td", [esc(F.col("p_name")), esc(F.col("p_type")), F.col("p_size").cast("string")])
    rows = p.select(
        (F.floor(F.col("p_partkey") / ROWS_PER_PAGE) + STADIUM_PAGE_BASE).alias("page_id"),
        F.struct("p_partkey", row.alias("html")).alias("r"),
    )
    decoy = '<table class="infobox"><tr><th>Stadium</th></tr><tr><td>decoy</td><td>decoy</td></tr></table>'
    pages = rows.groupBy("page_id").agg(
        _page(
            F.concat(
                F.lit(decoy + '<table class="wikitable">' + _header(STADIUM_HEADER)),
                _join_sorted("r", "html"),
                F.lit("</table>"),
            )
        ).alias("html")
    )
    return pages.select("page_id", F.concat(F.lit("https://example.org/venues/"), F.col("page_id")).alias("url"), "html")


def match_pages(matches: DataFrame) -> DataFrame:
    """Match boxes, about ``ROWS_PER_PAGE`` per page (content-hash pages, so a
    recomputed task rebuilds the same pages); a box of a match without a score
    has no score cell."""

    def box(m: Column) -> Column:
        h, a = m["home_score"], m["away_score"]
        score = F.when(
            h.isNotNull() & a.isNotNull(),
            F.concat(F.lit('<th class="fscore">'), h.cast("string"), F.lit("–"), a.cast("string"), F.lit("</th>")),
        ).otherwise(F.lit(""))
        return F.concat(
            F.lit('<table class="footballbox"><tr><th class="fhome">'),
            esc(m["home_team"]),
            F.lit("</th>"),
            score,
            F.lit('<th class="faway">'),
            esc(m["away_team"]),
            F.lit("</th></tr></table>"),
        )

    keyed = matches.select(
        chunk_key(matches, ROWS_PER_PAGE, ["home_team", "away_team", "matchday"]),
        F.struct("matchday", "home_team", "away_team", "home_score", "away_score").alias("r"),
    )
    # the rows are shuffled as they are, boxes are written from them where a page is put together
    boxes = F.transform(F.sort_array(F.collect_list("r")), box)
    pages = keyed.groupBy("_chunk").agg(_page(F.array_join(boxes, "")).alias("html"))
    return pages.select(  # two pages have one id, as two crawls of a page would
        (F.floor(F.col("_chunk") / 2) + MATCH_PAGE_BASE).alias("page_id"),
        F.lit("https://example.org/matches").alias("url"),
        "html",
    )


def with_supplied(spark: SparkSession, sf_dir: str, rendered: DataFrame) -> DataFrame:
    """Rendered pages plus the supplied ``pages`` table (whose pages carry no tables)."""
    supplied = derive.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return rendered.unionByName(supplied)
