"""HTML tables -> rows, as a distributed job over a table of pages.

``extract`` is the only Python-per-partition step of the engine: a
``mapInArrow`` that tokenizes each page (one compiled, possessive regular
expression scanned with ``findall``, linear even on malformed pages;
``html.unescape`` for text and attribute values; script/style bodies
skipped) and emits one row per ``<tr>``: (page_id, table_no, table_class, row_no,
cells, cell_tags, cell_classes). Everything after it (which tables qualify,
which cells to pick, marker stripping, first-seen dedup, match boxes) is
built-in Spark expressions, aggregates and joins.

Cell text follows ``get_text(strip=True)``: each text fragment is decoded, then
stripped, and the fragments are concatenated. As a search below a table finds
everything nested in it, a nested table's rows are rows of the enclosing tables
too, and a row's cells include those nested in it, in document order. ``fetch``
(a hash of the page's text) tells several crawls of one ``page_id`` apart.
"""

from __future__ import annotations

import html as htmllib
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreline.functions import FINISHED, has_class, strip_marker
from scoreline.operators.dedup import keep_first
from scoreline.schemas import HTML_ROWS

# The tokenizer runs on executors: ship its code with the task (pickled by
# value), so workers need neither the package installed nor the driver's path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELL_TAGS = ("td", "th")
# The header words that select standings and stadium tables,
# the table classes, the match-box cell classes and the scraped source label.
TEAM_HEADERS = ("Pts", "Team")
STADIUM_HEADERS = ("Stadium", "Venue")
TABLE_CLASS = "wikitable"
BOX_CLASS = "footballbox"
BOX_CELLS = {"home_team": "fhome", "away_team": "faway", "score": "fscore"}
SCRAPED_TABLE = "group_stage"


_CLASS = re.compile(r"""(?:^|\s)class\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW_TEXT = ("script", "style")


def _class_of(attrs: str) -> str | None:
    if not attrs or ("class" not in attrs and "CLASS" not in attrs.upper()):
        return None
    m = _CLASS.search(attrs)
    if m is None:
        return None
    a, b, c = m.groups()
    v = a if a is not None else b if b is not None else c
    return htmllib.unescape(v) if "&" in v else v


def _close_row(t: list, rows: list) -> None:
    """Emit the open row of a table: once for the table and once for each that encloses it."""
    t[4] = None
    if t[3] is not None:
        places, cells = t[3]
        t[3] = None
        texts, tags, classes = (["".join(c[0]) for c in cells], [c[1] for c in cells], [c[2] for c in cells])
        rows += [(no, cls, n, texts, tags, classes) for no, cls, n in places]


def _open_row(stack: list) -> None:
    places = []
    for t in stack:
        places.append((t[0], t[1], t[2]))
        t[2] += 1
    stack[-1][3] = (places, [])


# One scan per page: (text before the token, comment, declaration, "/" of an
# end tag, tag name, attributes, a lone "<" that is just text). findall does
# the scanning in C; Python only walks the tuples.
_SCAN = re.compile(
    r"([^<]*+)(?:(<!--(?:.*?-->|.*+))|(<![^>]*+(?:>|\Z)|<\?[^>]*+(?:>|\Z))"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|(<)|\Z)",
    re.S,
)


def parse_tables(page: str | None) -> list[tuple]:
    """(table_no, table_class, row_no, cells, cell_tags, cell_classes) per row of one page.

    An open table is the list [no, class, rows_so_far, open_row, open_cell]; a
    row has its (table, class, row number) in each table around it and its
    cells, a cell its [fragments, tag, class].
    Inside script/style everything up to the matching end tag is skipped.
    """
    if not page or "<table" not in page.lower():
        return []
    rows: list[tuple] = []
    stack: list[list] = []  # open tables, innermost last
    n_tables = 0
    pending: list[str] = []  # text interrupted by a lone "<"
    raw = None  # inside script/style
    for text, _comment, _decl, closing, tag, attrs, lt in _SCAN.findall(page):
        if raw is not None:
            if closing and tag.lower() == raw:
                raw = None
            continue
        if lt:
            pending += (text, lt)
            continue
        if pending:
            pending.append(text)
            text, pending = "".join(pending), []
        if text and stack:
            piece = (htmllib.unescape(text) if "&" in text else text).strip()
            if piece:
                for t in stack:  # enclosing cells see nested text, like get_text
                    if t[4] is not None:
                        t[4][0].append(piece)
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if stack:
                t = stack[-1]
                if tag == "table":
                    _close_row(t, rows)
                    stack.pop()
                elif tag == "tr":
                    _close_row(t, rows)
                elif tag == "td" or tag == "th":
                    t[4] = None
            continue
        if tag == "table":
            stack.append([n_tables, _class_of(attrs), 0, None, None])
            n_tables += 1
        elif stack and tag == "tr":
            _close_row(stack[-1], rows)
            _open_row(stack)
        elif stack and (tag == "td" or tag == "th"):
            if stack[-1][3] is None:  # cell outside <tr>: open an implicit row
                _open_row(stack)
            cell = [[], tag, _class_of(attrs)]
            stack[-1][4] = cell
            for t in stack:
                if t[3] is not None:
                    t[3][1].append(cell)
        elif tag in _RAW_TEXT:
            raw = tag
    while stack:
        _close_row(stack.pop(), rows)
    return rows


_ROWS = pa.schema(
    [
        ("page_id", pa.int64()), ("fetch", pa.int64()), ("table_no", pa.int32()), ("table_class", pa.string()), ("row_no", pa.int32()),
        *((c, pa.list_(pa.string())) for c in ("cells", "cell_tags", "cell_classes")),
    ]
)


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(_ROWS)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ROWS)], schema=_ROWS)


def _extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for page_id, fetch, html in zip(*(c.to_pylist() for c in batch.columns)):
            out += [(page_id, fetch, *r) for r in parse_tables(html)]
            if len(out) >= 5000:  # a page at most beyond that at a time
                yield _record_batch(out)
                out = []
        yield _record_batch(out)


def extract(pages: DataFrame) -> DataFrame:
    """Every table row of every page (needs ``page_id`` and ``html``)."""
    fetched = pages.select(F.col("page_id").cast("long"), F.xxhash64("html").alias("fetch"), "html")
    return fetched.mapInArrow(_extract_batches, HTML_ROWS)


def table_rows(rows: DataFrame) -> DataFrame:
    """Flat, comparable view of ``extract``: cell texts joined with '|'."""
    return rows.select(
        "page_id",
        "table_no",
        "table_class",
        "row_no",
        F.size("cells").alias("n_cells"),
        F.array_join("cells", "|").alias("cells_text"),
    )


def _body_rows(rows: DataFrame, words: tuple[str, ...]) -> DataFrame:
    """Rows after the first, with at least two cells, of each wikitable having a ``th`` whose text contains any of ``words``.

    A table's rows meet in one window, so the pages are read and parsed once.
    """
    def hit(x):
        cond = F.lit(False)
        for w in words:
            cond = cond | x["cells"].contains(w)
        return (x["cell_tags"] == "th") & cond

    wiki = rows.filter(has_class("table_class", TABLE_CLASS) & F.col("page_id").isNotNull())
    flagged = wiki.withColumn("hit", F.exists(F.arrays_zip("cells", "cell_tags"), hit))
    table = Window.partitionBy("page_id", "fetch", "table_no")
    found = flagged.withColumn("hit", F.bool_or("hit").over(table)).filter("hit").drop("hit")
    return found.filter((F.col("row_no") > 0) & (F.size("cells") >= 2))


def team_names(rows: DataFrame) -> DataFrame:
    """Team names from standings tables: second cell, marker stripped, first
    occurrence kept (by page, table, row)."""
    names = _body_rows(rows, TEAM_HEADERS).select(
        strip_marker(F.get(F.col("cells"), 1)).alias("name"), "page_id", "table_no", "row_no"
    ).filter(F.col("name").isNotNull() & (F.col("name") != ""))
    first = keep_first(names, ["name"], ["page_id", "table_no", "row_no"])
    return first.select("name", F.lit(None).cast("string").alias("group"), F.lit(SCRAPED_TABLE).alias("source_table"))


def stadiums(rows: DataFrame) -> DataFrame:
    """Stadium rows: first cell name, second cell city."""
    return _body_rows(rows, STADIUM_HEADERS).select(
        F.get(F.col("cells"), 0).alias("name"),
        F.get(F.col("cells"), 1).alias("city"),
        F.lit(None).cast("string").alias("country"),
        F.lit(None).cast("string").alias("capacity"),
    )


def match_boxes(rows: DataFrame) -> DataFrame:
    """(home_team, away_team, score) from footballbox tables: the first ``th``
    of each class; a box missing any of the three is skipped. (Exploding the
    cells measured twice as fast as picking them with higher-order functions,
    whose lambdas are interpreted, not code-generated.)"""
    boxes = rows.filter(has_class("table_class", BOX_CLASS))
    cells = boxes.select(
        "page_id",
        "fetch",
        "table_no",
        "row_no",
        F.posexplode(F.arrays_zip("cells", "cell_tags", "cell_classes")).alias("pos", "c"),
    ).filter(F.col("c.cell_tags") == "th")
    picks = []
    for out, cls in BOX_CELLS.items():
        first = F.min(F.when(has_class("c.cell_classes", cls), F.struct("row_no", "pos", F.col("c.cells").alias("t"))))
        picks.append(first["t"].alias(out))
    per_box = cells.groupBy("page_id", "fetch", "table_no").agg(*picks)
    return per_box.filter(
        F.col("home_team").isNotNull() & F.col("away_team").isNotNull() & F.col("score").isNotNull()
    ).select(*BOX_CELLS)


def scored_matches(rows: DataFrame) -> DataFrame:
    """Match boxes in landing form: the score text split into goals, a split one being finished."""
    parts = [F.regexp_extract("score", r"^\s*([0-9]+)\s*[–:-]\s*([0-9]+)", k) for k in (1, 2)]
    played = parts[0] != ""
    none = F.lit(None).cast("string")
    return match_boxes(rows).select(
        "home_team",
        "away_team",
        F.when(played, parts[0]).alias("home_score"),
        F.when(played, parts[1]).alias("away_score"),
        *(none.alias(c) for c in ("group", "matchday", "stadium")),
        F.when(played, FINISHED).otherwise("scheduled").alias("status"),
        "score",
    )
