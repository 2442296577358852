"""Expected results as DuckDB SQL over the supplied tables (registered as views).

Each string states, independently of the Spark code, what a query key must
return. Shared CTEs restate the derivations of ``plans/derive.py``.
"""

from __future__ import annotations

RAW_MATCHES = """
raw_matches AS (
  SELECT c_name AS home_team, s_name AS away_team,
    CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(l_quantity AS INT) % 6 END AS home_score,
    CASE WHEN o_orderstatus = 'O' THEN NULL ELSE l_linenumber % 5 END AS away_score,
    r_name AS "group",
    CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS INT) AS matchday,
    p_brand AS stadium,
    CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'P' THEN 'live' ELSE 'scheduled' END AS status,
    l_shipdate AS ingested_at,
    l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
)"""

RESULT = """CASE WHEN status = 'finished' AND home_score IS NOT NULL AND away_score IS NOT NULL THEN
      CASE WHEN home_score > away_score THEN 'home_win'
           WHEN home_score < away_score THEN 'away_win' ELSE 'draw' END END"""

LATEST_MATCHES = """
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY home_team, away_team, matchday
      ORDER BY ingested_at DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC,
               l_quantity DESC, l_extendedprice DESC) AS rn
    FROM raw_matches) WHERE rn = 1
),
m AS (
  SELECT home_team, away_team, home_score, away_score, "group", matchday, stadium, status,
    """ + RESULT + """ AS result, ingested_at
  FROM latest
)"""

M = "WITH " + RAW_MATCHES + "," + LATEST_MATCHES

SIDES = """
sides{sfx} AS (
  SELECT home_team AS team, "group", home_score AS gf, away_score AS ga, result, 'home' AS venue,
    CASE result WHEN 'home_win' THEN 'W' WHEN 'draw' THEN 'D' WHEN 'away_win' THEN 'L' END AS outcome
  FROM {src} WHERE status = 'finished'
  UNION ALL
  SELECT away_team, "group", away_score, home_score, result, 'away',
    CASE result WHEN 'away_win' THEN 'W' WHEN 'draw' THEN 'D' WHEN 'home_win' THEN 'L' END
  FROM {src} WHERE status = 'finished'
)"""

UNRANKED = """
unranked{sfx} AS (
  SELECT "group", team,
    count(*) AS played,
    CAST(count(*) FILTER (WHERE outcome = 'W') AS BIGINT) AS won,
    CAST(count(*) FILTER (WHERE outcome = 'D') AS BIGINT) AS drawn,
    CAST(count(*) FILTER (WHERE outcome = 'L') AS BIGINT) AS lost,
    CAST(sum(gf) AS BIGINT) AS goals_for,
    CAST(sum(ga) AS BIGINT) AS goals_against,
    CAST(sum(CASE outcome WHEN 'W' THEN 3 WHEN 'D' THEN 1 ELSE 0 END) AS BIGINT) AS points,
    CAST(sum(gf) - sum(ga) AS BIGINT) AS goal_difference
  FROM sides{sfx} GROUP BY "group", team
)"""

RANKED = """
ranked{sfx} AS (
  SELECT *, CAST(rank() OVER (PARTITION BY "group"
      ORDER BY points DESC NULLS LAST, goal_difference DESC NULLS LAST, goals_for DESC NULLS LAST) AS INT) AS group_rank
  FROM unranked{sfx}
)"""


def standings_ctes(src: str = "m", sfx: str = "") -> str:
    return "," + ",".join(t.format(src=src, sfx=sfx) for t in (SIDES, UNRANKED, RANKED))


STANDINGS = M + standings_ctes()

EVENTS = """
e AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
    json_extract_string(props, '$.k') AS home_team,
    CAST((TRY_CAST(json_extract_string(props, '$.k') AS INT) + 50) % 100 AS VARCHAR) AS away_team,
    CAST(NULL AS VARCHAR) AS "group",
    json_extract_string(props, '$.k') AS team,
    CAST(user_id AS VARCHAR) AS player,
    CASE event_type WHEN 'purchase' THEN 'goal' WHEN 'error' THEN 'yellow_card' WHEN 'signup' THEN 'red_card'
      WHEN 'click' THEN 'substitution' ELSE event_type END AS event_type,
    CAST(minute(ts) AS INT) AS minute,
    ts AS ingested_at
  FROM events
)"""

# The feed icons per event type and the default bullet.
ICON = (
    "CASE event_type WHEN 'goal' THEN '⚽' WHEN 'yellow_card' THEN '\U0001f7e8' "
    "WHEN 'red_card' THEN '\U0001f7e5' WHEN 'substitution' THEN '\U0001f504' ELSE '•' END"
)
DASH = "—"

SCORERS = """
scorers AS (SELECT player, team, count(*) AS goals FROM e WHERE event_type = 'goal' GROUP BY player, team)"""

TREND = """
trend AS (
  SELECT matchday, CAST(sum(home_score + away_score) AS BIGINT) AS goals, count(*) AS matches_played,
    ((200 * sum(home_score + away_score) + count(*)) // (2 * count(*))) / 100.0 AS avg_goals_per_match
  FROM m WHERE status = 'finished' GROUP BY matchday
)"""

FORM_SIDES = """
form_sides AS (
  SELECT home_team AS team, matchday,
    CASE result WHEN 'home_win' THEN 'W' WHEN 'away_win' THEN 'L' ELSE 'D' END AS oc
  FROM m WHERE status = 'finished'
  UNION ALL
  SELECT away_team, matchday, CASE result WHEN 'away_win' THEN 'W' WHEN 'home_win' THEN 'L' ELSE 'D' END
  FROM m WHERE status = 'finished'
)"""

ATTRS = ["played", "won", "drawn", "lost", "goals_for", "goals_against", "points", "goal_difference", "group_rank"]
COMPARE = ["played", "won", "drawn", "lost", "goals_for", "goals_against", "points", "group_rank"]
T0 = "TIMESTAMP '2026-06-13 00:00:00'"
T1 = "TIMESTAMP '2026-06-20 00:00:00'"
T2 = "TIMESTAMP '2026-06-27 00:00:00'"
AS_OF = "TIMESTAMP '2026-06-23 00:00:00'"
PLAIN = ["group", "team"] + ATTRS
SCD_COLS = ", ".join(f'"{c}"' for c in PLAIN) + ", effective_from, effective_to, is_current"


def _scd2(select: str) -> str:
    """Two standings snapshots (matchday <= 79 stamped T1, <= 83 stamped T2) merged."""
    ocols = ", ".join(f'x."{c}" AS o_{c}' for c in PLAIN)
    ncols = ", ".join(f'y."{c}" AS n_{c}' for c in PLAIN)
    differs = " OR ".join(f"o_{c} IS DISTINCT FROM n_{c}" for c in COMPARE)
    osel = ", ".join(f'o_{c} AS "{c}"' for c in PLAIN)
    nsel = ", ".join(f'n_{c} AS "{c}"' for c in PLAIN)
    return (
        M
        + ",\nm1 AS (SELECT * FROM m WHERE matchday <= 79)"
        + standings_ctes("m1", "1")
        + ",\nm2 AS (SELECT * FROM m)"
        + standings_ctes("m2", "2")
        + f""",
existing AS (SELECT *, {T1} AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, true AS is_current
  FROM ranked1),
j AS (
  SELECT {ocols}, x.effective_from AS o_from, x.is_current AS o_in, {ncols}, y.played IS NOT NULL AS n_in
  FROM existing x FULL OUTER JOIN ranked2 y
    ON x."group" IS NOT DISTINCT FROM y."group" AND x.team IS NOT DISTINCT FROM y.team
),
jc AS (SELECT *, (o_in IS NULL OR NOT n_in OR {differs}) AS changed FROM j),
merged AS (
  SELECT 'unchanged' AS change, {osel}, o_from AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to,
    true AS is_current
  FROM jc WHERE o_in AND n_in AND NOT changed
  UNION ALL
  SELECT 'closed', {osel}, o_from, {T2}, false FROM jc WHERE o_in AND changed
  UNION ALL
  SELECT 'inserted', {nsel}, {T2}, CAST(NULL AS TIMESTAMP), true FROM jc WHERE n_in AND changed
)
"""
        + select
    )


def _history() -> str:
    """Three standings (matchday <= 70 at T0, <= 79 at T1, all at T2) as one history of versions."""
    sel = ", ".join(f'x."{c}" AS "{c}"' for c in PLAIN)
    on = 'x."group" IS NOT DISTINCT FROM y."group" AND x.team IS NOT DISTINCT FROM y.team'
    same = " AND ".join(f'x."{c}" IS NOT DISTINCT FROM y."{c}"' for c in COMPARE)
    goes_on = lambda k: f"EXISTS (SELECT 1 FROM ranked{k} y WHERE {on} AND {same})"
    null = "CAST(NULL AS TIMESTAMP)"
    parts = [
        f"SELECT {sel}, {T0} AS effective_from, CASE WHEN NOT {goes_on(1)} THEN {T1} "
        f"WHEN NOT {goes_on(2)} THEN {T2} ELSE {null} END AS effective_to FROM ranked0 x",
        f"SELECT {sel}, {T1}, CASE WHEN NOT {goes_on(2)} THEN {T2} ELSE {null} END FROM ranked1 x WHERE NOT {goes_on(0)}",
        f"SELECT {sel}, {T2}, {null} FROM ranked2 x WHERE NOT {goes_on(1)}",
    ]
    return (
        M
        + ",\nm0 AS (SELECT * FROM m WHERE matchday <= 70)"
        + standings_ctes("m0", "0")
        + ",\nm1 AS (SELECT * FROM m WHERE matchday <= 79)"
        + standings_ctes("m1", "1")
        + standings_ctes("m", "2")
        + ", v AS ("
        + " UNION ALL ".join(parts)
        + ") SELECT *, effective_to IS NULL AS is_current FROM v"
    )


def _checks(
    table: str, src: str, not_null: list[str], non_negative: list[str], known: str | None = None, rules: dict | None = None
) -> str:
    parts = [
        f"SELECT '{table}' AS \"table\", '{table}_not_empty' AS \"check\", "
        f"CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS failed_rows FROM {src}"
    ]
    for c in not_null:
        parts.append(f"SELECT '{table}', '{table}_no_null_{c}', count(*) FILTER (WHERE {c} IS NULL) FROM {src}")
    for c in non_negative:
        parts.append(f"SELECT '{table}', '{table}_{c}_non_negative', count(*) FILTER (WHERE {c} < 0) FROM {src}")
    for name, pred in (rules or {}).items():
        parts.append(f"SELECT '{table}', '{table}_{name}', count(*) FILTER (WHERE COALESCE({pred}, false)) FROM {src}")
    if known:
        parts.append(f"SELECT '{table}', 'all_{table}_teams_known', count(*) FROM ({known})")
    return " UNION ALL ".join(parts)


UNKNOWN_TEAMS = """SELECT DISTINCT team FROM cur s
  WHERE team IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_name = s.team)"""


def sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["standings_ranked"] = STANDINGS + " SELECT * FROM ranked"
    q["standings_unranked"] = STANDINGS + " SELECT * FROM unranked"
    q["unpivot_sides"] = M + "," + SIDES.format(src="m", sfx="") + " SELECT * FROM sides"
    q["silver_matches"] = M + " SELECT * FROM m"
    q["silver_match_result"] = "WITH " + RAW_MATCHES + " SELECT *, " + RESULT + " AS result FROM raw_matches"

    # gold
    q["gold_standings_current"] = _scd2('SELECT "group", team, ' + ", ".join(ATTRS) + " FROM merged WHERE is_current")
    q["gold_top_scorers"] = "WITH " + EVENTS + "," + SCORERS + " SELECT * FROM scorers"
    q["gold_team_form"] = (
        M + "," + FORM_SIDES + " SELECT team, string_agg(oc, '' ORDER BY matchday NULLS FIRST, oc) AS form "
        "FROM form_sides GROUP BY team"
    )
    q["gold_goals_by_matchday"] = M + "," + TREND + " SELECT * FROM trend"

    # SCD2
    q["scd2_initial"] = _scd2("SELECT * FROM existing")
    q["scd2_changed_keys"] = _scd2(
        'SELECT COALESCE(o_group, n_group) AS "group", COALESCE(o_team, n_team) AS team, '
        "CASE WHEN o_in IS NULL THEN 'new' WHEN NOT n_in THEN 'gone' ELSE 'changed' END AS change "
        "FROM jc WHERE changed"
    )
    for ch in ("closed", "unchanged", "inserted"):
        q[f"scd2_{ch}"] = _scd2(f"SELECT {SCD_COLS} FROM merged WHERE change = '{ch}'")
    q["scd2_apply"] = _scd2(f"SELECT {SCD_COLS} FROM merged")
    q["scd2_metrics"] = _scd2(
        "SELECT count(*) FILTER (WHERE change = 'unchanged') AS unchanged, "
        "count(*) FILTER (WHERE change = 'closed') AS closed, "
        "count(*) FILTER (WHERE change = 'inserted') AS inserted, "
        "CAST(0 AS BIGINT) AS history, count(*) AS total, "
        "count(*) FILTER (WHERE change IN ('unchanged', 'inserted')) AS current FROM merged"
    )
    q["scd2_as_of"] = _scd2(
        f"SELECT {SCD_COLS} FROM merged WHERE effective_from <= {AS_OF} "
        f"AND (effective_to IS NULL OR effective_to > {AS_OF})"
    )

    q["scd2_history"] = _history()
    open_then = (
        'x."group" IS NOT DISTINCT FROM k."group" AND x.team = k.{0}_team AND x.effective_from <= k.kick_off '
        "AND (x.effective_to IS NULL OR k.kick_off < x.effective_to)"
    )
    q["scd2_as_of_join"] = (
        f"WITH h AS ({_history()}), k AS (SELECT *, TIMESTAMP '2026-06-10 00:00:00' + to_days(CAST(matchday % 21 AS INTEGER)) AS kick_off "
        f"FROM ({M} SELECT * FROM m)) "
        'SELECT k.home_team, k.away_team, k.matchday, k."group", k.kick_off, a.points AS home_points, a.group_rank AS home_rank, '
        "b.points AS away_points, b.group_rank AS away_rank FROM k "
        f"LEFT JOIN h a ON {open_then.format('home').replace('x.', 'a.')} LEFT JOIN h b ON {open_then.format('away').replace('x.', 'b.')}"
    )
    q["standings_overall_rank"] = (
        STANDINGS + ' SELECT "group", team, points, goal_difference, goals_for, CAST(rank() OVER (ORDER BY points DESC NULLS LAST, '
        "goal_difference DESC NULLS LAST, goals_for DESC NULLS LAST) AS INTEGER) AS overall_rank FROM ranked"
    )
    q["serve_standings_sorted"] = q["gold_standings_current"]
    q["serve_trend_sorted"] = q["gold_goals_by_matchday"]

    # serving
    q["serve_recent_events"] = (
        "WITH " + EVENTS + " SELECT * FROM e ORDER BY ingested_at DESC NULLS LAST, event_id DESC NULLS LAST LIMIT 12"
    )
    q["serve_event_icons"] = "WITH " + EVENTS + f" SELECT event_id, event_type, {ICON} AS icon FROM e"
    q["serve_event_line"] = (
        "WITH " + EVENTS + f", ei AS (SELECT *, {ICON} AS icon FROM e) "
        "SELECT event_id, CAST(minute AS VARCHAR) || ''' ' || icon || ' ' || player || ' (' || team || ') "
        + DASH
        + " ' || home_team || ' vs ' || away_team AS line FROM ei"
    )
    q["serve_top_scorers"] = (
        "WITH " + EVENTS + "," + SCORERS + " SELECT *, player || ' (' || team || ')' AS label FROM scorers "
        "ORDER BY goals DESC, player ASC NULLS LAST, team ASC NULLS LAST LIMIT 8"
    )
    q["serve_group_list"] = STANDINGS + ' SELECT DISTINCT "group" FROM ranked WHERE "group" IS NOT NULL'
    q["serve_group_table"] = (
        STANDINGS + ' SELECT group_rank AS "#", team AS "Team", played AS "P", won AS "W", drawn AS "D", '
        'lost AS "L", goals_for AS "GF", goals_against AS "GA", goal_difference AS "GD", points AS "Pts" '
        "FROM ranked WHERE \"group\" = 'AFRICA'"
    )
    q["serve_form_spaced"] = (
        M + "," + FORM_SIDES + " SELECT team, string_agg(oc, ' ' ORDER BY matchday NULLS FIRST, oc) AS form "
        "FROM form_sides GROUP BY team"
    )
    q["serve_freshness"] = (
        M + " SELECT count(*) > 0 AS available, max(ingested_at) AS latest_ingested_at, count(*) AS rows FROM m"
    )
    q["kpi_matches_played"] = (
        M + " SELECT count(*) FILTER (WHERE status = 'finished') AS finished, count(*) AS total FROM m"
    )
    q["kpi_total_goals"] = (
        M + "," + TREND + " SELECT CAST(COALESCE(sum(goals), 0) AS BIGINT) AS total_goals FROM trend"
    )
    q["kpi_distinct_teams"] = STANDINGS + " SELECT count(DISTINCT team) AS teams FROM ranked"
    q["kpi_avg_goals"] = (
        M + "," + TREND + " SELECT round(avg(avg_goals_per_match), 6) AS avg_goals_per_match, "
        "round(CAST(sum(goals) AS DOUBLE) / sum(matches_played), 6) AS weighted_avg FROM trend"
    )

    # quality and gate
    cur = ", cur AS (SELECT * FROM merged WHERE is_current)"
    q["dq_report"] = _scd2(
        cur
        + ","
        + EVENTS
        + ","
        + SCORERS
        + ","
        + TREND
        + ","
        + FORM_SIDES
        + ", form AS (SELECT team, string_agg(oc, '' ORDER BY matchday NULLS FIRST, oc) AS form FROM form_sides GROUP BY team)"
        + ", rep AS ("
        + _checks("standings", "cur", ["team"], ["points"], UNKNOWN_TEAMS)
        + " UNION ALL "
        + _checks("goals_by_matchday", "trend", ["matchday"], ["goals"])
        + " UNION ALL "
        + _checks("top_scorers", "scorers", ["player"], ["goals"])
        + " UNION ALL "
        + _checks("team_form", "form", ["team", "form"], [])
        + " UNION ALL "
        + _checks(
            "matches",
            "m",
            ["home_team", "away_team"],
            [],
            rules={"finished_have_scores": "status = 'finished' AND (home_score IS NULL OR away_score IS NULL)"},
        )
        + ') SELECT "table", "check", CAST(failed_rows AS BIGINT) AS failed_rows, failed_rows = 0 AS passed FROM rep'
    )
    q["dq_unknown_teams"] = _scd2(cur + " " + UNKNOWN_TEAMS)
    q["gate_live"] = (
        M + " SELECT COALESCE(bool_or(NOT COALESCE(status IN ('finished'), false)), false) AS is_live, "
        "count(*) FILTER (WHERE NOT COALESCE(status IN ('finished'), false)) AS open_matches FROM m"
    )
    q.update(sql_sources())
    q.update(sql_html())
    q.update(sql_streaming())
    return q


TEAMS_ALL = """
teams_all AS (
  SELECT c_name AS name, r_name AS "group", CAST(NULL AS VARCHAR) AS source_table
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT s_name, r_name, CAST(NULL AS VARCHAR)
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""
BATCH_A = "'2026-06-20T00:00:00+00:00'"
BATCH_B = "'2026-06-27T00:00:00+00:00'"


def _landing_rows(batch: str) -> str:
    if batch == BATCH_A:
        return (
            "SELECT home_team, away_team, CAST(NULL AS VARCHAR) AS home_score, CAST(NULL AS VARCHAR) AS away_score, "
            '"group", CAST(matchday AS VARCHAR) AS matchday, stadium, \'scheduled\' AS status, '
            f"CAST(NULL AS VARCHAR) AS score, {BATCH_A} AS ingested_at, 'snapshot' AS source_name FROM raw_matches"
        )
    return (
        "SELECT home_team, away_team, CAST(home_score AS VARCHAR) AS home_score, "
        "CAST(away_score AS VARCHAR) || '.0' AS away_score, \"group\", CAST(matchday AS VARCHAR) AS matchday, "
        "stadium, status, CASE WHEN home_score IS NOT NULL AND away_score IS NOT NULL THEN "
        "CAST(home_score AS VARCHAR) || '–' || CAST(away_score AS VARCHAR) END AS score, "
        f"{BATCH_B} AS ingested_at, 'snapshot' AS source_name FROM raw_matches"
    )


def _summary(batch: str) -> str:
    return (
        f"SELECT {batch} AS fetched_at, 'snapshot' AS source_name, (SELECT count(*) FROM teams_all) AS teams, "
        "(SELECT count(*) FROM part) AS stadiums, (SELECT count(*) FROM raw_matches) AS matches"
    )


def sql_sources() -> dict[str, str]:
    q: dict[str, str] = {}
    w = "WITH " + RAW_MATCHES + "," + TEAMS_ALL + " "
    q["src_landing_json"] = w + _summary(BATCH_A) + " UNION ALL " + _summary(BATCH_B)
    q["src_latest_batch"] = w + _summary(BATCH_B)
    q["src_explode_entities"] = w + _landing_rows(BATCH_B)
    q["io_landing_roundtrip"] = w + _landing_rows(BATCH_A) + " UNION ALL " + _landing_rows(BATCH_B)
    q["src_landing_tolerant"] = (
        w + "SELECT 'teams' AS kind, (SELECT count(*) FROM teams_all) + (SELECT count(*) FROM region) AS n "
        "UNION ALL SELECT 'stadiums', (SELECT count(*) FROM part) UNION ALL SELECT 'malformed', (SELECT count(*) FROM nation) "
        "UNION ALL SELECT 'owners', (SELECT count(DISTINCT r_name) FROM region)"
    )
    q["src_registry"] = w + "SELECT * FROM teams_all"
    q["src_group_map_flatten"] = w + "SELECT * FROM teams_all"
    q["bronze_align_schema"] = (
        "SELECT c_name AS name, r_name AS \"group\", CAST(NULL AS VARCHAR) AS source_table "
        "FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey "
        "UNION ALL SELECT s_name, CAST(NULL AS VARCHAR), 'group_stage' FROM supplier"
    )
    q["bronze_stamp"] = (
        "SELECT p_name AS name, p_type AS city, p_brand AS country, p_size AS capacity, "
        f"{BATCH_B} AS ingested_at, 'snapshot' AS source_name FROM part"
    )
    # plain, '.7' and padded spellings are numbers; 'd', 'e3' and 'abc' aren't
    q["silver_typed_cast"] = (
        w + "SELECT home_team, away_team, CASE WHEN matchday % 6 IN (0, 3, 4) THEN home_score END AS home_score, "
        "away_score, matchday, status FROM raw_matches"
    )
    q["silver_stadiums"] = (
        f"SELECT trim(p_name) AS name, trim(p_type) AS city, max(p_brand) AS country, max(struct_pack(b := p_brand, s := p_size)).s AS capacity, "
        f"{BATCH_B} AS ingested_at, 'snapshot' AS source_name FROM part GROUP BY ALL"
    )
    q["silver_teams"] = (
        w + f"SELECT name, max(\"group\") AS \"group\", {BATCH_B} AS ingested_at, 'snapshot' AS source_name "
        "FROM teams_all GROUP BY name"
    )
    we = "WITH " + EVENTS + " "
    q["silver_events"] = (
        we + "SELECT * REPLACE (CASE WHEN event_type = 'goal' THEN ingested_at + INTERVAL 1 MINUTE "
        "ELSE ingested_at END AS ingested_at) FROM e"
    )
    q["src_events_json"] = we + "SELECT * FROM e"
    q["io_roundtrip"] = M + " SELECT * FROM m"
    q["io_append"] = we + "SELECT * FROM e UNION ALL SELECT * FROM e"
    again = "SELECT * REPLACE (ingested_at + INTERVAL 1 MINUTE AS ingested_at) FROM e WHERE event_type = 'goal'"
    q["io_rerun"] = (
        we + "SELECT 'bronze' AS layer, event_id, minute, ingested_at FROM (SELECT * FROM e UNION ALL " + again + ") "
        "UNION ALL SELECT 'silver', event_id, minute, CASE WHEN event_type = 'goal' THEN ingested_at + INTERVAL 1 MINUTE "
        "ELSE ingested_at END FROM e"
    )
    q["io_upsert"] = q["silver_events"]
    q["src_event_files"] = we + "SELECT * FROM e"
    q["io_overwrite"] = we + "SELECT * FROM e WHERE event_type = 'goal'"
    return q


SUPPLIER_TABLES = """
s AS (
  SELECT s_suppkey, s_name, n_name, n_nationkey, s_suppkey // 50 + 1000000000000 AS page_id
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
t AS (
  SELECT *, CAST(dense_rank() OVER (PARTITION BY page_id ORDER BY n_nationkey) - 1 AS INT) AS table_no,
    CAST(row_number() OVER (PARTITION BY page_id, n_nationkey ORDER BY s_suppkey) AS INT) AS row_no
  FROM s
)"""


def sql_html() -> dict[str, str]:
    q: dict[str, str] = {}
    q["html_table_rows"] = (
        "WITH " + SUPPLIER_TABLES + ", n AS (SELECT page_id, CAST(max(table_no) + 1 AS INT) AS k FROM t GROUP BY page_id) "
        "SELECT page_id, table_no, 'wikitable sortable' AS table_class, row_no, "
        "4 AS n_cells, CAST(s_suppkey AS VARCHAR) || '|' || s_name || '(H)|' || n_name || '|' || "
        "CAST(s_suppkey % 10 AS VARCHAR) AS cells_text FROM t "
        "UNION ALL SELECT DISTINCT page_id, table_no, 'wikitable sortable', 0, 4, 'No|Team|Nation|Pts' FROM t "
        # a nested table's row is a row of both tables, and its cell one of the enclosing row
        "UNION ALL SELECT page_id, k, 'navbox', 0, 2, 'navx|x' FROM n "
        "UNION ALL SELECT page_id, k, 'navbox', 1, 1, 'x' FROM n "
        "UNION ALL SELECT page_id, k + 1, 'plain', 0, 1, 'x' FROM n"
    )
    q["html_team_names"] = (
        "WITH " + SUPPLIER_TABLES + " SELECT DISTINCT s_name AS name, CAST(NULL AS VARCHAR) AS \"group\", "
        "'group_stage' AS source_table FROM t"
    )
    q["html_team_names_files"] = q["html_team_names"]
    q["html_stadiums"] = (
        "SELECT p_name AS name, p_type AS city, CAST(NULL AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS capacity "
        "FROM part"
    )
    q["html_match_boxes"] = (
        M + " SELECT home_team, away_team, CAST(home_score AS VARCHAR) || '–' || CAST(away_score AS VARCHAR) AS score "
        "FROM m WHERE home_score IS NOT NULL AND away_score IS NOT NULL"
    )
    scraped = (
        "scraped AS (SELECT home_team, away_team, home_score, away_score, CAST(NULL AS VARCHAR) AS \"group\", "
        "'finished' AS status, CASE WHEN home_score > away_score THEN 'home_win' WHEN home_score < away_score THEN 'away_win' "
        "ELSE 'draw' END AS result FROM m WHERE home_score IS NOT NULL AND away_score IS NOT NULL)"
    )
    q["pipeline_html_standings"] = M + ", " + scraped + standings_ctes("scraped") + " SELECT * FROM ranked"
    return q


def sql_streaming() -> dict[str, str]:
    we = "WITH " + EVENTS + " "
    return {
        "stream_events_land": we
        + "SELECT * FROM e UNION ALL SELECT * FROM e "
        + "WHERE event_type = 'goal' AND ingested_at < TIMESTAMP '2024-01-16 00:00:00'",
        "stream_events_dedup": we + "SELECT * FROM e",
        "stream_top_scorers": we + "," + SCORERS + " SELECT * FROM scorers",
        "serve_stream_freshness": we
        + "SELECT count(*) + count(*) FILTER (event_type = 'goal' AND ingested_at < TIMESTAMP '2024-01-16 00:00:00') AS rows_in, "
        + "CAST(0 AS BIGINT) AS rejected, max(ingested_at) AS latest FROM e",
        "stream_events_restamped": we + "SELECT * FROM e",
        "stream_top_scorers_compacted": we + "," + SCORERS + " SELECT * FROM scorers",
        "stream_standings_corrections": STANDINGS + " SELECT * FROM ranked",
        "stream_standings": STANDINGS + " SELECT * FROM ranked",
    }
