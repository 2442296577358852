"""SCD2: merge semantics, null-safe keys, and history properties."""

import datetime as dt

from pyspark.sql import functions as F

from scoreline.operators import scd2

T1, T2, T3 = dt.datetime(2026, 6, 1), dt.datetime(2026, 6, 2), dt.datetime(2026, 6, 3)
SCHEMA = "group string, team string, points long"


def snap(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def apply(existing, incoming, ts):
    return scd2.apply(existing, incoming, ["group", "team"], ["points"], ts)


def test_close_insert_keep(spark):
    v1 = scd2.initial(snap(spark, [("A", "x", 3), ("A", "y", 0), ("B", "z", 1)]), T1)
    v2 = apply(v1, snap(spark, [("A", "x", 3), ("A", "y", 3), ("B", "w", 0)]), T2)
    got = {(r["team"], r["is_current"]): r for r in v2.collect()}
    assert got[("x", True)]["effective_from"] == T1 and got[("x", True)]["effective_to"] is None  # unchanged
    assert got[("y", False)]["effective_to"] == T2 and got[("y", True)]["effective_from"] == T2  # changed
    assert got[("z", False)]["effective_to"] == T2 and ("z", True) not in got  # gone
    assert got[("w", True)]["effective_from"] == T2  # new
    assert v2.count() == 5


def test_null_group_key_matches_itself(spark):
    v1 = scd2.initial(snap(spark, [(None, "x", 3)]), T1)
    v2 = apply(v1, snap(spark, [(None, "x", 3)]), T2)
    rows = v2.collect()
    assert len(rows) == 1 and rows[0]["is_current"] and rows[0]["effective_from"] == T1


def test_history_passes_through_and_properties(spark):
    v1 = scd2.initial(snap(spark, [("A", "x", 0), ("A", "y", 0)]), T1)
    v2 = apply(v1, snap(spark, [("A", "x", 3), ("A", "y", 0)]), T2)
    v3 = apply(v2, snap(spark, [("A", "x", 4), ("A", "y", 1)]), T3)
    rows = v3.collect()
    # one open row per key
    opened = [r["team"] for r in rows if r["is_current"]]
    assert sorted(opened) == ["x", "y"]
    # versions of a key do not overlap and chain
    for team in ("x", "y"):
        vs = sorted([r for r in rows if r["team"] == team], key=lambda r: r["effective_from"])
        for a, b in zip(vs, vs[1:]):
            assert a["effective_to"] == b["effective_from"]
    assert len([r for r in rows if r["team"] == "x"]) == 3
    # as-of the latest stamp equals the current view
    cur = sorted((r["team"], r["points"]) for r in scd2.current(v3).collect())
    asof = sorted((r["team"], r["points"]) for r in scd2.as_of(v3, T3).collect())
    assert cur == asof == [("x", 4), ("y", 1)]
    # as-of between stamps gives the older version
    mid = sorted((r["team"], r["points"]) for r in scd2.as_of(v3, T1 + dt.timedelta(hours=1)).collect())
    assert mid == [("x", 0), ("y", 0)]


def test_reapply_same_snapshot_is_noop(spark):
    v1 = scd2.initial(snap(spark, [("A", "x", 0), ("B", "y", 2)]), T1)
    merged = scd2.merge(v1, snap(spark, [("A", "x", 0), ("B", "y", 2)]), ["group", "team"], ["points"], T2)
    m = scd2.metrics(merged).first()
    assert (m["unchanged"], m["closed"], m["inserted"]) == (2, 0, 0)


def test_changed_keys_labels(spark):
    v1 = scd2.initial(snap(spark, [("A", "x", 0), ("A", "y", 0), ("A", "z", 0)]), T1)
    ck = scd2.changed_keys(v1, snap(spark, [("A", "x", 0), ("A", "y", 1), ("A", "n", 0)]), ["group", "team"], ["points"])
    assert sorted((r["team"], r["change"]) for r in ck.collect()) == [("n", "new"), ("y", "changed"), ("z", "gone")]


def test_stamp_is_timestamp_ntz(spark):
    v1 = scd2.initial(snap(spark, [("A", "x", 0)]), T1)
    assert dict(v1.dtypes)["effective_from"] == "timestamp_ntz"
    assert v1.filter(F.col("effective_to").isNull()).count() == 1


def test_empty_incoming_closes_every_open_version(spark):
    v1 = scd2.initial(snap(spark, [("A", "x", 3), ("B", "y", 1)]), T1)
    v2 = apply(v1, snap(spark, []), T2)
    rows = v2.collect()
    assert len(rows) == 2 and not any(r["is_current"] for r in rows)
    assert all(r["effective_to"] == T2 for r in rows)
    assert scd2.current(v2).count() == 0 and scd2.as_of(v2, T1).count() == 2
