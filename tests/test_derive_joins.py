"""How the match derivation joins suppliers."""

import re

from scoreline.plans import derive


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_suppliers_join_without_a_shuffle_of_the_line_items(spark, sf_small):
    text = plan(derive.raw_matches(spark, sf_small))
    assert re.search(r"BroadcastHashJoin \[l_suppkey", text)
    assert not re.search(r"Exchange hashpartitioning\(l_suppkey", text)


def test_more_suppliers_than_are_broadcast_are_shuffled(spark):
    few = spark.range(5)
    assert "broadcast" in derive.broadcast_if_small(few, 5)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in derive.broadcast_if_small(few, 4)._jdf.queryExecution().logical().toString().lower()
