import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402


def own():
    """The queries of the library itself; those of optional parts have tests of their own."""
    return [n for n in E.queries() if n.startswith("q_")]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["event_id", "user_key", "batch_file"]


def test_every_query_has_oracle():
    assert {n for n in E.oracle_sql() if n.startswith("q_")} == set(own())


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_queries_match_oracle(spark, sf):
    from oracle_check import compare

    rep = compare(spark, sf, own())
    bad = {k: v for k, v in rep.items() if not v.startswith("OK")}
    assert not bad, bad


def test_queries_match_oracle_with_shuffle_plans(spark):
    """Every query again with all broadcasts off: the plans used beyond the size bounds."""
    from oracle_check import compare

    old_thr = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rep = compare(spark, "/root/testdata/sf0.001", own())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old_thr)
    bad = {k: v for k, v in rep.items() if not v.startswith("OK")}
    assert not bad, bad
