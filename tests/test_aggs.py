import datetime as dt

from conftest import rows
from recordlake.operators import aggs, setops

D1, D2, D3 = dt.date(2024, 6, 1), dt.date(2024, 6, 2), dt.date(2024, 6, 3)


def test_daily_mean_golden_and_nulls(spark):
    df = spark.createDataFrame([(D1, 75), (D1, 80), (D2, 65), (D2, 70), (None, 99), (D2, None), (D3, None)],
                               "date date, temperature int")
    out = aggs.daily_mean(df, "date", "temperature")
    assert out.schema["temperature"].dataType.typeName() == "double"
    assert rows(out) == [(D1, 77.5), (D2, 67.5), (D3, None)]
    assert [r.date for r in setops.order_by_key(out, "date").collect()] == [D1, D2, D3]


def test_missing_report(spark):
    df = spark.createDataFrame([("a", None), ("b", "x"), ("c", None), ("d", "")], "k string, lic string")
    r = aggs.missing_report(df, "lic").first()
    assert (r.missing, r.total, r.missing_ratio) == (2, 4, 0.5)
    empty = aggs.missing_report(df.where("false"), "lic").first()
    assert (empty.missing, empty.total, empty.missing_ratio) == (0, 0, None)


def test_resolution_report(spark):
    df = spark.createDataFrame([("c1", "A"), ("c2", ""), ("c3", None)], "code string, name string")
    r = aggs.resolution_report(df, "name").first()
    assert (r.looked_up, r.unresolved, r.resolved) == (3, 2, 1)


def test_observe_count(spark, tmp_dir):
    df = spark.range(10)
    counted, obs = aggs.observe_count(df)
    counted.write.parquet(tmp_dir)
    assert obs.get["rows"] == 10


def test_tail_and_union(spark):
    df = spark.range(100)
    assert sorted(r.id for r in setops.tail_rows(df, 5, "id").collect()) == [95, 96, 97, 98, 99]
    a = spark.createDataFrame([("p1", "L1")], "k string, lic string")
    b = spark.createDataFrame([("p2", "L2", 1)], "k string, lic string, n long")
    assert rows(setops.union_resumed(a, b)) == [("p1", "L1", None), ("p2", "L2", 1)]
