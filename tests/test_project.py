import datetime as dt
import pathlib

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import plan_text, rows
from recordlake.operators import project


def test_drop_unnamed(spark):
    df = spark.createDataFrame([(1, "x", None)], "a long, b string, _c7 string")
    assert project.drop_unnamed(df).columns == ["a", "b"]
    with pytest.raises(ValueError):
        project.drop_unnamed(df.drop("_c7"), strict=True)


def test_canonical_names(spark):
    df = spark.createDataFrame([(1, 2)], "`Permit Number` long, `Installer Number` long")
    out = project.canonical_names(df, {"Installer Number": "license_no"})
    assert out.columns == ["permit_number", "license_no"]


def test_normalize_types(spark):
    df = spark.createDataFrame(
        [(1, 2.5, True, dt.datetime(2024, 1, 1, 1, 2, 3, 456789), dt.date(2024, 1, 2), "s", [1, 2])],
        "i int, f float, b boolean, t timestamp, d date, s string, a array<int>")
    out = project.normalize_types(df)
    types = {f.name: f.dataType for f in out.schema.fields}
    assert types["i"] == T.LongType() and types["f"] == T.DoubleType() and types["b"] == T.BooleanType()
    assert types["t"] == T.TimestampNTZType() and types["d"] == T.StringType() and types["a"] == T.StringType()
    r = out.first()
    assert r.t == dt.datetime(2024, 1, 1, 1, 2, 3, 456000) and r.d == "2024-01-02" and r.a == "[1,2]"


def test_keep_resolved_and_search(spark):
    df = spark.createDataFrame([("c1", "A"), ("c2", ""), ("c3", None)], "code string, name string")
    assert rows(project.keep_resolved(df, "name", ["code"])) == [("c1",)]
    recs = spark.createDataFrame([
        (dt.datetime(2024, 2, 1), "Residential", "Solar Array"),
        (dt.datetime(2024, 2, 29, 23, 0), "Residential", "Solar Array"),
        (dt.datetime(2024, 3, 1), "Residential", "Solar Array"),
        (dt.datetime(2024, 2, 10), "Commercial", "Solar Array"),
    ], "date timestamp_ntz, usage string, type string")
    out = project.search_records(recs, "date", "2024-02-01", "2024-02-29",
                                 {"usage": "Residential", "type": "Solar Array"})
    assert out.count() == 2


def test_search_filters_reach_parquet_scan(spark):
    from recordlake.functions.scalars import previous_month_range

    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    start, end = previous_month_range(F.lit("1997-03-15").cast("date"))
    out = project.search_records(o, "o_orderdate", start, end, {"o_orderstatus": "F"}).select("o_orderkey")
    plan = plan_text(out)
    pushed = [ln for ln in plan.splitlines() if "PushedFilters" in ln][0]
    assert "o_orderdate" in pushed and "o_orderstatus" in pushed
    schema_line = [ln for ln in plan.splitlines() if "ReadSchema" in ln][0]
    assert "o_totalprice" not in schema_line


def test_number_batches_matches_row_number(spark):
    df = spark.range(0, 1037, 1, 7).select((F.col("id") * 7 % 1037).alias("k"), F.col("id").alias("v"))
    got = project.number_batches(df, "k", 50, pos_col="pos")
    expect = df.select("k", ((F.row_number().over(Window.orderBy("k")) - 1)).alias("pos"))
    assert rows(got, "k", "pos") == rows(expect, "k", "pos")
    assert rows(got.groupBy("batch_id").count())[-1] == (20, 37)
    assert rows(got.where(F.col("batch_id") != F.floor(F.col("pos") / 50))) == []


def test_is_error_page(spark):
    df = spark.createDataFrame([("https://x/Error.aspx?x=1",), ("https://x/ok",)], "u string")
    assert [r[0] for r in df.select(project.is_error_page("u")).collect()] == [True, False]


def test_number_batches_composite_order(spark):
    df = spark.range(0, 523, 1, 5).select((F.col("id") % 7).alias("d"), (F.col("id") * 13 % 523).alias("p"))
    got = project.number_batches(df, ["d", "p"], 50, pos_col="pos")
    expect = df.select("d", "p", (F.row_number().over(Window.orderBy("d", "p")) - 1).alias("pos"))
    assert rows(got, "d", "p", "pos") == rows(expect, "d", "p", "pos")


def _bytes_under(path):
    return sum(f.stat().st_size for f in pathlib.Path(path).rglob("*") if f.is_file())


def test_number_batches_writes_down_the_order_columns_only(spark):
    def written(width):
        df = spark.range(0, 2000, 1, 4).select("id", F.repeat(F.sha2(F.col("id").cast("string"), 256), width).alias("text"))
        before = _bytes_under(folder)
        assert project.number_batches(df, "id", 50).where("length(text) <> 64 * %d" % width).count() == 0
        return _bytes_under(folder) - before
    project.number_batches(spark.range(1), "id")  # the folder is set by the first call
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    one, many = written(1), written(100)
    assert one > 0 and many <= 1.1 * one


def test_number_batches_with_other_columns_needs_a_certain_order(spark):
    df = spark.createDataFrame([(None, "n"), (2, "b"), (1, "a")], "k long, v string")
    assert rows(project.number_batches(df, "k", 2, pos_col="pos")) == [(None, "n", 0, 0), (1, "a", 0, 1), (2, "b", 1, 2)]
    assert project.number_batches(df.limit(0), "k").collect() == []
    with pytest.raises(Exception, match="no certain place"):
        project.number_batches(df.unionByName(df), "k").collect()
    twice = project.number_batches(df.select("k").unionByName(df.select("k")), "k", 2)
    assert sorted(r.batch_id for r in twice.collect()) == [0, 0, 1, 1, 2, 2]
