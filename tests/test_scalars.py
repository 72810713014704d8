import datetime as dt

from pyspark.sql import functions as F

from recordlake.functions import scalars as S


def one(spark, col, value=None, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("y")).first()["y"]


def test_previous_month_range(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 31),), (dt.date(2024, 1, 15),)], "d date")
    got = df.select(*[c.alias(n) for c, n in zip(S.previous_month_range("d"), ["a", "b"])]).collect()
    assert (got[0]["a"], got[0]["b"]) == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert (got[1]["a"], got[1]["b"]) == (dt.date(2023, 12, 1), dt.date(2023, 12, 31))


def test_format_date(spark):
    ts = dt.datetime(2025, 7, 8, 10, 11, 12)
    df = spark.createDataFrame([(ts,)], "t timestamp_ntz")
    r = df.select(S.format_date("t", "form").alias("a"), S.format_date("t", "stamp").alias("b"),
                  S.format_date("t", "day").alias("c"), S.batch_name("t").alias("n")).first()
    assert (r.a, r.b, r.c, r.n) == ("07/08/2025", "20250708_101112", "20250708", "batch_20250708_101112.parquet")


def test_batch_date_of(spark):
    names = ["batch_20250708_101112.parquet", "20250708.parquet", "x.parquet", "batch_20250709.parquet"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(S.batch_date_of("n")).collect()]
    assert got == ["20250708", "20250708", "x", "20250709"]


def test_clean_text_and_first_segment(spark):
    df = spark.createDataFrame([(" \t ACME SOLAR \n",), ("\u00a0x y\u00a0",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(S.clean_text("s")).collect()] == ["ACME SOLAR", "x y", "", None]
    df2 = spark.createDataFrame([(" ACME<br>1 Road",), ("no break",), ("<br>x",)], "s string")
    assert [r[0] for r in df2.select(S.first_segment("s")).collect()] == [" ACME", "no break", ""]


def test_to_millis_keeps_type(spark):
    ts = dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    df = spark.createDataFrame([(ts,), (dt.datetime(1969, 12, 31, 23, 59, 59, 999999),)], "t timestamp_ntz")
    out = df.select(S.to_millis("t").alias("m"))
    assert out.schema["m"].dataType.typeName() == "timestamp_ntz"
    got = [r.m for r in out.collect()]
    assert got == [dt.datetime(2024, 1, 1, 0, 0, 7, 179000), dt.datetime(1969, 12, 31, 23, 59, 59, 999000)]


def test_blank_ratio_suffix(spark):
    df = spark.createDataFrame([("",), (None,), ("a",)], "s string")
    assert [r[0] for r in df.select(S.is_blank("s")).collect()] == [True, True, False]
    r = spark.createDataFrame([(1, 8), (3, 0)], "a long, b long").select(
        S.ratio("a", "b").alias("r"), S.ratio_pct(S.ratio("a", "b")).alias("p")).collect()
    assert r[0].r == 0.125 and r[0].p == "12.5%"
    assert r[1].r is None and r[1].p is None
    df3 = spark.createDataFrame([("a.parquet",), ("a.csv",)], "s string")
    assert [r[0] for r in df3.select(S.ends_with("s")).collect()] == [True, False]


def test_file_segment(spark):
    paths = ["file:/d/batch_20240101_000000.parquet/part-00000-x.snappy.parquet",
             "file:/d/x.parquet", "s3a://b/d/b=batch_20240102_000000.parquet/part-1.parquet"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(S.file_segment(F.col("p"))).collect()] == [
        "batch_20240101_000000.parquet", "x.parquet", "batch_20240102_000000.parquet"]
