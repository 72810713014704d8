import pytest

from conftest import rows
from recordlake.sinks.table import LakeTable, write_batch
from recordlake.sinks.upsert import upsert_frames
from recordlake.sources.files import scan_batches_for

S = "k string, a string, b double"


def test_create_append_read(spark, tmp_dir):
    t = LakeTable(spark, f"{tmp_dir}/t")
    assert not t.exists()
    o1 = t.create_if_missing_or_append(spark.createDataFrame([("x", "1", 1.0)], S))
    o2 = t.create_if_missing_or_append(spark.createDataFrame([(2.0, "y")], "b double, k string"))
    assert t.exists() and o1.get["rows"] == 1 and o2.get["rows"] == 1
    assert rows(t.read()) == [("x", "1", 1.0), ("y", None, 2.0)]
    with pytest.raises(ValueError):
        t.append(spark.createDataFrame([("z", 1)], "k string, extra long"))


def test_replace_reading_itself(spark, tmp_dir):
    t = LakeTable(spark, f"{tmp_dir}/t")
    t.create_or_replace(spark.createDataFrame([("x", "1", 1.0)], S))
    t.create_or_replace(t.read().selectExpr("k", "a", "b * 10 AS b"))
    assert rows(t.read()) == [("x", "1", 10.0)]
    assert t.current_version() == 2


def test_upsert_last_wins_null_value_and_rejects(spark, tmp_dir):
    t = LakeTable(spark, f"{tmp_dir}/t")
    t.create_or_replace(spark.createDataFrame([("k1", "old", 1.0), ("k2", "old", 2.0)], S))
    ch = spark.createDataFrame([("k1", "n1", 10.0, 1), ("k1", "n2", None, 2), ("k3", "n3", 3.0, 1),
                                (None, "bad", 0.0, 1)], S + ", seq long")
    obs, rejected = t.upsert(ch, "k", order_col="seq")
    assert rows(t.read()) == [("k1", "n2", None), ("k2", "old", 2.0), ("k3", "n3", 3.0)]
    assert rejected.count() == 1 and obs.get["rows"] == 3
    # applying the same changes again changes nothing
    t.upsert(ch, "k", order_col="seq")
    assert rows(t.read()) == [("k1", "n2", None), ("k2", "old", 2.0), ("k3", "n3", 3.0)]


def test_upsert_partial(spark):
    base = spark.createDataFrame([("k1", "keep", 1.0)], S)
    ch = spark.createDataFrame([("k1", "ignored", 5.0, 1), ("k2", "first", 7.0, 1), ("k2", "second", 8.0, 2)],
                               S + ", seq long")
    out, _ = upsert_frames(base, ch, "k", "seq", update_cols=["b"])
    assert rows(out) == [("k1", "keep", 5.0), ("k2", "first", 8.0)]


def test_null_order_is_the_lowest(spark):
    base = spark.createDataFrame([("k1", "a", 1.0), ("k2", "a", 1.0)], S)
    ch = spark.createDataFrame([("k1", "late", None, None), ("k1", "new", 2.0, 1), ("k2", "only", None, None)], S + ", seq long")
    out, _ = upsert_frames(base, ch, "k", "seq")
    assert rows(out) == [("k1", "new", 2.0), ("k2", "only", None)]


def test_partial_upsert_creates_the_table(spark, tmp_dir):
    """K7 on a missing table: insert-only columns from the first change, update columns from the last."""
    t = LakeTable(spark, f"{tmp_dir}/made")
    ch = spark.createDataFrame([("k2", "first", 7.0, 1), ("k2", "second", 8.0, 2)], S + ", seq long")
    t.upsert(ch, "k", "seq", update_cols=["b"])
    assert rows(t.read()) == [("k2", "first", 8.0)]


def test_upsert_creates_missing_table(spark, tmp_dir):
    t = LakeTable(spark, f"{tmp_dir}/w")
    t.upsert(spark.createDataFrame([("d1", 1.0), ("d1", 3.0)], "date string, avg double"), "date")
    assert rows(t.read()) == [("d1", 3.0)]


def test_batches_by_run_date(spark, tmp_dir):
    df = spark.createDataFrame([("p1", 1)], "permit_number string, n int")
    for stamp in ["20250708_101112", "20250708_235959", "20250709_000001"]:
        write_batch(df, f"{tmp_dir}/b", stamp)
    with pytest.raises(Exception):
        write_batch(df, f"{tmp_dir}/b", "20250708_101112")
    got = scan_batches_for(spark, f"{tmp_dir}/b", "20250708")
    assert rows(got, "batch_file") == [("batch_20250708_101112.parquet",), ("batch_20250708_235959.parquet",)]
    assert got.schema["n"].dataType.typeName() == "long"


def test_upsert_equals_sequential_replay(spark):
    """A keyed upsert of random changes = applying them one by one in order."""
    import random

    rnd = random.Random(5)
    base_rows = {f"k{i}": (f"a{i}", float(i)) for i in range(6)}
    changes = [(rnd.choice(["k0", "k2", "k7", "k8", None]), f"n{j}", rnd.choice([None, float(j)]), j) for j in range(25)]
    expect = dict(base_rows)
    for k, a, b, _ in changes:
        if k is not None:
            expect[k] = (a, b)
    base = spark.createDataFrame([(k, a, b) for k, (a, b) in base_rows.items()], S)
    out, rejected = upsert_frames(base, spark.createDataFrame(changes, S + ", seq long"), "k", "seq")
    assert rows(out) == sorted((k, a, b) for k, (a, b) in expect.items())
    assert rejected.count() == sum(1 for c in changes if c[0] is None)
    again, _ = upsert_frames(out, spark.createDataFrame(changes, S + ", seq long"), "k", "seq")
    assert rows(again) == rows(out)


def test_run_date_glob_matches_the_name_rule(spark, tmp_dir):
    """The listing glob keeps exactly the names the row-level rule (F3) maps to the run date."""
    from recordlake.sources.files import select_batch_files

    df = spark.createDataFrame([("p1", 1)], "permit_number string, n int")
    names = ["batch_20250708_101112", "20250708", "batch_20250708", "20250708_x", "batch_20250709_000000",
             "x", "batch_2025070800_1"]
    for n in names:
        df.write.parquet(f"{tmp_dir}/g/{n}.parquet")
    got = sorted(r.batch_file for r in scan_batches_for(spark, f"{tmp_dir}/g", "20250708").collect())
    names_df = spark.createDataFrame([(f"{n}.parquet",) for n in names], "batch_file string")
    expect = sorted(r.batch_file for r in select_batch_files(names_df, "20250708").collect())
    assert got == expect == ["20250708.parquet", "20250708_x.parquet", "batch_20250708.parquet",
                             "batch_20250708_101112.parquet"]


def test_half_committed_append_is_invisible(spark, tmp_dir):
    """A write that died during its commit (files present, no _SUCCESS) is not read; the next
    append lands in a fresh part."""
    import os

    from recordlake.session import local_path

    t = LakeTable(spark, f"{tmp_dir}/t")
    t.create_or_replace(spark.createDataFrame([("x", "1", 1.0)], S))
    t.append(spark.createDataFrame([("y", "2", 2.0)], S))
    # simulate the crash: copy of a part's data file without the commit marker
    broken = f"{t.root}/v=000001/a=000002"
    spark.createDataFrame([("ghost", "g", 9.0)], S).coalesce(1).write.parquet(broken)
    os.remove(os.path.join(local_path(broken), "_SUCCESS"))
    assert rows(t.read()) == [("x", "1", 1.0), ("y", "2", 2.0)]
    t.append(spark.createDataFrame([("z", "3", 3.0)], S))
    assert rows(t.read()) == [("x", "1", 1.0), ("y", "2", 2.0), ("z", "3", 3.0)]


def test_partial_upsert_equals_sequential_replay(spark):
    """K7: stored keys update only update_cols; a new key takes insert-only columns from its
    first change and update columns from its last."""
    import random

    rnd = random.Random(17)
    base_rows = {f"k{i}": (f"a{i}", float(i)) for i in range(5)}
    changes = [(rnd.choice(["k1", "k3", "k6", "k7"]), f"n{j}", rnd.choice([None, float(j)]), j) for j in range(30)]
    expect = dict(base_rows)
    for k, a, b, _ in changes:  # ON CONFLICT DO UPDATE SET b = EXCLUDED.b, applied in order
        expect[k] = (expect[k][0], b) if k in expect else (a, b)
    base = spark.createDataFrame([(k, a, b) for k, (a, b) in base_rows.items()], S)
    ch = spark.createDataFrame(changes, S + ", seq long")
    out, _ = upsert_frames(base, ch, "k", "seq", update_cols=["b"])
    assert rows(out) == sorted((k, a, b) for k, (a, b) in expect.items())


def months(spark, tmp_dir):
    from recordlake.sinks.table import PartitionedTable

    return PartitionedTable(spark, f"{tmp_dir}/days", "day", "date_format(day, 'yyyy-MM')")


def test_upsert_of_one_day_touches_one_month(spark, tmp_dir):
    """One day of ten years is read and written with its month alone."""
    import glob
    import os

    from recordlake.session import local_path

    t = months(spark, tmp_dir)
    days = spark.sql("SELECT explode(sequence(DATE'2010-01-01', DATE'2019-12-31')) AS day").selectExpr("day", "CAST(dayofyear(day) AS DOUBLE) AS v")
    t.upsert(days)
    listed = lambda: {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{local_path(t.root)}/part=*/*.parquet")}
    before = listed()
    change = spark.createDataFrame([("2014-07-09", -1.0)], "day string, v double").selectExpr("CAST(day AS DATE) AS day", "v")
    assert {f.split("/part=")[1][:7] for f in t.touched(change).inputFiles()} >= {"2014-07"}
    assert t.touched(change).count() == 31
    obs, _ = t.upsert(change)
    after = listed()
    assert obs.get["rows"] == 31
    assert {p.split("/part=")[1][:7] for p, _ in set(before.items()) ^ set(after.items())} == {"2014-07"}
    got = {str(r.day): r.v for r in t.read().collect()}
    want = {str(r.day): r.v for r in days.collect()} | {"2014-07-09": -1.0}
    assert got == want and t.read().columns == ["day", "v"]


def test_partitioned_upsert_equals_a_full_one(spark, tmp_dir):
    import random

    rnd = random.Random(3)
    t = months(spark, tmp_dir)
    schema = "day date, a string, b double"
    base = spark.createDataFrame([], schema)
    for step, cols in enumerate([None, None, ["b"], ["a"]]):
        rows_ = [(f"2020-{rnd.randint(1, 6):02d}-{rnd.randint(1, 5):02d}" if rnd.random() < .9 else None, f"s{step}{i}", rnd.choice([None, float(i)]), i) for i in range(25)]
        ch = spark.createDataFrame(rows_, "day string, a string, b double, seq long").selectExpr("CAST(day AS DATE) AS day", "a", "b", "seq")
        want, gone = upsert_frames(base, ch, "day", "seq", cols)
        _, rejected = t.upsert(ch, "day", order_col="seq", update_cols=cols)
        base = spark.createDataFrame(want.collect(), schema)
        assert rows(t.read(), "day", "a", "b") == rows(base) and rejected.count() == gone.count()


def test_partitioned_upsert_that_died_is_run_again(spark, tmp_dir):
    import pytest

    t = months(spark, tmp_dir)
    day = lambda x: spark.createDataFrame([("2020-01-01", x), ("2020-02-01", x)], "day string, v double").selectExpr("CAST(day AS DATE) AS day", "v")
    t.upsert(day(1.0))
    with pytest.raises(Exception, match="look-up failed"):
        t.upsert(day(2.0).selectExpr("day", "IF(month(day) = 2, CAST(raise_error('look-up failed') AS DOUBLE), v) AS v"))
    assert [r.v for r in t.read().collect()] == [1.0, 1.0]
    for _ in range(2):
        t.upsert(day(2.0))
        assert [r.v for r in t.read().collect()] == [2.0, 2.0]
    with pytest.raises(ValueError):
        t.upsert(day(3.0), "v")
