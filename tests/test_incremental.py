import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from recordlake.operators.joins import append_first_wins
from recordlake.operators.project import number_batches
from recordlake.streaming.incremental import (
    append_micro_batch,
    incremental_append,
    read_progress,
    read_stored,
    write_progress,
)

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


def drop(spark, root, day, data):
    name = f"batch_202401{day:02d}_000000.parquet"
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(f"{root}/{name}")


def test_stream_three_drops_equals_one_pass(spark, tmp_dir):
    src, table, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    drops = [
        {1: [("a", 1), ("b", 2), (None, 3)], 2: [("a", 4), ("c", 5)]},
        {3: [("c", 6), ("d", 7), ("d", 8), (None, 9)]},
        {4: [("a", 10), ("e", 11)], 5: []},
    ]
    for d in drops:
        for day, data in d.items():
            drop(spark, src, day, data)
        incremental_append(spark, src, SCHEMA, table, ckpt, "k").awaitTermination()
    got = rows(read_stored(spark, table), "k", "v")
    assert got == [(None, 3), (None, 9), ("a", 1), ("b", 2), ("c", 5), ("d", 7), ("d", 8), ("e", 11)]
    # a further run with no new files appends nothing
    incremental_append(spark, src, SCHEMA, table, ckpt, "k").awaitTermination()
    assert rows(read_stored(spark, table), "k", "v") == got


def test_micro_batch_replay_is_idempotent(spark, tmp_dir):
    table = f"{tmp_dir}/t"
    b0 = spark.createDataFrame([("a", 1, "f1"), (None, 2, "f1")], "k string, v long, batch_file string")
    b1 = spark.createDataFrame([("a", 3, "f2"), ("b", 4, "f2"), (None, 5, "f2")], "k string, v long, batch_file string")
    append_micro_batch(b0, 0, table, "k", stream_id="s1")
    append_micro_batch(b1, 1, table, "k", stream_id="s1")
    once = rows(read_stored(spark, table), "k", "v")
    append_micro_batch(b1, 1, table, "k", stream_id="s1")  # replay
    assert rows(read_stored(spark, table), "k", "v") == once == [(None, 2), (None, 5), ("a", 1), ("b", 4)]


def test_two_checkpoints_and_a_lost_one_keep_all_rows(spark, tmp_dir):
    table = f"{tmp_dir}/table"
    drop(spark, f"{tmp_dir}/one", 1, [("a", 1), ("b", 2), (None, 0)])
    drop(spark, f"{tmp_dir}/two", 2, [("c", 3), ("d", 4), ("a", 9)])
    incremental_append(spark, f"{tmp_dir}/one", SCHEMA, table, f"{tmp_dir}/ck1", "k").awaitTermination()
    incremental_append(spark, f"{tmp_dir}/two", SCHEMA, table, f"{tmp_dir}/ck2", "k").awaitTermination()
    want = [(None, 0), ("a", 1), ("b", 2), ("c", 3), ("d", 4)]
    assert rows(read_stored(spark, table), "k", "v") == want
    # the checkpoint of the first is lost, its old file is gone, and a new one has arrived
    drop(spark, f"{tmp_dir}/one-later", 3, [("b", 7), ("e", 5)])
    incremental_append(spark, f"{tmp_dir}/one-later", SCHEMA, table, f"{tmp_dir}/ck3", "k").awaitTermination()
    assert rows(read_stored(spark, table), "k", "v") == [*want, ("e", 5)]


def test_unfinished_epoch_is_invisible(spark, tmp_dir):
    import os

    from recordlake.session import local_path

    table = f"{tmp_dir}/t"
    schema = "k string, v long, batch_file string"
    append_micro_batch(spark.createDataFrame([("a", 1, "f1")], schema), 0, table, "k", stream_id="s1")
    late = spark.createDataFrame([("b", 2, "f2"), ("a", 3, "f2")], schema)
    append_micro_batch(late, 1, table, "k", stream_id="s1")
    os.remove(os.path.join(local_path(table), "stream=s1", "batch_id=1", "_SUCCESS"))
    assert rows(read_stored(spark, table), "k", "v") == [("a", 1)]
    append_micro_batch(late, 1, table, "k", stream_id="s1")
    assert rows(read_stored(spark, table), "k", "v") == [("a", 1), ("b", 2)]


def test_write_progress_resumes_inside_a_range(spark, tmp_dir):
    df = number_batches(spark.range(0, 500).withColumnRenamed("id", "k"), "k", 50)
    assert write_progress(df.where(F.col("batch_id") < 3), f"{tmp_dir}/p", commits=2) == 150
    assert write_progress(df, f"{tmp_dir}/p", commits=2) == 350
    assert write_progress(df, f"{tmp_dir}/p") == 0
    got = read_progress(spark, f"{tmp_dir}/p")
    assert sorted((r.k, r.batch_id) for r in got.collect()) == [(i, i // 50) for i in range(500)]


def test_write_progress_keeps_what_a_failed_run_committed(spark, tmp_dir):
    df = number_batches(spark.range(0, 500).withColumnRenamed("id", "k"), "k", 50)
    broken = df.withColumn("k", F.when(F.col("batch_id") == 7, F.raise_error(F.lit("look-up failed"))).otherwise(F.col("k")).cast("long"))
    with pytest.raises(Exception, match="look-up failed"):
        write_progress(broken, f"{tmp_dir}/q", commits=5)
    assert sorted(r.k for r in read_progress(spark, f"{tmp_dir}/q").collect()) == list(range(300))
    assert write_progress(df, f"{tmp_dir}/q") == 200
    assert sorted(r.k for r in read_progress(spark, f"{tmp_dir}/q").collect()) == list(range(500))


@pytest.mark.parametrize("commits", [1, 4, 10])
def test_write_progress_reads_its_input_once(spark, tmp_dir, commits):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = number_batches(spark.range(0, 500).withColumnRenamed("id", "k"), "k", 50)
    counted = df.mapInPandas(count, df.schema)
    work = lambda part: part.withColumn("name", F.concat(F.lit("n"), F.col("k")))
    assert write_progress(counted, f"{tmp_dir}/p", commits=commits, step=work) == 500
    assert seen.value == 500
    got = read_progress(spark, f"{tmp_dir}/p")
    assert sorted((r.k, r.batch_id, r.name) for r in got.collect()) == [(i, i // 50, f"n{i}") for i in range(500)]
    assert write_progress(counted, f"{tmp_dir}/p", commits=commits, step=work) == 0


def test_write_progress_keeps_the_commits_before_a_failed_step(spark, tmp_dir):
    df = number_batches(spark.range(0, 500).withColumnRenamed("id", "k"), "k", 50)
    failing = lambda part: part.withColumn(
        "k", F.when(F.col("batch_id") == 6, F.raise_error(F.lit("look-up failed"))).otherwise(F.col("k")).cast("long"))
    with pytest.raises(Exception, match="look-up failed"):
        write_progress(df, f"{tmp_dir}/q", commits=10, step=failing)
    assert sorted(r.k for r in read_progress(spark, f"{tmp_dir}/q").collect()) == list(range(300))
    assert write_progress(df, f"{tmp_dir}/q", commits=10, step=lambda part: part) == 200
    assert sorted(r.k for r in read_progress(spark, f"{tmp_dir}/q").collect()) == list(range(500))


def test_first_wins_null_keys_skewed(spark):
    """A third of all rows under a null key, and a hot key: result is still exact."""
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit("hot"))
        .otherwise((F.col("id") % 50).cast("string")).alias("k"),
        F.col("id").alias("v"),
        F.concat(F.lit("batch_202401"), F.lpad(((F.col("id") % 9) + 1).cast("string"), 2, "0"),
                 F.lit("_000000.parquet")).alias("batch_file"))
    out = append_first_wins(df, None, "k", "batch_file")
    nulls = out.where(F.col("k").isNull()).count()
    assert nulls == n // 3
    first_hot = out.where(F.col("k") == "hot").agg(F.min("batch_file"), F.max("batch_file")).first()
    assert first_hot[0] == first_hot[1]
    assert dt is not None
