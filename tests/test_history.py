import pytest
from pyspark.sql import functions as F

from conftest import plan_text, rows
from recordlake.operators.history import BITS, cut_to_keys, key_words
from recordlake.operators.joins import append_first_wins, new_rows, skip_seen


def frames(spark):
    history = spark.range(200_000).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("h"))
    history = history.unionByName(spark.sql("SELECT cast(null as string) AS k, -1L AS h"))
    batch = spark.range(199_900, 200_100).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("v"))
    return history, batch.unionByName(spark.sql("SELECT cast(null as string) AS k, 7L AS v"))


def test_only_the_batch_s_keys_pass(spark):
    history, batch = frames(spark)
    cut = cut_to_keys(history, batch, "k")
    assert cut.columns == history.columns
    kept = {r.k for r in cut.collect()}
    assert {f"k{i}" for i in range(199_900, 200_000)} | {None} <= kept
    assert len(kept) < 101 + 30  # 201 keys in 2^24 bits: 2 or 3 others are expected of 200,000


def test_joins_after_the_cut_are_exact(spark):
    history, batch = frames(spark)
    cut = cut_to_keys(history, batch, "k")
    assert rows(new_rows(batch, cut, "k")) == rows(new_rows(batch, history, "k"))
    assert len(rows(new_rows(batch, cut, "k"))) == 101
    assert rows(skip_seen(batch, cut, "k")) == rows(skip_seen(batch, history, "k"))
    assert len(rows(skip_seen(batch, cut, "k"))) == 100
    filed = batch.withColumn("f", F.lit("a"))
    assert rows(append_first_wins(filed, cut, "k", "f")) == rows(append_first_wins(filed, history, "k", "f"))


def test_composite_keys_repeats_and_empty_sides(spark):
    h = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a"), (1, "a")], "x int, y string")
    b = spark.createDataFrame([(1, "a", 0), (None, "a", 1)], "x int, y string, v int")
    assert rows(cut_to_keys(h, b, ["x", "y"])) == [(None, "a"), (1, "a"), (1, "a")]
    assert rows(cut_to_keys(h, b.limit(0), ["x", "y"])) == []
    assert rows(cut_to_keys(h.limit(0), b, ["x", "y"])) == []


@pytest.mark.parametrize("other", ["long", "string", "double"])
def test_keys_of_other_types_are_not_cut(spark, other):
    h = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(1,)], "k int").select(F.col("k").cast(other).alias("k"))
    assert rows(cut_to_keys(h, b, "k")) == [(1,), (2,)]


def test_bitmap_has_a_fixed_size(spark):
    words = key_words(spark.range(3_000_000), ["id"])
    assert words.count() <= BITS // 64
    assert set(words.columns) == {"_rl_word", "_rl_bits"}


def test_cut_comes_before_the_shuffle_and_hot_keys_are_split(spark, tmp_dir):
    """The history is filtered under its exchange, and a hot null key is still split by AQE."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    keep = {k: spark.conf.get(k) for k in conf}
    history, _ = frames(spark)
    history.write.parquet(f"{tmp_dir}/h")
    (spark.range(30_000, numPartitions=8).select(F.when(F.col("id") % 3 > 0, F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
                                                 F.sha2(F.col("id").cast("string"), 256).alias("v")).write.parquet(f"{tmp_dir}/b"))
    history, batch = spark.read.parquet(f"{tmp_dir}/h"), spark.read.parquet(f"{tmp_dir}/b")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = new_rows(batch, cut_to_keys(history, batch, "k"), "k")
        assert out.where("k is null").count() == 10_000
        out.collect()
        plan = plan_text(out, "simple")
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    final = plan.split("Initial Plan")[0]
    assert "skew=true" in final
    before = final[final.index("LeftAnti"):final.index("BroadcastHashJoin")]
    assert before.count("Exchange hashpartitioning(k#") == 2  # the semi join with the bitmap is under the history's exchange
