import random

import pytest

from pyspark.sql import functions as F

from conftest import rows
from recordlake.operators import joins

SCHEMA = "k string, v long, file string"


def test_new_rows_keeps_null_and_in_file_duplicates(spark):
    batch = spark.createDataFrame([("a", 1, "f1"), ("a", 2, "f1"), ("b", 3, "f1"), (None, 4, "f1"), (None, 5, "f1")], SCHEMA)
    stored = spark.createDataFrame([("b", 0, "f0"), (None, 0, "f0")], SCHEMA)
    out = joins.new_rows(batch, stored, "k")
    assert rows(out, "k", "v") == [(None, 4), (None, 5), ("a", 1), ("a", 2)]


def test_unmatched_codes_reports_null_once(spark):
    df = spark.createDataFrame([("c1",), ("c1",), ("c2",), (None,), (None,)], "code string")
    reg = spark.createDataFrame([("c2", "Two")], "code string, name string")
    assert rows(joins.unmatched_codes(df, reg, "code")) == [(None,), ("c1",)]


def test_enrich_inner_drops_null_codes_and_dedupes_on_request(spark):
    df = spark.createDataFrame([("p1", "c1"), ("p2", None), ("p3", "c9")], "pn string, code string")
    reg = spark.createDataFrame([("c1", "A"), ("c1", "B")], "code string, name string")
    assert rows(joins.enrich_inner(df, reg, "code"), "pn", "name") == [("p1", "A"), ("p1", "B")]
    assert rows(joins.enrich_inner(df, reg, "code", dedupe_registry=True), "pn", "name") == [("p1", "B")]


def test_enrich_inner_fails_on_a_code_listed_twice(spark):
    df = spark.createDataFrame([("p1", "c1"), ("p2", None), ("p3", "c1"), ("p4", "c9")], "pn string, code string")
    reg = spark.createDataFrame([("c1", "A"), (None, "x"), (None, "y"), ("c2", None)], "code string, name string")
    assert rows(joins.enrich_inner(df, reg, "code", unique=True), "pn", "name") == [("p1", "A"), ("p3", "A")]
    assert rows(joins.enrich_inner(df, reg.select("code"), "code", unique=True), "pn") == [("p1",), ("p3",)]
    assert joins.enrich_inner(df, reg.limit(0), "code", unique=True).collect() == []
    doubled = reg.unionByName(reg.where("code = 'c1'"))
    with pytest.raises(Exception, match="listed more than once"):
        joins.enrich_inner(df, doubled, "code", unique=True).collect()


def test_attach_results_null_matches_null(spark):
    batch = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "z")], "id long, k string")
    res = spark.createDataFrame([("a", "L1"), ("a", "L1"), (None, "LN")], "k string, lic string")
    out = joins.attach_results(batch, res, "k")
    assert out.columns == ["id", "k", "lic"]
    assert rows(out) == [(1, "a", "L1"), (2, "a", "L1"), (3, None, "LN"), (4, "z", None)]


def test_skip_seen_null_safe(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id long, k string")
    seen = spark.createDataFrame([(None,), ("a",)], "k string")
    assert rows(joins.skip_seen(df, seen, "k")) == [(3, "b")]
    seen2 = spark.createDataFrame([("a",)], "k string")
    assert rows(joins.skip_seen(df, seen2, "k")) == [(2, None), (3, "b")]


def test_skewed_null_and_hot_keys_are_split(spark):
    """A third of the rows under a null key and a third under one hot key: AQE cuts the
    oversized join partitions (skew=true in the final plan) and the result is exact."""
    from conftest import plan_text

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 30000
        batch = spark.range(0, n, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit("hot"))
            .otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
        stored = spark.range(0, 100).select((F.col("id") * 3 + 2).cast("string").alias("k"))
        out = joins.new_rows(batch, stored, "k")
        assert out.count() == n - 100
        out.collect()
        assert "skew=true" in plan_text(out, "simple")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def first_wins_loop(files, stored_keys):
    """Reference semantics: files in name order, each anti-joined with all rows so far."""
    seen = set(stored_keys)
    out = []
    for name in sorted(files):
        rows_ = files[name]
        new = [r for r in rows_ if r[0] is None or r[0] not in seen]
        out.extend(new)
        seen.update(r[0] for r in new if r[0] is not None)
    return out


def test_append_first_wins_equals_file_loop(spark):
    rnd = random.Random(7)
    for trial in range(3):
        files = {}
        for f in range(rnd.randint(1, 6)):
            name = f"batch_202401{f + 10:02d}_000000.parquet"
            files[name] = [(rnd.choice(["a", "b", "c", "d", "e", None]), rnd.randint(0, 99), name)
                           for _ in range(rnd.randint(0, 12))]
        stored = [rnd.choice(["a", "x", None])]
        expected = first_wins_loop(files, [k for k in stored if k is not None])
        batch = spark.createDataFrame([r for v in files.values() for r in v], SCHEMA)
        st = spark.createDataFrame([(k, 0, "old") for k in stored], SCHEMA)
        got = joins.append_first_wins(batch, st, "k", "file")
        key = lambda t: tuple((x is not None, x) for x in t)
        assert sorted(map(tuple, got.collect()), key=key) == sorted(expected, key=key), trial


def test_resolve_and_grow_registry(spark):
    pending = spark.createDataFrame([("p1", "c1"), ("p2", "c2"), ("p3", "c3"), ("p4", None), ("p5", "c2")],
                                    "pn string, code string")
    reg = spark.createDataFrame([("c1", "One")], "code string, name string")
    look = spark.createDataFrame([("c2", "Two", "ok"), ("c3", "", "ok"), ("c1", "Other", "ok")],
                                 "code string, name string, status string")
    enriched, resolved, grown = joins.resolve_and_grow_registry(pending, reg, look, "code", "name")
    assert rows(resolved) == [("c2", "Two")]
    assert rows(grown) == [("c1", "One"), ("c2", "Two")]
    assert rows(enriched, "pn", "name") == [("p1", "One"), ("p2", "Two"), ("p5", "Two")]


@pytest.fixture(params=["-1", "10MB"])
def threshold(spark, request):
    """Every test that takes it runs with broadcasts off and on."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_no_forced_broadcast_and_no_single_partition(spark):
    """Catalyst alone decides on broadcasts, and no row limit gathers rows in one task."""
    from conftest import plan_text

    from recordlake.sinks.upsert import upsert_frames

    batch = spark.range(100).select(F.col("id").alias("k"), F.lit("f").alias("file"))
    stored = spark.range(50).select(F.col("id").alias("k"), F.lit("s").alias("file"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames = [joins.new_rows(batch, stored, "k"), joins.attach_results(batch, stored.withColumnRenamed("file", "x"), "k"),
                  joins.append_first_wins(batch, stored, "k", "file"), joins.skip_seen(batch, stored, "k"),
                  upsert_frames(stored, batch, "k")[0], upsert_frames(stored, batch, "k", update_cols=[])[0]]
        for f in frames:
            txt = plan_text(f, "simple")
            assert "Broadcast" not in txt and "SinglePartition" not in txt
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_results_are_rows_that_a_look_up_gave(spark, threshold):
    batch = spark.createDataFrame([("p1",), ("p1",), (None,), ("p3",)], "k string")
    results = spark.createDataFrame([("p1", "L1", "ok"), ("p1", "L0", "zz"), (None, None, "x"), (None, "L9", None), ("p2", "L2", "no")],
                                    "k string, lic string, status string")
    assert rows(joins.attach_results(batch, results, "k")) == [
        (None, "L9", None), ("p1", "L1", "ok"), ("p1", "L1", "ok"), ("p3", None, None)]
    reg = spark.createDataFrame([("p1", "A", "z"), ("p1", "B", "a")], "k string, name string, city string")
    assert rows(joins.enrich_inner(batch, reg, "k", dedupe_registry=True)) == [("p1", "B", "a"), ("p1", "B", "a")]


def test_new_rows_and_seen_partition_the_batch(spark, threshold):
    """new rows + rows whose key is stored = the whole batch."""
    rnd = random.Random(11)
    for _ in range(2):
        data = [(rnd.choice(["a", "b", "c", "d", "e", None]), i, "f") for i in range(80)]
        batch = spark.createDataFrame(data, SCHEMA)
        stored = spark.createDataFrame([(k, 0, "s") for k in rnd.sample(["a", "b", "c", "x", None], 3)], SCHEMA)
        new = joins.new_rows(batch, stored, "k")
        seen = batch.join(stored.select("k").where("k IS NOT NULL"), "k", "left_semi")
        assert rows(new.unionByName(seen)) == rows(batch)


def test_skip_seen_matches_null_with_null(spark, threshold):
    rnd = random.Random(21)
    data = [(i, rnd.choice(["a", "b", "c", None])) for i in range(40)]
    batch = spark.createDataFrame(data, "id long, k string")
    for seen_keys in (["a", None], ["b", "z"], []):
        seen = spark.createDataFrame([(k,) for k in seen_keys], "k string")
        assert sorted(r.id for r in joins.skip_seen(batch, seen, "k").collect()) == [i for i, k in data if k not in seen_keys]


def test_session_keeps_skew_settings(spark):
    from recordlake.operators.skew import check_skew_settings

    assert check_skew_settings(spark) == {}
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        assert check_skew_settings(spark) == {"spark.sql.adaptive.skewJoin.enabled": "false"}
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_composite_keys(spark, threshold):
    """Two-column keys with null parts: the anti joins and J5."""
    rnd = random.Random(99)
    sch = "k1 string, k2 long, v long, file string"
    pick = lambda: (rnd.choice(["a", "b", None]), rnd.choice([1, 2, None]))
    data = [(*pick(), i, f"f{rnd.randint(1, 3)}") for i in range(80)]
    batch = spark.createDataFrame(data, sch)
    stored = spark.createDataFrame([(*pick(), 0, "s") for _ in range(6)], sch)
    ks = ["k1", "k2"]
    seen = {(r[0], r[1]) for r in stored.collect()}
    whole = {k for k in seen if None not in k}
    assert sorted(r.v for r in joins.new_rows(batch, stored, ks).collect()) == [r[2] for r in data if (r[0], r[1]) not in whole]
    assert sorted(r.v for r in joins.skip_seen(batch, stored, ks).collect()) == [r[2] for r in data if (r[0], r[1]) not in seen]
    # J5 against the file-by-file loop, composite key (a key with a null part never matches)
    files = {}
    for k1, k2, v, f in data:
        files.setdefault(f, []).append(((k1, k2) if k1 is not None and k2 is not None else None, v, f))
    seen0 = [(r[0], r[1]) for r in stored.collect() if r[0] is not None and r[1] is not None]
    expect = sorted((v for _, v, _ in first_wins_loop(files, seen0)))
    got = sorted(r.v for r in joins.append_first_wins(batch, stored, ks, "file").collect())
    assert got == expect
