import numpy as np
import pytest

from recordlake.llm import neighbours as N

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=20, every=20):
    fine = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = []
    for q, x in fine:
        if q % every == 0:
            near = sorted((-float((x * y).sum()), i) for i, y in fine if i != q and len(x) == len(y))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(near)]
    return sorted(out)


def same(got, want):
    got = sorted(tuple(r) for r in got.collect())
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], rtol=0, atol=1e-12)


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    same(N.nearest(df), brute([(r.vec_id, r.embedding) for r in df.collect()]))


@pytest.mark.parametrize("tile, queries", [(2048, 2048), (16, 3)])
def test_edges_and_ties(spark, monkeypatch, tile, queries):
    monkeypatch.setattr(N, "TILE", tile)
    monkeypatch.setattr(N, "QUERIES", queries)
    rng = np.random.default_rng(4)
    rows = [(i, rng.integers(-3, 4, 3).astype(float).tolist()) for i in range(300)]
    rows += [(400 + i, [1.0, 2.0, 3.0]) for i in range(100)]
    rows += [(1000, None), (1020, [0.0, 0.0, 0.0]), (1040, [1.0, None, 2.0]), (1060, [float("nan"), 1.0, 1.0]),
             (1080, [float("inf"), 1.0, 1.0]), (1100, [1.0, 2.0]), (1101, [2.0, 2.0]), (None, [1.0, 1.0, 1.0]), (1120, []),
             (1140, [1e-30, -3e30, 5.0])]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS rank", "'x' AS score", "2 AS id").repartition(5)
    same(N.nearest(df), brute(rows))


def test_repeated_ids_and_nothing(spark):
    rows = [(20, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [2.0, 1.0]), (1, [2.0, 1.0])]
    got = N.nearest(spark.createDataFrame(rows, SCHEMA))
    assert sorted(tuple(r) for r in got.collect()) == [(20, 1, 1, 2.0), (20, 2, 1, 2.0)]
    assert N.nearest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_error_bounds_hold():
    rng = np.random.default_rng(0)
    a, b = N.Rounded(rng.normal(size=(50, 1500))), N.Rounded(rng.normal(size=(70, 1500)) ** 3)
    near = N.products(a.small, b.small) * a.scale[:, None] * b.scale
    bound = a.length[:, None] * b.residual + a.residual[:, None] * b.full
    assert (np.abs(near - a.exact @ b.exact.T) <= bound).all()
