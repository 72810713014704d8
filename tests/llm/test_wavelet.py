import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from recordlake.llm import wavelet as W
from recordlake.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)
SF = "/root/testdata/sf0.001"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70_000), max_size=40), st.integers(0, 70_000))
def test_matrix_against_a_list(values, other):
    m = W.WaveletMatrix(W.WaveletMatrix.build(np.array(values, dtype=np.int64)))
    assert m.values().tolist() == values == [m.access(i) for i in range(len(values))]
    for v in {*values, other}:
        where = [i for i, x in enumerate(values) if x == v]
        assert m.positions(v) == where
        assert m.count(v) == len(where)
        assert m.count(v, 2, 20) == sum(2 <= i < 20 for i in where)
        with pytest.raises(IndexError):
            m.select(v, len(where))


def test_matrix_over_many_rank_blocks():
    values = np.random.default_rng(2).zipf(1.3, 20_000) % 50_257
    m = W.WaveletMatrix(W.WaveletMatrix.build(values))
    assert (m.values() == values).all()
    for v in (0, 1, 2, 7, 500):
        assert m.positions(v) == np.flatnonzero(values == v).tolist()
        assert m.count(v, 511, 10_241) == int((values[511:10_241] == v).sum())
    with pytest.raises(ValueError):
        W.WaveletMatrix.build(np.array([-1]))


def expected(rows):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*LIB.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_documents_in_many_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(W, "BLOCK", 5000)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    path = scratch_path(spark, "wavelet")
    W.write_ids(docs, path, PATH)
    got = sorted(tuple(r) for r in W.id_checksums(spark, path).collect())
    assert got == expected(rows)
    token = LIB.encode(" the").ids[0]
    where = [(i, k) for i, t in rows for k, x in enumerate(LIB.encode(t, add_special_tokens=False).ids) if x == token]
    assert sorted(tuple(r) for r in W.find_token(spark, path, token).collect()) == sorted(where)
    assert W.count_token(spark, path, token).groupBy().sum("count").first()[0] == len(where)


def test_edge_rows(spark):
    rows = [(5, "a b"), (5, "a b"), (5, None), (None, "x"), (1, ""), (2, "word " * 5000), (-3, "<|endoftext|>")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS shard", "2 AS n", "3 AS matrix")
    path = scratch_path(spark, "wavelet")
    W.write_ids(df, path, PATH)
    got = sorted((tuple(r) for r in W.id_checksums(spark, path).collect()), key=lambda r: r[1])
    assert got == expected(rows)
    path = scratch_path(spark, "wavelet")
    W.write_ids(df.limit(0), path, PATH)
    assert W.id_checksums(spark, path).collect() == []
