import re

import numpy as np
import pytest

from recordlake.llm import setsketch as S

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string"


def shingles(text, k=5):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode()))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows, percent, k=5):
    """{doc_id: (set size, component)} by comparing all pairs."""
    sets = {i: shingles(t, k) for i, t in rows}
    comp = {i: i for i in sets}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x
    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                x = len(a & b)
                if 100 * x >= percent * (len(a) + len(b) - x):
                    lo, hi = sorted((root(i), root(j)))
                    comp[hi] = lo
    return {i: (len(sets[i]), root(i)) for i in sets}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("percent", [80, 85])
def test_documents_against_all_pairs(spark, percent):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = S.near_duplicates(docs, percent=percent)
    assert result(got) == brute(rows, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (6, "b a"), (None, "a b"), (7, "x " * 3000),
            (8, "x " * 2999), (9, "p q r s t u"), (9, "a b")]
    got = S.near_duplicates(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS node", "2 AS key"), percent=85)
    by = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in got.collect())
    assert by == [(False, 1, 0, 1, True), (False, 2, 0, 2, True), (False, 3, 0, 3, True), (False, 4, 1, 4, True),
                  (False, 5, 1, 4, False), (False, 6, 1, 6, True), (False, 7, 1, 7, True), (False, 8, 1, 7, False),
                  (False, 9, 1, 4, False), (False, 9, 2, 4, False), (True, 0, 1, None, True)]
    assert S.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_large_group_of_near_copies_is_cut_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 8)
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(90):
        words = list(base)
        for p in rng.choice(150, rng.integers(0, 9), replace=False):
            words[p] = f"v{rng.integers(10**6)}"
        rows.append((i * 3, " ".join(words)))
    got = S.near_duplicates(spark.createDataFrame(rows, SCHEMA), percent=85)
    assert result(got) == brute(rows, 85)


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    pool = rng.integers(1, 1 << 62, 3000).astype(np.uint64)
    for size, shared in ((40, 30), (900, 700), (2000, 100)):
        a, b = pool[:size], pool[size - shared:2 * size - shared]
        union = np.unique(np.concatenate([a, b]))
        regs = S.sketches(np.concatenate([a, b, union]), np.cumsum([0, len(a), len(b), len(union)]))
        assert (S.merge(regs[0], regs[1]) == regs[2]).all()
        j = shared / len(union)
        more = np.array([(regs[0] > regs[1]).sum()])
        same = np.array([(regs[0] == regs[1]).sum()])
        est = S.estimate(more, S.REGISTERS - more - same, same, np.array([size * 1.0]), np.array([size * 1.0]))[0]
        assert abs(est - j) < 5 * np.sqrt(j * (1 - j) / S.REGISTERS) + 0.01
