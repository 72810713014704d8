import hashlib
import re

import numpy as np
import pytest

from recordlake.llm import substrings as S

SCHEMA = "doc_id long, text string"


def brute(rows, window=50):
    docs = [(i, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for i, t in rows]
    first = {}
    for i, w in docs:
        if i is not None:
            for s in range(len(w) - window + 1):
                key = tuple(w[s:s + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in docs:
        gone = set()
        if i is not None:
            for s in range(len(w) - window + 1):
                if first[tuple(w[s:s + window])] < i:
                    gone.update(range(s, s + window))
        kept = b" ".join(x for n, x in enumerate(w) if n not in gone)
        out.append((i is None, i or 0, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute(rows_of(docs))
    assert sum(r[3] for r in want) > 0
    assert got(S.remove_repeats(docs, keep_text=False)) == want


@pytest.mark.parametrize("gather, partition", [(1 << 21, 1 << 21), (1 << 21, 5000), (700, 1400), (400, 190)])
def test_planted_passages(spark, monkeypatch, gather, partition):
    monkeypatch.setattr(S, "GATHER", gather)
    monkeypatch.setattr(S, "PARTITION", partition)
    rng = np.random.default_rng(8)
    new = lambda n: [f"w{x}" for x in rng.integers(0, 10**7, n)]
    passages = [new(n) for n in (49, 50, 51, 75, 130)]
    rows = []
    for i in range(120):
        words = new(int(rng.integers(0, 60)))
        for p in rng.choice(5, rng.integers(0, 4)):
            words += passages[p] + new(int(rng.integers(0, 30)))
        rows.append((int(rng.permutation(1000)[0]) * 3 + i % 3, " ".join(words)))
    rows = list(dict(rows).items())
    rows += [(5000 + i, rows[0][1]) for i in range(3)] + [(6001, "x " * 400), (6002, "y " + "x " * 300), (6003, "x " * 51)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    want = brute(rows)
    assert got(S.remove_repeats(df, keep_text=False)) == want
    kept = {r.doc_id: r for r in S.remove_repeats(df).collect()}
    for i, t in rows:
        r = kept[i]
        assert (r.kept_text is None) == (r.n_removed == 0)
        assert r.kept_text is None or hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256


def test_minimizers_of_windows():
    rng = np.random.default_rng(1)
    text = " ".join(f"w{x}" for x in rng.integers(0, 500, 300))
    t = next(S.texts_of(S.pa.array([text, "a b", text])))
    w = S.words_of(t)
    seeds = S.runs(w, S.SEED)
    for size in (S.SEED, S.SEED + 1, S.BLOCK, S.WINDOW):
        got, at = S.minimizers(w, size), S.whole_runs(w, size)
        want = np.array([seeds[i:i + size - S.SEED + 1].min() for i in at])
        assert (got[at] == S.mix(want)).all()
        assert (got[at[:len(at) // 2]] == got[at[len(at) // 2:]]).all()
    # neighbours share their minimizer: a passage of n windows has few of them
    assert len(np.unique(S.minimizers(w, S.WINDOW)[S.whole_runs(w, S.WINDOW)])) < 251 / 10


def test_edge_rows(spark):
    long = " ".join(f"a{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, " \t"), (None, long), (4, long), (4, long), (5, long + " tail"), (5, "head " + long), (6, long.upper()), (0, "b c")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS row", "'x' AS pos", "2 AS sha", "3 AS `k.l`")
    assert got(S.remove_repeats(df)) == brute(rows)
    assert S.remove_repeats(df.limit(0)).collect() == []
