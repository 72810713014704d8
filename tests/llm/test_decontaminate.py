import re

import numpy as np
import pytest

from recordlake.llm import decontaminate as D

SF = "/root/testdata/sf0.01"


def shingles(text, k=5):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode()))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(docs, items, percent=80):
    sets = [(i, shingles(t)) for i, t in docs]
    out = []
    for j, t in {*items}:
        own = shingles(t)
        if own and j is not None:
            out += [(i, j, len(own), len(own & s)) for i, s in sets if 100 * len(own & s) >= percent * len(own)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("percent, block", [(80, 1 << 20), (50, 300)])
def test_documents_against_all_pairs(spark, monkeypatch, percent, block):
    monkeypatch.setattr(D, "ITEMS", block)
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows, [(r.item_id, r.text) for r in items.collect()], percent)
    assert want and got(D.contaminated(docs, items, percent=percent)) == want
    left = sorted(r.doc_id for r in D.drop_contaminated(docs, items, percent=percent).collect())
    assert left == sorted({i for i, _ in rows} - {w[0] for w in want})


def test_short_item_in_a_very_long_document(spark):
    rng = np.random.default_rng(6)
    word = lambda: f"w{rng.integers(50_000)}"
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([5, 6, 9, 14, 20, 24, 40, 80, 300])]
    docs = []
    for i, t in items:
        words = [word() for _ in range(20_000)]
        for n, w in enumerate(t.split()):
            words[5000 + n] = w.upper()
        docs.append((i, "\n".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = D.contaminated(df, spark.createDataFrame(items, "item_id long, text string"))
    assert got(out) == brute(docs, items)
    assert len(got(out)) == len(items)


def test_edge_rows(spark):
    docs = [(1, None), (2, ""), (3, "a b"), (4, "x A b c d E f"), (4, "x A b c d E f"), (None, "a b c d e"), (5, "a b c d")]
    items = [(1, "a b c d e"), (1, "a b c d e"), (1, "a B"), (2, None), (3, " "), (None, "a b c d"), (4, "a b c d e f g h i j")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item_id", "2 AS n_shared", "3 AS `a.b`")
    it = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id")
    assert got(D.contaminated(df, it)) == brute(docs, items)
    assert [r.doc_id for r in D.drop_contaminated(df, it).collect()] == [1, 2, 5]
    assert D.drop_contaminated(df, it).columns == df.columns
    assert D.contaminated(df.limit(0), it).collect() == D.contaminated(df, it.limit(0)).collect() == []
    assert D.drop_contaminated(df, it.limit(0)).count() == len(docs)
