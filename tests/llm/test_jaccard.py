import numpy as np
import pytest

from recordlake.llm import jaccard as J
from test_setsketch import SCHEMA, brute, result

SF = "/root/testdata/sf0.01"


def three(rows, percent=90):
    return brute(rows, percent, 3)


def test_documents_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(J.jaccard_join(docs)) == three(rows)


def near_copies(rng, base, n, first, most, step=1):
    rows = []
    for i in range(n):
        words = list(base)
        for p in rng.choice(len(base), rng.integers(0, most + 1), replace=False):
            words[p] = f"v{rng.integers(10**6)}"
        rows.append((first + i * step, " ".join(words)))
    return rows


@pytest.mark.parametrize(("rare", "common", "percent"), [(0, 0, 90), (0, 10**9, 90), (3, 12, 90), (3, 12, 80), (10**9, 10**9, 95)])
def test_classes_of_tokens_change_nothing(spark, rare, common, percent):
    """Frequent tokens in twos, threes or alone; sets around powers of two, where levels meet."""
    rng = np.random.default_rng(rare % 7 + percent)
    rows = []
    for g, size in enumerate((12, 16, 31, 33, 66, 70, 130, 250, 520)):
        base = [f"w{rng.integers(40)}" for _ in range(size)]
        for cut in (0, 1, 2, 3):
            rows += near_copies(rng, base[:size - cut * (size // 40 + 1)], 5, 1000 * g + cut * 10, max(1, size // 60))
    got = J.jaccard_join(spark.createDataFrame(rows, SCHEMA), percent=percent, rare=rare, common=common)
    assert result(got) == three(rows, percent)


def test_large_groups_are_cut_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 8)
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(300)]
    rows = near_copies(rng, base, 60, 0, 9, 3)
    # a passage that unlike documents share puts them into one bucket without a link
    for i in range(40):
        rows.append((1000 + i, " ".join(base[:30] + [f"u{rng.integers(10**6)}" for _ in range(90)])))
    assert result(J.jaccard_join(spark.createDataFrame(rows, SCHEMA))) == three(rows)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (6, "b a"), (None, "a b"), (7, "x " * 3000),
            (8, "x " * 2999), (9, "p q r s t u"), (9, "a b"), (10, "ä b c d"), (10, "ä b c d")]
    got = J.jaccard_join(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS node", "2 AS key", "'x' AS bits"))
    by = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in got.collect())
    assert by == [(False, 1, 0, 1), (False, 2, 0, 2), (False, 3, 0, 3), (False, 4, 1, 4), (False, 5, 1, 4), (False, 6, 1, 6),
                  (False, 7, 1, 7), (False, 8, 1, 7), (False, 9, 1, 4), (False, 9, 4, 4), (False, 10, 1, 10), (False, 10, 1, 10),
                  (True, 0, 1, None)]
    assert J.jaccard_join(spark.createDataFrame([], SCHEMA)).collect() == []


def test_prefixes_share_a_key():
    """Linked sets have a key in common, whatever the tokens' classes."""
    rng = np.random.default_rng(2)
    for n in (9, 10, 15, 17, 64, 127, 128, 300, 1100):
        for _ in range(30):
            kind = rng.integers(1, 4, 1 << 16).astype(np.int8)
            pool = np.sort(rng.choice(1 << 16, 2 * n, replace=False)).astype(np.uint64)
            base = rng.choice(pool, n, replace=False)
            other = np.delete(base, rng.choice(n, int(rng.integers(0, J._missing(n, 90) + 1)), replace=False))
            a, b = np.sort(base), np.sort(other)
            keys = np.concatenate([a, b])
            owner, key = J.prefix_keys(keys, np.array([0, len(a), len(a) + len(b)]), kind[keys.astype(np.int64)], 90)
            if len(b) < len(a) and 100 * len(b) >= 90 * len(a):
                assert set(key[owner == 0].tolist()) & set(key[owner == 1].tolist()), (n, len(b))


def test_bitmaps_rule_out_no_linked_pair():
    rng = np.random.default_rng(3)
    for n in (10, 60, 64, 65, 500, 3000):
        a = np.unique(rng.integers(0, 1 << 55, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[J._missing(len(a), 90):], rng.integers(0, 1 << 55, 0).astype(np.uint64)]))
        c = np.unique(rng.integers(0, 1 << 55, n).astype(np.uint64))
        maps = J.parities(np.concatenate([a, b, c]), np.cumsum([0, len(a), len(b), len(c)]))
        size = np.array([len(a), len(b), len(c)])
        assert J.near(size[:1], size[1:2], maps[:1], maps[1:2], 90)[0]
        assert n < 60 or not J.near(size[:1], size[2:], maps[:1], maps[2:], 90)[0]
