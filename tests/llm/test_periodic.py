import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from recordlake.llm import periodic as P
from recordlake.llm.textkit import mix

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(w):
    """(start, length, period) of all runs, by a look at every period and position."""
    out = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def found(docs):
    h = mix(np.array([x for d in docs for x in d], dtype=np.uint64))
    out = {i: [] for i in range(len(docs))}
    for t, *run in zip(*(x.tolist() for x in P.runs_of(h, np.cumsum([0, *map(len, docs)])))):
        out[t].append(tuple(run))
    return list(out.values())


def random_words(rng):
    n, kind = rng.randint(0, 400), rng.random()
    if kind < .2:
        return [rng.randint(0, 1) for _ in range(n)]
    if kind < .4:
        period = [rng.randint(0, 50) for _ in range(rng.randint(1, 70))]
        around = [rng.randint(0, 50) for _ in range(rng.randint(0, 30))]
        return around + (period * rng.randint(1, 9))[:n] + around
    if kind < .5:
        return [7] * n
    if kind < .6:  # the sequence whose prefix hashes modulo 2**64 agree where it doesn't
        return [bin(i).count("1") & 1 for i in range(n)]
    if kind < .8:
        return ([1] * rng.randint(0, 60) + [2]) * rng.randint(1, 8)
    return [rng.randint(0, 1000) for _ in range(n)]


def test_runs_of_many_texts_against_brute_force():
    rng = random.Random(4)
    docs = [random_words(rng) for _ in range(500)]
    assert found(docs) == [brute(d) for d in docs]


def test_long_periods_and_hashes_that_mislead():
    rng = random.Random(5)
    period = [rng.randint(0, 10**6) for _ in range(5000)]
    morse = [bin(i).count("1") & 1 for i in range(1 << 13)]
    assert found([period * 3 + period[:17], period * 2, [3] * 20000]) == [[(0, 15017, 5000)], [], [(0, 20000, 1)]]
    assert found([morse + [5] + morse]) == [[]]


def test_transform_multiplies_exactly():
    rng = np.random.default_rng(1)
    for size, m in ((16, 70), (16, 3), (256, 2), (1024, 1)):
        t = P.Transform(size)
        x = rng.integers(0, P.MODULUS, (size, m)).astype(np.uint64)
        back = t.inverse(t.forward(x))
        assert (back == (x.astype(object) * size % P.MODULUS).astype(np.uint64)).all()
        first, second = np.zeros_like(x), np.zeros_like(x)
        first[:size // 2], second[:size // 2] = x[:size // 2], x[size // 2:]
        assert (t.joined_pair(t.forward(first), t.forward(second)) == t.forward(x)).all()
        turned = np.roll(x[::-1], 1, axis=0)
        assert (t.negative(t.forward(x)) == t.forward(turned)).all()


def expected(i, text):
    w = words(text)
    h = zlib.crc32(str(i).encode())
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if j < a else w[a + (j - a) % p] for j, x in enumerate(w)]
    runs = brute(w)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else None
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *top, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(w, runs)))


def test_documents_with_periodic_tails(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars < 6000")
    got = {r.doc_id: (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
           for r in P.run_digests(docs).collect()}
    rows = {r.doc_id: r.text for r in docs.collect()}
    want = {i: expected(i, t) for i, t in rows.items()}
    assert got == want and sum(x[0] > 0 for x in want.values()) > 50


def test_edge_rows(spark):
    tail = "x " * 3000 + "y"
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a " * 23), (5, "a " * 24), (5, "a " * 24), (None, "b c " * 12 + "b"), (6, tail),
            (7, "ä é " * 20 + "ä")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS runs", "2 AS best", "3 AS n_words")
    by = sorted(((r.doc_id is None, r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.best and tuple(r.best), r.collapsed)
                 for r in P.periodic_runs(docs).collect()), key=str)
    assert by == sorted([
        (False, 1, 0, [], None, ""), (False, 2, 0, [], None, ""), (False, 3, 0, [], None, ""), (False, 4, 23, [], None, " ".join("a" * 23)),
        (False, 5, 24, [(0, 24, 1)], (0, 24, 1), "a"), (False, 5, 24, [(0, 24, 1)], (0, 24, 1), "a"),
        (True, 0, 25, [(0, 25, 2)], (0, 25, 2), "b c"), (False, 6, 3001, [(0, 3000, 1)], (0, 3000, 1), "x y"),
        (False, 7, 41, [(0, 41, 2)], (0, 41, 2), "ä é")], key=str)
    assert P.run_digests(spark.createDataFrame([], SCHEMA)).collect() == []


def test_best_run_is_chosen_by_exact_ratio(spark):
    one, two = ["a", "b", "c"], ["d", "e", "f", "g", "h", "i"]
    text = " ".join(one * 8 + ["x"] + two * 8 + ["y"] + one * 8)
    best = P.periodic_runs(spark.createDataFrame([(1, text)], SCHEMA)).first().best
    assert tuple(best) == (0, 24, 3)


@pytest.mark.parametrize("text", [None, "", " ", "a", "a b c"])
def test_tails_leave_words_in_place(spark, text):
    ids = [i for i in range(300) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    got = {r.doc_id: r.text for r in P.with_periodic_tails(spark.createDataFrame([(i, text) for i in (*ids, None)], SCHEMA)).collect()}
    assert got[None] == text and all(len(words(got[i])) == len(words(text)) for i in ids)
