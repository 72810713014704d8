import zlib

import numpy as np
import pyarrow as pa

from recordlake.llm import toxicity as X
from recordlake.llm.textkit import texts_of

SF = "/root/testdata/sf0.1"


def one(texts):
    return next(texts_of(pa.array(texts)))


def test_windows_cover_every_word():
    before = np.concatenate([[0], np.cumsum([0, 1, 32, 33, 48, 49, 500])])
    text, first, size = X.windows(before)
    for i, n in enumerate(np.diff(before)):
        own = [(f - before[i], s) for t, f, s in zip(text, first, size) if t == i]
        assert sorted({w for f, s in own for w in range(f, f + s)}) == list(range(n))
        assert all(b[0] - a[0] == X.STEP for a, b in zip(own, own[1:]))


def test_gradients_against_differences():
    net = X.Network()
    rng = np.random.default_rng(0)
    net.words[:], net.grams[:] = (rng.normal(size=(X.BUCKETS, X.EMBED)) * 0.3 for _ in range(2))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    c = X.code(one([" ".join(f"w{i % 7}xyz" for i in range(40)), "ab c"]))
    _, first, size = X.windows(c.before)
    x, y = net.inputs(c).astype(np.float64), np.array([1.0, 0, 1])

    def loss(x):
        out = X._sigmoid(net.forward(x, c.word, first, size).astype(np.float64))
        return -(y * np.log(out) + (1 - y) * np.log(1 - out)).sum()
    keep = {}
    out = net.forward(x, c.word, first, size, keep)
    g, d_x = net.backward(x, size, keep, X._sigmoid(out) - y)
    for k in ("wf", "ub", "cb", "wa", "ba", "va", "wo", "bo"):
        i = tuple(0 for _ in net.p[k].shape)
        old = net.p[k][i]
        both = []
        for e in (1e-3, -1e-3):
            net.p[k][i] = old + e
            both.append(loss(x))
        net.p[k][i] = old
        assert abs((both[0] - both[1]) / 2e-3 - g[k][i]) < 2e-3 + 0.02 * abs(g[k][i]), k
    moved = x.copy()
    moved[1, 3] += 1e-3
    assert abs((loss(moved) - loss(x)) / 1e-3 - d_x[1, 3]) < 2e-3 + 0.02 * abs(d_x[1, 3])


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = X.scored(docs, labels).collect()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    test = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    hits = sum(t and p for t, p in test)
    assert hits >= 0.8 * sum(t for t, _ in test)
    assert hits >= 0.8 * sum(p for _, p in test)


def test_training_never_sees_held_out_labels(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    texts, y = X.labelled_sample(docs, labels)
    want = {f"text {i}": i % 2 for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2}
    assert dict(zip(texts, y.tolist())) == want


def test_long_texts_of_both_labels_are_trained_on(spark):
    docs = spark.createDataFrame([(i, f"{i} " + "word " * n) for i, n in enumerate([10, 10, 1000, 1000, 7000, 7000, 9000, 9000] * 10)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "1 AS quality", "cast(doc_id % 2 AS int) AS toxic")
    texts, y = X.labelled_sample(docs, labels)
    want = {r.text: r.doc_id % 2 for r in docs.collect() if len(r.text) <= X.LONG_CHARS and zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    assert dict(zip(texts, y.tolist())) == want and sum(v for t, v in want.items() if len(t) > X.MOST_CHARS) > 0


def test_edge_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (3, " \n", 0), (4, "you idiot", 1), (4, "you idiot", 1), (None, "x " * 5000, None), (5, "nice day", 0)] + [
        (10 + i, f"some plain words {i}" + " you idiot" * (i % 2), i % 2) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").selectExpr("*", "'s' AS score", "1 AS `a.b`", "2 AS made")
    labels = df.selectExpr("doc_id", "1 AS quality", "toxic")
    net = X.fit(df, labels)
    out = X.score(df, net)
    assert out.columns == ["doc_id", "text", "toxic", "a.b", "made", "score"]
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if not (r.text or "").strip()}) == 1
    assert all((r.score >= 0.3) == ("idiot" in (r.text or "")) for r in got)
    assert X.scored(df.limit(0), labels).collect() == []
    assert {r.predicted for r in X.scored(df, labels.limit(0)).collect()} == {0}
