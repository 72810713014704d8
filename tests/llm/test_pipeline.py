import collections

import duckdb
import numpy as np
import test_decontaminate
import test_setsketch
from tokenizers import Tokenizer

import corpus_pipeline as P
from recordlake.llm import queries, toxicity

SF = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    stages = dict(P.STAGES)
    assert list(stages) == ["toxicity", "line dedup", "near dedup", "decontamination", "bpe"]

    # toxicity: what scores under the threshold stays, unchanged
    net = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    low = {r.doc_id for r in toxicity.score(docs, net).collect() if r.score < toxicity.THRESHOLD}
    one = P.settle(stages["toxicity"](spark, docs, SF), "one")
    assert one.columns == list(P.COLUMNS)
    assert sorted(map(tuple, one.collect())) == sorted(tuple(r[c] for c in P.COLUMNS) for r in rows if r.doc_id in low)

    # line dedup: by SQL on what the first stage kept
    con = duckdb.connect()
    con.register("documents", one.toPandas())
    want = {r[0]: r[2] for r in con.execute(queries.LINES_SQL).fetchall()}
    two = P.settle(stages["line dedup"](spark, one, SF), "two")
    got = two.collect()
    assert two.columns == list(P.COLUMNS) and {r.doc_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)

    # near dedup: the smallest id of each component of all pairs
    comps = test_setsketch.brute([(r.doc_id, r.text) for r in got], 80)
    three = P.settle(stages["near dedup"](spark, two, SF), "three")
    kept = three.collect()
    assert three.columns == list(P.COLUMNS)
    assert sorted(map(tuple, kept)) == sorted(tuple(r) for r in got if comps[r.doc_id][1] == r.doc_id)
    assert len(kept) < len(got)

    # decontamination: no item is in what stays, and nothing else goes
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {w[0] for w in test_decontaminate.brute([(r.doc_id, r.text) for r in kept], items)}
    four = P.settle(stages["decontamination"](spark, three, SF), "four")
    assert bad and sorted(map(tuple, four.collect())) == sorted(tuple(r) for r in kept if r.doc_id not in bad)

    # bpe: the library's ids
    lib = Tokenizer.from_file(P.TOKENIZER)
    texts = {r.doc_id: r.text for r in four.collect()}
    last = stages["bpe"](spark, four, SF).collect()
    assert sorted(r.doc_id for r in last) == sorted(texts)
    for r in last:
        assert np.frombuffer(r.ids, "<u4").tolist() == lib.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(r.ids) // 4


def test_odd_rows_go_through(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, None, "en", None, None), (None, text, None, "s", 3), (None, text, None, "s", 3), (2, "", "en", "s", 0), (3, text, "en", "s", 9),
            (3, text, "en", "s", 9), (4, text + " tail", "en", "t", 9), (5, "long " * 3000, None, "s", 1), (6, " \n ", "en", "s", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, frame in (("documents", df), ("labels", df.selectExpr("doc_id", "1 AS quality", "0 AS toxic")),
                        ("benchmark", df.selectExpr("doc_id AS item_id", "'not in any text at all' AS text"))):
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
        frame.limit(0).write.parquet(f"{tmp_path}/none/{name}.parquet")
    got = collections.Counter(r.doc_id for r in P.run(spark, str(tmp_path)).collect())
    assert got == {1: 1, None: 2, 2: 1, 3: 1, 5: 1, 6: 1}
    assert P.run(spark, f"{tmp_path}/none").collect() == []


def test_copies_keep_their_text(spark):
    copied = " ".join(f"copied{i}" for i in range(40)) + "\n" + " ".join(f"tail{i}" for i in range(40))
    rows = [(i, copied, "en", "s", 0) for i in range(6)] + [(10 + i, "footer\n" + " ".join(f"w{i}x{j}" for j in range(40)), "en", "s", 0) for i in range(44)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(P.STAGES)
    lined = P.settle(stages["line dedup"](spark, docs, SF), "lined")
    kept = {r.doc_id: r.text for r in stages["near dedup"](spark, lined, SF).collect()}
    assert kept == {0: copied} | {r[0]: r[1].removeprefix("footer\n") for r in rows[6:]}


def test_texts_that_share_an_id_stay(spark):
    text = {k: " ".join(f"{k}{i}" for i in range(40)) for k in "abcd"}
    rows = [(1, text["a"], "en", "s", 1), (2, text["a"] + " tail", "en", "s", 1), (2, text["b"], "en", "s", 1), (3, text["c"], "en", "s", 1),
            (3, text["c"], "en", "s", 1), (3, text["c"], "de", "s", 1), (3, text["d"], "en", "s", 1), (3, text["d"] + " tail", "en", "s", 1),
            (None, text["b"], "en", "s", 1), (4, None, "en", "s", 1), (4, "", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for part in (docs.repartition(1), docs.repartition(5)):
        got = [tuple(r) for r in dict(P.STAGES)["near dedup"](spark, part, SF).select("doc_id", "text", "lang").collect()]
        assert sorted(x[0] or 0 for x in got) == [0, 1, 2, 3, 3, 4, 4]
        assert {(1, text["a"], "en"), (2, text["b"], "en"), (3, text["c"], "de"), (None, text["b"], "en"), (4, None, "en"), (4, "", "en")} < set(got)
        assert sum(str(x[1]).startswith(text["d"]) for x in got) == 1
