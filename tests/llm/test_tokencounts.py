import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from recordlake.llm import tokencounts as C
from recordlake.session import scratch_path

MODEL = public_tokenizers.path("piece_bpe_32k.model")
JSON = public_tokenizers.path("byte_bpe_50k.json")
SP = sentencepiece.SentencePieceProcessor(model_file=MODEL)
LIB = Tokenizer.from_file(JSON)
SCHEMA = "doc_id long, text string"
ROWS = [(1, None), (2, ""), (3, "a  b\n"), (4, "<s> x </s> <unk> <|endoftext|>"), (5, "a  b\n"), (5, "a  b\n"), (5, "other"),
        (None, "日本語 🙂 \u0000"), (None, "x"), (6, "long word " * 5000)]


def want(rows, count, limit):
    return sorted(((i is None, i or 0, len((t or "").encode()), count(t or ""), count(t or "") > limit) for i, t in rows))


def got(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in df.collect())


@pytest.mark.parametrize("path, count", [(MODEL, lambda t: len(SP.encode(t))), (JSON, lambda t: len(LIB.encode(t, add_special_tokens=False).ids))])
def test_edge_rows(spark, path, count):
    df = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "'d' AS digest", "1 AS n", "2 AS row")
    cache = scratch_path(spark, "cache")
    assert got(C.count_tokens(df, path, cache, limit=100)) == want(ROWS, count, 100)
    assert got(C.count_tokens(df.limit(0), path, cache)) == []


def test_only_new_contents_are_encoded_and_appended(spark):
    cache = scratch_path(spark, "cache")
    first = [(i, f"text {i % 3}") for i in range(9)]
    then = [(i, f"text {i % 5}") for i in range(9)]
    C.count_tokens(spark.createDataFrame(first, SCHEMA), MODEL, cache).collect()
    assert C.read_cache(spark, cache).count() == 3
    # a stored count is used as it is
    df = spark.createDataFrame([(C.tokenizer_digest(MODEL), C.hashlib.sha256(b"text 4").hexdigest(), 77)], C.CACHE)
    df.write.mode("append").parquet(cache)
    out = {r.doc_id: r.n_tokens for r in C.count_tokens(spark.createDataFrame(then, SCHEMA), MODEL, cache).collect()}
    assert out == {i: 77 if i % 5 == 4 else len(SP.encode(t)) for i, t in then}
    assert C.read_cache(spark, cache).count() == 5
    # another tokenizer has counts of its own
    C.count_tokens(spark.createDataFrame(then, SCHEMA), JSON, cache).collect()
    assert C.read_cache(spark, cache).count() == 10


def test_documents_against_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(C.count_tokens(docs, MODEL, scratch_path(spark, "cache"))) == want(rows, lambda t: len(SP.encode(t)), 4096)
