import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from recordlake.llm import bpe
from recordlake.llm.textkit import texts_of

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)
SF = "/root/testdata/sf0.01"


def ids_of(texts):
    out = []
    for t in texts_of(pa.array(texts, pa.string())):
        ids, at = bpe.codec(PATH).encode(t)
        out += [ids[a:b].tolist() for a, b in zip(at, at[1:])]
    return out


def lib(text):
    return LIB.encode(text or "", add_special_tokens=False).ids


HARD = ["", None, " ", "\n\n  a", "a  b", "a   b", "a   b", "é  　 x", "x<|endoftext|>  y", "a   <|endoftext|> b", "!!'second 'll",
        "don't  we'll\tgo\r\n", "日本語 テキスト。", "a\u0085 b", "\x1c \x1d", "trailing   ", "🙂🙂 🙂"]


def test_hard_texts():
    assert ids_of(HARD * 20) == [lib(t) for t in HARD] * 20


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aeé   \n\t'st19!<|>日🙂endoftxl"), max_size=60), max_size=6))
def test_any_text(texts):
    assert ids_of(texts) == [lib(t) for t in texts]


@pytest.mark.parametrize("alphabet", ["ab", "abcdefghijklmnopqrstuvwxyz", "!'sS1", "日本語漢字", "0123456789abcdef", "<|endoftext|>"])
def test_long_text_without_spaces_as_a_tree(monkeypatch, alphabet):
    monkeypatch.setattr(bpe, "LONG", 100)
    monkeypatch.setattr(bpe, "LEAF", 24)
    rng = random.Random(3)
    own = bpe.codec(PATH)
    for n in (101, 500, 3000):
        text = "".join(rng.choice([alphabet, *alphabet]) for _ in range(n))
        assert own.tree(text.encode()).tolist() == lib(text)
        assert ids_of([text, "x " + text + " y"]) == [lib(text), lib("x " + text + " y")]


def test_join_grows_its_window():
    own = bpe.codec(PATH)
    text = "a" * 5000 + "<|endoftext|>" + "b" * 5000
    for cut in (1, 17, 4999, 5003, 5012, 5013, 9000):
        a, b = (np.array(lib(x), dtype=np.int32) for x in (text[:cut], text[cut:]))
        assert own.join(a, b).tolist() == lib(text)


def test_documents_against_the_library(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in bpe.token_digests(docs, PATH).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        ids = lib(text)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(LIB.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_rows_and_columns_stay(spark):
    rows = [(1, t, "old", 7) for t in HARD] + [(None, "a b", None, 8)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, `x.y` int")
    back = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert [r["x.y"] for r in back] == [7] * len(HARD) + [8, 8]
    assert [r.decoded for r in back] == [t or "" for t in HARD] + ["a b"] * 2
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in back] == [lib(r.text) for r in back]
    assert bpe.encode(df.limit(0), PATH).collect() == []


def test_forgetting_keeps_results(monkeypatch):
    monkeypatch.setattr(bpe, "MOST", 50)
    own = bpe.Codec(PATH)
    for n in range(5):
        texts = [f"w{i} x{i * n} common words here" for i in range(4)]
        for t in texts_of(pa.array(texts)):
            ids, at = own.encode(t)
            assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [lib(x) for x in texts]
