"""Byte-level BPE: texts to ids as the tokenizers library gives them, and ids back to texts.

Texts are cut where no token can reach across: before an ASCII white-space byte that follows
something other than white space. No branch of the pre-tokenizer's pattern joins the two, and it looks
only forward, so the pieces' ids put together are the text's ids. Repeated pieces are looked up;
new ones are put together, encoded in one call, and the ids are dealt back by the lengths of the
tokens.

A long piece has no such place (a run of letters, encoded data, text without spaces). It is encoded as
a tree: the halves of halves are encoded in parallel, and around each join a growing window is encoded
again until it agrees with both sides: it must begin and end with the same tokens as they. A sequence
is the BPE encoding exactly when every pair of neighbours is, and each pair then lies inside
one of the three encodings.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, StringType, StructField, StructType

from recordlake.llm.frames import map_arrow, position
from recordlake.llm.textkit import Texts, mix, span_hashes, texts_of

#: Bytes of a piece from which it is encoded as a tree, and bytes of the tree's leaves.
LONG = 2048
LEAF = 1024
#: Bytes a window holds at least on each side of a join, and tokens that must agree on each side.
WINDOW = 48
AGREE = 2
#: Pieces up to this length are remembered, up to so many pieces and ids in a worker.
REMEMBER = 64
MOST = 300_000
#: Bytes of new pieces put together in one call of the library.
TOGETHER = 1 << 16

#: Fixed value: the pattern that the byte-level pre-tokenizer splits by.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: First bytes of characters other than ASCII and the letters from U+00C0 to U+017F.
_OTHER = re.compile(rb"[\xc2\xc6-\xff]")

_ASCII_SPACE = np.zeros(256, dtype=bool)
_ASCII_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Last bytes of white-space characters beyond ASCII, after C2 and after E1 to E3.
_AFTER_C2 = np.isin(np.arange(256), [0x85, 0xA0])
_LAST_OF_3 = np.isin(np.arange(256), [*range(0x80, 0x8B), 0x9F, 0xA8, 0xA9, 0xAF])


def pieces(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets that cut all texts into pieces, and for each text the number of pieces before it."""
    data, at = texts.data, texts.at
    if not len(data):
        return np.zeros(1, dtype=np.int64), np.zeros(len(at), dtype=np.int64)
    space = _ASCII_SPACE[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[1:-1] = space[1:] & ~space[:-1]
    where = np.flatnonzero(cut)
    wide = where[data[where - 1] >= 0x80]
    two = wide[wide >= 2]
    cut[two[(data[two - 2] == 0xC2) & _AFTER_C2[data[two - 1]]]] = False
    three = wide[wide >= 3]
    lead = data[three - 3]
    cut[three[(lead >= 0xE1) & (lead <= 0xE3) & (data[three - 2] >= 0x80) & _LAST_OF_3[data[three - 1]]]] = False
    cut[at] = True
    offsets = np.flatnonzero(cut)
    return offsets, np.searchsorted(offsets, at)


def _char_edge(raw: bytes, p: int) -> int:
    while 0 < p < len(raw) and (raw[p] & 0xC0) == 0x80:
        p -= 1
    return p


def gather(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """values[start[i]:start[i] + length[i]] for all i, one after the other."""
    total = int(length.sum())
    if not total:
        return values[:0]
    shift = start - np.concatenate([[0], np.cumsum(length)[:-1]])
    return values[np.repeat(shift, length) + np.arange(total)]


class Codec:
    """Encodes and decodes with one tokenizer file; one per worker process."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # the byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        to_byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        added = self.tokenizer.get_added_tokens_decoder()
        raw = []
        for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True)):
            token = self.tokenizer.id_to_token(i) or ""
            raw.append(token.encode() if i in added else bytes(to_byte[c] for c in token))
        self.token_bytes = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.token_length = np.array([len(x) for x in raw], dtype=np.int64)
        self.token_start = np.concatenate([[0], np.cumsum(self.token_length)[:-1]])
        self.special = [t.content.encode() for t in added.values()]
        self.quick = self._ranked(raw, added)
        self.reach = max([WINDOW, *(2 * len(x) for x in self.special)])
        self._forget()

    def _ranked(self, raw: list[bytes], added: dict):
        """A quicker encoder with the same result, or None.

        Where every merge makes the next higher id, ids are ranks, and tiktoken merges in the same order. It is used
        for text without special strings and with none but Latin letters beyond ASCII, where the two
        libraries' tables of letters can't differ.
        """
        model = json.loads(self.tokenizer.to_str())
        split = model["pre_tokenizer"] or {}
        made = [self.tokenizer.token_to_id("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in model["model"]["merges"]]
        plain = {x: i for i, x in enumerate(raw) if i not in added}
        if (split.get("type") != "ByteLevel" or not split.get("use_regex") or split.get("add_prefix_space") or model["normalizer"]
                or made != sorted(set(made)) or made[0] < 256 or len(plain) != 256 + len(made)):
            return None
        import tiktoken

        return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=plain, special_tokens={})

    def together(self, raw: bytes) -> np.ndarray:
        """The ids of some pieces put in one text."""
        if self.quick is not None and not any(x in raw for x in self.special) and not _OTHER.search(raw):
            return np.array(self.quick.encode_ordinary(raw.decode()), dtype=np.int32)
        return np.array(self.plain(raw.decode()), dtype=np.int32)

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, dtype=np.int32)
        self.start = np.zeros(MOST + 1, dtype=np.int64)
        self.used = 0

    def plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def tree(self, raw: bytes) -> np.ndarray:
        """The ids of one long text, from the leaves of a binary tree."""
        cuts = [0, len(raw)]
        while max(b - a for a, b in zip(cuts, cuts[1:])) > LEAF:
            halves = [x for a, b in zip(cuts, cuts[1:]) for x in (a, _char_edge(raw, (a + b) // 2) if b - a > LEAF else a)]
            cuts = sorted({*halves, len(raw)})
        leaves = [raw[a:b].decode() for a, b in zip(cuts, cuts[1:])]
        parts = [np.array(e.ids, dtype=np.int32) for e in self.tokenizer.encode_batch(leaves, add_special_tokens=False)]
        while len(parts) > 1:
            joined = [self.join(a, b) for a, b in zip(parts[::2], parts[1::2])]
            parts = joined + parts[len(parts) - len(parts) % 2:]
        return parts[0]

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ids of two neighbouring texts put together, from the ids of each."""
        l_len, r_len = self.token_length[left], self.token_length[right]
        reach = self.reach
        while True:
            i = max(0, len(left) - int(np.searchsorted(np.cumsum(l_len[::-1]), reach) + 1))
            j = min(len(right), int(np.searchsorted(np.cumsum(r_len), reach)) + 1)
            while i > 0 and self._inside(left[i]):
                i -= 1
            while j < len(right) and self._inside(right[j]):
                j += 1
            window = self.decode_bytes(np.concatenate([left[i:], right[:j]])).decode()
            now = np.array(self.plain(window), dtype=np.int32)
            if ((i == 0 or np.array_equal(now[:AGREE], left[i:i + AGREE]))
                    and (j == len(right) or np.array_equal(now[-AGREE:], right[j - AGREE:j]))):
                return np.concatenate([left[:i], now, right[j:]])
            reach *= 2

    def _inside(self, token: int) -> bool:
        """Whether a token begins inside a character."""
        return (int(self.token_bytes[self.token_start[token]]) & 0xC0) == 0x80

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the offsets of each text's ids."""
        offsets, before = pieces(texts)
        start, end = offsets[:-1], offsets[1:]
        if not len(start):
            return np.zeros(0, dtype=np.int32), np.zeros(len(texts) + 1, dtype=np.int64)
        data, size = texts.data, end - start
        if len(self.known) + len(start) > MOST:
            self._forget()
        keys = span_hashes(data, start, end) ^ mix(size.astype(np.uint64))
        unique, first, which = np.unique(keys, return_index=True, return_inverse=True)
        slot = np.array([self.known.get(k, -1) for k in unique.tolist()], dtype=np.int64)
        # new pieces: those that begin with white space and don't end with it can be put in one text
        new = np.flatnonzero(slot < 0)
        at = first[new]
        last = data[end[at] - 1]
        loose = ((size[at] <= LONG) & _ASCII_SPACE[data[start[at]]]
                 & ((last > 0x20) & (last < 0x7F) | ~np.isin(end[at], texts.at)))  # a cut inside a text follows no white space
        together = at[loose]
        slices = np.split(together, np.flatnonzero(np.diff(np.cumsum(size[together]) // TOGETHER)) + 1)
        got = np.concatenate([self.together(gather(data, start[s], size[s]).tobytes()) for s in slices])
        edges = np.searchsorted(np.cumsum(self.token_length[got]), np.cumsum(size[together])) + 1
        parts, lengths = [got], np.zeros(len(new), dtype=np.int64)
        lengths[loose] = np.diff(np.concatenate([[0], edges]))
        rest = np.flatnonzero(~loose)
        raws = [data[start[p]:end[p]].tobytes() for p in at[rest]]
        short = [r.decode() for r in raws if len(r) <= LONG]
        quick = iter([e.ids for e in self.tokenizer.encode_batch(short, add_special_tokens=False)] if short else [])
        for r, raw in zip(rest, raws):
            ids = self.tree(raw) if len(raw) > LONG else np.array(next(quick), dtype=np.int32)
            parts.append(ids)
            lengths[r] = len(ids)
        order = np.concatenate([np.flatnonzero(loose), rest])
        flat, n = np.concatenate(parts), lengths[order]
        begin = np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64)
        # where each distinct piece's ids are: what was known, then what is new
        u_start, u_len = np.zeros(len(unique), dtype=np.int64), np.zeros(len(unique), dtype=np.int64)
        old = slot >= 0
        u_start[old] = self.start[slot[old]]
        u_len[old] = self.start[slot[old] + 1] - u_start[old]
        u_start[new[order]], u_len[new[order]] = begin + self.used, n
        pool = np.concatenate([self.ids[:self.used], flat]) if self.used else flat
        out = gather(pool, u_start[which], u_len[which])
        done = np.concatenate([[0], np.cumsum(u_len[which])])
        self._remember(unique[new[order]], size[at[order]], flat, begin, n)
        return out, done[before]

    def _remember(self, keys, size, flat, begin, n) -> None:
        keep = np.flatnonzero(size <= REMEMBER)
        ids, n = gather(flat, begin[keep], n[keep]), n[keep]
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[:self.used], np.zeros(self.used + len(ids), dtype=np.int32)])
        self.ids[self.used:self.used + len(ids)] = ids
        k = len(self.known)
        self.start[k + 1:k + 1 + len(n)] = self.used + np.cumsum(n)
        self.used += len(ids)
        self.known.update(zip(keys[keep].tolist(), range(k, k + len(n))))

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return gather(self.token_bytes, self.token_start[ids], self.token_length[ids]).tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids; bytes that are no UTF-8 become replacement characters."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _appended(df: DataFrame, column: str, name: str, make: Callable[[pa.Array], Iterator[pa.Array]], kind: DataType) -> DataFrame:
    source = F.col(f"`{column}`")
    if name.lower() == column.lower():  # the column that is replaced is also the one that is read
        source, df = F.col("__source"), df.withColumn("__source", source)
        column = "__source"
    out = df.drop(name)
    at_column = position(out, column)
    work = out.toDF(*(f"c{i}" for i in range(len(out.columns))))
    schema = StructType([*work.schema.fields, StructField("made", kind)])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at = 0
        for made in make(batch.column(at_column)):
            own = batch.slice(at, len(made))
            at += len(made)
            yield pa.RecordBatch.from_arrays([*own.columns, made], schema.names)
    return map_arrow(work, run, schema).toDF(*out.columns, name).drop("__source")


def encode(df: DataFrame, path: str, text: str = "text", to: str = "ids") -> DataFrame:
    """``df`` with the ids of each whole text as little-endian unsigned 32-bit integers in ``to``.

    Ids are those of the tokenizers library without added special tokens, truncation or padding; special
    strings inside a text become their ids. Null and empty texts have no ids (empty binary). Every
    row and column stays; an input column called ``to`` is replaced.
    """
    def make(column: pa.Array) -> Iterator[pa.Array]:
        for texts in texts_of(column):
            ids, at = codec(path).encode(texts)
            yield pa.Array.from_buffers(pa.binary(), len(texts), [
                None, pa.py_buffer((at * 4).astype(np.int32).tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())])
    return _appended(df, text, to, make, BinaryType())


def decode(df: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``df`` with the text of the ids in ``ids`` (as encode() gives them) in ``to``; null gives ''."""
    def make(column: pa.Array) -> Iterator[pa.Array]:
        own = codec(path)
        for lo in range(0, len(column), 256):
            yield pa.array([own.decode(np.frombuffer(x or b"", dtype="<u4")) for x in column.slice(lo, 256).to_pylist()], pa.string())
    return _appended(df, ids, to, make, StringType())


def token_digests(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row, from its ids and the text decoded from them.

    What encode(), decode() and two digests give, made in one step, so that ids and texts stay in the task.
    """
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for t in texts_of(batch.column(1)):
            ids, at = own.encode(t)
            each = [ids[a:b] for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(t.first, len(t)), pa.array(np.diff(at)),
                                              pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in each]),
                                              pa.array([hashlib.sha256(own.decode(x).encode()).hexdigest() for x in each])],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    named = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return map_arrow(named, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
