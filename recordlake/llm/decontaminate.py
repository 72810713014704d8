"""Benchmark items inside documents: size-partitioned MinHash containment search, then exact shingles.

An item is in a document when ``100 * shared >= percent * size of the item's set`` for their sets of
``k``-word shingles (lower case A-Z; a text of fewer words is one shingle).

A short item in a long document has a tiny Jaccard similarity, which sketches of one size can't
see. So documents are partitioned by the size of their sets, and the sketch grows with the
partition: sets of up to 2**p shingles have ``4 * 2**p`` registers (one-permutation MinHash: the
leading bits of a shingle's hash choose the register, which keeps the smallest hash). A shared shingle is
then its register's minimum with a probability of about 0.9 on the document's side at any size, and an
item is a candidate if one of its registers agrees. An item has registers for each partition. An item
of at least ``TINY`` shingles with the wanted share in a document is missed with a probability
under 1e-8; smaller items are looked up by all their shingles, which misses nothing.

Items are sent to the tasks in blocks of bounded size, one pass over the documents for each block, so
documents are never shuffled and no table needs to be small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm.bpe import gather
from recordlake.llm.frames import map_arrow, position, settle
from recordlake.llm.textkit import shingle_sets, texts_of, words_of

TINY = 16
#: Shingles of the items sent out at once (8 bytes each; blocks are dealt by a hash of the item).
ITEMS = 1 << 20
BITS = 56


class Index:
    """Items with their sets, and the registers of the items for each partition by size."""

    def __init__(self, items: list[int], sets: list[np.ndarray]):
        self.items = np.array(items, dtype=np.int64)
        self.size = np.array([len(s) for s in sets], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.all = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
        owner = np.repeat(np.arange(len(items), dtype=np.int32), self.size)
        # hashes ascend in an item, so the hash before decides: from the partition on in which the two fall into different
        # registers, a hash is its register's minimum; the first hash always is, and tiny items are looked up by all hashes
        apart = np.zeros(len(self.all), dtype=np.uint64)
        apart[1:] = self.all[1:] ^ self.all[:-1]
        since = np.maximum(BITS - 2 - (np.frexp((apart >> np.uint64(8)).astype(np.float64))[1] + 7), 0).astype(np.int8)
        since[self.start[self.size > 0]] = 0
        since[self.size[owner] < TINY] = -1
        order = np.argsort(self.all, kind="stable")
        self.hashes, self.owner, self.since = self.all[order], owner[order], since[order]
        self.seen = np.zeros(1 << 20, dtype=bool)  # the hashes' leading 20 bits
        self.seen[(self.all >> np.uint64(BITS - 20)).astype(np.int64)] = True

    def candidates(self, doc: np.ndarray, h: np.ndarray, low: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, item) for each hash that a tiny item has, and for each register minimum of both sides."""
        maybe = np.flatnonzero(self.seen[(h >> np.uint64(BITS - 20)).astype(np.int64)])
        lo, hi = np.searchsorted(self.hashes, h[maybe], "left"), np.searchsorted(self.hashes, h[maybe], "right")
        n = hi - lo
        since, own = gather(self.since, lo, n), np.repeat(maybe, n)
        ok = (since < 0) | low[own] & (since <= part[doc[own]])
        return doc[own[ok]], gather(self.owner, lo, n)[ok]

    def search(self, keys: np.ndarray, at: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, item, shared shingles) for all sets that hold the wanted share of an item."""
        size = np.diff(at)
        doc = np.repeat(np.arange(len(size)), size)
        part = np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64)
        d, i = self.candidates(doc, keys, smallest(keys, doc, part), part)
        pairs = np.unique(d * len(self.items) + i)
        d, i = pairs // max(1, len(self.items)), pairs % max(1, len(self.items))
        # exact: every shingle of the item is looked for in the document's set
        owner = np.repeat(np.arange(len(d)), self.size[i])
        want = gather(self.all, self.start[i], self.size[i]) | (d[owner].astype(np.uint64) << np.uint64(BITS))
        have = keys | (doc.astype(np.uint64) << np.uint64(BITS))
        where = np.searchsorted(have, want)
        hit = np.zeros(len(want), dtype=bool)
        inside = where < len(have)
        hit[inside] = have[where[inside]] == want[inside]
        shared = np.bincount(owner[hit], minlength=len(d))
        ok = 100 * shared >= percent * self.size[i]
        return d[ok], i[ok], shared[ok]


def smallest(keys: np.ndarray, owner: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Which hashes are their register's minimum; hashes ascend in each set, part is each set's partition."""
    shift = (BITS - 2 - part[owner]).astype(np.uint64)
    register = keys >> shift
    first = np.ones(len(keys), dtype=bool)
    first[1:] = (owner[1:] != owner[:-1]) | (register[1:] != register[:-1])
    return first


def _item_sets(items: DataFrame, id: str, text: str, k: int) -> DataFrame:
    """(item_id, size, hashes) of the items that have words; rows that repeat an id and a text count once."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for t in texts_of(batch.column(1)):
            keys, at = shingle_sets(words_of(t, lower=True), k)
            ids = batch.column(0).slice(t.first, len(t))
            sets = [keys[a:b].tobytes() for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.diff(at)), pa.array(sets, pa.binary())], ["item_id", "size", "hashes"])
    named = items.select(F.col(f"`{id}`").cast("long").alias("item_id"), F.col(f"`{text}`").alias("text")).where("item_id is not null")
    return map_arrow(named, run, "item_id long, size long, hashes binary").where("size > 0").distinct()


def _indexes(items: DataFrame, id: str, text: str, k: int) -> Iterator[Index]:
    """The items in blocks of bounded size, one at a time on the driver."""
    sets = settle(_item_sets(items, id, text, k), "items")
    total = sets.agg(F.sum("size")).first()[0] or 0
    n = -(-total // ITEMS)
    for block in range(n):
        rows = sets.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == block).collect()
        if rows:
            yield Index([r.item_id for r in rows], [np.frombuffer(r.hashes, dtype=np.uint64) for r in rows])


def contaminated(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared) for each item that a document contains.

    ``n_shingles`` is the size of the item's set, ``n_shared`` how much of it the document has. Texts that
    are null, empty or without words have an empty set and are in no pair, as are items with a null id.
    Rows that repeat a document give equal rows; a null doc_id is returned as it is. Items that repeat
    an id and a text count once. Empty tables give none; other columns are not looked at.
    """
    named = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    spark, schema, out = docs.sparkSession, "doc_id long, item_id long, n_shingles long, n_shared long", None
    for index in _indexes(items, item_id, item_text, k):
        sent = spark.sparkContext.broadcast(index)

        def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            own = sent.value
            for t in texts_of(batch.column(1)):
                d, i, shared = own.search(*shingle_sets(words_of(t, lower=True), k), percent)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(d + t.first)), pa.array(own.items[i]),
                                                  pa.array(own.size[i]), pa.array(shared)], ["doc_id", "item_id", "n_shingles", "n_shared"])
        part = settle(map_arrow(named, run, schema), "contaminated")
        sent.unpersist()
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                      k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns, kept where they are read.

    Each block of items is one pass over what the blocks before it kept; between passes the rows are written, so that one block
    is broadcast at a time. Rows whose text is null, empty or without words stay, as do repeated rows and rows without an
    item; other columns, whatever their names, are returned as they are.
    """
    spark, at, names = docs.sparkSession, position(docs, text), docs.columns
    rows, last = docs.toDF(*(f"c{i}" for i in range(len(names)))), None
    for index in _indexes(items, item_id, item_text, k):
        if last is not None:
            rows = settle(rows, "uncontaminated")
            last.unpersist()
        sent = last = spark.sparkContext.broadcast(index)

        def run(batch: pa.RecordBatch, sent=sent) -> Iterator[pa.RecordBatch]:
            for t in texts_of(batch.column(at)):
                d, _, _ = sent.value.search(*shingle_sets(words_of(t, lower=True), k), percent)
                clean = np.ones(len(t), dtype=bool)
                clean[d] = False
                part = batch.slice(t.first, len(t))
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(clean)) for c in part.columns], batch.schema.names)
        rows = map_arrow(rows, run, rows.schema)
    return rows.toDF(*names)
