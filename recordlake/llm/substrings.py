"""Removal of passages of ``WINDOW`` words that also begin in a document with a smaller id.

Fixed-block anchors: a document is a sequence of blocks of ``BLOCK`` words from its start on. Any passage of
``WINDOW >= 2 * BLOCK - 1`` words holds a whole block of the earlier document, so the later one has that
block as one of its rolling windows of ``BLOCK`` words. Steps:

1. Documents with equal word sequences are one: all but the smallest id lose all their words.
2. Every rolling window of the others is looked up among the blocks. Windows are dealt to partitions by their
   minimizer, the smallest hash of the ``SEED``-word runs inside: equal windows have the same one, and neighbouring windows
   mostly do, so a passage of a document goes to a few partitions, however many there are. Windows meet by hash; a task first
   meets its own windows, so a passage in a third of all documents costs each task one entry. What
   crosses the network is packed: 5 bytes of hash, a small step in position, and the document
   once for all its windows of a partition.
3. Hits are extended to all windows of ``WINDOW`` words around them. The smallest document of each such
   window is found the same way, with whole 64-bit hashes; the others' windows are repeats. Overlapping
   ones are the maximal exact repeats, and their words go.

No step pairs documents: costs follow the words, however often a passage is repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm.bpe import gather
from recordlake.llm.frames import Bitmap, bitmap_filter, map_arrow, map_groups, settle
from recordlake.llm.textkit import Texts, Words, mix, runs, texts_of, whole_runs, words_of

WINDOW = 50
BLOCK = 25
#: Words of the runs whose hashes choose a window's partition.
SEED = 8
#: Windows that a task gathers before it deals them out, and windows of a partition (on average).
GATHER = 1 << 19
PARTITION = 1 << 20

_DEALT = "p int, kind int, rows binary, ids binary, counts binary, pos binary, hash binary, flags binary"
_NAMES = [f.split()[0] for f in _DEALT.split(", ")]
_TYPES = [pa.int32(), pa.int32(), *[pa.binary()] * 6]
ANCHOR, MANY = 1, 2


def joined(texts: Texts, words: Words, keep: np.ndarray | None = None) -> Iterator[bytes]:
    """The (kept) words of each text joined by one space, as bytes."""
    data = np.append(texts.data, np.uint8(0x20))
    start, end, owner = words.start, words.end, words.text
    if keep is not None:
        start, end, owner = start[keep], end[keep], owner[keep]
    # the byte after a word becomes a space; the last word of a text is copied without it
    last = np.ones(len(start), dtype=bool)
    last[:-1] = owner[1:] != owner[:-1]
    data[end[~last]] = 0x20
    length = end - start + ~last
    flat = gather(data, start, length)
    at = np.concatenate([[0], np.cumsum(length)])[np.searchsorted(owner, np.arange(len(texts) + 1))]
    for a, b in zip(at.tolist(), at[1:].tolist()):
        yield flat[a:b].tobytes()


def _meta(keyed: DataFrame) -> DataFrame:
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for t in texts_of(batch.column(2)):
            w = words_of(t)
            sha = [hashlib.sha256(x).hexdigest() for x in joined(t, w)]
            part = batch.slice(t.first, len(t))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(w.counts()), pa.array(sha)],
                                             ["row", "doc_id", "n_words", "sha"])
    return map_arrow(keyed.select("row", "doc_id", "text"), run, "row long, doc_id long, n_words long, sha string")


def _steps(pos: np.ndarray, owner: np.ndarray) -> bytes:
    """Positions as steps from the one before of the same document, 2 bytes each if they fit, with a mark."""
    step = pos.astype(np.int64)
    step[1:] -= np.where(owner[1:] == owner[:-1], pos[:-1], 0)
    wide = len(step) and step.max() > 0xFFFF
    return (b"4" if wide else b"2") + step.astype("<u4" if wide else "<u2").tobytes()


def _positions(raw: bytes, counts: np.ndarray) -> np.ndarray:
    step = np.frombuffer(raw, dtype="<u4" if raw[:1] == b"4" else "<u2", offset=1).astype(np.int64)
    total = np.cumsum(step)
    begin = np.cumsum(counts) - counts
    before = np.where(begin > 0, total[begin - 1], 0)
    return total - np.repeat(before, counts)


def _dealt(kind: int, p: np.ndarray, row: np.ndarray, doc: np.ndarray, pos: np.ndarray, h: np.ndarray | None,
           flags: np.ndarray | None, width: int) -> Iterator[pa.RecordBatch]:
    """Packed rows, one for each partition; row and doc belong to the entries."""
    if not len(p):
        return
    order = np.lexsort((pos, row, p))
    p, row, doc, pos = p[order], row[order], doc[order], pos[order]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(p)) + 1, [len(p)]])
    out: list[list] = [[] for _ in _NAMES]
    for lo, hi in zip(cuts.tolist(), cuts[1:].tolist()):
        own = slice(lo, hi)
        first = lo + np.concatenate([[0], np.flatnonzero(np.diff(row[own])) + 1])
        counts = np.diff(np.append(first, hi))
        packed = b"" if h is None else h[order[own]].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
        values = (int(p[lo]), kind, row[first].astype("<i8").tobytes(), doc[first].astype("<i8").tobytes() if width == 8 else b"",
                  counts.astype("<u4").tobytes(), _steps(pos[own], row[own]), packed,
                  b"" if flags is None else flags[order[own]].astype(np.uint8).tobytes())
        for column, v in zip(out, values):
            column.append(v)
    if out[0]:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, _TYPES)], _NAMES)


def minimizers(words: Words, size: int) -> np.ndarray:
    """For the window of ``size`` words from each word on the smallest hash of the runs in it, mixed; garbage beyond the text."""
    least, width, most = runs(words, SEED), 1, size - SEED + 1
    while width < most:  # minima of twice as many runs each time; the last step overlaps
        step = min(width, most - width)
        longer = least.copy()
        if step < len(least):
            np.minimum(least[:-step], least[step:], out=longer[:-step])
        least, width = longer, width + step
    return mix(least)


class _Gathered:
    """Windows of many documents: hash, partition, document and position; documents have a row key and an id."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.size = 0

    def add(self, h, p, row, doc, pos) -> None:
        self.parts.append((h, p, row, doc, pos))
        self.size += len(h)

    def sorted(self):
        h, p, row, doc, pos = (np.concatenate([x[i] for x in self.parts]) for i in range(5))
        self.parts, self.size = [], 0
        order = np.lexsort((pos, row, h))
        h, p, row, doc, pos = h[order], p[order], row[order], doc[order], pos[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, dtype=np.int64)
        return h, p, row, doc, pos, first, np.diff(np.append(first, len(h)))


def _slot(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> np.uint64(40)) % np.uint64(n)).astype(np.int32)


def _anchor_windows(main: DataFrame, n: int, without: Bitmap | None = None) -> DataFrame:
    """All rolling windows of BLOCK words, dealt to n partitions, of the rows that ``without`` doesn't mark.

    Of a window that several documents of the task share, one entry goes out, and all its occurrences
    go along as hits (kind 1).
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Gathered()

        def flush() -> Iterator[pa.RecordBatch]:
            h, p, row, doc, pos, first, size = held.sorted()
            if not len(h):
                return
            many = row[first] != row[first + size - 1]
            shared = np.repeat(many, size)
            anchor = pos % BLOCK == 0
            any_anchor = np.logical_or.reduceat(anchor, first)
            yield from _dealt(1, _slot(mix(row[shared].view(np.uint64)), n), row[shared], doc[shared], pos[shared], None, None, 5)
            lone = np.flatnonzero(~shared)
            some = np.concatenate([lone, first[many]])
            flags = np.concatenate([anchor[lone] * ANCHOR, any_anchor[many] * ANCHOR + MANY])
            yield from _dealt(0, p[some], row[some], doc[some], pos[some], h[some], flags, 5)

        for batch in batches:
            if without is not None:
                batch = batch.filter(pa.array(~without.hits(batch.column(2))))
            rows = np.asarray(batch.column(0))
            for t in texts_of(batch.column(1)):
                w = words_of(t)
                at = whole_runs(w, BLOCK)
                at = at[w.counts()[w.text[at]] >= WINDOW]
                row = rows[t.first:t.first + len(t)][w.text[at]]
                held.add(runs(w, BLOCK)[at], _slot(minimizers(w, BLOCK)[at], n), row, row, (at - w.before[w.text[at]]).astype(np.int32))
                if held.size >= GATHER:
                    yield from flush()
        if held.size:
            yield from flush()
    return main.select("row", "text", Bitmap.slot("row").alias("bit")).mapInArrow(each, _DEALT)


def _unpack(rows: pa.Table, width: int):
    """(hash, row, doc, pos, flags) of the packed entries of a partition."""
    parts = []
    for r in rows.to_pylist():
        counts = np.frombuffer(r["counts"], dtype="<u4").astype(np.int64)
        raw = np.frombuffer(r["hash"], dtype=np.uint8).reshape(-1, width)
        h = np.zeros((len(raw), 8), dtype=np.uint8)
        h[:, :width] = raw
        doc = np.frombuffer(r["ids"] or r["rows"], dtype="<i8")
        parts.append((h.reshape(-1).view("<u8"), np.repeat(np.frombuffer(r["rows"], dtype="<i8"), counts), np.repeat(doc, counts),
                      _positions(r["pos"], counts), np.frombuffer(r["flags"], dtype=np.uint8)))
    return [np.concatenate([p[i] for p in parts]) for i in range(5)]


def _found(row: np.ndarray, pos: np.ndarray) -> pa.RecordBatch | None:
    """(row, pos): the positions of each document as one binary."""
    if not len(row):
        return None
    order = np.lexsort((pos, row))
    row, pos = row[order], pos[order].astype("<i4")
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    at = (np.append(first, len(row)) * 4).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(row[first]), pa.Array.from_buffers(
        pa.binary(), len(first), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(pos.tobytes())])], ["row", "pos"])


def _passed_on(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Row and position of the entries that are decided already (kind 1)."""
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for r in rows.filter(pc.equal(rows["kind"], 1)).to_pylist():
        counts = np.frombuffer(r["counts"], dtype="<u4").astype(np.int64)
        out.append((np.repeat(np.frombuffer(r["rows"], dtype="<i8"), counts), _positions(r["pos"], counts)))
    return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])


def _hits(rows: pa.Table) -> pa.RecordBatch | None:
    """Of a partition's windows those that two documents have, one of them as a block."""
    row, pos = _passed_on(rows)
    asked = rows.filter(pc.equal(rows["kind"], 0))
    if asked.num_rows:
        h, r, _, at, flags = _unpack(asked, 5)
        order = np.lexsort((r, h))
        h, r, at, flags = h[order], r[order], at[order], flags[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        size = np.diff(np.append(first, len(h)))
        all_flags = np.bitwise_or.reduceat(flags, first)
        hit = (all_flags & ANCHOR > 0) & ((r[first] != r[first + size - 1]) | (all_flags & MANY > 0))
        use = np.repeat(hit, size) & (flags & MANY == 0)
        row, pos = np.concatenate([row, r[use]]), np.concatenate([pos, at[use]])
    return _found(row, pos)


def _spread(start: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n words lie in [s, s + width) for some s."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, np.clip(start, 0, n), 1)
    np.add.at(edge, np.clip(start + width, 0, n), -1)
    return np.cumsum(edge[:-1]) > 0


def _per_word(texts: Texts, words: Words, lists: list[list[bytes]], back: int, width: int) -> np.ndarray:
    """Which words lie in [s - back, s - back + width) of their text for a listed position s."""
    start = [np.frombuffer(b"".join(x), dtype="<i4").astype(np.int64) - back for x in lists]
    out = [_spread(s, width, n) for s, n in zip(start, words.counts().tolist())]
    return np.concatenate(out) if out else np.zeros(0, dtype=bool)


def _long_windows(around: DataFrame, n: int) -> DataFrame:
    """The windows of WINDOW words around all hits, dealt to n partitions.

    Of a window that several documents of the task share only the smallest document's go out; the
    others are repeats already (kind 1).
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Gathered()

        def flush() -> Iterator[pa.RecordBatch]:
            h, p, row, doc, pos, first, size = held.sorted()
            if not len(h):
                return
            later = doc > np.repeat(np.minimum.reduceat(doc, first), size)
            yield from _dealt(1, _slot(mix(row[later].view(np.uint64)), n), row[later], doc[later], pos[later], None, None, 8)
            yield from _dealt(0, p[~later], row[~later], doc[~later], pos[~later], h[~later], None, 8)

        for batch in batches:
            rows, docs, lists = np.asarray(batch.column(0)), np.asarray(batch.column(1)), batch.column(3)
            for t in texts_of(batch.column(2)):
                w = words_of(t)
                # windows that hold the BLOCK words of a hit begin up to WINDOW - BLOCK words before it
                near = _per_word(t, w, lists.slice(t.first, len(t)).to_pylist(), WINDOW - BLOCK, WINDOW - BLOCK + 1)
                at = whole_runs(w, WINDOW)
                at = at[near[at]]
                own = slice(t.first, t.first + len(t))
                held.add(runs(w, WINDOW)[at], _slot(minimizers(w, WINDOW)[at], n), rows[own][w.text[at]], docs[own][w.text[at]],
                         (at - w.before[w.text[at]]).astype(np.int32))
                if held.size >= GATHER:
                    yield from flush()
        if held.size:
            yield from flush()
    return around.select("row", "doc_id", "text", "pos").mapInArrow(each, _DEALT)


def _repeats(rows: pa.Table) -> pa.RecordBatch | None:
    """Of a partition's windows those whose sequence a smaller document has."""
    row, pos = _passed_on(rows)
    asked = rows.filter(pc.equal(rows["kind"], 0))
    if asked.num_rows:
        h, r, doc, at, _ = _unpack(asked, 8)
        order = np.argsort(h, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(h[order]) != 0]))
        low = np.minimum.reduceat(doc[order], first)
        use = order[doc[order] > np.repeat(low, np.diff(np.append(first, len(h))))]
        row, pos = np.concatenate([row, r[use]]), np.concatenate([pos, at[use]])
    return _found(row, pos)


def _cut(around: DataFrame, text_too: bool) -> DataFrame:
    """(row, n_removed, kept_sha, kept) of documents with repeats at the listed starts."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for t in texts_of(batch.column(1)):
            w = words_of(t)
            gone = _per_word(t, w, batch.column(2).slice(t.first, len(t)).to_pylist(), 0, WINDOW)
            n = np.bincount(w.text[gone], minlength=len(t))
            kept = list(joined(t, w, ~gone))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(t.first, len(t)), pa.array(n), pa.array([hashlib.sha256(x).hexdigest() for x in kept]),
                                              pa.array([x.decode() if text_too else None for x in kept], pa.string())],
                                             ["row", "n_removed", "kept_sha", "kept"])
    return map_arrow(around.select("row", "text", "pos"), run, "row long, n_removed long, kept_sha string, kept string")


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", keep_text: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256 and, with ``keep_text``, kept_text.

    A word is removed if a window of WINDOW words that covers it also begins in a document with a smaller id;
    windows are judged on the input. ``kept_text`` is the kept words joined by one space, null where
    nothing was removed (the text itself is kept then). Null, empty and blank texts have no words. Texts
    under WINDOW words lose nothing. Rows with a null id lose nothing and remove nothing; rows that repeat
    an id don't remove from each other. Other columns are not looked at; an empty table gives none.
    """
    named = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    keyed = named.withColumn("row", F.xxhash64("doc_id", "text"))
    meta = settle(_meta(keyed), "words")
    long = meta.where((F.col("n_words") >= WINDOW) & F.col("doc_id").isNotNull())
    # written first: a join of two plain shuffles can be split where copies make a digest hot
    first = settle(long.groupBy("sha").agg(F.min("doc_id").alias("first_id")), "first")
    copies = settle(long.join(first, "sha").where("doc_id > first_id").select("row").distinct(), "copies")
    total = long.agg(F.sum("n_words")).first()[0] or 0
    n = max(1, -(-total // PARTITION))

    # copies stay out; a row that only shares their bit of the map is told apart by a join
    keyed, marks = keyed.where("doc_id is not null"), Bitmap(copies, "row")
    unsure = bitmap_filter(keyed, "row", marks, "row").join(copies, "row", "left_anti")
    windows = _anchor_windows(keyed, n, marks).unionByName(_anchor_windows(unsure, n))

    hits = settle(map_groups(windows, ["p"], _hits, "row long, pos binary"), "hits")
    with_hits = hits.select("row").distinct()
    texts = settle(bitmap_filter(keyed, "row", with_hits, "row").join(with_hits, "row").dropDuplicates(["row"]).select("row", "doc_id", "text"), "texts")
    around = texts.join(hits.groupBy("row").agg(F.collect_list("pos").alias("pos")), "row")
    gone = settle(map_groups(_long_windows(around, n), ["p"], _repeats, "row long, pos binary"), "repeats")
    cut = _cut(texts.join(gone.groupBy("row").agg(F.collect_list("pos").alias("pos")), "row"), keep_text)

    none = F.lit(hashlib.sha256(b"").hexdigest())
    copied = copies.withColumn("copy", F.lit(True))
    out = meta.join(copied, "row", "left").join(cut, "row", "left")
    out = out.select("doc_id", "n_words",
                     F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
                     F.when(F.col("copy"), none).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
                     F.when(F.col("copy"), F.lit("")).otherwise(F.col("kept")).alias("kept_text"))
    return out if keep_text else out.drop("kept_text")
