"""Token ids of whole documents in wavelet-matrix files, one file per shard.

A shard holds a range of doc_ids in ascending order. Its one file is a sequence of blocks of bounded
size; a block is a row with the doc_ids, the lengths, and a wavelet matrix of all its ids:

    magic 'WVM1', n, levels, zeros per level, sizes of the parts (little-endian), then for each
    level a bit-plane and its rank directory, each a Zstandard frame

Level l holds bit (levels - 1 - l) of every id, in the order that the levels above leave: zeros first,
then ones, each in order. The rank directory counts the ones before every 512 bits, so access,
counting and select step down (or up) the levels with one directory entry and a few words each.

Files are written by Spark's own writer (a container it commits by task), so they lie in whatever
store the session can write, and a lost executor leaves no half-written shard.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordlake.llm import bpe
from recordlake.llm.frames import map_arrow, settle
from recordlake.llm.textkit import texts_of

#: Ids from which a block ends; one document is never cut.
BLOCK = 1 << 18
STRIDE = 512
MAGIC = b"WVM1"
END_ID = 0


def _pack(bits: np.ndarray) -> tuple[bytes, bytes]:
    raw = np.packbits(bits)
    words = np.zeros(-(-len(bits) // STRIDE) * STRIDE // 8, dtype=np.uint8)
    words[:len(raw)] = raw
    ones = np.bitwise_count(words.reshape(-1, STRIDE // 8)).sum(axis=1, dtype=np.uint32)
    rank = np.concatenate([[0], np.cumsum(ones)]).astype("<u4")
    return words.tobytes(), rank.tobytes()


class WaveletMatrix:
    """A compressed sequence of non-negative integers with access, rank and select."""

    def __init__(self, raw: bytes):
        if raw[:4] != MAGIC:
            raise ValueError("not a wavelet matrix")
        self.n, self.levels = struct.unpack_from("<QB", raw, 4)
        at = 13
        self.zeros = struct.unpack_from(f"<{self.levels}Q", raw, at)
        at += 8 * self.levels
        sizes = struct.unpack_from(f"<{2 * self.levels}I", raw, at)
        at += 8 * self.levels
        self._parts = []
        for size in sizes:
            self._parts.append(raw[at:at + size])
            at += size
        self._open: dict[int, np.ndarray] = {}

    @staticmethod
    def build(values: np.ndarray) -> bytes:
        values = np.asarray(values)
        top = int(values.max()) if len(values) else 0
        if len(values) and int(values.min()) < 0:
            raise ValueError("negative value")
        levels = max(1, top.bit_length())
        seq = values.astype(np.uint16 if levels <= 16 else np.uint64)
        squeeze = zstandard.ZstdCompressor(level=1)
        zeros, parts = [], []
        for level in range(levels):
            bits = (seq >> seq.dtype.type(levels - 1 - level)) & seq.dtype.type(1) != 0
            plane, rank = _pack(bits)
            parts += [squeeze.compress(plane), squeeze.compress(rank)]
            low = seq[~bits]
            zeros.append(len(low))
            seq = np.concatenate([low, seq[bits]])
        return b"".join([MAGIC, struct.pack("<QB", len(values), levels), struct.pack(f"<{levels}Q", *zeros),
                         struct.pack(f"<{2 * levels}I", *map(len, parts)), *parts])

    def _part(self, i: int) -> np.ndarray:
        if i not in self._open:
            raw = zstandard.ZstdDecompressor().decompress(self._parts[i])
            self._open[i] = np.frombuffer(raw, dtype="<u4" if i % 2 else np.uint8)
        return self._open[i]

    def _ones(self, level: int, i: int) -> int:
        """Ones before position i of a level."""
        block, at = divmod(i, STRIDE)
        plane = self._part(2 * level)[block * STRIDE // 8:block * STRIDE // 8 + (at + 7) // 8]
        n = int(self._part(2 * level + 1)[block])
        if at:
            n += int(np.bitwise_count(plane[:at // 8]).sum())
            if at % 8:
                n += int(plane[at // 8] >> (8 - at % 8)).bit_count()
        return n

    def _bit(self, level: int, i: int) -> int:
        return int(self._part(2 * level)[i // 8] >> (7 - i % 8)) & 1

    def access(self, i: int) -> int:
        """The value at position i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(self.levels):
            bit, ones = self._bit(level, i), self._ones(level, i)
            value = 2 * value + bit
            i = self.zeros[level] + ones if bit else i - ones
        return value

    def _range(self, value: int, lo: int, hi: int) -> tuple[int, int]:
        if value < 0 or value >> self.levels:
            return 0, 0
        for level in range(self.levels):
            a, b = self._ones(level, lo), self._ones(level, hi)
            if value >> (self.levels - 1 - level) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, value: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of a value in [lo, hi)."""
        hi = self.n if hi is None else min(hi, self.n)
        if lo >= hi:
            return 0
        lo, hi = self._range(value, lo, hi)
        return hi - lo

    def select(self, value: int, k: int) -> int:
        """The position of occurrence k (from 0) of a value."""
        lo, hi = self._range(value, 0, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        at = lo + k
        for level in reversed(range(self.levels)):
            one = value >> (self.levels - 1 - level) & 1
            want = at - self.zeros[level] if one else at  # the number of such bits before the one looked for
            rank = self._part(2 * level + 1).astype(np.int64)
            before = rank if one else np.arange(len(rank)) * STRIDE - rank
            block = int(np.searchsorted(before, want, side="right")) - 1
            plane = self._part(2 * level)[block * STRIDE // 8:(block + 1) * STRIDE // 8]
            bits = np.unpackbits(plane)
            at = block * STRIDE + int(np.flatnonzero(bits == one)[want - int(before[block])])
        return at

    def positions(self, value: int) -> list[int]:
        return [self.select(value, k) for k in range(self.count(value))]

    def values(self) -> np.ndarray:
        """The whole sequence, level by level from the last."""
        kind = np.uint16 if self.levels <= 16 else np.uint64
        seq = np.zeros(self.n, dtype=kind)
        for level in reversed(range(self.levels)):
            bits = np.unpackbits(self._part(2 * level), count=self.n).view(bool)
            above = np.empty(self.n, dtype=kind)
            above[~bits] = seq[:self.zeros[level]]
            above[bits] = seq[self.zeros[level]:] | kind(1 << (self.levels - 1 - level))
            seq = above
        return seq


SCHEMA = "shard int, block int, n long, doc_ids binary, no_id binary, lengths binary, matrix binary"


def write_ids(docs: DataFrame, path: str, tokenizer: str, id: str = "doc_id", text: str = "text") -> None:
    """Encodes every whole text, appends id 0 to each document, and writes the shards' files to ``path``.

    Shards follow each other in ascending id order, and documents lie in that order in a shard: null
    ids first, rows with equal ids by their texts. Null and empty texts are the end id alone. No
    rows give a folder without blocks. Other columns are not looked at.
    """
    named = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    dealt = named.repartitionByRange("doc_id").sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            key = pa.concat_arrays([h[0] for h in held])
            lengths = np.concatenate([h[1] for h in held]).astype("<i8")
            ids = np.concatenate([h[2] for h in held])
            row = [shard, block, len(ids), np.asarray(key.fill_null(0)).astype("<i8").tobytes(),
                   np.packbits(np.asarray(key.is_null())).tobytes(), lengths.tobytes(), WaveletMatrix.build(ids)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)],
                                              [f.split()[0] for f in SCHEMA.split(", ")])

        for batch in batches:
            for t in texts_of(batch.column(1)):
                ids, at = bpe.codec(tokenizer).encode(t)
                with_end = np.insert(ids, at[1:], END_ID)
                held.append((batch.column(0).slice(t.first, len(t)), np.diff(at) + 1, with_end))
                size += len(with_end)
                if size >= BLOCK:
                    yield flush()
                    held.clear()
                    size, block = 0, block + 1
        if held:
            yield flush()

    dealt.mapInArrow(each, SCHEMA).write.parquet(path)


def blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of all shards with ``first``, the number of ids before each block.

    Offsets come from sums by shard and then inside each shard; neither holds more than
    a few integers for each shard or block.
    """
    rows = spark.read.schema(SCHEMA).parquet(path)
    shards = rows.groupBy("shard").agg(F.sum("n").alias("all"))
    before = shards.select("shard", (F.sum("all").over(Window.orderBy("shard")) - F.col("all")).alias("ahead"))
    inside = Window.partitionBy("shard").orderBy("block")
    at = rows.select("shard", "block", (F.sum("n").over(inside) - F.col("n")).alias("inner")).join(before, "shard")
    # written first, so that its size is known: a small table is broadcast, and no block is shuffled
    at = settle(at.select("shard", "block", (F.col("inner") + F.col("ahead")).alias("first")), "offsets")
    return rows.join(at, ["shard", "block"])


def _documents(row: dict) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The ids of a block's documents, their lengths, and where each begins in the block."""
    lengths = np.frombuffer(row["lengths"], dtype="<i8")
    none = np.unpackbits(np.frombuffer(row["no_id"], dtype=np.uint8), count=len(lengths)).view(bool)
    return pa.array(np.frombuffer(row["doc_ids"], dtype="<i8"), mask=none), lengths, np.cumsum(lengths) - lengths


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids (little-endian unsigned 32-bit integers)."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            key, lengths, at = _documents(row)
            raw = WaveletMatrix(row["matrix"]).values().astype("<u4").tobytes()
            for lo in range(0, len(lengths), 256):
                part = slice(lo, lo + 256)
                ids = [raw[4 * a:4 * (a + n)] for a, n in zip(at[part].tolist(), lengths[part].tolist())]
                yield pa.RecordBatch.from_arrays([key[part], pa.array(at[part] + row["first"]), pa.array(lengths[part]), pa.array(ids, pa.binary())],
                                                 ["doc_id", "start", "n_tokens", "ids"])
    return map_arrow(blocks(spark, path), run, "doc_id long, start long, n_tokens long, ids binary")


def find_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """Every occurrence of a token: doc_id and position in the document, by select on each block."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            key, _, at = _documents(row)
            where = np.array(WaveletMatrix(row["matrix"]).positions(token), dtype=np.int64)
            doc = np.searchsorted(at, where, side="right") - 1
            yield pa.RecordBatch.from_arrays([key.take(pa.array(doc)), pa.array(where - at[doc])], ["doc_id", "position"])
    return map_arrow(spark.read.parquet(path), run, "doc_id long, position long")


def count_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """Occurrences of a token in each block, by rank alone: shard, block, count."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = [WaveletMatrix(m).count(token) for m in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], ["shard", "block", "count"])
    return map_arrow(spark.read.parquet(path).select("shard", "block", "matrix"), run, "shard int, block int, count long")


def id_checksums(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files."""
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
