"""Periodic runs of words by block convolution, and texts with their repetitions collapsed.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), of at least
``max(LEAST, TIMES * q)`` words, that no neighbouring word extends. Steps, for many texts at once:

1. Scales b = 8, 16, 32, ...: the words of all texts that are long enough for the scale are cut into blocks of b.
   A run with b <= q < 2b (q < 2b for the least scale) holds a whole block that occurs again q words on.
2. Each block is convolved with the two blocks behind it by a number-theoretic transform of 2b points, over all
   blocks at once. Words enter as short integers, short enough for the sum of squared differences of
   a block to stay below the modulus, so the sum is exact, and zero only where block and window agree.
   The window's transform is made of those of its two blocks: the second one with signs changed at odd frequencies.
3. The distances of zero sums are seeds. Seeds of neighbouring blocks with one distance are one stretch;
   its ends lie within a block's length and are found by binary search on prefix hashes, then
   the words of each run are compared once more.
4. A stretch found with several distances has the least as its period: its other periods are multiples.

Everything is proportional to the words times the number of scales, also for texts of one repeated word, and runs in
numpy over whole batches of texts. No text leaves the task that reads it.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm.frames import map_arrow
from recordlake.llm.substrings import joined
from recordlake.llm.textkit import texts_of, words_of

LEAST = 24
TIMES = 3
#: The least scale. Runs of LEAST words and periods under 2 * SCALE hold a whole block and its repetition.
SCALE = 8
#: The modulus 3 * 2**30 + 1 has roots of unity for all powers of two up to 2**30; 5 generates its units.
MODULUS = 3 * 2**30 + 1
GENERATOR = 5
#: Numbers that are transformed at once.
AT_ONCE = 1 << 15

_P = np.uint64(MODULUS)
_32 = np.uint64(32)


def _less(x: np.ndarray) -> np.ndarray:
    """Numbers under twice the modulus, reduced (the difference wraps around where it is negative)."""
    return np.minimum(x, x - _P)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    done = 1
    while done < n:
        step = np.uint64(pow(base, done, MODULUS))
        more = min(done, n - done)
        out[done:done + more] = out[:more] * step % _P
        done += more
    return out


class Transform:
    """Number-theoretic transforms of ``size`` points along the first axis of (size, m) arrays, exact modulo MODULUS.

    Frequencies come in an order of their own, which :meth:`negative` and :meth:`joined_pair` know. With
    few columns the later stages run on the transposed array, so that numpy's inner loops stay long.
    """

    def __init__(self, size: int):
        self.size = size
        self.bits = size.bit_length() - 1
        self.rows = 1 << (self.bits // 2)
        self.cols = size // self.rows
        root = pow(GENERATOR, (MODULUS - 1) // size, MODULUS)
        self.forth, self.back = [], []
        half = size // 2
        while half:
            for kept, base in ((self.forth, root), (self.back, pow(root, MODULUS - 2, MODULUS))):
                w = _powers(pow(base, size // (2 * half), MODULUS), half)
                kept.append((w[:, None], ((w << _32) // _P)[:, None]))
            half //= 2
        j = np.arange(size)
        k = np.zeros(size, dtype=np.int64)
        for bit in range(self.bits):
            k |= ((j >> bit) & 1) << (self.bits - 1 - bit)
        place = np.empty(size, dtype=np.int64)
        place[k] = j
        self.negated = place[(-k) % size]

    @staticmethod
    def _times(x: np.ndarray, factor: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """x * w, reduced; the quotient comes from the factor's precomputed fraction and is one too small at most."""
        w, fraction = factor
        return _less(x * w - ((x * fraction) >> _32) * _P)

    def _stages(self, a: np.ndarray, first: int, last: int, back: bool) -> None:
        """Butterflies of the stages [first, last) in place; a has shape (points, m)."""
        m = a.shape[1]
        order = range(first, last)
        for s in reversed(order) if back else order:
            half = self.size >> (s + 1)
            part = a.reshape(-1, 2, half, m)
            u, v = part[:, 0], part[:, 1]
            if back:
                turned = self._times(v, self.back[s])
                part[:, 1] = _less(u + (_P - turned))
                part[:, 0] = _less(u + turned)
            else:
                less = self._times(_less(u + (_P - v)), self.forth[s])
                part[:, 0] = _less(u + v)
                part[:, 1] = less

    def _late(self, a: np.ndarray, back: bool) -> np.ndarray:
        """The stages whose butterflies span less than a row, on the transposed array."""
        m = a.shape[1]
        flip = np.ascontiguousarray(a.reshape(self.rows, self.cols, m).transpose(1, 0, 2))
        first = self.rows.bit_length() - 1
        self._stages(flip.reshape(self.cols, self.rows * m), first, self.bits, back)
        return np.ascontiguousarray(flip.transpose(1, 0, 2)).reshape(self.size, m)

    def forward(self, a: np.ndarray) -> np.ndarray:
        a = np.array(a, dtype=np.uint64, order="C")
        if a.shape[1] >= 64:
            self._stages(a, 0, self.bits, False)
            return a
        self._stages(a, 0, self.rows.bit_length() - 1, False)
        return self._late(a, False)

    def inverse(self, a: np.ndarray) -> np.ndarray:
        """Times ``size``: the last factor is left to the caller."""
        a = np.array(a, dtype=np.uint64, order="C")
        if a.shape[1] >= 64:
            self._stages(a, 0, self.bits, True)
            return a
        a = self._late(a, True)
        self._stages(a, 0, self.rows.bit_length() - 1, True)
        return a

    def negative(self, f: np.ndarray) -> np.ndarray:
        """The transform of the points in reverse order (about point 0)."""
        return f[self.negated]

    def joined_pair(self, f: np.ndarray, g: np.ndarray) -> np.ndarray:
        """Of two transforms of half-empty arrays that of the first half of one, then the first half of the other."""
        half = self.size // 2
        out = np.empty_like(f)
        out[:half] = _less(f[:half] + g[:half])
        out[half:] = _less(f[half:] + (_P - g[half:]))
        return out


_TRANSFORMS: dict[int, Transform] = {}


def _transform(size: int) -> Transform:
    if size not in _TRANSFORMS:
        if len(_TRANSFORMS) > 12 or size > 1 << 16:
            _TRANSFORMS.clear()
        _TRANSFORMS[size] = Transform(size)
    return _TRANSFORMS[size]


def short_values(h: np.ndarray, b: int) -> np.ndarray:
    """Words as integers so short that b squared differences add up to less than the modulus."""
    bits = (31 - (b.bit_length() - 1)) // 2
    return h >> np.uint64(64 - bits)


def seeds(h: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) where the aligned block of b words from start occurs again, distances b to 2b - 1.

    At the least scale distances from 1 on. Blocks of the last, padded part take part, too; the caller
    drops what leaves its text.
    """
    n_blocks = -(-len(h) // b)
    values = np.zeros((n_blocks + 2) * b, dtype=np.uint64)
    values[:len(h)] = short_values(h, b)
    squares = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * values, out=squares[1:])
    t = _transform(2 * b)
    step = max(1, AT_ONCE // (2 * b))
    near = range(2) if b == SCALE else range(1, 2)
    starts, distances = [], []
    for lo in range(0, n_blocks, step):
        m = min(step, n_blocks - lo)
        points = np.zeros((2 * b, m + 2), dtype=np.uint64)
        points[:b] = values[lo * b:(lo + m + 2) * b].reshape(m + 2, b).T
        f = t.forward(points)
        turned = t.negative(f[:, :m])
        own = squares[(lo + 1) * b:(lo + m + 1) * b:b] - squares[lo * b:(lo + m) * b:b]
        for ahead in near:
            window = t.joined_pair(f[:, ahead:ahead + m], f[:, ahead + 1:ahead + 1 + m])
            product = t.inverse(turned * window % _P)[:b]  # times the number of points
            # sums of squares of the windows at distance ahead * b + j from each block
            at = (lo + ahead) * b + np.arange(b)[:, None] + np.arange(m)[None, :] * b
            total = own[None, :] + squares[at + b] - squares[at]
            zero = (total * np.uint64(2 * b) + np.uint64(2) * (_P - product)) % _P == 0
            if ahead == 0:
                zero[0] = False
            j, i = np.nonzero(zero)
            starts.append((lo + i) * b)
            distances.append(ahead * b + j)
    return np.concatenate(starts), np.concatenate(distances)


class _Equal:
    """Comparison of stretches of words by prefix hashes."""

    BASE = 0xD6E8FEB86659FD93 | 1

    def __init__(self, h: np.ndarray, reach: int):
        base = np.full(max(len(h), reach + 1) + 1, self.BASE, dtype=np.uint64)
        base[0] = 1
        self.power = np.multiply.accumulate(base)
        self.total = np.zeros(len(h) + 1, dtype=np.uint64)
        np.cumsum(h * self.power[:len(h)], out=self.total[1:])

    def same(self, at: np.ndarray, distance: np.ndarray, length: np.ndarray) -> np.ndarray:
        one = (self.total[at + length] - self.total[at]) * self.power[distance]
        return one == self.total[at + distance + length] - self.total[at + distance]

    def extent(self, at: np.ndarray, distance: np.ndarray, most: np.ndarray, forth: bool) -> np.ndarray:
        """How many words agree from ``at`` on (or before it), up to ``most``."""
        lo, hi = np.zeros(len(at), dtype=np.int64), most.copy()
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            ok = self.same(at if forth else at - mid, distance, mid)
            lo, hi = np.where(ok, mid, lo), np.where(ok, hi, mid - 1)
        return lo


def _stretches(h: np.ndarray, begin: np.ndarray, end: np.ndarray, b: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, distance) of the stretches of a scale that are long enough; texts are [begin, end) of h."""
    start, distance = seeds(h, b)
    owner = np.searchsorted(begin, start, side="right") - 1
    inside = start + distance + b <= end[owner]
    start, distance, owner = start[inside], distance[inside], owner[inside]
    if not len(start):
        return
    order = np.lexsort((start, distance))
    start, distance, owner = start[order], distance[order], owner[order]
    fresh = np.ones(len(start), dtype=bool)
    fresh[1:] = (distance[1:] != distance[:-1]) | (start[1:] != start[:-1] + b) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(start)) - 1
    lo, hi, d, own = start[first], start[last] + b, distance[first], owner[first]
    equal = _Equal(h, int(d.max()))
    left = equal.extent(lo, d, np.minimum(lo - begin[own], b), False)
    right = equal.extent(hi, d, np.minimum(end[own] - hi - d, b), True)
    l, r = lo - left, hi + right + d
    long = r - l >= np.maximum(LEAST, TIMES * d)
    l, r, d, lo, hi = l[long], r[long], d[long], lo[long], hi[long]
    order = np.lexsort((d, r, l))
    l, r, d, lo, hi = l[order], r[order], d[order], lo[order], hi[order]
    least = np.ones(len(l), dtype=bool)
    least[1:] = (l[1:] != l[:-1]) | (r[1:] != r[:-1])
    for x in zip(*(v[least].tolist() for v in (l, r, d, lo, hi))):
        yield from _exact(h, *x)


def _exact(h: np.ndarray, l: int, r: int, d: int, lo: int, hi: int) -> Iterator[tuple[int, int, int]]:
    """The stretch after a look at the words themselves; equal hashes of unlike stretches would shorten it."""
    wrong = np.flatnonzero(h[l:r - d] != h[l + d:r]) + l
    if len(wrong):
        if ((wrong >= lo) & (wrong < hi)).any():
            return
        l = int(wrong[wrong < lo].max(initial=l - 1)) + 1
        r = int(wrong[wrong >= hi].min(initial=r - d)) + d
        if r - l < max(LEAST, TIMES * d):
            return
    yield l, r, d


def runs_of(h: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, by text, start and period; text i has the word hashes h[before[i]:before[i + 1]]."""
    count = np.diff(before)
    found: dict[tuple[int, int], int] = {}
    b = SCALE
    while True:
        some = np.flatnonzero(count >= max(LEAST, TIMES * b if b > SCALE else LEAST))
        if not len(some):
            break
        size = count[some]
        end = np.cumsum(size)
        begin = end - size
        where = np.repeat(before[some] - begin, size) + np.arange(int(end[-1]))
        for l, r, d in _stretches(h[where], begin, end, b):
            # periods are looked for in ascending order, so the first one of a stretch is its least
            key = (int(where[l]), int(where[r - 1]) + 1)
            found[key] = min(d, found.get(key, d))
        b *= 2
    rows = sorted((l, d, r) for (l, r), d in found.items())
    l, d, r = (np.array([x[i] for x in rows], dtype=np.int64) for i in range(3))
    text = np.searchsorted(before, l, side="right") - 1
    return text, l - before[text], r - l, d


def _best(length: np.ndarray, period: np.ndarray) -> int:
    """The first run with the greatest exact length / period; runs are in order of start and period."""
    ratio = length / period
    near = np.flatnonzero(ratio >= ratio.max() * (1 - 1e-12)).tolist()
    return max(near, key=lambda i: (Fraction(int(length[i]), int(period[i])), -i))


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = ("doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
          "best struct<start:long,length:long,period:long>, collapsed string")


def periodic_runs(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, runs, best, collapsed.

    ``runs`` holds (start, length, period) of all runs, by start, then period; ``best`` is the one with the greatest length
    / period (ties: smallest start, then period), null without runs. ``collapsed`` is the words that no
    run contains after its first ``period`` words, joined by one space. Words are runs of bytes other
    than white space, numbered from 0 and compared as they are (by hashes of 64 bits). Null, empty and blank texts have no words, no runs
    and an empty ``collapsed``. Repeated rows and rows with a null id are rows like others, other columns
    are not looked at, and an empty table gives none.
    """
    named = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for t in texts_of(batch.column(1)):
            w = words_of(t)
            owner, start, length, period = runs_of(w.hash, w.before)
            at = np.searchsorted(owner, np.arange(len(t) + 1))
            edge = np.zeros(len(w.hash) + 1, dtype=np.int64)
            np.add.at(edge, w.before[owner] + start + period, 1)
            np.add.at(edge, w.before[owner] + start + length, -1)
            keep = np.cumsum(edge[:-1]) == 0
            # a run ends before its text does, so the sums never reach into the next text
            every = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], fields=list(_RUN))
            best = [int(a) + _best(length[a:b], period[a:b]) if a < b else None for a, b in zip(at.tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(t.first, len(t)), pa.array(w.counts().astype(np.int64)),
                 pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), every), every.take(pa.array(best, pa.int64())),
                 pa.array([x.decode() for x in joined(t, w, keep)], pa.string())],
                ["doc_id", "n_words", "runs", "best", "collapsed"])
    return map_arrow(named, run, SCHEMA)


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which documents with crc32(doc_id) % 10 = 0 end in a repetition of their own words.

    With g = crc32 // 10 and n words, each word i >= a becomes word a + (i - a) % p, where a = g % n and
    p = 1 + (n - a) // (3 + g % 8). Other texts, and texts without words, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    n = F.size("w").cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    some = (rows.where(chosen).select("doc_id", "text", words.alias("w"), g.alias("g"))
            .withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)).cast("long")))
    changed = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(
        F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    some = some.select("doc_id", F.when(n > 0, F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))
    return rows.where(~chosen).unionByName(some)


def run_digests(docs: DataFrame) -> DataFrame:
    """The runs of ``docs`` with periodic tails: doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256."""
    found = periodic_runs(with_periodic_tails(docs))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
                        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
                        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
                        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
