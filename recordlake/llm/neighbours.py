"""Exact nearest neighbours by inner product from int8 product tiles.

The queries are a stated set. They are taken in blocks of bounded size; a block is sent to all tasks,
which multiply it with tiles of candidates. Vectors are rounded to int8 with one scale each. A
tile of int8 products then gives every inner product up to an error that the rounding residuals
bound: |x.y - x'.y'| <= |x'| |y - y'| + |x - x'| |y|. The k-th largest lower bound of a query's tile,
or its k-th best so far, rules out all pairs whose upper bound is below it. Surviving pairs are
recomputed from the original components in double precision and pushed to the query's heap.
Nothing is approximate in the result: a pair is only left out when k others are surely better.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordlake.llm.frames import settle

#: Queries sent out at once (on average; blocks are dealt by a hash), and candidates of a tile.
QUERIES = 2048
TILE = 2048
#: Pairs recomputed at once.
PAIRS = 1 << 17


class Rounded:
    """Vectors as int8 with a scale each, and what bounds the rounding error of inner products."""

    def __init__(self, exact: np.ndarray):
        self.exact = exact
        scale = np.abs(exact).max(axis=1) / 127
        self.scale = scale
        self.small = np.rint(exact / scale[:, None]).astype(np.int8)
        back = self.small * scale[:, None]
        self.residual = np.sqrt(((exact - back) ** 2).sum(axis=1))
        self.length = np.sqrt((back ** 2).sum(axis=1))
        self.full = np.sqrt((exact ** 2).sum(axis=1))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products of int8 rows. Sums of 1024 products stay exact in single precision."""
    out = np.zeros((len(a), len(b)))
    for lo in range(0, a.shape[1], 1024):
        out += a[:, lo:lo + 1024].astype(np.float32) @ b[:, lo:lo + 1024].astype(np.float32).T
    return out


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed over the components in order."""
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


def tile(queries: Rounded, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int, heaps: list[list]) -> None:
    """Pushes to the queries' heaps what a tile of candidates may add; a heap holds (score, -id)."""
    # of equal vectors only the k + 1 smallest ids can be in any result (one may be the query's own)
    order = np.lexsort((ids, *rows.T[::-1]))
    rows, ids = rows[order], ids[order]
    fresh = np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])
    first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    few = np.arange(len(rows)) - first <= k
    rows, ids = rows[few], ids[few]
    other = Rounded(rows)
    near = products(queries.small, other.small) * queries.scale[:, None] * other.scale[None, :]
    error = (queries.length[:, None] * other.residual[None, :] + queries.residual[:, None] * other.full[None, :]) * (1 + 1e-9) + 1e-300
    least = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps])
    own = query_ids[:, None] == ids[None, :]
    if near.shape[1] > k:
        low = np.where(own, -np.inf, near - error)
        least = np.maximum(least, np.partition(low, -k, axis=1)[:, -k])
    slack = 1e-12 * (queries.full[:, None] * other.full[None, :])  # double precision sums
    q, c = np.nonzero((near + error + slack >= least[:, None]) & ~own)
    for lo in range(0, len(q), PAIRS):
        qs, cs = q[lo:lo + PAIRS], c[lo:lo + PAIRS]
        score = exact_products(queries.exact[qs], other.exact[cs])
        for i, s, v in zip(qs.tolist(), score.tolist(), ids[cs].tolist()):
            h = heaps[i]
            if len(h) < k:
                heapq.heappush(h, (s, -v))
            elif (s, -v) > h[0]:
                heapq.heapreplace(h, (s, -v))


def _vectors(column: pa.Array, d: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, d)


def usable(df: DataFrame, id: str, vec: str) -> DataFrame:
    """(id, v, d): rows with an id and a vector that takes part."""
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return (df.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{vec}`").cast("array<double>").alias("v"))
            .where("id is not null and v is not null").where(fine & F.exists("v", lambda x: x != 0))
            .withColumn("d", F.size("v")))


def nearest(df: DataFrame, k: int = 20, every: int = 20, id: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of each row whose id is divisible by ``every``.

    Nearness is the inner product in double precision, largest first, ties to the smaller id. Every
    row but those with the query's id is a candidate. Null ids and vectors that are null, empty, zero
    or hold null or non-finite components take no part; vectors of different lengths are not compared.
    A query id that several rows repeat is searched once, with the smallest of its vectors; as
    candidates they stay several. Fewer candidates than k give as many rows; none give none.
    """
    spark = df.sparkSession
    rows = usable(df, id, vec)
    queries = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v")).withColumn("d", F.size("v"))
    out = None
    # one count and one collect of bounded size for each dimension and block; the result is written block by block
    for d, n in sorted(queries.groupBy("d").count().collect()):
        n_blocks = -(-n // QUERIES)
        for block in range(n_blocks):
            mine = queries.where((F.col("d") == d) & (F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == block)).select("id", "v").toArrow()
            if not mine.num_rows:
                continue
            sent = spark.sparkContext.broadcast((np.asarray(mine["id"]), _vectors(mine["v"].combine_chunks(), d)))

            def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                query_ids, exact = sent.value
                own, heaps = Rounded(exact), [[] for _ in query_ids]
                for batch in batches:
                    ids, v = np.asarray(batch.column(0)), _vectors(batch.column(1), d)
                    for lo in range(0, len(ids), TILE):
                        tile(own, query_ids, v[lo:lo + TILE], ids[lo:lo + TILE], k, heaps)
                found = [(int(q), -v, s) for q, h in zip(query_ids, heaps) for s, v in h]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], ["query_id", "vec_id", "score"])

            part = rows.where(F.col("d") == d).select("id", "v").mapInArrow(search, "query_id long, vec_id long, score double")
            best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
            part = (part.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
                    .select("query_id", "rank", "vec_id", "score"))
            part = settle(part, "nearest")
            sent.unpersist()
            out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
