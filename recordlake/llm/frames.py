"""Spark helpers shared by the operators: tables, written cuts of lineage, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    It cuts the lineage where any executor can read it again, and gives Catalyst the size in bytes.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def position(df: DataFrame, name: str) -> int:
    """Where a column stands; names are matched as Spark matches them, exactly if one fits."""
    if name in df.columns:
        return df.columns.index(name)
    return [c.lower() for c in df.columns].index(name.lower())


def release() -> None:
    """Gives freed memory of Arrow back; a worker lives on and would hold it through later stages."""
    pa.default_memory_pool().release_unused()


def map_arrow(df: DataFrame, run: Callable[[pa.RecordBatch], pa.RecordBatch | None | Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with a function of one batch, which may give none, one or several."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = run(batch)
                if isinstance(out, pa.RecordBatch) or out is None:
                    out = [out] if out is not None else []
                yield from (x for x in out if x.num_rows)
                del batch, out
                release()
    return df.mapInArrow(each, schema)


def map_groups(df: DataFrame, keys: list[str], run: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``run`` once for each group of rows with equal ``keys``; a group must be of bounded size.

    Rows are dealt by the keys and sorted in their partition, and groups are cut from the stream
    of Arrow batches, so that many small groups cost little.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        last = None

        def done():
            out = run(pa.concat_tables(held).combine_chunks()) if held else None
            held.clear()
            return out

        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            change = np.zeros(t.num_rows, dtype=bool)
            for k in keys:
                v = np.asarray(batch.column(batch.schema.get_field_index(k)))
                change[1:] |= v[1:] != v[:-1]
            cuts = [0, *np.flatnonzero(change).tolist(), t.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                part = t.slice(lo, hi - lo)
                now = tuple(part[k][0].as_py() for k in keys)
                if now != last and (out := done()) is not None and out.num_rows:
                    yield out
                last = now
                held.append(part)
        if (out := done()) is not None and out.num_rows:
            yield out

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(each, schema)


#: Bits of the filter that bitmap_filter() sends to the executors (2 MB).
FILTER_BITS = 1 << 24


class Bitmap:
    """Which ids may be in a set: a bitmap of fixed size, whatever the number of ids.

    It only tells which rows surely aren't in the set; a join makes sure of the others. More ids let more
    rows pass. It keeps most texts out of the join's shuffle.
    """

    def __init__(self, ids: DataFrame, name: str):
        words = (ids.select(self.slot(name).alias("x")).groupBy(F.shiftright("x", 6).alias("w"))
                 .agg(F.bit_or(F.expr("shiftleft(1L, cast(x & 63 as int))")).alias("v")).toArrow())
        bits = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
        bits[np.asarray(words["w"], dtype=np.int64)] = np.asarray(words["v"]).view(np.uint64)
        self.sent = ids.sparkSession.sparkContext.broadcast(bits)

    @staticmethod
    def slot(name: str):
        """The bit of each row's id, as a column."""
        return F.pmod(F.xxhash64(F.col(name).cast("long")), F.lit(FILTER_BITS))

    def hits(self, slots: pa.Array) -> np.ndarray:
        """Which rows may be in the set, from their slots; for use in tasks."""
        x = np.asarray(slots).astype(np.uint64)
        return (self.sent.value[x >> np.uint64(6)] >> (x & np.uint64(63))) & np.uint64(1) == 1


def bitmap_filter(df: DataFrame, key: str, ids: DataFrame | Bitmap, name: str, keep: bool = True) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be in ``ids``; with ``keep=False`` those whose key surely isn't."""
    bits = ids if isinstance(ids, Bitmap) else Bitmap(ids, name)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hit = pa.array(bits.hits(batch.column(batch.num_columns - 1)) == keep)
        return pa.RecordBatch.from_arrays([c.filter(hit) for c in batch.columns[:-1]], batch.schema.names[:-1])
    return map_arrow(df.select("*", Bitmap.slot(key).alias("__bit")), run, df.schema)


def _stars(e: DataFrame) -> bool:
    """Whether distinct edges (a, b), b < a, are stars: each node is a leaf with one edge or a centre, the smallest of its star."""
    roles = e.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        e.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return roles.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of (a, b): one row (node, component) for each node with an edge.

    ``component`` is the smallest node of the component. Alternating large-star and small-star
    steps: every step is two pre-aggregated minima and a join, and the number of steps grows with the
    logarithm of the longest path; edges that are stars already cost none. Each step is written to the shared
    folder. Self-loops and nulls are ignored. No edges reach the driver.
    """
    e = settle(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .where("a <> b").distinct(), "edges")
    while not _stars(e):
        # large star: every larger neighbour of a node points to the smallest neighbour
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        large = settle(large, "large")
        # small star: smaller neighbours and the node itself point to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        e = settle(small, "small")
    return (e.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
