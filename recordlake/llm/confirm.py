"""Pairs of documents confirmed on their full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm.frames import settle
from recordlake.llm.textkit import shingle_sets, texts_of, words_of

#: Partners of a document that are compared with it in one group (on average; dealt by hash).
PARTNERS = 256


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets pass 100 * intersection >= percent * union.

    ``texts`` has (node, text). Pairs are grouped by ``a``: its text travels once for each group and
    its set is made once, however many partners it has; a document with very many partners has several groups.
    A node with several texts is confirmed if one of them is. ``pairs`` is evaluated twice: pass a written table.
    """
    # both are written: the few documents with very many partners are joined by broadcast where they are small, or by a join
    # that can be split, and the pairs are dealt once for the two uses below
    many = settle(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > PARTNERS), "many")
    groups = F.coalesce(F.ceil(F.col("c") / PARTNERS), F.lit(1))
    dealt = settle(pairs.join(many, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), groups).cast("int").alias("s")), "dealt")
    centres = dealt.select("a", "s").distinct().join(texts.select(F.col("node").alias("a"), "text"), "a").select("a", "s", F.lit(None).cast("long").alias("b"), "text")
    others = dealt.join(texts.select(F.col("node").alias("b"), "text"), "b").select("a", "s", "b", "text")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, centre = None, []
        for batch in batches:
            left, salt, right = (batch.column(i).to_pylist() for i in range(3))
            found = []
            for t in texts_of(batch.column(3)):
                keys, ends = shingle_sets(words_of(t, lower=True), k)
                for i in range(len(t)):
                    row = t.first + i
                    own = keys[ends[i]:ends[i + 1]]
                    if (left[row], salt[row]) != at:
                        at, centre = (left[row], salt[row]), []
                    if right[row] is None:
                        centre.append(own.copy())
                    elif any(_linked(c, own, percent) for c in centre):
                        found.append((left[row], right[row]))
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
    rows = centres.unionByName(others).repartition("a", "s").sortWithinPartitions("a", "s", F.col("b").asc_nulls_first())
    return rows.mapInArrow(each, "a long, b long")


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two ascending sets pass; without elements they don't."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)) or not len(x):
        return False
    at = np.searchsorted(x, y)
    both = int((x[np.minimum(at, len(x) - 1)] == y).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)
