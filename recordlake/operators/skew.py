"""Skew handling shared by the join and aggregate operators.

Hot groups in record flows are mostly null keys (records that never got a key), and any
key, or any set of exact copies, may hold a large share of the rows. Three rules keep
such groups from landing whole on one task:

1. Aggregates are combinable only (``min``, ``max``, ``count``, ``max_by``, ``min_by``):
   Spark pre-aggregates every group map-side, so a hot key reaches the shuffle as one
   partial row per input partition.
2. Joins are plain equi-joins whose build side is pre-aggregated to one row per key
   (``distinct`` keys, per-key verdicts, deduped results). The row side of an oversized
   shuffle partition is split at run time by AQE's skew-join handling
   (``spark.sql.adaptive.skewJoin.*`` in ``recordlake.session``): the partition is cut into
   map-output ranges, each joined with a copy of the (small) matching build partition.
   That split works for null keys, hot keys and exact copies alike, and adds no column to
   the plan, so column pruning and filter pushdown to the scan stay intact (a salt column
   hashed from the row would force every column to be read; a random or partition-id salt
   would block filter pushdown).
3. No window is partitioned by a record key; positional numbering uses range partitions
   (``number_batches``).

``check_skew_settings`` verifies a session keeps rule 2 switched on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

REQUIRED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def check_skew_settings(spark: SparkSession) -> dict[str, str]:
    """Settings of ``REQUIRED`` that differ in this session (empty when all is well)."""
    bad = {}
    for k, v in REQUIRED.items():
        got = (spark.conf.get(k, None) or "").lower()
        if got != v:
            bad[k] = got
    return bad


def any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def null_safe_cond(left: str, right: str, keys: list[str]) -> Column:
    """``left.k <=> right.k`` for all keys (``left``/``right`` are DataFrame aliases)."""
    conds = [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    return reduce(lambda a, b: a & b, conds)
