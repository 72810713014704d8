"""Ordering and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_file(df: DataFrame, keys, file_col: str) -> DataFrame:
    """Earliest file (by name, i.e. by time) per key (O1): a combinable ``min``."""
    ks = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*ks).agg(F.min(file_col).alias(file_col))


def order_by_key(df: DataFrame, *keys) -> DataFrame:
    """Presentation order by key (O2); apply last, only where order is the output."""
    return df.orderBy(*keys)


def tail_rows(df: DataFrame, n: int, order_col: str) -> DataFrame:
    """Last ``n`` rows by ``order_col`` (O3): a top-k, planned as ``TakeOrderedAndProject``
    (each partition keeps its own top ``n`` before the merge)."""
    return df.orderBy(F.col(order_col).desc()).limit(n)


def union_resumed(resumed: DataFrame, new: DataFrame) -> DataFrame:
    """Results of an earlier run followed by new results (U1); columns aligned by name,
    a column missing on one side is null there."""
    return resumed.unionByName(new, allowMissingColumns=True)


def grow_registry(registry: DataFrame, resolved: DataFrame) -> DataFrame:
    """Registry plus newly resolved entries (U2), in-plan."""
    return registry.unionByName(resolved.select(*registry.columns))
