"""Aggregations (A1-A5). Only combinable aggregates, so hot groups are pre-aggregated
map-side before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from recordlake.functions.scalars import is_blank, ratio


def daily_mean(df: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    """Mean of ``value`` per ``key`` (A1): null keys dropped, null values ignored, an
    all-null group gives null; result is double."""
    return (df.where(F.col(key).isNotNull())
            .groupBy(key).agg(F.avg(F.col(value).cast("double")).alias(out or value)))


def distinct_codes(df: DataFrame, code: str) -> DataFrame:
    """Distinct codes (A2); a null code is one value."""
    return df.select(code).distinct()


def observe_count(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled by the action that writes ``df`` (A3).

    The count is taken in the same pass as the write: no second evaluation.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def missing_report(df: DataFrame, col: str) -> DataFrame:
    """Null count of ``col``, row count and their ratio (A4); empty input gives a null ratio."""
    return df.agg(
        F.count_if(F.col(col).isNull()).alias("missing"),
        F.count(F.lit(1)).alias("total"),
    ).withColumn("missing_ratio", ratio(F.col("missing"), F.col("total")))


def resolution_report(lookups: DataFrame, name_col: str) -> DataFrame:
    """Looked-up codes that stayed unresolved (blank name) and those resolved (A5)."""
    return lookups.agg(
        F.count(F.lit(1)).alias("looked_up"),
        F.count_if(is_blank(F.col(name_col))).alias("unresolved"),
        F.count_if(~is_blank(F.col(name_col))).alias("resolved"),
    )
