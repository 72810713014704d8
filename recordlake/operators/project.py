"""Projections, filters and row numbering."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.functions.scalars import is_blank, to_millis


def project(df: DataFrame, cols) -> DataFrame:
    """Column subset (P1); Catalyst prunes the scan to these columns."""
    return df.select(*cols)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns, e.g. registry ``LicenseNo -> license_no``."""
    return df.withColumnsRenamed(mapping)


_UNNAMED = re.compile(r"^_c\d+$")


def drop_unnamed(df: DataFrame, strict: bool = False) -> DataFrame:
    """Drop the header-less columns a CSV scan names ``_cN``.

    ``strict`` raises when there is none, like dropping a named column that is absent.
    """
    unnamed = [c for c in df.columns if _UNNAMED.match(c)]
    if strict and not unnamed:
        raise ValueError("no unnamed column to drop")
    return df.drop(*unnamed)


def snake_case(name: str) -> str:
    """``Permit Number`` -> ``permit_number`` (canonical names after a scan)."""
    return re.sub(r"[^0-9a-zA-Z]+", "_", name.strip()).strip("_").lower()


def canonical_names(df: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """Rename every column to snake case, with explicit overrides first."""
    mapping = {}
    for c in df.columns:
        target = (overrides or {}).get(c, snake_case(c))
        if target != c:
            mapping[c] = target
    return df.withColumnsRenamed(mapping) if mapping else df


def storage_type(dt: T.DataType) -> T.DataType:
    """Type map of a written batch (P5): integers -> long, floats -> double, boolean,
    timestamps -> zone-less timestamp (ms), everything else -> string."""
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    if isinstance(dt, T.BooleanType):
        return T.BooleanType()
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return T.TimestampNTZType()
    return T.StringType()


def normalize_types(df: DataFrame) -> DataFrame:
    """Cast every column by ``storage_type``; timestamps are truncated to ms."""
    out = []
    for f in df.schema.fields:
        target = storage_type(f.dataType)
        col = F.col(f"`{f.name}`")
        if isinstance(target, T.TimestampNTZType):
            col = to_millis(col.cast(T.TimestampNTZType()))
        elif isinstance(target, T.StringType) and isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            col = F.to_json(col)
        elif target != f.dataType:
            col = col.cast(target)
        out.append(col.alias(f.name))
    return df.select(*out)


def keep_resolved(df: DataFrame, name_col: str, cols=None) -> DataFrame:
    """Rows with a non-blank name (P7), optionally projected."""
    kept = df.where(~is_blank(F.col(name_col)))
    return kept.select(*cols) if cols else kept


def search_records(df: DataFrame, date_col: str, start, end,
                   equals: dict[str, str] | None = None) -> DataFrame:
    """Records with ``start <= date <= end`` (whole days) and exact column values.

    ``start``/``end`` may be literals or Columns; with literals the bounds fold to
    constants and reach the parquet scan as pushed filters.
    """
    d = F.col(date_col)
    lo = F.lit(start) if not isinstance(start, Column) else start
    hi = F.lit(end) if not isinstance(end, Column) else end
    cond = (d >= lo.cast("timestamp_ntz")) & (d < F.date_add(hi.cast("date"), 1).cast("timestamp_ntz"))
    for c, v in (equals or {}).items():
        cond = cond & (F.col(c) == F.lit(v))
    return df.where(cond)


def is_error_page(url, marker: str = "Error.aspx") -> Column:
    """A look-up that landed on an error page."""
    u = F.col(url) if isinstance(url, str) else url
    return F.contains(u, F.lit(marker))


def number_batches(df: DataFrame, order_cols, size: int = 50, batch_col: str = "batch_id",
                   pos_col: str | None = None) -> DataFrame:
    """Number rows in ``order_cols`` order and cut them into batches of ``size`` (P10).

    No global window: the order columns alone are range-partitioned, sorted within partitions and
    checkpointed to the shared folder, so the two passes below see the same partitions; per-partition
    counts (one row per partition, a proven bound) give each partition its start offset. The other
    columns are neither checkpointed nor sorted: they meet the positions in one join on the order columns.

    With other columns, ``order_cols`` must order rows uniquely (one null is a value) and ``df`` must give the same
    order columns whenever it is evaluated; the run fails where a row's place isn't certain. A frame of nothing but
    order columns may repeat rows: they are numbered one after the other.
    """
    from recordlake.session import shared_dir

    shared_dir(df.sparkSession)  # checkpoint() needs the shared folder; set only when unset
    cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    ranged = df.select(*cols).repartitionByRange(*cols).sortWithinPartitions(*cols).checkpoint(eager=True)
    pid = F.spark_partition_id()
    local = ranged.select("*", pid.alias("_rl_pid"), F.monotonically_increasing_id().alias("_rl_mid"))
    counts = ranged.groupBy(pid.alias("_rl_pid")).agg(F.count(F.lit(1)).alias("_rl_n"))
    # one row per partition: a single-partition window over it is bounded by the partition count
    offsets = counts.select(
        "_rl_pid",
        F.coalesce(F.sum("_rl_n").over(Window.orderBy("_rl_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_rl_off"))
    place = F.col("_rl_off") + F.col("_rl_mid") - F.shiftleft(F.col("_rl_pid").cast("long"), 33)
    numbered = local.join(F.broadcast(offsets), "_rl_pid").withColumn("_rl_pos", place)
    if set(df.columns) <= set(cols):
        out, pos = numbered, F.col("_rl_pos")
    else:
        # a struct as key: null fields are equal, and the aggregate and the join share one shuffle
        key = F.struct(*cols)
        places = numbered.groupBy(key.alias("_rl_key")).agg(F.min("_rl_pos").alias("_rl_pos"), F.count(F.lit(1)).alias("_rl_n"))
        out = df.withColumn("_rl_key", key).join(places, "_rl_key", "left")
        unsure = F.raise_error(F.concat(F.lit("no certain place for the order columns "), F.to_json("_rl_key")))
        pos = F.when(F.col("_rl_n") == 1, F.col("_rl_pos")).otherwise(unsure)
    return out.select(*[F.col(f"`{c}`") for c in df.columns], F.floor(pos / F.lit(size)).cast("long").alias(batch_col),
                      *([pos.alias(pos_col)] if pos_col else []))
