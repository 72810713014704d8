"""Scans (S1-S9): CSV drops, parquet batch files, captured pages."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.functions.scalars import batch_date_of, ends_with, file_segment

# Date layouts accepted for record dates, tried in this order.
RECORD_DATE_FORMATS = ["M/d/yyyy", "M/d/yyyy H:mm:ss", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss"]


def _is_missing_path(err: AnalysisException) -> bool:
    cond = getattr(err, "getCondition", None) or getattr(err, "getErrorClass", None)
    cls = cond() if cond else None
    return cls == "PATH_NOT_FOUND" or "PATH_NOT_FOUND" in str(err) or "Path does not exist" in str(err)


def _csv(spark: SparkSession, multi_line: bool):
    """Header CSV as spreadsheets write it: a quote in a quoted field is doubled.

    ``multi_line`` allows line feeds in quoted fields, and makes each file one task: on for the monthly
    record lists, whose descriptions are free text; off for bulk data without line feeds.
    """
    return spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line)


def _by_name(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` by their header names, wherever they stand in the file; what can't be read
    as its type, or isn't there, is null."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
                       for f in schema.fields])


def scan_csv_inferred(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False) -> DataFrame:
    """Header CSV (S1). With ``schema`` one pass and columns by name; without, types are inferred (a second pass)."""
    if schema is not None:
        return _by_name(scan_csv_strings(spark, path, multi_line), schema)
    return _csv(spark, multi_line).option("inferSchema", True).csv(path)


def scan_csv_strings(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Header CSV, every column text (S3)."""
    return _csv(spark, multi_line).csv(path)


def parse_dates(df: DataFrame, cols, formats=None) -> DataFrame:
    """Text -> zone-less timestamp by the first format that parses; bad text -> null."""
    fmts = formats or RECORD_DATE_FORMATS
    out = df
    for c in [cols] if isinstance(cols, str) else cols:
        parsed = F.coalesce(*[F.try_to_timestamp(F.col(c), F.lit(f)) for f in fmts])
        out = out.withColumn(c, parsed.cast("timestamp_ntz"))
    return out


def scan_csv_dates(spark: SparkSession, path: str, date_cols, formats=None, multi_line: bool = True) -> DataFrame:
    """Header CSV as text, then date columns parsed."""
    return parse_dates(scan_csv_strings(spark, path, multi_line), date_cols, formats)


def scan_optional(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """Read the columns of ``schema`` from ``path``, by name; a missing path gives an empty frame.

    Only a missing path is treated as "nothing yet": any other read error is raised.
    """
    try:
        # resolved at once, so a missing path surfaces here
        df = scan_csv_strings(spark, path, True) if fmt == "csv" else spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as err:
        if _is_missing_path(err):
            return spark.createDataFrame([], schema)
        raise
    return _by_name(df, schema)


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists (a metadata probe, not a read of the data)."""
    from recordlake.sources import fs

    return fs.exists(spark, path)


def scan_batch(spark: SparkSession, paths, schema: T.StructType | None = None,
               file_col: str = "batch_file") -> DataFrame:
    """One or more parquet batches in ONE scan (S5), with the batch name of each row."""
    ps = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.option("recursiveFileLookup", True)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(*ps)
    return df.withColumn(file_col, file_segment(F.col("_metadata.file_path")))


def select_batch_files(df: DataFrame, run_date: str, file_col: str = "batch_file") -> DataFrame:
    """Keep rows of batches named for ``run_date`` (S7, F3, F10), row by row.

    For a frame of batch names; to scan one day's batch files use ``scan_batches_for``,
    which applies the same rule to the file listing.
    """
    name = F.col(file_col)
    return df.where(ends_with(name) & (batch_date_of(name) == F.lit(run_date)))


def batch_glob(batch_dir: str, run_date: str) -> str:
    """Glob of the batch names of ``run_date``: ``batch_<date>_<time>.parquet``, also without
    the prefix or the time part (the names ``batch_date_of`` maps to ``run_date``)."""
    return f"{batch_dir.rstrip('/')}/{{batch_,}}{run_date}{{_*,}}.parquet"


def scan_batches_for(spark: SparkSession, batch_dir: str, run_date: str | None,
                     schema: T.StructType | None = None, file_col: str = "batch_file") -> DataFrame:
    """All batches under ``batch_dir``, or only those of ``run_date``.

    The run date is applied to the file listing (a glob), so batches of other days are
    never opened and no per-row predicate runs. No batch of that day gives an empty frame
    when ``schema`` is known.
    """
    if not run_date:
        return scan_batch(spark, batch_dir, schema, file_col)
    try:
        return scan_batch(spark, batch_glob(batch_dir, run_date), schema, file_col)
    except AnalysisException as err:
        if _is_missing_path(err) and schema is not None:
            return spark.createDataFrame([], schema).withColumn(file_col, F.lit(None).cast("string"))
        raise


def has_batches(spark: SparkSession, batch_dir: str, run_date: str) -> bool:
    """Whether any batch of ``run_date`` is there (one listing)."""
    from recordlake.sources import fs

    return bool(fs.glob(spark, batch_glob(batch_dir, run_date)))


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    """Captured pages ``(page_id, url, html)``."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def scan_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
