"""Scalar column functions (``Column -> Column``), all JVM-side built-ins.

These are the small value transformations of the record flows: month ranges for the
search window, date formats used in batch names and search forms, batch-name parsing,
whitespace cleanup, ratios and millisecond truncation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# The three date layouts used by the record flow.
#   search form date   MM/dd/yyyy
#   batch stamp        yyyyMMdd_HHmmss
#   run date           yyyyMMdd
DATE_FORMATS = {
    "form": "MM/dd/yyyy",
    "stamp": "yyyyMMdd_HHmmss",
    "day": "yyyyMMdd",
}

# Batch file naming, prefix and suffix.
BATCH_PREFIX = "batch_"
BATCH_SUFFIX = ".parquet"

# White space removed by ``clean_text`` (Python ``str.strip`` set for ASCII plus no-break space).
_WS = r"[\s\x{00A0}]"


def _c(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def prev_month_start(d: ColumnLike) -> Column:
    """First day of the month before ``d`` (F1)."""
    return F.trunc(F.add_months(_c(d), -1), "MM")


def prev_month_end(d: ColumnLike) -> Column:
    """Last day of the month before ``d`` (F1)."""
    return F.last_day(F.add_months(_c(d), -1))


def previous_month_range(d: ColumnLike) -> tuple[Column, Column]:
    """(first day, last day) of the previous month (F1)."""
    return prev_month_start(d), prev_month_end(d)


def format_date(d: ColumnLike, style: str) -> Column:
    """Format with one of ``DATE_FORMATS`` (F2)."""
    return F.date_format(_c(d), DATE_FORMATS.get(style, style))


def batch_date_of(name: ColumnLike) -> Column:
    """Run date of a batch name: drop prefix and suffix, take the part before '_' (F3)."""
    stripped = F.replace(F.replace(_c(name), F.lit(BATCH_PREFIX), F.lit("")), F.lit(BATCH_SUFFIX), F.lit(""))
    return F.split_part(stripped, F.lit("_"), F.lit(1))


def batch_name(ts: ColumnLike) -> Column:
    """``batch_<yyyyMMdd_HHmmss>.parquet`` for a timestamp (name written by K1)."""
    return F.concat(F.lit(BATCH_PREFIX), format_date(ts, "stamp"), F.lit(BATCH_SUFFIX))


def clean_text(c: ColumnLike) -> Column:
    """Strip leading and trailing white space of any kind."""
    return F.regexp_replace(_c(c), rf"^{_WS}+|{_WS}+$", "")


def first_segment(c: ColumnLike, sep: str = "<br>") -> Column:
    """Text before the first ``sep``; the whole text when absent."""
    return F.split_part(_c(c), F.lit(sep), F.lit(1))


def as_text(c: ColumnLike) -> Column:
    """Key as text."""
    return _c(c).cast("string")


def to_millis(ts: ColumnLike) -> Column:
    """Truncate a timestamp to milliseconds, keeping its type.

    Works on the local-time value, so it is independent of the session zone.
    """
    col = _c(ts)
    micros_in_ms = F.pmod((F.extract(F.lit("SECOND"), col) * F.lit(1_000_000)).cast("long"), F.lit(1000))
    return F.timestamp_add("MICROSECOND", -micros_in_ms, col)


def is_blank(c: ColumnLike) -> Column:
    """Null or empty text, i.e. falsy in the record flow (F8)."""
    col = _c(c)
    return col.isNull() | (col == F.lit(""))


def ratio(num: ColumnLike, den: ColumnLike) -> Column:
    """``num / den`` as double; null when ``den`` is 0."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def ratio_pct(r: ColumnLike) -> Column:
    """A ratio shown as a percentage with one decimal, e.g. ``12.5%`` (F9); null stays null."""
    col = _c(r)
    return F.when(col.isNotNull(), F.format_string("%.1f%%", col * F.lit(100.0)))


def ends_with(c: ColumnLike, suffix: str = BATCH_SUFFIX) -> Column:
    """Suffix test."""
    return F.endswith(_c(c), F.lit(suffix))


def file_segment(path: ColumnLike, suffix: str = BATCH_SUFFIX) -> Column:
    """Path segment that ends in ``suffix`` (a batch written by Spark is a directory).

    ``.../batch_20240110_000000.parquet/part-0000.snappy.parquet`` -> ``batch_20240110_000000.parquet``;
    a plain file gives its own name; a partition directory ``b=batch_....parquet`` gives its value.
    Plain string functions (no regex): this runs once per scanned row.
    """
    p = _c(path)
    head = F.substring_index(p, suffix, 1)             # up to the first suffix
    segment = F.substring_index(head, "/", -1)         # its last path segment
    value = F.substring_index(segment, "=", -1)        # partition directory value
    return F.when(F.contains(p, F.lit(suffix)), F.concat(value, F.lit(suffix))).otherwise(F.lit(""))
