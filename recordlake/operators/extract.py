"""Free text -> typed detail columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.functions.textrules import PERMIT_TYPES, WATTS_MAX, WATTS_MIN, detail_columns
from recordlake.operators.joins import new_rows

DETAILS_SCHEMA = T.StructType([
    T.StructField("system_size", T.DoubleType()),
    T.StructField("permit_type", T.StringType()),
    T.StructField("storage_size", T.DoubleType()),
    T.StructField("module_watts", T.IntegerType()),
    T.StructField("module_count", T.IntegerType()),
    T.StructField("module_brand", T.StringType()),
])
UNREADABLE = "unreadable"
DETAIL_NAMES = [f.name for f in DETAILS_SCHEMA.fields]


def validate_details(df: DataFrame) -> DataFrame:
    """Range and enum checks (X3): an invalid value becomes null and is named in
    ``violations`` (one bad field never fails the batch), after the names in the column
    ``unreadable``, which goes."""
    watts_bad = F.col("module_watts").isNotNull() & ~F.col("module_watts").between(WATTS_MIN, WATTS_MAX)
    type_bad = F.col("permit_type").isNotNull() & ~F.col("permit_type").isin(*PERMIT_TYPES)
    # names of the failed checks; built without higher-order functions so the projection
    # stays inside whole-stage codegen
    failed = F.concat_ws(",", F.when(F.col(UNREADABLE) != F.lit(""), F.col(UNREADABLE)), F.when(watts_bad, F.lit("module_watts")), F.when(type_bad, F.lit("permit_type")))
    violations = F.when(failed == F.lit(""), F.array().cast("array<string>")).otherwise(F.split(failed, ","))
    return (df.withColumn("violations", violations)
              .withColumn("module_watts", F.when(watts_bad, F.lit(None)).otherwise(F.col("module_watts")))
              .withColumn("permit_type", F.when(type_bad, F.lit(None)).otherwise(F.col("permit_type")))
              .drop(UNREADABLE))


def extract_details(df: DataFrame, text_col: str, keep: list[str] | None = None) -> DataFrame:
    """Rule-based extraction (X1) plus validation (X3), all in Catalyst expressions.

    Output: ``keep`` columns (default: all input columns except the text), the six detail
    columns and ``violations``.
    """
    cols = detail_columns(F.col(text_col))
    kept = keep if keep is not None else [c for c in df.columns if c != text_col]
    out = df.select(*kept, *[cols[n].alias(n) for n in [*DETAIL_NAMES, UNREADABLE]])
    return validate_details(out)


BatchFn = Callable[[list], list]


INT_MAX = 2**31 - 1


_PLAIN = {T.IntegerType: (int, pa.int32()), T.DoubleType: (float, pa.float64()), T.StringType: (str, pa.string())}


def _typed(values: list, dt: T.DataType) -> tuple[pa.Array, list[bool] | None]:
    """Values as a column of their type, and which of them can't be read as one (they become null)."""
    plain, kind = _PLAIN[type(dt)]
    if set(map(type, values)) <= {plain, type(None)}:  # nothing to convert; NaN is null
        try:
            return pa.array(values, kind, from_pandas=True), None
        except (pa.ArrowInvalid, OverflowError, UnicodeError):  # a number or text beyond the type
            pass
    out, bad = [], []
    for v in values:
        try:
            x = None if v is None else int(v) if isinstance(dt, T.IntegerType) else float(v) if isinstance(dt, T.DoubleType) else str(v)
        except (TypeError, ValueError, OverflowError):
            x = None
        if isinstance(dt, T.IntegerType) and x is not None and not -INT_MAX - 1 <= x <= INT_MAX:
            x = None
        out.append(x)
        bad.append(v is not None and x is None)
    return pa.array(out, kind, from_pandas=True), bad


def extract_with(df: DataFrame, key_col: str, text_col: str, fn: BatchFn) -> DataFrame:
    """Batch-inference hook (X2): ``fn(list of texts) -> list of dicts`` with the detail
    fields, run per Arrow batch with ``mapInArrow``; each row keeps its key (P4). Values of a column's own type go
    into it as they are, only others are converted one by one.

    Any batch model plugs in here; results then get the X3 checks. A value that is none of its
    column's type becomes null and is named in ``violations``.
    """
    key_field = df.schema[key_col]
    out_schema = T.StructType([T.StructField(key_col, key_field.dataType, True), *DETAILS_SCHEMA.fields, T.StructField(UNREADABLE, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            recs = [r or {} for r in fn(texts)] if texts else []
            if len(recs) != len(texts):
                raise ValueError(f"batch function returned {len(recs)} records for {len(texts)} texts")
            columns, names = [batch.column(0)], [""] * len(recs)
            for f in DETAILS_SCHEMA.fields:
                values, bad = _typed([r.get(f.name) for r in recs], f.dataType)
                columns.append(values)
                if bad and any(bad):
                    names = [f"{n},{f.name}" if n and b else f.name if b else n for n, b in zip(names, bad)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string())], out_schema.names)

    return validate_details(df.select(key_col, text_col).mapInArrow(run, out_schema))


def extract_new(results: DataFrame, extracted: DataFrame | None, key_col: str, text_col: str,
                fn: BatchFn | None = None) -> DataFrame:
    """Details for records not extracted yet (X4): anti-join on the key, then X1 (or the
    X2 hook with ``fn``) and X3, one plan."""
    todo = results.select(key_col, text_col)
    if extracted is not None:
        todo = new_rows(todo, extracted.select(key_col), key_col)
    if fn is None:
        return extract_details(todo, text_col, keep=[key_col])
    return extract_with(todo, key_col, text_col, fn)
