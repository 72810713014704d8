"""Look-ups over captured pages (H3-H5): the per-record browsing of the source flow
becomes a scan of a ``pages`` table plus column expressions.

A page's field is extracted once, by a generator of one row, and status and value are read from its
output: neither a merged projection nor a pushed filter can copy the extraction past a generator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlake.functions.html import (
    ERROR_MARKER,
    LABEL_CLASS,
    LICENSE_LABEL,
    NAME_ID,
    NAME_TAG,
    first_line,
    label_field,
)
from recordlake.operators.project import is_error_page

# Look-up outcomes (this library's status values).
STATUSES = ["ok", "empty_page", "error_page", "missing_section", "missing_label"]

_FIELD = "_rl_field"


def lookup_status(url: Column, empty: Column, section_present: Column, value: Column,
                  error_marker: str = ERROR_MARKER) -> Column:
    """Why a look-up has (no) value (H3): the first failing step wins."""
    return (F.when(empty, F.lit("empty_page"))
            .when(is_error_page(url, error_marker), F.lit("error_page"))
            .when(~section_present, F.lit("missing_section"))
            .when(value.isNull(), F.lit("missing_label"))
            .otherwise(F.lit("ok")))


def _looked_up(pages: DataFrame, key_col: str, url_col: str, html_col: str, field: Column, error_marker: str, out_col: str) -> DataFrame:
    """Key, value and status from ``field``, a struct (section, value) that is computed once a page."""
    html = F.col(html_col)
    empty = html.isNull() | (html == F.lit(""))
    found = pages.select(F.col(key_col), F.col(url_col).alias("_rl_url"), empty.alias("_rl_empty"), F.explode(F.array(field)).alias(_FIELD))
    value = F.col(f"{_FIELD}.value")
    status = lookup_status(F.col("_rl_url"), F.col("_rl_empty"), F.coalesce(F.col(f"{_FIELD}.section"), F.lit(False)), value, error_marker)
    done = found.select(F.col(key_col), value.alias("_rl_value"), status.alias("status"))
    return done.select(F.col(key_col), F.when(F.col("status") == F.lit("ok"), F.col("_rl_value")).alias(out_col), F.col("status"))


def permit_to_license(pages: DataFrame, key_col: str, url_col: str = "url", html_col: str = "html",
                      label: str = LICENSE_LABEL, css_class: str = LABEL_CLASS,
                      error_marker: str = ERROR_MARKER, out_col: str = "license_no") -> DataFrame:
    """Per record ``(key, licence or null, status)`` from its captured detail page (H4).

    An error page gives a null licence even if the label is present.
    """
    return _looked_up(pages, key_col, url_col, html_col, label_field(F.col(html_col), label, css_class), error_marker, out_col)


def code_to_name(pages: DataFrame, code_col: str, url_col: str = "url", html_col: str = "html",
                 tag: str = NAME_TAG, elem_id: str | None = NAME_ID,
                 error_marker: str = ERROR_MARKER, out_col: str = "business_name") -> DataFrame:
    """Per code ``(code, name or null, status)`` from its captured registry page (H5)."""
    line = first_line(F.col(html_col), tag, elem_id)
    field = F.transform(F.array(line), lambda x: F.struct(x.isNotNull().alias("section"), x.alias("value")))
    return _looked_up(pages, code_col, url_col, html_col, F.get(field, F.lit(0)), error_marker, out_col)
