"""Column functions: scalars, text rules and HTML patterns."""

from recordlake.functions.scalars import (  # noqa: F401
    as_text,
    batch_date_of,
    batch_name,
    clean_text,
    ends_with,
    file_segment,
    first_segment,
    format_date,
    is_blank,
    prev_month_end,
    prev_month_start,
    previous_month_range,
    ratio,
    ratio_pct,
    to_millis,
)
