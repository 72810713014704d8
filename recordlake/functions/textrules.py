"""Rule set: free-text solar permit description -> typed detail columns.

Each rule is one regular expression evaluated by Catalyst (``regexp_extract`` /
``regexp_replace``), so extraction runs inside whole-stage codegen with no Python per
row. Patterns avoid look-around and possessive quantifiers, so the same text works in
Java regex and in RE2-based engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The detail record, its enum and its range.
PERMIT_TYPES = ["Roof Mount", "Ground Mount", "Storage only"]
WATTS_MIN, WATTS_MAX = 200, 500

# Rule patterns (case-insensitive, capture group 1 is the value).
NUM = r"[0-9]+(?:\.[0-9]+)?"
RULES = {
    # "(1) 13.5Kw Battery": a storage phrase, removed before reading the system size
    "storage_phrase": rf"(?i)(?:\([0-9]+\) *)?{NUM} *kwh? *batter",
    # "9.36kW", "5.53 Kw" but not "13.5 kWh"
    "system_size": rf"(?i)({NUM}) *kw(?:[^h0-9a-z]|$)",
    # "365 Watt", "400W"
    "module_watts": r"(?i)\b([0-9]{3}) *w(?:atts?)?\b",
    # "26 panels", "14 Modules"
    "module_count": r"(?i)\b([0-9]+) *(?:modules?|panels?)\b",
    # "19 - REC NPeak2 365 Watt Modules": count before the dash
    "module_count_listed": r"(?i)\b([0-9]+) *- *[a-z][^.]*? [0-9]{3} *w(?:atts?)? +(?:modules?|panels?)",
    # "19 - REC NPeak2 365 Watt Modules": brand between dash and wattage
    "module_brand": r"(?i)\b[0-9]+ *- *([a-z][^.]*?) +[0-9]{3} *w(?:atts?)? +(?:modules?|panels?)",
    # "2 batteries (13.5 kWh each)"
    "battery_count": r"(?i)\b([0-9]+) *batter",
    "battery_each": rf"(?i)batter[a-z]* *\(({NUM}) *kwh? *each",
    # "(1) 13.5Kw Battery"
    "battery_count_paren": rf"(?i)\(([0-9]+)\) *{NUM} *kwh? *batter",
    "battery_size": rf"(?i)({NUM}) *kwh? *batter",
    "ground": r"(?i)\bground\b",
    "roof": r"(?i)\broof",
}


def _grab(text: Column, rule: str) -> Column:
    """Group 1 of ``rule`` or null when it does not match."""
    return F.nullif(F.regexp_extract(text, RULES[rule], 1), F.lit(""))


def detail_columns(text: Column) -> dict[str, Column]:
    """The six raw detail columns (before validation) for a text column, and ``unreadable``: names of
    columns whose text is no value of their type (a number out of range), separated by commas."""
    t = F.coalesce(text, F.lit(""))
    without_storage = F.regexp_replace(t, RULES["storage_phrase"], " ")
    system_size = _grab(without_storage, "system_size").try_cast("double")
    module_watts = _grab(t, "module_watts").try_cast("int")
    count_text = F.coalesce(_grab(t, "module_count"), _grab(t, "module_count_listed"))
    module_count = count_text.try_cast("int")
    module_brand = _grab(t, "module_brand")
    n_batt = _grab(t, "battery_count").try_cast("double")
    each = _grab(t, "battery_each").try_cast("double")
    paren = F.coalesce(_grab(t, "battery_count_paren").try_cast("double"), F.lit(1.0))
    size_one = _grab(t, "battery_size").try_cast("double")
    storage_size = F.when(n_batt.isNotNull() & each.isNotNull(), n_batt * each) \
        .otherwise(paren * size_one)
    permit_type = (F.when(t.rlike(RULES["ground"]), F.lit("Ground Mount"))
                   .when(t.rlike(RULES["roof"]), F.lit("Roof Mount"))
                   .when(storage_size.isNotNull() & system_size.isNull() & count_text.isNull(),
                         F.lit("Storage only")))
    return {
        "system_size": system_size,
        "permit_type": permit_type,
        "storage_size": storage_size,
        "module_watts": module_watts,
        "module_count": module_count,
        "module_brand": module_brand,
        "unreadable": F.when(count_text.isNotNull() & module_count.isNull(), F.lit("module_count")).otherwise(F.lit("")),
    }
