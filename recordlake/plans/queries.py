"""Registered queries over the driver's tables, each with an equivalent DuckDB SQL oracle.

Every query reads whole tables (or frames Spark derives from them); splits into "stored"
and "new" parts use natural columns (dates, roles), and modulo arithmetic only derives
null keys or blank names, never drops rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.functions import html as H
from recordlake.functions import scalars as S
from recordlake.functions.textrules import PERMIT_TYPES, RULES, WATTS_MAX, WATTS_MIN
from recordlake.operators import aggs, joins, pages, project, setops
from recordlake.operators.extract import extract_details, extract_with
from recordlake.operators.history import cut_to_keys
from recordlake.plans import derive as D
from recordlake.sinks.upsert import upsert_frames
from recordlake.sources.files import scan_pages, scan_table

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_table(spark, sf_dir, name)


def q(s: str) -> str:
    """A Python string as a SQL string literal (both engines keep backslashes as-is)."""
    return "'" + s.replace("'", "''") + "'"


def _sql_clean(x: str) -> str:
    return f"regexp_replace({x}, {q(r'^[\s\x{00A0}]+|[\s\x{00A0}]+$')}, '', 'g')"


# ---------------------------------------------------------------------------------------
# A1, O2: mean per day
def q_daily_mean(spark, sf):
    ev = _t(spark, sf, "events").select(F.to_date("ts").alias("day"), "value")
    out = aggs.daily_mean(ev, "day", "value", "avg_value")
    return setops.order_by_key(out.select("day", F.round("avg_value", 6).alias("avg_value")), "day")


SQL_DAILY_MEAN = """
SELECT CAST(ts AS DATE) AS day, round(avg(value), 6) AS avg_value
FROM events WHERE ts IS NOT NULL GROUP BY 1 ORDER BY 1"""


# Documents not labelled yet
def q_new_rows(spark, sf):
    return joins.new_rows(_t(spark, sf, "documents"), _t(spark, sf, "labels"), "doc_id")


SQL_NEW_ROWS = """
SELECT d.* FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"""


# J1 against a long history: orders of January 1996 by customers who had not ordered before
def q_new_rows_history(spark, sf):
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    month, after = F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1996-02-01").cast("timestamp_ntz")
    batch = orders.where((F.col("o_orderdate") >= month) & (F.col("o_orderdate") < after)).drop("o_orderdate")
    before = orders.where(F.col("o_orderdate") < month).select("o_custkey")
    return joins.new_rows(batch, cut_to_keys(before, batch, "o_custkey"), "o_custkey")


SQL_NEW_ROWS_HISTORY = """
SELECT o.o_orderkey, o.o_custkey FROM orders o
WHERE o.o_orderdate >= TIMESTAMP '1996-01-01' AND o.o_orderdate < TIMESTAMP '1996-02-01'
  AND NOT EXISTS (SELECT 1 FROM orders b WHERE b.o_custkey = o.o_custkey AND b.o_orderdate < TIMESTAMP '1996-01-01')"""


def _registry(spark, sf) -> DataFrame:
    sup = _t(spark, sf, "supplier").where(F.col("s_nationkey") < 12)
    return project.rename(sup.select("s_suppkey", "s_name"), {"s_suppkey": "code", "s_name": "business_name"})


# Codes used by line items that the registry does not know
def q_unmatched_codes(spark, sf):
    li = _t(spark, sf, "lineitem").select(F.col("l_suppkey").alias("code"))
    return joins.unmatched_codes(li, _registry(spark, sf), "code")


SQL_UNMATCHED_CODES = """
SELECT DISTINCT l_suppkey AS code FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_nationkey < 12 AND s.s_suppkey = l.l_suppkey)"""


# Line items enriched with the registry name
def q_enrich_inner(spark, sf):
    li = project.project(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", F.col("l_suppkey").alias("code")])
    return joins.enrich_inner(li, _registry(spark, sf), "code")


SQL_ENRICH_INNER = """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey AS code, s.s_name AS business_name
FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey WHERE s.s_nationkey < 12"""


# J3 with a registry that is checked in the same pass
def q_enrich_unique(spark, sf):
    orders = _t(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("code"))
    registry = (_t(spark, sf, "customer").where(F.col("c_nationkey") < 12)
                .select(F.col("c_custkey").alias("code"), F.col("c_name").alias("business_name")))
    return joins.enrich_inner(orders, registry, "code", unique=True)


SQL_ENRICH_UNIQUE = """
SELECT o.o_orderkey, o.o_custkey AS code, c.c_name AS business_name
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey WHERE c.c_nationkey < 12"""


# Resolve codes, growing the registry from look-ups
def q_resolve_registry(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("code"))
    lookups = (_t(spark, sf, "supplier").where(F.col("s_nationkey") >= 12)
               .select(F.col("s_suppkey").alias("code"), F.expr(D.SUPPLIER_LOOKUP_NAME).alias("business_name")))
    enriched, _, _ = joins.resolve_and_grow_registry(li, _registry(spark, sf), lookups, "code", "business_name")
    return enriched.groupBy("code", "business_name").agg(F.count(F.lit(1)).alias("n_rows"))


SQL_RESOLVE_REGISTRY = f"""
WITH reg AS (SELECT s_suppkey AS code, s_name AS business_name FROM supplier WHERE s_nationkey < 12),
look AS (SELECT s_suppkey AS code, {D.SUPPLIER_LOOKUP_NAME} AS business_name FROM supplier WHERE s_nationkey >= 12),
missing AS (SELECT DISTINCT l_suppkey AS code FROM lineitem
            WHERE l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT code FROM reg)),
per_code AS (SELECT code, max(business_name) AS business_name FROM look WHERE code IS NOT NULL GROUP BY code),
resolved AS (SELECT code, business_name FROM per_code
             WHERE code IN (SELECT code FROM missing) AND business_name IS NOT NULL AND business_name <> ''),
grown AS (SELECT * FROM reg UNION ALL SELECT * FROM resolved)
SELECT g.code, g.business_name, count(*) AS n_rows
FROM lineitem l JOIN grown g ON l.l_suppkey = g.code GROUP BY 1, 2"""


# Look-up results attached to a batch, null key matching null key
def q_attach_results(spark, sf):
    # every look-up was made twice, with different outcomes: one whole outcome is attached
    batch = _t(spark, sf, "orders").select("o_orderkey", F.expr(D.ORDER_PERMIT_KEY).alias("permit_number"))
    once = _t(spark, sf, "customer").select(F.expr(D.CUSTOMER_PERMIT_KEY).alias("permit_number"),
                                            F.expr(D.CUSTOMER_LICENSE).alias("license_no"), F.col("c_mktsegment").alias("note"))
    again = once.select("permit_number", F.reverse("license_no").alias("license_no"), F.lower("note").alias("note"))
    results = once.unionByName(again)
    return joins.attach_results(batch, results, "permit_number")


SQL_ATTACH_RESULTS = f"""
WITH b AS (SELECT o_orderkey, {D.ORDER_PERMIT_KEY} AS permit_number FROM orders),
once AS (SELECT {D.CUSTOMER_PERMIT_KEY} AS permit_number, {D.CUSTOMER_LICENSE} AS license_no, c_mktsegment AS note FROM customer),
r AS (SELECT * FROM once UNION ALL SELECT permit_number, reverse(license_no) AS license_no, lower(note) AS note FROM once),
rd AS (SELECT *, row_number() OVER (PARTITION BY permit_number ORDER BY license_no DESC NULLS LAST, note DESC NULLS LAST) AS rn FROM r)
SELECT b.o_orderkey, b.permit_number, rd.license_no, rd.note
FROM b LEFT JOIN rd ON b.permit_number IS NOT DISTINCT FROM rd.permit_number AND rd.rn = 1"""


def _event_batches(spark, sf) -> DataFrame:
    ev = _t(spark, sf, "events")
    name = F.concat(F.lit(S.BATCH_PREFIX), S.format_date("ts", "day"), F.lit("_000000" + S.BATCH_SUFFIX))
    return ev.select("event_id", "ts", F.expr(D.EVENT_USER_KEY).alias("user_key"), name.alias("batch_file"))


_SQL_EVENT_BATCHES = f"""SELECT event_id, ts, {D.EVENT_USER_KEY} AS user_key,
  'batch_' || strftime(ts, '%Y%m%d') || '_000000.parquet' AS batch_file FROM events"""


# Day files appended in name order, first file wins, first day already stored
def q_first_wins(spark, sf):
    ev = _event_batches(spark, sf)
    cut = F.lit("2024-01-02").cast("timestamp_ntz")
    stored, batch = ev.where(F.col("ts") < cut), ev.where(F.col("ts") >= cut)
    return joins.append_first_wins(batch, stored, "user_key", "batch_file").select("event_id", "user_key", "batch_file")


SQL_FIRST_WINS = f"""
WITH ev AS ({_SQL_EVENT_BATCHES}),
st AS (SELECT * FROM ev WHERE ts < TIMESTAMP '2024-01-02'),
b AS (SELECT * FROM ev WHERE ts >= TIMESTAMP '2024-01-02'),
firsts AS (SELECT user_key, min(batch_file) AS batch_file FROM b
           WHERE user_key IS NOT NULL
             AND NOT EXISTS (SELECT 1 FROM st WHERE st.user_key = b.user_key)
           GROUP BY user_key)
SELECT b.event_id, b.user_key, b.batch_file FROM b
LEFT JOIN firsts f ON b.user_key = f.user_key AND b.batch_file = f.batch_file
WHERE f.user_key IS NOT NULL OR b.user_key IS NULL"""


# Batches of one run date
def q_batch_files(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", S.batch_name("ts").alias("batch_file"))
    from recordlake.sources.files import select_batch_files
    return select_batch_files(ev, "20240110", "batch_file")


SQL_BATCH_FILES = """
SELECT event_id, batch_file FROM (
  SELECT event_id, 'batch_' || strftime(ts, '%Y%m%d_%H%M%S') || '.parquet' AS batch_file FROM events)
WHERE batch_file LIKE '%.parquet'
  AND split_part(replace(replace(batch_file, 'batch_', ''), '.parquet', ''), '_', 1) = '20240110'"""


# Positional batches of 50, then keys handled by an earlier run skipped
def q_number_batches(spark, sf):
    orders = _t(spark, sf, "orders")
    numbered = project.number_batches(orders.select("o_orderkey"), "o_orderkey", 50)
    seen = orders.where(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey")
    todo = joins.skip_seen(numbered, seen, "o_orderkey")
    return todo.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_rows"))


# P10 with columns that only meet the positions in a join
def q_number_wide(spark, sf):
    orders = _t(spark, sf, "orders").select("o_orderdate", "o_orderkey", "o_custkey", "o_orderpriority")
    return project.number_batches(orders, ["o_orderdate", "o_orderkey"], 50, pos_col="pos").drop("o_orderdate")


SQL_NUMBER_WIDE = """
SELECT o_orderkey, o_custkey, o_orderpriority,
       (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 50 AS batch_id,
       row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS pos
FROM orders"""


SQL_NUMBER_BATCHES = """
WITH n AS (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 50 AS batch_id FROM orders)
SELECT batch_id, count(*) AS n_rows FROM n
WHERE NOT EXISTS (SELECT 1 FROM orders s WHERE s.o_orderpriority = '1-URGENT' AND s.o_orderkey = n.o_orderkey)
GROUP BY batch_id"""


# Records of an earlier partial run are skipped (null matches null)
def _event_keys(spark, sf):
    return _t(spark, sf, "events").select("event_id", "ts", "event_type", "value",
                                          F.expr(D.EVENT_USER_KEY).alias("user_key"))


def q_skip_seen(spark, sf):
    from recordlake.streaming.incremental import resume
    ev = _event_keys(spark, sf)
    cut = F.lit("2024-01-02").cast("timestamp_ntz")
    return resume(ev.where(F.col("ts") >= cut), ev.where(F.col("ts") < cut), "user_key") \
        .select("event_id", "user_key")


SQL_SKIP_SEEN = f"""
WITH ev AS (SELECT event_id, ts, {D.EVENT_USER_KEY} AS user_key FROM events)
SELECT r.event_id, r.user_key FROM ev r
WHERE r.ts >= TIMESTAMP '2024-01-02'
  AND NOT EXISTS (SELECT 1 FROM ev s WHERE s.ts < TIMESTAMP '2024-01-02' AND s.user_key IS NOT DISTINCT FROM r.user_key)"""


# Results of the earlier run followed by the new results
def q_union_resumed(spark, sf):
    from recordlake.streaming.incremental import resume
    ev = _event_keys(spark, sf)
    cut = F.lit("2024-01-02").cast("timestamp_ntz")
    prior = ev.where(F.col("ts") < cut).select("user_key", F.col("event_type").alias("result"))
    todo = resume(ev.where(F.col("ts") >= cut), prior, "user_key")
    new = todo.select("user_key", F.col("event_type").alias("result"), "value")
    return setops.union_resumed(prior, new)


SQL_UNION_RESUMED = f"""
WITH ev AS (SELECT event_id, ts, event_type, value, {D.EVENT_USER_KEY} AS user_key FROM events),
prior AS (SELECT user_key, event_type AS result FROM ev WHERE ts < TIMESTAMP '2024-01-02')
SELECT user_key, result, CAST(NULL AS DOUBLE) AS value FROM prior
UNION ALL
SELECT r.user_key, r.event_type AS result, r.value FROM ev r
WHERE r.ts >= TIMESTAMP '2024-01-02'
  AND NOT EXISTS (SELECT 1 FROM prior p WHERE p.user_key IS NOT DISTINCT FROM r.user_key)"""


# K6 / K7: upsert of changed orders into stored orders
def _order_versions(spark, sf):
    o = _t(spark, sf, "orders")
    base = o.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")) \
        .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    changes = o.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).select(
        F.expr("CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_orderkey END").alias("o_orderkey"),
        (F.col("o_custkey") + 1).alias("o_custkey"),
        F.lit("U").alias("o_orderstatus"),
        F.round(F.col("o_totalprice") * 2, 2).alias("o_totalprice"),
        F.col("o_orderkey").alias("seq"))
    return base, changes


_SQL_ORDER_VERSIONS = """
base AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
ch AS (SELECT CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_orderkey END AS o_orderkey, o_custkey + 1 AS o_custkey,
              'U' AS o_orderstatus, round(o_totalprice * 2, 2) AS o_totalprice
       FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
chk AS (SELECT * FROM ch WHERE o_orderkey IS NOT NULL)"""


def q_upsert(spark, sf):
    base, changes = _order_versions(spark, sf)
    return upsert_frames(base, changes, "o_orderkey", order_col="seq")[0]


SQL_UPSERT = f"""
WITH {_SQL_ORDER_VERSIONS}
SELECT * FROM base WHERE o_orderkey NOT IN (SELECT o_orderkey FROM chk)
UNION ALL SELECT * FROM chk"""


def q_upsert_partial(spark, sf):
    base, changes = _order_versions(spark, sf)
    return upsert_frames(base, changes, "o_orderkey", order_col="seq", update_cols=["o_orderstatus"])[0]


SQL_UPSERT_PARTIAL = f"""
WITH {_SQL_ORDER_VERSIONS}
SELECT b.o_orderkey, b.o_custkey,
       CASE WHEN c.o_orderkey IS NOT NULL THEN c.o_orderstatus ELSE b.o_orderstatus END AS o_orderstatus,
       b.o_totalprice
FROM base b LEFT JOIN chk c ON b.o_orderkey = c.o_orderkey
UNION ALL SELECT * FROM chk WHERE o_orderkey NOT IN (SELECT o_orderkey FROM base)"""


# K6: several changes per key, the last one (by event id) wins, also a null value
def q_upsert_last_wins(spark, sf):
    base = _t(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"),
                                            F.col("c_mktsegment").alias("event_type"),
                                            F.col("c_acctbal").alias("value"))
    changes = _t(spark, sf, "events").select(
        "user_id", "event_type",
        F.expr("CASE WHEN event_type = 'error' THEN NULL ELSE value END").alias("value"),
        F.expr("CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END").alias("seq"))
    return upsert_frames(base, changes, "user_id", order_col="seq")[0]


SQL_UPSERT_LAST_WINS = """
WITH base AS (SELECT c_custkey AS user_id, c_mktsegment AS event_type, c_acctbal AS value FROM customer),
last AS (SELECT user_id, event_type, value FROM (
   SELECT user_id, event_type, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
          row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END DESC NULLS LAST,
            event_type DESC NULLS LAST, CASE WHEN event_type = 'error' THEN NULL ELSE value END DESC NULLS LAST) AS rn
   FROM events WHERE user_id IS NOT NULL) WHERE rn = 1)
SELECT * FROM base WHERE user_id NOT IN (SELECT user_id FROM last)
UNION ALL SELECT * FROM last"""


# Records of the month before the run date (and of one status)
RUN_DATE = "1997-03-15"


def q_prev_month(spark, sf):
    start, end = S.previous_month_range(F.lit(RUN_DATE).cast("date"))
    o = _t(spark, sf, "orders")
    return project.search_records(o, "o_orderdate", start, end) \
        .select("o_orderkey", "o_orderdate", "o_orderstatus", start.alias("range_start"), end.alias("range_end"))


_SQL_PREV = f"""date_trunc('month', DATE '{RUN_DATE}' - INTERVAL 1 MONTH)"""
SQL_PREV_MONTH = f"""
SELECT o_orderkey, o_orderdate, o_orderstatus,
       CAST({_SQL_PREV} AS DATE) AS range_start, last_day({_SQL_PREV}) AS range_end
FROM orders
WHERE o_orderdate >= {_SQL_PREV} AND o_orderdate < CAST(last_day({_SQL_PREV}) AS TIMESTAMP) + INTERVAL 1 DAY"""


def q_search_records(spark, sf):
    start, end = S.previous_month_range(F.lit(RUN_DATE).cast("date"))
    o = _t(spark, sf, "orders")
    return project.search_records(o, "o_orderdate", start, end, {"o_orderstatus": "F"}) \
        .select("o_orderkey", "o_orderdate", "o_totalprice")


SQL_SEARCH_RECORDS = f"""
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate >= {_SQL_PREV} AND o_orderdate < CAST(last_day({_SQL_PREV}) AS TIMESTAMP) + INTERVAL 1 DAY
  AND o_orderstatus = 'F'"""


# Storage types of a batch (ints -> bigint, timestamps -> ms, other -> text)
def q_normalize_types(spark, sf):
    ev = _t(spark, sf, "events").select(
        "event_id", "ts", F.col("user_id").cast("int").alias("user_small"), "event_type", "value",
        F.to_date("ts").alias("day"), (F.col("value") > 50).alias("high"))
    return project.normalize_types(ev)


SQL_NORMALIZE_TYPES = """
SELECT event_id, date_trunc('millisecond', ts) AS ts, CAST(user_id AS BIGINT) AS user_small, event_type, value,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS day, value > 50 AS high
FROM events"""


# Formatting and cleanup
def q_scalars(spark, sf):
    o = _t(spark, sf, "orders")
    c = _t(spark, sf, "customer").select("c_custkey", "c_name")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
    status = F.expr("CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END")
    return j.select(
        "o_orderkey",
        S.format_date("o_orderdate", "form").alias("form_date"),
        S.format_date("o_orderdate", "stamp").alias("stamp"),
        S.format_date("o_orderdate", "day").alias("run_day"),
        S.clean_text(F.concat(F.lit("  "), F.col("c_name"), F.lit(" \t "))).alias("clean_name"),
        S.first_segment(F.concat("o_orderstatus", F.lit("<br>"), "o_orderpriority")).alias("first_seg"),
        S.as_text("o_orderkey").alias("key_text"),
        S.is_blank(status).alias("blank_status"),
        F.round(S.ratio(F.col("o_custkey") % 10, F.col("o_orderkey") % 4), 6).alias("ratio"))


SQL_SCALARS = f"""
SELECT o_orderkey, strftime(o_orderdate, '%m/%d/%Y') AS form_date, strftime(o_orderdate, '%Y%m%d_%H%M%S') AS stamp,
       strftime(o_orderdate, '%Y%m%d') AS run_day,
       {_sql_clean("'  ' || c_name || ' ' || chr(9) || ' '")} AS clean_name,
       split_part(o_orderstatus || '<br>' || o_orderpriority, '<br>', 1) AS first_seg,
       CAST(o_orderkey AS VARCHAR) AS key_text,
       (CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END) IS NULL
         OR (CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END) = '' AS blank_status,
       round(CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_custkey % 10 AS DOUBLE) / (o_orderkey % 4) END, 6) AS ratio
FROM orders JOIN customer ON o_custkey = c_custkey"""


# A4: licence missing ratio
def q_missing_report(spark, sf):
    j = _t(spark, sf, "documents").select("doc_id").join(_t(spark, sf, "labels"), "doc_id", "left")
    r = aggs.missing_report(j, "quality")
    return r.select("missing", "total", F.round("missing_ratio", 6).alias("missing_ratio"))


SQL_MISSING_REPORT = """
SELECT count(*) FILTER (WHERE l.quality IS NULL) AS missing, count(*) AS total,
       round(CAST(count(*) FILTER (WHERE l.quality IS NULL) AS DOUBLE) / count(*), 6) AS missing_ratio
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


# A5: resolved / unresolved look-ups
def q_resolution_report(spark, sf):
    look = _t(spark, sf, "supplier").select(F.expr(D.SUPPLIER_LOOKUP_NAME).alias("business_name"))
    return aggs.resolution_report(look, "business_name")


SQL_RESOLUTION_REPORT = f"""
SELECT count(*) AS looked_up,
       count(*) FILTER (WHERE name IS NULL OR name = '') AS unresolved,
       count(*) FILTER (WHERE NOT (name IS NULL OR name = '')) AS resolved
FROM (SELECT {D.SUPPLIER_LOOKUP_NAME} AS name FROM supplier)"""


# Fields out of captured pages
def q_page_fields(spark, sf):
    p = _t(spark, sf, "pages")
    return p.select(
        "page_id",
        H.extract_first_line("html", "h1", None).alias("h1"),
        H.extract_first_line("html", "article", None).alias("article_head"),
        H.extract_label_value(F.expr(D.PAGE_WITH_DETAIL)).alias("license_no"))


def _sql_first_line(x: str, tag: str) -> str:
    """By positions in the page: behind the open tag, up to the end tag and to a line break."""
    opened = f"strpos(lower({x}), '<{tag}')"
    behind = f"substr(substr({x}, {opened}), strpos(substr({x}, {opened}), '>') + 1)"
    end = f"strpos(lower({behind}), '</{tag}')"
    inner = f"substr({behind}, 1, {end} - 1)"
    line = f"CASE WHEN strpos(lower({inner}), '<br') > 0 THEN substr({inner}, 1, strpos(lower({inner}), '<br') - 1) ELSE {inner} END"
    return f"CASE WHEN {opened} > 0 AND {end} > 0 THEN trim({line}, ' ' || chr(9) || chr(10) || chr(13) || chr(160)) END"


SQL_PAGE_FIELDS = f"""
SELECT page_id,
       {_sql_first_line('html', 'h1')} AS h1,
       {_sql_first_line('html', 'article')} AS article_head,
       {D.PAGE_DETAIL_VALUE} AS license_no
FROM pages"""


# Look-up status per page (the first h1 as the name; urls with page=2 as error pages)
def q_page_status(spark, sf):
    p = _t(spark, sf, "pages")
    return pages.code_to_name(p, "page_id", tag="h1", elem_id=None, error_marker="page=2")


SQL_PAGE_STATUS = f"""
SELECT page_id, CASE WHEN status = 'ok' THEN name END AS business_name, status FROM (
  SELECT page_id, name,
    CASE WHEN html IS NULL OR html = '' THEN 'empty_page'
         WHEN contains(url, 'page=2') THEN 'error_page'
         WHEN name IS NULL THEN 'missing_section' ELSE 'ok' END AS status
  FROM (SELECT page_id, url, html, {_sql_first_line('html', 'h1')} AS name FROM pages))"""


# H5, H4: registry pages written from suppliers, read back; H4 on the detail snippet
def q_code_to_name(spark, sf):
    sup = _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("code"),
                                           F.expr(D.SUPPLIER_PAGE_URL).alias("url"),
                                           F.expr(D.SUPPLIER_PAGE_HTML).alias("html"))
    return pages.code_to_name(sup, "code")


SQL_CODE_TO_NAME = """
SELECT s_suppkey AS code, CASE WHEN s_nationkey <> 3 THEN s_name END AS business_name,
       CASE WHEN s_nationkey = 3 THEN 'error_page' ELSE 'ok' END AS status
FROM supplier"""


# Whole captured pages, scanned from a folder, with a detail block at the end of each
def q_permit_to_license(spark, sf):
    p = scan_pages(spark, f"{sf}/pages.parquet").select("page_id", "url", F.expr(D.PAGE_WITH_DETAIL).alias("html"))
    return pages.permit_to_license(p, "page_id", error_marker="page=2")


SQL_PERMIT_TO_LICENSE = f"""
SELECT page_id, CASE WHEN status = 'ok' THEN v END AS license_no, status FROM (
  SELECT page_id, v, CASE WHEN html IS NULL THEN 'empty_page' WHEN contains(url, 'page=2') THEN 'error_page'
                          WHEN v IS NULL THEN 'missing_label' ELSE 'ok' END AS status
  FROM (SELECT page_id, url, html, {D.PAGE_DETAIL_VALUE} AS v FROM pages))"""


# Captured pages as they are
def q_scan_pages(spark, sf):
    p = scan_pages(spark, f"{sf}/pages.parquet")
    return p.select("page_id", "url", F.length("html").cast("bigint").alias("n_html"), F.md5(F.col("html")).alias("html_md5"))


SQL_SCAN_PAGES = "SELECT page_id, url, CAST(length(html) AS BIGINT) AS n_html, md5(html) AS html_md5 FROM pages"


# a ratio and how it is shown
def q_ratio_pct(spark, sf):
    r = S.ratio("l_extendedprice", F.col("l_quantity") * F.expr("CASE WHEN l_linenumber = 7 THEN 0 ELSE 40000 END"))
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", S.ratio_pct(r).alias("shown"))


SQL_RATIO_PCT = """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 7 AND l_quantity <> 0 THEN
  format('{:.1f}%', l_extendedprice / (l_quantity * 40000) * 100.0) END AS shown FROM lineitem"""


# I4: only documents that have no label yet
def q_incremental_enrich(spark, sf):
    from recordlake.streaming.incremental import incremental_enrich
    docs = _t(spark, sf, "documents").select("doc_id", "source")
    return incremental_enrich(docs, _t(spark, sf, "labels"), "doc_id")


SQL_INCREMENTAL_ENRICH = """
SELECT doc_id, source FROM documents WHERE doc_id IS NULL OR doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)"""


# Permit descriptions -> typed details
def _descriptions(spark, sf):
    return _t(spark, sf, "part").select(F.col("p_partkey").alias("permit_number"),
                                        F.expr(D.PART_DESCRIPTION).alias("description"))


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumn("violations", F.array_join("violations", ","))


def q_extract_details(spark, sf):
    return _flat(extract_details(_descriptions(spark, sf), "description", keep=["permit_number"]))


def _sql_grab(x: str, rule: str) -> str:
    return f"nullif(regexp_extract({x}, {q(RULES[rule])}, 1), '')"


def _sql_details() -> str:
    t = "coalesce(description, '')"
    t2 = f"regexp_replace({t}, {q(RULES['storage_phrase'])}, ' ', 'g')"
    size = f"CAST({_sql_grab(t2, 'system_size')} AS DOUBLE)"
    watts = f"CAST({_sql_grab(t, 'module_watts')} AS INTEGER)"
    listed = f"coalesce({_sql_grab(t, 'module_count')}, {_sql_grab(t, 'module_count_listed')})"
    count = f"TRY_CAST({listed} AS INTEGER)"
    brand = _sql_grab(t, "module_brand")
    n_batt = f"CAST({_sql_grab(t, 'battery_count')} AS DOUBLE)"
    each = f"CAST({_sql_grab(t, 'battery_each')} AS DOUBLE)"
    paren = f"coalesce(CAST({_sql_grab(t, 'battery_count_paren')} AS DOUBLE), 1.0)"
    one = f"CAST({_sql_grab(t, 'battery_size')} AS DOUBLE)"
    storage = f"CASE WHEN {n_batt} IS NOT NULL AND {each} IS NOT NULL THEN {n_batt} * {each} ELSE {paren} * {one} END"
    ptype = (f"CASE WHEN regexp_matches({t}, {q(RULES['ground'])}) THEN 'Ground Mount' "
             f"WHEN regexp_matches({t}, {q(RULES['roof'])}) THEN 'Roof Mount' "
             f"WHEN ({storage}) IS NOT NULL AND ({size}) IS NULL AND {listed} IS NULL THEN 'Storage only' END")
    return f"""permit_number, {size} AS system_size, {ptype} AS permit_type, {storage} AS storage_size,
       {watts} AS module_watts, {count} AS module_count, {brand} AS module_brand,
       {listed} IS NOT NULL AND {count} IS NULL AS count_bad"""


_ENUM = ", ".join(q(v) for v in PERMIT_TYPES)
def sql_checked_details(source: str) -> str:
    """Details with their checks, over a query of (permit_number, description)."""
    return f"""
WITH raw AS (SELECT {_sql_details()} FROM ({source})),
chk AS (SELECT *, module_watts IS NOT NULL AND NOT (module_watts BETWEEN {WATTS_MIN} AND {WATTS_MAX}) AS watts_bad,
               permit_type IS NOT NULL AND permit_type NOT IN ({_ENUM}) AS type_bad FROM raw)
SELECT permit_number, system_size, CASE WHEN type_bad THEN NULL ELSE permit_type END AS permit_type, storage_size,
       CASE WHEN watts_bad THEN NULL ELSE module_watts END AS module_watts, module_count, module_brand,
       concat_ws(',', CASE WHEN count_bad THEN 'module_count' END, CASE WHEN watts_bad THEN 'module_watts' END, CASE WHEN type_bad THEN 'permit_type' END) AS violations
FROM chk"""


SQL_EXTRACT_DETAILS = sql_checked_details(f"SELECT p_partkey AS permit_number, {D.PART_DESCRIPTION} AS description FROM part")


# The same descriptions through the batch-inference hook (mapInPandas); the batch function
# works on whole pandas columns
def batch_rules(texts: list) -> list[dict]:
    import pandas as pd

    t = pd.Series(texts, dtype=object).fillna("").astype(str)

    def grab(rule, x=t):
        return x.str.extract(RULES[rule], expand=True)[0].replace("", None)

    count = grab("module_count").fillna(grab("module_count_listed"))
    each = pd.to_numeric(grab("battery_count")) * pd.to_numeric(grab("battery_each"))
    storage = each.fillna(pd.to_numeric(grab("battery_count_paren")).fillna(1.0) * pd.to_numeric(grab("battery_size")))
    size = grab("system_size", t.str.replace(RULES["storage_phrase"], " ", regex=True))
    kind = pd.Series(None, index=t.index, dtype=object)
    kind[storage.notna() & size.isna() & count.isna()] = "Storage only"
    kind[t.str.contains(RULES["roof"])] = "Roof Mount"
    kind[t.str.contains(RULES["ground"])] = "Ground Mount"
    out = pd.DataFrame({"system_size": size, "permit_type": kind, "storage_size": storage.astype(object),
                        "module_watts": grab("module_watts"), "module_count": count, "module_brand": grab("module_brand")})
    return out.astype(object).where(out.notna(), None).to_dict("records")


def q_extract_with(spark, sf):
    return _flat(extract_with(_descriptions(spark, sf), "permit_number", "description", batch_rules))


# O3: last 75 events (a top-k report)
def q_tail(spark, sf):
    return setops.tail_rows(_t(spark, sf, "events").select("event_id", "ts", "user_id"), 75, "event_id")


SQL_TAIL = "SELECT event_id, ts, user_id FROM events ORDER BY event_id DESC LIMIT 75"


def queries() -> dict[str, Query]:
    return {
        "q_daily_mean": q_daily_mean,
        "q_new_rows": q_new_rows,
        "q_new_rows_history": q_new_rows_history,
        "q_unmatched_codes": q_unmatched_codes,
        "q_enrich_inner": q_enrich_inner,
        "q_enrich_unique": q_enrich_unique,
        "q_resolve_registry": q_resolve_registry,
        "q_attach_results": q_attach_results,
        "q_first_wins": q_first_wins,
        "q_batch_files": q_batch_files,
        "q_number_batches": q_number_batches,
        "q_number_wide": q_number_wide,
        "q_skip_seen": q_skip_seen,
        "q_union_resumed": q_union_resumed,
        "q_upsert": q_upsert,
        "q_upsert_partial": q_upsert_partial,
        "q_upsert_last_wins": q_upsert_last_wins,
        "q_prev_month": q_prev_month,
        "q_search_records": q_search_records,
        "q_normalize_types": q_normalize_types,
        "q_scalars": q_scalars,
        "q_missing_report": q_missing_report,
        "q_resolution_report": q_resolution_report,
        "q_page_fields": q_page_fields,
        "q_page_status": q_page_status,
        "q_code_to_name": q_code_to_name,
        "q_permit_to_license": q_permit_to_license,
        "q_extract_details": q_extract_details,
        "q_extract_with": q_extract_with,
        "q_tail": q_tail,
        "q_scan_pages": q_scan_pages,
        "q_ratio_pct": q_ratio_pct,
        "q_incremental_enrich": q_incremental_enrich,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "q_daily_mean": SQL_DAILY_MEAN,
        "q_new_rows": SQL_NEW_ROWS,
        "q_new_rows_history": SQL_NEW_ROWS_HISTORY,
        "q_unmatched_codes": SQL_UNMATCHED_CODES,
        "q_enrich_inner": SQL_ENRICH_INNER,
        "q_enrich_unique": SQL_ENRICH_UNIQUE,
        "q_resolve_registry": SQL_RESOLVE_REGISTRY,
        "q_attach_results": SQL_ATTACH_RESULTS,
        "q_first_wins": SQL_FIRST_WINS,
        "q_batch_files": SQL_BATCH_FILES,
        "q_number_batches": SQL_NUMBER_BATCHES,
        "q_number_wide": SQL_NUMBER_WIDE,
        "q_skip_seen": SQL_SKIP_SEEN,
        "q_union_resumed": SQL_UNION_RESUMED,
        "q_upsert": SQL_UPSERT,
        "q_upsert_partial": SQL_UPSERT_PARTIAL,
        "q_upsert_last_wins": SQL_UPSERT_LAST_WINS,
        "q_prev_month": SQL_PREV_MONTH,
        "q_search_records": SQL_SEARCH_RECORDS,
        "q_normalize_types": SQL_NORMALIZE_TYPES,
        "q_scalars": SQL_SCALARS,
        "q_missing_report": SQL_MISSING_REPORT,
        "q_resolution_report": SQL_RESOLUTION_REPORT,
        "q_page_fields": SQL_PAGE_FIELDS,
        "q_page_status": SQL_PAGE_STATUS,
        "q_code_to_name": SQL_CODE_TO_NAME,
        "q_permit_to_license": SQL_PERMIT_TO_LICENSE,
        "q_extract_details": SQL_EXTRACT_DETAILS,
        "q_extract_with": SQL_EXTRACT_DETAILS,
        "q_tail": SQL_TAIL,
        "q_scan_pages": SQL_SCAN_PAGES,
        "q_ratio_pct": SQL_RATIO_PCT,
        "q_incremental_enrich": SQL_INCREMENTAL_ENRICH,
    }
