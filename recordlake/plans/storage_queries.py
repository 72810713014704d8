"""Registered queries that write and read back: CSV drops, batch files, versioned tables,
the file stream, and the two composite flows.

Every write goes to a new sub-folder of the shared folder (``spark.checkpoint.dir``), and
every input is a whole driver table or a frame Spark derives from it.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.functions import scalars as S
from recordlake.operators import project
from recordlake.plans import flows
from recordlake.plans.queries import _t
from recordlake.session import scratch_path
from recordlake.sinks.table import LakeTable, PartitionedTable, write_batch
from recordlake.sources.files import scan_batches_for, scan_csv_inferred, scan_csv_strings, scan_optional
from recordlake.streaming.incremental import incremental_append, read_stored

# ---------------------------------------------------------------------------------------
# A CSV drop with a trailing header-less column, read back typed


NOTE = """c_name || CASE c_custkey % 4 WHEN 0 THEN ', 6" rail, 9kW roof' WHEN 1 THEN chr(10) || 'second line' WHEN 2 THEN '"quoted"' ELSE '' END"""


def q_csv_roundtrip(spark, sf):
    """Text with commas, quotes and line feeds, as spreadsheets write it; a resume file whose columns stand in another order."""
    base = scratch_path(spark, "csv")
    customer = _t(spark, sf, "customer").withColumn("note", F.expr(NOTE))
    def write(df, name):
        df.write.option("header", True).option("escape", '"').csv(f"{base}/{name}")
    write(customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "note", F.lit(None).cast("string").alias("")), "customer")
    write(customer.select(F.col("note").alias("Installer Number"), F.lit("x").alias("Other"), F.col("c_custkey").alias("Permit Number")), "resume")
    typed = project.drop_unnamed(scan_csv_inferred(spark, f"{base}/customer", multi_line=True), strict=True)
    text = scan_csv_strings(spark, f"{base}/customer", multi_line=True).select(F.col("c_custkey").alias("key_text"),
                                                                               F.col("c_acctbal").alias("acctbal_text"))
    missing = scan_optional(spark, f"{base}/not_there", typed.schema)
    resumed = scan_optional(spark, f"{base}/resume", flows.RESUME_FILE)
    out = typed.unionByName(missing)
    return (out.join(text, out["c_custkey"].cast("string") == text["key_text"], "inner")
            .join(resumed, F.col("Permit Number") == F.col("key_text"))
            .select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", "c_nationkey", "c_acctbal",
                    "acctbal_text", "note", F.col("Installer Number").alias("resumed")))


SQL_CSV_ROUNDTRIP = f"""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, CAST(c_acctbal AS VARCHAR) AS acctbal_text, {NOTE} AS note, {NOTE} AS resumed
FROM customer"""


# ---------------------------------------------------------------------------------------
# Two batches of one day written, scanned by run date, create + append

def q_table_roundtrip(spark, sf):
    base = scratch_path(spark, "table")
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    cut = F.lit("1996-01-01").cast("timestamp_ntz")
    write_batch(li.where(F.col("l_shipdate") < cut), f"{base}/batches", "20240110_000000")
    write_batch(li.where(F.col("l_shipdate") >= cut), f"{base}/batches", "20240110_120000")
    write_batch(li.where(F.col("l_shipdate") >= cut), f"{base}/batches", "20240111_000000")
    scanned = scan_batches_for(spark, f"{base}/batches", "20240110")
    table = LakeTable(spark, f"{base}/lake/lineitem")
    if table.exists():
        raise RuntimeError("fresh table path already holds a table")
    first = table.create_if_missing_or_append(scanned.where(F.col("batch_file") == "batch_20240110_000000.parquet"))
    second = table.create_if_missing_or_append(scanned.where(F.col("batch_file") == "batch_20240110_120000.parquet"))
    if not table.exists() or first.get["rows"] + second.get["rows"] <= 0:
        raise RuntimeError("table round trip wrote nothing")
    return table.read()


SQL_TABLE_ROUNDTRIP = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, l_shipdate,
       CASE WHEN l_shipdate < TIMESTAMP '1996-01-01' THEN 'batch_20240110_000000.parquet'
            ELSE 'batch_20240110_120000.parquet' END AS batch_file
FROM lineitem"""


# ---------------------------------------------------------------------------------------
# Day files arriving in three drops, appended through the file stream

_STREAM_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_key", T.LongType()),
])


def q_incremental_append(spark, sf):
    """Two streams with checkpoints of their own feed one table: three drops, then the same files and one more."""
    from recordlake.plans import derive as D

    base = scratch_path(spark, "stream")
    src, table = f"{base}/drops", f"{base}/events_table"
    ev = _t(spark, sf, "events").select(
        "event_id", "ts", F.expr(D.EVENT_USER_KEY).alias("user_key"),
        F.concat(F.lit(S.BATCH_PREFIX), S.format_date("ts", "day"), F.lit("_000000" + S.BATCH_SUFFIX)).alias("b"))
    cuts = ["2024-01-11", "2024-01-21"]
    drops = [F.col("ts") < F.lit(cuts[0]).cast("timestamp_ntz"),
             (F.col("ts") >= F.lit(cuts[0]).cast("timestamp_ntz")) & (F.col("ts") < F.lit(cuts[1]).cast("timestamp_ntz")),
             F.col("ts") >= F.lit(cuts[1]).cast("timestamp_ntz")]
    for n, cond in enumerate(drops):
        # the last drop arrives in another folder, read by a second stream
        own = f"{src}_{n // 2}"
        ev.where(cond).write.mode("append").partitionBy("b").parquet(own)
        incremental_append(spark, own, _STREAM_SCHEMA, table, f"{base}/checkpoint_{n // 2}", "user_key").awaitTermination()
    return read_stored(spark, table).select("event_id", "user_key", "batch_file")


SQL_INCREMENTAL_APPEND = """
WITH ev AS (SELECT event_id, CASE WHEN user_id % 7 = 0 THEN NULL ELSE user_id END AS user_key,
                   'batch_' || strftime(ts, '%Y%m%d') || '_000000.parquet' AS batch_file FROM events),
firsts AS (SELECT user_key, min(batch_file) AS batch_file FROM ev WHERE user_key IS NOT NULL GROUP BY user_key)
SELECT ev.event_id, ev.user_key, ev.batch_file FROM ev
LEFT JOIN firsts f ON ev.user_key = f.user_key AND ev.batch_file = f.batch_file
WHERE f.user_key IS NOT NULL OR ev.user_key IS NULL"""


# ---------------------------------------------------------------------------------------
# Batches of 50 persisted in several commits; a first run stops after 103 batches (the
# failure), the re-run writes only the missing ones

def q_batched_progress(spark, sf):
    from recordlake.streaming.incremental import read_progress, write_progress

    root = f"{scratch_path(spark, 'progress')}/orders"
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    numbered = project.number_batches(orders, "o_orderkey", 50)
    first = write_progress(numbered.where(F.col("batch_id") < 103), root, commits=4)
    second = write_progress(numbered, root, commits=4)
    if first + second != numbered.count():
        raise RuntimeError("re-run did not write exactly the missing batches")
    return read_progress(spark, root).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("o_orderkey").alias("first_key"))


SQL_BATCHED_PROGRESS = """
SELECT batch_id, count(*) AS n_rows, min(o_orderkey) AS first_key FROM (
  SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 50 AS batch_id FROM orders)
GROUP BY batch_id"""


# ---------------------------------------------------------------------------------------
# K6, K7: orders by day, partitioned by month; shipments of 1997 replace the days up to the 20th, then counts alone change

def q_upsert_partitions(spark, sf):
    table = PartitionedTable(spark, f"{scratch_path(spark, 'months')}/days", "day", "date_format(day, 'yyyy-MM')")
    orders = _t(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").alias("v"))
    items = _t(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day"), F.col("l_extendedprice").alias("v"))
    per_day = lambda df: df.groupBy("day").agg(F.max("v").alias("top"), F.count(F.lit(1)).alias("n"))
    table.upsert(per_day(orders))
    table.upsert(per_day(items.where((F.year("day") == 1997) & (F.dayofmonth("day") <= 20))))
    table.upsert(per_day(items.where(F.col("day").between("1999-03-01", "1999-03-20"))), update_cols=["n"])
    return table.read()


SQL_UPSERT_PARTITIONS = """
WITH o AS (SELECT CAST(o_orderdate AS DATE) AS day, max(o_totalprice) AS top, count(*) AS n FROM orders GROUP BY 1),
l AS (SELECT CAST(l_shipdate AS DATE) AS day, max(l_extendedprice) AS top, count(*) AS n FROM lineitem GROUP BY 1),
c AS (SELECT * FROM l WHERE year(day) = 1997 AND day(day) <= 20),
k AS (SELECT * FROM l WHERE day BETWEEN DATE '1999-03-01' AND DATE '1999-03-20'),
b AS (SELECT * FROM c UNION ALL SELECT * FROM o WHERE day NOT IN (SELECT day FROM c))
SELECT coalesce(b.day, k.day) AS day, CASE WHEN b.day IS NULL THEN k.top ELSE b.top END AS top, coalesce(k.n, b.n) AS n
FROM b FULL JOIN k ON b.day = k.day"""


# ---------------------------------------------------------------------------------------
# Readings CSV -> daily mean -> upsert, loaded twice (the second load changes 5 days)

def q_weather_flow(spark, sf):
    base = scratch_path(spark, "weather")
    ev = _t(spark, sf, "events")
    first = ev.select(F.to_date("ts").alias("date"), F.col("value").alias("temperature"))
    second = ev.where(F.col("ts") >= F.lit("2024-01-26").cast("timestamp_ntz")) \
        .select(F.to_date("ts").alias("date"), (F.col("value") + 1).alias("temperature"))
    first.write.option("header", True).csv(f"{base}/load1")
    second.write.option("header", True).csv(f"{base}/load2")
    table = LakeTable(spark, f"{base}/daily_weather")
    flows.daily_weather_flow(spark, f"{base}/load1", table)
    out = flows.daily_weather_flow(spark, f"{base}/load2", table)
    return out.select("date", F.round("avg_temperature", 6).alias("avg_temperature"))


SQL_WEATHER_FLOW = """
WITH first AS (SELECT CAST(ts AS DATE) AS date, avg(value) AS avg_temperature FROM events GROUP BY 1),
second AS (SELECT CAST(ts AS DATE) AS date, avg(value + 1) AS avg_temperature FROM events
           WHERE ts >= TIMESTAMP '2024-01-26' GROUP BY 1)
SELECT date, round(avg_temperature, 6) AS avg_temperature FROM (
  SELECT * FROM first WHERE date NOT IN (SELECT date FROM second) UNION ALL SELECT * FROM second)"""


# ---------------------------------------------------------------------------------------
# The permit flow end to end on inputs written from orders and customers

RECORD_DESCRIPTION = """CASE o_orderkey % 3
 WHEN 0 THEN 'Web.  Roof PV solar - ' || CAST(o_custkey % 9 + 1 AS STRING) || '.' || lpad(CAST(o_custkey % 100 AS STRING), 2, '0')
   || 'kW - ' || CAST(o_custkey % 30 + 5 AS STRING) || ' panels'
 WHEN 1 THEN 'Digital.  ' || CAST(o_custkey % 30 + 5 AS STRING) || ' - REC Alpha ' || CAST(200 + o_custkey % 300 AS STRING)
   || ' Watt Modules.'
 ELSE 'Ground mount ' || CAST(o_custkey % 40 + 2 AS STRING) || ' modules' END"""
RECORD_TYPE = "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'Solar Array' ELSE 'Re-Roof' END"
RECORD_USAGE = "CASE WHEN o_orderstatus = 'P' THEN 'Commercial' ELSE 'Residential' END"
PERMIT_URL = """CASE WHEN o_orderkey % 17 = 0 THEN 'https://permits.example/Error.aspx'
 ELSE 'https://permits.example/CapDetail.aspx?id=' || CAST(o_orderkey AS STRING) END"""
PERMIT_HTML = """CASE WHEN o_orderkey % 11 = 0 THEN '<html><body><p>No details</p></body></html>'
 ELSE '<html><body><div class="MoreDetail_ItemCol1"><span>License Number:</span></div>'
   || '<div class="MoreDetail_ItemCol2"><span> L' || CAST(o_custkey AS STRING) || ' </span></div></body></html>' END"""
REGISTRY_HTML = """'<table><tr><td id="MainContent_BusInfo"> '
 || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END || '<br>' || CAST(c_custkey AS STRING) || ' Main St</td></tr></table>'"""
FLOW_RUN_DATE = "1997-03-15"


def permit_flow_inputs(spark, sf, base: str) -> dict:
    """Write the record list and registry CSVs under ``base`` and derive the captured pages;
    returns the keyword arguments of ``flows.permit_flow`` (without paths of its outputs)."""
    orders = _t(spark, sf, "orders")
    customer = _t(spark, sf, "customer")
    (orders.select(
        S.format_date("o_orderdate", "form").alias("Date"),
        F.concat(F.lit("P"), F.col("o_orderkey").cast("string")).alias("Permit Number"),
        F.expr(RECORD_TYPE).alias("Permit Type"),
        F.expr(RECORD_USAGE).alias("Usage"),
        F.expr(RECORD_DESCRIPTION).alias("Description"),
        F.concat(F.col("o_custkey").cast("string"), F.lit(" Main St")).alias("Address"),
        F.col("o_orderstatus").alias("Status"),
        F.lit(None).cast("string").alias(""))
     .write.option("header", True).csv(f"{base}/records"))
    (customer.where(F.col("c_nationkey") < 12)
     .select(F.concat(F.lit("L"), F.col("c_custkey").cast("string")).alias("LicenseNo"),
             F.col("c_name").alias("BusinessName"), F.col("c_mktsegment").alias("Classification"))
     .write.option("header", True).csv(f"{base}/registry"))
    permit_pages = orders.select(F.concat(F.lit("P"), F.col("o_orderkey").cast("string")).alias("permit_number"),
                                 F.expr(PERMIT_URL).alias("url"), F.expr(PERMIT_HTML).alias("html"))
    registry_pages = customer.where(F.col("c_nationkey") >= 12).select(
        F.concat(F.lit("L"), F.col("c_custkey").cast("string")).alias("license_no"),
        F.concat(F.lit("https://registry.example/check?code="), F.col("c_custkey").cast("string")).alias("url"),
        F.expr(REGISTRY_HTML).alias("html"))
    return {"record_csv": f"{base}/records", "permit_pages": permit_pages, "registry_csv": f"{base}/registry",
            "registry_pages": registry_pages, "run_date": FLOW_RUN_DATE}


def _permit_flow(spark, sf) -> flows.PermitFlowResult:
    base = scratch_path(spark, "permits")
    return flows.permit_flow(spark, batch_dir=f"{base}/batches", lake_root=f"{base}/lake", stamp="19970315_120000",
                             **permit_flow_inputs(spark, sf, base))


def q_permit_flow(spark, sf):
    return _permit_flow(spark, sf).permit_results_installer.read()


def q_permit_results(spark, sf):
    return _permit_flow(spark, sf).permit_results.read().select(
        "date", "permit_number", "permit_type", "usage", "description", "address", "status", "license_no")


def q_permit_installers(spark, sf):
    return _permit_flow(spark, sf).installers.read().select("license_no", "business_name")


def q_permit_details(spark, sf):
    details = _permit_flow(spark, sf).permit_details.read()
    return details.withColumn("violations", F.array_join("violations", ","))


SQL_PERMIT_FLOW = f"""
WITH rec AS (SELECT 'P' || CAST(o_orderkey AS VARCHAR) AS permit_number,
    CASE WHEN o_orderkey % 17 = 0 OR o_orderkey % 11 = 0 THEN NULL ELSE 'L' || CAST(o_custkey AS VARCHAR) END AS license_no
  FROM orders
  WHERE o_orderdate >= TIMESTAMP '1997-02-01' AND o_orderdate < TIMESTAMP '1997-03-01'
    AND {RECORD_USAGE} = 'Residential' AND {RECORD_TYPE} = 'Solar Array'),
reg AS (SELECT 'L' || CAST(c_custkey AS VARCHAR) AS license_no, c_name AS business_name FROM customer WHERE c_nationkey < 12),
look AS (SELECT 'L' || CAST(c_custkey AS VARCHAR) AS license_no,
                CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END AS business_name
         FROM customer WHERE c_nationkey >= 12),
missing AS (SELECT DISTINCT license_no FROM rec WHERE license_no IS NOT NULL
            AND license_no NOT IN (SELECT license_no FROM reg)),
resolved AS (SELECT license_no, business_name FROM look
             WHERE license_no IN (SELECT license_no FROM missing) AND business_name <> ''),
grown AS (SELECT * FROM reg UNION ALL SELECT * FROM resolved)
SELECT g.license_no, r.permit_number, g.business_name FROM rec r JOIN grown g ON r.license_no = g.license_no"""


_SQL_RECORDS = f"""
SELECT CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS date, 'P' || CAST(o_orderkey AS VARCHAR) AS permit_number,
    {RECORD_TYPE} AS permit_type, {RECORD_USAGE} AS usage, {RECORD_DESCRIPTION} AS description,
    CAST(o_custkey AS VARCHAR) || ' Main St' AS address, o_orderstatus AS status,
    CASE WHEN o_orderkey % 17 = 0 OR o_orderkey % 11 = 0 THEN NULL ELSE 'L' || CAST(o_custkey AS VARCHAR) END AS license_no
  FROM orders
  WHERE o_orderdate >= TIMESTAMP '1997-02-01' AND o_orderdate < TIMESTAMP '1997-03-01'
    AND {RECORD_USAGE} = 'Residential' AND {RECORD_TYPE} = 'Solar Array'"""

SQL_PERMIT_INSTALLERS = SQL_PERMIT_FLOW[:SQL_PERMIT_FLOW.index("SELECT g.license_no")] + "SELECT license_no, business_name FROM grown"


def _sql_permit_details() -> str:
    from recordlake.plans.queries import sql_checked_details

    return sql_checked_details(f"SELECT permit_number, description FROM ({_SQL_RECORDS})")


def queries():
    return {
        "q_csv_roundtrip": q_csv_roundtrip,
        "q_upsert_partitions": q_upsert_partitions,
        "q_table_roundtrip": q_table_roundtrip,
        "q_incremental_append": q_incremental_append,
        "q_batched_progress": q_batched_progress,
        "q_weather_flow": q_weather_flow,
        "q_permit_flow": q_permit_flow,
        "q_permit_results": q_permit_results,
        "q_permit_installers": q_permit_installers,
        "q_permit_details": q_permit_details,
    }


def oracle_sql():
    return {
        "q_csv_roundtrip": SQL_CSV_ROUNDTRIP,
        "q_upsert_partitions": SQL_UPSERT_PARTITIONS,
        "q_table_roundtrip": SQL_TABLE_ROUNDTRIP,
        "q_incremental_append": SQL_INCREMENTAL_APPEND,
        "q_batched_progress": SQL_BATCHED_PROGRESS,
        "q_weather_flow": SQL_WEATHER_FLOW,
        "q_permit_flow": SQL_PERMIT_FLOW,
        "q_permit_results": _SQL_RECORDS,
        "q_permit_installers": SQL_PERMIT_INSTALLERS,
        "q_permit_details": _sql_permit_details(),
    }

