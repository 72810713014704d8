"""Composite flows (D1, D2) as plain functions over DataFrames and tables.

Each step is one of the library's operators; the only driver-side work is choosing paths
and reading a few counters from ``Observation``s. No data passes through the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.functions.scalars import previous_month_range
from recordlake.operators import aggs, joins, pages, project, setops
from recordlake.operators.extract import BatchFn, extract_new
from recordlake.sinks.table import LakeTable, batch_path, batch_written, write_batch
from recordlake.sources.files import (
    scan_batches_for,
    scan_csv_dates,
    scan_csv_inferred,
    scan_csv_strings,
    scan_optional,
)
from recordlake.streaming.incremental import resume

# --------------------------------------------------------------------------------------
# Daily mean -> keyed upsert

WEATHER_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("temperature", T.DoubleType()),
])


def daily_weather_flow(spark: SparkSession, csv_path: str, table: LakeTable,
                       schema: T.StructType = WEATHER_SCHEMA) -> DataFrame:
    """CSV readings -> mean per day -> upsert keyed by day (D2: S1, A1, O2, K6).

    Returns the stored table ordered by day.
    """
    readings = scan_csv_inferred(spark, csv_path, schema)
    means = aggs.daily_mean(readings, "date", "temperature", "avg_temperature")
    table.upsert(means, "date")
    return setops.order_by_key(table.read(), "date")


# --------------------------------------------------------------------------------------
# Record list -> look-ups -> batches -> first-wins append -> registry -> details

# Canonical names of the record list columns (Q1, Q2).
RECORD_COLUMNS = {
    "Date": "date",
    "Permit Number": "permit_number",
    "Permit Type": "permit_type",
    "Usage": "usage",
    "Description": "description",
    "Address": "address",
    "Status": "status",
    "Installer Number": "license_no",
}
# The search form criteria and the look-up batch size.
SEARCH_USAGE = "Residential"
SEARCH_TYPE = "Solar Array"
BATCH_SIZE = 50

# The header of a resume file.
RESUME_FILE = T.StructType([
    T.StructField("Permit Number", T.StringType()),
    T.StructField("Installer Number", T.StringType()),
])
FILE_ROW = "file_row"


@dataclass
class PermitFlowResult:
    permit_results: LakeTable
    installers: LakeTable
    permit_results_installer: LakeTable
    permit_details: LakeTable
    # one-row aggregates (missing, resolution) and Observations (appended, resolved, ...)
    reports: dict = field(default_factory=dict)


def load_record_list(spark: SparkSession, csv_path: str, run_date: str) -> DataFrame:
    """The previous month's residential solar records, canonical names.

    ``file_row`` ascends in file order (a unique key, as a permit may be listed twice on one day).
    """
    raw = project.drop_unnamed(scan_csv_dates(spark, csv_path, "Date"))
    records = project.canonical_names(raw, RECORD_COLUMNS).withColumn(FILE_ROW, F.monotonically_increasing_id())
    start, end = previous_month_range(F.lit(run_date).cast("date"))
    return project.search_records(records, "date", start, end,
                                  {"usage": SEARCH_USAGE, "permit_type": SEARCH_TYPE})


def permit_flow(spark: SparkSession, record_csv: str, permit_pages: DataFrame, registry_csv: str,
                registry_pages: DataFrame, batch_dir: str, lake_root: str, run_date: str, stamp: str,
                resume_csv: str | None = None, extract_fn: BatchFn | None = None) -> PermitFlowResult:
    """The monthly permit flow (D1), every step a Spark job over whole inputs.

    ``permit_pages(permit_number, url, html)``: captured detail page per permit;
    ``registry_pages(license_no, url, html)``: captured registry page per licence;
    ``stamp``: ``yyyyMMdd_HHmmss`` of this run's batch (its date part should be ``run_date``'s day).

    The stamp names the run. Its batch and its appends carry it, and each counts once it has committed, so a run that
    died is started again with the same stamp: it does not repeat its look-ups or any write that is done (rows with null keys,
    which match nothing, included), and the tables become those of a run without a failure. The counters are then those
    of what the run stored in all its attempts, but for ``resolution``, which covers the look-ups of the last one.
    """
    lake = lake_root.rstrip("/")
    permit_results = LakeTable(spark, f"{lake}/permit_results")
    installers = LakeTable(spark, f"{lake}/installers")
    enriched_t = LakeTable(spark, f"{lake}/permit_results_installer")
    details_t = LakeTable(spark, f"{lake}/permit_details_extracted")
    reports: dict = {}

    resumed = scan_optional(spark, resume_csv, RESUME_FILE) if resume_csv else spark.createDataFrame([], RESUME_FILE)
    resumed = project.rename(resumed, {"Permit Number": "permit_number", "Installer Number": "license_no"})
    if batch_written(spark, batch_dir, stamp):  # by an attempt of this run that died later
        own = aggs.missing_report(spark.read.parquet(batch_path(batch_dir, stamp)), "license_no").first()
        missing, total = own["missing"], own["total"]
    else:
        # 1. record list, positional batches of 50 cut before seen records are removed
        records = load_record_list(spark, record_csv, run_date)
        numbered = project.number_batches(records, FILE_ROW, BATCH_SIZE, "batch_seq").drop(FILE_ROW)
        # results of earlier runs: the resume file (if any) and the stored output table
        prior = resumed
        if permit_results.exists():
            prior = prior.unionByName(permit_results.read().select("permit_number", "license_no"))
        todo = resume(numbered, prior, "permit_number")

        # 2. look-ups from captured pages of this batch only, attached to the batch
        wanted = permit_pages.join(todo.select("permit_number").distinct(), "permit_number", "left_semi")
        found = pages.permit_to_license(wanted, "permit_number")
        batch = joins.attach_results(todo, found.select("permit_number", "license_no"), "permit_number")

        # 3. the run's batch, counted while it is written (A4 in the same pass), then the files of
        #    the run date, first file wins
        counts = Observation("missing")
        written = batch.withColumn("batch_seq", F.lpad(F.col("batch_seq").cast("string"), 9, "0")).observe(
            counts, F.count_if(F.col("license_no").isNull()).alias("missing"), F.count(F.lit(1)).alias("total"))
        write_batch(written, batch_dir, stamp, replace_unfinished=True)
        missing, total = counts.get["missing"], counts.get["total"]
    if resume_csv:  # the report covers this run and what it resumed, not the stored history
        earlier = aggs.missing_report(resumed, "license_no").first()
        missing, total = missing + earlier["missing"], total + earlier["total"]
    reports["missing"] = {"missing": missing, "total": total, "missing_ratio": missing / total if total else None}
    scanned = scan_batches_for(spark, batch_dir, run_date.replace("-", ""))
    scanned = scanned.withColumn("_rl_order", F.concat_ws("#", "batch_file", "batch_seq"))
    stored = permit_results.read() if permit_results.exists() else None
    new = joins.append_first_wins(scanned, stored, "permit_number", "_rl_order").drop("_rl_order")
    reports["appended"] = permit_results.create_if_missing_or_append(new, stamp)

    # 4. registry: create from CSV if missing, resolve unknown codes, enrich
    if not installers.exists():
        reg = scan_csv_strings(spark, registry_csv)
        reg = project.rename(reg.select("LicenseNo", "BusinessName"),
                             {"LicenseNo": "license_no", "BusinessName": "business_name"})
        # one entry per licence, so the enrichment join never multiplies permits
        installers.create_or_replace(joins.dedupe_by_key(reg.where(F.col("license_no").isNotNull()), "license_no"))
    results = permit_results.read().select("permit_number", "license_no")
    done = enriched_t.read().select("permit_number") if enriched_t.exists() else None
    pending = joins.new_rows(results, done, "permit_number") if done is not None else results
    registry = installers.read()
    looked_up: dict = {}

    def look_up(missing: DataFrame) -> DataFrame:
        # captured registry pages of the missing licences only, then the name extraction (H5)
        # (evaluated once: the report, the registry and the enrichment read the checkpoint)
        missing = missing.checkpoint(eager=True)
        found = pages.code_to_name(registry_pages.join(missing, "license_no", "left_semi"), "license_no").checkpoint(eager=True)
        looked_up["codes"], looked_up["found"] = missing, found
        return found.select("license_no", "business_name")

    enriched, resolved, _ = joins.resolve_and_grow_registry(
        pending, registry, look_up, "license_no", "business_name")
    # every licence that needed a look-up; one without a captured page counts as unresolved (A5)
    outcome = looked_up["codes"].join(
        joins.dedupe_by_key(looked_up["found"].select("license_no", "business_name"), "license_no"),
        "license_no", "left")
    reports["resolution"] = aggs.resolution_report(outcome, "business_name").first().asDict()
    # the enriched rows read the registry before the append below; materialize them first
    enriched = enriched.select("license_no", "permit_number", "business_name").checkpoint(eager=True)
    reports["resolved"] = installers.append(resolved, stamp)
    reports["enriched"] = enriched_t.create_if_missing_or_append(enriched, stamp)

    # 5. details for records not extracted yet
    extracted = details_t.read().select("permit_number") if details_t.exists() else None
    details = extract_new(permit_results.read().select("permit_number", "description"), extracted,
                          "permit_number", "description", extract_fn)
    reports["extracted"] = details_t.create_if_missing_or_append(details, stamp)
    return PermitFlowResult(permit_results, installers, enriched_t, details_t, reports)
