"""Command-line steps, one per step of the record flows.

    python -m recordlake append   --batch-dir B --table T --run-date 20250708 [--key permit_number]
    python -m recordlake resolve  --results T --registry-csv R --registry-pages P --registry-table I --out O
    python -m recordlake extract  --results T --out D
    python -m recordlake weather  --csv W --table T
    python -m recordlake permits  --records C --permit-pages P --registry-csv R --registry-pages Q \
                                  --batch-dir B --lake L --run-date 2025-07-15 --stamp 20250715_020000

On a cluster: ``spark-submit --py-files recordlake.zip recordlake/__main__.py <step> ...``. The
session comes from ``SparkSession.builder.getOrCreate()``, so cluster settings are those of
``spark-submit``. Each step prints one JSON line with its counters.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F


def _append(spark, a) -> dict:
    from recordlake.operators.joins import append_first_wins
    from recordlake.operators.project import canonical_names
    from recordlake.sinks.table import LakeTable
    from recordlake.plans.flows import RECORD_COLUMNS
    from recordlake.sources.files import has_batches, scan_batches_for

    table = LakeTable(spark, a.table)
    if not has_batches(spark, a.batch_dir, a.run_date):  # a day without batches is a normal day
        return {"appended": 0}
    batch = canonical_names(scan_batches_for(spark, a.batch_dir, a.run_date), RECORD_COLUMNS)
    stored = table.read() if table.exists() else None
    new = append_first_wins(batch, stored, a.key, "batch_file").drop("batch_file")
    return {"appended": table.create_if_missing_or_append(new).get["rows"]}


def _resolve(spark, a) -> dict:
    from recordlake.operators import joins, pages, project
    from recordlake.sinks.table import LakeTable
    from recordlake.sources.files import scan_csv_strings

    registry = LakeTable(spark, a.registry_table)
    if not registry.exists():
        reg = project.rename(scan_csv_strings(spark, a.registry_csv).select("LicenseNo", "BusinessName"),
                             {"LicenseNo": "license_no", "BusinessName": "business_name"})
        registry.create_or_replace(joins.dedupe_by_key(reg.where(F.col("license_no").isNotNull()), "license_no"))
    out = LakeTable(spark, a.out)
    results = LakeTable(spark, a.results).read().select("permit_number", "license_no")
    pending = joins.new_rows(results, out.read().select("permit_number"), "permit_number") if out.exists() else results
    page_frame = spark.read.parquet(a.registry_pages)

    def look_up(missing):  # evaluated once: what is resolved and what is enriched read the checkpoint
        missing = missing.checkpoint(eager=True)
        return pages.code_to_name(page_frame.join(missing, "license_no", "left_semi"), "license_no").checkpoint(eager=True)

    enriched, resolved, _ = joins.resolve_and_grow_registry(
        pending, registry.read(), look_up, "license_no", "business_name")
    enriched = enriched.select("license_no", "permit_number", "business_name").checkpoint(eager=True)
    return {"resolved": registry.append(resolved).get["rows"],
            "enriched": out.create_if_missing_or_append(enriched).get["rows"]}


def _extract(spark, a) -> dict:
    from recordlake.operators.extract import extract_new
    from recordlake.sinks.table import LakeTable

    out = LakeTable(spark, a.out)
    done = out.read().select("permit_number") if out.exists() else None
    results = LakeTable(spark, a.results).read().select("permit_number", "description")
    details = extract_new(results, done, "permit_number", "description")
    return {"extracted": out.create_if_missing_or_append(details).get["rows"]}


def _weather(spark, a) -> dict:
    from recordlake.plans.flows import daily_weather_flow
    from recordlake.sinks.table import LakeTable

    out = daily_weather_flow(spark, a.csv, LakeTable(spark, a.table))
    return {"days": out.count()}


def _permits(spark, a) -> dict:
    from recordlake.plans.flows import permit_flow

    res = permit_flow(spark, record_csv=a.records, permit_pages=spark.read.parquet(a.permit_pages),
                      registry_csv=a.registry_csv, registry_pages=spark.read.parquet(a.registry_pages),
                      batch_dir=a.batch_dir, lake_root=a.lake, run_date=a.run_date, stamp=a.stamp,
                      resume_csv=a.resume)
    counters: dict = {}
    for name, value in res.reports.items():
        if isinstance(value, Observation):
            counters[name] = value.get["rows"]
        else:
            counters.update(value)  # one-row reports: missing / total / ratio, resolution counts
    return counters


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="recordlake")
    sub = p.add_subparsers(dest="step", required=True)
    s = sub.add_parser("append", help="append a run date's batches, first file wins")
    s.add_argument("--batch-dir", required=True)
    s.add_argument("--table", required=True)
    s.add_argument("--run-date", required=True, help="yyyyMMdd")
    s.add_argument("--key", default="permit_number")
    s = sub.add_parser("resolve", help="resolve licences against the registry, growing it from pages")
    for name in ("--results", "--registry-csv", "--registry-pages", "--registry-table", "--out"):
        s.add_argument(name, required=True)
    s = sub.add_parser("extract", help="typed details for records not extracted yet")
    s.add_argument("--results", required=True)
    s.add_argument("--out", required=True)
    s = sub.add_parser("weather", help="daily means upserted by day")
    s.add_argument("--csv", required=True)
    s.add_argument("--table", required=True)
    s = sub.add_parser("permits", help="the whole monthly permit flow")
    for name in ("--records", "--permit-pages", "--registry-csv", "--registry-pages", "--batch-dir", "--lake",
                 "--run-date", "--stamp"):
        s.add_argument(name, required=True)
    s.add_argument("--resume")
    return p


STEPS = {"append": _append, "resolve": _resolve, "extract": _extract, "weather": _weather, "permits": _permits}


def main(argv=None, spark: SparkSession | None = None) -> dict:
    args = parser().parse_args(argv)
    session = spark or SparkSession.builder.appName(f"recordlake-{args.step}").getOrCreate()
    counters = STEPS[args.step](session, args)
    print(json.dumps({"step": args.step, **counters}, default=str))
    return counters
