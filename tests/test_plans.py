"""Plan properties that matter at scale, checked on the physical plan."""

import re

from pyspark.sql import functions as F

from conftest import plan_text
from recordlake.operators import joins

SF = "/root/testdata/sf0.01"


def test_operators_keep_pruning_and_pushdown(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = joins.new_rows(docs, labels, "doc_id").where(F.col("doc_id") > 100).select("doc_id", "lang")
    txt = plan_text(out, "simple")
    file_scans = [ln for ln in txt.splitlines() if "FileScan parquet" in ln]
    assert all("text" not in re.search(r"ReadSchema: struct<([^>]*)>", ln).group(1) for ln in file_scans)
    row_scans = [ln for ln in file_scans if "lang" in ln]
    assert row_scans and all("GreaterThan(doc_id,100)" in ln for ln in row_scans), row_scans
