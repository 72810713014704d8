from pyspark.sql import functions as F

from conftest import rows
from recordlake.cli import main
from recordlake.sinks.table import LakeTable
from recordlake.sinks.table import write_batch


def test_steps_end_to_end(spark, tmp_dir):
    # two batches of one day with an overlapping permit, written like the collector does
    recs = spark.createDataFrame(
        [("P1", "L1", "Web. Roof PV - 5.5kW - 14 panels"), ("P2", "L9", "Ground mount 20 modules 400W"),
         ("P3", None, "nothing")], "`Permit Number` string, `Installer Number` string, Description string")
    write_batch(recs, f"{tmp_dir}/b", "20250708_100000")
    write_batch(recs.where(F.col("Permit Number") == "P1"), f"{tmp_dir}/b", "20250708_110000")
    out = main(["append", "--batch-dir", f"{tmp_dir}/b", "--table", f"{tmp_dir}/lake/results",
                "--run-date", "20250708"], spark)
    assert out == {"appended": 3}
    assert "license_no" in LakeTable(spark, f"{tmp_dir}/lake/results").read().columns
    # a day without batches is a normal day
    assert main(["append", "--batch-dir", f"{tmp_dir}/b", "--table", f"{tmp_dir}/lake/results",
                 "--run-date", "20250709"], spark) == {"appended": 0}
    assert main(["append", "--batch-dir", f"{tmp_dir}/b", "--table", f"{tmp_dir}/lake/results",
                 "--run-date", "20250708"], spark) == {"appended": 0}

    import os

    from recordlake.session import local_path
    os.makedirs(local_path(f"{tmp_dir}/reg"), exist_ok=True)
    with open(local_path(f"{tmp_dir}/reg/r.csv"), "w") as fh:
        fh.write("LicenseNo,BusinessName,Other\nL1,ACME,x\n")
    spark.createDataFrame([("L9", "https://r/check", '<td id="MainContent_BusInfo"> SUN CO<br>addr</td>')],
                          "license_no string, url string, html string").write.parquet(f"{tmp_dir}/pages")
    got = main(["resolve", "--results", f"{tmp_dir}/lake/results", "--registry-csv", f"{tmp_dir}/reg",
                "--registry-pages", f"{tmp_dir}/pages", "--registry-table", f"{tmp_dir}/lake/installers",
                "--out", f"{tmp_dir}/lake/enriched"], spark)
    assert got == {"resolved": 1, "enriched": 2}
    assert rows(LakeTable(spark, f"{tmp_dir}/lake/enriched").read(), "permit_number", "business_name") == [
        ("P1", "ACME"), ("P2", "SUN CO")]
    assert main(["extract", "--results", f"{tmp_dir}/lake/results", "--out", f"{tmp_dir}/lake/details"],
                spark) == {"extracted": 3}
    details = LakeTable(spark, f"{tmp_dir}/lake/details").read()
    assert rows(details, "permit_number", "permit_type", "module_count") == [
        ("P1", "Roof Mount", 14), ("P2", "Ground Mount", 20), ("P3", None, None)]


def test_weather_and_permits_steps(spark, tmp_dir):
    import os

    from recordlake.plans.storage_queries import permit_flow_inputs
    from recordlake.session import local_path

    os.makedirs(local_path(f"{tmp_dir}/w"), exist_ok=True)
    with open(local_path(f"{tmp_dir}/w/w.csv"), "w") as fh:
        fh.write("date,temperature\n2024-06-01,75\n2024-06-01,80\n2024-06-02,65\n2024-06-02,70\n")
    assert main(["weather", "--csv", f"{tmp_dir}/w", "--table", f"{tmp_dir}/daily"], spark) == {"days": 2}

    args = permit_flow_inputs(spark, "/root/testdata/sf0.001", f"{tmp_dir}/in")
    args["permit_pages"].write.parquet(f"{tmp_dir}/in/permit_pages")
    args["registry_pages"].write.parquet(f"{tmp_dir}/in/registry_pages")
    got = main(["permits", "--records", args["record_csv"], "--permit-pages", f"{tmp_dir}/in/permit_pages",
                "--registry-csv", args["registry_csv"], "--registry-pages", f"{tmp_dir}/in/registry_pages",
                "--batch-dir", f"{tmp_dir}/batches", "--lake", f"{tmp_dir}/lake", "--run-date", args["run_date"],
                "--stamp", "19970315_120000"], spark)
    assert got["appended"] > 0 and got["extracted"] == got["appended"] and got["total"] == got["appended"]
