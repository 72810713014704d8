import pytest
from pyspark.sql import functions as F

from conftest import rows
from recordlake.plans import flows
from recordlake.plans.storage_queries import permit_flow_inputs
from recordlake.session import scratch_path
from recordlake.sinks.table import LakeTable

SF = "/root/testdata/sf0.001"


def snapshot(res):
    return {name: rows(getattr(res, name).read()) for name in
            ("permit_results", "installers", "permit_results_installer", "permit_details")}


def test_permit_flow_second_run_adds_nothing(spark, tmp_dir):
    args = permit_flow_inputs(spark, SF, tmp_dir)
    first = flows.permit_flow(spark, batch_dir=f"{tmp_dir}/batches", lake_root=f"{tmp_dir}/lake",
                              stamp="19970315_120000", **args)
    before = snapshot(first)
    assert first.reports["appended"].get["rows"] == len(before["permit_results"]) > 0
    assert before["permit_details"] and before["permit_results_installer"]
    res = first.reports["resolution"]
    assert res["looked_up"] == res["resolved"] + res["unresolved"] and res["resolved"] > 0
    assert first.reports["resolved"].get["rows"] == res["resolved"]
    miss = first.reports["missing"]
    assert miss["total"] == len(before["permit_results"]) and 0 < miss["missing"] < miss["total"]
    n_null = sum(1 for r in first.permit_results.read().collect() if r.license_no is None)
    assert miss["missing"] == n_null
    second = flows.permit_flow(spark, batch_dir=f"{tmp_dir}/batches", lake_root=f"{tmp_dir}/lake",
                               stamp="19970315_130000", **args)
    assert second.reports["appended"].get["rows"] == 0
    # the report covers this run, which had nothing left to look up
    assert second.reports["missing"] == {"missing": 0, "total": 0, "missing_ratio": None}
    assert second.reports["enriched"].get["rows"] == 0
    assert second.reports["extracted"].get["rows"] == 0
    assert snapshot(second) == before
    # every stored permit has exactly one detail row
    details = [r.permit_number for r in first.permit_details.read().collect()]
    stored = [r.permit_number for r in first.permit_results.read().collect()]
    assert sorted(details) == sorted(stored) and len(set(details)) == len(details)


@pytest.fixture(scope="module")
def undisturbed(spark):
    """The inputs, with two records without a number, and the tables of a run without a failure."""
    base = scratch_path(spark, "restart")
    args = permit_flow_inputs(spark, SF, base)
    listed = spark.read.option("header", True).csv(args["record_csv"])
    nameless = listed.where("Usage = 'Residential' and `Permit Type` = 'Solar Array'").limit(400).withColumn(
        "Permit Number", F.when(F.col("Permit Number").endswith("1"), F.col("Permit Number")))
    nameless.unionByName(listed).write.option("header", True).csv(f"{base}/records2")
    args["record_csv"] = f"{base}/records2"
    res = flows.permit_flow(spark, batch_dir=f"{base}/batches", lake_root=f"{base}/lake", stamp="19970315_120000", **args)
    assert res.permit_results.read().where("permit_number is null").count() > 1
    return args, snapshot(res), res.reports["missing"]


# the writes of a run: batch, permits, registry, resolved licences, enriched permits (details are the last)
@pytest.mark.parametrize("after", [1, 2, 3, 4, 5])
def test_a_run_that_died_goes_on_where_it_stopped(spark, tmp_dir, monkeypatch, undisturbed, after):
    args, want, missing = undisturbed
    paths = dict(batch_dir=f"{tmp_dir}/batches", lake_root=f"{tmp_dir}/lake", stamp="19970315_120000")
    done = []

    def dies(write):
        def run(*a, **k):
            out = write(*a, **k)
            done.append(write.__name__)
            if len(done) == after:
                raise RuntimeError("driver lost")
            return out
        return run

    with monkeypatch.context() as m:
        m.setattr(flows, "write_batch", dies(flows.write_batch))
        m.setattr(LakeTable, "create_or_replace", dies(LakeTable.create_or_replace))
        m.setattr(LakeTable, "append", dies(LakeTable.append))
        with pytest.raises(RuntimeError, match="driver lost"):
            flows.permit_flow(spark, **paths, **args)
    assert len(done) == after
    looked_up = []
    monkeypatch.setattr(flows.pages, "permit_to_license", lambda *a: looked_up.append(a))
    res = flows.permit_flow(spark, **paths, **args)
    assert not looked_up  # the permits of the batch are not looked up again
    assert snapshot(res) == want
    assert res.reports["missing"] == missing
    assert res.reports["appended"].get["rows"] == len(want["permit_results"])
    assert res.reports["extracted"].get["rows"] == len(want["permit_details"])


def test_an_unfinished_batch_is_written_again(spark, tmp_dir):
    import os

    from recordlake.session import local_path
    from recordlake.sinks.table import batch_path, batch_written, write_batch

    df = spark.range(10)
    path = write_batch(df, tmp_dir, "20250101_000000")
    assert path == batch_path(tmp_dir, "20250101_000000") and batch_written(spark, tmp_dir, "20250101_000000")
    with pytest.raises(Exception, match="exist"):
        write_batch(df, tmp_dir, "20250101_000000", replace_unfinished=True)  # it is finished
    os.remove(os.path.join(local_path(path), "_SUCCESS"))
    assert not batch_written(spark, tmp_dir, "20250101_000000")
    with pytest.raises(Exception, match="exist"):
        write_batch(df, tmp_dir, "20250101_000000")
    write_batch(spark.range(3), tmp_dir, "20250101_000000", replace_unfinished=True)
    assert spark.read.parquet(path).count() == 3


def test_a_run_appends_once(spark, tmp_dir):
    t = LakeTable(spark, f"{tmp_dir}/t")
    assert t.create_if_missing_or_append(spark.range(3), "r1").get["rows"] == 3
    assert t.create_if_missing_or_append(spark.range(5), "r1").get["rows"] == 3
    assert t.append(spark.range(10, 12), "r2").get["rows"] == 2
    assert t.append(spark.range(10, 12), "r2").get["rows"] == 2
    assert t.append(spark.range(20, 21)).get["rows"] == 1  # a write without a name is one of its own
    assert t.append(spark.range(20, 21)).get["rows"] == 1
    assert rows(t.read()) == [(0,), (1,), (2,), (10,), (11,), (20,), (20,)]
    t.create_or_replace(t.read())  # also after the table has become another version
    assert t.append(spark.range(10, 12), "r2").get["rows"] == 2
    assert t.read().count() == 7
    with pytest.raises(ValueError, match="name of a run"):
        t.append(spark.range(1), "a/b")


def test_resumed_permits_count_once(spark, tmp_dir):
    """A permit in the resume file is not looked up again, and the report counts it with this run."""
    import os

    from recordlake.session import local_path

    args = permit_flow_inputs(spark, SF, tmp_dir)
    listed = [r.permit_number for r in flows.load_record_list(spark, args["record_csv"], args["run_date"]).collect()]
    assert len(listed) > 3
    path = f"{tmp_dir}/resume/r.csv"
    os.makedirs(os.path.dirname(local_path(path)), exist_ok=True)
    with open(local_path(path), "w") as fh:
        fh.write(f"Installer Number,Permit Number\nL1,{listed[0]}\n,{listed[1]}\n")
    res = flows.permit_flow(spark, batch_dir=f"{tmp_dir}/batches", lake_root=f"{tmp_dir}/lake", stamp="19970315_120000",
                            resume_csv=path, **args)
    assert res.reports["appended"].get["rows"] == len(listed) - 2
    assert res.reports["missing"]["total"] == len(listed)


def test_weather_flow_golden(spark, tmp_dir):
    import os

    from recordlake.session import local_path
    from recordlake.sinks.table import LakeTable

    p = local_path(f"{tmp_dir}/w1.csv")
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w") as fh:
        fh.write("date,temperature\n2024-06-01,75\n2024-06-01,80\n2024-06-02,65\n2024-06-02,70\n")
    table = LakeTable(spark, f"{tmp_dir}/daily_weather")
    out = flows.daily_weather_flow(spark, f"{tmp_dir}/w1.csv", table)
    assert [(str(r.date), r.avg_temperature) for r in out.collect()] == [("2024-06-01", 77.5), ("2024-06-02", 67.5)]
    with open(local_path(f"{tmp_dir}/w2.csv"), "w") as fh:
        fh.write("date,temperature\n2024-06-02,60\n2024-06-03,50\n")
    out2 = flows.daily_weather_flow(spark, f"{tmp_dir}/w2.csv", table)
    assert [(str(r.date), r.avg_temperature) for r in out2.collect()] == [
        ("2024-06-01", 77.5), ("2024-06-02", 60.0), ("2024-06-03", 50.0)]
