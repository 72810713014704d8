from pyspark.sql import functions as F

from recordlake.operators.extract import DETAIL_NAMES, extract_details, extract_new, extract_with
from recordlake.plans.queries import batch_rules

# The three worked examples of the source flow, inputs and expected records, in order.
GOLDEN = [
    ("Digital.  19 - REC NPeak2 365 Watt Modules.  1 - SolarEdge HD-Wave 7600H Inverter.  Signed SCMA Affidavit "
     "on file.  Includes two inspections.  Final required.",
     (None, None, None, 365, 19, "REC NPeak2")),
    ("Web.  Roof PV solar on storage building - 9.36kW - 26 panels - 2 batteries (13.5 kWh each). 100' trench. "
     "Includes two inspections.  Final required.",
     (9.36, "Roof Mount", 27.0, None, 26, None)),
    ("Digital: 5.53 Kw - 14 Modules PV roof top solar mount and (1) 13.5Kw Battery to be installed on detached "
     "garage.This permit includes two inspections",
     (5.53, "Roof Mount", 13.5, None, 14, None)),
]
EXTRA = [
    ("", (None, None, None, None, None, None), []),
    (None, (None, None, None, None, None, None), []),
    ("Ground mount, 20 panels 150 W", (None, "Ground Mount", None, None, 20, None), ["module_watts"]),
    ("12 - Acme X 600 Watt Modules", (None, None, None, None, 12, "Acme X"), ["module_watts"]),
    ("99999999999 panels, 400 Watt Modules", (None, None, None, 400, None, None), ["module_count"]),
    ("Ground 99999999999 panels 150 W", (None, "Ground Mount", None, None, None, None), ["module_count", "module_watts"]),
    ("Battery only: 13.5 kWh battery", (None, "Storage only", 13.5, None, None, None), []),
]


def frame(spark, cases):
    return spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "k long, text string")


def test_golden_cases(spark):
    out = extract_details(frame(spark, GOLDEN), "text").orderBy("k").collect()
    for (text, expect), r in zip(GOLDEN, out):
        assert tuple(r[n] for n in DETAIL_NAMES) == expect, text
        assert r.violations == []


def test_extra_cases_and_violations(spark):
    out = extract_details(frame(spark, EXTRA), "text").orderBy("k").collect()
    for (text, expect, viol), r in zip(EXTRA, out):
        assert tuple(r[n] for n in DETAIL_NAMES) == expect, text
        assert r.violations == viol, text


def test_hook_equals_rules(spark):
    descr = spark.read.parquet("/root/testdata/sf0.001/part.parquet").select(
        F.col("p_partkey").alias("k"), F.concat_ws(" ", "p_name", "p_type", F.col("p_size").cast("string"),
                                                   F.lit("kW -"), F.col("p_size").cast("string"), F.lit("panels")).alias("text"))
    cases = frame(spark, GOLDEN + [(t, e) for t, e, _ in EXTRA]).unionByName(descr)
    a = extract_details(cases, "text").orderBy("k")
    b = extract_with(cases, "k", "text", batch_rules).orderBy("k")
    assert [tuple(r) for r in a.collect()] == [tuple(r) for r in b.collect()]


def test_hook_output_is_validated(spark):
    def bad_model(texts):
        return [{"module_watts": 900, "permit_type": "Carport", "module_count": 3} for _ in texts]
    out = extract_with(frame(spark, GOLDEN), "k", "text", bad_model).collect()
    assert all(r.module_watts is None and r.permit_type is None and r.module_count == 3 for r in out)
    assert all(r.violations == ["module_watts", "permit_type"] for r in out)


def test_hook_values_of_no_type_are_violations(spark):
    def odd_model(texts):
        return [{"module_count": 10**12, "system_size": "five", "module_watts": "365", "storage_size": 2}, None, {"module_brand": 7}]
    out = extract_with(frame(spark, GOLDEN).coalesce(1), "k", "text", odd_model).orderBy("k").collect()
    assert [tuple(r[n] for n in DETAIL_NAMES) for r in out] == [(None, None, 2.0, 365, None, None), (None,) * 6, (None,) * 5 + ("7",)]
    assert [r.violations for r in out] == [["system_size", "module_count"], [], []]


def test_extract_new_skips_done(spark):
    res = spark.createDataFrame([("p1", GOLDEN[0][0]), ("p2", GOLDEN[1][0])], "permit_number string, description string")
    done = spark.createDataFrame([("p1",)], "permit_number string")
    out = extract_new(res, done, "permit_number", "description").collect()
    assert [r.permit_number for r in out] == ["p2"] and out[0].module_count == 26


def test_rules_agree_on_generated_descriptions(spark):
    """Catalyst rules and the Python batch function agree on random token sequences."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    tokens = ["12", "7", "365", "150", "600", "9.36", "5.53", "13.5", "(1)", "(2)", "kW", "Kw", "kWh", "kw",
              "W", "Watt", "Watts", "modules", "Modules", "panel", "panels", "battery", "batteries", "each",
              "(13.5 kWh each)", "Roof", "roof", "ground", "Ground", "mount", "-", "REC", "NPeak2", ".", ",",
              "Digital:", "storage", "trench", "100'"]
    text = st.lists(st.sampled_from(tokens), min_size=0, max_size=14).map(" ".join)

    @settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(text, min_size=20, max_size=40))
    def check(texts):
        df = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
        a = [tuple(r) for r in extract_details(df, "text").orderBy("k").collect()]
        b = [tuple(r) for r in extract_with(df, "k", "text", batch_rules).orderBy("k").collect()]
        assert a == b

    check()


def test_hook_must_return_one_record_per_text(spark):
    import pytest

    with pytest.raises(Exception, match="returned 0 records"):
        extract_with(frame(spark, GOLDEN), "k", "text", lambda texts: []).collect()
