import html
import time

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan_text
from recordlake.functions import html as H
from recordlake.operators.pages import code_to_name, permit_to_license
from recordlake.plans import derive as D

LABELLED = ('<div class="{c}"><span>License Number:</span></div><div><span>{v}</span></div>')


def values(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    return [r.v for r in df.select("i", H.extract_label_value("html").alias("v")).orderBy("i").collect()]


def test_references_as_browsers_read_them(spark):
    cells = ["Caf&eacute; &#8217;12", "&amp;lt; &AMP; &copy2024 &notit; &notin; &nosuch; & &; &#; &#x; &#xZ", "&#x1F600;&#128512;&#0;&#128;&#x9f;&#55296;&#1114112;&#99999999999;&#1;&#13;x&#xFDD0;x",
             "&fjlig; &NotEqualTilde; a&lt&gtb &#65 &#65x &#x41;", "&" * 50, "&amp" * 40]
    df = spark.createDataFrame(list(enumerate(cells)), "i int, t string")
    got = [r.v for r in df.select("i", H.decoded(F.col("t")).alias("v")).orderBy("i").collect()]
    assert got == [html.unescape(c) for c in cells]
    assert values(spark, [LABELLED.format(c=H.LABEL_CLASS, v=cells[0])]) == ["Café ’12"]


def test_references_of_any_text(spark):
    seen = []
    piece = st.one_of(st.sampled_from(["&", "#", "x", ";", "amp", "lt", "notin", "eacute", "Aacute", "8217", "0", " ", "<", "é"]), st.text(max_size=3))

    @settings(max_examples=400, deadline=None, database=None)
    @given(st.lists(piece, max_size=8).map("".join))
    def collect(text):
        if not any(0xD800 <= ord(c) <= 0xDFFF for c in text):
            seen.append(text)
    collect()
    df = spark.createDataFrame(list(enumerate(seen)), "i int, t string")
    got = [r.v for r in df.select("i", H.decoded(F.col("t")).alias("v")).orderBy("i").collect()]
    assert got == [html.unescape(t) for t in seen]


def test_time_is_linear_in_hostile_pages(spark):
    good = LABELLED.format(c=H.LABEL_CLASS, v="7")

    def seconds(shape, n):
        df = spark.createDataFrame([(shape * n + good,)], "html string").repartition(1).cache()
        df.count()
        began = time.time()
        assert df.select(H.extract_label_value("html")).first()[0] == "7"
        assert df.select(H.extract_first_line("html", "article", None)).first()[0] is None
        return time.time() - began

    for shape in ("<div class=MoreDetail_ItemCol1 ", "<", "<div class='", "<span>License Number:</span>", "<div class=MoreDetail_ItemCol1><span>License Number:"):
        seconds(shape, 100)
        assert seconds(shape, 10_000) < 5, shape


def test_each_pattern_is_in_the_plan_once(spark):
    rows = spark.createDataFrame([(1, "u", "<p>")], "k long, url string, html string")
    for df in (permit_to_license(rows, "k"), code_to_name(rows, "k"), permit_to_license(rows, "k").where("status = 'ok'")):
        optimized = plan_text(df, "extended").split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
        assert optimized.count("regexp_extract_all(html") == 1, optimized


def test_markup_around_the_label(spark):
    c = H.LABEL_CLASS
    cases = [
        ("<!-- x --><div data-class='x' class=\"" + c + "\" >\n<span id=s>license\n number:</span>\n</div>\n<div><span>1</span></div>", "1"),
        (LABELLED.format(c=c, v="a < b"), "a < b"),
        (LABELLED.format(c=c, v="1")[:-6], None),                          # the cell is cut off
        (LABELLED.format(c="x", v="1") + LABELLED.format(c=c, v="2"), "2"),   # a label of another class
        ("<p>License Number:</p>" + LABELLED.format(c=c, v="3"), "3"),
        (LABELLED.format(c=c, v="4") + LABELLED.format(c=c, v="5"), "4"),
        ("<div class=" + c, None),
    ]
    assert values(spark, [h for h, _ in cases]) == [v for _, v in cases]


def test_detail_pages_say_what_they_were_written_from(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = pages.select(H.extract_label_value(F.expr(D.PAGE_WITH_DETAIL)).alias("v"), F.expr(D.PAGE_DETAIL_VALUE).alias("w"))
    assert got.where("not v <=> w").count() == 0
