
from conftest import rows
from recordlake.functions.html import extract_first_line, extract_label_value
from recordlake.operators.pages import code_to_name, permit_to_license

LABEL = ('<div class="row"><div class="MoreDetail_ItemCol1 w"><span> License   Number: </span></div>\n'
         '<div class="MoreDetail_ItemCol2"><span> 123456 </span></div></div>')
NO_LABEL = '<div class="MoreDetail_ItemCol1"><span>Owner:</span></div><div><span>x</span></div>'
CELL = '<table><tr><td id="MainContent_BusInfo"> ACME SOLAR<br>1 Road</td></tr></table>'


def test_label_value(spark):
    df = spark.createDataFrame([(LABEL,), (NO_LABEL,), ("",), (None,)], "html string")
    assert [r[0] for r in df.select(extract_label_value("html")).collect()] == ["123456", None, None, None]


def test_first_line(spark):
    df = spark.createDataFrame([(CELL,), ('<td id="MainContent_BusInfo">NO BREAK </td>',), ("<td>other</td>",)],
                               "html string")
    assert [r[0] for r in df.select(extract_first_line("html")).collect()] == ["ACME SOLAR", "NO BREAK", None]
    h1 = spark.createDataFrame([("<h1 class='t'> Title <br>x</h1>",)], "html string")
    assert h1.select(extract_first_line("html", "h1", None)).first()[0] == "Title"


def test_permit_status(spark):
    df = spark.createDataFrame([
        (1, "https://x/CapDetail.aspx", LABEL),
        (2, "https://x/Error.aspx", LABEL),
        (3, "https://x/CapDetail.aspx", "<p>nothing</p>"),
        (4, "https://x/CapDetail.aspx", NO_LABEL),
        (5, "https://x/CapDetail.aspx", ""),
    ], "permit_number long, url string, html string")
    out = permit_to_license(df, "permit_number")
    assert rows(out) == [(1, "123456", "ok"), (2, None, "error_page"), (3, None, "missing_section"),
                         (4, None, "missing_label"), (5, None, "empty_page")]


def test_code_to_name(spark):
    df = spark.createDataFrame([("c1", "https://r/check", CELL), ("c2", "https://r/check", "<p>none</p>")],
                               "code string, url string, html string")
    assert rows(code_to_name(df, "code")) == [("c1", "ACME SOLAR", "ok"), ("c2", None, "missing_section")]


def cell(inner, label="License Number:", cls='class="MoreDetail_ItemCol1"', tag="div"):
    return (f'<p>top</p><{tag} {cls}><span>{label}</span></{tag}>\n<{tag} class="MoreDetail_ItemCol2">{inner}</{tag}>'
            f'<{tag} {cls}><span>Phone:</span></{tag}><{tag}><span>555</span></{tag}>')


def test_label_value_of_captured_markup(spark):
    """Expected values written by hand, as a browser shows the cell."""
    cases = [
        (cell(""), None),                                      # an empty cell has no value, the next field is not it
        (cell("<i>none</i>"), None),
        (cell("<span></span>"), ""),
        (cell("<span><b>123</b> &amp; 4</span>"), "123 & 4"),
        (cell("<span> 77&nbsp;</span><span>other</span>"), "77"),
        (cell("<span>1 &lt;2&gt; &quot;x&quot; &#39;y&#39;</span>"), "1 <2> \"x\" 'y'"),
        (cell("<span>12<br/>34</span>"), "12\n34"),
        (cell("<SPAN>9</SPAN>", cls="CLASS='a MoreDetail_ItemCol1'", tag="DIV"), "9"),
        (cell("<span>10</span>", cls="class=MoreDetail_ItemCol1 id=q"), "10"),
        (cell("<span>11</span>", label="Owner:"), None),
    ]
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(cases)], "i long, html string")
    got = [r.v for r in df.select("i", extract_label_value("html").alias("v")).orderBy("i").collect()]
    assert got == [v for _, v in cases]


def test_first_line_of_captured_markup(spark):
    cases = [
        ('<td id="MainContent_BusInfo">ACME INC<br/>1 Main St</td>', "ACME INC"),
        ("<TD class=x id='MainContent_BusInfo'> ACME <BR />1 Main St</TD>", "ACME"),
        ("<td id=MainContent_BusInfo>ACME<br clear=all>x<br>y</td >", "ACME"),
        ('<td id="MainContent_BusInfoX">NO</td><td ID="MainContent_BusInfo">YES<Br>z</td>', "YES"),
        ("<td id='other'>x</td>", None),
        ('<td id="MainContent_BusInfo"><br>later</td>', ""),
    ]
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(cases)], "i long, html string")
    got = [r.v for r in df.select("i", extract_first_line("html").alias("v")).orderBy("i").collect()]
    assert got == [v for _, v in cases]
