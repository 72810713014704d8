import collections

import pytest

from conftest import plan_text
from recordlake.llm import lines as L

SF = "/root/testdata/sf0.1"


def brute(rows, ratio=L.RATIO, min_pages=L.MIN_PAGES):
    """[(text, n_lines, n_removed)] for rows of (host, text), in order."""
    pages = collections.Counter(h for h, _ in rows)
    seen = collections.Counter((h, x) for h, t in rows if t is not None for x in {y.strip(" ") for y in t.split("\n")} if x)
    out = []
    for h, t in rows:
        if t is None:
            out.append((None, 0, 0))
            continue
        all_lines = t.split("\n")
        kept = [x for x in all_lines if not (seen[h, x.strip(" ")] >= min_pages and seen[h, x.strip(" ")] > ratio * pages[h])]
        out.append(("\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return out


@pytest.mark.parametrize("ratio, min_pages", [(L.RATIO, L.MIN_PAGES), (0.02, 3)])
def test_documents_against_brute_force(spark, ratio, min_pages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    want = dict(zip([r.doc_id for r in rows], brute([(r.source, r.text) for r in rows], ratio, min_pages)))
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in L.drop_boilerplate(docs, ratio=ratio, min_pages=min_pages).collect()}
    assert got == want and sum(w[2] for w in want.values()) > 0


def test_edge_rows(spark):
    rows = [("a", "menu\nfirst"), ("a", " menu \nsecond\n"), ("a", "menu\nmenu\nthird"), ("a", "menu"), ("a", "x\nmenu"), ("a", None), ("a", ""),
            ("b", "menu\nonly here"), (None, "foot\n1"), (None, "foot\n2"), (None, "foot"), (None, "foot"), (None, "foot"), ("c", "long " * 50_000)]
    rows += [("d", "same page\n\n")] * 6
    df = spark.createDataFrame([(i, h, t) for i, (h, t) in enumerate(rows)], "doc_id long, source string, text string")
    df = df.selectExpr("*", "'mine' AS n_lines", "1 AS line", "2 AS h", "3 AS `p.q`")
    out = L.drop_boilerplate(df)
    assert out.columns == ["doc_id", "source", "text", "line", "h", "p.q", "n_lines", "n_removed"]
    got = [(r.text, r.n_lines, r.n_removed) for r in out.orderBy("doc_id").collect()]
    assert got == brute(rows)
    assert got[0] == ("first", 2, 1) and got[3] == ("", 1, 1) and got[7] == ("menu\nonly here", 2, 0)
    assert L.drop_boilerplate(df.limit(0)).collect() == []


def test_copies_once(spark):
    pages = [("a", f"menu\nstory {i}\nits end {i}") for i in range(20)] + [("a", "menu\ncopied\nwhole")] * 600 + [("b", "menu\ncopied\nwhole")] * 6
    rows = pages + [("a", None)] * 500 + [(None, "x\ny")] * 7 + [(None, f"x\nz{i}") for i in range(9)]
    df = spark.createDataFrame([(i, h, t) for i, (h, t) in enumerate(rows)], "doc_id long, source string, text string")
    got = [(r.text, r.n_lines, r.n_removed) for r in L.drop_boilerplate(df, copies_once=True).orderBy("doc_id").collect()]
    once = brute(sorted(set(rows), key=str))
    want = dict(zip(sorted(set(rows), key=str), once))
    assert got == [want[r] for r in rows]
    assert got[20] == ("copied\nwhole", 3, 1) and got[620] == ("menu\ncopied\nwhole", 3, 0)
    assert L.drop_boilerplate(df.limit(0), copies_once=True).collect() == []
    plan = plan_text(L.drop_boilerplate(df, copies_once=True), "simple")
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for df in (L.boilerplate_lines(docs), L.drop_boilerplate(docs)):
        text = plan_text(df, "simple")
        assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_hosts_of_few_pages(spark):
    """A footer on all pages of a host goes from two pages on; the only page of a host keeps its lines."""
    rows = [(f"h{n}", f"story {n} {i}\nfooter\n{'half' if i % 2 else 'other half'}") for n in range(1, 12) for i in range(n)]
    df = spark.createDataFrame([(i, h, t) for i, (h, t) in enumerate(rows)], "doc_id long, source string, text string")
    got = [(r.text, r.n_lines, r.n_removed) for r in L.drop_boilerplate(df).orderBy("doc_id").collect()]
    assert got == brute(rows)
    assert got[0] == ("story 1 0\nfooter\nother half", 3, 0) and got[1] == ("story 2 0\nother half", 3, 1) and got[-1][0] == "story 11 10"
