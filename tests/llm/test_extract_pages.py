import html
import re

import pytest

from recordlake.llm import extract as E

SF = "/root/testdata/sf0.01"
PROSE = "A sentence of the story goes on for a while, with commas, and it comes to an end here."


def plain(page):
    """The article of the test pages, cut out by its tags."""
    inner = page[page.index("<article>") + 9:page.index("</article>")]
    blocks = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(b for b in blocks if b)


def test_pages_of_the_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in E.extract(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.page_id].text == plain(r.html)
        assert got[r.page_id].n_chars == len(plain(r.html)) and got[r.page_id].url == r.url


ARTICLE = f"<h1>The  Title</h1><p>{PROSE}<p>One &amp; two&nbsp;three &#x41;&lt;b&gt;.<br>{PROSE}</p><h2>Part</h2><p>{PROSE} <a href=x>linked</a> end</p>"
TEXT = "\n".join(["The Title", PROSE, f"One & two three A<b>. {PROSE}", "Part", f"{PROSE} linked end"])
NAV = "<nav><ul>" + "".join(f"<li><a href='/{i}'>Link {i}</a></li>" for i in range(12)) + "</ul></nav>"
LINKS = "<div><ul>" + "".join(f"<li><a href='/{i}'>Some other story {i}</a>" for i in range(12)) + "</ul></div>"


@pytest.mark.parametrize("page", [
    f"<html><head><title>T</title></head><body>{NAV}<article>{ARTICLE}</article><footer><p>{PROSE}</p></footer></body></html>",
    f"<body><header><h1>Site</h1></header><div id='content'>{ARTICLE}</div><div class='sidebar'><p>{PROSE}{PROSE}</p></div></body>",
    f"<body>{LINKS}<main><header>{ARTICLE[:19]}</header>{ARTICLE[19:]}</main><section id=comments>{f'<p>{PROSE}{PROSE}</p>' * 9}</section>",
    f"<head><style>p{{}}</style><meta x><body><div class=cookie-notice>We use cookies. {PROSE}</div><div>{ARTICLE}</div>{LINKS}",
    f"<body><article>{ARTICLE}<div class='ad'>{PROSE}</div><form><p>{PROSE}</p></form><script>'</p>{PROSE}'</script></article>",
    f"<BODY><DIV CLASS='wrapper with-sidebar'><ARTICLE><DIV>{ARTICLE}</DIV></ARTICLE><ASIDE>{PROSE}</ASIDE></DIV></BODY>",
    f"<body><!-- <article>x</article> --><div class='page'><div class='post'>{ARTICLE}</div></div><div id='respond'>{PROSE}</div>",
    f"<body><article>{ARTICLE}</article><div class='share'><a href=1>a</a></div><noscript>{PROSE}</noscript><textarea>{PROSE}</textarea>",
    f"<body><article>{ARTICLE}{LINKS}</article>",
])
def test_article_among_other_parts(page):
    assert E.main_text(page) == TEXT


def blocks(*sections, tag="section"):
    return "".join(f"<{tag}>" + "".join(f"<p>{x}</p>" for x in s) + f"</{tag}>" for s in sections)


LONG, MIDDLE, SHORT = (PROSE * 4)[:300], (PROSE * 3)[:200], "A short remark."


@pytest.mark.parametrize("page, text", [
    (f"<body><div>{blocks([LONG] * 3, [LONG] * 3, tag='div')}</div>", [LONG] * 6),
    (f"<body><div>{blocks([LONG] * 4, [LONG] * 4, [LONG] * 4)}</div><p><a href=x>{'link ' * 12}</a></p>", [LONG] * 12),
    (f"<body>{LINKS}<div><h1>Title</h1>{blocks([LONG] * 3, [MIDDLE] * 3, [SHORT], [LONG] * 3)}{LINKS}</div>{LINKS}",
     ["Title", *[LONG] * 3, *[MIDDLE] * 3, SHORT, *[LONG] * 3]),
    (f"<body>{LINKS}<h2>Title</h2>{blocks([LONG] * 3, [MIDDLE] * 3)}<div>Scrap</div>", ["Title", *[LONG] * 3, *[MIDDLE] * 3, "Scrap"]),
    (f"<body><div><h1>Title</h1><div>{blocks([LONG] * 3)}</div></div>{LINKS}", ["Title", *[LONG] * 3]),
    (f"<body><div>Scrap</div><div>{blocks([LONG] * 3)}</div><div>Scrap</div>{LINKS}", [LONG] * 3),
    (f"<body>{blocks([LONG] * 3, [LONG] * 3, tag='article')}{LINKS}", [LONG] * 6),
])
def test_article_in_sibling_blocks(page, text):
    assert E.main_text(page).split("\n") == text


REFERENCES = "".join(f"<li><a href='/{i}'>Author {i}: a title of the work that is cited here, in full</a>" for i in range(4))
CITED = [f"Author {i}: a title of the work that is cited here, in full" for i in range(4)]


@pytest.mark.parametrize("inside, text", [
    (f"<section id='discussion'><h2>Discussion</h2><p>{LONG}</p><p>{LONG}</p></section>", ["Discussion", LONG, LONG]),
    (f"<h2 id='discussion'>Discussion</h2><p>{LONG}</p>", ["Discussion", LONG]),
    (f"<h2 id='related-work'>Related work</h2><p class='share-price'>{LONG}</p>", ["Related work", LONG]),
    (f"<section id='related-work'><p>{LONG}</p></section><h3 class='social'>Social</h3>", [LONG, "Social"]),
    (f"<div class='notice'><p>{MIDDLE}</p></div><p>{SHORT} <span class='alert'>really</span></p>", [MIDDLE, f"{SHORT} really"]),
    (f"<h2>References</h2><ol>{REFERENCES}</ol>", ["References", *CITED]),
    (f"<h2>References</h2><ul>{REFERENCES}</ul>", ["References", *CITED]),
    ("<p>so <math><mi>x</mi><mspace/><mo>=</mo><semantics><mn>1</mn><annotation>x=1</annotation></semantics></math> holds</p>", ["so x=1 holds"]),
    (f"{LINKS}<div class='share-buttons'><a href=1>one</a><a href=2>two</a></div><div class='ad'>{PROSE}</div>", []),
    (f"<div class='related'><a href=1>{PROSE}</a></div><div id='respond'>Reply <form><p>{PROSE}</p></form></div>", []),
    (f"<div class='discussion'><div class='comment'><p>{LONG}</p></div><div class='comment'><p>{LONG}</p></div></div>", []),
])
@pytest.mark.parametrize("frame", ["<article>", "<main>", "<div>"])
def test_names_in_the_article(frame, inside, text):
    want = ["Title", *[LONG] * 6, *text, MIDDLE]
    page = f"<body>{NAV}{frame}<h1>Title</h1>{f'<p>{LONG}</p>' * 6}{inside}<p>{MIDDLE}</p>{frame.replace('<', '</')}{LINKS}"
    assert E.main_text(page).split("\n") == want


@pytest.mark.parametrize("raw", ["<script>if (a < b) x = '</p>'</SCRIPT >", "<style>p{}</style>", "<svg><path d=x /></svg>", "<noscript>no</noscript\n>",
                                 "<script>'</scripts>'</script>", "<svg/>"])
def test_letters_that_grow_in_lower_case(raw):
    story = "\u0130stanbul'da bir g\u00fcn. " * 20
    assert E.main_text(f"<body><p>{story}</p>{raw}<p>{PROSE}</p>{raw}<p>{story}</p>").split("\n") == [story.strip(), PROSE, story.strip()]


@pytest.mark.parametrize("tag", ["svg", "math", "noscript", "template", "iframe", "xmp", "noembed", "noframes"])
def test_unclosed_element_keeps_the_rest(tag):
    assert E.main_text(f"<body><p>{PROSE}</p><{tag}><p>{LONG}</p><{tag} class=x><p>{PROSE}</p>").split("\n") == [PROSE, LONG, PROSE]


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("<html></html>", ""), ("just text", "just text"), ("a < b and c > d", "a < b and c > d"),
    ("<p>one<p>two", "one\ntwo"), ("<p>a <b>b<p>c</b> d</p> e", "a b\nc d\ne"), ("<ul><li>x<li>y</ul>z", "x\ny\nz"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<p>a<!-- unclosed <p>b", "a"), ("<script>x", ""), ("<p title='>'>q</p>", "q"),
    ("<p>a</div></span>b</p>", "ab"), ("<p>&notanentity; &amp</p>", "¬anentity; &"), ("<div " * 50, None), ("<p>" + "<i>" * 3000 + "deep", "deep"),
    ("<p>wé \U0001f642</p>", "wé \U0001f642"), ("<p>" + "long " * 50_000, ("long " * 50_000).strip()),
])
def test_odd_markup(page, text):
    got = E.main_text(page)
    assert text is None or got == text


def test_density_follows_characters_per_tag_and_links():
    root, nodes = E.parse(f"<body><div><p>{PROSE}</p><p>{PROSE}</p></div><div><a>{PROSE}</a><a>x</a></div></body>")
    E._weigh(root, nodes)
    text, links = [n for n in nodes if n.tag == "div"]
    assert text.density > 5 * links.density and text.sum > links.sum
    assert E._largest(root) is text


def test_edge_rows(spark):
    rows = [(1, "u", None), (1, "u", "<p>a</p>"), (None, None, "<p>b</p>"), (2, "v", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars", "2 AS `a.b`")
    got = sorted((tuple(r) for r in E.extract(df).collect()), key=str)
    assert got == sorted([(1, "u", "", 0), (1, "u", "a", 1), (None, None, "b", 1), (2, "v", "", 0)], key=str)
    assert E.extract(df.limit(0)).collect() == []


def test_pages_that_end_inside_a_tag():
    import time

    text = "A sentence of the article, which is long enough to be one. " * 4
    for n in (10, 100, 10_000):
        for tail in (" ".join(f'a{i}="x"' for i in range(n)), " ".join(f'a{i}="x' for i in range(2 * n + 1)), "'" * n, '"' * (n + 1), "<b " * n):
            began = time.time()
            assert E.main_text(f"<html><body><article><p>{text}</p><img {tail}").strip() == text.strip(), (n, tail[:40])
            assert time.time() - began < 3
    # a quote that nothing closes doesn't take the rest of the page
    assert E.main_text(f"<article><p title=\"x>{text}</p><p>{text}</p></article>").count("sentence") == 8


def page_with(block):
    text = "A sentence of the article, which is long enough to be one. " * 6
    return f"<html><body><main><h1>Title</h1><p>{text}</p><p>{text}</p>{block}<p>{text}</p></main></body></html>"


def test_readers_comments_and_notices_in_the_article():
    for block in ("<section class='comments'><h2>Comments</h2><p>OUT one.</p></section>", "<div id='comments'><p>OUT one.</p><p>OUT two.</p></div>",
                  "<div class='cookie-notice'><p>OUT We use cookies to make this site work.</p><p>OUT Please accept them.</p></div>",
                  "<div id=disqus>OUT</div>", "<div class='gdpr-consent-banner'><p>OUT</p></div>"):
        assert "OUT" not in E.main_text(page_with(block)) and E.main_text(page_with(block)).count("sentence") == 18, block


def test_hidden_elements():
    for block in ("<p hidden>OUT</p>", "<div style='color:red; display: none'>OUT</div>", "<span style=\"visibility:hidden\">OUT</span>", "<p class=x hidden/>OUT</p>"):
        assert "OUT" not in E.main_text(page_with(block)), block
    for block in ("<p title='hidden'>IN</p>", "<p class=hidden-gems>IN</p>", "<p style='display:block'>IN</p>", "<p data-hidden=1>IN</p>"):
        assert "IN" in E.main_text(page_with(block)), block


def test_names_in_other_attributes_say_nothing():
    for block in ("<div data-id='menu'><p>IN</p></div>", "<div data-role='navigation'><p>IN</p></div>", "<div data-class='comments'><p>IN</p></div>"):
        assert "IN" in E.main_text(page_with(block)), block
