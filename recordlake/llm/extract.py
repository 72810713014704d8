"""Main text of HTML pages by composite text density.

A page becomes a tree of its elements. What can't be the article goes first: scripts, styles, forms,
navigation, sidebars and elements whose class, id or role names them (menu, advert, notice,
comments ...). In an ``article`` or ``main`` element, and for words that articles use as well, a name only raises
suspicion: links, forms or repeated comments must agree, and headings, inline elements and sections of text stay. For every element the composite text density is then computed: characters per tag, adjusted
by how many of them are links,

    CTD = C/T * log(C/LC * T/LT) / log(log-base),   log-base = ln(C * LC / (C - LC) + C * LCb / Cb + e)

with C characters, T tags, LC link characters and LT link tags below it, and Cb and LCb those of the
body (a zero counts as one). The element with the largest sum of its children's densities is the article's
frame. The smallest density on the path from it to the body is the threshold: from the body down, in every
element that reaches it the subtree of the largest sum is content. Where that subtree lies in an
``article`` or ``main`` element, the whole of it is taken, so that headings beside the paragraphs stay. Where no
such element marks the article, its blocks may be siblings, and short ones don't reach the threshold: the subtree widens to every
element above it that has paragraphs, headings or other text of its own beside it. Link lists inside are left out.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm.frames import map_arrow

#: Elements without content, and elements whose content is no markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg".split())
#: Those of them that reach to the end of the page where nothing ends them; of the others only the tag is left out then.
TO_THE_END = frozenset("script style textarea title".split())
#: Elements that break a line of text.
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol optgroup option p pre search section
    select summary table tbody td tfoot th thead tr ul caption""".split())
#: Elements that are never part of the article, and those that aren't unless they lie in it.
NEVER = frozenset("nav aside footer form button select input dialog head menu object audio video canvas annotation annotation-xml".split())
OUTSIDE = frozenset(["header"])
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words in a class or id that name something else than the article; readers' words may be most of a page. A class or id
#: does if all words of it do, but for those of NEUTRAL, which say nothing.
NAMES = frozenset("""ad ads adslot adbox adunit advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion sidebar sidebars
    menu nav navbar navigation breadcrumb breadcrumbs crumbs footer masthead topbar toolbar cookie cookies consent gdpr notice notices
    notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended
    recommendations widget pagination pager""".split())
READERS = frozenset("comment comments commentlist disqus respond reply replies discussion".split())
NEUTRAL = frozenset("""area articles bar block body bottom box btn button buttons center col column container content div first form global google group
    header icons inner inline item items js label last law left links list main media message outer page policy post posts primary right row
    secondary section site slot small stories this title tools top unit wp wrap wrapper""".split())
#: Words for which links, forms or comments must agree also outside of an article, if the element looks like a section of text.
WEAK = frozenset("share sharing social related recommended recommendations notice notices notification alert widget overlay login signup respond reply replies discussion".split())
#: Words that name nothing else, in an article or not.
SURE = frozenset("comments commentlist disqus cookie cookies consent gdpr".split())
NOTICES = frozenset("notice notices banner popup modal overlay alert notification policy".split())
#: Words that need no agreement in an article, unless the element looks like a section of text.
ADVERTS = frozenset("ad ads adslot adbox adunit advert adverts advertisement advertising adsense sponsor sponsored promo promotion".split())
IN_HEAD = frozenset("head title meta link base style script noscript template".split())
#: Elements whose open tag ends an open element of the set.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody", "thead"}}
#: Elements past which such an end, or an end tag, doesn't reach.
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
         "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"}}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold an article's text, and the characters from which any other text counts as such.
TEXT = HEADINGS | frozenset("p blockquote pre dl ul ol table figure".split())
TEXT_CHARS = 80
#: Characters a link of a list of links that isn't a list of references.
LABEL_CHARS = 40

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)|([^<]+|<)""", re.S)
#: The rest of a tag; its parts exclude each other, so nothing is tried twice. A quote without a second one is no quotation.
_REST = re.compile(r"""((?:[^>"']++|"[^"]*+"|'[^']*+'|"(?![^"]*+")|'(?![^']*+'))*+)>""")
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|style)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_QUOTED = re.compile(r"""=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)""")
_HIDDEN = re.compile(r"(?:^|[\s/])hidden(?=[\s/]|$)", re.I)
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I | re.A) for tag in RAW}
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Node:
    __slots__ = ("tag", "other", "parent", "items", "raw", "chars", "links", "tags", "link_tags", "density", "sum", "best", "texts", "marks", "words", "forms", "replies", "article")

    def __init__(self, tag: str, other: str, parent: Node | None):
        self.tag, self.other, self.parent = tag, other, parent
        self.items: list[Node | str] = []
        self.raw = self.chars = self.links = self.tags = self.link_tags = 0
        self.density = self.sum = 0.0
        self.best = self
        self.texts = self.marks = self.forms = self.replies = 0
        self.words: set[str] = set()
        self.article = tag in ("article", "main")


def _other(tag: str, attributes: str) -> tuple[str, set[str]]:
    """What says that an element may be no part of an article: its 'tag', 'role', 'name' or 'readers', or that it is 'hidden'; else ''; and the words."""
    if tag in NEVER:
        return "tag", set()
    if not attributes.strip("/ ") or tag in ("body", "html", "main", "article"):
        return "", set()
    found: set[str] = set()
    if _HIDDEN.search(_QUOTED.sub("", attributes)):
        return "hidden", set()
    for m in _ATTRIBUTE.finditer(attributes):
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() == "style":
            if _UNSEEN.search(value):
                return "hidden", set()
        elif m[1].lower() == "role":
            if value.lower() in ROLES:
                return "role", set()
        else:
            for token in value.split():
                words = {w.lower() for w in _NAME.findall(token)}
                named = words & (NAMES | READERS)
                if all(w in named or w in NEUTRAL or len(w) == 1 for w in words):
                    found |= named
    return ("readers" if found & READERS else "name" if found else ""), found


def parse(html: str) -> tuple[Node, list[Node]]:
    """The tree of a page, and its elements in page order. Open elements end where HTML lets them."""
    root = Node("html", "", None)
    nodes, stack, at = [root], [root], 0
    open_ended: set[str] = set()
    quotes = True
    while at < len(html):
        m = _TOKEN.match(html, at)
        at = m.end()
        if m[3] is not None:
            stack[-1].items.append(m[3])
            continue
        if m[2] is None:
            continue
        rest = _REST.match(html, at) if quotes else None
        if rest:
            attributes, at = rest[1], rest.end()
        else:  # quotations that lead to no end of the tag are none, from here on
            quotes = False
            end = html.find(">", at)
            if end < 0:  # the page ends in a tag
                break
            attributes, at = html[at:end], end + 1
        tag = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag or tag in HEADINGS and stack[i].tag in HEADINGS:
                    del stack[i:]
                    break
                # an inline end tag doesn't end blocks, and cells and items don't end their table or list
                if tag not in BLOCK and stack[i].tag in BLOCK or stack[i].tag in SCOPE.get(tag, ()):
                    break
            continue
        if tag in RAW:
            if tag not in open_ended and not (attributes.endswith("/") and tag == "svg"):
                end = _END[tag].search(html, at)
                close = html.find(">", end.end()) if end else -1
                if close >= 0:
                    at = close + 1
                elif tag in TO_THE_END:
                    at = len(html)
                else:
                    open_ended.add(tag)
            continue
        if tag in BLOCK:
            for i in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag in BLOCK:
                    break
        if tag in ENDS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in SCOPE[tag]:
                    break
                if stack[i].tag in ENDS[tag]:
                    del stack[i:]
        if tag in ("html", "body") and any(n.tag == tag for n in stack[tag == "html":]) or tag == "html":
            continue
        if tag not in IN_HEAD and any(n.tag == "head" for n in stack):  # a head that nothing ended
            del stack[next(i for i, n in enumerate(stack) if n.tag == "head"):]
        node = Node(tag, "", stack[-1])
        node.other, node.words = _other(tag, attributes)
        stack[-1].items.append(node)
        nodes.append(node)
        if tag not in VOID and not (attributes.endswith("/") and any(n.tag == "math" for n in stack + [node])):
            stack.append(node)
    return root, nodes


def _left_out(node: Node, whole: int, marked: bool) -> bool:
    """Whether an element can't be part of the article.

    whole is the page's text, marked says whether an article or main element marks the article.
    """
    if node.other == "tag":
        return True
    if node.tag in OUTSIDE and not _marked(node):
        return True
    if not node.other or node.marks:  # a frame around the article may be named for what else it holds
        return False
    small = node.raw <= 0.5 * whole
    inside = _marked(node)
    if node.other == "hidden":  # pages that scripts show when they are ready hide most of their text
        return small
    if node.other == "role":
        return small or marked and not inside
    if marked and not inside:
        return True
    if node.tag in HEADINGS or node.tag not in BLOCK:
        return False
    agrees = node.forms > 0 or node.links >= 0.5 * node.raw and node.link_tags > 0 or node.replies > 1
    if inside:
        return node.words <= SURE | NOTICES and bool(node.words & SURE) or agrees and (small or node.other == "readers") or bool(node.words & ADVERTS) and small and not _is_section(node)
    if agrees or not node.words <= WEAK or not _is_section(node, 1):
        return small or node.other == "readers"
    return False


def _marked(node: Node) -> bool:
    above = node.parent
    while above is not None and not above.article:
        above = above.parent
    return above is not None


def _is_section(node: Node, least: int = 2) -> bool:
    """Whether an element looks like a section of text: ``least`` paragraphs, or a heading and a paragraph."""
    inner = [x.tag for x in _below(node) if x.tag in TEXT and x.raw]
    return sum(x not in HEADINGS for x in inner) >= (1 if HEADINGS & set(inner) else least)


def _below(node: Node) -> Iterator[Node]:
    todo = [x for x in node.items if isinstance(x, Node)]
    while todo:
        node = todo.pop()
        yield node
        todo += [x for x in node.items if isinstance(x, Node)]


def _density(node: Node, body: Node) -> float:
    if not node.chars:
        return 0.0
    chars, tags, links, link_tags = node.chars, node.tags or 1, node.links or 1, node.link_tags or 1
    other = chars - node.links or 1
    base = math.log(chars * node.links / other + chars * body.links / (body.chars or 1) + math.e)
    return chars / tags * math.log(chars / links * tags / link_tags) / math.log(base) if base > 1 else (
        chars / tags * math.log(chars / links * tags / link_tags))


def _weigh(root: Node, nodes: list[Node]) -> Node:
    """Counts, densities and sums of all elements; returns the body."""
    for node in reversed(nodes):
        below = [x for x in node.items if isinstance(x, Node)]
        node.raw = sum(len(x.strip()) for x in node.items if isinstance(x, str)) + sum(
            x.raw for x in below if x.marks or x.other not in ("tag", "readers"))
        node.links = sum(x.raw if x.tag == "a" else x.links for x in below)
        node.link_tags = sum(x.link_tags + (x.tag == "a") for x in below)
        node.marks = sum(x.marks + (x.tag in ("article", "main")) for x in below)
        node.forms = sum(x.forms + (x.tag == "form") for x in below)
        node.replies = sum(x.replies + (x.other == "readers" and x.tag in BLOCK and x.tag not in HEADINGS) for x in below)
    marked = root.marks > 0
    for node in nodes:
        node.items = [x for x in node.items if isinstance(x, str) or not _left_out(x, root.raw, marked)]
    for node in nodes:
        node.links = node.link_tags = 0
    kept = [root]
    for node in kept:  # grows while it is read: page order by levels
        kept += [x for x in node.items if isinstance(x, Node)]
    for node in reversed(kept):
        for x in node.items:
            if isinstance(x, str):
                node.chars += len(x.strip())
            else:
                node.chars += x.chars
                node.links += x.chars if x.tag == "a" else x.links
                node.tags += x.tags + 1
                node.link_tags += x.link_tags + (x.tag == "a")
    body = next((x for x in kept if x.tag == "body"), root)
    for node in kept:
        node.density = _density(node, body)
    for node in reversed(kept):
        below = [x for x in node.items if isinstance(x, Node)]
        node.sum = sum(x.density for x in below)
        node.texts = sum(x.texts + (x.tag in TEXT) for x in below)
        node.marks = sum(x.marks + (x.tag in ("article", "main")) for x in below)
        node.best = max([node, *(x.best for x in below)], key=lambda x: x.sum)
    return body


def _largest(node: Node) -> Node:
    best = node
    for x in _below(node):
        if x.sum > best.sum:
            best = x
    return best


def content(html: str) -> list[Node]:
    """The subtrees that hold the article, in page order."""
    root, nodes = parse(html)
    body = _weigh(root, nodes)
    if not body.chars:
        body = root
    frame = _largest(body)
    threshold, node = frame.density, frame
    while node is not body and node.parent is not None:
        threshold, node = min(threshold, node.density), node.parent
    found: dict[int, Node] = {}
    todo = [body]
    while todo:
        node = todo.pop()
        if id(node) in found:
            continue
        if node.density >= threshold and node.chars:
            node.best.article = True
            whole = _whole(node.best, body)
            found[id(whole)] = whole
        if id(node) not in found:
            todo += reversed([x for x in node.items if isinstance(x, Node)])
    out, todo = [], [root]
    while todo:  # in page order, and none inside another
        node = todo.pop()
        if id(node) in found:
            out.append(node)
        else:
            todo += reversed([x for x in node.items if isinstance(x, Node)])
    return out


def _has_text(x: Node | str) -> bool:
    """Whether something beside a block of the article is text, too, rather than links or a scrap."""
    if isinstance(x, str):
        return len(x.strip()) >= TEXT_CHARS
    return x.links < 0.5 * x.chars and (x.tag in TEXT or x.texts > 0 or x.chars - x.links >= TEXT_CHARS)


def _whole(node: Node, body: Node) -> Node:
    """The article that a block belongs to: what is marked as one, else the frame of all text beside the block."""
    whole, up = node, node
    while up is not None:
        if up.tag == "article" or up.tag == "main" and whole.tag != "article":
            whole = up
        up = up.parent
    if whole.tag in ("article", "main"):
        return whole
    while node is not body and node.parent is not None and not node.parent.marks:
        up = node.parent
        if any(_has_text(x) for x in up.items if x is not node):
            whole = up
        node = up
    return whole


def _is_link_list(node: Node) -> bool:
    """Lists of links: short labels and next to nothing beside them, unlike references; outside of an article also longer ones."""
    if node.tag not in ("ul", "ol", "div", "section", "table", "dl") or node.link_tags < 2:
        return False
    if node.tag == "ol" or _marked(node):
        return node.links >= 0.9 * node.chars and node.links < LABEL_CHARS * node.link_tags
    return node.links >= 0.6 * node.chars


def main_text(html: str | None) -> str:
    """The article's blocks in page order, one a line; '' for null, empty and textless pages."""
    if not html:
        return ""
    lines: list[str] = []
    words: list[str] = []

    def end() -> None:
        line = " ".join(unescape("".join(words)).split())
        if line:
            lines.append(line)
        words.clear()

    for top in content(html):
        todo: list = [top]
        while todo:
            x = todo.pop()
            if x is None:
                end()
            elif isinstance(x, str):
                words.append(x)
            elif x.tag == "br":
                words.append(" ")
            elif x is top or not _is_link_list(x):
                if x.tag in BLOCK:
                    end()
                    todo.append(None)
                todo += reversed(x.items)
        end()
    return "\n".join(lines)


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: page_id, url, text (never null) and n_chars, its code points.

    Whole pages are read. Null, empty and textless pages give ''. Ids and urls, null or repeated, are
    returned as they are; other columns are not looked at. Markup that is never closed, or closed in
    another order, is read as far as it goes. An empty table gives an empty table.
    """
    named = pages.select(F.col(f"`{id}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                         F.col(f"`{html}`").cast("string").alias("html"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            text = [main_text(x) for x in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(text, pa.string()),
                                              pa.array([len(x) for x in text], pa.int64())], ["page_id", "url", "text", "n_chars"])
    return map_arrow(named, run, "page_id long, url string, text string, n_chars long")
