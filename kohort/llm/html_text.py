"""Main-text extraction from web pages by tree scoring (operator 5).

A page becomes a tree of its block elements; inline markup is transparent.
Every paragraph scores points for its length and its commas and passes them
to its ancestors (full to the parent, half to the grandparent, less further
up).  A container's points are discounted by its link density; the article
or main element around the best container, else that container, is kept, with
all parts that are not mostly links beside it, up to the lowest ancestor that
holds most of the page's points.  Parts that are never main text
(menus, page headers and footers, sidebars, notices, adverts, forms, scripts,
styles, reader comments) are cut out before scoring; an element that is only
named like one (or a form, or a dialog) but holds the main text is not cut,
its score is discounted.

Output text: the kept blocks in page order, one line each; inside a block
character references are decoded and white space is one space.

Defined cases: null or empty html, or a page without text, gives an empty
string; broken markup (missing end tags, cut-off tags, unknown elements) is
read as browsers do; a page without scoring paragraphs falls back to its
article, main or body element; repeated rows are extracted alike; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sliced, table

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(>|\Z)", re.S)
_ATTR = re.compile(r"(class|id|role|style|aria-hidden|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?(?=[\s/>]|\Z)", re.I)

_RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "math", "object", "noembed", "noframes", "xmp"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = {
    "html", "head", "body", "address", "article", "aside", "blockquote", "button", "caption", "center", "dd", "details",
    "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4",
    "h5", "h6", "header", "hgroup", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "select",
    "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
_CUT = {"head", "nav", "footer", "aside", "button", "select", "menu", "search"}
_CUT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alertdialog", "alert", "menu", "menubar"}
#: usually no main text, but whole pages can stand in one
_DOUBTFUL, _DOUBTFUL_ROLES = {"form", "fieldset", "dialog"}, {"form", "dialog"}
#: words that name such a part wherever they stand in a class or id
_CUT_NAMES = {
    "advert", "adverts", "advertisement", "adsense", "adbox", "sponsored", "sidebar", "navbar", "navigation", "topbar", "toolbar",
    "masthead", "footnav", "comment", "comments", "commentlist", "disqus", "respond", "replies", "cookie", "cookies", "consent",
    "gdpr", "popup", "modal", "lightbox", "newsletter", "subscribe", "subscription", "signup", "login", "breadcrumb", "breadcrumbs",
    "pagination", "pager", "paywall",
}
#: words that do so as a whole name, or beside a word for a box or a list only ("related posts", not "related work")
_CUT_WORDS = {
    "ad", "ads", "banner", "sponsor", "promo", "promotion", "aside", "menu", "nav", "footer", "notice", "notices", "notification",
    "alert", "overlay", "share", "sharing", "social", "related", "recommended", "recommendations", "widget", "hidden", "skip", "tags",
}
_BOX_WORDS = {
    "area", "articles", "bar", "block", "body", "box", "buttons", "container", "content", "cookie", "has", "icons", "inner", "item", "items", "link",
    "links", "list", "main", "media", "open", "outer", "page", "panel", "post", "posts", "row", "section", "site", "stories", "top", "unit",
    "wrap", "wrapper",
}
#: parts that are cut inside the main text too, however long they are
_NEVER = {"comment", "comments", "commentlist", "disqus", "respond", "replies", "advert", "adverts", "advertisement", "adsense", "adbox",
          "cookie", "cookies", "consent", "gdpr", "newsletter", "sidebar", "paywall"}
_NEVER_WORDS = {"ad", "ads", "sponsor", "promo", "promotion", "notice", "notices", "nav", "menu", "footer"}  # as whole names
#: inside the main text, other parts so named are cut when they are mostly links or shorter than that
_SHORT_PART = 250
_NAME_PART = re.compile(r"[a-z]+|[A-Z][a-z]*")
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_SCORED = {"p", "pre", "td", "blockquote", "li", "dd", "div", "section", "article", "main"}
#: start tag -> open elements that it ends
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
         "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
_LIMITS = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
           "tbody": {"table"}, "tfoot": {"table"}}
_MIN_PARAGRAPH = 25
#: share of a page's points that the container of its main text holds
_MOST = 0.75
_DISCOUNT = 0.25


class _Node:
    __slots__ = ("tag", "parent", "kids", "cut", "named", "never", "weight", "chars", "link_chars", "commas", "points")

    def __init__(self, tag: str, parent: _Node | None, cut: bool, named: bool = False, never: bool = False) -> None:
        self.tag, self.parent, self.cut = tag, parent, cut
        self.named, self.never, self.weight = named, never, 1.0  # named like a part that is no main text; never is
        self.kids: list[_Node | str] = []  # blocks, and runs of text between them
        self.chars = self.link_chars = self.commas = 0
        self.points = 0.0


def _is_cut(tag: str, attrs: str, parent: _Node) -> bool:
    if tag in _CUT:
        return True
    if tag == "header":  # an article's own header holds its heading
        up: _Node | None = parent
        while up is not None and up.tag not in ("article", "main"):
            up = up.parent
        if up is None:
            return True
    if not attrs or tag in ("html", "body"):
        return False
    for name, a, b, c in _ATTR.findall(attrs):
        value, name = a or b or c, name.lower()
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if name == "role" and value.lower() in _CUT_ROLES:
            return True
    return False


def _is_named(tag: str, attrs: str) -> tuple[bool, bool]:
    """Whether an element is made or named like a part that is no main text, and whether that never is."""
    named, never = tag in _DOUBTFUL, False
    if not attrs or tag in ("html", "body", "main", "p") or tag in _HEADINGS:  # a heading's id is an anchor
        return named, False
    for name, a, b, c in _ATTR.findall(attrs):
        value, name = a or b or c, name.lower()
        if name == "role" and value.lower() in _DOUBTFUL_ROLES:
            named = True
        if name in ("class", "id"):
            for one in value.split():
                parts = {x.lower() for x in _NAME_PART.findall(one)}
                whole = parts <= _CUT_WORDS | _BOX_WORDS
                named = named or bool(parts & _CUT_NAMES) or bool(parts & _CUT_WORDS) and whole
                never = never or bool(parts & _NEVER) or bool(parts & _NEVER_WORDS) and whole
    return named, never


def _tree(page: str) -> _Node:
    root = node = _Node("#root", None, False)
    run: list[str] = []
    links = 0  # open <a> elements
    linked = 0  # characters of the run inside links

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join("".join(run).split())
            run.clear()
            if text:
                node.kids.append(text)
                node.chars += len(text)
                node.link_chars += min(linked, len(text))
                node.commas += text.count(",") + text.count("、") + text.count("，")
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = html.unescape(text) if "&" in text else text
            run.append(text)
            if links:
                linked += len(text.strip())

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if tag is None or m[5] and not m[7]:  # comment, declaration, or a tag cut off by the end
            continue
        tag, closing, attrs = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
        if tag == "a":
            links = max(0, links - 1) if closing else 1
        elif tag in _RAW:
            if not closing and not (tag in ("svg", "math") and attrs.rstrip().endswith("/")):
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                at = close.end() if close else end
        elif tag == "br":
            run.append(" ")
        elif tag == "hr":
            flush()
        elif tag in _VOID or tag not in _BLOCK:
            continue
        elif closing:
            up: _Node | None = node
            while up is not None and up.tag != tag:
                up = None if up.tag in ("td", "th", "#root") and tag == "p" else up.parent
            if up is not None and up.parent is not None:
                flush()
                node = up.parent
                links = 0 if tag != "p" else links
            elif tag == "p":
                flush()
        else:
            flush()
            if tag in ("html", "body") and any(isinstance(k, _Node) and k.tag == tag for k in node.kids):
                continue
            if tag == "body":
                while node.tag == "head" and node.parent is not None:
                    node = node.parent
            elif node.tag == "p":
                node = node.parent or node
            ends = _ENDS.get(tag)
            if ends:
                up = node
                while up is not None and up.tag not in _LIMITS[tag] and up.tag != "#root":
                    if up.tag in ends and up.parent is not None:
                        node = up.parent
                    up = up.parent
            elif tag in _HEADINGS and node.tag in _HEADINGS and node.parent is not None:
                node = node.parent
            new = _Node(tag, node, node.cut or _is_cut(tag, attrs, node), *_is_named(tag, attrs))
            node.kids.append(new)
            node = new
    flush()
    return root


def _walk(root: _Node) -> list[_Node]:
    """All nodes that are not cut, parents first (no recursion: pages can nest deeply)."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        if not n.cut:
            out.append(n)
            todo.extend(k for k in reversed(n.kids) if isinstance(k, _Node))
    return out


def _blocks(root: _Node, lists: bool = False) -> list[str]:
    """Lines of a node; lists of links go unless ``lists``."""
    out: list[str] = []
    todo: list[_Node | str] = [root]
    while todo:
        n = todo.pop()
        if isinstance(n, str):
            out.append(n)
        elif not n.cut and (lists or not _link_list(n)):
            todo.extend(reversed(n.kids))
    return out


def _density(n: _Node) -> float:
    return n.link_chars / n.chars if n.chars else 0.0


def _link_list(n: _Node) -> bool:
    """A list made of links is a menu, unless it stands in the chosen container."""
    return n.tag in ("ul", "ol", "dl") and n.chars > 0 and _density(n) > 0.8


def _points(n: _Node, chars: int, commas: int, linked: int) -> float:
    """Points of a node's own text."""
    if n.tag not in _SCORED or chars < _MIN_PARAGRAPH:
        return 0.0
    return (1 + commas + min(chars / 100, 3)) * (1 - min(1.0, linked / chars))


def _cut_named(root: _Node) -> bool:
    """Cut elements by their names, except those around the main text: their score is discounted.

    Such an element holds a main element, an article that is no comment or
    teaser, or, on a page without these, most of the points.  Inside a main
    element or such an article a name alone cuts only what never is main text;
    else the part must also be short or mostly links.  Whether any was cut.
    """
    nodes = _walk(root)
    if not any(n.named and n.tag != "article" for n in nodes):
        return False
    points = {id(n): _points(n, n.chars, n.commas, n.link_chars) for n in nodes}
    for n in reversed(nodes):
        if n.parent is not None:
            points[id(n.parent)] = points.get(id(n.parent), 0.0) + points[id(n)]
    articles = [n for n in nodes if n.tag == "article" and not n.named]
    least = max((points[id(n)] for n in articles), default=0.0) / 2
    around: set[int] = set()
    inside: set[int] = set()  # the elements of main or of such an article
    sizes = {id(n): [n.chars, n.link_chars] for n in nodes}
    for n in reversed(nodes):
        if n.parent is not None:
            for k in (0, 1):
                sizes.setdefault(id(n.parent), [0, 0])[k] += sizes[id(n)][k]
    for n in nodes:
        if n.parent is not None and id(n.parent) in inside:
            inside.add(id(n))
        if n.tag == "main" or n.tag == "article" and not n.named and points[id(n)] >= least:
            inside.add(id(n))
            up: _Node | None = n.parent
            while up is not None and id(up) not in around:
                around.add(id(up))
                up = up.parent
    for n in nodes:
        if n.parent is not None:
            n.cut, n.weight = n.cut or n.parent.cut, n.parent.weight if id(n.parent) not in around else 1.0
        if not n.named or n.tag == "article" or n.cut:
            continue
        chars, linked = sizes[id(n)]
        prose = id(n) in inside and not n.never and chars >= _SHORT_PART and linked < 0.3 * chars
        if id(n) in around or prose or not around and 2 * points[id(n)] > points[id(root)]:
            n.weight *= _DISCOUNT
        else:
            n.cut = True
    return any(n.named and n.cut for n in nodes)


def extract_text(page: str | None) -> str:
    """The main text of one page.  Names are left aside where nothing would remain."""
    if not page:
        return ""
    root = _tree(page)
    named = _cut_named(root)
    return _main_text(root) or (_main_text(_tree(page)) if named else "")


def _main_text(root: _Node) -> str:
    nodes = _walk(root)
    own = {id(n): (n.chars, n.commas, n.link_chars) for n in nodes}
    for n in reversed(nodes):  # children first: totals of the subtrees
        if n.parent is not None and not n.parent.cut:
            n.parent.chars += n.chars
            n.parent.link_chars += n.link_chars
    candidates: dict[int, _Node] = {}
    for n in nodes:
        chars, commas, _ = own[id(n)]
        if n.tag not in _SCORED or chars < _MIN_PARAGRAPH:
            continue
        points = (1 + commas + min(chars / 100, 3)) * (1 - min(1.0, _density(n)))
        holder, level = (n if n.tag in ("div", "section", "article", "main") else n.parent), 0
        while holder is not None and holder.tag != "#root" and level < 5:
            holder.points += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            candidates[id(holder)] = holder
            holder, level = holder.parent, level + 1
    score = lambda n: n.points * (1 - _density(n)) * (1.5 if n.tag in ("article", "main") else 1) * n.weight
    best = max(candidates.values(), key=score, default=None)
    if best is None:
        for tag in ("article", "main", "body"):
            best = next((n for n in nodes if n.tag == tag and n.chars), None)
            if best is not None:
                break
        return "\n".join(_blocks(best or root))
    holders: list[_Node] = []
    up: _Node | None = best
    while up is not None:
        holders.append(up)
        up = up.parent
    # the outermost article, or else main, that holds the best container is the article
    for tag in ("article", "main"):
        held = [n for n in holders if n.tag == tag]
        if held:
            best = held[-1]
            break
    if best.parent is None or best.parent.tag == "html":
        return "\n".join(_blocks(best))
    # up to the lowest ancestor that holds most of the points, at least the parent
    total = {id(n): _points(n, *own[id(n)]) for n in nodes}
    for n in reversed(nodes):
        if n.parent is not None:
            total[id(n.parent)] = total.get(id(n.parent), 0.0) + total[id(n)]
    path, up = {id(best)}, best.parent
    while up.parent is not None and up.parent.tag not in ("html", "#root") and total[id(up)] < _MOST * total[id(nodes[0])]:
        path.add(id(up))
        up = up.parent
    out: list[str] = []
    todo: list[_Node | str] = [up]
    path.add(id(up))
    while todo:
        k = todo.pop()
        if isinstance(k, str):
            out.append(k)
        elif k is best:
            out += _blocks(k, lists=True)
        elif id(k) in path:
            chars, _, linked = own[id(k)]
            todo.extend(x for x in reversed(k.kids) if not isinstance(x, str) or linked < 0.3 * chars)
        elif not k.cut and (k.weight >= best.weight or any(
                n.tag == "main" or n.tag == "article" and not n.named for n in _walk(k))):
            if _density(k) < 0.3:
                out += _blocks(k)
            elif total[id(k)] > 0:  # a part with links beside prose: only the prose
                todo.extend(x for x in reversed(k.kids) if isinstance(x, _Node))
    return "\n".join(out)


def extract_pages(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = [extract_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.col(html_col).cast("string").alias("html"))
    return src.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
