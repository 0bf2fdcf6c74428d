"""Main text of web pages, found with a wrapper inferred for each host."""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import materialize

# Elements by role.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark",
    "q", "ruby", "rt", "rp", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "picture", "source", "map", "area", "meta", "link",
}
ENDS_P = {
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "ul",
}
SIBLING_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"ul", "ol", "dl", "table", "select", "body", "html", "article", "section", "div", "main"}
ASIDE_TAGS = {"nav", "footer", "aside", "form", "head", "button", "select", "dialog", "menu", "svg", "object", "canvas", "audio", "video", "fieldset", *RAW}
ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "alertdialog", "dialog", "form", "menu", "menubar", "toolbar"}
ASIDE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo", "promotion", "cookie", "cookies", "consent", "gdpr", "notice", "notices",
    "alert", "disclaimer", "comment", "comments", "reply", "replies", "respond", "disqus", "discussion", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer",
    "masthead", "share", "sharing", "social", "related", "recommended", "newsletter", "subscribe", "subscription", "signup", "login", "popup", "modal", "overlay", "widget", "toolbar", "pagination",
    "pager", "skip", "copyright", "legal", "search", "form",
}
# As an id these are as often a topic of the article as a part of the page.
TOPICS = {
    "discussion", "legal", "notice", "notices", "disclaimer", "form", "search", "related", "alert", "copyright", "social", "share", "sharing", "respond", "reply", "replies", "consent", "gdpr",
    "promotion", "subscription", "advertising", "advertisement", "banner", "cookie", "cookies", "navigation", "newsletter", "sponsor", "login", "signup", "footer", "menu", "overlay", "widget",
}
# Parts of a class that tell a state of the page, as in has-sidebar or nav-open.
STATES = {"has", "no", "with", "without", "is", "not", "hide", "show", "open", "opened", "closed", "enabled", "disabled", "active", "fixed", "collapsed", "expanded", "off", "on"}
OTHERS = {"comment", "comments", "reply", "ad", "ads", "advert"}
MAIN_WORDS = {"article", "post", "entry", "content", "story", "main", "body", "text"}
ITEMS = {"p", "li", "tr", "td", "th", "dt", "dd", "option", "blockquote", "pre", "figure"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_labels: dict[tuple[str, str], str] = {}


def label(name: str, attributes: str) -> str:
    """An element's name with what its attributes say about its role.

    ``div.-`` is aside: its role says so, or a whole class or id is the word for it (on headings, items and topics only a
    class).  ``div.~`` has the word in a compound and counts as aside only where nothing is marked as the article.
    ``div.!`` is the article, ``div.+`` may be.
    """
    if not attributes.strip():
        return name
    known = _labels.get((name, attributes))
    if known is None:
        a = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
        classes, own = a.get("class", "").lower().split(), a.get("id", "").lower().strip()
        if name in HEADINGS or name in ITEMS or own in TOPICS:
            own = ""
        tokens = {*classes, own}
        parts = [{w.lower() for w in _WORDS.findall(x)} for x in [*a.get("class", "").split(), a.get("id", "")]]
        words = set().union(*parts)
        role = a.get("role", "").lower()
        hidden = "hidden" in a or a.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", a.get("style", ""))
        aside = role in ASIDE_ROLES or tokens & ASIDE_WORDS or hidden
        if name in ("html", "body", "article", "main"):
            aside = name in ("article", "main") and (tokens & OTHERS or any(re.fullmatch(r"comment-\d+", t) for t in tokens))
        weak = name not in ("html", "body", "article", "main", *HEADINGS, *ITEMS) and any(w & ASIDE_WORDS and not w & STATES for w in parts)
        main = role in ("main", "article") or a.get("itemprop") == "articleBody"
        known = name + (".-" if aside else ".!" if main else ".~" if weak else ".+" if words & MAIN_WORDS and name not in ("body", "html") else "")
        if len(_labels) > 50_000:
            _labels.clear()
        _labels[name, attributes] = known
    return known


class Node:
    """An element, a text slot (label ``T``) or a repeated group of elements, of a page or of a wrapper.

    text: digest of a text that is the same wherever the slot occurs, else None; chars, pages: sums over what was
    merged into it; places: which texts of the page it stands for.
    """

    __slots__ = ("label", "kids", "optional", "repeated", "text", "chars", "pages", "places", "content")

    def __init__(self, label: str, kids=None, optional=False, repeated=False, text=None, chars=0, pages=1):
        self.label, self.kids, self.optional, self.repeated = label, kids or [], optional, repeated
        self.text, self.chars, self.pages, self.places, self.content = text, chars, pages, [], False

    def pack(self) -> list:
        return [self.label, int(self.optional), int(self.repeated), self.text, self.chars, self.pages, int(self.content), [k.pack() for k in self.kids]]

    @staticmethod
    def unpack(p: list) -> Node:
        node = Node(p[0], [Node.unpack(k) for k in p[7]], bool(p[1]), bool(p[2]), p[3], p[4], p[5])
        node.content = bool(p[6])
        return node

    def shape(self) -> str:
        return f"{self.label}{'*' if self.repeated else ''}{'?' if self.optional else ''}" + (f"({','.join(k.shape() for k in self.kids)})" if self.kids else "")

    def leaves(self) -> Iterator[Node]:
        if self.label == "T":
            yield self
        for k in self.kids:
            yield from k.leaves()


def parse(page: str) -> tuple[Node, list[str]]:
    """The balanced stream of a page's blocks as a tree, and its texts, decoded and with single spaces.

    Inline elements only join the text of their block.  Missing end tags are put in as browsers do.
    """
    root = Node("page")
    stack: list[tuple[str, Node]] = [("page", root)]
    texts: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = " ".join(html.unescape("".join(run)).split()) if run else ""
        run.clear()
        if text:
            leaf = Node("T", text=hash_text(text), chars=len(text))
            leaf.places = [len(texts)]
            texts.append(text)
            stack[-1][1].kids.append(leaf)

    at = 0
    while at < len(page):
        m = _TOKEN.search(page, at)
        if not m:
            run.append(page[at:])
            break
        run.append(page[at:m.start()])
        at = m.end()
        name = m[2] and m[2].lower()
        if not name:
            if page.startswith("<![CDATA[", m.start()):
                run.append(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        if name in INLINE:
            if name == "br":
                run.append(" ")
            continue
        flush()
        if m[1]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
            if depth:
                del stack[depth:]
            continue
        if name in ENDS_P:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] in ("p", "button", "td", "li")), 0)
            if depth and stack[depth][0] == "p":
                del stack[depth:]
        if name in SIBLING_ENDS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in SIBLING_ENDS[name]:
                    del stack[i:]
                    if name != "tr":
                        break
                elif stack[i][0] in SCOPE or (name == "tr" and stack[i][0] in ("tbody", "thead", "tfoot")):
                    break
        if name == "body" and any(s == "head" for s, _ in stack):
            del stack[next(i for i, (s, _) in enumerate(stack) if s == "head"):]
        node = Node(label(name, m[3]))
        stack[-1][1].kids.append(node)
        if name in RAW:
            end = re.compile(f"</{name}\\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif name not in VOID:
            stack.append((name, node))
    flush()
    return root, texts


def hash_text(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass"))


# Alignment

def merge(a: Node, b: Node) -> Node:
    """The wrapper of two nodes of one label: texts that differ become slots, parts of only one become optional."""
    if a.label == "T":
        if a.text != b.text:
            a.text = None
    else:
        a.kids = align(a.kids, b.kids)
    a.optional, a.repeated = a.optional or b.optional, a.repeated or b.repeated
    a.chars, a.pages = a.chars + b.chars, a.pages + b.pages
    a.places += b.places
    return a


def align(xs: list[Node], ys: list[Node]) -> list[Node]:
    if len(xs) == len(ys) and all(x.label == y.label for x, y in zip(xs, ys, strict=True)):
        return [merge(x, y) for x, y in zip(xs, ys, strict=True)]
    n, m = len(xs), len(ys)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if xs[i].label == ys[j].label else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and xs[i].label == ys[j].label:
            out.append(merge(xs[i], ys[j]))
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            xs[i].optional = True
            out.append(xs[i])
            i += 1
        else:
            ys[j].optional = True
            out.append(ys[j])
            j += 1
    return fold(out)


def fold(kids: list[Node], longest: int = 4) -> list[Node]:
    """Neighbours of one label, then neighbouring equal sequences of labels, become repeated groups.

    Containers such as ``div`` stand for anything; they repeat only if they are built alike.
    """
    out: list[Node] = []
    for k in kids:
        if out and out[-1].label == k.label and k.label != "T" and (k.label.split(".")[0] in ITEMS or out[-1].shape() == k.shape()):
            pages = out[-1].pages
            merge(out[-1], k)
            out[-1].repeated, out[-1].pages = True, max(pages, k.pages)
        else:
            out.append(k)
    for n in range(2, longest + 1):
        i = 0
        while i + 2 * n <= len(out):
            names = [k.label for k in out[i:i + n]]
            if len(set(names)) > 1 and names == [k.label for k in out[i + n:i + 2 * n]]:
                group = Node("(" + " ".join(names) + ")", out[i:i + n], repeated=True)
                del out[i + 1:i + n]
                out[i] = group
                while [k.label for k in out[i + 1:i + 1 + n]] == names:
                    group.kids = [merge(x, y) for x, y in zip(group.kids, out[i + 1:i + 1 + n], strict=True)]
                    del out[i + 1:i + 1 + n]
            i += 1
    return out


def collapse(node: Node) -> Node:
    for k in node.kids:
        collapse(k)
    node.kids = fold(node.kids)
    return node


# Which slots of a wrapper are the article

def _aside(node: Node) -> bool:
    return node.label.endswith(".-") or node.label.split(".")[0] in ASIDE_TAGS


def _weak(node: Node) -> bool:
    return node.label.endswith(".~")


def _regions(node: Node, test, barred) -> list[Node]:
    """The outermost elements that pass the test, none inside barred ones."""
    if barred(node):
        return []
    if test(node) and not _aside(node):
        return [node]
    return [r for k in node.kids for r in _regions(k, test, barred)]


def _weight(node: Node) -> int:
    """Characters of the texts that vary, in the node's own blocks."""
    own = [leaf for k in node.kids for leaf in ([k] if k.label == "T" else k.kids if k.label.split(".")[0] in ("p", "pre", "blockquote") or k.label[0] == "(" else []) if leaf.label == "T"]
    return sum(leaf.chars for leaf in own if leaf.text is None or leaf.pages == 1)


def choose(wrapper: Node) -> Node:
    """Mark the content slots of a wrapper.

    The article is what is marked so: article elements, else main ones, outside asides if there are any, else within
    them.  If nothing is marked it is what a class says, else the element whose own blocks hold the most varying text, compounds
    of aside words being looked into last.  Asides within the article are left out, of a header only the headings are
    kept.  Outside marked regions, a text that three or more pages share is template.
    """
    name = lambda n: n.label.split(".")[0]
    article, main = lambda n: name(n) == "article", lambda n: n.label.endswith(".!") or name(n) == "main"
    anywhere, vague = lambda n: False, lambda n: _aside(n) or _weak(n)

    def heaviest(barred) -> list[Node]:
        def all_nodes(n: Node) -> Iterator[Node]:
            if not barred(n):
                yield n
                for k in n.kids:
                    yield from all_nodes(k)

        return [max(all_nodes(wrapper), key=_weight)]

    def classed() -> list[Node]:
        return [r for r in _regions(wrapper, lambda n: n.label.endswith(".+"), vague) if any(leaf.chars for leaf in r.leaves())]

    def mark(node: Node, in_header: bool, heading: bool, marked: bool, barred) -> bool:
        if node.label == "T":
            node.content = (heading or not in_header) and (marked or node.text is None or node.pages < 3)
            return node.content
        if barred(node):
            return False
        return any([mark(k, in_header or name(node) == "header", heading or name(node) in HEADINGS, marked, barred) for k in node.kids])

    for find, marked, barred in (
        (lambda: _regions(wrapper, article, _aside), True, _aside), (lambda: _regions(wrapper, main, _aside), True, _aside),
        (lambda: _regions(wrapper, article, anywhere), True, _aside), (lambda: _regions(wrapper, main, anywhere), True, _aside),
        (classed, False, vague), (lambda: heaviest(vague), False, vague), (lambda: heaviest(_aside), False, _aside),
    ):
        if any([mark(r, False, False, marked, barred) for r in find()]):
            break
    return wrapper


def matched(page: Node, wrapper: Node) -> list[bool]:
    """For each leaf of a folded page, whether the wrapper's slot for it is content; what folding in the wrapper has
    left without a slot is judged by the page itself."""
    out: list[bool] = []
    choose(page)

    def walk(xs: list[Node], ys: list[Node]) -> None:
        n, m = len(xs), len(ys)
        best = [[0] * (m + 1) for _ in range(n + 1)]
        for i in range(n - 1, -1, -1):
            for j in range(m - 1, -1, -1):
                stay = best[i + 1][j] if ys[j].repeated else best[i + 1][j + 1]
                best[i][j] = max(best[i + 1][j], best[i][j + 1], 1 + max(stay, best[i + 1][j + 1]) if xs[i].label == ys[j].label else 0)
        j = 0
        for i in range(n):
            while j < m and xs[i].label != ys[j].label and best[i][j + 1] >= best[i + 1][j]:
                j += 1
            if j < m and xs[i].label == ys[j].label:
                if xs[i].label == "T":
                    out.append(ys[j].content)
                else:
                    walk(xs[i].kids, ys[j].kids)
                if not ys[j].repeated or best[i + 1][j + 1] >= best[i + 1][j]:
                    j += 1
            else:
                out.extend(leaf.content for leaf in xs[i].leaves())

    walk(page.kids, wrapper.kids)
    return out


# Spark

def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper): for each host the wrapper of all its pages, as JSON, with its content slots marked.

    Each task folds its pages into one wrapper a host and shape; these partial wrappers, not pages, are shuffled, and
    merged in two steps, so that a host with a third of all pages is a few small rows for each task.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple[str, str], Node] = {}

        def out() -> pa.RecordBatch:
            keys = list(kept)
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([json.dumps(kept[k].pack()) for k in keys], pa.string())], ["host", "wrapper"])

        for batch in batches:
            for site, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                node = collapse(parse(page or "")[0])
                for leaf in node.leaves():
                    leaf.places = []
                key = (site, node.shape())
                kept[key] = merge(kept[key], node) if key in kept else node
            if len(kept) > 5000:
                yield out()
                kept.clear()
        yield out()

    def merged(final: bool):
        def run(table: pa.Table) -> pa.Table:
            nodes = [Node.unpack(json.loads(w)) for w in sorted(table.column("wrapper").to_pylist())]
            node = nodes[0]
            for other in nodes[1:]:
                node = merge(node, other)
            return pa.table({"host": table.column("host").slice(0, 1).cast(pa.string()), "wrapper": pa.array([json.dumps((choose(node) if final else node).pack())], pa.string())})

        return run

    parts = pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(partial, "host string, wrapper string")
    parts = parts.withColumn("turn", F.pmod(F.xxhash64("wrapper"), F.lit(32)))
    parts = parts.groupBy("host", "turn").applyInArrow(merged(False), "host string, wrapper string")
    return parts.groupBy("host").applyInArrow(merged(True), "host string, wrapper string")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page, a row per row.

    Blocks are joined by an empty line.  Null or empty html gives an empty text, as does a page without an article.
    Pages without a host in their url share one wrapper.  Other columns are not used.
    """
    wrappers = materialize(infer_wrappers(pages), "wrappers").withColumnRenamed("host", "_host")
    rows = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    rows = rows.join(wrappers, F.col("host") == F.col("_host"), "left").select("page_id", "url", "html", "wrapper")

    def read(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        trees: dict[int, Node] = {}
        flags: dict[tuple[int, str], list[bool]] = {}
        for pages_here, wrappers_here in batches:
            out = []
            for page, packed in zip(pages_here.to_pylist(), wrappers_here.to_pylist(), strict=True):
                node, texts = parse(page or "")
                if not texts or packed is None:
                    out.append("")
                    continue
                node = collapse(node)
                own = hash(packed)
                if own not in trees:
                    if len(trees) > 2000:
                        trees.clear()
                        flags.clear()
                    trees[own] = Node.unpack(json.loads(packed))
                key = (own, node.shape())
                if key not in flags:
                    if len(flags) > 20_000:
                        flags.clear()
                    flags[key] = matched(node, trees[own])
                places = sorted(p for leaf, keep in zip(node.leaves(), flags[key], strict=True) if keep for p in leaf.places)
                out.append("\n\n".join(texts[p] for p in places))
            yield pa.array(out, pa.string())

    read.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    text = F.arrow_udf(read, "string")
    rows = rows.select("page_id", "url", text(F.col("html"), F.col("wrapper")).alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("bigint"))
