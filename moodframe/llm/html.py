"""Main text of web pages by a site style tree.

Pages of one host are merged into a style tree: a style node is a chain of
element signatures (tag and class) from the body down. Its features are its
presentations (the signatures of its children) and its contents (the texts of
its blocks). For a node that occurs on m pages of its host, a feature that c of
them share has entropy log c / log m (0: on one page only, 1: on all). The
importance of a node is one minus the mean entropy of its features; that of a
branch is the mean over all features in it. Branches of hosts with
``MIN_PAGES`` pages or more whose importance is below ``LEAST`` show the same
content page after page and are removed from every page of the host.

The tree also chooses the main branch of a host: the deepest container whose
branch holds more than ``SHARE`` of the host's important content, but none below
a container with important text or headings of its own. A text counts
by its share of its page times the importance of its content, so that a menu
that all pages repeat weighs nothing; what its tag, role or class calls noise
counts ``PRIOR`` of that. Only the main branch of a page is kept. Articles that a
page marks as such are kept whole if they overlap the main branch, and not at
all if the main branch lies elsewhere. A page without its host's main branch,
and one of a host with none, is judged by its marked article, else its body.

Presentation counts as well: elements whose tag, role or class says menu,
header, footer, sidebar, notice, advert, form or reader comment are removed
inside the main branch, whatever their content. Nothing inside a marked article
is removed as unimportant, so that a paragraph which many pages share is not
lost, and no branch with most of a page's text. Equal pages of a host count as
one, or copies would look like a template. Elements deeper than ``DEPTH`` count
for their ancestor there.

Pages are parsed twice: for the tree (only hashes leave the tasks) and for the
text. The page rows meet their host's branches in a join on host and a salt, so
a host with a third of all pages is spread over ``SALTS`` keys.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodframe.llm.common import small

MIN_PAGES, LEAST, SALTS = 8, 0.3, 64
SHARE, PRIOR, DEPTH = 0.75, 0.25, 64

# Fixed values of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIP = frozenset("head script style noscript template svg math iframe object canvas audio video select textarea button".split())
#: What a head can hold; anything else ends it.
_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
_BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section
    summary table tbody td tfoot th thead tr ul""".split())
#: A start tag of the key closes open elements of the values, up to one of the last set.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
           "option": {"option"}}
_SCOPE = frozenset("article main section div table ul ol dl td th body html blockquote form nav aside header footer".split())
# Names of page parts that are not the article.
_NOISE_TAGS = frozenset("nav header footer aside form menu dialog search".split())
_NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_NOISE_WORDS = frozenset("""nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager header masthead topbar
    footer sidebar aside widget widgets rail notice notices cookie cookies consent gdpr banner alert popup modal overlay
    newsletter subscribe subscription signup login paywall ad ads adv advert adverts advertisement advertising sponsor sponsored
    adsbygoogle taboola outbrain promo promotion comment comments commentlist reader respond replies disqus share sharing social related recommended
    form search toolbar skip""".split())
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|[0-9]+")
_ROOTS = ("article", "main")
#: Elements that can be a main branch.
_CONTAINERS = ("article", "main", "section", "div", "td", "center")


class _Node:
    __slots__ = ("tag", "words", "noise", "parts", "size", "clean", "holds", "signature", "parent")

    def __init__(self, tag: str, attrs: dict[str, str | None] | None = None):
        attrs = attrs or {}
        named = f"{attrs.get('class') or ''} {attrs.get('id') or ''}"
        self.tag = tag
        self.words = {w.lower() for w in _WORD.findall(named)}
        self.noise = (tag in _SKIP or tag in _NOISE_TAGS or (attrs.get("role") or "").lower() in _NOISE_ROLES
                      or "hidden" in attrs or attrs.get("aria-hidden") == "true"
                      or "display:none" in (attrs.get("style") or "").replace(" ", ""))
        self.signature = f"{tag}.{' '.join(sorted((attrs.get('class') or '').split()))}".replace("/", "_")
        self.parts: list[_Node | str] = []
        self.parent: _Node | None = None
        # characters of text, of text outside of noise, articles and main parts
        self.size, self.clean, self.holds = 0, 0, 0


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = _Node("body")
        self.open = [self.root]

    def _close(self, tags: set[str] | frozenset[str], scope: frozenset[str]) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in tags:
                del self.open[k:]
                return
            if self.open[k].tag in scope:
                return

    def _end_head(self) -> None:
        """Close a head whose end tag was left out."""
        if self.open[-1].tag == "head":
            self.open.pop()

    def handle_starttag(self, tag, attrs):
        if tag == "body":
            self._close({"head"}, frozenset())
        if tag in ("html", "body"):
            return
        if tag not in _HEAD:
            self._end_head()
        if tag in _BLOCK:
            self._close({"p"}, _SCOPE)
        if tag in _CLOSES:
            self._close(_CLOSES[tag], frozenset({"ul", "ol", "dl", "table", "menu"}) if tag != "td" else frozenset({"tr", "table"}))
        if tag == "br":
            self.open[-1].parts.append(" ")
            return
        node = _Node(tag, dict(attrs))
        node.parent = self.open[-1]
        self.open[-1].parts.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and tag not in _BLOCK and len(self.open) > 1 and self.open[-1].tag == tag:
            self.open.pop()

    def handle_endtag(self, tag):
        # an end tag of an inline element does not close a block around it
        self._close({tag}, frozenset() if tag in _BLOCK or tag in _SKIP else _BLOCK)

    def handle_data(self, data):
        if data.strip():
            self._end_head()
        self.open[-1].parts.append(data)


def parse(html: str | None) -> _Node:
    """A page's tree, with text sizes and which nodes hold an article."""
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    order, todo = [], [tree.root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [p for p in node.parts if isinstance(p, _Node)]
    for node in reversed(order):
        node.holds = int(node.tag in _ROOTS)
        for p in node.parts:
            if isinstance(p, str):
                node.size += 0 if p.isspace() else len(p)
            elif p.tag not in _SKIP:
                node.size += p.size
                node.holds += p.holds
    for node in order:
        # a class that says "page with sidebar" must not remove the page
        whole = node.holds == tree.root.holds if tree.root.holds else node.size * 2 >= tree.root.size
        if node.words & _NOISE_WORDS and node.tag not in _ROOTS and not whole:
            node.noise = True
    for node in reversed(order):
        node.clean = sum((0 if p.isspace() else len(p)) if isinstance(p, str) else 0 if p.noise else p.clean for p in node.parts)
    return tree.root


def _at(root: _Node, steps: list[str]) -> list[_Node]:
    """The nodes with text whose path of signatures is ``steps``."""
    level = [root] if steps[0] == root.signature else []
    for step in steps[1:]:
        found = []
        for node in level:
            todo = [p for p in reversed(node.parts) if isinstance(p, _Node)]
            while todo:
                x = todo.pop()
                if x.tag in _BLOCK:
                    if x.signature == step:
                        found.append(x)
                elif x.tag not in _SKIP:  # inline elements are no step
                    todo += [p for p in reversed(x.parts) if isinstance(p, _Node)]
        level = found
    return [node for node in level if node.size]


def _roots(root: _Node, main: str | None = None) -> list[_Node]:
    """The nodes of the host's main branch, unless articles overlap them: then
    all marked articles. Without such nodes the marked articles, else the body."""
    marked, chosen = _marked(root), _at(root, main.split("/")) if main else []
    if not chosen or not root.holds:
        return chosen or marked
    around = set()  # the articles and what lies around them
    for node in marked:
        while node is not None and id(node) not in around:
            around.add(id(node))
            node = node.parent
    articles = set(map(id, marked))
    for node in chosen:
        if id(node) in around:
            return marked
        while node is not None:
            if id(node) in articles:
                return marked
            node = node.parent
    return chosen


def _marked(root: _Node) -> list[_Node]:
    """The articles outside of noise (else the main parts, else articles inside
    of noise that was never closed, else the body)."""
    for tag, anywhere in ((t, a) for a in (False, True) for t in _ROOTS if root.holds):
        found, todo = [], [root]
        while todo:
            node = todo.pop()
            if node.tag == tag and node.size:
                found.append(node)
            elif anywhere or not node.noise:
                todo += [p for p in reversed(node.parts) if isinstance(p, _Node)]
        if found:
            return found
    return [root]


def blocks(root: _Node, dropped: set[int] | frozenset[int] = frozenset(), main: str | None = None) -> Iterator[str]:
    """The texts of the article's blocks in page order. ``dropped``: hashes of
    the paths of unimportant branches, ``main``: path of the main branch."""
    return (text for kind, _, text, _ in _walk(root, dropped, main=main) if kind == "text")


def _walk(root: _Node, dropped: set[int] | frozenset[int] = frozenset(), everything: bool = False,
          main: str | None = None) -> Iterator[tuple[str, list[str], str, bool]]:
    """(kind, path of signatures, value, whether in noise) in page order. Kind
    "text": a block's text. With ``everything`` also what is outside the article
    or noise, and kind "style": the signatures of a node's children."""
    roots = _roots(root, main)
    wanted, passed = set(map(id, roots)), set()
    for node in roots:  # what lies around an article is no noise
        while node is not None:
            passed.add(id(node))
            node = node.parent
    path: list[str] = []
    text: list[str] = []
    inside = [False]  # whether each open block lies in a wanted node
    noisy = [False]  # whether it lies in noise
    # a stack instead of recursion, for deeply nested pages
    todo: list[tuple[str, _Node | str]] = [("enter", root)]
    while todo:
        what, x = todo.pop()
        if what == "text":
            text.append(x)
            continue
        if what != "parts":  # a block begins or ends
            line = " ".join("".join(text).split())
            text = []
            if line and (everything or inside[-1]):
                yield "text", path, line, noisy[-1]
            if what == "leave":
                path.pop()
                inside.pop()
                noisy.pop()
            if what != "enter":
                continue
            path.append(x.signature)
            article = x is not root and (inside[-1] and bool(root.holds) or id(x) in wanted)
            if dropped and len(path) <= DEPTH and path_hash(path) in dropped and not article and x.clean * 2 <= root.clean and x.tag not in _ROOTS and not x.holds:
                path.pop()
                continue
            inside.append(inside[-1] or id(x) in wanted)
            noisy.append(noisy[-1] or x.noise)
            todo.append(("leave", x))
            if everything:
                yield "style", path, " ".join(p.signature for p in x.parts if not isinstance(p, str) and p.tag in _BLOCK), noisy[-1]
        for p in reversed(x.parts):
            if isinstance(p, str):
                todo.append(("text", p))
            elif p.tag in _SKIP:
                continue
            elif p.noise and not everything and id(p) not in passed and not (inside[-1] and p.tag in ("header", "hgroup")):
                todo.append(("flush", p))
            else:
                todo.append(("enter" if p.tag in _BLOCK else "parts", p))


def path_hash(path: list[str]) -> int:
    return xxhash.xxh64_intdigest("/".join(path)) - (1 << 63)


def host_of(url: Column) -> Column:
    """Host of a URL, lower-cased; the empty string if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def style_tree(pages: DataFrame, min_pages: int = MIN_PAGES, least: float = LEAST, share: float = SHARE,
               prior: float = PRIOR) -> DataFrame:
    """(host, branches, main) of rows (host, html): the paths of branches whose
    importance is below ``least``, and that of the host's main branch or null.
    Equal pages of a host are one page."""
    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            host, path, content, size, part = [], [], [], [], []
            for h, html, w in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), b.column("part").to_pylist(), strict=True):
                seen: dict[tuple[str, int], float] = {}
                for kind, steps, value, noise in _walk(parse(html), everything=True):
                    p, c = "/".join(steps[:DEPTH]), xxhash.xxh64_intdigest(kind + value) >> 1
                    seen[p, c] = seen.get((p, c), 0) + (kind == "text") * len(value) * (prior if noise else 1)
                    seen[p, -1] = 0  # counts the pages of the node
                whole = sum(seen.values()) or 1
                for (p, c), n in seen.items():
                    host.append(h)
                    path.append(p)
                    content.append(c)
                    size.append(round(1e6 * n / whole))
                    part.append(w)
            yield pa.RecordBatch.from_arrays(
                [pa.array(host, pa.string()), pa.array(path, pa.string()), pa.array(content, pa.int64()), pa.array(size, pa.int64()),
                 pa.array(part, pa.float64())], names=["host", "path", "content", "size", "part"])

    # each of n equal pages counts 1 / n; the pages themselves stay where they are if few are repeated
    pages = pages.select("host", "html", F.md5(F.coalesce("html", F.lit(""))).alias("page"))
    copies = small(pages.groupBy("host", "page").agg(F.count("*").alias("n")).filter("n > 1"), "copies")
    pages = pages.join(copies, ["host", "page"], "left").select("host", "html", (1 / F.coalesce("n", F.lit(1))).alias("part"))
    counts = pages.mapInArrow(contents, "host string, path string, content long, size long, part double").groupBy(
        "host", "path", "content").agg(F.round(F.sum("part")).cast("long").alias("c"), F.round(F.sum(F.col("size") * F.col("part"))).alias("size"))
    # contents by the pages that share them: few rows per node, then its entropy once its pages are known
    real = F.col("content") != -1
    nodes = counts.groupBy("host", "path").agg(
        F.max(F.when(~real, F.col("c"))).alias("m"), F.count_if(real).alias("n"), F.sum(F.when(real, F.log("c"))).alias("logs"),
        F.sum("size").alias("size"), F.sum(F.when(real, F.col("size") * F.log("c"))).alias("shared"))
    # a node on few pages shows nothing about its contents, so they count in full
    known = F.col("m") >= min_pages
    nodes = nodes.select(
        "host", "path", "m", F.when(known, F.col("n")).alias("n"), F.when(known, F.col("n") - F.col("logs") / F.log("m")).alias("importance"),
        (F.col("size") - F.when(known, F.col("shared") / F.log("m")).otherwise(0)).alias("mass"))
    steps = F.split("path", "/")
    # every branch that the node is part of
    branches = nodes.select("*", F.explode(F.transform(F.sequence(F.lit(1), F.size(steps)), lambda k: F.struct(
        F.array_join(F.slice(steps, 1, k), "/").alias("branch"), k.alias("depth")))).alias("b")).select("*", "b.*")
    own = (F.size(steps) == F.col("depth")) | (F.size(steps) == F.col("depth") + 1) & F.element_at(steps, -1).rlike(r"^h[1-6]\.")
    weighed = branches.groupBy("host", "branch", "depth").agg(
        (F.sum("importance") / F.sum("n")).alias("importance"), F.sum("mass").alias("mass"), F.sum(F.when(own, F.col("mass"))).alias("own"),
        F.max(F.when(F.col("path") == F.col("branch"), F.col("m"))).alias("m"))
    # one row per branch; a host's branches with more than half of its content are nested, so one of them is the deepest
    weighed = weighed.withColumn("all", F.max(F.when(F.col("depth") == 1, F.col("mass"))).over(Window.partitionBy("host")))
    tag = F.split(F.element_at(F.split("branch", "/"), -1), r"\.")[0]
    chain = (F.col("mass") > share * F.col("all")) & (F.col("m") >= min_pages) & tag.isin("body", *_CONTAINERS)
    place = F.struct("depth", "branch")
    # one pass over the branches, which are computed from all pages
    found = weighed.groupBy("host").agg(
        F.collect_list(F.when((F.col("importance") < least) & (F.col("depth") > 1), F.col("branch"))).alias("branches"),
        F.min(F.when(chain & (F.col("own") > 1e-6 * F.col("all")), place)).alias("top"), F.max(F.when(chain, place)).alias("deepest"))
    main = F.coalesce("top", "deepest")
    return found.select("host", "branches", F.when(main["depth"] > 1, main["branch"]).alias("main"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            main_col: str | None = None) -> DataFrame:
    """One row per page: id, url and ``text``, the article's blocks joined by
    ``\\n``.

    A null or empty html has the empty text; a null url is a host of its own
    name, the empty one. Pages of hosts below ``MIN_PAGES`` are judged by their
    presentation alone. With ``main_col`` that column names the host's main
    branch, null where there is none. Repeated rows are pages of their own; other columns are
    not read. An empty table gives an empty result.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                        host_of(F.col(url_col)).alias("host"))
    low = style_tree(rows.select("host", "html")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("url", "id"), F.lit(SALTS)).cast("int"))
    joined = salted.join(low, ["host", "salt"], "left").select("id", "url", "html", "branches", "main")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for html, branches, main in zip(*(b.column(c).to_pylist() for c in ("html", "branches", "main")), strict=True):
                low = {path_hash(x.split("/")) for x in branches or ()}
                found.append("\n".join(blocks(parse(html), low, main)))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("url"), pa.array(found, pa.string()), b.column("main")],
                                             names=["id", "url", "text", "main"])

    kinds = {c: pages.schema[c].dataType.simpleString() for c in (id_col, url_col)}
    done = joined.mapInArrow(texts, f"id {kinds[id_col]}, url {kinds[url_col]}, text string, main string")
    return done.toDF(id_col, url_col, "text", main_col) if main_col else done.drop("main").toDF(id_col, url_col, "text")
