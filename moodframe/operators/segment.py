"""Pages and documents -> numbered scenes with a word budget.

A document (or page) is one row and stays one row until its scenes are
exploded: line splitting, cleaning, consecutive de-duplication, word counts
and the greedy packing fold are all higher-order functions on that row's
array. So segmentation is a narrow, map-only stage, and a document's work is
bounded by its own size. The only Python is the HTML tree
walk of C1 (stdlib ``html.parser``, in Arrow batches via ``mapInPandas``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodframe.functions import text as tx
from moodframe.functions.parse import histogram_bar, numbered_titles
from moodframe.operators.sequence import scene_position

# --- fixed values -----------------------------------------------------------
# Elements removed before the text is read (tag names, .class, #id).
IRRELEVANT_SELECTORS = ("table", "figure", "sup", "style", "script", ".mw-editsection", ".toc",
                        "#toc", ".printfooter", ".asst-ad")
# Content root of a wiki page: tag and class.
CONTENT_ROOT = ("div", "mw-parser-output")
# Elements whose text becomes lines.
TEXT_ELEMENTS = ("p", "li")
# Parts of an episode's rating page: root and bars (data-testid), overall rating (class).
RATING_ROOT, BAR_PREFIX, OVERALL_CLASS = "rating-histogram", "rating-histogram-bar-", "ipc-rating-star--rating"
# ---------------------------------------------------------------------------

VOID_TAGS = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
                       "param", "source", "track", "wbr"))
# Plain tags, which most are; the parser reads all others itself.
_START = re.compile(r'<([a-zA-Z][a-zA-Z0-9]*)((?: [a-zA-Z][a-zA-Z0-9-]*="[^"]*")*)>')
_ATTRIBUTE = re.compile(r' ([a-zA-Z0-9-]+)="([^"]*)"')
_END = re.compile(r"</([a-zA-Z][a-zA-Z0-9]*)>")
# Elements whose contents a parser may not read as markup.
_RAW = frozenset(("script", "style", "textarea", "title", "plaintext", "xmp", "iframe", "noembed", "noframes", "noscript"))


# C8 --------------------------------------------------------------------------
def with_scenes(df: DataFrame, lines: str, out_col: str = "scenes", max_words: int = tx.MAX_WORDS,
                ws: str = tx.WS) -> DataFrame:
    """Greedy packing of ordered lines into scenes of at most ``max_words``
    words: a new scene starts when the next line would overflow a non-empty
    scene; one over-long line stays whole. Lines are joined by newline.

    A sequential fold with reset, so it is not a window sum. The words of every
    line are counted once, in a column of their own; the fold sees those numbers
    only and notes the lines at which scenes begin; the scenes are then slices
    of the lines. The columns in between are used several times each, which
    keeps the optimizer from inlining them into a lambda."""
    d = df.withColumn("__words", F.transform(lines, lambda x: tx.word_count(x, ws)))
    state = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).alias("i"), F.lit(0).alias("held"))

    def step(s, w):
        new = (s["i"] == 0) | (s["held"] + w > max_words)
        return F.struct(F.when(new, F.array_append(s["starts"], s["i"] + 1)).otherwise(s["starts"]).alias("starts"),
                        (s["i"] + 1).alias("i"), F.when(new, w).otherwise(s["held"] + w).alias("held"))

    d = d.withColumn("__starts", F.aggregate("__words", state, step, lambda s: s["starts"]))
    ends = F.concat(F.slice("__starts", 2, F.greatest(F.size("__starts"), F.lit(1))), F.array(F.size("__words") + 1))
    d = d.withColumn("__spans", F.when(F.size("__starts") > 0, F.zip_with(
        "__starts", ends, lambda a, b: F.struct(a.alias("at"), (b - a).alias("n")))).otherwise(
        F.array().cast("array<struct<at:int,n:int>>")))
    return d.withColumn(out_col, F.transform("__spans", lambda x: F.array_join(F.slice(F.col(lines), x["at"], x["n"]), "\n"))
                        ).drop("__words", "__starts", "__spans")


def explode_scenes(df: DataFrame, keys: Sequence[str], scenes_col: str = "scenes",
                   ws: str = tx.WS, places: int = 4) -> DataFrame:
    """C9 + F4: one row per scene with 0-based ``scene_idx``, ``n_scenes``,
    ``position = round(i/(n-1), 4)`` (0.0 for a one-scene document) and the
    word count. ``n`` is the array size, so no window is needed."""
    d = tx.explode_positions(df.withColumn("n_scenes", F.size(scenes_col)), scenes_col,
                             [*keys, "n_scenes"], "scene_idx", "text")
    return d.select(
        *keys,
        F.col("scene_idx").cast("int").alias("scene_idx"),
        F.col("n_scenes").cast("int").alias("n_scenes"),
        scene_position("scene_idx", "n_scenes", places).alias("position"),
        tx.word_count("text", ws).alias("n_words"),
        "text",
    )


def _dealt(df: DataFrame, num_partitions: int | None) -> DataFrame:
    return df.repartition(num_partitions) if num_partitions else df


def segment_documents(docs: DataFrame, keys: Sequence[str] = ("doc_id",), text_col: str = "text",
                      max_words: int = tx.MAX_WORDS, phrases: Sequence[str] = tx.IGNORE_PHRASES,
                      punct: Sequence[str] = tx.PUNCT_LINES, unicode: bool = True,
                      num_partitions: int | None = None) -> DataFrame:
    """C3-C9 on plain text: clean lines, pack scenes, one row per scene.
    ``num_partitions``: deal the rows first, for files with fewer row groups
    than there are cores; without it the work stays where the scan put it."""
    ws = tx.WS if unicode else tx.WS_ASCII
    d = tx.with_text_lines(_dealt(docs.select(*keys, text_col), num_partitions), text_col, "__lines", phrases, punct, unicode)
    return explode_scenes(with_scenes(d, "__lines", "scenes", max_words, ws).select(*keys, "scenes"), list(keys), "scenes", ws)


# C1 / C2 ---------------------------------------------------------------------
class _Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag = tag
        self.attrs = attrs
        self.children = []
        self.parent = parent


class _TreeBuilder(HTMLParser):
    """Minimal tree with the lenient nesting of a forgiving parser: an end tag
    closes the nearest open element of that name (ignored when none is open);
    an unclosed ``<p>`` keeps what follows as its children."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("#root", {}, None)
        self.cur = self.root

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, dict(attrs), self.cur)
        self.cur.children.append(node)
        if tag not in VOID_TAGS:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        self.cur.children.append(_Node(tag, dict(attrs), self.cur))

    def handle_endtag(self, tag):
        n = self.cur
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.cur = n.parent

    def handle_data(self, data):
        self.cur.children.append(data)

    def updatepos(self, i, j):
        return j  # line numbers are not asked for

    def parse_starttag(self, i):
        m = _START.match(self.rawdata, i)
        if m is None or (tag := m[1].lower()) in _RAW:
            return super().parse_starttag(i)
        self.lasttag = tag
        self.handle_starttag(tag, [(a.lower(), unescape(v)) for a, v in _ATTRIBUTE.findall(m[2])] if m[2] else ())
        return m.end()

    def parse_endtag(self, i):
        m = None if self.cdata_elem is not None else _END.match(self.rawdata, i)
        if m is None:
            return super().parse_endtag(i)
        self.handle_endtag(m[1].lower())
        return m.end()


def _find(node: _Node, tag: str, cls: str | None):
    """First element in document order with this tag (and class)."""
    stack = [c for c in reversed(node.children) if isinstance(c, _Node)]
    while stack:
        n = stack.pop()
        if n.tag == tag and (cls is None or cls in (n.attrs.get("class") or "").split()):
            return n
        stack.extend(c for c in reversed(n.children) if isinstance(c, _Node))
    return None


def _strip_nodes(node: _Node, selectors: Sequence[str]) -> None:
    """Drop every element matching a selector, with its subtree."""
    tags = {x for x in selectors if "." not in x and not x.startswith("#")}
    ids = {x[1:] for x in selectors if x.startswith("#")}
    classes = {x[1:] for x in selectors if x.startswith(".")}
    pairs = [x.split(".", 1) for x in selectors if "." in x and x[0] not in ".#"]

    def dropped(n: _Node) -> bool:
        if n.tag in tags:
            return True
        if not n.attrs:
            return False
        held = (n.attrs.get("class") or "").split()
        return (n.attrs.get("id") in ids or not classes.isdisjoint(held)
                or any(n.tag == tag and cls in held for tag, cls in pairs))

    stack = [node]
    while stack:
        n = stack.pop()
        keep = []
        for ch in n.children:
            if isinstance(ch, _Node):
                if dropped(ch):
                    continue
                stack.append(ch)
            keep.append(ch)
        n.children = keep


def _strings(node: _Node, out: list[str]) -> None:
    """Stripped, non-empty text pieces below ``node`` in document order."""
    stack = list(reversed(node.children))
    while stack:
        ch = stack.pop()
        if isinstance(ch, _Node):
            stack.extend(reversed(ch.children))
        else:
            t = ch.strip()
            if t:
                out.append(t)


def _element_texts(node: _Node, tags: Sequence[str], out: list[str], joiner: str = "\n") -> None:
    """Text of every element named in ``tags`` in document order; nested
    ones are read again on their own."""
    stack = [c for c in reversed(node.children) if isinstance(c, _Node)]
    while stack:
        ch = stack.pop()
        if ch.tag in tags:
            parts: list[str] = []
            _strings(ch, parts)
            out.append(joiner.join(parts))
        stack.extend(c for c in reversed(ch.children) if isinstance(c, _Node))


def html_element_texts(html: str | None, root: tuple[str, str | None] = CONTENT_ROOT,
                       selectors: Sequence[str] = IRRELEVANT_SELECTORS,
                       tags: Sequence[str] = TEXT_ELEMENTS, joiner: str = "\n") -> tuple[list[str] | None, str | None]:
    """(text of every ``p``/``li`` below the content root in document order,
    error). Each element's text is its stripped strings joined by ``joiner``; a
    nested element is read again on its own (as the reference does)."""
    if html is None:
        return None, "no html"
    b = _TreeBuilder()
    try:
        b.feed(html)
        b.close()
    except Exception as e:  # noqa: BLE001 - malformed markup becomes an error row
        return None, f"parse error: {e}"
    content = _find(b.root, root[0], root[1]) if root else b.root
    if content is None:
        return None, "no content root"
    _strip_nodes(content, selectors)
    out: list[str] = []
    _element_texts(content, tags, out, joiner)
    return out, None


def page_element_texts(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                       root: tuple[str, str | None] = CONTENT_ROOT,
                       selectors: Sequence[str] = IRRELEVANT_SELECTORS,
                       tags: Sequence[str] = TEXT_ELEMENTS, joiner: str = "\n") -> DataFrame:
    """``(id, texts array<string>, error)`` per page, parsed in Arrow
    batches by a Python worker (the only non-native step of segmentation)."""
    id_type = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            res = [html_element_texts(h, root, selectors, tags, joiner) for h in pdf[html_col]]
            yield pd.DataFrame({id_col: pdf[id_col], "texts": [r[0] for r in res],
                                "error": [r[1] for r in res]})

    return pages.select(id_col, html_col).mapInPandas(
        run, f"{id_col} {id_type}, texts array<string>, error string")


def page_lines(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
               root: tuple[str, str | None] = CONTENT_ROOT,
               selectors: Sequence[str] = IRRELEVANT_SELECTORS,
               phrases: Sequence[str] = tx.IGNORE_PHRASES, punct: Sequence[str] = tx.PUNCT_LINES,
               unicode: bool = True, num_partitions: int | None = None) -> DataFrame:
    """``(id, lines array<string>, error)``: element texts split into
    lines, cleaned and consecutively de-duplicated over the whole page.
    ``num_partitions`` as in ``segment_documents``."""
    t = page_element_texts(_dealt(pages.select(id_col, html_col), num_partitions), id_col, html_col, root, selectors)
    brk = tx.LINE_BREAKS if unicode else tx.LINE_BREAKS_ASCII
    raw = t.withColumn("__raw", F.flatten(F.transform("texts", lambda s: F.split(s, brk))))
    out = tx.with_text_lines(raw, "__raw", "lines", phrases, punct, unicode, split=False)
    return out.select(id_col, "lines", "error")


def segment_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                  root: tuple[str, str | None] = CONTENT_ROOT, max_words: int = tx.MAX_WORDS,
                  unicode: bool = True, num_partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(scenes, rejected pages). A page without html, with broken markup
    or without the content root is rejected with its ``error``."""
    ws = tx.WS if unicode else tx.WS_ASCII
    pl = page_lines(pages, id_col, html_col, root, unicode=unicode, num_partitions=num_partitions)
    packed = with_scenes(pl.filter(F.col("error").isNull()), "lines", "scenes", max_words, ws)
    return (explode_scenes(packed.select(id_col, "scenes"), [id_col], "scenes", ws),
            pl.filter(F.col("error").isNotNull()).select(id_col, "error"))


# C10 / C11 on pages ------------------------------------------------------------
def page_numbered_titles(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                         root: tuple[str, str | None] = CONTENT_ROOT) -> DataFrame:
    """``(id, number, title)`` from the ``td`` and ``li`` cells below the
    content root. A cell's strings are joined without a separator; a nested cell
    is read again on its own. Pages without the root give no rows."""
    cells = page_element_texts(pages, id_col, html_col, root, (), ("td", "li"), joiner="")
    return cells.select(id_col, F.explode("texts").alias("cell")).select(id_col, F.inline(numbered_titles("cell")))


def rating_page(html: str | None) -> tuple[float | None, list[str], str | None]:
    """(overall rating, labels of the vote bars in page order, error) of an
    episode page."""
    b = _TreeBuilder()
    b.feed(html or "")
    b.close()
    root = _first(b.root, lambda n: n.attrs.get("data-testid") == RATING_ROOT)
    if root is None:
        return None, [], "no rating histogram"
    star = _first(root, lambda n: n.tag == "span" and OVERALL_CLASS in (n.attrs.get("class") or "").split())
    text: list[str] = []
    if star is not None:
        _strings(star, text)
    try:
        overall = float("".join(text))
    except ValueError:
        overall = None
    labels, stack = [], list(reversed(root.children))
    while stack:
        n = stack.pop()
        if isinstance(n, _Node):
            if n.tag == "a" and (n.attrs.get("data-testid") or "").startswith(BAR_PREFIX):
                labels.append(n.attrs.get("aria-label") or "")
            stack.extend(reversed(n.children))
    return overall, labels, None if overall is not None else "no overall rating"


def _first(node: _Node, wanted) -> _Node | None:
    stack = [c for c in reversed(node.children) if isinstance(c, _Node)]
    while stack:
        n = stack.pop()
        if wanted(n):
            return n
        stack.extend(c for c in reversed(n.children) if isinstance(c, _Node))
    return None


def page_ratings(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """C11: ``(id, overall_rating, histogram array<struct<stars, votes>>, error)``
    per page. Of several bars of one star the last in the page wins; bars whose
    label does not match are skipped."""
    id_type = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            res = [rating_page(h) for h in pdf[html_col]]
            yield pd.DataFrame({id_col: pdf[id_col], "overall_rating": [r[0] for r in res],
                                "labels": [r[1] for r in res], "error": [r[2] for r in res]})

    raw = pages.select(id_col, html_col).mapInPandas(
        run, f"{id_col} {id_type}, overall_rating double, labels array<string>, error string")

    def bar(label, pos):
        votes, stars = histogram_bar(label)
        return F.struct(stars.alias("stars"), pos.alias("pos"), votes.alias("votes"))

    bars = raw.withColumn("bars", F.sort_array(F.filter(F.transform("labels", bar), lambda x: x["stars"].isNotNull())))
    last = F.filter("bars", lambda x, i: F.coalesce(x["stars"] != F.get("bars", i + 1)["stars"], F.lit(True)))
    return bars.select(id_col, "overall_rating", F.transform(
        last, lambda x: F.struct(x["stars"].alias("stars"), x["votes"].alias("votes"))).alias("histogram"), "error")


# C2 regex variant (native, SQL-checkable) ---------------------------------------
def strip_blocks(html: Column | str, tags: Sequence[str] = ("script", "style")) -> Column:
    """Remove whole ``<script>``/``<style>`` blocks with a regex (their
    content may hold ``</p>`` text)."""
    h = F.col(html) if isinstance(html, str) else html
    for t in tags:
        h = F.regexp_replace(h, rf"(?is)<{t}\b.*?</{t}>", "")
    return h


def regex_element_texts(html: Column | str, tag: str = "p") -> Column:
    """Text of each ``<tag>...</tag>`` found by regex (inner tags removed,
    trimmed) after script/style blocks are stripped."""
    h = strip_blocks(html)
    inner = F.regexp_extract_all(h, F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1))
    return F.transform(inner, lambda s: F.trim(F.regexp_replace(s, r"<[^>]*>", " ")))
