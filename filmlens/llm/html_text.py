"""Main text of web pages: page structure, and what a host repeats on its pages.

A page becomes a stream of text blocks. What the markup names as menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles or comments is left
out; ``article`` and ``main`` elements are candidates for the content.

Host suffix array: the block streams of a host's pages are put in order by
their suffixes, each named by the shortest run of blocks from its start with at
least eight words. Runs that stand on pages of different content are repeated
substrings, and every page is judged by them. Where the markup leaves several
candidates, the one with the most words in unique runs is chosen, and its unique
runs are the content; where it names none, the unique runs of the page are. Inside
a single candidate prose is repeated too (README has the figures), so there a run
is boilerplate if it belongs to the host's template: it stands on at least four
of the host's contents and on half of them. By the same measure a shorter block
goes where the markup leaves a choice. A candidate or page whose blocks are all
repeated (it copies another) keeps its blocks.

Suffixes are dealt by host and run, so a host with a third of all pages is
spread over all tasks. Pages are read again instead of being moved.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlens.llm.common import table
from filmlens.sources.staging import materialize

RUN_WORDS = 8
TEMPLATE_CONTENTS = 4
TEMPLATE_SHARE = 0.5
"""Of a host's contents, how many and what share a run of its template stands on."""

# Element and attribute words, by what they stand for.
_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
_SKIPPED = {"nav", "footer", "aside", "form", "noscript", "template", "svg", "math", "button", "select", "object", "audio", "video", "canvas", "dialog", "menu", "head", "map"} | _RAW
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "embed", "font", "i", "img", "ins", "kbd", "label", "link", "mark", "meta",
    "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
_NAMED = {
    "ad", "ads", "adbox", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner",
    "cookie", "cookies", "consent", "gdpr", "notice", "notification", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login",
    "sidebar", "menu", "navbar", "nav", "navigation", "breadcrumb", "breadcrumbs", "toolbar", "pagination", "pager", "footer", "masthead", "topbar",
    "comment", "comments", "commentlist", "disqus", "respond", "replies", "share", "sharing", "social", "related", "recommended", "widget", "widgets",
}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar"}
_ABOUT = {"no", "has", "with", "without"}
_CLOSED_BY_BLOCK = {"p"}
_SAME_CLOSES = {"li", "dt", "dd", "tr", "td", "th", "option"}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S)
_NAMES = re.compile(r"(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)", re.I)
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_PARTS = re.compile(r"[^a-z0-9]+")
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


@dataclass
class Page:
    """``texts``: the blocks that are not left out; ``roots``: for each, its candidate's number or -1."""

    texts: list[str] = field(default_factory=list)
    roots: list[int] = field(default_factory=list)
    n_roots: int = 0


_KEPT, _NAMED_OUT, _OUT = 0, 1, 2


def _left_out(name: str, attributes: str, in_root: bool, by_name: bool) -> int:
    """Whether an element is left out: by its kind, or only by what its class or id says of it."""
    if name in _SKIPPED or (name == "header" and not in_root):
        return _OUT
    if not attributes or name in ("html", "body"):
        return _KEPT
    if "hidden" in attributes and _HIDDEN.search(_QUOTED.sub('""', attributes)):
        return _OUT
    for key, a, b, c in _NAMES.findall(attributes):
        value = (a or b or c).lower()
        if key.lower() == "role":
            if value.strip() in _ROLES:
                return _OUT
        elif key.lower() != "itemprop" and by_name:
            for word in value.split():
                parts = _PARTS.split(word)
                if _NAMED.isdisjoint(parts) or parts[0] in _ABOUT:
                    continue
                if "comment" in word:
                    return _OUT
                # A container is named for what it holds.
                if name not in ("article", "main"):
                    return _NAMED_OUT
    return _KEPT


def _is_root(name: str, attributes: str) -> bool:
    if name in ("article", "main"):
        return True
    return any((k.lower() == "role" and v.strip() == "main") or (k.lower() == "itemprop" and v.strip() == "articlebody") for k, v in ((k, (a or b or c).lower()) for k, a, b, c in _NAMES.findall(attributes)))


def parse(source: str) -> Page:
    """Blocks of a page; bad markup is read the way browsers do, as far as text is concerned.

    Where classes and ids would leave nothing, they are not believed.
    """
    page = _parse(source, True)
    return page if page.texts else _parse(source, False)


def _parse(source: str, by_name: bool) -> Page:
    page = Page()
    parts: list[str] = []
    stack: list[tuple[str, int, int]] = [("", _KEPT, -1)]  # name, left out, candidate
    at = 0

    def flush() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            page.texts.append(text)
            page.roots.append(stack[-1][2])

    while True:
        tag = _TAG.search(source, at)
        if not stack[-1][1]:
            # Each piece by itself: a reference does not reach over a tag.
            parts.append(html.unescape(source[at : tag.start() if tag else len(source)]))
        if tag is None:
            break
        at = tag.end()
        closing, name, attributes = (tag[1], tag[2], tag[3]) if tag[2] else (tag[4], tag[5], tag[6])
        if not name:
            continue
        name = name.lower()
        if name not in _INLINE and not stack[-1][1]:
            flush()
        elif name == "br":
            parts.append(" ")
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            continue
        if name in _VOID or attributes.endswith("/") and name not in _RAW:
            continue
        if name in _RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(source, at)
            at = end.start() if end else len(source)
            continue
        if name not in _INLINE and stack[-1][0] in _CLOSED_BY_BLOCK or name in _SAME_CLOSES and stack[-1][0] == name:
            stack.pop()
        left_out, root = stack[-1][1], stack[-1][2]
        if left_out != _OUT:
            own = _left_out(name, attributes, root >= 0, by_name)
            is_root = not own and root < 0 and _is_root(name, attributes)
            if own and not left_out:
                flush()
            # The content element counts even inside a wrapper whose class names something else.
            left_out = own if own or is_root else left_out
            if is_root:
                root = page.n_roots
                page.n_roots += 1
        stack.append((name, left_out, root))
    flush()
    return page


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def _named(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\n".join(parts)) - (1 << 63)


def suffixes(page: Page, host: str) -> list[tuple[int, int, int]]:
    """For each block that starts a run of at least ``RUN_WORDS`` words: hash of host and run, first and last block."""
    counts = [len(t.split()) for t in page.texts]
    out = []
    for i in range(len(counts)):
        words, j = counts[i], i
        while words < RUN_WORDS and j + 1 < len(counts):
            j += 1
            words += counts[j]
        if words >= RUN_WORDS:
            out.append((_named(host, *page.texts[i : j + 1]), i, j))
    return out


def short_blocks(page: Page, host: str) -> list[tuple[int, int, int]]:
    """The blocks too short for a run of their own, in the form of ``suffixes``."""
    return [(_named(host, "", t), i, i) for i, t in enumerate(page.texts) if len(t.split()) < RUN_WORDS]


def default_root(page: Page) -> int:
    """The only candidate; -1 if there is none, -2 if there are several."""
    used = sorted({r for r in page.roots if r >= 0})
    return -1 if not used else used[0] if len(used) == 1 else -2


def main_text(page: Page, covered: set[int]) -> str:
    """The content's blocks, by the blocks that the host repeats."""
    root = default_root(page)
    if root == -2:
        unique: dict[int, int] = {}
        for k, (text, r) in enumerate(zip(page.texts, page.roots, strict=True)):
            if r >= 0:
                unique[r] = unique.get(r, 0) + (0 if k in covered else len(text.split()))
        root = max(sorted(unique), key=lambda r: unique[r])
    inside = [k for k, r in enumerate(page.roots) if root < 0 or r == root]
    left = [k for k in inside if k not in covered]
    return "\n".join(page.texts[k] for k in left or inside)


_ANY, _TEMPLATE, _COUNTED, _PAGE = 0, 1, 2, 3
"""What a run's blocks are left out for: any repetition, being of the host's template, or nothing (it is only counted); a page as a whole."""


def _suffix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of every page, and the page as a whole."""
    for batch in batches:
        hosts, runs, contents, firsts, lasts, owners, uses = [], [], [], [], [], [], []
        for k, (url, source) in enumerate(zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True)):
            page, name = parse(source or ""), host_of(url)
            host, content = _named(name), _named(*page.texts)
            root = default_root(page)
            found = [(run, i, j, _ANY if root < 0 else _TEMPLATE if {*page.roots[i : j + 1]} == {root} else _COUNTED) for run, i, j in suffixes(page, name)]
            found += [(run, i, j, _TEMPLATE) for run, i, j in (short_blocks(page, name) if root < 0 else ())]
            for run, i, j, use in [*found, (_named("", "", "", *page.texts), None, None, _PAGE)]:
                hosts.append(host)
                runs.append(run)
                contents.append(content)
                firsts.append(i)
                lasts.append(j)
                owners.append(k)
                uses.append(use)
        take = pa.array(owners, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.int64()), pa.array(runs, pa.int64()), pa.array(contents, pa.int64()), batch.column("page_hash").take(take)]
            + [pa.array(firsts, pa.int32()), pa.array(lasts, pa.int32()), pa.array(uses, pa.int32())],
            names=["host", "run", "content", "page_hash", "first", "last", "use"],
        )


def covered_blocks(pages: DataFrame) -> DataFrame:
    """``page_hash``, ``covered``: the blocks that the host repeats, as intervals."""
    rows = pages.mapInArrow(_suffix_rows, "host bigint, run bigint, content bigint, page_hash bigint, first int, last int, use int")
    # Most runs stand on one content: they end here.
    counted = rows.groupBy("host", "run").agg(F.min("content").alias("c0"), F.max("content").alias("c1"), F.min("use").alias("least"))
    counted = materialize(counted.filter((F.col("least") == _PAGE) | (F.col("c0") != F.col("c1")) & (F.col("least") < _COUNTED)), "repeated-runs")
    sizes = counted.filter(F.col("least") == _PAGE).groupBy(F.col("host").alias("h_host")).agg(F.count(F.lit(1)).alias("contents"))
    # Written by itself: its size tells the planner whether to broadcast it.
    repeated = materialize(counted.filter(F.col("least") < _COUNTED).select(F.col("run").alias("r_run")), "repeated-names")
    found = rows.join(repeated, F.col("run") == F.col("r_run")).select("host", "run", "content", "page_hash", "first", "last", "use")
    found = materialize(found, "repeated-places")
    spread = found.groupBy("host", "run").agg(F.count_distinct("content").alias("on")).filter(F.col("on") >= TEMPLATE_CONTENTS)
    template = spread.join(sizes, F.col("host") == F.col("h_host")).filter(F.col("on") >= F.col("contents") * TEMPLATE_SHARE).select(F.col("run").alias("t_run"))
    parts = found.filter(F.col("use") < _COUNTED).join(template, F.col("run") == F.col("t_run"), "left")
    parts = parts.filter((F.col("use") == _ANY) | F.col("t_run").isNotNull()).select("page_hash", F.struct("first", "last").alias("part")).distinct()
    return parts.groupBy("page_hash").agg(F.collect_list("part").alias("covered"))


def _text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for source, parts in zip(batch.column("html").to_pylist(), batch.column("covered").to_pylist(), strict=True):
            covered = {k for p in parts or [] for k in range(p["first"], p["last"] + 1)}
            texts.append(main_text(parse(source or ""), covered))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """One row per input row: ``page_id``, ``url``, ``text`` (blocks joined by line ends; empty if none).

    A null or empty page has no text; a null or odd url is a host without a
    name. Repeated rows, and pages with one id, are each read by themselves;
    equal pages do not count as repeating each other. Other columns are not read.
    """
    read = pages.select(F.col(f"`{id_column}`").cast("bigint").alias("page_id"), F.col(f"`{url_column}`").alias("url"), F.col(f"`{html_column}`").alias("html"))
    read = read.withColumn("page_hash", F.xxhash64("url", "html"))
    # A written table: the join with the pages is a broadcast only where this is small.
    found = materialize(covered_blocks(read).withColumnRenamed("page_hash", "c_hash"), "covered-blocks")
    joined = read.join(found, F.col("page_hash") == F.col("c_hash"), "left").select("page_id", "url", "html", "covered")
    return joined.mapInArrow(_text_rows, "page_id bigint, url string, text string")


NAME = "op10_html_text"


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, folder, "pages")).withColumn("n_chars", F.char_length("text").cast("bigint"))


# Reading markup has no SQL form; tests hold the query against another parser.
ORACLE_SQL = None
