"""Main text of web pages, without what a site repeats around it.

One pass over a page gives its text pieces and its elements, each with the range of pieces it covers and
a hash of its subtree (made of tag and the hashes of its children, so every hash costs one step). Spark
counts, for each host, on how many pages of different content a container subtree occurs; subtrees that
recur on ten or more are the site's template, whatever the size of the host, and are deleted from its pages
(each page meets only the marks that it holds itself), together with what is marked as
menu, header, footer, sidebar, notice, advert, form, script, style or reader comment by tag, class, id or
role. Text blocks themselves (paragraphs, headings, items, quotes) are never template inside an article,
however often a passage recurs.

The main text is that of the article elements, else of ``main``, else of the body. References are decoded,
white space within a block becomes one space, blocks are joined by an empty line. Nothing is cut off.

Edge cases: NULL html is an empty page with empty text; unclosed, crossed and cut-off tags are closed by
their parents; text outside any tag is body text; a NULL URL is a host of its own; repeated pages have
equal content and count once towards a template, and so do near copies, known by a sketch of the text; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.line_dedup import shingle_hashes
from tickloom.llm.skew import lookup
from tickloom.operators.joins import is_small
from tickloom.session import store

LEAST_PAGES = 10
SEEN = "host string, page string, content long, sketch array<long>, marks array<long>"
SHINGLE, SKETCH = 12, 128
NEAR = 0.7
SALTS = 64

# A comment, the beginning of a tag, or another kind of markup.
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)|<[!?/][^>]*>", re.S)
STOP = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"([a-zA-Z][-a-zA-Z]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|\b(hidden)\b")
SPACE = re.compile(r"\s+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "tfoot thead tr ul".split()
)
CELL = frozenset(("td", "th", "br"))
DROP = frozenset(
    "head nav footer aside form script style template iframe svg embed button select option textarea menu dialog title xmp "
    "datalist".split()
)
# What these hold is shown where the element itself is not; dropped outside the article only.
DROP_OUTSIDE = frozenset("noscript canvas object audio video map header".split())
ROOTS = frozenset(("html", "body", "main", "article"))
CONTAINER = frozenset("div section ul ol dl table figure details fieldset center dir header".split())
CLOSES = {  # an opening tag ends an open one of these
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "body": ("head",),
}
SCOPES = frozenset("ul ol dl table article section div body html main blockquote td th".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner menu nav navbar navigation "
    "breadcrumb breadcrumbs masthead footer sidebar notice notices cookie cookies consent gdpr popup modal overlay newsletter "
    "subscribe signup share sharing social related recommended recommendations toolbar widget pagination pager skip login".split()
)
COMMENTS = frozenset("comment comments commentlist disqus replies respond discussion".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
HEAD_MARKS = frozenset(("header", "topbar"))


def _marked(tag: str, attributes: str, inside: bool) -> bool:
    """Whether the attributes name something that is not main text. The elements that hold the text as a whole
    never do, whatever their class says about the page (but for articles that are comments by a class of
    their own, not just by a word in it); within the article only containers do."""
    if tag in ROOTS or (inside and tag not in CONTAINER):
        classes = (v for name, a, b, c, _ in ATTRIBUTE.findall(attributes) if name.lower() == "class" for v in (a or b or c).lower().split())
        return tag == "article" and not COMMENTS.isdisjoint(classes)
    for name, a, b, c, hidden in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if hidden or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
            return True
        if name in ("class", "id", "role"):
            words = set(re.split(r"[^a-z0-9]+", value))
            if words & COMMENTS or (name == "role" and words & ROLES):
                return True
            if words & MARKS or (not inside and words & HEAD_MARKS):
                return True
    return False


class _Quotes:
    """Finds the end of a tag. A quote that is never closed is remembered, so that no text is searched twice for it."""

    def __init__(self, source: str) -> None:
        self.source, self.last, self.open, self.lost = source, source.rfind(">"), set(), False

    def end(self, at: int) -> int:
        """Place of the ``>`` that ends the tag whose attributes begin at ``at``; -1 if there is none."""
        if at > self.last:
            return -1
        here = at
        while not self.lost and (met := STOP.search(self.source, here)):
            if met[0] == ">":
                return met.start()
            here = met.end()
            if met[0] not in self.open:
                close = self.source.find(met[0], here)
                if close < 0:
                    self.open.add(met[0])
                    break
                here = close + 1
            else:
                break
        else:
            self.lost = True
        return self.source.find(">", at)


class Page:
    """Pieces of text (None between blocks) and elements (hash, first, end, tag, dropped, inside article)."""

    def __init__(self, source: str) -> None:
        self.pieces: list[str | None] = []
        self.elements: list[tuple[int, int, int, str, bool, bool]] = []
        stack: list[list] = []  # tag, first piece, hashes of children, dropped, inside
        opened: Counter[str] = Counter()
        quotes = _Quotes(source)
        top: list[int] = []
        at = 0

        def text(value: str) -> None:
            if value:
                value = entities.unescape(value) if "&" in value else value
                self.pieces.append(value)
                key = " ".join(value.split())
                if key:
                    (stack[-1][2] if stack else top).append(xxhash.xxh64_intdigest(key))

        def close() -> None:
            tag, first, children, dropped, inside = stack.pop()
            opened[tag] -= 1
            mark = xxhash.xxh64_intdigest(tag + "".join([f"{h:016x}" for h in children]))
            if tag in BLOCK:
                self.pieces.append(None)
            self.elements.append((mark, first, len(self.pieces), tag, dropped, inside))
            (stack[-1][2] if stack else top).append(mark)

        while found := TAG.search(source, at):
            end, tag = found[1], found[2]
            if tag:
                stop = quotes.end(found.end())
                if stop < 0:
                    break  # no tag ends any more
                attributes = source[found.end() : stop]
            text(source[at : found.start()])
            at = stop + 1 if tag else found.end()
            if not tag:
                continue
            tag = tag.lower()
            if end:
                if opened[tag]:
                    while stack[-1][0] != tag:
                        close()
                    close()
                elif tag in BLOCK:
                    self.pieces.append(None)
                continue
            if stack and stack[-1][0] == "head" and tag in BLOCK:
                close()
            ends = CLOSES.get(tag, ("p",) if tag in BLOCK else ())
            for depth in range(len(stack) - 1, -1, -1) if any(opened[e] for e in ends) else ():
                if stack[depth][0] in ends:
                    while len(stack) > depth:
                        close()
                    break
                if stack[depth][0] in SCOPES:
                    break
            if tag in BLOCK:
                self.pieces.append(None)
            elif tag in CELL:
                self.pieces.append(" ")
            if tag in VOID:
                continue
            inside = tag in ("article", "main") or bool(stack and stack[-1][4])
            dropped = (bool(stack) and stack[-1][3]) or tag in DROP or (tag in DROP_OUTSIDE and not inside) or _marked(tag, attributes, inside)
            stack.append([tag, len(self.pieces), [], dropped, inside])
            opened[tag] += 1
            if tag in RAW and not attributes.endswith("/"):
                # What such an element holds is no markup and no text.
                last = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
                at = last.end() if last else len(source)
                close()
        text(source[at:])
        while stack:
            close()

    def _ranges(self, tag: str) -> list[tuple[int, int]]:
        return [(first, end) for _, first, end, name, dropped, _ in self.elements if name == tag and not dropped]

    def kept(self, templates: frozenset[int] | set[int] = frozenset()) -> list[bool]:
        """Which pieces belong to the main text."""
        size = len(self.pieces)
        roots = self._ranges("article") or self._ranges("main") or self._ranges("body") or [(0, size)]
        out = [(first, end) for mark, first, end, tag, dropped, _ in self.elements if dropped or (mark in templates and tag in CONTAINER)]
        return [bool(a and not b) for a, b in zip(_covered(roots, size), _covered(out, size), strict=True)]

    def text(self, templates: frozenset[int] | set[int] = frozenset()) -> str:
        blocks: list[str] = []
        parts: list[str] = []
        for piece, keep in zip([*self.pieces, None], [*self.kept(templates), True], strict=True):
            if piece is None or not keep:
                block = SPACE.sub(" ", "".join(parts)).strip() if parts else ""
                if block:
                    blocks.append(block)
                parts = []
            if piece is not None and keep:
                parts.append(piece)
        return "\n\n".join(blocks)

    def containers(self) -> set[int]:
        """Hashes of container subtrees with text that are not dropped anyway."""
        found = set()
        texts = [0, *accumulate(int(bool(p) and not p.isspace()) for p in self.pieces)]
        for mark, first, end, tag, dropped, _ in self.elements:
            if tag in CONTAINER and not dropped and texts[end] > texts[first]:
                found.add(mark)
        return found


def _covered(ranges: list[tuple[int, int]], size: int) -> list[int]:
    """How many of the ranges each place lies in."""
    steps = [0] * (size + 1)
    for first, end in ranges:
        steps[first] += 1
        steps[end] -= 1
    return list(accumulate(steps))[:size]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def host(url: Column) -> Column:
    name = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return name


def sketch(text: str) -> np.ndarray:
    """The least hashes of the text's shingles, in order; of a short text all of them."""
    return shingle_hashes(text, SHINGLE)[:SKETCH].view(np.int64)


def near(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two texts are near copies, by the share of common hashes among the least of both."""
    both = np.sort(np.concatenate([a, b]).view(np.uint64))
    again = np.concatenate([[False], both[1:] == both[:-1]])
    least = min(SKETCH, len(both) - int(again.sum()))
    last = both[~again][least - 1]
    return int(np.count_nonzero(both[again] <= last)) >= NEAR * least


def _different(batches: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    """Of each host and mark in a batch up to ``most`` pages of which no two are near copies."""
    for batch in batches:
        found: dict[tuple, list[np.ndarray]] = {}
        rows = []
        for name, mark, content, own in zip(batch["host"], batch["mark"], batch["content"], batch["sketch"], strict=True):
            others = found.setdefault((name, mark), [])
            if len(others) < most and not any(near(own, other) for other in others):
                others.append(own)
                rows.append((name, mark, content, own))
        yield pd.DataFrame(rows, columns=["host", "mark", "content", "sketch"])


def _counted(batches: Iterator[pd.DataFrame], most: int, emit: bool) -> Iterator[pd.DataFrame]:
    """The same for rows that arrive sorted by host and mark, over all batches; or else the marks that have ``most``."""
    key, others = None, []
    for batch in batches:
        rows = []
        for name, mark, content, own in zip(batch["host"], batch["mark"], batch["content"], batch["sketch"], strict=True):
            if (name, mark) != key:
                key, others = (name, mark), []
            if len(others) < most and not any(near(own, other) for other in others):
                others.append(own)
                if emit or len(others) == most:
                    rows.append((name, mark, content, own))
        yield pd.DataFrame(rows, columns=["host", "mark", "content", "sketch"])


def _reader(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for name, key, source in zip(batch["host"], batch["page"], batch["html"], strict=True):
            page = Page(source)
            text = page.text()
            content = _signed(xxhash.xxh64_intdigest(text))
            rows.append((name, key, content, sketch(text), [_signed(m) for m in page.containers()]))
        yield pd.DataFrame(rows, columns=["host", "page", "content", "sketch", "marks"])


def _held(seen: DataFrame, marks: DataFrame, *columns: str) -> DataFrame:
    """The rows of ``seen``, once for each mark of theirs that is among ``marks`` (``host, mark, n_rows``)."""
    rows = seen.select("page", *columns, F.explode("marks").alias("mark"), "host").withColumn("spot", F.struct("host", "mark"))
    wanted = marks.select(F.struct("host", "mark").alias("spot"), "n_rows")
    if is_small(marks):
        return rows.join(F.broadcast(wanted), "spot")
    return lookup(rows, wanted, "spot", "n_rows", ["page"], "inner")


def site_templates(seen: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``host, mark, n_rows``: hashes of the subtrees that recur on at least ``least_pages`` pages of different
    content, whatever the size of the host. Near copies count once: pages are picked one after the other that are
    no near copy of one picked before, and only whether ``least_pages`` are found matters, so no more are kept."""
    spots = seen.select("host", "content", F.explode("marks").alias("mark"))
    each = spots.groupBy("host", "mark", "content").agg(F.count("*").alias("copies"))
    counts = each.groupBy("host", "mark").agg(F.count("*").alias("n"), F.sum("copies").alias("n_rows"))
    often = store(counts.filter(F.col("n") >= least_pages).drop("n"), "template-counts")
    rows = "host string, mark long, content long, sketch array<long>"
    held = _held(seen, often, "content", "sketch").select("host", "mark", "content", "sketch")
    few = held.mapInPandas(lambda batches: _different(batches, least_pages), rows)
    # A mark of very many pages is dealt out before its pages meet in one task.
    salt = F.pmod(F.xxhash64("content"), F.lit(SALTS))
    dealt = few.repartition("host", "mark", salt).sortWithinPartitions("host", "mark", "content")
    fewer = dealt.mapInPandas(lambda batches: _counted(batches, least_pages, True), rows)
    met = fewer.repartition("host", "mark").sortWithinPartitions("host", "mark", "content")
    found = met.mapInPandas(lambda batches: _counted(batches, least_pages, False), rows).select("host", "mark")
    return store(often.join(found, ["host", "mark"], "left_semi"), "templates")


def extract(pages: DataFrame, url: str = "url", html: str = "html", least_pages: int = LEAST_PAGES) -> DataFrame:
    """Add ``main_text`` to the pages, or replace a column of this name."""
    others = [c for c in pages.columns if c != "main_text"]
    rows = pages.select(F.struct(*others).alias("row"), host(F.col(url)).alias("host"), F.coalesce(html, F.lit("")).alias("html"))
    # Equal pages of a host share a key, and so the marks that they hold.
    rows = rows.withColumn("page", F.md5(F.concat_ws("\0", "host", "html"))).withColumn("part", F.spark_partition_id())
    seen = store(rows.select("host", "page", "html").mapInPandas(_reader, SEEN), "page-marks")
    found = _held(seen, site_templates(seen, least_pages)).groupBy("page").agg(
        F.collect_set("mark").alias("marks"), F.count("*").alias("n")
    )
    templates = store(found.select("page", "marks", (F.col("n") / F.size("marks")).cast("long").alias("copies")), "page-templates")
    if is_small(templates):
        met = rows.join(F.broadcast(templates), "page", "left")
    else:
        met = lookup(rows, templates, "page", "copies", ["part"])

    @F.pandas_udf("string")
    def of(sources: pd.Series, marks: pd.Series) -> pd.Series:
        return pd.Series(
            [Page(s).text({int(m) % (1 << 64) for m in known} if known is not None else frozenset()) for s, known in zip(sources, marks, strict=True)],
            dtype=object,
        )

    return met.select("row.*", of("html", "marks").alias("main_text"))
