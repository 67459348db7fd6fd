"""Main text of web pages by wrapper induction.

A page is read into a tree of block elements in which siblings of one kind share a slot. The slot trees of a host's pages are
aligned by simple tree matching into one wrapper. Slots whose text is the same on different pages are template,
those whose text varies are content. Elements that say what they are (menus, headers, footers, sidebars, notices, adverts,
forms, reader comments) are never content, nor is what lies outside the article where a page marks one.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spherecube.llm.common import small_side, stored

#: a slot is template only on the evidence of this many different pages
MIN_PAGES = 3

# fixed values: element and class names of HTML and of common page furniture
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark meter output progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math object canvas audio video".split())
FURNITURE = frozenset("head nav header footer aside form menu dialog select button fieldset option datalist map".split())
ARTICLE = frozenset(["article", "main"])
FURNITURE_WORDS = frozenset(
    "ad ads adv advert advertisement adverts adbox adsense banner banners breadcrumb breadcrumbs byline captcha comment comments commentlist consent "
    "cookie cookies copyright dialog disclaimer disqus feedback footer footnav gdpr header masthead menu menubar modal nav navbar navigation newsletter "
    "notice notices notification overlay pager pagination paywall popup privacy promo promoted promotion recommended related replies respond search share "
    "sharing sidebar sidenav signup skip social sponsor sponsored subscribe subscription tags teaser toc toolbar topbar widget widgets".split()
)
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _furniture(tag: str, attributes: str, in_article: bool) -> tuple[bool, str]:
    """Whether an element is page furniture, and its classes without digits."""
    found = {}
    if attributes and "=" in attributes or "hidden" in attributes:
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            found.setdefault(name.lower(), a or b or c)
    classes = unescape(found.get("class", "")) if found else ""
    if tag in FURNITURE and not (in_article and tag == "header"):
        return True, classes
    if found:
        words = set(_WORD.findall(_CAMEL.sub("-", f"{classes} {found.get('id', '')}").lower()))
        if words & FURNITURE_WORDS and tag not in ("body", "html", *ARTICLE) or "comment" in words or "comments" in words:
            return tag not in ("body", "html"), classes
        if found.get("role", "").lower() in FURNITURE_ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true":
            return True, classes
        if re.search(r"display\s*:\s*none", found.get("style", ""), re.I):
            return True, classes
    return False, classes


class Page:
    """Slots of a page as (parent, label), and its text blocks in order as (slot, text)."""

    def __init__(self, html: str):
        self.slots: list[tuple[int, str]] = [(-1, "")]
        self.article = [False]
        self._numbers: dict[tuple[int, str], int] = {}
        self.blocks: list[tuple[int, str]] = []
        self._read(html)
        if any(self.article[s] for s, _ in self.blocks):
            self.blocks = [b for b in self.blocks if self.article[b[0]]]

    def _slot(self, parent: int, label: str, article: bool) -> int:
        number = self._numbers.get((parent, label))
        if number is None:
            number = self._numbers[parent, label] = len(self.slots)
            self.slots.append((parent, label))
            self.article.append(article)
        return number

    def _read(self, html: str) -> None:
        stack: list[tuple[str, int, bool]] = [("", 0, False)]  # tag, slot, furniture
        pieces: list[str] = []
        at, size = 0, len(html)

        def flush() -> None:
            if pieces:
                text = " ".join(unescape("".join(pieces)).split())
                pieces.clear()
                if text:
                    self.blocks.append((stack[-1][1], text))

        while at < size:
            found = _TAG.search(html, at)
            end = found.start() if found else size
            if end > at and not stack[-1][2]:
                pieces.append(html[at:end])
            if not found:
                break
            at = found.end()
            closing, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
            if not tag:
                continue
            tag = tag.lower()
            if closing:
                depth = len(stack) - 1
                while depth and stack[depth][0] != tag:
                    depth -= 1
                if depth and (tag not in INLINE or stack[depth][2]):
                    flush()
                    del stack[depth:]
                elif tag not in INLINE:
                    flush()
                continue
            if tag in RAW:
                stop = re.compile(f"</{tag}[\\s/>]", re.I).search(html, at)
                if attributes.endswith("/"):
                    continue
                if stop is None:
                    at = size
                else:
                    close = html.find(">", stop.start())
                    at = size if close < 0 else close + 1
                if tag not in INLINE:
                    flush()
                continue
            if tag in VOID:
                if tag not in INLINE:
                    flush()
                continue
            if tag in ARTICLE and any(s[2] for s in stack) and "comment" not in attributes.lower():
                # an article ends furniture that was never closed
                flush()
                del stack[next(k for k, s in enumerate(stack) if s[2]) :]
            inside = stack[-1]
            if inside[2]:
                if tag not in INLINE and not attributes.endswith("/"):
                    stack.append((tag, inside[1], True))
                continue
            in_article = self.article[inside[1]]
            furniture, classes = _furniture(tag, attributes, in_article)
            if tag in INLINE:
                if furniture and not attributes.endswith("/"):
                    stack.append((tag, inside[1], True))
                continue
            flush()
            ends = CLOSES.get(tag)
            if ends:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] in ends:
                        del stack[depth:]
                        break
                    if stack[depth][0] in ("ul", "ol", "dl", "table", "select"):
                        break
            else:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] == "p":
                        del stack[depth:]
                        break
                    if stack[depth][0] not in INLINE:
                        break
            label = tag + "".join(sorted(f".{c}" for c in re.sub(r"\d+", "", classes).split()))
            parent = stack[-1][1]
            slot = self._slot(parent, label, self.article[parent] or tag in ARTICLE)
            stack.append((tag, slot, furniture))
        flush()

    def structure(self) -> str:
        return json.dumps(self.slots, ensure_ascii=False)

    def digests(self) -> dict[int, int]:
        """Hash of each slot's blocks, in order."""
        held: dict[int, list[str]] = {}
        for slot, text in self.blocks:
            held.setdefault(slot, []).append(text)
        return {s: xxhash.xxh64_intdigest("\n".join(x)) - (1 << 63) for s, x in held.items()}


class Wrapper:
    """Slot tree of a host, grown by aligning the slot trees of its pages."""

    def __init__(self):
        self.labels = [""]
        self.children: list[list[int]] = [[]]

    def _weight(self, mine: int, theirs: int, tree: list[list[int]], labels: list[str], memo: dict) -> int:
        """Simple tree matching: most node pairs that an order-keeping matching of the two trees can have."""
        if self.labels[mine] != labels[theirs]:
            return 0
        key = (mine, theirs)
        if key not in memo:
            a, b = self.children[mine], tree[theirs]
            row = [0] * (len(b) + 1)
            for x in a:
                last, row = row, [0]
                for j, y in enumerate(b):
                    row.append(max(last[j + 1], row[j], last[j] + self._weight(x, y, tree, labels, memo)))
            memo[key] = row[-1] + 1
        return memo[key]

    def add(self, slots: list[tuple[int, str]]) -> list[int]:
        """Align a page's slots; those without counterpart are put where they stand. The wrapper node of each slot."""
        labels = [label for _, label in slots]
        tree: list[list[int]] = [[] for _ in slots]
        for k, (parent, _) in enumerate(slots[1:], 1):
            tree[parent].append(k)
        place, memo = [0] * len(slots), {}
        todo = [(0, 0)]
        while todo:
            mine, theirs = todo.pop()
            a, b = self.children[mine], tree[theirs]
            best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
            for i, x in enumerate(a):
                for j, y in enumerate(b):
                    best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + self._weight(x, y, tree, labels, memo))
            i, j, pairs = len(a), len(b), {}
            while i and j:
                if best[i][j] == best[i - 1][j]:
                    i -= 1
                elif best[i][j] == best[i][j - 1]:
                    j -= 1
                else:
                    pairs[b[j - 1]] = a[i - 1]
                    i, j = i - 1, j - 1
            at = 0
            for y in b:
                node = pairs.get(y)
                if node is None:
                    node = len(self.labels)
                    self.labels.append(labels[y])
                    self.children.append([])
                    a.insert(at, node)
                at = a.index(node) + 1
                place[y] = node
                todo.append((node, y))
            memo = {}
        return place


def _host(url: str | None) -> str:
    found = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else ""


def _slots_seen(pages: DataFrame) -> DataFrame:
    """host, structure, slot, digest, page: text of each slot outside marked articles, page by page."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows = []
                for url, html in zip(part.column("url").to_pylist(), part.column("html").to_pylist(), strict=True):
                    page = Page(html or "")
                    host, structure, whole = _host(url), page.structure(), xxhash.xxh64_intdigest(html or "") - (1 << 63)
                    # a row without slot tells of the structure itself
                    rows.append((host, structure, -1, 0, whole))
                    rows += [(host, structure, s, d, whole) for s, d in page.digests().items() if not page.article[s]]
                columns = list(zip(*rows, strict=True)) if rows else [()] * 5
                kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["host", "structure", "slot", "digest", "page"])

    return pages.mapInArrow(compute, "host string, structure string, slot int, digest bigint, page bigint")


def induce(pages: DataFrame) -> DataFrame:
    """Template slots by host and structure: host, structure, template (slot numbers). ``pages``: url, html.

    What is counted for a slot merges in any order: smallest and largest digest, and the number of different pages.
    The wrapper of a host is aligned from its distinct structures, however many pages have each.
    """
    seen = _slots_seen(pages).groupBy("host", "structure", "slot").agg(
        F.min("digest").alias("low"), F.max("digest").alias("high"), F.approx_count_distinct("page").alias("pages"))

    def align(key, rows: pd.DataFrame) -> pd.DataFrame:
        wrapper, places = Wrapper(), {}
        for structure in sorted(rows["structure"].unique(), key=lambda s: (-len(s), s)):
            places[structure] = wrapper.add([tuple(x) for x in json.loads(structure)])
        low, high, pages_of = {}, {}, {}
        texts = rows[rows["slot"] >= 0]
        for s, k, a, b, n in zip(texts["structure"], texts["slot"], texts["low"], texts["high"], texts["pages"], strict=True):
            node = places[s][k]
            low[node], high[node] = min(low.get(node, a), a), max(high.get(node, b), b)
            pages_of[node] = pages_of.get(node, 0) + n
        constant = {n for n in low if low[n] == high[n] and pages_of[n] >= MIN_PAGES}
        out = [(key[0], s, [int(k) for k in sorted(texts["slot"][texts["structure"] == s].unique()) if place[k] in constant]) for s, place in places.items()]
        return pd.DataFrame(out, columns=["host", "structure", "template"])

    found = seen.groupBy("host").applyInPandas(align, "host string, structure string, template array<int>")
    return found.filter(F.size("template") > 0)


def _blocks(pages: DataFrame) -> DataFrame:
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                read = [Page(html or "") for html in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array([_host(u) for u in part.column("url").to_pylist()], pa.string()), pa.array([p.structure() for p in read], pa.string()),
                     pa.array([[s for s, _ in p.blocks] for p in read], pa.list_(pa.int32())), pa.array([[t for _, t in p.blocks] for p in read], pa.list_(pa.string()))],
                    names=["page_id", "url", "host", "structure", "slots", "texts"],
                )

    kind = dict(pages.dtypes)["page_id"]
    return pages.mapInArrow(compute, f"page_id {kind}, url string, host string, structure string, slots array<int>, texts array<string>")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row, repeated rows included.

    White space within a block becomes one blank, blocks are joined by one blank. Null and empty pages have an empty
    text. Pages without a host (null or odd URLs) are taken together as one. A host with fewer than three different pages
    gives no evidence for a template; there only the elements' own names decide.
    """
    pages = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    template = stored(induce(pages.select("url", "html")), "wrappers")
    # wrappers are counted, and broadcast only where they are few
    joined = _blocks(pages).join(small_side(template, 20_000), ["host", "structure"], "left")
    pairs = F.arrays_zip("slots", "texts")
    kept = F.when(F.col("template").isNull(), F.col("texts")).otherwise(
        F.transform(F.filter(pairs, lambda p: ~F.array_contains("template", p["slots"])), lambda p: p["texts"]))
    text = F.array_join(kept, " ")
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("bigint"))
