"""Main text of web pages by wrappers inferred for each host.

A page becomes a balanced token stream, its repeated groups folded. Streams of
one host are aligned one after the other: a part that one side lacks becomes
optional, a group that repeats becomes a repetition, texts become slots. The
result is a union-free regular expression over tags. Every slot keeps how many
different texts it has, on how many different pages, and how much text. Its
elements and slots are judged once per host by these: where the article is, what
of it a class name that hints at boilerplate really marks, and which texts the
host repeats. Every page is laid over the judged wrapper.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import append, fresh, map_texts
from sparktab.llm.urls import host_of
from sparktab.session import materialize

#: Depth from which elements hang beside each other, but for those that decide about their content; longest group that is sought as a repetition.
DEEPEST, LONGEST_GROUP = 150, 4
#: Nodes from which a list that does not fold becomes one repeated group.
LONGEST_LIST = 48
#: Smallest checksums that a slot keeps of its texts; counts below this number are exact, larger ones estimated.
SKETCH = 16
#: Share of a host's main text from which an element holds the article, whatever its class says.
BODY_SHARE = 0.9
#: Bytes of wrappers up to which they are sent to every task, and salts that share a host's partial wrappers out.
SEND_BYTES, SALTS = 32 << 20, 16

# HTML element kinds.
RAW = frozenset("script style noscript template textarea iframe svg math object canvas audio video xmp noembed noframes title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
CLOSED_BY_BLOCK = frozenset(("p",))
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("html body article main section div table td th ul ol dl nav aside footer header form blockquote button figure".split())
# Elements and class words of what is not main text.
BOILER_TAGS = frozenset("nav footer aside form menu dialog button select input fieldset head address-bar".split())
BOILER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments comment-list consent cookie cookies disclaimer discussion disqus "
    "feedback footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notification pager pagination popup promo promoted "
    "recommended related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
MAIN_TAGS = ("article", "main")
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>""", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)


class Element:
    """A page's element: key (tag and boilerplate words, with ~ where they only qualify a name's last part), and children, texts as plain strings."""

    __slots__ = ("children", "key", "tag")

    def __init__(self, tag: str, key: str):
        self.tag, self.key, self.children = tag, key, []


@lru_cache(maxsize=4096)
def _key(tag: str, attributes: str) -> str:
    words = set()
    for m in ATTRIBUTE.finditer(attributes):
        for name in (m[2] or m[3] or m[4] or "").lower().split():
            *parts, last = (name,) if tag in MAIN_TAGS else [x for x in re.split(r"[-_]+", name) if x] or [name]
            strong = {w for w in (name, last) if w in BOILER_WORDS}
            words |= strong or {f"~{w}" for w in parts if w in BOILER_WORDS}
    if HIDDEN.search(attributes):
        words.add("hidden")
    return ".".join([tag, *sorted(words)])


def parse(html: str) -> Element:
    """The balanced tree of a page: raw elements are left out, missing end tags put in, stray ones ignored."""
    root = Element("", "")
    # For each open element where its children hang and which deep elements hold content; and how often a tag is open.
    stack, homes, chains, opened, at = [root], [root], [()], Counter(), 0

    def close(i: int) -> None:
        ends = any(e.tag not in INLINE for e in stack[max(i, DEEPEST) :])
        opened.subtract(e.tag for e in stack[i:])
        del stack[i:], homes[i:], chains[i:]
        there = homes[-1].children
        if ends and there and (isinstance(there[-1], str) or there[-1].tag in INLINE):
            there.append(Element("div", "div"))

    for m in TOKEN.finditer(html):
        if m.start() < at:
            continue
        if m.start() > at:
            homes[-1].children.append(html[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                homes[-1].children.append(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        if m[1] or m[4]:
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[i].tag == tag:
                    close(i)
                    break
                if tag in INLINE and stack[i].tag not in INLINE:
                    break
            continue
        attributes = m[3] or m[6] or ""
        if tag in RAW:
            if not attributes.endswith("/"):
                end = _closing(tag).search(html, at)
                at = end.end() if end else len(html)
            continue
        closes = SAME_CLOSES.get(tag, CLOSED_BY_BLOCK if tag not in INLINE else None)
        if closes and any(opened[c] for c in closes):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in closes:
                    close(i)
                    break
                if stack[i].tag in SCOPES:
                    break
        if tag not in INLINE and tag in SAME_CLOSES and opened["p"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag in SCOPES:
                    break
        element = Element(tag, _key(tag, attributes))
        homes[-1].children.append(element)
        if tag not in VOID and not attributes.endswith("/"):
            chain = chains[-1]
            kind = _deep_kind(element, chain) if len(stack) >= DEEPEST else ""
            homes.append(element if kind or len(stack) < DEEPEST else homes[-1])
            chains.append((*chain, kind) if kind else chain)
            stack.append(element)
            opened[tag] += 1
    if at < len(html):
        homes[-1].children.append(html[at:])
    return root


def _deep_kind(element: Element, chain: tuple) -> str:
    """What an element below DEEPEST decides about its content, if it must hold it: each kind once, and none within boilerplate."""
    kind = element.tag if element.tag in MAIN_TAGS else "heading" if element.tag in HEADINGS else ""
    if _boiler(element.key):
        kind = "header" if element.key == "header" else "boiler"
    return "" if kind in chain or "boiler" in chain else kind


@lru_cache(maxsize=64)
def _closing(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}[^>]*>", re.I)


# A node of a wrapper is [key, optional, repeated, content]. The content of "#" (a text slot)
# is [checksums of its texts, checksums of page and text, characters], that of others their nodes.


def smallest(sums: list) -> list:
    return sorted(set(sums))[:SKETCH]


def distinct(sums: list) -> float:
    """How many different values the kept checksums stand for."""
    return len(sums) if len(sums) < SKETCH else (SKETCH - 1) * 2**32 / (sums[-1] + 1)


def fold(nodes: list) -> list:
    """Neighbouring equal groups as one repeated group, short groups first."""
    for size in range(1, LONGEST_GROUP + 1):
        out, i = [], 0
        while i < len(nodes):
            group = nodes[i : i + size]
            keys = [n[0] for n in group]
            j = i + size
            if len(group) == size and [n[0] for n in nodes[j : j + size]] == keys and (size > 1 or keys != ["#"]):
                while [n[0] for n in nodes[j : j + size]] == keys:
                    group = [merge(a, b) for a, b in zip(group, nodes[j : j + size], strict=True)]
                    j += size
                out.append([group[0][0], group[0][1], True, group[0][3]] if size == 1 else [f"({' '.join(keys)})", False, True, group])
                i = j
            else:
                out.append(nodes[i])
                i += 1
        nodes = out
    return bounded(nodes)


def bounded(nodes: list) -> list:
    """A long list without a regular pattern as one repeated group of optional parts, one for each key."""
    if len(nodes) <= LONGEST_LIST:
        return nodes
    by: dict[str, list] = {}
    for n in spread(nodes):
        by[n[0]] = merge(by[n[0]], n) if n[0] in by else n
    return [["(*)", False, True, [[k, True, r, c] for k, _, r, c in by.values()]]]


def spread(nodes: list) -> list:
    """Nodes with those of repeated groups in the groups' places."""
    return [x for n in nodes for x in (spread(n[3]) if n[0][0] == "(" else [n])]


def shape(element: Element, page: int = 0) -> list:
    """The nodes of an element's content, folded; ``page`` is a checksum of the whole page."""
    out = []
    for child in element.children:
        if isinstance(child, str):
            words = " ".join(child.split()).encode()
            if words:
                slot = ["#", False, False, [[crc32(words)], [crc32(words, page)], len(words)]]
                if out and out[-1][0] == "#":
                    out[-1] = merge(out[-1], slot)
                else:
                    out.append(slot)
        else:
            out.append([child.key, False, False, shape(child, page)])
    return fold(out)


def pairs(a: list, b: list) -> Iterator[tuple[int | None, int | None]]:
    """Alignment of two node lists by their longest common sequence of keys."""
    i = 0
    while i < len(a) and i < len(b) and a[i][0] == b[i][0]:
        yield i, i
        i += 1
    m, n = len(a) - i, len(b) - i
    if not m or not n:
        yield from ((x, None) for x in range(i, len(a)))
        yield from ((None, x) for x in range(i, len(b)))
        return
    best = [[0] * (n + 1) for _ in range(m + 1)]
    for x in range(m - 1, -1, -1):
        for y in range(n - 1, -1, -1):
            best[x][y] = best[x + 1][y + 1] + 1 if a[i + x][0] == b[i + y][0] else max(best[x + 1][y], best[x][y + 1])
    x = y = 0
    while x < m or y < n:
        if x < m and y < n and a[i + x][0] == b[i + y][0] and best[x][y] == best[x + 1][y + 1] + 1:
            yield i + x, i + y
            x, y = x + 1, y + 1
        elif y == n or (x < m and best[x + 1][y] >= best[x][y + 1]):
            yield i + x, None
            x += 1
        else:
            yield None, i + y
            y += 1


def merge(a: list, b: list) -> list:
    """One node for both: what only one side has becomes optional, the texts of both fill one slot."""
    if a[0] == "#":
        (texts, places, size), (texts2, places2, size2) = a[3], b[3]
        return ["#", a[1] or b[1], a[2] or b[2], [smallest(texts + texts2), smallest(places + places2), size + size2]]
    return [a[0], a[1] or b[1], a[2] or b[2], merge_lists(a[3], b[3])]


def merge_lists(a: list, b: list) -> list:
    out = []
    for x, y in pairs(a, b):
        if x is not None and y is not None:
            out.append(merge(a[x], b[y]))
        else:
            key, _, repeated, content = a[x] if y is None else b[y]
            out.append([key, True, repeated, content])
    return bounded(out)


class Slot:
    """A wrapper's element or text for reading: what the host has there, and whether it is left out."""

    __slots__ = ("below", "drop", "main", "places", "size", "texts")

    def __init__(self, texts: float, places: float, size: int, below: dict):
        self.texts, self.places, self.size, self.below = texts, places, size, below
        self.main, self.drop = 0, False


def slots(nodes: list) -> dict[str, Slot]:
    """The nodes by key, with the figures of all that is below. Neither depends on the order in which pages came."""
    by: dict[str, list] = {}
    for n in spread(nodes):
        by[n[0]] = merge(by[n[0]], n) if n[0] in by else n
    out = {}
    for key, _, _, content in by.values():
        if key == "#":
            out[key] = Slot(distinct(content[0]), distinct(content[1]), content[2], {})
        else:
            below = slots(content)
            out[key] = Slot(*(sum(getattr(x, field) for x in below.values()) for field in ("texts", "places", "size")), below)
    return out


def expression(nodes: list) -> str:
    """The wrapper as a regular expression over tags and text slots."""
    out = []
    for key, optional, repeated, content in nodes:
        body = "#text" if key == "#" else expression(content) if key[0] == "(" else f"<{key}>{expression(content)}</{key.split('.')[0]}>"
        mark = "*" if optional and repeated else "?" if optional else "+" if repeated else ""
        out.append(f"({body}){mark}" if mark else body)
    return "".join(out)


def _boiler(key: str) -> bool:
    tag, *words = key.split(".")
    return tag in BOILER_TAGS or bool(words) or tag == "header"


def _left_out(key: str) -> bool:
    """Elements that are boilerplate by their tag, or hidden, whatever the host's pages show."""
    tag, *words = key.split(".")
    return tag in BOILER_TAGS or "hidden" in words


class Wrapper:
    """A host's wrapper and the judgement of its slots.

    The article is where the wrapper has article elements (else main elements,
    else the whole page). An element whose class hints at boilerplate is left out
    if the host repeats its texts on different pages, or if it is a container and
    holds less than ``BODY_SHARE`` of the main text; inside the article the last
    part of its class name must be the hint, and paragraphs, headings, items and
    inline elements stay unless repeated. Without an article, a text that all
    different pages share is the host's own, if such texts are the smaller part.
    """

    def __init__(self, nodes: list):
        self.slots = slots(nodes)
        self.region = next((t for t in MAIN_TAGS if self._measure(self.slots, t, False)), None)
        total = self._measure(self.slots, self.region, self.region is None)
        self._judge(self.slots, self.region is None, total)
        if self.region is None:
            shared = list(self._shared(self.slots))
            if 2 * sum(x.size for x in shared) <= total:
                for x in shared:
                    x.drop = True

    def _measure(self, here: dict, region: str | None, inside: bool) -> int:
        """Characters of main text, noted at every element."""
        for key, x in here.items():
            if key == "#":
                x.main = x.size if inside else 0
            elif not _left_out(key):
                x.main = self._measure(x.below, region, inside or key.split(".")[0] == region)
        return sum(x.main for x in here.values())

    def _judge(self, here: dict, inside: bool, total: int) -> None:
        for key, x in here.items():
            tag, *words = key.split(".")
            if _left_out(key):
                x.drop = True
                continue
            if words:
                within = inside and self.region is not None
                container = tag not in INLINE and not (within and tag in PARTS)
                hint = not within or any(w[0] != "~" for w in words)
                x.drop = 2 * x.texts <= x.places or (container and hint and x.main < BODY_SHARE * total)
            self._judge(x.below, inside or tag == self.region, total)

    def _shared(self, here: dict) -> Iterator[Slot]:
        for key, x in here.items():
            if key == "#" and x.texts == 1 < x.places:
                yield x
            elif not x.drop:
                yield from self._shared(x.below)

    def read(self, page: Element) -> str:
        """Blocks of the page's main text, white space within each one space, one line each."""
        blocks: list[list[str]] = [[]]
        region = self.region if self.region and self._holds(page, self.slots) else None
        self._walk(page, self.slots, region, region is None, False, blocks)
        lines = (" ".join("".join(b).split()) for b in blocks)
        return "\n".join(line for line in lines if line)

    def _drops(self, child: Element, slot: Slot | None) -> bool:
        return slot.drop if slot else _left_out(child.key)

    def _holds(self, element: Element, here: dict) -> bool:
        """Whether the page has the host's article element."""
        for child in element.children:
            if not isinstance(child, str):
                slot = here.get(child.key)
                if not self._drops(child, slot) and (child.tag == self.region or self._holds(child, slot.below if slot else {})):
                    return True
        return False

    def _walk(self, element: Element, here: dict, region: str | None, inside: bool, header: bool, blocks: list) -> None:
        for child in element.children:
            if isinstance(child, str):
                slot = here.get("#")
                if inside and not (slot and slot.drop) and (not header or element.tag in HEADINGS):
                    blocks[-1].append(unescape(child))
                continue
            block = child.tag not in INLINE
            if block:
                blocks.append([])
            elif child.tag == "br":
                blocks[-1].append(" ")
            slot, top = here.get(child.key), child.tag == "header"
            if not self._drops(child, slot) and not (top and not (inside and region)):
                self._walk(child, slot.below if slot else {}, region, inside or child.tag == region, header or top, blocks)
            if block:
                blocks.append([])


# Headings, and elements that are parts of a running text.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARTS = HEADINGS | frozenset("p li dt dd td th tr pre blockquote figcaption".split())


@lru_cache(maxsize=256)
def load(text: str) -> Wrapper:
    return Wrapper(json.loads(text))


def learn_page(html: str) -> list:
    return shape(parse(html), crc32(html.encode()))


def _dump(wrappers: dict) -> Iterator[pa.RecordBatch]:
    if wrappers:
        texts = [json.dumps(n, separators=(",", ":")) for n in wrappers.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(wrappers)), pa.array(texts)], names=["host", "wrapper"])


def _add(wrappers: dict, host: str, nodes: list) -> None:
    wrappers[host] = merge_lists(wrappers[host], nodes) if host in wrappers else nodes


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """``host, wrapper`` from all pages (columns host, html).

    Each task aligns its pages by host, then the partial wrappers of a host meet
    in salted groups and at last in one: what moves is one small wrapper per
    host and task, never pages, and no group holds more than the partial ones.
    """

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wrappers: dict[str, tuple] = {}
        for batch in batches:
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                _add(wrappers, host, learn_page(html or ""))
        yield from _dump(wrappers)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wrappers: dict[str, tuple] = {}
        for batch in batches:
            for host, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                _add(wrappers, host, json.loads(text))
        yield from _dump(wrappers)

    kind = "host string, wrapper string"
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partial = map_texts(pages.select("host", "html"), learn, kind)
    salted = partial.repartition(parts, "host", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS))).mapInArrow(join, kind)
    return salted.repartition(parts, "host").mapInArrow(join, kind)


def extract_text(df: DataFrame, url_col: str = "url", html_col: str = "html", column: str = "text") -> DataFrame:
    """The table with the main text of every page.

    All pages of a host form its wrapper, in whatever order they come; pages
    without a host share one. Equal pages count once where texts are compared, so
    repeated rows get the text of one. Null html is empty, an empty page has empty
    text, an empty table gives one. Small sets of wrappers (checked by size) are
    sent to the pages; larger ones are joined by host.
    """
    host, wrapper = fresh(df, "page_host"), fresh(df, "page_wrapper")
    pages = df.withColumn(host, host_of(F.col(url_col)))
    wrappers = materialize(infer_wrappers(pages.select(F.col(host).alias("host"), F.col(html_col).alias("html"))), "wrappers")
    size = wrappers.agg(F.sum(F.length("wrapper"))).first()[0] or 0
    wrappers = wrappers.select(F.col("host").alias(host), F.col("wrapper").alias(wrapper))
    joined = pages.join(F.broadcast(wrappers) if size <= SEND_BYTES else wrappers, host, "left")
    both, out = fresh(df, "page_both"), fresh(df, column)
    packed = joined.withColumn(both, F.concat(F.coalesce(wrapper, F.lit("")), F.lit("\x00"), F.coalesce(F.col(html_col), F.lit(""))))

    def read(value: bytes | None) -> tuple:
        saved, _, html = value.decode().partition("\x00")
        text = load(saved or "[]").read(parse(html))
        return text, len(text)

    kept = [*df.columns, both]
    return append(packed.select(*kept), both, read, {out: "string", fresh(df, "n_chars"): "long"}).drop(both)
