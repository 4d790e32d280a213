"""Main text of web pages by wrappers inferred for each host.

A wrapper is a union-free regular expression over the tokens of a host's pages, kept as a tree:
an element is its tag round a sequence of items, each an element or a text slot, some of them
optional, runs of them joined to repeated groups. It is inferred by aligning page after page:
items with the same signature meet; an item that one side lacks becomes optional; siblings
that recur, or stand in another order on another page, are joined with all between them to a
repeated group; texts that differ become slots, and what is equal on all pages stays constant.
Wrappers align with wrappers the same way, so tasks infer theirs from their own pages, and
these partial wrappers are aligned by host in two steps; no host's pages come together.

The wrapper tells, for each slot, on how many pages it stands, whether its text is the same on
all of them (template text: notices, labels, copyright lines), how much of it is link text
(menus), and how much text it holds on average. A page is then read along its host's wrapper:

1. what names itself as something else (nav, footer, aside, form, class words as ad or comments) is
   passed over, and so are template slots and, outside a marked article, repeated slots of links;
2. the text lies in the element marked as article or main; else in the one that class words call the
   content; else where the wrapper's slots hold most text, going down while one item has more than half;
3. its blocks are joined by an empty line. A header inside the article gives its headings only.

Template text needs a host with ``PAGES`` different pages at least; headings are never template
text. Slots are found by signature, and what is held of them are sums, extremes and sets, so the
result does not depend on the order in which pages were aligned. Elements with more than ``ITEMS``
kinds of children are generalised to their names, wrappers stop at ``LEVELS`` levels.

Wrappers go to the pages by broadcast where all of them take ``BROADCAST_BYTES`` at most, else by
a join on the host in which common hosts are split.

Defined results: null or empty html has an empty text; pages without a host share one wrapper;
rows that share an id are pages of their own; extra columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html_blocks import AWAY, AWAY_NAMES, HEADINGS, Node, page_tree
from .skew import salted
from .storage import dropped, written

#: Kinds of children an element has before they are told apart by name only; levels of a wrapper.
ITEMS, LEVELS = 48, 24
#: Different pages from which a host's template text is known.
PAGES = 5
#: A repeated slot is a menu if so much of its text is in links.
LINKS = 0.8
#: Slots that a task holds before it gives its wrappers out; first step's groups for each host.
HELD, GROUPS = 200_000, 1024
BROADCAST_BYTES = 32 << 20
TEXT = "#"


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big") >> 1


class Slot:
    """An item of a wrapper: what is known of it over all pages, and the items in it.

    count: occurrences; within: parents that hold it; many: whether one holds several;
    texts, lo, hi, chars, links: its own texts, their extreme hashes, characters, those in links;
    items: signature to slot, in order; joined: signatures in one repeated group with the next one;
    general: whether items are told apart by name only.
    """

    __slots__ = ("chars", "count", "general", "hi", "items", "joined", "links", "lo", "many", "texts", "within")

    def __init__(self):
        self.count = self.within = self.texts = self.chars = self.links = self.hi = 0
        self.lo = 1 << 63
        self.many = self.general = False
        self.items: dict[str, Slot] = {}
        self.joined: set[str] = set()

    def size(self) -> int:
        return 1 + sum(x.size() for x in self.items.values())


def _aligned(one: list[str], other: list[str]) -> tuple[list[str], list[tuple[int, int]]]:
    """Both orders as one: each item once, and the ranges of it that recur or change their order."""
    if not other or one == other:
        return one, []
    place = {x: k for k, x in enumerate(one)}
    if not any(x not in place for x in other) and all(place[a] < place[b] for a, b in zip(other, other[1:])):
        return one, []
    n, m = len(one), len(other)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if one[i] == other[j] else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    out: list[str] = []
    while i < n or j < m:
        if i < n and j < m and one[i] == other[j]:
            out.append(one[i])
            i, j = i + 1, j + 1
        elif j >= m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append(one[i])
            i += 1
        else:
            out.append(other[j])
            j += 1
    first: dict[str, int] = {}
    ranges = []
    order: list[str] = []
    for x in out:
        if x in first:
            ranges.append((first[x], len(order) - 1))
        else:
            first[x] = len(order)
            order.append(x)
    return order, ranges


def _bare(signature: str) -> str:
    return signature.split(".")[0].split("/")[0]


def _generalise(slot: Slot) -> None:
    """Tells an element's items apart by name only, from now on."""
    if slot.general:
        return
    items: dict[str, Slot] = {}
    for signature, item in slot.items.items():
        align(items.setdefault(_bare(signature), Slot()), item)
        items[_bare(signature)].many = True
    slot.items, slot.joined, slot.general = items, set(list(items)[:-1]), True


def align(wrapper: Slot, other: Slot) -> None:
    """Generalises ``wrapper`` to all that ``other`` stands for, too."""
    wrapper.count += other.count
    wrapper.within += other.within
    wrapper.many |= other.many
    wrapper.texts += other.texts
    wrapper.chars += other.chars
    wrapper.links += other.links
    wrapper.lo, wrapper.hi = min(wrapper.lo, other.lo), max(wrapper.hi, other.hi)
    if not other.items:
        return
    incoming = other.items
    if wrapper.general or other.general:
        _generalise(wrapper)
        _generalise(other)
        incoming = other.items
    order, ranges = _aligned(list(wrapper.items), list(incoming))
    place = {x: k for k, x in enumerate(order)}
    for side in (wrapper, other):
        names = list(side.items)
        ranges += [(place[a], place[b]) if place[a] < place[b] else (place[b], place[a]) for a, b in zip(names, names[1:]) if a in side.joined]
    joined = {order[k] for lo, hi in ranges for k in range(lo, hi)}
    items = {}
    for x in order:
        items[x] = wrapper.items.get(x) or Slot()
        if x in incoming:
            align(items[x], incoming[x])
    wrapper.items, wrapper.joined = items, joined
    if len(items) > ITEMS:
        _generalise(wrapper)


def page_wrapper(node: Node, level: int = 0) -> Slot:
    """The wrapper of one element of one page: recurring siblings are joined already."""
    slot = Slot()
    slot.count = slot.within = 1
    last: dict[str, int] = {}
    ranges: list[tuple[int, int]] = []
    for child in node.children:
        if type(child) is tuple:
            text, links = child
            signature, item = TEXT, Slot()
            item.count = item.within = item.texts = 1
            item.lo = item.hi = _hash(text)
            item.chars, item.links = len(text), links
        elif level >= LEVELS:
            continue
        else:
            signature, item = child.signature, page_wrapper(child, level + 1)
        if signature in slot.items:
            ranges.append((last[signature], len(slot.items) - 1))
            align(slot.items[signature], item)
            slot.items[signature].many, slot.items[signature].within = True, 1
        else:
            last[signature] = len(slot.items)
            slot.items[signature] = item
    order = list(slot.items)
    slot.joined = {order[k] for lo, hi in ranges for k in range(lo, hi)}
    if len(order) > ITEMS:
        _generalise(slot)
    return slot


def expression(slot: Slot, signature: str = "page") -> str:
    """The wrapper as a regular expression: ``?`` for optional items, ``( )+`` for repeated groups."""
    if signature == TEXT:
        return "text" if slot.lo == slot.hi and slot.texts > 1 else "#text"
    inner, group = [], []
    for name, item in slot.items.items():
        one = expression(item, name) + ("+" if item.many else "") + ("?" if item.within < slot.count and not item.many else "")
        group.append(one)
        if name not in slot.joined:
            inner.append(" ".join(group) if len(group) == 1 else "(" + " ".join(group) + ")+")
            group = []
    return f"<{signature}>" + " ".join(inner) + f"</{_bare(signature)}>"


def packed(slot: Slot) -> list:
    items = [[name, name in slot.joined, packed(item)] for name, item in slot.items.items()]
    return [slot.count, slot.within, slot.many, slot.general, slot.texts, slot.lo, slot.hi, slot.chars, slot.links, items]


def unpacked(data: list) -> Slot:
    slot = Slot()
    slot.count, slot.within, slot.many, slot.general, slot.texts, slot.lo, slot.hi, slot.chars, slot.links, items = data
    slot.items = {name: unpacked(item) for name, _, item in items}
    slot.joined = {name for name, joined, _ in items if joined}
    return slot


class Wrapper:
    """A host's wrapper and the smallest hashes of its different pages, ``PAGES`` at most."""

    def __init__(self, root: Slot, pages: set[int]):
        self.root, self.pages = root, pages

    def add(self, other: Wrapper) -> None:
        align(self.root, other.root)
        self.pages = set(sorted(self.pages | other.pages)[:PAGES])

    def text(self) -> str:
        return json.dumps([sorted(self.pages), packed(self.root)], separators=(",", ":"))

    @classmethod
    def of(cls, text: str) -> Wrapper:
        pages, root = json.loads(text)
        return cls(unpacked(root), set(pages))


def decided(wrapper: Wrapper) -> str:
    """What a page needs of its host's wrapper: for each slot whether it is template text (1), a menu (2)
    or neither, the mean of its other text on a page, and its items.
    """
    enough, pages = len(wrapper.pages) >= PAGES, max(1, wrapper.root.count)

    def walk(slot: Slot, name: str) -> list:
        constant = enough and slot.texts >= PAGES and slot.lo == slot.hi
        items = {x: walk(item, x) for x, item in slot.items.items()}
        if name == TEXT:
            return [1 if constant else 0, 0 if constant else (slot.chars - slot.links) // pages, {}]
        chars, links = _sums(slot)
        menu = slot.many and chars > 0 and links >= LINKS * chars
        mean = 0 if menu or _away(_bare(name), set(name.split("/")[0].split(".")[1:])) else sum(item[1] for item in items.values())
        return [2 if menu else 0, mean, items]

    return json.dumps(walk(wrapper.root, ""), separators=(",", ":"))


def _sums(slot: Slot) -> tuple[int, int]:
    chars, links = slot.chars, slot.links
    for item in slot.items.values():
        c, k = _sums(item)
        chars, links = chars + c, links + k
    return chars, links


def _away(name: str, words: set) -> bool:
    return name in AWAY_NAMES or (name not in ("html", "body", "main") and bool(AWAY & words))


def _passed(node: Node, whole: Node) -> bool:
    """Whether an element says of itself that it is no part of the text.

    A form round the article, or a frame of the whole page that is called after a part of it (menu-open,
    sidebar-left), is none of these.
    """
    if node.hidden or (node.name in AWAY_NAMES and node.name != "form"):
        return True
    words = AWAY & {*node.words, node.role}
    if node.name != "form" and (node.name in ("html", "body", "main", "") or not words):
        return False
    if any(_marked(x) for x in _nodes(node) if x is not node):
        return False
    if words <= FRAMES and 4 * _paragraphs(node) > 3 * _paragraphs(whole):
        inside = {id(x) for x in _nodes(node)}
        return any(_content(x) for x in _nodes(whole) if id(x) not in inside and not any(y is node for y in _nodes(x)))
    return True


def _paragraphs(node: Node) -> int:
    """Characters of text in paragraphs."""
    own = sum(len(c[0]) for c in node.children if type(c) is tuple) if node.name == "p" else 0
    return own + sum(_paragraphs(c) for c in node.children if type(c) is Node)


def _content(node: Node) -> bool:
    return _marked(node) or bool(CONTENT & set(node.words) and not AWAY & set(node.words))


def _marked(node: Node) -> bool:
    return (node.name in ("article", "main") or node.role in ("main", "article", "articlebody")) and not AWAY & set(node.words)


# Words of parts of a page after which its whole frame may be called; class words of the element that holds the text.
FRAMES = frozenset("sidebar sidebars menu menus nav navbar navigation topbar toolbar rail footer search form banner".split())
CONTENT = frozenset("article articlebody content maincontent main entry post story body text prose".split())


def _nodes(node: Node) -> Iterator[Node]:
    yield node
    for child in node.children:
        if type(child) is Node:
            yield from _nodes(child)


def page_blocks(root: Node, wrapper: list) -> list[str]:
    """The blocks of the main text, in order."""
    slots: dict[int, list] = {}

    def follow(node: Node, slot: list) -> None:
        slots[id(node)] = slot
        for child in node.children:
            if type(child) is Node:
                follow(child, slot[2].get(child.signature) or slot[2].get(_bare(child.signature)) or NOWHERE)

    follow(root, wrapper)
    away = {id(x) for x in _nodes(root) if _passed(x, root)}
    headers = {id(x) for x in _nodes(root) if x.name == "header" or ("header" in x.words and x.name not in HEADINGS and not any(map(_content, _nodes(x))) and 4 * _paragraphs(x) <= 3 * _paragraphs(root))}
    lengths: dict[tuple[int, bool], int] = {}

    def blocks(node: Node, marked: bool, headings: bool = False) -> Iterator[str]:
        slot = slots[id(node)]
        if id(node) in away or (slot[0] == 2 and not marked):
            return
        if id(node) in headers and not marked:
            return
        template = slot[2].get(TEXT, NOWHERE)[0] == 1 and node.name not in HEADINGS
        headings = headings or id(node) in headers
        for child in node.children:
            if type(child) is Node:
                yield from blocks(child, marked, headings)
            elif not template and (not headings or node.name in HEADINGS):
                yield child[0]

    def length(node: Node, marked: bool = True) -> int:
        """Characters of the blocks, each node worked out once."""
        key = id(node), marked
        if key not in lengths:
            slot = slots[id(node)]
            if id(node) in away or (not marked and (slot[0] == 2 or id(node) in headers)):
                lengths[key] = 0
            elif id(node) in headers:
                lengths[key] = sum(map(len, blocks(node, marked)))
            else:
                template = slot[2].get(TEXT, NOWHERE)[0] == 1 and node.name not in HEADINGS
                lengths[key] = sum(length(c, marked) if type(c) is Node else 0 if template else len(c[0]) for c in node.children)
        return lengths[key]

    def outermost(node: Node, test) -> Iterator[Node]:
        if id(node) in away:
            return
        if test(node):
            yield node
            return
        for child in node.children:
            if type(child) is Node:
                yield from outermost(child, test)

    def inner(node: Node, test) -> list[Node]:
        """The one marked element with most of the text inside, if there is one, as long as there is."""
        while True:
            found = [x for child in node.children if type(child) is Node for x in outermost(child, test)]
            top = max(found, key=length, default=None)
            if top is None or 2 * length(top) <= length(node):
                return [node]
            node = top

    for test in (_marked, lambda x: bool(CONTENT & set(x.words))):
        found = [x for x in outermost(root, test) if length(x)]
        if found:
            top = max(found, key=length)
            whole = sum(map(length, found))
            chosen = inner(top, test) if 2 * length(top) > whole else found
            return [b for x in chosen for b in blocks(x, True)]
    node = root
    while True:
        below = [(slots[id(c)][1], length(c, False), k, c) for k, c in enumerate(node.children) if type(c) is Node and length(c, False)]
        own = sum(len(c[0]) for c in node.children if type(c) is tuple)
        total = sum(b[0] for b in below)
        top = max(below, default=None, key=lambda b: b[:3])
        if top is None or own or 2 * top[0] <= total or top[3].name in HEADINGS or top[3].name in ("p", "li", "dd", "dt"):
            return list(blocks(node, False))
        node = top[3]


NOWHERE: list = [0, 0, {}]


@lru_cache(maxsize=256)
def _read(text: str) -> list:
    return json.loads(text)


def _inferred(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's pages as one wrapper for each host, given out when too many slots are held."""
    held: dict[str, Wrapper] = {}
    new = 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([w.text() for w in held.values()], pa.string())], names=["host", "wrapper"])

    for batch in batches:
        for host, html in zip(batch.column(0), batch.column(1)):
            host, html = host.as_py(), html.as_py() or ""
            page = Wrapper(page_wrapper(page_tree(html)), {_hash(html)})
            if host in held:
                held[host].add(page)
            else:
                held[host] = page
                new += page.root.size()
            if new > HELD:
                yield out()
                held, new = {}, 0
    if held:
        yield out()


def _together(final: bool):
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = None
        for batch in batches:
            for text in batch.column("wrapper"):
                one = Wrapper.of(text.as_py())
                if whole is None:
                    whole = one
                else:
                    whole.add(one)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.string()), pa.array([decided(whole) if final else whole.text()], pa.string())], names=["host", "wrapper"])

    run.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return run


def _extracted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        wrappers = batch.column("wrapper")
        texts = ["\n\n".join(page_blocks(page_tree(html.as_py() or ""), _read(w.as_py()) if w.is_valid else NOWHERE)) for html, w in zip(batch.column("html"), wrappers)]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) of the rows (host, html), as ``page_blocks`` reads them."""
    parts = pages.select("host", "html").mapInArrow(_inferred, "host string, wrapper string")
    parts = parts.withColumn("part", F.pmod(F.xxhash64("wrapper"), F.lit(GROUPS)))
    parts = parts.groupBy("host", "part").applyInArrow(_together(False), "host string, wrapper string")
    return parts.groupBy("host").applyInArrow(_together(True), "host string, wrapper string")


def extract_main_text(pages: DataFrame, *, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row for each page: page_id, url, text (blocks joined by an empty line) and n_chars."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), host.alias("host"))
    wrappers = written(infer_wrappers(rows), "wrappers")
    size = wrappers.agg(F.sum(F.length("wrapper") + F.length("host"))).first()[0] or 0  # one number
    if size <= BROADCAST_BYTES:
        met = rows.join(F.broadcast(wrappers), "host", "left")
    else:
        counted = written(rows.groupBy("host").agg(F.count("*").alias("n")).join(wrappers, "host"), "wrappers-of-hosts")
        dropped(wrappers)
        a, b = salted(rows.withColumn("_of", F.xxhash64("page_id", "url")), counted, ["host"], "_of")
        met = a.join(b.hint("shuffle_hash"), ["host", "_salt"], "left")
    return met.select("page_id", "url", "html", "wrapper").mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
