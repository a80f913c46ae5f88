"""Main text of pages by site style trees (operator 5).

The pages of a host are laid over each other: nodes with the same path of tags, classes
and ids are one node of the host's style tree. A node's importance joins two entropies
over the pages that have it. Presentation: how much the sequences of its children
vary. Content: how seldom its blocks of text are the same from page to page. Branches
of low importance are taken out of every page of the host, and blocks that are left
give the text.

What tags and names say goes before what is counted: menus, page headers, footers, asides,
adverts, notices and reader comments are unimportant wherever they are; an ``article`` or
``main`` is important, and if a page has one, nothing outside it is text, save an element
named as content that holds more than twice as much. Inside it only named branches can be
found unimportant, never its plain paragraphs. A name speaks of its own element by whole
words, not of an ``article`` or ``main``, and not where it says that the page has or has
no such part. What a name or a form's tag says of an element around most of the text, and
what counts say of a branch that holds half of it or more, does not hold: an article that
many pages copy stays, and so does a page inside one form.

Statistics are counts per (host, node, feature), summed before they are shuffled; a
host with a third of all pages is many rows with different keys. Only the unimportant
nodes of a host meet its pages again.

Defined results: a NULL or empty page, and one without text, gives an empty text; a
NULL url counts as a host of its own; repeated rows give repeated results; further
columns do not matter; an empty table gives no rows. Markup of any length is read to its
end whatever is unclosed in it; elements nested deeper than DEPTH count to the one there.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Callable, Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodline.llm.tables import staged

# The functions of tasks travel with the job, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_PAGES = 5
LOW = 0.3
PRESENTATION = 0.1
# Elements nested deeper are read as if they were not, as browsers do.
DEPTH = 512
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is no markup. Script and style run to the end if unclosed.
RAW = frozenset("script style iframe textarea title".split())
TO_THE_END = frozenset(("script", "style"))
BLOCK = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "blockquote pre figure figcaption header footer nav aside form fieldset address details summary hr".split()
)
# What these hold is never main text.
NOISE_TAGS = frozenset("nav footer aside button dialog menu head fieldset label noscript template svg math select object".split())
# A form may also be wrapped around a whole page.
WEAK_TAGS = frozenset(("form",))
COMMENT_NAMES = frozenset("comment comments commentlist respond replies disqus".split())
# Parts of a name that say noise wherever they stand in it, and those that say so only as all or the first of it.
NOISE_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs masthead footer sidebar aside ad ads adv advert adverts advertisement sponsor "
    "sponsored cookie cookies consent gdpr popup modal overlay newsletter subscribe signup login searchbox pagination pager toolbar "
    "complementary contentinfo".split()
)
# As the whole name they hold however much of the text is inside.
ADVERT_NAMES = frozenset("ad ads adv advert adverts advertisement".split())
FIRST_NAMES = frozenset(
    "promo promotion banner notice alert search share sharing social related recommended widget skip dialog form copyright legal disclaimer".split()
)
# "has-sidebar" speaks of the page and not of the element.
ABOUT_OTHERS = frozenset("has no not with without".split())
# A name must be all noise to speak of one of these.
CONTENT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre td th li dt dd figcaption caption span a b i em strong small u font".split())
CONTENT_NAMES = frozenset("content main article post entry story".split())
LANDMARKS = frozenset(("article", "main"))
WEAK, STRONG = 1, 2
# An element's start closes these open ones, as their end tags may be left out.
IMPLIED = {"li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p")}
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/<>]{0,60}+)")
_PLAIN = re.compile(r"[^<>\"']*+")
_ANY = re.compile(r"<[/!?][^<>]*+>")
_ATTR = re.compile(r"([^\s\"'<>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?|\"[^\"]*+\"|'[^']*+'")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"\d+")


def _says(name: str, tag: str) -> int:
    """What one class, id or role says of an element: 0 nothing, WEAK or STRONG that it is noise."""
    parts = [x.lower() for x in _PART.findall(name)]
    if not parts or parts[0] in ABOUT_OTHERS:
        return 0
    if parts[0] in COMMENT_NAMES and (len(parts) == 1 or tag not in CONTENT_TAGS):
        return STRONG
    if tag in LANDMARKS:
        return 0
    if len(parts) == 1 and parts[0] in ADVERT_NAMES:
        return STRONG
    if tag in CONTENT_TAGS:
        return WEAK if len(parts) == 1 and (parts[0] in NOISE_NAMES or parts[0] in FIRST_NAMES) else 0
    return WEAK if parts[0] in FIRST_NAMES or not NOISE_NAMES.isdisjoint(parts) else 0


class Node:
    """An open element: its tag, the hash of its path, and what its tag and names say.

    ``noise`` is what they say until the page is read, see ``page_of``.
    """

    __slots__ = ("tag", "path", "mark", "noise", "landmark", "soft", "named", "children", "parent", "chars", "main_chars")

    def __init__(self, tag: str, attributes: str, parent: Node | None) -> None:
        found: dict[str, str] = {}
        if attributes and not attributes.isspace():
            for m in _ATTR.finditer(attributes):
                if m[1]:
                    found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
        names = f"{found.get('class', '')} {found.get('id', '')} {found.get('role', '')}".split()
        key = f"{tag}.{_DIGITS.sub('', ' '.join(names).lower())}"
        inside = bool(parent and parent.landmark)
        hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
        self.tag = tag
        self.parent = parent
        self.path = xxhash.xxh3_64_intdigest(key, parent.path if parent else 0) >> 1
        self.mark = STRONG if tag in NOISE_TAGS or hidden or (tag == "header" and not inside) else WEAK if tag in WEAK_TAGS else 0
        if names and self.mark < STRONG and tag not in ("html", "body"):
            self.mark = max(self.mark, *(_says(name, tag) for name in names))
        self.noise = self.mark > 0
        self.landmark = inside or tag in LANDMARKS or "main" in found.get("role", "").lower().split()
        own = bool(names) and tag not in CONTENT_TAGS and any(not CONTENT_NAMES.isdisjoint(x.lower() for x in _PART.findall(name)) for name in names)
        self.soft = bool(parent and parent.soft) or (own and not self.mark and tag not in ("html", "body"))
        self.named = inside and bool(names) and tag not in LANDMARKS
        self.children: list[str] = []
        # Characters of text in the element, and of those the ones in an article or main.
        self.chars = self.main_chars = 0


def tag_end(html: str, at: int, dead: set[int]) -> int:
    """Where the ``>`` of a tag stands whose attributes begin at ``at``, or -1; quoted values may have any length.

    ``dead`` keeps the places after quoted values from which no tag of the page ends, so
    that no part of a page is searched for each of many tags.
    """
    passed = []
    while True:
        at = _PLAIN.match(html, at).end()
        mark = html[at : at + 1]
        if mark == ">":
            return at
        at = html.find(mark, at + 1) + 1 if mark in ('"', "'") else 0
        if not at or at in dead:
            dead.update(passed)
            return -1
        passed.append(at)


def _block_level(stack: list[Node]) -> list[Node]:
    """The open elements down to the innermost block, or element that makes its content the main text."""
    for i in range(len(stack) - 1, -1, -1):
        if stack[i].tag in BLOCK or (stack[i].landmark and not (i and stack[i - 1].landmark)):
            return stack[: i + 1]
    return []


def walk(html: str) -> Iterator[tuple[str, list[Node]] | Node]:
    """Blocks of a page in order, each with its open block-level elements, and every element when it closes.

    Parts of a block in an inline element of noise (a label, a button) are left out; a
    block that is noise as a whole is not.
    """
    stack: list[Node] = []
    held: list[str] = []
    # The block-level elements of the block held.
    place: list[Node] = []
    at, end = 0, len(html)
    unclosed: set[str] = set()
    dead: set[int] = set()

    def hold(part: str) -> None:
        nonlocal place
        if not held:
            place = _block_level(stack)
        held.append(" " if any(n.mark for n in stack[len(place) :]) else part)

    def flush() -> Iterator[tuple[str, list[Node]]]:
        text = " ".join(unescape("".join(held)).split())
        held.clear()
        if text:
            yield text, place

    while at < end:
        start = html.find("<", at)
        if start != at:
            part = html[at:] if start < 0 else html[at:start]
            hold(part)
            if start < 0:
                break
        if html.startswith("<!--", start):
            close = html.find("-->", start + 4)
            at = end if close < 0 else close + 3
            continue
        m = _TAG.match(html, start)
        close = tag_end(html, m.end(), dead) if m else -1
        if close < 0:
            other = _ANY.match(html, start)
            if other:
                at = other.end()
            else:
                hold("<")
                at = start + 1
            continue
        attributes = html[m.end() : close]
        at = close + 1
        closing, tag = m[1], m[2].lower()
        if tag in RAW:
            if not closing and tag not in unclosed:
                close = re.compile(rf"</{tag}\b[^<>]*+>?", re.I).search(html, at)
                if close:
                    at = close.end()
                elif tag in TO_THE_END:
                    at = end
                else:
                    unclosed.add(tag)
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag in BLOCK:
            yield from flush()
        if tag == "body" and not closing:
            while stack and stack[-1].tag != "html":
                yield stack.pop()
        if closing:
            if any(n.tag == tag for n in stack) and not (tag not in BLOCK and any(n.tag in BLOCK for n in stack[max(i for i, n in enumerate(stack) if n.tag == tag) + 1 :])):
                while stack:
                    node = stack.pop()
                    yield node
                    if node.tag == tag:
                        break
            continue
        if tag in VOID:
            continue
        if tag in BLOCK:
            ends = IMPLIED.get(tag, ("p",))
            scope = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].tag in ("div", "article", "section", "ul", "ol", "table", "td", "th", "li", "main", "aside", "nav", "body", "dl", "tr") and stack[i].tag not in ends), -1)
            first = next((i for i in range(scope + 1, len(stack)) if stack[i].tag in ends), None)
            if first is not None:
                while len(stack) > first:
                    yield stack.pop()
        if stack:
            stack[-1].children.append(tag)
        if not attributes.endswith("/") and len(stack) < DEPTH:
            stack.append(Node(tag, attributes, stack[-1] if stack else None))
    yield from flush()
    yield from reversed(stack)


def page_of(html: str) -> tuple[list[tuple[str, list[Node]]], list[Node]]:
    """Blocks and elements of a page, when it is known which elements are noise.

    What a form's tag or a name says does not hold for an element around more than half
    of the text that is left without tags of noise, unless an article stands outside it.
    """
    blocks, nodes = [], []
    for item in walk(html):
        (nodes if isinstance(item, Node) else blocks).append(item)
    total = articles = 0
    for text, place in blocks:
        if any(n.mark == STRONG for n in place):
            continue
        size = len(text)
        inside = size if place and place[-1].landmark else 0
        total += size
        articles += inside
        for n in place:
            n.chars += size
            n.main_chars += inside
    # Elements come when they close: a parent is after its children.
    for n in reversed(nodes):
        wraps = 2 * n.chars > total and n.main_chars == articles
        n.noise = bool(n.parent and n.parent.noise) or n.mark == STRONG or (n.mark == WEAK and not wraps)
    return blocks, nodes


def _host() -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def observations(pages: DataFrame) -> DataFrame:
    """``host, path, kind, feature, n``: kind 0 for presentation, 1 for content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for host, html in zip(*(c.to_pylist() for c in batch.columns)):
                seen = set()
                blocks, elements = page_of(html or "")
                for item in elements:
                    if not item.noise:
                        style = " ".join(t for i, t in enumerate(item.children) if not i or t != item.children[i - 1])
                        seen.add((item.path, 0, xxhash.xxh3_64_intdigest(style) >> 1))
                for text, nodes in blocks:
                    feature = xxhash.xxh3_64_intdigest(text) >> 1
                    seen.update((n.path, 1, feature) for n in nodes if not n.noise)
                counts.update((host, *x) for x in seen)
            keys = list(zip(*counts)) if counts else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[0], pa.string()), pa.array(keys[1], pa.int64()), pa.array(keys[2], pa.int32()), pa.array(keys[3], pa.int64()), pa.array(list(counts.values()), pa.int64())],
                ["host", "path", "kind", "feature", "n"],
            )

    return pages.select(_host().alias("host"), "html").mapInArrow(run, "host string, path long, kind int, feature long, n long")


def importance(pages: DataFrame) -> DataFrame:
    """``host, path, pages, importance`` of the nodes of every host's style tree.

    With m the presentations seen of a node, each a share p of them, presentation is
    -sum p log_m p; content is 1 minus the mean over the blocks of log_m of how many
    pages have the block. Content also holds the blocks of the branches below.
    """
    per = observations(pages).groupBy("host", "path", "kind", "feature").agg(F.sum("n").alias("n"))
    sums = per.groupBy("host", "path").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("n"))).alias("pages"),
        F.sum(F.when(F.col("kind") == 0, F.col("n") * F.log("n"))).alias("styles"),
        F.sum(F.when(F.col("kind") == 1, F.col("n"))).alias("blocks"),
        F.sum(F.when(F.col("kind") == 1, F.col("n") * F.log("n"))).alias("repeats"),
    )
    m = F.log(F.greatest(F.col("pages"), F.lit(2)))
    style = 1 - F.col("styles") / (F.col("pages") * m)
    content = F.coalesce(1 - F.col("repeats") / (F.col("blocks") * m), F.lit(0.0))
    joined = PRESENTATION * style + (1 - PRESENTATION) * content
    return sums.where(F.col("pages") > 0).select("host", "path", "pages", F.greatest(F.lit(0.0), joined).alias("importance"))


Blocks = list[tuple[str, list[Node]]]


def _without_low(blocks: Blocks, low: frozenset[int], candidates: Callable[[Node], bool]) -> Blocks:
    """The blocks outside unimportant branches; a branch that holds half of the text or more is none."""
    held: Counter = Counter()
    for text, nodes in blocks:
        for n in nodes:
            if n.path in low and candidates(n):
                held[id(n)] += len(text)
    total = sum(len(text) for text, _ in blocks)
    gone = {n for n, size in held.items() if 2 * size < total}
    return [(text, nodes) for text, nodes in blocks if not any(id(n) in gone for n in nodes)]


def main_text(html: str, low: frozenset[int]) -> str:
    """The blocks of a page that are in no unimportant branch, joined by spaces."""
    blocks, _ = page_of(html)
    kept = [(text, nodes) for text, nodes in blocks if not (nodes and nodes[-1].noise)]
    marked = [(text, nodes) for text, nodes in kept if nodes and nodes[-1].landmark]
    if marked:
        # An element named as content, beside an article much shorter than it, holds the text.
        beside = [(text, nodes) for text, nodes in kept if nodes and nodes[-1].soft and not next(n for n in nodes if n.soft).main_chars]
        if sum(len(text) for text, _ in beside) > 2 * sum(len(text) for text, _ in marked):
            chosen = _without_low(beside, low, lambda n: n.tag not in ("html", "body"))
        else:
            chosen = _without_low(marked, low, lambda n: n.named)
    else:
        # A site whose pages are all alike has no important node: the names decide alone.
        chosen = _without_low(kept, low, lambda n: n.tag not in ("html", "body"))
    return " ".join(text for text, _ in chosen)


def extracted(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: ``page_id, url, text, n_chars``."""
    low = staged(importance(pages).where((F.col("pages") >= MIN_PAGES) & (F.col("importance") < LOW)), "unimportant")
    per = low.groupBy("host").agg(F.collect_list("path").alias("low"))
    rows = pages.select("page_id", "url", "html", _host().alias("host")).join(per, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            page, url, html, low = batch.columns
            texts = [main_text(h.as_py() or "", frozenset(x.as_py() or ())) for h, x in zip(html, low)]
            lengths = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([page, url, pa.array(texts, pa.string()), lengths], ["page_id", "url", "text", "n_chars"])

    return rows.select("page_id", "url", "html", "low").mapInArrow(run, "page_id long, url string, text string, n_chars long")
