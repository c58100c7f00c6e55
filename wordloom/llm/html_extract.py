"""HTML extraction by consensus host paths.

Each page's containers are scored by the text they hold, and the page votes for the path of the lowest one
that holds its best and all blocks of the article: the tags and classes from the root, with digits left out of the classes. Votes are counted per
host in Spark, and every page is read again along its host's winning path; a page without that path
uses its own. Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments never count, but a container that only its name marks does if it holds the article.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.decontam import small
from wordloom.llm.url_filter import host_and_path
from wordloom.session import stage_table

#: A path wins within a page if it holds this share of the best path's score and is deeper.
SHARE = 0.8
#: A block of so many bytes, or a heading, widens the path to hold it unless more than half of it is links.
LEAST_BLOCK = 20
#: What article and main elements gain over plain containers.
GAIN = 1.5

#: Outside of quotes no tag reaches over the next ``<``, so each byte is looked at a bounded number of times.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|title|textarea|noscript|template|iframe|svg|select|xmp)\b(?:(?:[^\"'<>]++|\"[^\"]*+\"|'[^']*+')*+|[^<>]*+)>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^<>]*+>"
    r"|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^\"'<>]++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/<>]*+)([^<>]*+)>",
    re.DOTALL | re.IGNORECASE,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
CONTAINERS = frozenset("html body main article section div td th tr table tbody ul ol dl nav aside header footer form blockquote figure menu dialog fieldset center details head".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre hr address figcaption summary caption legend option thead tfoot".split())
DROPPED = frozenset("nav aside header footer form menu dialog head button".split())
#: Parts of a class, id or role that mark what is not the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert "
    "sidebar aside nav navbar navigation menu breadcrumb breadcrumbs header masthead footer comment comments respond reply replies disqus "
    "share sharing social related recommended newsletter subscribe signup login modal popup overlay widget pagination pager toolbar search".split()
)


#: Marks of what readers wrote, which is not the article however much it is.
READERS = frozenset("comment comments respond reply replies disqus".split())
#: Parts of a name that tell what a page has beside its article, or that a container wraps both.
WITH = frozenset("has with no without".split())
CONTENT, WRAP = frozenset("content main article post entry page".split()), frozenset("wrap wrapper container layout".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class Block:
    """Text between two block boundaries with the node it stands in and the innermost marked container around it."""

    __slots__ = ("heading", "linked", "mark", "node", "text")

    def __init__(self, node: int, text: str, linked: int, heading: bool = False, mark: int = -1):
        self.node, self.text, self.linked, self.heading, self.mark = node, text, linked, heading, mark


class Page:
    """Blocks in order, and the paths they stand in as a trie: a node is a generalised path, 0 the page itself.

    Nodes come after their parents, so sums over all that is below take one pass from the last to the first.
    """

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.parent, self.step, self.depth = [-1], [""], [0]
        self.children: dict[tuple[int, str], int] = {}

    def child(self, node: int, step: str) -> int:
        found = self.children.get((node, step))
        if found is None:
            found = self.children[node, step] = len(self.parent)
            self.parent.append(node)
            self.step.append(step)
            self.depth.append(self.depth[node] + 1)
        return found

    def tag(self, node: int) -> str:
        return self.step[node].split(".")[0]

    def path(self, node: int) -> str:
        steps = []
        while node > 0:
            steps.append(self.step[node])
            node = self.parent[node]
        return ">".join(reversed(steps))

    def find(self, path: str) -> int | None:
        """The node of a path, if the page has it."""
        node: int | None = 0
        for step in path.split(">") if path else ():
            node = self.children.get((node, step))
            if node is None:
                return None
        return node

    def below(self, values: list) -> list:
        """For each node the sum of the values at it and below it."""
        total = list(values)
        for node in range(len(total) - 1, 0, -1):
            total[self.parent[node]] += total[node]
        return total

    def within(self, root: int) -> list[bool]:
        """Whether each node is ``root`` or below it."""
        inside = [False] * len(self.parent)
        for node in range(len(inside)):
            inside[node] = node == root or (node > 0 and inside[self.parent[node]])
        return inside


def _marks_of(name: str) -> frozenset:
    """The marks in a class, id or role, if it is the name of what is marked."""
    parts = re.split(r"[-_\d]+", name)
    around = not WITH.isdisjoint(parts) or (parts[-1] in WRAP and not CONTENT.isdisjoint(parts))
    return frozenset() if around else MARKS.intersection(parts)


def _step(tag: str, attributes: str) -> tuple[str, bool, frozenset]:
    """Generalised name of an element, whether its text never counts, and the marks of its name."""
    if not attributes.strip():
        return tag, tag in DROPPED, frozenset()
    classes, marks = [], frozenset()
    for m in NAMES.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            marks |= _marks_of(name)
            if m.group()[:5].lower() == "class":
                classes.append(re.sub(r"\d+", "", name))
    return ".".join([tag, *sorted(set(classes) - {""})]), tag in DROPPED, marks


def _without_marked(found: list[Block], outer: list[int], readers: list[bool], articles: list[int]) -> list[Block]:
    """The blocks outside of marked containers, of which those that hold the article are none.

    Those are the ones with an article or main element, if there is none outside, and those with most of the
    page's unlinked text. ``outer`` is the marked container around each one, ``readers`` tells whether it holds what readers
    wrote, which needs both; ``articles`` has the innermost marked container around each article or main element.
    """
    held, holds, clear = [0] * len(outer), [False] * len(outer), [False] * len(outer)
    whole = 0
    for b in found:
        value = max(0, len(b.text) - b.linked)
        whole += value
        if b.mark >= 0:
            held[b.mark] += value
    for a in articles:
        if a >= 0:
            holds[a] = True
    for k in range(len(outer) - 1, -1, -1):
        if outer[k] >= 0:
            held[outer[k]] += held[k]
            holds[outer[k]] |= holds[k]
    around, free = set(articles), -1 in articles
    for k, by_readers in enumerate(readers):  # outer ones first
        most = 2 * held[k] > whole
        if (most or holds[k]) and not (by_readers and not most) and ((holds[k] and not free) or (most and not by_readers)):
            clear[k] = outer[k] < 0 or clear[outer[k]]
            free |= clear[k] and k in around
    return [b for b in found if b.mark < 0 or clear[b.mark]]


def blocks(text: str) -> Page:
    """A page's blocks in order, without those that never count."""
    page = Page()
    stack: list[tuple[str, int, bool, int]] = []  # tag, node, dropped, marked container
    opened: Counter = Counter()
    pieces: list[str] = []
    outer: list[int] = []
    readers: list[bool] = []
    articles: list[int] = []
    linked = in_link = at = 0
    heading = False

    def close() -> None:
        nonlocal linked
        if pieces:
            found = " ".join(html.unescape("".join(pieces)).split())
            if found and not (stack and stack[-1][2]):
                page.blocks.append(Block(stack[-1][1] if stack else 0, found, linked, heading, stack[-1][3] if stack else -1))
            pieces.clear()
        linked = 0

    def leave(tag: str) -> None:
        if opened[tag]:
            last = None
            while last != tag:
                last = stack.pop()[0]
                opened[last] -= 1

    def enter(tag: str, step: str, dropped: bool, mark: int | None = None) -> None:
        node, above, around = stack[-1][1:] if stack else (0, False, -1)
        stack.append((tag, page.child(node, step), dropped or above, around if mark is None else mark))
        opened[tag] += 1

    for m in TOKEN.finditer(text):
        if m.start() > at:
            pieces.append(text[at : m.start()])
            linked += (m.start() - at) * bool(in_link)
        at = m.end()
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            continue
        closing = m[2] or m[5]
        if tag not in BLOCKS:
            if tag == "a":
                in_link = not closing
            elif tag == "br" and pieces:
                pieces.append(" ")
            elif tag == "button":  # its text is closed off like that of a dropped container
                close()
                if closing:
                    leave("button")
                else:
                    enter("button", "button", True)
            continue
        close()
        heading = tag in HEADINGS and not closing
        if tag not in CONTAINERS:
            continue
        if closing:
            leave(tag)
        elif not (m[4] or m[7] or "").endswith("/"):
            step, dropped, marks = _step(tag, m[4] or m[7] or "")
            above, around = stack[-1][2:] if stack else (False, -1)
            mark = None
            if tag in ("article", "main"):
                if not (dropped or above or marks):
                    articles.append(around)
            elif marks and tag not in ("body", "html"):
                mark = len(outer)
                outer.append(around)
                readers.append(not READERS.isdisjoint(marks))
            enter(tag, step, dropped, mark)
    if at < len(text):
        pieces.append(text[at:])
    close()
    page.blocks = _without_marked(page.blocks, outer, readers, articles)
    return page


def best_node(page: Page) -> tuple[int, float]:
    """The node the page votes for and the best score: text held at or below a node, less what is linked.

    The deepest node of ``SHARE`` of the best score, the one with more and then the first, is widened to hold all blocks of the
    article: those of the article or main element that it stands in, or of the whole page.
    """
    values, many = [0] * len(page.parent), [0] * len(page.parent)
    for b in page.blocks:
        values[b.node] += max(0, len(b.text) - 2 * b.linked)
        many[b.node] += 1
    held = page.below(many)
    scores: list[float] = [s * GAIN if page.tag(n) in ("article", "main") else s for n, s in enumerate(page.below(values))]
    some = [n for n in range(1, len(held)) if held[n]]
    if not some:
        return 0, 0.0
    most = max(scores[n] for n in some)
    best = max((n for n in some if scores[n] >= SHARE * most), key=lambda n: (page.depth[n], scores[n], -n))
    root, up = 0, best
    while up > 0:  # the outermost article or main around it
        root, up = (up if page.tag(up) in ("article", "main") else root), page.parent[up]
    inside = page.within(root)
    wanted = [0] * len(page.parent)
    for b in page.blocks:
        if inside[b.node] and 2 * b.linked <= len(b.text) and (b.heading or len(b.text.encode("utf-8", "replace")) >= LEAST_BLOCK):
            wanted[b.node] += 1
    wanted[best] += 1
    below = page.below(wanted)
    while below[best] < below[0]:
        best = page.parent[best]
    return best, most


def text_along(page: Page, path: str | None) -> str:
    """The blocks at or below ``path``, or below the page's own best path if it has none there.

    Blocks of any length that stand right beside the path's container, in the one around it, belong to the article as
    well, unless they are links for the most part, the one around is the whole page, or the path ends with the article element.
    """
    node = page.find(path) if path else None
    inside = page.within(node) if node else []
    if not any(inside[b.node] for b in page.blocks if inside):
        node = best_node(page)[0]
        inside = page.within(node)
    beside = page.parent[node]
    if beside <= 0 or page.tag(beside) in ("html", "body") or page.tag(node) in ("article", "main"):
        beside = -1
    return "\n".join(b.text for b in page.blocks if inside[b.node] or (b.node == beside and 2 * b.linked <= len(b.text)))


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths, scores = [], []
        for text in batch.column(1).to_pylist():
            page = blocks(text or "")
            node, score = best_node(page)
            paths.append(page.path(node))
            scores.append(score)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.string()), pa.array(scores, pa.float64())], ["host", "path", "score"])


def votes(pages: DataFrame) -> DataFrame:
    """(host, path): the path that most pages of a host vote for, then the one with more text.

    Pages without a host share no template and have no vote.
    """
    host, _ = host_and_path("url")
    cast = pages.select(host.alias("host"), F.col("html").cast("string").alias("html")).where("host <> ''")
    each = cast.mapInArrow(_vote, "host string, path string, score double").where("path <> ''")
    counted = each.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(F.col("score").cast("bigint")).alias("score"))
    return counted.groupBy("host").agg(F.max_by("path", F.struct("n", "score", "path")).alias("path"))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("html").to_pylist(), batch.column("path").to_pylist(), strict=True)
        texts = pa.array([text_along(blocks(text or ""), path) for text, path in pairs], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), texts], ["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) per row of ``pages`` (page_id, url, html, any other columns).

    A null or empty page, or one without an article, has an empty text. Repeated rows vote each
    and give equal rows; an empty table gives none.
    """
    host, _ = host_and_path("url")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host.alias("host"))
    along = rows.join(small(stage_table(votes(pages), "host-paths")), "host", "left").select("page_id", "url", "html", "path")
    return along.mapInArrow(_extract, f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string")
