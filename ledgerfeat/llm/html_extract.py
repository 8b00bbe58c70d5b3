"""Main text of web pages from site style trees.

The pages of one host are merged into a style tree: a node is the chain of block elements with their class and id words.
For every node the entropy over the host's pages of its presentation (how many blocks a page has there) and of its
content (how evenly a text is spread over the pages) is its own evidence: what is the same on every page tells nothing.
The evidence of a branch is that of its nodes by size, and counts half in each of them. A node of links tells less.
Markup that names its own role (``nav``, ``footer``, ``article``, class ``ad`` ...) enters as the node's prior, because
menus, adverts and comments often differ from page to page. A site of several pages can overrule it: where names leave
little of the pages, a node of a loose name that is new on each page stays, and one that says the same everywhere goes.
Branches of low importance leave each page; the rest is its text.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfeat.llm.stages import Stages
from ledgerfeat.llm.text import texts_of

#: Shares of the prior, the presentation and the content in a node's importance, and the least importance to stay.
PRIOR_SHARE, PRESENTATION_SHARE, CONTENT_SHARE = 0.6, 0.08, 0.32
LEAST_IMPORTANCE = 0.5
#: What a name says for certain, or no reader sees, is below what stands around; no evidence brings it back.
MAIN, NEUTRAL, AROUND, FIRM, UNSEEN = 1.0, 0.5, 0.0, -0.75, -1.0
#: The branch's share in the evidence of its nodes, and what a node of nothing but links loses.
BRANCH_SHARE, LINK_SHARE = 0.5, 0.3
#: Evidence of so many pages can overrule a prior, by texts new (or the same) on all pages but a share. It raises nodes with
#: less than these thousandths in links, where names leave less than these of the pages' text; it lowers smaller nodes.
SURE_PAGES, SURE_SHARE, FEW_LINKS, LITTLE_LEFT, LARGE_PART = 4, 0.1, 300, 200, 500
RAISED, LOWERED = 0.5, 0.4

# Element names of HTML by their use.
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre
section summary table tbody td tfoot th thead tr ul""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|title|svg|math|iframe|object|canvas|audio|video|select|button"
AROUND_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
MAIN_TAGS = frozenset("article main".split())
# Words of class, id and role attributes that name what stands around a text.
AROUND_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo
promotion nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar aside widget widgets related
recommended share sharing social cookie cookies consent gdpr notice notices alert popup modal overlay newsletter
subscribe subscription signup login search searchbox comment comments commentlist disqus replies reply respond footer
contentinfo complementary masthead topbar toolbar hidden""".split())
#: Words that count only outside the main branch: an article has a header of its own.
PAGE_WORDS = frozenset("header head top bottom banner".split())
#: Tags and words that often hold articles all the same; the site can overrule these. All others are firm.
LOOSE_TAGS = frozenset("aside form fieldset dialog header".split())
LOOSE_WORDS = PAGE_WORDS | frozenset("sidebar aside widget widgets share sharing overlay modal popup complementary".split())
#: A class name that begins so tells what a layout has, not what the element is (has-sidebar, no-header).
LAYOUT_WORDS = frozenset("has with without no".split())
#: A name of several words has a role if all the others are such (comment-list, site-footer; not market-share).
GENERIC_WORDS = frozenset("""area article bar block blog body box button buttons col column container content entry
feed global group inner item items left link links list main outer page panel post posts primary right row secondary section
site slot text thread title unit wrap wrapper""".split())
ROLE_WORDS = AROUND_WORDS | PAGE_WORDS
#: A start tag ends an open element of the same group: (starting, ended, not beyond).
P_ENDERS = BLOCKS - {"html", "body"}
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "optgroup"}),
}

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b(?>[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL | re.IGNORECASE)
NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)
WORDS = re.compile(r"[a-z]+")


class _Element:
    """``outer`` is the prior that an article inside returns to: that outside the branch where only a name or a form rules it."""

    __slots__ = ("tag", "node", "branch", "prior", "outer")

    def __init__(self, tag: str, node: int, branch: int, prior: float, outer: float) -> None:
        self.tag, self.node, self.branch, self.prior, self.outer = tag, node, branch, prior, outer


_MARKS = {MAIN: "!main", NEUTRAL: "!neutral", AROUND: "!around", FIRM: "!firm", UNSEEN: "!unseen"}


def _open(tag: str, attributes: str, parent: _Element) -> _Element:
    words: list[str] = []
    named: set[str] = set()
    if "=" in attributes:
        for m in NAMES.finditer(attributes):
            for name in (m[2] or m[3] or m[4] or "").lower().split():
                found = WORDS.findall(name)
                words += found
                if found and found[0] not in LAYOUT_WORDS and tag not in ("html", "body") and (
                        len(found) == 1 or all(w in ROLE_WORDS or w in GENERIC_WORDS or len(w) < 3 for w in found)):
                    named.update(found)
    prior, outer = parent.prior, parent.outer
    if prior != UNSEEN:
        main = tag == "main" or "main" in named and "role" in attributes.lower()
        roles = named & AROUND_WORDS
        around = bool(roles) or tag in ("form", "fieldset")
        firm = bool(roles - LOOSE_WORDS) or tag in AROUND_TAGS - LOOSE_TAGS
        if attributes and HIDDEN.search(attributes):
            prior = outer = UNSEEN
        elif prior in (AROUND, FIRM):
            if main and not around:
                prior = outer = MAIN
            elif firm:
                prior = FIRM
            elif tag == "article" and not around and prior == AROUND:
                prior = outer
        elif tag in AROUND_TAGS or around or prior != MAIN and (tag == "header" or named & PAGE_WORDS):
            prior = FIRM if firm else AROUND
            outer = AROUND if tag in AROUND_TAGS and tag not in ("form", "fieldset") else outer
        elif main or tag in MAIN_TAGS:
            prior = outer = MAIN
    label = f"{tag}.{'.'.join(sorted(set(words)))}" if words else tag
    # Attributes outside the label change the prior too; blocks of different priors are different nodes.
    if prior != parent.prior:
        label += _MARKS[prior]
    node = _key(f"{parent.node}>{label}")
    top = prior != parent.prior or parent.tag in ("", "html", "body")
    return _Element(tag, node, node if top else parent.branch, prior, outer)


class Block(NamedTuple):
    """A block of text with its node and branch of the style tree and how many of its characters are links."""

    node: int
    prior: float
    text: str
    branch: int
    links: int


def page_blocks(page: str) -> list[Block]:
    """Blocks of text of a page in order.

    Unclosed and stray tags are repaired as far as block structure goes; a tag cut off at the end is no text. Scripts,
    styles and form controls hold no text. Where a page has a main branch with text, the rest stands around it.
    """
    stack, blocks, parts, at = [_Element("", 0, 0, NEUTRAL, NEUTRAL)], [], [], 0
    opened: Counter[str] = Counter()  # open elements by tag: no search for what is not open
    linked, in_links = False, 0

    def add(text: str) -> None:
        nonlocal in_links
        parts.append(text)
        if linked:
            in_links += len(text.strip())

    def flush() -> None:
        nonlocal in_links
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                last = stack[-1]
                links = 0 if last.tag in HEADINGS else min(in_links, len(text))  # a linked heading is no menu
                blocks.append(Block(last.node, last.prior, text, last.branch, links))
        in_links = 0

    def push(element: _Element) -> None:
        stack.append(element)
        opened[element.tag] += 1

    def close(names: set[str], limits: set[str]) -> None:
        if not any(opened[n] for n in names):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in limits:
                return
            if stack[i].tag in names:
                opened.subtract(e.tag for e in stack[i:])
                del stack[i:]
                return

    for m in TOKEN.finditer(page):
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        name = m[3] or m[6]
        if not name:
            continue
        tag, ends, attributes = name.lower(), m[2] or m[5], m[4] or m[7] or ""
        if tag == "br":
            parts.append(" ")
        elif tag in BLOCKS:
            flush()
            if ends:
                close({tag}, set())
                linked = False
            else:
                if tag in P_ENDERS:
                    close({"p"}, {"button", "td", "th", "table"})
                if tag in CLOSES:
                    close(*CLOSES[tag])
                if tag not in VOID:
                    push(_open(tag, attributes, stack[-1]))
        elif tag not in VOID:
            # An inline element matters only when it is a link or marks what stands around the text.
            if tag == "a":
                linked = not ends
            if ends:
                if opened[tag]:
                    flush()
                    close({tag}, set())
            elif "=" in attributes or "hidden" in attributes:
                found = _open(tag, attributes, stack[-1])
                if found.prior <= AROUND and found.prior != stack[-1].prior:
                    flush()
                    push(found)
    if at < len(page):
        add(page[at:])
    flush()
    if any(b.prior == MAIN for b in blocks):
        blocks = [b if b.prior <= AROUND or b.prior == MAIN else b._replace(prior=AROUND) for b in blocks]
    return blocks


def _key(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _node_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple] = []
        for page, host, text in zip(batch.column("page").to_pylist(), batch.column("host").to_pylist(), texts_of(batch, "html")):
            nodes: dict[int, list[Block]] = {}
            size = left = 0
            for block in page_blocks(text):
                nodes.setdefault(block.node, []).append(block)
                size += len(block.text)
                left += len(block.text) * (block.prior > AROUND)
            for node, blocks in nodes.items():
                chars = sum(len(b.text) for b in blocks)
                rows.append((page, host, node, blocks[0].branch, blocks[0].prior, len(blocks), sorted({_key(b.text) for b in blocks}),
                             1000 * chars // size, 1000 * sum(b.links for b in blocks) // chars, 1000 * left // size))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(zip(*rows), _NODE_TYPES.values())] if rows else
            [pa.array([], t) for t in _NODE_TYPES.values()], names=list(_NODE_TYPES))


_LONG = pa.int64()
_NODE_TYPES = {"page": _LONG, "host": _LONG, "node": _LONG, "branch": _LONG, "prior": pa.float64(), "blocks": _LONG,
               "texts": pa.list_(_LONG), "part": _LONG, "links": _LONG, "left": _LONG}


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for page, low in zip(texts_of(batch, "html"), batch.column("low").to_pylist()):
            gone = set(low or ())
            out.append("\n\n".join(b.text for b in page_blocks(page) if b.node not in gone))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def style_tree(nodes: DataFrame) -> DataFrame:
    """``evidence`` of each (host, node) from rows (page, host, node, branch, prior, blocks, texts, part, links, left).

    Entropies are to the base of the number of pages that have the node, so 0 to 1; a node on one page counts as telling.
    In thousandths, ``part`` is the node's part of its page's text, ``links`` that of links in the node and ``left`` the
    part of the page's text that names alone would leave.
    """
    pages = nodes.groupBy("host", "node").agg(
        F.count("*").alias("pages"), F.first("branch").alias("branch"),
        *[(F.sum(c) / F.count("*")).alias(c) for c in ("part", "links", "left")])
    # Presentation: spread of the number of blocks. One row per host, node and number after the first step.
    shapes = nodes.groupBy("host", "node", "blocks").agg(F.count("*").alias("n"))
    shapes = shapes.groupBy("host", "node").agg(F.sum(F.col("n") * F.ln("n")).alias("nlogn"), F.sum("n").alias("total"))
    shapes = shapes.select("host", "node", (F.ln("total") - F.col("nlogn") / F.col("total")).alias("presentation"))
    # Content: a text on n pages has entropy ln(n); telling texts are on one page.
    texts = nodes.select("host", "node", F.explode("texts").alias("t")).groupBy("host", "node", "t").agg(F.count("*").alias("n"))
    texts = texts.groupBy("host", "node").agg(F.avg(F.ln("n")).alias("spread"))
    joined = pages.join(shapes, ["host", "node"]).join(texts, ["host", "node"])
    base = F.ln(F.greatest("pages", F.lit(2)))
    many = F.col("pages") > 1
    content = F.when(many, 1.0 - F.col("spread") / base).otherwise(1.0)
    own = (F.lit(PRESENTATION_SHARE) * F.when(many, F.col("presentation") / base).otherwise(1.0)
           + F.lit(CONTENT_SHARE) * content - F.lit(LINK_SHARE) * F.col("links") / 1000)
    told = joined.select("host", "node", "branch", "pages", "part", "links", "left", content.alias("content"), own.alias("own"),
                         (F.col("pages") * F.greatest("part", F.lit(0.001))).alias("weight"))
    branches = told.groupBy("host", "branch").agg((F.sum(F.col("own") * F.col("weight")) / F.sum("weight")).alias("whole"))
    told = told.join(branches, ["host", "branch"])
    sure = F.col("pages") >= SURE_PAGES
    raised = sure & (F.col("content") >= 1 - SURE_SHARE) & (F.col("links") < FEW_LINKS) & (F.col("left") < LITTLE_LEFT)
    lowered = sure & (F.col("content") <= SURE_SHARE) & (F.col("part") < LARGE_PART)
    evidence = ((1 - BRANCH_SHARE) * F.col("own") + BRANCH_SHARE * F.col("whole")
                + F.when(raised, RAISED).when(lowered, -LOWERED).otherwise(0.0))
    return told.select("host", "node", evidence.alias("evidence"))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` for every row of ``pages``.

    Blocks of text are joined by a blank line; character references are decoded and white space becomes one space.
    A page without text, a null or an empty one gives an empty text. Null urls form one site. Rows of one site that
    repeat a page's markup count as one page of it and give equal texts. Other columns are not read. An empty table gives an empty table.
    """
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    source = source.withColumn("host", F.xxhash64(host)).withColumn("page", F.xxhash64("host", "html"))
    nodes = source.select("page", "host", "html").mapInArrow(
        _node_batches, "page long, host long, node long, branch long, prior double, blocks long, texts array<long>, "
        "part long, links long, left long")
    with Stages(pages.sparkSession) as stages:
        # The same page under several ids tells nothing about its site. Five readers follow, so pages are parsed once for all.
        nodes = stages.write(nodes.dropDuplicates(["page", "node"]))
        low = (nodes.select("page", "host", "node", "prior").join(style_tree(nodes), ["host", "node"])
               .where(F.col("prior") * PRIOR_SHARE + F.col("evidence") < LEAST_IMPORTANCE)
               .groupBy("page").agg(F.collect_set("node").alias("low")))  # nodes of one page
        low = stages.last(low)
    # Lists of nodes grow with the pages: one join at every size.
    return (source.join(low.hint("merge"), "page", "left").select("page_id", "url", "html", "low")
            .mapInArrow(_text_batches, "page_id long, url string, text string, n_chars long"))
