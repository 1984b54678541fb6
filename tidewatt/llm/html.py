"""Main text of web pages by site style trees (operator 10).

The pages of a host are merged into one tree: a node is the path of block elements with their
classes, and holds how often each sequence of children occurs (presentation) and on how many of
the pages that have the node each word, link and image, and the node's whole text, occurs (content).
A word on every page has entropy 1 there and one of a single page 0. A node's *content* is one less
the mean entropy of the words and links below it, its *whole* one less the mean entropy of its whole
text, its *mass* the share that it has of the information of the host's pages, which is the sum
of one less the entropy over all their words, its *size* its words a page, its *linked* share the
words in links among them, and its *variety* the effective number of its sequences of children, the
exponential of their entropy.

The topmost node that has most of the mass and varies is the host's container of articles: a
template has few sequences of children, an article as many as there are articles. Elements that are
made for articles, and branches with a first-level heading that differs from page to page, are
containers, too, however small. Inside a container headings, labels and cells stay though they recur;
link lists and other branches go where neither their words nor their whole text differ. Outside, a
branch has to hold a share of the mass or some words, besides: its content counts by mass / ``SHARE``
or size / ``LONG``, up to 1. Mass and size are those of the host drawn towards those of the like branch
on all hosts, by ``DRAWN`` pages, and count the less the fewer pages have that branch anywhere: so a
host with few pages is judged by the same rule. Branches of low importance are removed from each page.

Fixed knowledge adds to that: elements that hold no article (``NO_ARTICLE``) go on any host. A
class, role or whole id that has only words of ``NO_ARTICLE_WORDS`` names a branch as no article's;
it lowers the branch's importance, unless over half of the mass is there, also with the like branches or in many words. Ids of headings are
anchors and name nothing. Other uses of these words, and the broader ``HINTS``, lower importance
less ("related-work", "legal"). Identical pages of a host count once, so copies of an article don't
make it look like a template.

Character references are decoded, white space in a block becomes one space, and blocks are joined
by one space. A null page is empty, and so is its text. A null URL, or one without ``://``, belongs
to the host "". Unclosed and stray tags are tolerated. The tree has ``LEVELS`` levels; what is
nested deeper belongs to the node there. Repeated rows are extracted alike. Tables without rows
give none; columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from html import unescape
from typing import NamedTuple
from zlib import crc32

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatt.llm.lasting import lasting, written
from tidewatt.llm.urls import host

LOW = 0.3
#: A container of articles has this share of its host's mass and so many effective sequences of children.
MOST = 0.5
VARIED = 3.0
#: Outside the containers, branches below this share of the mass and so many words a page are the less important.
SHARE = 0.2
LONG = 60
#: Pages for which all hosts' like branches stand beside a host's own.
DRAWN = 4
#: From this share of words in links on, a branch is a link list.
LIST = 0.5
#: What a hint and a name leave of a branch's importance.
HINTED, NAMED_AS = 0.5, 0.25
LEVELS = 64
#: Features that a task holds at a time, about; judged nodes up to which their lists are sent to every
#: executor, some MB, and hosts whose pages are dealt to several tasks beyond that, each with as large a share of all pages.
HELD = 1 << 18
NODES = 100_000
HOT = 1024

#: Fixed sets: elements without an end, elements that run on within a block, elements that hold no
#: article, and words of classes, ids and roles that say so.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br img".split())
NO_ARTICLE = frozenset("head title script style noscript template nav header footer aside form iframe object select button textarea svg canvas dialog menu audio video".split())
NO_ARTICLE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored menu nav navbar navigation breadcrumb breadcrumbs header footer sidebar aside banner "
    "cookie cookies consent notice notices gdpr popup modal newsletter subscribe signup comment comments disqus toolbar pagination pager contentinfo complementary search login masthead".split()
)
HINTS = frozenset("promo share sharing social related recommended respond reply replies widget copyright legal".split())
MAIN = frozenset("html body main article".split())
COMMENTS = frozenset("comment comments disqus".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARTS = frozenset("p li ul ol dl dt dd table thead tbody tfoot tr td th caption figure figcaption blockquote pre hgroup".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = frozenset("ul ol dl table div section article body main blockquote".split())


RAW = {t: re.compile(f"</{t}(?![a-z])[^>]*>", re.I) for t in ("script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp")}
#: An attribute as HTML reads it: a quote opens a value only behind an =, and the value runs to the
#: next such quote, however far. A quote that never closes is a sign like any other.
_NAME, _VALUE = r"[^\s/>][^\s/>=]*+", r"""(?:"[^"]*+"|'[^']*+'|[^\s>]++)"""
_ATTRIBUTES = re.compile(rf"({_NAME})(?:\s*+=\s*+({_VALUE})?+)?+")
#: The start of a comment, a tag with its attributes, or a declaration. What has no end takes all that
#: is left, so that no part is searched twice. In the second form quotes mean nothing.
_TAG = re.compile(rf"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{_NAME}(?:\s*+=\s*+{_VALUE}?+)?+)*+)(>?)|[!?/][^>]*+>?)")
_PLAIN = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(>?)|[!?/][^>]*+>?)")
#: Longer attributes (inline images, JSON) are read each time rather than kept.
KEPT_ATTRIBUTES = 512


class Said(NamedTuple):
    """What attributes say: whether a class or role is no article's, whether the id is, whether one
    of them is of comments, whether any has such a word or a hint, the suffix of the node's name
    (its classes), and what a link or image refers to."""

    no_article: bool
    no_article_id: bool
    comments: bool
    hint: bool
    classes: str
    refers: str


def read_attributes(attributes: str, names: frozenset[str]) -> Said:
    """The first of attributes that share a name counts."""
    values: dict[str, str] = {}
    for name, value in _ATTRIBUTES.findall(attributes):
        if (name := name.lower()) in _SAYING and name not in values:
            values[name] = value[1:-1] if value[:1] in ("'", '"') and value[-1:] == value[:1] and len(value) > 1 else value
    no, comments, hint = {"class": False, "id": False, "role": False}, False, False
    for name in no.keys() & values.keys() if names else ():
        value = values[name]
        for token in [value] if name == "id" else value.split():
            words = set(token.lower().replace("-", " ").replace("_", " ").split())
            hint |= bool(words & names or words & HINTS)
            if words and words <= names:
                no[name] = True
                comments |= bool(words & COMMENTS)
    classes = "".join("." + c for c in sorted(set(values.get("class", "").split())))
    return Said(no["class"] or no["role"], no["id"], comments, hint, classes, values.get("href") or values.get("src") or "")


_SAYING = frozenset(("class", "id", "role", "href", "src"))
_kept = lru_cache(maxsize=1 << 15)(read_attributes)


def said(attributes: str, names: frozenset[str]) -> Said:
    return (_kept if len(attributes) <= KEPT_ATTRIBUTES else read_attributes)(attributes, names)


PLAIN, HINT, HEADING, NAMED, PART, ARTICLE, FIRST = (bytes([i]) for i in range(7))


def step(name: str, kind: bytes = PLAIN) -> bytes:
    """A node's part of its path: a byte for its kind, and a hash of its name."""
    return kind + xxhash.xxh64_digest(name.encode("utf-8", "surrogatepass"))[:7]


_step = lru_cache(maxsize=1 << 14)(step)


class Page:
    """Blocks of one page: (path of the leaf, text), the links and images of each node, and the
    children of each. names: the words that name branches as no article's; without any, elements
    alone do. removed: nodes that are left out; kept: named nodes that are not (None: no named node
    is left out)."""

    def __init__(self, markup: str, site: str = "", names: frozenset[str] = NO_ARTICLE_WORDS, removed: Iterable[bytes] = (), kept: Iterable[bytes] | None = ()):
        self.blocks: list[tuple[bytes, str]] = []
        #: Words in links of each block.
        self.linked: list[int] = []
        self.links: list[tuple[bytes, str]] = []
        self.children: dict[bytes, list[str]] = {}
        self._root = step(site)
        self._names = names
        self._removed = frozenset(removed)
        self._kept = None if kept is None else frozenset(kept)
        # Element, path, whether it holds no article, whether an element about it says so, whether it was removed.
        self._open: list[tuple[str, bytes, bool, bool, bool]] = []
        self._count: dict[str, int] = {}
        self._parts: list[str] = []
        self._link_parts: list[str] = []
        self._in_link = False
        self._met = False
        self._read(markup)
        self._end_block()

    def _read(self, markup: str) -> None:
        at = 0
        find, text = _TAG.search, self._text
        while m := find(markup, at):
            if m.start() > at:
                text(markup[at : m.start()])
            at = m.end()
            comment, slash, tag, attributes, closed = m.groups()
            if tag:
                if not closed:
                    # Its quotes hide every later >. Without them the text stays.
                    if ">" not in attributes:
                        return
                    at, find = m.start(), _PLAIN.search
                    continue
                tag = tag.lower()
                if slash:
                    self._end(tag)
                else:
                    self._start(tag, attributes)
                    if tag in RAW:
                        close = RAW[tag].search(markup, at)
                        if not close:
                            return
                        at = close.end()
                        self._end(tag)
            elif comment:
                end = markup.find("-->", at)
                if end < 0:
                    return
                at = end + 3
        text(markup[at:])

    def _text(self, raw: str) -> None:
        if not (self._open and self._open[-1][2]):
            self._parts.append(unescape(raw) if "&" in raw else raw)
            if self._in_link:
                self._link_parts.append(raw)

    def _end_block(self) -> None:
        if self._parts:
            text = " ".join("".join(self._parts).split())
            self._parts = []
            if text:
                path = self._open[-1][1] if self._open else self._root
                if path not in self._removed:
                    self.blocks.append((path, text))
                    self.linked.append(len(" ".join(self._link_parts).split()))
            self._link_parts = []

    def _pop(self, n: int) -> None:
        for x in self._open[n:]:
            if x[0] not in INLINE:
                self._end_block()
                break
        for x in self._open[n:]:
            self._count[x[0]] -= 1
        del self._open[n:]

    def _push(self, tag: str, *rest) -> None:
        self._open.append((tag, *rest))
        self._count[tag] = self._count.get(tag, 0) + 1

    def _start(self, tag: str, attributes: str) -> None:
        says = said(attributes, self._names) if attributes else _SILENT
        named = says.no_article or says.no_article_id and tag not in HEADINGS
        open_ = self._open
        if says.refers and tag in ("a", "img") and not (open_ and open_[-1][2]):
            self.links.append((open_[-1][1] if open_ else self._root, says.refers))
        if tag in INLINE:
            if tag == "a":
                self._in_link = bool(says.refers)
            if tag == "br":
                self._parts.append(" ")
            elif tag not in VOID and named:
                self._push(tag, open_[-1][1] if open_ else self._root, True, bool(open_ and open_[-1][3]), bool(open_ and open_[-1][4]))
            return
        closes = CLOSES.get(tag, _NONE)
        if tag == "body" and self._count.get("head"):
            self._pop(next(i for i, x in enumerate(open_) if x[0] == "head"))
        for i in range(len(open_) - 1, -1, -1):
            there = open_[i][0]
            if there == "p" or there in closes:
                self._pop(i)
                break
            if there in HOLDS:
                break
        self._end_block()
        if tag in VOID:
            return
        above_path, above, by_element, out = open_[-1][1:] if open_ else (self._root, False, False, False)
        path, deep = above_path, len(above_path) >= 8 * LEVELS
        if not deep:
            kind = FIRST if tag == "h1" else HEADING if tag in HEADINGS else NAMED if named else HINT if says.hint else ARTICLE if tag in ("article", "main") else PART if tag in PARTS else PLAIN
            path += _step(tag + says.classes, kind)
        if named and not deep and (self._kept is None or path in self._kept):
            named = False
        if tag in MAIN:
            # A page's first article counts even where a wrapper around it is named after a sidebar or header beside it.
            no = says.comments or above and (by_element or self._met)
            self._met |= tag in ("article", "main")
        else:
            no = above or tag in NO_ARTICLE or named
        if not no and not deep:
            self.children.setdefault(above_path, []).append(tag + says.classes)
        out = out or path in self._removed
        self._push(tag, path, no or out, by_element or tag in NO_ARTICLE, out)

    def _end(self, tag: str) -> None:
        if tag == "a":
            self._in_link = False
        if tag == "br" or tag == "p" and not self._count.get("p"):
            self._parts.append(" ")
            return
        if not self._count.get(tag):
            return
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i][0] == tag:
                self._pop(i)
                return

    def text(self) -> str:
        return " ".join(t for _, t in self.blocks)


_SILENT = Said(False, False, False, False, "", "")
_NONE: frozenset[str] = frozenset()

#: Features of a node: words from 0 on and links above them, its whole text above those, how many words
#: and words in links it has, each page that has the node, and below that the sequences of children.
LINKS, WHOLE, SIZE, LINKED, SEEN = 1 << 32, 1 << 33, 1 << 62, (1 << 62) + 1, -1


def page_features(page: Page) -> dict[bytes, dict[int, int]]:
    """Features of each node of a page, with how often they count: the whole texts of nodes with more
    nodes below, too."""
    found: dict[bytes, dict[int, int]] = {}
    whole: dict[bytes, xxhash.xxh64] = {}
    for (path, text), linked in zip(page.blocks, page.linked):
        words = text.split()
        own = found.setdefault(path, {SEEN: 1, SIZE: 0, LINKED: 0})
        own.update(dict.fromkeys([crc32(w.encode("utf-8", "surrogatepass")) for w in set(words)], 1))
        own[SIZE] += len(words)
        own[LINKED] += linked
        raw = text.encode("utf-8", "surrogatepass")
        for end in range(16, len(path) + 1, 8):
            whole.setdefault(path[:end], xxhash.xxh64()).update(raw)
    for path, link in page.links:
        if path in found:
            found[path][LINKS + crc32(link.encode("utf-8", "surrogatepass"))] = 1
    for path, digest in whole.items():
        found.setdefault(path, {})[WHOLE + (digest.intdigest() >> 3)] = 1
    for path, names in page.children.items():
        found.setdefault(path, {})[SEEN - 1 - (xxhash.xxh64_intdigest(" ".join(names).encode("utf-8", "surrogatepass")) >> 2)] = 1
    return found


def style_features(pages: DataFrame, names: frozenset[str] = NO_ARTICLE_WORDS) -> DataFrame:
    """path, feature and weight of every page's nodes; a page that its host has n times weighs 1 / n."""
    rows = pages.select(host(F.coalesce("url", F.lit(""))).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("_h", F.xxhash64("host", "html"))
    # Written, so that Spark knows its size and broadcasts it only where it is small.
    copies = written(rows.groupBy("_h").agg(F.count("*").alias("_n")).where("_n > 1"))
    weighed = rows.join(copies, "_h", "left").select("host", "html", (1 / F.coalesce("_n", F.lit(1))).alias("weight"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers: dict[bytes, int] = {}
            at, features, weights = [], [], []

            def out() -> pa.RecordBatch:
                paths = pa.array(list(numbers), pa.binary()).take(pa.array(at, pa.int32()))
                return pa.RecordBatch.from_arrays([paths, pa.array(features, pa.int64()), pa.array(weights, pa.float64())], ["path", "feature", "weight"])

            for site, markup, weight in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "weight"))):
                for path, own in page_features(Page(markup, site, names, kept=None)).items():
                    at.extend([numbers.setdefault(path, len(numbers))] * len(own))
                    features.extend(own)
                    weights.extend([weight * n for n in own.values()])
                if len(at) >= HELD:
                    yield out()
                    numbers, at, features, weights = {}, [], [], []
            yield out()

    return weighed.mapInArrow(read, "path binary, feature long, weight double")


def _prefixes(path: str = "path") -> Column:
    """The node itself and all above it."""
    return F.transform(F.sequence(F.lit(8), F.length(path), F.lit(8)), lambda k: F.substring(F.col(path), F.lit(1), k))


def measures(features: DataFrame) -> DataFrame:
    """site, path, pages, content, whole, mass, size, linked and variety of every node with text below it."""
    counts = features.groupBy("path", "feature").agg(F.round(F.sum("weight"), 6).alias("c"))
    f, clog = F.col("feature"), F.col("c") * F.log("c")
    word, sequence, text = (f >= 0) & (f < WHOLE), f < SEEN, (f >= WHOLE) & (f < SIZE)
    one = lambda feature: F.max(F.when(f == feature, F.col("c")))
    nodes = counts.groupBy("path").agg(
        one(SEEN).alias("pages"), one(SIZE).alias("size"), one(LINKED).alias("linked"), F.count_if(word).alias("n"), F.sum(F.when(word, F.log("c"))).alias("logs"),
        F.sum(F.when(word, F.col("c"))).alias("total"), F.sum(F.when(word, clog)).alias("clogs"),
        F.sum(F.when(text, F.col("c"))).alias("texts"), F.sum(F.when(text, clog)).alias("text_clogs"),
        F.sum(F.when(sequence, F.col("c"))).alias("shapes"), F.sum(F.when(sequence, clog)).alias("shape_clogs"),
    )
    nodes = lasting(nodes)
    m = F.log("pages")
    known = F.when(F.col("pages") > 1, F.col("n") - F.col("logs") / m).otherwise(F.col("n"))
    information = F.when(F.col("pages") > 1, F.col("total") - F.col("clogs") / m).otherwise(F.col("total"))
    leaves = nodes.where("n > 0").select(F.explode(_prefixes()).alias("path"), "pages", "n", "size", "linked", known.alias("known"), information.alias("information"))
    below = leaves.groupBy("path").agg(F.max("pages").alias("pages"), (F.sum("known") / F.sum("n")).alias("content"), F.sum("information").alias("information"), F.sum("size").alias("words"), F.sum("linked").alias("linked"))
    own = nodes.where("shapes > 0 or texts > 0").select("path", F.exp(F.log("shapes") - F.col("shape_clogs") / F.col("shapes")).alias("variety"), F.when(F.col("texts") > 1, 1 - F.col("text_clogs") / F.col("texts") / F.log("texts")).otherwise(1.0).alias("whole"))
    below = lasting(below.join(own, "path", "left").withColumn("site", F.substring("path", 1, 8)))
    sites = below.where(F.length("path") == 8).select("site", F.col("information").alias("all"))
    tree = below.join(sites, "site")
    return tree.select(
        "site", "path", "pages", "content", F.coalesce("whole", F.lit(1.0)).alias("whole"), (F.col("information") / F.greatest("all", F.lit(1e-9))).alias("mass"),
        (F.col("words") / F.greatest("pages", F.lit(1.0))).alias("size"), (F.col("linked") / F.greatest("words", F.lit(1.0))).alias("linked"), F.coalesce("variety", F.lit(0.0)).alias("variety"),
    )


def importance(features: DataFrame) -> DataFrame:
    """measures, and importance of every node."""
    tree = lasting(measures(features))
    kind = F.substring("path", F.length("path") - 7, F.lit(1))
    is_ = lambda *kinds: kind.isin([F.lit(k) for k in kinds])
    # Containers, the nodes in them, and the nodes above them.
    most = tree.where((F.col("mass") >= MOST) & (F.col("variety") >= VARIED)).groupBy("site").agg(F.min_by("path", F.length("path")).alias("path")).select("path")
    first = tree.where(is_(FIRST) & (F.col("content") >= 0.5) & (F.length("path") > 16)).select(F.substring(F.col("path"), F.lit(1), F.length("path") - 8).alias("path"))
    made = tree.where(is_(ARTICLE)).select("path")
    containers = lasting(most.unionByName(first).unionByName(made).distinct())
    headed = first.distinct().withColumn("_headed", F.lit(True))
    within = tree.select("path", F.explode(_prefixes()).alias("_c")).join(containers.withColumnRenamed("path", "_c"), "_c", "left_semi").select("path").distinct().withColumn("_in", F.lit(True))
    above = containers.select(F.explode(_prefixes()).alias("path")).distinct().withColumn("_above", F.lit(True))
    # What the like branch is on all hosts.
    pool = tree.groupBy(F.substring(F.col("path"), F.lit(9), F.length("path")).alias("_s")).agg(F.sum("pages").alias("_n"), F.sum(F.col("pages") * F.col("mass")).alias("_mass"), F.sum(F.col("pages") * F.col("size")).alias("_size"))
    pool = lasting(pool)
    tree = tree.withColumn("_s", F.substring(F.col("path"), F.lit(9), F.length("path"))).join(pool, "_s")
    tree = tree.join(within, "path", "left").join(above, "path", "left").join(headed, "path", "left")
    drawn = lambda own, all_: (F.col("pages") * F.col(own) + DRAWN * F.col(all_) / F.col("_n")) / (F.col("pages") + DRAWN)
    room = F.greatest(drawn("mass", "_mass") / SHARE, drawn("size", "_size") / LONG)
    room = F.pow(F.least(F.lit(1.0), room), 1 - 1 / F.greatest("_n", F.lit(1.0)))
    differs = F.greatest("content", "whole")
    inside = F.when(F.col("linked") >= LIST, F.col("content")).when(is_(HEADING, FIRST, PART), 1.0).otherwise(differs)
    judged = F.when(F.col("_in"), inside).when(is_(HEADING, FIRST), F.col("content")).otherwise(F.col("content") * room)
    most_here = (F.col("mass") > MOST) & ((drawn("mass", "_mass") > MOST) | (F.col("size") >= LONG))
    stays = most_here | (F.coalesce("_headed", F.lit(False)) & (F.col("size") >= LONG))
    share = F.when(is_(HINT), HINTED).when(is_(NAMED) & ~stays, NAMED_AS).otherwise(1.0)
    judged = F.when(F.coalesce("_above", F.lit(False)), F.greatest(judged, F.lit(1.0))).otherwise(judged) * share
    return tree.select("site", "path", "pages", "content", "whole", "mass", "size", "linked", "variety", judged.alias("importance"))


def judged_nodes(pages: DataFrame, names: frozenset[str] = NO_ARTICLE_WORDS) -> DataFrame:
    """site, and the lists of nodes that are removed from its pages and of named nodes that stay."""
    tree = importance(style_features(pages.select("url", "html"), names)).where(F.length("path") > 8)
    low = F.col("importance") < LOW
    named = F.substring("path", F.length("path") - 7, F.lit(1)) == F.lit(NAMED)
    return tree.where(low | named).groupBy("site").agg(F.collect_list(F.when(low, F.col("path"))).alias("removed"), F.collect_list(F.when(~low & named, F.col("path"))).alias("kept"))


def _texts(batch: pa.RecordBatch, names: frozenset[str], lists) -> Iterator[str]:
    """lists: host -> (removed, kept)."""
    for site, markup in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
        yield Page(markup or "", site, names, *lists(site)).text()


def extract(pages: DataFrame, names: frozenset[str] = NO_ARTICLE_WORDS) -> DataFrame:
    """page_id, url, text, n_chars of every page. A task gets a host's lists once: with few nodes in all, a checked
    number, they go to every executor; else each host's list goes before its pages in one ordered
    stream, and hosts with very many pages are dealt to as many tasks as they have HOT-ths of all pages."""
    rows = pages.select("page_id", "url", "html", host(F.coalesce("url", F.lit(""))).alias("host"))
    sites = rows.select("host").distinct().withColumn("site", _site("host"))
    lists = written(sites.join(judged_nodes(pages, names), "site").select("host", "removed", "kept"))
    nodes = lists.agg(F.coalesce(F.sum(F.size("removed") + F.size("kept")), F.lit(0))).first()[0]
    kind = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string"
    if nodes <= NODES:
        held = rows.sparkSession.sparkContext.broadcast({r["host"]: (frozenset(map(bytes, r["removed"])), frozenset(map(bytes, r["kept"]))) for r in lists.collect()})

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = pa.array(_texts(batch, names, lambda site: held.value.get(site, ((), ()))), pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), texts], ["page_id", "url", "text"])

        out = rows.mapInArrow(read, kind)
    else:
        out = _dealt(rows, lists).mapInArrow(lambda batches: _streamed(batches, names), kind)
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def _dealt(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """Lists and pages in one order: by host, and the list first."""
    sizes = rows.groupBy("host").count()
    total = sizes.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    # At most HOT hosts have so many pages.
    hot = sizes.where(F.col("count") * HOT >= total).select("host", F.ceil(F.col("count") * HOT / max(1, total)).cast("int").alias("_salts"))
    hot = F.broadcast(hot)
    one = F.coalesce("_salts", F.lit(1))
    own = rows.join(hot, "host", "left").withColumn("_salt", F.pmod(F.xxhash64("page_id", "url", "html"), one).cast("int"))
    each = lists.join(hot, "host", "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), one - 1)))
    both = own.select("page_id", "url", "html", "host", "_salt", F.lit(True).alias("page")).unionByName(each.select("host", "_salt", "removed", "kept", F.lit(False).alias("page")), allowMissingColumns=True)
    return both.repartition("host", "_salt").sortWithinPartitions("host", "_salt", "page").drop("_salt")


def _streamed(batches: Iterator[pa.RecordBatch], names: frozenset[str]) -> Iterator[pa.RecordBatch]:
    site, own = None, ((), ())
    for batch in batches:
        texts, at = [], []
        for i, (page, name) in enumerate(zip(batch.column("page").to_pylist(), batch.column("host").to_pylist())):
            if not page:
                site, own = name, tuple(frozenset(batch.column(c)[i].as_py()) for c in ("removed", "kept"))
                continue
            at.append(i)
            texts.append(Page(batch.column("html")[i].as_py() or "", name, names, *(own if name == site else ((), ()))).text())
        rows = batch.take(pa.array(at, pa.int32()))
        yield pa.RecordBatch.from_arrays([rows.column("page_id"), rows.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def _site(name: str) -> Column:
    @F.pandas_udf("binary")
    def made(hosts: pd.Series) -> pd.Series:
        return pd.Series([step(h) for h in hosts], dtype=object)

    return made(F.col(name))
