"""Main text of web pages by wrapper induction.

Pages of one host and layout share a wrapper.  Each page becomes a tree of its block
elements with their pieces of text as leaves.  One page per host and layout is the
reference; every other one is aligned with it by simple tree matching, which pairs as many
nodes as possible while keeping their order and their parents paired.  A leaf whose text is
the same on most aligned pages is part of the template, one whose text varies is a slot with
content.  A page that differs from the reference in hardly any of its text is a copy of its
article and tells nothing about the wrapper, so it is not counted.

Which slots are content at all is read from the mark-up: menus, headers, footers,
sidebars, notices, adverts, forms, comments and their like are dropped by element, role
and class; if a page has an article, its slots are the content.  An article inside a
wrapper that looks like boilerplate is content all the same, unless the wrapper holds
comments or teasers; an article inside an article is a reader's comment, and one of less
than a third of the longest article's text beside it is a teaser.

Only block trees (tags and text hashes) and texts of candidate slots are shuffled, to meet
one row per host; a host of many pages is dealt to as many tasks as it needs for that.

Defined results
* null html counts as empty; a page without content has an empty text, not null.
* a null url, or one without a host, belongs to the host of empty name.
* repeated rows each appear; a broken end of a page is read as far as it goes.
* depth and width of a tree do not change how it is matched.  Nothing is recursive; lists of n
  and m children take n * m steps, but no more memory than about m * sqrt(n) numbers.
* an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Generator, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import SLICE_ROWS, longs, map_slices, stored, strings
from rillhouse.llm.url_filter import host_of

#: Aligned pages needed to call a leaf constant, and the share that must agree.
EVIDENCE, AGREEMENT = 3, 0.8
#: A page with less than this share of its text unlike the reference's is a copy of it.
COPY_SHARE = 0.05
#: Pages of one host that a task takes; there are at most as many larger hosts as the number
#: of pages divided by this.
HOST_PAGES = 20_000
#: Scores of pairs of shapes that are remembered; forgotten ones are computed again.
REMEMBERED = 1 << 18
#: Numbers that are held at least, when two lists are aligned.
HELD = 1 << 16
#: Tags from the root that make a layout.
LAYOUT_DEPTH = 4
#: An article with less than this share of the longest one's text is a teaser.
TEASER = 1 / 3

# Kinds of elements.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title template iframe svg select object canvas annotation".split())
DROPPED = frozenset("head nav aside footer form dialog menu button figure-menu".split())
CONTENT = frozenset(["article", "main"])
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu "
                  "menubar toolbar".split())
# words of classes and ids: those that tell by themselves, those that tell only beside words
# of their kind, such words, and words that turn a class into a description of the layout
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner sidebar "
    "menu menubar nav navbar navigation breadcrumb breadcrumbs footer comment comments replies "
    "respond disqus cookie cookies consent gdpr popup modal overlay newsletter signup login toolbar "
    "pagination pager teaser teasers".split())
WEAK_HINTS = frozenset(
    "promotion reply notice notices subscribe subscription share sharing social related recommended "
    "recommendations widget toc skip hidden".split())
COMPANIONS = frozenset(
    "area articles bar block box buttons col column container content form group header icons inner item "
    "items left link links list main media page panel post posts primary right row secondary section site "
    "stories text to top wrap wrapper".split())
LAYOUT = frozenset("has with no without layout free open active enabled collapsed".split())
# wrappers of these kinds hold no article of the page's own
FOREIGN = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo comment comments reply "
    "replies respond disqus related recommended recommendations teaser teasers widget popup modal "
    "overlay".split())
FOREIGN_TAGS = frozenset("nav aside footer dialog menu button".split())
CLOSES_P = BLOCKS - {"head", "html", "body", "title"}
IMPLIED = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
           "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table td th article section div body html main blockquote".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_SPLIT = re.compile(r"[^a-z0-9]+")


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or "").strip("\"'").lower() for m in _ATTRIBUTE.finditer(text)}


def _hint(token: str) -> str | None:
    """The word that makes a class or id a sign of boilerplate."""
    words = [w for w in _SPLIT.split(token) if w]
    if LAYOUT.intersection(words):
        return None
    for word in words:
        if word in HINTS and (word in (words[0], words[-1])):
            return word
    if all(w in WEAK_HINTS or w in COMPANIONS or w in HINTS or w.isdigit() for w in words):
        return next((w for w in words if w in WEAK_HINTS), None)
    return None


def _kind(tag: str, attributes: str, in_content: bool) -> tuple[bool, bool, bool]:
    """(boilerplate, foreign, content) of an element: whether its text is dropped, whether an
    article inside would not be the page's own, and whether it holds the content."""
    dropped = tag in DROPPED or (tag == "header" and not in_content)
    foreign, content = tag in FOREIGN_TAGS, tag in CONTENT
    if not attributes.strip():
        return dropped, foreign, content
    found = _attributes(attributes)
    content = content or found.get("role") == "main" or "articlebody" in found.get("itemprop", "")
    gone = ("hidden" in found or found.get("aria-hidden") == "true"
            or re.search(r"display\s*:\s*none", found.get("style", "")) is not None)
    dropped, foreign = dropped or gone or found.get("role") in ROLES, foreign or gone
    if tag in ("html", "body"):
        return dropped, foreign, content
    # inside the content an id is a place to link to, not a kind of box
    for name in ("class",) if in_content else ("class", "id"):
        for hint in filter(None, map(_hint, found.get(name, "").split())):
            dropped, foreign = True, foreign or hint in FOREIGN
    return dropped, foreign, content


class Leaf:
    """A piece of text: its place (``_below`` of its parents' tags), the upper ones of these tags,
    whether it is boilerplate, and where it belongs: 0 to no content, 1 to the main part, from 2
    on to an article by its number."""

    __slots__ = ("place", "upper", "text", "dropped", "content")

    def __init__(self, place: int, upper: str, text: str, dropped: bool, content: int):
        self.place, self.upper, self.text, self.dropped, self.content = place, upper, text, dropped, content


def _below(place: int, tag: str) -> int:
    """Place of a child: the checksum of the path of tags, one tag longer."""
    return zlib.crc32(f"/{tag}".encode(), place)


def parse(page: str) -> tuple[list, list[Leaf]]:
    """(tree, leaves): nodes are [tag, children], leaves stand in the tree by number."""
    root: list = ["#", []]
    stack = [("#", root, False, 0, (0, "", 0), False)]  # tag, node, dropped, content, path, foreign
    leaves: list[Leaf] = []
    buffer: list[str] = []
    open_tags: Counter[str] = Counter()
    articles = 1

    def flush() -> None:
        text = " ".join("".join(buffer).split())
        buffer.clear()
        if text:
            _, node, dropped, content, (place, upper, _), _ = stack[-1]
            node[1].append(len(leaves))
            leaves.append(Leaf(place, upper, text, dropped, content))

    def pop_to(at: int) -> None:
        flush()
        open_tags.subtract(x[0] for x in stack[at:])
        del stack[at:]

    at, n = 0, len(page)
    while at < n:
        found = _TOKEN.search(page, at)
        if not found:
            buffer.append(html.unescape(page[at:]))
            break
        if found.start() > at:
            buffer.append(html.unescape(page[at:found.start()]))
        at = found.end()
        if found[2] is None:
            continue
        closing, tag, attributes = found[1] == "/", found[2].lower(), found[3]
        if not closing and (tag in RAW or (tag == "noscript" and not stack[-1][3])):
            if not attributes.endswith("/") or tag != "svg":
                end = re.compile(f"</{tag}[^>]*(?:>|\\Z)", re.I).search(page, at)
                at = end.end() if end else n
            if tag in BLOCKS:
                flush()
            continue
        if tag == "br":
            buffer.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if closing:
            for i in () if not open_tags[tag] else range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    pop_to(i)
                    break
                if stack[i][0] in BLOCKS and (tag not in BLOCKS or (tag in ("p", "li") and stack[i][0] in SCOPES)):
                    break
            continue
        closes = IMPLIED.get(tag, ()) + (("p",) if tag in CLOSES_P else ())
        for i in range(len(stack) - 1, 0, -1) if closes else ():
            if stack[i][0] in closes:
                pop_to(i)
                break
            if stack[i][0] in SCOPES and stack[i][0] not in closes:
                break
        _, node, dropped, content, path, foreign = stack[-1]
        boilerplate, alien, own = _kind(tag, attributes, content > 0)
        hidden = dropped or boilerplate
        if tag == "article" and content > 1:
            hidden, alien = True, True  # a reader's comment
        elif own and not foreign and not alien:
            if not content:
                hidden = False  # whatever wraps it
            if tag == "article":
                articles += 1
            content = articles if tag == "article" else max(content, 1)
        open_tags[tag] += 1
        if tag in BLOCKS or hidden != dropped:
            flush()
            child = [tag, []]
            node[1].append(child)
            place, upper, depth = path
            path = _below(place, tag), f"{upper}/{tag}" if depth < LAYOUT_DEPTH else upper, depth + 1
            stack.append((tag, child, hidden, content, path, foreign or alien))
        else:
            stack.append((tag, node, dropped, content, path, foreign or alien))
    flush()
    return root, leaves


# ------------------------------------------------------------------ simple tree matching

class _Shapes:
    """Trees without their texts, equal ones under one number."""

    def __init__(self):
        self.numbers: dict[tuple, int] = {}
        self.tags: list[str | None] = []
        self.parts: list[tuple] = []
        self.sizes: list[int] = []
        self.scores: dict[tuple[int, int], int] = {}

    def _number(self, tag: str | None, parts: tuple) -> int:
        number = self.numbers.get((tag, parts))
        if number is None:
            number = self.numbers[tag, parts] = len(self.tags)
            self.tags.append(tag)
            self.parts.append(parts)
            self.sizes.append(1 + sum([self.sizes[c] for c in parts]))
        return number

    def of(self, node, seen: dict[int, int]) -> int:
        leaf = self._number(None, ())
        if isinstance(node, int):
            return leaf
        open_ = [node]
        while open_:
            now = open_[-1]
            below = [] if id(now) in seen else [c for c in now[1] if not isinstance(c, int) and id(c) not in seen]
            if below:
                open_ += below
                continue
            open_.pop()
            if id(now) not in seen:
                seen[id(now)] = self._number(
                    now[0], tuple([leaf if isinstance(c, int) else seen[id(c)] for c in now[1]]))
        return seen[id(node)]

    def _known(self, x: int, y: int) -> int | None:
        if x == y:
            return self.sizes[x]
        if self.tags[x] is None or self.tags[x] != self.tags[y]:
            return 0
        return self.scores.get((x, y))

    def score(self, x: int, y: int) -> int:
        """Nodes paired by a maximum matching of two shapes."""
        found = self._known(x, y)
        return self._worked(self._scored(x, y)) if found is None else found

    def _worked(self, work: Generator):
        """The result of ``work``, which asks for the scores of pairs."""
        open_, given = [work], None
        while open_:
            try:
                pair = open_[-1].send(given)
            except StopIteration as done:
                given = done.value
                open_.pop()
            else:
                given = None
                open_.append(self._scored(*pair))
        return given

    def _scored(self, x: int, y: int) -> Generator:
        head, tail = self.ends(self.parts[x], self.parts[y])
        xs, ys = (p[head:len(p) - tail] for p in (self.parts[x], self.parts[y]))
        found = 1 + sum([self.sizes[c] for c in self.parts[x]]) - sum([self.sizes[c] for c in xs])
        if xs and ys:
            rows = yield from self._rows(xs, ys, None, len(xs))
            found += int(rows[-1][-1])
        if len(self.scores) >= REMEMBERED:
            self.scores.clear()
        self.scores[x, y] = found
        return found

    @staticmethod
    def ends(xs: tuple, ys: tuple) -> tuple[int, int]:
        """How many children are equal from the start, and from the end."""
        most, head, tail = min(len(xs), len(ys)), 0, 0
        while head < most and xs[head] == ys[head]:
            head += 1
        while tail < most - head and xs[-1 - tail] == ys[-1 - tail]:
            tail += 1
        return head, tail

    def _rows(self, xs: tuple, ys: tuple, best: np.ndarray | None, keep: int) -> Generator:
        """Best scores of the first children of both lists: a row for ``best`` (none: zeros) and
        one after each ``keep``-th of ``xs``, up to the last one.  Place j of a row is for the
        first j of ``ys``."""
        kinds: dict[int, int] = {}
        where = np.array([kinds.setdefault(y, len(kinds)) for y in ys])
        best = np.zeros(len(ys) + 1, np.int64) if best is None else best
        rows = [best]
        for i, x in enumerate(xs, 1):
            row = []
            for y in kinds:
                known = self._known(x, y)
                row.append((yield x, y) if known is None else known)
            if any(row):
                now = np.zeros_like(best)
                np.maximum(best[1:], best[:-1] + np.array(row)[where], out=now[1:])
                best = np.maximum.accumulate(now)
            if i % keep == 0 or i == len(xs):
                rows.append(best)
        return rows

    def aligned(self, xs: tuple, ys: tuple) -> list[tuple[int, int]]:
        """Places of the children that a maximum matching of two lists pairs, last ones first.
        One row in ``step`` is kept; those between are made on the way back."""
        step = max(isqrt(len(xs)), HELD // len(ys)) + 1
        blocks = range(0, len(xs), step)
        kept = self._worked(self._rows(xs[:blocks[-1]], ys, None, step))
        pairs, j = [], len(ys)
        for low in reversed(blocks):
            rows = self._worked(self._rows(xs[low:low + step], ys, kept[low // step], 1))
            i = len(rows) - 1
            while i and j:
                now = rows[i][j]
                if now == rows[i][j - 1]:
                    j -= 1
                elif now == rows[i - 1][j]:
                    i -= 1
                else:
                    i, j = i - 1, j - 1
                    pairs.append((low + i, j))
        return pairs


def match(a: list, b: list) -> list[tuple[int, int]]:
    """Pairs of leaves (number in a, number in b) of a maximum top-down matching."""
    shapes = _Shapes()
    of_a: dict[int, int] = {}
    of_b: dict[int, int] = {}
    shapes.of(a, of_a)
    shapes.of(b, of_b)
    pairs, open_ = [], [(a, b)]
    while open_:
        x, y = open_.pop()
        if isinstance(x, int):
            if isinstance(y, int):
                pairs.append((x, y))
            continue
        if isinstance(y, int) or x[0] != y[0]:
            continue
        xs = tuple([shapes.of(c, of_a) for c in x[1]])
        ys = tuple([shapes.of(c, of_b) for c in y[1]])
        head, tail = shapes.ends(xs, ys)
        open_ += zip(x[1][:head], y[1][:head])
        open_ += zip(x[1][len(xs) - tail:], y[1][len(ys) - tail:])
        inner_x, inner_y = xs[head:len(xs) - tail], ys[head:len(ys) - tail]
        if not inner_x or not inner_y:
            continue
        open_ += [(x[1][head + i], y[1][head + j]) for i, j in shapes.aligned(inner_x, inner_y)]
    return sorted(pairs)


# ------------------------------------------------------------------ block trees as text

def _print_of(leaf: Leaf) -> int:
    return 0 if leaf.dropped else zlib.crc32(leaf.text.encode()) | 1


def skeleton(page: str) -> tuple[str, int]:
    """Block tree as text, and its layout.  The text has tags, brackets, and for each leaf the
    number of its text (0: dropped) and its length; the layout is a hash of the upper paths."""
    root, leaves = parse(page)
    out: list[str] = []
    open_: list = [root]
    while open_:
        node = open_.pop()
        if node is None:
            out.append(")")
        elif isinstance(node, int):
            out.append(f"{_print_of(leaves[node])}:{len(leaves[node].text)}")
        else:
            out.append(f"({node[0]}")
            open_.append(None)
            open_ += reversed(node[1])
    upper = {x.upper for x in leaves}
    return " ".join(out), zlib.crc32("|".join(sorted(upper)).encode())


def _read(text: str) -> tuple[list, list[tuple[int, int, int]]]:
    """(tree, leaves as (place, number, length)) of a skeleton."""
    top: list = ["", []]
    stack, places, leaves = [top], [0], []
    for token in text.split():
        if token[0] == "(":
            node = [token[1:], []]
            stack[-1][1].append(node)
            stack.append(node)
            places.append(0 if len(stack) == 2 else _below(places[-1], token[1:]))
        elif token == ")":
            stack.pop()
            places.pop()
        else:
            number, length = token.split(":")
            stack[-1][1].append(len(leaves))
            leaves.append((places[-1], int(number), int(length)))
    return top[1][0], leaves


def _slot(place: int, number: int) -> int:
    """Key of a leaf: where it stands and what it says."""
    return place << 31 | number >> 1


# ------------------------------------------------------------------ Spark side

def _trees(pages: DataFrame) -> DataFrame:
    def make():
        def work(ids, hosts, texts):
            found = [skeleton(t) for t in texts]
            return longs(ids), strings(hosts), strings([t for t, _ in found]), longs([n for _, n in found])
        return work

    return map_slices(pages.select("page_id", "host", "html"), make,
                      "page_id bigint, host string, tree string, layout bigint")


def _votes(pairs: DataFrame) -> DataFrame:
    """(host, slot, pages, equal) of the aligned pages, added up batch by batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple = ("", None, None)
        for batch in batches:
            votes: dict[tuple, list[int]] = defaultdict(lambda: [0, 0])
            for host, tree, other in zip(*(c.to_pylist() for c in batch.columns)):
                if known[0] != other:
                    known = (other, *_read(other))
                _, ref_root, ref_leaves = known
                root, leaves = _read(tree)
                aligned = [(ref_leaves[i], leaves[j]) for i, j in match(ref_root, root)]
                aligned = [(x, y) for x, y in aligned if x[1] and y[1]]
                total = sum(n for _, number, n in leaves if number)
                same = sum(y[2] for x, y in aligned if x[:2] == y[:2])
                if total - same < COPY_SHARE * total or not aligned:
                    continue
                for x, y in aligned:
                    vote = votes[host, _slot(*x[:2])]
                    vote[0] += 1
                    vote[1] += x[:2] == y[:2]
            rows = list(votes.items())
            yield pa.RecordBatch.from_arrays(
                [strings([k[0] for k, _ in rows]), longs([k[1] for k, _ in rows]),
                 longs([v[0] for _, v in rows]), longs([v[1] for _, v in rows])],
                names=["host", "slot", "pages", "equal"])

    return pairs.mapInArrow(run, "host string, slot bigint, pages bigint, equal bigint")


def _with_host(rows: DataFrame, of_host: DataFrame, on: list[str], large: DataFrame, how: str) -> DataFrame:
    """Join pages with rows of their host.  The pages of a large host are dealt to several
    tasks, each of which gets that host's rows."""
    parts = F.coalesce("parts", F.lit(1))
    salt = F.pmod(F.xxhash64("page_id", F.col(rows.columns[-1])), parts)
    salted = rows.join(F.broadcast(large), "host", "left").withColumn("salt", salt).drop("parts")
    copies = (of_host.join(F.broadcast(large), "host", "left")
              .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), (parts - 1).cast("bigint")))).drop("parts"))
    return salted.join(copies, [*on, "salt"], how)


def large_hosts(pages: DataFrame) -> DataFrame:
    """(host, parts) of the hosts with more than ``HOST_PAGES`` pages: a small share of all
    pages' number at most, so the frame is fit to be broadcast."""
    counted = pages.groupBy("host").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOST_PAGES)
    return stored(counted.select("host", F.ceil(F.col("n") / HOST_PAGES).cast("int").alias("parts")), "large-hosts")


def wrappers(pages: DataFrame, large: DataFrame) -> DataFrame:
    """(host, template): the slots of each host whose text is constant."""
    trees = _trees(pages)
    reference = trees.groupBy("host", "layout").agg(
        F.min(F.struct(F.col("page_id").isNull(), "page_id", "tree")).alias("first"))
    reference = reference.select("host", "layout", F.col("first.tree").alias("other"))
    rows = trees.select("page_id", "host", "layout", "tree")
    pairs = _with_host(rows, reference, ["host", "layout"], large, "inner").filter("tree <> other")
    votes = _votes(pairs.select("host", "tree", "other")).groupBy("host", "slot").agg(
        F.sum("pages").alias("pages"), F.sum("equal").alias("equal"))
    constant = votes.filter((F.col("pages") >= EVIDENCE) & (F.col("equal") >= AGREEMENT * F.col("pages")))
    return constant.groupBy("host").agg(F.collect_list("slot").alias("template"))


def content_leaves(page: str) -> list[Leaf]:
    """The leaves that may be content, by mark-up alone."""
    leaves = [x for x in parse(page)[1] if not x.dropped]
    if not any(x.content for x in leaves):
        return leaves
    sizes: Counter[int] = Counter()
    for x in leaves:
        sizes[x.content] += len(x.text)
    longest = max((n for number, n in sizes.items() if number > 1), default=0)
    return [x for x in leaves if x.content == 1 or (x.content > 1 and sizes[x.content] >= TEASER * longest)]


def _slots(pages: DataFrame) -> DataFrame:
    """Texts and keys of the content slots of every page."""
    schema = "page_id bigint, url string, host string, texts array<string>, slots array<bigint>"
    names = ["page_id", "url", "host", "texts", "slots"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                texts, slots = [], []
                for page in part.column("html").to_pylist():
                    leaves = content_leaves(page)
                    texts.append([x.text for x in leaves])
                    slots.append([_slot(x.place, _print_of(x)) for x in leaves])
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), part.column("host"),
                     pa.array(texts, pa.list_(pa.string())), pa.array(slots, pa.list_(pa.int64()))],
                    names=names)

    return pages.select("page_id", "url", "host", "html").mapInArrow(run, schema)


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url",
                        host_of(F.col("url")).alias("host"),
                        F.coalesce("html", F.lit("")).alias("html"))
    large = large_hosts(rows)
    found = _with_host(_slots(rows), wrappers(rows, large), ["host"], large, "left")
    varying = F.filter(F.arrays_zip("texts", "slots"), lambda x: ~F.array_contains(
        F.coalesce("template", F.array().cast("array<bigint>")), x["slots"]))
    text = F.array_join(F.transform(varying, lambda x: x["texts"]), "\n")
    return found.select("page_id", "url", text.alias("text")).select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
