"""Main text of web pages by wrapper induction: what stays the same on the pages of a host is template.

Pages are parsed to trees of all their visible blocks.  Trees of a host with the same sections are a cluster, and one of
its smaller trees is its wrapper, as a template is on every page.  Every page is aligned with it by simple tree
matching: of two nodes with the same name the best pairing of their children that keeps order.  A block of the wrapper
whose text is the same on nearly all different pages of the cluster is template, and goes from every page where it is
aligned with the same text.  Other slots vary and are content, but for those that name themselves as menus, adverts, forms
and the like, and for links beside an article that has most of the text.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioledger.llm.tables import land, read, ship

#: A block is template if it is the same on this share of a host's different pages, of which there must be so many.
SAME_SHARE, LEAST_PAGES = 0.8, 3
#: The wrapper is the smallest tree of a host above this share of its trees, so not that of an odd page.
ABOVE_SHARE = 0.25
#: Trees with the same sections down to a depth are a cluster if so many different pages have them; pages of smaller ones are
#: aligned with the largest cluster of their host, or all together if it has none.
SECTIONS_DEPTH, CLUSTER_PAGES = 4, 5
#: Elements deeper than this don't part the tree any further; what they say of their blocks counts at any depth.
MOST_DEPTH = 100
#: Two lists of children with no more pairs than this are aligned by a table of all pairs, longer ones in linear space.
TABLE_PAIRS = 10_000

_words = lambda names: frozenset(names.split())
BLOCKS = _words(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol optgroup option p pre search section summary table caption tbody td tfoot th thead tr ul"
)
VOID = _words("area base br col embed hr img input link meta param source track wbr")
SECTIONS = _words("article aside body center div footer form header html main nav section")
#: Parts that show no text, and hints that a varying part is no content: by tag, by role and by a word of class or id.
UNSEEN_TAGS = _words("audio button canvas head iframe input noscript object script select style svg template textarea video")
SKIPPED_TAGS = _words("aside dialog footer menu nav")
SKIPPED_ROLES = _words("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search")
SKIPPED_NAMES = _words(
    "ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer gdpr masthead menu modal nav navbar navigation newsletter notice popup promo promotion related reply replies respond "
    "share sharing sidebar signup social sponsor sponsored subscribe toolbar widget"
)
#: Words that may stand beside those in a class or id; any other word makes it the name of something else, such as has-sidebar.
NAME_PARTS = _words("area bar bottom box center left links list main primary right secondary section site top")
#: What a new block of a kind ends if it is still open, and within which blocks that is looked for.
CLOSES = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
SCOPES = _words("ul ol dl table menu body html article main section div")


class Block(NamedTuple):
    path: tuple  # name and number of every element around it, down to ``MOST_DEPTH``
    marks: tuple  # numbers of the articles and of the skipped and so named elements around it, all of them
    text: str
    linked: bool  # more than half of it is links


class Page(HTMLParser):
    """Visible blocks of a page in order, each with the elements around it; numbers of articles, of skipped and of so named elements."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, str, bool, bool, int]] = []  # tag, name, unseen, in an article, number
        self.text: list[str] = []
        self.blocks: list[Block] = []
        self.articles: set[int] = set()
        self.skipped: set[int] = set()
        self.named: set[int] = set()
        self.marks: list[tuple[int, int]] = []  # place among the open elements, and number
        self.count = self.linked = 0
        self.link = -1  # number of open elements around the open link
        self.feed(html)
        self.close()
        self._flush()

    def _flush(self) -> None:
        text = " ".join("".join(self.text).split())
        self.text, linked, self.linked = [], self.linked, 0
        if text and not (self.open and self.open[-1][2]):
            path = tuple((name, number) for _, name, _, _, number in self.open[:MOST_DEPTH])
            self.blocks.append(Block(path, tuple(number for _, number in self.marks), text, 2 * linked > len(text)))

    def _pop(self, at: int) -> None:
        self._flush()
        del self.open[at:]
        while self.marks and self.marks[-1][0] >= at:
            self.marks.pop()
        if self.link > at:
            self.link = -1

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br" or tag == "wbr":
            self.text.append(" " if tag == "br" else "")
        if tag in VOID and tag != "hr":
            return
        named = {k: v or "" for k, v in attrs}
        if tag == "a":
            self.link = len(self.open) if "href" in named else -1
        unseen = tag in UNSEEN_TAGS or "hidden" in named
        skipped, so_named = self._skipped(tag), self._named(tag, named)
        if tag not in BLOCKS and not so_named and not unseen:
            return
        if tag in BLOCKS:
            self._close_before(tag)
        self._flush()
        if tag == "hr":
            return
        above_unseen, above_article = self.open[-1][2:4] if self.open else (False, False)
        first = named.get("class", "").split()[:1]
        self.count += 1
        name = ".".join([tag, *first])
        article = tag in ("article", "main")
        if article or skipped or so_named:
            self.marks.append((len(self.open), self.count))
        self.open.append((tag, name, above_unseen or unseen, above_article or article, self.count))
        if article:
            self.articles.add(self.count)
        if skipped:
            self.skipped.add(self.count)
        if so_named:
            self.named.add(self.count)

    def _skipped(self, tag: str) -> bool:
        return tag in SKIPPED_TAGS or tag == "header" and not (self.open and self.open[-1][3])

    @staticmethod
    def _named(tag: str, named: dict[str, str]) -> bool:
        """Whether a part says by its role or by a whole class or id that it is no content, or is a form."""
        if tag in ("html", "body", "main", "article"):
            return False
        if tag == "form" or named.get("role", "").lower() in SKIPPED_ROLES:
            return True
        for token in f"{named.get('class', '')} {named.get('id', '')}".lower().split():
            parts = {part for part in re.split(r"[\W\d_]+", token) if part}
            if not parts.isdisjoint(SKIPPED_NAMES) and parts <= SKIPPED_NAMES | NAME_PARTS:
                return True
        return False

    def _close_before(self, tag: str) -> None:
        """Ends what a block may not be part of, such as a paragraph or the list item before."""
        ends = CLOSES.get(tag, "").split()
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == "p" or self.open[at][0] in ends:
                self._pop(at)
                return
            if self.open[at][0] in SCOPES:
                return

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.link = -1
        if tag == "p" and not any(o[0] == "p" for o in self.open):
            self._flush()
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self._pop(at)
                return

    def handle_data(self, data: str) -> None:
        if not (self.open and self.open[-1][2]):
            self.text.append(data)
            if self.link >= 0:
                self.linked += len(" ".join(data.split()))


def _article_at(block: Block, page: Page, sizes: Counter[int], most: int) -> int | None:
    """Where in the block's marks the article with the most text is."""
    return next((at for at, number in enumerate(block.marks) if number in page.articles and sizes[number] == most), None)


def hinted(page: Page) -> set[int]:
    """Numbers of the blocks that hints tell from content where they vary.

    These are blocks in skipped elements, and in those so named, unless these hold the article (the one with the most
    text) or most of the page's text.  Where articles have most of the other text, links beside them go as well, but no
    other text does: an article may be a teaser, or a part.
    """
    sizes: Counter[int] = Counter()
    for b in page.blocks:
        for number in b.marks:
            sizes[number] += len(b.text)
    most = max((sizes[number] for number in page.articles), default=0)
    held = {number for b in page.blocks if (at := _article_at(b, page, sizes, most)) is not None for number in b.marks[:at]}
    total = sum(len(b.text) for b in page.blocks)
    out = page.skipped | {number for number in page.named - held if 2 * sizes[number] <= total}
    gone = {i for i, b in enumerate(page.blocks) if not out.isdisjoint(b.marks)}
    rest = [(i, b, not page.articles.isdisjoint(b.marks)) for i, b in enumerate(page.blocks) if i not in gone]
    inside = sum(len(b.text) for _, b, article in rest if article)
    if 2 * inside > sum(len(b.text) for _, b, _ in rest):
        gone.update(i for i, b, article in rest if b.linked and not article)
    return gone


def main_blocks(html: str | None) -> list[tuple[tuple, str]]:
    """Blocks of a page without those that hints tell from content."""
    page = Page(html or "")
    gone = hinted(page)
    return [(b.path, b.text) for i, b in enumerate(page.blocks) if i not in gone]


def sections(blocks: list[tuple[tuple, str]]) -> str:
    """Digest of the nested sections that hold the blocks, however many there are of each."""
    found = set()
    for path, _ in blocks:
        names = [name for name, _ in path if name.split(".")[0] in SECTIONS][:SECTIONS_DEPTH]
        found.update(tuple(names[: i + 1]) for i in range(len(names)))
    return hashlib.md5(json.dumps(sorted(found)).encode()).hexdigest()[:16]


Node = tuple[str, int, str, list]  # name, number of the block or -1, digest of its text, children


def tree(blocks: list[tuple[tuple, str]]) -> Node:
    """The blocks below the elements around them."""
    root: Node = ("", -1, "", [])
    made = {(): root}
    for number, (path, text) in enumerate(blocks):
        above = root
        for i in range(len(path)):
            if path[: i + 1] not in made:
                made[path[: i + 1]] = (path[i][0], -1, "", [])
                above[3].append(made[path[: i + 1]])
            above = made[path[: i + 1]]
        above[3].append(("#", number, hashlib.md5(text.encode()).hexdigest()[:12], []))
    return root


def match(a: Node, b: Node) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching: the weight of the best alignment, and the numbers of aligned blocks with the same text.

    Nodes with different names don't match; a block with the same text weighs more than one with another.  Of
    alignments that weigh the same, long lists may have another than short ones.
    """
    if a[0] != b[0]:
        return 0, []
    if a[1] >= 0:
        return (3, [(a[1], b[1])]) if a[2] == b[2] else (1, [])
    left, right = a[3], b[3]
    if len(left) * len(right) > TABLE_PAIRS:
        weight, steps = _align_long(left, right)
        return weight + 1, [pair for i, j in steps for pair in match(left[i], right[j])[1]]
    best = [[(0, 0)] * (len(right) + 1) for _ in range(len(left) + 1)]  # weight, step
    found = {}
    for i, x in enumerate(left):
        row, above = best[i + 1], best[i]
        for j, y in enumerate(right):
            weight = found[i, j] = match(x, y) if x[0] == y[0] else (0, [])
            row[j + 1] = max((above[j + 1][0], 1), (row[j][0], 2), (above[j][0] + weight[0], 3))
    pairs, i, j = [], len(left), len(right)
    while i and j:
        step = best[i][j][1]
        if step == 3:
            pairs += found[i - 1, j - 1][1]
        i, j = i - (step != 2), j - (step != 1)
    return best[-1][-1][0] + 1, pairs


def _single(node: Node) -> tuple[tuple, str] | None:
    """Names down to the only block of a node, and the digest of its text; None if it holds several or none."""
    names = []
    while node[1] < 0:
        if len(node[3]) != 1:
            return None
        names.append(node[0])
        node = node[3][0]
    return (*names, node[0]), node[2]


def _common(x: tuple, y: tuple) -> int:
    return next((k for k, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))


def _align_long(left: list, right: list) -> tuple[int, list[tuple[int, int]]]:
    """The best pairing in order of two long lists of children: its weight, and the pairs that weigh anything.

    Halves of the left list are weighed against all ends of the right one, which tells where the right one parts (after
    Hirschberg), so memory is linear in the lists.  Children with one block each, as nearly all of long lists are, are
    weighed a row at a time; pairs of others are matched and their weights remembered, in four bytes a pair.
    """
    ones, others = [_single(x) for x in left], [_single(y) for y in right]
    shapes = sorted({one[0] for one in (*ones, *others) if one})
    numbers = {shape: i for i, shape in enumerate(shapes)}
    digests = {one[1]: i for i, one in enumerate(one for one in others if one)}
    shape = np.array([numbers[one[0]] if one else -1 for one in others], np.int32)
    digest = np.array([digests[one[1]] if one else -1 for one in others], np.int32)
    rest = np.flatnonzero(shape < 0)
    # A shape shared by no pair of lists costs a line of numbers each; lists have few shapes.
    depth = {x: np.array([_common(x, y) for y in shapes] or [0], np.int32) for x in {one[0] for one in ones if one}}
    kept: dict[int, np.ndarray] = {}

    def weights(i: int, start: int, stop: int) -> np.ndarray:
        one = ones[i]
        columns = rest if one else np.arange(len(right))
        if len(columns) and i not in kept:
            kept[i] = np.array([match(left[i], right[j])[0] for j in columns], np.int32)
        if not one:
            return kept[i][start:stop]
        row = depth[one[0]][shape[start:stop]]
        row[(digest[start:stop] == digests.get(one[1], -2)) & (shape[start:stop] == numbers[one[0]])] += 2
        if len(rest):
            first, end = np.searchsorted(rest, (start, stop))
            row[rest[first:end] - start] = kept[i][first:end]
        return row

    def last(rows: range, start: int, stop: int, step: int) -> np.ndarray:
        """Weights of the rows against every beginning of the right children from start to stop, or ending if step is -1."""
        line = np.zeros(stop - start + 1, np.int32)
        for i in rows:
            paired = line[:-1] + weights(i, start, stop)[::step]
            np.maximum.accumulate(np.maximum(line[1:], paired, out=paired), out=line[1:])
        return line

    total, pairs, todo = 0, [], [(0, len(left), 0, len(right))]
    while todo:
        top, bottom, start, stop = todo.pop()
        if top == bottom or start == stop:
            continue
        if bottom - top == 1:
            row = weights(top, start, stop)
            at = int(row.argmax())
            if row[at]:
                total += int(row[at])
                pairs.append((top, start + at))
            continue
        middle = (top + bottom) // 2
        upper, lower = last(range(top, middle), start, stop, 1), last(range(bottom - 1, middle - 1, -1), start, stop, -1)
        cut = start + int((upper + lower[::-1]).argmax())
        todo += [(middle, bottom, cut, stop), (top, middle, start, cut)]
    return total, pairs


def host_of(url: str | None) -> str:
    """The host in lower case without user and port; pages without one share the empty host."""
    found = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else ""


def _parsed(pages: DataFrame) -> DataFrame:
    """One row per page; written.

    Number, id, address, host, digests of its sections and of its blocks without the hinted ones, number of blocks, tree,
    and packed blocks with the numbers of the hinted ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            out = []
            for url, html in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                page = Page(html or "")
                gone = hinted(page)
                blocks = [(b.path, b.text) for b in page.blocks]
                main = [b for i, b in enumerate(blocks) if i not in gone]
                content = hashlib.md5(json.dumps([t for _, t in main]).encode()).digest()
                packed = packer.compress(json.dumps([[t for _, t in blocks], sorted(gone)]).encode())
                out.append((host_of(url), sections(main), content, len(blocks), json.dumps(tree(blocks)), packed))
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.string(), pa.string(), pa.binary(), pa.int32(), pa.string(), pa.binary()]
            new = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            names = ["_row", "page_id", "url", "host", "sections", "content", "size", "tree", "packed"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *new], names)

    kind = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select(F.monotonically_increasing_id().alias("_row"), "page_id", "url", "html")
    ddl = f"_row long, page_id {kind}, url string, host string, sections string, content binary, size int, tree string, packed binary"
    return land(rows.mapInArrow(run, ddl), "parsed-pages")


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row, host, cluster, votes, page, wrapper in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            out += [(row, host, cluster, votes, slot, block) for block, slot in match(json.loads(page), json.loads(wrapper))[1]]
        columns = list(zip(*out, strict=True)) or [()] * 6
        kinds = [pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.int32(), pa.int32()]
        names = ["_row", "host", "cluster", "votes", "slot", "block"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def clusters(different: DataFrame) -> DataFrame:
    """The cluster of every host and digest of sections, and whether its pages vote there."""
    counted = different.groupBy("host", "sections").agg(F.count("*").alias("pages"))
    largest = counted.filter(F.col("pages") >= CLUSTER_PAGES).groupBy("host").agg(F.max(F.struct("pages", "sections")).alias("largest"))
    large = F.col("pages") >= CLUSTER_PAGES
    cluster = F.when(large, F.col("sections")).otherwise(F.coalesce("largest.sections", F.lit("")))
    return counted.join(largest, "host", "left").select("host", "sections", cluster.alias("cluster"), (large | F.col("largest").isNull()).alias("votes"))


def template_blocks(parsed: DataFrame) -> DataFrame:
    """``_row`` and the numbers of the blocks of that page that are template.

    Pages that are the same but for hinted blocks count once, so that no number of copies makes an article a template.
    """
    first = F.min(F.struct("_row", "size", "sections")).alias("first")
    different = land(parsed.groupBy("host", "content").agg(first).select("host", "first.*"), "different")
    placed = land(clusters(different), "clusters")
    voters = different.join(placed.filter("votes"), ["host", "sections"])
    counted = voters.groupBy("host", "cluster").agg(F.count("*").alias("pages"), F.percentile_approx("size", ABOVE_SHARE).alias("above"))
    usual = voters.join(counted.filter(F.col("pages") >= LEAST_PAGES), ["host", "cluster"]).filter("size >= above")
    least = usual.groupBy("host", "cluster").agg(F.max("pages").alias("pages"), F.min(F.struct("size", "_row")).alias("least"))
    several = land(least.select("host", "cluster", "pages", F.col("least._row").alias("_row")), "hosts")
    wrappers = parsed.select("_row", F.col("tree").alias("wrapper")).join(several, "_row").select("host", "cluster", "wrapper")
    # a copy has its own sections, which may be no different page's
    pages = parsed.filter("size > 0").select("_row", "host", "sections", "tree").join(placed, ["host", "sections"], "left")
    alone = several.groupBy("host").agg(F.max(F.struct("pages", "cluster"))["cluster"].alias("usual"))
    pages = pages.join(alone, "host").withColumn("cluster", F.coalesce("cluster", "usual"))
    pairs = pages.join(wrappers, ["host", "cluster"]).select("_row", "host", "cluster", F.coalesce("votes", F.lit(False)).alias("votes"), "tree", "wrapper")
    same = land(pairs.mapInArrow(_align, "_row long, host string, cluster string, votes boolean, slot int, block int"), "aligned")
    votes = same.filter("votes").join(different.select("_row"), "_row", "left_semi").groupBy("host", "cluster", "slot").agg(F.count("*").alias("n"))
    fixed = votes.join(several, ["host", "cluster"]).filter(F.col("n") >= SAME_SHARE * F.col("pages")).select("host", "cluster", "slot")
    return same.join(fixed, ["host", "cluster", "slot"]).groupBy("_row").agg(F.collect_list("block").alias("template"))


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpacker = zstandard.ZstdDecompressor()
    for batch in batches:
        texts = []
        for packed, template in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            blocks, hints = json.loads(unpacker.decompress(packed))
            gone = {*hints, *(template or ())}
            texts.append("\n".join(b for i, b in enumerate(blocks) if i not in gone))
        sizes = pa.array(map(len, texts), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, ``text`` and ``n_chars`` of every page.

    Null and empty pages have an empty text.  Pages without a host share one.  Repeated rows and ids are pages each.
    Hosts with fewer than three different pages have no template to tell, so all stays but what hints tell.  Only page_id,
    url and html are read.
    """
    ship(pages.sparkSession)
    parsed = _parsed(pages)
    kind = pages.schema["page_id"].dataType.simpleString()
    template = land(template_blocks(parsed), "templates")  # written, so that its size decides how the texts meet it
    joined = parsed.select("_row", "page_id", "url", "packed").join(template, "_row", "left")
    return joined.select("page_id", "url", "packed", "template").mapInArrow(_assemble, f"page_id {kind}, url string, text string, n_chars long")


def op8_wrapper_induction(spark, sf_dir: str) -> DataFrame:
    """The main text of every whole page."""
    return extract(read(spark, sf_dir, "pages", "page_id", "url", "html"))
