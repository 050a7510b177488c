"""Main text of web pages: differences between pages of nearest URL.

The pages of a host are ordered by URL path, and each is paired with the neighbour whose
path has more in common with its own. The text lines (blocks) of both are aligned by
their longest common subsequence: what they share is the site's, what differs the page's.

Differencing alone keeps adverts that change from page to page and deletes passages that
two articles share. So markup decides where it is explicit: what it names as menu,
header, footer, advert and so on goes, and inside an element it names as the article a
shared line goes only if it is all links. Elsewhere differencing decides.
"""

import bisect
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import python_tasks, text_or_empty
from tierline.llm.url_filter import host_of, path_of
from tierline.session import stage

# HTML's elements by what they mean for a page's text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
CHROME = frozenset(
    "aside button canvas datalist dialog fieldset footer form head header iframe input menu nav noscript object option script select style svg template textarea title".split()
)
ARTICLE = frozenset(["article", "main"])
CHROME_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())

# Words of class names and ids that mark what is not the article, and words
# that say nothing either way. A name counts if it is made of both kinds only.
CHROME_WORDS = frozenset(
    "ad ads adsense advert advertisement advertising adverts announcement banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disclaimer disqus "
    "dropdown footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notification outbrain pager pagination paywall popup promo promoted promotion "
    "related replies reply respond rss search share sharing sidebar signup skip skyscraper social sponsor sponsored subscribe subscription taboola tags toc toolbar tooltip widget widgets".split()
)
NEUTRAL_WORDS = frozenset(
    "a area bar block body bottom box buttons column container content fixed form global group holder icons inner item items left level link links list main media message outer page panel policy post "
    "posts primary reader right row secondary section site slot small sticky tertiary text thread title top unit user users wrap wrapper zone 1 2 3 4 5".split()
)

#: Pages that a neighbourhood of URLs holds on average, and the most neighbourhoods there are.
NEAR_ROWS, MOST_RANGES = 1024, 1 << 16

#: Lines that stand more often than this on the other page are not paired one by one, and
#: the bytes that the table of such pages may have before it is cut in half.
MOST_PAIRS, TABLE_BYTES = 64, 64 << 20

#: Adjacent pages without article markup that share more than this part of the longer
#: one's text may be copies: a neighbour is looked for beyond them first.
COPY_SHARE = 0.9

_WORDS = regex.compile(r"[^a-z0-9]+")


def _is_chrome(tag: str, attributes: dict[str, str | None]) -> bool:
    if tag in CHROME:
        return True
    if tag in ARTICLE or tag in ("html", "body"):
        return False
    if (attributes.get("role") or "").lower() in CHROME_ROLES or "hidden" in attributes:
        return True
    for name in [*(attributes.get("class") or "").lower().split(), (attributes.get("id") or "").lower()]:
        parts = {w for w in _WORDS.split(name) if w}
        if parts & CHROME_WORDS and parts <= CHROME_WORDS | NEUTRAL_WORDS:
            return True
    return False


class _Reader(HTMLParser):
    """Collects a page's blocks: (text, zone, all links); zones are c(hrome), a(rticle), b(ody)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, str, bool]] = []
        self.open: list[tuple[str, bool]] = []
        self.chrome = self.article = self.links = 0
        self.text: list[str] = []
        self.plain = False

    def _count(self, tag: str, chrome: bool, by: int) -> None:
        self.chrome += by * chrome
        self.article += by * (tag in ARTICLE)
        self.links += by * (tag == "a")

    def _flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            zone = "c" if self.chrome else "a" if self.article else "b"
            self.blocks.append((text, zone, not self.plain))
        self.text, self.plain = [], False

    def _close(self, down_to: int) -> None:
        for tag, chrome in reversed(self.open[down_to:]):
            self._count(tag, chrome, -1)
        del self.open[down_to:]

    def handle_starttag(self, tag, attrs):
        attributes = dict(attrs)
        if tag == "br":
            self.text.append(" ")
            return
        chrome = _is_chrome(tag, attributes)
        if tag in BLOCK or chrome != bool(self.chrome) and chrome:
            self._flush()
        if tag in VOID:
            return
        if (tag in ARTICLE and not chrome or tag == "body") and self.chrome:
            # An article inside of what is no article: that was left open.
            first = next(i for i, (_, c) in enumerate(self.open) if c)
            if self.open[first][0] not in ("aside", "form", "dialog", "template") and not any(t == "section" for t, _ in self.open[first:]):
                self._close(first)
        self.open.append((tag, chrome))
        self._count(tag, chrome, 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag), None)
        if tag in BLOCK or at is not None and any(c for _, c in self.open[at:]):
            self._flush()
        if at is not None:
            self._close(at)

    def handle_data(self, data):
        self.text.append(data)
        if not self.links and data.strip():
            self.plain = True


def blocks(page: str | None) -> list[tuple[str, str, bool]]:
    """The text blocks of a page in order, each with its zone and whether it is all links."""
    if not page:
        return []
    reader = _Reader()
    reader.feed(page)
    reader.close()
    reader._flush()
    return reader.blocks


def _table(own: list[int], other: list[int]) -> Iterator[int]:
    """Row by row of ``own`` the table of common subsequence lengths, as bits: a zero at
    place j says that one more line of ``other``, the j-th, makes it longer."""
    places: dict[int, list[int]] = defaultdict(list)
    for j, line in enumerate(other):
        places[line].append(j)

    @lru_cache(maxsize=max(TABLE_BYTES // (len(other) // 8 + 1), 1))
    def mask(line: int) -> int:
        bits = np.zeros(len(other), dtype=np.uint8)
        bits[places.get(line, [])] = 1
        return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")

    row = full = (1 << len(other)) - 1
    yield row
    for line in own:
        paired = row & mask(line)
        row = ((row + paired) | (row - paired)) & full
        yield row


def _lengths(own: list[int], other: list[int]) -> np.ndarray:
    """Item j is the common subsequence's length of ``own`` and the first j of ``other``."""
    row = 0
    for row in _table(own, other):
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(other) // 8 + 1, "little"), dtype=np.uint8), count=len(other), bitorder="little")
    return np.concatenate([[0], np.cumsum(bits == 0)])


def _dense(own: list[int], other: list[int]) -> Iterator[int]:
    """Places in ``own`` of a longest common subsequence, whatever the number of equal
    lines: by the table of lengths, or by halves if that is too large (Hirschberg)."""
    if not own or not other:
        return
    if len(own) * len(other) > 8 * TABLE_BYTES and len(own) > 1:
        half = len(own) // 2
        at = int((_lengths(own[:half], other) + _lengths(own[half:][::-1], other[::-1])[::-1]).argmax())
        yield from _dense(own[:half], other[:at])
        yield from (half + i for i in _dense(own[half:], other[at:]))
        return
    rows = list(_table(own, other))
    i, j = len(own), len(other)
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
            continue
        i -= 1
        if rows[i] >> (j - 1) & 1:
            j -= 1
            yield i


def shared_lines(own: list[int], other: list[int]) -> set[int]:
    """Places in ``own`` of a longest common subsequence of both lists.

    Each pair of equal lines extends the longest chain of pairs before it. If a line
    stands very often on the other page, the table of all lengths is made instead.
    """
    start, end = 0, min(len(own), len(other))
    while start < end and own[start] == other[start]:
        start += 1
    tail = 0
    while tail < end - start and own[-1 - tail] == other[-1 - tail]:
        tail += 1
    shared = {*range(start), *range(len(own) - tail, len(own))}
    places = defaultdict(list)
    for j in range(start, len(other) - tail):
        places[other[j]].append(j)
    if any(len(places.get(line, ())) > MOST_PAIRS for line in own[start : len(own) - tail]):
        return shared | {start + i for i in _dense(own[start : len(own) - tail], other[start : len(other) - tail])}
    ends: list[int] = []
    last: list[tuple] = []
    for i in range(start, len(own) - tail):
        for j in reversed(places.get(own[i], ())):
            length = bisect.bisect_left(ends, j)
            chain = (i, last[length - 1] if length else None)
            if length == len(ends):
                ends.append(j)
                last.append(chain)
            else:
                ends[length], last[length] = j, chain
    chain = last[-1] if last else None
    while chain:
        shared.add(chain[0])
        chain = chain[1]
    return shared


def main_text(page: list[tuple[str, str, bool]], shared: set[int]) -> str:
    """The article of a page's blocks, given which of them the nearest page has too."""
    if any(zone == "a" for _, zone, _ in page):
        kept = [text for i, (text, zone, links) in enumerate(page) if zone == "a" and not (links and i in shared)]
    else:
        own = any(zone == "b" and not links and i not in shared for i, (_, zone, links) in enumerate(page))
        # A page that has nothing of its own is a copy: all but its links stays.
        kept = [text for i, (text, zone, links) in enumerate(page) if zone == "b" and (i not in shared or not own and not links)]
    return " ".join(kept)


def _common_prefix(a: str, b: str) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


class _Page(NamedTuple):
    """What a page shows its neighbours: ``sizes`` are of unmarked blocks, 0 for others."""

    place: str
    lines: np.ndarray
    sizes: np.ndarray
    article: bool

    @property
    def host(self) -> str:
        return self.place.split("\u0001", 1)[0]


def _relation(one: _Page, other: _Page) -> str:
    """``host`` for pages of different hosts (or none), ``equal`` for the same unmarked
    lines, ``copy`` for nearly the same, else ``differ``."""
    if not one.host or one.host != other.host:
        return "host"
    # The same answer from either side.
    one, other = sorted((one, other), key=lambda p: p.place)
    if np.array_equal(one.lines[one.sizes > 0], other.lines[other.sizes > 0]):
        return "equal"
    if one.article or other.article:
        return "differ"
    same = sum(int(one.sizes[i]) for i in shared_lines(one.lines.tolist(), other.lines.tolist()))
    return "copy" if same > COPY_SHARE * max(one.sizes.sum(), other.sizes.sum()) else "differ"


class _Side:
    """Pages met on one side while pages are read in order: the last one, the last that is
    not equal to those after it, and the last beyond a run of copies."""

    def __init__(self):
        self.last: _Page | None = None
        self.unequal: _Page | None = None
        self.far: _Page | None = None

    def step(self, page: _Page) -> str | None:
        """Move on to ``page``; returns how it relates to the one before."""
        relation = _relation(self.last, page) if self.last else None
        if relation == "host":
            self.unequal = self.far = None
        elif relation in ("copy", "differ"):
            self.unequal = self.last
            if relation == "differ":
                self.far = self.last
        before, self.last = self.last, page
        self.before = None if relation == "host" else before
        return relation

    def nearest(self) -> tuple[int, _Page] | None:
        """The neighbour of the page stepped to, and how good it is: one beyond all copies
        is best, then one that is not equal. Markup decides for articles, so theirs is the
        adjacent page."""
        if not self.last.article:
            if self.far:
                return 2, self.far
            if self.unequal:
                return 1, self.unequal
        return (0, self.before) if self.before else None


#: Rows that say what lies around an area: pages before it, the last one nearest, and after it.
_AROUND = {"far": 3, "unequal": 2, "last": 1}
#: Pages of an area that tell what its adjoining areas see.
_FIRST, _LAST, _BEFORE, _AFTER = 0, 1, {"unequal": 2, "far": 3}, {"unequal": 4, "far": 5}


def _ends(pages: Iterator[_Page]) -> dict[int, _Page | None]:
    """The pages of an area, in order, as what a reader from either side knows at its end;
    a page that is None says that a new host came last, no page that nothing came."""
    side, found = _Side(), {}
    for page in pages:
        found.setdefault(_FIRST, page)
        relation = side.step(page)
        for level, by in (("unequal", ("copy", "differ", "host")), ("far", ("differ", "host"))):
            if relation in by:
                found[_BEFORE[level]] = getattr(side, level)
                found.setdefault(_AFTER[level], None if relation == "host" else page)
    return found | {_LAST: side.last}


def _passed_on(areas: Iterator[tuple[int, dict[int, _Page | None]]], forward: bool) -> Iterator[tuple[int, int, _Page]]:
    """What each area is sent of those that were read before it: (area, rank, page)."""
    side, sign = _Side(), -1 if forward else 1
    entry, end, levels = (_FIRST, _LAST, _BEFORE) if forward else (_LAST, _FIRST, _AFTER)
    for area, pages in areas:
        yield from ((area, sign * rank, page) for name, rank in _AROUND.items() if (page := getattr(side, name)))
        side.step(pages[entry])
        for level, role in levels.items():
            if role in pages:
                setattr(side, level, pages[role])
        side.last = pages[end]


def extract(df: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per input row: ``key``, ``url``, ``text`` (empty if there is none),
    ``n_chars`` (its code points) and ``n_shared``, the blocks shared with the nearest page.

    A null page is empty; a page without a host has no neighbour. Repeated rows stay, and
    are each other's neighbours. Pages are extracted whole, whatever their length. Other
    columns are left out; an empty table gives an empty one. Where markup does not name
    the article, the nearest page is one beyond a run of copies; if a host has no such
    page, one that is not equal.

    The order of (host, path, key) is cut into neighbourhoods at keys whose hash is a
    multiple of a number, about every NEAR_ROWS pages, so that a host with a third of all
    pages is many of them. Each is sent the pages that its first and last pages see beyond
    its bounds, so the bounds change no result. They are at most about MOST_RANGES, and
    sent to the workers. Pages are parsed before the shuffle.
    """
    spark = df.sparkSession
    python_tasks(spark, rows=200)
    place = F.concat_ws("\u0001", host_of(text_or_empty(df[url])), path_of(text_or_empty(df[url])), F.coalesce(df[key].cast("string"), F.lit("")))
    kind = df.schema[key].dataType.simpleString()
    # Whole numbers beside nulls would become floating-point numbers in pandas.
    carried = "string" if kind in ("tinyint", "smallint", "int", "bigint") else kind
    placed = df.select(df[key].cast(carried).alias("key"), df[url].cast("string").alias("url"), df[page].cast("string").alias("html"), place.alias("place"))
    every = NEAR_ROWS * (placed.count() // (NEAR_ROWS * MOST_RANGES) + 1)
    chosen = placed.select("place").where(F.pmod(F.xxhash64("place"), F.lit(every)) == 0).distinct().collect()
    bounds = spark.sparkContext.broadcast(sorted(r["place"] for r in chosen))
    # Two areas a partition on average, whatever the session's number of partitions is.
    parts = len(bounds.value) // 2 + 1

    page_type = "place string, lines array<bigint>, sizes array<int>, article boolean"
    parsed_type = f"key {carried}, url string, area int, texts array<string>, zones string, links string, {page_type}"

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [blocks(page) for page in batch["html"]]
            yield pd.DataFrame(
                {
                    "key": batch["key"],
                    "url": batch["url"],
                    "area": [bisect.bisect_right(bounds.value, p) for p in batch["place"]],
                    # The texts of blocks that cannot be the article stay behind.
                    "texts": [[t if z != "c" else "" for t, z, _ in b] for b in found],
                    "zones": ["".join(z for _, z, _ in b) for b in found],
                    "links": ["".join("x" if x else "-" for _, _, x in b) for b in found],
                    "lines": [np.array([xxhash.xxh64_intdigest(t) - (1 << 63) for t, _, _ in b], dtype=np.int64) for b in found],
                    "place": batch["place"],
                    "sizes": [np.array([len(t) if z == "b" else 0 for t, z, _ in b], dtype=np.int32) for b in found],
                    "article": [any(z == "a" for _, z, _ in b) for b in found],
                }
            )

    def sided(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list]]:
        """Each batch with the neighbour of each row on the side that was read before. What
        that side's areas sent is used up, what the other's sent goes through."""
        side, area, sign = _Side(), None, 0
        for batch in batches:
            near, kept = [], []
            for row in batch.itertuples(index=False):
                if row.area != area:
                    side, area, sign = _Side(), row.area, 0
                page = _Page(row.place, row.lines, row.sizes, row.article)
                if row.rank == 0:
                    sign = 1
                    side.step(page)
                sent = row.rank != 0 and sign == 0
                if sent:
                    setattr(side, next(name for name, rank in _AROUND.items() if rank == abs(row.rank)), page)
                else:
                    near.append(side.nearest() if row.rank == 0 else None)
                kept.append(not sent)
            yield batch[kept], near

    near_type = "near_rank int, near_place string, near_lines array<bigint>"

    def look_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, near in sided(batches):
            yield batch.assign(
                near_rank=[n[0] if n else -1 for n in near], near_place=[n[1].place if n else None for n in near], near_lines=[n[1].lines if n else None for n in near]
            )

    def difference(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, after in sided(batches):
            texts, counts = [], []
            for row, behind in zip(batch.itertuples(index=False), after, strict=True):
                path = row.place.split("\u0001", 2)[1]
                near = [(row.near_rank, row.near_place, row.near_lines)] if row.near_rank >= 0 else []
                near += [(behind[0], behind[1].place, behind[1].lines)] if behind else []
                # Of two equally good and near pages the one before is taken.
                lines = max(near, key=lambda n: (n[0], _common_prefix(path, n[1].split("\u0001", 2)[1])))[2] if near else []
                shared = shared_lines(list(row.lines), list(lines)) if len(lines) else set()
                page = list(zip(row.texts, row.zones, (x == "x" for x in row.links)))
                texts.append(main_text(page, shared))
                counts.append(len(shared))
            yield pd.DataFrame({"key": batch["key"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts], "n_shared": counts})

    def pages_of(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, int, _Page | None]]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                yield row.area, row.rank, None if row.place is None else _Page(row.place, row.lines, row.sizes, row.article)

    def shown(pages: Iterator[tuple[int, int, _Page | None]]) -> Iterator[pd.DataFrame]:
        for area, rank, page in pages:
            yield pd.DataFrame([(area, rank, *(page or (None,) * 4))], columns=["area", "rank", *_Page._fields])

    def ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for area, pages in groupby(pages_of(batches), key=lambda p: p[0]):
            yield from shown((area, role, page) for role, page in _ends(page for _, _, page in pages).items())

    def pass_on(forward: bool) -> DataFrame:
        def passed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            areas = groupby(pages_of(batches), key=lambda p: p[0])
            yield from shown(_passed_on(((area, {role: page for _, role, page in pages}) for area, pages in areas), forward))

        # At most six rows an area, of at most MOST_RANGES: one task reads them in order.
        in_order = edges.coalesce(1).sortWithinPartitions(F.col("area") if forward else F.col("area").desc(), "rank")
        return in_order.mapInPandas(passed, f"area int, rank int, {page_type}")

    order = [F.col("area"), F.col("rank"), F.col("place"), F.xxhash64("lines")]
    parsed = placed.mapInPandas(parse, parsed_type).withColumn("rank", F.lit(0))
    parsed_type += ", rank int"
    if bounds.value:
        # Pages are parsed once more, for the ends of the areas: only lines are shuffled for that.
        lines = parsed.select("area", "rank", *_Page._fields).repartition(parts, "area").sortWithinPartitions(*order)
        edges = stage(lines.mapInPandas(ends, f"area int, rank int, {page_type}"), "page-edges")
        parsed = parsed.unionByName(pass_on(True).unionByName(pass_on(False)), allowMissingColumns=True)
    # Every area is read in order and then in reverse, where it lies: texts are shuffled once.
    around = parsed.repartition(parts, "area").sortWithinPartitions(*order).mapInPandas(look_back, f"{parsed_type}, {near_type}").sortWithinPartitions(*(c.desc() for c in order))
    made = around.mapInPandas(difference, f"key {carried}, url string, text string, n_chars long, n_shared long")
    return made.select(F.col("key").cast(kind).alias(key), F.col("url").alias(url), "text", "n_chars", "n_shared")
