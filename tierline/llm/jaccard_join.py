"""Documents that share three quarters of their word shingles, and the groups they form.

Signature trees find the pairs. A document's signature is a bitmap of its shingles; the
nodes of a tree hold the OR of the bitmaps below them and the range of their sizes. Two
trees are walked together: a pair of nodes is dropped if its sizes cannot match, or if the
common bits bound the overlap of any two documents below too low.

One tree over a corpus would have nodes that hold every bit. So the corpus is cut first,
into overlapping groups of documents that share a shingle among their first ones. Shingles
are ordered by their frequency class (a count sketch over all documents, of fixed size),
then by hash; two documents that are similar enough share one of their first
n - ceil(t n) + 1. Frequent shingles come last, so a passage that many documents have
makes a group only of those that consist of little else. Each group is a forest of trees
over blocks of it. The sketch only decides where a shingle's documents are brought together:
rare ones in one task, which a second count bounds, frequent ones block by block.

Similar documents are not paired one by one: of the pairs that a tree leaves, those that
connect its documents are verified first, on the exact shingles; the others only where
their documents are not connected by then. What is never paired is similar to nothing or
connected already. Documents with equal sets of shingles count as one throughout.
"""

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import python_tasks, small_side
from tierline.llm.components import components
from tierline.llm.hashing import FACTOR, MIXES, mixed
from tierline.llm.hashing import words as hashed_words
from tierline.session import stage

SHINGLE = 5
PERCENT = 75

#: Cells of the count sketch, and the parts it is added up in.
CELLS, CELL_PARTS = 1 << 20, 64

#: A frequency below this is not told from chance.
LEAST_FREQUENT = 32

#: Bits of a shingle's place among a set's first ones, beside the set's size.
PLACE_BITS = 24

#: Documents of a tree, and children of a node.
BLOCK, FAN = 512, 8

#: Cells per shuffle partition that shingles held for rare are counted in, the part of a
#: partition's rows that one of them may have, and rows that are always few.
CELLS_A_PART, PART_SHARE, FEW_ROWS = 64, 4, 1024

#: Pairs that a block may leave per document before only the connecting ones are kept.
DENSE = 8

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The hashes of each text's distinct shingles, sorted; see :func:`linked`."""
    lines = [(t or "").encode().translate(_LOWER) for t in texts]
    starts, words = hashed_words(b"\n".join(lines))
    line_starts = np.cumsum([0] + [len(x) + 1 for x in lines[:-1]])
    edges = np.searchsorted(starts, np.append(line_starts, np.iinfo(np.int64).max))
    full = np.zeros(max(len(words) - SHINGLE + 1, 0), dtype=np.uint64)
    for i in range(SHINGLE):
        full = full * MIXES[1] + words[i : i + len(full)]
    full = mixed(full, MIXES[0])
    out = []
    for a, b in zip(edges, edges[1:]):
        if b - a >= SHINGLE:
            out.append(np.unique(full[a : b - SHINGLE + 1]))
        elif b > a:
            # The whole of a short text; its length keeps it apart from longer ones.
            h = np.full(1, b - a, dtype=np.uint64)
            for w in words[a:b]:
                h = h * MIXES[1] + w
            out.append(mixed(h * FACTOR, MIXES[0]))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def _cells(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sketch's cell of each shingle and the sign it is counted with."""
    cell = (hashes >> np.uint64(40)).astype(np.int64) & (CELLS - 1)
    return cell, 1 - 2 * ((hashes >> np.uint64(39)) & np.uint64(1)).astype(np.int64)


def frequency_sketch(docs: DataFrame) -> np.ndarray:
    """Signed counts of shingles by cell, over all documents (``text``): 8 MB however many
    documents there are. Its errors make groups larger or smaller, never a result wrong."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(CELLS, dtype=np.float64)
        for batch in batches:
            found = shingle_sets(list(batch["text"]))
            cell, sign = _cells(np.concatenate(found)) if found else _cells(np.empty(0, dtype=np.uint64))
            total += np.bincount(cell, weights=sign, minlength=CELLS)
        parts = total.astype("<i4").reshape(CELL_PARTS, -1)
        yield pd.DataFrame({"part": range(CELL_PARTS), "cells": [p.tobytes() for p in parts]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, cells in zip(batch["part"], batch["cells"]):
                totals[part] = totals.get(part, 0) + np.frombuffer(cells, dtype="<i4").astype("<i8")
        yield pd.DataFrame({"part": list(totals), "cells": [t.tobytes() for t in totals.values()]}, columns=["part", "cells"])

    counted = docs.select("text").mapInPandas(count, "part int, cells binary")
    summed = counted.repartition("part").mapInPandas(add, "part int, cells binary")
    sketch = np.zeros((CELL_PARTS, CELLS // CELL_PARTS), dtype=np.int64)
    for row in summed.collect():
        sketch[row["part"]] += np.frombuffer(row["cells"], dtype="<i8")
    return sketch.reshape(-1)


def frequency_classes(sketch: np.ndarray) -> np.ndarray:
    """The class of a cell's shingles: 0 below the noise, else the binary logarithm of the
    count, with the count's sign."""
    noise = np.median(np.abs(sketch)) / 0.6745
    size = np.abs(sketch)
    found = np.where(size < max(LEAST_FREQUENT, 6 * noise), 0, np.log2(np.maximum(size, 1)).astype(np.int64))
    return (np.sign(sketch) * found).astype(np.int8)


def _lists(arrays: Iterable[np.ndarray]) -> pd.Series:
    """A column of arrays, also if there are none."""
    return pd.Series(list(arrays), dtype=object)


def _first_ones(shingles: np.ndarray, classes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles of a set in the order of class and hash, rare ones and frequent
    ones apart. Similar sets share one of them."""
    cell, sign = _cells(shingles)
    level = np.maximum(classes[cell] * sign, 0)
    many = len(shingles) - -(-percent * len(shingles) // 100) + 1
    order = np.lexsort((shingles, level))[:many]
    first, level = shingles[order], level[order]
    return first[level == 0], first[level > 0]


def _width(n: int) -> int:
    """Bits of the signature of a set of n: a power of two, two to four a shingle."""
    return 1 << max(6, (2 * n - 1).bit_length())


def _bitmap(shingles: np.ndarray) -> bytes:
    width = _width(len(shingles))
    bits = np.zeros(width, dtype=np.uint8)
    bits[(shingles & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


class _Tree:
    """A signature tree over the rows of a matrix of bitmaps, given in an order in which
    similar rows are neighbours. Level 0 is the rows, every level above has a node for FAN
    nodes below, the last one a single root."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray):
        spare = sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        self.levels = [(bits, sizes, sizes, spare)]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, spare = self.levels[-1]
            at = np.arange(0, len(bits), FAN)
            self.levels.append(
                (np.bitwise_or.reduceat(bits, at, axis=0), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(spare, at))
            )

    def node_count(self, level: int) -> int:
        return len(self.levels[min(level, len(self.levels) - 1)][0])


def _bounds(one: _Tree, other: _Tree, level: int, x: np.ndarray, y: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which node pairs (x, y) of a level may hold a similar pair, and the most it may share.

    Shared shingles lie in common bits; a set has no more shingles than bits but for the
    spare ones that fell on a bit already set.
    """
    a, b = (t.levels[min(level, len(t.levels) - 1)] for t in (one, other))
    keep, most = np.empty(len(x), dtype=bool), np.empty(len(x), dtype=np.int64)
    step = max(1, (1 << 22) // max(a[0].shape[1], 1))
    for at in range(0, len(x), step):
        i, j = x[at : at + step], y[at : at + step]
        common = np.bitwise_count(a[0][i] & b[0][j]).sum(axis=1, dtype=np.int64) + np.minimum(a[3][i], b[3][j])
        sized = (100 * a[2][i] >= percent * b[1][j]) & (100 * b[2][j] >= percent * a[1][i])
        keep[at : at + step] = sized & ((100 + percent) * common >= percent * (a[1][i] + b[1][j]))
        most[at : at + step] = common
    return keep, most


def _children(nodes: np.ndarray, tree: _Tree, level: int) -> tuple[np.ndarray, np.ndarray]:
    """First child and number of children of nodes, one level down; a tree that is lower
    than the other waits at its root."""
    if level >= len(tree.levels):
        return nodes, np.ones(len(nodes), dtype=np.int64)
    first = nodes * FAN
    return first, np.minimum(len(tree.levels[level - 1][0]) - first, FAN)


def _walk(one: _Tree, other: _Tree, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of both trees that may be similar, with their bound; within one tree each pair once."""
    x = y = np.zeros(1, dtype=np.int64)
    for level in range(max(len(one.levels), len(other.levels)) - 1, -1, -1):
        keep, most = _bounds(one, other, level, x, y, percent)
        if one is other and level == 0:
            keep &= x < y
        x, y, most = x[keep], y[keep], most[keep]
        if level == 0 or not len(x):
            return x, y, most
        first_x, many_x = _children(x, one, level)
        first_y, many_y = _children(y, other, level)
        many = many_x * many_y
        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        across = np.repeat(many_y, many)
        x, y = np.repeat(first_x, many) + nth // across, np.repeat(first_y, many) + nth % across
        if one is other:
            x, y = x[x <= y], y[x <= y]
    return x, y, most


def _similar(sizes: np.ndarray, bitmaps: list[bytes], side: np.ndarray | None, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows that may be similar: of all rows, or of side 0 with side 1.

    Bitmaps of one width make a tree. Similar sizes differ by less than a factor of two,
    so a width meets itself and the next one, folded to it.
    """
    widths = np.array([len(b) for b in bitmaps])
    sides = [None] if side is None else [0, 1]
    rows = {(w, s): np.flatnonzero((widths == w) & (True if s is None else side == s)) for w in np.unique(widths) for s in sides}
    # Like rows side by side: by size first, then by what the bitmaps begin with.
    rows = {k: r[np.lexsort(([bitmaps[i][:16] for i in r], sizes[r]))] if len(r) > 2 else r for k, r in rows.items() if len(r)}
    trees: dict[tuple, _Tree] = {}

    def tree(w: int, s: int | None, folded: bool) -> _Tree:
        if (w, s, folded) not in trees:
            bits = np.frombuffer(b"".join(bitmaps[i] for i in rows[w, s]), dtype="<u8").reshape(len(rows[w, s]), -1)
            if folded:
                bits = bits[:, : bits.shape[1] // 2] | bits[:, bits.shape[1] // 2 :]
            trees[w, s, folded] = _Tree(bits, sizes[rows[w, s]])
        return trees[w, s, folded]

    found = []
    for w, s in rows:
        for v, t in rows:
            if v not in (w, 2 * w) or s is not None and s == t:
                continue
            if v == w and s is not None and s > t:
                continue
            x, y, most = _walk(tree(w, s, False), tree(v, t, v != w), percent)
            found.append((rows[w, s][x], rows[v, t][y], most))
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, dtype=np.int64),) * 3


def _connecting(n: int, x: np.ndarray, y: np.ndarray, most: np.ndarray, within: np.ndarray) -> np.ndarray:
    """Mask of the pairs, most promising first, that connect what is not connected yet;
    rows of equal ``within`` are connected from the start."""
    _, parent = np.unique(within, return_inverse=True)
    parent = parent.tolist()
    above = list(range(n))

    def root(i: int) -> int:
        while above[i] != i:
            above[i] = above[above[i]]
            i = above[i]
        return i

    mask = np.zeros(len(x), dtype=bool)
    for k in np.lexsort((y, x, -most)):
        a, b = root(parent[x[k]]), root(parent[y[k]])
        if a != b:
            above[a] = b
            mask[k] = True
    return mask


#: What a tree's pairs are for: to connect, to complete what is not, to come back to.
CONNECT, REST, AGAIN = 0, 1, 2


def _join_blocks(percent: int, complete: bool, dense: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Joins blocks of rows (``group, i, j, side, id, n, bits, part``), sorted by the first
    three: block i with itself, or with block j. Gives pairs ``a, b`` of ids of different
    parts and their ``use``; with ``complete`` all of them."""

    def of_block(group: int, rows: pd.DataFrame) -> tuple[list, list, list]:
        side = rows["side"].to_numpy() if rows["i"].iat[0] != rows["j"].iat[0] else None
        ids, part = rows["id"].to_numpy(), rows["part"].to_numpy()
        x, y, most = _similar(rows["n"].to_numpy(dtype=np.int64), list(rows["bits"]), side, percent)
        apart = part[x] != part[y]
        x, y, most = x[apart], y[apart], most[apart]
        if not len(x):
            return [], [], []
        if complete:
            use = np.full(len(x), REST)
        else:
            use = np.where(_connecting(len(ids), x, y, most, part), CONNECT, REST)
            if len(x) > dense * len(ids):
                x, y = x[use == CONNECT], y[use == CONNECT]
                use = np.full(len(x), CONNECT)
                return [*ids[x], group], [*ids[y], group], [*use, AGAIN]
        return list(ids[x]), list(ids[y]), list(use)

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        key = None

        def done() -> Iterator[tuple[list, list, list]]:
            if held:
                yield of_block(key[0], pd.concat(held) if len(held) > 1 else held[0])

        for batch in batches:
            if not len(batch):
                continue
            keys = batch[["group", "i", "j"]].to_numpy()
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            out: list[list] = [[], [], []]
            for a, b in zip(starts, [*starts[1:], len(batch)]):
                here = tuple(keys[a])
                if here != key:
                    for made in done():
                        for column, values in zip(out, made):
                            column += values
                    held, key = [], here
                held.append(batch.iloc[a:b])
            yield pd.DataFrame(dict(zip(("a", "b", "use"), out)), dtype="int64")
        for made in done():
            yield pd.DataFrame(dict(zip(("a", "b", "use"), made)), dtype="int64")

    return join


def _may_pair(n: np.ndarray, rest: np.ndarray, percent: int) -> np.ndarray:
    """Which sets of a group have another one that it may be similar to, if the shared
    shingle is the first that both have: ``n`` shingles, ``rest`` of them from it on. They
    share no more than the smaller rest."""
    one, other = n[:, None], n[None, :]
    shared = np.minimum(rest[:, None], rest[None, :])
    fits = ((100 + percent) * shared >= percent * (one + other)) & (100 * one >= percent * other) & (100 * other >= percent * one)
    np.fill_diagonal(fits, False)
    return fits.any(axis=1)


def _shared_groups(percent: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """From rows (``token, id, at``) sorted by token: the ids of the sets that share a token
    and may be similar, once if several tokens have the same ids. ``at`` is the set's size
    and, in the lower PLACE_BITS, the token's place in the set's order. A token's rows are
    few here."""

    def groups(token: np.ndarray, ids: np.ndarray, at: np.ndarray) -> pd.DataFrame:
        order = np.lexsort((ids, at, token))
        token, ids, at = token[order], ids[order], at[order]
        new = np.r_[True, (token[1:] != token[:-1]) | (ids[1:] != ids[:-1])][: len(token)]
        token, ids, n = token[new], ids[new], at[new] >> PLACE_BITS
        rest = n - (at[new] & ((1 << PLACE_BITS) - 1))
        # A group ends where the next larger set is too large for all before it.
        starts = np.flatnonzero(np.r_[True, (token[1:] != token[:-1]) | (percent * n[1:] > 100 * n[:-1])][: len(token)])
        ends = np.append(starts[1:], len(token))
        pairs = starts[ends - starts == 2]
        fits = (100 + percent) * np.minimum(rest[pairs], rest[pairs + 1]) >= percent * (n[pairs] + n[pairs + 1])
        found: dict[bytes, np.ndarray] = {}
        for a in pairs[fits]:
            found.setdefault(ids[a : a + 2].tobytes(), ids[a : a + 2])
        several = ends - starts > 2
        for a, b in zip(starts[several], ends[several]):
            members = ids[a:b]
            if b - a <= BLOCK:
                members = members[_may_pair(n[a:b], rest[a:b], percent)]
            if len(members):
                found.setdefault(members.tobytes(), members)
        return pd.DataFrame({"ids": _lists(found.values())})

    def shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append([batch[c].to_numpy() for c in ("token", "id", "at")])
            # The last token may go on in the next batch.
            if held[0][0][0] == held[-1][0][-1]:
                continue
            rows = [np.concatenate(c) for c in zip(*held)]
            cut = np.searchsorted(rows[0], rows[0][-1])
            yield groups(*(r[:cut] for r in rows))
            held = [[r[cut:] for r in rows]]
        if held:
            yield groups(*(np.concatenate(c) for c in zip(*held)))

    return shared


def _blocks(rows: DataFrame, count: Column) -> Column:
    """Block of a row in its group of ``count``."""
    return F.pmod(F.xxhash64("id"), F.ceil(count / BLOCK)).cast("int")


class _Join:
    """The steps of one join; ``profiles`` has ``doc, text_id, n, rare, frequent, bits``."""

    def __init__(self, docs: DataFrame, profiles: DataFrame, percent: int):
        self.docs, self.profiles, self.percent = docs, profiles, percent
        self.known = None

    def sorted_blocks(self, rows: DataFrame, complete: bool) -> DataFrame:
        """Pairs of the blocks of ``rows`` (``group, i, j, side, id, part``)."""
        signatures = self.profiles.where("n > 0").select(F.col("text_id").alias("id"), "n", "bits").dropDuplicates(["id"])
        ready = rows.join(signatures, "id").select("group", "i", "j", "side", "id", "n", "bits", "part")
        ready = ready.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j")
        return ready.mapInPandas(_join_blocks(self.percent, complete, DENSE), "a long, b long, use int")

    def hot_cells(self) -> tuple[int, list[int]]:
        """The sketch may hold a frequent shingle for rare, since counts of two can cancel
        out. So the shingles it holds for rare are counted again by cell, never too low:
        the number of cells, and those with more rows than a task should have of one
        shingle. They are a few a shuffle partition at most."""
        parts = int(self.profiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        cells = CELLS_A_PART * parts
        counted = self.profiles.select(F.explode("rare").alias("token")).groupBy(F.pmod("token", F.lit(cells)).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
        counted = stage(counted, "cells")
        rows = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        most = max(rows // (PART_SHARE * parts), FEW_ROWS)
        return cells, [r["cell"] for r in counted.where(F.col("n") > most).select("cell").collect()]

    def groups(self) -> DataFrame:
        """``group, id, many``: documents that share one of their first shingles."""
        cells, hot = self.hot_cells()
        rare = self.profiles.select(F.posexplode("rare").alias("place", "token"), F.col("text_id").alias("id"), "n")
        frequent = self.profiles.select(F.explode("frequent").alias("group"), F.col("text_id").alias("id"))
        if hot:
            is_hot = F.pmod("token", F.lit(cells)).isin(hot)
            frequent = frequent.unionByName(rare.where(is_hot).select(F.col("token").alias("group"), "id"))
            rare = rare.where(~is_hot)
        rare = rare.select("token", "id", F.shiftleft("n", PLACE_BITS).bitwiseOR(F.col("place").cast("long")).alias("at"))
        shared = rare.repartition("token").sortWithinPartitions("token").mapInPandas(_shared_groups(self.percent), "ids array<bigint>")
        small = shared.groupBy(F.xxhash64("ids").alias("group")).agg(F.first("ids").alias("ids"))
        small = small.select("group", F.explode("ids").alias("id"), F.size("ids").cast("long").alias("many"))
        # Frequent shingles: first one row a document set, combined before the shuffle.
        frequent = stage(frequent.distinct(), "frequent")
        counts = stage(frequent.groupBy("group").agg(F.count(F.lit(1)).alias("many")).where("many > 1"), "counts")
        large = frequent.join(small_side(counts), "group")
        return stage(small.unionByName(large.select("group", "id", "many")), "groups")

    def shingles(self, pairs: DataFrame) -> DataFrame:
        """``id, shingles`` of the documents in ``pairs``, read from their texts again."""
        first = self.profiles.where("n > 0").groupBy(F.col("text_id").alias("id")).agg(F.min("doc").alias("doc"))
        ends = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        wanted = stage(first.join(ends, "id").select(F.col("doc").alias("wanted")).distinct(), "wanted")
        texts = self.docs.join(small_side(wanted), F.col("doc").eqNullSafe(F.col("wanted")), "left_semi")

        def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = [s for s in shingle_sets(list(batch["text"])) if len(s)]
                yield pd.DataFrame({"id": [_digest(s) for s in found], "shingles": [s.tobytes() for s in found]}, columns=["id", "shingles"])

        return stage(texts.select("text").mapInPandas(cut, "id long, shingles binary").dropDuplicates(["id"]), "shingles")

    def verified(self, pairs: DataFrame, shingles: DataFrame) -> DataFrame:
        """The pairs whose shingle sets are similar, counted exactly."""
        percent = self.percent
        one = shingles.select(F.col("id").alias("a"), F.col("shingles").alias("of_a"))
        other = shingles.select(F.col("id").alias("b"), F.col("shingles").alias("of_b"))
        both = pairs.select("a", "b").distinct().join(one, "a").join(other, "b")

        def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                keep = []
                for x, y in zip(batch["of_a"], batch["of_b"]):
                    x, y = np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8")
                    same = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * same >= percent * (len(x) + len(y) - same))
                yield batch.loc[keep, ["a", "b"]]

        return stage(both.mapInPandas(compare, "a long, b long"), "links")

    def links(self) -> DataFrame:
        """Links (``a``, ``b``) that connect every two similar documents directly or not."""
        groups = self.groups()
        alone = groups.select("group", _blocks(groups, F.col("many")).alias("i"), F.lit(0).alias("side"), "id", F.col("id").alias("part")).withColumn("j", F.col("i"))
        first = stage(self.sorted_blocks(alone, complete=False), "pairs")
        connecting = _ordered(first.where(F.col("use") == CONNECT))
        shingles = self.shingles(first.where(F.col("use") != AGAIN))
        links = self.verified(connecting, shingles)
        parts = components(links)

        # Groups of several blocks: one document of each part of the group stands for it.
        again = first.where(F.col("use") == AGAIN).select(F.col("a").alias("group"))
        again = small_side(stage(again.unionByName(groups.where(F.col("many") > BLOCK).select("group")).distinct(), "again"))
        open_groups = stage(groups.join(again, "group", "left_semi"), "open")
        if not open_groups.isEmpty():
            heads = _with_parts(open_groups.where(F.col("many") > BLOCK), parts).groupBy("group", "part").agg(F.min("id").alias("id"))
            heads = stage(heads, "heads")
            many = stage(heads.groupBy("group").agg(F.count(F.lit(1)).alias("many")).where("many > 1"), "many")
            heads = heads.join(small_side(many), "group").select("group", _blocks(heads, F.col("many")).alias("i"), F.lit(0).alias("side"), "id", "part").withColumn("j", F.col("i"))
            second = stage(self.sorted_blocks(heads, complete=False), "pairs").where(F.col("use") == CONNECT)
            links = self._more(links, second, shingles)
            parts = components(links)

        # What is left: pairs whose documents are in different parts still.
        rest = first.where(F.col("use") == REST)
        if not open_groups.isEmpty():
            rest = rest.unionByName(self.sorted_blocks(_block_pairs(_with_parts(open_groups, parts)), complete=True))
        rest = _ordered(rest)
        rest = _with_parts(rest.withColumnRenamed("a", "id"), parts).withColumnsRenamed({"id": "a", "part": "part_a", "b": "id"})
        rest = _with_parts(rest, parts).where("part_a <> part").select("a", F.col("id").alias("b"))
        return self._more(links, stage(rest.distinct(), "rest"), shingles)

    def _more(self, links: DataFrame, pairs: DataFrame, shingles: DataFrame) -> DataFrame:
        pairs = _ordered(pairs)
        if pairs.isEmpty():
            return links
        missing = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(shingles, "id", "left_anti")
        if not missing.isEmpty():
            shingles = shingles.unionByName(self.shingles(missing.select(F.col("id").alias("a"), F.col("id").alias("b"))))
        return links.unionByName(self.verified(pairs, shingles))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _with_parts(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """``rows`` (``id``) with the part each document is in so far, at first itself."""
    return rows.join(parts.select(F.col("node").alias("id"), "root"), "id", "left").withColumn("part", F.coalesce("root", "id")).drop("root")


def _block_pairs(rows: DataFrame) -> DataFrame:
    """Rows (``group, id, many, part``) of groups with several parts, for every two blocks
    that hold different ones. A part of more than a block has blocks of its own; two of
    the same part never meet."""
    held = stage(rows.groupBy("group", "part").agg(F.count(F.lit(1)).alias("held")), "held")
    several = held.groupBy("group").agg(F.count(F.lit(1)).alias("parts")).where("parts > 1").select("group")
    open_parts = stage(held.join(several, "group", "left_semi"), "parts")
    known = rows.join(small_side(open_parts), ["group", "part"])
    alone = F.col("held") > BLOCK
    block = F.when(alone, F.xxhash64("part", _blocks(rows, F.col("held")))).otherwise(F.pmod(F.xxhash64("part"), F.ceil(F.col("many") / BLOCK)))
    placed = known.withColumn("own", F.when(alone, F.col("part"))).withColumn("block", block)
    blocks = placed.select("group", "block", "own").distinct()
    one = blocks.select("group", F.col("block").alias("i"), F.col("own").alias("own_i"))
    other = blocks.select("group", F.col("block").alias("j"), F.col("own").alias("own_j"))
    meet = one.join(other, "group").where("i <= j and not coalesce(own_i = own_j, false)")
    meet = meet.select("group", "i", "j", F.explode(F.when(F.col("i") == F.col("j"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))).alias("side"))
    meet = meet.withColumn("block", F.when(F.col("side") == 0, F.col("i")).otherwise(F.col("j")))
    return placed.select("group", "block", "id", "part").join(meet, ["group", "block"]).select("group", "i", "j", "side", "id", "part")


def _digest(shingles: np.ndarray) -> int:
    """One number for a set of shingles."""
    place = np.arange(1, len(shingles) + 1, dtype=np.uint64) * FACTOR
    h = mixed(shingles + place, MIXES[1]).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(mixed(np.array([h], dtype=np.uint64), MIXES[0]).view(np.int64)[0])


def _grouped(df: DataFrame, percent: int, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """A row ``doc, version`` (a hash of the text)``, n, text_id`` per input row, and
    ``text_id, root`` of the texts that another one stands for. These are far fewer than the
    documents; joined as a small side, they leave a large group's rows where they are."""
    spark = df.sparkSession
    python_tasks(spark)
    docs = df.select(df[key].alias("doc"), df[text].cast("string").alias("text"))
    classes = spark.sparkContext.broadcast(frequency_classes(frequency_sketch(docs)))
    kind = df.schema[key].dataType.simpleString()

    def profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Equal sets of a task are grouped by the first of them.
        seen: set[int] = set()
        none = np.empty(0, dtype=np.uint64)
        for batch in batches:
            found = shingle_sets(list(batch["text"]))
            digests = [_digest(s) for s in found]
            firsts = []
            for s, digest in zip(found, digests):
                firsts.append((none, none) if digest in seen else _first_ones(s, classes.value, percent))
                seen.add(digest)
            yield pd.DataFrame(
                {
                    "doc": batch["doc"],
                    "version": batch["version"],
                    "text_id": digests,
                    "n": [len(s) for s in found],
                    "rare": _lists(f.view(np.int64) for f, _ in firsts),
                    "frequent": _lists(f.view(np.int64) for _, f in firsts),
                    "bits": [_bitmap(s) for s in found],
                }
            )

    made = docs.withColumn("version", F.xxhash64("text")).mapInPandas(profile, f"doc {kind}, version long, text_id long, n long, rare array<bigint>, frequent array<bigint>, bits binary")
    profiles = stage(made, "profiles")
    parts = components(_Join(docs, profiles, percent).links()).withColumnRenamed("node", "text_id")
    rows = profiles.select("doc", "version", "n", F.when(F.col("n") > 0, F.col("text_id")).alias("text_id"))
    return rows, small_side(stage(parts, "roots"))


def linked(df: DataFrame, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``key``, ``n_shingles`` and ``component_id``, the smallest key
    reachable by links, its own included.

    A document's set is its distinct shingles of five words (runs of anything but ASCII
    white space, A-Z in lower case), or all its words if they are fewer. Documents link
    when the intersection is at least ``percent`` / 100 of the union. Null and empty texts,
    and those of white space only, have no shingles and link with nothing. Rows of one key
    and different texts are documents of their own; a null key is reported as such, and is
    never the smallest unless there is no other. Other columns are left out.
    """
    rows, roots = _grouped(df, percent, key, text)
    first = rows.where("n > 0").groupBy("text_id").agg(F.min("doc").alias("doc"), F.count(F.lit(1)).alias("times"))
    first = stage(first.join(roots, "text_id", "left").withColumn("root", F.coalesce("root", "text_id")), "first")
    # Only groups of several rows have anything to be told.
    whole = first.groupBy("root").agg(F.min("doc").alias("component_id"), F.sum("times").alias("times")).where("times > 1")
    whole = small_side(stage(whole.drop("times"), "whole"))
    named = small_side(stage(first.join(whole, "root").select("text_id", "component_id"), "named"))
    return rows.join(named, "text_id", "left").select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc").alias("component_id"))


def first_of_groups(df: DataFrame, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The input rows, all columns, without near duplicates: of each group (see
    :func:`linked`) the row with the smallest key stays, of several with that key the one
    with the smallest hash of its text, of repeated rows any one. A null key comes last.
    Rows without shingles all stay.
    """
    rows, roots = _grouped(df, percent, key, text)
    rows = rows.where("n > 0").groupBy("text_id", "doc", "version").agg(F.count(F.lit(1)).alias("times"))
    rows = stage(rows.join(roots, "text_id", "left").withColumn("root", F.coalesce("root", "text_id")), "rooted")
    order = F.struct(F.col("doc").isNull().alias("last"), "doc", "version")
    chosen = rows.groupBy("root").agg(F.min(order).alias("chosen"), F.sum("times").alias("all_times")).where("all_times > 1")
    judged = rows.join(small_side(stage(chosen.drop("all_times"), "chosen")), "root").withColumn("stays", order == F.col("chosen"))
    gone = small_side(stage(judged.where("not stays").select(F.col("doc").alias("gone_doc"), F.col("version").alias("gone_version")), "gone"))
    repeated = stage(judged.where("stays and times > 1").select(F.col("doc").alias("gone_doc"), F.col("version").alias("gone_version")), "repeated")

    plain = df.select(*(df[c].alias(f"c{i}") for i, c in enumerate(df.columns)), df[key].alias("doc"), F.xxhash64(df[text].cast("string")).alias("version"))
    same = F.col("doc").eqNullSafe(F.col("gone_doc")) & (F.col("version") == F.col("gone_version"))
    kept = plain.join(gone, same, "left_anti")
    # Repeated rows are few: only they are brought together.
    if not repeated.isEmpty():
        side = small_side(repeated)
        kept = kept.join(side, same, "left_anti").unionByName(kept.join(side, same, "left_semi").dropDuplicates(["doc", "version"]))
    return kept.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns)))
