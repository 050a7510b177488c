"""Document fingerprints: homomorphic multiset hashes of paragraphs.

Every paragraph is hashed to a wide vector; a document's fingerprint is the sum of the
vectors of its paragraphs, lane by lane modulo a power of two. Addition has no order, so
documents with the same paragraphs in any order have the same fingerprint, and a
paragraph is inserted or deleted by adding or subtracting its vector.

A vector has two parts. The identity lanes are a cryptographic hash of the paragraph,
modulo 2**32: they decide equality. The likeness lanes are a projection of the
paragraph's word trigrams to random signs, modulo 2**32, which no text has words enough
to exceed: their cosine estimates how much
two documents have in common, also where paragraphs were edited.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegralType

from tierline.llm.common import free_name, python_tasks, text_or_empty
from tierline.llm.hashing import MIXES, mixed
from tierline.llm.hashing import words as hashed_words

IDENTITY_LANES = 32
LIKENESS_LANES = 128
GRAM = 3

_IDENTITY_BYTES = 4 * IDENTITY_LANES
#: Word grams spread to signs at once; this bounds the memory.
_CHUNK = 1 << 15


def _grams(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word trigrams within each owner, and their owners; an owner with
    fewer words has all of them as its one gram."""
    firsts = np.flatnonzero(np.diff(owner, prepend=-1))
    counts = np.diff(firsts, append=len(words))
    size = np.minimum(counts, GRAM)
    grams_of = counts - size + 1
    start = np.repeat(firsts, grams_of) + np.arange(grams_of.sum()) - np.repeat(np.cumsum(grams_of) - grams_of, grams_of)
    size = np.repeat(size, grams_of)
    grams = words[start]
    for i in range(1, GRAM):
        more = size > i
        grams[more] = grams[more] * MIXES[1] + words[start[more] + i]
    return grams, owner[start]


def _add_signs(total: np.ndarray, grams: np.ndarray, owner: np.ndarray) -> None:
    """Add the random signs of each gram to the row of its owner (owners ascend)."""
    for at in range(0, len(grams), _CHUNK):
        part, rows = grams[at : at + _CHUNK], owner[at : at + _CHUNK]
        bits = np.stack([mixed(part, m) for m in MIXES], axis=1).astype("<u8")
        ones = np.unpackbits(bits.view(np.uint8).reshape(len(part), -1), axis=1)
        firsts = np.flatnonzero(np.diff(rows, prepend=-1))
        ends = np.append(firsts[1:], len(part))
        for row, a, b in zip(rows[firsts], firsts, ends):
            total[row] += 2 * ones[a:b].sum(axis=0, dtype=np.int32).astype(np.int64) - (b - a)


def paragraphs(text: str | None) -> list[str]:
    """The lines of a text that are not blank, white space at their ends dropped."""
    return [p for p in map(str.strip, (text or "").split("\n")) if p]


def fingerprint_all(texts: list[str | None]) -> list[str]:
    """The fingerprint of each text: lanes in hexadecimal, first the identity's."""
    identity = np.zeros((len(texts), IDENTITY_LANES), dtype="<u4")
    likeness = np.zeros((len(texts), LIKENESS_LANES), dtype=np.int64)
    lines, line_of = [], []
    for row, text in enumerate(texts):
        parts = [p.encode() for p in paragraphs(text)]
        if parts:
            hashed = b"".join(hashlib.shake_128(p).digest(_IDENTITY_BYTES) for p in parts)
            identity[row] = np.frombuffer(hashed, dtype="<u4").reshape(len(parts), -1).sum(axis=0, dtype="<u4")
            lines += parts
            line_of += [row] * len(parts)
    starts, words = hashed_words(b"\n".join(lines))
    if len(words):
        line_starts = np.cumsum([0] + [len(x) + 1 for x in lines[:-1]])
        grams, line = _grams(words, np.searchsorted(line_starts, starts, side="right") - 1)
        _add_signs(likeness, grams, np.array(line_of)[line])
    return [_hex(a, b) for a, b in zip(identity, likeness.astype("<u4"))]


def fingerprint(text: str | None) -> str:
    return fingerprint_all([text])[0]


def _hex(identity: np.ndarray, likeness: np.ndarray) -> str:
    return identity.astype("<u4").tobytes().hex() + likeness.astype("<u4").tobytes().hex()


def _lanes(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    raw = bytes.fromhex(fingerprint)
    return np.frombuffer(raw[:_IDENTITY_BYTES], dtype="<u4"), np.frombuffer(raw[_IDENTITY_BYTES:], dtype="<u4")


def combine(fingerprint: str, other: str, sign: int = 1) -> str:
    """The fingerprint of both multisets together, or (sign -1) of the first without the second."""
    (a, b), (c, d) = _lanes(fingerprint), _lanes(other)
    return _hex(a + c, b + d) if sign > 0 else _hex(a - c, b - d)


def near(one: str, other: str) -> float:
    """Likeness from 0 to 1: 1 for equal fingerprints, else the cosine of the likeness
    lanes, 0 if it is negative or one has no words."""
    if one == other:
        return 1.0
    a, b = (_lanes(x)[1].astype("<i4").astype(np.float64) for x in (one, other))
    size = np.sqrt((a @ a) * (b @ b))
    return float(min(max((a @ b) / size, 0.0), 1.0)) if size else 0.0


def fingerprints(df: DataFrame, *texts: str) -> DataFrame:
    """The rows of ``df`` with ``<text>_fingerprint`` for each column of ``texts``; a null
    text has the fingerprint of an empty one, which is all zeros. Columns that have these
    names already are replaced, all others kept."""
    python_tasks(df.sparkSession)
    held = free_name(df, "summed_")
    names = [f"{t}_fingerprint" for t in texts]

    @F.pandas_udf(", ".join(f"c{i} string" for i in range(len(texts))))
    def summed(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for columns in batches:
            # One column comes by itself.
            columns = columns if isinstance(columns, tuple) else (columns,)
            # Equal texts of a batch are hashed once.
            different = list(dict.fromkeys(t for column in columns for t in column))
            known = dict(zip(different, fingerprint_all(different), strict=True))
            yield pd.DataFrame({f"c{i}": [known[t] for t in column] for i, column in enumerate(columns)})

    made = df.withColumn(held, summed(*(F.col(t) for t in texts)))
    return made.withColumns({n: F.col(f"{held}.c{i}") for i, n in enumerate(names)}).drop(held)


@F.pandas_udf(DoubleType())
def likeness(one: pd.Series, other: pd.Series) -> pd.Series:
    """:func:`near` of two columns of fingerprints."""
    return pd.Series([near(a, b) for a, b in zip(one, other)], dtype="float64")


#: Documents that a range of keys holds on average, the most ranges there are, and the
#: keys drawn for each bound, so that ranges differ little in size.
RANGE_ROWS, MOST_RANGES, DRAWN = 256, 1 << 16, 4


def _ranges(df: DataFrame) -> list[int]:
    """Keys that cut the table into ranges of about RANGE_ROWS rows: every DRAWN-th of
    those of the smallest hashes. They are at most MOST_RANGES, so the driver can hold them."""
    keys = df.select("key").where("key is not null")
    many = min(max(keys.count() // RANGE_ROWS, 1), MOST_RANGES) * DRAWN
    chosen = keys.orderBy(F.xxhash64("key"), "key").limit(many)
    return sorted({r["key"] for r in chosen.collect()})[::DRAWN]


def _range_of(key: Column, bounds: list[int]) -> Column:
    """How many bounds are not above the key, found in two steps. A null key is in the first range."""
    step = max(int(len(bounds) ** 0.5), 1)
    # Each list is one literal, not an expression an item.
    every, coarse = (F.lit(np.array(x, dtype=np.int64)) for x in (bounds, bounds[::step]))
    block = F.size(F.filter(coarse, lambda b: b <= key))
    inside = F.size(F.filter(F.slice(every, F.greatest(block - 1, F.lit(0)) * step + 1, step), lambda b: b <= key))
    return F.when(key.isNull() | (block == 0), 0).otherwise((block - 1) * step + inside)


def with_next(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``text`` and ``next_text``, the text of the next row by key, for the last
    row that of the first. Equal keys are ordered by the text's digest; null keys first,
    null texts are empty. Keys are whole numbers; a column of another type is refused.

    Texts are shuffled once, by ranges of keys; the first row of a range is also sent to
    the range before it.
    """
    if not isinstance(df.schema[key].dataType, IntegralType):
        raise TypeError(f"{key} is no column of whole numbers")
    rows = df.select(df[key].cast("long").alias("key"), text_or_empty(df[text].cast("string")).alias("text"))
    rows = rows.withColumn("tie", F.sha2("text", 256))
    bounds = _ranges(rows)
    rows = rows.withColumn("range", _range_of(F.col("key"), bounds))
    # The first row of each range: that of a bound; of the first range, the first of all.
    first = rows.groupBy("range").agg(F.min(F.struct(F.col("key").isNotNull().alias("has"), "key", "tie")).alias("f")).select("range", "f.*").collect()
    if not first:
        return rows.select(F.col("key").alias(key), F.col("text").alias("text"), F.col("text").alias("next_text"))
    first.sort(key=lambda r: r["range"])
    before = {r["range"]: first[i - 1]["range"] for i, r in enumerate(first)}
    heads = df.sparkSession.createDataFrame(
        [(r["range"], r["key"], r["tie"], before[r["range"]], i == 0) for i, r in enumerate(first)],
        "range int, head_key long, head_tie string, sent_to int, wraps boolean",
    )
    # At most MOST_RANGES + 1 rows of fixed size: that is the bound of this broadcast.
    known = rows.join(F.broadcast(heads), "range")
    is_head = F.col("key").eqNullSafe(F.col("head_key")) & (F.col("tie") == F.col("head_tie"))
    own = F.struct("range", F.lit(0).alias("late"), F.lit(False).alias("sent"))
    sent = F.struct(F.col("sent_to").alias("range"), F.lit(1).alias("late"), F.lit(True).alias("sent"))
    spread = known.select("key", "text", "tie", F.explode(F.when(is_head, F.array(own, sent)).otherwise(F.array(own))).alias("r"))
    order = Window.partitionBy("r.range").orderBy("r.late", F.col("key").isNotNull(), "key", "tie")
    following = spread.withColumn("next_text", F.lead("text").over(order))
    return following.where("not r.sent").select(F.col("key").alias(key), "text", "next_text")


def edited(text: Column, other: Column) -> Column:
    """``text`` with its last half (rounded down, in code points) replaced by as many of
    the first code points of ``other``, or all if it has fewer."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half))
