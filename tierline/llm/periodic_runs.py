"""Periodic runs of words, found by splitting at rare words and scanning at lags.

A run of period q is a stretch in which words q apart are equal; it qualifies with a length
of at least ``least`` and ``repeats`` periods. Each of its words then comes ``repeats`` times
or more within it. So a word that comes less often in a segment lies in no run there, and
splits it; the pieces are split by their own counts, until nothing is left to split.

What survives is scanned at each lag q up to a ``repeats``-th of its length, smallest first.
A run of lag q holds some equal words at multiples of q, one behind the other, so only these
are compared, n / q of them; where they agree the stretch is extended word by word. One
that lies inside a shorter-period run already found has that smaller period, and is none.
"""

import re
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import WORD_PATTERN, python_tasks

LEAST, REPEATS = 6, 4

_WORDS = re.compile(WORD_PATTERN)

#: A run: number of its first word, words, period.
Run = tuple[int, int, int]


def segments(codes: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> Iterator[tuple[int, int]]:
    """The segments (first, behind the last) in which every word comes often enough."""
    waiting = [(0, len(codes))]
    while waiting:
        lo, hi = waiting.pop()
        if hi - lo < least:
            continue
        _, place, count = np.unique(codes[lo:hi], return_inverse=True, return_counts=True)
        rare = np.flatnonzero((count < repeats)[place])
        if not len(rare):
            yield lo, hi
            continue
        bounds = np.concatenate([[-1], rare, [hi - lo]])
        for i in np.flatnonzero(np.diff(bounds) > least):
            waiting.append((lo + int(bounds[i]) + 1, lo + int(bounds[i + 1])))


def _equal_words(codes: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many words in a row, from ``at`` on in direction ``step``, equal the one ``lag``
    behind them. Looked at in stretches that double, so it costs what it finds."""
    found, size = 0, 32
    while True:
        if step > 0:
            ahead = codes[at + found : at + found + size]
            other = codes[at + found + lag : at + found + lag + size]
            ahead = ahead[: len(other)]
        else:
            stop = at + 1 - found
            start = max(stop - size, 0)
            ahead, other = codes[start:stop][::-1], codes[start + lag : stop + lag][::-1]
        differ = ahead != other
        if differ.any():
            return found + int(differ.argmax())
        found += len(ahead)
        if len(ahead) < size:
            return found
        size *= 2


def _scan(codes: np.ndarray, least: int, repeats: int) -> list[Run]:
    """All runs of one segment."""
    n = len(codes)
    runs: list[Run] = []
    # The farthest end of a run, found so far, that holds each word.
    reach = np.zeros(n, dtype=np.int64)
    for lag in range(1, max(n // repeats, 1) + 1):
        shortest = max(least, repeats * lag)
        if shortest > n:
            break
        # A run's first ``shortest - lag`` words equal those a lag behind; so many of them
        # stand at multiples of the lag.
        marks = (shortest - lag) // lag
        sampled = codes[::lag]
        same = sampled[1:] == sampled[:-1]
        places = len(same) - marks + 1
        agree = same[:places].copy()
        for i in range(1, marks):
            agree &= same[i : places + i]
        if not agree.any():
            continue
        marked = np.flatnonzero(agree) * lag
        # Those inside a run of a smaller period belong to no run of this one.
        marked = marked[reach[marked] <= marked + marks * lag]
        done = 0
        for at in marked.tolist():
            if at < done:
                continue
            start = at - _equal_words(codes, at - 1, lag, -1) if at else 0
            done = at + _equal_words(codes, at, lag, 1)
            end = done + lag
            if end - start >= shortest and reach[start] < end:
                runs.append((start, end - start, lag))
                np.maximum(reach[start:end], end, out=reach[start:end])
    return runs


def find(words: list[str], least: int = LEAST, repeats: int = REPEATS) -> list[Run]:
    """All runs by start, then period: stretches of smallest period q that no neighbouring
    word extends, of at least ``least`` words and ``repeats`` periods (3 or more)."""
    if repeats < 3 or least < repeats:
        raise ValueError("a run has three periods or more, and a word in each")
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    codes = np.fromiter(map(number.__getitem__, words), dtype=np.int32, count=len(words))
    return sorted(((lo + start, length, period) for lo, hi in segments(codes, least, repeats) for start, length, period in _scan(codes[lo:hi], least, repeats)), key=lambda r: (r[0], r[2]))


def kept_words(words: list[str], runs: list[Run]) -> list[str]:
    """The words without the repetitions: of each run only the first period stays."""
    if not runs:
        return words
    kept = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [w for w, k in zip(words, kept.tolist(), strict=True) if k]


def _strongest(runs: list[Run]) -> Run | None:
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def collapse(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, repeats: int = REPEATS) -> DataFrame:
    """One row per input row: ``key``, ``runs`` (array of ``start``, ``length``, ``period``,
    in words, by start, then period), ``strongest`` (the run with the most periods; ties:
    smallest start, then period; null if there is none) and ``collapsed``, the words that no
    run repeats, joined by one space.

    Words are separated by ASCII white space. A null or empty text has no word and no run. A
    null key is a key; repeated rows are treated alike; texts of any length are searched
    whole; other columns are left out; an empty table gives an empty one.
    """
    python_tasks(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    names = ("start", "length", "period")

    def searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            runs, strongest, collapsed = [], [], []
            for content in batch["text"]:
                words = _WORDS.findall(content or "")
                found = find(words, least, repeats)
                most = _strongest(found)
                runs.append([dict(zip(names, r)) for r in found])
                strongest.append(most and dict(zip(names, most)))
                collapsed.append(" ".join(kept_words(words, found)))
            yield pd.DataFrame({"key": batch["key"], "runs": runs, "strongest": strongest, "collapsed": collapsed})

    run = "struct<start: long, length: long, period: long>"
    picked = df.select(df[key].alias("key"), df[text].cast("string").alias("text"))
    return picked.mapInPandas(searched, f"key {kind}, runs array<{run}>, strongest {run}, collapsed string").withColumnRenamed("key", key)


def with_planted(text: Column, key: Column) -> Column:
    """The text of about a tenth of the keys (those whose CRC-32 ends in 0) with a periodic
    tail: from some word on, the words of one period over and over. The others as they are."""
    digest = F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    more = F.floor(digest / 10)

    def planted(words: Column) -> Column:
        n = F.size(words)
        first = more % n
        period = 1 + F.floor((n - first) / (3 + more % 8))
        # A lambda's variables are computed once, not once a word.
        at = F.transform(F.array(F.struct(n.alias("n"), first.alias("a"), period.alias("p"))), lambda s: F.transform(
            F.sequence(F.lit(0), s["n"] - 1), lambda i: F.when(i < s["a"], i).otherwise(s["a"] + (i - s["a"]) % s["p"]).cast("int")
        ))[0]
        return F.array_join(F.transform(at, lambda i: F.get(words, i)), " ")

    words = F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))
    tail = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, planted(w)))[0]
    return F.when(digest % 10 == 0, F.coalesce(tail, text)).otherwise(text)
