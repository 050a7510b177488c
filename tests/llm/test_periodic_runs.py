import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierline.llm.periodic_runs import collapse, find, kept_words, segments, with_planted
from tierline.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"


def _brute(words, least=6, repeats=4):
    """Every lag over the whole text, and the smallest period of every stretch it finds."""
    n, out = len(words), []
    for q in range(1, n):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            part = words[i : i + length]
            smaller = any(all(part[k] == part[k + p] for k in range(length - p)) for p in range(1, q))
            if length >= max(least, repeats * q) and not smaller:
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def _texts(seed):
    rng = random.Random(seed)
    for size in (0, 1, 5, 6, 7, 12, 40, 90):
        for letters in ("a", "ab", "abc", "abcdefghij"):
            yield [rng.choice(letters) for _ in range(size)]
    for _ in range(40):
        words = []
        while len(words) < 120:
            part = [rng.choice("abcde") for _ in range(rng.randint(1, 9))]
            words += part * rng.randint(1, 7) + part[: rng.randint(0, len(part))]
            words += [str(rng.random()) for _ in range(rng.randint(0, 2))]
        yield words


@pytest.mark.parametrize("seed", range(6))
def test_equals_brute_force(seed):
    found = 0
    for words in _texts(seed):
        want = _brute(words)
        assert find(words) == want
        found += len(want)
    assert found > 50


@pytest.mark.parametrize(("least", "repeats"), [(3, 3), (10, 3), (6, 5), (30, 4)])
def test_other_limits(least, repeats):
    for words in _texts(9):
        assert find(words, least, repeats) == _brute(words, least, repeats)


def test_nested_periods_and_powers():
    # Fibonacci and Thue-Morse words, and a run whose period is itself nearly periodic.
    a, b = "x", "xy"
    for _ in range(9):
        a, b = b, b + a
    words = ["x"]
    for _ in range(7):
        words += ["y" if w == "x" else "x" for w in words]
    inner = list("aaaaaaab") * 5 + list("aaaaaaaa")
    for text in (list(b), words, inner, inner * 4, list("ab" * 20 + "ba" * 20), ["a"] * 300):
        assert find(text) == _brute(text)


def test_splitting_recurses():
    # "b" comes four times, but twice on each side of the word that splits.
    words = list("abab") + ["once"] + list("baba") + list("cccccc")
    codes = np.array([ord(w[0]) for w in words])
    assert list(segments(codes)) == [(9, 15)]
    assert find(words) == [(9, 6, 1)]


def test_long_texts():
    assert find(["a"] * 200_000) == [(0, 200_000, 1)]
    words = [str(i) for i in range(30_000)]
    assert find(words * 5 + ["0"]) == [(0, 150_001, 30_000)]
    rng = random.Random(4)
    noise = [rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000)]
    found = find(noise + words[:7_000] * 4)
    assert (20_000, 28_000, 7_000) in found


def _rows(docs):
    """The query's rows by the definition, word by word."""
    out = {}
    for key, text in docs:
        words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
        n, h = len(words), zlib.crc32(str(key).encode())
        g = h // 10
        if h % 10 == 0 and n:
            first = g % n
            period = 1 + (n - first) // (3 + g % 8)
            words = [w if i < first else words[first + (i - first) % period] for i, w in enumerate(words)]
        runs = _brute(words)
        gone = {i for s, length, p in runs for i in range(s + p, s + length)}
        most = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
        lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        milli = most[0] if most[0] is None else 1000 * most[1] // most[2]
        out[key] = (len(runs), *most, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(7)
    docs = [(i, " ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 60)))) for i in range(200)]
    docs += [(200 + i, "\t".join(f"w{rng.randint(0, 99)}" for _ in range(100)) + "\n") for i in range(100)]
    docs += [(300, None), (301, ""), (302, " \n"), (303, "x y " * 8), (304, "é\x1cü " * 9)]
    spark.createDataFrame(docs, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op12_periodic_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = _rows(docs)
    assert sum(1 for key, _ in docs if zlib.crc32(str(key).encode()) % 10 == 0) > 10
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(None, "a a a a a a", 1, "x"), (1, "a a a a a a b", 1, "x"), (1, "a a a a a a b", 1, "x"), (2, None, None, None)]
    out = collapse(spark.createDataFrame(rows, SCHEMA + ", runs int, words string")).collect()
    assert sorted((r["doc_id"] or 0, r["collapsed"], len(r["runs"])) for r in out) == [(0, "a", 1), (1, "a b", 1), (1, "a b", 1), (2, "", 0)]
    assert [r["strongest"] for r in out if r["doc_id"] == 2] == [None]
    empty = spark.createDataFrame([], SCHEMA)
    assert collapse(empty).count() == 0
    assert kept_words([], []) == []
    nulls = spark.createDataFrame([(None, "a b c d e f g h i j")], SCHEMA)
    assert nulls.select(with_planted(F.col("text"), F.col("doc_id"))).count() == 1
