import random
import re

import numpy as np
import pytest

from tierline.llm import jaccard_join
from tierline.llm.components import components
from tierline.llm.jaccard_join import linked
from tierline.llm.queries import op9_jaccard_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    words = WORD.findall((text or "").translate(UPPER))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute(docs):
    """(n_shingles, component) of each (key, text), by comparing all that share a shingle."""
    sets = [shingles(t) for _, t in docs]
    above = list(range(len(docs)))

    def root(i):
        while above[i] != i:
            i = above[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        met = {}
        for x in s:
            for j in holders.setdefault(x, []):
                met[j] = met.get(j, 0) + 1
            holders[x].append(i)
        for j, same in met.items():
            if 100 * same >= 75 * (len(s) + len(sets[j]) - same):
                above[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(docs):
        if k is not None:
            least[root(i)] = min(k, least.get(root(i), k))
    return sorted((k is None, k or 0, len(sets[i]), least.get(root(i))) for i, (k, _) in enumerate(docs))


def _result(rows):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in rows)


def _edited(rng, words, share):
    return [w if rng.random() > share else f"new{rng.randint(0, 10**6)}" for w in words]


@pytest.mark.parametrize(("block", "dense", "frequent"), [(512, 8, 32), (4, 8, 3), (3, 0, 3), (16, 1, 2)])
def test_random_clusters(spark, monkeypatch, block, dense, frequent):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "DENSE", dense)
    monkeypatch.setattr(jaccard_join, "LEAST_FREQUENT", frequent)
    rng = random.Random(block)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = rng.choices(vocabulary, k=60)
    docs = []
    for cluster in range(12):
        base = rng.choices(vocabulary, k=rng.choice([3, 8, 30, 120, 400]))
        for _ in range(rng.choice([1, 2, 5, 25])):
            words = _edited(rng, base, rng.choice([0, 0.005, 0.02, 0.04, 0.06]))
            if rng.random() < 0.3:
                words = words + passage
            docs.append(rng.choice([" ", "\n", " \t"]).join(words))
    docs += ["", None, " \n", "One two", "one  TWO", "one two three", "É a b c d e", "é a b c d e"]
    rng.shuffle(docs)
    docs = list(enumerate(docs))
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], "doc_id long, text string, id string, component_id int")
    assert _result(linked(df).collect()) == brute(docs)


def test_documents_equal_brute_force(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert _result(op9_jaccard_join(spark, sf_dir).collect()) == brute(docs)


def test_nulls_repeats_and_empty_tables(spark):
    schema = "doc_id long, text string"
    docs = [(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (7, "x y"), (3, "x Y"), (5, ""), (5, ""), (None, None), (9, "q " * 300_000)]
    assert _result(linked(spark.createDataFrame(docs, schema)).collect()) == _result(
        [{"doc_id": k, "n_shingles": n, "component_id": c} for k, n, c in [(None, 1 * 2, 7), (7, 2, 7), (7, 2, 7), (7, 1, 3), (3, 1, 3), (5, 0, 5), (5, 0, 5), (None, 0, None), (9, 1, 9)]]
    )
    assert linked(spark.createDataFrame([], schema)).count() == 0


def test_tree_finds_every_similar_pair():
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 1 << 63, size=rng.integers(5, 300), dtype=np.uint64)
        for _ in range(rng.integers(1, 6)):
            keep = base[rng.random(len(base)) > rng.choice([0.0, 0.05, 0.2])]
            more = rng.integers(0, 1 << 63, size=int(len(base) * rng.choice([0, 0.05, 0.2])), dtype=np.uint64)
            sets.append(np.unique(np.concatenate([keep, more])))
    sets = [s for s in sets if len(s)]
    x, y, most = jaccard_join._similar(np.array([len(s) for s in sets]), [jaccard_join._bitmap(s) for s in sets], None, 75)
    found = {(min(a, b), max(a, b)): m for a, b, m in zip(x, y, most)}
    assert len(found) == len(x)
    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            same = len(np.intersect1d(sets[i], sets[j]))
            if 100 * same >= 75 * (len(sets[i]) + len(sets[j]) - same):
                assert found[i, j] >= same
    assert len(found) < len(sets) ** 2 / 8


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randint(100, 300), rng.randint(100, 300)) for _ in range(120)] + [(500, 600 + i) for i in range(50)]
    above = {n: n for e in edges for n in e}

    def root(n):
        while above[n] != n:
            n = above[n]
        return n

    for a, b in edges:
        above[max(root(a), root(b))] = min(root(a), root(b))
    out = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {n: root(n) for n in above if root(n) != n}


@pytest.fixture
def blind(monkeypatch):
    """A sketch whose counts have all cancelled out: every shingle is held for rare."""
    monkeypatch.setattr(jaccard_join, "frequency_classes", lambda sketch: np.zeros(len(sketch), dtype=np.int8))
    monkeypatch.setattr(jaccard_join, "FEW_ROWS", 20)


def test_a_frequent_shingle_held_for_rare_meets_in_no_task(spark, monkeypatch, blind):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = rng.choices(vocabulary, k=40)
    docs = [(i, " ".join(passage + rng.choices(vocabulary, k=rng.choice([2, 5, 9, 60])))) for i in range(700)]
    docs += [(2000 + i, "k2467") for i in range(300)] + [(3000 + i, "k2238") for i in range(300)]
    docs += [(4000 + i, " ".join(rng.choices(vocabulary, k=30))) for i in range(300)]
    together = []
    hot = jaccard_join._Join.hot_cells
    monkeypatch.setattr(jaccard_join._Join, "hot_cells", lambda self: together.append((self.profiles, hot(self))) or together[-1][1])
    rows = linked(spark.createDataFrame(docs, "doc_id long, text string").repartition(8)).collect()
    assert _result(rows) == brute(docs)
    profiles, (cells, found) = together[0]
    assert 0 < len(found) <= jaccard_join.PART_SHARE * 8
    rare = [(t % cells, t) for r in profiles.select("rare").collect() for t in r["rare"]]
    left = {}
    for cell, token in rare:
        if cell not in found:
            left[token] = left.get(token, 0) + 1
    assert max(left.values()) <= max(len(rare) // (jaccard_join.PART_SHARE * 8), 20)
    # Equal texts of a task have one row a shingle.
    assert profiles.where("n = 1 and size(rare) > 0").count() <= 2 * 8
