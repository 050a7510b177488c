import random

import pytest
from pyspark.sql import functions as F

from tierline.llm import mixing
from tierline.llm.mixing import mix

SCHEMA = "doc_id long, text string, source string"


def _targets(words, weights=(5, 2, 1), share=1.5, repeats=2):
    """Share by weight, hand the excess over the caps to the others, until none is above."""
    names = sorted(words, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, budget, full = set(names), share * sum(words.values()), {}
    while left:
        per = (budget - sum(full.values())) / sum(weight[s] for s in left)
        above = {s for s in left if per * weight[s] > repeats * words[s]}
        if not above:
            return full | {s: per * weight[s] for s in left}
        full |= {s: repeats * words[s] for s in above}
        left -= above
    return full


@pytest.mark.parametrize(("seed", "slice_rows"), [(1, 8192), (2, 50), (3, 7)])
def test_targets_and_words_taken(spark, monkeypatch, seed, slice_rows):
    monkeypatch.setattr(mixing, "SLICE_ROWS", slice_rows)
    rng = random.Random(seed)
    sources = ["hot"] * 9 + ["a", "b", "é", "Z", "", None, "tiny"]
    docs = [(i, "w " * rng.choice([0, 1, 5, 20, 60]), rng.choice(sources)) for i in range(1500)] + [(5000, "x", "alone"), (5001, "", "none")]
    df = spark.createDataFrame(docs, SCHEMA)
    rows = mix(df).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(d[0] for d in docs)
    words = {}
    for _, text, source in docs:
        words[source] = words.get(source, 0) + len(text.split())
    want = _targets(words)
    for source in words:
        mine = [r for r in rows if r["source"] == source]
        assert all(r["source_size"] == words[source] and r["target"] == pytest.approx(want[source]) for r in mine)
        assert abs(sum(r["taken"] for r in mine) - want[source]) <= 60 + 1
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in rows)
    assert sum(r["taken"] for r in rows) == pytest.approx(1.5 * sum(words.values()), abs=30)
    again = {r["doc_id"]: r["taken"] for r in mix(df.orderBy("text").repartition(5)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}


def test_nulls_repeats_long_texts_and_clashing_columns(spark):
    rows = [(None, None, None, 1, "x"), (1, "a b", "s", 1, "x"), (1, "a b", "s", 1, "x"), (2, "a " * 500_000, "t", 1, "x")]
    out = mix(spark.createDataFrame(rows, SCHEMA + ", size int, queue string")).collect()
    assert sorted((r["doc_id"] or 0, r["size"]) for r in out) == [(0, 0), (1, 2), (1, 2), (2, 500_000)]
    assert sum(r["taken"] for r in out) in (500_000 * 1, 500_004, 500_008, 1_000_000, 1_000_008)
    assert mix(spark.createDataFrame([], SCHEMA)).count() == 0
    assert [r["taken"] for r in mix(spark.createDataFrame([(1, "", "s"), (2, None, "s")], SCHEMA)).collect()] == [0, 0]


@pytest.mark.parametrize("bits", [0, 1, 3, 10])
def test_sums_before_are_those_of_one_level(spark, monkeypatch, bits):
    monkeypatch.setattr(mixing, "BLOCK_BITS", bits)
    rng = random.Random(bits)
    rows = [(k, at, rng.randint(0, 9)) for k in "ab" for at in rng.sample(range(200), 60)]
    df = spark.createDataFrame(rows, "k string, at long, n long")
    got = {(r["k"], r["at"]): r["before"] for r in mixing._before(df, ["k"], "at", "n").collect()}
    assert got == {(k, at): sum(n for j, b, n in rows if j == k and b < at) for k, at, _ in rows}
    whole = df.groupBy("at").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n")
    got = {r["at"]: r["before"] for r in mixing._before(whole, [], "at", "n").collect()}
    assert got == {at: sum(n for _, b, n in rows if b < at) for _, at, _ in rows}


def test_only_blocks_are_added_up_in_one_task(spark):
    df = spark.range(5000).select(F.col("id").alias("at"), F.lit(1).alias("n"))
    plan = mixing._before(df, [], "at", "n")._jdf.queryExecution().optimizedPlan().toString()
    # One window over blocks, one over places that is cut by block.
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2 and all("windowspecdefinition(block#" in line for line in windows), plan
