import random

import pytest

from tierline.llm.decontaminate import contained

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def _shingles(text):
    words = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def _brute(docs, items, percent):
    out = []
    for d, text in docs:
        held = _shingles(text)
        for i, item in items:
            s = _shingles(item)
            if s and 100 * len(s & held) >= percent * len(s):
                out.append((d, i, len(s), len(s & held)))
    return sorted(out, key=str)


@pytest.mark.parametrize("percent", [50, 75, 100])
def test_finds_every_contained_item(spark, percent):
    rng = random.Random(percent)
    words = [f"w{i}" for i in range(40)] + ["É", "don't"]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 5, 8, 20, 60])))) for i in range(30)] + [(90, None), (91, " "), (None, "w1 w2 w3 w4 w5 w6")]
    docs = []
    for d in range(60):
        parts = [w for _ in range(3) for w in rng.choices(words, k=rng.randint(0, 60))]
        copy = [w if rng.random() > rng.choice([0, 0.02, 0.05]) else "zz" for w in (rng.choice(items)[1] or "").split(" ")]
        at = rng.randint(0, len(parts))
        docs.append((d, "\n, ".join(parts[:at] + [w.upper() for w in copy] + parts[at:])))
    docs += [(70, None), (71, ""), (None, "so W1, w2; w3 w4 w5 (w6) on"), (72, items[0][1]), (73, "w9 " * 100_000)]
    out = contained(spark.createDataFrame([(*r, 1, "p") for r in docs], DOCS + ", item int, probe string"), spark.createDataFrame(items, ITEMS), percent)
    got = sorted(((r["doc_id"], r["item_id"], r["n_shingles"], r["matched"]) for r in out.collect()), key=str)
    assert got == _brute(docs, items, percent)
    assert any(r["doc_id"] is None and r["item_id"] is None for r in out.collect())


def test_rows_of_one_key_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "c d e f g"), (1, "c d e f g")], DOCS)
    items = spark.createDataFrame([(1, "a b c d e f g"), (2, "x")], ITEMS)
    assert [tuple(r) for r in contained(docs, items).collect()] == [(1, 1, 3, 3, 1.0)]
    assert contained(docs, items.where("false")).count() == 0
    assert contained(docs.where("false"), items).count() == 0
