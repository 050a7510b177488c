import hashlib
import random

import pytest

from tierline.llm import fingerprint as fp
from tierline.llm.queries import op2_fingerprint


def test_order_insertion_and_deletion():
    a, b, c = "one two three four", "five six", "seven\teight nine"
    assert fp.fingerprint(f"{a}\n{b}\n\n {c} ") == fp.fingerprint(f"{c}\n{a}\n{b}") != fp.fingerprint(f"{a}\n{b}")
    assert fp.fingerprint(f"{a}\n{a}") != fp.fingerprint(a)
    both = fp.combine(fp.fingerprint(a), fp.fingerprint(b))
    assert both == fp.fingerprint(f"{a}\n{b}") and fp.combine(both, fp.fingerprint(a), -1) == fp.fingerprint(b)
    nothing = fp.fingerprint(None)
    assert nothing == fp.fingerprint(" \n ") and set(nothing) == {"0"} and fp.near(nothing, nothing) == 1.0 and fp.near(nothing, both) == 0.0


def test_sums_of_paragraph_vectors():
    random.seed(2)
    words = ["a", "bc", "dé", "e", "\x0b", "漢字"]
    texts = [None, "", "x"] + ["\n".join(" ".join(random.choices(words, k=random.randint(0, 7))) for _ in range(random.randint(0, 5))) for _ in range(60)]
    texts.append(" ".join(random.choices(words, k=400_000)))
    for text, got in zip(texts, fp.fingerprint_all(texts), strict=True):
        total = fp.fingerprint(None)
        for paragraph in fp.paragraphs(text):
            total = fp.combine(total, fp.fingerprint(paragraph))
        assert got == total


def test_likeness_of_a_line_repeated_very_often(spark):
    whole, half = (fp.fingerprint("again\n" * n) for n in (40_000, 20_000))
    assert fp.near(whole, half) == pytest.approx(1) and fp.combine(half, half) == whole and fp.combine(whole, half, -1) == half
    rows = [(1, "again\n" * 40_000), (2, "again\n" * 39_000 + "something else altogether"), (3, "x y z")]
    documents = fp.with_next(spark.createDataFrame(rows, "doc_id long, text string"))
    edited = documents.withColumn("edited", fp.edited(fp.F.col("text"), fp.F.col("next_text")))
    summed = fp.fingerprints(edited, "text", "edited", "next_text")
    near = summed.select("doc_id", fp.likeness("text_fingerprint", "edited_fingerprint").alias("e"), fp.likeness("text_fingerprint", "next_text_fingerprint").alias("n"))
    got = {r["doc_id"]: r for r in near.collect()}
    assert got[1]["e"] > 0.99 and got[1]["n"] > 0.99 and got[2]["e"] > 0.99


def _brute(rows):
    rows = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(r[1].encode()).hexdigest()))
    for i, (k, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        yield k, len(t), hashlib.sha256((t[: len(t) - half] + nxt[:half]).encode()).hexdigest(), t, nxt


@pytest.mark.parametrize("range_rows", [1, 3, 2048])
def test_next_document(spark, monkeypatch, range_rows):
    monkeypatch.setattr(fp, "RANGE_ROWS", range_rows)
    random.seed(range_rows)
    rows = [(random.choice([None, *range(-50, 3000, 7)]), random.choice([None, "", "é😀x" * random.randint(1, 9), "ab"])) for _ in range(150)]
    df = spark.createDataFrame([(k, t, 0, "x") for k, t in rows], "doc_id long, text string, range int, tie string")
    out = fp.with_next(df).withColumn("edited", fp.edited(fp.F.col("text"), fp.F.col("next_text"))).collect()
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["text"], hashlib.sha256(r["edited"].encode()).hexdigest()) for r in out)
    assert got == sorted((k is not None, k or 0, t, sha) for k, _, sha, t, _ in _brute(rows))


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = op2_fingerprint(spark, sf_dir).collect()
    want = {k: (n, sha, t, nxt) for k, n, sha, t, nxt in _brute(docs.items())}
    assert len(out) == len(docs)
    far = [r for r in out if want[r["doc_id"]][2] != want[r["doc_id"]][3]]
    for r in out:
        n, sha, text, nxt = want[r["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"]) == (n, sha, fp.fingerprint(text))
        assert r["near_next"] == pytest.approx(fp.near(r["fingerprint"], fp.fingerprint(nxt)))
        assert 0 <= r["near_edited"] <= 1
    close = sum(r["near_edited"] > r["near_next"] for r in far)
    assert close >= 0.98 * len(far), close / len(far)
    print(sum(r["near_edited"] for r in far) / len(far), sum(r["near_next"] for r in far) / len(far))


def test_one_and_no_document(spark):
    assert [tuple(r) for r in fp.with_next(spark.createDataFrame([(1, "ab")], "doc_id long, text string")).collect()] == [(1, "ab", "ab")]
    assert fp.with_next(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_clashing_names_are_kept_and_text_keys_refused(spark):
    df = spark.createDataFrame([(1, "a b c d", "own", "old")], "doc_id long, text string, summed_ string, text_fingerprint string")
    row = fp.fingerprints(df, "text").first()
    assert row["summed_"] == "own" and row["text_fingerprint"] == fp.fingerprint("a b c d")
    with pytest.raises(TypeError, match="whole numbers"):
        fp.with_next(spark.createDataFrame([("x", "t")], "doc_id string, text string"))


def test_fingerprints_equal_sums_by_hand():
    """Identity lanes as sums of the lines' hashes, without the module's own arithmetic."""
    text = "one line of it\n\n  one line of it\nanother"
    lanes = [0] * fp.IDENTITY_LANES
    for line in ("one line of it", "one line of it", "another"):
        digest = hashlib.shake_128(line.encode()).digest(4 * len(lanes))
        for i in range(len(lanes)):
            lanes[i] = (lanes[i] + int.from_bytes(digest[4 * i : 4 * i + 4], "little")) % 2**32
    assert fp.fingerprint(text).startswith("".join(x.to_bytes(4, "little").hex() for x in lanes))
