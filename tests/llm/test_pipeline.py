import re

import pytest
from test_jaccard_join import brute

import corpus_pipeline
from tierline.llm.jaccard_join import first_of_groups

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, taken string"


def _leaking(docs, items):
    def shingles(text):
        words = [w for w in re.findall(r"[^\W_]+", (text or "").lower())]
        return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()

    tests = [s for s in (shingles(t) for t in items) if s]
    out = set()
    for key, text in docs:
        held = shingles(text)
        if any(100 * len(s & held) >= 75 * len(s) for s in tests):
            out.add(key)
    return out


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    everything = {r["doc_id"]: r for r in docs.collect()}
    items = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    (_, languages), (_, near), (_, leaks), (_, mixture) = corpus_pipeline.STAGES

    after = corpus_pipeline.stage(languages(spark, docs, SF_DIR))
    assert after.columns == docs.columns
    left = {r["doc_id"]: r["text"] for r in after.collect()}
    assert all(re.search(r"[^\W\d_]", t) for t in left.values())
    assert len(left) >= 0.995 * len(everything)

    after = corpus_pipeline.stage(near(spark, after, SF_DIR))
    groups = brute(sorted(left.items()))
    kept = {c for _, _, n, c in groups if n} | {k for _, k, n, _ in groups if not n}
    rows = after.collect()
    assert after.columns == docs.columns and sorted(r["doc_id"] for r in rows) == sorted(kept)

    after = corpus_pipeline.stage(leaks(spark, after, SF_DIR))
    leaking = _leaking([(r["doc_id"], r["text"]) for r in rows], items)
    assert leaking and after.columns == docs.columns
    rows = after.collect()
    assert {r["doc_id"] for r in rows} == kept - leaking

    mixed = mixture(spark, after, SF_DIR).collect()
    sizes = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in rows}
    assert all(r["size"] == sizes[r["doc_id"]] and r["taken"] in (r["size"], 2 * r["size"]) for r in mixed)
    assert sum(r["taken"] for r in mixed) == pytest.approx(1.5 * sum(sizes.values()), abs=max(sizes.values()))


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    text = "the cat of the house and the dog of the house were here"
    docs = [
        (1, text, "en", "a", 5, "s", "t"),
        (1, text, "en", "a", 5, "s", "t"),
        (2, text.upper() + " " * 9, "en", None, 5, "s", "t"),
        (None, text, "en", "b", None, None, None),
        (3, None, "en", "b", 0, "s", "t"),
        (4, "", None, "b", 0, "s", "t"),
        (5, "12 34 !", "en", "b", 0, "s", "t"),
        (6, "le chat de la maison et le chien de la rue sont ici", "fr", "b", 0, "s", "t"),
        (None, "la rue de la maison est ici et la porte de la rue", "fr", None, 0, "s", "t"),
        (7, "the " * 200_000 + "end of the story", "en", "c", 0, "s", "t"),
        (8, "here is the leaked test item of the house: What of the cat and the dog?", "en", "c", 0, "s", "t"),
    ]
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "what of the cat, and the dog"), (2, None), (None, ""), (3, "x")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_odd_rows(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    kept = [docs]
    for _, function in corpus_pipeline.STAGES:
        kept.append(corpus_pipeline.stage(function(spark, kept[-1], odd)))
    assert all(k.columns == docs.columns for k in kept[:-1])
    ids = [sorted((r["doc_id"] or 0) for r in k.collect()) for k in kept]
    assert ids[1] == [0, 0, 1, 1, 2, 6, 7, 8]
    assert ids[2] == [0, 1, 6, 7, 8]
    assert ids[3] == [0, 1, 6, 7]
    assert sorted(r["doc_id"] or 0 for r in corpus_pipeline.run(spark, odd).collect()) == ids[4]


def test_empty_tables(spark, odd, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{odd}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_repeated_rows_of_one_key(spark):
    rows = [(1, "a b c d e f g", "x"), (1, "a b c d e f g", "y"), (1, "other words than those before it", "x"), (2, "A b c d e f g", "x"), (None, "", "x"), (None, "", "x")]
    out = first_of_groups(spark.createDataFrame(rows, "doc_id long, text string, version string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"][:3]) for r in out) == [(0, ""), (0, ""), (1, "a b"), (1, "oth")]


@pytest.mark.parametrize("count", [1, 2, 3, 4])
def test_no_evidence_is_no_language_however_many_are_learned(spark, count):
    known = {"en": "the house and the garden of the king", "de": "das Haus und der Garten des Königs", "es": "la casa y el jardín del rey", "fr": "la maison et le jardin du roi"}
    rows = [(i * 10 + j, text, lang) for i, (lang, text) in enumerate(list(known.items())[:count]) for j in range(3)]
    rows += [(900, "漢字 かな 漢字", None), (901, "12 34", None), (902, None, None)]
    kept = corpus_pipeline.languages(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [r[0] for r in rows if r[0] < 900]
