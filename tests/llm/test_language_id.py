import math
import random
import zlib
from collections import Counter

import pytest
import regex

from tierline.llm import language_id
from tierline.llm.language_id import Model, identify, train
from tierline.llm.queries import op10_language_id

SCHEMA = "doc_id long, text string, lang string"


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    out = op10_language_id(spark, sf_dir)
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = out.join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 200
    wrong = [r for r in rows if r["lang_pred"] != r["lang"]]
    assert len(wrong) <= 0.03 * len(rows), [(r["doc_id"], r["lang"], r["lang_pred"], r["score"]) for r in wrong]
    assert all(0 <= r["score"] <= 1 for r in rows)


@pytest.fixture(scope="module")
def model(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, None, "fr"), (4, "der hund", None), (5, "the the", "en"), (5, "the the", "en")]
    return train(spark.createDataFrame(rows, SCHEMA))


def test_words_then_shorter_grams(spark, model):
    assert model.languages == ("en", "fr")
    rows = [(1, "THE dog"), (2, "le le"), (3, "chienne"), (4, "thedog"), (5, "1 2 ! ½"), (6, None), (7, ""), (8, "the " * 500_000), (9, "漢")]
    out = {r["doc_id"]: r for r in identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert [out[i]["lang_pred"] for i in range(1, 9)] == ["en", "fr", "fr", "en", "und", "und", "und", "en"]
    assert [out[i]["score"] for i in (5, 6, 7)] == [0.0] * 3 and out[9]["score"] == 0.5


def test_clashing_columns_repeats_and_empty_tables(spark, model):
    df = spark.createDataFrame([(1, "the", 5, "x", "y")] * 2, "doc_id long, text string, score int, c0 string, judged string")
    out = identify(df, model)
    assert out.columns == ["doc_id", "text", "c0", "judged", "lang_pred", "score"]
    assert [(r["c0"], r["judged"], r["lang_pred"]) for r in out.collect()] == [("x", "y", "en")] * 2
    empty = spark.createDataFrame([], SCHEMA)
    assert train(empty) == Model((), {}, {})
    assert identify(empty, model).count() == 0
    assert identify(df, Model((), {}, {})).first()["lang_pred"] == "und"


def _brute(rows):
    """Language and score of each (key, text, lang) by the definition, from those that may
    be learned from."""
    letters = regex.compile(r"\p{L}[\p{L}\p{M}]*")
    held = {key: zlib.crc32(str(key).encode()) % 4 == 2 for key, _, _ in rows}
    words = {}
    for key, text, lang in {r for r in rows if not held[r[0]] and r[1] is not None and r[2] is not None}:
        words.setdefault(lang, Counter()).update(letters.findall(text.lower()))
    languages = sorted(x for x, found in words.items() if found)
    grams = {x: Counter() for x in languages}
    for x in languages:
        for word, n in words[x].items():
            marked = f"<{word}>"
            for size in range(1, 6):
                for i in range(len(marked) - size + 1):
                    if marked[i : i + size] not in "<>":
                        grams[x][marked[i : i + size]] += n
    word_total = {x: words[x].total() for x in languages}
    gram_total = {(x, size): sum(n for g, n in grams[x].items() if len(g) == size) for x in languages for size in range(1, 6)}

    def logs(item, counts, total):
        found = [math.log((counts[x][item] + 0.1) / (total(x) + 1)) for x in languages]
        return [f - sum(found) / len(found) for f in found]

    def word_score(word, memo={}):
        if word in memo:
            return memo[word]
        out = [0.0] * len(languages)
        if sum(words[x][word] for x in languages) > 1:
            out = logs(word, words, word_total.get)
        else:
            marked = f"<{word}>"
            for size in range(min(5, len(marked)), 0, -1):
                known = [g for g in (marked[i : i + size] for i in range(len(marked) - size + 1)) if any(grams[x][g] for x in languages)]
                if known:
                    each = [logs(g, grams, lambda x: gram_total[x, size]) for g in known]
                    out = [0.8 ** (5 - size) * sum(c) / len(known) for c in zip(*each)]
                    break
        memo[word] = out
        return out

    result = {}
    for key, text, _ in rows:
        found = letters.findall((text or "").lower())
        if not found:
            result[key] = (held[key], "und", 0.0)
            continue
        total = [sum(c) * min(1, 30 / len(found)) for c in zip(*map(word_score, found))]
        odds = [math.exp(t - max(total)) for t in total]
        best = odds.index(max(odds))
        result[key] = (held[key], languages[best], odds[best] / sum(odds))
    return result


def test_every_document_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()]
    want = _brute(rows)
    got = {r["doc_id"]: (r["held_out"], r["lang_pred"], r["score"]) for r in op10_language_id(spark, sf_dir).collect()}
    assert set(got) == set(want)
    assert [k for k in want if got[k][:2] != want[k][:2]] == []
    assert max(abs(got[k][2] - want[k][2]) for k in want) < 1e-4


def test_unseen_words_equal_brute_force(spark, tmp_path):
    """Words of texts that are not learned from, made of pieces of those that are."""
    rng = random.Random(3)
    kinds = {"aa": "bcdea", "bb": "cdefb", "cc": "xyzéß漢"}
    rows = []
    for key in range(400):
        lang = rng.choice(list(kinds))
        words = ["".join(rng.choice(kinds[lang]) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 6))]
        rows.append((key, " ".join(words), lang))
    rows += [(900, None, "aa"), (901, "Q", "bb"), (902, "bcd", None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    want = _brute(rows)
    got = {r["doc_id"]: (r["held_out"], r["lang_pred"], r["score"]) for r in op10_language_id(spark, str(tmp_path)).collect()}
    assert {k: v[:2] for k, v in got.items()} == {k: v[:2] for k, v in want.items()}
    assert max(abs(got[k][2] - want[k][2]) for k in want) < 1e-4
    assert len({v[1] for v in want.values()}) == 4


def test_grams_are_the_pieces_of_words(spark):
    model = train(spark.createDataFrame([(1, "ab abcd", "x")], SCHEMA))
    assert set(model.grams) == {"a", "b", "c", "d", "<a", "ab", "b>", "bc", "cd", "d>", "<ab", "ab>", "abc", "bcd", "cd>", "<ab>", "<abc", "abcd", "bcd>", "<abcd", "abcd>"}


def test_no_language_is_lost_and_the_sample_is_bounded(spark):
    rows = [(1, "le chat et le chien", "fr")] * 9000 + [(i, f"the cat and dog {'x' * (i % 50)}", "en") for i in range(50)]
    assert train(spark.createDataFrame(rows, SCHEMA)).languages == ("en", "fr")
    # One key with many texts, and rows without a key.
    rows = [(7, f"mot{i}", "fr") for i in range(9000)] + [(None, "the word the", "en")]
    df = spark.createDataFrame(rows, SCHEMA)
    sampled = language_id._sample(df, "doc_id", "text", "lang", 100).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in sampled} == {"fr": 100, "en": 1}
    assert train(df, train_rows=100).languages == ("en", "fr")


def test_every_item_of_the_sample_is_kept(spark):
    alphabet = [chr(0x4E00 + i) for i in range(6000)]
    text = " ".join(a + b for a, b in zip(alphabet, alphabet[1:]))
    model = train(spark.createDataFrame([(1, f"{text} {text}", "zh"), (2, "the the", "en")], SCHEMA))
    assert len(model.words) == 6000 and sum(len(g) == 2 for g in model.grams) > 17_000
    assert model.scores.shape == (len(model.words) + len(model.grams), 2) and model.scores.dtype == "float32"
