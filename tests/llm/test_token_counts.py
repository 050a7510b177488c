import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tierline.llm.queries import TOKEN_LIMIT, op8_token_counts
from tierline.llm import token_counts
from tierline.llm.token_counts import PrefixCounter, fitting_prefix, prefix_counts, unpack

PATH = public_tokenizers.path("byte_bpe_50k.json")
BITS = ["a", "'re", "'ll", "'s", " ", "  ", "\n", "\t", "é", "ß", "漢", "😀", "<|endoftext|>", "<|", "the", "12", "!!", "'", " 've", "====", "\x85", "thonerent"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_every_prefix_equals_the_library(library):
    random.seed(5)
    counter = PrefixCounter(open(PATH, "rb").read())
    for _ in range(400):
        text = "".join(random.choices(BITS, k=random.randint(0, 12)))
        want = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
        assert counter.prefixes(text).tolist() == want, text
        assert counter.totals([text]) == want[-1:]


def test_documents_equal_the_library(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    for row in prefix_counts(docs, PATH).collect():
        text = texts[row["doc_id"]]
        assert row["n_tokens"] == len(library.encode(text, add_special_tokens=False).ids) == unpack(row["prefix_tokens"])[-1]
        assert row["n_bytes"] == len(text.encode())


def test_budget(spark, library):
    text = "Then the thonerent, once  more!\n\nIt isn't 1234 they're."
    row = prefix_counts(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH).first()
    for budget in range(12):
        fits = [k for k in range(len(text) + 1) if len(library.encode(text[:k], add_special_tokens=False).ids) <= budget]
        assert fitting_prefix(row["prefix_tokens"], budget) == max(fits)


def test_nulls_repeats_long_texts_and_clashing_columns(spark):
    long = "=" * 50_000 + " the" * 100_000
    rows = [(None, None, 1, "k"), (1, "", 1, "k"), (2, "a b", 1, "k"), (2, "a b", 1, "k"), (3, long, 1, "k")]
    out = prefix_counts(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, key string"), PATH).collect()
    assert sorted((r["doc_id"] or 0, r["n_bytes"]) for r in out) == [(0, 0), (1, 0), (2, 3), (2, 3), (3, len(long))]
    want = len(Tokenizer.from_file(PATH).encode(long, add_special_tokens=False).ids)
    assert [r["n_tokens"] for r in out if r["doc_id"] == 3] == [want]
    empty = prefix_counts(spark.createDataFrame([], "doc_id long, text string"), PATH)
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_bytes", "n_tokens", "prefix_tokens"]


def test_query_stores_every_prefix_and_the_cut_at_the_limit(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = op8_token_counts(spark, sf_dir).collect()
    assert len(out) == len(texts)

    def tokens(text):
        return len(library.encode(text, add_special_tokens=False).ids)

    for r in out:
        text, counts = texts[r["doc_id"]] or "", unpack(r["prefix_tokens"])
        assert len(counts) == len(text) + 1 and counts[-1] == r["n_tokens"] == tokens(text)
        assert r["over_limit"] == (r["n_tokens"] > TOKEN_LIMIT) == (r["fitting_chars"] < len(text))
        assert tokens(text[: r["fitting_chars"]]) <= TOKEN_LIMIT
        if r["over_limit"]:
            assert tokens(text[: r["fitting_chars"] + 1]) > TOKEN_LIMIT


def test_units_in_context_equal_the_library(library):
    random.seed(6)
    counter = PrefixCounter(open(PATH, "rb").read())
    bits = [" ", "  ", "\n", "\r\n", "\t", "\x1c", "\u3000", "'", "''", "'ll", "'re", "'d", "ve", "!", "x", "the", "9", "é", "漢字", "\u0301", "<|endoftext|>"]
    texts = ["".join(random.choices(bits, k=random.randint(0, 10))) for _ in range(400)]
    for text, steps in zip(texts, counter.all_steps(texts), strict=True):
        want = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
        assert [0, *steps.cumsum().tolist()] == want, repr(text)


def test_other_vocabularies_are_refused(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError, match="normalizer, pre_tokenizer"):
        prefix_counts(df, public_tokenizers.path("word_bpe_49k.json"))


def test_narrow_texts_have_the_same_units():
    random.seed(7)
    counter = PrefixCounter(open(PATH, "rb").read())
    narrow = [chr(i) for i in range(256)]
    texts = [a + b for a in narrow for b in narrow]
    texts += ["".join(random.choices([*narrow, " ", " ", "'", "'s", "'re", "\n"], k=12)) for _ in range(5000)]
    for text in texts:
        assert counter._units_of(text) == counter.unit.findall(text), repr(text)
    assert counter._units_of("a é\u0153 \u2160") == ["a", " é\u0153", " \u2160"]


def test_texts_are_split_once(monkeypatch):
    counter, split = PrefixCounter(open(PATH, "rb").read()), []

    class Counted:
        def __init__(self, pattern):
            self.pattern = pattern

        def findall(self, text):
            split.append(text)
            return self.pattern.findall(text)

        def finditer(self, text):
            split.append(text)
            return self.pattern.finditer(text)

    for name in ("unit", "latin_unit"):
        monkeypatch.setattr(counter, name, Counted(getattr(counter, name)), raising=False)
    texts = ["the word", "漢字 the", "", "x" * 50]
    want = [list(counter.prefixes(t)) for t in texts]
    split.clear()
    assert [[0, *s.cumsum().tolist()] for s in counter.all_steps(texts)] == want
    assert split == texts
    # Texts held together are bounded; one that is too long is not held as a list.
    monkeypatch.setattr(token_counts, "LONG_TEXT", 9)
    split.clear()
    assert [[0, *s.cumsum().tolist()] for s in counter.all_steps(texts)] == want
    assert split == texts
