"""Language identification, words first, then ever shorter character n-grams.

A known word is scored by its log frequency in each language. An unseen word falls back
to the longest n-grams of it that are known in any language, from ``MAX_GRAM`` characters
down to one; the word's end marks count as characters.

Training counts words and n-grams with Spark on a bounded sample: ``train_rows`` different
rows of a language at most, those with the smallest hash of key and text. Of the sample
every n-gram is kept, and every word that is there twice; so the model's size depends on the
sampled rows alone. It is one matrix of scores with a row an item, sent to the workers.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import python_tasks, small_side
from tierline.session import stage

UNKNOWN = "und"
MAX_GRAM = 5

#: Weight of an n-gram's evidence against a known word's, per character that it is shorter.
BACKOFF = 0.8

#: A text's evidence counts as that of at most this many words, so that the score of a
#: long text in two languages does not jump to 1.
EVIDENCE_WORDS = 30

#: Words whose score a worker remembers.
MEMO_WORDS = 200_000

#: Times the sample that is ranked to find it.
DRAWN = 2

_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")


@dataclass(frozen=True)
class Model:
    """Rows of ``scores`` by word and by n-gram: log frequencies in each language (in the
    order of ``languages``), less their mean."""

    languages: tuple[str, ...]
    words: dict[str, int]
    grams: dict[str, int]
    scores: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), dtype=np.float32), compare=False)


def _sample(labelled: DataFrame, key: str, text: str, lang: str, train_rows: int) -> DataFrame:
    """``lang`` and ``text`` of at most ``train_rows`` different rows a language."""
    usable = labelled.where(labelled[lang].isNotNull() & labelled[text].isNotNull())
    # A number from 0 to 1 for each different row. Those of a language below a limit that
    # leaves some times the sample are ranked, so that no language's rows all meet in one
    # task; a language with few different rows has a limit above 1.
    whole = usable.select(usable[lang].cast("string").alias("lang"), usable[text].cast("string").alias("text"), usable[key].alias("key"))
    whole = whole.select("lang", "text", F.shiftrightunsigned(F.xxhash64("key", "text"), 1).alias("drawn"))
    part = F.col("drawn") / float(1 << 63)
    limits = whole.groupBy("lang").agg((DRAWN * train_rows / F.approx_count_distinct("drawn")).alias("limit"))
    near = whole.select("lang", "drawn").join(small_side(stage(limits, "limits")), "lang").where(part < F.col("limit"))
    first = Window.partitionBy("lang").orderBy("drawn")
    chosen = near.select("lang", "drawn").distinct().withColumn("n", F.row_number().over(first)).where(F.col("n") <= train_rows)
    # At most train_rows a language are chosen: that is the bound of this broadcast.
    return whole.join(F.broadcast(chosen.select("lang", "drawn")), ["lang", "drawn"], "left_semi").dropDuplicates(["lang", "drawn"]).select("lang", "text")


def train(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", train_rows: int = 1000) -> Model:
    """Fit on a bounded sample of the rows with a language and a text.

    Rows of the same key and text are one row; a null key is a key. Every language that has
    a row is in the sample; one whose sampled texts have no letter is not learned.
    """
    sample = stage(_sample(labelled, key, text, lang, train_rows), "sample")
    words = (
        sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}[\p{L}\p{M}]*"), F.lit(0))).alias("item"))
        .groupBy("lang", "item")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    pieces = F.flatten(F.filter(F.array(*map(_pieces, range(1, MAX_GRAM + 1))), lambda p: p.isNotNull()))
    grams = words.select("lang", F.explode(pieces).alias("item"), "n")
    grams = grams.groupBy("lang", "item").agg(F.sum("n").alias("n"))
    return _scored(_counted(words), _counted(grams))


def _pieces(length: int) -> Column:
    """The n-grams of this length of a marked word; null if it is shorter. An end mark alone
    says nothing: the shortest n-grams are letters."""
    marked = F.concat(F.lit("<"), F.col("item"), F.lit(">"))
    skip = 1 if length == 1 else 0
    places = F.sequence(F.lit(1 + skip), F.length("item") + 3 - length - skip)
    return F.when(F.length("item") + 2 >= length, F.transform(places, lambda i: F.substring(marked, i, F.lit(length))))


def _counted(items: DataFrame) -> pd.DataFrame:
    """The counts of a sample's items, as Arrow columns: their number is bounded by the
    sample's."""
    return items.select("lang", "item", "n").toArrow().to_pandas()


def _scored(words: pd.DataFrame, grams: pd.DataFrame) -> Model:
    """Smoothed log frequencies among all words, and among the n-grams of the same length."""
    languages = tuple(sorted(set(words["lang"])))
    tables, indices, start = [np.zeros((0, len(languages)), dtype=np.float32)], ({}, {}), 0
    groups = [(indices[0], words), *((indices[1], found) for _, found in grams.groupby(grams["item"].str.len()))]
    for index, found in groups if languages else ():
        items = sorted(set(found["item"]))
        place = {item: i for i, item in enumerate(items)}
        counts = np.zeros((len(items), len(languages)))
        counts[found["item"].map(place), found["lang"].map(languages.index)] = found["n"]
        logs = np.log((counts + 0.1) / (counts.sum(axis=0) + 1.0))
        # A word met only once is better judged by its n-grams.
        kept = counts.sum(axis=1) > 1 if index is indices[0] else np.ones(len(items), dtype=bool)
        index.update(zip([item for item, k in zip(items, kept.tolist()) if k], range(start, start + int(kept.sum()))))
        tables.append((logs - logs.mean(axis=1, keepdims=True))[kept].astype(np.float32))
        start += len(tables[-1])
    return Model(languages, *indices, np.concatenate(tables))


class _Words(dict):
    """Row numbers of the words met so far in a matrix of scores."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.rows = np.zeros((MEMO_WORDS, len(model.languages)), dtype=np.float32)
        self.known = np.ones(MEMO_WORDS, dtype=bool)

    def learn(self, words: list[str]) -> None:
        """Add words not met yet: known ones as they are, others by their n-grams."""
        model = self.model
        rows, sizes, weights = [], [], []
        for word in words:
            row, weight = model.words.get(word), 1.0
            found = [] if row is None else [row]
            if row is None:
                marked = f"<{word}>"
                for length in range(min(MAX_GRAM, len(marked)), 0, -1):
                    found = [g for i in range(len(marked) + 1 - length) if (g := model.grams.get(marked[i : i + length])) is not None]
                    if found:
                        weight = BACKOFF ** (MAX_GRAM - length) / len(found)
                        break
            # A word of no known n-gram gets some row with weight 0.
            rows += found or [0]
            sizes.append(len(found) or 1)
            weights.append(weight if found else 0.0)
        at, end = len(self), len(self) + len(words)
        starts = np.cumsum([0, *sizes[:-1]])
        self.rows[at:end] = np.add.reduceat(model.scores[rows], starts, axis=0) * np.array(weights)[:, None]
        self.known[at:end] = np.array(weights) > 0
        self.update(zip(words, range(at, end)))


def _judge(text: str | None, words: _Words) -> tuple[str, float, float]:
    languages = words.model.languages
    found = _LETTERS.findall(text.lower()) if text else []
    if not found or not languages:
        return UNKNOWN, 0.0, 0.0
    if len(words) + len(found) > len(words.rows):
        words.clear()
    total, known = np.zeros(len(languages)), 0
    # Pieces as large as the memo has room for, so that texts of any length are whole.
    for at in range(0, len(found), MEMO_WORDS):
        if at:
            words.clear()
        part = found[at : at + MEMO_WORDS]
        new = [w for w in dict.fromkeys(part) if w not in words]
        if new:
            words.learn(new)
        rows = np.fromiter(map(words.__getitem__, part), dtype=np.int64, count=len(part))
        total += words.rows[rows].sum(axis=0, dtype=np.float64)
        known += int(words.known[rows].sum())
    total *= min(1.0, EVIDENCE_WORDS / len(found))
    odds = np.exp(total - total.max())
    best = int(odds.argmax())
    return languages[best], float(odds[best] / odds.sum()), known / len(found)


def identify(df: DataFrame, model: Model, text: str = "text", names: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """The input rows with the language (``lang_pred``) and ``score`` (0 to 1) of their whole
    text, in columns of these ``names``. A third name gets the share of the text's words
    that are known or have a known n-gram: without one, the score says nothing.

    A null text, or one without a letter, is ``und`` with score 0; so is every text if
    nothing was learned. Equal scores go to the first language in order. Columns of these
    names in the input are replaced; all other columns and repeated rows are kept.
    """
    python_tasks(df.sparkSession)
    shipped = df.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in df.columns if c not in names]
    inner = df.select(*(df[c].alias(f"c{i}") for i, c in enumerate(kept)), df[text].cast("string").alias("judged"))

    @F.pandas_udf("lang_pred string, score double, known double")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = _Words(shipped.value)
        for texts in batches:
            yield pd.DataFrame([_judge(t, words) for t in texts], columns=["lang_pred", "score", "known"])

    out = inner.withColumn("verdict", judged("judged"))
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(kept)), *(F.col(f"verdict.{c}").alias(n) for c, n in zip(("lang_pred", "score", "known"), names)))


def held_out(key: Column) -> Column:
    """Rows never learned from: CRC-32 of the key as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))
