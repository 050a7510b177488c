"""A training corpus in four stages: language, near duplicates, test leaks, source mix.

Every stage reads what the one before it wrote, and its decisions take effect: rows it
rejects are not in what it returns. All stages but the last return the columns of
``documents``, whatever they are. Repeated rows are decided alike, except that of a group
of near duplicates one row stays. Rows of one id are one document to the leak stage.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import decontaminate, jaccard_join, language_id, mixing
from tierline.llm.common import free_name, small_side, table
from tierline.session import stage

#: A text's language is clear if its score is this part of the way from that of no
#: evidence, 1 / languages, to 1. It also needs a word with a known n-gram: of one
#: language every score is 1.
LEAST_MARGIN = 1 / 15

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of no recognisable language: null texts, texts without a letter and
    texts whose language is not clear. The labels of all documents are learned from."""
    columns = docs.columns
    names = tuple(free_name(docs, n) for n in ("predicted_language_", "language_score_", "known_words_"))
    model = language_id.train(docs)
    chance = 1 / max(len(model.languages), 1)
    judged = language_id.identify(docs, model, names=names)
    clear = (F.col(names[2]) > 0) & (F.col(names[1]) >= chance + LEAST_MARGIN * (1 - chance))
    return judged.where((F.col(names[0]) != language_id.UNKNOWN) & clear).select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates, the one with the smallest id."""
    return jaccard_join.first_of_groups(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a benchmark item."""
    found = decontaminate.contained(docs, table(spark, sf_dir, "benchmark"))
    leaking = small_side(stage(found.select(F.col("doc_id").alias("leaking_id_")).distinct(), "leaking"))
    return docs.join(leaking, docs["doc_id"].eqNullSafe(leaking["leaking_id_"]), "left_anti")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document: the documents with words taken."""
    return mixing.mix(docs).where("taken > 0")


STAGES: list[tuple[str, Stage]] = [
    ("language ID", languages),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", leaks),
    ("mixing sources to target weights", mixture),
]

#: SQL cannot express language identification; the tests compare it, and the other stages,
#: with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
