"""Benchmark decontamination: which documents contain which test items?

An item is found where at least ``threshold`` of its word shingles are in the document
(containment, not likeness: items are short, documents long). The MinHash sketch of an
item is the set of its smallest shingle hashes. If a document holds at least t of n
shingles, it misses at most n - t, so of any n - t + 1 it holds one: a sketch of that
many shingles finds every document that contains the item, however long. Items are
partitioned by size (powers of two), and the largest size of a partition sets the length
of its sketches. What the sketches find is verified on the shingles themselves.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import small_side
from tierline.session import stage

SHINGLE = 5
THRESHOLD_PERCENT = 75


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits: neither punctuation nor spacing hides a copy."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _each(found: str, make) -> Column:
    """``make`` of each run of SHINGLE words; fewer words are one shingle, none is none."""
    count = F.size(found)
    places = F.sequence(F.lit(1), F.greatest(count - (SHINGLE - 1), F.lit(1)))
    return F.when(count > 0, F.transform(places, lambda i: make(F.slice(found, i, F.lit(SHINGLE)))))


def _hashes(found: str) -> Column:
    return _each(found, lambda s: F.xxhash64(s))


def _shingles(found: str) -> Column:
    return _each(found, lambda s: F.array_join(s, " "))


def sketches(items: DataFrame, percent: int) -> DataFrame:
    """``item``, ``probe``: the smallest shingle hashes of each item, as many as its size
    partition needs. ``items`` has ``item`` and ``words``."""
    sized = items.withColumn("hashes", F.array_sort(F.array_distinct(_hashes("words")))).where(F.size("hashes") > 0)
    largest = F.pow(F.lit(2), F.floor(F.log2(F.size("hashes"))) + 1) - 1
    length = F.floor(largest * (100 - percent) / 100).cast("int") + 1
    return sized.select("item", F.explode(F.slice("hashes", F.lit(1), length)).alias("probe")).distinct()


def contained(documents: DataFrame, items: DataFrame, percent: int = THRESHOLD_PERCENT, doc_key: str = "doc_id", doc_text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """Pairs (``doc_key``, ``item_key``) with ``n_shingles`` of the item, ``matched`` of them
    in the document, and ``containment``, at least ``percent`` / 100.

    Rows of one key are one document (or item): their shingles are taken together. Null
    and empty texts contain nothing and are contained nowhere; a text of fewer words than
    a shingle has its whole sequence as the only one, so it is found only in texts that
    consist of it. Null keys are keys like any other. Other columns are left out.
    """
    docs = documents.select(documents[doc_key].alias("doc"), documents[doc_text].cast("string").alias("text"))
    test = stage(items.select(items[item_key].alias("item"), words(items[item_text].cast("string")).alias("words")), "items")
    # A document's hashes are not shuffled as long as the probes, counted, are few.
    probes = stage(sketches(test, percent), "sketches")
    shingles = stage(test.select("item", F.explode(_shingles("words")).alias("shingle")).distinct(), "shingles")

    # No document hash above every sketch can match: with long items, most of them.
    highest = probes.agg(F.max("probe")).first()[0]
    highest = F.lit(highest).cast("long")
    split = docs.where(F.col("text").isNotNull()).select("doc", words(F.col("text")).alias("words"))
    hashed = split.select("doc", F.explode(F.filter(_hashes("words"), lambda h: h <= highest)).alias("probe"))
    candidates = stage(hashed.join(small_side(probes), "probe").select("doc", "item").distinct(), "candidates")

    found = candidates.select(F.col("doc").alias("found")).distinct()
    texts = docs.join(found, F.col("doc").eqNullSafe(F.col("found")), "left_semi")
    held = texts.select("doc", words(F.col("text")).alias("words")).select("doc", F.explode(_shingles("words")).alias("shingle")).distinct()
    counted = held.join(shingles, "shingle").groupBy("doc", "item").agg(F.count(F.lit(1)).alias("matched"))
    verified = counted.join(candidates.select(F.col("doc").alias("c_doc"), F.col("item").alias("c_item")), F.col("doc").eqNullSafe(F.col("c_doc")) & F.col("item").eqNullSafe(F.col("c_item")), "left_semi")
    sizes = shingles.groupBy(F.col("item").alias("s_item")).agg(F.count(F.lit(1)).alias("n_shingles"))
    return (
        verified.join(sizes, F.col("item").eqNullSafe(F.col("s_item")))
        .where(F.col("matched") * 100 >= F.col("n_shingles") * percent)
        .select(F.col("doc").alias(doc_key), F.col("item").alias(item_key), "n_shingles", "matched", (F.col("matched") / F.col("n_shingles")).alias("containment"))
    )
