"""The registered query of every operator, with its production parameters."""

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import chat_format, clustering, decontaminate, fingerprint, html_extract, jaccard_join, language_id, license_scan, mixing, packing, periodic_runs, token_counts, url_filter
from tierline.llm.common import table

#: Turns of the conversation that every run formats besides the table's.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"

VOCABULARY = "byte_bpe_50k.json"
TOKEN_LIMIT = 512


#: Hosts of these words are on the spam list of the URL filter's query.
SPAM_HOSTS = "pills|casino|bets|spam|adult"


def _block_lists(pages: DataFrame) -> DataFrame:
    """Dated entries made from the hosts of the pages: spam hosts listed one after another,
    other hosts reported, cleared and reported again, and some directories."""
    hosts = pages.select(url_filter.host_of(F.col("url")).alias("host")).distinct().where("host <> ''")
    number = F.conv(F.substring(F.md5("host"), 1, 6), 16, 10).cast("int")
    hosts = hosts.withColumn("x", number)

    def entries(name: str, kind: str, entry, day: str, listed: bool, which: str) -> DataFrame:
        return hosts.where(which).select(
            F.lit(name).alias("list"), F.lit(kind).alias("kind"), entry.alias("entry"), F.expr(f"date_add(date'2024-01-01', {day})").alias("day"), F.lit(listed).alias("listed")
        )

    host = F.col("host")
    return (
        entries("spam", url_filter.DOMAIN, host, "x % 200", True, f"host rlike '{SPAM_HOSTS}'")
        .unionByName(entries("reported", url_filter.DOMAIN, host, "x % 200", True, "x % 5 = 0"))
        .unionByName(entries("reported", url_filter.DOMAIN, host, "x % 200 + 40", False, "x % 5 = 0"))
        .unionByName(entries("reported", url_filter.DOMAIN, host, "x % 200 + 90", True, "x % 10 = 0"))
        .unionByName(entries("sections", url_filter.PREFIX, F.concat(host, F.lit("/fr")), "x % 300", True, "x % 3 = 0"))
    )


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, with a fetch day each, against dated lists made from their hosts."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    fetched = pages.withColumn("fetched_at", F.expr("cast(date_add(date'2024-01-01', cast(page_id * 7 % 366 as int)) as timestamp) + interval 12 hours"))
    return url_filter.filter_captures(fetched, _block_lists(pages)).select(
        "page_id", "url", F.date_format("fetched_at", "yyyy-MM-dd").alias("fetched_on"), "blocked", F.array_join("lists", ",").alias("lists"),
        F.date_format("first_entry.valid_from", "yyyy-MM-dd").alias("listed_since"), F.col("first_entry.entry").alias("entry"),
    )


def op2_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document, edited with the next one's text, and the fingerprints of both."""
    documents = fingerprint.with_next(table(spark, sf_dir, "documents"))
    edited = documents.withColumn("edited", fingerprint.edited(F.col("text"), F.col("next_text")))
    summed = fingerprint.fingerprints(edited, "text", "edited", "next_text")
    return summed.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("text_fingerprint").alias("fingerprint"),
        "edited_fingerprint",
        fingerprint.likeness("text_fingerprint", "edited_fingerprint").alias("near_edited"),
        fingerprint.likeness("text_fingerprint", "next_text_fingerprint").alias("near_next"),
    )


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one made of control strings, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    formatted = chat_format.format_chats(turns.unionByName(control))
    read = formatted.withColumn("read", chat_format.read_back(F.col("formatted"))).withColumn("learned", chat_format.loss_text(F.col("segments")))
    said = F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents that contain a benchmark item, with the item."""
    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licences in all documents: as the whole text, a paragraph or a line."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, mixed by weights 5, 2, 1 to 150 % of their words."""
    return mixing.mix(table(spark, sf_dir, "documents")).withColumn("target", F.round("target", 6))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every whole page."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every prefix of every document, and from them those of the whole document
    and where it is cut to keep to the limit."""
    documents = table(spark, sf_dir, "documents")
    counted = token_counts.prefix_counts(documents, public_tokenizers.path(VOCABULARY), budget=TOKEN_LIMIT)
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the group of near duplicates each is in."""
    return jaccard_join.linked(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole document, learned from three quarters of the others."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    apart = documents.withColumn("held_out", language_id.held_out(F.col("doc_id")))
    model = language_id.train(apart.where(~F.col("held_out")))
    return language_id.identify(apart.select("doc_id", "text", "held_out"), model).drop("text")


def op11_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All usable vectors with the nearest of 16 centroids after three rounds."""
    return clustering.cluster(table(spark, sf_dir, "embeddings"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every whole document, a tenth of them with a planted tail."""
    documents = table(spark, sf_dir, "documents")
    planted = documents.select("doc_id", periodic_runs.with_planted(F.col("text"), F.col("doc_id")).alias("text"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return periodic_runs.collapse(planted).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "strongest.*",
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, packed into sequences of 1024 tokens."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_fingerprint": op2_fingerprint,
    "op3_chat_format": op3_chat_format,
    "op4_decontaminate": op4_decontaminate,
    "op5_license_scan": op5_license_scan,
    "op6_mixing": op6_mixing,
    "op7_html_extract": op7_html_extract,
    "op8_token_counts": op8_token_counts,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_language_id": op10_language_id,
    "op11_clustering": op11_clustering,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_packing": op13_packing,
    "pipeline": corpus_pipeline.run,
}
