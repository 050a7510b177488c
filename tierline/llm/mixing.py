"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its shuffled documents, a second copy of all of them behind the
first. A copy's virtual finish time is the words of its queue up to and with it, divided by
the source's target. Served in the order of these times until the budget is spent, sources
take words in proportion to their targets at any point, and reach them together.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import word_count
from tierline.session import stage

#: Documents that a slice of a queue, or of virtual time, holds on average.
SLICE_ROWS = 1024

#: Bits of a place in a block of slices or spans; see :func:`_before`.
BLOCK_BITS = 10

#: Bits of the shuffle order.
ORDER_BITS = 60


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, repeats: int) -> DataFrame:
    """``sources`` (``source``, ``words``) with ``target`` words each.

    The budget is ``share`` of all words. Sources in code point order (null last) have
    ``weights``, over and over. No target exceeds ``repeats`` times its source; the excess
    is shared by weight among the others: target = min(cap, level * weight), where the
    level spends the budget. One row a source is all that is sorted here.
    """
    named = Window.orderBy(F.col("source").isNull(), "source")
    weighed = sources.withColumn("place", (F.row_number().over(named) - 1) % len(weights)).withColumn("cap", F.col("words") * repeats)
    weighed = weighed.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.col("place") + 1))
    # From the source that is full first on: the level if all before it are full.
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    budget = F.sum("words").over(everything) * share
    full = F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1))
    open_weight = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    levelled = weighed.withColumn("level", (budget - F.coalesce(full, F.lit(0))) / open_weight)
    level = F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(everything)
    return levelled.withColumn("target", F.least(F.col("cap").cast("double"), level * F.col("weight"))).withColumn(
        "target", F.coalesce("target", F.col("cap").cast("double"))
    ).select("source", "words", "target")


def _before(sums: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """``sums`` (one row for each ``at`` of the ``keys``) with ``before``, the sum of
    ``value`` over all smaller ``at`` of the same keys.

    In two levels, so that not all rows of a key pass through one task: within blocks of
    2^BLOCK_BITS consecutive ``at``, and over the sums of blocks."""
    blocked = sums.withColumn("block", F.shiftright(at, BLOCK_BITS))
    blocks = blocked.groupBy(*keys, "block").agg(F.sum(value).alias("of_block"))
    over_blocks = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*keys, "block", F.coalesce(F.sum("of_block").over(over_blocks), F.lit(0)).alias("of_blocks"))
    within = Window.partitionBy(*keys, "block").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    inside = blocked.withColumn("inside", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return inside.join(blocks, [*keys, "block"]).withColumn("before", F.col("of_blocks") + F.col("inside")).drop("block", "of_blocks", "inside")


def mix(df: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, repeats: int = 2, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: ``key``, ``source``, ``size`` (words), ``source_size``,
    ``target`` (its source's) and ``taken``: the words the mix takes of it, 0 to
    ``repeats`` times its size, always whole copies.

    A null text has size 0, a null source is a source, a null key a key. Documents are
    shuffled by a hash of their key, so reruns agree. Rows of one key and size are queued one
    behind the other, so the mix may take some of them and not the others; which of them is
    all the same. The copy in which the budget ends is taken if more than half of it
    fits; so a source may miss its target by a document. Other columns are left out.

    No queue passes through one task: it is cut into slices of the shuffle order, whose
    sums, added up in two levels, give each slice its start; so is virtual time.
    """
    digest = F.md5(F.coalesce(df[key].cast("string"), F.lit("")))
    sized = stage(
        df.select(
            df[key].alias("key"),
            df[source].cast("string").alias("source"),
            word_count(df[text].cast("string")).alias("size"),
            F.conv(F.substring(digest, 1, ORDER_BITS // 4), 16, 10).cast("long").alias("order"),
        ),
        "sized",
    )
    bits = max(0, (sized.count() // SLICE_ROWS).bit_length())
    sized = sized.withColumn("slice", F.shiftright("order", ORDER_BITS - bits)).withColumn("id", F.coalesce(F.col("key").cast("string"), F.lit("")))
    # A source as a join key that is never null and keeps the order.
    sized = sized.withColumn("queue", F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), "source")))

    slices = sized.groupBy("queue", "slice").agg(F.sum("size").alias("words"), F.first("source").alias("source"))
    slices = stage(slices, "slices")
    aims = targets(slices.groupBy("source").agg(F.sum("words").alias("words")), weights, share, repeats)
    aims = aims.select(F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), "source")).alias("queue"), F.col("words").alias("source_size"), "target")
    starts = _before(slices, ["queue"], "slice", "words").select("queue", "slice", F.col("before").alias("start")).join(aims, "queue")

    within = Window.partitionBy("queue", "slice").orderBy("order", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    queued = stage(sized.withColumn("up_to", F.sum("size").over(within)).join(starts, ["queue", "slice"]).withColumn("up_to", F.col("up_to") + F.col("start")), "queued")

    def timed(rows: DataFrame, copy) -> DataFrame:
        """``at``: a copy's place in the order of service; ``span``: its slice of time."""
        finish = (F.col("up_to") + copy * F.col("source_size")) / F.nullif(F.col("target"), F.lit(0.0))
        rows = rows.withColumn("at", F.struct(finish.alias("finish"), "queue", "order", "id", "size", copy.alias("copy")))
        # All sources reach their targets at time 1; what is later than 2 needs no finer slices.
        return rows.withColumn("span", F.least(F.floor(F.col("at.finish") * (1 << bits)), F.lit(2 << bits)).cast("long"))

    copies = queued.where("size > 0 and target > 0").select("*", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("number"))
    copies = timed(copies, F.col("number"))
    budget = aims.agg(F.sum("target")).first()[0] or 0.0
    spans = _before(stage(copies.groupBy("span").agg(F.sum("size").alias("words")), "spans"), [], "span", "words")
    # The span in which the budget is spent, and the last copy taken in it.
    cut = spans.where(F.col("before") + F.col("words") > budget).orderBy("span").limit(1).first()
    last = None
    if cut is not None:
        spent = F.sum("size").over(Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)) + cut["before"]
        inside = copies.where(F.col("span") == cut["span"]).withColumn("spent", spent)
        last = inside.where(F.col("spent") - F.col("size") / 2 < budget).agg(F.max("at").alias("at")).first()["at"]

    taken = F.lit(0).cast("long")
    for number in range(repeats):
        row = timed(queued, F.lit(number))
        queued = row.withColumnsRenamed({"at": f"at{number}", "span": f"span{number}"})
        served = F.lit(True) if cut is None else F.col(f"span{number}") < cut["span"]
        if last is not None:
            kind = queued.schema[f"at{number}"].dataType
            served = served | (F.col(f"at{number}") <= F.struct(*(F.lit(last[f.name]).cast(f.dataType).alias(f.name) for f in kind.fields)))
        taken = taken + F.when(served & (F.col("target") > 0), F.col("size")).otherwise(0)
    return queued.select(F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target", taken.alias("taken"))
