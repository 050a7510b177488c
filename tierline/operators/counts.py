"""Analytical counts over the cleaned layer."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tierline.operators.keyed import latest_per_key
from tierline.schemas import GOLD_KEYS, LOCATION_COLUMNS


def as_stored(silver: DataFrame, partition_columns: Sequence[str] = LOCATION_COLUMNS) -> DataFrame:
    """Rows as the partitioned lake returns them: a blank partition value is NULL."""
    return silver.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in partition_columns})


def gold_counts(silver: DataFrame, keys: Sequence[str] = GOLD_KEYS) -> DataFrame:
    """Rows per group. Counts are combined before the one shuffle, so a hot group
    sends one row per input partition. Whether ``silver`` is one run's delta
    or more is the caller's choice."""
    return silver.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_breweries"))


def gold_current(
    history: DataFrame, newest_first: Sequence[Column], key: str = "id", keys: Sequence[str] = GOLD_KEYS
) -> DataFrame:
    """Counts over the latest version of each id in the whole silver history."""
    return gold_counts(latest_per_key(history, key, newest_first), keys)


def gold_changes(delta: DataFrame, keys: Sequence[str] = GOLD_KEYS, previous: str = "previous") -> DataFrame:
    """What a delta does to the counts: each row adds one to its group and takes one from
    the group its id was in before (``previous``: a struct of the keys, null for a new id).
    Combined before the one shuffle; groups that end as they were are left out."""
    now = F.struct(F.lit(1).alias("n"), *keys)
    before = F.struct(F.lit(-1).alias("n"), *[F.col(f"{previous}.{k}").alias(k) for k in keys])
    steps = F.when(F.col(previous).isNull(), F.array(now)).otherwise(F.array(now, before))
    moved = delta.select(F.explode(steps).alias("step")).groupBy(*[F.col(f"step.{k}").alias(k) for k in keys])
    return moved.agg(F.sum("step.n").alias("total_breweries")).filter("total_breweries <> 0")


def gold_incremental(totals: DataFrame, delta: DataFrame, keys: Sequence[str] = GOLD_KEYS, previous: str = "previous") -> DataFrame:
    """Counts over the current version of each id, from those before a delta and the delta
    alone: as :func:`gold_current` over the whole history, at the price of what changed.
    A group that nothing is left in goes."""
    together = totals.select(*keys, "total_breweries").unionByName(gold_changes(delta, keys, previous))
    return together.groupBy(*keys).agg(F.sum("total_breweries").alias("total_breweries")).filter("total_breweries <> 0")
