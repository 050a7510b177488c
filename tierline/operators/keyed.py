"""Operators on keyed rows: latest version, key constraint, change-detecting upsert."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierline.functions.json import json_distinct

# Largest batch that is broadcast, measured on the data, not on plan estimates.
BROADCAST_BYTES = 64 << 20

KEY = "id_api"

Distinct = Callable[[Column, Column], Column]


def latest_per_key(df: DataFrame, keys: str | Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark plans a row_number limit before the shuffle, so each input partition sends
    at most one row per key: a key holding a third of all rows costs no hot task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_nth", F.row_number().over(order)).filter("_nth = 1").drop("_nth")


def key_check(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys that break PRIMARY KEY / NOT NULL: no rows means the constraint holds."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("problem", F.when(any_null, "null key").when(F.col("n_rows") > 1, "duplicate key"))
        .filter(F.col("problem").isNotNull())
    )


def _merged(joined: DataFrame, key: str, distinct: Distinct) -> DataFrame:
    is_new = F.col("t._stored").isNull()
    changed = F.col("b._seen").isNotNull() & distinct(F.col("t.payload"), F.col("b.payload"))
    # A column of its own, so payloads are compared once for both values it decides.
    take = F.col("_take")
    return joined.withColumn("_take", is_new | changed).select(
        F.col(key),
        F.when(take, F.col("b.payload")).otherwise(F.col("t.payload")).alias("payload"),
        F.when(is_new, F.col("b.updated_at")).otherwise(F.col("t.ingested_at")).alias("ingested_at"),
        F.when(take, F.col("b.updated_at")).otherwise(F.col("t.updated_at")).alias("updated_at"),
    )


def _sides(target: DataFrame, batch: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    t = target.select(key, "payload", "ingested_at", "updated_at", F.lit(True).alias("_stored"))
    b = batch.select(key, "payload", "updated_at", F.lit(True).alias("_seen"))
    return t.alias("t"), b.alias("b")


def upsert_changed(
    target: DataFrame, batch: DataFrame, key: str = KEY, distinct: Distinct = json_distinct
) -> DataFrame:
    """New full state of ``target`` after merging ``batch``; both unique per key.

    New keys are inserted with both stamps from the batch; a stored key takes the
    batch's payload and ``updated_at`` only if the payload value differs and keeps
    its ``ingested_at``; keys absent from the batch stay.
    """
    t, b = _sides(target, batch, key)
    return _merged(t.join(b, key, "full_outer"), key, distinct)


def row_bytes(*columns: str) -> Column:
    """Aggregate: size of the given columns as broadcast rows (text plus row overhead)."""
    size = F.lit(64)
    for c in columns:
        size = size + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    return F.coalesce(F.sum(size), F.lit(0))


#: Keys that may stand in a filter as literals.
MOST_LITERALS = 1000


def few_keys(batch: DataFrame, key: str = KEY) -> list[str] | None:
    """The different keys of a batch if they are few, else None. Reads no more than that."""
    found = batch.select(key).distinct().limit(MOST_LITERALS + 1).collect()
    return [r[0] for r in found] if len(found) <= MOST_LITERALS else None


def upsert_broadcast(
    target: DataFrame,
    batch: DataFrame,
    key: str = KEY,
    distinct: Distinct = json_distinct,
    limit_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """As :func:`upsert_changed`, without moving the target when the batch is small.

    The batch is measured first; over ``limit_bytes`` the shuffled merge is used. The
    stored keys met by the batch are at most as many as the batch has, so they are
    bounded by the same limit (the target is unique per key: see :func:`key_check`).
    Both inputs are read several times: pass stored tables.
    """
    if batch.agg(row_bytes(key, "payload")).first()[0] > limit_bytes:
        return upsert_changed(target, batch, key, distinct)
    t, b = _sides(target, batch, key)
    kept = _merged(t.join(F.broadcast(b), key, "left"), key, distinct)
    met = target.select(key).join(F.broadcast(batch.select(key)), key, "left_semi")
    new = batch.join(F.broadcast(met), key, "left_anti").select(
        key, "payload", F.col("updated_at").alias("ingested_at"), "updated_at"
    )
    return kept.unionByName(new)


def upsert_changes(
    layers: Sequence[DataFrame],
    batch: DataFrame,
    key: str = KEY,
    distinct: Distinct = json_distinct,
    small_keys: DataFrame | None = None,
    replaced: bool = False,
) -> DataFrame:
    """Only the rows an upsert would write, with ``op`` = insert or update, and with
    ``replaced`` the payload that an update takes the place of.

    ``layers`` hold the stored state, oldest first, each unique per key: a key's newest
    layer wins. A layer bucketed by the key is joined where it lies. ``small_keys``, the
    batch's keys where their size was measured and is small, are broadcast to cut each
    layer to the keys in question before anything is shuffled.
    """
    joined = batch.select(key, "payload", "updated_at")
    stored, old_payload, old_ingested = F.lit(False), F.lit(None), F.lit(None)
    for n, layer in enumerate(layers):
        if small_keys is not None:
            layer = layer.join(F.broadcast(small_keys.select(key)), key, "left_semi")
        part = layer.select(
            key,
            F.col("payload").alias(f"_payload{n}"),
            F.col("ingested_at").alias(f"_ingested{n}"),
            F.lit(True).alias(f"_stored{n}"),
        )
        joined = joined.join(part, key, "left")
        here = F.col(f"_stored{n}").isNotNull()
        stored = here | stored
        old_payload = F.when(here, F.col(f"_payload{n}")).otherwise(old_payload)
        old_ingested = F.when(here, F.col(f"_ingested{n}")).otherwise(old_ingested)
    if layers:
        joined = joined.filter(~stored | distinct(old_payload, F.col("payload")))
    return joined.select(
        key,
        "payload",
        F.when(stored, old_ingested).otherwise(F.col("updated_at")).alias("ingested_at"),
        "updated_at",
        F.when(stored, F.lit("update")).otherwise(F.lit("insert")).alias("op"),
        *([F.when(stored, old_payload).cast("string").alias("replaced")] if replaced else []),
    )


def overlay(base: DataFrame, newer: DataFrame, key: str = KEY) -> DataFrame:
    """Rows of ``base`` with those of ``newer`` in place of or beside them.

    One full outer join, whose rows stay where a base bucketed by the key has them.
    """
    columns = [c for c in base.columns if c != key]
    joined = base.alias("t").join(newer.withColumn("_newer", F.lit(True)).alias("b"), key, "full_outer")
    is_newer = F.col("b._newer").isNotNull()
    return joined.select(
        key, *[F.when(is_newer, F.col(f"b.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in columns]
    )


def merge_changed(batch: DataFrame, table: str, key: str = KEY, distinct: Distinct = json_distinct) -> None:
    """The same upsert as MERGE INTO, for catalog tables whose format supports it.

    Plain Parquet tables do not; :class:`tierline.sources.bronze.BronzeStore` is for those.
    Not run here: there is no such format in this environment.
    """
    target = table.rpartition(".")[2]
    stored, new = F.col(f"{target}.payload"), F.col("b.payload")
    source = batch.select(key, "payload", "updated_at").alias("b")
    merge = source.mergeInto(table, F.col(f"{target}.{key}") == F.col(f"b.{key}"))
    merge.whenMatched(distinct(stored, new)).update(
        {"payload": new, "updated_at": F.col("b.updated_at")}
    ).whenNotMatched().insert(
        {
            key: F.col(f"b.{key}"),
            "payload": new,
            "ingested_at": F.col("b.updated_at"),
            "updated_at": F.col("b.updated_at"),
        }
    ).merge()
