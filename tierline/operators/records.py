"""Raw records: validity, quarantine, bronze rows, per-page counts."""

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tierline.functions.json import findings, has_keys, record_id
from tierline.functions.stamps import stamp
from tierline.schemas import REQUIRED_KEYS


def required_keys(records: DataFrame, keys: Sequence[str] = REQUIRED_KEYS, payload: str = "payload") -> DataFrame:
    """Records that carry every mandatory key; malformed JSON carries none."""
    return records.filter(has_keys(F.col(payload), keys))


def examined(
    records: DataFrame, keys: Sequence[str] = REQUIRED_KEYS, payload: str = "payload", id_key: str = "id"
) -> DataFrame:
    """Records with their ``id_api`` and ``missing_keys`` (text; NULL for no JSON object).

    What is known of a record once it was parsed: stored next to it, later steps need
    not parse it again.
    """
    found = records.withColumn("_found", findings(F.col(payload), keys, id_key))
    known = {"id_api": F.col("_found.id"), "missing_keys": F.array_join("_found.missing", ",")}
    return found.withColumns(known).drop("_found")


def accepted(examined: DataFrame) -> DataFrame:
    """Examined records bronze takes: all mandatory keys and a non-null id."""
    return examined.filter((F.col("missing_keys") == "") & F.col("id_api").isNotNull())


def refused(examined: DataFrame) -> DataFrame:
    """The other examined records, with a ``reason``: absent keys, malformed text, or a
    null id, which the keyed store cannot hold."""
    reason = (
        F.when(F.col("missing_keys").isNull(), "malformed")
        .when(F.col("missing_keys") != "", "missing keys")
        .when(F.col("id_api").isNull(), "null id")
    )
    return examined.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def quarantine(
    records: DataFrame, keys: Sequence[str] = REQUIRED_KEYS, payload: str = "payload", id_key: str = "id"
) -> DataFrame:
    """The records bronze refuses, and why."""
    return refused(examined(records, keys, payload, id_key))


def bronze_rows(
    records: DataFrame, as_of: datetime, payload: str = "payload", id_key: str = "id"
) -> DataFrame:
    """``(id_api, payload, updated_at)`` of each record, one stamp for the batch."""
    return records.select(
        record_id(F.col(payload), id_key).alias("id_api"),
        F.col(payload).alias("payload"),
        stamp(as_of).alias("updated_at"),
    )


def page_stats(records: DataFrame, keys: Sequence[str] = REQUIRED_KEYS, payload: str = "payload") -> DataFrame:
    """Records and valid records per page."""
    return records.groupBy("page").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_if(has_keys(F.col(payload), keys)).alias("n_valid"),
    )
