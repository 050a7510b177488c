"""Raw rows to typed, cleaned columns."""

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tierline.functions import text
from tierline.functions.stamps import stamp
from tierline.schemas import GOLD_KEYS, LOCATION_COLUMNS, PAYLOAD, SILVER


def parse_payload(df: DataFrame, schema: T.StructType | str = PAYLOAD, payload: str = "payload") -> DataFrame:
    """Schema-on-read: the payload's known fields as columns, unknown ones dropped.

    Unreadable text gives a row of NULLs.
    """
    return df.select(F.from_json(payload, schema).alias("data")).select("data.*")


def silver_clean(parsed: DataFrame, as_of: datetime, blank_as_missing: bool = False, extra: Sequence[str] = ()) -> DataFrame:
    """Cleaned silver columns, all stamped with the run's one ``as_of``, and ``extra``
    columns as they are."""
    places = {name: text.place(F.col(name), blank_as_missing) for name in ("city", *LOCATION_COLUMNS)}
    cleaned = parsed.withColumns(
        places
        | {
            "brewery_type": text.title(F.col("brewery_type")),
            "phone": text.digits(F.col("phone")),
            "website_url": text.url(F.col("website_url")),
            "latitude": text.number(F.col("latitude")),
            "longitude": text.number(F.col("longitude")),
            "full_address": text.joined(F.col("address_1"), F.col("address_2"), F.col("address_3")),
            "ingested_at": stamp(as_of),
        }
    )
    return cleaned.select(*SILVER.fieldNames(), *extra)


def silver_rows(bronze: DataFrame, as_of: datetime, blank_as_missing: bool = False, previous: str | None = None) -> DataFrame:
    """Bronze rows to silver rows. With the name of a column of replaced payloads, also the
    group each of these was counted in (``previous``)."""
    if previous is None:
        return silver_clean(parse_payload(bronze), as_of, blank_as_missing)
    parsed = bronze.select(F.from_json("payload", PAYLOAD).alias("data"), group_of(F.col(previous), blank_as_missing).alias("previous"))
    return silver_clean(parsed.select("data.*", "previous"), as_of, blank_as_missing, extra=["previous"])


def group_of(payload: Column, blank_as_missing: bool = False) -> Column:
    """The gold group a raw record is counted in, as the lake returns its columns; null
    without a payload."""
    fields = T.StructType([f for f in PAYLOAD.fields if f.name in GOLD_KEYS])
    # Bound by the lambda, the record is parsed once for all columns.
    group = F.transform(
        F.array(F.from_json(payload, fields)),
        lambda record: F.struct(
            *[F.nullif(text.place(record[c], blank_as_missing), F.lit("")).alias(c) for c in LOCATION_COLUMNS],
            text.title(record["brewery_type"]).alias("brewery_type"),
        ),
    )[0]
    return F.when(payload.isNotNull(), group)
