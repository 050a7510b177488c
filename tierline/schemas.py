"""Column names, types and key lists of the three layers.

The values below are fixed by the data model: callers with another feed pass
their own lists, every operator takes them as parameters.
"""

from pyspark.sql import types as T

# Record fields in payload order.
PAYLOAD_FIELDS = (
    "id",
    "name",
    "brewery_type",
    "city",
    "state_province",
    "country",
    "phone",
    "website_url",
    "latitude",
    "longitude",
    "address_1",
    "address_2",
    "address_3",
)

# Keys a record must carry (a null value is allowed).
REQUIRED_KEYS = ("id", "name", "brewery_type", "city", "country")

# Physical layout and grouping of the lake layers.
LOCATION_COLUMNS = ("country", "state_province")
GOLD_KEYS = ("country", "state_province", "brewery_type")

# Placeholder, page size, parallel fetches, cursor of an empty layer.
NOT_INFORMED = "Not Informed"
PAGE_SIZE = 200
# Pages a fetch task reads one after the other; a lost task reads them again.
PAGES_PER_TASK = 4

# Columns of fetched records.
FETCHED = ("page", "pos", "payload")
NO_CURSOR = "1900-01-01 00:00:00"

PAYLOAD = T.StructType([T.StructField(f, T.StringType()) for f in PAYLOAD_FIELDS])

BRONZE = T.StructType(
    [
        T.StructField("id_api", T.StringType(), False),
        T.StructField("payload", T.StringType(), False),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

# Bronze rows as stored per run: "insert" for a new key, "update" for a new version.
BRONZE_CHANGES = T.StructType(BRONZE.fields + [T.StructField("op", T.StringType())])

# As written: with the payload an update took the place of, where the writer knew it.
BRONZE_STORED = T.StructType(BRONZE_CHANGES.fields + [T.StructField("replaced", T.StringType())])

SILVER = T.StructType(
    [
        T.StructField(f, T.DoubleType() if f in ("latitude", "longitude") else T.StringType())
        for f in PAYLOAD_FIELDS
    ]
    + [
        T.StructField("full_address", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)

# As written: with the group that the last version of the id before this run was in; null
# for an id that no run before has. Readers of SILVER do not see it.
GROUP = T.StructType([T.StructField(k, T.StringType()) for k in GOLD_KEYS])
SILVER_STORED = T.StructType(SILVER.fields + [T.StructField("previous", GROUP)])

GOLD = T.StructType(
    [T.StructField(k, T.StringType()) for k in GOLD_KEYS]
    + [
        T.StructField("total_breweries", T.LongType()),
        T.StructField("processed_at", T.TimestampType()),
    ]
)
