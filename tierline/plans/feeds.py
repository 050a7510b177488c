"""Record feeds shaped from the test tables.

Customers and suppliers become JSON records with the gaps a real feed has: nulls,
blanks, stray spaces and case, unreadable numbers.
"""

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tierline.schemas import PAGE_SIZE, PAYLOAD_FIELDS

#: Pages that are saved in one folder of :func:`saved_pages`: what a fetch reads to find its own.
PAGES_PER_BLOCK = 32

_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _located(spark: SparkSession, sf_dir: str, entities: DataFrame, nation_key: str) -> DataFrame:
    """Entities with their nation and region names.

    The small tables are joined on one after the other: the size Catalyst knows of each
    keeps the entities the streamed side. Joined to each other first, their estimated
    product could look larger than the entities.
    """
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return entities.join(nation, F.col(nation_key) == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )


def _every(n: int, key: Column, value: Column, otherwise: Column) -> Column:
    return F.when(key % n == 0, value).otherwise(otherwise)


def _record(prefix: str, key: Column, name: Column, kind: Column) -> dict[str, Column]:
    """The 13 record fields of one entity."""
    null = F.lit(None).cast("string")
    text = key.cast("string")
    return {
        "id": F.concat(F.lit(prefix), text),
        "name": name,
        "brewery_type": F.concat(F.lit(" "), kind, F.lit(" ")),
        "city": F.when(key % 7 == 0, null)
        .when(key % 7 == 1, F.lit(""))
        .otherwise(F.concat(F.lit("  "), F.lower("n_name"), F.lit(" TOWN"))),
        "state_province": _every(11, key, null, F.concat(F.lit(" "), F.col("n_name"), F.lit(" "))),
        "country": F.when(key % 13 == 0, null).when(key % 13 == 1, F.lit("")).otherwise(F.col("r_name")),
        "phone": _every(
            5, key, null, F.concat(F.lit("+1 ("), (key % 900).cast("string"), F.lit(") 555-"), text)
        ),
        "website_url": F.concat(F.lit(" HTTP://"), name, F.lit(".Example.COM ")),
        "latitude": _every(17, key, F.lit("n/a"), (key % 180).cast("string")),
        "longitude": (key % 90).cast("string"),
        "address_1": _every(3, key, null, F.lit("Suite 1")),
        "address_2": null,
        "address_3": _every(4, key, null, kind),
    }


def customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per customer, plus its page and position in the feed."""
    key = F.col("c_custkey")
    fields = _record("c", key, F.col("c_name"), F.col("c_mktsegment"))
    joined = _located(spark, sf_dir, table(spark, sf_dir, "customer"), "c_nationkey")
    return joined.select(key, *_paging(key), *[c.alias(n) for n, c in fields.items()])


def supplier_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    fields = _record("s", key, F.col("s_name"), F.lit("SUPPLIER"))
    joined = _located(spark, sf_dir, table(spark, sf_dir, "supplier"), "s_nationkey")
    return joined.select(*_paging(key), *[c.alias(n) for n, c in fields.items()])


def _paging(key: Column) -> tuple[Column, Column]:
    page = F.floor(key / PAGE_SIZE) + 1
    return page.cast("long").alias("page"), (key % PAGE_SIZE).cast("int").alias("pos")


def with_payload(records: DataFrame, keep_null_keys: bool = True) -> DataFrame:
    """``(page, pos, payload)``; without null keys a null field is an absent key."""
    options = {"ignoreNullFields": str(not keep_null_keys).lower()}
    payload = F.to_json(F.struct(*PAYLOAD_FIELDS), options)
    return records.select("page", "pos", payload.alias("payload"))


def second_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as fetched a day later, judged by each customer's last order.

    Customers without orders or with a pending last order are gone, those with an open
    one are unchanged, those with a finished one have a new second address line, and
    every supplier is new.
    """
    orders = table(spark, sf_dir, "orders")
    last = orders.groupBy("o_custkey").agg(
        F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("last_status")
    )
    seen = (
        customer_records(spark, sf_dir)
        .join(last, F.col("c_custkey") == F.col("o_custkey"))
        .filter(F.col("last_status") != "P")
        .withColumn("address_2", F.when(F.col("last_status") == "F", "Box F"))
    )
    return with_payload(seen).unionByName(with_payload(supplier_records(spark, sf_dir)))


def third_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first feed again, in which every fourth customer has moved to another group."""
    seen = customer_records(spark, sf_dir)
    moved = F.col("c_custkey") % 4 == 0
    seen = seen.withColumns(
        {
            "brewery_type": F.when(moved, F.lit(" relocated ")).otherwise(F.col("brewery_type")),
            "state_province": F.when(~moved, F.col("state_province")),
        }
    )
    return with_payload(seen)


def pages(records: DataFrame) -> DataFrame:
    """Records packed into JSON array pages; a page holds at most the page size."""
    items = F.transform(F.array_sort(F.collect_list(F.struct("pos", "payload"))), lambda r: r["payload"])
    body = F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
    return records.groupBy("page").agg(body.alias("body"))


def saved_pages(records: DataFrame, folder: str) -> tuple[DataFrame, Callable[[int, int], list]]:
    """Records written once, and a fetcher that looks a page up in them.

    Pages lie in blocks, a folder each that is named after the page numbers in it, so a
    fetch reads the folder of its block only, however many pages there are. A page that is
    not there is empty.
    """
    block = F.floor(F.col("page") / PAGES_PER_BLOCK)
    placed = records.withColumn("block", block).repartition("block").sortWithinPartitions("block", "page", "pos")
    placed.write.mode("overwrite").partitionBy("block").parquet(folder)
    pages_per_block = PAGES_PER_BLOCK

    def fetch_page(number: int, per_page: int) -> list:
        from pyarrow import dataset, fs

        files, path = fs.FileSystem.from_uri(folder if ":/" in folder else f"file://{folder}")
        path = f"{path}/block={number // pages_per_block}"
        if files.get_file_info(path).type == fs.FileType.NotFound:
            return []
        # No threads: a worker holds what one page's block needs, one file after the other.
        found = dataset.dataset(path, filesystem=files, format="parquet").to_table(
            ["pos", "payload"], filter=dataset.field("page") == number, use_threads=False
        )
        return [json.loads(r["payload"]) for r in sorted(found.to_pylist(), key=lambda r: r["pos"])]

    return records.sparkSession.read.schema(records.schema).parquet(folder).select(records.columns), fetch_page
