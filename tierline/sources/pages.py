"""Paged JSON: page planning, page files, and a Spark data source over a fetcher."""

import json
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tierline.functions.json import MARK, bound, followed_by_mark
from tierline.schemas import PAGE_SIZE, PAGES_PER_TASK

RECORD_SCHEMA = "page long, pos int, payload string"


def total_records(meta: Column) -> Column:
    """``total`` of a metadata document, given as a number or as text."""
    return F.get_json_object(meta, "$.total").try_cast("long")


def page_count(total: int, per_page: int = PAGE_SIZE) -> int:
    return math.ceil(total / per_page)


def page_plan(spark: SparkSession, total: int, per_page: int = PAGE_SIZE) -> DataFrame:
    """Pages ``1..ceil(total / per_page)``, generated on the executors; none for 0."""
    return spark.range(1, page_count(total, per_page) + 1).withColumnRenamed("id", "page")


def page_records(pages: DataFrame, body: str = "body") -> DataFrame:
    """One row ``(page, pos, payload)`` per object of each page's JSON array.

    Each payload stays raw JSON. ``[]``, ``{}`` and ``null`` are empty pages. Any other
    body that is not one whole JSON array fails the job: NULL, blank, cut off, or with
    text after the array.
    """
    text = F.coalesce(F.col(body), F.lit(""))
    array = F.when(F.trim(F.translate(text, "\t\r\n", "   ")) == "{}", "[]").otherwise(text)
    parsed = F.from_json(followed_by_mark(array, f'["{MARK}"]'), "array<array<string>>", {"mode": "FAILFAST"})
    malformed = F.raise_error(F.concat(F.lit("MALFORMED page "), F.col("page").cast("string"))).cast("array<string>")

    def whole(items: Column) -> Column:
        complete = (F.size(items) == 2) & F.get(items, F.lit(1)).eqNullSafe(F.array(F.lit(MARK)))
        return F.when(complete, F.get(items, F.lit(0))).otherwise(malformed)

    return pages.select("page", F.posexplode(bound(parsed, whole)).alias("pos", "payload"))


def read_page_files(spark: SparkSession, path: str, number: str = r"(\d+)\D*$") -> DataFrame:
    """Records of saved pages, one file per page. ``number`` finds the page number in the
    file's path without its ending: by default it is the last number there."""
    files = spark.read.text(path, wholetext=True)
    name = F.regexp_replace(F.url_decode("_metadata.file_path"), r"(\.[A-Za-z][A-Za-z0-9]*)+$", "")
    page = F.regexp_extract(name, number, 1).cast("long")
    return page_records(files.select(page.alias("page"), F.col("value").alias("body")))


class PageRange(InputPartition):
    def __init__(self, first: int, last: int):
        self.first = first
        self.last = last


class PagedReader(DataSourceReader):
    """Tasks of a few pages each, so that a lost one fetches little again.

    Simultaneous fetches are bounded by the cores of the fetching application; where that
    is too many for the server, ``max_fetches`` bounds the tasks instead, at the price of
    longer ranges.
    """

    def __init__(self, fetch_total, fetch_page, per_page: int, pages_per_task: int, max_fetches: int | None = None):
        self.fetch_total = fetch_total
        self.fetch_page = fetch_page
        self.per_page = per_page
        self.pages_per_task = pages_per_task
        self.max_fetches = max_fetches

    def partitions(self) -> list[InputPartition]:
        n = page_count(int(self.fetch_total()), self.per_page)
        size = self.pages_per_task
        if self.max_fetches:
            size = max(size, page_count(n, self.max_fetches))
        ranges = [PageRange(lo + 1, min(lo + size, n)) for lo in range(0, n, size)]
        return ranges or [PageRange(1, 0)]

    def read(self, partition: PageRange) -> Iterator[pa.RecordBatch]:
        # One Arrow batch per page: memory holds one page, whatever the range.
        for page in range(partition.first, partition.last + 1):
            items = self.fetch_page(page, self.per_page) or []
            yield _page_batch(page, 0, items)


def _page_batch(page: int, first: int, items: list) -> pa.RecordBatch:
    """Some items of a page, from the position ``first`` on."""
    return pa.RecordBatch.from_arrays(
        [
            pa.array([page] * len(items), pa.int64()),
            pa.array(range(first, first + len(items)), pa.int32()),
            pa.array([json.dumps(item) for item in items], pa.string()),
        ],
        names=["page", "pos", "payload"],
    )


class RecordRange(InputPartition):
    """Pages of a task, and the records of them that a micro-batch reads."""

    def __init__(self, first: int, last: int, start: int, end: int):
        self.first = first
        self.last = last
        self.start = start
        self.end = end


class PagedStreamReader(DataSourceStreamReader):
    """A feed that grows at its end, as a stream: an offset is a number of records.

    A micro-batch reads the records between two totals, so the last page, read when it was
    half full, is read again for the rest of it only. A page that has fewer records than
    the total promised fails the batch, and so does a total that has become smaller: the
    offset would pass over what is not there.
    """

    def __init__(self, fetch_total, fetch_page, per_page: int, pages_per_task: int, max_fetches: int | None = None):
        self.fetch_total = fetch_total
        self.fetch_page = fetch_page
        self.per_page = per_page
        self.pages_per_task = pages_per_task
        self.max_fetches = max_fetches

    def initialOffset(self) -> dict:
        return {"records": 0}

    def latestOffset(self) -> dict:
        return {"records": int(self.fetch_total())}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        lo, hi = start["records"], end["records"]
        if hi < lo:
            raise ValueError(f"the feed has {hi} records, {lo} were read")
        before, last = lo // self.per_page, page_count(hi, self.per_page)
        size = self.pages_per_task
        if self.max_fetches:
            size = max(size, page_count(last - before, self.max_fetches))
        return [RecordRange(at + 1, min(at + size, last), lo, hi) for at in range(before, last, size) if lo < hi]

    def read(self, partition: RecordRange) -> Iterator[pa.RecordBatch]:
        for page in range(partition.first, partition.last + 1):
            start = (page - 1) * self.per_page
            lo, hi = max(partition.start - start, 0), min(partition.end - start, self.per_page)
            items = self.fetch_page(page, self.per_page) or []
            if len(items) < hi:
                raise ValueError(f"page {page} has {len(items)} records of {hi}")
            yield _page_batch(page, lo, items[lo:hi])


def paged_source(
    fetch_total: Callable[[], int | str],
    fetch_page: Callable[[int, int], list],
    name: str = "paged_json",
) -> type[DataSource]:
    """A data source class over two callables, for ``spark.dataSource.register``.

    ``fetch_total()`` runs once per scan and returns the record total;
    ``fetch_page(page, per_page)`` runs in the tasks and returns a list of objects.
    Options: ``perPage``, ``pagesPerTask`` and ``maxFetches`` (none by default).

    ``spark.readStream`` reads the same feed as a stream, if records are only added at its
    end: every record once, across restarts from the checkpoint (:class:`PagedStreamReader`).
    """

    class PagedSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return RECORD_SCHEMA

        def _settings(self) -> tuple:
            return (
                fetch_total,
                fetch_page,
                int(self.options.get("perPage", PAGE_SIZE)),
                int(self.options.get("pagesPerTask", PAGES_PER_TASK)),
                int(self.options.get("maxFetches", 0)) or None,
            )

        def reader(self, schema) -> DataSourceReader:
            return PagedReader(*self._settings())

        def streamReader(self, schema) -> DataSourceStreamReader:
            return PagedStreamReader(*self._settings())

    return PagedSource
