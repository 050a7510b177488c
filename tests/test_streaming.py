"""Paged streams, the committing sink, reconciliation inside a stream."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tierline.plans.stages import Layers, StageFailed
from tierline.sources import lake, pages
from tierline.sources.bronze import BronzeStore
from tierline.sources.sink import LakeRunSink
from tierline.streaming.handover import stream_bronze
from tierline.streaming.reconcile import reconciled_stream


@pytest.fixture
def feed(spark, tmp_path):
    """A stream of records whose number, and how many a page really has, are in files."""
    folder = str(tmp_path)

    def total():
        with open(f"{folder}/total") as f:
            return f.read()

    def page(number, per_page):
        with open(f"{folder}/there") as f:
            there = int(f.read())
        with open(f"{folder}/fetched", "a") as f:
            f.write(f"{number}\n")
        first = (number - 1) * per_page
        return [{"id": str(i), "name": "x", "brewery_type": "b", "city": "c", "country": "d"} for i in range(first, min(first + per_page, there))]

    def arrive(n, there=None):
        for name, value in (("total", n), ("there", n if there is None else there)):
            with open(f"{folder}/{name}", "w") as f:
                f.write(str(value))

    name = f"feed_{tmp_path.name}"
    spark.dataSource.register(pages.paged_source(total, page, name))
    arrive(0)
    return spark.readStream.format(name).option("perPage", 10).option("pagesPerTask", 2).load(), arrive, folder


def _run(stream, folder):
    writer = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/ckpt")
    writer.trigger(availableNow=True).start().awaitTermination()


def test_each_record_is_streamed_once(spark, feed):
    stream, arrive, folder = feed
    for n in (0, 7, 25, 25, 30, 64):
        arrive(n)
        _run(stream, folder)
        rows = spark.read.schema(stream.schema).parquet(f"{folder}/out").collect() if n else []
        ids = [int(json.loads(r.payload)["id"]) for r in rows]
        assert sorted(ids) == list(range(n))
        assert all((r.page - 1) * 10 + r.pos == i for r, i in zip(rows, ids))
    # Only pages that had something new were fetched again.
    with open(f"{folder}/fetched") as f:
        assert sorted(map(int, f.read().split())) == [1, 1, 2, 3, 3, 4, 5, 6, 7]


def test_a_short_page_and_a_shrunk_feed_stop_the_stream(feed):
    stream, arrive, folder = feed
    arrive(15, there=14)
    with pytest.raises(Exception, match="page 2 has 4 records of 5"):
        _run(stream, folder)
    arrive(15)
    _run(stream, folder)
    arrive(12)
    with pytest.raises(Exception, match="the feed has 12 records, 15 were read"):
        _run(stream, folder)


def test_a_stream_into_bronze(spark, feed, tmp_path):
    stream, arrive, folder = feed
    layers, times = Layers.under(f"{folder}/layers"), [datetime(2024, 1, d) for d in (1, 2, 3)]
    found = []
    for n in (25, 25, 40):
        arrive(n)
        found += stream_bronze(spark, layers, stream, f"{folder}/ckpt", clock=lambda run: times[int(run)])
    assert [(c.batch, c.read, c.written, c.status) for c in found] == [(0, 25, 25, "proceed"), (1, 15, 15, "proceed")]
    store = BronzeStore(spark, layers.bronze)
    assert store.runs() == ["run_id=000000000000", "run_id=000000000001"] and store.state().count() == 40


def test_a_lost_row_stops_the_stream(spark, tmp_path):
    source, written = f"{tmp_path}/source", []
    for n in range(3):
        spark.range(n * 10, n * 10 + 10).write.mode("append").parquet(source)
    files = sorted(os.path.join(source, f) for f in os.listdir(source) if f.endswith(".parquet"))
    batches = len(files)
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source)

    def write(batch, number):
        written.append(number)
        return len(batch.collect())

    whole = reconciled_stream(spark, stream, write, f"{tmp_path}/one")
    assert len(whole) == batches and sum(c.read for c in whole) == 30 and all(c.status == "proceed" for c in whole)
    written.clear()
    with pytest.raises(Exception, match="batch 0 read 10 rows, wrote 9|batch . read . rows, wrote"):
        reconciled_stream(spark, stream, write, f"{tmp_path}/two", transform=lambda df: df.where("id % 10 <> 3"))
    assert len(written) < batches


def test_the_last_batch_is_checked_too(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(f"{tmp_path}/source")
    stream = spark.readStream.schema("id long").parquet(f"{tmp_path}/source")
    with pytest.raises(StageFailed, match="batch 0 read 5 rows, wrote 4"):
        reconciled_stream(spark, stream, lambda batch, n: batch.count() - 1, f"{tmp_path}/ckpt")


# --- the committing sink


@pytest.fixture
def save(spark, tmp_path):
    spark.dataSource.register(LakeRunSink)

    def write(df, run_id, mode="append", **options):
        df.write.format("lake_run").options(path=f"{tmp_path}/base", runId=run_id, **options).mode(mode).save()

    return write


def _rows(spark, tmp_path, schema):
    from pyspark.sql.types import _parse_datatype_string

    kind = _parse_datatype_string(schema)
    rows = lake.read_runs(spark, f"{tmp_path}/base", kind).select(*kind.fieldNames(), "run_id")
    return sorted(map(tuple, rows.collect()), key=str)


def test_a_run_is_committed_as_a_whole(spark, tmp_path, save):
    df = spark.createDataFrame([(1, "A/B=c"), (2, ""), (3, None), (4, "é x%{}'")], "n int, place string").repartition(3)
    save(df, "1", partitionBy="place", expectedRows="4")
    assert _rows(spark, tmp_path, "n int, place string") == [(1, "A/B=c", "1"), (2, None, "1"), (3, None, "1"), (4, "é x%{}'", "1")]
    assert lake.commits(spark, f"{tmp_path}/base")["run_id=1"]
    with pytest.raises(Exception, match="is committed"):
        save(df, "1", partitionBy="place")
    save(df.where("n < 2"), "1", "overwrite", partitionBy="place")
    save(df.where("n > 9"), "2")
    assert _rows(spark, tmp_path, "n int, place string") == [(1, "A/B=c", "1")]
    assert lake.list_runs(spark, f"{tmp_path}/base") == ["run_id=1", "run_id=2"]
    assert os.listdir(f"{tmp_path}/base/{lake.STAGING}") == []


def test_a_failed_task_leaves_nothing(spark, tmp_path, save):
    df = spark.range(100, numPartitions=4).select(F.when(F.col("id") == 60, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("n"))
    save(spark.range(3).withColumnRenamed("id", "n"), "1")
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="lost"):
            save(df, "1" if mode == "overwrite" else "2", mode)
    with pytest.raises(Exception, match="3 rows were written, 4 expected"):
        save(spark.range(3).withColumnRenamed("id", "n"), "2", expectedRows="4")
    assert _rows(spark, tmp_path, "n long") == [(0, "1"), (1, "1"), (2, "1")]
    assert lake.list_runs(spark, f"{tmp_path}/base", committed=False) == ["run_id=1"]
