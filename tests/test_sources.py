"""Pages, run folders, bronze store, JDBC options."""

import glob
import json
import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from tierline.functions.stamps import stamp
from tierline.operators import keyed
from tierline.plans import feeds
from tierline.schemas import LOCATION_COLUMNS, SILVER
from tierline.sources import jdbc, lake, pages
from tierline.sources.bronze import BronzeStore

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)


@pytest.mark.parametrize("total, expected", [(401, [1, 2, 3]), (400, [1, 2]), (1, [1]), (0, [])])
def test_page_plan(spark, total, expected):
    assert [r.page for r in pages.page_plan(spark, total).orderBy("page").collect()] == expected


@pytest.mark.parametrize("meta, total", [('{"total":"401"}', 401), ('{"total":7}', 7), ('{"n":1}', None)])
def test_total_records(spark, meta, total):
    df = spark.createDataFrame([(meta,)], "m string")
    assert df.select(pages.total_records(F.col("m"))).first()[0] == total


def test_page_files(spark, tmp_path):
    body = [{"id": "a", "n": None}, {"id": "b", "o": {"k": [1, 2]}}]
    (tmp_path / "page_1.json").write_text(json.dumps(body, indent=2))
    (tmp_path / "page_12.json").write_text("[]")
    (tmp_path / "v3_page_2.json").write_text('[{"id": "c"}]')
    (tmp_path / "v3_page_7.json.txt").write_text('[{"id": "d"}]')
    got = pages.read_page_files(spark, str(tmp_path)).orderBy("page", "pos").collect()
    assert [(r.page, r.pos, json.loads(r.payload)) for r in got] == [
        (1, 0, body[0]),
        (1, 1, body[1]),
        (2, 0, {"id": "c"}),
        (7, 0, {"id": "d"}),
    ]


@pytest.mark.parametrize(
    "body",
    ['[{"id":1},', "xx", '{"id":', '[{"id":"a"}][{"id":"b"}]', '[{"id":"c"}],{"id":"d"}]', '[{"id":1}] x', "", "\n", None, "[1", '{"a":1}', '[{"a":1}],"x":[{"b":2}]', "[1],[2]", '[{"id":"a"}]],[[{"id":"b"}]', '[{"id":"a"}]] trailing', '[{"id":"a"}]]', '[1],["x"]]'],
)
def test_broken_page_fails(spark, body):
    with pytest.raises(Exception, match="MALFORMED"):
        pages.page_records(spark.createDataFrame([(1, body)], "page long, body string")).collect()


@pytest.mark.parametrize("body", ["[]", " [ ] ", "null", "{}", " {}\n"])
def test_empty_page(spark, body):
    assert pages.page_records(spark.createDataFrame([(1, body)], "page long, body string")).count() == 0


def test_a_page_is_parsed_once(spark):
    got = pages.page_records(spark.createDataFrame([(1, "[1]")], "page long, body string"))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_paged_source(spark):
    # Plain functions: they travel to the Python workers.
    def total():
        return "1005"

    def page(number, per_page):
        first = (number - 1) * per_page
        return [{"id": str(i), "page": number} for i in range(first, min(first + per_page, 1005))]

    spark.dataSource.register(pages.paged_source(total, page, "test_pages"))
    reader = spark.read.format("test_pages")
    df = reader.load()
    ids = df.select("page", F.get_json_object("payload", "$.id").cast("int").alias("id"), "pos").collect()
    assert sorted(r.id for r in ids) == list(range(1005))
    assert all(r.id == (r.page - 1) * 200 + r.pos for r in ids)
    assert df.rdd.getNumPartitions() == 2
    assert reader.option("pagesPerTask", 1).load().rdd.getNumPartitions() == 6
    assert reader.option("pagesPerTask", 1).option("maxFetches", 2).load().rdd.getNumPartitions() == 2
    assert reader.option("maxFetches", 4).option("perPage", 50).load().count() == 1005


def test_paged_source_without_records(spark):
    spark.dataSource.register(pages.paged_source(lambda: 0, lambda p, n: [], "no_pages"))
    assert spark.read.format("no_pages").load().count() == 0


def _silver(spark, rows):
    df = spark.createDataFrame(rows, "id string, country string, state_province string")
    fields = [
        F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in SILVER.fields
    ]
    return df.select(*fields)


def test_lake_round_trip(spark, tmp_path):
    base = str(tmp_path / "silver")
    rows = [("1", "A/B=c", "01"), ("2", "", "x"), ("3", None, "x")]
    assert lake.write_run(_silver(spark, rows), base, "1", LOCATION_COLUMNS) == 3
    got = lake.read_run(spark, base, SILVER)
    assert got.columns == SILVER.fieldNames()
    assert {(r.id, r.country, r.state_province) for r in got.collect()} == {
        ("1", "A/B=c", "01"),
        ("2", None, "x"),
        ("3", None, "x"),
    }


def test_runs(spark, tmp_path):
    base = str(tmp_path / "silver")
    assert lake.list_runs(spark, base) == []
    with pytest.raises(lake.NoRuns):
        lake.latest_run(spark, base)
    assert lake.read_runs(spark, base, SILVER).count() == 0
    for run in ("20240102_0900", "20240101_0900"):
        lake.write_run(_silver(spark, [(run, "a", "b")]), base, run, LOCATION_COLUMNS)
    # A run without its marker is still being written; other folders are no runs.
    (tmp_path / "silver" / "run_id=20240103_0900").mkdir()
    (tmp_path / "silver" / "other").mkdir()
    assert lake.latest_run(spark, base) == "run_id=20240102_0900"
    assert lake.list_runs(spark, base, committed=False)[-1] == "run_id=20240103_0900"
    assert lake.runs_before(spark, base, "20240102_0900") == ["run_id=20240101_0900"]
    assert {(r.run_id, r.id) for r in lake.read_runs(spark, base, SILVER).collect()} == {
        ("20240101_0900",) * 2,
        ("20240102_0900",) * 2,
    }
    # A retried run replaces itself only.
    lake.write_run(_silver(spark, [("again", "a", "b")]), base, "20240102_0900", LOCATION_COLUMNS)
    assert sorted(r.id for r in lake.read_runs(spark, base, SILVER).collect()) == ["20240101_0900", "again"]


def test_region_filter_prunes_directories(spark, tmp_path):
    base = str(tmp_path / "silver")
    lake.write_run(_silver(spark, [("1", "Asia", "x"), ("2", "Europe", "y")]), base, "1", LOCATION_COLUMNS)
    asia = lake.read_runs(spark, base, SILVER).filter("country = 'Asia'").select("id")
    plan = asia._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(country" in plan
    assert len(asia.inputFiles()) == 2 and [r.id for r in asia.collect()] == ["1"]


def test_hot_directory_is_split_and_small_ones_are_not(spark, tmp_path):
    schema = T.StructType([T.StructField("v", T.StringType()), T.StructField("country", T.StringType())])
    hot = spark.range(60_000, numPartitions=8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 20)).alias("country"),
    )
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, "200k")
    try:
        assert lake.write_run(hot, str(tmp_path), "1", ["country"]) == 60_000
    finally:
        spark.conf.set(advisory, before)
    files = {d: len(glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{tmp_path}/run_id=1/country=*")}
    # Only directories hashed together with the hot one share its split.
    assert files.pop(f"{tmp_path}/run_id=1/country=hot") > 4
    assert sorted(files.values())[len(files) // 2] == 1
    assert lake.read_run(spark, str(tmp_path), schema).distinct().count() == 60_000


def test_small_gold_is_one_file(spark, tmp_path):
    groups = spark.range(100_000).groupBy((F.col("id") % 500).alias("k")).count()
    assert lake.write_run(groups, str(tmp_path), "1") == 500
    assert len(glob.glob(f"{tmp_path}/run_id=1/*.parquet")) == 1


def _changes(spark, rows, as_of):
    return spark.createDataFrame(rows, "id_api string, payload string").withColumn("updated_at", stamp(as_of))


def _load(spark, store, rows, run, as_of):
    return store.append(keyed.upsert_changes(store.layers(run), _changes(spark, rows, as_of)), run)


def _current(store, **options):
    return {r.id_api: r.payload for r in store.state(**options).collect()}


@pytest.mark.parametrize("compact", [False, True])
def test_bronze_store(spark, tmp_path, compact):
    store = BronzeStore(spark, str(tmp_path))
    assert store.layers() == [] and store.state().count() == 0 and store.compact() is None
    assert _load(spark, store, [("a", '{"v":1}'), ("b", '{"v":1}')], "1", T1) == 2
    if compact:
        assert store.compact(buckets=4) == "run_id=1.b4"
        assert store.compact(buckets=4) == "run_id=1.b4"
    assert _load(spark, store, [("a", '{"v": 1.0}'), ("b", '{"v":2}'), ("c", '{"v":1}')], "2", T2) == 2
    want = {"a": '{"v":1}', "b": '{"v":2}', "c": '{"v":1}'}
    assert _current(store) == want
    assert _current(store, before="2") == {"a": '{"v":1}', "b": '{"v":1}'}
    # The same run again gives the same result: it does not see its own output.
    assert _load(spark, store, [("a", '{"v": 1.0}'), ("b", '{"v":2}'), ("c", '{"v":1}')], "2", T2) == 2
    assert _current(store) == want
    assert store.runs() == ["run_id=1", "run_id=2"] and store.runs("1") == ["run_id=1"]
    assert {r.id_api for r in store.changed_by(["run_id=2"]).collect()} == {"b", "c"}
    assert {r.id_api: r.payload for r in store.changed_by(store.runs()).collect()} == want
    assert {r.id_api for r in store.changed_by(store.runs("1")).collect()} == {"a", "b"}
    assert store.missing_rows(store.runs()) == 0
    assert tuple(store.stats("2", T1).first()) == (3, 2)
    assert tuple(store.stats("2", T2).first()) == (3, 0)
    # Nothing changed: no run is kept.
    assert _load(spark, store, [("a", '{"v":1}')], "3", T3) == 0
    assert lake.list_runs(spark, store.changes_path) == ["run_id=1", "run_id=2"]
    if compact:
        assert store.compact(buckets=4) == "run_id=2.b4"
        assert _current(store) == want
        latest = lambda: store.last_stamp().replace(tzinfo=None)
        assert latest() == T2
        # Retention may drop folders the snapshot covers.
        shutil.rmtree(f"{store.changes_path}/run_id=1")
        shutil.rmtree(f"{store.changes_path}/run_id=2")
        assert latest() == T2 and _current(store) == want
        assert tuple(store.stats("3", T2).first()) == (3, 0)


def test_compaction_moves_only_the_changes(spark, tmp_path):
    store = BronzeStore(spark, str(tmp_path))
    _load(spark, store, [(str(i), "{}") for i in range(200)], "1", T1)
    assert store.pending() == 1 and store.compact() == "run_id=1.b8" and store.pending() == 0
    _load(spark, store, [(str(i), "[]") for i in range(150, 250)], "2", T2)
    merged = keyed.overlay(*store.layers())
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan and "FullOuter" in plan
    assert store.compact() == "run_id=2.b8"
    assert len(glob.glob(f"{store.snapshot_path}/run_id=2.b8/*.parquet")) == 8
    want = {str(i): "{}" if i < 150 else "[]" for i in range(250)}
    assert _current(store) == want
    _load(spark, store, [("x", "{}")], "3", T3)
    assert store.compact(buckets=20) == "run_id=3.b20"
    assert _current(store) == want | {"x": "{}"}


def test_bucketed_snapshot_is_joined_in_place(spark, tmp_path):
    store = BronzeStore(spark, str(tmp_path))
    _load(spark, store, [(str(i), "{}") for i in range(100)], "1", T1)
    store.compact(buckets=16)
    assert len(glob.glob(f"{store.snapshot_path}/run_id=1.b16/*.parquet")) <= 16
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = keyed.upsert_changes(store.layers(), _changes(spark, [("1", "[]")], T2))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Bucketed: true" in plan
        assert plan.count("Exchange") == 1, "only the batch may move"
        assert [r.op for r in joined.collect()] == ["update"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


class _FakeReader:
    def __init__(self, df):
        self.df, self.seen = df, {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen.update(options)
        return self

    def load(self):
        return self.df

    def jdbc(self, url, table, predicates, properties):
        self.seen.update(url=url, dbtable=table, predicates=predicates, **properties)
        return self.df


class _FakeSession:
    def __init__(self, df):
        self.read = _FakeReader(df)


def test_jdbc_scan_options(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int").withColumn("ts", stamp(T2))
    session = _FakeSession(df)
    split = jdbc.range_options("id", 0, 100, 4)
    got = jdbc.jdbc_delta_scan(session, "jdbc:x", "bronze.t", "ts", T1, {"user": "u"}, split)
    assert got.count() == 2
    assert session.read.seen == {
        "format": "jdbc", "dbtable": "bronze.t", "url": "jdbc:x", "fetchsize": "10000", "user": "u",
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4",
    }
    assert jdbc.jdbc_delta_scan(session, "jdbc:x", "t", "ts", T2, predicates=["id < 2", "id >= 2"]).count() == 0
    assert session.read.seen["predicates"] == ["id < 2", "id >= 2"]


def test_append_once(spark):
    run = spark.range(3).withColumn("ts", stamp(T2))
    older = spark.range(5).withColumn("ts", stamp(T1))
    sent = []
    assert jdbc.append_once(run, "ts", None, sent.append)
    assert jdbc.append_once(run, "ts", older, sent.append)
    assert not jdbc.append_once(run, "ts", older.unionByName(run), sent.append)
    with pytest.raises(RuntimeError, match="1 of the run's 3"):
        jdbc.append_once(run, "ts", run.limit(1), sent.append)
    assert len(sent) == 2


# --- saved pages looked up one by one


def test_a_saved_page_is_fetched_without_the_others(spark, tmp_path):
    folder = f"{tmp_path}/pages"
    rows = [(page, pos, f'{{"id":"{page}-{pos}"}}') for page in range(1, 101) for pos in (2, 0, 1)]
    saved, fetch = feeds.saved_pages(spark.createDataFrame(rows, "page long, pos int, payload string").repartition(4), folder)
    assert saved.columns == ["page", "pos", "payload"] and sorted(map(tuple, saved.collect())) == sorted(rows)
    for page in (1, 31, 32, 33, 63, 64, 100):
        assert fetch(page, 200) == [{"id": f"{page}-{pos}"} for pos in range(3)]
    assert fetch(101, 200) == fetch(5000, 200) == []
    # What a fetch reads does not grow with the table: files of other blocks are not opened.
    for block in ("0", "2", "3"):
        for file in glob.glob(f"{folder}/block={block}/*.parquet"):
            with open(file, "wb") as f:
                f.write(b"not a table")
    assert fetch(40, 200) == [{"id": f"40-{pos}"} for pos in range(3)]


def test_saved_pages_of_no_records_or_no_number(spark, tmp_path):
    schema = "page long, pos int, payload string"
    saved, fetch = feeds.saved_pages(spark.createDataFrame([], schema), f"{tmp_path}/none")
    assert saved.count() == 0 and fetch(1, 200) == []
    rows = [(None, None, "{}"), (1, 0, '{"a":1}'), (1, 0, '{"a":1}')]
    saved, fetch = feeds.saved_pages(spark.createDataFrame(rows, schema), f"{tmp_path}/some")
    assert saved.count() == 3 and fetch(1, 200) == [{"a": 1}, {"a": 1}]
