"""Incremental scenarios over the three stages."""

import json
import os
import random
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tierline.plans import stages
from tierline.plans.stages import Layers, Outcome, StageFailed, bronze_stage, gold_stage, refresh, silver_stage
from tierline.schemas import BRONZE_CHANGES, GOLD, SILVER
from tierline.sources import lake
from tierline.sources.bronze import BronzeStore
from tierline.sources.jdbc import append_sink
from tierline.sources.pages import paged_source, read_page_files
from tierline.streaming.handover import stream_silver

RUNS = ["20240101_0900", "20240102_0900", "20240103_0900", "20240104_0900"]
TIMES = [datetime(2024, 1, d, 9) for d in (1, 2, 3, 4)]


def _record(key, kind="micro", country="Chile", **more):
    return {"id": key, "name": key, "brewery_type": kind, "city": "x", "country": country} | more


def _fetched(spark, *items):
    rows = [(1 + n // 2, n % 2, i if isinstance(i, str) else json.dumps(i)) for n, i in enumerate(items)]
    return spark.createDataFrame(rows, "page long, pos int, payload string")


def _gold(spark, layers):
    rows = lake.read_run(spark, layers.gold, GOLD).collect()
    return {(r.country, r.brewery_type): r.total_breweries for r in rows}


@pytest.fixture
def layers(tmp_path):
    return Layers.under(str(tmp_path))


def test_full_repeat_and_changed_runs(spark, layers):
    a, b, c = _record("a"), _record("b"), _record("c", "nano")
    bad = {"id": "z", "name": "z"}
    first = refresh(spark, layers, _fetched(spark, a, b, c, bad), RUNS[0], TIMES[0])
    assert first == [Outcome("bronze", "proceed", None, 3), Outcome("silver", "proceed", None, 3),
                     Outcome("gold", "proceed", None, 2)]
    assert _gold(spark, layers) == {("Chile", "Micro"): 2, ("Chile", "Nano"): 1}

    reordered = json.dumps(dict(reversed(a.items())), indent=1)
    second = refresh(spark, layers, _fetched(spark, c, reordered, b), RUNS[1], TIMES[1])
    assert [(o.stage, o.status) for o in second] == [("bronze", "skip"), ("silver", "skip"), ("gold", "skip")]
    assert lake.list_runs(spark, layers.gold) == [lake.run_name(RUNS[0])]

    third = refresh(spark, layers, _fetched(spark, a, _record("b", "nano"), _record("d")), RUNS[2], TIMES[2])
    assert [o.rows for o in third] == [2, 2, 2]
    # The default counts the last run's delta; "current" counts every id once.
    assert _gold(spark, layers) == {("Chile", "Micro"): 1, ("Chile", "Nano"): 1}
    gold_stage(spark, layers, RUNS[2], TIMES[2], scope="current")
    assert _gold(spark, layers) == {("Chile", "Micro"): 2, ("Chile", "Nano"): 2}
    # Silver is history: the changed record is there once per version.
    assert lake.read_runs(spark, layers.silver, SILVER).count() == 5
    state = BronzeStore(spark, layers.bronze).state().withColumns(
        {c: F.unix_seconds(c) for c in ("ingested_at", "updated_at")}
    )
    days = {r.id_api: ((r.ingested_at - 1704099600) // 86400, (r.updated_at - 1704099600) // 86400)
            for r in state.collect()}
    assert days == {"a": (0, 0), "b": (0, 2), "c": (0, 0), "d": (2, 2)}


def test_compaction_between_runs_changes_nothing(spark, layers):
    refresh(spark, layers, _fetched(spark, _record("a"), _record("b")), RUNS[0], TIMES[0])
    BronzeStore(spark, layers.bronze).compact(buckets=2)
    repeat = refresh(spark, layers, _fetched(spark, _record("a"), _record("b")), RUNS[1], TIMES[1])
    assert {o.status for o in repeat} == {"skip"}
    third = refresh(spark, layers, _fetched(spark, _record("b", "nano"), _record("c")), RUNS[2], TIMES[2])
    assert [o.rows for o in third] == [2, 2, 2]
    BronzeStore(spark, layers.bronze).compact(buckets=4)
    last = refresh(spark, layers, _fetched(spark, _record("c"), _record("a", "pub")), RUNS[3], TIMES[3])
    assert [o.rows for o in last] == [1, 1, 1]


def test_large_batches_take_the_shuffled_join(spark, layers, monkeypatch):
    monkeypatch.setattr(stages.keyed, "BROADCAST_BYTES", 0)
    refresh(spark, layers, _fetched(spark, _record("a"), _record("b")), RUNS[0], TIMES[0])
    out = refresh(spark, layers, _fetched(spark, _record("a"), _record("b", "nano")), RUNS[1], TIMES[1])
    assert [o.rows for o in out] == [1, 1, 1]


def test_the_feed_is_fetched_once(spark, layers, tmp_path):
    calls = str(tmp_path / "calls")
    os.mkdir(calls)

    def page(number, per_page):
        with open(f"{calls}/{number}-{uuid.uuid4().hex}", "w"):
            pass
        return [_record_of(f"{number}-{n}") for n in range(per_page)]

    def _record_of(key):
        return {"id": key, "name": key, "brewery_type": "micro", "city": "x", "country": "Chile"}

    spark.dataSource.register(paged_source(lambda: 600, page, "counted_pages"))
    fetched = spark.read.format("counted_pages").load()
    assert [o.rows for o in refresh(spark, layers, fetched, RUNS[0], TIMES[0])] == [600, 600, 1]
    assert sorted(name.split("-")[0] for name in os.listdir(calls)) == ["1", "2", "3"]


def test_records_in_files_need_no_landing(spark, layers, tmp_path):
    (tmp_path / "pages").mkdir()
    for n, key in ((1, "a"), (2, "b")):
        (tmp_path / "pages" / f"page_{n}.json").write_text(json.dumps([_record(key)]))
    saved = read_page_files(spark, str(tmp_path / "pages"))
    assert bronze_stage(spark, layers, saved, RUNS[0], TIMES[0], land=False).rows == 2
    assert bronze_stage(spark, layers, saved, RUNS[1], TIMES[1], land=False).status == "skip"
    assert not os.path.exists(layers.landing)


def test_duplicate_ids(spark, layers):
    batch = _fetched(spark, _record("a", "first"), _record("b"), _record("a", "last"))
    with pytest.raises(StageFailed, match="twice"):
        bronze_stage(spark, layers, batch, RUNS[0], TIMES[0], on_duplicate="error")
    assert bronze_stage(spark, layers, batch, RUNS[0], TIMES[0]).rows == 2
    state = {r.id_api: json.loads(r.payload)["brewery_type"] for r in BronzeStore(spark, layers.bronze).state().collect()}
    assert state == {"a": "last", "b": "micro"}


def test_empty_upstreams_fail(spark, layers):
    with pytest.raises(StageFailed, match="table is empty"):
        bronze_stage(spark, layers, _fetched(spark, {"id": "a"}), RUNS[0], TIMES[0])
    with pytest.raises(StageFailed, match="upstream is empty"):
        silver_stage(spark, layers, RUNS[0], TIMES[0])
    with pytest.raises(lake.NoRuns):
        gold_stage(spark, layers, RUNS[0], TIMES[0])


def test_stamps_must_grow(spark, layers):
    bronze_stage(spark, layers, _fetched(spark, _record("a")), RUNS[1], TIMES[1])
    with pytest.raises(ValueError, match="not after"):
        bronze_stage(spark, layers, _fetched(spark, _record("b")), RUNS[2], TIMES[0])


def test_retry_after_a_failed_stage(spark, layers):
    fetched = _fetched(spark, _record("a"), _record("b"))
    seen = []

    def broken(run, run_id):
        raise OSError("sink is down")

    with pytest.raises(OSError):
        refresh(spark, layers, fetched, RUNS[0], TIMES[0], silver_sinks=[broken])
    again = refresh(spark, layers, fetched, RUNS[0], TIMES[0], silver_sinks=[lambda run, run_id: seen.append(run.count())])
    assert [o.rows for o in again] == [2, 2, 1] and seen == [2]
    assert lake.read_runs(spark, layers.silver, SILVER).count() == 2


def test_a_later_run_picks_up_what_a_failed_one_left(spark, layers):
    bronze_stage(spark, layers, _fetched(spark, _record("a")), RUNS[0], TIMES[0])
    out = refresh(spark, layers, _fetched(spark, _record("a")), RUNS[1], TIMES[1])
    assert [(o.status, o.rows) for o in out] == [("skip", 0), ("proceed", 1), ("proceed", 1)]


def test_two_bronze_runs_before_one_silver_run(spark, layers):
    bronze_stage(spark, layers, _fetched(spark, _record("a"), _record("b")), RUNS[0], TIMES[0])
    bronze_stage(spark, layers, _fetched(spark, _record("a", "nano")), RUNS[1], TIMES[1])
    assert silver_stage(spark, layers, RUNS[1], TIMES[1]).rows == 2
    kinds = {r.id: r.brewery_type for r in lake.read_run(spark, layers.silver, SILVER).collect()}
    assert kinds == {"a": "Nano", "b": "Micro"}


def test_reconciliation_stops_the_run(spark, layers, monkeypatch):
    bronze_stage(spark, layers, _fetched(spark, _record("a")), RUNS[0], TIMES[0])
    monkeypatch.setattr(stages.lake, "write_run", lambda *a, _real=lake.write_run, **k: _real(*a, **k) + 1)
    with pytest.raises(StageFailed, match="wrote 2 rows, found 1"):
        silver_stage(spark, layers, RUNS[0], TIMES[0])


def test_blank_location_reads_back_as_null(spark, layers):
    bronze_stage(spark, layers, _fetched(spark, _record("a", country="")), RUNS[0], TIMES[0])
    silver_stage(spark, layers, RUNS[0], TIMES[0])
    assert lake.read_run(spark, layers.silver, SILVER).first().country is None
    silver_stage(spark, layers, RUNS[0], TIMES[0], blank_as_missing=True)
    assert lake.read_run(spark, layers.silver, SILVER).first().country == "Not Informed"


def test_session_zone_does_not_matter(spark, layers):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        refresh(spark, layers, _fetched(spark, _record("a")), RUNS[0], TIMES[0])
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        repeat = refresh(spark, layers, _fetched(spark, _record("a")), RUNS[1], TIMES[1])
        assert {o.status for o in repeat} == {"skip"}
        changed = refresh(spark, layers, _fetched(spark, _record("a", "nano")), RUNS[2], TIMES[2])
        assert [o.rows for o in changed] == [1, 1, 1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_stream_hand_over(spark, layers, tmp_path):
    store = BronzeStore(spark, layers.bronze)
    told = []

    def catch_up(checkpoint="ckpt"):
        stream_silver(
            spark, layers.bronze, layers.silver, str(tmp_path / checkpoint), clock=lambda run: TIMES[2], then=told.append
        ).awaitTermination()

    catch_up()
    bronze_stage(spark, layers, _fetched(spark, _record("a"), _record("b")), RUNS[0], TIMES[0])
    catch_up()
    catch_up()
    # The same run again, and a run that is not complete: nothing new.
    bronze_stage(spark, layers, _fetched(spark, _record("a"), _record("b")), RUNS[0], TIMES[0])
    lake.write_run(store.changed_by(store.runs()).withColumn("op", F.lit("insert")), store.changes_path, RUNS[3])
    os.remove(f"{lake.run_path(store.changes_path, RUNS[3])}/_SUCCESS")
    catch_up()
    # A lost checkpoint neither repeats nor overwrites anything.
    catch_up("other")
    assert told == [RUNS[0]]
    # Committed late, with an older stamp than silver has seen: still picked up.
    late = store.state().withColumn("id_api", F.lit("late")).limit(1).withColumn("op", F.lit("insert"))
    store.append(late.withColumn("payload", F.lit(json.dumps(_record("late")))), "20231231_0900")
    catch_up()
    assert told == [RUNS[0], "20231231_0900"]
    rows = lake.read_runs(spark, layers.silver, SILVER).collect()
    assert {(r.run_id, r.id) for r in rows} == {(RUNS[0], "a"), (RUNS[0], "b"), ("20231231_0900", "late")}


def test_a_run_repeated_after_compaction(spark, layers):
    bronze_stage(spark, layers, _fetched(spark, _record("a")), RUNS[0], TIMES[0], compact_after=1)
    BronzeStore(spark, layers.bronze).compact(buckets=2)
    again = _fetched(spark, _record("a", "nano"), _record("b"))
    assert bronze_stage(spark, layers, again, RUNS[0], TIMES[0], compact_after=1).rows == 2
    state = {r.id_api: json.loads(r.payload)["brewery_type"] for r in BronzeStore(spark, layers.bronze).state().collect()}
    assert state == {"a": "nano", "b": "micro"}
    assert silver_stage(spark, layers, RUNS[0], TIMES[0]).rows == 2


def test_an_older_run_is_refused(spark, layers):
    bronze_stage(spark, layers, _fetched(spark, _record("a")), RUNS[1], TIMES[1])
    with pytest.raises(StageFailed, match="committed already"):
        bronze_stage(spark, layers, _fetched(spark, _record("b")), RUNS[0], TIMES[0])


def test_an_older_gold_run_repeated(spark, layers):
    refresh(spark, layers, _fetched(spark, _record("a")), RUNS[0], TIMES[0])
    refresh(spark, layers, _fetched(spark, _record("a", "nano"), _record("b", "nano")), RUNS[1], TIMES[1])
    for scope in ("latest_run", "current"):
        gold_stage(spark, layers, RUNS[0], TIMES[0], scope=scope)
        first = lake.read_run(spark, layers.gold, GOLD, lake.run_name(RUNS[0]))
        assert [(r.brewery_type, r.total_breweries) for r in first.collect()] == [("Micro", 1)]


def test_rows_committed_late_reach_silver(spark, layers):
    bronze_stage(spark, layers, _fetched(spark, _record("a")), RUNS[0], TIMES[0])
    silver_stage(spark, layers, RUNS[2], TIMES[2])
    bronze_stage(spark, layers, _fetched(spark, _record("a"), _record("b")), RUNS[1], TIMES[1])
    assert silver_stage(spark, layers, RUNS[3], TIMES[3]).rows == 1
    assert silver_stage(spark, layers, "20240105_0900", datetime(2024, 1, 5, 9)).status == "skip"
    assert sorted(r.id for r in lake.read_runs(spark, layers.silver, SILVER).collect()) == ["a", "b"]


def test_a_lost_bronze_row_stops_silver(spark, layers):
    bronze_stage(spark, layers, _fetched(spark, _record("a"), _record("b")), RUNS[0], TIMES[0])
    store = BronzeStore(spark, layers.bronze)
    kept = store.state().where("id_api = 'a'").withColumn("op", F.lit("insert")).collect()
    lake.write_run(spark.createDataFrame(kept, BRONZE_CHANGES), store.changes_path, RUNS[0])
    with pytest.raises(StageFailed, match="1 of the rows"):
        silver_stage(spark, layers, RUNS[0], TIMES[0])


def test_appended_once_however_often_repeated(spark, layers, tmp_path):
    copies = str(tmp_path / "copies")
    sink = append_sink(
        "ingested_at",
        lambda: spark.read.schema(SILVER).parquet(copies) if os.path.exists(copies) else None,
        lambda df: df.write.mode("append").parquet(copies),
    )

    def broken(run, run_id):
        raise OSError("sink is down")

    fetched = _fetched(spark, _record("a"), _record("b"))
    with pytest.raises(OSError):
        refresh(spark, layers, fetched, RUNS[0], TIMES[0], [sink], [broken])
    refresh(spark, layers, fetched, RUNS[0], TIMES[0], [sink])
    assert sorted(r.id for r in spark.read.parquet(copies).collect()) == ["a", "b"]


def test_a_fetch_without_its_columns_is_refused(spark, layers):
    with pytest.raises(StageFailed, match="lacks pos"):
        bronze_stage(spark, layers, _fetched(spark, _record("a")).drop("pos"), RUNS[0], TIMES[0])


def test_a_merge_moves_only_the_batch(spark, layers):
    """Past the first load the store is bucketed: one exchange, the batch's, whatever its size."""
    bronze_stage(spark, layers, _fetched(spark, _record("a"), _record("b")), RUNS[0], TIMES[0])
    store = BronzeStore(spark, layers.bronze)
    assert store.outgrown(RUNS[1]) and not store.outgrown(RUNS[0])
    bronze_stage(spark, layers, _fetched(spark, _record("a"), _record("c")), RUNS[1], TIMES[1], broadcast_bytes=0)
    assert len(lake.list_runs(spark, store.snapshot_path)) == 1
    batch = store.changed_by([lake.run_name(RUNS[1])]).select("id_api", "payload", "updated_at").repartition(3)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        merged = stages.keyed.upsert_changes(store.layers(RUNS[1]), batch)
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("Exchange hashpartitioning") == 1, plan
    delta = store.changed_by([lake.run_name(RUNS[1])])
    assert "snapshot" not in "".join(delta.inputFiles())


def test_retention_keeps_what_later_runs_need(spark, layers):
    for n, (run, as_of) in enumerate(zip(RUNS, TIMES)):
        batch = _fetched(spark, _record("a", f"kind {n}"), _record(f"new {n}"))
        refresh(spark, layers, batch, run, as_of, compact_after=1)
    store = BronzeStore(spark, layers.bronze)
    assert len(lake.list_runs(spark, store.snapshot_path)) == 3
    assert stages.retain(spark, layers) == [lake.run_name(r) for r in RUNS[:2]]
    assert stages.retain(spark, layers) == []
    assert lake.list_runs(spark, layers.landing) == [lake.run_name(r) for r in RUNS[2:]]
    assert len(lake.list_runs(spark, store.snapshot_path)) == 2
    # The last run can be repeated, and one more follows.
    again = _fetched(spark, _record("a", "kind 3"), _record("new 3"), _record("newer"))
    assert refresh(spark, layers, again, RUNS[3], TIMES[3], compact_after=1)[0].rows == 3
    assert refresh(spark, layers, again, "20240105_0900", datetime(2024, 1, 5, 9), compact_after=1)[0].status == "skip"
    assert {r.id_api for r in store.state().collect()} == {"a", "newer", *(f"new {n}" for n in range(4))}


def test_no_records_at_all(spark, layers):
    nothing = spark.createDataFrame([], "page long, pos int, payload string")
    with pytest.raises(StageFailed, match="table is empty"):
        bronze_stage(spark, layers, nothing, RUNS[0], TIMES[0])
    bronze_stage(spark, layers, _fetched(spark, _record("a")), RUNS[0], TIMES[0])
    assert bronze_stage(spark, layers, nothing, RUNS[1], TIMES[1]).status == "skip"


def test_random_loads_against_a_dictionary(spark, layers):
    """Four random loads, compacted after every second, against the merge rules in plain Python."""
    rng = random.Random(7)
    keys = [f"k{n}" for n in range(60)]
    model = {}
    for run, as_of in zip(RUNS, TIMES):
        items = []
        for key in rng.sample(keys, 40) + rng.choices(keys, k=10):
            record = _record(key, rng.choice(["a", "b"]), tags=rng.choice([[1, 2], [2, 1], None]), n=rng.choice([1, 2]))
            if rng.random() < 0.1:
                del record["city"]
            if rng.random() < 0.05:
                record["id"] = None
            if rng.random() < 0.05:
                items.append("{broken")
                continue
            fields = list(record.items())
            rng.shuffle(fields)
            text = json.dumps(dict(fields), indent=rng.choice([None, 1]))
            items.append(text.replace('"n": 1', '"n": 1.0') if rng.random() < 0.5 else text)
        last = {}
        for text in items:
            try:
                record = json.loads(text)
            except ValueError:
                continue
            if "city" in record and record["id"] is not None:
                last[record["id"]] = record
        expected = 0
        for key, record in last.items():
            old = model.get(key)
            if old is None:
                model[key] = (record, run, run)
            elif old[0] != record:
                model[key] = (record, old[1], run)
            else:
                continue
            expected += 1
        assert bronze_stage(spark, layers, _fetched(spark, *items), run, as_of, compact_after=2).rows == expected
    run_of = {int((t - datetime(1970, 1, 1)).total_seconds()): r for t, r in zip(TIMES, RUNS)}
    state = BronzeStore(spark, layers.bronze).state().select(
        "id_api", "payload", F.unix_seconds("ingested_at"), F.unix_seconds("updated_at")
    )
    got = {r[0]: (json.loads(r[1]), run_of[r[2]], run_of[r[3]]) for r in state.collect()}
    assert got == model
