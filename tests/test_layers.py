"""Runs that break off, are refused, repeated or read by two readers; counts kept up to date."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tierline.operators import clean, gates
from tierline.plans import stages
from tierline.plans.stages import Layers, StageFailed, bronze_stage, gold_stage, refresh, silver_stage
from tierline.schemas import GOLD, GOLD_KEYS, LOCATION_COLUMNS, SILVER, SILVER_STORED
from tierline.sources import lake
from tierline.sources.bronze import BronzeStore
from tierline.streaming.handover import stream_silver

RUNS = [f"2024010{d}_0900" for d in range(1, 7)]
TIMES = [datetime(2024, 1, d, 9) for d in range(1, 7)]


def _record(key, kind="micro", country="Chile", **more):
    return {"id": key, "name": key, "brewery_type": kind, "city": "x", "country": country, "state_province": "s"} | more


def _fetched(spark, *items):
    return spark.createDataFrame([(1, n, json.dumps(i)) for n, i in enumerate(items)], "page long, pos int, payload string")


@pytest.fixture
def layers(tmp_path):
    return Layers.under(str(tmp_path))


def _silver(spark, layers):
    return sorted((r.run_id, r.id) for r in lake.read_runs(spark, layers.silver, SILVER).collect())


def _counts(df):
    return {tuple(r[k] for k in GOLD_KEYS): r.total_breweries for r in df.collect()}


def _recounted(spark, layers, upto=None):
    runs = [r for r in lake.list_runs(spark, layers.silver) if upto is None or r <= lake.run_name(upto)]
    return _counts(stages.counts.gold_current(lake.read_runs(spark, layers.silver, SILVER, runs), [F.desc("run_id")]))


@pytest.mark.parametrize("point", ["writing", "audit", "note", "rename"])
def test_a_failed_repeat_loses_nothing(spark, layers, monkeypatch, point):
    bronze_stage(spark, layers, _fetched(spark, _record("a")), RUNS[0], TIMES[0])
    silver_stage(spark, layers, RUNS[2], TIMES[2])
    bronze_stage(spark, layers, _fetched(spark, _record("a"), _record("b")), RUNS[1], TIMES[1])
    with monkeypatch.context() as m:
        if point == "writing":
            rows = clean.silver_rows
            m.setattr(clean, "silver_rows", lambda *a, **k: rows(*a, **k).withColumn("name", F.raise_error(F.lit("disk full")).cast("string")))
        elif point == "rename":
            m.setattr(lake, "_publish_staged", lambda *a: (_ for _ in ()).throw(OSError("disk full")))
        elif point == "note":
            m.setattr(lake, "write_note", lambda *a: (_ for _ in ()).throw(OSError("disk full")))
        audits = [lambda run: (_ for _ in ()).throw(OSError("disk full"))] if point == "audit" else []
        with pytest.raises(Exception, match="disk full"):
            silver_stage(spark, layers, RUNS[2], TIMES[2], audits=audits)
    assert _silver(spark, layers) == [(RUNS[2], "a")]
    assert silver_stage(spark, layers, RUNS[3], TIMES[3]).rows == 1
    assert _silver(spark, layers) == [(RUNS[2], "a"), (RUNS[3], "b")]
    # Repeated now, the run has its own rows and not those another run has read.
    assert silver_stage(spark, layers, RUNS[2], TIMES[2]).rows == 1
    assert _silver(spark, layers) == [(RUNS[2], "a"), (RUNS[3], "b")]
    assert os.listdir(f"{layers.silver}/{lake.STAGING}") == []


def test_a_run_lost_between_its_renames_is_read_again(spark, layers):
    bronze_stage(spark, layers, _fetched(spark, _record("a")), RUNS[0], TIMES[0])
    silver_stage(spark, layers, RUNS[0], TIMES[0])
    lake.drop_run(spark, layers.silver, RUNS[0])
    assert silver_stage(spark, layers, RUNS[1], TIMES[1]).rows == 1
    assert silver_stage(spark, layers, RUNS[0], TIMES[0]).status == "skip"
    assert _silver(spark, layers) == [(RUNS[1], "a")]


def test_a_failed_bronze_repeat_keeps_the_earlier_try(spark, layers, monkeypatch):
    bronze_stage(spark, layers, _fetched(spark, _record("a")), RUNS[0], TIMES[0])
    with monkeypatch.context() as m:
        m.setattr(lake, "_publish_staged", lambda *a: (_ for _ in ()).throw(OSError("disk full")))
        with pytest.raises(OSError):
            bronze_stage(spark, layers, _fetched(spark, _record("b")), RUNS[0], TIMES[0])
    assert [r.id_api for r in BronzeStore(spark, layers.bronze).state().collect()] == ["a"]
    assert silver_stage(spark, layers, RUNS[0], TIMES[0]).rows == 1


def test_a_note_is_replaced_as_a_whole(spark, tmp_path):
    path = f"{tmp_path}/notes/a"
    for text in ("one\ntwo", "three"):
        lake.write_note(spark, path, text)
        assert lake.read_notes(spark, f"{tmp_path}/notes") == {"a": text.split("\n")}
    assert [f for f in os.listdir(tmp_path / "notes") if not f.endswith(".crc")] == ["a"]


def test_audits_refuse_a_run(spark, layers):
    bronze_stage(spark, layers, _fetched(spark, _record("a")), RUNS[0], TIMES[0])
    refused = gates.share_at_most(F.col("country") == "Chile", 0.5)
    with pytest.raises(gates.AuditFailed, match="1 of 1 rows"):
        silver_stage(spark, layers, RUNS[0], TIMES[0], audits=[gates.unique("id"), refused])
    assert lake.list_runs(spark, layers.silver) == [] and lake.read_notes(spark, f"{layers.silver}_consumed") == {}
    with pytest.raises(gates.AuditFailed, match="id x: duplicate key"):
        gates.unique("id")(spark.createDataFrame([("x",), ("x",), ("y",)], "id string"))
    assert silver_stage(spark, layers, RUNS[0], TIMES[0], audits=[gates.unique("id")]).rows == 1
    with pytest.raises(gates.AuditFailed):
        gold_stage(spark, layers, RUNS[0], TIMES[0], audits=[refused])
    assert lake.list_runs(spark, layers.gold) == []


def test_rows_lost_while_staged_stop_the_run(spark, layers, monkeypatch):
    bronze_stage(spark, layers, _fetched(spark, _record("a"), _record("b", country="Peru")), RUNS[0], TIMES[0])
    read = lake.read_runs
    monkeypatch.setattr(lake, "read_runs", lambda spark, base, *a: read(spark, base, *a).where("country = 'Peru'") if lake.STAGING in base else read(spark, base, *a))
    with pytest.raises(StageFailed, match="wrote 2 rows, found 1"):
        silver_stage(spark, layers, RUNS[0], TIMES[0])
    monkeypatch.setattr(lake, "read_runs", read)
    assert lake.list_runs(spark, layers.silver) == []


def _stream(spark, layers, tmp_path, name, **options):
    stream_silver(spark, layers.bronze, layers.silver, str(tmp_path / name), **options).awaitTermination()


def test_the_stream_replaces_no_batch_run(spark, layers, tmp_path):
    bronze_stage(spark, layers, _fetched(spark, _record("a")), RUNS[0], TIMES[0])
    silver_stage(spark, layers, RUNS[1], TIMES[1])
    bronze_stage(spark, layers, _fetched(spark, _record("a"), _record("b")), RUNS[1], TIMES[1])
    for name in ("one", "two"):
        _stream(spark, layers, tmp_path, name)
    assert _silver(spark, layers) == [(RUNS[1], "a"), (f"{RUNS[1]}_2", "b")]
    assert silver_stage(spark, layers, RUNS[2], TIMES[2]).status == "skip"
    # The stream's stamp is that of its rows, so a batch run of the past's next day follows.
    bronze_stage(spark, layers, _fetched(spark, _record("c")), RUNS[2], TIMES[2])
    assert silver_stage(spark, layers, RUNS[2], TIMES[2]).rows == 1


def test_the_stream_does_not_double_a_run_without_a_note(spark, layers, tmp_path):
    bronze_stage(spark, layers, _fetched(spark, _record("a")), RUNS[0], TIMES[0])
    whole = BronzeStore(spark, layers.bronze).state()
    lake.write_run(clean.silver_rows(whole, TIMES[0]), layers.silver, RUNS[0], LOCATION_COLUMNS)
    _stream(spark, layers, tmp_path, "one")
    assert silver_stage(spark, layers, RUNS[1], TIMES[1]).status == "skip"
    assert _silver(spark, layers) == [(RUNS[0], "a")]


def test_the_stream_reads_a_run_whose_note_was_lost(spark, layers, tmp_path):
    store = BronzeStore(spark, layers.bronze)
    bronze_stage(spark, layers, _fetched(spark, _record("a")), RUNS[0], TIMES[0])
    lake.drop_note(spark, f"{store.commits_path}/{lake.run_name(RUNS[0])}")
    _stream(spark, layers, tmp_path, "one")
    bronze_stage(spark, layers, _fetched(spark, _record("a"), _record("b")), RUNS[1], TIMES[1])
    _stream(spark, layers, tmp_path, "one")
    assert _silver(spark, layers) == [(RUNS[1], "a"), (RUNS[1], "b")]


# --- counts kept up to date


def test_counts_follow_every_change(spark, layers):
    """Ids that come, move, change without moving, move back; groups that end."""
    loads = [
        [_record("a"), _record("b"), _record("c", country="Peru")],
        [_record("a", "nano"), _record("b", name="other"), _record("d", country="")],
        [_record("a"), _record("c", country=None), _record("d", country="Peru")],
        [_record("a"), _record("b"), _record("e", None)],
    ]
    for load, run, as_of in zip(loads, RUNS, TIMES):
        refresh(spark, layers, _fetched(spark, *load), run, as_of, scope="current")
        assert _counts(lake.read_run(spark, layers.gold, GOLD)) == _recounted(spark, layers)
    assert _counts(lake.read_run(spark, layers.gold, GOLD)) == {
        ("Chile", "S", "Micro"): 2, ("Not Informed", "S", "Micro"): 1, ("Peru", "S", "Micro"): 1, ("Chile", "S", None): 1,
    }


def test_only_the_last_counts_and_the_delta_are_read(spark, layers):
    for n, (run, as_of) in enumerate(zip(RUNS[:3], TIMES)):
        refresh(spark, layers, _fetched(spark, _record("a", f"kind {n}"), _record(f"new {n}")), run, as_of, scope="current")
    past = stages.SilverPast.of(spark, layers.silver)
    counted = lake.commits(spark, layers.gold)
    totals, expected = stages.current_counts(spark, layers, past, list(past.notes), list(counted)[:-1], counted)
    read = {path.removeprefix("file://").removeprefix(layers.gold.rsplit("/", 1)[0] + "/").split("/run_id=")[0] + path.split("/run_id=")[1].split("/")[0] for path in totals.inputFiles()}
    assert read == {f"gold{RUNS[1]}", f"silver{RUNS[2]}"}
    assert expected == 4 and _counts(totals) == _recounted(spark, layers)
    plan = totals._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") <= 2 and "Window" not in plan and "Join" not in plan


@pytest.mark.parametrize("case", ["repeated", "late", "rule", "unnoted"])
def test_counted_anew_where_a_delta_does_not_follow(spark, layers, tmp_path, case):
    refresh(spark, layers, _fetched(spark, _record("a"), _record("b")), RUNS[0], TIMES[0], scope="current")
    refresh(spark, layers, _fetched(spark, _record("a", "nano"), _record("b")), RUNS[2], TIMES[2], scope="current")
    if case == "repeated":
        silver_stage(spark, layers, RUNS[2], TIMES[2])
    elif case == "late":
        # A silver run of an older name than the last, with another version of "a".
        BronzeStore(spark, layers.bronze).append(
            BronzeStore(spark, layers.bronze).state().where("id_api = 'a'").withColumn("payload", F.lit(json.dumps(_record("a", "pub")))).withColumn("op", F.lit("update")), RUNS[1]
        )
        stream_silver(spark, layers.bronze, layers.silver, str(tmp_path / "ckpt")).awaitTermination()
    elif case == "rule":
        bronze_stage(spark, layers, _fetched(spark, _record("a", "nano", country="")), RUNS[3], TIMES[3])
        silver_stage(spark, layers, RUNS[3], TIMES[3], blank_as_missing=True)
    else:
        rows = clean.silver_rows(BronzeStore(spark, layers.bronze).state().where("id_api = 'b'"), TIMES[3])
        lake.write_run(rows.withColumn("brewery_type", F.lit("Pub")), layers.silver, RUNS[3], LOCATION_COLUMNS)
    bronze_stage(spark, layers, _fetched(spark, _record("c"), _record("a", "large")), RUNS[4], TIMES[4])
    silver_stage(spark, layers, RUNS[4], TIMES[4])
    gold_stage(spark, layers, RUNS[4], TIMES[4], scope="current")
    assert _counts(lake.read_run(spark, layers.gold, GOLD)) == _recounted(spark, layers)
    # From there on deltas follow again.
    bronze_stage(spark, layers, _fetched(spark, _record("c", "nano"), _record("b", country="Peru")), RUNS[5], TIMES[5])
    silver_stage(spark, layers, RUNS[5], TIMES[5])
    gold_stage(spark, layers, RUNS[5], TIMES[5], scope="current")
    assert _counts(lake.read_run(spark, layers.gold, GOLD)) == _recounted(spark, layers)


def test_two_bronze_runs_in_one_delta(spark, layers):
    refresh(spark, layers, _fetched(spark, _record("a"), _record("b")), RUNS[0], TIMES[0], scope="current")
    for n, kind in ((1, "nano"), (2, "pub")):
        bronze_stage(spark, layers, _fetched(spark, _record("a", kind), _record(f"new {n}"), _record("new 1", kind)), RUNS[n], TIMES[n])
    silver_stage(spark, layers, RUNS[3], TIMES[3])
    gold_stage(spark, layers, RUNS[3], TIMES[3], scope="current")
    assert _counts(lake.read_run(spark, layers.gold, GOLD)) == _recounted(spark, layers)
    last = lake.read_runs(spark, layers.silver, SILVER_STORED, [lake.run_name(RUNS[3])])
    assert {r.id: r.previous and r.previous.brewery_type for r in last.collect()} == {"a": "Micro", "new 1": None, "new 2": None}


def test_an_older_incremental_run_repeated(spark, layers):
    for n, (run, as_of) in enumerate(zip(RUNS[:3], TIMES)):
        refresh(spark, layers, _fetched(spark, _record("a", f"kind {n}"), _record(f"new {n}")), run, as_of, scope="current")
    gold_stage(spark, layers, RUNS[1], TIMES[1], scope="current")
    assert _counts(lake.read_run(spark, layers.gold, GOLD, lake.run_name(RUNS[1]))) == _recounted(spark, layers, RUNS[1])


def test_counts_that_do_not_add_up_are_refused(spark, layers, monkeypatch):
    refresh(spark, layers, _fetched(spark, _record("a"), _record("b")), RUNS[0], TIMES[0])
    bronze_stage(spark, layers, _fetched(spark, _record("c")), RUNS[1], TIMES[1])
    silver_stage(spark, layers, RUNS[1], TIMES[1])
    monkeypatch.setattr(stages.counts, "gold_counts", lambda rows: rows.groupBy(*GOLD_KEYS).agg((F.count("*") + 1).alias("total_breweries")))
    with pytest.raises(StageFailed, match="counted 2 rows, there are 1"):
        gold_stage(spark, layers, RUNS[1], TIMES[1])
    assert lake.list_runs(spark, layers.gold) == [lake.run_name(RUNS[0])]


@pytest.mark.parametrize("few", [0, 64])
def test_notes_read_alike_by_job_or_not(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(lake, "FEW_NOTES", few)
    notes = {"a": ["one", "two"], "b.c": ["é"]}
    for name, lines in notes.items():
        lake.write_note(spark, f"{tmp_path}/notes/{name}", "\n".join(lines))
    (tmp_path / "notes" / "_hidden").write_text("x")
    assert lake.read_notes(spark, f"{tmp_path}/notes") == notes
    assert lake.read_notes(spark, f"{tmp_path}/none") == {}
