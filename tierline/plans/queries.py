"""The registered queries: every operator over whole test tables."""

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierline.functions.json import json_distinct, record_id
from tierline.functions.stamps import run_id_of, stamp
from tierline.operators import clean, counts, gates, keyed, records
from tierline.plans import feeds
from tierline.plans.stages import Layers, StageFailed, bronze_stage, gold_stage, refresh, silver_stage
from tierline.schemas import BRONZE_CHANGES, GOLD, LOCATION_COLUMNS, PAGE_SIZE, SILVER
from tierline.session import new_folder, prepare, ship_package, stage
from tierline.sources import jdbc, lake, pages
from tierline.sources.bronze import BronzeStore
from tierline.sources.jdbc import append_sink
from tierline.sources.sink import LakeRunSink
from tierline.streaming.handover import stream_bronze, stream_silver

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Two loads a day apart, and the date that splits the event history into two batches.
FIRST = datetime(2024, 1, 1, 9)
REPEAT = datetime(2024, 1, 2, 9)
SECOND = datetime(2024, 1, 3, 9)
FIRST_RUN, REPEAT_RUN, SECOND_RUN = "20240101_0900", "20240102_0900", "20240103_0900"
LATER, LATER_RUN, LATE_RUN = datetime(2024, 1, 4, 9), "20240104_0900", "20231231_0900"
SPLIT = datetime(2024, 1, 16)
LAST_DAY = datetime(2024, 1, 30)


def query(run: Query) -> Query:
    """Register under the function's name; a trailing underscore keeps a name free."""

    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(prepare(spark), sf_dir)

    QUERIES[run.__name__.rstrip("_")] = prepared
    return run


def _feed(spark, sf_dir, keep_null_keys=True):
    return feeds.with_payload(feeds.customer_records(spark, sf_dir), keep_null_keys)


def _silver(spark, sf_dir):
    return clean.silver_rows(_feed(spark, sf_dir), FIRST)


def _supplier_silver(spark, sf_dir):
    return clean.silver_rows(feeds.with_payload(feeds.supplier_records(spark, sf_dir)), SECOND)


def _seconds(column: str):
    return F.unix_seconds(column).alias(column)


# --- parsing, cleaning, counting


@query
def parse_payload(spark, sf_dir):
    return clean.parse_payload(_feed(spark, sf_dir))


@query
def parse_props(spark, sf_dir):
    events = feeds.table(spark, sf_dir, "events")
    return clean.parse_payload(events, "k STRING", "props")


@query
def silver_clean(spark, sf_dir):
    return _silver(spark, sf_dir).drop("ingested_at")


@query
def silver_clean_blank_as_missing(spark, sf_dir):
    silver = clean.silver_rows(_feed(spark, sf_dir), FIRST, blank_as_missing=True)
    return silver.select("id", "city", "state_province", "country")


@query
def gold_counts(spark, sf_dir):
    return counts.gold_counts(counts.as_stored(_silver(spark, sf_dir)))


@query
def gold_current(spark, sf_dir):
    second = clean.silver_rows(feeds.second_fetch(spark, sf_dir), SECOND)
    history = counts.as_stored(_silver(spark, sf_dir).unionByName(second))
    return counts.gold_current(history, [F.desc("ingested_at")])


# --- raw records and pages


@query
def required_keys(spark, sf_dir):
    valid = records.required_keys(_feed(spark, sf_dir, keep_null_keys=False))
    return valid.select(record_id(F.col("payload")).alias("id"))


@query
def quarantine(spark, sf_dir):
    refused = records.quarantine(_feed(spark, sf_dir, keep_null_keys=False))
    return refused.select(F.col("id_api").alias("id"), "missing_keys", "reason")


@query
def quarantine_malformed(spark, sf_dir):
    """Records with text behind their object, some of which would close a list from inside."""
    behind = F.element_at(F.array(*map(F.lit, ("", "] junk", '],[{"id":"2"}', " junk", ',{"id":"2"}'))), F.col("pos") % 5 + 1)
    records_ = _feed(spark, sf_dir).withColumn("payload", F.concat("payload", behind))
    return records.quarantine(records_).select("page", "pos", "missing_keys", "reason")


@query
def json_numbers(spark, sf_dir):
    """Order totals spelled in two ways, equal or different in a digit far behind."""
    orders = feeds.table(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    plain = F.concat(F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    digits = cents.cast("string")
    spelled = [
        F.concat(plain, F.lit("0")),
        F.concat(digits, F.lit("e-2")),
        F.concat(digits, F.lit("00E-4")),
        F.concat(digits, F.lit(".1e-2")),
        F.concat(plain, F.lit("0" * 60 + "1")),
        F.concat(F.lit("-"), plain),
    ]
    other = F.element_at(F.array(*spelled), (F.col("o_orderkey") % 6 + 1).cast("int"))
    left = F.concat(F.lit('{"key":"1e2","total":'), plain, F.lit("}"))
    right = F.concat(F.lit('{ "total": '), other, F.lit(', "key": "1e2" }'))
    return orders.select("o_orderkey", json_distinct(left, right).alias("differ"))


@query
def bronze_rows(spark, sf_dir):
    return records.bronze_rows(_feed(spark, sf_dir), FIRST).withColumn("updated_at", _seconds("updated_at"))


@query
def page_stats(spark, sf_dir):
    return records.page_stats(_feed(spark, sf_dir, keep_null_keys=False))


@query
def page_plan(spark, sf_dir):
    customers = feeds.table(spark, sf_dir, "customer")
    meta = customers.agg(F.to_json(F.struct(F.count(F.lit(1)).cast("string").alias("total"))).alias("meta"))
    total = meta.select(pages.total_records(F.col("meta"))).first()[0]
    return pages.page_plan(spark, total)


@query
def page_scan(spark, sf_dir):
    saved = stage(feeds.pages(_feed(spark, sf_dir)), "pages")
    return pages.page_records(saved)


@query
def page_files(spark, sf_dir):
    """Pages saved as text files, a folder each, and read back."""
    folder = new_folder(spark, "page_files")
    saved = feeds.pages(_feed(spark, sf_dir))
    saved.write.mode("overwrite").partitionBy("page").text(folder)
    return pages.read_page_files(spark, folder, number=r"/page=(\d+)/")


@query
def page_source(spark, sf_dir):
    """The paged source over a fetcher that looks each page up in a table of pages."""
    feed = _feed(spark, sf_dir)
    saved, fetch_page = feeds.saved_pages(feed, new_folder(spark, "page_source"))
    last = saved.agg(F.max("page")).first()[0]

    ship_package(spark)
    source = f"pages_{uuid.uuid4().hex}"
    total = (last or 0) * PAGE_SIZE
    spark.dataSource.register(pages.paged_source(lambda: str(total), fetch_page, source))
    fetched = spark.read.format(source).option("pagesPerTask", 2).load()
    return fetched.select("page", "pos", *(_json_field(f) for f in ("id", "name", "city", "phone")))


def _growing_feed(spark, sf_dir, name: str):
    """A stream over the customers' pages, and a function that lets so many of them be
    there; the totals and pages are read from the shared folder."""
    folder, feed = new_folder(spark, name), _feed(spark, sf_dir)
    saved, fetch_page = feeds.saved_pages(feed, f"{folder}/pages")

    def fetch_total() -> str:
        from pyarrow import fs

        total = f"{folder}/total"
        files, path = fs.FileSystem.from_uri(total if ":/" in total else f"file://{total}")
        return files.open_input_stream(path).read().decode()

    ship_package(spark)
    source = f"{name}_{uuid.uuid4().hex}"
    spark.dataSource.register(pages.paged_source(fetch_total, fetch_page, source))
    stream = spark.readStream.format(source).option("pagesPerTask", 2).load()
    n_records = saved.count()
    return stream, n_records, lambda total: lake.write_note(spark, f"{folder}/total", str(total))


@query
def stream_pages(spark, sf_dir):
    """Half of the records, the rest, nothing new: each a start of the stream from its
    checkpoint; the page in the middle is read twice, its records once."""
    stream, n_records, arrive = _growing_feed(spark, sf_dir, "stream_pages")
    target, checkpoint = new_folder(spark, "streamed"), new_folder(spark, "checkpoint")
    for total in (n_records // 2, n_records, n_records):
        arrive(total)
        writer = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
    streamed = spark.read.schema(stream.schema).parquet(target)
    return streamed.select("page", "pos", *(_json_field(f) for f in ("id", "name", "city", "phone")))


@query
def stream_reconcile(spark, sf_dir):
    """Two arrivals streamed into bronze: rows read and landed, a row per micro-batch."""
    stream, n_records, arrive = _growing_feed(spark, sf_dir, "stream_reconcile")
    layers, checkpoint = Layers.under(new_folder(spark, "stream_bronze")), new_folder(spark, "checkpoint")
    runs = [(FIRST_RUN, FIRST), (SECOND_RUN, SECOND)]
    counts = []
    for total in (n_records // 2, n_records):
        arrive(total)
        counts += stream_bronze(spark, layers, stream, checkpoint, lambda n: runs[n][0], lambda run: dict(runs)[run])
    rows = spark.createDataFrame([(c.batch, c.read, c.written, c.status) for c in counts], "batch int, n_read long, n_written long, status string")
    stored = BronzeStore(spark, layers.bronze).state().agg(F.count(F.lit(1))).scalar()
    return rows.withColumn("n_stored", stored)


@query
def sink_commit(spark, sf_dir):
    """Silver rows through the committing sink; a run that fails in a task leaves nothing."""
    ship_package(spark)
    spark.dataSource.register(LakeRunSink)
    base = new_folder(spark, "sink_commit")
    silver = _silver(spark, sf_dir)

    def save(rows: DataFrame, run_id: str) -> None:
        rows.write.format("lake_run").options(path=base, runId=run_id, partitionBy=",".join(LOCATION_COLUMNS)).mode("append").save()

    save(silver, FIRST_RUN)
    try:
        save(silver.withColumn("name", F.when(F.col("id") != "c7", F.col("name")).otherwise(F.raise_error(F.lit("lost")))), SECOND_RUN)
    except Exception as error:  # noqa: BLE001
        if "lost" not in str(error):
            raise
    return lake.read_runs(spark, base, SILVER).drop("ingested_at")


# --- keyed rows and upserts


@query
def latest_per_key(spark, sf_dir):
    events = feeds.table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return keyed.latest_per_key(events, "user_id", [F.desc("ts"), F.desc("event_id")])


@query
def key_check(spark, sf_dir):
    return keyed.key_check(feeds.table(spark, sf_dir, "events"), "user_id")


def _event_versions(spark, sf_dir, since: datetime = SPLIT):
    """Event types per user and hour of day: the state at SPLIT, and what came later
    (or ``since`` another time).

    Both sides write the same JSON value in a different spelling.
    """
    events = feeds.table(spark, sf_dir, "events").withColumn(
        "id_api", F.concat_ws("-", F.col("user_id"), F.hour("ts"))
    )
    split, after = gates.stamp_like(events, "ts", SPLIT), gates.stamp_like(events, "ts", since)

    def latest(part, payload):
        newest = keyed.latest_per_key(part, "id_api", [F.desc("ts"), F.desc("event_id")])
        return newest.select("id_api", payload.alias("payload"), F.col("ts").alias("updated_at"))

    kind = F.col("event_type")
    stored = latest(events.filter(F.col("ts") < split), F.format_string('{"n":1,"type":"%s"}', kind))
    batch = latest(events.filter(F.col("ts") >= after), F.format_string('{ "type": "%s", "n": 1.0 }', kind))
    return stored.withColumn("ingested_at", F.col("updated_at")), batch


@query
def upsert_changed(spark, sf_dir):
    return keyed.upsert_changed(*_event_versions(spark, sf_dir))


@query
def upsert_broadcast(spark, sf_dir):
    target, batch = _event_versions(spark, sf_dir)
    return keyed.upsert_broadcast(stage(target, "target"), stage(batch, "batch"))


@query
def upsert_changes(spark, sf_dir):
    target, batch = _event_versions(spark, sf_dir)
    return keyed.upsert_changes([target], batch)


@query
def bronze_store(spark, sf_dir):
    """Load, compact into buckets, merge a batch against them, compact again in place."""
    target, batch = _event_versions(spark, sf_dir)
    store = BronzeStore(spark, new_folder(spark, "bronze"))

    def stored(rows):
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in BRONZE_CHANGES.fields])

    store.append(stored(target.withColumn("op", F.lit("insert"))), FIRST_RUN)
    store.compact(buckets=8)
    batch = batch.withColumn("updated_at", F.col("updated_at").cast("timestamp"))
    store.append(keyed.upsert_changes(store.layers(), batch), SECOND_RUN)
    store.compact()
    state = store.state()
    return state.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("ingested_at", "updated_at")})


@query
def upsert_pruned(spark, sf_dir):
    """The events of the last day, a small batch, against a bucketed store: only the
    buckets of its keys are read."""
    target, _ = _event_versions(spark, sf_dir)
    _, batch = _event_versions(spark, sf_dir, LAST_DAY)
    store = BronzeStore(spark, new_folder(spark, "pruned"))
    rows = target.withColumn("op", F.lit("insert"))
    store.append(rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in BRONZE_CHANGES.fields]), FIRST_RUN)
    store.compact(buckets=64)
    batch = stage(batch.withColumn("updated_at", F.col("updated_at").cast("timestamp")), "batch")
    changes = keyed.upsert_changes(store.layers(keys=keyed.few_keys(batch)), batch)
    return changes.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("ingested_at", "updated_at")})


# --- gates


@query
def high_water_mark(spark, sf_dir):
    return gates.high_water_mark(feeds.table(spark, sf_dir, "events"), "ts")


@query
def change_stats(spark, sf_dir):
    return gates.change_stats(feeds.table(spark, sf_dir, "events"), "ts", SPLIT)


@query
def delta_filter(spark, sf_dir):
    return gates.delta_filter(feeds.table(spark, sf_dir, "orders"), "o_orderdate", datetime(1998, 1, 1))


@query
def latest_batch(spark, sf_dir):
    return gates.latest_batch(feeds.table(spark, sf_dir, "orders"), "o_orderdate")


@query
def bronze_gate(spark, sf_dir):
    events = feeds.table(spark, sf_dir, "events")
    verdicts = {
        "no cursor": gates.change_stats(events, "ts", None),
        "older cursor": gates.change_stats(events, "ts", SPLIT),
        "newest cursor": gates.change_stats(events, "ts", gates.latest_stamp(events, "ts")),
    }
    return _labelled({name: gates.bronze_gate(stats) for name, stats in verdicts.items()})


@query
def delta_gate(spark, sf_dir):
    events, orders = feeds.table(spark, sf_dir, "events"), feeds.table(spark, sf_dir, "orders")
    return _labelled(
        {
            "newer": gates.delta_gate(events, "ts", orders, "o_orderdate"),
            "older": gates.delta_gate(orders, "o_orderdate", events, "ts"),
            "equal": gates.delta_gate(events, "ts", events, "ts"),
            "first": gates.delta_gate(events, "ts", None, "ts"),
        }
    )


@query
def reconcile(spark, sf_dir):
    orders = feeds.table(spark, sf_dir, "orders")
    newest = gates.latest_batch(orders, "o_orderdate").agg(F.count(F.lit(1))).scalar()
    every = orders.agg(F.count(F.lit(1))).scalar()
    return _labelled(
        {
            "match": gates.reconcile(orders, "o_orderdate", newest),
            "mismatch": gates.reconcile(orders, "o_orderdate", every),
        }
    )


def _labelled(verdicts: dict[str, DataFrame]) -> DataFrame:
    rows = None
    for name, verdict in verdicts.items():
        row = verdict.withColumn("gate_case", F.lit(name))
        rows = row if rows is None else rows.unionByName(row)
    return rows


@query
def preflight(spark, sf_dir):
    needed = {
        "customer": ["c_custkey", "c_name"],
        "orders": ["o_orderkey", "o_updated_at"],
        "events": ["event_id", "ts"],
    }
    return gates.preflight({name: (feeds.table(spark, sf_dir, name), cols) for name, cols in needed.items()})


# --- lake layout


def _silver_lake(spark, sf_dir) -> str:
    """Customers as the first run, suppliers as the second."""
    base = new_folder(spark, "silver")
    lake.write_run(_silver(spark, sf_dir), base, FIRST_RUN, LOCATION_COLUMNS)
    lake.write_run(_supplier_silver(spark, sf_dir), base, SECOND_RUN, LOCATION_COLUMNS)
    return base


@query
def lake_partitioned(spark, sf_dir):
    base = new_folder(spark, "silver")
    lake.write_run(_silver(spark, sf_dir), base, FIRST_RUN, LOCATION_COLUMNS)
    return lake.read_run(spark, base, SILVER).drop("ingested_at")


@query
def lake_scan(spark, sf_dir):
    history = lake.read_runs(spark, _silver_lake(spark, sf_dir), SILVER)
    return history.select("run_id", "id", "name", *LOCATION_COLUMNS, "brewery_type", "latitude")


@query
def lake_compacted(spark, sf_dir):
    """The two silver runs packed into one, their own files removed, and a run added."""
    base = _silver_lake(spark, sf_dir)
    lake.compact(spark, base, SILVER, LOCATION_COLUMNS)
    lake.drop_packed(spark, base)
    lake.write_run(_supplier_silver(spark, sf_dir), base, LATER_RUN, LOCATION_COLUMNS)
    history = lake.read_runs(spark, base, SILVER)
    return history.select("run_id", "id", "name", *LOCATION_COLUMNS, "brewery_type", "latitude")


@query
def split_predicates(spark, sf_dir):
    """Conditions that cut skewed orders, a third of them of one customer, into even ranges:
    rows in no range or in several, and whether the largest is near the mean."""
    orders = feeds.table(spark, sf_dir, "orders")
    skewed = orders.withColumn("customer", F.when(F.col("o_orderkey") % 3 == 0, 7).otherwise(F.pow(F.col("o_custkey"), 2).cast("long")))
    ranges = jdbc.split_predicates(skewed, "customer", 16, tie="o_orderkey")
    hits = [F.expr(p).cast("int") for p in ranges]
    sizes = [F.sum(hit) for hit in hits]
    times = sum(hits[1:], hits[0])
    return skewed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(times != 1).alias("n_misplaced"),
        (F.greatest(*sizes) <= 1.5 * F.count(F.lit(1)) / len(ranges)).alias("even"),
    )


@query
def lake_pruned(spark, sf_dir):
    history = lake.read_runs(spark, _silver_lake(spark, sf_dir), SILVER)
    return history.filter(F.col("country") == "Asia").select("run_id", "id", "state_province", "city")


@query
def latest_run(spark, sf_dir):
    return lake.read_run(spark, _silver_lake(spark, sf_dir), SILVER).drop("ingested_at")


@query
def lake_table(spark, sf_dir):
    """The two silver runs as a catalog table, read by SQL: the first found by looking for
    it, the second named. Publishing a run twice is harmless."""
    base, table = new_folder(spark, "silver"), f"tierline_{uuid.uuid4().hex}.silver"
    publish = partial(lake.publish, spark, table, base, SILVER, LOCATION_COLUMNS, new_folder(spark, "database"))
    lake.write_run(_silver(spark, sf_dir), base, FIRST_RUN, LOCATION_COLUMNS)
    publish()
    lake.write_run(_supplier_silver(spark, sf_dir), base, SECOND_RUN, LOCATION_COLUMNS)
    for _ in range(2):
        publish(runs=[SECOND_RUN])
    return spark.sql(
        f"SELECT run_id, country, count(*) AS n_rows, count(latitude) AS n_located FROM {table} GROUP BY ALL"
    )


@query
def gold_snapshot(spark, sf_dir):
    base = new_folder(spark, "gold")
    totals = counts.gold_counts(counts.as_stored(_silver(spark, sf_dir)))
    lake.write_run(totals.withColumn("processed_at", stamp(FIRST)), base, FIRST_RUN)
    return lake.read_run(spark, base, GOLD).withColumn("processed_at", _seconds("processed_at"))


@query
def run_id(spark, sf_dir):
    return feeds.table(spark, sf_dir, "events").select("event_id", run_id_of("ts").alias("run_id"))


# --- stages


def _loaded(spark, sf_dir, through: str, **options) -> Layers:
    """A full first load, then the second fetch, through the given stage."""
    layers = Layers.under(new_folder(spark, through))
    fetches = [
        (_feed(spark, sf_dir), FIRST_RUN, FIRST),
        (feeds.second_fetch(spark, sf_dir), SECOND_RUN, SECOND),
    ]
    for fetched, run, as_of in fetches:
        bronze_stage(spark, layers, fetched, run, as_of, **options)
        if through != "bronze":
            silver_stage(spark, layers, run, as_of)
    return layers


def _json_field(name: str):
    return F.get_json_object("payload", f"$.{name}").alias(name)


def _bronze_state(spark, layers: Layers) -> DataFrame:
    state = BronzeStore(spark, layers.bronze).state()
    return state.select(
        "id_api", _json_field("name"), _json_field("address_2"), _seconds("ingested_at"), _seconds("updated_at")
    )


@query
def bronze_stage_(spark, sf_dir):
    return _bronze_state(spark, _loaded(spark, sf_dir, "bronze"))


@query
def bronze_stage_shuffled(spark, sf_dir):
    """As a batch too large to broadcast is merged: against the bucketed snapshot."""
    return _bronze_state(spark, _loaded(spark, sf_dir, "bronze", broadcast_bytes=0))


@query
def bronze_repeat(spark, sf_dir):
    """The second run broke off after half of the feed, was compacted, and is repeated."""
    layers = Layers.under(new_folder(spark, "bronze_repeat"))
    half = feeds.with_payload(feeds.supplier_records(spark, sf_dir).withColumn("name", F.lit("first try")))
    bronze_stage(spark, layers, _feed(spark, sf_dir), FIRST_RUN, FIRST)
    bronze_stage(spark, layers, half, SECOND_RUN, SECOND)
    BronzeStore(spark, layers.bronze).compact()
    bronze_stage(spark, layers, feeds.second_fetch(spark, sf_dir), SECOND_RUN, SECOND)
    return _bronze_state(spark, layers)


@query
def silver_late(spark, sf_dir):
    """A bronze run committed after silver ran, stamped before it: the next run reads it."""
    layers = Layers.under(new_folder(spark, "silver_late"))
    bronze_stage(spark, layers, _feed(spark, sf_dir), FIRST_RUN, FIRST)
    silver_stage(spark, layers, SECOND_RUN, SECOND)
    bronze_stage(spark, layers, feeds.second_fetch(spark, sf_dir), REPEAT_RUN, REPEAT)
    silver_stage(spark, layers, LATER_RUN, LATER)
    silver_stage(spark, layers, LATER_RUN, LATER)
    return lake.read_runs(spark, layers.silver, SILVER).drop("ingested_at")


@query
def silver_broken_repeat(spark, sf_dir):
    """A run committed late, then the silver run before it repeated and broken off: the
    earlier try stays, and the next run reads what came late."""
    layers = Layers.under(new_folder(spark, "silver_broken_repeat"))

    def broken(run: DataFrame) -> None:
        raise OSError("the disk is full")

    bronze_stage(spark, layers, _feed(spark, sf_dir), FIRST_RUN, FIRST)
    silver_stage(spark, layers, SECOND_RUN, SECOND)
    bronze_stage(spark, layers, feeds.second_fetch(spark, sf_dir), REPEAT_RUN, REPEAT)
    try:
        silver_stage(spark, layers, SECOND_RUN, SECOND, audits=[broken])
    except OSError:
        silver_stage(spark, layers, LATER_RUN, LATER)
    return lake.read_runs(spark, layers.silver, SILVER).drop("ingested_at")


@query
def silver_audit(spark, sf_dir):
    """A second run refused by an audit, then by its counts: readers see the first one."""
    layers = Layers.under(new_folder(spark, "silver_audit"))
    store = BronzeStore(spark, layers.bronze)
    bronze_stage(spark, layers, _feed(spark, sf_dir), FIRST_RUN, FIRST)
    silver_stage(spark, layers, FIRST_RUN, FIRST, audits=[gates.unique("id")])
    bronze_stage(spark, layers, feeds.second_fetch(spark, sf_dir), SECOND_RUN, SECOND)
    try:
        silver_stage(spark, layers, SECOND_RUN, SECOND, audits=[gates.share_at_most(F.col("id").startswith("s"), 0.01)])
    except gates.AuditFailed:
        fewer = stage(store.changed_by([lake.run_name(SECOND_RUN)]).withColumn("op", F.lit("insert")).where("id_api not like 's%'"))
        lake.write_run(fewer, store.changes_path, SECOND_RUN)
        try:
            silver_stage(spark, layers, SECOND_RUN, SECOND)
        except StageFailed:
            pass
    return lake.read_runs(spark, layers.silver, SILVER).drop("ingested_at")


@query
def gold_incremental(spark, sf_dir):
    """Three loads, the counts of current versions kept up to date from each delta."""
    layers = Layers.under(new_folder(spark, "gold_incremental"))
    loads = [
        (_feed(spark, sf_dir), FIRST_RUN, FIRST),
        (feeds.second_fetch(spark, sf_dir), SECOND_RUN, SECOND),
        (feeds.third_fetch(spark, sf_dir), LATER_RUN, LATER),
    ]
    for fetched, run, as_of in loads:
        refresh(spark, layers, fetched, run, as_of, scope="current")
    return lake.read_run(spark, layers.gold, GOLD).drop("processed_at")


@query
def stream_after_batch(spark, sf_dir):
    """Batch and stream over one silver layer: a batch run of the name the stream would
    use, and a layer whose only run something else wrote."""
    shared = Layers.under(new_folder(spark, "stream_after_batch"))
    bronze_stage(spark, shared, _feed(spark, sf_dir), FIRST_RUN, FIRST)
    silver_stage(spark, shared, SECOND_RUN, FIRST)
    bronze_stage(spark, shared, feeds.second_fetch(spark, sf_dir), SECOND_RUN, SECOND)
    unnoted = Layers(shared.landing, shared.bronze, f"{shared.silver}_unnoted", shared.gold)
    whole = BronzeStore(spark, shared.bronze).changed_by([lake.run_name(FIRST_RUN)])
    lake.write_run(clean.silver_rows(whole, FIRST), unnoted.silver, FIRST_RUN, LOCATION_COLUMNS)
    rows = None
    for name, layers in (("shared", shared), ("unnoted", unnoted)):
        for _ in range(2):
            stream_silver(spark, layers.bronze, layers.silver, new_folder(spark, "checkpoint")).awaitTermination()
        found = lake.read_runs(spark, layers.silver, SILVER).select(F.lit(name).alias("layer"), "run_id", "id", "address_2", "full_address")
        rows = found if rows is None else rows.unionByName(found)
    return rows


@query
def gold_repeat(spark, sf_dir):
    """Both runs counted, then the first one repeated: it does not see the second."""
    layers = _loaded(spark, sf_dir, "silver")
    gold_stage(spark, layers, FIRST_RUN, FIRST)
    gold_stage(spark, layers, SECOND_RUN, SECOND)
    gold_stage(spark, layers, FIRST_RUN, FIRST)
    return lake.read_runs(spark, layers.gold, GOLD).drop("processed_at")


@query
def silver_stage_(spark, sf_dir):
    layers = _loaded(spark, sf_dir, "silver")
    return lake.read_runs(spark, layers.silver, SILVER).withColumn("ingested_at", _seconds("ingested_at"))


@query
def gold_stage_(spark, sf_dir):
    layers = _loaded(spark, sf_dir, "silver")
    gold_stage(spark, layers, SECOND_RUN, SECOND)
    return lake.read_run(spark, layers.gold, GOLD).withColumn("processed_at", _seconds("processed_at"))


@query
def gold_stage_current(spark, sf_dir):
    layers = _loaded(spark, sf_dir, "silver")
    gold_stage(spark, layers, SECOND_RUN, SECOND, scope="current")
    return lake.read_run(spark, layers.gold, GOLD).drop("processed_at")


@query
def medallion(spark, sf_dir):
    """Full load, the same feed again (every layer skips), then the changed feed."""
    layers = Layers.under(new_folder(spark, "medallion"))
    feed = _feed(spark, sf_dir)
    refresh(spark, layers, feed, FIRST_RUN, FIRST)
    refresh(spark, layers, feed, REPEAT_RUN, REPEAT)
    refresh(spark, layers, feeds.second_fetch(spark, sf_dir), SECOND_RUN, SECOND)
    return lake.read_runs(spark, layers.gold, GOLD).drop("processed_at")


@query
def medallion_repeat(spark, sf_dir):
    """The first run breaks off after silver and is repeated; an append sink has each row once."""
    layers = Layers.under(new_folder(spark, "medallion_repeat"))
    copies = f"{layers.silver}_copies"

    def stored():
        return spark.read.schema(SILVER).parquet(copies) if lake.exists(spark, copies) else None

    def broken(run: DataFrame, run_id: str) -> None:
        raise OSError("the gold sink is down")

    sink = append_sink("ingested_at", stored, lambda df: df.write.mode("append").parquet(copies))
    try:
        refresh(spark, layers, _feed(spark, sf_dir), FIRST_RUN, FIRST, [sink], [broken])
    except OSError:
        refresh(spark, layers, _feed(spark, sf_dir), FIRST_RUN, FIRST, [sink])
    refresh(spark, layers, feeds.second_fetch(spark, sf_dir), SECOND_RUN, SECOND, [sink])
    return stored().drop("ingested_at")


@query
def stream_silver_(spark, sf_dir):
    """Bronze load, stream, stream again with nothing new, second load, stream."""
    layers = Layers.under(new_folder(spark, "stream"))
    checkpoint = new_folder(spark, "checkpoint")

    def catch_up():
        stream_silver(spark, layers.bronze, layers.silver, checkpoint).awaitTermination()

    bronze_stage(spark, layers, _feed(spark, sf_dir), FIRST_RUN, FIRST)
    catch_up()
    catch_up()
    bronze_stage(spark, layers, feeds.second_fetch(spark, sf_dir), SECOND_RUN, SECOND)
    catch_up()
    return lake.read_runs(spark, layers.silver, SILVER).drop("ingested_at")


@query
def stream_repeat(spark, sf_dir):
    """A run repeated, one that was never committed, a lost checkpoint, and a late run."""
    layers = Layers.under(new_folder(spark, "stream_repeat"))
    store = BronzeStore(spark, layers.bronze)

    def catch_up(checkpoint: str) -> None:
        stream_silver(spark, layers.bronze, layers.silver, checkpoint).awaitTermination()

    checkpoint = new_folder(spark, "checkpoint")
    for _ in range(2):
        bronze_stage(spark, layers, _feed(spark, sf_dir), FIRST_RUN, FIRST)
        catch_up(checkpoint)
    lake.write_run(store.changed_by(store.runs()).withColumn("op", F.lit("insert")), store.changes_path, SECOND_RUN)
    lake.drop_note(spark, f"{lake.run_path(store.changes_path, SECOND_RUN)}/_SUCCESS")
    checkpoint = new_folder(spark, "checkpoint")
    catch_up(checkpoint)
    late = records.accepted(records.examined(feeds.with_payload(feeds.supplier_records(spark, sf_dir))))
    stamps = {"ingested_at": stamp(FIRST), "updated_at": stamp(FIRST), "op": F.lit("insert")}
    store.append(late.withColumns(stamps), LATE_RUN)
    catch_up(checkpoint)
    return lake.read_runs(spark, layers.silver, SILVER).drop("ingested_at")
