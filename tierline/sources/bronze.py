"""Keyed bronze store on plain Parquet: per-run changes over a bucketed snapshot.

``<base>/changes/run_id=<id>`` holds the rows a run inserted or changed, so a run
writes what changed, not the table; an update also has the payload it replaced.
``<base>/commits/run_id=<id>`` notes how many they are; it is written last, and the stream
follows these notes. ``<base>/snapshot/
run_id=<id>.b<N>`` holds the full state up to that run, hash-bucketed by key into N files:
joins on the key read it in place and shuffle only the other side. A run becomes visible
as a whole; a run that is repeated finds the state before its first try.
"""

import hashlib
import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierline.functions.stamps import moment, stamp
from tierline.operators import keyed
from tierline.operators.keyed import KEY, latest_per_key
from tierline.schemas import BRONZE, BRONZE_STORED
from tierline.sources import lake

# Bytes of Parquet per bucket that compaction aims at, and the least number of buckets.
BUCKET_BYTES = 256 << 20
LEAST_BUCKETS = 8

# Most bytes of a row group's Bloom filter on the key.
BLOOM_BYTES = 1 << 20

# Change runs, or part of the snapshot's size, from which they are folded into it.
FOLD_RUNS = 8
FOLD_SHARE = 0.25


def _run_of(folder: str) -> str:
    """Run folder name without a snapshot's bucket suffix."""
    return re.sub(r"\.b\d+$", "", folder)


class BronzeStore:
    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.changes_path = f"{base.rstrip('/')}/changes"
        self.snapshot_path = f"{base.rstrip('/')}/snapshot"
        self.commits_path = f"{base.rstrip('/')}/commits"

    def _visible(self, path: str, run_id: str | None, inclusive: bool) -> list[str]:
        """Run folders up to ``run_id``, oldest first."""
        limit = run_id and lake.run_name(run_id)

        def seen(run: str) -> bool:
            return limit is None or run < limit or (inclusive and run == limit)

        return [name for name in lake.list_runs(self.spark, path) if seen(_run_of(name))]

    def _parts(self, run_id: str | None = None, inclusive: bool = False) -> tuple[str | None, list[str]]:
        """Newest snapshot and the change runs after it, up to ``run_id``."""
        snapshot = next(reversed(self._visible(self.snapshot_path, run_id, inclusive)), None)
        changes = self._visible(self.changes_path, run_id, inclusive)
        return snapshot, [c for c in changes if snapshot is None or c > _run_of(snapshot)]

    def layers(self, before: str | None = None, keys: Sequence[str] | None = None) -> list[DataFrame]:
        """Snapshot and later changes, oldest first, each unique per key.

        ``before`` hides that run and newer ones, so a retry starts from the same state.
        With ``keys``, few literals, only their rows: of the snapshot the buckets that hold
        them are read, and of the files the row groups whose Bloom filters may.
        """
        snapshot, changes = self._parts(before)
        layers = []
        wanted = F.lit(True) if keys is None else F.col(KEY).isin(list(keys))
        if snapshot:
            layers.append(self._snapshot(snapshot).where(wanted))
        if changes:
            log = self._log(changes).where(wanted)
            # One run holds a key once; only several runs need versioning.
            if len(changes) > 1:
                log = latest_per_key(log.select(*BRONZE.fieldNames(), "run_id"), KEY, [F.desc("run_id")])
            layers.append(log.select(*BRONZE.fieldNames()))
        return layers

    def state(self, before: str | None = None) -> DataFrame:
        """The current rows: snapshot rows not superseded, and the newest changes."""
        layers = self.layers(before)
        if not layers:
            return self.spark.createDataFrame([], BRONZE)
        if len(layers) == 1:
            return layers[0]
        base, newer = layers
        return base.join(newer.select(KEY), KEY, "left_anti").unionByName(newer)

    def runs(self, upto: str | None = None) -> list[str]:
        """Change runs up to ``upto``, oldest first; the newest snapshot stands for the
        runs it holds if their folders are gone."""
        snapshot, _ = self._parts(upto, inclusive=True)
        changes = self._visible(self.changes_path, upto, inclusive=True)
        if snapshot and not any(c <= _run_of(snapshot) for c in changes):
            changes.insert(0, _run_of(snapshot))
        return changes

    def newer_runs(self, run_id: str) -> list[str]:
        return [r for r in lake.list_runs(self.spark, self.changes_path) if r > lake.run_name(run_id)]

    def changed_by(self, runs: list[str]) -> DataFrame:
        """Newest version of each key among the rows of some :meth:`runs`, read from
        their change folders only."""
        return self.changes_of(runs).select(*BRONZE.fieldNames())

    def changes_of(self, runs: list[str]) -> DataFrame:
        """As :meth:`changed_by`, with the payload that was ``replaced`` by the oldest of
        the rows of a key: what was stored before all of the runs."""
        rows = self._rows_of(runs)
        columns = BRONZE.fieldNames()
        if len(runs) > 1:
            newest = F.max_by(F.struct(*columns), "run_id").alias("newest")
            oldest = F.min_by(F.struct("replaced"), "run_id").alias("oldest")
            rows = rows.groupBy(KEY).agg(newest, oldest).select("newest.*", "oldest.replaced")
        return rows.select(*columns, "replaced")

    def notes(self, runs: list[str]) -> dict[str, list[str]]:
        """Commit notes of the runs: their number of rows, and whether these know what they
        replaced."""
        return {name: lines for name, lines in lake.read_notes(self.spark, self.commits_path).items() if name in runs}

    def missing_rows(self, runs: list[str], notes: dict[str, list[str]] | None = None) -> int:
        """Rows that were committed by the runs and are not there; from file footers."""
        here = {r for r in lake.list_runs(self.spark, self.changes_path) if r in runs}
        notes = {name: int(lines[0]) for name, lines in (notes or self.notes(runs)).items() if name in here}
        found = self._rows_of(list(notes)).count() if notes else 0
        return sum(notes.values()) - found

    def _rows_of(self, runs: list[str]) -> DataFrame:
        folders = set(lake.list_runs(self.spark, self.changes_path))
        columns = (*BRONZE.fieldNames(), "run_id")
        rows = self._log([r for r in runs if r in folders]).select(*columns, "replaced")
        if any(r not in folders for r in runs):
            snapshot = next(s for s in lake.list_runs(self.spark, self.snapshot_path) if _run_of(s) in runs)
            whole = self._snapshot(snapshot).withColumn("run_id", F.lit("")).select(*columns, F.lit(None).cast("string").alias("replaced"))
            rows = whole.unionByName(rows)
        return rows

    def last_stamp(self, run_id: str | None = None, inclusive: bool = True) -> datetime | None:
        """The high-water mark: the stamp of the last run, which all its rows share. Stamps
        grow from run to run and a run without changes is not kept. The snapshot is asked
        only if the run's own folder is gone."""
        snapshot, later = self._parts(run_id, inclusive)
        runs = self._visible(self.changes_path, run_id, inclusive)[-1:]
        if snapshot and not later and runs != [_run_of(snapshot)]:
            return moment(self._snapshot(snapshot).agg(F.unix_micros(F.max("updated_at"))).first()[0])
        return lake.run_stamp(self._log(runs), "updated_at")

    def stamp_of(self, runs: list[str]) -> datetime:
        """The newest stamp among the rows of some runs."""
        return moment(self._rows_of(runs).agg(F.unix_micros(F.max("updated_at"))).first()[0])

    def stats(self, run_id: str, cursor: datetime | None) -> DataFrame:
        """Stored keys, and rows of ``run_id`` newer than the cursor, as the bronze gate
        takes them: snapshot rows plus later inserts. Payloads are not read."""
        snapshot, changes = self._parts(run_id)
        run = lake.run_name(run_id)
        committed = run in lake.list_runs(self.spark, self.changes_path)
        newer = F.lit(True) if cursor is None else F.col("updated_at") > stamp(cursor)
        total = F.count_if(F.col("op") == "insert")
        if snapshot:
            total = total + self._snapshot(snapshot).agg(F.count(F.lit(1))).scalar()
        log = self._log(changes + [run] if committed else changes)
        return log.agg(
            total.alias("total"),
            F.count_if((F.col("run_id") == run_id) & newer).alias("changed"),
        )

    def append(self, changes: DataFrame, run_id: str) -> int:
        """Store one run's inserts and updates, if any; returns their number. Until all are
        written, an earlier try of the run stays what readers see.

        A first load is written as its own shuffle spread it; later runs are what is left
        of a larger batch, so their files are sized anew.
        """
        later = any(self._parts(run_id))
        self._forget_snapshots(run_id)
        knows = "replaced" in changes.columns
        rows = (changes if knows else changes.withColumn("replaced", F.lit(None).cast("string"))).select(*BRONZE_STORED.fieldNames())
        written = lake.write_run(rows, self.changes_path, run_id, rebalance=later)
        note = f"{self.commits_path}/{lake.run_name(run_id)}"
        if written == 0:
            lake.drop_run(self.spark, self.changes_path, run_id)
            lake.drop_note(self.spark, note)
        else:
            lake.write_note(self.spark, note, f"{written}\nreplaced" if knows else str(written))
        return written

    def _forget_snapshots(self, run_id: str) -> None:
        """Drop snapshots that hold the run already: it is about to be written again."""
        folders = set(lake.list_runs(self.spark, self.changes_path))
        for name in lake.list_runs(self.spark, self.snapshot_path):
            if _run_of(name) >= lake.run_name(run_id):
                if _run_of(name) not in folders:
                    raise RuntimeError(f"{name} is all that is left of its runs: {run_id} cannot be repeated")
                self._drop_snapshot(name)

    def pending(self, before: str | None = None) -> int:
        """Change runs not yet folded into a snapshot."""
        return len(self._parts(before)[1])

    def outgrown(self, before: str | None = None) -> bool:
        """Whether the changes should be folded: a first load always, later ones when
        they are many, or large beside the snapshot."""
        snapshot, changes = self._parts(before)
        if not snapshot or not changes:
            return bool(changes)
        size = sum(lake.folder_bytes(self.spark, f"{self.changes_path}/{c}") for c in changes)
        return len(changes) >= FOLD_RUNS or size > FOLD_SHARE * lake.folder_bytes(self.spark, f"{self.snapshot_path}/{snapshot}")

    def compact(self, buckets: int | None = None, before: str | None = None) -> str | None:
        """Fold all changes, or those of runs before ``before``, into a new bucketed
        snapshot named after the last of them.

        While the bucket number stays, the old snapshot is merged bucket by bucket in
        place and only the changes are shuffled. Older folders are left for the caller's
        retention rules; readers move to the new snapshot by themselves.
        """
        snapshot, changes = self._parts(before)
        if not changes:
            return snapshot
        current = int(snapshot.rpartition(".b")[2]) if snapshot else 0
        if buckets is None:
            wanted = self._wanted_buckets(snapshot, changes)
            # Buckets may double in size before the table is spread anew.
            buckets = wanted if wanted > 2 * current else current
        if buckets == current:
            state = keyed.overlay(*self.layers(before))
        else:
            # One task per bucket file: the shuffle uses the hash the bucket layout uses.
            state = self.state(before).repartition(buckets, KEY)
        name = f"{changes[-1]}.b{buckets}"
        path = f"{self.snapshot_path}/{name}"
        table = self._table_name(path)
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        writer = state.write.mode("overwrite").bucketBy(buckets, KEY).sortBy(KEY)
        # The size of a filter follows from the keys a row group holds, up to this many bytes.
        writer = writer.option(f"parquet.bloom.filter.enabled#{KEY}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
        writer = writer.option("parquet.bloom.filter.max.bytes", str(BLOOM_BYTES))
        writer.option("path", path).format("parquet").saveAsTable(table)
        return name

    def retain(self, read: set[str]) -> list[str]:
        """Remove what no reader needs any more: all snapshots but the last two, and the
        change runs that the older of these holds and that downstream has read (``read``).
        The last runs can still be repeated. Returns the names of the removed runs."""
        *old, kept = lake.list_runs(self.spark, self.snapshot_path)[:-1] or [None]
        for name in old:
            self._drop_snapshot(name)
        covered = [r for r in lake.list_runs(self.spark, self.changes_path) if kept and r <= _run_of(kept) and r in read]
        for run in covered:
            lake.drop_run(self.spark, self.changes_path, run.removeprefix("run_id="))
        return covered

    def _drop_snapshot(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table_name(f'{self.snapshot_path}/{name}')}")
        lake.drop_run(self.spark, self.snapshot_path, name.removeprefix("run_id="))

    def _wanted_buckets(self, snapshot: str | None, changes: list[str]) -> int:
        folders = [f"{self.changes_path}/{c}" for c in changes]
        if snapshot:
            folders.append(f"{self.snapshot_path}/{snapshot}")
        size = sum(lake.folder_bytes(self.spark, f) for f in folders)
        return max(-(-size // BUCKET_BYTES), LEAST_BUCKETS)

    def _log(self, runs: list[str]) -> DataFrame:
        return lake.read_runs(self.spark, self.changes_path, BRONZE_STORED, runs)

    def _snapshot(self, name: str) -> DataFrame:
        """The snapshot as a bucketed table; the session catalog learns it on first use."""
        path = f"{self.snapshot_path}/{name}"
        table = self._table_name(path)
        if not self.spark.catalog.tableExists(table):
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in BRONZE.fields)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
                f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {name.rpartition('.b')[2]} BUCKETS "
                f"LOCATION '{path}'"
            )
        return self.spark.table(table)

    @staticmethod
    def _table_name(path: str) -> str:
        return "bronze_snapshot_" + hashlib.sha256(path.encode()).hexdigest()[:24]
