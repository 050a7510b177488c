"""The three stages and the incremental refresh that runs them in order.

A run is named by ``run_id`` and stamped with one ``as_of``. A stage reads its own layer
as it was before the run, so running the same run again writes the same result.
"""

import hashlib
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tierline.functions.stamps import stamp, utc
from tierline.operators import clean, counts, gates, keyed, records
from tierline.schemas import FETCHED, GOLD, GOLD_KEYS, LOCATION_COLUMNS, REQUIRED_KEYS, SILVER, SILVER_STORED
from tierline.sources import lake
from tierline.sources.bronze import BronzeStore

# Size of a batch's ids (see :func:`keyed.row_bytes`) from which they are not looked at one
# by one to prune the store's buckets.
PRUNE_BYTES = 256 << 10

# Takes a run's written rows and its id; a repeated run comes with the same id again.
Sink = Callable[[DataFrame, str], None]

# Looks at a run's rows before readers can see them; raises to refuse the run.
Audit = Callable[[DataFrame], None]


class StageFailed(RuntimeError):
    """A data-quality gate or reconciliation failed; later stages must not run."""


@dataclass(frozen=True)
class Layers:
    """Base folder of each layer; ``under`` puts them side by side."""

    landing: str
    bronze: str
    silver: str
    gold: str

    @classmethod
    def under(cls, base: str) -> "Layers":
        base = base.rstrip("/")
        return cls(*(f"{base}/{name}" for name in ("landing", "bronze", "silver", "gold")))


@dataclass(frozen=True)
class Outcome:
    """What a stage did: ``proceed`` with its row count, or ``skip`` with the reason."""

    stage: str
    status: str
    reason: str | None = None
    rows: int = 0


def _after(cursor: datetime | None, as_of: datetime) -> datetime | None:
    """The cursor, once the run's own stamp is known to lie after it: stamps grow from
    run to run, so the last run alone holds a layer's high-water mark."""
    if cursor is not None and utc(as_of) <= cursor:
        raise ValueError(f"as_of {utc(as_of)} is not after the last run's {cursor}")
    return cursor


def _landed(examined: DataFrame, layers: Layers, run_id: str) -> tuple[DataFrame, int]:
    """The records as written to this run's landing folder, and the size of their ids."""
    path = lake.run_path(layers.landing, run_id)
    size = Observation()
    examined.observe(size, keyed.row_bytes("id_api").alias("bytes")).write.mode("overwrite").parquet(path)
    return examined.sparkSession.read.schema(examined.schema).parquet(path), size.get["bytes"]


def bronze_stage(
    spark: SparkSession,
    layers: Layers,
    fetched: DataFrame,
    run_id: str,
    as_of: datetime,
    required: Sequence[str] = REQUIRED_KEYS,
    on_duplicate: str = "last",
    compact_after: int | None = None,
    land: bool = True,
    broadcast_bytes: int = keyed.BROADCAST_BYTES,
) -> Outcome:
    """Merge fetched records ``(page, pos, payload)`` into the bronze store.

    The records land once in the landing layer with what was found out about them: the
    source is read and each record examined a single time however many jobs follow.
    ``land=False`` saves that copy for records that already lie in files which do not
    change. Records without the mandatory keys or an id are left out (landing keeps them;
    see :func:`tierline.operators.records.refused`). For a repeated id the last page and
    position wins, or the run fails with ``on_duplicate="error"``.

    First the runs before this one are compacted if they have outgrown the snapshot (see
    :meth:`BronzeStore.outgrown`), or if ``compact_after`` of them wait (0: never). So the
    merge finds the store bucketed by key and moves only the batch, and this run can be
    repeated. A run older than a committed one is refused.
    """
    checked = gates.preflight({"fetched": (fetched, list(FETCHED))}, rows=False).first()
    if checked["status"] == "missing columns":
        raise StageFailed(f"bronze: the fetch lacks {checked['missing_columns']}")
    store = BronzeStore(spark, layers.bronze)
    newer = store.newer_runs(run_id)
    if newer:
        raise StageFailed(f"bronze: {newer[0]} is committed already, {run_id} is older")
    if store.outgrown(run_id) if compact_after is None else 0 < compact_after <= store.pending(run_id):
        store.compact(before=run_id)
    _after(store.last_stamp(run_id, inclusive=False), as_of)

    examined = records.examined(fetched, required)
    if land:
        examined, id_bytes = _landed(examined, layers, run_id)
    else:
        id_bytes = examined.agg(keyed.row_bytes("id_api")).first()[0]
    rows = records.accepted(examined).withColumn("updated_at", stamp(as_of))
    if on_duplicate == "error" and not keyed.key_check(rows, keyed.KEY).isEmpty():
        raise StageFailed("bronze: a record id occurs twice in the batch")
    batch = keyed.latest_per_key(rows, keyed.KEY, [F.desc("page"), F.desc("pos")])

    small_keys = rows.select(keyed.KEY) if id_bytes <= broadcast_bytes else None
    few = keyed.few_keys(rows) if id_bytes <= PRUNE_BYTES else None
    if few is not None:
        small_keys = None
    written = store.append(keyed.upsert_changes(store.layers(run_id, few), batch, small_keys=small_keys, replaced=True), run_id)
    # What bronze_gate finds out by counting: nothing is stored, or nothing is newer.
    if not store.runs(run_id):
        raise StageFailed("bronze: table is empty")
    if not written:
        return Outcome("bronze", "skip", "no changes")
    return Outcome("bronze", "proceed", rows=written)


def silver_stage(
    spark: SparkSession,
    layers: Layers,
    run_id: str,
    as_of: datetime,
    sinks: Iterable[Sink] = (),
    blank_as_missing: bool = False,
    audits: Iterable[Audit] = (),
) -> Outcome:
    """Clean what the bronze runs changed that no silver run has read into one lake run.

    Which bronze runs a silver run read is noted beside the layer, so a run committed late
    is read whatever its stamp. The rows read must be as many as bronze committed. The run
    is reconciled, and looked at by ``audits``, before it is published: one that is refused,
    or breaks off anywhere, leaves what readers saw, and a later run reads its rows.
    ``sinks`` get the written rows, so every copy carries the same stamps and bronze is read
    once.
    """
    store = BronzeStore(spark, layers.bronze)
    bronze_runs = store.runs(run_id)
    if not bronze_runs:
        raise StageFailed("silver: upstream is empty")
    past = SilverPast.of(spark, layers.silver)
    seen = past.read_by_others(bronze_runs, run_id)
    new = [r for r in bronze_runs if r not in seen]
    if not new:
        return Outcome("silver", "skip", "no new data")
    done = lake.read_runs(spark, layers.silver, SILVER, past.before(run_id)[-1:])
    _after(lake.run_stamp(done, "ingested_at"), as_of)
    written = write_silver(spark, store, new, layers.silver, run_id, as_of, blank_as_missing, past, audits)
    run = lake.read_run(spark, layers.silver, SILVER, lake.run_name(run_id))
    for sink in sinks:
        sink(run, run_id)
    return Outcome("silver", "proceed", rows=written)


def _notes_of(base: str) -> str:
    return f"{base.rstrip('/')}_consumed"


# First lines of a silver note: by which rule the run was cleaned, and which silver runs,
# as they were written, came before it.
_CLEANED = "# blank_as_missing="
_AFTER = "# after="


@dataclass(frozen=True)
class SilverPast:
    """Committed silver runs, oldest first, with the lines of the note that was published
    with each; None for a run that something else wrote."""

    notes: dict[str, list[str] | None]
    tokens: dict[str, str | None]

    @classmethod
    def of(cls, spark: SparkSession, silver: str) -> "SilverPast":
        committed = lake.commits(spark, silver)
        notes = lake.read_notes(spark, _notes_of(silver)) if any(committed.values()) else {}
        return cls({run: notes.get(f"{run}.{token}") for run, token in committed.items()}, committed)

    def digest(self, runs: Sequence[str]) -> str:
        """Says which runs these are, each as it was written."""
        return hashlib.sha256("\n".join(f"{r} {self.tokens[r]}" for r in runs).encode()).hexdigest()

    def knows_before(self, run: str) -> bool:
        """Whether the ``previous`` groups of a run are those of the runs now before it:
        none of them was repeated, removed or added since."""
        lines, before = self.notes[run], [r for r in self.notes if r < run]
        return lines is not None and f"{_AFTER}{self.digest(before)}" in lines

    def before(self, run_id: str) -> list[str]:
        return [r for r in self.notes if r < lake.run_name(run_id)]

    def read_by_others(self, bronze_runs: Sequence[str], run_id: str | None = None) -> set[str]:
        """The bronze runs that silver runs other than ``run_id`` have read. One without a
        note has read every bronze run up to its own name, except what a repeated run
        before it had read."""
        me = run_id and lake.run_name(run_id)
        read: set[str] = set()
        for run, lines in self.notes.items():
            if run == me:
                continue
            if lines is not None:
                read.update(line for line in lines if not line.startswith("#"))
            else:
                mine = me if me in self.notes and me < run else ""
                read.update(r for r in bronze_runs if mine < r <= run)
        return read

    def follows(self, new: Sequence[str], bronze_runs: Sequence[str], run_id: str, blank_as_missing: bool) -> bool:
        """Whether a run comes after all others in both layers, which were cleaned by its
        own rule: then what its rows replaced in bronze is what silver had of them."""
        rule = f"{_CLEANED}{blank_as_missing}"
        others = [lines for run, lines in self.notes.items() if run != lake.run_name(run_id)]
        ruled = all(lines is not None and rule in lines for lines in others)
        last = max((r for r in self.notes if r != lake.run_name(run_id)), default="")
        read = self.read_by_others(bronze_runs, run_id)
        return ruled and last < lake.run_name(run_id) and max(read, default="") < min(new)


def _note(spark: SparkSession, base: str, run_id: str, lines: Sequence[str]) -> Callable[[str], None]:
    """Writes the note of a run that is about to be published with a token, and drops those
    of earlier tries but the one that is still visible."""

    def write(token: str) -> None:
        folder, name = _notes_of(base), lake.run_name(run_id)
        visible = lake.commits(spark, base).get(name)
        lake.drop_notes(spark, f"{folder}/{name}.*", keep=f"{name}.{visible}")
        lake.write_note(spark, f"{folder}/{name}.{token}", "\n".join(lines))

    return write


def write_silver(
    spark: SparkSession,
    store: BronzeStore,
    runs: list[str],
    silver: str,
    run_id: str,
    as_of: datetime,
    blank_as_missing: bool = False,
    past: SilverPast | None = None,
    audits: Iterable[Audit] = (),
) -> int:
    """One silver run from some bronze runs, published together with the note of which they
    were. Each row also says in which group its id was before (``previous``)."""
    past = past or SilverPast.of(spark, silver)
    notes = store.notes(runs)
    lost = store.missing_rows(runs, notes)
    if lost:
        raise StageFailed(f"silver: {lost} of the rows bronze committed are not there")
    delta = store.changes_of(runs)
    cleaned = clean.silver_rows(delta, as_of, blank_as_missing, previous="replaced")
    known = all("replaced" in notes.get(r, ()) for r in runs)
    if not (known and past.follows(runs, store.runs(), run_id, blank_as_missing)):
        cleaned = _looked_up(spark, cleaned.drop("previous"), silver, past.before(run_id))
    found: list[int] = []

    def audit(staged: DataFrame, written: int) -> None:
        _reconciled("silver", staged, "ingested_at", as_of, written)
        for check in audits:
            check(staged.select(*SILVER.fieldNames()))
        found.append(written)

    about = [f"{_CLEANED}{blank_as_missing}", f"{_AFTER}{past.digest(past.before(run_id))}"]
    note = _note(spark, silver, run_id, [*about, *runs])
    written = lake.write_run(cleaned, silver, run_id, LOCATION_COLUMNS, audit=audit, note=note)
    _same("silver", written, found)
    return written


def _looked_up(spark: SparkSession, rows: DataFrame, silver: str, earlier: Sequence[str]) -> DataFrame:
    """The rows with ``previous`` taken from the silver runs before: for a run that does not
    simply follow them."""
    history = lake.read_runs(spark, silver, SILVER, earlier).select("id", "run_id", *GOLD_KEYS)
    last = keyed.latest_per_key(history, "id", [F.desc("run_id")])
    return rows.join(last.select("id", F.struct(*GOLD_KEYS).alias("previous")), "id", "left").select(*SILVER_STORED.fieldNames())


def gold_stage(
    spark: SparkSession,
    layers: Layers,
    run_id: str,
    as_of: datetime,
    sinks: Iterable[Sink] = (),
    scope: str = "latest_run",
    audits: Iterable[Audit] = (),
) -> Outcome:
    """Count by location and type into one gold run.

    ``latest_run`` counts only the last silver run up to this run, which holds its delta;
    ``current`` counts the latest version of every id over all of them. That is kept up to
    date: the last run of this scope, plus and minus what the silver runs since then moved.
    The whole history is counted only if there is no such run, or a silver run that it
    counted was repeated, removed or joined by an older one (``recount`` always does).

    A repeated run does not see silver runs that came after it. The counts must add up to
    the rows or ids counted, and pass ``audits``, before the run is published.
    """
    past = SilverPast.of(spark, layers.silver)
    silver_runs = [r for r in past.notes if r <= lake.run_name(run_id)]
    if not silver_runs:
        raise lake.NoRuns(f"no runs in {layers.silver}")
    latest = lake.read_run(spark, layers.silver, SILVER, silver_runs[-1])
    counted_runs = lake.commits(spark, layers.gold)
    earlier = [r for r in counted_runs if r < lake.run_name(run_id)]
    newest = lake.run_stamp(latest, "ingested_at")
    counted = lake.run_stamp(lake.read_runs(spark, layers.gold, GOLD, earlier[-1:]), "processed_at")
    if newest is None:
        raise StageFailed("gold: upstream is empty")
    if counted is not None and newest <= counted:
        return Outcome("gold", "skip", "no new data")
    _after(counted, as_of)
    lines = [scope]
    if scope == "latest_run":
        totals, expected = counts.gold_counts(latest), latest.count()
    else:
        totals, expected = current_counts(spark, layers, past, silver_runs, earlier if scope == "current" else [], counted_runs)
        lines = ["current", silver_runs[-1], past.digest(silver_runs)]
    found: list[int] = []

    def audit(staged: DataFrame, written: int) -> None:
        (total,) = _reconciled("gold", staged, "processed_at", as_of, written, F.coalesce(F.sum("total_breweries"), F.lit(0)))
        if expected is not None and total != expected:
            raise StageFailed(f"gold: counted {total} rows, there are {expected}")
        for check in audits:
            check(staged)
        found.append(written)

    note = _note(spark, layers.gold, run_id, lines)
    written = lake.write_run(totals.withColumn("processed_at", stamp(as_of)), layers.gold, run_id, audit=audit, note=note)
    _same("gold", written, found)
    run = lake.read_run(spark, layers.gold, GOLD, lake.run_name(run_id))
    for sink in sinks:
        sink(run, run_id)
    return Outcome("gold", "proceed", rows=written)


def current_counts(
    spark: SparkSession,
    layers: Layers,
    past: SilverPast,
    silver_runs: list[str],
    earlier: Sequence[str] = (),
    counted_runs: dict[str, str | None] | None = None,
) -> tuple[DataFrame, int | None]:
    """Counts over the current versions in some silver runs, and what they should add up
    to: from the newest of the ``earlier`` gold runs that counted a beginning of the same
    silver runs, and the silver runs since then; or from the whole history (None: the ids
    are not counted a second time)."""
    notes = lake.read_notes(spark, _notes_of(layers.gold)) if earlier else {}
    for run in reversed(earlier):
        scope, last, digest = (*notes.get(f"{run}.{counted_runs[run]}", ()), "", "", "")[:3]
        upto = [r for r in silver_runs if r <= last]
        since = silver_runs[len(upto) :]
        if scope == "current" and digest == past.digest(upto) and all(map(past.knows_before, since)):
            base = lake.read_run(spark, layers.gold, GOLD, run)
            delta = lake.read_runs(spark, layers.silver, SILVER_STORED, since).select(*GOLD_KEYS, "previous")
            new_ids = delta.filter(F.col("previous").isNull()).count()
            return counts.gold_incremental(base, delta), base.agg(F.coalesce(F.sum("total_breweries"), F.lit(0))).first()[0] + new_ids
    history = lake.read_runs(spark, layers.silver, SILVER, silver_runs)
    return counts.gold_current(history, [F.desc("run_id")]), None


def _reconciled(stage: str, run: DataFrame, ts: str, as_of: datetime, written: int, *more: Column) -> list:
    """A run, read back, has as many rows of its stamp as were written; returns what ``more``
    aggregates find on the way."""
    found, *others = run.agg(F.count_if(F.col(ts) == stamp(as_of)), *more).first()
    if found != written:
        raise StageFailed(f"{stage}: wrote {written} rows, found {found}")
    return others


def _same(stage: str, written: int, found: Sequence[int]) -> None:
    """What was published is what was audited."""
    if [written] != list(found):
        raise StageFailed(f"{stage}: wrote {written} rows, found {sum(found)}")


def refresh(
    spark: SparkSession,
    layers: Layers,
    fetched: DataFrame,
    run_id: str,
    as_of: datetime,
    silver_sinks: Iterable[Sink] = (),
    gold_sinks: Iterable[Sink] = (),
    scope: str = "latest_run",
    **bronze_options,
) -> list[Outcome]:
    """One incremental refresh; each stage reconciles what it wrote before anyone sees it.

    Every stage asks its own gate, so a run that found nothing new does nothing below,
    and a run after a failure picks up what the failed one left.
    """
    return [
        bronze_stage(spark, layers, fetched, run_id, as_of, **bronze_options),
        silver_stage(spark, layers, run_id, as_of, silver_sinks),
        gold_stage(spark, layers, run_id, as_of, gold_sinks, scope),
    ]


def retain(spark: SparkSession, layers: Layers) -> list[str]:
    """Remove landing copies, change runs and snapshots that no later run needs (see
    :meth:`BronzeStore.retain`), and what writers that were killed left staged: call it when
    no stage runs. Silver and gold keep their history."""
    store = BronzeStore(spark, layers.bronze)
    read = SilverPast.of(spark, layers.silver).read_by_others(store.runs())
    removed = store.retain(read)
    for run in removed:
        lake.drop_run(spark, layers.landing, run.removeprefix("run_id="))
    for base in (store.changes_path, layers.silver, layers.gold):
        lake.drop_folder(spark, f"{base.rstrip('/')}/{lake.STAGING}")
    return removed
