"""New bronze runs in, one silver run out: the event-driven hand-over.

The stream follows the commit notes of the bronze store, not its files: a note is written
when a run is complete, and a repeated run has the same note. Which bronze runs were read
is kept with the silver layer, as the batch stage does, so a run is read once even if the
checkpoint is lost, and one committed late is still read. Nothing new means no batch,
which is the gate's "skip".
"""

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tierline.plans.stages import Audit, Layers, SilverPast, bronze_stage, write_silver
from tierline.schemas import SILVER
from tierline.sources import lake
from tierline.sources.bronze import BronzeStore
from tierline.streaming.reconcile import BatchCount, reconciled_stream


def _free_name(run_id: str, taken: set[str]) -> str:
    """The run id, or the first of ``id_2``, ``id_3``... that no run has: they sort after
    the id and before later ones."""
    names = [run_id, *(f"{run_id}_{n}" for n in range(2, len(taken) + 3))]
    return next(name for name in names if lake.run_name(name) not in taken)


def stream_silver(
    spark: SparkSession,
    bronze_base: str,
    silver_base: str,
    checkpoint: str,
    max_runs: int | None = None,
    clock: Callable[[str], datetime] | None = None,
    then: Callable[[str], None] | None = None,
    audits: tuple[Audit, ...] = (),
) -> StreamingQuery:
    """Clean what all bronze runs committed since the last call changed, then stop.

    A micro-batch's run has the name of the last bronze run in it; if a silver run of that
    name is there, of the batch stage say, a name after it (``<run>_2``). So the stream never
    replaces a run, and batch and stream may share a layer: what either has read the other
    does not read. A micro-batch that is tried again finds its rows read, or unpublished.

    ``max_runs`` bounds a micro-batch when a long backlog is read. A run's stamp is that of
    the last bronze run in it, or just after the layer's last, unless ``clock`` gives it.
    ``then`` is told the id of each written run (to start the gold stage, say); ``audits``
    see its rows before they are published, as in the batch stage.
    """
    store = BronzeStore(spark, bronze_base)
    reader = spark.readStream.schema("value string")
    if max_runs:
        reader = reader.option("maxFilesPerTrigger", str(max_runs))
    # A first call may come before the first commit.
    lake.make_folder(spark, store.commits_path)
    commits = reader.text(store.commits_path).select(F.col("_metadata.file_name").alias("run"))

    def stamp_of(runs: list[str], past: SilverPast) -> datetime:
        read = store.stamp_of(runs)
        last = lake.run_stamp(lake.read_runs(spark, silver_base, SILVER, list(past.notes)[-1:]), "ingested_at")
        return read if last is None or last < read else last + timedelta(microseconds=1)

    def write(batch: DataFrame, batch_id: int) -> None:
        told = {r["run"] for r in batch.distinct().collect()}
        runs = store.runs()
        # A run whose note was lost is read with the next one.
        noted = set(store.notes(runs))
        past = SilverPast.of(spark, silver_base)
        read = past.read_by_others(runs)
        new = [r for r in runs if r not in read and (r in told or r not in noted)]
        if not new:
            return
        last = new[-1].removeprefix("run_id=")
        run_id = _free_name(last, set(lake.list_runs(spark, silver_base, committed=False)))
        as_of = clock(run_id) if clock is not None else stamp_of(new, past)
        write_silver(spark, store, new, silver_base, run_id, as_of, past=past, audits=audits)
        if then is not None:
            then(run_id)

    return (
        commits.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _batch_run(batch: int) -> str:
    return f"{batch:012d}"


def _now(_run_id: str) -> datetime:
    return datetime.now(timezone.utc)


def stream_bronze(
    spark: SparkSession,
    layers: Layers,
    fetched: DataFrame,
    checkpoint: str,
    run_of: Callable[[int], str] = _batch_run,
    clock: Callable[[str], datetime] = _now,
    **bronze_options,
) -> list[BatchCount]:
    """Merge a stream of fetched records ``(page, pos, payload)`` into the bronze store until
    what is there has been read: a bronze run per micro-batch, its fetched rows reconciled
    with those that landed.

    A micro-batch that is tried again is the same run again. ``run_of`` names the run of a
    batch number; names must grow, also over those of other runs in the store.
    """

    def write(batch: DataFrame, number: int) -> int:
        run_id = run_of(number)
        bronze_stage(spark, layers, batch, run_id, clock(run_id), **bronze_options)
        return spark.read.parquet(lake.run_path(layers.landing, run_id)).count()

    return reconciled_stream(spark, fetched, write, checkpoint)
