"""Reconciliation inside a stream: rows read against rows written, micro-batch by micro-batch.

The rows are counted where they leave the source, by ``observe`` in the stream's own plan,
so nothing is read for it; a listener gets the count with the batch's progress. A batch
whose rows did not all arrive stops the stream: the next batch is not begun.
"""

import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tierline.plans.stages import StageFailed

#: Seconds to wait for the progress of a batch that is done.
PATIENCE = 60


@dataclass(frozen=True)
class BatchCount:
    batch: int
    read: int
    written: int | None

    @property
    def status(self) -> str:
        return "proceed" if self.read == self.written else "fail"


class _Counts(StreamingQueryListener):
    """Rows by batch: those observed in the stream, and those reported written."""

    def __init__(self, metric: str):
        self.metric = metric
        self.read: dict[int, int] = {}
        self.written: dict[int, int] = {}
        self.news = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        observed = event.progress.observedMetrics.get(self.metric)
        if observed is not None:
            with self.news:
                self.read[event.progress.batchId] = observed["n"]
                self.news.notify_all()

    def settled(self) -> list[BatchCount]:
        """The counts of all batches that were written, once their progress is known."""
        with self.news:
            if not self.news.wait_for(lambda: self.read.keys() >= self.written.keys(), PATIENCE):
                raise StageFailed("stream: a batch's progress was not reported")
            return [BatchCount(b, self.read[b], self.written[b]) for b in sorted(self.written)]


def _check(counts: list[BatchCount]) -> None:
    for c in counts:
        if c.status == "fail":
            raise StageFailed(f"stream: batch {c.batch} read {c.read} rows, wrote {c.written}")


def reconciled_stream(
    spark: SparkSession,
    source: DataFrame,
    write: Callable[[DataFrame, int], int],
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> list[BatchCount]:
    """Run a stream until what is available has been read; one count per micro-batch.

    ``write`` gets a micro-batch and its number and returns how many rows it wrote; it reads
    the batch once, as :func:`tierline.plans.stages.bronze_stage` does. ``transform`` is what
    lies between the source and the writer, and must keep every row. Raises
    :class:`StageFailed` at the first batch whose rows were not all written; with an error
    of ``write`` itself the stream's exception.
    """
    counts = _Counts(f"read_{uuid.uuid4().hex}")
    observed = source.observe(counts.metric, F.count(F.lit(1)).alias("n"))

    def write_batch(batch: DataFrame, number: int) -> None:
        _check(counts.settled())
        counts.written[number] = write(batch, number)

    spark.streams.addListener(counts)
    try:
        stream = (transform(observed) if transform else observed).writeStream.foreachBatch(write_batch)
        stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        found = counts.settled()
    finally:
        spark.streams.removeListener(counts)
    _check(found)
    return found
