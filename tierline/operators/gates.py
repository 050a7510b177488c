"""High-water marks, change gates and reconciliation, each a small aggregate.

A gate is one row: ``status`` (proceed, skip or fail) with its ``reason`` and figures.
Other tables enter as scalar subqueries, never as cross joins.
"""

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tierline.functions.stamps import stamp_like
from tierline.operators.keyed import key_check
from tierline.schemas import NO_CURSOR


def high_water_mark(df: DataFrame, ts: str) -> DataFrame:
    """Latest stamp (NULL when empty) and row count in one pass."""
    return df.agg(F.max(ts).alias("high_water_mark"), F.count(F.lit(1)).alias("n_rows"))


def latest_stamp(df: DataFrame, ts: str) -> Column:
    """``MAX(ts)`` as a scalar subquery; it reaches the scan as a pushed filter."""
    return df.agg(F.max(ts).alias(ts)).scalar()


def change_stats(df: DataFrame, ts: str, cursor: datetime | Column | None) -> DataFrame:
    """All rows and rows newer than the cursor, fused; without a cursor every row is new."""
    newer = F.lit(True) if cursor is None else F.col(ts) > stamp_like(df, ts, cursor)
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(newer).alias("changed"))


def delta_filter(df: DataFrame, ts: str, cursor: datetime | Column | None) -> DataFrame:
    """Rows strictly newer than the cursor; all rows without one."""
    return df if cursor is None else df.filter(F.col(ts) > stamp_like(df, ts, cursor))


def latest_batch(df: DataFrame, ts: str) -> DataFrame:
    """Rows that carry the latest stamp."""
    return df.filter(F.col(ts) == latest_stamp(df, ts))


def bronze_gate(stats: DataFrame) -> DataFrame:
    """Verdict on :func:`change_stats`: an empty table fails before "no change" skips."""
    status = F.when(F.col("total") == 0, "fail").when(F.col("changed") == 0, "skip").otherwise("proceed")
    reason = F.when(F.col("total") == 0, "table is empty").when(F.col("changed") == 0, "no changes")
    return stats.select(status.alias("status"), reason.alias("reason"), "total", "changed")


def delta_gate(upstream: DataFrame, ts: str, downstream: DataFrame | None, downstream_ts: str) -> DataFrame:
    """Is there anything newer upstream than the downstream layer has seen?

    An empty upstream fails, ``<=`` skips. A layer that does not exist yet (None) or
    is empty has no cursor, and the sentinel cursor lets every row pass.
    """
    if downstream is None:
        seen = F.lit(None)
    else:
        seen = latest_stamp(downstream, downstream_ts)
    kind = upstream.schema[ts].dataType
    marks = upstream.agg(F.max(ts).alias("latest_upstream")).withColumn("latest_downstream", seen.cast(kind))
    up, down = F.col("latest_upstream"), F.col("latest_downstream")
    sentinel = F.lit(NO_CURSOR).cast(kind)
    return marks.select(
        F.when(up.isNull(), "fail").when(up <= down, "skip").otherwise("proceed").alias("status"),
        F.when(up.isNull(), "upstream is empty").when(up <= down, "no new data").alias("reason"),
        "latest_upstream",
        "latest_downstream",
        F.coalesce(down, sentinel).alias("cursor"),
    )


def reconcile(df: DataFrame, ts: str, expected: int | Column) -> DataFrame:
    """Rows of the latest batch against the rows the run processed.

    Two scans of the stamp column and no shuffle; the second reads only the row
    groups that can hold the latest stamp.
    """
    want = F.lit(expected).cast("long") if isinstance(expected, int) else expected.cast("long")
    counts = latest_batch(df, ts).agg(F.count(F.lit(1)).alias("actual")).withColumn("expected", want)
    match = F.col("expected") == F.col("actual")
    # A run that processed nothing has nothing to reconcile.
    return counts.select(
        F.when(F.col("expected") == 0, "skip").when(match, "proceed").otherwise("fail").alias("status"),
        "expected",
        "actual",
    )


def preflight(inputs: dict[str, tuple[DataFrame, list[str]]], rows: bool = True) -> DataFrame:
    """Per input: required columns it lacks, whether it has rows, and whether it can be used.

    One row is enough to know that an input is not empty: nothing is counted. Without
    ``rows`` the data is not read at all and ``has_rows`` is null.
    """
    checks = None
    for name, (df, required) in inputs.items():
        missing = [c for c in required if c not in df.columns]
        if rows:
            found = df.select(F.lit(1)).limit(1).agg((F.count(F.lit(1)) > 0).alias("has_rows"))
        else:
            found = df.sparkSession.sql("select cast(null as boolean) as has_rows")
        row = found.select(
            F.lit(name).alias("input"),
            F.lit(",".join(missing)).alias("missing_columns"),
            "has_rows",
            F.when(F.lit(bool(missing)), "missing columns").when(~F.col("has_rows"), "empty").otherwise("ok").alias("status"),
        )
        checks = row if checks is None else checks.unionByName(row)
    return checks


class AuditFailed(RuntimeError):
    """A run's rows were refused before they were published."""


def unique(key: str) -> Callable[[DataFrame], None]:
    """An audit for a stage: every row has a key of its own."""

    def check(rows: DataFrame) -> None:
        found = key_check(rows, key).limit(1).collect()
        if found:
            raise AuditFailed(f"{key} {found[0][key]}: {found[0]['problem']}")

    return check


def share_at_most(condition: Column, share: float) -> Callable[[DataFrame], None]:
    """An audit for a stage: the condition holds for at most this share of the rows."""

    def check(rows: DataFrame) -> None:
        n, hits = rows.agg(F.count(F.lit(1)), F.count_if(condition)).first()
        if hits > share * n:
            raise AuditFailed(f"{hits} of {n} rows, more than {share:.1%} of them")

    return check
