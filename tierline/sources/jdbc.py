"""JDBC scan and sinks. The lake is written first; a database copy derives from it."""

from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierline.operators.gates import delta_filter

BATCH_ROWS = 10_000


def range_options(column: str, lower: object, upper: object, partitions: int) -> dict[str, str]:
    """Options that split a scan on ranges of ``column``.

    Choose a column whose values spread evenly, such as a numeric key. A load stamps
    all its rows alike, so ranges of the stamp would put a whole load in one task.
    """
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def split_predicates(rows: DataFrame, column: str, parts: int, tie: str | None = None, accuracy: int = 10_000) -> list[str]:
    """SQL conditions that cut a table into about ``parts`` ranges of equally many rows, each
    row in exactly one: the ``predicates`` of :func:`jdbc_delta_scan`, for a column whose
    values are spread unevenly.

    The bounds are quantiles of ``rows`` (the column as an earlier load has it, or a sample),
    from a sketch of ``accuracy``; only they reach the driver. Numbers, dates and timestamps
    may be split. A value that fills several ranges by itself becomes as many, by the
    remainder of the whole-number column ``tie``; without one it is one range. Nulls, and
    values beyond those known, are in the first and last range.
    """
    kind = rows.schema[column].dataType.simpleString()
    wanted = [n / parts for n in range(1, parts)]
    found = rows.agg(F.percentile_approx(column, wanted, accuracy).cast("array<string>")).first()[0] or []
    literal = (lambda v: v) if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal") else (lambda v: f"{_SQL_TYPES.get(kind, '')}'{v}'")
    bounds = [literal(v) for v in dict.fromkeys(found)]
    fills = Counter(map(literal, found))
    if not bounds:
        return ["1 = 1"]
    predicates = [f"({column} < {bounds[0]} OR {column} IS NULL)"]
    for n, bound in enumerate(bounds):
        low = ">="
        if tie is not None and fills[bound] > 1:
            # The value's rows fill what lies between its first and its last bound, and some.
            k = fills[bound] + 1
            predicates += [f"({column} = {bound} AND {_remainder(tie, k)} = {i})" for i in range(k)]
            low = ">"
        upper = f" AND {column} < {bounds[n + 1]}" if n + 1 < len(bounds) else ""
        predicates.append(f"({column} {low} {bound}{upper})")
    return predicates


# How SQL marks the type of a literal.
_SQL_TYPES = {"date": "DATE ", "timestamp": "TIMESTAMP ", "timestamp_ntz": "TIMESTAMP "}


# The factor and prime modulus of the minimal standard generator.
_FACTOR, _PRIME = 48271, 2147483647


def _remainder(column: str, k: int) -> str:
    """0 to k - 1 for any whole number, null as 0. Keys that go up in steps of k would all
    have one remainder, so they are mixed first, in terms that any database knows."""
    mixed = f"MOD(ABS(CAST(COALESCE({column}, 0) AS BIGINT)), {_PRIME})"
    for _ in range(2):
        mixed = f"MOD({mixed} * {_FACTOR}, {_PRIME})"
    return f"MOD({mixed}, {k})"


def jdbc_delta_scan(
    spark: SparkSession,
    url: str,
    table: str,
    ts: str,
    cursor: datetime | None,
    connection: Mapping[str, str] | None = None,
    split: Mapping[str, str] | None = None,
    predicates: Sequence[str] | None = None,
    fetch_rows: int = BATCH_ROWS,
) -> DataFrame:
    """Rows newer than the cursor. The typed filter is pushed into the database's query;
    ``split`` (see :func:`range_options`) or ``predicates``, one per task, spread it: one
    of them is required, since without any a single task would read the whole table."""
    if not split and not predicates:
        raise ValueError("split or predicates: one task would read the whole table")
    options = {"url": url, "fetchsize": str(fetch_rows), **(connection or {})}
    if predicates:
        properties = {k: v for k, v in options.items() if k != "url"}
        df = spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)
    else:
        df = spark.read.format("jdbc").options(dbtable=table, **options, **(split or {})).load()
    return delta_filter(df, ts, cursor)


def _write(df: DataFrame, url: str, table: str, mode: str, connection, options: Mapping[str, str]) -> None:
    settings = {"url": url, "dbtable": table, "batchsize": str(BATCH_ROWS), **options, **(connection or {})}
    df.write.format("jdbc").options(**settings).mode(mode).save()


def jdbc_append(
    df: DataFrame, url: str, table: str, connection: Mapping[str, str] | None = None, connections: int = 8
) -> None:
    """Append rows over at most ``connections`` parallel connections."""
    _write(df, url, table, "append", connection, {"numPartitions": str(connections)})


def jdbc_overwrite(
    df: DataFrame, url: str, table: str, connection: Mapping[str, str] | None = None, connections: int = 8
) -> None:
    """Replace the table's rows, keeping its definition and grants."""
    _write(df, url, table, "overwrite", connection, {"numPartitions": str(connections), "truncate": "true"})


def append_once(
    df: DataFrame, ts: str, stored: DataFrame | None, append: Callable[[DataFrame], None]
) -> bool:
    """Append one run's rows unless an earlier try of the run already did.

    ``stored`` is the table as it is now (None: it does not exist yet). All rows of a run
    share one stamp, so the run is there when as many rows carry it. A part of them means
    a try broke off: parallel connections commit one by one, so that is an error to
    resolve in the database, not a reason to append a second copy.
    """
    if stored is not None:
        run = df.agg(F.max(ts).alias("run_stamp"), F.count(F.lit(1)).alias("n"))
        there = stored.filter(F.col(ts) == run.select("run_stamp").scalar()).agg(F.count(F.lit(1)).alias("there"))
        found, wanted = there.withColumn("n", run.select("n").scalar()).first()
        if found == wanted:
            return False
        if found:
            raise RuntimeError(f"{found} of the run's {wanted} rows are already in the table")
    append(df)
    return True


def append_sink(
    ts: str, stored: Callable[[], DataFrame | None], append: Callable[[DataFrame], None]
) -> Callable[[DataFrame, str], None]:
    """A stage sink that appends each run once, however often the run is repeated."""
    return lambda df, run_id: append_once(df, ts, stored(), append) and None


def jdbc_sink(
    spark: SparkSession, url: str, table: str, ts: str, connection: Mapping[str, str] | None = None
) -> Callable[[DataFrame, str], None]:
    """A stage sink: ``jdbc_sink(spark, url, "silver.records", "ingested_at")``. The table
    exists; a repeated run finds its rows there and adds none."""

    def stored() -> DataFrame:
        return spark.read.format("jdbc").options(url=url, dbtable=table, **(connection or {})).load()

    return append_sink(ts, stored, lambda df: jdbc_append(df, url, table, connection))
