"""Run-scoped Parquet folders: ``<base>/run_id=<id>[/<partition>=<value>…]``.

Each run owns one folder, so a retried run overwrites only itself, and ``run_id`` is a
partition column when several runs are read as one table. A run counts once its
``_SUCCESS`` marker is there: a half-written folder is never read.

A run is written, audited, published: its rows go to a folder below ``_staging`` that no
reader looks at, are read back and checked there, and appear by a rename. Until then, and
if anything fails, readers see what was there before. Each writing has a token, the name of
a marker in the folder; what was noted about it beside the layer is named after run and
token, so a note counts only together with the rows it was written for.
"""

import uuid
from collections.abc import Callable, Sequence
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tierline.functions.stamps import moment

RUN_PREFIX = "run_"
STAGING = "_staging"
PACKS = "_packs"
TOKEN_PREFIX = "_token."

# Takes the rows of a run as read back before they are published, and their number;
# raises to refuse them.
Audit = Callable[[DataFrame, int], None]


class NoRuns(RuntimeError):
    """A layer that should hold runs has none."""


def run_name(run_id: str) -> str:
    return f"run_id={run_id}"


def run_path(base: str, run_id: str) -> str:
    return f"{base.rstrip('/')}/{run_name(run_id)}"


def list_runs(spark: SparkSession, base: str, committed: bool = True) -> list[str]:
    """Names of run folders, oldest first, on any file system Spark can reach."""
    found = _found(spark, f"{base.rstrip('/')}/{RUN_PREFIX}*" + ("/_SUCCESS" if committed else ""))
    return sorted((path.getParent() if committed else path).getName() for path in found)


def _path(spark: SparkSession, path: str):
    """A path and the file system it is on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _found(spark: SparkSession, pattern: str) -> list:
    path, fs = _path(spark, pattern)
    return [f.getPath() for f in fs.globStatus(path) or []]


def commits(spark: SparkSession, base: str) -> dict[str, str | None]:
    """Committed runs, oldest first, each with the token of its writing: one listing. A run
    that something else wrote has none."""
    found = _found(spark, f"{base.rstrip('/')}/{RUN_PREFIX}*/_{{SUCCESS,{TOKEN_PREFIX[1:]}*}}")
    tokens: dict[str, str | None] = {}
    complete = set()
    for path in found:
        run, name = path.getParent().getName(), path.getName()
        if name == "_SUCCESS":
            complete.add(run)
        else:
            tokens[run] = name.removeprefix(TOKEN_PREFIX)
    return {run: tokens.get(run) for run in sorted(complete)}


def latest_run(spark: SparkSession, base: str) -> str:
    """Folder name of the last run; fails when there is none."""
    runs = list_runs(spark, base)
    if not runs:
        raise NoRuns(f"no '{RUN_PREFIX}' folders in {base}")
    return runs[-1]


def runs_before(spark: SparkSession, base: str, run_id: str) -> list[str]:
    """Runs older than ``run_id``: a retried run must not see its own first try."""
    return [r for r in list_runs(spark, base) if r < run_name(run_id)]


def folder_bytes(spark: SparkSession, folder: str) -> int:
    path, fs = _path(spark, folder)
    return fs.getContentSummary(path).getLength()


def drop_run(spark: SparkSession, base: str, run_id: str) -> None:
    """Remove a run's folder, so it does not count as a run."""
    drop_folder(spark, run_path(base, run_id))


def drop_folder(spark: SparkSession, folder: str) -> None:
    path, fs = _path(spark, folder)
    fs.delete(path, True)


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """Put a small text file in place as a whole: readers see all of it or none, and an
    older one until then."""
    target, fs = _path(spark, path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(f"{target.getParent().toString()}/_{target.getName()}")
    out = fs.create(hidden, True)
    out.write(bytearray(text.encode()))
    out.close()
    kind = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(hidden), fs.makeQualified(target), options)


def drop_notes(spark: SparkSession, pattern: str, keep: str) -> None:
    """Remove the notes a pattern finds, but one."""
    for path in _found(spark, pattern):
        if path.getName() != keep:
            drop_note(spark, path.toString())


# Notes that are read one by one, without a job.
FEW_NOTES = 64


def read_notes(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """Lines of all notes in a folder by file name; many are read as one small table."""
    found = [path for path in _found(spark, f"{folder.rstrip('/')}/*") if not path.getName().startswith(("_", "."))]
    if len(found) <= FEW_NOTES:
        return {path.getName(): _read_text(spark, path.toString()).splitlines() for path in found}
    notes: dict[str, list[str]] = {}
    for name, line in spark.read.text(folder).select("_metadata.file_name", "value").collect():
        notes.setdefault(name, []).append(line)
    return notes


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _path(spark, path)
    return fs.exists(target)


def make_folder(spark: SparkSession, folder: str) -> None:
    path, fs = _path(spark, folder)
    fs.mkdirs(path)


def drop_note(spark: SparkSession, path: str) -> None:
    target, fs = _path(spark, path)
    fs.delete(target, False)


def write_run(
    df: DataFrame,
    base: str,
    run_id: str,
    partition_by: Sequence[str] = (),
    rebalance: bool = True,
    audit: Audit | None = None,
    note: Callable[[str], None] | None = None,
) -> int:
    """Write one run's folder and return its row count, without a second job.

    The rows are staged; ``audit`` looks at them as read back, ``note`` is told the token of
    this writing; then the folder takes its place, or that of the run's earlier try. If
    anything raises, the staged rows are dropped and readers never saw them.

    REBALANCE sizes the files: rows of one directory go together, small partitions are
    merged, and a directory holding a third of the data is split over many tasks, which
    ``repartition`` on the columns would hand to one. Small results end up in one file.
    Rows that leave a shuffle evenly and all get written can do without.
    """
    spark, token, rows = df.sparkSession, uuid.uuid4().hex, Observation()
    staging = f"{base.rstrip('/')}/{STAGING}/{token}"
    # Counted behind the last shuffle, where a recomputed map task cannot count twice.
    placed = df.hint("rebalance", *partition_by) if rebalance else df
    writer = placed.observe(rows, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.parquet(run_path(staging, run_id))
        written = rows.get["n"]
        if audit is not None:
            audit(read_runs(spark, staging, df.schema, [run_name(run_id)]).select(*df.columns), written)
        if note is not None:
            note(token)
        _publish_staged(spark, base, staging, run_id, token)
    finally:
        drop_folder(spark, staging)
    return written


def _publish_staged(spark: SparkSession, base: str, staging: str, run_id: str, token: str) -> None:
    """Move a staged run to its place. One that is there is moved aside first: between the
    two renames the run does not exist, and nothing says that it did."""
    staged, fs = _path(spark, run_path(staging, run_id))
    fs.create(spark._jvm.org.apache.hadoop.fs.Path(staged, f"{TOKEN_PREFIX}{token}"), True).close()
    place, _ = _path(spark, run_path(base, run_id))
    aside, _ = _path(spark, f"{staging}/replaced")
    if fs.exists(place) and not fs.rename(place, aside):
        raise OSError(f"cannot replace {place.toString()}")
    if not fs.rename(staged, place):
        raise OSError(f"cannot publish {place.toString()}")


def read_runs(spark: SparkSession, base: str, schema: T.StructType, runs: Sequence[str] | None = None) -> DataFrame:
    """All (or the named) runs as one table, with a ``run_id`` column.

    The schema is given, not inferred: numeric-looking partition values stay text and
    a run without files can be read.
    """
    if runs is None:
        runs = list_runs(spark, base)
    full = T.StructType(schema.fields + [T.StructField("run_id", T.StringType())])
    if not runs:
        return spark.createDataFrame([], full)
    packed = _packed(spark, base)
    paths = [f"{base.rstrip('/')}/{name}" for name in runs if name not in packed]
    parts = [spark.read.schema(full).option("basePath", base).parquet(*paths)] if paths else []
    for pack in sorted({packed[name] for name in runs if name in packed}):
        held = [name.removeprefix("run_id=") for name in runs if packed.get(name) == pack]
        rows = spark.read.schema(full).option("basePath", pack).parquet(pack)
        parts.append(rows.where(F.col("run_id").isin(held)).select(*full.fieldNames()))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.select(*full.fieldNames()).unionByName(part)
    return whole


def read_run(spark: SparkSession, base: str, schema: T.StructType, run: str | None = None) -> DataFrame:
    """One run (default: the latest) in the layer's column order."""
    run = run or latest_run(spark, base)
    return read_runs(spark, base, schema, [run]).select(*schema.fieldNames())


def _read_text(spark: SparkSession, path: str) -> str:
    target, fs = _path(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _packs(spark: SparkSession, base: str) -> dict[str, dict[str, str]]:
    """Packs, oldest first, with the runs and tokens each of them holds."""
    found = sorted(path.toString() for path in _found(spark, f"{base.rstrip('/')}/{PACKS}/pack_*/_runs"))
    return {path.rpartition("/")[0]: dict(line.split(" ") for line in _read_text(spark, path).splitlines()) for path in found}


def _packed(spark: SparkSession, base: str) -> dict[str, str]:
    """The newest pack that holds a run as it was written last, by run."""
    packs = _packs(spark, base)
    tokens = commits(spark, base) if packs else {}
    return {run: pack for pack, held in packs.items() for run, token in held.items() if tokens.get(run) == token}


def _bins(sizes: dict[str, int], capacity: int) -> list[list[str]]:
    """Names in as few bins as first fit, largest first, finds; larger ones are left out."""
    bins: list[list] = []
    for name in sorted((n for n in sizes if sizes[n] <= capacity), key=lambda n: (-sizes[n], n)):
        place = next((b for b in bins if b[0] + sizes[name] <= capacity), None)
        if place is None:
            bins.append([sizes[name], [name]])
        else:
            place[0] += sizes[name]
            place[1].append(name)
    return [names for _, names in bins]


def compact(
    spark: SparkSession, base: str, schema: T.StructType, partition_by: Sequence[str] = (), target_bytes: int = 128 << 20, pack_bytes: int = 32 << 30
) -> list[str]:
    """Pack the rows of runs with small files together, ``run_id`` as a column; returns the
    new packs' folders.

    Runs whose files are smaller than half of ``target_bytes`` on average, and packs that
    hold such runs, are put into bins of at most ``pack_bytes``; each bin of two or more
    becomes a pack, with files of about ``target_bytes``, at least one a directory. A pack
    appears by a rename with the list of what it holds, and from then on every reader of
    :func:`read_runs` takes those runs from it; one that began before goes on with the old
    files until :func:`drop_packed`. A run written again is read from its folder. The rows
    are counted before a pack is published. Run names, and what was noted, stay.
    """
    tokens, packs, packed = commits(spark, base), _packs(spark, base), _packed(spark, base)
    units = {run: [run] for run, token in tokens.items() if token and run not in packed}
    units |= {pack: held for pack in packs if (held := sorted(r for r, p in packed.items() if p == pack))}
    sizes = {}
    for name in units:
        path, fs = _path(spark, name if name in packs else f"{base.rstrip('/')}/{name}")
        summary = fs.getContentSummary(path)
        if summary.getLength() < target_bytes / 2 * max(summary.getFileCount(), 1):
            sizes[name] = summary.getLength()
    made = []
    for names in _bins(sizes, pack_bytes):
        runs = sorted(run for name in names for run in units[name])
        if len(names) > 1:
            made.append(_pack(spark, base, schema, partition_by, target_bytes, runs, tokens, len(packs) + len(made)))
    return made


def _pack(spark: SparkSession, base: str, schema: T.StructType, partition_by: Sequence[str], target_bytes: int, runs: list[str], tokens: dict, number: int) -> str:
    name = f"pack_{number:08d}_{uuid.uuid4().hex}"
    staging, place = (f"{base.rstrip('/')}/{folder}/{name}" for folder in (STAGING, PACKS))
    rows, seen = read_runs(spark, base, schema, runs), Observation()
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, str(target_bytes))
    try:
        # A reader of one run skips row groups of others.
        placed = rows.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, "run_id")
        writer = placed.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(staging)
        expected = rows.count()
        if seen.get["n"] != expected:
            raise RuntimeError(f"packed {seen.get['n']} rows of {expected}")
        write_note(spark, f"{staging}/_runs", "\n".join(f"{run} {tokens[run]}" for run in runs))
        source, fs = _path(spark, staging)
        make_folder(spark, f"{base.rstrip('/')}/{PACKS}")
        if not fs.rename(source, _path(spark, place)[0]):
            raise OSError(f"cannot publish {place}")
    finally:
        spark.conf.set(advisory, before)
        drop_folder(spark, staging)
    return place


def drop_packed(spark: SparkSession, base: str) -> list[str]:
    """Remove the data files of runs that a pack holds, but not the runs' markers, and packs
    that newer ones stand for: call it when no reader of before the packing is left, and not
    beside a catalog table of :func:`publish`, which reads the runs' folders. Returns the
    names of the runs."""
    packed = _packed(spark, base)
    for run in packed:
        path, fs = _path(spark, f"{base.rstrip('/')}/{run}")
        for status in fs.listStatus(path):
            if not status.getPath().getName().startswith(("_", ".")):
                fs.delete(status.getPath(), True)
    for pack in set(_packs(spark, base)) - set(packed.values()):
        drop_folder(spark, pack)
    return list(packed)


def run_stamp(run: DataFrame, ts: str) -> datetime | None:
    """The one stamp that all rows of a run carry; None without rows. Reads one row."""
    row = run.select(F.unix_micros(ts)).first()
    return moment(row[0]) if row else None


def publish(
    spark: SparkSession,
    table: str,
    base: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    database_path: str | None = None,
    runs: Sequence[str] | None = None,
) -> DataFrame:
    """Make a layer queryable as ``database.table``, idempotently.

    Creates what does not exist yet and registers what was written since the last call;
    data stays where it is. Looking for that lists every directory of every run; with
    ``runs`` (ids) only those are listed and registered, anew if they were repeated.
    """
    database = table.rpartition(".")[0]
    if database:
        location = f" LOCATION '{database_path}'" if database_path else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{location}")
    partitions = ["run_id", *partition_by]
    types = {f.name: f.dataType.simpleString() for f in schema.fields} | {"run_id": "string"}
    order = [c for c in types if c not in partitions] + partitions
    columns = ", ".join(f"{c} {types[c]}" for c in order)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(partitions)}) LOCATION '{base}'"
    )
    if runs is None:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    for run_id in runs or ():
        _publish_run(spark, table, base, run_id, len(partition_by))
    spark.catalog.refreshTable(table)
    return spark.table(table)


def _publish_run(spark: SparkSession, table: str, base: str, run_id: str, depth: int) -> None:
    """Replace one run's partitions in the catalog by the directories it has now."""
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (run_id = {_sql(run_id)})")
    root = run_path(base, run_id)
    path = spark._jvm.org.apache.hadoop.fs.Path("/".join([root, *["*=*"] * depth]))
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    folders = [f.getPath().toString().rstrip("/").rsplit("/", depth + 1)[1:] for f in found if f.isDirectory()]
    for at in range(0, len(folders), 200):
        specs = (", ".join(f"{k} = {_sql(unquote(v))}" for k, _, v in (p.partition("=") for p in f)) for f in folders[at : at + 200])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(f"PARTITION ({spec})" for spec in specs))


def _sql(value: str) -> str:
    """A partition value as a SQL literal."""
    if value == "__HIVE_DEFAULT_PARTITION__":
        return "NULL"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
