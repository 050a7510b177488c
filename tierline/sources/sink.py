"""A data source that writes one lake run, committed by the driver.

``df.write.format("lake_run").option("path", base).option("runId", run_id).mode("append")``
writes what :func:`tierline.sources.lake.write_run` does, in the layout that
:mod:`tierline.sources.lake` reads, for writers that are plain Spark jobs. A task writes
below ``_staging`` and returns a commit message with its files and rows. When all tasks are
done the driver moves the files it has messages for into the run and publishes it by a
rename; files of attempts that failed, or ran beside another, have no message. If a task
fails for good the staged files are dropped, and an earlier try of the run stays. What a
task writes that was still running then stays below ``_staging``, where no reader looks,
until :func:`tierline.plans.stages.retain`.

The file system is pyarrow's (local, HDFS); one without a rename of folders will not do.
"""

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tierline.sources.lake import STAGING, TOKEN_PREFIX, run_name


# Folders a task has a file open in; with more, it starts new files.
MOST_OPEN = 200


@dataclass
class Written(WriterCommitMessage):
    """Files of one task, relative to its own folder, and their rows."""

    folder: str
    files: list[str]
    rows: int


# Characters that Spark escapes in the folder name of a partition value.
_ESCAPED = {*map(chr, range(32)), "\x7f", *"\"#%'*/:=?\\{[]^"}


def folder_name(value) -> str:
    """A partition value as Spark's own writer spells it; a blank one is null."""
    if value is None or value == "":
        return "__HIVE_DEFAULT_PARTITION__"
    value = str(value)
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in value)


def _system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if ":/" in path else f"file://{path}")


class LakeRunWriter(DataSourceArrowWriter):
    def __init__(self, base: str, run_id: str, partition_by: list[str], expected: int | None, overwrite: bool):
        self.base = base.rstrip("/")
        self.run_id = run_id
        self.partition_by = partition_by
        self.expected = expected
        self.overwrite = overwrite
        self.staging = f"{self.base}/{STAGING}/{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyarrow import parquet

        files, root = _system(f"{self.staging}/tasks/{uuid.uuid4().hex}")
        written: list[str] = []
        open_files: dict[str, parquet.ParquetWriter] = {}
        rows = 0
        for batch in iterator:
            rows += len(batch)
            for folder, part in self._parts(batch):
                if folder not in open_files:
                    if len(open_files) >= MOST_OPEN:
                        _close(open_files)
                    files.create_dir(f"{root}/{folder}")
                    written.append(f"{folder}/part-{uuid.uuid4().hex}.parquet".lstrip("/"))
                    open_files[folder] = parquet.ParquetWriter(f"{root}/{written[-1]}", part.schema, filesystem=files)
                open_files[folder].write_batch(part)
        _close(open_files)
        return Written(root, written, rows)

    def _parts(self, batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
        """The batch by folder, without the columns the folders stand for."""
        if not self.partition_by:
            yield "", batch
            return
        names = zip(*([f"{c}={folder_name(v)}" for v in batch.column(c).to_pylist()] for c in self.partition_by), strict=True)
        places: dict[str, list[int]] = {}
        for row, name in enumerate(map("/".join, names)):
            places.setdefault(name, []).append(row)
        kept = batch.select([c for c in batch.schema.names if c not in self.partition_by])
        for folder, at in places.items():
            yield folder, kept.take(pa.array(at))

    def commit(self, messages: list[Written | None]) -> None:
        """Publish what the tasks wrote, if it is as much as was expected."""
        files, staging = _system(self.staging)
        rows = sum(m.rows for m in messages if m)
        if self.expected is not None and rows != self.expected:
            files.delete_dir(staging)
            raise RuntimeError(f"{run_name(self.run_id)}: {rows} rows were written, {self.expected} expected")
        run = f"{staging}/{run_name(self.run_id)}"
        files.create_dir(run)
        folders = set()
        for message in filter(None, messages):
            for name in message.files:
                folder = name.rpartition("/")[0]
                if folder and folder not in folders:
                    files.create_dir(f"{run}/{folder}")
                    folders.add(folder)
                files.move(f"{message.folder}/{name}", f"{run}/{name}")
        for marker in ("_SUCCESS", f"{TOKEN_PREFIX}{staging.rpartition('/')[2]}"):
            files.open_output_stream(f"{run}/{marker}").close()
        place = f"{_system(self.base)[1]}/{run_name(self.run_id)}"
        if files.get_file_info(place).type.name == "Directory":
            if not self.overwrite:
                files.delete_dir(staging)
                raise RuntimeError(f"{run_name(self.run_id)} is committed; mode overwrite replaces it")
            files.move(place, f"{staging}/replaced")
        files.move(run, place)
        files.delete_dir(staging)

    def abort(self, messages: list[Written | None]) -> None:
        files, staging = _system(self.staging)
        if files.get_file_info(staging).type.name == "Directory":
            files.delete_dir(staging)


def _close(open_files: dict) -> None:
    for writer in open_files.values():
        writer.close()
    open_files.clear()


class LakeRunSink(DataSource):
    """Options: ``path`` (the layer's folder), ``runId``, ``partitionBy`` (column names with
    commas) and ``expectedRows`` (another number written is not published). Mode ``append``
    refuses a run that is committed, ``overwrite`` replaces it and no other."""

    @classmethod
    def name(cls) -> str:
        return "lake_run"

    def writer(self, schema, overwrite: bool) -> LakeRunWriter:
        by = [c.strip() for c in self.options.get("partitionBy", "").split(",") if c.strip()]
        expected = self.options.get("expectedRows")
        return LakeRunWriter(self.options["path"], self.options["runId"], by, None if expected is None else int(expected), overwrite)
