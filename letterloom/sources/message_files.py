"""One file per message, many per task, as a sink of ``DataFrame.write``."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatchcase
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from letterloom.session import work_path

#: Files of one folder at most.
FOLDER_FILES = 1_000
#: Folders that a task lists, and files and bytes that a task reads, about.
TASK_FOLDERS, TASK_FILES, TASK_BYTES = 32, 10_000, 64 << 20
#: Bytes after which what has been read leaves the worker.
BATCH_BYTES = 4 << 20

LISTED = "path string, size long, modified timestamp, folder boolean"
_INSTANT = pa.timestamp("us", tz="UTC")


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path within it."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


@dataclass
class Written(WriterCommitMessage):
    folder: str
    files: int


@dataclass
class MessageFileWriter(DataSourceWriter):
    """Tasks write below a folder whose leading underscore hides it from readers; the commit gives it its name.

    Every attempt of a task has a folder of its own, so a lost, repeated or speculative one leaves nothing
    behind: the commit removes the folders of attempts that Spark did not accept, then renames one folder.
    Files are numbered, or named by a second column; rows of one name that follow each other share a file.
    """

    path: str
    overwrite: bool
    job: str
    suffix: str

    def write(self, iterator: Iterator[Row]) -> Written:
        store, root = open_store(self.path)
        task = TaskContext.get()
        folder = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        files = 0
        for name, rows in groupby(enumerate(iterator), lambda row: row[1][1] if len(row[1]) > 1 else row[0]):
            place = f"{root}/_{self.job}/{folder}/{files // FOLDER_FILES:06d}"
            if files % FOLDER_FILES == 0:
                store.create_dir(place, recursive=True)
            called = name if isinstance(name, str) else f"{files % FOLDER_FILES:03d}"
            with store.open_output_stream(f"{place}/{called}{self.suffix}") as out:
                for _, (content, *_) in rows:
                    out.write(b"" if content is None else bytes(content))
            files += 1
        return Written(folder, files)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = open_store(self.path)
        hidden = f"{root}/_{self.job}"
        store.create_dir(hidden, recursive=True)
        accepted = {m.folder for m in messages if m is not None}
        for found in store.get_file_info(fs.FileSelector(hidden)):
            if found.base_name not in accepted:
                store.delete_dir(found.path)
        older = [f for f in store.get_file_info(fs.FileSelector(root)) if f.base_name.startswith("job-")]
        store.move(hidden, f"{root}/{self.job}")
        for found in older if self.overwrite else ():
            store.delete_dir(found.path)

    def abort(self, messages: list[Written | None]) -> None:
        store, root = open_store(self.path)
        if store.get_file_info(f"{root}/_{self.job}").type == fs.FileType.Directory:
            store.delete_dir(f"{root}/_{self.job}")


class MessageFiles(DataSource):
    """``df.write.format("message_files")``: the first column, binary, of each row becomes a file.

    Null and empty contents become empty files, which Spark's own readers pass over; rows that
    repeat are written each. A second column of text names the files; a name holds no "/" and its rows have to
    follow each other in one partition, where they are put together. The option ``suffix`` ends the names (".eml"). Appending adds a folder; overwriting removes those of earlier writes, and
    only those, after the new one is there. Stores need a file system that pyarrow knows.
    """

    @classmethod
    def name(cls) -> str:
        return "message_files"

    def writer(self, schema: StructType, overwrite: bool) -> MessageFileWriter:
        if not schema or schema[0].dataType.typeName() != "binary":
            raise ValueError("the first column has to hold the bytes of the files")
        if len(schema) > 1 and schema[1].dataType.typeName() != "string":
            raise ValueError("the second column has to hold the names of the files")
        return MessageFileWriter(self.options["path"], overwrite, f"job-{uuid.uuid4().hex}", self.options.get("suffix", ".eml"))


def _hidden(name: str, folder: bool) -> bool:
    """Names that Spark's own readers pass over."""
    if folder and name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _root(spark: SparkSession, path: str) -> tuple[str, str] | None:
    """(what Spark's paths have in front, the folder within its store), or nothing if tasks cannot list it."""
    local = re.match(r"(?:file:)?/+", path)
    if any(c in path for c in "*?[]{}\\%"):
        return None
    if path.startswith("/"):
        local = spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:")
        if not local:
            return None
    try:
        store, root = open_store(path.rstrip("/"))
        if store.get_file_info(root).type != fs.FileType.Directory:
            return None
    except (pa.ArrowException, OSError, ValueError):
        return None
    if local:
        return "file:", root
    front = path.rstrip("/").removesuffix(root)
    return (front, root) if front != path.rstrip("/") else None


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame | None:
    """(path, size, modified) of the files below a folder; nothing where tasks cannot list it.

    Folders are listed by tasks, a level of the tree at a time, and what they hold is written beside the
    checkpoints: only numbers of folders reach the driver. Names that Spark passes over are passed over, empty
    files too. ``glob`` knows "*" and "?". Stores need a file system that pyarrow knows; one folder is listed by one task.
    """
    found = None if glob and set(glob) & set("[]{}\\") else _root(spark, path)
    if found is None:
        return None
    front, root = found

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(path.rstrip("/"))
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                infos = store.get_file_info(fs.FileSelector(folder.removeprefix(front)))
                rows = [(i, i.type == fs.FileType.Directory) for i in infos]
                rows = [
                    (front + i.path, i.size or 0, i.mtime_ns // 1_000_000 * 1_000, inner)
                    for i, inner in rows
                    if not _hidden(i.base_name, inner) and (inner or (i.size and (not glob or fnmatchcase(i.base_name, glob))))
                ]
                for at in range(0, len(rows), TASK_FILES):
                    paths, sizes, times, inner = zip(*rows[at : at + TASK_FILES])
                    arrays = [pa.array(paths), pa.array(sizes, pa.int64()), pa.array(times, pa.int64()).cast(_INSTANT), pa.array(inner)]
                    yield pa.RecordBatch.from_arrays(arrays, ["path", "size", "modified", "folder"])

    place, levels = work_path(spark, "listing"), []
    level, tasks = spark.createDataFrame([(front + root,)], "path string"), 1
    while tasks:
        levels.append(f"{place}/{len(levels)}")
        level.repartition(tasks, "path").mapInArrow(entries, LISTED).write.parquet(levels[-1])
        level = spark.read.schema(LISTED).parquet(levels[-1]).where("folder").select("path")
        count = level.count()
        tasks = min(count, max(spark.sparkContext.defaultParallelism, -(-count // TASK_FOLDERS)))
    return spark.read.schema(LISTED).parquet(*levels).where("not folder").select("path", "size", "modified")


def read_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, modificationTime, content), a row per file below a folder, as Spark's reader of binary files gives them.

    Tasks list the folders and read the files, so neither a list nor a plan of them passes the driver. For
    addresses with patterns and stores unknown to pyarrow it is Spark's reader, whose list does.
    """
    files = list_files(spark, path, glob)
    if files is None:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        return reader.load(path).select("path", "modificationTime", "content")
    count, size = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    parts = max(min(count, spark.sparkContext.defaultParallelism), -(-count // TASK_FILES), -(-size // TASK_BYTES), 1)
    front = _root(spark, path)[0]

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(path.rstrip("/"))

        def packed(batch: pa.RecordBatch, first: int, read: list[bytes]) -> pa.RecordBatch:
            some = batch.slice(first, len(read))
            return pa.RecordBatch.from_arrays(
                [some.column("path"), some.column("modified"), pa.array(read, pa.binary())], ["path", "modificationTime", "content"]
            )

        for batch in batches:
            first, read, held = 0, [], 0
            for address in batch.column("path").to_pylist():
                with store.open_input_stream(address.removeprefix(front)) as file:
                    read.append(file.read())
                held += len(read[-1])
                if held >= BATCH_BYTES:
                    yield packed(batch, first, read)
                    first, read, held = first + len(read), [], 0
            if read:
                yield packed(batch, first, read)

    dealt = files.repartition(parts, "path")
    return dealt.mapInArrow(contents, "path string, modificationTime timestamp, content binary")
