"""Very many small files: written by the tasks, read back folder by folder.

A folder per file, its rename at the end of the job and its listing cost more
than the file.  Here a task writes its files into few flat folders, and the
driver knows folders only; the tasks list and read them (:func:`read_texts`), or
a reader of Spark takes some folders at a time.
"""

from __future__ import annotations

import gzip
import re
import sys
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as afs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.session import scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOLDER_FILES = 5_000        # files of a folder
READ_FOLDERS = 10           # folders read by one job
TEXT_BYTES = 4 << 20        # text a task hands over at once; one file at least
HIDDEN = re.compile(r"\.|_[^=]*$")      # names that Spark's readers leave out
NO_KEY = "__HIVE_DEFAULT_PARTITION__"


def file_system(path: str) -> tuple[afs.FileSystem, str]:
    """File system and name of a path, by its scheme (local, HDFS, object stores)."""
    scheme, found, rest = path.partition(":")
    if found and scheme != "file":
        return afs.FileSystem.from_uri(path)
    return afs.LocalFileSystem(), "/" + (rest if found else path).lstrip("/")


def write_files(rows: DataFrame, key: str, line: str, root: str, gz: bool = False, folder_files: int = FOLDER_FILES) -> list[str]:
    """One text file ``<key>=<value>.txt[.gz]`` per key and task, holding the task's ``line`` of that key, each ended by
    a line feed (NULL: an empty line); ``rows`` are sorted by ``key`` within their partitions.

    Returns the folders below ``root`` that hold them.  Only those of task
    attempts that came to their end are among them.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(root)
        ctx = TaskContext.get()
        home = f"task={ctx.partitionId()}-{ctx.taskAttemptId()}"
        folders, files, at, out = [], 0, None, None
        try:
            for b in batches:
                for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    if out is None or k != at:
                        if out is not None:
                            out.close()
                        if files % folder_files == 0:
                            folders.append(f"{home}-{len(folders)}")
                            system.create_dir(f"{base}/{folders[-1]}")
                        name = NO_KEY if k is None else quote(k, safe="")
                        out = system.open_output_stream(f"{base}/{folders[-1]}/{key}={name}.txt{'.gz' if gz else ''}", compression=None)
                        if gz:
                            out = _Gzip(out)
                        at, files = k, files + 1
                    out.write((text or b"") + b"\n")
        finally:
            if out is not None:
                out.close()
        yield pa.RecordBatch.from_arrays([pa.array(folders, pa.string())], names=["folder"])

    pairs = rows.select(F.col(key).cast("string").alias("k"), F.col(line).cast("binary").alias("v"))
    return sorted(f"{root}/{r['folder']}" for r in pairs.mapInArrow(task, "folder string").collect())


class _Gzip:
    """A gzip member written to ``raw``."""

    def __init__(self, raw):
        self.raw, self.packed = raw, gzip.GzipFile(fileobj=raw, mode="wb", mtime=0)

    def write(self, data: bytes) -> None:
        self.packed.write(data)

    def close(self) -> None:
        self.packed.close()
        self.raw.close()


def key_of(path: Column, key: str) -> Column:
    """The key, as text, in the path of a file of :func:`write_files`; NULL for the file of the NULL key."""
    name = F.regexp_extract(path, rf"{key}=([^/.]+)", 1)
    return F.when(name != NO_KEY, name)


def read_texts(spark, folders: list[str]) -> DataFrame:
    """``path, value``: every file of the flat ``folders`` as one text, listed and read by the tasks.

    As in Spark's reader of whole texts, hidden and empty files are left out and
    packed ones unpacked; that reader lists the files in the driver, which also
    keeps the lists of earlier jobs (some 800 bytes a file).
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(values, pa.binary())], names=["path", "value"])

        for folder in (f for b in batches for f in b.column(0).to_pylist()):
            system, base = file_system(folder)
            paths, values, size = [], [], 0
            for file in system.get_file_info(afs.FileSelector(base)):
                if not file.is_file or file.size == 0 or HIDDEN.match(file.base_name):
                    continue
                with system.open_input_stream(file.path) as f:
                    values.append(f.read())
                paths.append(file.path)
                size += len(values[-1])
                if size >= TEXT_BYTES:
                    yield batch()
                    paths, values, size = [], [], 0
            yield batch()

    tasks = min(len(folders), 2 * spark.sparkContext.defaultParallelism)
    names = spark.createDataFrame([(f,) for f in folders], "folder string").repartition(tasks)
    return names.mapInArrow(task, "path string, value binary").withColumn("value", F.col("value").cast("string"))


def read_folders(spark, root: str, folders: list[str], read: Callable[[list[str]], DataFrame], at_once: int | None = READ_FOLDERS) -> DataFrame:
    """What ``read`` makes of the files in ``folders``, ``at_once`` folders a job (None: all), stored under the shared folder.

    ``read`` takes paths and returns rows that are small beside the files.
    """
    out = scratch(spark, "read")
    at_once = at_once or max(1, len(folders))
    groups = [folders[i:i + at_once] for i in range(0, len(folders), at_once)] or [[root]]
    for paths in groups:
        # files are many and small: two tasks a core, not one and an output file for every 32
        read(paths).coalesce(2 * spark.sparkContext.defaultParallelism).write.mode("append").parquet(out)
    return spark.read.parquet(out)
