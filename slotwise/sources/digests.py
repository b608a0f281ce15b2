"""Digests of image files of any size: blocks into one running digest, never the body as one value.

The functions that run in tasks are pickled by value, so executors need no
installed copy of the package.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.sources.files import file_system
from slotwise.sources.readers import image_files

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_BYTES = 4 << 20       # of a file read at once
ONE_VALUE = 64 << 20        # files up to this size are digested inside the scan
TASK_BYTES = 256 << 20      # of files streamed by one task, about
TASK_FILES = 1_000          # files streamed by one task, about


def blocks(path: str, size: int) -> Iterator[bytes]:
    """The bytes of a file, ``size`` at a time, by its scheme's file system (local, HDFS, object stores)."""
    system, name = file_system(path)
    with system.open_input_stream(name) as stream:
        while block := stream.read(size):
            yield block


def streamed_digests(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``path, length, sha256`` of ``files`` (path, length), each read block by block.

    A digest runs from the first byte to the last, so a file is one task's
    work; files are dealt to as many tasks as their bytes and their number ask
    for, up to one a file.  A file that is gone, or that no
    longer has its listed length, has no digest (NULL); other read errors fail
    the task, which Spark tries again.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for path, length in zip(b.column("path").to_pylist(), b.column("length").to_pylist()):
                digest, seen = hashlib.sha256(), 0
                try:
                    for block in blocks(path, block_bytes):
                        digest.update(block)
                        seen += len(block)
                except FileNotFoundError:
                    seen = -1
                out.append(digest.hexdigest() if seen == length else None)
            yield pa.RecordBatch.from_arrays([b.column("path"), b.column("length"), pa.array(out, pa.string())],
                                             names=["path", "length", "sha256"])

    rows = files.select("path", F.col("length").cast("long").alias("length"))
    # a number given outright is not coalesced at run time: paths are tiny, the files behind them are not
    return rows.repartition(stream_tasks(rows)).mapInArrow(task, "path string, length long, sha256 string")


def stream_tasks(rows: DataFrame) -> int:
    """Tasks for the files in ``rows`` (path, length)."""
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    return max(1, min(n, -(-size // TASK_BYTES) + -(-n // TASK_FILES)))


def image_digests(spark, path_glob: str | list[str], recursive: bool = True, name_glob: str | None = None,
                  one_value: int = ONE_VALUE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``path, length, sha256`` of image files of any size.

    Files up to ``one_value`` bytes are digested inside the scan, larger ones
    by :func:`streamed_digests`; the same bytes give the same digest either
    way, so ``one_value`` only decides how much memory a task needs.
    """
    files = image_files(spark, path_glob, recursive, name_glob)
    small = files.where(F.col("length") <= one_value).select("path", "length", F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > one_value).select("path", "length")
    return small.unionByName(streamed_digests(large, block_bytes))
