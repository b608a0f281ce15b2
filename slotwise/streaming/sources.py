"""File stream sources for tests and demos.

A real deployment points ``readStream`` at the folder devices upload to.  To
replay a table as a stream, :func:`stage_slices` writes it in one job, in
slices of arrival time, and sets the files' times in slice order; the file
source reads files by time, so as many files per trigger as a slice has give
one slice per micro-batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


FILE_ROWS = 1 << 20     # rows of a file, about


def stage_slices(df: DataFrame, path: str, arrived: Column, closing: DataFrame | None = None, slices: int = 6,
                 file_rows: int = FILE_ROWS) -> int:
    """Write ``df`` under ``path`` as ``slices`` slices of equal spans of ``arrived`` (microseconds).

    A slice is as many files, each written by a task of its own, as its rows
    ask for.  ``closing`` (same columns) comes last, in a slice of its own:
    events late enough to carry the watermark past everything else.  Returns
    the most files that a slice has: the files per trigger that make a slice a
    micro-batch.
    """
    spark = df.sparkSession
    lo, hi, n = df.agg(F.min(arrived), F.max(arrived), F.count(F.lit(1))).first()
    if lo is None:
        return 1
    files = max(1, -(-n // (slices * file_rows)))
    step = max(1, -(-(hi + 1 - lo) // slices))
    rows = df.withColumn("slice", F.floor((arrived - F.lit(lo)) / F.lit(step)).cast("int"))
    if closing is not None:
        rows = rows.unionByName(closing.withColumn("slice", F.lit(slices)))
    part = F.col("slice") * files + F.pmod(F.xxhash64(*df.columns), F.lit(files))
    rows.repartitionById((slices + 1) * files, part.cast("int")).write.partitionBy("slice").parquet(path)
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = sorted((int(st.getPath().getName().split("=")[1]), st.getPath())
                     for st in fs.listStatus(root) if st.getPath().getName().startswith("slice="))
    for k, folder in folders:
        for st in fs.listStatus(folder):
            fs.setTimes(st.getPath(), 1_700_000_000_000 + k * 60_000, -1)
    return files
