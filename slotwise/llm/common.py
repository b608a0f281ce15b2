"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.session import checkpoint_dir

# Characters handled by one numpy pass; longer inputs are cut into such pieces.
PIECE = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str | Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(mod))


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def counted(df: DataFrame, count: Callable[[list], dict[int, np.ndarray]], size: int, groups: int = 1) -> np.ndarray:
    """Sum count vectors of fixed length over all rows: (groups, size) int64 on the driver.

    ``count`` maps the columns of an Arrow batch to {group: vector}.  A task
    adds up its own batches and emits only the non-zero slots; Spark sums the
    slots.  The result has at most ``groups * size`` numbers at any input size.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for g, v in count([c.to_pylist() for c in b.columns]).items():
                if g in total:
                    total[g] += v
                else:
                    total[g] = v.astype(np.int64)
        for g, v in total.items():
            at = np.flatnonzero(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at + g * size, pa.int64()), pa.array(v[at], pa.int64())], names=["slot", "n"])

    rows = df.mapInArrow(task, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(groups * size, np.int64)
    out[rows["slot"].to_numpy()] = rows["n"].to_numpy()
    return out.reshape(groups, size)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing of uint64 numbers (multiply, shift, xor)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))
