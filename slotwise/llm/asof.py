"""As-of scan: the latest value before each row, per key, for keys of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.common import cut


def latest_before(rows: DataFrame, key: str, order: list[str], value: Column, out: str) -> DataFrame:
    """``rows`` with ``out``, the last non-NULL ``value`` among the rows of the same ``key`` that come before in ``order``.

    Rows are stored in ranges of (key, order), so that a hot key is split like
    all others and every branch below sees the same ranges.  Each range looks
    back within itself; what it hands on is one row for each of its keys, and
    the few keys that reach over several ranges take it from there.
    """
    laid = cut(rows.withColumn("__value", value).repartitionByRange(key, *order).withColumn("__range", F.spark_partition_id()))
    inside = Window.partitionBy(key, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    found = laid.withColumn("__inside", F.last("__value", ignorenulls=True).over(inside))
    last = F.max_by("__value", F.when(F.col("__value").isNotNull(), F.struct(*order)))
    earlier = Window.partitionBy(key).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    handed = (laid.groupBy(key, "__range").agg(last.alias("__last"))
                  .select(key, "__range", F.last("__last", ignorenulls=True).over(earlier).alias("__before"))
                  .filter(F.col("__before").isNotNull()))
    return (found.join(handed, [key, "__range"], "left").withColumn(out, F.coalesce("__inside", "__before"))
                 .drop("__range", "__value", "__inside", "__before"))
