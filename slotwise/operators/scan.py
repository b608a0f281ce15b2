"""Ordered scans over per-key histories that stay parallel when one key is hot.

A plain ``Window.partitionBy(key).orderBy(t)`` puts every row of a key into
one task.  Event histories (actions, runs) are unbounded per device, so every
scan here cuts the history into contiguous *chunks* and runs a two-level
prefix scan:

1. inside each (key, chunk): a local window, one task per chunk;
2. one summary row per (key, chunk): what the chunk hands to later chunks;
3. a window over the summaries only gives each chunk its carry-in, which is
   joined back on (key, chunk), for the few keys that reach beyond a chunk.

Chunks are the partitions of a range partitioning by key and order
(:func:`ranged`), stored once, so they hold about equal shares of the rows: a
hot key, or a hot day of it, is split like any other, and all others lie in one
chunk.  There is one path for every size, and no edge of a range ever appears
in a plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.session import checkpoint_dir


def ranged(df: DataFrame, by: str | Sequence[str], parts: int | None = None) -> DataFrame:
    """``df`` with ``chunk``, the number of its range of ``by`` (ascending), stored in the checkpoint folder.

    Spark samples the edges of the ranges and the rows move once.  They are
    stored then and there: whatever branches of a plan read the result, and
    whichever executor is lost, a row keeps its chunk.  Without ``parts`` the
    number of ranges follows the bytes (adaptive coalescing of the partitions).
    """
    by = [by] if isinstance(by, str) else list(by)
    dealt = df.repartitionByRange(parts, *by) if parts else df.repartitionByRange(*by)
    checkpoint_dir(df.sparkSession)
    return dealt.withColumn("chunk", F.spark_partition_id()).checkpoint(eager=True)


def crossing(laid: DataFrame, key: str) -> DataFrame:
    """The values of ``key`` with rows in several chunks of ``laid`` (ranges of ``key`` and order).

    Such a key is the first or the last of each of its chunks, so there are
    fewer of them than chunks: small enough to broadcast whatever the history.
    """
    ends = laid.groupBy("chunk").agg(F.array(F.min(key), F.max(key)).alias("ends"))
    return (ends.select(F.explode(F.array_distinct("ends")).alias(key)).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
                .where("n > 1").select(key))


def dealt(df: DataFrame, keys: Sequence[str], bucket: str = "chunk") -> DataFrame:
    """``df`` partitioned by (keys, chunk) for the local windows.

    A partitioning by ``keys`` alone (a bucketed table, an earlier join) also
    satisfies them, and would keep a hot key's whole history in one task.  The
    summaries do without: they are aggregated before their shuffle.
    """
    return df.repartition(*keys, bucket)


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def carry(df: DataFrame, keys: Sequence[str], order: Sequence, specs: dict[str, tuple[str, Column]],
          bucket: str = "chunk", inclusive: bool = False) -> DataFrame:
    """Several carries of one order in one pass: ``{out: (kind, value)}``.

    ``last``: the last non-NULL value of the rows before each row (per
    ``keys``); ``next``: the first non-NULL value of the rows after it;
    ``max``: the greatest value of the rows before it.  ``order`` must be
    ascending sort keys (numbers, for ``next``); ``bucket`` a column that never
    decreases along ``order`` within a key.  ``inclusive`` also counts the row
    itself.
    """
    order_c = _cols(order)
    end = Window.currentRow if inclusive else -1
    tmp = {out: f"__{out}_v" for out in specs}
    df = df.withColumns({tmp[out]: value for out, (_, value) in specs.items()})
    forward = Window.partitionBy(*keys, bucket).orderBy(*order_c).rowsBetween(Window.unboundedPreceding, end)
    backward = Window.partitionBy(*keys, bucket).orderBy(*[-c for c in order_c]).rowsBetween(Window.unboundedPreceding, end)

    def found(kind: str, v: str, ahead, behind) -> Column:
        if kind == "max":
            return F.max(v).over(ahead)
        return F.last(v, ignorenulls=True).over(behind if kind == "next" else ahead)

    base = dealt(df, keys, bucket).withColumns(
        {f"__{out}_local": found(kind, tmp[out], forward, backward) for out, (kind, _) in specs.items()})
    # one row per (key, chunk): what it hands on (NULL when it has no value)
    at = F.struct(*order_c)
    hand = {"last": lambda v: F.max_by(v, F.when(F.col(v).isNotNull(), at)),
            "next": lambda v: F.min_by(v, F.when(F.col(v).isNotNull(), at)), "max": F.max}
    summary = df.groupBy(*keys, bucket).agg(*(hand[kind](tmp[out]).alias(tmp[out]) for out, (kind, _) in specs.items()))
    ahead = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy(*keys).orderBy(F.col(bucket).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = [f"__{out}_carry" for out in specs]
    handed = (summary.select(*keys, bucket, *(found(kind, tmp[out], ahead, behind).alias(name)
                                              for name, (out, (kind, _)) in zip(carried, specs.items())))
                     .dropna("all", subset=carried))
    join = {"max": F.greatest, "last": F.coalesce, "next": F.coalesce}
    return (base.join(handed, [*keys, bucket], "left")
                .withColumns({out: join[kind](F.col(f"__{out}_local"), F.col(f"__{out}_carry"))
                              for out, (kind, _) in specs.items()})
                .drop(*(f"__{out}_{x}" for out in specs for x in ("v", "local", "carry"))))


def carry_last(df: DataFrame, keys: Sequence[str], order: Sequence, value: Column, out: str,
               bucket: str = "chunk", inclusive: bool = False) -> DataFrame:
    """``out`` = last non-NULL ``value`` of the rows before each row (see :func:`carry`)."""
    return carry(df, keys, order, {out: ("last", value)}, bucket, inclusive)


def carry_max(df: DataFrame, keys: Sequence[str], order: Sequence, value: Column, out: str,
              bucket: str = "chunk") -> DataFrame:
    """``out`` = max of ``value`` over the rows before each row."""
    return carry(df, keys, order, {out: ("max", value)}, bucket)


def carry_next(df: DataFrame, keys: Sequence[str], order: Sequence, value: Column, out: str,
               bucket: str = "chunk", inclusive: bool = False) -> DataFrame:
    """``out`` = first non-NULL ``value`` of the rows after each row (see :func:`carry`)."""
    return carry(df, keys, order, {out: ("next", value)}, bucket, inclusive)


def position(df: DataFrame, keys: Sequence[str], order: Sequence, out: str,
             bucket: str = "chunk") -> DataFrame:
    """``out`` = 1-based position of each row within its key, by ``order``."""
    order_c = _cols(order)
    tmp_local, tmp_off, tmp_n = f"__{out}_local", f"__{out}_off", f"__{out}_n"
    base = dealt(df, keys, bucket).withColumn(
        tmp_local, F.row_number().over(Window.partitionBy(*keys, bucket).orderBy(*order_c)))
    sizes = df.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias(tmp_n))
    wc = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (sizes.select(*keys, bucket, F.sum(tmp_n).over(wc).alias(tmp_off)).where(F.col(tmp_off).isNotNull()))
    return (base.join(offsets, [*keys, bucket], "left")
                .withColumn(out, (F.col(tmp_local) + F.coalesce(tmp_off, F.lit(0))).cast("long"))
                .drop(tmp_local, tmp_off))
