"""Best-fit packing with conflicts.

Documents are packed into bins of fixed capacity, longest first.  Open bins are
ordered by residual room; each carries a bitmap of its sources and one of its
duplicate clusters.  The search starts at the tightest bin with enough room and
goes on to its successors until one has no conflict.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm.common import cut, table

CAPACITY = 2048         # words
SHARD = 4096            # items packed together


def pack_items(items: list[tuple], capacity: int) -> tuple[list[int], int]:
    """Bin number of each item and the number of bins.

    ``items``: (length, source, cluster) with 0 <= length <= capacity, in the
    order of packing.  Two items of one source or one cluster never share a
    bin; a null source or cluster conflicts with nothing.
    """
    many = Counter(c for _, _, c in items if c is not None)
    bit: dict[tuple, int] = {}
    order: list[tuple[int, int]] = []       # (residual, bin), ascending
    sources: list[int] = []
    clusters: list[int] = []
    out: list[int] = []
    for length, source, cluster in items:
        s = 0 if source is None else 1 << bit.setdefault(("s", source), len(bit))
        # a cluster of one item here conflicts with nothing
        c = 0 if many[cluster] < 2 else 1 << bit.setdefault(("c", cluster), len(bit))
        for at in range(bisect_left(order, (length, -1)), len(order)):
            residual, b = order[at]
            if not (sources[b] & s or clusters[b] & c):
                del order[at]
                break
        else:
            residual, b = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        sources[b] |= s
        clusters[b] |= c
        insort(order, (residual - length, b))
        out.append(b)
    return out, len(sources)


def pack(docs: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """One row per segment: bin_id, position, doc_id, segment, start, length.

    ``docs``: doc_id, length (in tokens; null or negative as 0), source,
    cluster.  A document longer than ``capacity`` is cut into full segments,
    which fill a bin each, and a remainder; a remainder of 0 makes no segment
    unless the document is empty.  Each segment is one row in exactly one bin;
    no bin holds more than ``capacity``, or two segments of one source or one
    cluster.  Rows are dealt by hash to shards of about ``shard`` documents,
    which are packed apart, longest first (ties by doc_id, then source and
    cluster; equal rows are packed each).  Other columns are ignored.
    """
    rows = docs.select("doc_id", F.greatest(F.lit(0), F.coalesce(F.col("length").cast("long"), F.lit(0))).alias("length"),
                       F.col("source").cast("string").alias("source"), F.col("cluster").cast("long").alias("cluster"))
    rows = cut(rows)        # lengths are counted once
    shards = max(1, -(-rows.count() // shard))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "source", "cluster", "length"), F.lit(shards)))

    def task(group: pa.Table) -> pa.Table:
        here = group.column("shard")[0].as_py() if group.num_rows else 0
        whole, items = [], []
        for doc_id, length, source, cluster in zip(*(group.column(c).to_pylist()
                                                     for c in ("doc_id", "length", "source", "cluster"))):
            full, rest = divmod(length, capacity)
            whole.extend((doc_id, k, k * capacity, capacity) for k in range(full))
            if rest or not full:
                items.append((rest, doc_id, source, cluster, full))
        key = lambda x: (-x[0], x[1] is not None, x[1] or 0, x[2] or "", x[3] or 0, x[4])
        items.sort(key=key)
        bins, used = pack_items([(x[0], x[2], x[3]) for x in items], capacity)
        held = [0] * used
        base = here << 32
        cols: list[list] = [[] for _ in range(6)]

        def put(*row) -> None:
            for c, v in zip(cols, row):
                c.append(v)

        for (rest, doc_id, _s, _c, full), b in zip(items, bins):
            put(base + b, held[b], doc_id, full, full * capacity, rest)
            held[b] += 1
        for n, (doc_id, k, start, length) in enumerate(sorted(whole, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))):
            put(base + used + n, 0, doc_id, k, start, length)
        return pa.table([pa.array(c, pa.int32() if i in (1, 3) else pa.int64()) for i, c in enumerate(cols)],
                        names=["bin_id", "position", "doc_id", "segment", "start", "length"])

    return rows.groupBy("shard").applyInArrow(
        task, "bin_id long, position int, doc_id long, segment int, start long, length long")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, length (words), source, and a cluster that holds the rows with equal texts."""
    return docs.select("doc_id", F.regexp_count("text", F.lit(r"\S+")).alias("length"), "source",
                       F.xxhash64("text").alias("cluster"))


def op6_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins of 2,048 words over all documents."""
    return pack(measured(table(spark, sf_dir, "documents")))
