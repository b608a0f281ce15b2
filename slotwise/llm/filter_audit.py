"""Filter interaction audit: counters kept by a stream that takes back what it said too early.

The files of a table are read as available-now micro-batches.  A document's own
filters give a mask of bits at once; whether its text is a copy of a smaller
id's depends on documents that may come later.  State keyed by text (SHA-256;
the texts of a hash bucket share one value of the state store) holds the least
id so far: a larger id counts as a copy, and when a smaller id arrives, the
mask that the former least id was counted with is retracted and counted again
as a copy's.  Counters per part and mask are all that leaves the stream;
every order and step of the report follows from them.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from slotwise.llm.common import PIECE, table
from slotwise.session import scratch

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 50, 65, 5
SPECIAL = b"#$%&*|"
COPY = 1 << FILTERS.index("E")
BATCHES = 4             # micro-batches of a run, about
HELD = 1 << 18          # texts a task looks after before it hands them on
TEXTS = 4096            # of one state, about
BLANKS = b" \t\n\x0b\f\r"
UPPER = bytes(range(65, 91))
COUNTS = "part string, mask int, good int, toxic int, n long"
CELL = ["part", "mask", "good", "toxic"]


def own_mask(text: bytes) -> int:
    """Bits of the filters A to D that a UTF-8 text fails, in pieces of bounded size."""
    words, distinct, rest, at = 0, set(), b"", 0
    while at < len(text):
        part = rest + text[at:at + PIECE]
        at += PIECE
        found = part.split()        # of bytes: at space, tab, line feed, vertical tab, form feed, carriage return
        rest = b""
        if at < len(text) and found and part[-1] not in BLANKS:
            rest = found.pop()
        words += len(found)
        distinct.update(found)
    if rest:
        words += 1
        distinct.add(rest)
    raw = np.frombuffer(text, np.uint8)
    points = len(raw) - int(((raw & 0xC0) == 0x80).sum())
    upper = len(text) - len(text.translate(None, UPPER))
    fails = (words < MIN_WORDS, 100 * len(distinct) < DISTINCT_PERCENT * words, 100 * upper > UPPER_PERCENT * points,
             len(text.translate(None, SPECIAL)) < len(text))
    return sum(1 << k for k, x in enumerate(fails) if x)


def masked(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest (SHA-256 of the text) and mask (bits of A to D) of every row; the texts stay behind."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests, masks = [], []
            for t in b.column("text"):
                text = t.as_py()
                digests.append(hashlib.sha256(text).digest())
                masks.append(own_mask(text))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("part"), pa.array(digests, pa.binary()), pa.array(masks, pa.int32())],
                names=["doc_id", "part", "digest", "mask"])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("source", F.lit("")).alias("part"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("text")).mapInArrow(
        task, "doc_id long, part string, digest binary, mask int")


def settled(rows: DataFrame) -> DataFrame:
    """What a task can say of its own rows, before any shuffle.

    Of the rows of one text only those of the task's least id can still turn
    out to be no copies; one row (digest, least, cell, n) stands for them.  All
    others are copies and go into the task's counters, as do rows without an
    id: these travel as ``settled`` under keys of their own.  So a text that
    fills a third of the table is one row a task.
    """
    schema = "digest binary, settled boolean, least long, part string, mask int, good int, toxic int, n long"
    names = ["digest", "settled", "least", *CELL, "n"]
    types = (pa.binary(), pa.bool_(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[bytes, int] = {}
        open_: dict[bytes, Counter] = {}
        done: Counter = Counter()

        def hand_over() -> Iterator[pa.RecordBatch]:
            out = [(d, False, least[d], *cell, n) for d, c in open_.items() for cell, n in c.items()]
            out += [(hashlib.sha256(repr(cell).encode()).digest(), True, 0, *cell, n) for cell, n in done.items()]
            for x in (least, open_, done):
                x.clear()
            for i in range(0, len(out), 1 << 16):
                cols = zip(*out[i:i + (1 << 16)])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        for b in batches:
            cols = (b.column(c).to_pylist() for c in ("digest", "doc_id", *CELL))
            for digest, doc_id, *cell in zip(*cols):
                part, mask, good, toxic = cell
                now = least.get(digest)
                if doc_id is None:
                    done[tuple(cell)] += 1
                elif now is None or doc_id < now:
                    for (p, m, g, x), n in open_.pop(digest, {}).items():
                        done[p, m | COPY, g, x] += n
                    least[digest] = doc_id
                    open_[digest] = Counter([tuple(cell)])
                elif doc_id == now:
                    open_[digest][tuple(cell)] += 1
                else:
                    done[part, mask | COPY, good, toxic] += 1
            if len(least) > HELD:
                yield from hand_over()
        yield from hand_over()

    return rows.mapInArrow(task, schema)


def follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Counter changes by the new rows of the texts of one bucket.

    The state has, for each text, its least id and the cells that the rows of
    that id were counted in.
    """
    change: Counter = Counter()
    kept = _read(*state.get) if state.exists else {}
    moved = False
    for b in batches:
        for digest, settled_, new, *cell, n in zip(*(b[c].tolist() for c in ("digest", "settled", "least", *CELL, "n"))):
            cell = tuple(cell)
            part, mask, good, toxic = cell
            least, cells = kept.get(digest, (None, None))
            if settled_:
                change[cell] += n
            elif least is not None and new > least:
                change[part, mask | COPY, good, toxic] += n
            else:
                if least is None or new < least:
                    for (p, m, g, x), was in (cells or {}).items():
                        change[p, m, g, x] -= was       # the retraction
                        change[p, m | COPY, g, x] += was
                    cells = Counter()
                    kept[digest] = new, cells
                change[cell] += n
                cells[cell] += n
                moved = True
    if moved:
        state.update((_write(kept),))
    yield pd.DataFrame([(*cell, n) for cell, n in change.items() if n], columns=[*CELL, "n"])


def _write(kept: dict[bytes, tuple[int, Counter]]) -> bytes:
    """The texts of a bucket as one value (an Arrow stream)."""
    rows = [(digest, least, *cell, n) for digest, (least, cells) in kept.items() for cell, n in cells.items()]
    types = (pa.binary(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["digest", "least", *CELL, "n"])
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as stream:
        stream.write_batch(batch)
    return out.getvalue().to_pybytes()


def _read(texts: bytes) -> dict[bytes, tuple[int, Counter]]:
    kept: dict[bytes, tuple[int, Counter]] = {}
    for digest, least, *cell, n in zip(*(c.to_pylist() for c in pa.ipc.open_stream(texts).read_all().columns)):
        kept.setdefault(digest, (least, Counter()))[1][tuple(cell)] += n
    return kept


def mask_counts(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    """part, mask, good, toxic, n: how many rows of the table at ``path`` (Parquet) fail which filters.

    ``labels``: doc_id, quality, toxic.  The table's files come in about
    ``batches`` micro-batches, in any order.  The state (some 100 bytes a text)
    is kept by the session's state store provider: Spark's default holds it in
    the executors' heaps, the RocksDB provider (``session.cluster_conf`` names
    it) on their disks.
    """
    marks = (labels.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
                   .agg(F.max(F.col("quality") == 1).cast("int").alias("good"),
                        F.max(F.col("toxic") == 1).cast("int").alias("toxic")))
    whole = spark.read.parquet(path)
    files = -(-max(1, len(whole.inputFiles())) // batches)
    # a file stream takes a table that is a single file only by a pattern
    pattern = re.sub(r"(.)/*$", r"[\1]", path)
    stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", files).parquet(pattern)
    rows = (masked(stream).join(marks, "doc_id", "left").fillna(0, ["good", "toxic"]))
    # a state of its own for each text costs a call each; its size grows with the texts of a bucket, their number with the rows
    bucket = F.pmod(F.xxhash64("digest"), F.lit(max(1, whole.count() // TEXTS)))
    changes = settled(rows).withColumn("bucket", bucket).groupBy("bucket").applyInPandasWithState(
        follow, COUNTS, "texts binary", "append", GroupStateTimeout.NoTimeout)
    base = scratch(spark, "audit")
    query = (changes.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
                    .option("checkpointLocation", f"{base}/checkpoint").start(f"{base}/changes"))
    query.awaitTermination()
    return (spark.read.schema(COUNTS).parquet(f"{base}/changes").groupBy(*CELL).agg(F.sum("n").alias("n")).filter("n <> 0"))


def report(counts: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, from the counters per mask."""
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("cells"))   # <= 128 cells
    orders = " ".join(map("".join, permutations(FILTERS)))
    rows = (parts.withColumn("filter_order", F.explode(F.split(F.lit(orders), " ")))
                 .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))))

    def bits(letters):
        return sum((F.when(F.instr(letters, f) > 0, 1 << k).otherwise(0) for k, f in enumerate(FILTERS)), F.lit(0))

    rows = rows.withColumns({"own": bits(F.substr("filter_order", "step", F.lit(1))),
                             "before": bits(F.substr("filter_order", F.lit(1), F.col("step") - 1))})

    def number(holds, share=lambda c: c["n"]):
        return F.aggregate("cells", F.lit(0).cast("long"), lambda total, c: total + F.when(holds(c), share(c)).otherwise(0))

    def fails(c):
        return c["mask"].bitwiseAND(F.col("own")) != 0

    def free(c, of):
        return c["mask"].bitwiseAND(F.col(of)) == 0

    def removed(c):
        return fails(c) & free(c, "before")

    orders_of_all = len(list(permutations(FILTERS)))
    return rows.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        number(lambda c: free(c, "own") & free(c, "before")).alias("kept"),
        number(removed).alias("removed"),
        number(lambda c: fails(c) & ~free(c, "before")).alias("redundant"),
        number(lambda c: c["mask"] == F.col("own")).alias("unique_fails"),
        number(lambda c: removed(c) & (c["good"] == 1)).alias("good_lost"),
        number(lambda c: removed(c) & (c["toxic"] == 1)).alias("toxic_lost"),
        # of the filters that a row fails each is the first in equally many orders
        number(fails, lambda c: F.floor(F.lit(orders_of_all) * c["n"] / F.bit_count(c["mask"]))).alias("shapley"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interaction of five filters over all documents.

    Rows without an id neither are copies nor make any; rows of one id with
    equal texts are no copies of each other.  Null texts are empty, null
    sources the part ''; an id with several labels counts as good (toxic) if
    one says so; other columns are ignored; an empty table gives no rows.
    """
    return report(mask_counts(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels")))


SQL = """
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM d
), m AS (
  SELECT part, doc_id, [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
         regexp_matches(text, '[#$%&*|]'), least < doc_id] AS fails
  FROM w
), l AS (
  SELECT part, fails, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad
  FROM m LEFT JOIN labels USING (doc_id)
), c AS (
  SELECT part, fails, good, bad, count(*) AS n FROM l GROUP BY ALL
), f AS (
  SELECT unnest([1, 2, 3, 4, 5]) AS k
), o AS (
  SELECT row_number() OVER () AS id, [a.k, b.k, c.k, d.k, e.k] AS ks FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5
), s AS (
  SELECT id, array_to_string(list_transform(ks, lambda x: substr('ABCDE', x, 1)), '') AS filter_order, f.k AS step,
         ks[f.k] AS own, ks[1:f.k - 1] AS before FROM o, f
), x AS (
  SELECT part, filter_order, step, own, n, good, bad, fails[own] AS hit, len(list_filter(before, lambda y: fails[y])) > 0 AS gone,
         len(list_filter(fails, lambda y: y)) = 1 AS one
  FROM c, s
), r AS (
  SELECT part, filter_order, step, any_value(own) AS own,
         coalesce(sum(n) FILTER (WHERE NOT hit AND NOT gone), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE hit AND NOT gone), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE hit AND gone), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE hit AND one), 0) AS unique_fails,
         coalesce(sum(n) FILTER (WHERE hit AND NOT gone AND good), 0) AS good_lost,
         coalesce(sum(n) FILTER (WHERE hit AND NOT gone AND bad), 0) AS toxic_lost
  FROM x GROUP BY part, filter_order, step
)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r
"""
