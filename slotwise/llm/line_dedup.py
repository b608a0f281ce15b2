"""Line dedup: lines that many documents share stay only in one of them.

Native: DataFrame functions only.  Line hashes are range-partitioned with a
secondary sort by document and position, first occurrences per (hash,
document) are streamed off that order, and each document that loses lines gets
a compressed keep bitmap (runs of kept lines); the text itself stays behind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm.common import cut, table

# space, tab, line feed, vertical tab, form feed, carriage return
BLANKS = " \t\n\x0b\f\r"
SALTS = 16      # the rows of a hot line are dealt to so many tasks
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lines_of(text: Column) -> Column:
    """A null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Keep bitmaps of the documents that lose lines.

    A line's key is the line without blanks at both ends, A-Z lower-cased.
    Keys of at least ``min_chars`` code points in at least ``min_docs``
    documents keep only the lines of the largest ``doc_id``.  Returns
    ``doc_id, text_hash, n_lines, n_dropped, keep``; ``keep`` is a run
    container: the runs ``(start, len)`` of kept lines in order.  Documents
    that lose nothing have no row.

    A document is a ``doc_id``: repeated rows count once, rows of one id with
    different texts are told apart by ``text_hash``; a null id is one document
    below all others.  Other columns are ignored.
    """
    stripped = F.btrim(F.col("line"), F.lit(BLANKS))
    found = (docs.select("doc_id", F.xxhash64("text").alias("text_hash"), lines_of(F.col("text")).alias("lines"))
                 .select("doc_id", "text_hash", F.size("lines").alias("n_lines"),
                         F.posexplode("lines").alias("pos", "line"))
                 .withColumn("line", stripped)
                 .filter(F.char_length("line") >= min_chars)
                 .withColumn("line", F.translate("line", UPPER, UPPER.lower()))
                 # two seeds: 128 bits
                 .select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"),
                         "doc_id", "text_hash", "n_lines", "pos"))
    # split and hashed once, read by both branches below
    found = cut(found)
    # a hot hash spreads over several ranges, since the document is part of the range key
    ordered = (found.repartitionByRange("h1", "h2", "doc_id")
                    .sortWithinPartitions("h1", "h2", "doc_id", "pos"))
    first = ordered.groupBy("h1", "h2", "doc_id").agg(F.min("pos").alias("pos"))
    shared = (first.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("holder"))
                   .filter(F.col("n_docs") >= min_docs).drop("n_docs")
                   .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    lost = (found.withColumn("salt", F.pmod(F.hash("doc_id"), F.lit(SALTS)))
                 .join(shared, ["h1", "h2", "salt"])
                 .filter(~F.col("doc_id").eqNullSafe(F.col("holder")))
                 .groupBy("doc_id", "text_hash")
                 .agg(F.first("n_lines").alias("n_lines"), F.sort_array(F.collect_set("pos")).alias("lost")))
    # kept runs lie between neighbouring lost positions
    edges = F.concat(F.array(F.lit(-1)), F.col("lost"), F.array(F.col("n_lines")))
    runs = F.filter(
        F.transform(F.arrays_zip(F.slice(edges, 1, F.size("lost") + 1).alias("a"),
                                 F.slice(edges, 2, F.size("lost") + 1).alias("b")),
                    lambda e: F.struct((e["a"] + 1).alias("start"), (e["b"] - e["a"] - 1).alias("len"))),
        lambda r: r["len"] > 0)
    return lost.select("doc_id", "text_hash", F.col("n_lines").cast("long").alias("n_lines"),
                       F.size("lost").cast("long").alias("n_dropped"), runs.alias("keep"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with ``line_count``, ``lines_dropped`` and ``kept_text`` (kept lines joined by line feeds)."""
    m = bitmaps.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"),
                       F.col("n_dropped").alias("__dropped"), F.col("keep").alias("__keep"))
    lines = lines_of(F.col("text"))
    kept = F.array_join(F.flatten(F.transform(
        F.col("__keep"), lambda r: F.slice(lines, r["start"] + 1, r["len"]))), "\n")
    return (docs.join(m, docs["doc_id"].eqNullSafe(m["__id"])
                      & F.xxhash64(docs["text"]).eqNullSafe(m["__hash"]), "left")
                .withColumn("line_count", F.size(lines).cast("long"))
                .withColumn("lines_dropped", F.coalesce("__dropped", F.lit(0).cast("long")))
                .withColumn("kept_text", F.when(F.col("__keep").isNull(), F.coalesce("text", F.lit("")))
                            .otherwise(kept))
                .drop("__id", "__hash", "__dropped", "__keep"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts and the digest of what stays, per document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = apply_bitmaps(docs, keep_bitmaps(docs))
    return done.select("doc_id", F.col("line_count").alias("n_lines"), F.col("lines_dropped").alias("n_dropped"),
                       F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


SQL = """
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), shared AS (
  SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), m AS (
  SELECT k.doc_id, k.line, k.pos, s.holder IS NOT NULL AND s.holder <> k.doc_id AS lost
  FROM k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
