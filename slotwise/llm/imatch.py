"""Document fingerprints: I-Match over randomised lexicon subsets.

Terms within a band of inverse document frequency are kept.  The lexicon is
split at random into 2^l subsets for each level l; a text's distinct terms in
a subset are sorted and hashed together.  A text uses the three levels at which
a subset holds one of its terms or less, so that an edit changes few of them.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotwise.llm.common import mix, table
from slotwise.llm.near_dedup import word_hashes

BITS = 18                   # a lexicon may also be given as a bitmap over this many leading bits of a term's hash
HELD = 1 << 21              # terms that a counting task holds before it hands on their counts
BAND = (0.2, 0.9)           # idf of kept terms, as a share of the largest, log(documents)
SUBSETS = 32                # subsets hashed per level
LEVELS = 3
STEP = np.uint64(0x9E3779B97F4A7C15)


def terms(text: str | None) -> np.ndarray:
    """Hashes of the distinct terms (lower-cased words), sorted."""
    return np.unique(word_hashes(text.lower())) if text else np.empty(0, np.uint64)


def document_frequencies(docs: DataFrame) -> tuple[DataFrame, int]:
    """``term`` (64-bit hash) and ``n``, the documents that hold it, and the number of documents, over all rows.

    A task hands on counts of the terms it holds; Spark adds them up by term.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counts() -> pa.RecordBatch:
            term, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.empty(0, np.uint64), np.empty(0, np.int64))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n, pa.int64())], names=["term", "n"])

        for b in batches:
            for t in b.column("text").to_pylist():
                held.append(terms(t))
                size += len(held[-1])
                if size >= HELD:
                    yield counts()
                    size = 0
        yield counts()

    counted = docs.select("text").mapInArrow(task, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return counted, docs.count()


def kept_slots(df: DataFrame, documents: int) -> np.ndarray:
    """Sorted hashes of the terms within the idf band; the terms outside it stay on the executors."""
    idf = F.log(F.lit(float(max(1, documents))) / F.col("n")) / math.log(max(2, documents))
    rows = df.filter(idf.between(*BAND)).select("term").toArrow()
    return np.sort(rows["term"].to_numpy().view(np.uint64))


def in_band(h: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """Those of the term hashes that are in the lexicon: sorted hashes, or a bitmap of leading bits."""
    if kept.dtype == bool:
        return h[kept[(h >> np.uint64(64 - BITS)).astype(np.int64)]]
    if not len(kept):
        return kept
    return h[kept[np.minimum(np.searchsorted(kept, h), len(kept) - 1)] == h]


def fingerprint(text: str | None, kept: np.ndarray) -> str:
    """``level:`` and the subset hashes, a dot for each empty subset, for three levels.

    Equal texts have equal fingerprints.  A text without a kept term has the
    hash of all its terms, or of its characters if it has no term.
    """
    every = terms(text)
    h = in_band(every, kept)
    if not len(h):
        raw = every.tobytes() if len(every) else (text or "").encode("utf-8", "surrogatepass")
        return "0:" + hashlib.blake2b(raw, digest_size=8).hexdigest()
    low = max(1, math.ceil(math.log2(len(h))))
    out = []
    for level in range(low, low + LEVELS):
        with np.errstate(over="ignore"):
            x = mix(h + STEP * np.uint64(level))
            subset = (x >> np.uint64(64 - level)).astype(np.int64)
            mine = np.flatnonzero(subset < SUBSETS)
            # sorted by subset, then by term; a term's place within its subset is its power
            mine = mine[np.argsort(subset[mine], kind="stable")]
            s = subset[mine]
            first = np.flatnonzero(np.diff(s, prepend=-1))
            place = np.arange(len(s)) - np.repeat(first, np.diff(first, append=len(s)))
            folded = mix(x[mine] + STEP * (place.astype(np.uint64) + np.uint64(1)))
            sums = np.add.reduceat(folded, first) if len(first) else folded
            sums = (mix(sums) >> np.uint64(32)).astype(np.uint64)
        parts = ["."] * min(SUBSETS, 1 << level)
        for k, v in zip(s[first].tolist(), sums.tolist()):
            parts[k] = f"{v:08x}"
        out.append(f"{level}:" + ",".join(parts))
    return ";".join(out)


def likeness(a: str, b: str) -> float:
    """Share of equal subsets among those that either text uses, over the levels both have; 0 without such a level."""
    if a == b:
        return 1.0
    x = dict(p.split(":", 1) for p in a.split(";"))
    y = dict(p.split(":", 1) for p in b.split(";"))
    same = used = 0
    for level in x.keys() & y.keys():
        for u, v in zip(x[level].split(","), y[level].split(",")):
            if u != "." or v != ".":
                used += 1
                same += u == v
    return same / used if used else 0.0


def fingerprints(docs: DataFrame, kept: np.ndarray) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every row of ``docs`` (doc_id, text): one row per row, null as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(kept)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = [fingerprint(t, shared.value) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(prints, pa.string())],
                                             names=["doc_id", "fingerprint"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(task, f"doc_id {kind}, fingerprint string")


def place_among(x: Column, edges: Column, size: int) -> Column:
    """How many of the ascending ``edges`` (array of up to ``size``) are at or below ``x``, by halving; 0 for NULL."""
    steps = [1 << i for i in reversed(range(max(1, size.bit_length())))]
    return F.aggregate(
        F.array(*(F.lit(i) for i in steps)), F.lit(0),
        lambda at, step: F.when(F.get(edges, at + step - 1) <= x, at + step).otherwise(at))


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """``doc_id, text, next_text``: the text of the next row by (doc_id, text), after the last the first.

    Rows are cut into ranges of doc_id; each range's last row takes the first
    row of the next range from a table of one row per range.  Null texts count
    as empty, a null id comes first, equal ids follow the order of the text.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # several ranges a task, to even them out
    parts = parts or 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = [i / parts for i in range(1, parts)]
    edges = (rows.agg(F.percentile_approx("doc_id", share, 10_000).alias("e")).first()["e"] or []) if share else []
    edges = sorted(set(edges))
    at = place_among(F.col("doc_id"), F.array(*map(F.lit, edges)), len(edges)) if edges else F.lit(0)
    ranged = rows.withColumn("range", at)
    w = Window.partitionBy("range").orderBy(F.col("doc_id").asc_nulls_first(), "text")
    led = ranged.withColumn("next_text", F.lead("text").over(w))
    first = ranged.groupBy("range").agg(F.min(F.struct("doc_id", "text")).alias("first"))
    order = Window.orderBy("range")     # one row per range
    heads = first.select("range", F.coalesce(F.lead("first.text").over(order),
                                             F.first("first.text").over(order)).alias("head"))
    return (led.join(heads, "range").select("doc_id", "text", F.coalesce("next_text", "head").alias("next_text")))


def op1_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    df, documents = document_frequencies(docs)
    shared = spark.sparkContext.broadcast(kept_slots(df, documents))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = shared.value
        last, last_print = None, ""
        for b in batches:
            out = []
            for text, after in zip(b.column("text").to_pylist(), b.column("next_text").to_pylist()):
                k = len(text) // 4
                edited = text[:len(text) - k] + after[:k]
                own = last_print if text == last else fingerprint(text, kept)
                changed = own if edited == text else fingerprint(edited, kept)
                last, last_print = after, fingerprint(after, kept)
                out.append((len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own, changed,
                            likeness(own, changed), likeness(own, last_print)))
            columns = list(zip(*out)) if out else [()] * 6
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, kinds))],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return with_next(docs).mapInArrow(
        task, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
