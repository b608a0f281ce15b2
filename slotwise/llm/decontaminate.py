"""Benchmark decontamination: pigeonhole edit matching.

A test item with error budget k is cut into k + 1 pieces: any passage within
k edits holds at least one piece unchanged.  A hash filter over every place
of a whole text finds exact piece hits; Myers' bit-parallel distance verifies
the passages they point to.  The benchmark is taken in blocks of bounded size, each
against every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from slotwise.llm.common import PIECE, table
from slotwise.llm.grams import codes

ERRORS = 0.08           # edits per character of an item's normal form
MIN_CHARS = 25          # shorter items are searched word for word, without edits
BLOCK_CHARS = 2_000_000   # benchmark text in one broadcast block, about

FILTER_BITS = 20
FACTOR = np.uint32(0x9E3779B1)

# letters of scripts without blanks between words
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
BREAK = re.compile(r"[\W_]+")
WORDS = re.compile(r"[^\W_]+")


def normal(text: str | None) -> str:
    """Lower case; everything between words is one blank."""
    return BREAK.sub(" ", text.lower()).strip() if text else ""


def places(text: str) -> list[int]:
    """For each character of ``normal(text)``, its place in ``text``; one more entry for the end."""
    out: list[int] = []
    last = 0
    low = text.lower()
    if len(low) != len(text):       # a few letters change length in lower case
        at, src = [], []
        for i, c in enumerate(text):
            for x in c.lower():
                at.append(x)
                src.append(i)
        low = "".join(at)
    else:
        src = range(len(text))
    for m in WORDS.finditer(low):
        if out:
            out.append(src[last - 1] + 1)
        out.extend(src[i] for i in range(m.start(), m.end()))
        last = m.end()
    out.append(src[last - 1] + 1 if last else 0)
    return out


def cut_pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` consecutive pieces of nearly equal length: (offset, piece)."""
    n = errors + 1
    edges = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:])]


def as_passage(item: str) -> str | None:
    """A short normal form with the blanks that bound it; None for a single word, which is no passage.

    A script without blanks has no bounds, and four of its letters are taken
    for more than a word.
    """
    if " " not in item and len(UNSPACED.findall(item)) < 4:
        return None
    return (" " * (not UNSPACED.match(item[0]))) + item + (" " * (not UNSPACED.match(item[-1])))


def masks_of(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def myers(masks: dict[str, int], m: int, text: str, errors: int) -> tuple[int, int] | None:
    """Least edit distance of a pattern to any substring of ``text`` and where the first best one ends; None above ``errors``."""
    full, top = (1 << m) - 1, 1 << m - 1
    pv, mv, score = full, 0, m
    best = None
    get = masks.get
    left = len(text)
    for j, c in enumerate(text):
        # the score falls by at most one a character
        if score - left > errors and best is None:
            break
        left -= 1
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        if score <= errors and (best is None or score < best[0]):
            best = (score, j + 1)
            if not score:
                break
    return best


class Pieces:
    """Exact hits of pieces in texts: a filter over the hashes of their first ``width`` characters, then the pieces themselves."""

    def __init__(self, where: dict[str, list]):
        self.width = min(map(len, where), default=0)
        self.starts: dict[str, list] = {}
        for piece, uses in where.items():
            self.starts.setdefault(piece[:self.width], []).append((piece, uses))
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        for start in self.starts:
            self.filter[self.hashes(start)] = True

    def hashes(self, text: str) -> np.ndarray:
        points = codes(text)
        n = len(points) - self.width + 1
        with np.errstate(over="ignore"):
            h = points[:n] * FACTOR
            for j in range(1, self.width):
                h += points[j:n + j]
                h *= FACTOR
        return h >> np.uint32(32 - FILTER_BITS)

    def hits(self, text: str) -> Iterator[tuple]:
        """(use, place) for every use of a piece found in a normal form, in order of place."""
        if not self.width:
            return
        for base in range(0, len(text) - self.width + 1, PIECE):
            part = text if len(text) <= PIECE else text[base:base + PIECE + self.width - 1]
            for at in np.flatnonzero(self.filter[self.hashes(part)]).tolist():
                for piece, uses in self.starts.get(part[at:at + self.width], ()):
                    if text.startswith(piece, base + at):
                        for use in uses:
                            yield use, base + at


class Matcher:
    """One block of benchmark items: (item id, text) pairs."""

    def __init__(self, items: list[tuple[int, str | None]], errors: float, min_chars: int):
        self.items, self.whole = [], {}
        where: dict[str, list[tuple[int, int]]] = {}
        short: dict[str, list[tuple[int, str]]] = {}
        for item_id, text in items:
            t = normal(text)
            if not t:
                continue
            if len(t) < min_chars:
                self.whole.setdefault(t, []).append(item_id)
                passage = as_passage(t)
                if passage:
                    short.setdefault(passage, []).append((item_id, t))
                continue
            k = int(errors * len(t))
            for at, piece in cut_pieces(t, k):
                where.setdefault(piece, []).append((len(self.items), at))
            self.items.append((item_id, t, k, masks_of(t)))
        # short items have a filter of their own: their width would let too much through the other
        self.pieces, self.short = Pieces(where), Pieces({p: [(p, uses)] for p, uses in short.items()})

    def hits(self, text: str) -> Iterator[tuple[int, int]]:
        """(item number, place where the item would begin) for every piece found in a normal form."""
        for (n, offset), at in self.pieces.hits(text):
            yield n, at - offset

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item id, distance, start, end) of the best passage for each item found; places in ``text``."""
        t = normal(text)
        if not t:
            return []
        out = [(i, 0, 0, len(text)) for i in self.whole.get(t, ())]
        where = None
        # short items: the first place of each, bounded by blanks
        first: dict[str, tuple[int, list]] = {}
        for (passage, uses), at in self.short.hits(f" {t} "):
            first.setdefault(passage, (at, uses))
        for passage, (at, uses) in first.items():
            start = at - 1 + passage.startswith(" ")
            for item_id, item in uses:
                if item != t:       # else it is the whole text
                    where = where or places(text)
                    out.append((item_id, 0, where[start], where[start + len(item) - 1] + 1))
        diagonals: dict[int, set[int]] = {}
        for n, start in self.hits(t):
            diagonals.setdefault(n, set()).add(start)
        for n, starts in diagonals.items():
            item_id, item, k, masks = self.items[n]
            best = None
            lo = hi = None
            windows = []
            for d in sorted(starts):
                a, b = max(0, d - k), min(len(t), d + len(item) + k)
                if hi is not None and a <= hi:
                    hi = max(hi, b)
                else:
                    if hi is not None:
                        windows.append((lo, hi))
                    lo, hi = a, b
            windows.append((lo, hi))
            for a, b in windows:
                got = myers(masks, len(item), t[a:b], k)
                if got and (best is None or got[0] < best[0]):
                    best = (got[0], a + got[1])
            if best:
                distance, end = best
                # backwards from the end: the nearest start with that distance
                back = t[max(0, end - len(item) - k):end][::-1]
                start = end - (_start(item, back, distance) if distance else len(item))
                where = where or places(text)
                out.append((item_id, distance, where[start], where[end - 1] + 1 if end > start else where[start]))
        return out


def _start(item: str, back: str, distance: int) -> int:
    """Length of the shortest prefix of ``back`` at the given distance from the reversed item."""
    turned = item[::-1]
    m = len(turned)
    col = list(range(m + 1))
    for j, c in enumerate(back):
        prev, col[0] = col[0], j + 1
        for i in range(1, m + 1):
            cur = col[i]
            col[i] = min(prev + (turned[i - 1] != c), cur + 1, col[i - 1] + 1)
            prev = cur
        if col[m] <= distance:
            return j + 1
    return len(back)


def blocks_of(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple]]:
    """The benchmark's (item_id, text) rows in hashed blocks of about ``block_chars`` characters, one at a time."""
    items = benchmark.select("item_id", "text").filter(F.length("text") > 0)
    total = items.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    for block in range(blocks):
        rows = items.filter(F.col("block") == block).collect()
        yield sorted(((r["item_id"], r["text"]) for r in rows), key=str)


def matches(docs: DataFrame, benchmark: DataFrame, errors: float = ERRORS, min_chars: int = MIN_CHARS,
            block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document row and benchmark item found in it: doc_id, item_id, distance, start, end.

    An item matches a passage whose normal form (lower case, one blank between
    words) is within ``floor(errors * length)`` edits; the best passage is
    reported with its place in the whole text (code points; of equal ones the
    first).  Items under ``min_chars`` match without edits, between words; a
    single short word matches only a document whose whole normal form equals it
    (see :func:`as_passage`).  Null, empty or wordless texts and items match nothing;
    repeated rows are reported each; a null item_id or doc_id stays null.
    Other columns are ignored.
    """
    sc = docs.sparkSession.sparkContext
    schema = (StructType([docs.schema["doc_id"], benchmark.schema["item_id"]])
              .add("distance", IntegerType()).add("start", LongType()).add("end", LongType()))

    def one(items: list[tuple]) -> DataFrame:
        shared = sc.broadcast(items)

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, errors, min_chars)
            for b in batches:
                ids = b.column("doc_id")
                found = [(i, *m) for i, t in enumerate(b.column("text").to_pylist()) for m in matcher.find(t)]
                rows, item, distance, start, end = zip(*found) if found else ((),) * 5
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows, pa.int64())), pa.array(item, pa.int64()),
                     pa.array(distance, pa.int32()), pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                    names=["doc_id", "item_id", "distance", "start", "end"])

        return docs.select("doc_id", "text").mapInArrow(task, schema)

    return reduce(DataFrame.unionByName, map(one, blocks_of(benchmark, block_chars)))


def clean(docs: DataFrame, benchmark: DataFrame, errors: float = ERRORS, min_chars: int = MIN_CHARS,
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found (see :func:`matches`), with all their columns."""
    sc = docs.sparkSession.sparkContext

    def without(rest: DataFrame, items: list[tuple]) -> DataFrame:
        shared = sc.broadcast(items)

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, errors, min_chars)
            for b in batches:
                yield b.filter(pa.array([not matcher.find(t) for t in b.column("text").to_pylist()], pa.bool_()))

        return rest.mapInArrow(task, rest.schema)

    return reduce(without, blocks_of(benchmark, block_chars), docs)


def op4_benchmark_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, with edit distance and place."""
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
