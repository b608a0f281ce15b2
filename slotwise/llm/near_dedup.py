"""Near-duplicate detection: ProbMinHash, banding, verification.

Each text becomes a weighted set of five-word shingles.  ProbMinHash lets every
shingle arrive by a Poisson process whose rate is its weight; a register keeps
the shingle that arrives first, and a text's processes stop once no later
arrival can win any register.  Two texts agree on a register with the
probability Jaccard similarity of their weights.  A text that repeats shingles
has a second row of registers with all weights 1, which agree with the
similarity of the sets (without repeats both rows are the same).  Bands of
registers give candidates; candidates are verified on their whole shingle sets.

No pair list of a whole group is ever made: equal texts are collapsed first
and each bucket is linked to one centre; buckets that still hold several
components then compare their outliers in blocks, where only links that join
components are written down.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm.common import cut, mix, table
from slotwise.llm.grams import codes

PIECE = 1 << 17                 # characters (or words) handled by one numpy pass
WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5             # at set Jaccard 0.8 a pair shares a band with probability 0.99995
REGISTERS = BANDS * ROWS
BLOCK = 4096                    # members of a bucket compared at once
BLOCK_SHINGLES = 1 << 20        # and their shingles, about
SALTS = 4

R1, R2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
_tables: dict[str, np.ndarray] = {}


def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Powers of two odd bases and the inverse powers of the first, modulo 2^64; word characters below 65,536."""
    if not _tables:
        inverse = np.uint64(pow(int(R1), -1, 1 << 64))
        with np.errstate(over="ignore"):
            for name, base in (("p", R1), ("q", inverse), ("s", R2)):
                x = np.full(2 * PIECE, base, np.uint64)
                x[0] = 1
                _tables[name] = np.multiply.accumulate(x)
        _tables["w"] = np.array([chr(i).isalnum() or i == 95 for i in range(65536)])
    return _tables["p"], _tables["q"], _tables["s"], _tables["w"]


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words (runs of letters, digits and underscores) of a text, in order."""
    if len(text) > 2 * PIECE - 2:     # cut between words; a longer word is cut into pieces
        out, at = [], 0
        while at < len(text):
            end = min(len(text), at + PIECE)
            if end < len(text):
                gap = re.compile(r"\W").search(text, end, at + 2 * PIECE - 2)
                end = gap.start() + 1 if gap else at + 2 * PIECE - 2
            out.append(word_hashes(text[at:end]))
            at = end
        return np.concatenate(out)
    p, q, _, is_word = _powers()
    points = codes(text)
    inside = is_word[np.minimum(points, 65535)] | (points > 65535)
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    start, end = edge[::2], edge[1::2]
    with np.errstate(over="ignore"):
        total = np.zeros(len(points) + 1, np.uint64)
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * p[:len(points)], out=total[1:])
        return mix((total[end] - total[start]) * q[start] + (end - start).astype(np.uint64))


def shingles(texts: list[str | None] | pa.Array) -> Iterator[tuple[int, tuple[int, int], np.ndarray, np.ndarray]]:
    """(row, 128-bit key of the word sequence, sorted distinct shingle hashes, their counts) per text.

    Fewer than five words make one shingle; a text without a word has none
    and its key is taken from the raw characters.
    """
    p, _, s, _ = _powers()
    for i, t in enumerate(texts):       # one Python string at a time
        t = t.as_py() if isinstance(t, pa.Scalar) else t
        h = word_hashes(t.lower()) if t else np.empty(0, np.uint64)
        seed = h if len(h) else mix(codes(t).astype(np.uint64) + R2) if t else h
        with np.errstate(over="ignore"):
            n = np.uint64(len(seed))
            k1 = k2 = np.uint64(0)
            for at in range(0, len(seed), PIECE):   # a chain over pieces of very long texts
                part = seed[at:at + PIECE]
                k1 = k1 * R2 + (part * p[:len(part)]).sum(dtype=np.uint64)
                k2 = k2 * R1 + (mix(part + R1) * s[:len(part)]).sum(dtype=np.uint64)
            key = (int(mix(np.array([k1 + n + np.uint64(len(h) == 0)]))[0]), int(mix(np.array([k2 ^ n]))[0]))
            if len(h) >= WORDS:
                m = len(h) - WORDS + 1
                x = h[:m].copy()
                for j in range(1, WORDS):
                    x = x * R1 + h[j:m + j]
                x = np.sort(mix(x))
            else:
                x = np.array([key[0]], np.uint64) if len(h) else h
        new = np.flatnonzero(np.diff(x, prepend=~x[:1])) if len(x) else np.empty(0, np.int64)
        yield i, key, x[new], np.diff(new, append=len(x))


def signatures(sets: list[np.ndarray], counts: list[np.ndarray]) -> np.ndarray:
    """ProbMinHash registers (the winning shingle's hash) of many sets at once: (len(sets), REGISTERS)."""
    d = len(sets)
    first = np.full(d * REGISTERS, np.inf)
    winner = np.zeros(d * REGISTERS, np.uint64)
    owner = np.repeat(np.arange(d), [len(x) for x in sets])
    h = np.concatenate(sets) if d else np.empty(0, np.uint64)
    weight = 1 + np.log(np.concatenate(counts)) if d else np.empty(0)
    t = np.zeros(len(h))
    i = 0
    while len(h):
        with np.errstate(over="ignore"):
            x = mix(h + np.uint64(i + 1) * R2)
        t = t - np.log(((x >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53) / weight
        slot = owner * REGISTERS + (x & np.uint64(2047)).astype(np.int64) % REGISTERS
        wins = np.flatnonzero(t < first[slot])
        if len(wins):
            s = slot[wins]
            np.minimum.at(first, s, t[wins])
            kept = wins[t[wins] == first[s]]
            winner[slot[kept]] = h[kept]
        i += 1
        # stop a process once it is later than every register of its text
        if i < 4 or i % 4 == 0:
            live = np.unique(owner)
            last = np.zeros(d)
            last[live] = first.reshape(d, REGISTERS)[live].max(axis=1)
            on = np.flatnonzero(t < last[owner])
            if len(on) < len(h):
                h, weight, t, owner = h[on], weight[on], t[on], owner[on]
    return winner.reshape(d, REGISTERS)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, key (16 bytes), n (shingles), bands (25 hashes of five registers each).

    A text with repeated shingles has 25 more bands, of its registers with unit
    weights; those that equal the band before them are null.
    """
    def bands_of(sets: list[np.ndarray], counts: list[np.ndarray]) -> list[list[int]]:
        g = signatures(sets, counts).reshape(len(sets), BANDS, ROWS)
        with np.errstate(over="ignore"):
            x = g[:, :, 0].copy()
            for j in range(1, ROWS):
                x = x * R1 + g[:, :, j]
            return mix(x).view(np.int64).tolist()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, n, bands = [], [], []
            sets, counts, held = [], [], 0

            def flush() -> None:
                nonlocal held
                weighted = bands_of(sets, counts)
                repeats = [k for k, c in enumerate(counts) if len(c) and c.max() > 1]
                unit = dict(zip(repeats, bands_of([sets[k] for k in repeats], [np.ones_like(counts[k]) for k in repeats])))
                for k, one in enumerate(sets):
                    more = [None if u == w else u for u, w in zip(unit.get(k, ()), weighted[k])]
                    bands.append(weighted[k] + more if len(one) else [])
                sets.clear(), counts.clear()
                held = 0

            for _, key, x, c in shingles(b.column("text")):
                keys.append(key[0].to_bytes(8) + key[1].to_bytes(8))
                n.append(len(x))
                sets.append(x)
                counts.append(c)
                held += len(x)
                if held > 4 * PIECE or len(sets) >= 2000:
                    flush()
            flush()
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_hash"), pa.array(keys, pa.binary()), pa.array(n, pa.int32()),
                 pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "text_hash", "key", "n", "bands"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash long, key binary, n int, bands array<long>"
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(task, schema)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """key and the whole set of distinct shingles of each text, as 32-bit hashes.

    Two sets of a thousand shingles share a false one with a chance of 1 in
    4,000; a similarity then moves by a thousandth.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, sets = [], []
            for _, key, x, _c in shingles(b.column("text")):
                keys.append(key[0].to_bytes(8) + key[1].to_bytes(8))
                sets.append(np.unique((x >> np.uint64(32)).astype(np.uint32)).view(np.int32))
            flat = pa.array(np.concatenate(sets) if sets else np.empty(0, np.int32))
            ends = np.cumsum([0, *map(len, sets)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)],
                names=["key", "shingles"])

    return docs.select("text").mapInArrow(task, "key binary, shingles array<int>")


def each(n: Column) -> Column:
    """One row for each number from 0 to n - 1."""
    return F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1))


def merged(rows: DataFrame, other: DataFrame, on: list[str] | Column, how: str = "inner") -> DataFrame:
    """A join by sorting both sides.

    Dozens of small joins would else each leave a broadcast relation, of a
    memory page at least, in the driver; a sorted side that is skewed is split
    by Spark at run time, which a broadcast never needs and a hash join can't do.
    """
    return rows.join(other.hint("merge"), on, how)


def salted_join(rows: DataFrame, one: DataFrame, on: list[str], salt_by: str = "key", how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``one`` (a row per value of ``on``); the rows of a hot value go to ``SALTS`` tasks."""
    return merged(rows.withColumn("salt", F.pmod(F.xxhash64(salt_by), F.lit(SALTS))),
                  one.withColumn("salt", each(F.lit(SALTS))), [*on, "salt"], how).drop("salt")


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets have at least the given Jaccard similarity.

    ``pairs``: a (the centre), b, part.  The partners of a centre are dealt to
    as many parts as their number asks for; the centre's set goes once to each.
    """
    x, y = sets.toDF("a", "sa"), sets.toDF("b", "sb")
    both = F.size(F.array_intersect("sa", "sb"))
    centres = merged(pairs.select("a", "part").distinct(), x, ["a"])
    return (merged(merged(pairs, y, ["b"]), centres, ["a", "part"]).withColumn("both", both)
            .filter(F.col("both") >= similarity * (F.size("sa") + F.size("sb") - F.col("both")))
            .select("a", "b"))


def components(edges: DataFrame) -> DataFrame:
    """key and comp (the least key of its connected component) of every key in ``edges`` (a, b).

    Alternating large-star and small-star steps until every component is a
    star; every step only rewires rows, so no neighbourhood is collected.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        """large: neighbours above a node are moved to the least of all its neighbours; else those below it are."""
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else e
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        j = salted_join(both, least, ["a"], "b")
        if large:
            return (j.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .filter(F.col("a") != F.col("b")))
        # the node itself comes along with each of its rows
        moved = j.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        return moved.filter(F.col("a") != F.col("b")).distinct()

    def settled(e: DataFrame) -> bool:
        """Whether every component is a star: a key is under one other key, or other keys are under it."""
        ends = e.select(F.explode(F.array(F.struct(F.col("a").alias("key"), F.lit(1).alias("under")),
                                          F.struct(F.col("b").alias("key"), F.lit(0).alias("under")))).alias("end"))
        odd = (ends.groupBy("end.key").agg(F.sum("end.under").alias("n"), F.min("end.under").alias("under"))
                   .filter((F.col("n") > 1) | (F.col("n") == 1) & (F.col("under") == 0)))
        return odd.agg(F.count(F.lit(1))).first()[0] == 0

    now = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .filter(F.col("a") != F.col("b")).distinct())
    while not settled(now):
        now = cut(star(star(now, True), False))
    return now.select(F.col("a").alias("key"), F.col("b").alias("comp")).union(
        now.select(F.col("b").alias("key"), F.col("b").alias("comp")).distinct())


def joined(comps: DataFrame, links: DataFrame) -> DataFrame:
    """``comps`` (key, comp) after ``links`` (a, b) between components; a key that is not in ``comps`` is its own.

    Only the components that have links are gone over again, as single keys.
    """
    least = cut(components(links))
    moved = salted_join(comps, least.toDF("comp", "least"), ["comp"], "key", "left")
    return moved.select("key", F.coalesce("least", "comp").alias("comp")).union(least).distinct()


def open_blocks(shared: DataFrame, comps: DataFrame, reps: DataFrame) -> DataFrame:
    """Blocks of the buckets that hold several components: each outlier meets each other member once.

    ``shared``: band, h, key, centre, size.  Outliers are the members outside
    the centre's component.  Members are dealt to blocks and outliers to parts
    by hash, both by number and by total shingles, so that a (band, h, block,
    part) is of bounded size; its rows are band, h, block, part, outlier, key,
    comp.
    """
    labelled = (merged(shared.filter(F.col("size") > 2), comps, ["key"], "left")
                .withColumn("comp", F.coalesce("comp", "key")))
    open_ = (labelled.groupBy("band", "h")
                     .agg(F.min_by("comp", "key").alias("main"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                     .filter(F.col("lo") != F.col("hi")).select("band", "h", "main"))
    mixed = cut(merged(salted_join(labelled, open_, ["band", "h"]), reps.select("key", "n"), ["key"])
                .withColumn("outlier", F.col("comp") != F.col("main"))
                .select("band", "h", "key", "comp", "size", "n", "outlier"))
    own = F.when(F.col("outlier"), F.col("n").cast("long"))
    counts = mixed.groupBy("band", "h").agg(F.sum(F.col("outlier").cast("int")).alias("outliers"),
                                            F.sum(own).alias("own"), F.sum(F.col("n").cast("long")).alias("all"))
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("all") / BLOCK_SHINGLES)).cast("int")
    parts = F.ceil(F.greatest(F.col("outliers") / BLOCK, F.col("own") / BLOCK_SHINGLES)).cast("int")
    rows = salted_join(mixed, counts, ["band", "h"])
    as_member = (rows.withColumn("block", F.pmod(F.xxhash64("key"), blocks)).withColumn("part", each(parts))
                     .withColumn("outlier", F.lit(False)))
    # with one block an outlier is there already, as a member
    as_outlier = (rows.filter("outlier").withColumn("part", F.pmod(F.xxhash64("key"), parts))
                      .withColumn("block", each(blocks)))
    at = ["band", "h", "block", "part", "outlier", "key", "comp"]
    return as_member.select(*at).union(as_outlier.select(*at))


def block_links(out: list[tuple], rest: list[tuple], similarity: float) -> Iterator[tuple[bytes, bytes]]:
    """Links that join components: (comp, comp) of an outlier and a member.

    ``out``, ``rest``: (key, comp, shingles).  The members' shingles are sorted
    together once; an outlier's intersections with all of them are then counts
    over the places where its own shingles stand.
    """
    root: dict[bytes, bytes] = {}

    def top(c: bytes) -> bytes:
        while root.get(c, c) != c:
            c = root[c]
        return c

    sizes = np.array([len(r[2]) for r in rest])
    flat = np.concatenate([r[2] for r in rest])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], np.repeat(np.arange(len(rest)), sizes)[order]
    for _, comp, mine in out:
        first, last = np.searchsorted(flat, mine, "left"), np.searchsorted(flat, mine, "right")
        n = last - first
        at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        both = np.bincount(owner[at], minlength=len(rest))
        for j in np.flatnonzero(both >= similarity * (len(mine) + sizes - both)).tolist():
            x, y = top(comp), top(rest[j][1])
            if x != y:
                root[max(x, y)] = min(x, y)
                yield comp, rest[j][1]


def last_links(rows: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b: components) between components that are left in the blocks of :func:`open_blocks`.

    Every pair of a block is compared on whole sets, but only pairs that join
    two components are written down: fewer than the block has rows.
    """
    at = ["band", "h", "block", "part"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, rest, here = [], [], None

        def links() -> pa.RecordBatch:
            found = list(block_links(out, rest, similarity)) if out and rest else []
            out.clear(), rest.clear()
            return pa.RecordBatch.from_arrays([pa.array([min(x) for x in found], pa.binary()),
                                               pa.array([max(x) for x in found], pa.binary())], names=["a", "b"])

        for batch in batches:
            places = zip(*(batch.column(c).to_pylist() for c in at))
            cells = zip(*(batch.column(c).to_pylist() for c in ("outlier", "key", "comp")))
            sets_ = batch.column("shingles")
            ends, flat = sets_.offsets.to_numpy(), sets_.values.to_numpy()
            for i, (where, (outlier, key, comp)) in enumerate(zip(places, cells)):
                if where != here:
                    yield links()
                    here = where
                (out if outlier else rest).append((key, comp, flat[ends[i]:ends[i + 1]].copy()))
        yield links()

    return (merged(rows, sets, ["key"]).repartition(*at).sortWithinPartitions(*at)
                .mapInArrow(task, "a binary, b binary").distinct())


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, text_hash, class_id, class_hash, class_size for every row of ``docs`` (doc_id, text).

    A class is a connected component of rows with equal word sequences or with
    five-word shingle sets of Jaccard similarity ``similarity`` or more; its id
    is its least doc_id (ties: least text_hash; a null id is the least).  Every
    row is kept, repeated ones too.  Texts without a word are in a class only
    with equal texts; null counts as empty.  Other columns are ignored.
    """
    base = cut(sketches(docs))
    reps = cut(base.groupBy("key").agg(F.min(F.struct("doc_id", "text_hash")).alias("rep"), F.count(F.lit(1)).alias("copies"),
                                       F.first("n").alias("n"), F.first("bands").alias("bands")))
    members = (reps.filter(F.col("n") > 0).select("key", F.posexplode("bands").alias("band", "h"))
                   .filter(F.col("h").isNotNull()).withColumn("band", F.col("band") % BANDS))
    centres = (members.groupBy("band", "h").agg(F.min("key").alias("centre"), F.count(F.lit(1)).alias("size"))
                      .filter(F.col("size") > 1))
    # members of buckets with company; from here on small
    shared = cut(salted_join(members, centres, ["band", "h"]).select("band", "h", "key", "centre", "size"))
    parts = F.ceil(F.max("size") / BLOCK)
    pairs = cut(shared.filter(F.col("key") != F.col("centre"))
                      .groupBy(F.col("centre").alias("a"), F.col("key").alias("b"))
                      .agg(parts.alias("parts"))
                      .select("a", "b", F.pmod(F.xxhash64("b"), "parts").alias("part")))
    # whole shingle sets, only of texts in some pair
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    ids = merged(reps, wanted, ["key"], "left_semi").select(F.col("rep.doc_id").alias("__id"), F.col("rep.text_hash").alias("__hash"))
    texts = merged(docs.select("doc_id", "text"), ids,
                   F.col("doc_id").eqNullSafe(F.col("__id")) & F.xxhash64("text").eqNullSafe(F.col("__hash")), "left_semi")
    sets = cut(shingle_sets(texts).dropDuplicates(["key"]))
    edges = cut(verified(pairs, sets, similarity))
    comps = cut(components(edges))

    # buckets that still hold several components: their outliers against all other members
    more = cut(last_links(open_blocks(shared, comps, reps), sets, similarity))
    if not more.isEmpty():
        comps = cut(joined(comps, more))

    labelled = cut(merged(reps.select("key", "rep", "copies"), comps, ["key"], "left")
                   .withColumn("comp", F.coalesce("comp", "key")))
    classes = labelled.groupBy("comp").agg(F.min("rep").alias("class"), F.sum("copies").alias("class_size"))
    named = cut(salted_join(labelled.select("key", "comp"), classes, ["comp"]).select("key", "class", "class_size"))
    return salted_join(base.select("doc_id", "text_hash", "key"), named, ["key"], "doc_id").select(
        "doc_id", "text_hash", F.col("class.doc_id").alias("class_id"), F.col("class.text_hash").alias("class_hash"),
        "class_size")


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The row of each class that gives it its id, with all columns; of equal rows (id and text) any one."""
    keep = (near_duplicates(docs, similarity)
            .filter(F.col("doc_id").eqNullSafe(F.col("class_id")) & F.col("text_hash").eqNullSafe(F.col("class_hash")))
            .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct())
    rows = docs.withColumn("__own", F.xxhash64("text"))
    return (merged(rows, keep, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__hash")), "left_semi")
                .dropDuplicates(["doc_id", "__own"]).drop("__own"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "class_id", "class_size")
