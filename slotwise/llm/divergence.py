"""Source divergence audit: joint walks over K-squared trees of the group-term counts.

Per language the counts form a matrix of sources by kept terms, mostly zero.
Its columns are dealt to strips of bounded size; in a task a strip becomes a
K-squared tree (K = 2): the matrix is halved both ways again and again, and
only quadrants with a nonzero count have children, down to small leaves.  Two
groups are compared by walking the tree for both at once.  A quadrant that is
zero for both needs no cell: all its columns have the same price, so their
number is enough.  Leaves that hold a count of either group are priced cell by
cell, for all group pairs of the two leaves together.  All numbers are integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotwise.llm.common import PIECE, cut, table

MIN_DOCS = 10
TOP = 10
K = 2                   # a quadrant has K * K children
LEAF = 8                # rows and columns of a leaf
STRIP = 1 << 17         # nonzero counts of a strip, about
TILE = 512              # groups compared with as many others in one task
SALTS = 64              # tasks at least for the columns of one language
HELD = 1 << 20          # terms counted by a task before they are handed on
CHUNK = 2048            # leaf pairs priced by one numpy pass
UNIT = 1_000_000_000    # probabilities are in parts of 10^9

# a term is a run of A-Z, a-z and all bytes above 0x7F; all else divides terms
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def term_lists(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, in lists of bounded size."""
    at, rest = 0, b""
    while at < len(text):
        part = rest + text[at:at + PIECE].translate(_TERMS)
        at += PIECE
        end = part.rfind(b" ") + 1 if at < len(text) else len(part)
        yield part[:end].split()
        rest = part[end:]


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (rows that hold it), of lang, source and text without nulls.

    Each task adds up what it reads; a (lang, source, term) has a row for each task and each hand-over.
    """
    names = ["lang", "source", "term", "n", "docs"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, tuple[Counter, Counter]] = {}

        def hand_over() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, held) in found.items():
                terms = list(n)
                for i in range(0, len(terms), 1 << 16):
                    some = terms[i:i + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(some), pa.string()), pa.array([source] * len(some), pa.string()),
                         pa.array(some, pa.binary()), pa.array([n[t] for t in some], pa.int64()),
                         pa.array([held[t] for t in some], pa.int64())], names=names)
            found.clear()

        for b in batches:
            for lang, source, text in zip(*(b.column(c) for c in ("lang", "source", "text"))):
                n, held = found.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
                own: set[bytes] = set()
                for terms in term_lists(text.as_py()):
                    n.update(terms)
                    own.update(terms)
                held.update(own)
            if sum(len(n) for n, _ in found.values()) > HELD:
                yield from hand_over()
        yield from hand_over()

    rows = docs.select("lang", "source", F.col("text").cast("binary").alias("text"))
    return (rows.mapInArrow(task, "lang string, source string, term binary, n long, docs long")
                .withColumn("term", F.col("term").cast("string")))


def probability(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / total), by long division in steps of 1,000, so that no product passes 64 bits."""
    whole, rest = np.divmod(count + 2, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digit
    return whole + 1


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); 0 where both are 0 (columns that only fill up a leaf)."""
    return (p - q) ** 2 // np.maximum(p + q, 1)


class Tree:
    """A K-squared tree over the nonzero cells (row, column, p) of a matrix of ``rows`` by ``columns``.

    ``levels`` holds, from the root to the leaves, the sorted keys (block row *
    ``wide`` + block column) of the quadrants that are not all zero; ``leaves``
    their dense cells, zero cells already at the row's price ``zero``.
    """

    def __init__(self, row: np.ndarray, column: np.ndarray, p: np.ndarray, zero: np.ndarray, columns: int, depth: int):
        self.rows, self.wide = len(zero), -(-columns // LEAF)
        keys, inside = np.unique(row // LEAF * self.wide + column // LEAF, return_inverse=True)
        self.levels = [keys]
        r, c, wide = keys // self.wide, keys % self.wide, self.wide
        for _ in range(depth):
            r, c, wide = r // K, c // K, -(-wide // K)
            self.levels.insert(0, np.unique(r * wide + c))
        high = -(-self.rows // LEAF) * LEAF
        self.zeros = np.concatenate([zero, np.zeros(high - self.rows, np.int64)]).reshape(-1, LEAF)
        real = (keys % self.wide)[:, None] * LEAF + np.arange(LEAF) < columns
        self.leaves = np.where(real[:, None, :], self.zeros[keys // self.wide][:, :, None], 0)
        self.leaves[inside, row % LEAF, column % LEAF] = p

    def find(self, level: int, key: np.ndarray) -> np.ndarray:
        """The number of each quadrant among the nonzero ones of its level, or -1."""
        keys = self.levels[level]
        if not len(keys):
            return np.full(len(key), -1)
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[at] == key, at, -1)


def depth_of(rows: int, columns: int) -> int:
    depth = 0
    while LEAF * K ** depth < max(rows, columns):
        depth += 1
    return depth


def joint_walk(a: Tree, b: Tree, columns: int, same: bool) -> np.ndarray:
    """Summed prices of all columns for every (row of a, row of b); with ``same`` only row <= row is meant."""
    depth = len(a.levels) - 1
    empty = np.zeros((a.rows, b.rows), np.int64)            # columns where both are zero
    total = np.zeros((a.zeros.shape[0], b.zeros.shape[0], LEAF, LEAF), np.int64)
    ra = rb = c = np.zeros(1, np.int64)
    for level in range(depth + 1):
        block = LEAF * K ** (depth - level)
        wide = -(-columns // block)
        at_a, at_b = a.find(level, ra * wide + c), b.find(level, rb * wide + c)
        none = (at_a < 0) & (at_b < 0)
        # all-zero quadrants: their columns are counted, no cell is looked at
        here = np.zeros((-(-a.rows // block), -(-b.rows // block)), np.int64)
        np.add.at(here, (ra[none], rb[none]), np.minimum(columns - c[none] * block, block))
        empty += here.repeat(block, 0)[:a.rows].repeat(block, 1)[:, :b.rows]
        ra, rb, c, at_a, at_b = (x[~none] for x in (ra, rb, c, at_a, at_b))
        if level == depth:
            break
        child = np.array([(i, j, k) for i in range(K) for j in range(K) for k in range(K)]).T[:, None, :]
        ra, rb, c = ((x[:, None] * K + y).ravel() for x, y in zip((ra, rb, c), child))
        block //= K
        on = (ra * block < a.rows) & (rb * block < b.rows) & (c * block < columns)
        if same:
            on &= ra <= rb
        ra, rb, c = ra[on], rb[on], c[on]
    for i in range(0, len(ra), CHUNK):
        s = slice(i, i + CHUNK)
        real = (c[s, None] * LEAF + np.arange(LEAF) < columns)[:, None, :]

        def cells(tree: Tree, at: np.ndarray, r: np.ndarray) -> np.ndarray:
            zero = np.where(real, tree.zeros[r][:, :, None], 0)
            return np.where((at >= 0)[:, None, None], tree.leaves[at], zero) if len(tree.leaves) else zero

        f = price(cells(a, at_a[s], ra[s])[:, :, None, :], cells(b, at_b[s], rb[s])[:, None, :, :]).sum(axis=3)
        np.add.at(total, (ra[s], rb[s]), f)
    priced = total.transpose(0, 2, 1, 3).reshape(a.zeros.size, b.zeros.size)[:a.rows, :b.rows]
    zero_a, zero_b = a.zeros.ravel()[:a.rows], b.zeros.ravel()[:b.rows]
    return priced + empty * price(zero_a[:, None], zero_b[None, :])


def strip_prices(columns: pa.Table, groups: pa.Table, i: int, j: int) -> tuple[list, list]:
    """Rows (a, b, value) of the group pairs of tiles i and j, and rows (source, term, value) of the best terms.

    ``columns``: term, total, cells; ``groups``: tile, source, n, lang_n, v.
    Terms are only listed where i = j, at most ``TOP`` of a source.
    """
    tiles, n_columns = [], len(columns)
    lists = columns["cells"].combine_chunks()
    flat = lists.flatten()
    per_column = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    cell_column = np.repeat(np.arange(n_columns), per_column)
    cell_source = flat.field("source").to_pylist()
    cell_n = flat.field("n").to_numpy()
    # alike columns side by side: by the number of their sources, then by the first of them
    first = np.full(n_columns, "", object)
    first[cell_column[::-1]] = cell_source[::-1]
    place = np.empty(n_columns, np.int64)
    place[sorted(range(n_columns), key=lambda x: (-per_column[x], first[x]))] = np.arange(n_columns)
    table_ = {c: groups[c].to_pylist() for c in ("tile", "source", "n", "lang_n", "v")}
    rows = sorted(zip(*table_.values()), key=lambda x: (-x[2], x[1]))
    depth = depth_of(max(1, max((sum(r[0] == t for r in rows) for t in {i, j}), default=1)), n_columns)
    for t in sorted({i, j}):
        own = [r for r in rows if r[0] == t]
        number = {r[1]: k for k, r in enumerate(own)}
        row = np.array([number.get(s, -1) for s in cell_source], np.int64)
        mine = np.flatnonzero(row >= 0)
        whole = np.array([r[2] + 2 * r[4] for r in own], np.int64)
        p = probability(cell_n[mine], whole[row[mine]])
        zero = probability(np.zeros(len(own), np.int64), np.maximum(whole, 1))
        tree = Tree(row[mine], place[cell_column[mine]], p, zero, n_columns, depth) if n_columns else None
        tiles.append((own, tree, row[mine], cell_column[mine], p))
    (own_a, a, *_), (own_b, b, *_) = tiles[0], tiles[-1]
    walked = n_columns and own_a and own_b
    value = joint_walk(a, b, n_columns, i == j) if walked else np.zeros((len(own_a), len(own_b)), np.int64)
    pairs = [(x[1], y[1], int(value[k, m])) for k, x in enumerate(own_a) for m, y in enumerate(own_b) if i != j or k < m]
    best = []
    if i == j and n_columns:
        own, _, row, column, p = tiles[0]
        lang_total = own[0][3] + 2 * own[0][4]
        q = probability(columns["total"].to_numpy(), np.full(n_columns, lang_total, np.int64))[column]
        above = np.flatnonzero(p > q)
        row, column, f = row[above], column[above], price(p[above], q[above])
        names = columns["term"].to_pylist()
        order = np.lexsort((-f, row))
        starts = np.flatnonzero(np.diff(row[order], prepend=-1))
        for s, e in zip(starts, [*starts[1:], len(order)]):
            least = f[order[min(s + TOP, e) - 1]]        # ties with the last one are sorted out by term
            some = [(-int(f[x]), names[column[x]].encode(), x) for x in order[s:e][f[order[s:e]] >= least]]
            best += [(own[row[x]][1], names[column[x]], -v) for v, _, x in sorted(some)[:TOP]]
    return pairs, best


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, part, item, value, rank: how the sources of a language differ in their terms.

    ``docs``: lang, source, text; nulls count as ''; other columns are ignored.
    Every row is a document, repeated rows too.  Terms are runs of letters A-Z,
    a-z (lower-cased) and all characters above U+007F; a language keeps those
    in at least ``min_docs`` of its rows.  Part ``pair`` has each other source
    of the language, part ``term`` the (up to ten) kept terms that set the
    source off from its language.  Sources without terms have counts of zero;
    a language without kept terms has values of 0; equal values are ranked by
    item; an empty table gives an empty result.

    The matrix of a language may have up to some 10^5 sources (a column is one
    row); its strips hold about ``STRIP`` counts each, and ``TILE`` by ``TILE``
    sources meet in a task.
    """
    filled = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    occurring = filled.select("lang", "source").distinct()
    cells = term_counts(filled).groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    columns = cut(cells.groupBy("lang", "term")
                  .agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"),
                       F.collect_list(F.struct("source", "n")).alias("cells"))
                  .filter(F.col("docs") >= min_docs).select("lang", "term", "total", "cells"))
    sums = (columns.select("lang", F.explode("cells").alias("c"))
                   .groupBy("lang", F.col("c.source").alias("source"))
                   .agg(F.sum("c.n").alias("n"), F.count(F.lit(1)).alias("held")))
    per_group = occurring.join(sums, ["lang", "source"], "left").fillna(0, ["n", "held"])
    own_lang = Window.partitionBy("lang")       # one row a source
    terms_of = columns.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    groups = cut(per_group.join(terms_of, "lang", "left").fillna(0, ["v"])
                 .withColumns({"lang_n": F.sum("n").over(own_lang),
                               "tiles": F.ceil(F.count(F.lit(1)).over(own_lang) / TILE).cast("int"),
                               "strips": F.greatest(F.lit(1), F.ceil(F.sum("held").over(own_lang) / STRIP)).cast("int")})
                 .withColumn("tile", F.pmod(F.xxhash64("source"), "tiles").cast("int")))
    langs = groups.select("lang", "tiles", "strips").distinct().withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    at = ["lang", "strip", "i", "j"]

    def number(n):
        return F.sequence(F.lit(0), n - 1)

    meet = F.explode(F.flatten(F.transform(number(F.col("tiles")), lambda i: F.transform(
        F.sequence(i, F.col("tiles") - 1), lambda j: F.struct(i.alias("i"), j.alias("j")))))).alias("m")
    placed = (columns.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)))
                     .join(langs.hint("merge"), ["lang", "salt"])
                     .withColumn("strip", F.pmod(F.xxhash64("term", F.lit(1)), "strips").cast("int"))
                     .select("lang", "strip", "term", "total", "cells", "tiles", meet)
                     .select("lang", "strip", "m.i", "m.j", "term", "total", F.filter("cells", lambda x: (F.col("tiles") == 1) | F.pmod(
                         F.xxhash64(x["source"]), F.col("tiles")).isin(F.col("m.i"), F.col("m.j"))).alias("cells")))
    present = (groups.select("lang", "tile", "source", "n", "lang_n", "v", "strips", meet)
                     .filter((F.col("tile") == F.col("m.i")) | (F.col("tile") == F.col("m.j")))
                     .select("lang", F.explode(number(F.col("strips"))).alias("strip"), "m.i", "m.j",
                             "tile", "source", "n", "lang_n", "v"))

    def task(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        lang, _, i, j = (k.as_py() for k in key)
        pairs, best = strip_prices(left, right, i, j) if len(right) else ([], [])
        rows = [("pair", *r) for r in pairs] + [("term", *r) for r in best]
        part, source, item, value = zip(*rows) if rows else ((), (), (), ())
        return pa.table([pa.array([lang] * len(rows), pa.string()), pa.array(source, pa.string()), pa.array(part, pa.string()),
                         pa.array(item, pa.string()), pa.array(value, pa.int64())],
                        names=["lang", "source", "part", "item", "value"])

    priced = cut(placed.groupBy(*at).cogroup(present.groupBy(*at)).applyInArrow(
        task, "lang string, source string, part string, item string, value long"))
    sums = priced.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    other = sums.select("lang", F.col("item").alias("source"), "part", F.col("source").alias("item"), "value")
    by = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    return (sums.union(other).union(priced.filter("part = 'term'"))
                .withColumn("rank", F.row_number().over(by))
                .filter((F.col("part") == "pair") | (F.col("rank") <= TOP)))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of the sources of each language, over all documents."""
    return divergence(table(spark, sf_dir, "documents"))


SQL = """
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), w AS (
  SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 10
), cell AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL
), grp AS (
  SELECT g.lang, g.source, coalesce(s.n, 0) AS total, coalesce(k.v, 0) AS v, coalesce(k.n, 0) AS lang_total
  FROM (SELECT DISTINCT lang, source FROM d) g
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM cell GROUP BY ALL) s USING (lang, source)
  LEFT JOIN (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY ALL) k USING (lang)
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * g.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 2)) // (g.lang_total + 2 * g.v) AS q
  FROM grp g JOIN kept k USING (lang) LEFT JOIN cell c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pair AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(v.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM found
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INT) AS rank
FROM ranked WHERE part = 'pair' OR r <= 10
"""
