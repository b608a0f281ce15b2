"""Mixing sources to target weights: exact quotas split down a tree of output shards.

Native: DataFrame functions only.  Documents are cut into blocks of words;
every source has a quota of blocks, whole passes over the source and a last
pass that ends inside one block.  A binary tree deals the quotas to output
shards: a node halves its room and draws how much of each source goes left from
the multivariate hypergeometric distribution, one source after the other, so
quotas stay exact at every node.  The leaf counts give each shard its own
places in the permuted order of each source's blocks, disjoint by make, and a
shard orders what it got at random.

Random numbers are hashes of seeds and names, so reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotwise.llm.common import cut, table

BLOCK = 1024            # words of a block
SHARD = 4096            # blocks of an output shard, about
WEIGHTS = (5, 2, 1)     # of the sources in their order, repeating
SHARE = (3, 2)          # all targets together, as a fraction of all words
REPEATS = 2             # no source is taken more often
SALTS = 64
KEY_DIGITS = 15         # hexadecimal digits of a permutation key
TRIES = 64              # draws of the rejection sampler; each is accepted with probability 1/2 at least
WORD = r"[^\x20\x09-\x0D]+"

# ln n! for n below 16, above by Stirling's series
_LOG_FACTORIALS = [math.lgamma(n + 1) for n in range(16)]


def sized(docs: DataFrame) -> DataFrame:
    """uid, doc_id, source, size (words), text_hash of every row."""
    return docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "source",
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.xxhash64("text").alias("text_hash"))


def targets(sources: DataFrame) -> DataFrame:
    """``sources`` (source, source_size) with ``target``: words to take, by weight and at most ``REPEATS`` times the size.

    What goes beyond a source's limit is shared anew by weight among the
    others.  In the order of limit by weight the limited sources come first, so
    sums over the sources before each one tell whether it is limited.
    """
    up, down = SHARE
    place = Window.orderBy(F.col("source").asc_nulls_last())        # one row a source
    w = sources.withColumn("weight", F.get(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(place) - 1) % len(WEIGHTS)).cast("int"))
                           .cast("long")).withColumn("limit", F.col("source_size") * REPEATS)
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before, all_ = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    w = w.withColumns({"words": F.sum("source_size").over(all_),
                       "spent": F.coalesce(F.sum("limit").over(before), F.lit(0)),
                       "others": F.sum("weight").over(all_) - F.coalesce(F.sum("weight").over(before), F.lit(0))})
    # room / (down * others) is what a unit of weight gets if no source from here on is limited
    room = up * F.col("words") - down * F.col("spent")
    limited = F.col("limit") * down * F.col("others") < F.col("weight") * room
    w = w.withColumns({"room": room, "limited": limited})
    free = F.min_by(F.struct("room", "others"), F.when(~F.col("limited"), F.col("spent"))).over(all_)
    share = F.col("weight") * free["room"] / (down * free["others"])
    return w.withColumn("target", F.when(F.col("limited"), F.col("limit").cast("double")).otherwise(share)).select(
        "source", "source_size", "target")


def salted(rows: DataFrame, one: DataFrame, on: list[str], by: Column) -> DataFrame:
    """``rows`` with the columns of ``one``, a row for each (maybe null) value of ``on``; a hot value goes to ``SALTS`` tasks."""
    names = {c: f"__{c}" for c in on}
    one = one.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnsRenamed(names).hint("merge")
    rows = rows.withColumn("salt", F.pmod(F.hash(by), F.lit(SALTS)))
    same = F.col("salt") == F.col("__salt")
    for c, new in names.items():
        same &= F.col(c).eqNullSafe(F.col(new))
    return rows.join(one, same).drop("salt", "__salt", *names.values())


def blocks(base: DataFrame) -> DataFrame:
    """Blocks of all passes that a source needs: uid, source, pass, block, words, key (a place in the pass's permutation).

    ``base``: uid, doc_id, text_hash, source, size, whole (full passes) and
    rest (words of the last pass).  Equal keys are told apart by doc_id,
    text_hash, block and uid.
    """
    rows = (base.filter("size > 0")
                .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / BLOCK))))
                .withColumn("words", F.least(F.lit(BLOCK), F.col("size") - F.col("block") * BLOCK))
                .filter("whole + rest > 0")
                .withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - F.when(F.col("rest") > 0, 0).otherwise(1)))))
    name = F.concat_ws("|", F.col("pass").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("block").cast("string"))
    return rows.withColumn("key", F.conv(F.substring(F.md5(name.cast("binary")), 1, KEY_DIGITS), 16, 10).cast("long"))


def drawn(rows: DataFrame, number: int) -> DataFrame:
    """The blocks that the mix takes of ``number`` ones, with ``place`` in their source's permuted order and ``taken`` words.

    A pass is cut into ranges of equal width of the key; ranges and the rows of
    a range are about the square root of all blocks in number.  Sums over the
    ranges before, then over the range's own rows, give each block its place.
    """
    wide = max(1, math.isqrt(number))
    rows = rows.withColumn("bucket", F.floor(F.col("key") / -(-16 ** KEY_DIGITS // wide)))
    at = ["source", "pass"]
    sums = rows.groupBy(*at, "bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("w"))
    before = Window.partitionBy("source").orderBy("pass", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    in_pass = Window.partitionBy(*at).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*at, "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
                       F.coalesce(F.sum("w").over(in_pass), F.lit(0)).alias("w_before"))
    on = F.lit(True)
    for c in (*at, "bucket"):
        on &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    joined = (rows.join(sums.withColumnsRenamed({c: f"__{c}" for c in (*at, "bucket")}).hint("merge"), on)
                  .drop(*(f"__{c}" for c in (*at, "bucket"))))
    own = Window.partitionBy(*at, "bucket").orderBy("key", "doc_id", "text_hash", "block", "uid").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("rest") - F.col("w_before") - F.coalesce(F.sum("words").over(own), F.lit(0))
    return (joined.withColumns({"place": F.col("n_before") + F.count(F.lit(1)).over(own),
                                "taken": F.when(F.col("pass") < F.col("whole"), F.col("words")).otherwise(F.least("words", left))})
                  .filter("taken > 0")
                  .select("uid", "source", "pass", "block", "place", "taken", "key"))


def log_factorial(n: Column) -> Column:
    x = F.greatest(n, F.lit(len(_LOG_FACTORIALS))).cast("double")
    series = (x + 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + (1 - (1 / 30 - 1 / (105 * x * x)) / (x * x)) / (12 * x)
    table_ = F.from_json(F.lit(str(_LOG_FACTORIALS)), "array<double>")      # folded to one constant
    return F.when(n < len(_LOG_FACTORIALS), F.get(table_, F.greatest(n, F.lit(0)).cast("int"))).otherwise(series)


def bound(value: Column, f) -> Column:
    """``f(value)`` with ``value`` worked out once, however often ``f`` names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def uniform(*names: Column) -> Column:
    """A number between 0 and 1 (neither) that the names determine."""
    return (F.shiftrightunsigned(F.xxhash64(*names), 11).cast("double") + 0.5) * 2.0 ** -53


def hypergeometric(good: Column, total: Column, draws: Column, *names: Column) -> Column:
    """How many good ones are among ``draws`` of ``total`` without replacement: a draw that the names determine.

    Rejection by the ratio of two uniforms under a table-mountain hat around
    the mode, with exact log probabilities; the hat covers the distribution,
    so accepted values follow it.  ``TRIES`` misses in a row (less likely than
    10^-19) give the mode.
    """
    least, most = F.greatest(F.lit(0).cast("long"), draws - (total - good)), F.least(good, draws)
    n = F.greatest(total, F.lit(1)).cast("double")

    def log_weight(k: Column) -> Column:
        return -(log_factorial(k) + log_factorial(good - k) + log_factorial(draws - k) + log_factorial(total - good - draws + k))

    mean = draws * (good / n)
    spread = F.sqrt(mean * (1 - good / n) * (1 - (draws - 1) / F.greatest(n - 1, F.lit(1.0))) + 0.5)
    # Stadlober's constants: width of the hat 2 sqrt(2 / e) standard deviations, and 3 - 2 sqrt(3 / e)
    width = 2 * math.sqrt(2 / math.e) * spread + (3 - 2 * math.sqrt(3 / math.e))
    mode = F.floor((draws + 1).cast("double") * (good + 1) / (n + 2))
    # what all attempts share, and the outcome: a NULL k has not been found yet
    shared = F.struct(least.alias("least"), most.alias("most"), mean.cast("double").alias("mean"), width.alias("width"),
                      F.least(most, F.greatest(least, mode)).alias("mode"))

    def search(x: Column) -> Column:
        def attempt(found: Column, i: Column) -> Column:
            u = uniform(*names, i, F.lit(0))
            k = F.floor(x["mean"] + 0.5 + x["width"] * (uniform(*names, i, F.lit(1)) - 0.5) / u)
            hit = bound(k, lambda k: F.when((k >= x["least"]) & (k <= x["most"]) & (
                2 * F.log(u) <= log_weight(k) - log_weight(x["mode"])), k))
            return F.when(found.isNotNull(), found).otherwise(hit)

        start = F.when(x["least"] == x["most"], x["least"])
        return F.coalesce(F.aggregate(F.sequence(F.lit(1), F.lit(TRIES)), start, attempt), x["mode"])

    return bound(shared, search)


def halved(counts: Column, node: Column) -> Column:
    """The left half's count of each source: a multivariate hypergeometric draw of half of the node's room."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, c: a + c)

    def step(state: Column, c: Column) -> Column:
        k = hypergeometric(c, state["total"], state["room"], node, F.size(state["left"]))
        return bound(k, lambda k: F.struct((state["total"] - c).alias("total"), (state["room"] - k).alias("room"),
                                           F.concat(state["left"], F.array(k)).alias("left")))

    start = F.struct(total.alias("total"), F.ceil(total / 2).alias("room"), F.array().cast("array<bigint>").alias("left"))
    return F.aggregate(counts, start, step, lambda s: s["left"])


def split_tree(quotas: DataFrame, levels: int) -> DataFrame:
    """node (the shard, from 0) and counts of its ``2 ** levels`` leaves, from one root row ``counts``."""
    nodes = quotas.select(F.lit(1).cast("long").alias("node"), "counts")
    for level in range(levels):
        nodes = nodes.withColumn("left", halved(F.col("counts"), F.col("node")))
        right = F.zip_with("counts", "left", lambda c, l: c - l)
        nodes = nodes.select(F.explode(F.array(F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("counts")),
                                               F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("counts")))).alias("n")).select("n.*")
        nodes = cut(nodes.repartition("node"))      # else each level would hold the expressions of all before it
    return nodes.withColumn("node", F.col("node") - (1 << levels))


def mix(docs: DataFrame, shard: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """(documents, spans) of a mix of all ``docs`` (doc_id, source, text).

    documents: uid, doc_id, source, size, source_size, target; a row for each
    row.  spans: shard, position (in the shard's random order), uid, pass,
    first_word and words of every block that the mix takes.  A source's words
    come to its target, rounded.  Null texts and texts without a word have size
    0 and are not taken, nor is a source of such; null is a source of its own,
    the last; repeated rows are documents of their own; equal doc_ids are told
    apart by text; an empty table gives no rows; other columns are ignored.
    """
    rows = cut(sized(docs))
    plan = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    words = F.floor(F.col("target") + 0.5)
    plan = (plan.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(words / F.greatest("source_size", F.lit(1)))).otherwise(0))
                .withColumn("rest", words - F.col("whole") * F.col("source_size")))
    base = cut(salted(rows, cut(plan), ["source"], F.col("uid")))
    number = base.agg(F.sum(F.ceil(F.col("size") / BLOCK) * (F.col("whole") + F.when(F.col("rest") > 0, 1).otherwise(0)))).first()[0]
    taken = cut(drawn(blocks(base), int(number or 0)))
    quotas = cut(taken.groupBy("source").agg(F.count(F.lit(1)).alias("n")))
    levels = max(0, math.ceil(math.log2(max(1, (taken.count()) / shard))))
    # sources in their order; a root row of one count a source
    listed = F.array_sort(F.collect_list(F.struct(F.col("source").isNull().alias("none"), "source", "n")))
    root = quotas.agg(listed.alias("all")).select(F.transform("all", lambda x: x["n"]).alias("counts"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = quotas.select("source", (F.row_number().over(order) - 1).alias("number"))
    leaves = split_tree(root, levels).select(F.col("node").alias("shard"), F.posexplode("counts").alias("number", "n")).filter("n > 0")
    # a leaf's places in a source's order follow those of the leaves before it
    until = Window.partitionBy("number").orderBy("shard")
    slots = (leaves.withColumn("end", F.sum("n").over(until))
                   .select("shard", "number", F.explode(F.sequence(F.col("end") - F.col("n"), F.col("end") - 1)).alias("place")))
    placed = salted(taken, numbered, ["source"], F.col("place")).join(slots.hint("merge"), ["number", "place"])
    local = Window.partitionBy("shard").orderBy(F.xxhash64("shard", "key", "number", "place"), "number", "place")
    spans = placed.select("shard", (F.row_number().over(local) - 1).alias("position"), "uid", "pass",
                          (F.col("block") * BLOCK).alias("first_word"), F.col("taken").alias("words"))
    return base.select("uid", "doc_id", "source", "size", "source_size", "target"), spans


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs, spans = mix(table(spark, sf_dir, "documents"))
    words = spans.groupBy("uid").agg(F.sum("words").alias("taken"))
    return docs.join(words, "uid", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


SQL = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents
), s AS (
  SELECT source, sum(size) AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM d GROUP BY source
), o AS (
  SELECT *, 2 * source_size AS lim, sum(source_size) OVER () AS words,
         coalesce(sum(2 * source_size) OVER before, 0) AS spent,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS others
  FROM s WINDOW before AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT *, 3 * words - 2 * spent AS room, lim * 2 * others < weight * (3 * words - 2 * spent) AS limited FROM o
), t AS (
  SELECT source, source_size, CASE WHEN limited THEN CAST(lim AS DOUBLE) ELSE
         CAST(weight * (arg_min(room, spent) FILTER (WHERE NOT limited) OVER ()) AS DOUBLE)
         / CAST(2 * (arg_min(others, spent) FILTER (WHERE NOT limited) OVER ()) AS DOUBLE) END AS target
  FROM l
), p AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // CAST(source_size AS BIGINT) ELSE 0 END AS whole FROM t
), r AS (
  SELECT *, CAST(floor(target + 0.5) AS BIGINT) - whole * CAST(source_size AS BIGINT) AS rest FROM p
), b AS (
  SELECT d.doc_id, d.source, r.whole, r.rest, g.block, least(1024, d.size - 1024 * g.block) AS words,
         substr(md5(r.whole || '|' || coalesce(CAST(d.doc_id AS VARCHAR), '') || '|' || g.block), 1, 15) AS key
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source, LATERAL (SELECT unnest(range((d.size + 1023) // 1024)) AS block) g
), c AS (
  SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY key, doc_id, block
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_before FROM b
), k AS (
  SELECT doc_id, sum(whole * words + greatest(0, least(words, rest - w_before))) AS taken FROM c GROUP BY doc_id
)
SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, CAST(r.source_size AS BIGINT) AS source_size, r.target,
       CAST(coalesce(k.taken, 0) AS BIGINT) AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source LEFT JOIN k ON d.doc_id = k.doc_id
"""
