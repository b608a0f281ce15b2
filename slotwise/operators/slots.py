"""Slot contents: integrity roots, replacement plans, overlays.

A slot's content is a manifest ``(slot, path, digest)`` (or any DataFrame,
for :func:`merkle_root` over rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROOT_DEPTH = 2      # prefix digits of a manifest root; part of what the root means, so stored beside it
ROWS_DEPTH = 4      # the same for roots over any rows
HIDDEN_TOP_LEVEL = r"^/\.[^/]*"


def _fold(children: Column) -> Column:
    """Digest of a node: sha256 of its children, sorted, joined without separator."""
    return F.sha2(F.array_join(F.sort_array(F.collect_list(children)), ""), 256)


def merkle_root(df: DataFrame, group: list[str], key: Column, leaf: Column, depth: int) -> DataFrame:
    """Integrity root per ``group`` over the rows of ``df``.

    Leaves are ``leaf`` digests; level ``d`` (``depth`` .. 1) groups nodes by
    the first ``d`` hex digits of ``sha2(key)``, so every level is one
    ``groupBy`` on a uniformly spread prefix (no hot group, no global sort, no
    row numbering), and a node never holds more than ~16 children above the
    leaf level.  Result ``(*group, root)``.
    """
    level = df.select(*group, F.sha2(key, 256).alias("k"), leaf.alias("h"))
    level = level.groupBy(*group, F.substring("k", 1, depth).alias("p")).agg(_fold(F.col("h")).alias("h"))
    for d in range(depth - 1, 0, -1):
        level = level.groupBy(*group, F.substring("p", 1, d).alias("p")).agg(_fold(F.col("h")).alias("h"))
    return level.groupBy(*group).agg(_fold(F.col("h")).alias("root"))


def manifest_root(manifest: DataFrame, depth: int = ROOT_DEPTH) -> DataFrame:
    """A6 over file manifests: leaf ``sha256('0' || path || '=' || digest)``,
    key ``path``, one root per slot, with the depth it was made at.

    The depth never follows the number of rows: a root only changes with its
    own slot.  Choose it for the largest manifest expected (a leaf group holds
    about rows / 16^depth digests) and compare only roots of one depth.
    """
    leaf = F.sha2(F.concat(F.lit("0"), F.col("path"), F.lit("="), F.col("digest")), 256)
    return merkle_root(manifest, ["slot"], F.col("path"), leaf, depth).withColumn("depth", F.lit(depth))


def rows_root(df: DataFrame, depth: int = ROWS_DEPTH) -> str | None:
    """A6 over any DataFrame (the whole row is the leaf); returns the root.

    Only the single root value comes back to the driver.
    """
    row = F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]))
    leaf = F.sha2(F.concat(F.lit("0"), row), 256)
    out = merkle_root(df.withColumn("__g", F.lit(0)), ["__g"], row, leaf, depth).collect()
    return out[0]["root"] if out else None


def _visible(df: DataFrame, include_hidden: bool) -> DataFrame:
    return df if include_hidden else df.where(~F.col("path").rlike(HIDDEN_TOP_LEVEL))


def slot_diff(src: DataFrame, dst: DataFrame, include_hidden: bool = False) -> DataFrame:
    """What replacing ``src`` by ``dst`` does to every path:
    ``added`` / ``removed`` / ``changed`` / ``same``.  Top-level hidden
    entries are left out unless ``include_hidden`` (H13)."""
    a = _visible(src, include_hidden).select("path", F.col("digest").alias("da"))
    b = _visible(dst, include_hidden).select("path", F.col("digest").alias("db"))
    j = a.join(b, "path", "full_outer")
    return j.select(
        "path",
        F.when(F.col("da").isNull(), F.lit("added"))
         .when(F.col("db").isNull(), F.lit("removed"))
         .when(F.col("da").eqNullSafe(F.col("db")), F.lit("same"))
         .otherwise(F.lit("changed")).alias("status"))


def mirror(src: DataFrame, dst: DataFrame, include_hidden: bool = False) -> DataFrame:
    """Replace ``dst`` by ``src``: ``delete`` what only ``dst`` has, ``copy``
    what only ``src`` has (multiset difference on ``(path, digest)``).

    One scan of either side and one aggregation: rows of ``src`` count +1,
    rows of ``dst`` -1, and what is left over is written out that often.
    """
    s = _visible(src, include_hidden).select("path", "digest", F.lit(1).alias("n"))
    d = _visible(dst, include_hidden).select("path", "digest", F.lit(-1).alias("n"))
    left = s.unionByName(d).groupBy("path", "digest").agg(F.sum("n").alias("n")).where(F.col("n") != 0)
    return left.select(F.when(F.col("n") > 0, "copy").otherwise("delete").alias("action"), "path", "digest",
                       F.explode(F.sequence(F.lit(1), F.abs("n"))).alias("k")).drop("k")


def preserve_overlay(new: DataFrame, old: DataFrame, keep: list[str]) -> DataFrame:
    """The new tree, with the ``keep`` files taken from the running one.

    A kept file the running tree lacks stays as the new tree has it.  ``keep``
    is a short fixed list (e.g. the host name): only those paths are compared.
    """
    kept = F.col("path").isin(*keep)
    rows = new.select("path", "digest", F.lit("new").alias("source"))
    mine = old.where(kept).select("path", "digest", F.lit("old").alias("source"))
    # "old" sorts after "new"
    chosen = (rows.where(kept).unionByName(mine).groupBy("path")
                  .agg(F.max(F.struct("source", "digest")).alias("c")).select("path", "c.digest", "c.source"))
    return rows.where(~kept).unionByName(chosen)


def publish_write(df: DataFrame, root: str, running: str | None) -> str:
    """Full replace of the slot that is not running (``a`` if none is);
    the running slot is never touched.  Returns the slot written."""
    slot = "b" if running == "a" else "a"
    df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/slot={slot}")
    return slot
