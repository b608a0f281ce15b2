"""Queries over slot contents."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotwise.operators import slots as S
from slotwise.plans.catalog import query
from slotwise.plans.dataset_slots import DatasetSlots
from slotwise.session import scratch

# files carried over from the running system; the second is only in the new tree at some scales
KEEP_FILES = ["/etc/hostname", "/usr/share/fr/3"]


def _slot(fx, s):
    return fx.manifest.where(F.col("slot") == s)


@query("a6_merkle_root", """
WITH lv AS (SELECT slot, sha256(path) AS k, sha256('0' || path || '=' || digest) AS h FROM fx_manifest),
l2 AS (SELECT slot, substr(k, 1, 2) AS p, sha256(string_agg(h, '' ORDER BY h)) AS h FROM lv GROUP BY ALL),
l1 AS (SELECT slot, substr(p, 1, 1) AS p, sha256(string_agg(h, '' ORDER BY h)) AS h FROM l2 GROUP BY ALL)
SELECT slot, sha256(string_agg(h, '' ORDER BY h)) AS root, 2 AS depth FROM l1 GROUP BY slot""")
def a6_merkle_root(fx):
    """Integrity root per slot and its prefix depth (part of the root's definition)."""
    return S.manifest_root(fx.manifest)


@query("j8_preserve_overlay", f"""
SELECT path, digest, 'new' AS source FROM fx_manifest WHERE slot = 'b' AND path NOT IN ({", ".join(f"'{p}'" for p in KEEP_FILES)})
UNION ALL
SELECT path, digest, 'old' AS source FROM fx_manifest WHERE slot = 'a' AND path IN ({", ".join(f"'{p}'" for p in KEEP_FILES)})
UNION ALL
SELECT path, digest, 'new' AS source FROM fx_manifest WHERE slot = 'b' AND path IN ({", ".join(f"'{p}'" for p in KEEP_FILES)})
  AND path NOT IN (SELECT path FROM fx_manifest WHERE slot = 'a')""")
def j8_preserve_overlay(fx):
    return S.preserve_overlay(_slot(fx, "b"), _slot(fx, "a"), KEEP_FILES)


@query("j9_slot_diff", """
SELECT COALESCE(a.path, b.path) AS path,
  CASE WHEN a.path IS NULL THEN 'added' WHEN b.path IS NULL THEN 'removed' WHEN a.digest = b.digest THEN 'same' ELSE 'changed' END AS status
FROM (SELECT * FROM fx_manifest WHERE slot = 'a') a FULL JOIN (SELECT * FROM fx_manifest WHERE slot = 'b') b ON a.path = b.path""")
def j9_slot_diff(fx):
    """Slot a replaced by slot b, hidden top-level entries included."""
    return S.slot_diff(_slot(fx, "a"), _slot(fx, "b"), include_hidden=True)


@query("u1_mirror", """
WITH s AS (SELECT path, digest FROM fx_manifest WHERE slot = 'b' AND NOT regexp_matches(path, '^/\\.[^/]*')),
d AS (SELECT path, digest FROM fx_manifest WHERE slot = 'a' AND NOT regexp_matches(path, '^/\\.[^/]*'))
SELECT 'delete' AS action, * FROM (SELECT * FROM d EXCEPT ALL SELECT * FROM s) x
UNION ALL SELECT 'copy' AS action, * FROM (SELECT * FROM s EXCEPT ALL SELECT * FROM d) y""")
def u1_mirror(fx):
    """Deletes and copies that turn slot a into slot b (hidden entries kept)."""
    return S.mirror(_slot(fx, "b"), _slot(fx, "a"))


@query("s8_publish_write", """
SELECT 'b' AS slot_written, path, digest FROM fx_manifest WHERE slot = 'b'
UNION ALL SELECT 'a' AS slot_written, path, digest FROM fx_manifest WHERE slot = 'a'""")
def s8_publish_write(fx):
    """Slot a's manifest published into a fresh dataset, then slot b's while a
    runs: each lands in the slot that does not run, the other stays; both read back."""
    root = scratch(fx.spark, "publish")
    running = S.publish_write(_slot(fx, "a").select("path", "digest"), root, None)
    S.publish_write(_slot(fx, "b").select("path", "digest"), root, running)
    return fx.spark.read.parquet(root).select(F.col("slot").alias("slot_written"), "path", "digest")


@query("p1_dataset_slots", "SELECT path, digest FROM fx_manifest WHERE slot = 'a'")
def p1_dataset_slots(fx):
    """Full cycle: publish a, verify, apply, open, commit; publish b, apply,
    open (trial), roll back; the next open serves a again."""
    ds = DatasetSlots(fx.spark, scratch(fx.spark, "dataset"))
    ds.write(_slot(fx, "a").select("path", "digest"))
    if not ds.verify():
        raise RuntimeError("slot a failed verification")
    ds.apply()
    ds.open()
    ds.commit()
    ds.write(_slot(fx, "b").select("path", "digest"))
    ds.apply()
    ds.open()          # trial of b
    ds.rollback()
    return ds.open()
