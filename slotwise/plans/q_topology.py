"""Queries over device topology."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotwise.operators import topology as T
from slotwise.plans.catalog import query
from slotwise.session import scratch
from slotwise.sources import files as W
from slotwise.sources import readers as R

# Shared oracle text: the block rows with the carry-forward names.
SCAN_SQL = """
WITH blk AS (
  SELECT device_id, ord, depth, mountpoint, fstype, partlabel,
         nullif(regexp_replace(name, '^[^a-zA-Z0-9]*', ''), '') AS cname
  FROM fx_block),
scan AS (
  SELECT *, last_value(cname IGNORE NULLS) OVER w AS prev_name,
         last_value(CASE WHEN depth <= 1 THEN cname END IGNORE NULLS) OVER w AS prev_top,
         last_value(CASE WHEN depth >= 2 THEN cname END IGNORE NULLS) OVER w AS prev_sub
  FROM blk WINDOW w AS (PARTITION BY device_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
devs AS (SELECT DISTINCT device_id FROM fx_block),
fde AS (
  SELECT d.device_id, COALESCE(c.f, false) AS is_fde
  FROM devs d LEFT JOIN (SELECT device_id, bool_or(contains(target, 'rootfs_a')) AND bool_or(contains(target, 'rootfs_b')) AS f
                         FROM fx_crypt GROUP BY device_id) c ON c.device_id = d.device_id),
ver AS (SELECT device_id, count(*) FILTER (WHERE mountpoint = '/') >= 2 AS is_verity FROM fx_block GROUP BY device_id),
mode AS (SELECT v.device_id, CASE WHEN f.is_fde THEN 'fde' WHEN v.is_verity THEN 'verity' ELSE 'plain' END AS mode
         FROM ver v JOIN fde f ON f.device_id = v.device_id),
w1 AS (SELECT device_id, CASE WHEN contains(cname, 'verity') THEN '/dev/' || prev_name ELSE '/dev/' || cname END AS active,
              row_number() OVER (PARTITION BY device_id ORDER BY ord) AS rn
       FROM scan WHERE mountpoint = '/'),
w2 AS (SELECT device_id, '/dev/' || prev_top AS active, row_number() OVER (PARTITION BY device_id ORDER BY ord) AS rn
       FROM scan WHERE mountpoint = '/' AND starts_with(prev_sub, 'rootfs')),
w3 AS (SELECT device_id, '/dev/' || prev_top AS active, row_number() OVER (PARTITION BY device_id ORDER BY ord) AS rn
       FROM scan WHERE mountpoint = '/' AND TRY_CAST(nullif(regexp_extract(prev_top, '([0-9]+)$', 1), '') AS INTEGER) IN (2, 6)),
act AS (SELECT m.device_id, m.mode,
               CASE m.mode WHEN 'fde' THEN w2.active WHEN 'verity' THEN w3.active ELSE w1.active END AS active
        FROM mode m LEFT JOIN w1 ON w1.device_id = m.device_id AND w1.rn = 1
        LEFT JOIN w2 ON w2.device_id = m.device_id AND w2.rn = 1
        LEFT JOIN w3 ON w3.device_id = m.device_id AND w3.rn = 1)
"""


@query("a1_is_fde", SCAN_SQL + "SELECT device_id, is_fde FROM fde")
def a1_is_fde(fx):
    """Is full-disk encryption on (both slot volumes among the crypt targets)?"""
    return T.is_fde(fx.crypt, fx.block.select("device_id").distinct())


@query("a2_is_verity", SCAN_SQL + "SELECT device_id, is_verity FROM ver")
def a2_is_verity(fx):
    return T.is_verity(fx.block)


@query("a3_device_mode", SCAN_SQL + "SELECT device_id, mode FROM mode")
def a3_device_mode(fx):
    return T.device_mode(fx.block, fx.crypt)


@query("a3_mode_counts", SCAN_SQL + "SELECT mode, count(*) AS devices FROM mode GROUP BY mode")
def a3_mode_counts(fx):
    return T.mode_counts(T.device_mode(fx.block, fx.crypt))


@query("w1_active_plain", SCAN_SQL + """
SELECT d.device_id, w1.active FROM devs d LEFT JOIN w1 ON w1.device_id = d.device_id AND w1.rn = 1""")
def w1_active_plain(fx):
    return T.active_plain(fx.block)


@query("w2_active_fde", SCAN_SQL + """
SELECT d.device_id, w2.active FROM devs d LEFT JOIN w2 ON w2.device_id = d.device_id AND w2.rn = 1""")
def w2_active_fde(fx):
    return T.active_fde(fx.block)


@query("w3_active_verity", SCAN_SQL + """
SELECT d.device_id, w3.active FROM devs d LEFT JOIN w3 ON w3.device_id = d.device_id AND w3.rn = 1""")
def w3_active_verity(fx):
    return T.active_verity(fx.block)


@query("w7_active_partition", SCAN_SQL + "SELECT device_id, mode, active FROM act")
def w7_active_partition(fx):
    return T.active_partition(fx.block, fx.crypt)


INACTIVE_SQL = SCAN_SQL + """,
w4c AS (SELECT b.device_id, b.cname, row_number() OVER (PARTITION BY b.device_id ORDER BY b.ord) AS rn
        FROM blk b JOIN act a ON a.device_id = b.device_id
        WHERE b.mountpoint IS NULL AND b.fstype IS NOT NULL AND starts_with(b.partlabel, 'rootfs')
          AND NOT COALESCE(starts_with(b.cname, 'loop'), false) AND NOT COALESCE('/dev/' || b.cname = a.active, false)),
w4 AS (SELECT a.device_id,
              CASE WHEN w.cname IS NOT NULL AND NOT COALESCE(TRY_CAST(nullif(regexp_extract(w.cname, '([0-9]+)$', 1), '') AS INTEGER) IN (2, 6), false)
                   THEN NULL ELSE '/dev/' || w.cname END AS target,
              CASE WHEN w.cname IS NOT NULL AND NOT COALESCE(TRY_CAST(nullif(regexp_extract(w.cname, '([0-9]+)$', 1), '') AS INTEGER) IN (2, 6), false)
                   THEN 'Partition index must be either 2 or 6. Found: ' || COALESCE(nullif(regexp_extract(w.cname, '([0-9]+)$', 1), ''), '') END AS error
       FROM act a LEFT JOIN w4c w ON w.device_id = a.device_id AND w.rn = 1),
firstroot AS (SELECT device_id, prev_top AS n, prev_sub AS sub, row_number() OVER (PARTITION BY device_id ORDER BY ord) AS rn
              FROM scan WHERE mountpoint = '/'),
w5 AS (SELECT d.device_id,
              CASE WHEN r.device_id IS NULL THEN NULL
                   WHEN COALESCE(starts_with(r.n, 'rootfs_a'), false) OR COALESCE(starts_with(r.sub, 'rootfs_a'), false) THEN '/dev/mapper/rootfs_b'
                   ELSE '/dev/mapper/rootfs_a' END AS target,
              r.device_id IS NOT NULL
                AND NOT (COALESCE(starts_with(r.n, 'rootfs_a'), false) OR COALESCE(starts_with(r.sub, 'rootfs_a'), false))
                AND NOT (COALESCE(starts_with(r.n, 'rootfs_b'), false) OR COALESCE(starts_with(r.sub, 'rootfs_b'), false)) AS slot_guessed
       FROM devs d LEFT JOIN firstroot r ON r.device_id = d.device_id AND r.rn = 1),
w6 AS (SELECT device_id, cname AS volume, '/dev/' || prev_top AS parent FROM (
         SELECT *, row_number() OVER (PARTITION BY device_id, cname ORDER BY ord) AS rn FROM scan WHERE depth >= 2) x WHERE rn = 1),
wt AS (SELECT a.device_id, a.mode, a.active,
              CASE WHEN a.mode = 'fde' THEN w5.target ELSE w4.target END AS target,
              CASE WHEN a.mode = 'fde' THEN NULL ELSE w4.error END AS error
       FROM act a LEFT JOIN w4 ON w4.device_id = a.device_id LEFT JOIN w5 ON w5.device_id = a.device_id),
wtb AS (SELECT wt.*, CASE WHEN wt.mode = 'fde' THEN w6.parent ELSE wt.target END AS target_block
        FROM wt LEFT JOIN w6 ON w6.device_id = wt.device_id AND w6.volume = regexp_extract(wt.target, '([^/]+)$', 1))
"""


@query("w4_inactive_plain", INACTIVE_SQL + "SELECT device_id, target, error FROM w4")
def w4_inactive_plain(fx):
    """First free root slot per device, judged against the W7 active slot."""
    return T.inactive_plain(fx.block, T.active_partition(fx.block, fx.crypt))


@query("w5_inactive_fde", INACTIVE_SQL + "SELECT device_id, target, slot_guessed FROM w5")
def w5_inactive_fde(fx):
    return T.inactive_fde(fx.block)


@query("w6_parent_of", INACTIVE_SQL + "SELECT device_id, volume, parent FROM w6")
def w6_parent_of(fx):
    return T.parent_of(fx.block)


@query("w_write_target", INACTIVE_SQL + "SELECT device_id, mode, active, target, error, target_block FROM wtb")
def w_write_target(fx):
    """Target of a write per device (W4 or W5 by mode, backing block by W6)."""
    return T.write_target(fx.block, fx.crypt)


@query("f5_normalize_devices", """
SELECT device_id, ord, name,
  regexp_replace(regexp_replace(name, '[0-9]+$', ''), '([0-9])p$', '\\1') AS base,
  TRY_CAST(nullif(regexp_extract(name, '([0-9]+)$', 1), '') AS INTEGER) AS number,
  TRY_CAST(nullif(regexp_extract(name, '([0-9]+)$', 1), '') AS INTEGER) IN (2, 6) AS allowed,
  regexp_replace(name, '[0-9]+$', '') || '7' AS hash_dev,
  regexp_replace(name, '[0-9]+$', '') || CASE WHEN TRY_CAST(nullif(regexp_extract(name, '([0-9]+)$', 1), '') AS INTEGER) = 2 THEN '4' ELSE '5' END AS map_dev
FROM (SELECT device_id, ord, nullif(regexp_replace(name, '^[^a-zA-Z0-9]*', ''), '') AS name FROM fx_block) b""")
def f5_normalize_devices(fx):
    return T.normalize_devices(fx.block)


@query("a4_duplicate_ids", """
SELECT device_id, id, count(DISTINCT dev) AS devices, min(dev) AS first_dev
FROM (SELECT device_id, dev, lower(uuid) AS id FROM fx_blkid WHERE NOT contains(dev, 'loop')
      UNION ALL SELECT device_id, dev, lower(partuuid) FROM fx_blkid WHERE NOT contains(dev, 'loop')) x
WHERE id IS NOT NULL GROUP BY device_id, id HAVING count(DISTINCT dev) > 1""")
def a4_duplicate_ids(fx):
    return T.duplicate_ids(fx.blkid)


@query("s5_image_id", """
SELECT device_id, image_uuid FROM (
  SELECT device_id, split_part(line, '=', 2) AS image_uuid, row_number() OVER (PARTITION BY device_id ORDER BY ord) AS rn
  FROM fx_image_id_line WHERE starts_with(line, 'IMAGE_UUID=')) x WHERE rn = 1""")
def s5_image_id(fx):
    return R.image_id(fx.image_id_line)


@query("f10_device_present", INACTIVE_SQL + """
SELECT t.device_id, t.target,
  regexp_extract(COALESCE(t.target, ''), '([^/]*)$', 1) = '' OR COALESCE(bool_or(contains(b.cname, regexp_extract(COALESCE(t.target, ''), '([^/]*)$', 1))), false) AS present,
  count(*) FILTER (WHERE b.mountpoint IS NOT NULL AND starts_with('/dev/' || b.cname, t.target)) AS mounted_under
FROM wt t LEFT JOIN blk b ON b.device_id = t.device_id
GROUP BY t.device_id, t.target""")
def f10_device_present(fx):
    """Is each device's write target present in its block table; rows mounted under it."""
    return T.device_present(fx.block, T.write_target(fx.block, fx.crypt).select("device_id", "target"))


@query("s1_read_block", """
SELECT device_id, ord, depth, nullif(regexp_replace(name, '^[^a-zA-Z0-9]*', ''), '') AS name, fstype, partlabel, mountpoint
FROM fx_block""")
def s1_read_block(fx):
    """lsblk text rendered from the block table, parsed back into columns."""
    return R.read_block(R.render_block(fx.block))


@query("s1_read_block_aligned", """
SELECT device_id, ord, depth, nullif(regexp_replace(name, '^[^a-zA-Z0-9]*', ''), '') AS name, fstype, partlabel, mountpoint
FROM fx_block""")
def s1_read_block_aligned(fx):
    """Padded lsblk text with header and tree glyphs, parsed back into columns."""
    return R.read_block_aligned(R.render_block_aligned(fx.block))


@query("s1_read_block_files", """
SELECT device_id, CAST(row_number() OVER (PARTITION BY device_id ORDER BY ord) - 1 AS INT) AS ord, depth,
       nullif(regexp_replace(name, '^[^a-zA-Z0-9]*', ''), '') AS name, fstype, partlabel, mountpoint
FROM fx_block""")
def s1_read_block_files(fx):
    """lsblk output as devices upload it: one text file each, lines numbered as they stand in the file."""
    root = scratch(fx.spark, "lsblk")
    text = R.render_block(fx.block).repartition("device_id").sortWithinPartitions("device_id", "ord")
    folders = W.write_files(text, "device_id", "line", root)

    def read(paths):
        lines = R.read_lines(fx.spark, paths, device=r"device_id=([^/.]+)", by_tasks=True)
        return R.read_block(lines.withColumn("device_id", F.col("device_id").cast("long")))
    return W.read_folders(fx.spark, root, folders, read, at_once=None)


@query("s2_read_blkid", "SELECT device_id, dev, uuid, partuuid FROM fx_blkid")
def s2_read_blkid(fx):
    """blkid text rendered from the id table, parsed back (attributes as a map)."""
    return R.read_blkid(R.render_blkid(fx.blkid)).drop("attrs")
