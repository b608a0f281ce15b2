"""Queries over boot entries."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotwise.functions import columns as C
from slotwise.operators import boot as B
from slotwise.operators import topology as T
from slotwise.plans.catalog import query
from slotwise.plans.q_topology import SCAN_SQL

BOOT_TAIL = r""",
bl AS (SELECT device_id, ord, line, nullif(regexp_extract(line, '([A-Za-z0-9._-]+\.efi)', 1), '') AS named,
              nullif(regexp_extract(line, 'root=PARTUUID=([^ ]+)', 1), '') AS root,
              nullif(regexp_extract(line, 'boot_uuid=([^ ]+)', 1), '') AS boot FROM fx_boot_line),
ctx AS (SELECT * FROM (
          SELECT *, last_value(named IGNORE NULLS) OVER w AS uki,
                 last_value(CASE WHEN named IS NOT NULL THEN ord END IGNORE NULLS) OVER w AS head_ord
          FROM bl WINDOW w AS (PARTITION BY device_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) x
        WHERE uki IS NOT NULL AND ord - head_ord <= 5),
entries AS (SELECT k.device_id, k.uki,
              (SELECT root FROM ctx c WHERE c.device_id = k.device_id AND c.uki = k.uki AND root IS NOT NULL ORDER BY ord LIMIT 1) AS root_partuuid,
              (SELECT boot FROM ctx c WHERE c.device_id = k.device_id AND c.uki = k.uki AND boot IS NOT NULL ORDER BY ord LIMIT 1) AS boot_uuid
            FROM (SELECT DISTINCT device_id, uki FROM ctx) k),
j2 AS (SELECT e.device_id, e.uki,
         CASE WHEN (CASE WHEN a.mode = 'plain' THEN b.partuuid ELSE b.uuid END) IS NULL THEN 'no partition id'
              WHEN (CASE WHEN a.mode = 'plain' THEN COALESCE(e.root_partuuid, e.boot_uuid) ELSE e.boot_uuid END) IS NULL THEN 'no entry id'
              WHEN (CASE WHEN a.mode = 'plain' THEN COALESCE(e.root_partuuid, e.boot_uuid) ELSE e.boot_uuid END)
                   = (CASE WHEN a.mode = 'plain' THEN b.partuuid ELSE b.uuid END) THEN 'yes' ELSE 'no' END AS matched
       FROM entries e JOIN act a ON a.device_id = e.device_id
       LEFT JOIN fx_blkid b ON b.device_id = a.device_id AND b.dev = a.active),
j3 AS (SELECT d.device_id, y.active_uki FROM devs d
       LEFT JOIN (SELECT device_id, min(uki) AS active_uki FROM j2 WHERE matched = 'yes' GROUP BY device_id) y ON y.device_id = d.device_id)
"""
BOOT_SQL = SCAN_SQL + BOOT_TAIL


def entries_of(fx):
    return B.read_boot_entries(fx.boot_line)


def active_uki_of(fx, act=None):
    act = act if act is not None else T.active_partition(fx.block, fx.crypt)
    return B.active_uki(entries_of(fx), act.select("device_id", "mode", "active"), fx.blkid).select(
        "device_id", "active_uki")


@query("s3_read_boot_entries", BOOT_SQL + "SELECT device_id, uki, root_partuuid, boot_uuid FROM entries")
def s3_read_boot_entries(fx):
    return entries_of(fx)


@query("j2_uki_matches", BOOT_SQL + "SELECT device_id, uki, matched FROM j2")
def j2_uki_matches(fx):
    return B.uki_matches(entries_of(fx), T.active_partition(fx.block, fx.crypt), fx.blkid)


@query("j3_active_uki", BOOT_SQL + "SELECT device_id, active_uki FROM j3")
def j3_active_uki(fx):
    return active_uki_of(fx)


@query("f9_other_slot", BOOT_SQL + r"""
SELECT device_id, active_uki,
  CASE WHEN active_uki IS NULL THEN NULL WHEN regexp_matches(active_uki, '-2\.efi$') THEN 'linux-2.efi' ELSE 'linux.efi' END AS active_boot,
  CASE WHEN active_uki IS NULL THEN NULL WHEN regexp_matches(active_uki, '-2\.efi$') THEN 'linux.efi' ELSE 'linux-2.efi' END AS next_boot,
  CASE WHEN active_uki IS NULL THEN NULL WHEN regexp_matches(active_uki, '-2\.efi$') THEN 'linux.efi' ELSE 'linux-2.efi' END AS previous_boot
FROM j3""")
def f9_other_slot(fx):
    a = active_uki_of(fx)
    return a.select("device_id", "active_uki", C.active_boot_image("active_uki").alias("active_boot"),
                    C.other_boot_image("active_uki").alias("next_boot"),
                    C.other_boot_image("active_uki").alias("previous_boot"))


@query("l1_first_file", r"""
SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, min(path) AS first_path FROM fx_image GROUP BY 1""")
def l1_first_file(fx):
    return B.first_file(fx.image.select("path"))


@query("l1_first_file_manifest", r"""
SELECT slot, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, min(path) AS first_path FROM fx_manifest GROUP BY 1, 2""")
def l1_first_file_manifest(fx):
    """First file of every directory of each slot."""
    return B.first_file(fx.manifest, group=("slot",))


@query("a5_adjacent_distinct", """
SELECT device_id, seq, msg FROM (
  SELECT device_id, seq, regexp_replace(line, '^.*\\]: ', '') AS msg,
         lag(regexp_replace(line, '^.*\\]: ', '')) OVER (PARTITION BY device_id ORDER BY seq) AS prev
  FROM fx_log) x WHERE prev IS DISTINCT FROM msg""")
def a5_adjacent_distinct(fx):
    """Drop log lines repeating the previous message of the same device."""
    log = fx.log.select("device_id", "seq", F.regexp_replace("line", r"^.*\]: ", "").alias("msg"))
    return B.adjacent_distinct(log, "msg", order=("seq",))


@query("a5_entry_lines", r"""
SELECT device_id, ord, uki FROM (
  SELECT device_id, ord, uki, lag(uki) OVER (PARTITION BY device_id ORDER BY ord) AS prev
  FROM (SELECT device_id, ord, nullif(regexp_extract(line, '([A-Za-z0-9._-]+\.efi)', 1), '') AS uki FROM fx_boot_line) n
  WHERE uki IS NOT NULL) x WHERE prev IS DISTINCT FROM uki""")
def a5_entry_lines(fx):
    """Where each boot entry begins: runs of lines that name one image, folded to their first."""
    return B.entry_lines(fx.boot_line)
