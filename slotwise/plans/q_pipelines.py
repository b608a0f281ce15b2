"""Pipeline queries Q1-Q4."""

from __future__ import annotations

from slotwise.plans import pipelines as P
from slotwise.plans.catalog import query
from slotwise.plans.q_boot import BOOT_TAIL
from slotwise.plans.q_integrity import FILE_TYPE, FILE_VERDICT, HAS_FILE, SHA_OK, STAGED_SQL, VERDICT, published
from slotwise.plans.q_topology import INACTIVE_SQL, SCAN_SQL

FULL_SQL = INACTIVE_SQL + BOOT_TAIL + "," + STAGED_SQL


@query("q1_fleet_status", SCAN_SQL + """,
img AS (SELECT device_id, split_part(line, '=', 2) AS image_uuid,
               row_number() OVER (PARTITION BY device_id ORDER BY ord) AS rn
        FROM fx_image_id_line WHERE starts_with(line, 'IMAGE_UUID='))
SELECT a.device_id, a.mode, a.active, i.image_uuid FROM act a LEFT JOIN img i ON i.device_id = a.device_id AND i.rn = 1""")
def q1_fleet_status(fx):
    """Which slot each device runs, in which mode, with which image id."""
    return P.fleet_status(fx.block, fx.crypt, fx.image_id_line)


Q2_SQL = FULL_SQL + f""",
ig AS (SELECT image_id, path,
         CASE WHEN path IS NULL OR path = '' THEN 'empty' WHEN NOT regexp_matches(path, '^[a-zA-Z0-9._/-]+$') THEN 'invalid characters' END AS path_reason,
         {SHA_OK} AS sha_ok, expected_sha IS NOT NULL AND expected_sha <> '' AS has_sha, {VERDICT} AS verdict,
         COALESCE({FILE_TYPE}, 'Invalid File Type') AS file_type, COALESCE({FILE_TYPE} IN ('xz', 'gz'), false) AS compressed
       FROM fx_image),
q2 AS (SELECT a.device_id, a.image_id,
         CASE WHEN g.path_reason IS NOT NULL OR g.path IS NULL THEN 'bad path'
              WHEN COALESCE(g.has_sha AND NOT g.sha_ok, false) THEN 'malformed digest'
              WHEN COALESCE(g.verdict IN ('missing input', 'not read', 'mismatch'), false) THEN 'checksum'
              WHEN t.target IS NULL OR t.error IS NOT NULL THEN 'no target'
              WHEN COALESCE(g.file_type = 'Invalid File Type', false) THEN 'file type'
              WHEN COALESCE(g.compressed AND NOT COALESCE(s.avail_kb >= 2500 * 1024, false), false) THEN 'space'
              WHEN COALESCE(c.verdict = 'duplicate', false) THEN 'id conflict'
              ELSE 'ready' END AS gate
       FROM fx_assign a LEFT JOIN ig g ON g.image_id = a.image_id
       LEFT JOIN wtb t ON t.device_id = a.device_id
       LEFT JOIN fx_space s ON s.device_id = a.device_id
       LEFT JOIN j5 c ON c.device_id = a.device_id)
SELECT device_id, image_id, gate,
  CASE gate WHEN 'ready' THEN 0 WHEN 'checksum' THEN 3 WHEN 'file type' THEN 3 WHEN 'id conflict' THEN 3 ELSE 1 END AS exit_code
FROM q2"""


@query("q2_write_readiness", Q2_SQL)
def q2_write_readiness(fx):
    """First failing gate of a write for every device and its assigned image."""
    return P.write_readiness(fx.assign, fx.image, fx.space, fx.staged, fx.block, fx.blkid, fx.crypt)


FILES_SQL = Q2_SQL.replace("'invalid characters' END AS path_reason",
                           f"'invalid characters' WHEN NOT {HAS_FILE} THEN 'does not exist' END AS path_reason").replace(VERDICT, FILE_VERDICT)


@query("q2_write_readiness_files", FILES_SQL)
def q2_write_readiness_files(fx):
    """Q2 over the image files themselves: a path must name a file, digests are streamed from the files."""
    images, files = published(fx)
    return P.write_readiness(fx.assign, images, fx.space, fx.staged, fx.block, fx.blkid, fx.crypt, files)


@query("q3_apply_plan", FULL_SQL + r"""
SELECT a.device_id, s.target, a.active, u.active_uki,
  CASE WHEN s.target IS NOT NULL AND u.active_uki IS NOT NULL THEN
       CASE WHEN regexp_matches(u.active_uki, '-2\.efi$') THEN 'linux-2.efi' ELSE 'linux.efi' END END AS default_boot,
  CASE WHEN s.target IS NOT NULL AND u.active_uki IS NOT NULL THEN
       CASE WHEN regexp_matches(u.active_uki, '-2\.efi$') THEN 'linux.efi' ELSE 'linux-2.efi' END END AS next_boot,
  CASE WHEN s.target IS NULL THEN 'Nothing to apply.' WHEN u.active_uki IS NULL THEN 'Failed to get active UKI.' END AS reason,
  CASE WHEN s.target IS NULL THEN 1 WHEN u.active_uki IS NULL THEN 3 ELSE 0 END AS exit_code
FROM act a LEFT JOIN j3 u ON u.device_id = a.device_id LEFT JOIN j4 s ON s.device_id = a.device_id""")
def q3_apply_plan(fx):
    return P.apply_plan(fx.staged, fx.blkid, fx.block, fx.crypt, fx.boot_line)


@query("q4_commit_plan", FULL_SQL + r"""
SELECT a.device_id, a.active, u.active_uki,
  CASE WHEN s.device_id IS NOT NULL AND u.active_uki IS NOT NULL THEN
       CASE WHEN regexp_matches(u.active_uki, '-2\.efi$') THEN 'linux-2.efi' ELSE 'linux.efi' END END AS new_default,
  CASE WHEN s.device_id IS NULL THEN 'Nothing to commit.' WHEN u.active_uki IS NULL THEN 'Failed to get active UKI.' END AS reason,
  CASE WHEN s.device_id IS NULL THEN 1 WHEN u.active_uki IS NULL THEN 4 ELSE 0 END AS exit_code
FROM act a LEFT JOIN j3 u ON u.device_id = a.device_id
LEFT JOIN (SELECT DISTINCT device_id FROM fx_staged) s ON s.device_id = a.device_id""")
def q4_commit_plan(fx):
    return P.commit_plan(fx.staged, fx.blkid, fx.block, fx.crypt, fx.boot_line)
