"""Fleet fixtures: the views of FIXTURES.md section 3.

The SQL below is the dual-dialect text of FIXTURES.md.  ``ORACLE_SQL`` is used
verbatim as CTEs for DuckDB.  The Spark side runs the same text except where the
text multiplies rows by a constant ``CROSS JOIN (VALUES ...)``: there Spark uses
a generator (``LATERAL VIEW explode/inline``), which fans each row out inside
the scan stage instead of planning a nested-loop join.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid

# Fixed fixture definitions (FIXTURES.md section 3), in definition order.
ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["fx_device"] = """
SELECT c_custkey AS device_id,
  CASE WHEN c_custkey % 3 = 0 THEN 'plain' WHEN c_custkey % 3 = 1 THEN 'verity' ELSE 'fde' END AS layout,
  CASE WHEN c_custkey % 2 = 0 THEN 'a' ELSE 'b' END AS act
FROM customer
"""

ORACLE_SQL["fx_block"] = """
SELECT d.device_id, t.ord, t.depth,
  CASE WHEN t.name = 'sda6' AND d.layout = 'plain' AND d.device_id % 17 = 5 THEN 'sda8' ELSE t.name END AS name,
  t.fstype, t.partlabel,
  CASE WHEN t.role = 'efi' THEN '/boot/efi' WHEN t.role = 'data' THEN '/opt'
       WHEN t.role = 'root' AND t.slot = d.act THEN '/' END AS mountpoint,
  CASE WHEN t.depth = 0 THEN 'disk' WHEN t.role = 'loop' THEN 'loop' WHEN t.depth = 1 THEN 'part' ELSE 'crypt' END AS type
FROM fx_device d JOIN (SELECT * FROM (VALUES
  ('plain',0,1,'loop0p2','ext4','rootfs_b','x','loop'), ('plain',1,0,'sda',NULL,NULL,'x','disk'),
  ('plain',2,1,'sda1','vfat','esp','x','efi'), ('plain',3,1,'sda2','ext4','rootfs_a','a','root'),
  ('plain',4,1,'sda3','ext4','edge_persistent','x','data'), ('plain',5,1,'sda6','ext4','rootfs_b','b','root'),
  ('verity',0,1,'loop0p2','ext4','rootfs_b','x','loop'), ('verity',1,0,'sda',NULL,NULL,'x','disk'),
  ('verity',2,1,'sda1','vfat','esp','x','efi'), ('verity',3,1,'sda2','ext4','rootfs_a','a','part'),
  ('verity',4,2,'rootfs-verity','ext4',NULL,'a','root'), ('verity',5,1,'sda3','ext4','edge_persistent','x','data'),
  ('verity',6,1,'sda4','DM_verity_hash','root_a_ver_hash_map','x','map'), ('verity',7,2,'rootfs-verity','ext4',NULL,'a','root'),
  ('verity',8,1,'sda5','DM_verity_hash','root_b_ver_hash_map','x','map'), ('verity',9,2,'rootfs-verity','ext4',NULL,'b','root'),
  ('verity',10,1,'sda6','ext4','rootfs_b','b','part'), ('verity',11,2,'rootfs-verity','ext4',NULL,'b','root'),
  ('verity',12,1,'sda7','ext4','ver_roothash','x','map'),
  ('fde',0,1,'loop0p2','ext4','rootfs_b','x','loop'), ('fde',1,0,'sda',NULL,NULL,'x','disk'),
  ('fde',2,1,'sda1','vfat','esp','x','efi'), ('fde',3,1,'sda2','crypto_LUKS','rootfs_a','a','part'),
  ('fde',4,2,'rootfs_a','ext4',NULL,'x','crypt'), ('fde',5,3,'rootfs-verity','ext4',NULL,'a','root'),
  ('fde',6,1,'sda3','ext4','edge_persistent','x','data'), ('fde',7,1,'sda4','crypto_LUKS','root_a_ver_hash_map','x','map'),
  ('fde',8,2,'root_a_ver_hash_map','DM_verity_hash',NULL,'x','crypt'), ('fde',9,3,'rootfs-verity','ext4',NULL,'a','root'),
  ('fde',10,1,'sda5','crypto_LUKS','root_b_ver_hash_map','x','map'), ('fde',11,2,'root_b_ver_hash_map','DM_verity_hash',NULL,'x','crypt'),
  ('fde',12,3,'rootfs-verity','ext4',NULL,'b','root'), ('fde',13,1,'sda6','crypto_LUKS','rootfs_b','b','part'),
  ('fde',14,2,'rootfs_b','ext4',NULL,'x','crypt'), ('fde',15,3,'rootfs-verity','ext4',NULL,'b','root'),
  ('fde',16,1,'sda7','crypto_LUKS','ver_roothash','x','map')
) AS v(layout, ord, depth, name, fstype, partlabel, slot, role)) t ON d.layout = t.layout
WHERE (t.role <> 'loop' OR d.device_id % 11 = 3) AND NOT (t.role = 'root' AND t.depth >= 2 AND t.slot <> d.act)
"""

ORACLE_SQL["fx_blkid"] = """
SELECT device_id, dev,
  substr(u,1,8) || '-' || substr(u,9,4) || '-' || substr(u,13,4) || '-' || substr(u,17,4) || '-' || substr(u,21,12) AS uuid,
  substr(p,1,8) || '-' || substr(p,9,4) || '-' || substr(p,13,4) || '-' || substr(p,17,4) || '-' || substr(p,21,12) AS partuuid
FROM (SELECT device_id, '/dev/' || name AS dev,
        md5(CAST(device_id AS STRING) || ':fs:' || CASE WHEN name = 'loop0p2' THEN 'sda6' ELSE name END) AS u,
        md5(CAST(device_id AS STRING) || ':pu:' || CASE WHEN name = 'sda3' AND (device_id % 19 = 7 OR device_id % 9 = 3) THEN 'sda2'
          WHEN name = 'loop0p2' THEN 'sda6' ELSE name END) AS p
      FROM fx_block WHERE depth = 1) x
"""

ORACLE_SQL["fx_boot_line"] = """
SELECT e.device_id, e.base + t.k AS ord,
  CASE WHEN t.k = 1 THEN '  title: Edge OS' WHEN t.k = 2 THEN '     id: ' || e.uki
       WHEN t.k = 3 THEN ' source: /boot/efi/EFI/Linux/' || e.uki WHEN t.k = 4 THEN '  linux: ' || e.uki
       WHEN e.device_id % 20 = 4 THEN 'options: quiet boot_uuid=ffffffff-ffff-4fff-8fff-ffffffffffff ro'
       WHEN e.layout = 'plain' AND e.device_id % 5 <> 0 THEN 'options: quiet root=PARTUUID=' || e.partuuid || ' ro'
       WHEN e.layout = 'plain' THEN 'options: quiet boot_uuid=' || e.partuuid || ' ro'
       ELSE 'options: quiet boot_uuid=' || e.uuid || ' ro' END AS line
FROM (SELECT d.device_id, d.layout, s.base, s.uki, b.uuid, b.partuuid
      FROM fx_device d JOIN fx_blkid b ON b.device_id = d.device_id
      JOIN (SELECT * FROM (VALUES ('/dev/sda2',0,'linux.efi'), ('/dev/sda6',5,'linux-2.efi'), ('/dev/sda8',5,'linux-2.efi')) AS v(dev, base, uki)) s
        ON b.dev = s.dev) e
CROSS JOIN (SELECT * FROM (VALUES (1),(2),(3),(4),(5)) AS v(k)) t
"""

ORACLE_SQL["fx_crypt"] = """
SELECT device_id, name AS target FROM fx_block
WHERE depth = 2 AND name <> 'rootfs-verity' AND NOT (name = 'rootfs_b' AND device_id % 23 = 2)
"""

ORACLE_SQL["fx_staged"] = """
SELECT d.device_id, CASE WHEN d.device_id % 8 = 3 THEN 'x boot_uuid=00000000-0000-4000-8000-' || substr(md5(CAST(d.device_id AS STRING)),1,12) || ' ro '
    WHEN d.layout = 'plain' AND d.device_id % 5 <> 0 THEN 'x PARTUUID=' || CASE WHEN d.device_id % 8 = 4 THEN upper(b.partuuid) ELSE b.partuuid END || ' ro '
    WHEN d.layout = 'plain' THEN 'x boot_uuid=' || b.partuuid || ' ro '
    ELSE 'x boot_uuid=' || CASE WHEN d.device_id % 8 = 4 THEN upper(b.uuid) ELSE b.uuid END || ' ro ' END AS content
FROM fx_device d JOIN fx_blkid b ON b.device_id = d.device_id
WHERE d.device_id % 7 <> 0 AND ((d.act = 'b' AND b.dev = '/dev/sda2') OR (d.act = 'a' AND (b.dev = '/dev/sda6' OR b.dev = '/dev/sda8')))
"""

ORACLE_SQL["fx_image"] = """
SELECT doc_id AS image_id,
  '/img/' || lang || '/' || CASE WHEN doc_id % 37 = 0 THEN 'os image' ELSE 'os-' END || CAST(doc_id AS STRING)
    || CASE WHEN doc_id % 4 = 0 THEN '.raw.xz' WHEN doc_id % 4 = 1 THEN '.raw.gz' WHEN doc_id % 4 = 2 THEN '.raw' ELSE '.iso' END AS path,
  text AS body,
  CASE WHEN doc_id % 13 = 0 THEN md5(text) || md5(text) WHEN doc_id % 17 = 0 THEN md5(text)
       WHEN doc_id % 31 = 0 THEN NULL WHEN doc_id % 29 = 0 THEN upper(__SHA256__(text)) ELSE __SHA256__(text) END AS expected_sha
FROM documents
"""

ORACLE_SQL["fx_run"] = """
SELECT event_id AS run_id, user_id AS device_id, event_id % 500 AS image_id,
  CASE event_id % 14 WHEN 0 THEN '-v' WHEN 1 THEN '-a' WHEN 2 THEN '-c' WHEN 3 THEN '-r' WHEN 4 THEN '-w -u /img/os.raw'
    WHEN 5 THEN '-w -u' WHEN 6 THEN '-w -u /img/os.raw.xz -s ' || md5(props) || md5(event_type) || ' -a --debug'
    WHEN 7 THEN '-w -u /img/os.raw -s ' || md5(props) WHEN 8 THEN '' WHEN 9 THEN '-h -r' WHEN 10 THEN '-v -a -c'
    WHEN 11 THEN '--dev -w -u /img/a;b.raw -r' WHEN 12 THEN '-w -u /img/none.raw' ELSE '--debug' END AS argv,
  ts AS start_ts, ts + (CAST(floor(value) AS BIGINT) + 1) * INTERVAL '1' MINUTE AS end_ts
FROM events
"""

ORACLE_SQL["fx_path"] = """
SELECT path FROM (VALUES ('/img/os.raw'), ('/img/os.raw.xz')) AS v(path)
"""

ORACLE_SQL["fx_assign"] = """
SELECT c_custkey AS device_id, c_custkey % 200 AS image_id FROM customer
"""

ORACLE_SQL["fx_action"] = """
SELECT user_id AS device_id, event_id AS seq, ts,
  CASE WHEN event_type = 'signup' THEN 'write' WHEN event_type = 'click' THEN 'apply' WHEN event_type = 'view' THEN 'reboot'
       WHEN event_type = 'purchase' THEN 'commit' ELSE 'fail' END AS action
FROM events
"""

ORACLE_SQL["fx_log"] = """
SELECT user_id AS device_id, event_id AS seq,
  CASE WHEN event_id % 9 = 0 THEN '' ELSE replace(CAST(date_trunc('second', ts) AS STRING), ' ', 'T') || '+00:00' END
  || CASE WHEN event_type = 'error' THEN ' ' || chr(27) || '[31m[ERROR]' || chr(27) || '[0m: '
          WHEN event_type = 'view' THEN ' ' || chr(27) || '[93m[WARN]' || chr(27) || '[0m: '
          WHEN event_type = 'click' THEN ' [DEBUG]: ' ELSE ' [INFO]: ' END
  || CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'Failed write image.' WHEN event_type = 'error' THEN 'Failed to commit update OS.'
          WHEN event_type = 'signup' THEN 'Write Image.' WHEN event_type = 'purchase' THEN 'Commit update.' ELSE 'Apply updates.' END AS line
FROM events
"""

ORACLE_SQL["fx_config_line"] = """
SELECT s.s_suppkey AS device_id, t.seq,
  CASE WHEN t.seq = 9 THEN 'TEMPDATA=/tmp/run.' || CAST(s.s_suppkey AS STRING)
       WHEN t.seq = 10 AND s.s_suppkey % 6 = 1 THEN 'UNKNOWN=1' WHEN t.seq = 10 AND s.s_suppkey % 6 = 2 THEN 'TARGETDEV=/dev/sda2;id'
       WHEN t.seq = 10 THEN 'TARGETDEV=/dev/sda6' ELSE t.line END AS line
FROM supplier s CROSS JOIN (SELECT * FROM (VALUES
  (1,'# image preparation'), (2,''), (3,'EXPECTEDRAWSIZE=2500'), (4,'TEMPDATA="/opt/OS/abupdate"'), (5,'RAWSOURCE="$TEMPDATA/source.raw"'),
  (6,'DESTCOPY="$TEMPDATA/destos"'), (7,'DEBUG=false'), (8,'TARGETDEV=""'), (9,'x'), (10,'x')) AS v(seq, line)) t
"""

ORACLE_SQL["fx_image_id_line"] = """
SELECT c.c_custkey AS device_id, t.ord,
  CASE WHEN t.ord = 1 THEN 'OLD_IMAGE_UUID=none' WHEN c.c_custkey % 12 = 1 THEN 'IMAGE_UUID=' || md5(CAST(c.c_custkey % 7 AS STRING)) || '=x'
       ELSE 'IMAGE_UUID=' || md5(CAST(c.c_custkey % 7 AS STRING)) END AS line
FROM customer c CROSS JOIN (SELECT * FROM (VALUES (1), (2)) AS v(ord)) t
WHERE NOT (t.ord = 2 AND c.c_custkey % 10 = 9)
"""

ORACLE_SQL["fx_manifest"] = """
SELECT s.slot, CASE WHEN d.doc_id % 41 = 0 THEN '/.hidden' WHEN d.doc_id = 1 THEN '/etc/hostname' ELSE '/usr/share/' || d.lang || '/' END
    || CASE WHEN d.doc_id = 1 THEN '' ELSE CAST(d.doc_id AS STRING) END AS path,
  CASE WHEN s.slot = 'b' AND (d.doc_id % 5 = 0 OR d.doc_id = 1) THEN md5('b' || d.text) ELSE md5(d.text) END AS digest
FROM documents d CROSS JOIN (SELECT * FROM (VALUES ('a'), ('b')) AS v(slot)) s
WHERE NOT (s.slot = 'a' AND d.doc_id % 10 = 3) AND NOT (s.slot = 'b' AND d.doc_id % 7 = 2)
"""

ORACLE_SQL["fx_command"] = """
SELECT s.s_suppkey AS device_id, t.cmd,
  CASE WHEN (s.s_suppkey + t.k) % 10 = 5 THEN NULL ELSE '/usr/bin/' || t.cmd END AS path,
  CAST(CASE WHEN (s.s_suppkey + t.k) % 10 = 1 THEN 1704153600 WHEN (s.s_suppkey + t.k) % 10 = 2 THEN 1704110400
       WHEN (s.s_suppkey + t.k) % 10 = 3 THEN -1 WHEN (s.s_suppkey + t.k) % 10 = 4 THEN 0 ELSE 1704067000 END AS BIGINT) AS birth_s,
  CAST(1704067200 AS BIGINT) AS os_birth_s
FROM supplier s CROSS JOIN (SELECT * FROM (VALUES (0,'dd'),(1,'lsblk'),(2,'blkid'),(3,'bootctl'),(4,'xz'),(5,'gzip')) AS v(k, cmd)) t
"""

ORACLE_SQL["fx_space"] = """
SELECT c_custkey AS device_id, CAST(floor(c_acctbal) AS BIGINT) * 512 AS avail_kb FROM customer
"""

# Spark text where it differs: constant fan-outs become generators.
SPARK_SQL: dict[str, str] = dict(ORACLE_SQL)

SPARK_SQL["fx_boot_line"] = """
SELECT e.device_id, e.base + t.k AS ord,
  CASE WHEN t.k = 1 THEN '  title: Edge OS' WHEN t.k = 2 THEN '     id: ' || e.uki
       WHEN t.k = 3 THEN ' source: /boot/efi/EFI/Linux/' || e.uki WHEN t.k = 4 THEN '  linux: ' || e.uki
       WHEN e.device_id % 20 = 4 THEN 'options: quiet boot_uuid=ffffffff-ffff-4fff-8fff-ffffffffffff ro'
       WHEN e.layout = 'plain' AND e.device_id % 5 <> 0 THEN 'options: quiet root=PARTUUID=' || e.partuuid || ' ro'
       WHEN e.layout = 'plain' THEN 'options: quiet boot_uuid=' || e.partuuid || ' ro'
       ELSE 'options: quiet boot_uuid=' || e.uuid || ' ro' END AS line
FROM (SELECT d.device_id, d.layout, s.base, s.uki, b.uuid, b.partuuid
      FROM fx_device d JOIN fx_blkid b ON b.device_id = d.device_id
      JOIN (SELECT * FROM (VALUES ('/dev/sda2',0,'linux.efi'), ('/dev/sda6',5,'linux-2.efi'), ('/dev/sda8',5,'linux-2.efi')) AS v(dev, base, uki)) s
        ON b.dev = s.dev) e
LATERAL VIEW explode(array(1, 2, 3, 4, 5)) t AS k
"""

SPARK_SQL["fx_config_line"] = """
SELECT s.s_suppkey AS device_id, t.seq,
  CASE WHEN t.seq = 9 THEN 'TEMPDATA=/tmp/run.' || CAST(s.s_suppkey AS STRING)
       WHEN t.seq = 10 AND s.s_suppkey % 6 = 1 THEN 'UNKNOWN=1' WHEN t.seq = 10 AND s.s_suppkey % 6 = 2 THEN 'TARGETDEV=/dev/sda2;id'
       WHEN t.seq = 10 THEN 'TARGETDEV=/dev/sda6' ELSE t.line END AS line
FROM supplier s LATERAL VIEW inline(array(
  named_struct('seq', 1, 'line', '# image preparation'), named_struct('seq', 2, 'line', ''),
  named_struct('seq', 3, 'line', 'EXPECTEDRAWSIZE=2500'), named_struct('seq', 4, 'line', 'TEMPDATA="/opt/OS/abupdate"'),
  named_struct('seq', 5, 'line', 'RAWSOURCE="$TEMPDATA/source.raw"'), named_struct('seq', 6, 'line', 'DESTCOPY="$TEMPDATA/destos"'),
  named_struct('seq', 7, 'line', 'DEBUG=false'), named_struct('seq', 8, 'line', 'TARGETDEV=""'),
  named_struct('seq', 9, 'line', 'x'), named_struct('seq', 10, 'line', 'x'))) t AS seq, line
"""

SPARK_SQL["fx_image_id_line"] = """
SELECT c.c_custkey AS device_id, t.ord,
  CASE WHEN t.ord = 1 THEN 'OLD_IMAGE_UUID=none' WHEN c.c_custkey % 12 = 1 THEN 'IMAGE_UUID=' || md5(CAST(c.c_custkey % 7 AS STRING)) || '=x'
       ELSE 'IMAGE_UUID=' || md5(CAST(c.c_custkey % 7 AS STRING)) END AS line
FROM customer c LATERAL VIEW explode(array(1, 2)) t AS ord
WHERE NOT (t.ord = 2 AND c.c_custkey % 10 = 9)
"""

SPARK_SQL["fx_manifest"] = """
SELECT s.slot, CASE WHEN d.doc_id % 41 = 0 THEN '/.hidden' WHEN d.doc_id = 1 THEN '/etc/hostname' ELSE '/usr/share/' || d.lang || '/' END
    || CASE WHEN d.doc_id = 1 THEN '' ELSE CAST(d.doc_id AS STRING) END AS path,
  CASE WHEN s.slot = 'b' AND (d.doc_id % 5 = 0 OR d.doc_id = 1) THEN md5('b' || d.text) ELSE md5(d.text) END AS digest
FROM documents d LATERAL VIEW explode(array('a', 'b')) s AS slot
WHERE NOT (s.slot = 'a' AND d.doc_id % 10 = 3) AND NOT (s.slot = 'b' AND d.doc_id % 7 = 2)
"""

SPARK_SQL["fx_command"] = """
SELECT s.s_suppkey AS device_id, t.cmd,
  CASE WHEN (s.s_suppkey + t.k) % 10 = 5 THEN NULL ELSE '/usr/bin/' || t.cmd END AS path,
  CAST(CASE WHEN (s.s_suppkey + t.k) % 10 = 1 THEN 1704153600 WHEN (s.s_suppkey + t.k) % 10 = 2 THEN 1704110400
       WHEN (s.s_suppkey + t.k) % 10 = 3 THEN -1 WHEN (s.s_suppkey + t.k) % 10 = 4 THEN 0 ELSE 1704067000 END AS BIGINT) AS birth_s,
  CAST(1704067200 AS BIGINT) AS os_birth_s
FROM supplier s LATERAL VIEW inline(array(
  named_struct('k', 0, 'cmd', 'dd'), named_struct('k', 1, 'cmd', 'lsblk'), named_struct('k', 2, 'cmd', 'blkid'),
  named_struct('k', 3, 'cmd', 'bootctl'), named_struct('k', 4, 'cmd', 'xz'), named_struct('k', 5, 'cmd', 'gzip'))) t AS k, cmd
"""

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

_SHA_TOKEN = "__SHA256__"


def _dialect(sql: str, engine: str) -> str:
    """Resolve the one dialect token: ``__SHA256__(x)``."""
    repl = r"sha2(\1, 256)" if engine == "spark" else r"sha256(\1)"
    return re.sub(_SHA_TOKEN + r"\(([^()]*)\)", repl, sql)


def _deps(name: str) -> list[str]:
    """Fixture views a fixture reads, in definition order."""
    text = ORACLE_SQL[name]
    return [n for n in ORACLE_SQL if n != name and re.search(rf"\b{n}\b", text)]


def closure(names) -> list[str]:
    """All fixture views needed by ``names``, in definition order."""
    need: set[str] = set()
    stack = list(names)
    while stack:
        n = stack.pop()
        if n in need:
            continue
        need.add(n)
        stack.extend(_deps(n))
    return [n for n in ORACLE_SQL if n in need]


def oracle_with(sql: str) -> str:
    """Prefix ``sql`` with the fixture CTEs it references (DuckDB dialect)."""
    used = [n for n in ORACLE_SQL if re.search(rf"\b{n}\b", sql)]
    ctes = [f"{n} AS ({_dialect(ORACLE_SQL[n], 'duckdb').strip()})" for n in closure(used)]
    body = sql.strip()
    if not ctes:
        return body
    head = "WITH "
    m = re.match(r"(?is)^WITH\s+(RECURSIVE\s+)?", body)
    if m:
        # splice the fixture CTEs in front of the query's own CTE list
        head = "WITH RECURSIVE " if m.group(1) else "WITH "
        return head + ",\n".join(ctes) + ",\n" + body[m.end():]
    return head + ",\n".join(ctes) + "\n" + body


# per session: the scale directory, its identity, and the fixtures whose views stand
_REGISTERED: dict[int, tuple[str, str, set[str]]] = {}


def _source_files(spark, sf_dir: str) -> list[tuple[str, int, int]]:
    """(path, bytes, modification time) of every file of the base tables, from the file system that holds them."""
    root, fs = _fs(spark, sf_dir)
    names = {f"{t}.parquet" for t in BASE_TABLES}
    out, todo = [], [st for st in fs.listStatus(root) if st.getPath().getName() in names]   # one listing, most often
    while todo:
        st = todo.pop()
        if st.isDirectory():
            todo.extend(fs.listStatus(st.getPath()))
        else:
            out.append((st.getPath().toString(), st.getLen(), st.getModificationTime()))
    return sorted(out)


def _source_key(spark, sf_dir: str) -> str:
    """Identity of a scale directory: path, size and modification time of each file."""
    parts = "|".join(":".join(map(str, f)) for f in _source_files(spark, sf_dir))
    return hashlib.sha256(f"{sf_dir}|{parts}".encode()).hexdigest()[:16]


MIN_BUCKETS = 8
BUCKET_BYTES = 8 << 20       # input bytes per bucket, compressed: a bucket's rows, in memory, are many times that
# Event histories: unbounded per device, so never bucketed by device (a hot
# device would become one bucket file and one scan task); stored in time order.
HISTORY_TABLES = {"fx_run": "start_ts", "fx_action": "ts", "fx_log": "seq"}


def register(spark, sf_dir: str, materialize: bool = True, buckets: int | None = None, names=None) -> None:
    """Register the base tables of ``sf_dir`` and fixtures (``names`` and what they read; all of them if None) as temp views.

    Fixtures are device inventories in production, i.e. stored tables.  With
    ``materialize`` each fixture is derived once by Spark from the base
    tables and stored as Parquet in the shared folder of
    ``spark.checkpoint.dir`` (keyed by the source files), when it is first
    asked for: a query pays for the inventories it reads and for no others.
    Tables keyed by device are stored *bucketed by device_id* (``buckets``
    buckets, one sorted file each), the layout a fleet inventory should have:
    windows, aggregations and joins on ``device_id`` then read co-partitioned
    data and need no shuffle.
    """
    key = id(spark)
    # Times in the inputs are UTC wall times (timestamp_ntz); day boundaries,
    # epoch conversions and log offsets are all judged in UTC.
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    src_key = _source_key(spark, sf_dir)
    if _REGISTERED.get(key, ())[:2] != (sf_dir, src_key) or not spark.catalog.tableExists(BASE_TABLES[-1]):
        for n in ORACLE_SQL:    # views of another directory
            spark.catalog.dropTempView(n)
        for t in BASE_TABLES:
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
        _REGISTERED[key] = (sf_dir, src_key, set())
    done = _REGISTERED[key][2]
    todo = [n for n in closure(ORACLE_SQL if names is None else names) if n not in done]
    if not todo:
        return
    nb = _buckets(spark, sf_dir, buckets)
    base = fixture_dir(spark, sf_dir, nb) if materialize else None
    for n in todo:
        df = spark.sql(_dialect(SPARK_SQL[n], "spark"))
        if base is not None:
            df = _stored(spark, df, n, f"{base}/{n}", nb, src_key)
        df.createOrReplaceTempView(n)
        done.add(n)


def _stored(spark, df, name: str, path: str, nb: int, src_key: str):
    """Store ``df`` once at ``path`` and return a DataFrame reading it.

    Written to a private folder first and published by an atomic rename, so
    sessions racing on the same shared folder never see a half-written table
    (the loser drops its copy).
    """
    bucketed = "device_id" in df.columns and name not in HISTORY_TABLES
    table = f"slotwise_{name}_{src_key}_b{nb}"
    if not _exists(spark, f"{path}/_SUCCESS"):
        tmp = f"{path}.tmp-{uuid.uuid4().hex}"
        if bucketed:
            tmp_table = f"{table}_tmp_{uuid.uuid4().hex[:8]}"
            (df.repartition(nb, "device_id").write.mode("overwrite")
               .bucketBy(nb, "device_id").sortBy("device_id")
               .option("path", tmp).saveAsTable(tmp_table))
            spark.sql(f"DROP TABLE IF EXISTS {tmp_table}")      # external: files stay
        else:
            if name in HISTORY_TABLES:
                df = df.repartitionByRange(nb, HISTORY_TABLES[name]).sortWithinPartitions(HISTORY_TABLES[name])
            else:
                df = df.repartition(nb)
            df.write.mode("overwrite").parquet(tmp)
        if not _rename(spark, tmp, path):
            _delete(spark, tmp)
    if not bucketed:
        return spark.read.parquet(path)
    if not spark.catalog.tableExists(table):
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet CLUSTERED BY (device_id) "
                  f"SORTED BY (device_id) INTO {nb} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def _fs(spark, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _rename(spark, src: str, dst: str) -> bool:
    s, fs = _fs(spark, src)
    d, _ = _fs(spark, dst)
    if fs.exists(d):
        return False
    return bool(fs.rename(s, d))


def _delete(spark, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def _buckets(spark, sf_dir: str, buckets: int | None = None) -> int:
    """Buckets of the stored fixtures: as set, else by the size of the input, without a cap."""
    told = buckets or spark.conf.get("slotwise.buckets", None) or os.environ.get("SLOTWISE_BUCKETS")
    return int(told) if told else max(MIN_BUCKETS, -(-sum(f[1] for f in _source_files(spark, sf_dir)) // BUCKET_BYTES))


def fixture_dir(spark, sf_dir: str, buckets: int | None = None) -> str:
    """Folder of the stored fixture tables of ``sf_dir`` (one sub-folder each)."""
    from slotwise.session import checkpoint_dir
    nb = _buckets(spark, sf_dir, buckets)
    return f"{checkpoint_dir(spark).rstrip('/')}/slotwise-fixtures/{_source_key(spark, sf_dir)}-b{nb}-v2"


def _exists(spark, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


class Fleet:
    """Fixture DataFrames of one scale directory (temp views, registered when asked for)."""

    def __init__(self, spark, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        register(spark, sf_dir, names=())

    def __getattr__(self, name: str):
        key = name if name.startswith("fx_") else f"fx_{name}"
        if key in ORACLE_SQL or name in BASE_TABLES:
            register(self.spark, self.sf_dir, names=[key] if key in ORACLE_SQL else ())
            return self.spark.table(key if key in ORACLE_SQL else name)
        raise AttributeError(name)
