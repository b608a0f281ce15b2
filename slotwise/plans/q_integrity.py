"""Queries over image integrity and write gates."""

from __future__ import annotations

from slotwise.operators import integrity as I
from slotwise.operators import topology as T
from slotwise.plans.catalog import query
from slotwise.plans.q_topology import INACTIVE_SQL

SHA_OK = "COALESCE(regexp_matches(regexp_replace(expected_sha, ' $', ''), '^[a-fA-F0-9]{64}$'), false)"
FILE_TYPE = ("CASE WHEN ends_with(path, '.xz') THEN 'xz' WHEN ends_with(path, '.gz') THEN 'gz' "
             "WHEN ends_with(path, '.raw') THEN 'raw' END")
VERDICT = f"""CASE WHEN path IS NULL OR expected_sha IS NULL OR expected_sha = '' THEN 'missing input'
     WHEN NOT {SHA_OK} THEN 'malformed'
     WHEN body IS NULL THEN 'not read'
     WHEN sha256(body) <> regexp_replace(expected_sha, ' $', '') THEN 'mismatch' ELSE 'ok' END"""

STAGED_SQL = """
sid AS (SELECT device_id, lower(COALESCE(nullif(regexp_extract(content, 'boot_uuid=(.{36})', 1), ''),
                                         nullif(regexp_extract(content, 'PARTUUID=(.{36})', 1), ''))) AS staged_id
        FROM fx_staged),
ids AS (SELECT DISTINCT device_id, dev, id FROM (
          SELECT device_id, dev, lower(uuid) AS id FROM fx_blkid UNION ALL SELECT device_id, dev, lower(partuuid) FROM fx_blkid) x
        WHERE NOT contains(dev, 'loop') AND id IS NOT NULL),
m AS (SELECT s.device_id, s.staged_id, i.dev FROM sid s JOIN ids i ON i.device_id = s.device_id AND i.id = s.staged_id),
parts AS (SELECT device_id, '/dev/' || nullif(regexp_replace(name, '^[^a-zA-Z0-9]*', ''), '') AS dev, ord FROM fx_block WHERE type = 'part'),
mp AS (SELECT m.device_id, m.dev, p.ord FROM m LEFT JOIN parts p ON p.device_id = m.device_id AND p.dev = m.dev),
firstpart AS (SELECT device_id, dev FROM (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY ord) AS rn
                                           FROM mp WHERE ord IS NOT NULL) x WHERE rn = 1),
j4 AS (SELECT s.device_id, s.staged_id, f.dev AS target, COALESCE(c.n, 0) AS matches
       FROM sid s LEFT JOIN firstpart f ON f.device_id = s.device_id
       LEFT JOIN (SELECT device_id, count(DISTINCT dev) AS n FROM m GROUP BY device_id) c ON c.device_id = s.device_id),
j5 AS (SELECT t.device_id, t.target_block, s.staged_id,
              CASE WHEN NOT EXISTS (SELECT 1 FROM m WHERE m.device_id = t.device_id) THEN 'free'
                   WHEN NOT EXISTS (SELECT 1 FROM m WHERE m.device_id = t.device_id AND m.dev IS DISTINCT FROM t.target_block) THEN 'same'
                   ELSE 'duplicate' END AS verdict
       FROM wtb t LEFT JOIN sid s ON s.device_id = t.device_id)
"""


@query("f1_valid_path", """
SELECT image_id, path, CASE WHEN path IS NULL OR path = '' THEN 'empty'
  WHEN NOT regexp_matches(path, '^[a-zA-Z0-9._/-]+$') THEN 'invalid characters'
  WHEN image_id % 10 = 9 THEN 'does not exist' END AS path_reason
FROM fx_image""")
def f1_valid_path(fx):
    """Every image's path against a file catalogue that lacks one image in ten."""
    existing = fx.image.selectExpr("CASE WHEN image_id % 10 = 9 THEN '/gone' ELSE path END AS path")
    return I.path_checks(fx.image, existing).select("image_id", "path", "path_reason")


@query("f2_valid_sha", f"SELECT image_id, {SHA_OK} AS sha_ok FROM fx_image")
def f2_valid_sha(fx):
    return I.path_checks(fx.image).select("image_id", "sha_ok")


@query("f4_image_type", f"""
SELECT image_id, COALESCE({FILE_TYPE}, 'Invalid File Type') AS file_type,
       COALESCE({FILE_TYPE} IN ('xz', 'gz'), false) AS compressed FROM fx_image""")
def f4_image_type(fx):
    return I.path_checks(fx.image).select("image_id", "file_type", "compressed")


@query("f11_extract_id", "WITH " + STAGED_SQL.split("ids AS")[0].rstrip().rstrip(",") + "\nSELECT device_id, staged_id FROM sid")
def f11_extract_id(fx):
    return I.staged_ids(fx.staged)


@query("j1_verify_checksum", f"SELECT image_id, path, {VERDICT} AS verdict FROM fx_image")
def j1_verify_checksum(fx):
    return I.verify_checksum(fx.image)


@query("j4_staged_target", "WITH " + STAGED_SQL + "SELECT device_id, staged_id, target, matches FROM j4")
def j4_staged_target(fx):
    return I.staged_target(fx.staged, fx.blkid, fx.block)


@query("j5_id_conflict", INACTIVE_SQL + "," + STAGED_SQL + "SELECT device_id, target_block, staged_id, verdict FROM j5")
def j5_id_conflict(fx):
    targets = T.write_target(fx.block, fx.crypt).select("device_id", "target_block")
    return I.id_conflict(targets, fx.staged, fx.blkid)


@query("j6_space_check", """
SELECT device_id, avail_kb, CAST(2500 * 1024 AS BIGINT) AS required_kb, avail_kb >= 2500 * 1024 AS enough FROM fx_space""")
def j6_space_check(fx):
    return I.space_check(fx.space)


@query("j6_image_space", f"""
SELECT a.device_id, a.image_id, s.avail_kb, CAST(CASE WHEN i.compressed THEN 2500 * 1024 WHEN NOT i.compressed THEN 0 END AS BIGINT) AS required_kb,
       COALESCE(s.avail_kb, 0) >= CASE WHEN i.compressed THEN 2500 * 1024 WHEN NOT i.compressed THEN 0 END AS enough
FROM fx_assign a LEFT JOIN fx_space s ON s.device_id = a.device_id
LEFT JOIN (SELECT image_id, COALESCE({FILE_TYPE} IN ('xz', 'gz'), false) AS compressed FROM fx_image) i ON i.image_id = a.image_id""")
def j6_image_space(fx):
    return I.image_space(fx.space, fx.assign, fx.image)


@query("j7_command_trust", """
SELECT device_id, cmd, path,
  CASE WHEN path IS NULL THEN 'not found' WHEN birth_s < 0 THEN 'no birth date' WHEN os_birth_s < 0 THEN 'no OS birth date'
       WHEN floor(birth_s / 86400) > floor(os_birth_s / 86400) THEN 'newer than OS' ELSE 'ok' END AS verdict,
  birth_s = 0 AS birth_unknown
FROM fx_command""")
def j7_command_trust(fx):
    return I.command_trust(fx.command)


@query("s7_read_images", """
SELECT image_id, strlen(body) + 1 AS length, sha256(body) AS sha
FROM fx_image""")
def s7_read_images(fx):
    """Image files: every body written as a file under the shared folder, read
    back with the ``binaryFile`` source; length and digest per file (the text
    writer ends each file with one newline, which the digest leaves out)."""
    from pyspark.sql import functions as F

    from slotwise.session import scratch
    from slotwise.sources import files as W
    from slotwise.sources import readers as R
    root = scratch(fx.spark, "images")
    folders = W.write_files(fx.image.sortWithinPartitions("image_id"), "image_id", "body", root)

    def read(paths):
        files = R.read_images(fx.spark, paths, name_glob="*.txt")
        content = F.expr("substring(content, 1, length(content) - 1)")
        return files.select(W.key_of(F.col("path"), "image_id").cast("long").alias("image_id"),
                            "length", F.sha2(content, 256).alias("sha"))
    return W.read_folders(fx.spark, root, folders, read)


@query("s7_read_gz_images", "SELECT image_id, sha256(body) AS sha FROM fx_image")
def s7_read_gz_images(fx):
    """Compressed images: every body stored gzip-compressed, read back as one
    whole text per file (Spark's codec does the decompression), digested."""
    from pyspark.sql import functions as F

    from slotwise.session import scratch
    from slotwise.sources import files as W
    root = scratch(fx.spark, "gz")
    folders = W.write_files(fx.image.sortWithinPartitions("image_id"), "image_id", "body", root, gz=True)

    def read(paths):
        files = fx.spark.read.option("recursiveFileLookup", "true").text(paths, wholetext=True)
        body = F.expr("substring(value, 1, length(value) - 1)")   # the writer's newline
        return files.select(W.key_of(F.col("_metadata.file_path"), "image_id").cast("long").alias("image_id"), F.sha2(body, 256).alias("sha"))
    return W.read_folders(fx.spark, root, folders, read)


# A file is the body and the line feed of the text writer; one image in 23 has no file.
FILE_SHA = "CASE WHEN expected_sha = sha256(body) THEN sha256(body || chr(10)) ELSE expected_sha END"
HAS_FILE = "image_id % 23 <> 11"
FILE_VERDICT = f"""CASE WHEN path IS NULL OR expected_sha IS NULL OR expected_sha = '' THEN 'missing input'
     WHEN NOT {SHA_OK} THEN 'malformed' WHEN NOT {HAS_FILE} THEN 'not read'
     WHEN sha256(body || chr(10)) <> regexp_replace({FILE_SHA}, ' $', '') THEN 'mismatch' ELSE 'ok' END"""
STREAMED_ABOVE = 2_000      # bytes: most of the files are read block by block


def published(fx):
    """(images, files): the images with the digest of their file, and path and digest of every file found.

    The bodies are written as files under the shared folder and digested there.
    """
    from pyspark.sql import functions as F

    from slotwise.session import scratch
    from slotwise.sources import digests as D
    from slotwise.sources import files as W
    root = scratch(fx.spark, "published")
    folders = W.write_files(fx.image.where(HAS_FILE).sortWithinPartitions("image_id"), "image_id", "body", root)

    def read(paths):
        found = D.image_digests(fx.spark, paths, name_glob="*.txt", one_value=STREAMED_ABOVE, block_bytes=512)
        return found.withColumn("image_id", W.key_of(F.col("path"), "image_id").cast("long"))
    found = W.read_folders(fx.spark, root, folders, read)
    images = fx.image.withColumn("expected_sha", F.expr(FILE_SHA.replace("sha256(body)", "sha2(body, 256)").replace(
        "sha256(body || chr(10))", "sha2(body || chr(10), 256)"))).select("image_id", "path", "expected_sha")
    files = found.select("image_id", "length", "sha256").join(images.select("image_id", "path"), "image_id")
    return images, files


@query("s7_image_digests", f"SELECT image_id, strlen(body) + 1 AS length, sha256(body || chr(10)) AS sha256 FROM fx_image WHERE {HAS_FILE}")
def s7_image_digests(fx):
    """Digests of image files of any size, most of them read block by block."""
    return published(fx)[1].select("image_id", "length", "sha256")


@query("j1_verify_files", f"SELECT image_id, path, {FILE_VERDICT} AS verdict FROM fx_image")
def j1_verify_files(fx):
    """Checksum verdicts of image files of any size."""
    return I.verify_files(*published(fx))
