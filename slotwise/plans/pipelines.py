"""User-level entry points: status, write readiness, apply and commit plans.

All device-level inputs are keyed by ``device_id``; every join below is on
that key, so after the first exchange the joins line up on one hash
partitioning.  Image bodies are reduced to a verdict where they are read
(``sha2`` per row) and only the verdict travels to the device join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions import columns as C
from slotwise.operators import boot as B
from slotwise.operators import integrity as I
from slotwise.operators import topology as T
from slotwise.sources import readers as R

# Gate order of a write and the exit code of each failing gate.
WRITE_GATES = (
    ("bad path", 1),
    ("malformed digest", 1),
    ("checksum", 3),
    ("no target", 1),
    ("file type", 3),
    ("space", 1),
    ("id conflict", 3),
)


def fleet_status(block: DataFrame, crypt: DataFrame, image_id_lines: DataFrame) -> DataFrame:
    """Q1: mode, active partition and image id per device (the ``-v`` answer)."""
    return (T.active_partition(block, crypt)
             .join(C.by_merge(R.image_id(image_id_lines)), "device_id", "left")
             .select("device_id", "mode", "active", "image_uuid"))


def image_gates(images: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Per image: path reason (F1), digest shape (F2), checksum verdict (J1) and file type.

    With ``files(path, sha256)``, the files that exist and their digests, a
    well-formed path that names none of them is no path, and verdicts come from
    these digests; without, from the bodies in ``images``, in the scan, and a
    well-formed path counts as a file.
    """
    exp = F.col("expected_sha")
    exists = digest = None
    if files is not None:
        exists, digest = "exists", "sha256"
        known = files.select("path", "sha256", F.lit(True).alias("exists"))
        images = images.select("image_id", "path", "expected_sha").join(known, "path", "left")
    return images.select(
        "image_id", "path",
        C.valid_path_reason("path", exists).alias("path_reason"),
        C.valid_sha(exp).alias("sha_ok"),
        (exp.isNotNull() & (exp != "")).alias("has_sha"),
        I.checksum_verdict(digest=digest).alias("verdict"),
        F.coalesce(C.image_type("path"), F.lit("Invalid File Type")).alias("file_type"),
        F.coalesce(C.is_compressed("path"), F.lit(False)).alias("compressed"))


def write_readiness(assign: DataFrame, images: DataFrame, space: DataFrame, staged: DataFrame,
                    block: DataFrame, blkid: DataFrame, crypt: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Q2: first failing gate of a write per device and its exit code (``files``: see :func:`image_gates`)."""
    # the digest is taken in the scan; from here on an image is a few columns
    gates = image_gates(images, files)
    targets = T.write_target(block, crypt).select("device_id", "target", "error", "target_block")
    conflict = (I.id_conflict(targets, staged, blkid)
                 .select("device_id", "target", "error", F.col("verdict").alias("id_verdict")))
    room = I.space_check(space).select("device_id", "enough")
    # device-keyed tables first: they are co-bucketed, so these joins need no
    # shuffle; only the image-keyed join below moves data
    j = I.per_image(assign.select("device_id", "image_id").join(C.by_merge(conflict), "device_id", "left")
                          .join(C.by_merge(room), "device_id", "left"),
                    gates)
    failed = {   # SQL predicates, one per gate
        "bad path": "path_reason IS NOT NULL OR path IS NULL",
        "malformed digest": "has_sha AND NOT sha_ok",
        "checksum": "verdict IN ('missing input', 'not read', 'mismatch')",
        "no target": "target IS NULL OR error IS NOT NULL",
        "file type": "file_type = 'Invalid File Type'",
        "space": "compressed AND NOT coalesce(enough, false)",
        "id conflict": "id_verdict = 'duplicate'",
    }
    arms = [(f"coalesce({failed[name]}, false)", name, rc) for name, rc in WRITE_GATES]
    gate = "CASE " + " ".join(f"WHEN {c} THEN '{n}'" for c, n, _ in arms) + " ELSE 'ready' END"
    code = "CASE " + " ".join(f"WHEN {c} THEN {rc}" for c, _, rc in arms) + " ELSE 0 END"
    return j.selectExpr("device_id", "image_id", f"{gate} AS gate", f"{code} AS exit_code")


def _active_and_uki(block, crypt, blkid, boot_lines):
    act = T.active_partition(block, crypt)
    return B.active_uki(B.read_boot_entries(boot_lines), act, blkid)


def apply_plan(staged: DataFrame, blkid: DataFrame, block: DataFrame, crypt: DataFrame,
               boot_lines: DataFrame) -> DataFrame:
    """Q3: staged target, active partition and boot image, next default and
    one-shot image, or the reason apply stops."""
    base = _active_and_uki(block, crypt, blkid, boot_lines)
    tgt = I.staged_target(staged, blkid, block).select("device_id", "target")
    j = base.join(C.by_merge(tgt), "device_id", "left")
    reason = (F.when(F.col("target").isNull(), F.lit("Nothing to apply."))
               .when(F.col("active_uki").isNull(), F.lit("Failed to get active UKI.")))
    ok = reason.isNull()
    return j.select(
        "device_id", "target", "active", "active_uki",
        F.when(ok, C.active_boot_image("active_uki")).alias("default_boot"),
        F.when(ok, C.other_boot_image("active_uki")).alias("next_boot"),
        reason.alias("reason"),
        F.when(F.col("target").isNull(), F.lit(1)).when(F.col("active_uki").isNull(), F.lit(3))
         .otherwise(F.lit(0)).alias("exit_code"))


def commit_plan(staged: DataFrame, blkid: DataFrame, block: DataFrame, crypt: DataFrame,
                boot_lines: DataFrame) -> DataFrame:
    """Q4: new default boot image, or why commit stops (exit 1 / 4)."""
    base = _active_and_uki(block, crypt, blkid, boot_lines)
    has = staged.select("device_id", F.lit(True).alias("staged")).dropDuplicates(["device_id"])
    j = base.join(C.by_merge(has), "device_id", "left")
    staged_c = F.coalesce(F.col("staged"), F.lit(False))
    reason = (F.when(~staged_c, F.lit("Nothing to commit."))
               .when(F.col("active_uki").isNull(), F.lit("Failed to get active UKI.")))
    return j.select(
        "device_id", "active", "active_uki",
        F.when(reason.isNull(), C.active_boot_image("active_uki")).alias("new_default"),
        reason.alias("reason"),
        F.when(~staged_c, F.lit(1)).when(F.col("active_uki").isNull(), F.lit(4)).otherwise(F.lit(0)).alias("exit_code"))
