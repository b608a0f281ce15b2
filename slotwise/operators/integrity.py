"""Image integrity and write gates: checksums, ids, space, command trust."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise import constants as K
from slotwise.functions import columns as C

IMAGE_SALTS = 16


def verify_checksum(images: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """``missing input`` / ``malformed`` / ``not read`` / ``mismatch`` / ``ok`` per image.

    ``not read`` is an image without a body (too large for one value, see
    ``read_images``): it never passes for verified.  Images of any size are
    verified from their files by :func:`verify_files`.

    ``images(image_id, path, body[, expected_sha])``; when ``expected`` is
    given it supplies ``(image_id, expected_sha)`` by a left join.  The digest
    is computed where the body is read (no shuffle of bodies); the comparison
    is case-sensitive, after one trailing blank of the expected digest is
    removed.
    """
    if expected is not None:
        images = images.drop("expected_sha").join(expected.select("image_id", "expected_sha"), "image_id", "left")
    return images.select("image_id", "path", checksum_verdict().alias("verdict"))


def verify_files(images: DataFrame, files: DataFrame) -> DataFrame:
    """J1 over image files of any size: the verdict of :func:`verify_checksum` per image.

    ``images(image_id, path, expected_sha)`` joins ``files(path, sha256)``, the
    digests of the files that exist (``sources.digests.image_digests``); an
    image without a file, or whose file could not be read whole, is ``not read``.
    """
    found = images.select("image_id", "path", "expected_sha").join(files.select("path", "sha256"), "path", "left")
    return found.select("image_id", "path", checksum_verdict(digest="sha256").alias("verdict"))


def checksum_verdict(path="path", body="body", expected="expected_sha", digest=None):
    """The J1 verdict as one column expression over ``path, expected_sha`` and ``body``, or a ``digest`` taken before."""
    exp = F.col(expected)
    found = F.col(digest) if digest else F.sha2(F.col(body), 256)
    return (F.when(F.col(path).isNull() | exp.isNull() | (exp == ""), F.lit("missing input"))
             .when(~C.valid_sha(exp), F.lit("malformed"))
             .when(found.isNull(), F.lit("not read"))
             .when(found != C.strip_one_trailing_blank(exp), F.lit("mismatch"))
             .otherwise(F.lit("ok")))


def path_checks(images: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """F1 + F2 + F4 per image: path reason, digest shape, file type.

    ``existing(path)`` is the catalogue of the files that exist; without it a
    well-formed path counts as one.
    """
    exists = None
    if existing is not None:
        known = existing.select("path").distinct().withColumn("exists", F.lit(True))
        images = images.select("image_id", "path", "expected_sha").join(known, "path", "left")
        exists = "exists"
    return images.select(
        "image_id", "path",
        C.valid_path_reason("path", exists).alias("path_reason"),
        C.valid_sha("expected_sha").alias("sha_ok"),
        F.coalesce(C.image_type("path"), F.lit("Invalid File Type")).alias("file_type"),
        F.coalesce(C.is_compressed("path"), F.lit(False)).alias("compressed"))


def staged_ids(staged: DataFrame) -> DataFrame:
    """F11 over staged boot images: ``device_id, staged_id`` (lower case)."""
    return staged.select("device_id", C.lower_id(C.extract_id("content")).alias("staged_id"))


def _id_rows(blkid: DataFrame) -> DataFrame:
    """blkid unpivoted to ``(device_id, dev, id)``; loop copies dropped one by one."""
    return (blkid.where(~F.col("dev").contains("loop"))
                 .select("device_id", "dev",
                         F.explode(F.array_distinct(F.array(C.lower_id("uuid"), C.lower_id("partuuid")))).alias("id"))
                 .where(F.col("id").isNotNull()))


def staged_matches(staged: DataFrame, blkid: DataFrame) -> DataFrame:
    """Non-loop partitions carrying each device's staged id (equi-join on
    ``(device_id, id)``): ``device_id, staged_id, dev``."""
    ids = staged_ids(staged).where(F.col("staged_id").isNotNull())
    return ids.join(C.by_merge(_id_rows(blkid).withColumnRenamed("id", "staged_id")), ["device_id", "staged_id"])


def staged_target(staged: DataFrame, blkid: DataFrame, block: DataFrame) -> DataFrame:
    """First partition (type ``part``, block order) whose id is the staged
    id: ``device_id, staged_id, target, matches``.  No id -> no target (H2)."""
    parts = (block.where(F.col("type") == "part")
                  .select("device_id", F.concat(F.lit("/dev/"), C.clean_name("name")).alias("dev"), "ord"))
    m = (staged_ids(staged)
         .join(C.by_merge(_id_rows(blkid).withColumnRenamed("id", "staged_id")), ["device_id", "staged_id"], "left")
         .join(C.by_merge(parts), ["device_id", "dev"], "left"))
    return m.groupBy("device_id").agg(
        F.max("staged_id").alias("staged_id"),
        F.min_by("dev", F.col("ord")).alias("target"),
        F.count_distinct("dev").cast("long").alias("matches"))


def id_conflict(targets: DataFrame, staged: DataFrame, blkid: DataFrame) -> DataFrame:
    """Is the new id already used?  ``same`` (only by the target itself),
    ``duplicate`` (by another non-loop partition) or ``free``.

    ``targets(device_id, target_block, ...)``: the partition that will carry
    the id; all its columns are passed through, ``staged_id`` and ``verdict``
    are added.  The matching partitions of a device are a handful (bounded by
    its partition table), collected per device.
    """
    ids = staged_ids(staged)
    per = (ids.join(C.by_merge(_id_rows(blkid).withColumnRenamed("id", "staged_id")), ["device_id", "staged_id"], "left")
              .groupBy("device_id")
              .agg(F.max("staged_id").alias("staged_id"), F.collect_set("dev").alias("devs")))
    j = targets.join(C.by_merge(per), "device_id", "left")
    devs = "coalesce(devs, CAST(array() AS array<string>))"
    return j.selectExpr(
        *[f"`{c}`" for c in targets.columns], "staged_id",
        f"CASE WHEN size({devs}) = 0 THEN 'free'"
        f" WHEN size(filter({devs}, d -> NOT (d <=> target_block))) = 0 THEN 'same'"
        " ELSE 'duplicate' END AS verdict")


def per_image(devices: DataFrame, images: DataFrame) -> DataFrame:
    """``devices`` (device_id, image_id, ...) with the columns of their image, if known.

    One release image is assigned to most of a fleet: the devices of an image
    are dealt to ``IMAGE_SALTS`` tasks, each with a copy of the image's row.
    """
    salted = images.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(IMAGE_SALTS - 1))))
    return (devices.withColumn("salt", F.pmod(F.hash("device_id"), F.lit(IMAGE_SALTS)))
                   .join(salted, ["image_id", "salt"], "left").drop("salt"))


def space_check(space: DataFrame, size_mb: int = K.EXPECTED_RAW_SIZE_MB) -> DataFrame:
    """Free KB >= size MB x 1024 (only compressed images need it)."""
    need = F.lit(size_mb * 1024).cast("long")
    return space.select("device_id", "avail_kb", need.alias("required_kb"),
                        (F.col("avail_kb") >= need).alias("enough"))


def image_space(space: DataFrame, assign: DataFrame, images: DataFrame,
                size_mb: int = K.EXPECTED_RAW_SIZE_MB) -> DataFrame:
    """J6 per assigned image: a compressed image needs room to unpack, others
    need none; ``enough`` is NULL for an unknown image."""
    kinds = images.select("image_id", F.coalesce(C.is_compressed("path"), F.lit(False)).alias("compressed"))
    need = F.when(F.col("compressed"), F.lit(size_mb * 1024)).when(~F.col("compressed"), F.lit(0)).cast("long")
    rows = assign.select("device_id", "image_id").join(C.by_merge(space.select("device_id", "avail_kb")), "device_id", "left")
    return (per_image(rows, kinds)
                  .select("device_id", "image_id", "avail_kb", need.alias("required_kb"),
                          (F.coalesce("avail_kb", F.lit(0)) >= need).alias("enough")))


def command_trust(cmds: DataFrame) -> DataFrame:
    """``not found`` / ``no birth date`` / ``no OS birth date`` /
    ``newer than OS`` (later calendar day, UTC) / ``ok``; birth 0 passes."""
    day = lambda c: F.to_date(F.timestamp_seconds(F.col(c)))
    return cmds.select(
        "device_id", "cmd", "path",
        F.when(F.col("path").isNull(), F.lit("not found"))
         .when(F.col("birth_s") < 0, F.lit("no birth date"))
         .when(F.col("os_birth_s") < 0, F.lit("no OS birth date"))
         .when(day("birth_s") > day("os_birth_s"), F.lit("newer than OS"))
         .otherwise(F.lit("ok")).alias("verdict"),
        (F.col("birth_s") == 0).alias("birth_unknown"))
