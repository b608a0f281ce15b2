"""Boot entries: which boot image belongs to which partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise.functions import columns as C
from slotwise.operators import scan

CONTEXT_LINES = 5
_EFI_NAME = r"([A-Za-z0-9._-]+\.efi)"


def read_boot_entries(lines: DataFrame, context: int = CONTEXT_LINES) -> DataFrame:
    """S3: ``bootctl list`` lines -> ``device_id, uki, root_partuuid, boot_uuid``.

    A line naming an image opens its context: that line and up to ``context``
    lines after it, cut at the next line naming a different image (H9).  The
    first id of each kind in the context wins.  One window pass per device
    (a boot list is bounded per machine), no join.
    """
    w = Window.partitionBy("device_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    named = C.nullif_empty(F.regexp_extract("line", _EFI_NAME, 1))
    root = C.nullif_empty(F.regexp_extract("line", r"root=PARTUUID=([^ ]+)", 1))
    boot = C.nullif_empty(F.regexp_extract("line", r"boot_uuid=([^ ]+)", 1))
    ctx = (lines.select("device_id", "ord", "line",
                        F.last(named, ignorenulls=True).over(w).alias("uki"),
                        F.last(F.when(named.isNotNull(), F.col("ord")), ignorenulls=True).over(w).alias("head_ord"))
                .where(F.col("uki").isNotNull() & (F.col("ord") - F.col("head_ord") <= context)))
    return ctx.groupBy("device_id", "uki").agg(
        F.min_by(root, F.when(root.isNotNull(), F.col("ord"))).alias("root_partuuid"),
        F.min_by(boot, F.when(boot.isNotNull(), F.col("ord"))).alias("boot_uuid"))


def _entry_vs_partition(entries: DataFrame, active: DataFrame, blkid: DataFrame) -> DataFrame:
    ids = blkid.select("device_id", F.col("dev").alias("active"), "uuid", "partuuid")
    a = active.join(C.by_merge(ids), ["device_id", "active"], "left")
    return a.join(C.by_merge(entries), "device_id", "left")


def _matched() -> "F.Column":
    entry_id = F.when(F.col("mode") == "plain", F.coalesce("root_partuuid", "boot_uuid")).otherwise(F.col("boot_uuid"))
    part_id = F.when(F.col("mode") == "plain", F.col("partuuid")).otherwise(F.col("uuid"))
    return (F.when(part_id.isNull(), F.lit("no partition id"))
             .when(entry_id.isNull(), F.lit("no entry id"))
             .when(entry_id == part_id, F.lit("yes")).otherwise(F.lit("no")))


def uki_matches(entries: DataFrame, active: DataFrame, blkid: DataFrame) -> DataFrame:
    """Does each boot entry point at the device's active partition?

    ``active(device_id, mode, active)``.  plain compares the entry's
    ``root=PARTUUID=`` (else ``boot_uuid=``) with the partition's PARTUUID;
    verity the filesystem UUID, fde the LUKS UUID (blkid ``uuid`` of the LUKS
    partition), both against ``boot_uuid=``.  Result ``yes`` / ``no`` or the
    reason no comparison was possible.
    """
    j = _entry_vs_partition(entries, active, blkid).where(F.col("uki").isNotNull())
    return j.select("device_id", "uki", _matched().alias("matched"))


def active_uki(entries: DataFrame, active: DataFrame, blkid: DataFrame) -> DataFrame:
    """First matching boot image per device in file-name order, or NULL.

    Keeps every column of ``active``; device rows, their partition ids and
    their (few) boot entries meet in one join chain and one aggregation.
    """
    j = _entry_vs_partition(entries, active, blkid)
    return j.groupBy(*active.columns).agg(F.min(F.when(_matched() == "yes", F.col("uki"))).alias("active_uki"))


def adjacent_distinct(rows: DataFrame, value: str, keys: tuple[str, ...] = ("device_id",), order: tuple[str, ...] = ("ord",)) -> DataFrame:
    """A5: ``rows`` without those whose ``value`` equals that of the row before (per ``keys``, in ``order``); the first stays.

    NULL equals NULL.  ``order`` are numbers; the rows of a key may be a long
    history, so they are cut into ranges.  What stands before a row is carried
    as a struct, since the value before may itself be NULL.
    """
    laid = scan.carry_last(scan.ranged(rows, [*keys, *order]), list(keys), list(order), F.struct(value), "__before")
    same = F.col("__before").isNotNull() & F.col("__before")[value].eqNullSafe(F.col(value))
    return laid.where(~same).select(*rows.columns)


def entry_lines(lines: DataFrame) -> DataFrame:
    """The lines that name a boot image, once for each stretch that names the same one: device_id, ord, uki."""
    named = lines.select("device_id", "ord", C.nullif_empty(F.regexp_extract("line", _EFI_NAME, 1)).alias("uki"))
    return adjacent_distinct(named.where(F.col("uki").isNotNull()), "uki")


def first_file(files: DataFrame, path_col: str = "path", group: tuple[str, ...] = ()) -> DataFrame:
    """L1: first file of each directory (per ``group``), the order fixed by
    path; a partial aggregation, never a global sort."""
    d = F.regexp_extract(F.col(path_col), r"^(.*)/[^/]*$", 1)
    return files.groupBy(*group, d.alias("dir")).agg(F.min(path_col).alias("first_path"))
