"""Device topology: modes, active and inactive slots, parents, duplicate ids.

Inputs are one snapshot per device: ``block(device_id, ord, depth, name,
fstype, partlabel, mountpoint, type)`` (lsblk rows in their printed order),
``crypt(device_id, target)`` and ``blkid(device_id, dev, uuid, partuuid)``.
A device's snapshot is bounded by its hardware (a few dozen rows), so the
windows here partition by ``device_id`` alone; all of them share one
partitioning and one sort, i.e. one shuffle for the whole topology pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise import constants as K
from slotwise.functions import columns as C


def _before():
    """Rows of the same device before the current one (windows need a session,
    so they are built on use, not at import)."""
    return Window.partitionBy("device_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)


def _first_by_ord(value: Column, cond: Column) -> Column:
    """Value of the first row (lowest ``ord``) where ``cond`` holds."""
    return F.min_by(value, F.when(cond, F.col("ord")))


_CNAME = "nullif(regexp_replace(name, '^[^a-zA-Z0-9]*', ''), '')"
_BEFORE_SQL = "OVER (PARTITION BY device_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def with_scan_columns(block: DataFrame) -> DataFrame:
    """Carry-forward columns every slot finder needs, in one window pass.

    ``prev_name``: last non-empty name before the row (any depth);
    ``prev_top``: last top-level name (depth <= 1) before the row;
    ``prev_sub``: last sub-volume name (depth >= 2) before the row.
    (Written as SQL expressions: one driver round trip per column.)
    """
    return block.selectExpr(
        "*", f"{_CNAME} AS cname",
        f"last({_CNAME}, true) {_BEFORE_SQL} AS prev_name",
        f"last(CASE WHEN depth <= 1 THEN {_CNAME} END, true) {_BEFORE_SQL} AS prev_top",
        f"last(CASE WHEN depth >= 2 THEN {_CNAME} END, true) {_BEFORE_SQL} AS prev_sub")


def _dev(name: Column) -> Column:
    return F.concat(F.lit("/dev/"), name)


# --- modes ------------------------------------------------------------------

def is_fde(crypt: DataFrame, devices: DataFrame) -> DataFrame:
    """A1: both ``rootfs_a`` and ``rootfs_b`` among a device's crypt targets."""
    agg = (crypt.groupBy("device_id")
                .agg((F.bool_or(F.col("target").contains("rootfs_a"))
                      & F.bool_or(F.col("target").contains("rootfs_b"))).alias("is_fde")))
    return (devices.select("device_id").join(C.by_merge(agg), "device_id", "left")
                   .select("device_id", F.coalesce("is_fde", F.lit(False)).alias("is_fde")))


def is_verity(block: DataFrame) -> DataFrame:
    """A2: two or more rows mounted at ``/``."""
    return block.groupBy("device_id").agg(
        (F.count_if(F.col("mountpoint") == "/") >= 2).alias("is_verity"))


def device_mode(block: DataFrame, crypt: DataFrame) -> DataFrame:
    """A3: ``fde`` first, then ``verity``, else ``plain``."""
    verity = is_verity(block)
    fde = is_fde(crypt, verity)
    return (verity.join(C.by_merge(fde), "device_id")
                  .select("device_id",
                          F.when(F.col("is_fde"), F.lit("fde"))
                           .when(F.col("is_verity"), F.lit("verity"))
                           .otherwise(F.lit("plain")).alias("mode")))


def mode_counts(modes: DataFrame) -> DataFrame:
    """A3 fleet view: devices per mode."""
    return modes.groupBy("mode").agg(F.count(F.lit(1)).alias("devices"))


# --- active slot ------------------------------------------------------------

def _root() -> Column:
    return F.col("mountpoint") == "/"


def active_plain_expr() -> Column:
    """W1 candidate: '/' row's own name, or the name before it for a verity volume."""
    return F.when(F.col("cname").contains("verity"), _dev(F.col("prev_name"))).otherwise(_dev(F.col("cname")))


def active_fde_cond() -> Column:
    return _root() & F.col("prev_sub").startswith("rootfs")


def active_verity_cond() -> Column:
    return _root() & C.is_allowed_root(F.col("prev_top"))


def active_plain(block: DataFrame) -> DataFrame:
    """First ``/`` row; a verity volume resolves to the partition before it."""
    s = with_scan_columns(block)
    return s.groupBy("device_id").agg(_first_by_ord(active_plain_expr(), _root()).alias("active"))


def active_fde(block: DataFrame) -> DataFrame:
    """First ``/`` row whose parent volume is ``rootfs*``; its top-level partition."""
    s = with_scan_columns(block)
    return s.groupBy("device_id").agg(_first_by_ord(_dev(F.col("prev_top")), active_fde_cond()).alias("active"))


def active_verity(block: DataFrame) -> DataFrame:
    """First ``/`` row whose top-level partition has an allowed root index."""
    s = with_scan_columns(block)
    return s.groupBy("device_id").agg(
        _first_by_ord(_dev(F.col("prev_top")), active_verity_cond()).alias("active"))


def device_pass(block: DataFrame, crypt: DataFrame) -> DataFrame:
    """Everything the slot finders need, per device, from ONE window pass and
    ONE aggregation over the block table (plus the crypt aggregation).

    Columns: ``device_id, mode, active`` (W7), ``w4_name`` (first W4
    candidate that is not the active partition), ``w5_target, w5_guessed``
    (W5), ``parent_a, parent_b`` (W6 for the two slot volumes).  W4
    candidates are collected per device: a device's block table is bounded
    by its hardware, so this list is a handful of rows.
    """
    s = with_scan_columns(block)
    root = "mountpoint = '/'"
    allowed = ", ".join(str(i) for i in K.ALLOWED_ROOT_INDEXES)
    top_index = "CAST(nullif(regexp_extract(prev_top, '([0-9]+)$', 1), '') AS INT)"

    def first(value: str, cond: str, name: str) -> str:
        return f"min_by({value}, CASE WHEN {cond} THEN ord END) AS {name}"

    per_dev = s.groupBy("device_id").agg(*[F.expr(e) for e in (
        f"count_if({root}) >= 2 AS is_verity",
        first("CASE WHEN contains(cname, 'verity') THEN concat('/dev/', prev_name) ELSE concat('/dev/', cname) END",
              root, "a_plain"),
        first("concat('/dev/', prev_top)", f"{root} AND startswith(prev_sub, 'rootfs')", "a_fde"),
        first("concat('/dev/', prev_top)", f"{root} AND {top_index} IN ({allowed})", "a_verity"),
        first("prev_top", root, "root_top"),
        first("prev_sub", root, "root_sub"),
        f"count_if({root}) AS roots",
        "sort_array(collect_list(CASE WHEN mountpoint IS NULL AND fstype IS NOT NULL AND startswith(partlabel, 'rootfs')"
        " AND NOT coalesce(startswith(cname, 'loop'), false) THEN named_struct('ord', ord, 'cname', cname) END))"
        " AS w4_cands",
        first("concat('/dev/', prev_top)", "cname = 'rootfs_a'", "parent_a"),
        first("concat('/dev/', prev_top)", "cname = 'rootfs_b'", "parent_b"),
    )])
    fde_agg = crypt.groupBy("device_id").agg(
        F.expr("bool_or(contains(target, 'rootfs_a')) AND bool_or(contains(target, 'rootfs_b')) AS is_fde"))
    is_a = "(coalesce(startswith(root_top, 'rootfs_a'), false) OR coalesce(startswith(root_sub, 'rootfs_a'), false))"
    is_b = "(coalesce(startswith(root_top, 'rootfs_b'), false) OR coalesce(startswith(root_sub, 'rootfs_b'), false))"
    return (per_dev.join(C.by_merge(fde_agg), "device_id", "left")
                   .selectExpr("*", "CASE WHEN coalesce(is_fde, false) THEN 'fde' WHEN is_verity THEN 'verity'"
                                    " ELSE 'plain' END AS mode")
                   .selectExpr("*", "CASE mode WHEN 'fde' THEN a_fde WHEN 'verity' THEN a_verity"
                                    " ELSE a_plain END AS active")
                   .selectExpr(
                       "device_id", "mode", "active",
                       "get(filter(w4_cands, c -> NOT coalesce(concat('/dev/', c.cname) = active, false)), 0).cname"
                       " AS w4_name",
                       f"CASE WHEN roots = 0 THEN NULL WHEN {is_a} THEN '{K.CRYPTED_PART}/rootfs_b'"
                       f" ELSE '{K.CRYPTED_PART}/rootfs_a' END AS w5_target",
                       f"roots > 0 AND NOT {is_a} AND NOT {is_b} AS w5_guessed",
                       "parent_a", "parent_b"))


def active_partition(block: DataFrame, crypt: DataFrame) -> DataFrame:
    """Mode and active partition per device.

    W1, W2 and W3 are computed in the same window pass and the same
    aggregation; the mode picks one of them.
    """
    return device_pass(block, crypt).select("device_id", "mode", "active")


# --- inactive slot ----------------------------------------------------------

def inactive_plain(block: DataFrame, active: DataFrame) -> DataFrame:
    """First unmounted ``rootfs*`` partition with a filesystem that is not
    a loop copy and not the active one; its index must be 2 or 6.

    ``active(device_id, active)``.  Returns ``device_id, target, error``.
    """
    cand = (block.join(C.by_merge(active.select("device_id", "active")), "device_id")
                 .withColumn("cname", C.clean_name("name")))
    cond = (F.col("mountpoint").isNull() & F.col("fstype").isNotNull()
            & F.col("partlabel").startswith("rootfs")
            & ~F.coalesce(F.col("cname").startswith("loop"), F.lit(False))
            & ~F.coalesce(_dev(F.col("cname")) == F.col("active"), F.lit(False)))
    first = (cand.groupBy("device_id")
                 .agg(_first_by_ord(F.col("cname"), cond).alias("cname")))
    idx = C.trailing_number("cname")
    bad = F.col("cname").isNotNull() & ~C.is_allowed_root("cname")
    return first.select(
        "device_id",
        F.when(bad, F.lit(None)).otherwise(_dev(F.col("cname"))).alias("target"),
        F.when(bad, F.concat(F.lit(f"Partition index must be either {K.INDEX_PART_A} or {K.INDEX_PART_B}. Found: "),
                             F.coalesce(idx.cast("string"), F.lit("")))).alias("error"))


def inactive_fde(block: DataFrame) -> DataFrame:
    """The mapper volume of the other slot, judged from the names before the
    first ``/`` row (anything not slot A is taken as A's partner B, see H14).

    Returns ``device_id, target, slot_guessed`` (``slot_guessed`` flags names
    that are neither ``rootfs_a*`` nor ``rootfs_b*``).
    """
    s = with_scan_columns(block)
    per = s.groupBy("device_id").agg(
        _first_by_ord(F.col("prev_top"), _root()).alias("n"),
        _first_by_ord(F.col("prev_sub"), _root()).alias("sub"),
        F.count_if(_root()).alias("roots"))
    is_a = F.coalesce(F.col("n").startswith("rootfs_a"), F.lit(False)) | \
        F.coalesce(F.col("sub").startswith("rootfs_a"), F.lit(False))
    is_b = F.coalesce(F.col("n").startswith("rootfs_b"), F.lit(False)) | \
        F.coalesce(F.col("sub").startswith("rootfs_b"), F.lit(False))
    has_root = F.col("roots") > 0
    return per.select(
        "device_id",
        F.when(~has_root, F.lit(None))
         .when(is_a, F.lit(f"{K.CRYPTED_PART}/rootfs_b"))
         .otherwise(F.lit(f"{K.CRYPTED_PART}/rootfs_a")).alias("target"),
        (has_root & ~is_a & ~is_b).alias("slot_guessed"))


def parent_of(block: DataFrame) -> DataFrame:
    """For every sub-volume name, the last top-level partition before its
    first row (``device_id, volume, parent``)."""
    s = with_scan_columns(block)
    return (s.where(F.col("depth") >= 2)
             .groupBy("device_id", F.col("cname").alias("volume"))
             .agg(F.min_by(_dev(F.col("prev_top")), F.col("ord")).alias("parent")))


def write_target(block: DataFrame, crypt: DataFrame) -> DataFrame:
    """Target of ``-w`` per device: W5 in fde mode, else W4 against W1/W3.

    Returns ``device_id, mode, active, target, error, target_block`` where
    ``target_block`` is the partition backing the target (W6 for fde).  One
    pass over the block table (:func:`device_pass`).
    """
    d = device_pass(block, crypt)
    allowed = ", ".join(str(i) for i in K.ALLOWED_ROOT_INDEXES)
    idx = "nullif(regexp_extract(w4_name, '([0-9]+)$', 1), '')"
    bad = f"(w4_name IS NOT NULL AND NOT coalesce(CAST({idx} AS INT) IN ({allowed}), false))"
    target = (f"CASE WHEN mode = 'fde' THEN w5_target WHEN {bad} THEN NULL"
              " ELSE concat('/dev/', w4_name) END")
    return d.selectExpr(
        "device_id", "mode", "active", f"{target} AS target",
        f"CASE WHEN mode <> 'fde' AND {bad} THEN concat("
        f"'Partition index must be either {K.INDEX_PART_A} or {K.INDEX_PART_B}. Found: ',"
        f" coalesce(CAST(CAST({idx} AS INT) AS STRING), '')) END AS error",
        "CASE WHEN mode = 'fde' THEN CASE regexp_extract(w5_target, '([^/]+)$', 1)"
        " WHEN 'rootfs_a' THEN parent_a WHEN 'rootfs_b' THEN parent_b END"
        f" ELSE {target} END AS target_block")


def normalize_devices(block: DataFrame) -> DataFrame:
    """name, base device, trailing number, allowed root index and the
    verity sibling devices (hash 7; map 4 for slot A, else 5) of each row."""
    name = C.clean_name("name")
    num = C.trailing_number(name)
    return block.select(
        "device_id", "ord",
        name.alias("name"),
        C.base_device(name).alias("base"),
        num.alias("number"),
        C.is_allowed_root(name).alias("allowed"),
        C.sibling_device(name, K.INDEX_HASH_PART).alias("hash_dev"),
        C.sibling_device(name, F.when(num == K.INDEX_PART_A, F.lit(K.INDEX_MAP_PART_A))
                         .otherwise(F.lit(K.INDEX_MAP_PART_B))).alias("map_dev"))


def duplicate_ids(blkid: DataFrame) -> DataFrame:
    """A4: ids (either column, case-insensitive) on more than one non-loop
    partition of a device: ``device_id, id, devices, first_dev``."""
    ids = (blkid.where(~F.col("dev").contains("loop"))
                .select("device_id", "dev",
                        F.explode(F.array(C.lower_id("uuid"), C.lower_id("partuuid"))).alias("id"))
                .where(F.col("id").isNotNull()))
    return (ids.groupBy("device_id", "id")
               .agg(F.count_distinct("dev").alias("devices"), F.min("dev").alias("first_dev"))
               .where(F.col("devices") > 1))


def device_present(block: DataFrame, targets: DataFrame) -> DataFrame:
    """is the target's base name present in the device's block table
    (substring, an empty name counts as present), and how many mounted rows
    sit under the target as a prefix.  ``targets(device_id, target)``."""
    t = targets.select("device_id", "target",
                       F.regexp_extract(F.coalesce("target", F.lit("")), r"([^/]*)$", 1).alias("base"))
    rows = block.select("device_id", C.clean_name("name").alias("cname"), "mountpoint")
    j = t.join(C.by_merge(rows), "device_id", "left")
    return (j.groupBy("device_id", "target", "base")
             .agg(F.bool_or(F.col("cname").contains(F.col("base"))).alias("hit"),
                  F.count_if(F.col("mountpoint").isNotNull()
                             & _dev(F.col("cname")).startswith(F.col("target"))).alias("mounted_under"))
             .select("device_id", "target",
                     ((F.col("base") == "") | F.coalesce(F.col("hit"), F.lit(False))).alias("present"),
                     "mounted_under"))
