"""Column expressions (no UDFs): everything here stays inside whole-stage codegen; and the hint of device joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise import constants as K


def by_merge(side: DataFrame) -> DataFrame:
    """One side of a join on devices, never broadcast: a table that grows with the fleet is small on disk, where its
    columns are dictionaries, and many times that in the driver."""
    return side.hint("merge")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def nullif_empty(col) -> Column:
    """'' -> NULL (the updater uses the empty string as NULL)."""
    c = _c(col)
    return F.when(c == "", F.lit(None)).otherwise(c)


def clean_name(col) -> Column:
    """Device name without leading tree glyphs / non-alphanumerics; '' -> NULL."""
    return nullif_empty(F.regexp_replace(_c(col), r"^[^a-zA-Z0-9]*", ""))


def trailing_number(col) -> Column:
    """Whole trailing number of a device name (``sda12`` -> 12), else NULL."""
    return nullif_empty(F.regexp_extract(_c(col), r"([0-9]+)$", 1)).cast("int")


def device_stem(col) -> Column:
    """Name without its trailing number (``nvme0n1p2`` -> ``nvme0n1p``)."""
    return F.regexp_replace(_c(col), r"[0-9]+$", "")


def base_device(col) -> Column:
    """Whole disk of a partition: trailing number off, and the ``p`` after a digit."""
    return F.regexp_replace(device_stem(col), r"([0-9])p$", "$1")


def sibling_device(col, index) -> Column:
    """Partition of the same disk with another index (``sda2``, 7 -> ``sda7``)."""
    return F.concat(device_stem(col), _c(index).cast("string") if not isinstance(index, int) else F.lit(str(index)))


def is_allowed_root(col) -> Column:
    """Trailing number is one of the two root slot indexes."""
    return trailing_number(col).isin(*K.ALLOWED_ROOT_INDEXES)


def valid_path_reason(path, exists=None) -> Column:
    """NULL when fine, else 'empty' / 'invalid characters' / 'does not exist'."""
    p = _c(path)
    r = (F.when(p.isNull() | (p == ""), F.lit("empty"))
         .when(~p.rlike(K.VALID_PATH_RE), F.lit("invalid characters")))
    if exists is not None:
        r = r.when(~F.coalesce(_c(exists), F.lit(False)), F.lit("does not exist"))
    return r


def strip_one_trailing_blank(col) -> Column:
    return F.regexp_replace(_c(col), r" $", "")


def valid_sha(col) -> Column:
    """64 hex digits, either case, after one trailing blank is removed."""
    return F.coalesce(strip_one_trailing_blank(col).rlike(K.VALID_SHA256_RE), F.lit(False))


def image_type(path) -> Column:
    """'xz' / 'gz' / 'raw' by suffix, else NULL (invalid file type)."""
    p = _c(path)
    return (F.when(p.endswith(".xz"), F.lit("xz"))
            .when(p.endswith(".gz"), F.lit("gz"))
            .when(p.endswith(".raw"), F.lit("raw")))


def is_compressed(path) -> Column:
    return image_type(path).isin("xz", "gz")


def is_second_image(uki) -> Column:
    return _c(uki).rlike(r"-2\.efi$")


def active_boot_image(uki) -> Column:
    """the boot image a device runs, normalised to one of the two names."""
    return F.when(_c(uki).isNull(), F.lit(None)).when(
        is_second_image(uki), F.lit(K.BOOT_IMAGE_B)).otherwise(F.lit(K.BOOT_IMAGE_A))


def other_boot_image(uki) -> Column:
    """the other boot image (next one-shot on apply, previous on restore)."""
    return F.when(_c(uki).isNull(), F.lit(None)).when(
        is_second_image(uki), F.lit(K.BOOT_IMAGE_A)).otherwise(F.lit(K.BOOT_IMAGE_B))


def extract_id(content) -> Column:
    """id after ``boot_uuid=`` (36 chars, first hit), else after ``PARTUUID=``."""
    c = _c(content)
    return F.coalesce(nullif_empty(F.regexp_extract(c, r"boot_uuid=(.{36})", 1)),
                      nullif_empty(F.regexp_extract(c, r"PARTUUID=(.{36})", 1)))


def lower_id(col) -> Column:
    return F.lower(_c(col))
