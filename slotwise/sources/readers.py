"""Text sources: the outputs a device prints, parsed into typed columns.

Every reader takes a DataFrame of ``(device_id, ord|seq, line)`` rows, so the
same code serves batch (``spark.read.text`` / Parquet) and streams
(``readStream``); parsing is built-in regex functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise import constants as K
from slotwise.functions import columns as C
from slotwise.sources.files import read_texts


def read_block(lines: DataFrame) -> DataFrame:
    """Lsblk text ``NAME FSTYPE PARTLABEL MOUNTPOINT`` -> block rows.

    ``depth`` is the width of the leading tree glyphs (two characters per
    level).  Cells are split on single blanks (the raw form), so an empty
    middle cell stays in its column; the blank-collapsing read of the updater
    would shift it (H11).  For padded columns see :func:`read_block_aligned`.
    """
    glyphs = F.regexp_extract("line", r"^([^a-zA-Z0-9]*)", 1)
    body = F.split(F.regexp_replace("line", r"^[^a-zA-Z0-9]*", ""), " ")
    return lines.select(
        "device_id", "ord",
        (F.length(glyphs) / 2).cast("int").alias("depth"),
        C.clean_name(F.get(body, 0)).alias("name"),
        C.nullif_empty(F.get(body, 1)).alias("fstype"),
        C.nullif_empty(F.get(body, 2)).alias("partlabel"),
        C.nullif_empty(F.get(body, 3)).alias("mountpoint"))


BLOCK_COLUMNS = ("NAME", "FSTYPE", "PARTLABEL", "MOUNTPOINT")


def read_block_aligned(lines: DataFrame) -> DataFrame:
    """S1, aligned form: padded columns under a header line, tree glyphs
    (``├─``, ``└─``, ``│ ``) before the names.

    The header (the line that starts with ``NAME``, lowest ``ord`` of the
    device) says where the columns begin; a device's listing is bounded, so it
    reaches its lines by a window.  ``ord`` of the result starts at 0 after
    the header.
    """
    is_header = F.col("line").startswith("NAME ")
    w = Window.partitionBy("device_id")
    starts = F.array(*(F.instr(F.col("__header"), n) for n in BLOCK_COLUMNS))
    at = lines.withColumn("__header", F.min_by(F.when(is_header, F.col("line")), F.when(is_header, F.col("ord"))).over(w))
    at = at.withColumn("__first", F.min(F.when(is_header, F.col("ord"))).over(w)).withColumn("__at", starts)
    cells = [F.trim(F.substring(F.col("line"), F.get("__at", i), F.get("__at", i + 1) - F.get("__at", i)) if i < 3
                    else F.substring(F.col("line"), F.get("__at", i), F.length("line"))) for i in range(4)]
    glyphs = F.regexp_extract("line", r"^([^a-zA-Z0-9]*)", 1)
    return at.where(F.col("ord") > F.col("__first")).select(
        "device_id", (F.col("ord") - F.col("__first") - 1).cast("int").alias("ord"),
        (F.length(glyphs) / 2).cast("int").alias("depth"), C.clean_name(cells[0]).alias("name"),
        *[C.nullif_empty(c).alias(n.lower()) for c, n in zip(cells[1:], BLOCK_COLUMNS[1:])])


def render_block_aligned(block: DataFrame) -> DataFrame:
    """Aligned lsblk-style text of block rows with a header (the inverse of :func:`read_block_aligned`)."""
    w = Window.partitionBy("device_id")
    glyph = F.when(F.col("depth") > 0, F.concat(F.repeat(F.lit("│ "), F.col("depth") - 1), F.lit("├─"))).otherwise(F.lit(""))
    cells = [F.concat(glyph, F.coalesce("name", F.lit(""))), *(F.coalesce(c.lower(), F.lit("")) for c in BLOCK_COLUMNS[1:])]
    rows = block.select("device_id", (F.col("ord") + 1).alias("ord"), *(c.alias(n) for c, n in zip(cells, BLOCK_COLUMNS)))
    header = block.select("device_id").distinct().select(
        "device_id", F.lit(0).alias("ord"), *(F.lit(n).alias(n) for n in BLOCK_COLUMNS))
    every = rows.unionByName(header)
    line = F.concat_ws(" ", *(F.rpad(F.col(n), F.max(F.length(n)).over(w), " ") for n in BLOCK_COLUMNS))
    return every.select("device_id", "ord", F.rtrim(line).alias("line"))


def render_block(block: DataFrame) -> DataFrame:
    """lsblk-style text of block rows (the inverse of :func:`read_block`)."""
    glyph = F.when(F.col("depth") > 0, F.concat(F.repeat(F.lit("  "), F.col("depth") - 1), F.lit("└─"))).otherwise(F.lit(""))
    cells = F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in ("name", "fstype", "partlabel", "mountpoint")])
    return block.select("device_id", "ord", F.concat(glyph, cells).alias("line"))


def render_blkid(blkid: DataFrame) -> DataFrame:
    """blkid-style text ``dev: UUID="..." PARTUUID="..."`` of blkid rows."""
    return blkid.select("device_id", F.concat(
        F.col("dev"), F.lit(":"),
        F.coalesce(F.concat(F.lit(' UUID="'), F.col("uuid"), F.lit('"')), F.lit("")),
        F.coalesce(F.concat(F.lit(' PARTUUID="'), F.col("partuuid"), F.lit('"')), F.lit(""))).alias("line"))


def read_blkid(lines: DataFrame) -> DataFrame:
    """``dev: KEY="v" KEY="v"`` -> ``device_id, dev, uuid, partuuid, attrs``."""
    keys = F.regexp_extract_all("line", F.lit(r'([A-Z_]+)="[^"]*"'), 1)
    vals = F.regexp_extract_all("line", F.lit(r'[A-Z_]+="([^"]*)"'), 1)
    m = F.map_from_arrays(keys, vals)
    return lines.select(
        "device_id",
        F.regexp_extract("line", r"^([^:]*)", 1).alias("dev"),
        C.nullif_empty(F.element_at(m, F.lit("UUID"))).alias("uuid"),
        C.nullif_empty(F.element_at(m, F.lit("PARTUUID"))).alias("partuuid"),
        m.alias("attrs"))


def read_kv(lines: DataFrame) -> DataFrame:
    """``KEY=VALUE`` lines; blank and ``#`` lines skipped, quotes removed.

    Keeps the raw key text so F3 can judge it; ``key`` is NULL when it is not
    a valid identifier.
    """
    body = F.col("line")
    raw_key = F.regexp_extract(body, r"^([^=]*)=", 1)
    value = F.regexp_replace(F.regexp_extract(body, r"^[^=]*=(.*)$", 1), '"', "")
    return (lines.where(~(F.trim(body) == "") & ~body.startswith("#"))
                 .select("device_id", "seq", raw_key.alias("raw_key"),
                         F.when(raw_key.rlike(K.CONFIG_KEY_RE), raw_key).alias("key"),
                         value.alias("value")))


def image_id(lines: DataFrame) -> DataFrame:
    """Value of the first ``IMAGE_UUID=`` line (second ``=``-field only)."""
    return (lines.where(F.col("line").startswith(K.IMAGE_ID_PREFIX))
                 .groupBy("device_id")
                 .agg(F.min_by(F.split("line", "=").getItem(1), F.col("ord")).alias("image_uuid")))


_ANSI = r"\x1b\[[0-9;]*m"
_LOG_RE = r"^(\S*) \[(ERROR|WARN|INFO|DEBUG)\]: (.*)$"


def read_log(lines: DataFrame, *keep: str) -> DataFrame:
    """``<ISO time> [LEVEL]: msg`` with ANSI colours stripped.

    The timestamp is optional; it is turned into UTC wall time
    (``timestamp_ntz``).  Lines of another shape get ``level`` NULL.  ``keep``
    names further columns to pass through.
    """
    plain = F.regexp_replace("line", _ANSI, "")
    ts_txt = C.nullif_empty(F.regexp_extract(plain, _LOG_RE, 1))
    level = C.nullif_empty(F.regexp_extract(plain, _LOG_RE, 2))
    return lines.select(
        "device_id", "seq",
        F.try_to_timestamp(ts_txt, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")).cast("timestamp_ntz").alias("ts"),
        level.alias("level"),
        F.when(level.isNotNull(), F.regexp_extract(plain, _LOG_RE, 3)).alias("msg"), *keep)


def read_lines(spark, path: str | list[str], device: str = r"device_id=([^/]+)", order: str = "ord", stream: bool = False,
               max_files: int | None = None, by_tasks: bool = False) -> DataFrame:
    """Lines of real text files as the readers above take them: ``device_id, <order>, line``.

    One file is one output of a device (a listing, a configuration, a boot
    list; a log piece as it was uploaded): the first group of ``device`` in its
    path names the device, ``<order>`` is the line's number in the file, from 0.
    A file is read as one text, so its lines keep their numbers however files
    are packed into tasks; both line endings are known, and the end of the last
    line begins no further one.  With ``stream`` the files come as a file
    stream, ``max_files`` a micro-batch.  With ``by_tasks`` the paths are flat
    folders of very many files, which the tasks list and read, not the driver.
    """
    if by_tasks:
        texts = read_texts(spark, [path] if isinstance(path, str) else path)
    else:
        reader = spark.readStream if stream else spark.read
        reader = reader.option("recursiveFileLookup", "true")
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        texts = reader.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    files = texts.select(F.regexp_extract("path", device, 1).alias("device_id"), F.regexp_replace("value", r"\r?\n\z", "").alias("value"))
    return files.select("device_id", F.posexplode(F.split("value", r"\r?\n")).alias(order, "line"))


MAX_CONTENT = (1 << 31) - 1     # one value of Spark's binary type


def image_files(spark, path_glob: str | list[str], recursive: bool = True, name_glob: str | None = None) -> DataFrame:
    """Regular files under ``path_glob`` by the ``binaryFile`` source (path, length, content, ...); ``name_glob``
    keeps only matching file names (e.g. ``*.raw.gz``).  A column that is not asked for is not read; the source lists no empty files."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.load(path_glob)


def read_images(spark, path_glob: str | list[str], recursive: bool = True, name_glob: str | None = None,
                max_bytes: int = MAX_CONTENT) -> DataFrame:
    """Image files as ``path, length, content`` (see :func:`image_files`).

    A file above ``max_bytes`` is listed with ``content`` NULL, so that one
    large image becomes a verdict and not a failed job; the length filter is
    pushed into the source, which then does not read such a file.  For digests
    of files of any size see :mod:`slotwise.sources.digests`.
    """
    files = image_files(spark, path_glob, recursive, name_glob)
    small = files.where(F.col("length") <= max_bytes).select("path", "length", "content")
    large = files.where(F.col("length") > max_bytes).select("path", "length", F.lit(None).cast("binary").alias("content"))
    return small.unionByName(large)
