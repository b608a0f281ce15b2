"""Log analytics: counts per level, failure reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.operators.commands import exit_code, stage_of


def log_counts(parsed: DataFrame, include_debug: bool = True) -> DataFrame:
    """Lines per device and level (DEBUG lines only when enabled)."""
    df = parsed.where(F.col("level").isNotNull())
    if not include_debug:
        df = df.where(F.col("level") != "DEBUG")
    return df.groupBy("device_id", "level").agg(F.count(F.lit(1)).alias("lines"))


def failure_report(parsed: DataFrame) -> DataFrame:
    """ERROR messages mapped to their stage, counted fleet-wide."""
    err = parsed.where(F.col("level") == "ERROR")
    return (err.groupBy(F.col("msg"))
               .agg(F.count(F.lit(1)).alias("lines"), F.count_distinct("device_id").alias("devices"))
               .select(F.coalesce(stage_of(F.col("msg")), F.lit("unknown")).alias("stage"), "msg", "lines", "devices"))


def error_exit_codes(parsed: DataFrame) -> DataFrame:
    """C3 over logs: each ERROR line's stage and the exit code it ends with.

    The override of the stage, else the line's own failing ``status`` if the
    input has that column, else 1 (a line that tells no status)."""
    err = parsed.where(F.col("level") == "ERROR")
    stage = F.coalesce(stage_of(F.col("msg")), F.lit("unknown"))
    own = F.coalesce(F.col("status"), F.lit(1)) if "status" in parsed.columns else F.lit(1)
    return err.select("device_id", "seq", "msg", stage.alias("stage"), exit_code(stage, own).alias("exit_code"))
