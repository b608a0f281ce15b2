"""Configuration text: validation (F3), effective values (K1), references (K2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise import constants as K

REF_VAR = "TEMPDATA"


def resolve_refs(kv: DataFrame, var: str = REF_VAR) -> DataFrame:
    """K2: values mentioning ``$VAR`` re-evaluated with the device's current
    ``VAR`` (its last assignment; the default when none), one level deep.

    A config file is bounded per device, so the current value is a window
    aggregate over the device (one shuffle, no self-join).
    """
    w = Window.partitionBy("device_id")
    is_var = F.col("key") == var
    current = F.max_by(F.when(is_var, F.col("value")), F.when(is_var, F.col("seq"))).over(w)
    cur = F.coalesce(current, F.lit(K.CONFIG_DEFAULTS[var]))
    return kv.withColumn("resolved", F.when(F.col("value").contains(f"${var}"),
                                            F.replace(F.col("value"), F.lit(f"${var}"), cur))
                                      .otherwise(F.col("value")))


def config_reason(value_col: str = "resolved"):
    """NULL when an update is acceptable, else the first failing check:
    ``bad key`` / ``bad value`` / ``unknown key``."""
    known = F.col("key").isin(*K.CONFIG_DEFAULTS.keys())
    v = F.col(value_col)
    return (F.when(F.col("key").isNull(), F.lit("bad key"))
             .when((v != "") & v.rlike(K.CONFIG_BAD_VALUE_RE), F.lit("bad value"))
             .when(~known, F.lit("unknown key")))


def valid_config(kv: DataFrame) -> DataFrame:
    """F3 per line after K2: ``device_id, seq, raw_key, value, reason``."""
    r = resolve_refs(kv)
    return r.select("device_id", "seq", "raw_key", F.col("resolved").alias("value"), config_reason().alias("reason"))


def effective_config(kv: DataFrame, defaults: dict[str, str] | None = None) -> DataFrame:
    """K1: per device and key, the defaults overlaid by later valid updates
    (last wins); values are K2-resolved.

    ``defaults`` are the deployment's own keys and values in file order.  One
    aggregation per device (a config file is bounded) gathers its valid
    updates; the defaults fan out after it, so nothing is shuffled but the
    input by device.
    """
    defaults = K.CONFIG_DEFAULTS if defaults is None else defaults
    is_var = F.col("key") == REF_VAR
    valid = F.when(config_reason().isNull(), F.struct("seq", "key", F.col("resolved").alias("value")))
    per = resolve_refs(kv).groupBy("device_id").agg(
        F.sort_array(F.collect_list(valid)).alias("updates"),
        F.max_by(F.when(is_var, F.col("value")), F.when(is_var, F.col("seq"))).alias("var"))
    table = F.create_map(*[F.lit(x) for kv_ in defaults.items() for x in kv_])
    rows = per.select("device_id", "updates", "var", F.explode(table).alias("key", "default"))
    own = F.filter("updates", lambda u: u["key"] == F.col("key"))
    ref = F.replace(F.col("default"), F.lit(f"${REF_VAR}"), F.coalesce("var", F.lit(defaults.get(REF_VAR, ""))))
    return rows.select("device_id", "key", F.coalesce(F.get(own, F.size(own) - 1)["value"], ref).alias("value"))
