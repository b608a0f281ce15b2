"""Queries over configuration text."""

from __future__ import annotations

from slotwise import constants as K
from slotwise.operators import config as CF
from slotwise.plans.catalog import query
from slotwise.sources import readers as R

_KEYS = ", ".join(f"'{k}'" for k in K.CONFIG_DEFAULTS)
_DEFAULTS = ", ".join(f"('{k}', '{v}')" for k, v in K.CONFIG_DEFAULTS.items())

KV_SQL = f"""
WITH kv AS (
  SELECT device_id, seq, regexp_extract(line, '^([^=]*)=', 1) AS raw_key,
    CASE WHEN regexp_matches(regexp_extract(line, '^([^=]*)=', 1), '^[a-zA-Z_][a-zA-Z0-9_]*$')
         THEN regexp_extract(line, '^([^=]*)=', 1) END AS key,
    replace(regexp_extract(line, '^[^=]*=(.*)$', 1), '"', '') AS value
  FROM fx_config_line WHERE trim(line) <> '' AND NOT starts_with(line, '#')),
cur AS (SELECT device_id, arg_max(value, seq) FILTER (WHERE key = 'TEMPDATA') AS cur FROM kv GROUP BY device_id),
res AS (SELECT kv.*, CASE WHEN contains(kv.value, '$TEMPDATA')
                          THEN replace(kv.value, '$TEMPDATA', COALESCE(c.cur, '{K.CONFIG_DEFAULTS["TEMPDATA"]}'))
                          ELSE kv.value END AS resolved
        FROM kv LEFT JOIN cur c ON c.device_id = kv.device_id),
f3 AS (SELECT device_id, seq, raw_key, resolved AS value,
         CASE WHEN key IS NULL THEN 'bad key'
              WHEN resolved <> '' AND regexp_matches(resolved, '[^a-zA-Z0-9._:/ -]') THEN 'bad value'
              WHEN key NOT IN ({_KEYS}) THEN 'unknown key' END AS reason
       FROM res),
defs AS (SELECT d.device_id, 0 AS seq, k.key, CASE WHEN contains(k.value, '$TEMPDATA')
           THEN replace(k.value, '$TEMPDATA', COALESCE(c.cur, '{K.CONFIG_DEFAULTS["TEMPDATA"]}')) ELSE k.value END AS resolved
         FROM (SELECT DISTINCT device_id FROM kv) d LEFT JOIN cur c ON c.device_id = d.device_id
         CROSS JOIN (SELECT * FROM (VALUES {_DEFAULTS}) AS v(key, value)) k),
k1 AS (SELECT device_id, key, arg_max(resolved, seq) AS value FROM (
         SELECT device_id, seq, key, resolved FROM defs
         UNION ALL SELECT r.device_id, r.seq, r.key, r.resolved FROM res r JOIN f3 f ON f.device_id = r.device_id AND f.seq = r.seq
         WHERE f.reason IS NULL) x GROUP BY device_id, key)
"""


def kv_of(fx):
    return R.read_kv(fx.config_line)


@query("s4_read_kv", KV_SQL + "SELECT device_id, seq, raw_key, key, value FROM kv")
def s4_read_kv(fx):
    return kv_of(fx)


@query("k2_resolve_refs", KV_SQL + "SELECT device_id, seq, key, value, resolved FROM res")
def k2_resolve_refs(fx):
    return CF.resolve_refs(kv_of(fx)).select("device_id", "seq", "key", "value", "resolved")


@query("f3_valid_config", KV_SQL + "SELECT device_id, seq, raw_key, value, reason FROM f3")
def f3_valid_config(fx):
    return CF.valid_config(kv_of(fx))


@query("k1_effective_config", KV_SQL + "SELECT device_id, key, value FROM k1")
def k1_effective_config(fx):
    return CF.effective_config(kv_of(fx))
