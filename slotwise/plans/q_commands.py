"""Queries over tool runs and logs."""

from __future__ import annotations

from slotwise import constants as K
from pyspark.sql import functions as F

from slotwise.operators import commands as CM
from slotwise.operators import logs as L
from slotwise.plans.catalog import query
from slotwise.sources import readers as R


def _sql_map(d: dict, col: str) -> str:
    arms = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in d.items())
    return f"CASE {arms} END"


C1_SQL = """
WITH t0 AS (SELECT run_id, device_id, list_filter(string_split(argv, ' '), lambda x: x <> '') AS arr FROM fx_run),
toks AS (SELECT run_id, device_id, unnest(arr) AS tok, unnest(range(1, len(arr) + 1)) AS pos FROM t0),
t1 AS (SELECT *, lead(tok) OVER (PARTITION BY run_id ORDER BY pos) AS nxt,
         (pos - 1 - COALESCE(max(CASE WHEN tok NOT IN ('-u', '-s') THEN pos END)
            OVER (PARTITION BY run_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) % 2 = 1 AS consumed
       FROM toks),
t2 AS (SELECT *, CASE WHEN consumed THEN NULL
          WHEN tok IN ('-u', '-s') AND nxt IS NULL THEN 'missing value'
          WHEN tok = '-u' AND NOT regexp_matches(nxt, '^[a-zA-Z0-9._/-]+$') THEN 'bad path'
          WHEN tok = '-u' AND nxt NOT IN (SELECT path FROM fx_path) THEN 'path missing'
          WHEN tok = '-s' AND NOT regexp_matches(regexp_replace(nxt, ' $', ''), '^[a-fA-F0-9]{64}$') THEN 'bad digest'
          WHEN tok = '-h' THEN 'help'
          WHEN tok NOT IN ('-v', '-a', '-c', '-w', '-u', '-s', '-h', '--debug', '--dev') THEN 'invalid option' END AS err
       FROM t1),
agg AS (SELECT run_id,
          arg_min(err, pos) FILTER (WHERE err IS NOT NULL) AS err,
          bool_or(NOT consumed AND tok = '-v') AS v, bool_or(NOT consumed AND tok = '-a') AS a,
          bool_or(NOT consumed AND tok = '-c') AS c, bool_or(NOT consumed AND tok = '-w') AS w,
          bool_or(NOT consumed AND tok = '--dev') AS dev, bool_or(NOT consumed AND tok = '--debug') AS debug,
          arg_max(nxt, pos) FILTER (WHERE NOT consumed AND tok = '-u') AS src,
          arg_max(regexp_replace(nxt, ' $', ''), pos) FILTER (WHERE NOT consumed AND tok = '-s') AS sha
        FROM t2 GROUP BY run_id),
c1 AS (SELECT t0.run_id, t0.device_id,
          CASE WHEN len(t0.arr) = 0 THEN 'no parameters' ELSE g.err END AS error,
          g.v, g.a, g.c, g.w, g.dev, g.debug, g.src, g.sha
       FROM t0 LEFT JOIN agg g ON g.run_id = t0.run_id),
c1out AS (SELECT run_id, device_id,
          COALESCE(error IS NULL AND v, false) AS v, COALESCE(error IS NULL AND a, false) AS a,
          COALESCE(error IS NULL AND c, false) AS c, COALESCE(error IS NULL AND w, false) AS w,
          COALESCE(error IS NULL AND dev, false) AS dev, COALESCE(error IS NULL AND debug, false) AS debug,
          CASE WHEN error IS NULL THEN src END AS img_source, CASE WHEN error IS NULL THEN sha END AS sha,
          error, CASE WHEN error IS NULL THEN 0 ELSE 1 END AS exit_code FROM c1)
"""


def parsed_runs(fx):
    return CM.parse_runs(fx.run, fx.path)


@query("c1_parse_runs", C1_SQL + "SELECT * FROM c1out")
def c1_parse_runs(fx):
    """Flags, values and first error of every run's command line."""
    return parsed_runs(fx)


@query("c2_planned_steps", C1_SQL + """
SELECT run_id, device_id, CASE WHEN error IS NOT NULL THEN '' WHEN v THEN 'status'
  ELSE concat_ws(',', CASE WHEN w THEN 'write' END, CASE WHEN a THEN 'apply' END, CASE WHEN c THEN 'commit' END) END AS steps
FROM c1out""")
def c2_planned_steps(fx):
    return CM.planned_steps(parsed_runs(fx))


@query("c2_planned_steps_long", C1_SQL + """,
c2 AS (SELECT run_id, device_id, CASE WHEN error IS NOT NULL THEN '' WHEN v THEN 'status'
  ELSE concat_ws(',', CASE WHEN w THEN 'write' END, CASE WHEN a THEN 'apply' END, CASE WHEN c THEN 'commit' END) END AS steps
  FROM c1out)
SELECT run_id, device_id, unnest(range(1, len(string_split(steps, ',')) + 1)) AS step_no,
       unnest(string_split(steps, ',')) AS step
FROM c2 WHERE steps <> ''""")
def c2_planned_steps_long(fx):
    return CM.planned_steps_long(parsed_runs(fx))


LOG_SQL = r"""
WITH p AS (SELECT device_id, seq, regexp_replace(line, '\x1b\[[0-9;]*m', '', 'g') AS p FROM fx_log),
s6 AS (SELECT device_id, seq,
         CAST(timezone('UTC', try_strptime(nullif(regexp_extract(p, '^(\S*) \[(ERROR|WARN|INFO|DEBUG)\]: (.*)$', 1), ''),
                                           '%Y-%m-%dT%H:%M:%S%z')) AS TIMESTAMP) AS ts,
         nullif(regexp_extract(p, '^(\S*) \[(ERROR|WARN|INFO|DEBUG)\]: (.*)$', 2), '') AS level,
         CASE WHEN nullif(regexp_extract(p, '^(\S*) \[(ERROR|WARN|INFO|DEBUG)\]: (.*)$', 2), '') IS NOT NULL
              THEN regexp_extract(p, '^(\S*) \[(ERROR|WARN|INFO|DEBUG)\]: (.*)$', 3) END AS msg
       FROM p)
"""


def parsed_log(fx):
    return R.read_log(fx.log)


@query("s6_read_log", LOG_SQL + "SELECT device_id, seq, ts, level, msg FROM s6")
def s6_read_log(fx):
    return parsed_log(fx)


@query("a7_log_counts", LOG_SQL + "SELECT device_id, level, count(*) AS lines FROM s6 WHERE level IS NOT NULL GROUP BY ALL")
def a7_log_counts(fx):
    return L.log_counts(parsed_log(fx))


@query("a8_failure_report", LOG_SQL + f"""
SELECT COALESCE({_sql_map(K.ERROR_STAGE, 'msg')}, 'unknown') AS stage, msg, count(*) AS lines,
       count(DISTINCT device_id) AS devices
FROM s6 WHERE level = 'ERROR' GROUP BY msg""")
def a8_failure_report(fx):
    return L.failure_report(parsed_log(fx))


_STAGE = f"COALESCE({_sql_map(K.ERROR_STAGE, 'msg')}, 'unknown')"


@query("c3_exit_code", LOG_SQL + f"""
SELECT device_id, seq, msg, {_STAGE} AS stage,
  COALESCE(CASE {_STAGE} {' '.join(f"WHEN '{k}' THEN {v}" for k, v in K.STAGE_EXIT_CODE.items())} END, 1) AS exit_code
FROM s6 WHERE level = 'ERROR'""")
def c3_exit_code(fx):
    """Exit code each failure ends with (stage override, else its status)."""
    return L.error_exit_codes(parsed_log(fx))


@query("c3_exit_code_status", """
SELECT device_id, seq, stage, CASE stage WHEN 'write' THEN 3 WHEN 'commit' THEN 4 ELSE status END AS exit_code
FROM (SELECT device_id, seq, CASE seq % 3 WHEN 0 THEN 'write' WHEN 1 THEN 'commit' END AS stage,
             CAST(2 + seq % 5 AS INTEGER) AS status FROM fx_action WHERE action = 'fail') x""")
def c3_exit_code_status(fx):
    """Exit code of every failed action: by the stage it failed in, or its own status outside the stages."""
    fails = fx.action.where(F.col("action") == "fail").select(
        "device_id", "seq", F.expr("CASE seq % 3 WHEN 0 THEN 'write' WHEN 1 THEN 'commit' END").alias("stage"),
        F.expr("CAST(2 + seq % 5 AS INT)").alias("status"))
    return fails.select("device_id", "seq", "stage", CM.exit_code(F.col("stage"), F.col("status")).alias("exit_code"))
