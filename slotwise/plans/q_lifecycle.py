"""Queries over the update lifecycle."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotwise.operators import lifecycle as LC
from slotwise.plans.catalog import query

LIFE_SQL = """
WITH s1 AS (SELECT *, COALESCE(last_value(CASE WHEN action = 'write' THEN 1 WHEN action = 'commit' THEN 0 END IGNORE NULLS)
              OVER (PARTITION BY device_id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS staged_before
            FROM fx_action),
s2 AS (SELECT *, action = 'apply' AND staged_before = 1 AS apply_ok, action = 'commit' AND staged_before = 1 AS commit_ok FROM s1),
s3 AS (SELECT *, COALESCE(last_value(CASE WHEN apply_ok THEN 1 WHEN action = 'reboot' THEN 0 END IGNORE NULLS)
              OVER (PARTITION BY device_id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS armed_before
       FROM s2),
s4 AS (SELECT *, CASE WHEN action = 'reboot' AND armed_before = 1 THEN 1 WHEN action = 'reboot' THEN 0
                      WHEN apply_ok THEN 0 WHEN commit_ok THEN 0 END AS trial_v FROM s3),
s5 AS (SELECT *, COALESCE(last_value(trial_v IGNORE NULLS)
              OVER (PARTITION BY device_id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS trial_before
       FROM s4),
life AS (SELECT device_id, seq, ts, action,
  CASE WHEN action = 'write' THEN 'staged'
       WHEN action = 'apply' THEN CASE WHEN apply_ok THEN 'accepted' ELSE 'Nothing to apply.' END
       WHEN action = 'commit' THEN CASE WHEN commit_ok THEN 'accepted' ELSE 'Nothing to commit.' END
       WHEN action = 'reboot' THEN CASE WHEN armed_before = 1 THEN 'trial' WHEN trial_before = 1 THEN 'rollback' ELSE 'plain' END
       ELSE 'no change' END AS outcome,
  CASE WHEN action = 'write' THEN 1 WHEN action = 'commit' THEN 0 ELSE staged_before END AS staged,
  CASE WHEN apply_ok THEN 1 WHEN action = 'reboot' THEN 0 ELSE armed_before END AS armed,
  COALESCE(trial_v, trial_before) AS trial
FROM s5)
"""


@query("w9_lifecycle", LIFE_SQL + "SELECT * FROM life")
def w9_lifecycle(fx):
    """State and outcome after every lifecycle event of every device."""
    return LC.lifecycle(fx.action)


@query("w8_step_gate", LIFE_SQL + "SELECT device_id, seq, action, outcome AS verdict FROM life WHERE action IN ('apply', 'commit')")
def w8_step_gate(fx):
    return LC.step_gate(fx.action)


@query("w10_admit_runs", """
WITH RECURSIVE r AS (SELECT run_id, device_id, start_ts, end_ts,
                            row_number() OVER (PARTITION BY device_id ORDER BY start_ts, run_id) AS rn FROM fx_run),
walk AS (SELECT device_id, rn, end_ts AS lock_end, true AS admitted FROM r WHERE rn = 1
         UNION ALL
         SELECT w.device_id, r.rn, CASE WHEN r.start_ts >= w.lock_end THEN r.end_ts ELSE w.lock_end END,
                r.start_ts >= w.lock_end
         FROM walk w JOIN r ON r.device_id = w.device_id AND r.rn = w.rn + 1)
SELECT r.run_id, r.device_id, w.admitted, CASE WHEN w.admitted THEN 0 ELSE 1 END AS exit_code
FROM r JOIN walk w ON w.device_id = r.device_id AND w.rn = r.rn""")
def w10_admit_runs(fx):
    """Which runs get the exclusive, non-blocking lock."""
    return LC.admit_runs(fx.run)


@query("j10_overlapping_runs", """
SELECT a.device_id, a.run_id AS run_a, b.run_id AS run_b
FROM fx_run a JOIN fx_run b ON a.device_id = b.device_id AND a.run_id < b.run_id
  AND a.start_ts < b.end_ts AND b.start_ts < a.end_ts""")
def j10_overlapping_runs(fx):
    return LC.overlapping_runs(fx.run)


J11_SQL = """
WITH a AS (SELECT device_id, seq, ts FROM fx_action WHERE action = 'apply'),
r AS (SELECT device_id, ts FROM fx_action WHERE action = 'reboot'),
nx AS (SELECT a.device_id, a.seq, a.ts, (SELECT min(r.ts) FROM r WHERE r.device_id = a.device_id AND r.ts >= a.ts) AS rts FROM a),
d AS (SELECT device_id, seq, epoch_us(rts) - epoch_us(ts) AS dt FROM nx)
SELECT device_id, seq,
  CASE WHEN dt IS NOT NULL AND dt <= 21600000000 THEN CAST(floor((dt + 3599999999) / 3600000000) AS BIGINT) END AS tick,
  NOT COALESCE(dt <= 21600000000, false) AS timed_out
FROM d"""


@query("j11_wait_for", J11_SQL)
def j11_wait_for(fx):
    """Apply -> reboot: first hourly poll that sees the reboot, timeout 6 h."""
    acts = fx.action
    return LC.wait_for(acts.where(F.col("action") == "apply").select("device_id", "seq", "ts"),
                       acts.where(F.col("action") == "reboot").select("device_id", "ts"),
                       interval_s=LC.HOUR, timeout_s=6 * LC.HOUR)
