"""Streaming queries ST1-ST4.

Each query replays a fixture table as a file stream in a scratch folder, runs
the streaming operator with ``trigger(availableNow=True)`` into a Parquet sink
and returns the sink's rows.  Rows arrive out of order: an event's arrival is
its time plus up to ``LATENESS``, so that events of one hour come in different
micro-batches.  A closing event far in the future carries the watermark past
everything, so the results are complete and equal their batch twins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.operators import lifecycle as LC
from slotwise.plans.catalog import query
from slotwise.plans.q_commands import LOG_SQL
from slotwise.plans.q_lifecycle import J11_SQL, LIFE_SQL
from slotwise.session import scratch
from slotwise.sources import readers as R
from slotwise.streaming import operators as ST
from slotwise.streaming.sources import stage_slices

LATENESS_DAYS = 2
WATERMARK = "3 days"
CLOSING = "2100-01-01 00:00:00"     # after every event of the fixtures


def _late(ts: Column, seq: Column) -> Column:
    """Arrival in microseconds: the event's time and up to ``LATENESS_DAYS`` more, by hash."""
    span = LATENESS_DAYS * LC.DAY * 1_000_000
    return F.unix_micros(ts.cast("timestamp")) + F.pmod(F.xxhash64(seq), F.lit(span))


def _replay(spark, df: DataFrame, arrived: Column, closing: DataFrame, path: str) -> DataFrame:
    files = stage_slices(df, path, arrived, closing)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


def _buckets(history: DataFrame) -> int:
    """Buckets of devices for a replay of a stored history."""
    return ST.buckets_for(history.count())


def _actions(fx, path: str) -> DataFrame:
    """The action stream; closing events of two devices that do not exist, one per kind of wait."""
    df = fx.action.select("device_id", "seq", "ts", "action")
    closing = fx.spark.createDataFrame([(-1, -1, "apply"), (-2, -2, "reboot")], "device_id long, seq long, action string")
    closing = closing.select(*(F.col(c).cast(df.schema[c].dataType).alias(c) for c in ("device_id", "seq")),
                             F.lit(CLOSING).cast("timestamp_ntz").alias("ts"), "action")
    return _replay(fx.spark, df, _late(F.col("ts"), F.col("seq")), closing, path)


def run_available(stream: DataFrame, base: str, name: str, mode: str = "append") -> DataFrame:
    """Run ``stream`` over everything available into a Parquet sink; read it back."""
    sink, ckpt = f"{base}/{name}-sink", f"{base}/{name}-ckpt"
    q = (stream.writeStream.format("parquet").option("checkpointLocation", ckpt).outputMode(mode)
               .trigger(availableNow=True).start(sink))
    q.awaitTermination()
    return stream.sparkSession.read.parquet(sink)


@query("st1_stream_log_counts", LOG_SQL + """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       device_id, level, count(*) AS lines
FROM s6 WHERE level IS NOT NULL GROUP BY 1, 2, 3, 4""")
def st1_stream_log_counts(fx):
    """Log lines per device, level and hour from a watermarked stream; lines without a time in a row of their own."""
    base = scratch(fx.spark, "stream")
    parsed = R.read_log(fx.log, "line")
    # a line without a time arrives some time within the span of the others
    lo, hi = parsed.agg(F.min("ts"), F.max("ts")).first()
    micros = lambda c: F.unix_micros(F.lit(c).cast("timestamp_ntz").cast("timestamp"))
    spread = micros(lo) + F.pmod(F.xxhash64("seq"), micros(hi) - micros(lo) + 1)
    at = F.coalesce(_late(F.col("ts"), F.col("seq")), spread)
    df = parsed.select("device_id", "seq", "line", F.timestamp_micros(at).alias("arrived"))
    closing = fx.spark.createDataFrame([(-1, -1, f"{CLOSING.replace(' ', 'T')}+00:00 [INFO]: end")],
                                       "device_id long, seq long, line string")
    closing = closing.select(*(F.col(c).cast(df.schema[c].dataType).alias(c) for c in ("device_id", "seq")), "line",
                             F.lit(CLOSING).cast("timestamp").alias("arrived"))
    lines = _replay(fx.spark, df, F.unix_micros("arrived"), closing, f"{base}/log")
    return ST.log_totals(run_available(ST.log_counts_stream(lines, watermark=WATERMARK), base, "st1"))


@query("st2_stream_lifecycle", LIFE_SQL + "SELECT * FROM life")
def st2_stream_lifecycle(fx):
    """Lifecycle state machine over an unordered action stream (batch twin: W9)."""
    base = scratch(fx.spark, "stream")
    return run_available(ST.lifecycle_stream(_actions(fx, f"{base}/action"), WATERMARK, _buckets(fx.action)), base, "st2")


@query("st2_stream_armed_timeout", LIFE_SQL + """,
p AS (SELECT *, armed = 1 OR trial = 1 AS pending, row_number() OVER (PARTITION BY device_id ORDER BY ts, seq) AS n FROM life),
q AS (SELECT *, COALESCE(lag(pending) OVER (PARTITION BY device_id ORDER BY n), false) AS before FROM p),
s AS (SELECT device_id, n, ts AS pending_since FROM q WHERE pending AND NOT before),
e AS (SELECT device_id, n, ts FROM q WHERE NOT pending AND before),
x AS (SELECT s.device_id, s.n, s.pending_since, (SELECT min(e.n) FROM e WHERE e.device_id = s.device_id AND e.n > s.n) AS closed
      FROM s),
y AS (SELECT x.*, e.ts AS closed_ts FROM x LEFT JOIN e ON e.device_id = x.device_id AND e.n = x.closed),
z AS (SELECT y.*, (SELECT max(p.n) FROM p WHERE p.device_id = y.device_id AND p.ts < y.pending_since + INTERVAL 1 DAY) AS last
      FROM y WHERE closed_ts IS NULL OR closed_ts >= pending_since + INTERVAL 1 DAY)
SELECT z.device_id, z.pending_since, z.pending_since + INTERVAL 1 DAY AS deadline,
       CASE WHEN p.armed = 1 THEN 'armed but never tried' ELSE 'on trial but never committed' END AS outcome,
       p.staged, p.armed, p.trial
FROM z JOIN p ON p.device_id = z.device_id AND p.n = z.last""")
def st2_stream_armed_timeout(fx):
    """Episodes armed or on trial for a day of event time without a commit."""
    base = scratch(fx.spark, "stream")
    stream = ST.lifecycle_timeouts(_actions(fx, f"{base}/action"), LC.DAY, WATERMARK, _buckets(fx.action))
    return run_available(stream, base, "st2t")


@query("st3_stream_wait_for", J11_SQL)
def st3_stream_wait_for(fx):
    """Apply -> reboot waits from an unordered action stream (batch twin: J11); the sink holds the answer."""
    base = scratch(fx.spark, "stream")
    kind = F.when(F.col("action") == "apply", "start").when(F.col("action") == "reboot", "signal")
    events = _actions(fx, f"{base}/action").withColumn("kind", kind)
    return run_available(ST.wait_for_stream(events, LC.HOUR, 6 * LC.HOUR, WATERMARK, _buckets(fx.action)), base, "st3")


W10_SQL = """
WITH RECURSIVE r AS (SELECT run_id, device_id, start_ts, end_ts,
                            row_number() OVER (PARTITION BY device_id ORDER BY start_ts, run_id) AS rn FROM fx_run),
walk AS (SELECT device_id, rn, end_ts AS lock_end, true AS admitted FROM r WHERE rn = 1
         UNION ALL
         SELECT w.device_id, r.rn, CASE WHEN r.start_ts >= w.lock_end THEN r.end_ts ELSE w.lock_end END,
                r.start_ts >= w.lock_end
         FROM walk w JOIN r ON r.device_id = w.device_id AND r.rn = w.rn + 1)
SELECT r.run_id, r.device_id, w.admitted, CASE WHEN w.admitted THEN 0 ELSE 1 END AS exit_code
FROM r JOIN walk w ON w.device_id = r.device_id AND w.rn = r.rn"""


def _admitted(fx) -> DataFrame:
    base = scratch(fx.spark, "stream")
    df = fx.run.select("run_id", "device_id", "start_ts", "end_ts")
    far = F.lit(CLOSING).cast("timestamp_ntz")
    closing = fx.spark.range(1).select(F.lit(-1).cast(df.schema["run_id"].dataType).alias("run_id"),
                                       F.lit(-1).cast(df.schema["device_id"].dataType).alias("device_id"),
                                       far.alias("start_ts"), far.alias("end_ts"))
    runs = _replay(fx.spark, df, _late(F.col("start_ts"), F.col("run_id")), closing, f"{base}/run")
    return run_available(ST.admit_runs_stream(runs, WATERMARK, _buckets(df)), base, "st4")


@query("st4_stream_admit_runs", W10_SQL)
def st4_stream_admit_runs(fx):
    """Lock admission over an unordered run stream (batch twin: W10)."""
    return _admitted(fx)


@query("st4_stream_admit_runs_tws", W10_SQL)
def st4_stream_admit_runs_tws(fx):
    """The same by its earlier name: both run on transformWithStateInPandas."""
    return _admitted(fx)
