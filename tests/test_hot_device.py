"""A device holding a third of all events, or all of them: the scans must split
its history, and the answers must still equal DuckDB's on the same data."""

import random
import tempfile
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from slotwise.check import rows_of
from slotwise.operators import lifecycle as LC
from slotwise.operators import scan
from slotwise.plans import catalog as _c
from slotwise.sources.fixtures import Fleet

_c.load_all()
HOT = 7


@pytest.fixture(scope="module")
def skewed(spark):
    fx = Fleet(spark, SF_CHECK)
    hot = F.when(F.col("seq") % 3 == 0, F.lit(HOT)).otherwise(F.col("device_id"))
    base = tempfile.mkdtemp(prefix="slotwise-hot-")
    fx.action.withColumn("device_id", hot).write.parquet(f"{base}/fx_action")
    (fx.run.withColumn("device_id", F.when(F.col("run_id") % 3 == 0, F.lit(HOT)).otherwise(F.col("device_id")))
       .write.parquet(f"{base}/fx_run"))
    con = duckdb.connect()
    for t in ("fx_action", "fx_run"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{base}/{t}/*.parquet')")
    return spark.read.parquet(f"{base}/fx_action"), spark.read.parquet(f"{base}/fx_run"), con


def _same(df, con, name):
    rel = con.sql(_c.oracle_bodies()[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())


@pytest.fixture
def many_ranges(spark):
    setting = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in setting}
    for k, v in setting.items():
        spark.conf.set(k, v)
    yield
    for k, v in was.items():
        spark.conf.set(k, v)


def test_hot_device_stays_exact(spark, skewed, many_ranges):
    actions, runs, con = skewed
    top = actions.groupBy("device_id").count().orderBy(F.desc("count")).first()
    assert top["device_id"] == HOT and top["count"] * 3 >= actions.count() * 0.9
    _same(LC.lifecycle(actions), con, "w9_lifecycle")
    _same(LC.step_gate(actions), con, "w8_step_gate")
    _same(LC.admit_runs(runs), con, "w10_admit_runs")
    _same(LC.overlapping_runs(runs), con, "j10_overlapping_runs")
    acts = actions
    waits = LC.wait_for(acts.where(F.col("action") == "apply").select("device_id", "seq", "ts"),
                        acts.where(F.col("action") == "reboot").select("device_id", "ts"),
                        interval_s=LC.HOUR, timeout_s=6 * LC.HOUR)
    _same(waits, con, "j11_wait_for")


def test_hot_device_chunks_are_small(spark, skewed):
    actions, _, _ = skewed
    per_chunk = (scan.ranged(actions.withColumn("t", F.unix_micros(F.col("ts").cast("timestamp"))), "t", 40)
                     .groupBy("device_id", "chunk").count().agg(F.max("count")).first()[0])
    per_device = actions.groupBy("device_id").count().agg(F.max("count")).first()[0]
    assert per_chunk * 20 < per_device   # the hot device's work is spread over many tasks


def test_hot_day_is_split(spark):
    # all rows of one device within one day, most of them within one hour
    t = F.when(F.col("id") % 10 == 0, F.col("id") * 80).otherwise(3_600_000 + F.col("id") * 3)
    one = spark.range(100_000).select(F.lit(1).alias("k"), "id", t.alias("t"))
    sizes = scan.ranged(one, "t", 50).groupBy("k", "chunk").count()
    top, n = sizes.agg(F.max("count"), F.count("*")).first()
    assert n >= 45 and top < 4 * 100_000 / 50


def brute_admissions(runs):
    """{run_id: admitted} by walking the runs of each device in order."""
    until, out = {}, {}
    for device, start, run, end in sorted(runs):
        out[run] = device not in until or start >= until[device]
        if out[run]:
            until[device] = end
    return out


@pytest.mark.parametrize("seed", range(4))
def test_admissions_and_overlaps_of_odd_runs(spark, many_ranges, seed):
    """Ties, runs without length, backward ones, ones over the whole time; all devices over several ranges."""
    rnd = random.Random(seed)
    runs = []
    for i in range(1500):
        start = rnd.randrange(0, 900) // 3 * 3
        length = rnd.choice([0, 0, 1, 2, 5, 40, -3, rnd.choice([0, 3000])])
        runs.append((rnd.choice([1, 1, 1, 2, 3]), start, i, start + length))
    df = spark.createDataFrame(runs, "device_id long, s long, run_id long, e long").select(
        "device_id", "run_id", F.timestamp_seconds("s").alias("start_ts"), F.timestamp_seconds("e").alias("end_ts"))
    got = {r["run_id"]: (r["admitted"], r["exit_code"]) for r in LC.admit_runs(df).collect()}
    assert got == {k: (v, int(not v)) for k, v in brute_admissions(runs).items()}
    by_device = {}
    for d, s, i, e in runs:
        by_device.setdefault(d, []).append((s, e, i))
    want = sorted((d, min(a[2], b[2]), max(a[2], b[2])) for d, rows in by_device.items() for k, a in enumerate(rows)
                  for b in rows[:k] if a[0] < b[1] and b[0] < a[1])
    assert sorted(tuple(r) for r in LC.overlapping_runs(df).collect()) == want


def test_chain_passes_over_a_range(spark, many_ranges):
    # one run holds the lock while most others come; runs of text ids
    runs = [("d", 0, "r0", 5), ("d", 6, "r1", 5000), *(("d", 10 + i, f"s{i:04d}", 11 + i) for i in range(2000)), ("d", 6000, "t", 6001)]
    df = spark.createDataFrame(runs, "device_id string, s long, run_id string, e long").select(
        "device_id", "run_id", F.timestamp_seconds("s").alias("start_ts"), F.timestamp_seconds("e").alias("end_ts"))
    assert {r["run_id"] for r in LC.admit_runs(df).collect() if r["admitted"]} == {"r0", "r1", "t"}
    assert LC.overlapping_runs(df).count() == 2000


def test_empty_histories(spark):
    runs = spark.createDataFrame([], "run_id long, device_id long, start_ts timestamp, end_ts timestamp")
    assert LC.admit_runs(runs).count() == LC.overlapping_runs(runs).count() == 0
    actions = spark.createDataFrame([], "device_id long, seq long, ts timestamp, action string")
    assert LC.lifecycle(actions).count() == LC.step_gate(actions).count() == 0


def test_rounds_touch_a_few_rows_a_range(spark, tmp_path, many_ranges):
    """The links walked between ranges are a few for each range, not for each run."""
    runs = spark.range(20_000).select(F.col("id").alias("run_id"), F.lit(HOT).cast("long").alias("device_id"),
                                      F.timestamp_seconds(F.col("id") * 10).alias("start_ts"),
                                      F.timestamp_seconds(F.col("id") * 10 + 15 + F.col("id") % 7).alias("end_ts"))
    laid = LC._laid_runs(runs)
    pieces = LC._ordered(laid).mapInArrow(LC.R.pieces_of_range, "device_id long, chunk int, upto long, exit long, exit_end long, last_start long")
    ranges = laid.select("chunk").distinct().count()
    assert ranges >= 30 and pieces.count() <= 10 * ranges
    assert LC._lock_entries(pieces).count() == ranges - 1


def test_no_plan_holds_edges_and_ranges_follow_the_partitions(spark):
    df = spark.range(50_000).select(F.lit(1).alias("k"), F.col("id").alias("t"), "id")
    t0 = time.time()
    laid = scan.ranged(df, ["k", "t"], 500)
    out = scan.carry_last(laid, ["k"], ["t"], F.col("id"), "before")
    assert len(out._jdf.queryExecution().analyzed().toString()) < 20_000
    assert time.time() - t0 < 60 and laid.select("chunk").distinct().count() >= 450
    assert out.where("before = t - 1").count() == 49_999


def test_one_device_with_all_runs(spark, tmp_path):
    # a long busy chain on one device: run i holds the lock 1.5 starts long
    n = 20_000
    runs = spark.range(n).select(F.col("id").alias("run_id"), F.lit(HOT).alias("device_id"),
                                 F.timestamp_seconds(F.col("id") * 10).alias("start_ts"),
                                 F.timestamp_seconds(F.col("id") * 10 + 15).alias("end_ts"))
    runs.write.parquet(str(tmp_path / "runs"))
    got = LC.admit_runs(spark.read.parquet(str(tmp_path / "runs"))).groupBy("admitted").count().collect()
    assert {r["admitted"]: r["count"] for r in got} == {True: n // 2, False: n // 2}
