"""Streams against their batch twins; the driver contract."""

from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from slotwise.plans import catalog as _c
from slotwise.sources import readers as R
from slotwise.sources.fixtures import Fleet

_c.load_all()


def _same(spark, name, sf=SF_SMALL):
    from slotwise.check import duck, rows_of
    df = _c.QUERIES[name](spark, sf)
    rel = duck(sf).sql(_c.oracles()[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())


def test_st1_is_complete_and_counts_lines_without_time(spark):
    _same(spark, "st1_stream_log_counts")
    fx = Fleet(spark, SF_SMALL)
    parsed = R.read_log(fx.log).where(F.col("level").isNotNull())
    rows = _c.QUERIES["st1_stream_log_counts"](spark, SF_SMALL)
    assert rows.agg(F.sum("lines")).first()[0] == parsed.count()
    untimed = rows.where(F.col("window_start").isNull())
    assert untimed.agg(F.sum("lines")).first()[0] == parsed.where(F.col("ts").isNull()).count() > 0


def test_st3_equals_j11(spark):
    st3 = _c.QUERIES["st3_stream_wait_for"](spark, SF_SMALL)
    j11 = _c.QUERIES["j11_wait_for"](spark, SF_SMALL)
    cols = ["device_id", "seq", "tick", "timed_out"]
    assert sorted(map(str, st3.select(cols).collect())) == sorted(map(str, j11.select(cols).collect()))


def test_slices_hold_events_out_of_order(spark, tmp_path):
    """The replay really mixes events of one device across micro-batches."""
    from slotwise.plans import q_streams as QS
    fx = Fleet(spark, SF_CHECK)
    QS._actions(fx, str(tmp_path / "a"))
    spans = (spark.read.parquet(str(tmp_path / "a")).where("device_id > 0").groupBy("slice")
                  .agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).orderBy("slice").collect())
    assert len(spans) == 6 or len(spans) == 7
    assert all(x["hi"] > y["lo"] for x, y in zip(spans, spans[1:]))


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_folds_of_the_stateful_processors():
    from slotwise.streaming import operators as ST
    state, out, _ = ST.lifecycle_fold(1, (0, 0, 0), [(1, 1, "write", 0), (2, 2, "apply", 0), (3, 3, "reboot", 0)], 9)
    assert [(r[1], r[3], r[4]) for r in out] == [(1, "write", "staged"), (2, "apply", "accepted"), (3, "reboot", "trial")]
    assert state == (1, 0, 1)
    state, out, due = ST.admit_fold(1, (ST.NONE,), [(0, 1, "run", 6), (5, 2, "run", 8), (10, 3, "run", 12)], 11)
    assert {r[0]: r[2] for r in out} == {1: True, 2: False, 3: True} and state == (12,) and due == 12
    assert ST.admit_fold(1, state, [], 12)[0] == (ST.NONE,)          # the lock is free: no state is kept
    fold = ST.timeout_fold(10)
    state, out, due = fold(1, (0, 0, 0, ST.NONE), [(1, 1, "write", 0), (2, 2, "apply", 0)], 5)
    assert out == [] and due == 12
    state, out, due = fold(1, state, [], 12)
    assert out == [(1, 2, 12, 1, 1, 0)] and due is None
    state, out, _ = fold(1, state, [(20, 3, "commit", 0), (21, 4, "reboot", 0), (22, 5, "reboot", 0)], 30)
    assert out == [] and state == (0, 0, 0, ST.NONE)                 # reported once


def test_st2_timeouts_equal_long_pending_episodes(spark):
    from pyspark.sql import Window

    from slotwise.operators import lifecycle as LC
    out = _c.QUERIES["st2_stream_armed_timeout"](spark, SF_CHECK)
    got = {(r["device_id"], r["pending_since"]) for r in out.collect()}
    # batch twin: episodes of W9 state with armed or trial set
    w9 = LC.lifecycle(Fleet(spark, SF_CHECK).action)
    w = Window.partitionBy("device_id").orderBy("ts", "seq")
    pend = (F.col("armed") == 1) | (F.col("trial") == 1)
    e = (w9.withColumn("pending", pend)
           .withColumn("prev", F.coalesce(F.lag("pending").over(w), F.lit(False)))
           .withColumn("start", F.when(F.col("pending") & ~F.col("prev"), F.col("ts")))
           .withColumn("since", F.last("start", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
           .withColumn("end", F.when(~F.col("pending") & F.col("prev"), F.col("ts"))))
    since_end = (e.select("device_id", "end",
                          F.last("since", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("s"))
                  .where(F.col("end").isNotNull()))
    day = F.expr("INTERVAL 1 DAY")
    closed = {(r["device_id"], r["s"]) for r in since_end.where(F.col("end") >= F.col("s") + day).collect()}
    last = e.groupBy("device_id").agg(F.max_by("pending", F.struct("ts", "seq")).alias("p"),
                                     F.max_by("since", F.struct("ts", "seq")).alias("s"))
    open_ = {(r["device_id"], r["s"]) for r in last.where("p").collect()}
    assert closed and got == closed | open_      # long closed episodes and all that stay open, and nothing else


def test_stateful_stream_runs_where_executors_lack_the_package(tmp_path):
    """Python state functions are pickled by value: a session started from
    another folder (executors cannot import the package) still runs ST4."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "run.py"
    script.write_text(
        "import sys\n"
        f"sys.path.insert(0, {repo!r})\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[4]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "from slotwise.plans import catalog\n"
        "catalog.load_all()\n"
        f"print('ROWS', catalog.QUERIES['st4_stream_admit_runs'](spark, {SF_SMALL!r}).count())\n")
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SLOTWISE_CHECKPOINT_DIR")}
    out = subprocess.run([sys.executable, str(script)], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=600)
    assert "ROWS" in out.stdout, out.stderr[-2000:]


def test_wait_fold_by_definition():
    """However the events are cut into calls, each start comes out once, with the first signal or the timeout."""
    import random

    from slotwise.streaming import operators as ST
    rnd = random.Random(4)
    for _ in range(200):
        interval, timeout = rnd.choice([(1, 10), (3, 10), (4, 12)])
        events = sorted((rnd.randrange(60), k, ("start", "signal")[k], n) for n, k in enumerate(rnd.choices([0, 1], k=rnd.randrange(1, 25))))
        fold, state, got, at = ST.wait_fold(interval, timeout), ([], []), [], 0
        while at < 200:
            upto = at + rnd.randrange(1, 40)
            due = [e for e in events if at <= e[0] < upto]
            state, out, deadline = fold(7, state, due, upto)
            assert (deadline is None) == (state == ([], [])) and (deadline is None or deadline >= upto)
            got += out
            at = upto
        want = []
        for t, k, _, n in events:
            if k == 0:
                signals = [s for s, kind, *_ in events if kind == 1 and t <= s <= t + timeout]
                want.append((7, n, -(-(min(signals) - t) // interval) if signals else None, not signals))
        assert sorted(got, key=str) == sorted(want, key=str)


class Kept:
    """Value and map states of one device in memory, counting what is read and written."""

    def __init__(self):
        self.values, self.rows, self.timers = {}, 0, []

    def _state(self, name):
        outer = self

        class State:
            def exists(self):
                return (name, None) in outer.values

            def get(self):
                return outer.values[name, None]

            def update(self, value):
                outer.values[name, None] = value

            def clear(self):
                outer.values.pop((name, None), None)

            def getValue(self, key):
                outer.rows += len(outer.values[name, key][0])
                return outer.values[name, key]

            def updateValue(self, key, value):
                outer.rows += len(value[0])
                outer.values[name, key] = value

            def removeKey(self, key):
                del outer.values[name, key]
        return State()

    def getMapState(self, name, *_):
        return self._state(name)

    def getValueState(self, name, *_):
        return self._state(name)

    def listTimers(self):
        return list(self.timers)

    def deleteTimer(self, t):
        self.timers.remove(t)

    def registerTimer(self, t):
        self.timers.append(t)


def test_waiting_events_are_read_when_due():
    """A device with 100,000 waiting events: a call touches its new events' slots and those that have come due."""
    import random

    from slotwise.streaming import operators as ST
    rnd = random.Random(6)
    folded = []

    def fold(key, state, events, watermark):
        folded.extend(events)
        return state, [], None

    kept = Kept()
    device = ST.InOrder(fold, "n int", (0,), {"x": "int64"})
    device.init(kept)
    hour = ST.SLOT
    events = [(rnd.randrange(100 * hour), i, "write", 0) for i in range(100_000)]
    device.advance(1, events, 0)
    kept.rows = 0
    late = [(99 * hour + 5, -1, "write", 0), (3 * hour, -2, "write", 0)]
    device.advance(1, late, 2 * hour + hour // 2)
    assert len(folded) == sum(e[0] < 2 * hour + hour // 2 for e in events)
    assert kept.rows < 10 * 1000       # a few slots of about 1,000, not 100,000 events
    for watermark in (2 * hour + hour // 2, 50 * hour, 50 * hour + 1, 200 * hour):
        device.advance(1, [], watermark)
    assert folded == sorted([*events, *late]) and not kept.values and not kept.timers


def test_files_of_a_slice_follow_its_rows(spark, tmp_path):
    from slotwise.streaming.sources import stage_slices
    df = spark.range(6000).selectExpr("id", "id * 1000 AS at")
    files = stage_slices(df, str(tmp_path / "s"), F.col("at"), slices=3, file_rows=500)
    assert files == 4
    found = {}
    for f in spark.read.parquet(str(tmp_path / "s")).inputFiles():
        found.setdefault(f.rsplit("/", 2)[1], []).append(f)
    assert {k: len(v) for k, v in found.items()} == {f"slice={k}": 4 for k in range(3)}
    assert spark.read.parquet(str(tmp_path / "s")).count() == 6000


def test_devices_of_a_bucket_share_a_call():
    """500 devices in one bucket: a micro-batch is one call with few state accesses, and each device is folded by itself."""
    import random

    import pandas as pd

    from slotwise.streaming import operators as ST
    rnd = random.Random(8)
    hour = ST.SLOT
    events = [(rnd.randrange(1000, 1500), rnd.randrange(20 * hour), i, rnd.choice(["write", "apply", "reboot", "commit"]), 0)
              for i in range(20_000)]

    class Time:
        def __init__(self, ms):
            self.ms = ms

        def getCurrentWatermarkInMs(self):
            return self.ms

    class Counted(Kept):
        calls = 0

        def _state(self, name):
            state, outer = super()._state(name), self

            class Counting:
                def __getattr__(self, what):
                    outer.calls += 1
                    return getattr(state, what)
            return Counting()

    kept = Counted()
    bucket = ST.InOrder(ST.lifecycle_fold, "staged int, armed int, trial int", (0, 0, 0), {
        "device_id": "Int64", "seq": "int64", "ts": "datetime64[us]", "action": "object", "outcome": "object",
        "staged": "int32", "armed": "int32", "trial": "int32"})
    bucket.init(kept)
    got = []
    for at in range(4):
        df = pd.DataFrame(events[at::4], columns=["device", "us", "seq", "what", "until"])
        for out in bucket.handleInputRows((3,), iter([df]), Time(0)):
            got += out.itertuples(index=False, name=None)
        assert len(kept.timers) == 1
    for wm in (7 * hour + hour // 3, 30 * hour):
        for out in bucket.handleExpiredTimer((3,), Time(wm // 1000), None):
            got += out.itertuples(index=False, name=None)
    assert kept.calls < 400             # 500 devices a call took thousands
    want = []
    for device in {e[0] for e in events}:
        want += ST.lifecycle_fold(device, (0, 0, 0), sorted(e[1:] for e in events if e[0] == device), 0)[1]
    assert sorted(r[:2] + r[3:] for r in got) == sorted(r[:2] + r[3:] for r in want)
    assert [k for k in kept.values if k[0] != "value"] == [] and not kept.timers


def test_events_without_a_device_are_one_device(spark, tmp_path):
    """As in the batch twin, rows of a null id share a history; they change no other id, however large."""
    from datetime import datetime, timedelta

    from slotwise.plans import q_streams as QS
    from slotwise.streaming import operators as ST
    t, big = datetime(2024, 1, 1), (1 << 60) + 1
    rows = [(d, s, t + timedelta(hours=s), a) for d in (None, big) for s, a in enumerate(("write", "apply", "reboot"))]
    rows.append((-1, 9, datetime(2100, 1, 1), "fail"))
    schema = "device_id long, seq long, ts timestamp_ntz, action string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = ST.lifecycle_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "1 day", 1)
    out = QS.run_available(stream, str(tmp_path), "st2").where("seq < 9").collect()
    assert {(r["device_id"], r["seq"], r["outcome"]) for r in out} == {
        (d, s, o) for d in (None, big) for s, o in enumerate(("staged", "accepted", "trial"))}
