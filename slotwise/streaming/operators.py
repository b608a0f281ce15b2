"""Streaming forms of the log, lifecycle, wait and lock operators.

* ST1 ``log_counts_stream``: A7 per tumbling event-time window, watermarked;
  lines without a time are counted apart.
* ST2 ``lifecycle_stream`` / ``lifecycle_timeouts``: W8 + W9 incrementally.
* ST3 ``wait_for_stream``: J11 incrementally, starts and signals in one stream.
* ST4 ``admit_runs_stream``: W10 incrementally.

ST2, ST3 and ST4 are stateful processors that do not depend on the order in which
events arrive: events wait in the state, by slots of time, until the watermark
has passed them and are then folded device by device in event-time order.  The
key is a bucket of devices by hash, so that the calls of a micro-batch are as
many as the buckets.  State is one small tuple and the events of the last
``watermark`` per device; a device without pending events and with its initial
state keeps none.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from slotwise.sources import readers as R

# Executors need no copy of this package: what they run is pickled by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LIFECYCLE_OUT = ("device_id long, seq long, ts timestamp_ntz, action string, outcome string, "
                 "staged int, armed int, trial int")
ADMIT_OUT = "run_id long, device_id long, admitted boolean, exit_code int"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# --- ST1 --------------------------------------------------------------------

def log_counts_stream(lines: DataFrame, window: str = "1 hour", watermark: str = "1 hour") -> DataFrame:
    """ST1: lines per device, level and event-time window.

    ``lines``: device_id, seq, line, arrived.  Lines later than the watermark
    are dropped.  A line without a time is placed by its arrival, so that its
    window closes, and marked ``timed = false``: see :func:`log_totals`.
    """
    parsed = R.read_log(lines, "arrived").where(F.col("level").isNotNull())
    at = F.coalesce(F.col("ts").cast("timestamp"), F.col("arrived"))   # watermarks need TIMESTAMP
    return (parsed.select("device_id", "level", F.col("ts").isNotNull().alias("timed"), at.alias("at"))
                  .withWatermark("at", watermark)
                  .groupBy(F.window("at", window).alias("w"), "timed", "device_id", "level")
                  .agg(F.count(F.lit(1)).alias("lines"))
                  .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                          F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                          "timed", "device_id", "level", "lines"))


def log_totals(counts: DataFrame) -> DataFrame:
    """Batch step after ST1: the windows of timed lines, and one row without a window for the others."""
    return (counts.groupBy(F.when(F.col("timed"), F.col("window_start")).alias("window_start"),
                           F.when(F.col("timed"), F.col("window_end")).alias("window_end"), "device_id", "level")
                  .agg(F.sum("lines").alias("lines")))


# --- ordered state ----------------------------------------------------------

Event = tuple[int, int, str, int]       # time (us), seq, what, until (us)
EVENTS = "device array<long>, us array<long>, seq array<long>, what array<string>, until array<long>"
SLOT = 3_600_000_000    # width of a slot of waiting events in us
BUCKETS = 64            # of devices, at least
BUCKET_ROWS = 1 << 15   # rows of a bucket over a whole stream, about
NOBODY = -1             # the bucket of the device without an id
# fold(key, state, events in order, watermark in us) -> (state, output rows, next deadline in us or None)
Fold = Callable[[int, tuple, list[Event], int], tuple[tuple, list[tuple], "int | None"]]


class InOrder(StatefulProcessor):
    """Folds each device's events in order of (time, seq), however they arrive.

    A key of the stream is a bucket of devices: one call, one timer and a few
    reads and writes of state serve them all.  A bucket's events wait until the
    watermark has passed them, in a map state keyed by the slot of time they lie
    in and a number: a call adds its new events as further pieces of their slots
    and reads the slots that have come due, whatever else waits.  A small index
    tells which slots there are, their pieces and the first event of each.  The
    folds' states are arrays of one value; a device in its initial state is not
    in it.  An event-time timer wakes the bucket for the next event, or for the
    first deadline of a fold.
    """

    def __init__(self, fold: Fold, state: str, initial: tuple, columns: dict[str, str]):
        self.fold, self.initial, self.columns = fold, initial, columns
        fields = [f.split() for f in state.split(", ")]
        self.schema = ", ".join(["device array<long>", *(f"{name} array<{kind}>" for name, kind in fields)])

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "slot long, piece long", EVENTS)
        self.index = handle.getValueState("index", "slot array<long>, pieces array<long>, first array<long>")
        self.value = handle.getValueState("value", self.schema)

    def handleInputRows(self, key, rows, timerValues):
        new: dict[int, list[Event]] = {}
        for df in rows:
            for device, *event in zip(*(df[c].tolist() for c in ("device", "us", "seq", "what", "until"))):
                new.setdefault(device, []).append(tuple(event))
        yield self.advance_all(new, timerValues.getCurrentWatermarkInMs() * 1000, int(key[0]) == NOBODY)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield self.advance_all({}, timerValues.getCurrentWatermarkInMs() * 1000, int(key[0]) == NOBODY)

    def stored(self, slot: int, pieces: int) -> list[tuple]:
        """Take the (device, event...) rows of a slot out of the state."""
        rows = []
        for k in range(pieces):
            rows.extend(zip(*self.waiting.getValue((slot, k))))
            self.waiting.removeKey((slot, k))
        return rows

    def due(self, new: dict[int, list[Event]], watermark: int) -> tuple[dict[int, list[Event]], "int | None"]:
        """Each device's events before the watermark, out of those waiting and the new ones, and the time of the first that waits on."""
        index = {s: (n, first) for s, n, first in zip(*self.index.get())} if self.index.exists() else {}
        before = dict(index)
        ready: dict[int, list[Event]] = {}
        later: dict[int, list[tuple]] = {}

        def place(device: int, e: Event) -> None:
            if e[0] < watermark:
                ready.setdefault(device, []).append(e)
            else:
                later.setdefault(e[0] // SLOT, []).append((device, *e))

        for device, events in new.items():
            for e in events:
                place(device, e)
        for slot in [s for s, (_, first) in index.items() if first < watermark]:
            for device, *e in self.stored(slot, index.pop(slot)[0]):
                place(device, tuple(e))     # those of the slot that the watermark stands in go back
        for slot, rows in later.items():
            n, first = index.get(slot, (0, rows[0][1]))
            self.waiting.updateValue((slot, n), tuple(map(list, zip(*rows))))
            index[slot] = n + 1, min(first, min(r[1] for r in rows))
        if index != before:
            if index:
                self.index.update((list(index), *map(list, zip(*index.values()))))
            else:
                self.index.clear()
        for events in ready.values():
            events.sort()
        return ready, min((first for _, first in index.values()), default=None)

    def advance(self, device: int, new: list[Event], watermark: int) -> pd.DataFrame:
        """A call with the new events of one device."""
        return self.advance_all({device: new} if new else {}, watermark)

    def advance_all(self, new: dict[int, list[Event]], watermark: int, nobody: bool = False) -> pd.DataFrame:
        """A call with each device's new events; ``nobody``: those of the device without an id."""
        due, waits = self.due(new, watermark)
        states = {device: tuple(state) for device, *state in zip(*self.value.get())} if self.value.exists() else {}
        before = dict(states)
        out, wake = [], [] if waits is None else [waits]
        for device in {**states, **due}:
            state, rows, deadline = self.fold(None if nobody else device, states.get(device, self.initial),
                                              due.get(device, []), watermark)
            if state != self.initial:
                states[device] = state
            else:
                states.pop(device, None)
            out.extend(rows)
            if deadline is not None:
                wake.append(deadline)
        if states != before:
            if states:
                self.value.update((list(states), *map(list, zip(*states.values()))))
            else:
                self.value.clear()
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if wake:
            self.handle.registerTimer(max(min(wake), watermark) // 1000 + 1)
        return pd.DataFrame(out, columns=list(self.columns)).astype(self.columns)

    def close(self) -> None:
        pass


def buckets_for(rows: int) -> int:
    """Buckets of devices for a stream of about so many rows: a bucket's call has a part of ``BUCKET_ROWS``."""
    return max(BUCKETS, -(-rows // BUCKET_ROWS))


def _in_order(events: DataFrame, fold: Fold, state: str, initial: tuple, out: str, columns: dict[str, str],
              watermark: str, buckets: int) -> DataFrame:
    """``events``: device_id, at (timestamp), us, seq, what, until.  Needs the RocksDB state store, which is switched on.

    ``buckets``: keys that the devices are dealt to by hash.  It is part of the
    state: a stream goes on from its checkpoint with the number it began with.
    """
    spark = events.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) != ROCKSDB_PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    device = F.col("device_id")
    keyed = events.select(F.when(device.isNull(), NOBODY).otherwise(F.pmod(F.xxhash64(device), F.lit(buckets))).alias("bucket"),
                          F.coalesce(device.cast("long"), F.lit(0)).alias("device"), "at", "us", "seq", "what", "until")
    return keyed.withWatermark("at", watermark).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=InOrder(fold, state, initial, columns), outputStructType=out, outputMode="Append",
        timeMode="EventTime")


def _action_events(actions: DataFrame) -> DataFrame:
    at = F.col("ts").cast("timestamp")
    return actions.select("device_id", at.alias("at"), F.unix_micros(at).alias("us"), "seq", F.col("action").alias("what"),
                          F.lit(0).cast("long").alias("until"))


# --- ST2 --------------------------------------------------------------------

def step_machine(action: str, staged: int, armed: int, trial: int) -> tuple[int, int, int, str]:
    """State after one action, and its outcome."""
    if action == "write":
        return 1, armed, trial, "staged"
    if action == "apply":
        return (staged, 1, 0, "accepted") if staged else (staged, armed, trial, "Nothing to apply.")
    if action == "reboot":
        if armed:
            return staged, 0, 1, "trial"
        if trial:
            return staged, armed, 0, "rollback"
        return staged, armed, trial, "plain"
    if action == "commit":
        return (0, armed, 0, "accepted") if staged else (staged, armed, trial, "Nothing to commit.")
    return staged, armed, trial, "no change"


def lifecycle_fold(key: int, state: tuple, events: list[Event], watermark: int):
    out = []
    for us, seq, action, _ in events:
        *bits, outcome = step_machine(action, *state)
        state = tuple(bits)
        out.append((key, seq, pd.Timestamp(us, unit="us"), action, outcome, *state))
    return state, out, None


def lifecycle_stream(actions: DataFrame, watermark: str = "1 hour", buckets: int = BUCKETS) -> DataFrame:
    """ST2: outcome and state after every event, in event-time order; events later than ``watermark`` are dropped."""
    return _in_order(_action_events(actions), lifecycle_fold, "staged int, armed int, trial int", (0, 0, 0), LIFECYCLE_OUT,
                     {"device_id": "Int64", "seq": "int64", "ts": "datetime64[us]", "action": "object", "outcome": "object",
                      "staged": "int32", "armed": "int32", "trial": "int32"}, watermark, buckets)


# an episode's outcome, by the state it was in at its deadline
ARMED_OUTCOME, TRIAL_OUTCOME = "armed but never tried", "on trial but never committed"
NONE, REPORTED = -1, -2     # no episode open; the open episode has been reported
NEVER = (1 << 63) - 1       # the end of a run that has none: its lock is held throughout


def timeout_fold(timeout_us: int) -> Fold:
    """One row per episode in which a device stayed armed or on trial for ``timeout_us`` without commit or rollback."""
    def fold(key: int, state: tuple, events: list[Event], watermark: int):
        *bits, since = state
        out = []

        def report(now: int) -> None:
            nonlocal since
            if since >= 0 and now >= since + timeout_us:
                out.append((key, since, since + timeout_us, *bits))
                since = REPORTED

        for us, _, action, _ in events:
            report(us)
            *bits, _outcome = step_machine(action, *bits)
            if not (bits[1] or bits[2]):
                since = NONE
            elif since == NONE:
                since = us
        # no event before the watermark can still come
        report(watermark)
        return (*bits, since), out, since + timeout_us if since >= 0 else None
    return fold


def lifecycle_timeouts(actions: DataFrame, timeout_s: int, watermark: str = "1 hour", buckets: int = BUCKETS) -> DataFrame:
    """ST2 timeout: episodes in which a device stayed armed (or on trial)
    without a commit or rollback for ``timeout_s`` of event time, reported once
    each, when the watermark passes the deadline."""
    kinds = {"device_id": "Int64", "since": "int64", "fired": "int64", "staged": "int32", "armed": "int32", "trial": "int32"}
    out = _in_order(_action_events(actions), timeout_fold(timeout_s * 1_000_000),
                    "staged int, armed int, trial int, since long", (0, 0, 0, NONE),
                    "device_id long, since long, fired long, staged int, armed int, trial int", kinds, watermark, buckets)
    return out.select("device_id",
                      F.timestamp_micros("since").cast("timestamp_ntz").alias("pending_since"),
                      F.timestamp_micros("fired").cast("timestamp_ntz").alias("deadline"),
                      F.when(F.col("armed") == 1, ARMED_OUTCOME).otherwise(TRIAL_OUTCOME).alias("outcome"), "staged", "armed", "trial")


# --- ST4 --------------------------------------------------------------------

def admit_fold(key: int, state: tuple, events: list[Event], watermark: int):
    """Greedy lock admission; the state is the end of the lock held, forgotten once it is past."""
    (held,) = state
    out = []
    for us, run, _, until in events:
        ok = held == NONE or us >= held
        if ok:
            held = until
        out.append((run, key, ok, 0 if ok else 1))
    return (NONE if held <= watermark else held,), out, held if held > watermark else None


def admit_runs_stream(runs: DataFrame, watermark: str = "1 hour", buckets: int = BUCKETS) -> DataFrame:
    """ST4: lock admission in order of (start, run_id); runs that start before the watermark are dropped."""
    at, end = F.col("start_ts").cast("timestamp"), F.col("end_ts").cast("timestamp")
    events = runs.select("device_id", at.alias("at"), F.unix_micros(at).alias("us"), F.col("run_id").alias("seq"),
                         F.lit("run").alias("what"), F.coalesce(F.unix_micros(end), F.lit(NEVER)).alias("until"))
    return _in_order(events, admit_fold, "held long", (NONE,), ADMIT_OUT,
                     {"run_id": "int64", "device_id": "Int64", "admitted": "bool", "exit_code": "int32"}, watermark, buckets)


# --- ST3 --------------------------------------------------------------------

def wait_fold(interval_us: int, timeout_us: int) -> Fold:
    """One row per start: the first poll tick at which a signal has come, or the timeout.

    The state is the starts still open, in order of time; the first signal
    answers all of them, so a device without open starts keeps none.
    """
    def fold(key: int, state: tuple, events: list[Event], watermark: int):
        open_ = list(zip(*state))
        out = []

        def expire(now: int) -> None:
            late = 0
            while late < len(open_) and open_[late][0] + timeout_us < now:
                out.append((key, open_[late][1], None, True))
                late += 1
            del open_[:late]

        for us, _, what, seq in events:
            expire(us)
            if what == "start":
                open_.append((us, seq))
            else:
                out.extend((key, own, -((t - us) // interval_us), False) for t, own in open_)
                open_.clear()
        # no event before the watermark can still come
        expire(watermark)
        state = tuple(map(list, zip(*open_))) if open_ else ([], [])
        return state, out, open_[0][0] + timeout_us if open_ else None
    return fold


def wait_for_stream(events: DataFrame, interval_s: int = 3600, timeout_s: int = 21_600, watermark: str = "1 hour",
                    buckets: int = BUCKETS) -> DataFrame:
    """ST3 (= J11): device_id, seq, tick, timed_out, one row per start.

    ``events(device_id, seq, ts, kind)`` with kind ``start`` or ``signal``, in
    any order of arrival; events later than ``watermark`` are dropped.  A
    signal at the time of a start counts for it, and so does one at the
    timeout.  A row comes out once the watermark has passed what decides it.
    """
    at = F.col("ts").cast("timestamp")
    rows = events.where(F.col("kind").isin("start", "signal")).select(
        "device_id", at.alias("at"), F.unix_micros(at).alias("us"),
        F.when(F.col("kind") == "start", 0).otherwise(1).cast("long").alias("seq"),       # signals after starts of one time
        F.col("kind").alias("what"), F.coalesce(F.col("seq").cast("long"), F.lit(0)).alias("until"))
    return _in_order(rows, wait_fold(interval_s * 1_000_000, timeout_s * 1_000_000), "t array<long>, seq array<long>", ([], []),
                     "device_id long, seq long, tick long, timed_out boolean",
                     {"device_id": "Int64", "seq": "int64", "tick": "Int64", "timed_out": "bool"}, watermark, buckets)
