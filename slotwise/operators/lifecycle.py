"""Update lifecycle over event histories: gates, state, lock admission,
overlapping runs and waits.

Histories are unbounded per device, and one device may hold a large share of
all events.  Every ordered pass here therefore goes through
:mod:`slotwise.operators.scan`, which splits the histories into ranges of equal
row share; what reaches from one range into the next is a small summary, so no
task holds more of a hot device than a range.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotwise.operators import runs as R
from slotwise.operators import scan
from slotwise.session import checkpoint_dir

DAY = 86_400
HOUR = 3_600
NEVER = (1 << 63) - 1   # a lock held throughout


def _micros(ts: str):
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _level(df: DataFrame) -> DataFrame:
    """Store small intermediate rows in the checkpoint folder, so that rounds over them do not pile up."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def lifecycle(actions: DataFrame) -> DataFrame:
    """W8 + W9: outcome and state after every event.

    ``actions(device_id, seq, ts, action)`` with action in write / apply /
    reboot / commit / fail.  State machine (start 0/0/0):

    * write: staged := 1
    * apply: if staged then armed := 1, trial := 0 else "Nothing to apply."
    * reboot: armed -> trial (armed := 0, trial := 1); else trial -> rollback
      (trial := 0); else plain
    * commit: if staged then staged := 0, trial := 0 else "Nothing to commit."

    Each state bit is "last value set before the row", or the bit at the
    range's beginning where nothing has set it.  What sets ``armed`` depends on
    ``staged``, what sets ``trial`` on both, so a range keeps armed for either
    staged it may begin with, and trial for all four beginnings: seven columns
    of one window pass.  A range's last values of them are its map from the
    eight states it may begin with to those it ends with; chaining these maps,
    one row a range, gives every range its true beginning.
    """
    laid = scan.ranged(actions.select("device_id", "seq", "ts", "action"), ["device_id", "ts", "seq"])
    # a device within one range begins it with nothing staged, armed or on trial
    beyond = laid.join(F.broadcast(scan.crossing(laid, "device_id")), "device_id", "left_semi")
    after = ", ".join(f"coalesce({v}, {c}) AS {c}" for c, v in _SETS.items())
    maps = (_hypotheses(beyond).selectExpr("device_id", "chunk", "ts", "seq", f"struct({after}) AS m")
                               .groupBy("device_id", "chunk").agg(F.max_by("m", F.struct("ts", "seq")).alias("m"))
                               .select("device_id", "chunk", "m.*"))
    earlier = "OVER (PARTITION BY device_id ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    begins = (maps.selectExpr("*", f"coalesce(last(staged_, true) {earlier}, 0) AS staged_in")
                  .selectExpr("*", f"coalesce(last({_ARMED}, true) {earlier}, 0) AS armed_in")
                  .selectExpr("*", f"coalesce(last({_TRIAL}, true) {earlier}, 0) AS trial_in")
                  .selectExpr("device_id", "chunk", "staged_in", "armed_in", "trial_in").where("staged_in + armed_in + trial_in > 0"))
    rows = (_hypotheses(laid).join(begins, ["device_id", "chunk"], "left").fillna(0, ["staged_in", "armed_in", "trial_in"])
            .selectExpr("device_id", "seq", "ts", "action", "coalesce(staged_, staged_in) AS staged_before",
                        f"coalesce({_ARMED}, armed_in) AS armed_before", f"coalesce({_TRIAL}, trial_in) AS trial_before"))
    done = "action IN ('apply', 'commit') AND staged_before = 1"
    return rows.selectExpr(
        "device_id", "seq", "ts", "action",
        f"""CASE WHEN action = 'write' THEN 'staged' WHEN {done} THEN 'accepted' WHEN action = 'apply' THEN 'Nothing to apply.'
             WHEN action = 'commit' THEN 'Nothing to commit.' WHEN action <> 'reboot' THEN 'no change'
             WHEN armed_before = 1 THEN 'trial' WHEN trial_before = 1 THEN 'rollback' ELSE 'plain' END AS outcome""",
        "CASE action WHEN 'write' THEN 1 WHEN 'commit' THEN 0 ELSE staged_before END AS staged",
        f"CASE WHEN action = 'apply' AND {done} THEN 1 WHEN action = 'reboot' THEN 0 ELSE armed_before END AS armed",
        f"CASE WHEN action = 'reboot' THEN armed_before WHEN {done} THEN 0 ELSE trial_before END AS trial")


# What an event sets each bit to (NULL: nothing), by the bits its range may begin with: armed_<staged>, trial_<staged><armed>.
_SETS = {"staged_": "CASE action WHEN 'write' THEN 1 WHEN 'commit' THEN 0 END"}
_SETS |= {f"armed_{h}": f"CASE WHEN action = 'apply' AND coalesce(staged_, {h}) = 1 THEN 1 WHEN action = 'reboot' THEN 0 END"
          for h in (0, 1)}
_SETS |= {f"trial_{h}{g}": f"CASE WHEN action = 'reboot' THEN coalesce(armed_{h}, {g}) "
                           f"WHEN action IN ('apply', 'commit') AND coalesce(staged_, {h}) = 1 THEN 0 END" for h in (0, 1) for g in (0, 1)}
# the columns that hold under the bits a range does begin with
_ARMED = "CASE staged_in WHEN 1 THEN armed_1 ELSE armed_0 END"
_TRIAL = "CASE 2 * staged_in + armed_in WHEN 0 THEN trial_00 WHEN 1 THEN trial_01 WHEN 2 THEN trial_10 ELSE trial_11 END"


def _hypotheses(laid: DataFrame) -> DataFrame:
    """``laid`` with the columns of ``_SETS`` as last set before each row inside its range, NULL where as the range began."""
    before = "OVER (PARTITION BY device_id, chunk ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    rows = scan.dealt(laid, ["device_id"])
    for stage in ("staged", "armed", "trial"):
        rows = rows.selectExpr("*", *(f"last({v}, true) {before} AS {c}" for c, v in _SETS.items() if c.startswith(stage)))
    return rows


def step_gate(actions: DataFrame) -> DataFrame:
    """Verdict of every apply and commit ("accepted" or the refusal).

    It only asks what was staged, so one carry over the events that bear on it is enough.
    """
    act = F.col("action")
    order = ["ts", "seq"]
    a = scan.ranged(actions.where(act.isin("write", "apply", "commit")).select("device_id", "seq", "ts", "action"), ["device_id", *order])
    a = scan.carry_last(a, ["device_id"], order, F.when(act == "write", 1).when(act == "commit", 0), "staged")
    verdict = (F.when(F.col("staged") == 1, F.lit("accepted"))
                .otherwise(F.when(act == "apply", F.lit("Nothing to apply.")).otherwise(F.lit("Nothing to commit."))))
    return a.where(act != "write").select("device_id", "seq", "action", verdict.alias("verdict"))


def _laid_runs(runs: DataFrame) -> DataFrame:
    """device_id, run_id, s, e, chunk: the runs in ranges of (device, start, run_id)."""
    rows = runs.select("device_id", "run_id", _micros("start_ts").alias("s"), _micros("end_ts").alias("e"))
    return scan.ranged(rows, ["device_id", "s", "run_id"])


def _ordered(laid: DataFrame) -> DataFrame:
    """The rows of each range in order; the partitions are the ranges as stored."""
    return laid.sortWithinPartitions("device_id", "s", "run_id")


def _lock_entries(pieces: DataFrame) -> DataFrame:
    """device_id, chunk, entry: until when the lock is held as a range begins (``NEVER`` freed: the range is passed over).

    ``pieces``: what :func:`runs.pieces_of_range` says of the ranges.  The
    holder that leaves a range meets the next piece of its device that reaches
    its end; these links of exits, a few rows a range, are walked from each
    device's first range by doubling: a round adds to the exits reached those
    2^k links on, and squares the links.
    """
    of = Window.partitionBy("device_id")
    pieces = _level(pieces.withColumns({"first": F.min("chunk").over(of), "more": F.max("chunk").over(of)})
                          .where(F.col("first") < F.col("more")).drop("more"))
    # a run without length may leave its range with an end that is no later than the range's last start
    late = F.col("exit_end") > F.col("last_start")
    ends = pieces.select("device_id", "exit", "exit_end", "last_start", "chunk").distinct().select(
        "device_id", F.when(late, F.col("exit_end")).otherwise(F.col("last_start")).alias("t"),
        F.when(late, -1).otherwise(F.col("chunk")).alias("k1"), F.when(late, 0).otherwise(2).alias("k2"),
        F.lit(None).cast("int").alias("chunk"), F.lit(None).cast(pieces.schema["exit"].dataType).alias("to"), F.col("exit").alias("of"))
    marks = pieces.select("device_id", F.col("upto").alias("t"), F.col("chunk").alias("k1"), F.lit(1).alias("k2"), "chunk",
                          F.col("exit").alias("to"), F.lit(None).cast(pieces.schema["exit"].dataType).alias("of"))
    later = (Window.partitionBy("device_id").orderBy(F.desc("t"), F.desc("k1"), F.desc("k2"))
                   .rowsBetween(Window.unboundedPreceding, -1))
    met = F.last(F.when(F.col("to").isNotNull(), F.struct("chunk", "to")), ignorenulls=True).over(later)
    link = _level(marks.unionByName(ends).withColumn("met", met).where(F.col("of").isNotNull() & F.col("met").isNotNull())
                       .select("device_id", "of", F.col("t").alias("entry"), "met.chunk", "met.to"))
    reached = (pieces.where(F.col("chunk") == F.col("first")).groupBy("device_id").agg(F.min_by("exit", "upto").alias("of")))
    longest = pieces.groupBy("device_id").agg(F.count_distinct("chunk").alias("n")).agg(F.max("n")).first()[0] or 0
    jump = link.select("device_id", "of", "to")
    for k in range(math.ceil(math.log2(longest)) if longest > 1 else 0):
        reached = _level(reached.union(reached.join(jump, ["device_id", "of"]).select("device_id", F.col("to").alias("of"))).distinct())
        jump = _level(jump.join(jump.select("device_id", F.col("of").alias("to"), F.col("to").alias("on")), ["device_id", "to"])
                          .select("device_id", "of", F.col("on").alias("to")))
    entered = link.join(reached, ["device_id", "of"]).select("device_id", "chunk", "entry")
    return (pieces.where(F.col("chunk") > F.col("first")).select("device_id", "chunk").distinct()
                  .join(entered, ["device_id", "chunk"], "left")
                  .select("device_id", "chunk", F.coalesce("entry", F.lit(NEVER)).alias("entry")))


def admit_runs(runs: DataFrame) -> DataFrame:
    """Which runs get the non-blocking lock.

    A run is admitted iff no admitted run still holds it (greedy in
    ``start, run_id`` order): a chain from a device's first run, each followed
    by the first that starts at or after its end.  Runs are stored in ranges of
    (device, start); a range folds its chains to pieces, from who comes in to
    who leaves; the pieces of devices that reach over several ranges tell how
    the lock is held as each range begins; one pass over the ranges then marks
    the chains.  The history moves once.  Only a range's first device can have
    begun before it, so the entries are at most one row a range, which bounds
    what is broadcast.
    """
    laid = _laid_runs(runs)
    ids = {c: laid.schema[c].dataType.simpleString() for c in ("device_id", "run_id")}
    pieces = _ordered(laid).mapInArrow(R.pieces_of_range, f"device_id {ids['device_id']}, chunk int, upto long, exit {ids['run_id']}, "
                                                          "exit_end long, last_start long")
    entries = _lock_entries(pieces)
    rows = _ordered(laid.join(F.broadcast(entries), ["device_id", "chunk"], "left"))
    done = rows.select("device_id", "run_id", "s", "e", "entry").mapInArrow(
        R.admissions_of_range, f"run_id {ids['run_id']}, device_id {ids['device_id']}, admitted boolean")
    return done.withColumn("exit_code", F.when(F.col("admitted"), F.lit(0)).otherwise(F.lit(1)))


def overlapping_runs(runs: DataFrame) -> DataFrame:
    """Pairs of runs of one device whose intervals overlap (the lock
    conflict report), ``start_a < end_b and start_b < end_a``.

    Runs are stored in ranges of (device, start).  A range pairs the runs that
    start in it; a run still open at its end is a guest of every later range
    that begins before the run ends, and is paired there with the runs that
    start before its end.  A guest meets at least one run in each such range,
    so there are no more guests than pairs; nothing is paired and then dropped
    but runs without length.
    """
    laid = _laid_runs(runs)
    ids = {c: laid.schema[c].dataType.simpleString() for c in ("device_id", "run_id")}
    pair = f"device_id {ids['device_id']}, run_a {ids['run_id']}, run_b {ids['run_id']}"
    own = _ordered(laid).mapInArrow(R.overlaps_of_range, pair)
    edges = _level(_ordered(laid).mapInArrow(
        R.open_at_end, f"device_id {ids['device_id']}, chunk int, t long, run_id {ids['run_id']}, s long, e long"))
    # the last range of the device that begins before the end of an open run
    head = F.col("run_id").isNull()
    upto = (Window.partitionBy("device_id").orderBy("t", F.when(head, 1).otherwise(0), "chunk").rowsBetween(Window.unboundedPreceding, -1))
    guests = (edges.withColumn("upto", F.max(F.when(head, F.col("chunk"))).over(upto))
                   .where(~head & (F.col("upto") > F.col("chunk")))
                   .select("device_id", F.explode(F.sequence(F.col("chunk") + 1, F.col("upto"))).alias("chunk"), "run_id", "s", "e",
                           F.lit(True).alias("guest")))
    # a range has at most one first device
    visited = F.broadcast(guests.select("device_id", "chunk").distinct())
    hosts = laid.join(visited, ["device_id", "chunk"], "left_semi").select("device_id", "chunk", "run_id", "s", "e", F.lit(False).alias("guest"))
    met = (guests.unionByName(hosts).repartition("device_id", "chunk")
                 .sortWithinPartitions("device_id", "chunk", F.desc("guest"), "s", "run_id"))
    return own.unionByName(met.mapInArrow(R.overlaps_with_guests, pair))


def wait_for(starts: DataFrame, signals: DataFrame, interval_s: int = 1, timeout_s: int = 10) -> DataFrame:
    """Per start, the first poll tick (in intervals) at which a signal of
    the same device has arrived, or a timeout; the tick at ``timeout`` counts.

    ``starts(device_id, seq, ts)``, ``signals(device_id, ts)``.  The first
    signal at or after each start is one backward carry over the merged
    stream (signals sort after starts at equal time).
    """
    st = starts.select("device_id", "seq", _micros("ts").alias("t"), F.lit(0).alias("k"),
                       F.lit(None).cast("long").alias("val"), F.lit(True).alias("is_start"))
    sg = signals.select("device_id", F.lit(None).cast(starts.schema["seq"].dataType).alias("seq"),
                        _micros("ts").alias("t"), F.lit(1).alias("k"), _micros("ts").alias("val"),
                        F.lit(False).alias("is_start"))
    merged = scan.ranged(st.unionByName(sg), ["device_id", "t", "k"])
    found = scan.carry_next(merged, ["device_id"], ["t", "k"], F.col("val"), "sig")
    iv = interval_s * 1_000_000
    dt = F.col("sig") - F.col("t")
    ok = F.col("sig").isNotNull() & (dt <= F.lit(timeout_s * 1_000_000))
    return (found.where(F.col("is_start"))
                 .select("device_id", "seq",
                         F.when(ok, F.floor((dt + F.lit(iv - 1)) / F.lit(iv)).cast("long")).alias("tick"),
                         (~ok).alias("timed_out")))
