"""Runs of a lock inside one range of a history: chains of admissions and overlapping pairs.

A task gets the runs of a range of (device, start, run_id) in order and works
on all its devices at once with numpy.  What crosses a range is left to Spark
(:mod:`slotwise.operators.lifecycle`): only a range's first and last device
can reach beyond it.  The functions that run in tasks are pickled by value.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE = 1 << 16         # pairs handed on at once


def whole(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    """The rows of a partition as one table; a range is as large as a partition of Spark, whatever the device."""
    rows = list(batches)
    return pa.Table.from_batches(rows).combine_chunks() if rows and sum(map(len, rows)) else None


def groups_of(*keys: pa.ChunkedArray) -> np.ndarray:
    """Where each group of equal keys begins, and the number of rows at the end."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        new[1:] |= pc.fill_null(pc.not_equal(k.slice(1), k.slice(0, n - 1)), True).to_numpy(zero_copy_only=False)
    return np.append(np.flatnonzero(new), n)


def starts_before(bounds: np.ndarray, start: np.ndarray, time: np.ndarray, of: np.ndarray) -> np.ndarray:
    """For each ``time`` in group ``of``: the place of the group's first start at or after it."""
    group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((np.repeat([1, 0], [len(start), len(time)]), np.concatenate([start, time]), np.concatenate([group, of])))
    is_start = order < len(start)
    before = np.cumsum(is_start)
    place = np.empty(len(time), np.int64)
    place[order[~is_start] - len(start)] = before[~is_start]
    return place


def links(bounds: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The place of each run's successor: the first later one of its group that starts at or after its end, else ``n``."""
    n = len(start)
    group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    nxt = np.maximum(starts_before(bounds, start, np.maximum(end, start), group), np.arange(n) + 1)
    return np.where(nxt < bounds[group + 1], nxt, n)


def exits(nxt: np.ndarray) -> np.ndarray:
    """The last run of the chain that begins at each run, inside the range."""
    last = np.where(nxt < len(nxt), nxt, np.arange(len(nxt)))
    while (last[last] != last).any():
        last = last[last]
    return last


def marked(nxt: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Which runs lie on the chains from ``entries``."""
    n = len(nxt)
    jump = np.append(nxt, n)
    on = np.zeros(n + 1, bool)
    on[entries] = True
    while (jump[:n] < n).any():
        on[jump[np.flatnonzero(on)]] = True
        jump = jump[jump]
    return on[:n]


def pieces_of_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How a lock passes through a range: (device_id, chunk, upto, exit, exit_end, last_start).

    Whoever holds the lock until after the device's former piece and not after
    ``upto`` leaves the range with the run ``exit`` holding it until
    ``exit_end``.  Only the range's first and last device are told of, and
    equal neighbours are folded together.
    """
    t = whole(batches)
    if t is None:
        return
    start, end = t["s"].to_numpy(), t["e"].to_numpy()
    bounds = groups_of(t["device_id"])
    out = exits(links(bounds, start, end))
    for g in {0, len(bounds) - 2}:
        a, b = bounds[g], bounds[g + 1]
        entry = a + np.flatnonzero(np.diff(start[a:b], prepend=start[a] - 1))     # of equal starts the first
        x = out[entry]
        keep = np.append(x[1:] != x[:-1], True)
        entry, x = entry[keep], x[keep]
        yield pa.RecordBatch.from_arrays(
            [t["device_id"].take(pa.array(x)).combine_chunks(), t["chunk"].take(pa.array(x)).combine_chunks(), pa.array(start[entry]),
             t["run_id"].take(pa.array(x)).combine_chunks(), pa.array(np.maximum(end, start)[x]),
             pa.array(np.full(len(x), start[b - 1]))],
            names=["device_id", "chunk", "upto", "exit", "exit_end", "last_start"])


def admissions_of_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """run_id, device_id, admitted.  ``entry``: until when the lock is held as the range begins; NULL: not at all."""
    t = whole(batches)
    if t is None:
        return
    start = t["s"].to_numpy()
    bounds = groups_of(t["device_id"])
    n = len(start)
    first = bounds[:-1].copy()
    entry = t["entry"].take(pa.array(first)).combine_chunks()
    held = np.flatnonzero(entry.is_valid().to_numpy(zero_copy_only=False))
    until = entry.take(pa.array(held)).to_numpy(zero_copy_only=False).astype(np.int64)
    for g, e in zip(held.tolist(), until.tolist()):
        at = bounds[g] + np.searchsorted(start[bounds[g]:bounds[g + 1]], e)
        first[g] = at if at < bounds[g + 1] else n
    on = marked(links(bounds, start, t["e"].to_numpy()), first)
    for b in pa.table({"run_id": t["run_id"], "device_id": t["device_id"], "admitted": pa.array(on)}).to_batches(SLICE):
        yield b


def open_at_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """device_id, chunk, t, run_id, s, e: the first start of the range's first device (run_id NULL, t its start), and
    the runs of its last device that end after the range's last start (t is their end)."""
    t = whole(batches)
    if t is None:
        return
    names = ["device_id", "chunk", "t", "run_id", "s", "e"]
    start, end = t["s"].to_numpy(), t["e"].to_numpy()
    bounds = groups_of(t["device_id"])
    head = t.slice(0, 1)
    yield pa.table([head["device_id"], head["chunk"], head["s"], pa.nulls(1, t.schema.field("run_id").type),
                    pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64())], names=names).combine_chunks().to_batches()[0]
    a = bounds[-2]
    at = pa.array(a + np.flatnonzero(end[a:] > start[-1]))
    rows = t.take(at)
    if len(rows):
        yield from pa.table([rows["device_id"], rows["chunk"], rows["e"], rows["run_id"], rows["s"], rows["e"]], names=names).to_batches()


def _pairs(t: pa.Table, early: np.ndarray, first: np.ndarray, upto: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Pairs of the runs ``early`` with the rows from ``first`` to before ``upto``, where these do not end at once."""
    start, end = t["s"].to_numpy(), t["e"].to_numpy()
    count = np.maximum(upto - first, 0)
    total = np.cumsum(count)
    for lo in range(0, int(total[-1]) if len(total) else 0, SLICE):
        at = np.arange(lo, min(lo + SLICE, int(total[-1])))
        k = np.searchsorted(total, at, "right")
        i, j = early[k], first[k] + at - (total[k] - count[k])
        real = start[i] < end[j]
        i, j = pa.array(i[real]), pa.array(j[real])
        a, b = (t["run_id"].take(x).combine_chunks() for x in (i, j))
        yield pa.RecordBatch.from_arrays([t["device_id"].take(i).combine_chunks(), pc.min_element_wise(a, b), pc.max_element_wise(a, b)],
                                         names=["device_id", "run_a", "run_b"])


def overlaps_of_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping pairs of runs that both start in the range."""
    t = whole(batches)
    if t is None:
        return
    bounds = groups_of(t["device_id"])
    n = len(t)
    group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    yield from _pairs(t, np.arange(n), np.arange(n) + 1, starts_before(bounds, t["s"].to_numpy(), t["e"].to_numpy(), group))


def overlaps_with_guests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping pairs of a guest (a run still open as the range begins) and a run that starts in the range.

    Rows are ordered by device, chunk, guests first, start and run_id.
    """
    t = whole(batches)
    if t is None:
        return
    bounds = groups_of(t["device_id"], t["chunk"])
    end, start = t["e"].to_numpy(), t["s"].to_numpy()
    guest = t["guest"].to_numpy(zero_copy_only=False)
    for a, b in zip(bounds[:-1], bounds[1:]):
        own = a + int(guest[a:b].sum())
        yield from _pairs(t, np.arange(a, own), np.full(own - a, own), own + np.searchsorted(start[own:b], end[a:own]))
