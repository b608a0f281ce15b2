"""A/B publication of a Spark dataset.

The same discipline the updater applies to root partitions, applied to a
table: a new version is written to the *inactive* slot only (S8), checked by
its integrity root (A6), armed for exactly one ``open``, and either committed
as the default or dropped, in which case the next ``open`` returns to the old
default.

Layout under ``root`` (any Hadoop file system, e.g. the shared folder the
cluster names in ``spark.checkpoint.dir``)::

    root/slot=a/...parquet
    root/slot=b/...parquet
    root/_state/v000001.json, v000002.json, ...

The state is a small JSON document; every change writes the next version
file with ``overwrite=False``, so two writers racing for the same version
cannot both succeed (the second gets an error, like a non-blocking lock).
The highest version is the current state.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from slotwise.operators.slots import rows_root

SLOTS = ("a", "b")
_EMPTY = {"default": None, "staged": None, "staged_root": None, "oneshot": None, "trial": None, "version": 0}


class SlotStateError(RuntimeError):
    pass


class DatasetSlots:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._Path(self.root).getFileSystem(self._conf)

    # --- state file ---------------------------------------------------------
    def _state_dir(self):
        return self._Path(f"{self.root}/_state")

    def state(self) -> dict:
        d = self._state_dir()
        if not self._fs.exists(d):
            return dict(_EMPTY)
        names = [st.getPath().getName() for st in self._fs.listStatus(d)]
        versions = {int(n[1:-5]): n for n in names if n.startswith("v") and n.endswith(".json")}
        if not versions:
            return dict(_EMPTY)
        stream = self._fs.open(self._Path(f"{self.root}/_state/{versions[max(versions)]}"))
        try:
            reader = self.spark.sparkContext._jvm.java.io.BufferedReader(
                self.spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            text = reader.readLine()
        finally:
            stream.close()
        return json.loads(text)

    def _save(self, state: dict) -> dict:
        new = dict(state, version=state["version"] + 1)
        path = self._Path(f"{self.root}/_state/v{new['version']:06d}.json")
        out = self._fs.create(path, False)   # fails if another writer got there first
        try:
            out.write(bytearray(json.dumps(new, sort_keys=True).encode("utf-8")))
        finally:
            out.close()
        return new

    def slot_path(self, slot: str) -> str:
        return f"{self.root}/slot={slot}"

    # --- operations ---------------------------------------------------------
    def inactive(self, state: dict | None = None) -> str:
        st = state or self.state()
        running = st["trial"] or st["default"]
        return SLOTS[1] if running == SLOTS[0] else SLOTS[0]

    def write(self, df: DataFrame) -> str:
        """Full replace of the inactive slot; the running slot is never touched."""
        st = self.state()
        slot = self.inactive(st)
        df.write.mode("overwrite").parquet(self.slot_path(slot))
        root = rows_root(self.spark.read.parquet(self.slot_path(slot)))
        self._save(dict(st, staged=slot, staged_root=root))
        return slot

    def verify(self, expected_root: str | None = None) -> bool:
        """Re-read the staged slot and compare its integrity root."""
        st = self.state()
        if not st["staged"]:
            raise SlotStateError("Nothing to verify.")
        root = rows_root(self.spark.read.parquet(self.slot_path(st["staged"])))
        return root == (expected_root or st["staged_root"])

    def apply(self) -> str:
        """Arm the staged slot for one open; the default stays the running slot."""
        st = self.state()
        if not st["staged"]:
            raise SlotStateError("Nothing to apply.")
        running = st["trial"] or st["default"]
        self._save(dict(st, default=running, oneshot=st["staged"], trial=None))
        return st["staged"]

    def open(self) -> DataFrame:
        """Read the current slot: the armed one once, else the default."""
        st = self.state()
        if st["oneshot"]:
            st = self._save(dict(st, trial=st["oneshot"], oneshot=None))
            slot = st["trial"]
        elif st["trial"]:
            # an unarmed re-open of a trial slot falls back to the default
            st = self._save(dict(st, trial=None))
            slot = st["default"]
        else:
            slot = st["default"]
        if slot is None:
            raise SlotStateError("No slot has been committed or armed.")
        return self.spark.read.parquet(self.slot_path(slot))

    def commit(self) -> str:
        """Make the running slot the default and drop the staging."""
        st = self.state()
        if not st["staged"]:
            raise SlotStateError("Nothing to commit.")
        running = st["trial"] or st["default"]
        if running is None:
            raise SlotStateError("Nothing runs yet: open the armed slot before committing it.")
        self._save(dict(st, default=running, trial=None, staged=None, staged_root=None, oneshot=None))
        return running

    def rollback(self) -> str | None:
        """Leave a trial (or an armed open) and return to the default."""
        st = self.state()
        self._save(dict(st, trial=None, oneshot=None))
        return st["default"]
