"""P1 DatasetSlots: write to the inactive slot, verify, one-shot open,
commit or roll back; refusals like the updater's."""

import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from slotwise.plans.dataset_slots import DatasetSlots, SlotStateError
from slotwise.sources.fixtures import Fleet


def _rows(df):
    return sorted(tuple(r) for r in df.select("path", "digest").collect())


@pytest.fixture()
def slots(spark):
    return DatasetSlots(spark, tempfile.mkdtemp(prefix="slotwise-ds-"))


@pytest.fixture(scope="module")
def versions(spark):
    m = Fleet(spark, SF_SMALL).manifest
    return (m.where(F.col("slot") == "a").select("path", "digest"),
            m.where(F.col("slot") == "b").select("path", "digest"))


def test_refusals_before_a_write(slots):
    with pytest.raises(SlotStateError, match="Nothing to apply."):
        slots.apply()
    with pytest.raises(SlotStateError, match="Nothing to commit."):
        slots.commit()
    with pytest.raises(SlotStateError):
        slots.open()


def test_one_shot_open_then_fallback_and_commit(slots, versions):
    a, b = versions
    assert slots.write(a) == "a"
    assert slots.verify()
    slots.apply()
    assert _rows(slots.open()) == _rows(a)          # armed: served once
    slots.commit()
    assert slots.state()["default"] == "a"
    assert slots.write(b) == "b"                     # the running slot a is never touched
    assert _rows(slots.open()) == _rows(a)           # written but not applied
    slots.apply()
    assert _rows(slots.open()) == _rows(b)           # trial of b
    assert _rows(slots.open()) == _rows(a)           # not committed: back to a
    slots.apply()
    assert _rows(slots.open()) == _rows(b)
    slots.commit()
    assert slots.state()["default"] == "b" and slots.state()["staged"] is None
    assert slots.write(a) == "a"                     # next write goes to the other slot again


def test_verify_detects_a_changed_slot(slots, versions, spark):
    a, b = versions
    slots.write(a)
    b.write.mode("overwrite").parquet(slots.slot_path("a"))   # tampered after the write
    assert not slots.verify()


def test_racing_state_writers_cannot_both_win(slots):
    st = slots.state()
    slots._save(st)
    with pytest.raises(Exception):
        slots._save(st)            # same version again: refused, like a held lock
