"""History operators must give the oracle's answer for any number of chunks."""

import pytest

from conftest import SF_CHECK
from slotwise.check import duck, rows_of
from slotwise.plans import catalog as _c

_c.load_all()
HISTORY = ["w9_lifecycle", "w8_step_gate", "w10_admit_runs", "j10_overlapping_runs", "j11_wait_for",
           "a5_adjacent_distinct"]


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


@pytest.mark.parametrize("name", HISTORY)
@pytest.mark.parametrize("chunks", ["1", "61"])
def test_any_chunks_match_oracle(spark, con, name, chunks):
    setting = {"spark.sql.shuffle.partitions": chunks, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in setting}
    try:
        for k, v in setting.items():
            spark.conf.set(k, v)
        df = _c.QUERIES[name](spark, SF_CHECK)
        got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    rel = con.sql(_c.oracles()[name])
    assert got == rows_of(rel.columns, rel.fetchall())
