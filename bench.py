"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line.  Each query is run once to warm up, then timed
$BENCH_REPS times (median) into Spark's ``noop`` sink, which executes the
whole plan without collecting rows to the driver.  The DuckDB oracle of the
same query is timed for reference twice: deriving the fixtures from the base
tables (its CTEs), and over the same stored fixture files Spark reads.  Spark
is timed a second way too: once per query over fixture views that derive from
the given tables in the same run (nothing stored, nothing warm but the JVM).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import warnings

warnings.filterwarnings("ignore")
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "q1_fleet_status", "q2_write_readiness", "q3_apply_plan", "q4_commit_plan",
    "c1_parse_runs", "j1_verify_checksum", "a7_log_counts", "k1_effective_config",
    "w9_lifecycle", "w10_admit_runs", "j10_overlapping_runs", "j11_wait_for",
    "a6_merkle_root", "j9_slot_diff", "u1_mirror",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from slotwise.check import duck
    from slotwise.plans import catalog
    from slotwise.session import local_session
    from slotwise.sources import fixtures

    spark = local_session(cpus=cpus, shuffle_partitions=max(8, cpus * 2))
    catalog.load_all()
    oracles = catalog.oracles()
    bodies = catalog.oracle_bodies()
    con = duck(sf_dir)
    fixtures.register(spark, sf_dir)
    stored = duck(sf_dir)   # DuckDB over the same stored fixture files Spark reads
    base = fixtures.fixture_dir(spark, sf_dir)
    for n in fixtures.ORACLE_SQL:
        stored.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{base}/{n}/*.parquet')")
    names = only or list(HEADLINE)
    times, duck_times, duck_stored = {}, {}, {}
    for name in names:
        fn = catalog.QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()   # warm-up
        runs = []
        for _ in range(reps):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
        if name in oracles:
            con.sql(oracles[name]).fetchall()
            d = []
            for _ in range(reps):
                t0 = time.perf_counter()
                con.sql(oracles[name]).fetchall()
                d.append(time.perf_counter() - t0)
            duck_times[name] = round(statistics.median(d), 3)
            stored.sql(bodies[name]).fetchall()
            d = []
            for _ in range(reps):
                t0 = time.perf_counter()
                stored.sql(bodies[name]).fetchall()
                d.append(time.perf_counter() - t0)
            duck_stored[name] = round(statistics.median(d), 3)
    # the same queries from the given tables: views, no stored fixtures
    raw = spark.newSession()
    fixtures.register(raw, sf_dir, materialize=False)
    given = {}
    for name in names:
        t0 = time.perf_counter()
        catalog.QUERIES[name](raw, sf_dir).write.format("noop").mode("overwrite").save()
        given[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus,
                      "from_given_tables_sec": given, "from_given_tables_total_sec": round(sum(given.values()), 3),
                      "duckdb_oracle_sec": duck_times, "duckdb_on_stored_fixtures_sec": duck_stored}))


if __name__ == "__main__":
    main()
