"""Plan report: ``python -m slotwise.explain [--sf DIR] > PLANS.md``.

For every registered batch query, the physical plan Spark chooses (AQE off,
so the static plan is shown; at runtime AQE may still coalesce partitions,
split skewed ones or turn a sort-merge join into a broadcast one): shuffles
(hash / range / single-partition), joins by strategy, window and aggregate
operators, and per scan the columns read and the filters pushed to Parquet.
"""

from __future__ import annotations

import argparse
import re
import sys

SIDE_EFFECTS = {"w9_lifecycle", "w8_step_gate", "j10_overlapping_runs", "s7_read_images", "s7_read_gz_images", "s8_publish_write", "p1_dataset_slots", "w10_admit_runs"}


def summarize(plan: str) -> dict:
    lines = plan.splitlines()
    scans = []
    for ln in lines:
        if "FileScan" in ln or "Scan parquet" in ln:
            table = re.search(r"(fx_[a-z_]+?)(?:_[0-9a-f]{16}|/|\]|,|$)", ln) or re.search(r"/(\w+)\.parquet", ln)
            if table:
                name = table.group(1)
            else:   # path shortened in the plan text: show the columns instead
                cols_read = re.search(r"Scan parquet \S*\[([^\]]*)\]", ln)
                name = "scan[" + re.sub(r"#\d+L?", "", cols_read.group(1)) + "]" if cols_read else "?"
            cols = re.search(r"ReadSchema: struct<([^>]*)>", ln)
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", ln)
            bucketed = "Bucketed: true" in ln
            scans.append(f"{name}({len(cols.group(1).split(',')) if cols else '?'} cols"
                         f"{', bucketed' if bucketed else ''}"
                         f"{', pushed: ' + pushed.group(1) if pushed and pushed.group(1) else ''})")
    return {
        "shuffles": sum("Exchange hashpartitioning" in ln or "Exchange rangepartitioning" in ln
                        or "Exchange SinglePartition" in ln or "Exchange RoundRobin" in ln for ln in lines),
        "single": sum("Exchange SinglePartition" in ln for ln in lines),
        "broadcasts": sum("BroadcastExchange" in ln for ln in lines),
        "smj": sum("SortMergeJoin" in ln for ln in lines),
        "bhj": sum("BroadcastHashJoin" in ln for ln in lines),
        "nlj": sum("NestedLoopJoin" in ln or "CartesianProduct" in ln for ln in lines),
        "windows": sum(ln.strip().startswith(("Window ", "+- Window", ":- Window")) or " Window [" in ln for ln in lines),
        "python": sum("ArrowEvalPython" in ln or "BatchEvalPython" in ln or "FlatMapGroupsInPandas" in ln for ln in lines),
        "scans": scans,
    }


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    args = ap.parse_args(argv)
    from slotwise.plans import catalog
    from slotwise.session import local_session
    spark = local_session()
    catalog.load_all()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    print(f"# Physical plans at {args.sf} (AQE off: the static plan)\n")
    print("| query | shuffles | single-partition | broadcast | SMJ | BHJ | nested loop | windows | Python | scans (columns read, pushed filters) |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in catalog.QUERIES.items():
        if name.startswith("st") or name in SIDE_EFFECTS:
            continue
        plan = fn(spark, args.sf)._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        print(f"| {name} | {s['shuffles']} | {s['single']} | {s['broadcasts']} | {s['smj']} | {s['bhj']} | "
              f"{s['nlj']} | {s['windows']} | {s['python']} | {'; '.join(s['scans'])} |", flush=True)
    return 0


if __name__ == "__main__":
    sys.exit(main())
