"""Summarise the final physical plan of every batch query.

    python tools/show_plans.py [sf_dir] [--full name]

Per query: the exchanges (shuffles) with their partitioning, whether
aggregation is partial before the shuffle, the scan's ReadSchema and pushed /
partition filters, and any Python UDF or global Window node.  The plans are
taken after execution, so adaptive re-planning is included.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(plan: str) -> dict:
    final = plan.split("== Initial Plan ==")[0]
    exchanges = re.findall(r"Exchange (\w+(?:\([^)]*\))?)", final)
    exchanges = [re.sub(r"#\d+L?", "", e) for e in exchanges]
    return {
        "exchanges": exchanges,
        "partial_agg": bool(re.search(r"partial_|HashAggregate\(keys=\[[^\]]*\], functions=\[\]", final)),
        "read_schema": sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", final))),
        "partition_filters": sorted(set(f for f in re.findall(r"PartitionFilters: \[([^\]]*)\]", final) if f)),
        "pushed_filters": sorted(set(f for f in re.findall(r"PushedFilters: \[([^\]]*)\]", final) if f)),
        "python_udf": bool(re.search(r"BatchEvalPython|ArrowEvalPython", final)),
        "window": bool(re.search(r"\bWindow \[", final)),
        "take_ordered": "TakeOrderedAndProject" in final,
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and not argv[1].startswith("--") else "/root/testdata/sf0.01"
    full = argv[argv.index("--full") + 1] if "--full" in argv else None
    from eventlens.plans import catalog
    from eventlens.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    for name, fn in catalog.QUERIES.items():
        if name.startswith("stream_") or (full and name != full):
            continue
        df = fn(spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        if full:
            print(plan)
            continue
        s = summarise(plan)
        print(f"### {name}")
        print(f"- shuffles: {len(s['exchanges'])}: " + "; ".join(s["exchanges"]))
        print(f"- partial aggregate before shuffle: {s['partial_agg']}; top-k: {s['take_ordered']}; "
              f"window: {s['window']}; python udf: {s['python_udf']}")
        for rs in s["read_schema"]:
            print(f"- ReadSchema: `{rs}`")
        for f in s["partition_filters"]:
            print(f"- PartitionFilters: `{f}`")
        for f in s["pushed_filters"]:
            print(f"- PushedFilters: `{f}`")
        print()
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
