"""Summarise the executed physical plans of the headline queries (writes PLANS.md).

For each query: shuffle exchanges, single-partition exchanges, join strategies,
aggregates, Python operators and, per parquet scan, the pushed filters and the
columns read.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from bench import HEADLINE  # noqa: E402
from encore.plans.registry import queries  # noqa: E402
from encore.session import get_session  # noqa: E402


def summary(plan: str) -> dict:
    return {
        "hash shuffles": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range shuffles": len(re.findall(r"Exchange rangepartitioning", plan)),
        "single-partition exchanges": len(re.findall(r"Exchange SinglePartition", plan)),
        "broadcast exchanges": len(re.findall(r"BroadcastExchange", plan)),
        "broadcast hash joins": plan.count("BroadcastHashJoin"),
        "sort-merge joins": plan.count("SortMergeJoin"),
        "cartesian / nested-loop joins": plan.count("CartesianProduct") + plan.count("BroadcastNestedLoopJoin"),
        "hash/sort/object aggregates": plan.count("HashAggregate") + plan.count("SortAggregate") + plan.count("ObjectHashAggregate"),
        "python operators": plan.count("ArrowEvalPython") + plan.count("BatchEvalPython") + plan.count("MapInPandas") + plan.count("MapInArrow"),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session()
    qs = queries()
    out = ["# Physical plans of the headline queries", "",
           f"Executed (AQE final) plans at `{sf}` on local[8], summarised by `tools/plans.py`.", ""]
    for name in HEADLINE:
        if name == "gbt_fold_scores":
            continue  # an ML driver: many small jobs, not one plan
        df = qs[name](spark, sf)
        df.collect()  # runs this frame's own plan, which then holds its final form
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        out.append(f"## {name}")
        out.append("")
        for k, v in summary(plan).items():
            out.append(f"- {k}: {v}")
        scans = re.findall(r"FileScan parquet [^\n]*", plan)
        seen = set()
        for sc in scans:
            cols = re.search(r"ReadSchema: struct<([^>]*)>", sc)
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", sc)
            key = (cols.group(1) if cols else "", pushed.group(1) if pushed else "")
            if key in seen:
                continue
            seen.add(key)
            out.append(f"- scan reads `{key[0]}`; pushed filters `{key[1] or '-'}`")
        out.append("")
    open(__file__.rsplit("/tools/", 1)[0] + "/PLANS.md", "w").write("\n".join(out) + "\n")
    print("\n".join(out))


if __name__ == "__main__":
    main()
