"""Print the physical operator trees of the fact passes and the publication tail.

Usage: python tools/dump_plans.py [sf_dir]   (operator names only; expressions trimmed)
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def tree(df) -> str:
    s = df._jdf.queryExecution().executedPlan().treeString()
    out = []
    for line in s.splitlines():
        m = re.match(r"^([\s:+\-*]*)(\(\d+\)\s*)?([A-Za-z][A-Za-z]*)(.*)$", line)
        if not m:
            continue
        prefix, _, op, rest = m.groups()
        detail = ""
        if op in ("FileScan", "Scan"):
            t = re.search(r"Location: InMemoryFileIndex[^\]]*?/([\w.]+)\]", rest) or re.search(r"parquet \[", rest)
            detail = f" {t.group(1)}" if t and t.groups() else " parquet"
        elif op == "HashAggregate":
            detail = " (partial)" if "partial_" in rest else " (final)"
        elif op in ("BroadcastHashJoin", "SortMergeJoin", "BroadcastNestedLoopJoin"):
            j = re.search(r"(Inner|LeftOuter|LeftSemi|LeftAnti|RightOuter|FullOuter|Cross)", rest)
            detail = f" {j.group(1)}" if j else ""
        out.append(f"{prefix}{op}{detail}")
    return "\n".join(out)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from depreco.config import FIXTURE_PARAMS as P
    from depreco.operators import decay as D
    from depreco.operators import ratios as R
    from depreco.operators.assign import assign_by_closure, closure
    from depreco.plans.pipeline import Run
    from depreco.session import get_spark
    from depreco.sources import extracts as X
    from depreco.sources import fixtures as FX

    spark = get_spark(os.environ.get("CHECK_MASTER", "local[8]"), shuffle_partitions=16)
    run = Run(FX.load_inputs(spark, sf_dir, P), P)
    slim = D.regression_input(X.cost_extract(run.inputs.cost_assets, P), P)
    keep = run.keep
    classes = keep(D.class_cells(slim))
    closed = keep(closure(classes, run.schedules))
    cells = keep(D.sd_filter_cells(D.merge_cells(assign_by_closure(classes, closed)), P.sd_multiplier).where("keep"))
    listed = keep(D.influential_cells(classes, closed, keep(D.fitted_cells(cells, P))))
    costs = X.cost_extract(run.inputs.cost_assets, P)
    stages = {
        "decay pass 1: class cells": D.class_cells(slim),
        "(schedule, age) cells from the written class cells and their closure": D.merge_cells(assign_by_closure(classes, closed)),
        "decay pass 2: influential rows of the listed cells": D.influential_rows(slim, listed),
        "schedule assignment of raw rows": assign_by_closure(costs, keep(closure(costs, run.schedules))),
        "retail cells (one comparables scan, three periods)": R.retail_cells(run.inputs.comparables, run.schedules, P),
        "auction means (published values, both periods)": R.auction_means(X.auction_published(run.inputs.class_values, P), run.schedules),
        "publication tail (after the written stages)": run.prepare().upload,
    }
    for title, df in stages.items():
        t = tree(df)
        ops = {}
        for line in t.splitlines():
            op = line.strip(" :+-|").split(" ")[0]
            key = line.strip(" :+-|")
            key = key if op in ("BroadcastHashJoin", "SortMergeJoin", "BroadcastNestedLoopJoin") else op
            ops[key] = ops.get(key, 0) + 1
        summary = ", ".join(f"{k}: {v}" for k, v in sorted(ops.items()) if k.split(" ")[0] in (
            "Exchange", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "BroadcastNestedLoopJoin",
            "Window", "FileScan", "Generate"))
        print(f"### {title}\noperator counts: {summary}\n```\n{t}\n```\n")
    run.close()


if __name__ == "__main__":
    main()
