"""Formatted physical plan of one preset on materialised stand-ins, after
execution (AQE's final plan), plus a short summary: scans with their pushed
filters and read schema, exchanges, join strategies.

    python tools/plan_report.py naf_prod [sf_dir] [--full]
"""

from __future__ import annotations

import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    preset = args[0] if args else "naf_prod"
    sf_dir = args[1] if len(args) > 1 else "/root/testdata/sf0.01"
    from salesfacts.config import PRESETS
    from salesfacts.plans.pipeline import run
    from salesfacts.session import ensure_checkpoint_dir, local_session
    from salesfacts.sources.catalog import SourceCatalog, write_standins

    spark = local_session(cores=8, shuffle_partitions=16, app="salesfacts-plan")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    out = f"{ensure_checkpoint_dir(spark)}/plan-{uuid.uuid4().hex[:8]}"
    catalog = SourceCatalog.from_paths(spark, write_standins(spark, sf_dir, out))
    df = run(catalog, PRESETS[preset])
    df._jdf.queryExecution().toRdd().count()   # executes this DataFrame's own plan, so the AQE plan below is final
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    if "--full" in sys.argv:
        print(plan)
    import re

    lines = plan.splitlines()
    # node ids of AQE's final plan (the tree also lists the initial plan)
    tree_end = next(i for i, ln in enumerate(lines) if ln.strip() == "")
    tree = lines[:tree_end]
    start = next((i for i, ln in enumerate(tree) if "== Final Plan ==" in ln), 0)
    stop = next((i for i, ln in enumerate(tree) if "== Initial Plan ==" in ln), len(tree))
    final_ids = {m for ln in tree[start:stop] for m in re.findall(r"\((\d+)\)\s*$", ln)}

    def in_final(ln: str) -> bool:
        m = re.match(r"\((\d+)\)", ln)
        return bool(m) and m.group(1) in final_ids

    print(f"== {preset}: summary (final plan) ==")
    for i, ln in enumerate(lines):
        if in_final(ln) and "Scan parquet" in ln:
            block = lines[i:i + 12]
            loc = next((b for b in block if b.startswith("Location:")), "")
            pushed = next((b for b in block if b.startswith("PushedFilters:")), "")
            schema = next((b for b in block if b.startswith("ReadSchema:")), "")
            print(loc.split("/")[-1].rstrip("]"), "|", pushed[:160], "|", schema[:120])
    for kind in ("Exchange", "BroadcastExchange", "ReusedExchange", "BroadcastHashJoin", "SortMergeJoin",
                 "HashAggregate", "WindowGroupLimit"):
        print(kind, sum(1 for ln in lines if in_final(ln) and re.match(rf"\(\d+\) {kind}\b", ln)))


if __name__ == "__main__":
    main()
