"""Summarise the physical plans of the load job's steps and the BI queries.

    python tools/explain_plans.py [sf_dir] [--full]

Loads the tape with the load job, then prints, per plan: exchanges, joins by strategy, windows,
sorts, aggregates of every kind, and every scan's partition filters, pushed filters and read
schema. ``--full`` also prints the formatted plans.
"""
from __future__ import annotations

import re
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from pricewell.operators import measures as M  # noqa: E402
from pricewell.operators.metrics import add_rolling_metrics  # noqa: E402
from pricewell.operators.quality import validate  # noqa: E402
from pricewell.operators.star import integrity_checks, normalise_reference  # noqa: E402
from pricewell.plans import views as V  # noqa: E402
from pricewell.plans.scenario import full_load, tape  # noqa: E402
from pricewell.session import get_spark  # noqa: E402


def summary(name: str, df, full: bool) -> None:
    # The static plan (AQE off while planning this printout) shows exchange reuse; AQE's initial
    # plan lists every branch's exchanges and only reuses them at run time.
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    ex = re.findall(r"(?<!Reused)(?<!Broadcast)Exchange (\w+)(?:\(([^)]*)\))?", plan)
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)"
                       r" \[[^\]]*\], \[[^\]]*\], (\w+)", plan)
    print(f"== {name}")
    print(f"   exchanges: {len([e for e in ex if e[0] != 'SinglePartition'])} hash/range/rr, "
          f"{len([e for e in ex if e[0] == 'SinglePartition'])} single-partition "
          + "; ".join(f"{k}({v[:60]})" for k, v in ex))
    print(f"   reused exchanges: {plan.count('ReusedExchange')}; scans of lineitem: {plan.count('lineitem.parquet')}")
    print(f"   joins: {joins}")
    count = lambda node: len(re.findall(rf"\b{node}\b ?[\[(]", plan))
    print("   " + ", ".join(f"{node}: {count(node)}" for node in ("Window", "Sort", "HashAggregate", "ObjectHashAggregate", "SortAggregate")))
    for line in plan.splitlines():
        if "FileScan" in line:
            part = lambda key: (re.search(rf"{key}: (\[.*?\]|struct<[^>]*>?)", line) or [None, "-"])[1][:170]
            print(f"   scan partitions={part('PartitionFilters')} pushed={part('PushedFilters')} schema={part('ReadSchema')}")
    if full:
        df.explain("formatted")


def main() -> None:
    sf = next((a for a in sys.argv[1:] if not a.startswith("--")), "/root/testdata/sf0.01")
    full = "--full" in sys.argv
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    raw, inst = tape(spark, sf)
    staging = validate(raw, normalise_reference(inst))
    summary("staging: distinct raw rows", staging.staged, full)
    summary("staging: clean prices", staging.clean, full)
    summary("staging: refused rows", staging.refused, full)
    summary("metrics over clean prices", add_rolling_metrics(staging.clean), full)
    wh = full_load(spark, sf).read()
    star = V.star(wh)
    for name, df in {
        "instrument_latest": V.instrument_latest(wh), "sector_monthly": V.sector_monthly(wh),
        "golden_cross": V.golden_cross(wh), "most_volatile": V.most_volatile(wh),
        "trace_run (one row)": V.trace_run(wh, ticker="SUPPLIER#000000001", date_key=19980105),
        "reject_drilldown": V.reject_drilldown(wh), "sector_index": M.sector_index(star),
        "integrity_checks": integrity_checks(wh.fact_daily_price, wh.dim_date, wh.dim_instrument, wh.dim_sector,
                                             wh.etl_load_run, wh.etl_rejected_row),
        "instrument_drilldown": V.instrument_drilldown(wh),
        "price_vs_ma50": V.latest_measure(wh, M.price_vs_ma50),
    }.items():
        summary(name, df, full)


if __name__ == "__main__":
    main()
