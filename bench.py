"""Benchmark: the load job and the BI queries at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line. Timed steps:

* ``load_full``    - end-to-end load of the whole tape into an empty warehouse (the reference's
                     published figure is an end-to-end load);
* ``reload_tail``  - a second run reloading the two newest files (range replace path);
* BI queries over the stored warehouse, each run to completion with the ``noop`` sink.

The session is warmed by one small load first. The warehouse lives in a fresh temporary folder.
"""
from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pricewell.operators import measures as M  # noqa: E402
from pricewell.plans import views as V  # noqa: E402
from pricewell.plans.job import run_load  # noqa: E402
from pricewell.plans.scenario import split_files, tape  # noqa: E402
from pricewell.session import get_spark  # noqa: E402
from pricewell.sources.warehouse import WarehouseStore  # noqa: E402


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark("pricewell-bench", f"local[{cpus}]", shuffle_partitions=max(cpus, 8))
    scratch = tempfile.mkdtemp(prefix="pricewell-bench-")

    # warm-up: JIT and class loading on the smallest scale
    warm_raw, warm_inst = tape(spark, "/root/testdata/sf0.001")
    run_load(spark, warm_raw, warm_inst, os.path.join(scratch, "warm"))

    times: dict[str, float] = {}
    wh_dir = os.path.join(scratch, "wh")
    raw, inst = tape(spark, sf_dir)

    t = time.time()
    r1 = run_load(spark, raw, inst, wh_dir)
    times["load_full"] = time.time() - t

    _, tail = split_files(raw)
    t = time.time()
    run_load(spark, tail, inst, wh_dir)
    times["reload_tail"] = time.time() - t

    wh = WarehouseStore(spark, wh_dir).read()
    star = V.star(wh)
    bi = {
        "instrument_latest": lambda: V.instrument_latest(wh),
        "sector_monthly": lambda: V.sector_monthly(wh),
        "sector_year_return": lambda: V.sector_year_return(wh),
        "golden_cross": lambda: V.golden_cross(wh),
        "trace_files": lambda: V.trace_files(wh),
        "most_volatile": lambda: V.most_volatile(wh),
        "reject_drilldown": lambda: V.reject_drilldown(wh),
        "drilldown_rollup": lambda: V.drilldown_rollup(wh),
        "sector_index": lambda: M.sector_index(star),
        "price_vs_ma50": lambda: V.latest_measure(wh, M.price_vs_ma50),
        "latest_run": lambda: M.latest_run_card(wh.etl_load_run, wh.etl_rejected_row),
    }
    for name, q in bi.items():
        t = time.time()
        _noop(q())
        times[name] = time.time() - t

    total = sum(times.values())
    print(json.dumps({
        "metric": "load_plus_bi_total", "value": round(total, 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": Path(sf_dir).name.replace("sf", ""),
        "rows_read": r1["rows_read"], "rows_loaded": r1["rows_loaded"], "rows_rejected": r1["rows_rejected"],
        "load_rows_per_sec": round(r1["rows_read"] / times["load_full"], 1),
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
