"""Benchmark of the headline jobs; prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).

Lazy queries are timed to completion with the ``noop`` sink (full execution, no output cost);
``run_full`` / ``run_incremental`` are the stored daily jobs (every layer written once);
``dq_report`` runs over the stored tables of the full run.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from ferrolake.session import local_session, scratch_path
    spark = local_session(cpus, max(2 * cpus, 8), app="ferrolake-bench")

    from ferrolake.plans import pipeline
    from ferrolake.plans.reports import dq_report, freshness_report
    from ferrolake.sources import derived

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    noop(derived.raw_orders(spark, sf_dir).limit(10))   # warm-up: JVM start, file listing

    lazy = pipeline.models_from_tables(spark, sf_dir)
    for name in ["stg_orders", "stg_customers", "stg_transactions", "dim_customers", "fct_orders",
                 "mart_customer_lifetime"]:
        timed(name, lambda n=name: noop(lazy[n]))
    timed("freshness_report", lambda: noop(freshness_report(derived.bronze(spark, sf_dir, pipeline.AS_OF),
                                                            pipeline.AS_OF)))

    root_full = scratch_path(spark, "bench-full")
    stored = {}
    timed("run_full", lambda: stored.update(pipeline.run_full(spark, derived.bronze(spark, sf_dir),
                                                              pipeline.AS_OF, root_full)))
    timed("dq_report", lambda: dq_report(stored).collect())

    root_inc = scratch_path(spark, "bench-inc")
    pipeline.run_full(spark, derived.bronze(spark, sf_dir, pipeline.PREV), pipeline.PREV, root_inc)
    timed("run_incremental", lambda: pipeline.run_incremental(spark, derived.bronze(spark, sf_dir),
                                                              pipeline.AS_OF, root_inc))

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "total_wall_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
