"""Time every registered query and print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default all), BENCH_RUNS (default 2). Each query is built and
then fully executed into Spark's ``noop`` sink (no driver collect); the time covers both.
``queries`` holds the fastest run of each query (warm JVM), ``first_run`` the first one,
which also pays one-time costs such as code generation; ``preparation`` is the time to write
the derived input files, before any query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))

    from cobble.plans.queries import QUERIES
    from cobble.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=max(cpus, 8), app="cobble-bench")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or sorted(QUERIES)

    # Warm the JVM (class loading, code generation) outside the timed runs.
    QUERIES["hour_histogram"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    # Input tables that stand in for arriving files are written once, timed apart.
    from cobble.plans import queries as Q
    from cobble.plans import testdata as TD

    t0 = time.perf_counter()
    TD.violation_table(spark, sf_dir)
    TD.violation_rows(spark, sf_dir)
    TD.yearly_files(spark, sf_dir, Q.YEARS)
    TD.line_files(spark, sf_dir)
    TD.collection_files(spark, sf_dir, Q.FEATURE_PROPS)
    Q._event_files(spark, sf_dir)
    preparation = round(time.perf_counter() - t0, 3)

    runs = max(1, int(os.environ.get("BENCH_RUNS", "2")))
    first: dict[str, float] = {}
    times: dict[str, float] = {}
    for r in range(runs):
        for name in names:
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            t = round(time.perf_counter() - t0, 3)
            first.setdefault(name, t)
            times[name] = min(t, times.get(name, t))
            spark.catalog.clearCache()
            print(f"run {r} {name}: {t:.2f}s", file=sys.stderr, flush=True)

    # Flagship throughput, comparable in kind with the baseline's resolved violations per
    # second: rows read, violations resolved to a segment (the report's yearly total).
    flagship = None
    if "violations_by_segment" in times:
        read = TD.violation_table(spark, sf_dir).count()
        resolved = QUERIES["reconcile_total"](spark, sf_dir).first()["total"]
        sec = times["violations_by_segment"]
        flagship = {
            "violations_read": read,
            "violations_resolved": resolved,
            "sec": sec,
            "resolved_per_sec": round(resolved / sec, 1),
            "resolved_per_sec_per_core": round(resolved / sec / cpus, 1),
            "read_per_sec": round(read / sec, 1),
        }

    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "first_run": first,
                "first_run_total": round(sum(first.values()), 3),
                "preparation": preparation,
                "runs": runs,
                "flagship": flagship,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
