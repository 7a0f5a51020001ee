"""Flagship throughput on a larger probe input derived from the test tables (not a test).

    python tests/scale_flagship.py <copies> <shift>

Each sf0.1 probe row is emitted ``copies`` times. With ``shift`` 0 the copies repeat
the same addresses (as real tickets repeat blocks); with ``shift`` 1 copy c appends c to
the house number's leading digits, so addresses stay distinct (and mostly miss).
Prints rows, warm time, violations resolved and their rate.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from cobble.operators import violations as V  # noqa: E402
from cobble.operators.aggregates import sum_of_years  # noqa: E402
from cobble.plans import testdata as TD  # noqa: E402
from cobble.session import local_session, shared_scratch  # noqa: E402
from cobble.sources.io import read_positional_csv, write_csv  # noqa: E402


def main(copies: int, shift: int, sf: str = "/root/testdata/sf0.1") -> None:
    spark = local_session()
    base = TD.derive_violation_rows(spark, sf)
    c = F.col("c")
    house = F.col("house_number")
    if shift:
        house = F.when(c == 0, house).otherwise(
            F.regexp_replace("house_number", r"^([0-9]+)", F.concat(F.lit("$1"), c.cast("string")))
        )
    rows = base.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("c")).select(
        "issue_date", "county", house.alias("house_number"), "street_name"
    )
    path = shared_scratch(spark, "scale_csv")
    write_csv(rows.toDF(*TD.VIOLATION_HEADER), path, header=True)
    raw = read_positional_csv(spark, path, ["issue_date", "county", "house_number", "street_name"], header_first="Issue Date")
    n = raw.count()
    segments, aliases = V.prepare_segments(TD.segment_features(spark, sf))
    roster = TD.segment_roster(spark, sf)

    def report():
        probes = V.prepare_violations(raw, "issue_date", "county", "house_number", "street_name")
        return V.violations_report(probes, segments, aliases, roster)

    best = None
    for _ in range(2):
        t = time.time()
        report().write.format("noop").mode("overwrite").save()
        best = min(best or 1e9, time.time() - t)
    resolved = sum_of_years(report(), V.VIOLATION_YEARS).first()["total"]
    cores = spark.sparkContext.defaultParallelism
    print(
        f"rows {n} warm {best:.1f}s resolved {resolved} "
        f"resolved/s {resolved / best:.0f} per core {resolved / best / cores:.0f} rows/s {n / best:.0f}"
    )
    spark.stop()


if __name__ == "__main__":
    main(int(sys.argv[1]), int(sys.argv[2]))
