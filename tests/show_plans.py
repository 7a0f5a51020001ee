"""Write PLANS.md: the executed (final adaptive) physical plans of the main queries.

    python tests/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from cobble.plans.queries import QUERIES  # noqa: E402
from cobble.session import local_session  # noqa: E402

NAMES = [
    "violations_by_segment",
    "complaints_report",
    "product_revenue",
    "customer_runs",
    "max_concurrent_events",
    "first_event_of_day",
    "top_station_by_group",
    "word_count_lower",
    "keywords",
    "yearly_trend",
]


def main(sf_dir: str) -> None:
    spark = local_session()
    out = [
        "# Physical plans",
        "",
        f"Final adaptive plans after running each query at `{sf_dir}` on local[8] with 8 shuffle",
        "partitions (`tests/show_plans.py`). Long expressions are cut at 150 characters.",
        "",
    ]
    for name in NAMES:
        df = QUERIES[name](spark, sf_dir)
        df.collect()  # runs this DataFrame's own query execution, so the plan below is final
        plan = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
        lines = [re.sub(r", \[plan_id=\d+\]", "", re.sub(r"#\d+L?", "", l))[:150] for l in plan.splitlines()]
        doc = (QUERIES[name].__doc__ or "").strip().splitlines()[0]
        out += [f"## {name}", "", doc, "", "```", *lines, "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
