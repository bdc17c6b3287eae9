"""Write the physical plans of the headline queries to docs/PLANS.md.

Usage: python scripts/show_plans.py [sf_dir]
Each query is shown twice: as planned here (small tables, AQE may broadcast) and
with automatic broadcast joins switched off, which is the shape the big tables of
a large cluster get.  Plans are the pre-execution AQE plans (isFinalPlan=false).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeload.plans import catalog  # noqa: E402
from lakeload.session import get_session  # noqa: E402

QUERIES = [
    "billing_for_each_customer",
    "gold_candidate_by_campaign",
    "merge_cdc",
    "merge_cdc_shuffle",
    "merge_collapsed_batches",
    "change_feed",
    "dq_metrics",
    "merge_latest_per_key",
]


def clean(plan: str) -> str:
    plan = re.sub(r"#\d+L?", "", plan)
    plan = re.sub(r", \[plan_id=\d+\]", "", plan)
    return "\n".join(line[:220] for line in plan.splitlines())


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session()
    out = ["# Physical plans of the headline queries", "", f"Generated by `scripts/show_plans.py` on `{sf}`.", ""]
    for name in QUERIES:
        out.append(f"## {name}")
        for label, threshold in (("as planned", None), ("broadcast joins off", "-1")):
            if threshold:
                spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            df = catalog.QUERIES[name](spark, sf)
            plan = df._jdf.queryExecution().executedPlan().toString()
            out += [f"### {label}", "", "```", clean(plan), "```", ""]
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
