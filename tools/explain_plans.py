"""Write the physical plan trees of the headline queries to docs/PLANS.md
(the operator tree of explain("formatted") plus each scan's ReadSchema and
PushedFilters), for plan review."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sessionlab.config import build_session  # noqa: E402
from sessionlab.plans.registry import REGISTRY  # noqa: E402

QUERIES = ["sessions_all", "sessions_wide", "roc_auc", "stratified_split"]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(os.path.dirname(os.path.dirname(
        os.path.abspath(__file__))), "docs", "PLANS.md")
    spark = build_session("local[8]", shuffle_partitions=8)
    lines = ["# Physical plans (explain formatted, operator tree and scans)", "",
             f"Generated by `tools/explain_plans.py` on `{sf}`; AQE re-plans at run time.", ""]
    for q in QUERIES:
        df = REGISTRY[q].build(spark, sf)
        text = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        tree = text.split("\n\n")[0]
        scans = sorted(set(re.findall(r"(ReadSchema: .*|PushedFilters: .*)", text)))
        lines += [f"## {q}", "", "```", tree.strip(), "```", "", "Scans:", ""]
        lines += [f"- `{s}`" for s in scans] + [""]
    with open(out, "w") as f:
        f.write("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()
