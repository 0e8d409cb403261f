"""Write the physical plan tree of every registered query to a Markdown file.

Usage: python tools/show_plans.py [sf_dir] [out.md]

Plans are taken with AQE off, so the file shows the static plan Catalyst
chose (at runtime AQE may still coalesce partitions, switch a join to a
broadcast from real sizes, or split skewed partitions).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def tree(df) -> str:
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    head = text.split("\n\n\n")[0]
    return "\n".join(line.rstrip() for line in head.splitlines() if line.strip())


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    out = argv[2] if len(argv) > 2 else "PLANS.md"
    from pricelake.session import build_session

    spark = build_session("local[8]", shuffle_partitions=16, extra={"spark.sql.adaptive.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    from pricelake.plans.registry import QUERIES

    parts = [
        "# Physical plans of the registered queries (without the training-data operators)",
        "",
        f"Generated by `tools/show_plans.py` on `{os.path.basename(sf_dir.rstrip('/'))}` with AQE off "
        "(the static plan). Exchanges are the shuffles; `WindowGroupLimit ... Partial` before an "
        "exchange is the map-side top-k cut; `BroadcastExchange` sides passed a size check.",
        "",
    ]
    for name, fn in QUERIES.items():
        plan = tree(fn(spark, sf_dir))
        n_ex = len(re.findall(r"\bExchange\b", plan))
        n_bc = len(re.findall(r"BroadcastExchange", plan))
        parts += [f"## {name}", "", f"shuffles: {n_ex}, broadcasts: {n_bc}", "", "```", plan, "```", ""]
    with open(out, "w", encoding="utf-8") as f:
        f.write("\n".join(parts))
    spark.stop()
    print(out)


if __name__ == "__main__":
    main(sys.argv)
