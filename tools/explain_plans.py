"""Write the physical plan of every registered query to docs/PLANS.md.

Usage: python tools/explain_plans.py [sf_dir]

AQE is off here so the static plan shows every exchange Catalyst planned
(with AQE on, the same plan is re-optimised per stage at run time). Long
expression lists are cut at 160 characters per line.
"""
from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

WIDTH = 160


def main(argv):
    from pyspark.sql import SparkSession

    from postings_lake.plans.registry import QUERIES

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.adaptive.enabled", "false").config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Physical plans of the registered queries", "",
           f"Generated by `tools/explain_plans.py` on `{os.path.basename(sf_dir.rstrip('/'))}` with AQE off; "
           "`*(n)` marks whole-stage-codegen stages, `Exchange` a shuffle. Lines are cut at "
           f"{WIDTH} characters.", ""]
    for k, q in QUERIES.items():
        plan = q(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        lines = [ln if len(ln) <= WIDTH else ln[: WIDTH - 1] + "…" for ln in plan.rstrip().split("\n")]
        shuffles = sum("Exchange" in ln for ln in lines)
        out += [f"## {k}", "", f"{shuffles} exchange(s).", "", "```text", *lines, "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    spark.stop()
    print(path)


if __name__ == "__main__":
    main(sys.argv[1:])
