"""Write PLANS.md: the physical plan of every registered query.

    python scripts/dump_plans.py [sf_dir] > PLANS.md

For each query: the operator tree of ``explain("formatted")`` plus the scans'
read schemas and pushed filters. Queries that write files on call
(``report_roundtrip``, ``file_*``) are planned like the others.
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from wordfold.plans.inspect import physical_tree, plan_text  # noqa: E402
from wordfold.plans.queries import QUERIES  # noqa: E402
from wordfold.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 8)
    spark.sparkContext.setLogLevel("ERROR")
    out = [
        "# Physical plans of the registered queries",
        "",
        f"Generated by `scripts/dump_plans.py` at `{os.path.basename(sf_dir.rstrip('/'))}`, local[8], AQE on",
        "(initial plans; AQE may still coalesce partitions or switch a join to broadcast at runtime).",
        "",
    ]
    for name, q in QUERIES.items():
        df = q(spark, sf_dir)
        tree = physical_tree(df).replace("== Physical Plan ==\n", "")
        details = [
            line
            for line in plan_text(df).splitlines()
            if line.startswith(("ReadSchema:", "PushedFilters:", "Arguments: RoundRobin", "Arguments: hashpartitioning"))
        ]
        out += [f"## {name}", "", "```", tree.rstrip(), "", *details, "```", ""]
    print("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
