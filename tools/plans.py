"""Write PLANS.md: the physical plan of every registered query, condensed.

    python tools/plans.py [sf_dir]

Each plan is the adaptive query's initial physical plan (``explain("simple")`` style), with
long expression lists cut and the whitespace character set shown as ``<WS>``; a summary line
counts exchanges, joins and scans.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tectonic.functions.text import PY_WHITESPACE  # noqa: E402
from tectonic.queries import QUERIES  # noqa: E402
from tectonic.session import build_session  # noqa: E402

WIDTH = 150


def condensed(plan: str) -> list[str]:
    plan = plan.replace(PY_WHITESPACE, "<WS>")
    out = []
    for line in plan.splitlines():
        if not line.strip():
            continue
        out.append(line if len(line) <= WIDTH else line[:WIDTH] + " …")
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    parts = ["# Physical plans of the registered queries",
             "",
             f"Generated by `tools/plans.py` on `{sf_dir}` (initial adaptive plans; AQE may still "
             "coalesce partitions or switch a shuffled join to broadcast at run time).",
             ""]
    for name, fn in QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        exchanges = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|"
                                   r"RoundRobinPartitioning)", plan))
        joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                           r"BroadcastNestedLoopJoin|CartesianProduct)", plan)
        scans = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
        parts += [f"## `{name}`", "",
                  f"exchanges: {exchanges}; joins: {', '.join(joins) or 'none'}; "
                  f"scans: {', '.join(f'`{s}`' for s in scans) or 'none'}", "",
                  "```", *condensed(plan), "```", ""]
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(out, "w") as f:
        f.write("\n".join(parts))
    print("wrote", out)
    spark.stop()


if __name__ == "__main__":
    main()
