"""Write the executed physical plan of selected queries to PLANS.md.

Usage: python tools/dump_plans.py [sf_dir] [name ...]
Each query is run first, so the plan is the one adaptive execution ended with. Used to
review scans (PushedFilters / ReadSchema), exchanges, broadcasts and subqueries.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabprism.plans.registry import queries  # noqa: E402
from tabprism.session import local_session  # noqa: E402

DEFAULT = ["price_buckets", "box_stats_by_category", "kde", "minmax_scale_feature", "stat_broadcast",
           "sentiment_label", "linear_trend", "one_hot"]
LINE = 220


def main():
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and os.path.isdir(args[0]):
        sf_dir, args = args[0], args[1:]
    names = args or DEFAULT
    spark = local_session(8)
    qs = queries()
    out = ["# Physical plans as executed\n", f"Generated by `tools/dump_plans.py` on `{sf_dir}`.\n"]
    for name in names:
        df = qs[name](spark, sf_dir)
        df.collect()  # the small test tables only
        plan = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
        lines = [re.sub(r"file:\S*/", "", x)[:LINE] for x in plan.strip().split("\n")]
        out.append(f"\n## {name}\n\n```\n" + "\n".join(lines) + "\n```\n")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("".join(out))
    print(path)


if __name__ == "__main__":
    main()
