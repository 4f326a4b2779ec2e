"""Print the physical-plan operators that matter for scale, per query, as Markdown.

usage: python scripts/show_plans.py [--sf DIR] name ...

Each query runs once (so adaptive execution has settled its final plan); the listing
keeps scans (with pushed filters and read schema), exchanges, joins, aggregates, window
limits, windows and checkpointed inputs.
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridmart.plans.registry import queries  # noqa: E402
from gridmart.session import get_session  # noqa: E402

KEEP = ("Scan", "Exchange", "Join", "Aggregate", "WindowGroupLimit", "Window ", "TakeOrdered", "Generate",
        "LogicalRDD", "ExistingRDD", "Expand", "Union")


def _short(line: str) -> str:
    line = re.sub(r"#\d+L?", "", line)
    line = re.sub(r", \[plan_id=\d+\]", "", line)
    i = line.find("Location:")
    if i > 0:
        j = line.find("PushedFilters")
        line = line[:i] + (line[j:] if j > 0 else "")
    return line[:230]


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="+")
    args = ap.parse_args()
    spark = get_session("local[8]", shuffle_partitions=8)
    qs = queries()
    for name in args.names:
        df = qs[name](spark, args.sf)
        df.collect()  # run this DataFrame's own plan, so explain shows the final adaptive plan
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain(mode="simple")
        plan = buf.getvalue().split("== Initial Plan ==")[0]
        print(f"### `{name}`\n\n```")
        for line in plan.splitlines():
            if any(k in line for k in KEEP):
                print(_short(line.rstrip()))
        print("```\n")


if __name__ == "__main__":
    main()
