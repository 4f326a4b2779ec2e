"""List registered queries whose physical plan contains a cross product.

usage: python scripts/check_no_cross_products.py [--sf DIR]
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridmart.plans.registry import queries  # noqa: E402
from gridmart.session import get_session  # noqa: E402


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.001")
    args = ap.parse_args()
    spark = get_session("local[8]", shuffle_partitions=8)
    bad = []
    for name, fn in queries().items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, args.sf).explain(mode="simple")
        if "CartesianProduct" in buf.getvalue() or "BroadcastNestedLoopJoin" in buf.getvalue():
            bad.append(name)
    print("cross products:", bad or "none", f"({len(queries())} queries checked)")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
