"""Print the formatted physical plan of one or more query keys.

    python explain.py sales_weekly inventory_weekly [--sf /root/testdata/sf0.01]
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stockroom.plans.registry import QUERIES  # noqa: E402
from stockroom.session import get_spark  # noqa: E402


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("keys", nargs="+", choices=sorted(QUERIES))
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    args = ap.parse_args()
    spark = get_spark()
    for key in args.keys:
        print(f"==== {key}")
        QUERIES[key](spark, args.sf).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
