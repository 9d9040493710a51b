"""Print the physical plan tree of selected registered queries (explain formatted).

Usage: python tools/show_plans.py [sf_dir] [key ...]  > docs/PLANS.md
Only the operator tree of each plan and its scan lines are kept.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DEFAULT = [
    "users_refined", "transactions_refined", "txn_index", "txn_lookup", "txn_lookup_pruned", "users_history_delta",
    "scd2_merge", "scd2_merge_repeated_keys", "keyed_patch", "latest_batch", "month_keys",
]


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    head = text.split("\n\n\n")[0] if "\n\n\n" in text else text.split("\n\n(1)")[0]
    scans = [
        ln.strip() for ln in text.splitlines()
        if ln.startswith(("ReadSchema:", "PushedFilters:", "PartitionFilters:"))
        or "dynamicpruning" in ln.lower() and ln.startswith("PartitionFilters")
    ]
    return head.strip() + "\n" + "\n".join(s[:220] for s in scans)


def main() -> None:
    from ledgerlake.plans.registered import QUERIES
    from ledgerlake.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or DEFAULT
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plans of the main operators\n")
    print(f"Generated by `tools/show_plans.py` on `{sf}` (local[8], AQE on; `isFinalPlan=false`"
          " is the plan before AQE re-optimises at run time).\n")
    for k in keys:
        print(f"## {k}\n\n```\n{tree(QUERIES[k](spark, sf))}\n```\n")


if __name__ == "__main__":
    main()
