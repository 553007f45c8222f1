"""Print Spark's formatted physical plan of registered outputs.

    python explain_plan.py /root/testdata/sf0.1 q3_completion_by_genre [more keys]

Look for PushedFilters / ReadSchema on the scans, BroadcastHashJoin only
on bounded sides, and no Exchange SinglePartition below a Window over rows
of the fact or user tables.
"""
from __future__ import annotations

import sys

from reelhouse.registry import build
from reelhouse.session import get_session


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = get_session("local[8]", 16)
    for name in names:
        print(f"===== {name} =====")
        build(name, spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
