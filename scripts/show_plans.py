"""Print the physical plans of registered queries.

Usage: python scripts/show_plans.py [--at-scale] [--formatted] [sf_dir] [query ...]

``--at-scale`` turns broadcast joins off, which is how the joins are planned
when every side is large; the small test tables would otherwise be broadcast.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakevault.plans.queries import QUERIES  # noqa: E402
from lakevault.session import build_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    at_scale = "--at-scale" in args
    mode = "formatted" if "--formatted" in args else "simple"
    args = [a for a in args if not a.startswith("--")]
    sf = args[0] if args else "/root/testdata/sf0.1"
    names = args[1:] or list(QUERIES)
    extra = {"spark.sql.autoBroadcastJoinThreshold": "-1"} if at_scale else {}
    spark = build_session(extra_conf=extra)
    for name in names:
        print(f"===== {name}")
        QUERIES[name](spark, sf).explain(mode=mode)
    spark.stop()


if __name__ == "__main__":
    main()
