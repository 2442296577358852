"""Print the physical plan of registered queries (formatted), for review.

    python scripts/explain.py [sf_dir] [key ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from scoreline.plans.catalog import QUERIES  # noqa: E402
from scoreline.session import get_spark  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    keys = sys.argv[2:] or HEADLINE
    spark = get_spark()
    for k in keys:
        print(f"\n===== {k} =====", flush=True)
        QUERIES[k](spark, sf).explain("formatted")


if __name__ == "__main__":
    main()
