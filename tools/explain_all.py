"""Write the physical plan of every registered query (for plan review).

usage: python tools/explain_all.py [sf_dir] > PLANS.txt
Long expression lines are cut at 160 characters.
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from threadmill.session import get_spark
    from threadmill.plans.catalog import QUERIES

    spark = get_spark("explain-all", master="local[8]", shuffle_partitions=8)
    for name, fn in QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        print(f"== {name}")
        for line in plan.splitlines():
            print(line if len(line) <= 160 else line[:157] + "...")
        print()
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
