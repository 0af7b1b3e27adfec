"""Print the plan-review table of README.md: per queries() key, the shuffle
exchanges and broadcast joins of the final adaptive plan.

Usage: python tests/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def final_plan_counts(df) -> tuple[int, int, int]:
    df.collect()  # runs the plan; the adaptive plan is final afterwards
    s = df._jdf.queryExecution().executedPlan().toString()
    final = s.split("+- == Initial Plan ==")[0]
    return (len(re.findall(r"Exchange hashpartitioning", final)),
            len(re.findall(r"Exchange rangepartitioning", final)),
            final.count("BroadcastHashJoin"))


def main() -> None:
    from cohortlift.session import build_session

    import __spark_entry__ as E

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]")
    print("| key | hash shuffles | range shuffles | broadcast joins |")
    print("| --- | ---: | ---: | ---: |")
    for key, q in E.queries().items():
        h, r, b = final_plan_counts(q(spark, sf_dir))
        print(f"| {key} | {h} | {r} | {b} |")


if __name__ == "__main__":
    main()
