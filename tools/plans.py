"""Write PLANS.md: the final (post-AQE) physical operator tree of every
catalogue query, executed on a given scale factor.

usage: python tools/plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from cinerank.plans.catalog import queries  # noqa: E402
from cinerank.session import build_session  # noqa: E402

SKIP = {"tune_als", "stream_recommender_available_now", "stream_recommender_stateful", "ingest_roundtrip"}


def tree(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        # keep the operator and its key arguments, drop attribute ids
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        if len(line) > 160:
            line = line[:157] + "..."
        out.append(line)
    return "\n".join(out)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=16)
    print(f"# Physical plans\n\nFinal adaptive plans after execution on `{sf}` (`local[8]`, 16 shuffle partitions,"
          " AQE on), from `tools/plans.py`. Attribute ids removed; long lines cut.\n")
    for name, fn in queries().items():
        if name in SKIP:
            continue
        df = fn(spark, sf)
        # run through the DataFrame's own query execution (JVM side, no rows
        # to Python) so the printed adaptive plan is the final one
        df._jdf.queryExecution().toRdd().count()
        print(f"## {name}\n\n```\n{tree(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
