"""Print the final (AQE) physical plan of registered queries, with a short summary.

    python tools/explain_plans.py /root/testdata/sf0.1 player_360 silver_deposits ...

For each query: number of exchanges, reused exchanges, broadcast exchanges,
single-partition exchanges and Parquet scans per table, then the final plan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewell.plans import catalog  # noqa: E402
from tidewell.session import build_session  # noqa: E402

TABLES = ["customer", "nation", "orders", "lineitem", "events", "part"]


def final_plan(df) -> str:
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    if "== Final Plan ==" in p:
        p = p[p.index("== Final Plan =="):p.index("== Initial Plan ==")]
    return p


def summary(p: str) -> dict:
    return {
        "exchanges": len(re.findall(r"\bExchange\b", p)),
        "reused": p.count("ReusedExchange"),
        "broadcast": p.count("BroadcastExchange"),
        "single_partition": p.count("SinglePartition"),
        "scans": {t: len(re.findall(r"FileScan parquet [^\n]*" + t + r"[.]parquet", p)) for t in TABLES},
    }


def main() -> None:
    sf = sys.argv[1]
    names = sys.argv[2:] or ["player_360"]
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    qs = catalog.queries()
    for n in names:
        p = final_plan(qs[n](spark, sf))
        print(f"### {n}\n{summary(p)}\n{p}\n")


if __name__ == "__main__":
    main()
