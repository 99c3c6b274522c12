"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is run once to warm up (JIT, FX table) and timed on the second run
with a ``noop`` sink, so the whole plan executes without collecting rows.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewell.plans import catalog  # noqa: E402
from tidewell.session import build_session, drop_materialised  # noqa: E402
from tidewell.sources import bindings  # noqa: E402

HEADLINE = [
    "fx_dense", "silver_deposits", "silver_bets", "silver_campaigns", "reconciliation",
    "dq_bronze_checks", "fact_bet", "player_360", "value_segments", "ltv_channel_offer_product",
    "taxonomy_conformance", "dormancy_gaps", "dormancy_return", "target_list",
    "ltv_by_channel", "channel_offer_fanout", "dq_verdict_changes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", app="tidewell-bench",
                          shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set(bindings.DEAL_OUT, cpus)  # the given tables are one file each
    qs = catalog.queries()
    names = [n for n in HEADLINE if n in qs]
    if os.environ.get("BENCH_ALL"):
        names = list(qs)
    times = {}
    for name in names:
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        t = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)
    drop_materialised(spark)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
