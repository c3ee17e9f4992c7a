"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line with per-query seconds.

Each query is executed in full with the no-op sink (no driver transfer)."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from arrivo.plans.queries import QUERIES  # noqa: E402
from arrivo.session import local_session, use_local_checkpoints  # noqa: E402

HEADLINE = (
    "missing_policy", "encode_shared", "holiday_nearest", "dim_join", "interactions",
    "assemble", "standard_scale", "score_holdout", "rf_grid_cv",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [a for a in sys.argv[1:]] or list(HEADLINE)
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), driver_memory="16g",
                          app_name="arrivo-bench")
    spark.sparkContext.setLogLevel("ERROR")
    use_local_checkpoints(spark)
    times = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
