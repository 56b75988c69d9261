"""Time the headline queries.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS] and
prints one JSON line. Each query runs to completion through the ``noop``
sink (nothing is collected to the driver); the value is the median of
$BENCH_REPEAT runs after one warm-up query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from nearrate.keep import releasing  # noqa: E402
from nearrate.plans import QUERIES  # noqa: E402
from nearrate.session import get_session  # noqa: E402

HEADLINE = [
    "ratings",
    "mae_by_method",
    "cosine_similarity",
    "jaccard_similarity",
    "predict_personalized_cosine",
    "knn_neighbours_k10",
    "predict_knn_k10",
    "mae_knn_sweep",
    "approx_neighbours",
    "mae_approx_knn",
    "recommend_top3",
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    with releasing():
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    spark = get_session(f"local[{cpus}]", int(cpus) * int(os.environ.get("BENCH_PARTS_PER_CPU", "1")),
                        app_name="nearrate-bench")
    run(spark, "global_mean", sf_dir)  # warm-up: JVM, parquet footers
    # Start the Python workers once, as any long-running session has them.
    (spark.range(64).withColumn("g", F.col("id") % 8).groupBy("g")
     .applyInPandas(lambda pdf: pdf, "id long, g long")
     .write.format("noop").mode("overwrite").save())
    times, failed = {}, {}
    for name in names:
        try:
            times[name] = round(statistics.median(run(spark, name, sf_dir)
                                                  for _ in range(repeat)), 3)
            print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
        except Exception as e:  # keep timing the others; report the failure
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
            print(f"# {name}: FAILED {failed[name]}", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus)}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))


if __name__ == "__main__":
    main()
