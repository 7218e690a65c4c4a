"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (names).
Every query runs once, cold, to a sink that drops the rows; ``value`` is the sum.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
from windrow.queries import registry  # noqa: E402
from windrow.scale import local_session  # noqa: E402

HEADLINE = (
    "chunk_fixed chunk_shifted clean_text quota_fill balance_parity audit_table integrity_report "
    "term_stats tfidf_fit tfidf_transform classification_report homogeneity_completeness "
    "build_all score_batch evaluate_suite"
).split()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).repartition(8).count()
    queries, times = registry.queries(), {}
    for name in os.environ.get("BENCH_QUERIES", "").split() or HEADLINE:
        t0 = time.time()
        queries[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": Path(sf).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
