"""Headline-query benchmark.

Runs the headline queries on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) in a warm
``local[$BENCH_CPUS]`` session: a warm-up pass runs every query once (JIT, file listing,
footer schemas), then each query runs ``$BENCH_REPEAT`` (default 5) timed times. A run
builds the DataFrame and writes the full result to Spark's ``noop`` sink, so every column
is computed and nothing is collected to the driver. Prints ONE JSON line with the median
seconds per query and their sum. ``BENCH_EVENT_LOG=1`` also writes Spark's event log to
the run's scratch folder (stage and task times; the UI stays off).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from placerank.plans.catalog import QUERIES  # noqa: E402
from placerank.session import local_session  # noqa: E402

HEADLINE = [
    "top_items", "popularity_score_sales", "tfidf_terms", "top_tfidf_terms", "keyword_ranking",
    "keyword_ranking_item_join", "hybrid_recommendations", "evaluate_hybrid", "listing_feature_columns",
    "cluster_items", "tfidf_vectors",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    names = sys.argv[1:] or HEADLINE
    scratch = tempfile.mkdtemp(prefix="placerank-bench-", dir="/tmp")
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):
        # Stage and task times for later reading, written to this run's scratch folder.
        events = os.path.join(scratch, "events")
        os.makedirs(events)
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": events}
    spark = local_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus), scratch_dir=scratch,
                          extra_conf=extra)
    errors = {}
    for name in names:
        try:
            run_once(spark, name, sf_dir)
        except Exception as e:  # report the failure in the JSON line instead of no line at all
            errors[name] = str(e).splitlines()[0][:300]
    per_query = {}
    for name in names:
        if name in errors:
            per_query[name] = None
            continue
        per_query[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(repeat)), 4)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_median_sum",
        "value": round(sum(v for v in per_query.values() if v is not None), 4),
        "unit": "sec",
        "queries": per_query,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "repeat": repeat,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
