"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` at ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]``; each run executes the full
plan into the ``noop`` sink (nothing is collected). Per query: one warm-up
run, then the median of ``$BENCH_REPEAT`` (default 3) timed runs. Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reviewlake.plans.queries import QUERIES  # noqa: E402
from reviewlake.session import build_session  # noqa: E402
from reviewlake.sources.testdata import SPREAD_CONF  # noqa: E402

HEADLINE = [
    "clean_reviews",
    "rating_summary",
    "review_pace",
    "rating_histogram",
    "movie_keywords",
    "tag_counts_by_movie",
    "cast_boxoffice",
    "genre_share",
    "region_top10",
    "yoy_sales",
    "new_since_latest",
    "merge_append",
    "sentiment_lexicon",
    "sentiment_top10",
    "page_extract",
    "candidate_match",
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(app="reviewlake-bench")
    spark.conf.set(SPREAD_CONF, os.environ.get("BENCH_CPUS", "8"))  # the tables are files of one row group each
    times, errors = {}, {}
    for n in names:
        try:
            run(spark, n, sf_dir)  # warm-up: JIT, file listing, Python workers
            times[n] = round(statistics.median(run(spark, n, sf_dir) for _ in range(repeat)), 3)
        except Exception as e:  # noqa: BLE001 - report and go on with the other queries
            errors[n] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "sum of median wall time over headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(os.environ.get("BENCH_CPUS", "8")),
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
