"""Run one of the end-to-end jobs (``reviewlake.plans.jobs``).

usage (local or under spark-submit):
  python scripts/run_job.py reviews-batch --out OUT --watcha DIR --megabox DIR --cgv DIR --cine DIR
  python scripts/run_job.py reviews-daily --out OUT --day 2025-03-19 --megabox DIR ...
  python scripts/run_job.py boxoffice --out OUT --daily DIR [--region DIR] [--legacy]

Under spark-submit the cluster's session settings are used; ``cluster_settings``
adds the large-input defaults. Prints the written table paths as JSON.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from reviewlake.plans import jobs  # noqa: E402
from reviewlake.session import cluster_settings  # noqa: E402

PLATFORMS = ("watcha", "megabox", "cgv", "cine")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    sub = ap.add_subparsers(dest="job", required=True)
    for name in ("reviews-batch", "reviews-daily"):
        p = sub.add_parser(name)
        p.add_argument("--out", required=True)
        for pl in PLATFORMS:
            p.add_argument(f"--{pl}")
        if name == "reviews-daily":
            p.add_argument("--day", required=True)
    b = sub.add_parser("boxoffice")
    b.add_argument("--out", required=True)
    b.add_argument("--daily", required=True)
    b.add_argument("--region")
    b.add_argument("--legacy", action="store_true")
    args = ap.parse_args(argv)

    spark = cluster_settings(SparkSession.builder.appName(f"reviewlake-{args.job}").getOrCreate())
    if args.job == "boxoffice":
        paths = jobs.boxoffice_job(spark, args.daily, args.out, region_folder=args.region, legacy=args.legacy)
    else:
        folders = {pl: getattr(args, pl) for pl in PLATFORMS if getattr(args, pl)}
        if args.job == "reviews-batch":
            paths = jobs.review_batch_job(spark, folders, args.out)
        else:
            paths = jobs.review_daily_job(spark, folders, args.out, args.day)
    print(json.dumps(paths))


if __name__ == "__main__":
    main()
