"""Physical-plan summary per registered query (after execution, so AQE's
final choices show): joins, aggregates, windows, generators, exchanges and
pushed filters. Prints a Markdown table.

usage: python scripts/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reviewlake.plans.queries import QUERIES  # noqa: E402
from reviewlake.session import build_session  # noqa: E402

PATTERNS = {
    "BroadcastHashJoin": r"BroadcastHashJoin",
    "SortMergeJoin": r"SortMergeJoin",
    "NestedLoop/Cartesian": r"BroadcastNestedLoopJoin|CartesianProduct",
    "HashAggregate": r"HashAggregate",
    "SortAggregate": r"SortAggregate",
    "WindowGroupLimit": r"WindowGroupLimit",
    "Window": r"\bWindow \[",
    "Generate": r"\bGenerate\b",
    "TakeOrdered": r"TakeOrderedAndProject",
    "MapInPandas": r"MapInPandas",
    "Python UDF": r"BatchEvalPython|ArrowEvalPython",
    "SinglePartition": r"SinglePartition",
    "RoundRobin": r"RoundRobinPartitioning",
    "Scan": r"FileScan|Scan parquet",
    "PushedFilters": r"PushedFilters: \[[^\]]",
}


def final_plan(df) -> str:
    df.collect()  # runs this DataFrame's own execution, so its adaptive plan is final
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in text or "AdaptiveSparkPlan" not in text
    return text.split("\n+- == Initial Plan ==")[0]  # the top-level final plan (subqueries keep theirs)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    print("| query | " + " | ".join(PATTERNS) + " |")
    print("| --- |" + " --- |" * len(PATTERNS))
    for name, fn in QUERIES.items():
        if name.startswith("stream_") or name in ("sentiment_ml", "file_ingest", "table_sinks", "append_day_rerun", "daily_keywords", "csv_table"):
            continue
        p = final_plan(fn(spark, sf))
        cells = [str(len(re.findall(rx, p))) or "" for rx in PATTERNS.values()]
        print(f"| {name} | " + " | ".join(c if c != "0" else "" for c in cells) + " |")


if __name__ == "__main__":
    main()
