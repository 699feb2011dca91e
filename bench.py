"""Time the headline queries: one JSON line with seconds per query (second run, after one warm-up)."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalog.spark_queries import QUERIES  # noqa: E402
from postmill.session import local_session  # noqa: E402

HEADLINES = [
    "numerical_stats", "categorical_stats", "grouped_stats", "outliers_iqr", "outliers_zscore", "corr_pearson",
    "corr_spearman", "distributions", "top_values_per_column", "crosstab", "exact_duplicates", "likely_duplicates",
    "clean_text", "salary", "experience", "clean_postings", "cleaning_counts", "quality_score", "missing_values",
    "overview", "job_distributions", "salary_by_group", "chart_histogram", "chart_box",
]


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(
        os.environ.get("BENCH_CPUS", "8"), "postmill-bench", **{"spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINES
    times = {}
    for name in names:
        seconds(spark, name, sf_dir)
        times[name] = round(seconds(spark, name, sf_dir), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total time of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
