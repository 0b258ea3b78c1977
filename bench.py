"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of local cores.
Each query runs twice; the second time counts, as the first one also compiles. Models run
once. The total also has the preparation of the shared tables, from a cold start. Results are written to a sink that discards them.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent)
sys.path.insert(0, ROOT)
# Python workers are started by the JVM, which takes this over; without it they find the library from its own folder only.
os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, os.environ.get("PYTHONPATH")) if p)

from lotwise.catalog import all_queries  # noqa: E402
from lotwise.catalog.common import split_table  # noqa: E402
from lotwise.fixtures import listings  # noqa: E402

HEADLINES = [
    "preprocess",
    "describe_all",
    "association_matrix",
    "evaluate_train_test",
    "lookup_table",
    "histogram",
    "kde_curve",
    "box_stats",
    "top_k_values",
    "skew_report",
    "iqr_outlier_count",
    "duplicate_count",
    "group_median_topk",
    "price_trend",
    "fill_features",
    "standard_scale",
    "train_test_split",
    "box_stats_by_group",
    "price_trend_all",
]
#: Fits that end in a minute or so: run once, as they are long beside the start of the JVM. The full-size tree fits and the searches are not here.
MODELS = ["fit_linear", "fit_svr", "score"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    start = time.time()
    listings(spark, folder)
    prepare = {"listing_table": round(time.time() - start, 3)}
    start = time.time()
    split_table(spark, folder)
    prepare["clean_and_split_table"] = round(time.time() - start, 3)
    times: dict[str, float] = {}
    for name in [*HEADLINES, *MODELS]:
        for _ in range(1 if name in MODELS else 2):
            start = time.time()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries and of preparing their tables",
                "value": round(sum(times.values()) + sum(prepare.values()), 3),
                "unit": "sec",
                "queries": times,
                "prepare": prepare,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
