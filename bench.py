"""Time the headline queries on one machine and print one JSON line.

Every query is written to a sink that discards its rows, so that all of its columns are computed. ``BENCH_SF_DIR`` and
``BENCH_CPUS`` choose the tables and the number of threads.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from queries.registry import QUERIES  # noqa: E402
from shelfline.session import build_session  # noqa: E402

HEADLINE = [
    "enrich_sales",
    "calendar_features",
    "lag_features",
    "rolling_features",
    "expanding_features",
    "expanding_by_store",
    "days_until_promo",
    "promo_streak",
    "seasonality_features",
    "seasonality_by_store",
    "holiday_join",
    "oil_promo_join",
    "oil_dense",
    "item_price_dense",
    "calendar_gaps",
    "fold_summary",
    "feature_profile",
    "feature_matrix",
    "fold_train_features",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the engine and warm the file cache, so that the first query is not charged for it.
    QUERIES["series_date_bounds"](spark, sf_dir).collect()

    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
