"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from checks import QUERIES  # noqa: E402
from tidepanel.session import local_session  # noqa: E402

HEADLINE = (
    "flagship", "city_ranking", "bucket_distribution", "freshness", "monthly_trends",
    "missing_pct", "correlation_matrix", "measure_summary", "summer_winter", "tail_n",
    "add_lags", "add_rolling", "zscore", "trend_decomp", "feat_pipeline", "events_lags_sized",
    "events_rolling_blocked", "detect_gaps", "baseline_ma", "evaluate_baselines", "error_by_band",
    "split_expanding", "prep_impute", "resample_week", "histogram", "kde_grid", "seasonal_box",
    "src_json_rows", "sink_unique_key", "model_trend_seasonal", "forecast_entity",
    "forecast_batch", "cross_validation", "model_gbt",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    # Start the executor threads and code generation before the first timed query.
    spark.range(100_000).groupBy((F.col("id") % 10).alias("k")).count().collect()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(scale)}))


if __name__ == "__main__":
    main()
