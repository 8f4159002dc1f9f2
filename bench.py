"""Times the headline queries on local Spark and prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores (default 8). Each query is
run to the end of its result by a no-op write.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "a1_top_products", "a2_monthly_trend", "a3_by_store", "a4_seasonality", "a5_kpis", "a10_weekly", "a12_category_shares", "a18_rate_by_group",
    "a22_percentile", "j2_monthly_weather", "j3_role_playing", "j6_interval_join", "j12_as_of_history", "w1_rolling_mean_by_discount",
    "w1_rolling_mean_of_events", "w3_trailing_means", "w5_top_neighbours", "w9_cumulative_sum", "w10_roc_points", "p12_threshold_rules",
    "p13_combined_flag", "p25_impute_by_group", "m2_baseline_detector", "m7_silhouette", "m8_demand_features", "m13_linear_trend", "m17_recommend",
    "m21_tfidf", "m24_classification_report", "m32_flight_features", "f17_keywords", "s25_page_items", "st1_anomaly_stream", "st6_dialogue",
]


def main() -> None:
    from tidemill import build_session
    from tidemill.plans import registered

    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # start the engine and its Python workers before the clock runs
    spark.range(0, 10_000, 1, int(cpus)).mapInPandas(lambda it: it, "id long").count()
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    times = {}
    for name in names:
        at = time.perf_counter()
        registered()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - at, 3)
        print(f"{times[name]:8.2f}s {name}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
