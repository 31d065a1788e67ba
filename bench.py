"""Time the headline queries. Prints one JSON line."""

import json
import os
import time

HEADLINE = [
    "flagship_area_month_returns", "filt_exclude_set", "filt_min_group_count", "str_link_key", "str_rule_label", "dt_parts",
    "join_left_linkkey", "join_scorecards", "join_enrich_coalesce", "join_full_parent", "join_nearest_point",
    "agg_month_panel", "agg_smoothed_share", "agg_describe", "agg_global_median", "agg_value_domain",
    "win_group_bounds_filter", "win_ffill_global", "win_dedupe_keep", "win_interpolate_linear",
    "imp_group_first", "imp_median", "map_dot_drivers", "fc_backtest", "fc_decay_adjust",
    "req_nearest_profile", "req_forecast_report", "stage_micro", "stage_training", "stage_panel",
]


def main():
    from pyspark.sql import SparkSession

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "6g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from parcelflow.plans import RUNNERS

    spark.read.parquet(f"{sf_dir}/nation.parquet").count()
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    took = {}
    for name in names:
        start = time.perf_counter()
        RUNNERS[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    total = round(sum(took.values()), 3)
    print(json.dumps({"metric": "headline queries, total time", "value": total, "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir)}))


if __name__ == "__main__":
    main()
