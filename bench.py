"""Times headline queries: BENCH_SF_DIR (default sf0.1) on local[BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from rallyframe.plans import catalog

HEADLINE = (
    "zone_vs_baseline", "zone_rollup_dense", "asof_backward", "asof_clamped", "gaps_islands_runs", "second_grid",
    "pending_state_with_clear", "running_max_rise", "majority_vote", "lineup_explode_agg", "onoff_split", "context_two_sided",
    "scope_grouping_sets", "rate_table", "percentile_rank_nonmember", "zscore_within_group", "full_outer_reconcile",
    "season_pair_selfjoin", "gram_matrix", "ridge_fit", "ridge_cv_folds", "advanced_rates", "rapm_table", "second_grid_compare", "season_stints",
)


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES[HEADLINE[0]](spark, folder).write.format("noop").mode("overwrite").save()  # starts the JVM's compilers
    took = {}
    for name in HEADLINE:
        began = time.time()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline_queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
