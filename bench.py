"""Time the headline queries once each and print one JSON line.

Queries that share a prepared step (the labelled cohort, the training frame, the trained model)
are preceded by that step, timed as a query of its own.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from catalogue import queries as q

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

STEPS = [
    ("step_modelled", q.modelled),
    ("step_training_frame", q.training_frame),
    ("step_model_rows", q.model_rows),
    ("step_scored_accounts", q.scored_accounts),
    ("step_train_model", q.trained),
]
HEADLINE = [
    "cohort_accounts",
    "churn_labels",
    "role_volume",
    "usage_by_day",
    "usage_grid",
    "package_grid",
    "campaign_grid",
    "usage_grid_users",
    "feature_assembly",
    "scoring_assembly",
    "message_dedup",
    "keyword_flags_documents",
    "keyword_features",
    "variable_levels",
    "missing_share",
    "medians",
    "medians_lines",
    "numeric_profile_lines",
    "variable_roles",
    "split_events",
    "impute_train",
    "seen_categories",
    "quantile_bins_lines",
    "woe_table",
    "woe_lines",
    "gini_exact_lines",
    "ks_lines",
    "score_deciles_lines",
    "threshold_sweep_lines",
    "decile_profile_lines",
    "optimal_bins_lines",
    "accuracy_importance",
    "pca_scores",
    "score_batch",
    "score_output",
    "forest_gini",
    "boosted_challenger",
    "score_sink_append",
    "model_roundtrip",
    "optimal_bins",
]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="checkpoint-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads
    times: dict[str, float] = {}

    def timed(name, action) -> None:
        start = time.perf_counter()
        action()
        times[name] = round(time.perf_counter() - start, 3)

    for name, step in STEPS:
        timed(name, lambda: step(spark, SF_DIR))
    for name in HEADLINE:
        build = q.QUERIES[name].build
        timed(name, lambda: build(spark, SF_DIR).write.format("noop").mode("overwrite").save())
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
