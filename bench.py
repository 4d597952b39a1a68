"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [--compare]

Each time is the better of two full evaluations. ``--compare`` adds other ways to the same
results: one field parsed instead of all, one fit per fold and setting for the linear grid, one
evaluator job per metric.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from isobar.plans.registry import QUERIES  # noqa: E402
from isobar.session import local_session, scratch_scope  # noqa: E402

HEADLINE = [
    "model_table", "quality_funnel", "range_validate", "dedupe_keyed", "feature_profile",
    "feature_profile_lineitem", "train_test_split", "split_lineitem", "standard_scale",
    "vector_explode", "gram_by_fold", "cv_lr", "lr_tuned", "learning_curve_lr", "prediction_metrics",
    "capped_sample_lineitem", "leaderboard", "dt_tuned", "rf_tuned", "gbt_tuned", "learning_curve_tree",
    "src_csv_roundtrip", "sink_parquet_roundtrip", "model_save_load", "report_leaderboard",
]
RUNS = 2


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def best_of(job) -> float:
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        job()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def comparisons(spark, sf_dir: str) -> dict[str, float]:
    """Other ways to the same tables, over a stored table dealt to all cores."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import LinearRegression
    from pyspark.sql import functions as F

    from isobar import schema as S
    from isobar.operators import clean, features, linear, metrics, split, tuning
    from isobar.plans import preprocess
    from isobar.session import scratch_path
    from isobar.sources.observations import observations

    raw_path, table_path = scratch_path(spark, "raw"), scratch_path(spark, "table")
    cores = spark.sparkContext.defaultParallelism
    observations(spark, sf_dir).repartition(cores).write.parquet(raw_path)
    raw = spark.read.parquet(raw_path)
    preprocess.write_split_table(raw, table_path, "obs_id")
    table = spark.read.parquet(table_path)

    def parse():
        run(clean.range_validate(preprocess.parsed_observations(raw)))

    def parse_one_field():
        run(preprocess.parsed_observations(raw, fields=["TMP_C"]).select("TMP_C"))

    def linear_by_separate_fits():
        keyed = split.kfold_assign(features.rename_label(table.filter("split = 'train'")), S.MODEL_KEY)
        rows = features.assemble_features(keyed, S.FEATURES_ALL).select(*S.MODEL_KEY, "fold", "label", "features").persist()
        evaluator, scores = RegressionEvaluator(), []
        settings = tuning.expand_grid(tuning.GRIDS["lr"])
        for setting in settings:
            folds = [
                evaluator.evaluate(LinearRegression(**setting).fit(rows.filter(F.col("fold") != k)).transform(rows.filter(F.col("fold") == k)))
                for k in range(3)
            ]
            scores.append(sum(folds) / 3)
        best = tuning.best_setting(settings, scores)
        for share in linear.FRACTIONS:
            evaluator.evaluate(LinearRegression(**best).fit(split.sample_fraction(rows, S.MODEL_KEY, share)).transform(rows))
        rows.unpersist()

    scored = table.select("split", F.col(S.LABEL).alias("label"), F.col("DEW_C").alias("prediction"))

    def metrics_by_evaluator():
        for part in ("train", "test"):
            for metric in ("rmse", "r2"):
                RegressionEvaluator(metricName=metric).evaluate(scored.filter(F.col("split") == part))

    return {
        "parse_and_validate": best_of(parse),
        "parse_one_field": best_of(parse_one_field),
        "linear_study": best_of(lambda: linear.tune_linear(table, S.MODEL_KEY, S.FEATURES_ALL)),
        "linear_study_by_separate_fits": best_of(linear_by_separate_fits),
        "metrics_one_pass": best_of(lambda: metrics.prediction_metrics(scored, ["split"]).collect()),
        "metrics_by_evaluator": best_of(metrics_by_evaluator),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "isobar-bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).groupBy().count().collect()

    def once(name: str) -> None:
        with scratch_scope(spark):
            run(QUERIES[name](spark, sf_dir))

    times = {name: best_of(lambda: once(name)) for name in HEADLINE}
    result = {
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    if "--compare" in sys.argv:
        result["comparisons"] = comparisons(spark, sf_dir)
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
