"""Train one model family on a split table and store everything it reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar import schema as S
from isobar.operators import clean, linear, metrics, results, split, tuning
from isobar.session import scratch_scope
from isobar.sources import artifacts
from isobar.sources.artifacts import ArtifactStore

SAMPLE_FRACTION = 0.01


def prepare(
    table: DataFrame, features: Sequence[str], null_policy: str = "drop", label: str = S.LABEL
) -> DataFrame:
    """Coordinates as numbers and one null policy for whatever the table holds."""
    text = [c for c, t in table.dtypes if c in S.COORDINATES and t == "string"]
    numeric = clean.cast_double(table, text) if text else table
    return clean.apply_null_policy(numeric, null_policy, features, label)


def prediction_sample(
    model, rows: DataFrame, keys: Sequence[str], fraction: float = SAMPLE_FRACTION, cap: int | None = None
) -> DataFrame:
    """Scored pairs of the fraction sample, of at most ``cap`` rows if given. Sampled, then scored."""
    chosen = split.sample_fraction(rows, keys, fraction, "plot")
    if cap is not None:
        chosen = split.capped_sample(rows, keys, fraction, cap)
    return metrics.predicted_vs_actual(model.transform(chosen))


def new_run_id() -> str:
    return f"run-{artifacts.now()}"


def train_family(
    table: DataFrame, store: ArtifactStore, family: str, keys: Sequence[str] = tuple(S.MODEL_KEY),
    features: Sequence[str] = tuple(S.FEATURES_ALL), label: str = S.LABEL,
    grid: Mapping[str, list] | None = None, null_policy: str = "drop", run_id: str | None = None,
    sample_fraction: float = SAMPLE_FRACTION, sample_cap: int | None = None,
    options: Mapping | None = None, folds: int = 3, fractions: Sequence[float] = tuple(linear.FRACTIONS),
    scale: bool = False, parallelism: int = 8,
):
    """Tune, refit, score and store one family; ``table`` has a ``split`` column.

    ``options`` are passed to every tree estimator, e.g. ``maxMemoryInMB``; ``scale`` keeps a scaler
    in a saved tree pipeline; ``parallelism`` fits run at once. One fit gives coefficients, scores,
    curve, saved model and sample. The prediction sample is whole unless ``sample_cap`` is given. The run is
    published when all of it is written.
    """
    features, keys = list(features), list(keys)
    name = tuning.MODEL_NAMES[family]
    spark, run = table.sparkSession, store.run(name, run_id or new_run_id())
    ready = prepare(table, features, null_policy, label).select("split", *keys, *features, label)
    tune = {"folds": folds, "fractions": fractions, "parallelism": parallelism}
    if family == "lr":
        study = linear.tune_linear(ready, keys, features, label, name, grid or linear.LINEAR_GRID, **tune)
        model = study.fit.pipeline()
        run.write(linear.coefficient_table(spark, study.fit, name), artifacts.COEFFICIENTS)
    else:
        study = tuning.tune_by_fits(ready, keys, family, features, label, grid, scale=scale, options=options, **tune)
        model = study.model
        run.write(tuning.importance_table(spark, study), artifacts.IMPORTANCE)
    run.write(results.cv_table(spark, study.cv_rows), artifacts.CV)
    run.write(results.learning_curve_table(spark, study.curve_rows), artifacts.CURVE)
    record = results.small_table(spark, [(study.test_rmse, study.test_r2)], "rmse double, r2 double")
    run.write(results.metrics_record(record, name, study.best), artifacts.METRICS)
    test = ready.filter(F.col("split") == "test").withColumn("label", F.col(label).cast("double"))
    with scratch_scope(spark):
        sample = prediction_sample(model, test, keys, sample_fraction, sample_cap)
        run.write(sample.withColumn("model", F.lit(name)), artifacts.PLOT)
    run.save_model(model)
    run.publish()
    return study
