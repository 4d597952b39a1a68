"""Comparison of the models in an artifact folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.operators import metrics, results, split
from isobar.session import scratch_scope
from isobar.sources import artifacts, tables
from isobar.sources.artifacts import ArtifactStore


def sample_metrics(store: ArtifactStore) -> DataFrame:
    """Scores on the stored prediction samples, for models with enough rows."""
    stored = store.read(artifacts.PLOT)
    pairs = stored.withColumnsRenamed(
        {"Predicted_Temperature_C": "prediction", "Actual_Temperature_C": "label"}
    )
    return metrics.prediction_metrics(pairs, ["model"])


def leaderboard_from(store: ArtifactStore) -> DataFrame:
    return results.leaderboard(
        results.join_sample_scores(store.read(artifacts.METRICS), sample_metrics(store))
    )


def validation_curves(store: ArtifactStore) -> DataFrame:
    return results.validation_curve(store.read(artifacts.CV))


def top_importances(store: ArtifactStore) -> DataFrame:
    return results.top_features(store.read(artifacts.IMPORTANCE), "importance")


def top_coefficients(store: ArtifactStore) -> DataFrame:
    return results.top_features(store.read(artifacts.COEFFICIENTS), "abs_coeff")


def export_tidy(store: ArtifactStore, out: str, cap: int | None = None) -> None:
    """Each kind as one CSV table partitioned by model, and the leaderboard.

    With a ``cap`` at most so many predictions per model, the first in hash order.
    """
    with scratch_scope(store.spark):
        for kind in artifacts.STORED:
            df = store.read(kind)
            if kind == artifacts.PLOT and cap is not None:
                df = split.capped_sample(df, df.columns, 1.0, cap, ["model"])
            if kind == artifacts.CV:
                df = df.withColumn("params", F.to_json("params"))
            tables.write_csv(df, f"{out}/tables/{kind}", ["model"])
        tables.write_csv(leaderboard_from(store), f"{out}/leaderboard")
