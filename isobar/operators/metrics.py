"""Prediction tables and their quality, in one aggregate per table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted spellings of the prediction and the label column.
PREDICTION_NAMES = ["prediction", "pred", "predicted", "y_pred", "predicted_temperature_c"]
LABEL_NAMES = [
    "label", "target", "y_true", "actual", "obs", "temperature", "temp", "y",
    "actual_temperature_c",
]
MIN_ROWS = 10


def only_match(by_name: dict[str, list[str]], accepted: list[str]) -> str | None:
    found = [c for name in accepted for c in by_name.get(name, [])]
    if len(found) > 1:
        raise ValueError(f"more than one column could be meant: {found}")
    return found[0] if found else None


def resolve_prediction_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame | None:
    """(label, prediction, kept columns) under whatever accepted names they have; None if either is absent.

    Two columns with accepted names for the same thing are an error.
    """
    by_name: dict[str, list[str]] = {}
    for c in df.columns:
        by_name.setdefault(c.lower(), []).append(c)
    chosen = {"label": only_match(by_name, LABEL_NAMES), "prediction": only_match(by_name, PREDICTION_NAMES)}
    if None in chosen.values():
        return None
    pairs = df.select(*[F.col(c).alias(name) for name, c in chosen.items()], *keep)
    return pairs.na.drop(subset=list(chosen))


def predicted_vs_actual(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return df.select(
        *keys,
        F.col("prediction").alias("Predicted_Temperature_C"),
        F.col("label").alias("Actual_Temperature_C"),
    )


def squared_error(label: str, prediction: str) -> Column:
    return F.pow(F.col(label) - F.col(prediction), F.lit(2.0))


def rmse_of(label: str, prediction: str) -> Column:
    return F.sqrt(F.avg(squared_error(label, prediction)))


def r2_of(label: str, prediction: str) -> Column:
    """1 - SSE / SST; NULL for a constant label."""
    total = F.var_pop(label) * F.count(label)
    return F.lit(1.0) - F.sum(squared_error(label, prediction)) / F.nullif(total, F.lit(0.0))


def prediction_metrics(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", prediction: str = "prediction",
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """Row count, RMSE, MAE, R2 and the common value range per group.

    Pairs with a NULL are left out. A group under ``min_rows`` pairs keeps its row and count;
    its scores are NULL.
    """
    pairs = df.na.drop(subset=[label, prediction])
    scores = (
        pairs.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            rmse_of(label, prediction).alias("rmse"),
            F.avg(F.abs(F.col(label) - F.col(prediction))).alias("mae"),
            r2_of(label, prediction).alias("r2"),
            F.least(F.min(label), F.min(prediction)).alias("low"),
            F.greatest(F.max(label), F.max(prediction)).alias("high"),
        )
    )
    enough = F.col("n_rows") >= min_rows
    return scores.withColumns({c: F.when(enough, F.col(c)) for c in ("rmse", "mae", "r2", "low", "high")})


def long_scores(df: DataFrame, predictions: dict[str, Column], keep: Sequence[str] = ()) -> DataFrame:
    """One row per model and scored row: (model, label, prediction), so that all models are
    compared by one grouped aggregate."""
    scored = [F.struct(F.lit(m).alias("model"), p.alias("prediction")) for m, p in predictions.items()]
    return df.select(*keep, "label", F.inline(F.array(*scored)))


def exact_and_sample(scores: DataFrame, in_sample: Column, min_rows: int = MIN_ROWS) -> DataFrame:
    """Per model the scores on all rows and on the marked sample, from one aggregate.

    The sample scores are NULL where the sample has fewer than ``min_rows`` rows.
    """
    s_label, s_pred = F.when(in_sample, F.col("label")), F.when(in_sample, F.col("prediction"))
    marked = scores.na.drop(subset=["label", "prediction"]).withColumns({"_l": s_label, "_p": s_pred})
    wide = marked.groupBy("model").agg(
        rmse_of("label", "prediction").alias("test_rmse"),
        r2_of("label", "prediction").alias("test_r2"),
        rmse_of("_l", "_p").alias("sample_rmse"),
        r2_of("_l", "_p").alias("sample_r2"),
        F.count("_l").alias("sample_rows"),
    )
    enough = F.col("sample_rows") >= min_rows
    sampled = ["sample_rmse", "sample_r2"]
    return wide.withColumns({c: F.when(enough, F.col(c)) for c in sampled})
