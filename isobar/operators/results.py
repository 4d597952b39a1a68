"""Result tables: tuning scores, curves, rankings and the model leaderboard."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isobar import schema as S

# Column spellings found in older learning-curve tables.
CURVE_SYNONYMS = {
    "train_size_fraction": "fraction", "train_count": "n_rows", "rmse": "test_rmse", "r2": "test_r2",
}


def small_table(spark: SparkSession, rows: Sequence[tuple], schema) -> DataFrame:
    """A handful of driver rows in one partition; by default they would be spread over as
    many tasks as the cluster has cores."""
    return spark.createDataFrame(list(rows), schema).coalesce(1)


def cv_table(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """(model, grid_idx, params, avg_rmse), one row per tried setting."""
    return small_table(spark, rows, S.CV_SCHEMA)


def cv_table_wide(cv: DataFrame, names: Sequence[str]) -> DataFrame:
    """One column per parameter, as text, after the average error."""
    return cv.select(
        "model", "grid_idx", "avg_rmse", *[F.col("params").getItem(n).alias(n) for n in names]
    )


def learning_curve_table(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return small_table(spark, rows, S.LEARNING_CURVE_SCHEMA)


def best_params(cv: DataFrame) -> DataFrame:
    """Per model the setting with the lowest error; the earliest of equals."""
    order = F.struct("avg_rmse", "grid_idx")
    return (
        cv.filter(F.col("avg_rmse").isNotNull()).groupBy("model")
        .agg(F.min_by(F.struct("grid_idx", "params", "avg_rmse"), order).alias("b"))
        .select("model", "b.grid_idx", "b.params", "b.avg_rmse")
    )


def validation_curve(cv: DataFrame) -> DataFrame:
    """Mean error per value of each numeric parameter, over all values of the others."""
    long = cv.select("model", "avg_rmse", F.explode("params").alias("param", "text"))
    return (
        long.select("model", "param", F.col("text").try_cast("double").alias("value"), "avg_rmse")
        .filter(F.col("value").isNotNull())
        .groupBy("model", "param", "value")
        .agg(F.avg("avg_rmse").alias("avg_rmse"))
        .orderBy("model", "param", "value")
    )


def top_features(df: DataFrame, weight: str, n: int = 20, by: Sequence[str] = ("model",)) -> DataFrame:
    """The ``n`` features of largest ``weight`` per model, ties by name."""
    order = Window.partitionBy(*by).orderBy(F.desc(weight), "feature")
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def spelled(df: DataFrame) -> DataFrame:
    """A learning curve with its columns under their common names."""
    return df.withColumnsRenamed({
        old: new for old, new in CURVE_SYNONYMS.items() if old in df.columns and new not in df.columns
    })


def normalize_curve(df: DataFrame, model: str | None = None) -> DataFrame:
    """A learning curve of any accepted spelling in the one common schema."""
    out = spelled(df)
    if model is not None:
        out = out.withColumn("model", F.lit(model))
    return out.select(*[
        (F.col(f.name) if f.name in out.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in S.LEARNING_CURVE_SCHEMA.fields
    ])


def union_curves(curves: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [normalize_curve(df, m) for m, df in curves.items()])


def metrics_record(df: DataFrame, model: str, best: Mapping) -> DataFrame:
    """(model_name, test_rmse, test_r2, best_hyperparameters as JSON text) from (rmse, r2)."""
    params = F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in best.items()])) if best else F.lit("{}")
    return df.select(
        F.lit(model).alias("model_name"),
        F.col("rmse").alias("test_rmse"),
        F.col("r2").alias("test_r2"),
        params.alias("best_hyperparameters"),
    )


def leaderboard(board: DataFrame) -> DataFrame:
    """Ranks models by exact test RMSE; a model without one comes last."""
    # One row per model, so a window without partitions is a handful of rows.
    place = F.row_number().over(Window.orderBy(F.col("test_rmse").asc_nulls_last(), "model"))
    return board.withColumn("rank", place)


def join_sample_scores(exact: DataFrame, sampled: DataFrame) -> DataFrame:
    """Stored exact scores with the sample scores beside them, never in their place."""
    scores = sampled.select(
        "model", F.col("rmse").alias("sample_rmse"), F.col("r2").alias("sample_r2"),
        F.col("n_rows").alias("sample_rows"),
    )
    board = exact.select(F.col("model_name").alias("model"), "test_rmse", "test_r2")
    return board.join(scores, "model", "left")
