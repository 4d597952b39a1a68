"""Calendar features, the modelling projection and vector transforms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from isobar import schema as S
from isobar.functions.times import parse_time, truncate_hour
from isobar.session import scratch_path


def hourly_rows(df: DataFrame, date: str = "DATE") -> DataFrame:
    """Rows stamped exactly on the hour."""
    return df.filter(F.minute(parse_time(date)) == 0)


def calendar_features(df: DataFrame, date: str = "DATE") -> DataFrame:
    timed = df.withColumn("DATETIME", parse_time(date))
    timed = timed.withColumns({
        "DATE_HOUR": truncate_hour(F.col("DATETIME")),
        "DATE_DAY": F.to_date("DATETIME"),
    })
    return timed.withColumns({
        "HOUR": F.hour("DATE_HOUR"),
        "MONTH": F.month("DATE_HOUR"),
        "DAY_OF_YEAR": F.dayofyear("DATE_HOUR"),
    })


def model_projection(df: DataFrame) -> DataFrame:
    return df.select(*S.MODEL_COLUMNS)


def rename_label(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    return df.withColumnsRenamed({label: "label"})


def assembler(features: Sequence[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="error")


def feature_stages(features: Sequence[str], scale: bool) -> list:
    """Pipeline stages from columns to a ``features`` vector, unit deviation if scaled."""
    if not scale:
        return [assembler(features)]
    return [
        assembler(features, "raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withStd=True, withMean=False),
    ]


def assemble_features(df: DataFrame, features: Sequence[str], output: str = "features") -> DataFrame:
    return assembler(features, output).transform(df)


def sample_deviations(columns: Sequence[str]) -> list[Column]:
    """Aggregates for ``observe`` or ``agg``: the sample deviation of each column under its name.

    Spark keeps count, mean and squared deviations around it and merges them between tasks.
    """
    return [F.stddev_samp(F.col(c).cast("double")).alias(c) for c in columns]


def scaled(df: DataFrame, features: Sequence[str], deviations: Mapping[str, float | None], output: str = "features") -> DataFrame:
    """Adds ``output``: the columns as a vector, each divided by its deviation; 0 where that is 0 or unknown."""
    parts = [
        F.col(c).cast("double") / F.lit(float(deviations[c])) if deviations[c] else F.lit(0.0) for c in features
    ]
    return df.withColumn(output, array_to_vector(F.array(*parts)))


def standard_scale(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Adds ``features``: the columns as a vector, each divided by its sample deviation.

    ``df`` is evaluated once: its rows are written, and the deviations observed while they are.
    """
    spark, seen = df.sparkSession, Observation()
    path = scratch_path(spark, "unscaled")
    df.observe(seen, *sample_deviations(features)).write.parquet(path)
    return scaled(spark.read.parquet(path), features, seen.get)


def vector_to_columns(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """A dense or sparse vector spread back into one double column per name."""
    values = vector_to_array(F.col(vector))
    return df.withColumns({n: F.get(values, F.lit(i)) for i, n in enumerate(names)})


def vector_explode(df: DataFrame, vector: str, keys: Sequence[str]) -> DataFrame:
    """One row per vector element: keys, position, value."""
    return df.select(*keys, F.posexplode(vector_to_array(F.col(vector))).alias("pos", "value"))
