"""Column names, schemas and limits shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

# The packed columns of a raw observation, in file order.
RAW_COLUMNS = [
    "STATION", "DATE", "LATITUDE", "LONGITUDE", "ELEVATION",
    "WND", "TMP", "DEW", "SLP", "VIS", "AA1",
]
COORDINATES = ["LATITUDE", "LONGITUDE", "ELEVATION"]
PACKED = ["WND", "TMP", "DEW", "SLP", "VIS", "AA1"]
KEY = ["STATION", "DATE"]
MODEL_KEY = ["STATION", "DATE_HOUR"]

# Model inputs, in vector order, and the label.
FEATURES_ALL = [
    "HOUR", "MONTH", "DAY_OF_YEAR", "LATITUDE", "LONGITUDE", "ELEVATION",
    "WIND_DIR", "WIND_SPEED", "DEW_C", "SLP_HPA", "PRECIP_MM", "RH_PCT", "VIS_M",
]
LABEL = "TMP_C"
MODEL_COLUMNS = MODEL_KEY + FEATURES_ALL + [LABEL]

# RH_PCT is computed from the label, so a fair model leaves it out.
FEATURES_NO_LEAK = [c for c in FEATURES_ALL if c != "RH_PCT"]

# Closed physical ranges an observation must satisfy.
VALID_RANGES = {
    "TMP_C": (-90.0, 65.0),
    "DEW_C": (-95.0, 40.0),
    "SLP_HPA": (850.0, 1100.0),
    "WIND_SPEED": (0.0, 90.0),
    "PRECIP_MM": (0.0, 1000.0),
    "RH_PCT": (0.0, 100.0),
}

# The measurements that have a valid range.
MEASUREMENTS = list(VALID_RANGES)


def all_string(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


CV_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("grid_idx", T.IntegerType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("avg_rmse", T.DoubleType()),
])
LEARNING_CURVE_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("fraction", T.DoubleType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("train_rmse", T.DoubleType()),
    T.StructField("test_rmse", T.DoubleType()),
    T.StructField("test_r2", T.DoubleType()),
])
IMPORTANCE_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("feature", T.StringType()),
    T.StructField("importance", T.DoubleType()),
])
COEFFICIENT_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("feature", T.StringType()),
    T.StructField("coefficient", T.DoubleType()),
    T.StructField("abs_coeff", T.DoubleType()),
    T.StructField("intercept", T.DoubleType()),
])
METRICS_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("test_rmse", T.DoubleType()),
    T.StructField("test_r2", T.DoubleType()),
    T.StructField("best_hyperparameters", T.StringType()),
])
