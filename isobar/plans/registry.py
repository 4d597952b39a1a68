"""Every operator as a query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar import schema as S
from isobar.functions import packed as P
from isobar.operators import (
    clean, features, linear, metrics, moments, quality, results, split, tuning,
)
from isobar.plans import preprocess, report, train
from isobar.session import scratch_path
from isobar.sources import artifacts, tables
from isobar.sources.artifacts import ArtifactStore
from isobar.sources.observations import observations

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TIE = "obs_id"
LEADERBOARD = {
    "ols_all": S.FEATURES_ALL, "ols_no_leak": S.FEATURES_NO_LEAK,
    "ols_weather": [c for c in S.FEATURES_NO_LEAK if c not in (*S.COORDINATES, "HOUR", "MONTH", "DAY_OF_YEAR")],
}
# Nodes of fewer rows are where several features cut the same rows apart and rounding decides
# between them; leaves of this size make the trees that SQL is asked for unique.
TIE_FREE = {"minInstancesPerNode": 20}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(c: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns})


def raw(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d)


def parsed(spark: SparkSession, d: str) -> DataFrame:
    return preprocess.parsed_observations(raw(spark, d), [TIE])


def model(spark: SparkSession, d: str) -> DataFrame:
    return preprocess.model_table(raw(spark, d), TIE)


def labelled(spark: SparkSession, d: str) -> DataFrame:
    return split.train_test_split(model(spark, d), S.MODEL_KEY)


def stored(spark: SparkSession, d: str) -> DataFrame:
    """The split table written once and read back, for queries that pass over it repeatedly."""
    path = scratch_path(spark, "split-table")
    preprocess.write_split_table(raw(spark, d), path, TIE)
    return tables.read_parquet(spark, path)


def lineitem(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return tables.read_parquet(spark, f"{d}/lineitem.parquet", columns)


# --- whole cleaning job ---------------------------------------------------------------

@query
def model_table(spark, d):
    return rounded(model(spark, d), "RH_PCT")


# --- parsing --------------------------------------------------------------------------

@query
def strip_whitespace(spark, d):
    spaced = raw(spark, d).select(
        TIE, F.concat(F.lit(" "), F.regexp_replace("WND", ",", " ,\t ")).alias("WND"),
        F.concat(F.col("STATION"), F.lit("\n")).alias("STATION"),
    )
    return clean.strip_whitespace(spaced, ["WND", "STATION"])


@query
def parse_wind(spark, d):
    wind = raw(spark, d).select(TIE, P.packed_wind("WND").alias("w"))
    return wind.select(
        TIE, F.col("w.dir").alias("WIND_DIR_READ"), F.col("w.speed").alias("WIND_SPEED"),
        P.impute_direction("w.dir", "w.speed").alias("WIND_DIR"),
    )


@query
def parse_numeric_fields(spark, d):
    return raw(spark, d).select(
        TIE, P.packed_numeric("TMP").alias("TMP_C"), P.packed_numeric("DEW").alias("DEW_C"),
        P.packed_numeric("SLP").alias("SLP_HPA"), P.packed_numeric("AA1").alias("PRECIP_MM"),
    )


@query
def parse_precip_depth(spark, d):
    return raw(spark, d).select(TIE, P.packed_numeric("AA1", index=1).alias("PRECIP_DEPTH_MM"))


@query
def parse_visibility(spark, d):
    return raw(spark, d).select(TIE, P.packed_visibility("VIS").alias("VIS_M"))


@query
def cast_coordinates(spark, d):
    return clean.cast_double(raw(spark, d).select(TIE, *S.COORDINATES), S.COORDINATES)


# --- cleaning -------------------------------------------------------------------------

@query
def select_existing(spark, d):
    kept, _ = clean.select_existing(
        raw(spark, d).drop("AA1"), [TIE, "STATION", "TMP", "AA1"], fill_missing=True
    )
    return kept


@query
def filter_required(spark, d):
    return clean.filter_required(raw(spark, d), ["AA1", "DATE"]).select(TIE, "AA1")


@query
def filter_any_present(spark, d):
    return clean.filter_any_present(parsed(spark, d), ["TMP_C", "DEW_C"]).select(TIE, "TMP_C", "DEW_C")


@query
def range_validate(spark, d):
    valid = clean.range_validate(parsed(spark, d))
    return rounded(valid.select(TIE, "STATION", "DATE", *S.MEASUREMENTS), "RH_PCT")


@query
def drop_nulls(spark, d):
    return rounded(clean.drop_nulls(parsed(spark, d).select(TIE, "WIND_DIR", "VIS_M", *S.MEASUREMENTS)), "RH_PCT")


@query
def fill_nulls(spark, d):
    return clean.fill_nulls(parsed(spark, d).select(TIE, "WIND_DIR", "VIS_M", "DEW_C", "TMP_C"))


@query
def dedupe_keyed(spark, d):
    valid = clean.range_validate(parsed(spark, d)).select(*S.KEY, TIE, "TMP_C")
    return clean.dedupe_keyed(valid, S.KEY, [TIE])


@query
def quality_funnel(spark, d):
    return quality.quality_funnel(raw(spark, d), TIE)


# --- features -------------------------------------------------------------------------

@query
def relative_humidity(spark, d):
    return parsed(spark, d).select(TIE, "TMP_C", "DEW_C", r6("RH_PCT").alias("RH_PCT"))


@query
def calendar_features(spark, d):
    return features.calendar_features(raw(spark, d).select(TIE, "DATE")).drop("DATE")


@query
def hourly_rows(spark, d):
    return features.hourly_rows(raw(spark, d).select(TIE, "DATE"))


@query
def feature_profile(spark, d):
    profile = quality.feature_profile(model(spark, d), [*S.FEATURES_ALL, S.LABEL])
    return rounded(profile, "min_value", "max_value")


@query
def feature_profile_lineitem(spark, d):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    return quality.feature_profile(lineitem(spark, d, *columns), columns)


# --- splits ---------------------------------------------------------------------------

@query
def train_test_split(spark, d):
    return labelled(spark, d).select(*S.MODEL_KEY, "split")


@query
def nested_fractions(spark, d):
    part = split.fraction_index(S.MODEL_KEY, linear.FRACTIONS)
    return model(spark, d).select(*S.MODEL_KEY, part.alias("part"))


@query
def kfold_assign(spark, d):
    return split.kfold_assign(model(spark, d).select(*S.MODEL_KEY), S.MODEL_KEY)


@query
def split_lineitem(spark, d):
    keys = ["l_orderkey", "l_linenumber"]
    items = split.kfold_assign(split.train_test_split(lineitem(spark, d, *keys, "l_quantity"), keys), keys)
    return items.groupBy("split", "fold").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("sum_quantity")
    )


# --- vector transforms ----------------------------------------------------------------

@query
def assemble_features(spark, d):
    vectors = features.assemble_features(model(spark, d), S.FEATURES_ALL).select(*S.MODEL_KEY, "features")
    return rounded(
        features.vector_to_columns(vectors, "features", S.FEATURES_ALL).drop("features"), "RH_PCT"
    )


@query
def standard_scale(spark, d):
    """Deviations observed while the split table is written; scaling projects what was written."""
    path = scratch_path(spark, "split-table")
    preprocess.write_split_table(raw(spark, d), path, TIE)
    table = tables.read_parquet(spark, path)
    scaled = features.scaled(table, S.FEATURES_ALL, preprocess.stored_deviations(spark, path)).select(*S.MODEL_KEY, "features")
    names = [f"{c}_SCALED" for c in S.FEATURES_ALL]
    return rounded(features.vector_to_columns(scaled, "features", names).drop("features"), *names)


@query
def vector_explode(spark, d):
    vectors = tables.read_parquet(spark, f"{d}/embeddings.parquet", ["vec_id", "embedding"]).select(
        "vec_id", array_to_vector("embedding").alias("vector")
    )
    return rounded(features.vector_explode(vectors, "vector", ["vec_id"]), "value")


# --- linear models --------------------------------------------------------------------

def one_feature_moments(df: DataFrame, feature: str, by: list[str], label: str = S.LABEL) -> tuple[dict, dict]:
    """The means that are subtracted, and the moments of every group."""
    shift = moments.column_means(df, [feature, label])
    rows = moments.moments_by(df, [feature, label], by, shift).collect()
    return shift, {tuple(r[b] for b in by): moments.from_row(r, 2) for r in rows}


def fitted_line(spark: SparkSession, df: DataFrame, feature: str, label: str = S.LABEL, digits: int = 6) -> DataFrame:
    """Least squares of one feature by the moment solver."""
    shift, cells = one_feature_moments(df, feature, [], label)
    m = cells[()]
    fit = linear.solve(m, [feature], shift, label=label)
    rows = [(int(m.n), float(fit.coefficients[0]), fit.intercept, linear.rmse(fit, m, shift), linear.r2(fit, m, shift))]
    table = results.small_table(spark, rows, "n_rows bigint, slope double, intercept double, rmse double, r2 double")
    return table.select("n_rows", r6("slope", digits).alias("slope"), "intercept", r6("rmse").alias("rmse"), r6("r2").alias("r2"))


@query
def ols_simple(spark, d):
    return rounded(fitted_line(spark, model(spark, d), "DEW_C"), "intercept")


@query
def ols_lineitem(spark, d):
    line = fitted_line(spark, lineitem(spark, d, "l_quantity", "l_extendedprice"), "l_quantity", "l_extendedprice")
    return line.select("n_rows", "slope", r6("intercept", 4).alias("intercept"))


@query
def ols_epoch(spark, d):
    """A feature whose mean is a thousand times its spread: seconds since 1970."""
    events = tables.read_parquet(spark, f"{d}/events.parquet", ["ts", "value"])
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")).cast("double")
    line = fitted_line(spark, events.select(seconds.alias("seconds"), "value"), "seconds", "value", 12)
    return line.select("n_rows", "slope", "rmse", "r2")


@query
def ols_offset(spark, d):
    """The same line as on the quantity alone; only the intercept moves."""
    items = lineitem(spark, d, "l_quantity", "l_extendedprice")
    moved = items.select((F.col("l_quantity") + F.lit(1.7e9)).alias("far"), "l_extendedprice")
    return fitted_line(spark, moved, "far", "l_extendedprice").select("n_rows", "slope", "rmse", "r2")


@query
def ridge_simple(spark, d):
    shift, cells = one_feature_moments(model(spark, d), "DEW_C", [])
    rows = []
    for reg in (0.01, 0.1, 5.0):
        fit = linear.solve(cells[()], ["DEW_C"], shift, reg)
        rows.append((reg, float(fit.coefficients[0]), fit.intercept))
    return rounded(
        results.small_table(spark, rows, "reg_param double, slope double, intercept double"), "slope", "intercept"
    )


@query
def cv_ols(spark, d):
    shift, cells = one_feature_moments(split.kfold_assign(model(spark, d), S.MODEL_KEY), "DEW_C", ["fold"])
    rows = []
    for (fold,), held in cells.items():
        rest = moments.total(m for (other,), m in cells.items() if other != fold)
        fit = linear.solve(rest, ["DEW_C"], shift)
        rows.append((fold, int(rest.n), float(fit.coefficients[0]), fit.intercept, linear.rmse(fit, held, shift)))
    df = results.small_table(spark, rows, "fold int, n_train bigint, slope double, intercept double, rmse double")
    return rounded(df, "slope", "intercept", "rmse")


@query
def gram_by_fold(spark, d):
    columns = ["DEW_C", "WIND_SPEED", "TMP_C"]
    gram = moments.moments_by(
        split.kfold_assign(model(spark, d), S.MODEL_KEY), columns, ["fold"], {"WIND_SPEED": 10.0}
    )
    sums = [c for c in gram.columns if c[:2] in ("s_", "p_")]
    return rounded(gram, *sums).select("fold", "n", *sums)


def curve_rounded(df: DataFrame) -> DataFrame:
    return rounded(df, "train_rmse", "test_rmse", "test_r2")


@query
def learning_curve_ols(spark, d):
    study = linear.tune_linear(labelled(spark, d), S.MODEL_KEY, ["DEW_C"], grid={"regParam": [0.0], "elasticNetParam": [0.0]})
    return curve_rounded(results.learning_curve_table(spark, study.curve_rows))


@query
def learning_curve_lr(spark, d):
    study = linear.tune_linear(labelled(spark, d), S.MODEL_KEY, S.FEATURES_ALL, grid={"regParam": [0.0], "elasticNetParam": [0.0]})
    return curve_rounded(results.learning_curve_table(spark, study.curve_rows))


@query
def cv_lr(spark, d):
    """Average held-out error of plain least squares on all features, and without the leak."""
    table, rows = stored(spark, d), []
    for name, feats in (("all", S.FEATURES_ALL), ("no_leak", S.FEATURES_NO_LEAK)):
        study = linear.tune_linear(
            table, S.MODEL_KEY, feats, name=name, grid={"regParam": [0.0], "elasticNetParam": [0.0]}
        )
        rows.append((name, study.cv_rows[0][3], study.test_rmse, study.test_r2))
    df = results.small_table(spark, rows, "features string, avg_rmse double, test_rmse double, test_r2 double")
    return rounded(df, "avg_rmse", "test_rmse", "test_r2")


def weights(spark: SparkSession, d: str) -> DataFrame:
    """Of all features, the constant and collinear ones of the station grid included: the smallest weights.

    Rounded before they are ranked: collinear columns share their weight, to the last digits.
    """
    table = linear.coefficient_table(spark, linear.least_squares(stored(spark, d), S.FEATURES_ALL), "ols")
    return rounded(table, "coefficient", "abs_coeff", "intercept")


@query
def lr_coefficients(spark, d):
    return weights(spark, d)


@query
def top_features(spark, d):
    return results.top_features(weights(spark, d), "abs_coeff").select("model", "rank", "feature", "abs_coeff")


@query
def lr_tuned(spark, d):
    """The default grid on all features, with the test scores of the best setting."""
    study = linear.tune_linear(labelled(spark, d), S.MODEL_KEY, S.FEATURES_ALL)
    cv = numeric_params(results.cv_table(spark, study.cv_rows))
    return cv.withColumns({"test_rmse": r6(F.lit(study.test_rmse)), "test_r2": r6(F.lit(study.test_r2))})


# --- scoring --------------------------------------------------------------------------

def scored_ols(spark: SparkSession, d: str, feature: str = "DEW_C") -> DataFrame:
    table = stored(spark, d)
    shift, cells = one_feature_moments(table.filter(F.col("split") == "train"), feature, [])
    fit = linear.solve(cells[()], [feature], shift)
    return fit.transform(features.rename_label(table))


@query
def pred_vs_actual(spark, d):
    test = scored_ols(spark, d).filter(F.col("split") == "test")
    return rounded(metrics.predicted_vs_actual(test, S.MODEL_KEY), "Predicted_Temperature_C")


@query
def prediction_metrics(spark, d):
    scores = metrics.prediction_metrics(scored_ols(spark, d), ["split"])
    return rounded(scores, "rmse", "mae", "r2", "low", "high")


@query
def resolve_prediction_columns(spark, d):
    odd = scored_ols(spark, d).withColumnsRenamed({"prediction": "Y_Pred", "label": "Actual"})
    return rounded(metrics.resolve_prediction_columns(odd), "prediction")


@query
def pred_sample(spark, d):
    test = scored_ols(spark, d).filter(F.col("split") == "test")
    chosen = split.sample_fraction(test, S.MODEL_KEY, train.SAMPLE_FRACTION, "plot")
    return rounded(metrics.predicted_vs_actual(chosen, S.MODEL_KEY), "Predicted_Temperature_C")


@query
def capped_sample_lineitem(spark, d):
    columns = ["l_returnflag", "l_orderkey", "l_linenumber", "l_quantity"]
    return split.capped_sample(
        lineitem(spark, d, *columns), ["l_orderkey", "l_linenumber"], 0.1, 500, ["l_returnflag"]
    )


# --- trees ----------------------------------------------------------------------------

def hour_table(spark: SparkSession, d: str) -> DataFrame:
    return features.assemble_features(features.rename_label(stored(spark, d)), ["HOUR"])


def by_hour(fitted, table: DataFrame) -> DataFrame:
    scored = fitted.transform(table).groupBy("HOUR").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("prediction").alias("prediction")
    )
    return rounded(scored, "prediction")


@query
def dt_stump(spark, d):
    table = hour_table(spark, d)
    return by_hour(DecisionTreeRegressor(maxDepth=1, maxBins=32, seed=tuning.SEED, labelCol="label").fit(table), table)


@query
def rf_single_tree(spark, d):
    table = hour_table(spark, d)
    forest = RandomForestRegressor(
        numTrees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all", seed=tuning.SEED, labelCol="label"
    )
    return by_hour(forest.fit(table), table)


@query
def gbt_two_rounds(spark, d):
    table = hour_table(spark, d)
    return by_hour(GBTRegressor(maxIter=2, maxDepth=1, seed=tuning.SEED, labelCol="label").fit(table), table)


def tree_study(spark: SparkSession, d: str, family: str, **options) -> tuning.FitStudy:
    return tuning.tune_by_fits(labelled(spark, d), S.MODEL_KEY, family, S.FEATURES_ALL, **options)


def tuned(spark: SparkSession, d: str, family: str, **options) -> DataFrame:
    study = tree_study(spark, d, family, **options)
    names = list(tuning.GRIDS[family])
    cv = results.cv_table_wide(results.cv_table(spark, study.cv_rows), names)
    return cv.select(
        "model", "grid_idx", *[F.col(n).cast("int").alias(n) for n in names], r6("avg_rmse").alias("avg_rmse"),
        r6(F.lit(study.test_rmse)).alias("test_rmse"), r6(F.lit(study.test_r2)).alias("test_r2"),
    )


@query
def dt_tuned(spark, d):
    return tuned(spark, d, "dt")


@query
def rf_tuned(spark, d):
    return tuned(spark, d, "rf")


@query
def gbt_tuned(spark, d):
    return tuned(spark, d, "gbt")


def single_setting(spark: SparkSession, d: str, family: str, params: dict, **options) -> tuning.FitStudy:
    return tuning.tune_by_fits(
        labelled(spark, d), S.MODEL_KEY, family, S.FEATURES_ALL,
        grid={k: [v] for k, v in params.items()}, **options,
    )


@query
def feature_importance(spark, d):
    """Of the tree with the setting that the default grid chose."""
    study = tree_study(spark, d, "dt", options=TIE_FREE)
    return rounded(tuning.importance_table(spark, study), "importance").orderBy(F.desc("importance"))


@query
def learning_curve_tree(spark, d):
    """At the setting that the default grid chose."""
    study = tree_study(spark, d, "dt", options=TIE_FREE)
    return curve_rounded(results.learning_curve_table(spark, study.curve_rows))


# Grids that SQL can follow on all features.
FOREST_GRID = {"maxDepth": [3, 5], "numTrees": [4, 8]}
BOOST_GRID = {"maxDepth": [2, 3], "maxIter": [1, 2]}


@query
def rf_hashed(spark, d):
    """A forest whose bootstrap and feature draws are hashes, so that it is the same everywhere."""
    return tuned(spark, d, "hf", grid=FOREST_GRID, options=TIE_FREE)


@query
def gbt_shallow(spark, d):
    """Boosting on all features: the second round fits the residuals of the first."""
    return tuned(spark, d, "gbt", grid=BOOST_GRID, options=TIE_FREE)


# --- tuning of trees that SQL can follow: one split of the hour --------------------------

STUMPS = {"dt": {"maxDepth": [1], "maxBins": [28, 32]}, "gbt": {"maxDepth": [1], "maxIter": [1, 2]}}


def stump_study(spark: SparkSession, d: str, family: str, **options) -> tuning.FitStudy:
    return tuning.tune_by_fits(
        labelled(spark, d), S.MODEL_KEY, family, ["HOUR"], grid=STUMPS[family], **options
    )


def stump_scores(spark: SparkSession, d: str, family: str) -> DataFrame:
    study = stump_study(spark, d, family, fractions=[1.0])
    cv = results.cv_table(spark, study.cv_rows).select("grid_idx", r6("avg_rmse").alias("avg_rmse"))
    return cv.withColumns({"test_rmse": r6(F.lit(study.test_rmse)), "test_r2": r6(F.lit(study.test_r2))})


@query
def cv_dt_stump(spark, d):
    return stump_scores(spark, d, "dt")


@query
def cv_gbt_stump(spark, d):
    return stump_scores(spark, d, "gbt")


@query
def learning_curve_stump(spark, d):
    return curve_rounded(results.learning_curve_table(spark, stump_study(spark, d, "dt").curve_rows))


# Few enough levels that no two features cut a node into the same rows.
SHALLOW = {"maxDepth": [2, 3], "maxBins": [32, 64]}


@query
def cv_dt_shallow(spark, d):
    study = tuning.tune_by_fits(
        labelled(spark, d), S.MODEL_KEY, "dt", S.FEATURES_ALL, grid=SHALLOW, fractions=[1.0]
    )
    cv = results.cv_table_wide(results.cv_table(spark, study.cv_rows), list(SHALLOW))
    return cv.select(
        "grid_idx", F.col("maxDepth").cast("int").alias("maxDepth"), F.col("maxBins").cast("int").alias("maxBins"),
        r6("avg_rmse").alias("avg_rmse"), r6(F.lit(study.test_rmse)).alias("test_rmse"),
        r6(F.lit(study.test_r2)).alias("test_r2"),
    )


@query
def feature_importance_shallow(spark, d):
    study = single_setting(spark, d, "dt", {"maxDepth": 3, "maxBins": 64}, fractions=[1.0])
    return rounded(tuning.importance_table(spark, study), "importance")


@query
def learning_curve_shallow(spark, d):
    study = single_setting(spark, d, "dt", {"maxDepth": 2, "maxBins": 32})
    return curve_rounded(results.learning_curve_table(spark, study.curve_rows))


# --- result tables --------------------------------------------------------------------

def tuned_grid(spark: SparkSession, d: str) -> DataFrame:
    """The default linear grid on all features."""
    study = linear.tune_linear(labelled(spark, d), S.MODEL_KEY, S.FEATURES_ALL)
    return results.cv_table(spark, study.cv_rows)


def numeric_params(df: DataFrame) -> DataFrame:
    return df.select(
        "model", "grid_idx", F.col("params")["regParam"].cast("double").alias("regParam"),
        F.col("params")["elasticNetParam"].cast("double").alias("elasticNetParam"),
        r6("avg_rmse").alias("avg_rmse"),
    )


@query
def cv_table(spark, d):
    return numeric_params(tuned_grid(spark, d))


@query
def best_params(spark, d):
    return numeric_params(results.best_params(tuned_grid(spark, d)))


@query
def validation_curve(spark, d):
    return rounded(results.validation_curve(tuned_grid(spark, d)), "avg_rmse")


@query
def learning_curve_union(spark, d):
    grid = {"regParam": [0.0], "elasticNetParam": [0.0]}
    table = stored(spark, d)
    dew = linear.tune_linear(table, S.MODEL_KEY, ["DEW_C"], grid=grid)
    wind = linear.tune_linear(table, S.MODEL_KEY, ["WIND_SPEED"], grid=grid)
    # The two spellings found in stored curves.
    short = results.learning_curve_table(spark, dew.curve_rows).select(
        "fraction", "n_rows", F.col("test_rmse").alias("rmse"), F.col("test_r2").alias("r2")
    )
    long = results.learning_curve_table(spark, wind.curve_rows).select(
        F.col("fraction").alias("train_size_fraction"), F.col("n_rows").alias("train_count"),
        "train_rmse", "test_rmse",
    )
    return curve_rounded(results.union_curves({"dew": short, "wind": long}))


@query
def leaderboard(spark, d):
    """Least squares on three sets of features, from one moment pass and compared in one scoring pass."""
    table = stored(spark, d)
    columns = [*S.FEATURES_ALL, S.LABEL]
    fitted = table.filter(F.col("split") == "train")
    shift = moments.column_means(fitted, columns)
    [row] = moments.moments_by(fitted, columns, [], shift).collect()
    everything = moments.from_row(row, len(columns))
    predictions = {
        name: linear.solve(everything.take([columns.index(c) for c in [*feats, S.LABEL]]), feats, shift).prediction()
        for name, feats in LEADERBOARD.items()
    }
    test = features.rename_label(table.filter(F.col("split") == "test"))
    scores = metrics.long_scores(test, predictions, S.MODEL_KEY)
    in_sample = split.in_sample(S.MODEL_KEY, train.SAMPLE_FRACTION, "plot")
    board = results.leaderboard(metrics.exact_and_sample(scores, in_sample))
    return rounded(board, "test_rmse", "test_r2", "sample_rmse", "sample_r2")


# --- stored artifacts -----------------------------------------------------------------

def trained_store(spark: SparkSession, d: str, families: tuple[str, ...] = ("lr", "dt")) -> ArtifactStore:
    """The whole job on all features: clean, write the split table, tune by default grids, store."""
    store, table = ArtifactStore(spark, scratch_path(spark, "artifacts")), stored(spark, d)
    for family in families:
        train.train_family(table, store, family, options=None if family == "lr" else TIE_FREE, run_id="run-1")
    return store


def board_rounded(df: DataFrame) -> DataFrame:
    return rounded(df, "test_rmse", "test_r2", "sample_rmse", "sample_r2")


@query
def artifact_metrics(spark, d):
    got = trained_store(spark, d).read(artifacts.METRICS)
    param = lambda name: F.get_json_object("best_hyperparameters", f"$.{name}").cast("double").alias(name)
    return got.select(
        "model_name", r6("test_rmse").alias("test_rmse"), r6("test_r2").alias("test_r2"),
        *[param(name) for name in ("regParam", "elasticNetParam", "maxDepth", "maxBins")],
    )


@query
def artifact_tables(spark, d):
    return curve_rounded(trained_store(spark, d).read(artifacts.CURVE))


@query
def artifact_catalogue(spark, d):
    return trained_store(spark, d).catalogue().select("model", "kind", "n_rows")


def four_families(spark: SparkSession, d: str) -> ArtifactStore:
    """The whole job: clean, split, tune and store all families on all features."""
    store, table = ArtifactStore(spark, scratch_path(spark, "families")), stored(spark, d)
    for family in tuning.FAMILIES:
        train.train_family(table, store, family)
    return store


@query
def report_four_families(spark, d):
    return board_rounded(report.leaderboard_from(four_families(spark, d)))


@query
def tidy_export(spark, d):
    """The exported report read back: grids, curves, prediction samples and the leaderboard as (kind, model, item, value)."""
    out = scratch_path(spark, "tidy")
    report.export_tidy(trained_store(spark, d), out)

    def back(kind: str) -> DataFrame:
        return spark.read.option("header", True).csv(f"{out}/{kind}")

    number = lambda c: F.col(c).cast("double")
    pairs = back(f"tables/{artifacts.PLOT}").groupBy("model").agg(
        F.count(F.lit(1)).alias("item"), F.avg(number("Predicted_Temperature_C")).alias("value"))
    parts = [
        back(f"tables/{artifacts.CV}").select(F.lit("cv"), "model", number("grid_idx"), number("avg_rmse")),
        back(f"tables/{artifacts.CURVE}").select(F.lit("curve"), "model", number("fraction"), number("test_rmse")),
        pairs.select(F.lit("sample"), "model", number("item"), "value"),
        back("leaderboard").select(F.lit("board"), "model", number("rank"), number("test_rmse")),
    ]
    return rounded(reduce(DataFrame.union, parts).toDF("kind", "model", "item", "value"), "value")


@query
def report_leaderboard(spark, d):
    return board_rounded(report.leaderboard_from(trained_store(spark, d)))


@query
def report_four_checked(spark, d):
    """All four kinds of models on all features, tuned over grids that SQL can follow."""
    store, table = ArtifactStore(spark, scratch_path(spark, "families")), stored(spark, d)
    for family, grid in (("lr", None), ("dt", None), (tuning.HASHED, FOREST_GRID), ("gbt", BOOST_GRID)):
        train.train_family(table, store, family, grid=grid, options=None if family == "lr" else TIE_FREE)
    return board_rounded(report.leaderboard_from(store))


# --- sources and sinks ----------------------------------------------------------------

@query
def src_csv_roundtrip(spark, d):
    path = scratch_path(spark, "csv")
    tables.write_csv(raw(spark, d).select(*S.RAW_COLUMNS), path)
    return tables.read_raw_csv(spark, path)


@query
def src_csv_mixed_headers(spark, d):
    """Three folders: all columns, the same in another order, and without AA1 where it is missing."""
    path, rows = scratch_path(spark, "mixed"), raw(spark, d).select(TIE, *S.RAW_COLUMNS)
    lacking, odd = F.col("AA1").isNull(), F.col(TIE) % 2 == 1
    tables.write_csv(rows.filter(~lacking & odd).select(*S.RAW_COLUMNS), f"{path}/a")
    tables.write_csv(rows.filter(~lacking & ~odd).select(*sorted(S.RAW_COLUMNS)), f"{path}/b")
    tables.write_csv(rows.filter(lacking).select(*[c for c in S.RAW_COLUMNS if c != "AA1"]), f"{path}/c")
    return tables.read_raw_csv(spark, [f"{path}/{k}" for k in "abc"])


@query
def sink_parquet_roundtrip(spark, d):
    path = scratch_path(spark, "parquet")
    preprocess.write_split_table(raw(spark, d), path, TIE)
    return tables.read_parquet(spark, path, [*S.MODEL_KEY, "TMP_C", "DEW_C", "split"])


@query
def metrics_json_roundtrip(spark, d):
    path = scratch_path(spark, "json")
    scores = metrics.prediction_metrics(scored_ols(spark, d).filter(F.col("split") == "test"), min_rows=1)
    record = results.metrics_record(rounded(scores, "rmse", "r2"), "ols", {"regParam": 0.0})
    tables.write_json(record, f"{path}/ols.json")
    return tables.read_json_under(spark, path, S.METRICS_SCHEMA).drop("path")


@query
def model_save_load(spark, d):
    path = scratch_path(spark, "model")
    table = stored(spark, d)
    plain = {"regParam": [0.0], "elasticNetParam": [0.0]}
    study = linear.tune_linear(table, S.MODEL_KEY, ["DEW_C"], grid=plain)
    tables.save_model(study.fit.pipeline(), path)
    loaded = tables.load_model(path)
    test = table.filter(F.col("split") == "test")
    return loaded.transform(test).select(*S.MODEL_KEY, r6("prediction").alias("prediction"))
