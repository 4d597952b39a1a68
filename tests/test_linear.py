import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from isobar import schema as S
from isobar.operators import features, linear, metrics, moments, split, tuning
from isobar.operators.tuning import expand_grid


@pytest.fixture(scope="module")
def study(table):
    return linear.tune_linear(table, S.MODEL_KEY, S.FEATURES_ALL)


@pytest.fixture(scope="module")
def vectors(table):
    keyed = split.kfold_assign(table, S.MODEL_KEY).withColumn("label", F.col("TMP_C"))
    out = features.assemble_features(keyed, S.FEATURES_ALL).select("split", "fold", "label", "features").persist()
    yield out
    out.unpersist()


def test_grid_matches_mllib(study, vectors):
    """Every setting of the default grid against 27 separate fits."""
    evaluator = RegressionEvaluator(labelCol="label")
    train = vectors.filter("split = 'train'")
    for (_, idx, params, got) in study.cv_rows:
        lr = LinearRegression(
            regParam=float(params["regParam"]), elasticNetParam=float(params["elasticNetParam"]),
            featuresCol="features", labelCol="label",
        )
        scores = [
            evaluator.evaluate(lr.fit(train.filter(f"fold <> {i}")).transform(train.filter(f"fold = {i}")))
            for i in range(3)
        ]
        assert got == pytest.approx(np.mean(scores), rel=1e-5), params


def test_wide_path_agrees_with_the_moment_path(table, study):
    features_ = S.FEATURES_ALL
    fitted = tuning.tune_by_fits(
        table, S.MODEL_KEY, "lr", features_, grid={"regParam": [0.0, 0.1], "elasticNetParam": [0.0]},
        fractions=[1.0], scale=True,
    )
    mine = {(p["regParam"], p["elasticNetParam"]): v for _, _, p, v in study.cv_rows}
    for _, _, p, v in fitted.cv_rows:
        assert v == pytest.approx(mine[p["regParam"], p["elasticNetParam"]], rel=1e-5)


def test_more_columns_than_any_limit(spark):
    """Seventy features, the last one the label itself."""
    rng = np.random.default_rng(0)
    data = rng.normal(size=(400, 70))
    rows = [(str(i), "train" if i % 3 else "test", *map(float, r), float(r[-1])) for i, r in enumerate(data)]
    names = [f"f{i}" for i in range(70)]
    df = spark.createDataFrame(rows, "k string, split string, " + ", ".join(f"{n} double" for n in [*names, "y"]))
    study = linear.tune_linear(df, ["k"], names, "y", grid={"regParam": [0.0], "elasticNetParam": [0.0]}, fractions=[1.0])
    assert study.test_rmse < 1e-9 and study.test_r2 <= 1.0
    assert study.fit.coefficients[-1] == pytest.approx(1.0)


@pytest.mark.parametrize("mean", [0.0, 1e7, 1.7e9])
@pytest.mark.parametrize("alpha", [0.0, 1.0])
def test_large_means_keep_their_digits(spark, mean, alpha):
    rows = [(str(i), "train" if i % 4 else "test", mean + i, 0.5 * i + 3.0) for i in range(1000)]
    df = spark.createDataFrame(rows, "k string, split string, x double, y double")
    study = linear.tune_linear(df, ["k"], ["x"], "y", grid={"regParam": [0.0 if alpha == 0 else 1e-6], "elasticNetParam": [alpha]})
    assert study.fit.coefficients[0] == pytest.approx(0.5, rel=1e-5)
    assert study.test_rmse < 1e-3 and study.test_r2 <= 1.0
    loaded = study.fit.pipeline().transform(df).filter("split = 'test'")
    assert loaded.filter("abs(prediction - y) > 1e-3").count() == 0


def test_test_scores_match_evaluator(study, table):
    scored = study.fit.transform(table.filter("split = 'test'").withColumn("label", F.col("TMP_C")))
    assert study.test_rmse == pytest.approx(RegressionEvaluator(metricName="rmse").evaluate(scored), rel=1e-9)
    assert study.test_r2 == pytest.approx(RegressionEvaluator(metricName="r2").evaluate(scored), rel=1e-9)


def test_curve_ends_at_the_tuned_score(study):
    last = study.curve_rows[-1]
    assert last[1] == 1.0 and last[4] == study.test_rmse and last[5] == study.test_r2
    counts = [r[2] for r in study.curve_rows]
    assert counts == sorted(counts)


def test_unpenalised_rows_are_equal_and_the_first_wins(table):
    study = linear.tune_linear(table, S.MODEL_KEY, ["DEW_C"], grid={"regParam": [0.0], "elasticNetParam": [0.0, 0.5, 1.0]})
    assert len({r[3] for r in study.cv_rows}) == 1
    assert study.best == {"regParam": 0.0, "elasticNetParam": 0.0}


def test_shift_changes_nothing(table):
    plain = linear.tune_linear(table, S.MODEL_KEY, S.FEATURES_ALL, shift={})
    moved = linear.tune_linear(table, S.MODEL_KEY, S.FEATURES_ALL)
    for a, b in zip(plain.cv_rows, moved.cv_rows):
        assert a[3] == pytest.approx(b[3], rel=1e-6)


def test_partitioning_changes_nothing(table, study):
    other = linear.tune_linear(table.repartition(13), S.MODEL_KEY, S.FEATURES_ALL)
    assert [r[2] for r in other.curve_rows] == [r[2] for r in study.curve_rows]
    assert other.test_rmse == pytest.approx(study.test_rmse, rel=1e-9)


def test_moments_add_up(table):
    rows = moments.moments_by(table, ["DEW_C", "TMP_C"], ["split"]).collect()
    parts = [moments.from_row(r, 2) for r in rows]
    [whole] = moments.moments_by(table, ["DEW_C", "TMP_C"], []).collect()
    joined = moments.total(parts)
    expected = moments.from_row(whole, 2)
    assert joined.n == expected.n and np.allclose(joined.products, expected.products)
    assert (joined.low == expected.low).all() and (joined.high == expected.high).all()


def test_constant_label_and_constant_feature(spark):
    df = spark.createDataFrame([("a", float(i), 1.0, 5.0) for i in range(20)], "k string, x double, c double, TMP_C double")
    [row] = moments.moments_by(df, ["x", "c", "TMP_C"], []).collect()
    m = moments.from_row(row, 3)
    fit = linear.solve(m, ["x", "c"], {})
    assert list(fit.coefficients) == [0.0, 0.0] and fit.intercept == pytest.approx(5.0)
    assert linear.r2(fit, m, {}) is None


def test_coefficients_in_scaled_space(table):
    fit = linear.tune_linear(table, S.MODEL_KEY, ["DEW_C", "WIND_SPEED"], grid={"regParam": [0.0], "elasticNetParam": [0.0]}).fit
    rows = linear.coefficient_rows(fit, "m")
    assert [r[3] for r in rows] == sorted((r[3] for r in rows), reverse=True)
    train = table.filter("split = 'train'").withColumn("label", F.col("TMP_C"))
    scaled = features.standard_scale(train, ["DEW_C", "WIND_SPEED"])
    mllib = LinearRegression(featuresCol="features", labelCol="label").fit(scaled)
    assert {r[1]: pytest.approx(r[2], rel=1e-6) for r in rows} == dict(zip(["DEW_C", "WIND_SPEED"], mllib.coefficients))


def test_metrics_match_evaluator_and_guard(spark, table):
    scored = table.select("split", F.col("TMP_C").alias("label"), F.col("DEW_C").alias("prediction"))
    got = {r["split"]: r for r in metrics.prediction_metrics(scored, ["split"]).collect()}
    for name in ("train", "test"):
        part = scored.filter(F.col("split") == name)
        for metric in ("rmse", "r2", "mae"):
            assert got[name][metric] == pytest.approx(RegressionEvaluator(metricName=metric).evaluate(part), rel=1e-9)
    few = spark.createDataFrame([(1.0, 1.0)] * 9 + [(None, 1.0)], "label double, prediction double")
    row = metrics.prediction_metrics(few).first()
    assert row["n_rows"] == 9 and row["rmse"] is None and row["r2"] is None
    flat = spark.createDataFrame([(1.0, 2.0)] * 10, "label double, prediction double")
    assert metrics.prediction_metrics(flat).first()["r2"] is None


def test_resolve_prediction_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "Y_TRUE double, Predicted_Temperature_C double")
    assert metrics.resolve_prediction_columns(df).columns == ["label", "prediction"]
    assert metrics.resolve_prediction_columns(df.drop("Y_TRUE")) is None
    with pytest.raises(ValueError, match="more than one"):
        metrics.resolve_prediction_columns(df.withColumn("actual", F.lit(1.0)))


def test_expand_grid_order():
    assert expand_grid({"a": [1, 2], "b": [3, 4]}) == [
        {"a": 1, "b": 3}, {"a": 1, "b": 4}, {"a": 2, "b": 3}, {"a": 2, "b": 4},
    ]
