import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from isobar import schema as S
from isobar.operators import features, split, tuning
from isobar.plans import train
from isobar.session import scratch_path
from isobar.sources import artifacts, tables
from isobar.sources.artifacts import ArtifactStore

FEATURES = ["HOUR", "DEW_C", "RH_PCT", "WIND_SPEED"]


@pytest.fixture(scope="module")
def keyed(table):
    out = split.kfold_assign(table, S.MODEL_KEY).withColumn("label", F.col("TMP_C")).persist()
    yield out
    out.unpersist()


@pytest.fixture(scope="module")
def tree(table):
    return tuning.tune_by_fits(table, S.MODEL_KEY, "dt", FEATURES, grid={"maxDepth": [2, 4], "maxBins": [16, 32]})


def test_tree_grid_matches_mllib_cross_validator(tree, keyed):
    dt = tuning.estimator("dt", {})
    grid = ParamGridBuilder().addGrid(dt.maxDepth, [2, 4]).addGrid(dt.maxBins, [16, 32]).build()
    cv = CrossValidator(
        estimator=Pipeline(stages=[features.assembler(FEATURES), dt]), estimatorParamMaps=grid,
        evaluator=RegressionEvaluator(), numFolds=3, foldCol="fold",
    )
    want = cv.fit(keyed.filter("split = 'train'"))
    by_setting = {(str(p[dt.maxDepth]), str(p[dt.maxBins])): m
                  for p, m in zip(want.getEstimatorParamMaps(), want.avgMetrics)}
    for (_, _, params, got) in tree.cv_rows:
        assert got == pytest.approx(by_setting[params["maxDepth"], params["maxBins"]], rel=1e-9)
    test = keyed.filter("split = 'test'")
    assert tree.test_rmse == pytest.approx(RegressionEvaluator().evaluate(want.transform(test)), rel=1e-9)


def test_best_setting_is_recorded_for_trees(tree):
    assert set(tree.best) == {"maxDepth", "maxBins"} and tree.best["maxDepth"] == 4


def test_curve_ends_at_the_tuned_score(tree):
    assert tree.curve_rows[-1][4] == tree.test_rmse
    counts = [r[2] for r in tree.curve_rows]
    assert counts == sorted(counts) and len(counts) == 5


def test_importances_sum_to_one_in_order(tree):
    rows = tuning.importance_rows(tree)
    assert sum(r[2] for r in rows) == pytest.approx(1.0)
    assert [r[2] for r in rows] == sorted((r[2] for r in rows), reverse=True)


def test_boosting_prefix_equals_separate_fits(keyed):
    rows = features.assemble_features(keyed.filter("split = 'train'"), FEATURES).select("fold", "label", "features")
    train, held = rows.filter("fold <> 0").persist(), rows.filter("fold = 0").persist()
    settings = [{"maxDepth": d, "maxIter": n} for d in (1, 2) for n in (2, 4)]
    groups = tuning.fit_groups("gbt", settings)
    assert groups == [[0, 1], [2, 3]]
    got = {i: g for members in groups for i, g in tuning.group_scores("gbt", settings, members, train, held).items()}
    for i, s in enumerate(settings):
        g, model = got[i], tuning.estimator("gbt", s).fit(train)
        assert g == pytest.approx(RegressionEvaluator().evaluate(model.transform(held)), rel=1e-9), s


def test_forest_scores_match_separate_evaluation(keyed):
    rows = features.assemble_features(keyed.filter("split = 'train'"), FEATURES).select("fold", "label", "features")
    train, held = rows.filter("fold <> 1").persist(), rows.filter("fold = 1").persist()
    settings = [{"maxDepth": 2, "numTrees": 3}, {"maxDepth": 3, "numTrees": 2}]
    got = tuning.group_scores("rf", settings, [0, 1], train, held)
    for i, s in enumerate(settings):
        g, model = got[i], tuning.estimator("rf", s).fit(train)
        assert g == pytest.approx(RegressionEvaluator().evaluate(model.transform(held)), rel=1e-9)


def test_scaling_does_not_change_a_tree(table):
    grid = {"maxDepth": [3], "maxBins": [32]}
    plain = tuning.tune_by_fits(table, S.MODEL_KEY, "dt", FEATURES, grid=grid, fractions=[1.0])
    scaled = tuning.tune_by_fits(table, S.MODEL_KEY, "dt", FEATURES, grid=grid, fractions=[1.0], scale=True)
    assert plain.test_rmse == pytest.approx(scaled.test_rmse, rel=1e-9)
    assert len(scaled.model.stages) == 3


def test_family_options_reach_the_study(table, spark):
    """Curve fractions, folds, scaler and pool size of a stored tree."""
    store = ArtifactStore(spark, scratch_path(spark, "options"))
    study = train.train_family(
        table, store, "dt", features=FEATURES, grid={"maxDepth": [3], "maxBins": [32]}, folds=2,
        fractions=[0.1, 0.2, 0.4, 0.6, 0.8, 1.0], scale=True, parallelism=2,
    )
    curve = store.read(artifacts.CURVE).orderBy("fraction").collect()
    assert [r["fraction"] for r in curve] == [0.1, 0.2, 0.4, 0.6, 0.8, 1.0]
    loaded = tables.load_model(store.path("DecisionTree_Tuned", artifacts.MODEL))
    assert [type(s).__name__ for s in loaded.stages][1] == "StandardScalerModel" and len(study.model.stages) == 3


def test_earliest_of_equal_scores_wins():
    assert tuning.best_setting([{"a": 1}, {"a": 2}, {"a": 3}], [2.0, 1.0, 1.0]) == {"a": 2}


def laid_out(df):
    """Rows by partition, in their order."""
    return [[tuple(r) for r in part] for part in df.rdd.glom().collect()]


def test_fits_get_as_many_partitions_as_their_rows_need(table, monkeypatch):
    seen, scores = [], tuning.group_scores

    def watched(family, settings, members, train, held, options=None):
        seen.append(train.rdd.getNumPartitions())
        return scores(family, settings, members, train, held, options)

    monkeypatch.setattr(tuning, "group_scores", watched)
    grid, spread = {"maxDepth": [1, 2], "maxIter": [1]}, table.repartition(40)
    study = tuning.tune_by_fits(spread, S.MODEL_KEY, "gbt", FEATURES, grid=grid, fractions=[0.5, 1.0])
    assert seen and set(seen) == {1}
    again = tuning.tune_by_fits(table, S.MODEL_KEY, "gbt", FEATURES, grid=grid, fractions=[0.5, 1.0])
    assert [r[3] for r in study.cv_rows] == pytest.approx([r[3] for r in again.cv_rows], rel=1e-9)
    assert study.curve_rows[0][2] == again.curve_rows[0][2] and study.test_rmse == pytest.approx(again.test_rmse, rel=1e-9)


def test_forest_gets_few_partitions_and_small_tables_keep_theirs(table, monkeypatch):
    seen, scores = [], tuning.group_scores

    def watched(family, settings, members, train, held, options=None):
        seen.append(train.rdd.getNumPartitions())
        return scores(family, settings, members, train, held, options)

    monkeypatch.setattr(tuning, "group_scores", watched)
    for given in (40, 5):
        tuning.tune_by_fits(
            table.repartition(given), S.MODEL_KEY, "rf", FEATURES, grid={"maxDepth": [1, 2], "numTrees": [2]}, fractions=[1.0])
    assert set(seen[:6]) == {tuning.OWN_LAYOUT} and set(seen[6:]) == {5}


def test_forest_draws_the_rows_that_it_would_draw_from_the_given_table(table):
    rows = features.assemble_features(table.withColumn("label", F.col("TMP_C")).repartition(5), FEATURES)
    rows = rows.select("split", *FEATURES, "label", "TMP_C", "features", *S.MODEL_KEY).persist()
    params = {"maxDepth": 4, "numTrees": 3}
    study = tuning.tune_by_fits(
        rows, S.MODEL_KEY, "rf", FEATURES, grid={k: [v] for k, v in params.items()}, fractions=[1.0])
    want = tuning.estimator("rf", params).fit(rows.filter("split = 'train'")).transform(rows.filter("split = 'test'"))
    assert study.test_rmse == pytest.approx(RegressionEvaluator().evaluate(want), rel=1e-12)
    rows.unpersist()


def test_kept_rows_stay_whole_and_in_order(spark):
    rows = [(i, None if i % 7 == 0 else float(i % 5), "a" if i % 3 else None) for i in range(500)]
    df = spark.createDataFrame(rows + rows[:50], "_at int, x double, s string").repartition(6).persist()
    before = laid_out(df)
    with tuning.kept_for_fits(df, least=8) as kept:
        assert laid_out(kept) == before and kept.columns == df.columns
    with tuning.kept_for_fits(df, least=1, rows_per_task=300) as kept:
        assert laid_out(kept) == [sum(before[:3], []), sum(before[3:], [])]
    df.unpersist()


def test_kept_rows_leave_no_files_and_may_be_none(spark, monkeypatch):
    paths, make = [], tuning.scratch_path
    monkeypatch.setattr(tuning, "scratch_path", lambda s, label: paths.append(make(s, label)) or paths[-1])
    with tuning.kept_for_fits(spark.range(0).withColumn("x", F.lit(1.0))) as kept:
        assert kept.count() == 0
    with pytest.raises(ValueError), tuning.kept_for_fits(spark.range(9)):
        raise ValueError
    path = spark._jvm.org.apache.hadoop.fs.Path
    assert len(paths) == 2 and not any(path(p).getFileSystem(spark._jsc.hadoopConfiguration()).exists(path(p)) for p in paths)
