"""The hashed forest: the same on any partitioning, its draws as they should be, saved and scored as one model."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar import schema as S
from isobar.operators import forest, split, tuning
from isobar.plans import report, train
from isobar.session import scratch_path
from isobar.sources import artifacts, tables
from isobar.sources.artifacts import ArtifactStore

FEATURES = ["HOUR", "DEW_C", "RH_PCT", "WIND_SPEED", "SLP_HPA", "VIS_M"]


@pytest.fixture(scope="module")
def rows(table):
    out = table.withColumn("label", F.col("TMP_C")).persist()
    yield out
    out.unpersist()


@pytest.fixture(scope="module")
def grown(rows):
    return forest.fit_forest(rows.filter("split = 'train'"), S.MODEL_KEY, FEATURES, trees=4, depth=4)


def test_same_forest_on_any_partitioning(rows, grown):
    other = forest.fit_forest(
        rows.filter("split = 'train'").repartition(13, F.rand(5)).orderBy(F.rand(6)), S.MODEL_KEY, FEATURES, trees=4, depth=4
    )
    one, two = (m.model().transform(rows).select(*S.MODEL_KEY, "prediction") for m in (grown, other))
    both = one.join(two.withColumnRenamed("prediction", "again"), S.MODEL_KEY)
    assert both.count() == rows.count() and both.filter(F.abs(F.col("prediction") - F.col("again")) > 1e-9).count() == 0


def test_draws_are_poisson(rows):
    drawn = rows.select(*[forest.bootstrap_weight(S.MODEL_KEY, t).alias(str(t)) for t in range(3)]).collect()
    values = np.array(drawn)
    n = len(values)
    shares = [np.mean(values == k) for k in range(4)]
    assert shares == pytest.approx([np.exp(-1), np.exp(-1), np.exp(-1) / 2, np.exp(-1) / 6], abs=4 / np.sqrt(3 * n))
    assert abs(np.corrcoef(values.T)[0, 1]) < 5 / np.sqrt(n)


def test_drawn_rows_are_hashed_once(rows, capsys):
    some = rows.select(*S.MODEL_KEY, "label")
    got = forest.bootstrap_rows(some, S.MODEL_KEY, 2)
    want = some.withColumn("_draws", forest.bootstrap_weight(S.MODEL_KEY, 2)).filter("_draws > 0")
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    capsys.readouterr()
    got.explain("simple")
    assert capsys.readouterr().out.count("md5(") == 1


def test_subsets_are_a_third_and_differ():
    subsets = [tuple(forest.feature_subset(S.FEATURES_ALL, t)) for t in range(20)]
    assert {len(s) for s in subsets} == {5} and len(set(subsets)) > 15
    assert all(list(s) == [f for f in S.FEATURES_ALL if f in s] for s in subsets)
    assert forest.feature_subset(["a"], 3) == ["a"]


def test_prediction_is_the_mean_of_the_trees(rows, grown):
    some = rows.limit(20)
    model = grown.model(3)
    mean = np.zeros(20)
    for t in range(3):
        from isobar.operators import features as feat

        vectors = feat.assembler(grown.subsets[t], f"_features_{t}").transform(some)
        mean += np.array([r[0] for r in grown.trees[t].transform(vectors).select(f"_prediction_{t}").collect()]) / 3
    got = model.transform(some)
    assert got.columns == [*some.columns, "prediction"]
    assert [r["prediction"] for r in got.collect()] == pytest.approx(mean)


def test_rows_drawn_twice_count_twice(spark):
    """A tree of depth 0 is the weighted mean."""
    df = spark.createDataFrame([(str(i), float(i), float(i * i)) for i in range(200)], "k string, x double, label double")
    grown = forest.fit_forest(df, ["k"], ["x"], trees=1, depth=0)
    weights = df.select("label", forest.bootstrap_weight(["k"], 0).alias("w")).collect()
    want = sum(r["label"] * r["w"] for r in weights) / sum(r["w"] for r in weights)
    assert grown.model().transform(df).first()["prediction"] == pytest.approx(want)


def test_tuning_scores_prefixes_like_separate_fits(rows):
    grid = {"maxDepth": [3], "numTrees": [2, 4]}
    study = tuning.tune_by_fits(rows, S.MODEL_KEY, "hf", FEATURES, grid=grid, fractions=[1.0])
    folds = split.kfold_assign(rows, S.MODEL_KEY).filter("split = 'train'").persist()
    want = []
    for trees in grid["numTrees"]:
        errors = []
        for i in range(3):
            model = forest.fit_forest(folds.filter(f"fold <> {i}"), S.MODEL_KEY, FEATURES, trees=trees, depth=3).model()
            scored = model.transform(folds.filter(f"fold = {i}"))
            errors.append(scored.agg(F.sqrt(F.avg((F.col("label") - F.col("prediction")) ** 2))).first()[0])
        want.append(np.mean(errors))
    folds.unpersist()
    assert [r[3] for r in study.cv_rows] == pytest.approx(want)
    weights = tuning.importance_rows(study)
    assert sum(r[2] for r in weights) == pytest.approx(1.0) and {r[1] for r in weights} == set(FEATURES)


def test_tuning_fits_trees_on_as_many_partitions_as_the_rows_need(rows, monkeypatch):
    seen, fit = [], tuning.hashed_fit
    monkeypatch.setattr(tuning, "hashed_fit", lambda train, *rest: seen.append(train.rdd.getNumPartitions()) or fit(train, *rest))
    tuning.tune_by_fits(
        rows.repartition(40), S.MODEL_KEY, "hf", FEATURES, grid={"maxDepth": [1], "numTrees": [1, 2]}, fractions=[0.5, 1.0])
    assert len(seen) == 5 and set(seen) == {1}


def test_stored_and_reported_like_any_family(spark, table):
    store = ArtifactStore(spark, scratch_path(spark, "hashed"))
    study = train.train_family(table, store, "hf", features=FEATURES, grid={"maxDepth": [2], "numTrees": [3]}, sample_fraction=0.2)
    board = report.leaderboard_from(store).first()
    assert board["model"] == "HashedForest_Tuned" and board["test_rmse"] == pytest.approx(study.test_rmse)
    loaded = tables.load_model(store.path("HashedForest_Tuned", artifacts.MODEL))
    test = table.filter("split = 'test'").withColumn("label", F.col("TMP_C"))
    rmse = loaded.transform(test).agg(F.sqrt(F.avg((F.col("label") - F.col("prediction")) ** 2))).first()[0]
    assert rmse == pytest.approx(study.test_rmse)
    assert store.read(artifacts.IMPORTANCE).count() == len(FEATURES)
