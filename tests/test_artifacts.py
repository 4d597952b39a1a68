import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from isobar import schema as S
from isobar.operators import results
from isobar.plans import report, train
from isobar.session import scratch_path
from isobar.sources import artifacts, tables
from isobar.sources.artifacts import ArtifactStore

LR, DT = "LinearRegression_Tuned", "DecisionTree_Tuned"


@pytest.fixture(scope="module")
def trained(spark, table):
    """A linear model trained twice, and a tree."""
    store = ArtifactStore(spark, scratch_path(spark, "store"))
    train.train_family(table, store, "lr", grid={"regParam": [0.1], "elasticNetParam": [0.0]}, run_id="run-1")
    linear = train.train_family(
        table, store, "lr", grid={"regParam": [0.0, 0.1], "elasticNetParam": [0.0]}, run_id="run-2",
        sample_fraction=0.1,
    )
    tree = train.train_family(
        table, store, "dt", features=["HOUR", "DEW_C"], grid={"maxDepth": [2, 3], "maxBins": [32]},
        run_id="run-1", sample_fraction=0.1, null_policy="fill",
    )
    return store, linear, tree


def test_metrics_come_back(trained):
    store, linear, tree = trained
    rows = {r["model_name"]: r for r in store.read(artifacts.METRICS).collect()}
    assert rows[LR]["test_rmse"] == pytest.approx(linear.test_rmse, rel=1e-12)
    assert json.loads(rows[DT]["best_hyperparameters"]) == tree.best


def test_kinds_are_not_mixed_up(trained):
    store, _, _ = trained
    assert {r["model"] for r in store.read(artifacts.IMPORTANCE).collect()} == {DT}
    assert {r["model"] for r in store.read(artifacts.COEFFICIENTS).collect()} == {LR}


def test_only_the_latest_run_is_read(trained, spark):
    store, linear, _ = trained
    cv = store.read(artifacts.CV)
    assert cv.filter(F.col("model") == LR).count() == 2
    stale = spark.createDataFrame([(LR, 0, {"regParam": "9"}, 9.9)], S.CV_SCHEMA)
    text = stale.withColumn("params", F.to_json("params")).withColumns({"run_id": F.lit("run-0"), "run_at": F.lit("2001")})
    # A table that belongs to no run is older than any run.
    text.write.option("header", True).csv(f"{store.root}/{LR}/{artifacts.CV}")
    assert store.read(artifacts.CV).filter(F.col("avg_rmse") > 9).count() == 0


def test_catalogue(trained):
    store, _, _ = trained
    found = {(r["model"], r["kind"]): r["n_rows"] for r in store.catalogue().collect()}
    assert found[LR, artifacts.CV] == 2 and found[DT, artifacts.IMPORTANCE] == 2
    assert (LR, artifacts.IMPORTANCE) not in found and (DT, artifacts.COEFFICIENTS) not in found


def test_leaderboard_keeps_exact_scores(trained):
    store, linear, tree = trained
    rows = {r["model"]: r for r in report.leaderboard_from(store).collect()}
    assert rows[LR]["rank"] == 1 and rows[DT]["rank"] == 2
    assert rows[LR]["test_rmse"] == pytest.approx(linear.test_rmse, rel=1e-12)
    assert rows[LR]["sample_rows"] >= 10 and rows[LR]["sample_rmse"] != rows[LR]["test_rmse"]


def test_report_tables(trained):
    store, _, _ = trained
    curves = report.validation_curves(store)
    assert curves.filter((F.col("model") == DT) & (F.col("param") == "maxDepth")).count() == 2
    assert [r["rank"] for r in report.top_importances(store).orderBy("rank").collect()] == [1, 2]
    assert report.top_coefficients(store).count() == 13


def test_saved_model_scores_the_same(trained, table):
    store, linear, _ = trained
    loaded = tables.load_model(store.path(LR, artifacts.MODEL))
    both = loaded.transform(table.filter("split = 'test'")).withColumn("mine", linear.fit.prediction())
    assert both.filter(F.abs(F.col("prediction") - F.col("mine")) > 1e-9).count() == 0
    stored = store.read(artifacts.COEFFICIENTS).filter(F.col("model") == LR).first()["intercept"]
    assert stored == linear.fit.intercept and f"{stored!r}D" in loaded.stages[0].getStatement()


def test_tidy_export(trained, spark):
    store, _, _ = trained
    out = scratch_path(spark, "tidy")
    report.export_tidy(store, out)
    board = spark.read.option("header", True).csv(f"{out}/leaderboard")
    assert board.count() == 2
    assert spark.read.option("header", True).csv(f"{out}/tables/{artifacts.CURVE}").count() == 10


def test_json_array_and_lines(spark):
    root = Path(scratch_path(spark, "json"))
    (root / "deep" / "er").mkdir(parents=True)
    first, second = {"model_name": "a", "test_rmse": 1.5}, {"model_name": "b", "test_rmse": 2.5}
    (root / "array.json").write_text(json.dumps([first, second], indent=1))
    (root / "deep" / "lines.json").write_text(json.dumps(second) + "\n" + json.dumps(first) + "\n")
    (root / "deep" / "er" / "broken.json").write_text("not json")
    (root / "deep" / "other.txt").write_text("{}")
    rows = tables.read_json_under(spark, str(root), S.METRICS_SCHEMA).collect()
    named = sorted((r["path"].rsplit("/", 1)[1], r["model_name"]) for r in rows if r["model_name"])
    assert named == [("array.json", "a"), ("lines.json", "b")]


def test_raw_csv_keeps_text(spark, raw):
    path = scratch_path(spark, "csv")
    tables.write_csv(raw.select(*S.RAW_COLUMNS).withColumn("STATION", F.lit("01001099999")), path)
    back = tables.read_raw_csv(spark, path)
    assert {t for _, t in back.dtypes} == {"string"}
    row = back.first()
    assert row["STATION"] == "01001099999" and "T" in row["DATE"]


def test_raw_csv_reads_each_file_by_its_own_header(spark):
    root = Path(scratch_path(spark, "mixed"))
    root.mkdir(parents=True)
    (root / "a.csv").write_text("STATION,DATE,TMP,AA1\n1,2024-01-01T00:00:00,x,p\n")
    (root / "b c%20[1].csv").write_text('TMP,"STATION",EXTRA,DATE\n"y,1",2,z,2024-01-02T00:00:00\n')
    (root / "d.csv").write_text("STATION,DATE,TMP,AA1\n3,2024-01-03T00:00:00,w,q\n")
    (root / "empty.csv").write_text("")
    got = tables.read_raw_csv(spark, str(root))
    assert got.columns == ["STATION", "DATE", "TMP", "AA1"]
    assert sorted(tuple(r) for r in got.collect()) == [
        ("1", "2024-01-01T00:00:00", "x", "p"), ("2", "2024-01-02T00:00:00", "y,1", None), ("3", "2024-01-03T00:00:00", "w", "q"),
    ]
    (root / "twice.csv").write_text("STATION,DATE,DATE\n1,2,3\n")
    with pytest.raises(ValueError, match="twice"):
        tables.read_raw_csv(spark, str(root))


@pytest.fixture()
def foreign(spark):
    """Tables as others write them: no run, no model column, one column per parameter."""
    root = Path(scratch_path(spark, "foreign"))
    texts = {
        "Alpha_Tuned/cv_results_csv/part-0.csv": "avg_rmse,maxDepth,maxIter\n2.5,4,30\n2.0,6,30\n",
        "Alpha_Tuned/learning_curve_csv/part-0.csv": "fraction,n_rows,rmse,r2\n0.1,10,3.0,0.5\n1.0,100,2.0,0.7\n",
        "Alpha_Tuned/feature_importances_csv/part-0.csv": "feature,importance\nDEW_C,0.9\nHOUR,0.1\n",
        "Alpha_Tuned/plot_data_csv/part-0.csv": "Predicted_Temperature_C,Actual_Temperature_C\n" + "1.0,1.5\n" * 12,
        "Alpha_Tuned/metrics.json/part-0.json": json.dumps({"model_name": "Alpha_Tuned", "test_rmse": 2.0, "test_r2": 0.7}),
        "Beta_Tuned/cv_results_csv/part-0.csv": "avg_rmse,regParam\n1.0,0.1\n",
        "Beta_Tuned/learning_curve_csv/part-0.csv": "fraction,train_count,train_rmse,test_rmse\n1.0,100,0.5,1.0\n",
        "Beta_Tuned/coefficients_csv/part-0.csv": "feature,coefficient,abs_coeff,intercept\nDEW_C,-2.0,2.0,1.0\n",
        "Beta_Tuned/plot_data_csv/part-0.csv": "y_true,Pred\n" + "1.0,1.0\n" * 11,
        "Beta_Tuned/metrics.json/part-0.json": json.dumps({"model_name": "Beta_Tuned", "test_rmse": 1.0, "test_r2": 0.9}),
    }
    for name, text in texts.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(text)
    return ArtifactStore(spark, str(root))


def test_foreign_folders_give_a_full_report(foreign):
    board = {r["model"]: r for r in report.leaderboard_from(foreign).collect()}
    assert {m: (r["rank"], r["sample_rows"]) for m, r in board.items()} == {"Beta_Tuned": (1, 11), "Alpha_Tuned": (2, 12)}
    assert board["Alpha_Tuned"]["sample_rmse"] == pytest.approx(0.5)
    best = {r["model"]: (r["grid_idx"], r["params"]) for r in results.best_params(foreign.read(artifacts.CV)).collect()}
    assert best["Alpha_Tuned"] == (1, {"maxDepth": "6", "maxIter": "30"}) and best["Beta_Tuned"] == (0, {"regParam": "0.1"})
    curves = {(r["model"], r["fraction"]): (r["n_rows"], r["test_rmse"]) for r in foreign.read(artifacts.CURVE).collect()}
    assert curves == {("Alpha_Tuned", 0.1): (10, 3.0), ("Alpha_Tuned", 1.0): (100, 2.0), ("Beta_Tuned", 1.0): (100, 1.0)}
    assert foreign.read(artifacts.IMPORTANCE).count() == 2 and foreign.read(artifacts.COEFFICIENTS).count() == 1
    assert {(r["model"], r["kind"]) for r in foreign.catalogue().collect()} == {
        ("Alpha_Tuned", k) for k in (artifacts.CV, artifacts.CURVE, artifacts.IMPORTANCE, artifacts.PLOT, artifacts.METRICS)
    } | {("Beta_Tuned", k) for k in (artifacts.CV, artifacts.CURVE, artifacts.COEFFICIENTS, artifacts.PLOT, artifacts.METRICS)}


def metrics_and_grid(spark, run, rmse):
    record = spark.createDataFrame([("m", rmse, 0.5, "{}")], S.METRICS_SCHEMA)
    return {artifacts.METRICS: record, artifacts.CV: spark.createDataFrame([("m", 0, {"p": run}, rmse)], S.CV_SCHEMA)}


def put(store, run_id, at, rmse, kinds=(artifacts.METRICS, artifacts.CV), publish=True):
    run = store.run("m", run_id, at)
    for kind, df in metrics_and_grid(store.spark, run_id, rmse).items():
        if kind in kinds:
            run.write(df, kind)
    if publish:
        run.publish()


def test_runs_are_ordered_by_time_and_never_mixed(spark):
    store = ArtifactStore(spark, scratch_path(spark, "runs"))
    put(store, "run-9", "2024-01-01T00:00:00.000000Z", 9.0)
    put(store, "run-10", "2024-01-02T00:00:00.000000Z", 1.0, (artifacts.METRICS,))
    assert [r["test_rmse"] for r in store.read(artifacts.METRICS).collect()] == [1.0]
    assert store.read(artifacts.CV).count() == 0  # the older run's settings do not stand beside it
    assert store.published()["m"]["kinds"] == {artifacts.METRICS: 1}


def test_a_killed_run_does_not_exist(spark, table, monkeypatch):
    """Tables without a manifest are not read, wherever the run died; the run before stays whole."""
    store = ArtifactStore(spark, scratch_path(spark, "killed"))
    put(store, "run-1", "2024-01-01T00:00:00.000000Z", 2.0)
    put(store, "run-2", "2024-01-02T00:00:00.000000Z", 1.0, publish=False)
    assert [r["test_rmse"] for r in store.read(artifacts.METRICS).collect()] == [2.0]
    assert [r["params"] for r in store.read(artifacts.CV).collect()] == [{"p": "run-1"}]

    plain = {"regParam": [0.0], "elasticNetParam": [0.0]}
    whole = train.train_family(table, store, "lr", features=["DEW_C"], grid=plain)
    written = artifacts.Run.write

    def dies(self, df, kind):
        if kind == artifacts.PLOT:
            raise RuntimeError("lost")
        written(self, df, kind)

    monkeypatch.setattr(artifacts.Run, "write", dies)
    with pytest.raises(RuntimeError, match="lost"):
        train.train_family(table, store, "lr", features=["HOUR"], grid=plain)
    monkeypatch.undo()
    got = {r["model_name"]: r["test_rmse"] for r in store.read(artifacts.METRICS).collect()}
    assert got == {"m": 2.0, LR: pytest.approx(whole.test_rmse)}
    assert {r["feature"] for r in store.read(artifacts.COEFFICIENTS).collect()} == {"DEW_C"}


def test_catalogue_reads_each_kind_once(trained):
    """One scan per kind, and none of tables that belong to no run where there are none."""
    store = ArtifactStore(trained[0].spark, scratch_path(trained[0].spark, "once"))
    put(store, "run-1", None, 1.0)
    plan = store.catalogue()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation ") == 2 and {r["kind"] for r in store.catalogue().collect()} == {artifacts.METRICS, artifacts.CV}


def test_two_records_in_a_metrics_file_are_an_error(spark):
    root = Path(scratch_path(spark, "double"))
    (root / "m" / "metrics.json").mkdir(parents=True)
    record = {"model_name": "m", "test_rmse": 1.0}
    for text in (json.dumps([record, record]), json.dumps(record) + "\n" + json.dumps(record) + "\n"):
        (root / "m" / "metrics.json" / "part-0.json").write_text(text)
        with pytest.raises(Exception, match="more than one record"):
            ArtifactStore(spark, str(root)).read(artifacts.METRICS).collect()


def test_curve_spellings(spark):
    a = spark.createDataFrame([(0.1, 5, 1.0)], "train_size_fraction double, train_count int, rmse double")
    b = spark.createDataFrame([(0.5, 7, 0.5, 2.0)], "fraction double, n_rows int, train_rmse double, test_rmse double")
    rows = results.union_curves({"a": a, "b": b}).orderBy("model").collect()
    assert rows[0].asDict() == {"model": "a", "fraction": 0.1, "n_rows": 5, "train_rmse": None, "test_rmse": 1.0, "test_r2": None}
    assert rows[1]["train_rmse"] == 0.5 and rows[1]["n_rows"] == 7


def test_leaderboard_puts_missing_scores_last(spark):
    board = spark.createDataFrame([("a", None, None), ("b", 2.0, 0.5), ("c", 1.0, 0.9)], "model string, test_rmse double, test_r2 double")
    assert [r["model"] for r in results.leaderboard(board).orderBy("rank").collect()] == ["c", "b", "a"]


def test_best_params_first_of_equals(spark):
    cv = spark.createDataFrame([("m", 0, {"p": "1"}, 2.0), ("m", 1, {"p": "2"}, 1.0), ("m", 2, {"p": "3"}, 1.0)], S.CV_SCHEMA)
    assert results.best_params(cv).first()["grid_idx"] == 1
