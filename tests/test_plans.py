"""The physical plans the job depends on at scale."""

import re
from pathlib import Path

from pyspark.sql import functions as F

from isobar import schema as S
from isobar.operators import features, linear, metrics, moments, quality, split
from isobar.plans import preprocess
from isobar.session import scratch_path


def plan_of(df, mode="formatted"):
    jvm = df.sparkSession._jvm
    explain = jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    return df._jdf.queryExecution().explainString(explain)


def exchanges(plan):
    return len(re.findall(r"^\(\d+\) Exchange", plan, re.M))


def test_cleaning_is_native_with_one_shuffle(raw):
    plan = plan_of(preprocess.model_table(raw, "obs_id"))
    assert "EvalPython" not in plan and "MapInPandas" not in plan
    assert exchanges(plan) == 1
    # The rank filter runs before and after the shuffle.
    assert len(re.findall(r"^\(\d+\) WindowGroupLimit", plan, re.M)) == 2


def test_each_field_is_parsed_once(raw):
    plan = plan_of(preprocess.model_table(raw, "obs_id"))
    assert plan.count("9{4,}") == 4
    assert not re.search(r"Condition :.*regexp_extract", plan)


def test_generated_code_fits_the_jit(raw):
    spark = raw.sparkSession
    # Adaptive plans show their generated code only once they have run.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(preprocess.model_table(spark.read.parquet(stored(raw)), "obs_id"), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", plan)]
    assert sizes and max(sizes) < 8000


def stored(raw):
    path = scratch_path(raw.sparkSession, "raw")
    raw.write.parquet(path)
    return path


def test_filters_and_columns_reach_the_scan(raw):
    spark = raw.sparkSession
    wide = spark.read.parquet(stored(raw.withColumn("REM", F.lit("remarks"))))
    plan = plan_of(preprocess.model_table(wide, "obs_id"))
    assert "REM" not in re.search(r"ReadSchema: (.*)", plan).group(1)
    assert "IsNotNull(TMP)" in plan and "IsNotNull(DATE)" in plan


def test_split_needs_no_shuffle(table):
    labelled = split.kfold_assign(split.train_test_split(table.drop("split"), S.MODEL_KEY), S.MODEL_KEY)
    assert exchanges(plan_of(labelled)) == 0


def test_aggregates_combine_before_the_shuffle(table, raw):
    for df, keys in (
        (moments.moments_by(table, ["DEW_C", "TMP_C"], ["split"]), 1),
        (quality.feature_profile(table, S.FEATURES_ALL), 1),
        (metrics.prediction_metrics(table.select("split", F.col("TMP_C").alias("label"), F.col("DEW_C").alias("prediction")), ["split"]), 1),
    ):
        plan = plan_of(df)
        assert exchanges(plan) == keys and "partial_" in plan
        assert "SortAggregate" not in plan


def test_funnel_uses_hash_aggregates(raw):
    plan = plan_of(quality.quality_funnel(raw, "obs_id"))
    assert "SortAggregate" not in plan and exchanges(plan) == 2


def test_scoring_is_a_projection(table):
    fit = linear.tune_linear(table, S.MODEL_KEY, ["DEW_C"]).fit
    plan = plan_of(fit.transform(table))
    assert exchanges(plan) == 0 and "Python" not in plan


def test_no_cross_join_in_the_capped_sample(table):
    pairs = table.select("split", *S.MODEL_KEY, "TMP_C")
    plan = plan_of(split.capped_sample(pairs, S.MODEL_KEY, 0.5, 100, ["split"]))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def bytes_read(spark):
    return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())


def test_scaling_evaluates_its_input_once(spark, raw):
    """The split table and its deviations come out of one pass; scaling is a projection."""
    source = stored(raw.repartition(4))
    size = sum(f.stat().st_size for f in Path(source).glob("*.parquet"))
    path = scratch_path(spark, "scaled")
    before = bytes_read(spark)
    preprocess.write_split_table(spark.read.parquet(source), path, "obs_id")
    assert bytes_read(spark) - before < 1.5 * size
    table = spark.read.parquet(path)
    assert set(table.columns) == {*S.MODEL_COLUMNS, "split"}
    deviations = preprocess.stored_deviations(spark, path)
    want = table.agg(*features.sample_deviations(S.FEATURES_ALL)).first().asDict()
    assert all(abs(deviations[c] - want[c]) <= 1e-9 * (1 + want[c]) for c in S.FEATURES_ALL)
    plan = plan_of(features.scaled(table, S.FEATURES_ALL, deviations))
    assert exchanges(plan) == 0 and "Python" not in plan and plan.count("Scan parquet") <= 2


def test_standard_scale_reads_its_input_once(spark, raw):
    source = stored(raw.select("obs_id", F.col("obs_id").cast("double").alias("x"), F.lit(2.0).alias("same")).repartition(4))
    size = sum(f.stat().st_size for f in Path(source).glob("*.parquet"))
    before = bytes_read(spark)
    got = features.standard_scale(spark.read.parquet(source), ["x", "same"])
    assert bytes_read(spark) - before < 2 * size + 20_000  # the schema is read from a footer as well
    row = got.orderBy("obs_id").collect()[-1]
    assert row["features"][1] == 0.0 and row["features"][0] > 0


def test_capped_sample_shuffles_counters_and_then_few_rows(table):
    """No exchange carries a row's columns before the threshold's filter."""
    pairs = table.select("split", *S.MODEL_KEY, "TMP_C", "DEW_C")
    cut = split.sample_cut(pairs, split.row_hash(pairs.columns), 100, [F.col("split")], ["g"], "last")
    assert {r["g"] for r in cut.collect()} == {"train", "test"}
    plan = plan_of(split.capped_sample(pairs, S.MODEL_KEY, 0.5, 100, ["split"]))
    tree = plan.split("\n\n")[0]
    first_exchange = max(i for i, line in enumerate(tree.splitlines()) if "Exchange" in line and "Broadcast" not in line)
    join = next(i for i, line in enumerate(tree.splitlines()) if "BroadcastHashJoin" in line)
    assert join > first_exchange  # below the deepest shuffle: the rows are filtered first


def test_capped_sample_takes_any_column_name(spark):
    df = spark.range(50).selectExpr("id AS _n", "id % 2 AS _hash", "id AS _group_0", "CAST(NULL AS INT) AS `_last`")
    got = split.capped_sample(df, ["_n"], 1.0, 7, ["_hash"])
    assert got.columns == df.columns and got.count() == 14
