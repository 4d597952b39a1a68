import pytest
from pyspark.sql import functions as F

from isobar import schema as S
from isobar.operators import clean, quality
from isobar.plans import preprocess
from isobar.session import scratch_path


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_select_existing(spark):
    df = spark.createDataFrame([("a", "b")], "TMP string, DATE string")
    kept, missing = clean.select_existing(df, S.RAW_COLUMNS)
    assert kept.columns == ["DATE", "TMP"] and "AA1" in missing and len(missing) == 9
    filled, _ = clean.select_existing(df, S.RAW_COLUMNS, fill_missing=True)
    assert filled.columns == S.RAW_COLUMNS and filled.first()["AA1"] is None


def test_missing_columns(raw):
    """Parsing goes on with NULLs; a column the ranges need must not be missing for all rows."""
    assert preprocess.parsed_observations(raw.drop("AA1")).count() == raw.count()
    with pytest.raises(ValueError, match="AA1"):
        preprocess.model_table(raw.drop("AA1"), "obs_id")
    assert preprocess.model_table(raw.drop("VIS"), "obs_id").count() == 0


def test_parse_reads_only_what_is_asked_for(spark, raw):
    path = scratch_path(spark, "raw")
    raw.write.parquet(path)
    plan = str(preprocess.parsed_observations(spark.read.parquet(path), fields=["TMP_C"]).select("TMP_C")
               ._jdf.queryExecution().executedPlan())
    schema = plan.split("ReadSchema:")[1]
    assert "TMP:string" in schema and "WND" not in schema and "AA1" not in schema and "LATITUDE" not in schema
    assert plan.count("regexp_extract") == 1
    wanted = preprocess.parsed_observations(raw, ["obs_id"])
    for fields in (["TMP_C"], ["RH_PCT"], ["WIND_DIR", "VIS_M"]):
        some = preprocess.parsed_observations(raw, ["obs_id"], fields=fields)
        assert rows(some.select("obs_id", *fields)) == rows(wanted.select("obs_id", *fields))


def test_funnel_without_a_tie_column(raw):
    with_tie = {r.step: r.n_rows for r in quality.quality_funnel(raw, "obs_id").collect()}
    without = {r.step: r.n_rows for r in quality.quality_funnel(raw.drop("obs_id")).collect()}
    assert {k: v for k, v in without.items() if k != "complete"} == {k: v for k, v in with_tie.items() if k != "complete"}
    assert without["complete"] == preprocess.model_table(raw.drop("obs_id")).count()


def test_padded_station_is_the_same_station(spark, raw):
    one = raw.filter("obs_id < 50").drop("obs_id")
    padded = one.withColumn("STATION", F.concat(F.lit(" "), "STATION", F.lit("  ")))
    assert preprocess.deduplicated(one.union(padded)).count() == preprocess.deduplicated(one).count()


def test_survivor_counts(raw):
    assert preprocess.deduplicated(raw, "obs_id").count() == 561
    assert preprocess.feature_table(raw, "obs_id").count() == 420
    assert preprocess.model_table(raw, "obs_id").count() == 392


def test_ranges_hold_and_ends_are_inside(spark, raw):
    valid = clean.range_validate(preprocess.parsed_observations(raw))
    assert valid.filter(~clean.in_ranges()).count() == 0
    edge = spark.createDataFrame([(lo,) for lo in (-90.0, 65.0, 65.1)] + [(None,)], "TMP_C double")
    assert clean.range_validate(edge, {"TMP_C": (-90.0, 65.0)}).count() == 2


def test_dedupe_is_stable_and_idempotent(raw):
    parsed = preprocess.parsed_observations(raw, ["obs_id"])
    once = clean.dedupe_keyed(parsed, S.KEY, ["obs_id"])
    again = clean.dedupe_keyed(parsed.repartition(7), S.KEY, ["obs_id"])
    assert rows(once) == rows(again) == rows(clean.dedupe_keyed(once, S.KEY, ["obs_id"]))
    by_content = clean.dedupe_keyed(parsed, S.KEY)
    assert rows(by_content) == rows(clean.dedupe_keyed(parsed.repartition(5), S.KEY))


def test_dedupe_without_other_columns(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "b"), ("c", None), ("c", None)], "STATION string, DATE string")
    assert clean.dedupe_keyed(df).count() == 2


def test_dedupe_hot_key_sends_one_row_per_task(spark):
    hot = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("STATION"),
        F.lit("d").alias("DATE"), F.col("id").alias("obs_id"),
    )
    out = clean.dedupe_keyed(hot, S.KEY, ["obs_id"])
    assert out.count() == 20_001
    assert out.filter("STATION = 'hot'").first()["obs_id"] == 0


def test_null_policies(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, 2.0, None)], "a double, b double, TMP_C double")
    assert clean.apply_null_policy(df, "drop", ["a"]).count() == 1
    filled = clean.apply_null_policy(df, "fill", ["a"]).collect()
    assert [tuple(r) for r in filled] == [(1.0, 0.0, 3.0), (0.0, 2.0, None)]


def test_any_present(spark):
    df = spark.createDataFrame([(None, None), (None, 1.0)], "TMP_C double, DEW_C double")
    assert clean.filter_any_present(df, ["TMP_C", "DEW_C"]).count() == 1


def test_funnel_agrees_with_the_steps(raw):
    funnel = {r["step"]: r["n_rows"] for r in quality.quality_funnel(raw, "obs_id").collect()}
    parsed = preprocess.parsed_observations(raw, ["obs_id"])
    assert funnel == {
        "raw": raw.count(), "required": clean.filter_required(raw).count(),
        "valid": clean.range_validate(parsed).count(), "deduplicated": 561, "on_the_hour": 420, "complete": 392,
    }


def test_funnel_counts_rows_lost_to_required(spark, raw):
    holed = raw.withColumn("TMP", F.when(F.col("obs_id") % 10 != 0, F.col("TMP")))
    funnel = {r["step"]: r["n_rows"] for r in quality.quality_funnel(holed, "obs_id").collect()}
    assert funnel["required"] == 900 and funnel["complete"] == preprocess.model_table(holed, "obs_id").count()


def test_empty_input(raw):
    nothing = raw.limit(0)
    assert preprocess.model_table(nothing, "obs_id").count() == 0
    assert [r["n_rows"] for r in quality.quality_funnel(nothing, "obs_id").collect()] == [0] * 6


def test_unreadable_date_is_dropped_not_an_error(spark, raw):
    broken = raw.withColumn("DATE", F.when(F.col("obs_id") < 500, F.lit("soon")).otherwise(F.col("DATE")))
    assert 0 < preprocess.model_table(broken, "obs_id").count() < 392


def test_session_zone_does_not_matter(spark, raw):
    before = rows(preprocess.model_table(raw, "obs_id"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert rows(preprocess.model_table(raw, "obs_id")) == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
