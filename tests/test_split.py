from collections import Counter

import pytest
from pyspark.sql import functions as F

from isobar import schema as S
from isobar.functions.hashing import row_hash
from isobar.operators import split


def test_split_is_a_partition_and_stable(table):
    base = table.drop("split")
    first = {(r.STATION, r.DATE_HOUR): r.split for r in split.train_test_split(base, S.MODEL_KEY).collect()}
    second = {(r.STATION, r.DATE_HOUR): r.split
              for r in split.train_test_split(base.repartition(7), S.MODEL_KEY).collect()}
    assert first == second and set(first.values()) == {"train", "test"}
    share = sum(v == "train" for v in first.values()) / len(first)
    assert 0.65 < share < 0.75


def test_fractions_are_nested(table):
    sizes, previous = [], None
    for f in (0.1, 0.25, 0.5, 1.0):
        keys = {tuple(r) for r in split.sample_fraction(table, S.MODEL_KEY, f).select(*S.MODEL_KEY).collect()}
        assert previous is None or previous <= keys
        previous = keys
        sizes.append(len(keys))
    assert sizes == sorted(sizes) and sizes[-1] == table.count()


def test_folds_cover_everything_once(table):
    counts = split.kfold_assign(table, S.MODEL_KEY).groupBy("fold").count().collect()
    assert {r["fold"] for r in counts} == {0, 1, 2}
    assert sum(r["count"] for r in counts) == table.count()


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows are copies of one row; another third shares one key."""
    return spark.range(0, 6000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit("m1")).otherwise(F.lit("m2")).alias("model"),
        F.when(F.col("id") % 3 == 2, F.col("id")).otherwise(F.lit(-1)).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("v"),
    )


def brute_force(rows, cap, by_model):
    groups = {}
    for h, row in sorted(rows):
        groups.setdefault(row[0] if by_model else None, []).append(row)
    return Counter(r for g in groups.values() for r in g[:cap])


@pytest.mark.parametrize("cap", [1, 137, 1500, 10_000])
@pytest.mark.parametrize("by", [[], ["model"]])
def test_capped_sample_is_exact_under_skew(skewed, cap, by):
    hashed = skewed.select(row_hash(skewed.columns, "plot").alias("h"), *skewed.columns).collect()
    want = brute_force([(r["h"], (r["model"], r["k"], r["v"])) for r in hashed], cap, bool(by))
    got = split.capped_sample(skewed, ["k"], 1.0, cap, by)
    assert Counter(tuple(r) for r in got.collect()) == want


def test_capped_sample_without_cap_is_the_sample(skewed):
    got = split.capped_sample(skewed, ["k", "v"], 0.3, 1_000_000, ["model"])
    want = split.sample_fraction(skewed, ["k", "v"], 0.3, "plot")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_rows_without_a_group_are_kept(spark):
    df = spark.createDataFrame([(None, i) for i in range(50)] + [("a", i) for i in range(50)], "model string, v int")
    got = Counter(r["model"] for r in split.capped_sample(df, ["v"], 1.0, 20, ["model"]).collect())
    assert got == {None: 20, "a": 20}


def test_fractions_finer_than_a_bucket_are_refused(table):
    with pytest.raises(ValueError, match="multiple"):
        split.sample_fraction(table, S.MODEL_KEY, 0.0005)
