"""Orthogonal triangles against numpy's own decompositions, and fits that moments cannot make."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar import schema as S
from isobar.operators import linear, moments, tsqr


def frame(spark, data, by=None):
    names = [f"f{i}" for i in range(data.shape[1] - 1)] + ["y"]
    rows = [(None if by is None else by[i], *map(float, r)) for i, r in enumerate(data)]
    return spark.createDataFrame(rows, "g string, " + ", ".join(f"{n} double" for n in names)), names


def test_triangles_of_groups_add_up(spark):
    rng = np.random.default_rng(0)
    data = rng.normal(3, 1, (1000, 5))
    by = [None if k < 3 else "ab"[k % 2] for k in rng.integers(0, 10, 1000)]
    df, names = frame(spark, data, by)
    df = df.unionByName(df.limit(1).withColumn("y", F.lit(None).cast("double"))).repartition(50)  # a row with a NULL is left out
    shift = {"f0": 3.0}
    got = {r["g"]: tsqr.from_row(r) for r in tsqr.triangles_by(df, names, ["g"], shift).collect()}
    assert set(got) == {None, "a", "b"}
    for g, t in got.items():
        own = data[[b == g for b in by]]
        assert t.n == len(own) and t.means == pytest.approx(own.mean(0) - np.array([3.0, 0, 0, 0, 0]))
        assert t.centred.T @ t.centred == pytest.approx((own - own.mean(0)).T @ (own - own.mean(0)))
    both = tsqr.total(got.values())
    assert both.n == 1000 and (got["a"] + got["b"] + got[None]).centred.T @ both.centred is not None
    [row] = tsqr.triangles_by(df, names, [], {}).collect()
    whole = tsqr.from_row(row)
    centred = data - data.mean(0)
    assert whole.centred.T @ whole.centred == pytest.approx(centred.T @ centred)
    want = np.linalg.lstsq(centred[:, :4], centred[:, 4], rcond=None)[0]
    assert whole.weights(range(4)) == pytest.approx(want)
    assert whole.squared_error(want, 0.5) == pytest.approx(((centred[:, 4] - centred[:, :4] @ want) ** 2).sum() + 250)


def test_few_rows_and_no_rows(spark):
    df, names = frame(spark, np.arange(6.0).reshape(2, 3))
    t = tsqr.from_row(tsqr.triangles_by(df, names, [], {}).first())
    assert t.n == 2 and t.r.shape == (4, 4)
    assert tsqr.triangles_by(df.limit(0), names, [], {}).collect() == [] and tsqr.total([]) is None


def close_columns(n=20_000, gap=1e-9):
    """Two columns that differ by ``gap`` times a third variable, which is half of the label."""
    rng = np.random.default_rng(1)
    x, noise = rng.normal(100, 1, n), rng.normal(0, 1, n)
    moved = x + gap * noise
    return np.column_stack([x, moved, x + (moved - x) / gap])


def test_condition_of_a_billion(spark):
    """The moments take the two columns for one; the triangles tell them apart."""
    data = close_columns()
    df, names = frame(spark, data)
    df = df.withColumns({"k": F.monotonically_increasing_id().cast("string"), "split": F.when(F.rand(1) < 0.7, "train").otherwise("test")})
    shift = moments.column_means(df, names)
    [row] = moments.moments_by(df, names, [], shift).collect()
    m = moments.from_row(row, 3)
    assert linear.ill_conditioned(m, 2)
    by_moments = linear.solve(m, names[:2], shift, label="y")
    fit = linear.least_squares(df, names[:2], "y")
    error = lambda f: float(np.sqrt(np.mean((data[:, 2] - f.intercept - data[:, :2] @ f.coefficients) ** 2)))
    assert error(by_moments) > 0.5 and error(fit) < 1e-4
    assert fit.coefficients == pytest.approx([1 - 1e9, 1e9], rel=1e-4)
    study = linear.tune_linear(df, ["k"], names[:2], "y", grid={"regParam": [0.0], "elasticNetParam": [0.0]})
    assert study.cv_rows[0][3] < 1e-4 and study.test_rmse < 1e-4 and study.test_r2 > 0.999999
    scored = fit.transform(df).agg(F.sqrt(F.avg((F.col("y") - F.col("prediction")) ** 2))).first()[0]
    assert scored < 1e-4


def test_exact_combinations_share_their_weight(spark):
    rng = np.random.default_rng(2)
    x, z = rng.normal(0, 1, 500), rng.normal(0, 1, 500)
    data = np.column_stack([x, 17.5 * x - 170, np.full(500, 7.7), z, 3 * x + z])
    df, names = frame(spark, data)
    fit = linear.least_squares(df.repartition(7), names[:4], "y")
    spread = data[:, :4].std(0)
    assert fit.coefficients * spread == pytest.approx([1.5 * spread[0], 1.5 * spread[0], 0, spread[3]])
    assert fit.intercept == pytest.approx(1.5 * 170 / 17.5)


def test_all_features_of_the_station_table(table):
    fit = linear.least_squares(table, S.FEATURES_ALL)
    x = np.array(table.select(*S.FEATURES_ALL).collect(), float)
    y = np.array([r[0] for r in table.select(S.LABEL).collect()])
    spread = x.std(0)
    live = spread > 0
    z = (x[:, live] - x[:, live].mean(0)) / spread[live]
    want = np.zeros(len(spread))
    want[live] = np.linalg.lstsq(z, y - y.mean(), rcond=1e-10)[0] / spread[live]
    assert fit.coefficients == pytest.approx(want, rel=1e-6, abs=1e-9)
