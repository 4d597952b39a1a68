"""Linear regression with an elastic-net penalty.

Settings without an absolute-value penalty are solved from moments: one pass over the rows serves
all folds, settings and sample fractions. Where the moments are too ill-conditioned to tell close directions
from equal ones, unpenalised settings are solved from orthogonal triangles instead, one more pass. Settings
with an absolute-value penalty are fitted by MLlib's normal-equation solver on the same folds. Both follow one convention: features and label are standardised with
population deviations, and ``regParam`` is divided by that of the label.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar import schema as S
from isobar.operators import features as feat
from isobar.operators import split, tsqr
from isobar.operators.moments import Moments, column_means, from_row, moments_by, total
from isobar.operators.results import small_table
from isobar.operators.tuning import GRIDS, best_setting, expand_grid

LINEAR_GRID = GRIDS["lr"]
# The default learning-curve fractions.
FRACTIONS = [0.1, 0.25, 0.5, 0.75, 1.0]

# Directions of the correlation matrix below this are exact linear combinations.
COLLINEAR = 1e-9
# Eigenvalues of the correlation matrix below this share of the largest have lost half their digits.
ILL = 1e-7
# MLlib's stopping rule for penalised fits, tight enough for six digits of the scores.
TOLERANCE, MAX_ITERATIONS = 1e-13, 10_000


@dataclass(frozen=True)
class LinearFit:
    features: list[str]
    coefficients: np.ndarray
    intercept: float
    deviations: np.ndarray = field(repr=False)
    label: str = S.LABEL

    def prediction(self) -> Column:
        """The fitted formula as a native column expression."""
        terms = [F.lit(float(w)) * F.col(c) for c, w in zip(self.features, self.coefficients)]
        return sum(terms, F.lit(float(self.intercept)))

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self.prediction())

    def pipeline(self) -> PipelineModel:
        """The formula, digit for digit, as a saveable model that adds ``prediction``."""
        terms = [f"{float(w)!r}D * `{c}`" for c, w in zip(self.features, self.coefficients)]
        formula = " + ".join([*terms, f"{float(self.intercept)!r}D"])
        return PipelineModel([SQLTransformer(statement=f"SELECT *, {formula} AS prediction FROM __THIS__")])


def has_l1(setting: Mapping) -> bool:
    return setting["regParam"] > 0 and setting["elasticNetParam"] > 0


def solve(m: Moments, features: Sequence[str], shift: Mapping[str, float], reg: float = 0.0,
          label: str = S.LABEL) -> LinearFit:
    """Least squares with a squared penalty, from moments whose last column is the label.

    Constant columns get weight 0; of equally good weights the smallest are taken.
    """
    cov, k = m.covariance, len(features)
    spread = np.sqrt(np.clip(np.diag(cov), 0.0, None))
    live = [i for i in range(k) if spread[i] > 0]
    w = np.zeros(k)
    if live and spread[k] > 0:
        corr = cov[np.ix_(live, live)] / np.outer(spread[live], spread[live])
        target = cov[live, k] / (spread[live] * spread[k])
        system = corr + reg / spread[k] * np.eye(len(live))
        w[live] = np.linalg.pinv(system, rcond=COLLINEAR, hermitian=True) @ target * spread[k] / spread[live]
    return finished(m, features, shift, w, label)


@dataclass(frozen=True)
class RowSet:
    """What is known of a set of rows: their moments, and their triangle where it was asked for."""

    m: Moments
    t: tsqr.Triangle | None = None


def ill_conditioned(m: Moments, k: int) -> bool:
    """Whether the moments of the first ``k`` columns are too close to singular to be solved."""
    spread = np.sqrt(np.clip(np.diag(m.covariance)[:k], 0.0, None))
    live = np.flatnonzero(spread > 0)
    if len(live) < 2:
        return False
    values = np.linalg.eigvalsh(m.covariance[np.ix_(live, live)] / np.outer(spread[live], spread[live]))
    return bool(values[0] < ILL * values[-1])


def solve_rows(rows: RowSet, features: Sequence[str], shift: Mapping[str, float], reg: float = 0.0, label: str = S.LABEL) -> LinearFit:
    """Least squares by the triangle where there is one and no penalty, else by the moments."""
    if rows.t is None or reg > 0:
        return solve(rows.m, features, shift, reg, label)
    live = [i for i in np.flatnonzero(rows.m.low < rows.m.high).tolist() if i < len(features)]
    return finished(rows.m, features, shift, rows.t.weights(live), label)


def least_squares(df: DataFrame, features: Sequence[str], label: str = S.LABEL) -> LinearFit:
    """Unpenalised fit on all rows of ``df``; of equally good weights the smallest."""
    columns = [*features, label]
    shift = column_means(df, columns)
    [row] = moments_by(df, columns, [], shift).collect()
    m = from_row(row, len(columns))
    t = tsqr.from_row(tsqr.triangles_by(df, columns, [], shift).first()) if ill_conditioned(m, len(features)) else None
    return solve_rows(RowSet(m, t), features, shift, label=label)


def finished(m: Moments, features: Sequence[str], shift: Mapping[str, float], w: np.ndarray, label: str) -> LinearFit:
    """The fit with weights ``w`` whose mean error on the rows behind ``m`` is 0."""
    k = len(features)
    origin = m.means[:k] + np.array([shift.get(c, 0.0) for c in features])
    intercept = m.means[k] + shift.get(label, 0.0) - w @ origin
    spread = np.sqrt(np.clip(np.diag(m.covariance), 0.0, None))
    sample = spread[:k] * np.sqrt(m.n / (m.n - 1)) if m.n > 1 else np.zeros(k)
    return LinearFit(list(features), w, float(intercept), sample, label)


def fit_penalised(rows: DataFrame, m: Moments, features: Sequence[str], shift: Mapping[str, float],
                  setting: Mapping, label: str = S.LABEL) -> LinearFit:
    """MLlib's elastic net on ``rows`` around their means; ``m`` holds the moments of the same rows."""
    varies = np.flatnonzero(m.low < m.high)
    live = [i for i in varies.tolist() if i < len(features)]
    w = np.zeros(len(features))
    if live and len(features) in varies:
        moved = [(F.col(c) - F.lit(float(shift.get(c, 0.0)))).alias(c) for c in (*[features[i] for i in live], label)]
        vectors = feat.assemble_features(rows.select(*moved), [features[i] for i in live])
        solver = LinearRegression(
            featuresCol="features", labelCol=label, solver="normal", tol=TOLERANCE, maxIter=MAX_ITERATIONS, **setting
        )
        w[live] = solver.fit(vectors).coefficients.toArray()
    return finished(m, features, shift, w, label)


def squared_error(fit: LinearFit, rows: RowSet | Moments, shift: Mapping[str, float]) -> float:
    """Sum of squared errors of ``fit`` on ``rows``."""
    m, t = (rows, None) if isinstance(rows, Moments) else (rows.m, rows.t)
    w = np.append(-fit.coefficients, 1.0)
    origin = np.array([shift.get(c, 0.0) for c in fit.features])
    # Mean error first, spread around it second: no large terms cancel.
    bias = w @ m.means + shift.get(fit.label, 0.0) - fit.coefficients @ origin - fit.intercept
    if t is not None:
        return t.squared_error(fit.coefficients, bias)
    return float(m.n * (max(w @ m.covariance @ w, 0.0) + bias * bias))


def rmse(fit: LinearFit, rows: RowSet | Moments, shift: Mapping[str, float]) -> float:
    m = rows if isinstance(rows, Moments) else rows.m
    return float(np.sqrt(squared_error(fit, rows, shift) / m.n))


def r2(fit: LinearFit, rows: RowSet | Moments, shift: Mapping[str, float]) -> float | None:
    m = rows if isinstance(rows, Moments) else rows.m
    k = len(fit.features)
    sst = m.n * m.covariance[k, k]
    return float(1.0 - squared_error(fit, rows, shift) / sst) if sst > 0 else None


@dataclass
class LinearStudy:
    """Everything the tuned linear model reports."""

    name: str
    fit: LinearFit
    best: dict
    cv_rows: list[tuple]
    curve_rows: list[tuple]
    test_rmse: float | None
    test_r2: float | None


def tune_linear(
    df: DataFrame, keys: Sequence[str], features: Sequence[str], label: str = S.LABEL,
    name: str = "LinearRegression_Tuned", grid: Mapping[str, list] = LINEAR_GRID,
    folds: int = 3, fractions: Sequence[float] = FRACTIONS, shift: Mapping[str, float] | None = None,
    parallelism: int = 8,
) -> LinearStudy:
    """Grid search, refit, test score and learning curve of a table with a ``split`` column.

    Rows with a missing value take no part. At most 2 x folds x (fractions + 1) rows of moments
    are fetched; they score every fit, and give those without an absolute-value penalty. If they are
    ill-conditioned, as many triangles are fetched besides.
    """
    fractions = sorted(fractions)
    columns = [*features, label]
    table = df.na.drop(subset=columns).select(
        "split", split.fold_number(keys, folds).alias("fold"),
        F.coalesce(split.fraction_index(keys, fractions), F.lit(len(fractions))).alias("part"),
        *[F.col(c).cast("double").alias(c) for c in columns],
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        shift = column_means(table, columns) if shift is None else shift
        by = ["split", "fold", "part"]
        key_of = lambda r: tuple(r[b] for b in by)
        cells = {key_of(r): from_row(r, len(columns)) for r in moments_by(table, columns, by, shift).collect()}
        whole_train = total(m for (s, _, _), m in cells.items() if s == "train")
        triangles = {}
        if whole_train is not None and ill_conditioned(whole_train, len(features)):
            triangles = {key_of(r): tsqr.from_row(r) for r in tsqr.triangles_by(table, columns, by, shift).collect()}

        def pick(where) -> RowSet | None:
            m = total(m for key, m in cells.items() if where(*key))
            return None if m is None else RowSet(m, tsqr.total(t for key, t in triangles.items() if where(*key)))

        train = pick(lambda s, f, p: s == "train")
        test = pick(lambda s, f, p: s == "test")
        if train is None:
            raise ValueError("no training rows")
        in_train = table.filter(F.col("split") == "train")
        settings = expand_grid(grid)
        pairs = {}
        for i in range(folds):
            held = pick(lambda s, f, p, i=i: s == "train" and f == i)
            rest = pick(lambda s, f, p, i=i: s == "train" and f != i)
            if held is not None and rest is not None:
                pairs[i] = (rest, held)

        def fit_on(part: RowSet, setting: Mapping, rows: DataFrame) -> LinearFit:
            if has_l1(setting):
                return fit_penalised(rows, part.m, features, shift, setting, label)
            return solve_rows(part, features, shift, setting["regParam"], label)

        def score(task: tuple[int, int]) -> float:
            rest, held = pairs[task[1]]
            return rmse(fit_on(rest, settings[task[0]], in_train.filter(F.col("fold") != task[1])), held, shift)

        def at_once(fn, tasks: list) -> list:
            if not tasks:
                return []
            with ThreadPool(min(parallelism, len(tasks))) as pool:
                return pool.map(inheritable_thread_target(df.sparkSession)(fn), tasks, chunksize=1)

        tasks = [(k, i) for k in range(len(settings)) for i in pairs]
        scores = dict(zip(tasks, at_once(score, tasks)))
        averages = [float(np.mean([scores[k, i] for i in pairs])) if pairs else None for k in range(len(settings))]
        cv_rows = [(name, k, {p: str(v) for p, v in s.items()}, averages[k]) for k, s in enumerate(settings)]
        best = best_setting(settings, averages)

        def fit_part(i: int) -> LinearFit | None:
            part = pick(lambda s, f, p: s == "train" and p <= i)
            return None if part is None else fit_on(part, best, in_train.filter(F.col("part") <= i))

        # The whole training set is the fit that everything else reports.
        whole = len(fractions)
        fits = dict(zip(range(whole + 1), at_once(fit_part, list(range(whole + 1)))))
        fit = fits[whole]
    finally:
        table.unpersist()
    curve = []
    for i, fraction in enumerate(fractions):
        part = pick(lambda s, f, p: s == "train" and p <= i)
        if part is None:
            continue
        sub = fit if part.m.n == train.m.n else fits[i]
        curve.append((
            name, float(fraction), int(part.m.n), rmse(sub, part, shift),
            rmse(sub, test, shift) if test else None, r2(sub, test, shift) if test else None,
        ))
    return LinearStudy(
        name, fit, best, cv_rows, curve,
        rmse(fit, test, shift) if test else None, r2(fit, test, shift) if test else None,
    )


def weight_rows(features: Sequence[str], weights: Iterable[float], intercept: float, name: str) -> list[tuple]:
    """Coefficient table rows, largest magnitude first."""
    rows = [(name, f, float(c), abs(float(c)), float(intercept)) for f, c in zip(features, weights)]
    return sorted(rows, key=lambda r: -r[3])


def coefficient_rows(fit: LinearFit, name: str) -> list[tuple]:
    """Weights of the unit-deviation features."""
    return weight_rows(fit.features, fit.coefficients * fit.deviations, fit.intercept, name)


def coefficient_table(spark: SparkSession, fit: LinearFit, name: str) -> DataFrame:
    return small_table(spark, coefficient_rows(fit, name), S.COEFFICIENT_SCHEMA)
