"""First and second moments of features and label: one aggregate for many linear fits.

Least squares needs only n, sums and cross products. Grouped by split, fold and sample
fraction they are additive, so every fold and every learning-curve point comes out of a
single pass over the rows. The products are taken around the columns' means, found in a
cheap pass of its own: around zero, columns with a large mean would lose their digits.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Means over the rows that have all columns; 0 if there are none."""
    row = df.na.drop(subset=list(columns)).agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(columns)]).first()
    return {c: float(row[f"m_{i}"] or 0.0) for i, c in enumerate(columns)}


def moments_by(
    df: DataFrame, columns: Sequence[str], by: Sequence[str], shift: Mapping[str, float] | None = None
) -> DataFrame:
    """Per group: ``n``, ``s_i`` (sums), ``l_i``, ``h_i`` (extremes), ``p_i_j`` (cross products, i <= j).

    ``shift``, usually ``column_means``, is subtracted from the columns first. The group count must be small and
    known, as for split x fold x fraction: each group is one row of the result.
    """
    shift = shift or {}
    x = [F.col(c).cast("double") - F.lit(float(shift.get(c, 0.0))) for c in columns]
    width = range(len(columns))
    centred = df.na.drop(subset=list(columns)).select(*by, *[v.alias(f"x_{i}") for i, v in enumerate(x)])
    # As SQL text: one call to the JVM per aggregate instead of six.
    return centred.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.expr(f"sum(x_{i}) AS s_{i}") for i in width],
        *[F.expr(f"min(x_{i}) AS l_{i}") for i in width],
        *[F.expr(f"max(x_{i}) AS h_{i}") for i in width],
        *[F.expr(f"sum(x_{i} * x_{j}) AS p_{i}_{j}") for i in width for j in width if i <= j],
    )


@dataclass(frozen=True)
class Moments:
    """Moments of one set of rows; ``+`` joins disjoint sets."""

    n: float
    sums: np.ndarray
    products: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(
            self.n + other.n, self.sums + other.sums, self.products + other.products,
            np.minimum(self.low, other.low), np.maximum(self.high, other.high),
        )

    def take(self, columns: Sequence[int]) -> Moments:
        """Moments of some of the columns, in the given order."""
        return Moments(
            self.n, self.sums[columns], self.products[np.ix_(columns, columns)], self.low[columns], self.high[columns]
        )

    @property
    def means(self) -> np.ndarray:
        return self.sums / self.n

    @property
    def covariance(self) -> np.ndarray:
        """Population covariance; exactly 0 for a constant column."""
        cov = self.products / self.n - np.outer(self.means, self.means)
        constant = self.low == self.high
        cov[constant, :] = 0.0
        cov[:, constant] = 0.0
        return cov


def from_row(row: Mapping, width: int) -> Moments:
    p = np.zeros((width, width))
    for i in range(width):
        for j in range(i, width):
            p[i, j] = p[j, i] = row[f"p_{i}_{j}"]
    sums, low, high = (np.array([row[f"{k}_{i}"] for i in range(width)]) for k in "slh")
    return Moments(float(row["n"]), sums, p, low, high)


def total(parts: Iterable[Moments]) -> Moments | None:
    """Sum of the parts; None if there are none."""
    result = None
    for part in parts:
        result = part if result is None else result + part
    return result
