"""Least squares by orthogonal triangles, for features that are almost linear combinations of each other.

Moments square the condition number: directions below a few 1e-5 of the largest are lost in rounding and
must be taken for exact combinations. Here every Arrow batch is reduced to the triangle of its QR
decomposition, a task folds its batches into one triangle per group, and triangles are merged in a tree
of shuffles. A triangle has as many rows as columns, whatever the rows behind it, and the triangles of
disjoint rows add up like moments, so one pass serves all folds, fractions and splits.

The first column is constant. Below its row stands the triangle of the columns around the group's own means.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

FAN = 32  # triangles that one merge takes in
LEVELS = 3  # merges; the last takes one triangle per FAN ** (LEVELS - 1) tasks
# Singular values below this share of the largest are exact linear combinations.
RANK = 1e-12


def triangle(rows: np.ndarray) -> np.ndarray:
    """The upper triangle of ``rows``; square, with zero rows where there are too few."""
    width = rows.shape[1]
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((width - len(r), width))]) if len(r) < width else r


@dataclass(frozen=True)
class Triangle:
    """The triangle of (constant, features, label) over one set of rows; ``+`` joins disjoint sets."""

    r: np.ndarray

    def __add__(self, other: Triangle) -> Triangle:
        return Triangle(triangle(np.vstack([self.r, other.r])))

    @property
    def n(self) -> float:
        return float(round(self.r[0, 0] ** 2))

    @property
    def means(self) -> np.ndarray:
        return self.r[0, 1:] / self.r[0, 0]

    @property
    def centred(self) -> np.ndarray:
        return self.r[1:, 1:]

    def weights(self, live: Sequence[int]) -> np.ndarray:
        """Of the best weights in standardised features the smallest; 0 for columns not in ``live``."""
        k = self.centred.shape[1] - 1
        w = np.zeros(k)
        a, b = self.centred[:, list(live)], self.centred[:, k]
        norms = np.sqrt((a * a).sum(0))
        if len(live) and (norms > 0).all():
            w[list(live)] = np.linalg.lstsq(a / norms, b, rcond=RANK)[0] / norms
        return w

    def squared_error(self, w: np.ndarray, bias: float) -> float:
        """Of label - features w on the rows behind, whose mean error is ``bias``."""
        return float(((self.centred @ np.append(-w, 1.0)) ** 2).sum() + self.n * bias * bias)


def total(parts: Iterable[Triangle]) -> Triangle | None:
    """Sum of the parts; None if there are none."""
    stacked = [p.r for p in parts]
    return Triangle(triangle(np.vstack(stacked))) if stacked else None


def triangles_by(df: DataFrame, columns: Sequence[str], by: Sequence[str], shift: Mapping[str, float]) -> DataFrame:
    """(by..., r array<double>): the triangle of (constant, columns) per group, row by row.

    ``shift``, usually ``column_means``, is subtracted first; rows with a NULL are left out. The group count
    must be small and known, as for split x fold x fraction.
    """
    width = len(columns) + 1
    values = [(F.col(c).cast("double") - F.lit(float(shift.get(c, 0.0)))).alias(f"x_{i}") for i, c in enumerate(columns)]
    rows = df.na.drop(subset=list(columns)).select(*by, *values)
    kinds, named = dict(rows.dtypes), to_arrow_schema(rows.select(*by).schema)
    schema = ", ".join([*(f"`{b}` {kinds[b]}" for b in by), "task bigint", "r array<double>"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple, np.ndarray] = {}
        for batch in batches:
            x = np.column_stack([np.ones(batch.num_rows), *(batch.column(f"x_{i}").to_numpy(zero_copy_only=False) for i in range(width - 1))])
            code, names = np.zeros(batch.num_rows, np.int64), [()]
            for b in by:
                values = pc.dictionary_encode(batch.column(b), null_encoding="encode")
                own = values.dictionary.to_pylist()
                code = code * len(own) + values.indices.to_numpy(zero_copy_only=False)
                names = [(*n, v) for n in names for v in own]
            for c in np.unique(code):
                parts = [x[code == c], *([kept[names[c]]] if names[c] in kept else [])]
                kept[names[c]] = triangle(np.vstack(parts))
        task = TaskContext.get().partitionId()
        arrays = [pa.array([k[i] for k in kept], named.field(b).type) for i, b in enumerate(by)]
        arrays += [pa.array([task] * len(kept), pa.int64()), pa.array([t.ravel().tolist() for t in kept.values()], pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(arrays, [*by, "task", "r"])

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        parts = np.vstack([np.array(r).reshape(width, width) for r in table.column("r").to_pylist()])
        names = [*by, "task"]
        columns_ = {n: table.column(n).slice(0, 1) for n in names}
        return pa.table({**columns_, "r": pa.array([triangle(parts).ravel().tolist()], pa.list_(pa.float64()))})

    found = rows.mapInArrow(fold, schema)
    for _ in range(LEVELS):
        found = found.withColumn("task", F.floor(F.col("task") / FAN)).groupBy(*by, "task").applyInArrow(merge, schema)
    return found.groupBy(*by).applyInArrow(merge, schema).select(*by, "r")


def from_row(row: Mapping) -> Triangle:
    side = int(round(len(row["r"]) ** 0.5))
    return Triangle(np.array(row["r"]).reshape(side, side))
