"""A random forest that is the same on any partitioning: every draw is a hash of a row's key.

A bootstrap draws each row a Poisson(1) number of times; here the number is read off the row's hash,
salted by the tree, and given to MLlib's tree as a weight. A tree sees its own third of the
features, chosen by a hash of tree and name. Trees are fitted side by side on one persisted table
and saved as one ordinary pipeline.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.functions.hashing import row_hash
from isobar.operators import features as feat

RANGE = 1 << 32  # of a row's hash


def poisson_steps(mean: float = 1.0) -> list[int]:
    """Hash values from which a row is drawn once, twice, and so on."""
    steps, chance, below = [], math.exp(-mean), 0.0
    while True:
        below += chance
        step = math.floor(below * RANGE)
        if step >= RANGE - 1:
            return steps
        steps.append(step)
        chance *= mean / len(steps)


def bootstrap_weight(keys: Sequence[str], tree: int, salt: str = "forest") -> Column:
    """How often tree number ``tree`` draws the row."""
    return draws_of(row_hash(keys, f"{salt}-{tree}"))


def draws_of(drawn: Column) -> Column:
    return sum((F.when(drawn >= step, 1.0).otherwise(0.0) for step in poisson_steps()), F.lit(0.0))


def bootstrap_rows(df: DataFrame, keys: Sequence[str], tree: int, salt: str = "forest") -> DataFrame:
    """The rows that tree number ``tree`` draws, how often as ``_draws``.

    The hash comes out of a one-element inline(): through a projection Catalyst would copy it into the
    filter, once per step, and every pass over the rows would hash each of them a dozen times.
    """
    drawn = F.inline(F.array(F.struct(row_hash(keys, f"{salt}-{tree}").alias("_drawn"))))
    hashed = df.select("*", drawn).filter(F.col("_drawn") >= poisson_steps()[0])
    return hashed.withColumn("_draws", draws_of(F.col("_drawn"))).drop("_drawn")


def feature_subset(features: Sequence[str], tree: int, salt: str = "forest", share: float = 1 / 3) -> list[str]:
    """The features of a tree, in their given order."""
    count = max(1, math.ceil(len(features) * share - 1e-9))
    rank = lambda f: (hashlib.md5(f"{salt}|{tree}|{f}".encode()).hexdigest()[:8], f)
    chosen = set(sorted(features, key=rank)[:count])
    return [f for f in features if f in chosen]


@dataclass
class HashedForest:
    trees: list
    subsets: list[list[str]]

    def model(self, count: int | None = None) -> PipelineModel:
        """The mean of the first ``count`` trees (all) as ``prediction``."""
        count = count or len(self.trees)
        stages = []
        for t in range(count):
            stages += [feat.assembler(self.subsets[t], f"_features_{t}"), self.trees[t]]
        mean = " + ".join(f"_prediction_{t}" for t in range(count))
        hidden = ", ".join(f"_features_{t}, _prediction_{t}" for t in range(count))
        stages.append(SQLTransformer(statement=f"SELECT * EXCEPT ({hidden}), ({mean}) / {count}D AS prediction FROM __THIS__"))
        return PipelineModel(stages)


def importances_of(model: PipelineModel, features: Sequence[str]) -> list[float]:
    """Each feature's share of the trees' gains, every tree counting the same; they sum to 1."""
    total = dict.fromkeys(features, 0.0)
    for vector, tree in zip(model.stages[:-1:2], model.stages[1:-1:2]):
        for name, gain in zip(vector.getInputCols(), tree.featureImportances.toArray()):
            total[name] += float(gain)
    norm = sum(total.values())
    return [total[f] / norm if norm else 0.0 for f in features]


def fit_forest(
    df: DataFrame, keys: Sequence[str], features: Sequence[str], label: str = "label", trees: int = 20, depth: int = 6,
    bins: int = 32, salt: str = "forest", seed: int = 42, parallelism: int = 4, options: Mapping | None = None,
) -> HashedForest:
    """``trees`` trees on the rows of ``df``, which should be persisted; their mean is ``prediction``.

    ``keys`` identify a row: rows with equal keys are drawn alike.
    """
    subsets = [feature_subset(features, t, salt) for t in range(trees)]

    def grow(t: int):
        rows = bootstrap_rows(df, keys, t, salt)
        vectors = feat.assembler(subsets[t], f"_features_{t}").transform(rows).select(f"_features_{t}", label, "_draws")
        learner = DecisionTreeRegressor(
            featuresCol=f"_features_{t}", labelCol=label, weightCol="_draws", predictionCol=f"_prediction_{t}",
            maxDepth=depth, maxBins=bins, seed=seed, **(options or {}),
        )
        return learner.fit(vectors)

    with ThreadPool(min(parallelism, trees)) as pool:
        grown = pool.map(inheritable_thread_target(df.sparkSession)(grow), range(trees), chunksize=1)
    return HashedForest(grown, subsets)
