"""Grid search by MLlib fits: hash folds, concurrent fits, one scoring pass per fold."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar import schema as S
from isobar.operators import features as feat
from isobar.operators import forest, split
from isobar.operators.metrics import r2_of, rmse_of
from isobar.operators.results import small_table
from isobar.session import delete_path, scratch_path

SEED = 42
# Every level of every tree is a job with a task per partition: smaller partitions cost more to start than to read.
ROWS_PER_TASK = 1 << 16
# MLlib's forest draws rows by partition; tables of so few partitions keep their draws.
OWN_LAYOUT = 8
FAMILIES = {
    "lr": LinearRegression,
    "dt": DecisionTreeRegressor,
    "rf": RandomForestRegressor,
    "gbt": GBTRegressor,
}
# A forest whose draws are hashes of the rows' keys; the same on any partitioning.
HASHED = "hf"
# Families that add trees one by one, and the parameter that counts them.
COUNTED = {"gbt": "maxIter", HASHED: "numTrees"}
# The default grids and model names.
GRIDS = {
    "lr": {"regParam": [0.0, 0.01, 0.1], "elasticNetParam": [0.0, 0.5, 1.0]},
    "dt": {"maxDepth": [4, 6], "maxBins": [32, 64]},
    "rf": {"maxDepth": [6, 12], "numTrees": [20, 50]},
    "gbt": {"maxDepth": [4, 6], "maxIter": [30, 50]},
    "hf": {"maxDepth": [6, 12], "numTrees": [20, 50]},
}
MODEL_NAMES = {
    "lr": "LinearRegression_Tuned",
    "dt": "DecisionTree_Tuned",
    "rf": "RandomForest_Tuned",
    "gbt": "GBT_Tuned",
    "hf": "HashedForest_Tuned",
}
TREE_FRACTIONS = [0.1, 0.25, 0.5, 0.75, 1.0]


def expand_grid(grid: Mapping[str, Sequence]) -> list[dict]:
    """Every combination of the listed values, the last parameter varying fastest."""
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def best_setting(settings: Sequence[dict], scores: Sequence[float | None]) -> dict:
    """The setting with the lowest score; the earliest of equals."""
    scored = [i for i, s in enumerate(scores) if s is not None]
    return settings[min(scored, key=lambda i: scores[i])] if scored else settings[0]


def estimator(family: str, params: Mapping, **fixed):
    seed = {} if family == "lr" else {"seed": SEED}
    return FAMILIES[family](featuresCol="features", labelCol="label", **seed, **fixed, **params)


@dataclass
class FitStudy:
    name: str
    model: PipelineModel
    best: dict
    cv_rows: list[tuple]
    curve_rows: list[tuple]
    test_rmse: float | None
    test_r2: float | None
    features: list[str]


def score_by_split(model, df: DataFrame) -> dict:
    """{split: (rmse, r2)} from one aggregate over the scored rows."""
    rows = (
        model.transform(df).groupBy("split")
        .agg(rmse_of("label", "prediction").alias("rmse"), r2_of("label", "prediction").alias("r2"),
             F.count(F.lit(1)).alias("n"))
        .collect()
    )
    return {r["split"]: (r["rmse"], r["r2"], r["n"]) for r in rows}


def fit_groups(family: str, settings: Sequence[dict]) -> list[list[int]]:
    """Settings that one fit serves. Boosting and the hashed forest add trees one by one, so settings
    that differ in their number only are prefixes of the longest."""
    if family not in COUNTED:
        return [[i] for i in range(len(settings))]
    groups: dict[tuple, list[int]] = {}
    for i, s in enumerate(settings):
        groups.setdefault(tuple(sorted((k, v) for k, v in s.items() if k != COUNTED[family])), []).append(i)
    return list(groups.values())


def hashed_fit(train: DataFrame, keys: Sequence[str], features: Sequence[str], setting: Mapping, options: Mapping) -> forest.HashedForest:
    trees, depth, bins = setting.get("numTrees", 20), setting.get("maxDepth", 5), setting.get("maxBins", 32)
    return forest.fit_forest(train, keys, features, trees=trees, depth=depth, bins=bins, seed=SEED, options=options)


def hashed_scores(
    settings: Sequence[dict], members: list[int], train: DataFrame, held: DataFrame, keys: Sequence[str],
    features: Sequence[str], options: Mapping,
) -> dict[int, float]:
    """RMSE on ``held`` of each setting of a group: prefixes of one forest."""
    longest = max((settings[i] for i in members), key=lambda s: s.get("numTrees", 20))
    grown = hashed_fit(train, keys, features, longest, options)
    return {
        i: grown.model(settings[i].get("numTrees", 20)).transform(held).agg(rmse_of("label", "prediction").alias("r")).first()["r"]
        for i in members
    }


def group_scores(
    family: str, settings: Sequence[dict], members: list[int], train: DataFrame, held: DataFrame,
    options: Mapping | None = None,
) -> dict[int, float]:
    """RMSE on ``held`` of each setting of a group, from one fit on ``train``."""
    options = options or {}
    if family == "gbt":
        longest = max((settings[i] for i in members), key=lambda s: s.get("maxIter", 20))
        errors = estimator(family, longest, **options).fit(train).evaluateEachIteration(held, "squared")
        return {i: errors[settings[i].get("maxIter", 20) - 1] ** 0.5 for i in members}
    scores = {}
    for i in members:
        model = estimator(family, settings[i], **options).fit(train)
        scores[i] = model.transform(held).agg(rmse_of("label", "prediction").alias("r")).first()["r"]
    return scores


@contextmanager
def kept_for_fits(table: DataFrame, least: int = 1, rows_per_task: int = ROWS_PER_TASK) -> Iterator[DataFrame]:
    """``table`` written once, read back and persisted, in no more partitions than its rows need.

    A fit is hundreds of short jobs. Their tasks carry the plan behind the persisted rows, which ends at a scan here
    instead of holding the whole cleaning job, and there are as many as there are rows for, not as
    many as the shuffle that made the table had. Neighbouring partitions are put together and rows keep
    their order, so the same table is laid out alike each time; ``least`` partitions or fewer stay as they are.
    """
    spark, seen, at = table.sparkSession, Observation(), split.unused(table, "_at")
    path = scratch_path(spark, "fits")
    kept, source = None, table.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        partition = F.shiftright(at, 33)
        source.withColumn(at, F.monotonically_increasing_id()).observe(
            seen, F.count(F.lit(1)).alias("rows"), F.max(partition).alias("last")
        ).write.parquet(path)
        source.unpersist()
        found = (seen.get["last"] or 0) + 1
        count = min(found, max(least, math.ceil(seen.get["rows"] / rows_per_task)))
        placed = F.floor(partition * count / found).cast("int")
        back = spark.read.schema(T.StructType([*table.schema, T.StructField(at, T.LongType())])).parquet(path)
        kept = back.repartitionById(count, placed).sortWithinPartitions(at).drop(at).persist(StorageLevel.MEMORY_AND_DISK)
        yield kept
    finally:
        source.unpersist()
        if kept is not None:
            kept.unpersist()
        delete_path(spark, path)


def tune_by_fits(
    df: DataFrame, keys: Sequence[str], family: str, features: Sequence[str],
    label: str = S.LABEL, grid: Mapping[str, list] | None = None, folds: int = 3,
    fractions: Sequence[float] = TREE_FRACTIONS, scale: bool = False, parallelism: int = 8,
    name: str | None = None, options: Mapping | None = None,
) -> FitStudy:
    """Grid search, refit, test score and learning curve of a table with a ``split`` column.

    Takes any family; linear models are better served by ``linear.tune_linear``. ``hf`` is the forest
    of ``forest.fit_forest``: the same model on any partitioning, its scores by prefix. Trees do not
    change when features are scaled, so ``scale`` is off unless a saved pipeline has to contain
    the scaler. Folds and curve samples are hash filters on the one table kept for the fits; nothing is
    reshuffled or copied per fold. All pairs of a fold and a setting go through one pool of
    ``parallelism`` fits, the refit and the points of the curve through the same afterwards; each
    running fit keeps a binned copy of its rows inside MLlib. ``options`` go to every estimator,
    e.g. ``maxMemoryInMB`` or ``cacheNodeIds`` for deep trees on large data.
    """
    name, options = name or MODEL_NAMES[family], dict(options or {})
    settings = expand_grid(grid or GRIDS[family])
    fractions = sorted(fractions)
    named = [f"_key_{i}" for i in range(len(keys))] if family == HASHED else []
    table = df.na.drop(subset=[*features, label]).select(
        "split", split.fold_number(keys, folds).alias("fold"),
        F.coalesce(split.fraction_index(keys, fractions), F.lit(len(fractions))).alias("part"),
        *features, F.col(label).cast("double").alias("label"), *[F.col(k).cast("string").alias(n) for n, k in zip(named, keys)],
    )
    stages = feat.feature_stages(features, scale)
    with kept_for_fits(table, OWN_LAYOUT if family == "rf" else 1) as table:
        with ThreadPool(parallelism) as pool:
            def at_once(fn, tasks: list) -> list:
                return pool.map(inheritable_thread_target(df.sparkSession)(fn), tasks, chunksize=1)

            train = table.filter(F.col("split") == "train")
            rows = train if named else feat.assemble_features(train, features).select("fold", "features", "label")
            counts = {r["fold"]: r["count"] for r in train.groupBy("fold").count().collect()}
            averages: list[float | None] = [None] * len(settings)
            if len(settings) > 1 and len(counts) > 1:
                # Large settings first, so that none starts when the others have ended.
                tasks = [(i, g) for g in reversed(fit_groups(family, settings)) for i in sorted(counts)]

                def score(task: tuple[int, list[int]]) -> dict[int, float]:
                    fold, members = task
                    apart = F.col("fold") == fold
                    if named:
                        return hashed_scores(settings, members, rows.filter(~apart), rows.filter(apart), named, features, options)
                    return group_scores(family, settings, members, rows.filter(~apart), rows.filter(apart), options)

                found = at_once(score, tasks)
                for i in range(len(settings)):
                    own = [s[i] for s in found if i in s]
                    averages[i] = sum(own) / len(own)
            best = best_setting(settings, averages)
            cv_rows = [
                (name, i, {k: str(v) for k, v in s.items()}, averages[i]) for i, s in enumerate(settings)
            ]

            # Point None is the whole training set: the model itself.
            def point(i: int | None):
                part = train if i is None else train.filter(F.col("part") <= i)
                if part.isEmpty():
                    return None
                if named:
                    fitted = hashed_fit(part, named, features, best, options).model()
                else:
                    fitted = Pipeline(stages=[*stages, estimator(family, best, **options)]).fit(part)
                seen = table if i is None else table.filter((F.col("split") == "test") | (F.col("part") <= i))
                return fitted, score_by_split(fitted, seen)

            points = [None, *[i for i, f in enumerate(fractions) if f < 1.0]]
            done = dict(zip(points, at_once(point, points)))
    if done[None] is None:
        raise ValueError("no training rows")
    model, scores = done[None]
    curve = []
    for i, fraction in enumerate(fractions):
        found_point = done[None if fraction >= 1.0 else i]
        if found_point is None:
            continue
        tr, te = (found_point[1].get(k, (None, None, 0)) for k in ("train", "test"))
        curve.append((name, float(fraction), int(tr[2]), tr[0], te[0], te[1]))
    test = scores.get("test", (None, None, 0))
    return FitStudy(name, model, best, cv_rows, curve, test[0], test[1], list(features))


def importance_rows(study: FitStudy) -> list[tuple]:
    last = study.model.stages[-1]
    weights = last.featureImportances.toArray() if hasattr(last, "featureImportances") else forest.importances_of(study.model, study.features)
    rows = [(study.name, f, float(w)) for f, w in zip(study.features, weights)]
    return sorted(rows, key=lambda r: -r[2])


def importance_table(spark: SparkSession, study: FitStudy) -> DataFrame:
    return small_table(spark, importance_rows(study), S.IMPORTANCE_SCHEMA)
