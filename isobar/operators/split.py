"""Splits, samples and folds that depend on the row key only.

A seeded random draw changes with the partitioning; a hash of the key does not, costs no
shuffle, and gives the same answer after an executor is lost and its tasks are rerun.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.functions.hashing import bucket, row_hash
from isobar.session import scratch_path


BUCKETS = 1000


def _limit(fraction: float) -> int:
    """Number of buckets in a fraction, which must be a multiple of 1/1000."""
    buckets = round(fraction * BUCKETS)
    if abs(buckets - fraction * BUCKETS) > 1e-6:
        raise ValueError(f"fraction {fraction} is not a multiple of {1 / BUCKETS}")
    return buckets


def split_label(keys: Sequence[str], train: float = 0.7, salt: str = "split") -> Column:
    return F.when(bucket(keys, salt, BUCKETS) < _limit(train), F.lit("train")).otherwise(F.lit("test"))


def train_test_split(df: DataFrame, keys: Sequence[str], train: float = 0.7) -> DataFrame:
    return df.withColumn("split", split_label(keys, train))


def fold_number(keys: Sequence[str], folds: int = 3, salt: str = "fold") -> Column:
    return (row_hash(keys, salt) % F.lit(folds)).cast("int")


def kfold_assign(df: DataFrame, keys: Sequence[str], folds: int = 3) -> DataFrame:
    return df.withColumn("fold", fold_number(keys, folds))


def in_sample(keys: Sequence[str], fraction: float, salt: str = "sample") -> Column:
    return bucket(keys, salt, BUCKETS) < _limit(fraction)


def sample_fraction(df: DataFrame, keys: Sequence[str], fraction: float, salt: str = "sample") -> DataFrame:
    """Rows of the first ``fraction`` of the buckets; smaller fractions are subsets of larger."""
    return df.filter(in_sample(keys, fraction, salt))


def fraction_index(keys: Sequence[str], fractions: Sequence[float], salt: str = "sample") -> Column:
    """Index of the smallest fraction whose sample holds the row; NULL if none does."""
    b = bucket(keys, salt, BUCKETS)
    return F.coalesce(*[
        F.when(b < _limit(f), F.lit(i)) for i, f in enumerate(sorted(fractions))
    ])


def unused(df: DataFrame, name: str) -> str:
    """``name``, or with enough underscores that no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def sample_cut(
    df: DataFrame, order: Column, cap: int, by: Sequence[Column], names: Sequence[str], last: str, bits: int = 16
) -> DataFrame:
    """(names, last): per group the range of ``order`` (32 bits) that holds the ``cap``-th row; a written table.

    Rows are counted per group and range, combined map-side: at most 2^``bits`` counters per group
    leave a task and none of the rows' columns. Groups with fewer rows get their last range.
    """
    spark = df.sparkSession
    at, count, before = "range", "count", "before"
    counted = (
        df.select(*[c.alias(n) for c, n in zip(by, names)], F.shiftright(order, 32 - bits).alias(last))
        .groupBy(*names, last).agg(F.count(F.lit(1)).alias(count))
    )
    whole = F.struct(*names) if names else F.lit(0)
    earlier = Window.partitionBy(whole).orderBy(last).rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        counted.withColumn(before, F.coalesce(F.sum(count).over(earlier), F.lit(0))).filter(F.col(before) < cap)
        .groupBy(*names).agg(F.max(last).alias(at)).select(*names, F.col(at).alias(last))
    )
    path = scratch_path(spark, "cut")
    cut.write.parquet(path)
    return spark.read.parquet(path)


def capped_sample(
    df: DataFrame, keys: Sequence[str], fraction: float, cap: int, by: Sequence[str] = (),
    salt: str = "plot",
) -> DataFrame:
    """The fraction sample, and of it the ``cap`` rows per group that come first in hash order.

    A first pass finds each group's threshold of the hash (``sample_cut``), a second one filters by
    it: rows beyond it are never shuffled or ranked. The thresholds are a written table with
    one row per group, joined without a hint, so Catalyst sees how large it is. Behind the filter equal
    rows travel as one with a multiplicity, so copies cannot pile up in one task, and a boundary row
    is repeated only as often as the cap still allows.
    """
    cols = df.columns
    n, order, upto, sofar, take = (unused(df, c) for c in ("_n", "_hash", "_last", "_before", "_take"))
    names = [unused(df, f"_group_{i}") for i in range(len(by))]
    drawn = sample_fraction(df, keys, fraction, salt)
    hashed = row_hash(cols, salt)
    cut = sample_cut(drawn, hashed, cap, [F.col(c) for c in by], names, upto)
    marked = drawn.withColumn(order, hashed)
    same = [F.col(c).eqNullSafe(F.col(g)) for c, g in zip(by, names)]
    near = marked.join(cut, [*same, F.shiftright(order, 16) <= F.col(upto)]).select(*cols, order)
    distinct = near.groupBy(*cols, order).agg(F.count(F.lit(1)).alias(n))
    group = F.struct(*by) if by else F.lit(0)
    earlier = Window.partitionBy(group).orderBy(order, *cols).rowsBetween(Window.unboundedPreceding, -1)
    kept = (
        distinct.withColumn(sofar, F.coalesce(F.sum(n).over(earlier), F.lit(0)))
        .filter(F.col(sofar) < cap)
        .withColumn(take, F.least(F.col(n), F.lit(cap) - F.col(sofar)).cast("int"))
    )
    return kept.withColumn(n, F.explode(F.sequence(F.lit(1), F.col(take)))).select(*cols)
