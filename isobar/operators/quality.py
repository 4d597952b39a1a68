"""Data-quality tables: the row funnel and the column profile, one pass each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar import schema as S
from isobar.functions.times import parse_time
from isobar.operators.clean import all_present, in_ranges, parse_packed


def quality_funnel(raw: DataFrame, tie: str | None = None, required: Sequence[str] = ("TMP", "DATE")) -> DataFrame:
    """Rows left after each cleaning step, as (step_idx, step, n_rows, n_dropped).

    One aggregate per (STATION, DATE) of fixed-width counters, combined before the
    shuffle, then one global sum; no step is counted by a job of its own. The survivor
    of a key is the valid row with the smallest ``tie``, or without one the first by all
    measurements, as in ``clean.dedupe_keyed``.
    """
    marked = raw.select(*([tie] if tie else []), *S.RAW_COLUMNS).withColumn("_required", all_present(required))
    keep = F.col("_required") & F.col("_valid")
    measured = [c for c in S.FEATURES_ALL if c not in ("HOUR", "MONTH", "DAY_OF_YEAR")]
    parsed = parse_packed(marked)
    rest = [c for c in parsed.columns if c not in (*S.KEY, "_required")]
    order = F.col(tie) if tie else F.struct(*rest)
    flags = parsed.select(
        *S.KEY,
        order.alias("_tie"),
        "_required",
        in_ranges().alias("_valid"),
        all_present(["STATION", *measured, S.LABEL]).alias("_complete"),
    )
    per_key = flags.groupBy(*S.KEY).agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if("_required").alias("required"),
        F.count_if(keep).alias("valid"),
        F.min_by("_complete", F.when(keep, F.col("_tie"))).alias("complete"),
    )
    present = F.col("valid") > 0
    on_hour = present & (F.minute(parse_time("DATE")) == 0)
    total = per_key.agg(
        F.coalesce(F.sum("raw"), F.lit(0)).alias("raw"),
        F.coalesce(F.sum("required"), F.lit(0)).alias("required"),
        F.coalesce(F.sum("valid"), F.lit(0)).alias("valid"),
        F.count_if(present).alias("deduplicated"),
        F.count_if(on_hour).alias("on_the_hour"),
        F.count_if(on_hour & F.col("complete")).alias("complete"),
    )
    steps = ["raw", "required", "valid", "deduplicated", "on_the_hour", "complete"]
    rows = [
        F.struct(
            F.lit(i).alias("step_idx"),
            F.lit(s).alias("step"),
            F.col(s).alias("n_rows"),
            (F.col(steps[max(i - 1, 0)]) - F.col(s)).alias("n_dropped"),
        )
        for i, s in enumerate(steps)
    ]
    return total.select(F.inline(F.array(*rows)))


def feature_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count, minimum and maximum of numeric columns, one row per column."""
    wide = df.agg(*[
        F.struct(
            F.lit(c).alias("feature"),
            F.count_if(F.col(c).isNull()).alias("n_nulls"),
            F.min(F.col(c).cast("double")).alias("min_value"),
            F.max(F.col(c).cast("double")).alias("max_value"),
        ).alias(c)
        for c in columns
    ])
    return wide.select(F.inline(F.array(*[F.col(c) for c in columns])))
