"""Raw observations to the modelling table, as one lazy plan."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession

from isobar import schema as S
from isobar.operators import clean, features, results, split

log = logging.getLogger(__name__)
SCALE = "_deviations"


def parsed_observations(
    raw: DataFrame, keep: Sequence[str] = (), precip_index: int = 0, fields: Sequence[str] = tuple(clean.SOURCES)
) -> DataFrame:
    """The asked-for measurements of all rows with a temperature and a time."""
    existing, missing = clean.select_existing(raw, [*keep, *S.RAW_COLUMNS], fill_missing=True)
    if missing:
        log.warning("columns missing from the input, read as NULL: %s", ", ".join(missing))
    return clean.parse_packed(clean.filter_required(existing), precip_index, fields)


def check_ranges_readable(raw: DataFrame) -> None:
    """A column that a valid range needs must exist: without it no row would be left."""
    needed = sorted({c for f in S.VALID_RANGES for c in clean.SOURCES[f]})
    if absent := [c for c in needed if c not in raw.columns]:
        raise ValueError(f"the valid ranges need columns that the input lacks: {', '.join(absent)}")


def deduplicated(raw: DataFrame, tie: str | None = None, precip_index: int = 0) -> DataFrame:
    check_ranges_readable(raw)
    parsed = parsed_observations(raw, [tie] if tie else [], precip_index)
    return clean.dedupe_keyed(clean.range_validate(parsed), S.KEY, [tie] if tie else None)


def feature_table(raw: DataFrame, tie: str | None = None, precip_index: int = 0) -> DataFrame:
    """The modelling projection, rows with missing features still included."""
    hourly = features.hourly_rows(deduplicated(raw, tie, precip_index))
    return features.model_projection(features.calendar_features(hourly))


def model_table(raw: DataFrame, tie: str | None = None, precip_index: int = 0) -> DataFrame:
    # A row on the hour has a readable time, so its calendar parts cannot be NULL;
    # naming only the other columns keeps the null test free of repeated time parsing.
    calendar = ["DATE_HOUR", "HOUR", "MONTH", "DAY_OF_YEAR"]
    nullable = [c for c in S.MODEL_COLUMNS if c not in calendar]
    return clean.drop_nulls(feature_table(raw, tie, precip_index), nullable)


def write_split_table(raw: DataFrame, path: str, tie: str | None = None) -> None:
    """The modelling table with its train/test label, one parquet folder per split.

    The deviations of the features are observed while the rows are written and stored beside them,
    in a folder that readers of the table skip.
    """
    labelled, seen = split.train_test_split(model_table(raw, tie), S.MODEL_KEY), Observation()
    observed = labelled.observe(seen, *features.sample_deviations(S.FEATURES_ALL))
    observed.write.mode("overwrite").partitionBy("split").parquet(path)
    rows = [(c, seen.get[c]) for c in S.FEATURES_ALL]
    results.small_table(raw.sparkSession, rows, "feature string, deviation double").write.json(f"{path}/{SCALE}")


def stored_deviations(spark: SparkSession, path: str) -> dict[str, float | None]:
    """The sample deviations of the features of a split table, as they were observed when it was written."""
    rows = spark.read.schema("feature string, deviation double").json(f"{path}/{SCALE}").collect()
    return {r["feature"]: r["deviation"] for r in rows}
