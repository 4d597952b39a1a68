"""Selecting, parsing, validating and de-duplicating observations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar import schema as S
from isobar.functions import packed as P


def select_existing(df: DataFrame, wanted: Sequence[str], fill_missing: bool = False):
    """The wanted columns that exist, and the list of those that do not.

    With ``fill_missing`` the absent ones come back as NULL strings.
    """
    missing = [c for c in wanted if c not in df.columns]
    cols = [F.col(c) for c in wanted if c in df.columns]
    if fill_missing:
        cols = [F.lit(None).cast("string").alias(c) if c in missing else F.col(c) for c in wanted]
    return df.select(cols), missing


def strip_whitespace(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.withColumns({c: P.strip_whitespace(c) for c in (columns or df.columns)})


def cast_double(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text that is not a number becomes NULL, never an error."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def filter_required(df: DataFrame, columns: Sequence[str] = ("TMP", "DATE")) -> DataFrame:
    return df.filter(all_present(columns))


def filter_any_present(df: DataFrame, columns: Sequence[str] = tuple(S.MEASUREMENTS)) -> DataFrame:
    return df.filter(F.coalesce(*[F.col(c) for c in columns]).isNotNull())


def all_present(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


# Raw columns that each measurement is read from.
SOURCES = {
    "WIND_DIR": ("WND",), "WIND_SPEED": ("WND",), "TMP_C": ("TMP",), "DEW_C": ("DEW",), "SLP_HPA": ("SLP",),
    "PRECIP_MM": ("AA1",), "RH_PCT": ("TMP", "DEW"), "VIS_M": ("VIS",),
}


def parse_packed(df: DataFrame, precip_index: int = 0, fields: Sequence[str] = tuple(SOURCES)) -> DataFrame:
    """Replace the packed columns by the asked-for measurements; coordinates become doubles.

    Only the sources of ``fields`` are read. ``precip_index=0`` divides the first part of AA1 by
    ten, as existing users of this data do; ``precip_index=1`` reads the liquid depth itself.
    """
    fields = list(fields)
    if unknown := [f for f in fields if f not in SOURCES]:
        raise ValueError(f"no such measurements: {unknown}")
    coordinates = [c for c in S.COORDINATES if c in df.columns]
    texts = {
        "_DIR": ("WIND_DIR", lambda: P.direction_text("WND")), "_SPEED": ("WIND_SPEED", lambda: P.speed_text("WND")),
        "_TMP": ("TMP_C", lambda: P.numeric_text("TMP")), "_DEW": ("DEW_C", lambda: P.numeric_text("DEW")),
        "_SLP": ("SLP_HPA", lambda: P.numeric_text("SLP")), "_PRECIP": ("PRECIP_MM", lambda: P.numeric_text("AA1", precip_index)),
        "_VIS": ("VIS_M", lambda: P.visibility_text("VIS")),
    }
    readers = {
        "_DIR": P.wind_direction, "_SPEED": P.wind_speed, "_TMP": P.scaled, "_DEW": P.scaled, "_SLP": P.scaled,
        "_PRECIP": P.scaled, "_VIS": P.visibility,
    }
    needed = set(fields)
    if "RH_PCT" in needed:
        needed |= {"TMP_C", "DEW_C"}
    if "WIND_DIR" in needed:
        needed.add("WIND_SPEED")
    packed = sorted({c for f in needed for c in SOURCES[f]}, key=S.PACKED.index)
    text = df.withColumns({c: P.strip_whitespace(c) for c in [*packed, *coordinates, *[c for c in ["STATION"] if c in df.columns]]})
    others = [c for c in df.columns if c not in S.PACKED + S.COORDINATES]
    used = {t: named for t, (named, _) in texts.items() if named in needed}
    cut = text.select(*others, *coordinates, *[texts[t][1]().alias(t) for t in used])
    # The typed values come out of a one-element inline() rather than a projection: a
    # filter on them then stays above it. Through a projection Catalyst would copy the
    # whole parse of each field into the range filter, several times over for humidity,
    # until the generated code no longer fits a JVM method.
    # No filter looks at coordinates, so they stay outside and can be pruned.
    typed = F.struct(*[readers[t](t).alias("_DIR" if t == "_DIR" else named) for t, named in used.items()])
    places = [F.col(c).try_cast("double").alias(c) for c in coordinates]
    parsed = cut.select(*others, *places, F.inline(F.array(typed)))
    made = {}
    if "WIND_DIR" in needed:
        made["WIND_DIR"] = P.impute_direction("_DIR", "WIND_SPEED")
    if "RH_PCT" in needed:
        made["RH_PCT"] = P.relative_humidity("TMP_C", "DEW_C")
    parsed = parsed.withColumns(made) if made else parsed
    return parsed.drop("_DIR", *[f for f in needed if f not in fields])


def in_ranges(rules: Mapping[str, tuple[float, float]] = S.VALID_RANGES) -> Column:
    """True where every listed column is present and inside its closed interval."""
    return reduce(
        lambda a, b: a & b,
        [F.coalesce(F.col(c).between(lo, hi), F.lit(False)) for c, (lo, hi) in rules.items()],
    )


def range_validate(df: DataFrame, rules: Mapping[str, tuple[float, float]] = S.VALID_RANGES) -> DataFrame:
    return df.filter(reduce(
        lambda a, b: a & b, [F.col(c).between(lo, hi) for c, (lo, hi) in rules.items()]
    ))


def dedupe_keyed(
    df: DataFrame, keys: Sequence[str] = tuple(S.KEY), order_by: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the first by ``order_by``, by default by all other columns.

    The rank filter is applied in every map task before the shuffle as well, so a key
    holding a third of all rows still sends one row per task.
    """
    order = list(order_by) if order_by else [c for c in df.columns if c not in keys]
    if not order:
        return df.dropDuplicates(list(keys))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(subset) if subset else None)


def fill_nulls(df: DataFrame, value: float = 0.0, label: str = S.LABEL) -> DataFrame:
    """Fill the numeric columns other than the label."""
    return df.na.fill(value, subset=[c for c in df.columns if c != label])


def apply_null_policy(df: DataFrame, policy: str, required: Sequence[str], label: str = S.LABEL) -> DataFrame:
    if policy == "drop":
        return drop_nulls(df, list(required) + [label])
    if policy == "fill":
        return fill_nulls(df, 0.0, label)
    raise ValueError(f"null policy must be 'drop' or 'fill', not {policy!r}")
