"""Packed text fields: comma-separated parts with sentinel nines.

Each measurement is read in two steps. ``*_text`` cuts the digits out of the field with a
single regular expression that also rejects blanks, missing-value markers and malformed
numbers, and yields '' where there is nothing to read; ``number`` turns that text into a
double. Both are plain column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark's own cast also takes '1d', 'NaN' and 'Infinity'; this pattern does not.
UNSIGNED = r"(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
PART = "[^,]*,"
# Fixed rule: four or more nines, and nothing else, mark a missing measurement.
MISSING = r"9{4,}\+*(?:,|$)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_whitespace(c: Column | str) -> Column:
    """Drops the six blank characters of ASCII, wherever they stand."""
    return F.translate(_col(c), " \t\n\x0b\f\r", "")


def number(text: Column | str) -> Column:
    """Digits already cut out to double; '' and NULL to NULL."""
    t = _col(text)
    return F.when(t != "", t.try_cast("double"))


def numeric_text(c: Column | str, index: int = 0) -> Column:
    """Digits of part ``index`` with ``+`` signs stripped from both ends."""
    pattern = rf"^(?:{PART}){{{index}}}\+*(?!{MISSING})(-?{UNSIGNED})\+*(?:,|$)"
    return F.regexp_extract(_col(c), pattern, 1)


def direction_text(c: Column | str) -> Column:
    """Part 0 of a wind field that has at least five parts."""
    return F.regexp_extract(_col(c), rf"^([+-]?{UNSIGNED}),(?:{PART}){{3}}", 1)


def speed_text(c: Column | str) -> Column:
    """Part 3 of a wind field that has at least five parts."""
    return F.regexp_extract(_col(c), rf"^(?:{PART}){{3}}([+-]?{UNSIGNED}),", 1)


def visibility_text(c: Column | str) -> Column:
    return F.regexp_extract(_col(c), "^([0-9]+)(?:,|$)", 1)


def scaled(text: Column | str, scale: float = 10.0) -> Column:
    return number(text) / F.lit(float(scale))


def wind_direction(text: Column | str) -> Column:
    """Degrees; 999 is missing."""
    d = number(text)
    return F.when(d != 999, d)


def wind_speed(text: Column | str) -> Column:
    """Tenths to units; 999.9 and above is missing."""
    s = scaled(text)
    return F.when(s < 999.9, s)


def visibility(text: Column | str) -> Column:
    """Metres below the 99999 marker."""
    v = number(text)
    return F.when(v < 99999, v)


def packed_numeric(c: Column | str, scale: float = 10.0, index: int = 0) -> Column:
    return scaled(numeric_text(c, index), scale)


def packed_wind(c: Column | str) -> Column:
    """``struct<dir, speed>``."""
    return F.struct(
        wind_direction(direction_text(c)).alias("dir"),
        wind_speed(speed_text(c)).alias("speed"),
    )


def packed_visibility(c: Column | str) -> Column:
    return visibility(visibility_text(c))


def impute_direction(direction: Column | str, speed: Column | str) -> Column:
    """A missing direction with moving air becomes 0; calm or unknown air keeps NULL."""
    d, s = _col(direction), _col(speed)
    return F.when(d.isNull() & (s > 0), F.lit(0.0)).otherwise(d)


def relative_humidity(temp: Column | str, dew: Column | str) -> Column:
    """Magnus-form relative humidity in percent, NULL unless both inputs are present."""
    t, d = _col(temp), _col(dew)

    # The two constants of the Magnus form over water.
    def vapour(x: Column) -> Column:
        return F.exp((F.lit(17.625) * x) / (F.lit(243.04) + x))

    return F.when(t.isNotNull() & d.isNotNull(), F.lit(100) * (vapour(d) / vapour(t)))
