import random

import pytest
from pyspark.sql import functions as F

from isobar.functions import packed as P

WIND = [
    (None, (None, None)), ("", (None, None)), ("NULL", (None, None)), ("None", (None, None)),
    ("210,1,N,0046", (None, None)), ("999,9,V,0021,1", (None, 2.1)), ("999,9,C,0000,1", (None, 0.0)),
    ("210,1,N,9999,9", (210.0, None)), ("abc,1,N,0046,1", (None, 4.6)), ("210,1,N,0046,1,x", (210.0, 4.6)),
]
NUMERIC = [
    ("+0123,1", 12.3), ("-0089,1", -8.9), ("+9999,9", None), ("99999,9", None), ("-9999,9", -999.9),
    ("+999,9", 99.9), ("++12,1", 1.2), ("abc,1", None), (None, None), ("", None), ("1d,1", None),
    ("NaN,1", None), ("Infinity", None), ("12", 1.2), ("12+,1", 1.2), ("99990,1", 9999.0), ("NULL", None),
]
VISIBILITY = [
    ("016000,1,N,1", 16000.0), ("099999,1,N,1", None), ("999999,9,N,9", None), ("-1,1,N,1", None),
    ("abc", None), (None, None), ("12.5,1", None),
]


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr.alias("r")).collect()]


def test_wind_edges(spark):
    got = column(spark, [v for v, _ in WIND], P.packed_wind("v"))
    assert [(g["dir"], g["speed"]) for g in got] == [w for _, w in WIND]


def test_numeric_edges(spark):
    assert column(spark, [v for v, _ in NUMERIC], P.packed_numeric("v")) == [w for _, w in NUMERIC]


def test_visibility_edges(spark):
    assert column(spark, [v for v, _ in VISIBILITY], P.packed_visibility("v")) == [w for _, w in VISIBILITY]


def test_precip_index(spark):
    assert column(spark, ["01,0020,9,5"], P.packed_numeric("v")) == [0.1]
    assert column(spark, ["01,0020,9,5", "01"], P.packed_numeric("v", index=1)) == [2.0, None]


def test_fields_composed_from_known_values(spark):
    """Fields put together from numbers drawn first, so the right reading is known."""
    rng = random.Random(7)
    rows = []
    for i in range(2000):
        tenths, direction, speed, metres = rng.randint(-8999, 8999), rng.randint(0, 360), rng.randint(0, 900), rng.randint(0, 99_998)
        plus = "+" * rng.randint(0, 2) if tenths >= 0 else ""
        rows.append((
            i, f"{plus}{tenths},{rng.randint(0, 9)}", tenths / 10, f"{direction:03d},1,N,{speed:04d},1", float(direction),
            speed / 10, f"{metres:06d},1,N,1", float(metres), f"{rng.randint(1, 24):02d},{abs(tenths):04d},9,5", abs(tenths) / 10,
        ))
    df = spark.createDataFrame(
        rows, "i int, t string, tv double, w string, dv double, sv double, m string, mv double, a string, av double"
    )
    wind = P.packed_wind("w")
    got = df.filter(
        ~P.packed_numeric("t").eqNullSafe(F.col("tv")) | ~wind["dir"].eqNullSafe(F.col("dv"))
        | ~wind["speed"].eqNullSafe(F.col("sv")) | ~P.packed_visibility("m").eqNullSafe(F.col("mv"))
        | ~P.packed_numeric("a", index=1).eqNullSafe(F.col("av"))
    )
    assert got.collect() == []


def test_direction_imputation(spark):
    df = spark.createDataFrame(
        [(None, 2.1), (None, 0.0), (None, None), (90.0, 3.0)], "d double, s double"
    )
    got = [r[0] for r in df.select(P.impute_direction("d", "s")).collect()]
    assert got == [0.0, None, None, 90.0]


def test_humidity(spark):
    df = spark.createDataFrame([(10.0, 10.0), (None, 1.0), (1.0, None), (20.0, 10.0)], "t double, d double")
    got = [r[0] for r in df.select(P.relative_humidity("t", "d")).collect()]
    assert got[:3] == [100.0, None, None]
    assert got[3] == pytest.approx(52.5, abs=0.5)


def test_whitespace(spark):
    assert column(spark, [" 21 0,\t1\n", None], P.strip_whitespace("v")) == ["210,1", None]
    assert column(spark, ["x"], F.lit(None).cast("string")) == [None]
