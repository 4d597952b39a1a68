"""DuckDB SQL for the registered queries, written from the definitions of the operators.

Nothing here is shared with the Spark side but column lists: parsing, hashing, fits and
scores are all spelled out again in SQL.
"""

from __future__ import annotations

import math

from isobar import schema as S
from isobar.plans.registry import BOOST_GRID, FOREST_GRID, LEADERBOARD, TIE_FREE

ORACLE: dict[str, str] = {}
FRACTIONS = [0.1, 0.25, 0.5, 0.75, 1.0]

NUM = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"


def num(text: str) -> str:
    return f"(CASE WHEN regexp_full_match({text}, '{NUM}') THEN TRY_CAST({text} AS DOUBLE) END)"


def packed(col: str, index: int = 1) -> str:
    part = f"trim(split_part({col}, ',', {index}), '+')"
    return (f"(CASE WHEN {col} IS NULL OR {col} IN ('', 'NULL', 'None') THEN NULL "
            f"WHEN regexp_full_match({part}, '9{{4,}}') THEN NULL ELSE {num(part)} / 10.0e0 END)")


PARTS_OK = "len(string_split(WND, ',')) >= 5"
SPEED = f"{num('split_part(WND, chr(44), 4)')} / 10.0e0"
HUMIDITY = ("100 * (exp((17.625e0 * DEW_C) / (243.04e0 + DEW_C)) / exp((17.625e0 * TMP_C) / (243.04e0 + TMP_C)))")
IN_RANGE = " AND ".join(f"{c} BETWEEN {lo} AND {hi}" for c, (lo, hi) in S.VALID_RANGES.items())


def bucket(salt: str, *keys: str) -> str:
    text = " || '|' || ".join([f"'{salt}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def key_bucket(salt: str) -> str:
    return bucket(salt, "STATION", "DATE_HOUR")


def part_index(salt_bucket: str) -> str:
    cases = " ".join(f"WHEN {salt_bucket} % 1000 < {round(f * 1000)} THEN {i}" for i, f in enumerate(FRACTIONS))
    return f"CASE {cases} END"


CTES = [
    ("base", """
      SELECT event_id AS e, user_id % 20 AS u, CAST(ts AS VARCHAR(40)) AS s,
             (event_id * 71) % 700 - 200 AS t,
             (event_id * 71) % 700 - 200 + 10 - (event_id * 29) % 150 AS d
      FROM events"""),
    ("obs", """
      SELECT e AS obs_id, 'S' || lpad(CAST(u AS VARCHAR(9)), 3, '0') AS STATION,
        substr(s, 1, 10) || 'T' || substr(s, 12, 2) || ':'
          || CASE WHEN e % 4 <> 3 THEN '00' ELSE substr(s, 15, 2) END || ':00' AS DATE,
        CAST(u * 4.5e0 - 40.0e0 AS VARCHAR) AS LATITUDE,
        CAST(u * 17.5e0 - 170.0e0 AS VARCHAR) AS LONGITUDE,
        CAST(u * 60.5e0 AS VARCHAR) AS ELEVATION,
        CASE WHEN e % 7 = 0 THEN '999,9,V,0021,1' WHEN e % 29 = 0 THEN '999,9,C,0000,1'
             WHEN e % 17 = 0 THEN '210,1,N,9999,9'
             ELSE lpad(CAST((e * 37) % 361 AS VARCHAR(9)), 3, '0') || ',1,N,'
                  || lpad(CAST((e * 13) % 300 AS VARCHAR(9)), 4, '0') || ',1' END AS WND,
        CASE WHEN e % 13 = 0 THEN '+9999,9' ELSE CASE WHEN t < 0 THEN '-' ELSE '+' END
             || lpad(CAST(abs(t) AS VARCHAR(9)), 4, '0') || ',1' END AS TMP,
        CASE WHEN e % 31 = 0 THEN '+9999,9' ELSE CASE WHEN d < 0 THEN '-' ELSE '+' END
             || lpad(CAST(abs(d) AS VARCHAR(9)), 4, '0') || ',1' END AS DEW,
        CASE WHEN e % 19 = 0 THEN '99999,9'
             ELSE lpad(CAST(9500 + (e * 31) % 900 AS VARCHAR(9)), 5, '0') || ',1' END AS SLP,
        CASE WHEN e % 23 = 0 THEN '999999,9,N,9'
             ELSE lpad(CAST((e * 97) % 20000 AS VARCHAR(9)), 6, '0') || ',1,N,1' END AS VIS,
        CASE WHEN e % 5 = 0 THEN NULL
             ELSE lpad(CAST(1 + e % 24 AS VARCHAR(9)), 2, '0') || ','
                  || lpad(CAST((e * 7) % 200 AS VARCHAR(9)), 4, '0') || ',9,5' END AS AA1
      FROM base"""),
    ("read_fields", f"""
      SELECT obs_id, STATION, DATE,
        TRY_CAST(LATITUDE AS DOUBLE) AS LATITUDE, TRY_CAST(LONGITUDE AS DOUBLE) AS LONGITUDE,
        TRY_CAST(ELEVATION AS DOUBLE) AS ELEVATION,
        CASE WHEN {PARTS_OK} THEN nullif({num("split_part(WND, ',', 1)")}, 999.0) END AS WIND_DIR_READ,
        CASE WHEN {PARTS_OK} AND {SPEED} < 999.9 THEN {SPEED} END AS WIND_SPEED,
        {packed('TMP')} AS TMP_C, {packed('DEW')} AS DEW_C, {packed('SLP')} AS SLP_HPA,
        {packed('AA1')} AS PRECIP_MM, {packed('AA1', 2)} AS PRECIP_DEPTH_MM,
        CASE WHEN regexp_full_match(split_part(VIS, ',', 1), '[0-9]+')
              AND CAST(split_part(VIS, ',', 1) AS DOUBLE) < 99999
             THEN CAST(split_part(VIS, ',', 1) AS DOUBLE) END AS VIS_M
      FROM obs"""),
    ("parsed", f"""
      SELECT *, CASE WHEN WIND_DIR_READ IS NULL AND WIND_SPEED > 0 THEN 0.0e0 ELSE WIND_DIR_READ END AS WIND_DIR,
        {HUMIDITY} AS RH_PCT
      FROM read_fields"""),
    ("valid", f"SELECT * FROM parsed WHERE {IN_RANGE}"),
    ("dedup", """
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY STATION, DATE ORDER BY obs_id) AS rn FROM valid)
      WHERE rn = 1"""),
    ("timed", "SELECT *, CAST(DATE AS TIMESTAMP) AS DATETIME FROM dedup"),
    ("model_rows", """
      SELECT STATION, date_trunc('hour', DATETIME) AS DATE_HOUR,
        CAST(hour(DATETIME) AS INTEGER) AS HOUR, CAST(month(DATETIME) AS INTEGER) AS MONTH,
        CAST(dayofyear(DATETIME) AS INTEGER) AS DAY_OF_YEAR,
        LATITUDE, LONGITUDE, ELEVATION, WIND_DIR, WIND_SPEED, DEW_C, SLP_HPA, PRECIP_MM, RH_PCT, VIS_M, TMP_C
      FROM timed WHERE minute(DATETIME) = 0"""),
    ("model_tab", "SELECT * FROM model_rows WHERE "
        + " AND ".join(f"{c} IS NOT NULL" for c in S.MODEL_COLUMNS)),
    ("labelled", f"""
      SELECT *, CASE WHEN {key_bucket('split')} % 1000 < 700 THEN 'train' ELSE 'test' END AS split,
        CAST({key_bucket('fold')} % 3 AS INTEGER) AS fold, {part_index(key_bucket('sample'))} AS part
      FROM model_tab"""),
]


def with_ctes(last: str, body: str, extra: str = "") -> str:
    parts = []
    for name, sql in CTES:
        kind = "AS MATERIALIZED" if name in ("parsed", "labelled", "model_tab") else "AS"
        parts.append(f"{name} {kind} ({sql})")
        if name == last:
            break
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n" + body


def add(name: str, last: str, body: str, extra: str = "") -> None:
    ORACLE[name] = with_ctes(last, body, extra)


def r6(expr: str, digits: int = 6) -> str:
    return f"round({expr}, {digits})"


MODEL_LIST = ", ".join(r6(c) + f" AS {c}" if c == "RH_PCT" else c for c in S.MODEL_COLUMNS)

add("model_table", "model_tab", f"SELECT {MODEL_LIST} FROM model_tab")

# --- parsing --------------------------------------------------------------------------

add("strip_whitespace", "obs", "SELECT obs_id, WND, STATION FROM obs")
add("parse_wind", "parsed", "SELECT obs_id, WIND_DIR_READ, WIND_SPEED, WIND_DIR FROM parsed")
add("parse_numeric_fields", "parsed", "SELECT obs_id, TMP_C, DEW_C, SLP_HPA, PRECIP_MM FROM parsed")
add("parse_precip_depth", "parsed", "SELECT obs_id, PRECIP_DEPTH_MM FROM parsed")
add("parse_visibility", "parsed", "SELECT obs_id, VIS_M FROM parsed")
add("cast_coordinates", "parsed", "SELECT obs_id, LATITUDE, LONGITUDE, ELEVATION FROM parsed")

# --- cleaning -------------------------------------------------------------------------

MEASURED = ", ".join(f"{r6(c)} AS {c}" if c == "RH_PCT" else c for c in S.MEASUREMENTS)
add("select_existing", "obs", "SELECT obs_id, STATION, TMP, CAST(NULL AS VARCHAR) AS AA1 FROM obs")
add("filter_required", "obs", "SELECT obs_id, AA1 FROM obs WHERE AA1 IS NOT NULL AND DATE IS NOT NULL")
add("filter_any_present", "parsed",
    "SELECT obs_id, TMP_C, DEW_C FROM parsed WHERE TMP_C IS NOT NULL OR DEW_C IS NOT NULL")
add("range_validate", "valid", f"SELECT obs_id, STATION, DATE, {MEASURED} FROM valid")
add("drop_nulls", "parsed", f"SELECT obs_id, WIND_DIR, VIS_M, {MEASURED} FROM parsed WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in ["WIND_DIR", "VIS_M", *S.MEASUREMENTS]))
add("fill_nulls", "parsed", """
    SELECT obs_id, coalesce(WIND_DIR, 0.0) AS WIND_DIR, coalesce(VIS_M, 0.0) AS VIS_M,
           coalesce(DEW_C, 0.0) AS DEW_C, TMP_C FROM parsed""")
add("dedupe_keyed", "dedup", "SELECT STATION, DATE, obs_id, TMP_C FROM dedup")
add("quality_funnel", "model_tab", """
    SELECT CAST(i AS INTEGER) AS step_idx, step, n AS n_rows,
           coalesce(lag(n) OVER (ORDER BY i), n) - n AS n_dropped
    FROM (SELECT 0 AS i, 'raw' AS step, count(*) AS n FROM obs
          UNION ALL SELECT 1, 'required', count(*) FROM obs WHERE TMP IS NOT NULL AND DATE IS NOT NULL
          UNION ALL SELECT 2, 'valid', count(*) FROM valid
          UNION ALL SELECT 3, 'deduplicated', count(*) FROM dedup
          UNION ALL SELECT 4, 'on_the_hour', count(*) FROM model_rows
          UNION ALL SELECT 5, 'complete', count(*) FROM model_tab)""")

# --- features -------------------------------------------------------------------------

add("relative_humidity", "parsed", f"SELECT obs_id, TMP_C, DEW_C, {r6('RH_PCT')} AS RH_PCT FROM parsed")
add("calendar_features", "obs", """
    SELECT obs_id, t AS DATETIME, date_trunc('hour', t) AS DATE_HOUR, CAST(t AS DATE) AS DATE_DAY,
      CAST(hour(t) AS INTEGER) AS HOUR, CAST(month(t) AS INTEGER) AS MONTH,
      CAST(dayofyear(t) AS INTEGER) AS DAY_OF_YEAR
    FROM (SELECT obs_id, CAST(DATE AS TIMESTAMP) AS t FROM obs)""")
add("hourly_rows", "obs", "SELECT obs_id, DATE FROM obs WHERE minute(CAST(DATE AS TIMESTAMP)) = 0")


def profile(columns: list[str], table: str, digits: int | None) -> str:
    def shown(expr: str) -> str:
        return r6(expr, digits) if digits else expr

    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS n_nulls, "
        f"{shown(f'min(CAST({c} AS DOUBLE))')} AS min_value, {shown(f'max(CAST({c} AS DOUBLE))')} AS max_value FROM {table}"
        for c in columns
    )


add("feature_profile", "model_tab", profile([*S.FEATURES_ALL, S.LABEL], "model_tab", 6))
ORACLE["feature_profile_lineitem"] = profile(
    ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"], "lineitem", None
)

# --- splits ---------------------------------------------------------------------------

add("train_test_split", "labelled", "SELECT STATION, DATE_HOUR, split FROM labelled")
add("nested_fractions", "labelled", "SELECT STATION, DATE_HOUR, CAST(part AS INTEGER) AS part FROM labelled")
add("kfold_assign", "labelled", "SELECT STATION, DATE_HOUR, fold FROM labelled")
ORACLE["split_lineitem"] = f"""
    SELECT CASE WHEN {bucket('split', 'l_orderkey', 'l_linenumber')} % 1000 < 700 THEN 'train' ELSE 'test' END AS split,
      CAST({bucket('fold', 'l_orderkey', 'l_linenumber')} % 3 AS INTEGER) AS fold,
      count(*) AS n_rows, sum(l_quantity) AS sum_quantity
    FROM lineitem GROUP BY 1, 2"""

# --- vector transforms ----------------------------------------------------------------

add("assemble_features", "model_tab", "SELECT STATION, DATE_HOUR, "
    + ", ".join(f"{r6(c) if c == 'RH_PCT' else f'CAST({c} AS DOUBLE)'} AS {c}" for c in S.FEATURES_ALL)
    + " FROM model_tab")
add("standard_scale", "model_tab", "SELECT STATION, DATE_HOUR, " + ", ".join(
    f"{r6(f'CASE WHEN sd_{c} > 0 THEN {c} / sd_{c} ELSE 0.0 END')} AS {c}_SCALED" for c in S.FEATURES_ALL
) + " FROM model_tab, (SELECT " + ", ".join(
    f"stddev_samp({c}) AS sd_{c}" for c in S.FEATURES_ALL) + " FROM model_tab)")
ORACLE["vector_explode"] = """
    SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, round(CAST(embedding[i] AS DOUBLE), 6) AS value
    FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)"""

# --- one-feature least squares --------------------------------------------------------


def score(y: str, p: str) -> tuple[str, str]:
    rmse = f"sqrt(avg(({y} - {p}) ** 2))"
    return rmse, f"1.0e0 - sum(({y} - {p}) ** 2) / nullif(var_pop({y}) * count({y}), 0)"


add("ols_simple", "model_tab", f"""
    SELECT count(*) AS n_rows, {r6('any_value(b)')} AS slope, {r6('any_value(a)')} AS intercept,
      {r6(score('TMP_C', '(a + b * DEW_C)')[0])} AS rmse, {r6(score('TMP_C', '(a + b * DEW_C)')[1])} AS r2
    FROM model_tab, (SELECT regr_slope(TMP_C, DEW_C) AS b, regr_intercept(TMP_C, DEW_C) AS a FROM model_tab)""")
ORACLE["ols_lineitem"] = """
    SELECT count(*) AS n_rows, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
           round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem"""
def regression(table: str, x: str, y: str, digits: int) -> str:
    return f"""
    SELECT regr_count(y, x) AS n_rows, round(regr_slope(y, x), {digits}) AS slope,
      round(sqrt(regr_syy(y, x) * (1 - regr_r2(y, x)) / regr_count(y, x)), 6) AS rmse, round(regr_r2(y, x), 6) AS r2
    FROM (SELECT CAST({x} AS DOUBLE) AS x, {y} AS y FROM {table})"""


# Around a fixed instant: SQL's own sums would lose the digits of seconds since 1970.
ORACLE["ols_epoch"] = regression("events", "epoch(ts) - 1.7e9", "value", 12)
ORACLE["ols_offset"] = regression("lineitem", "l_quantity", "l_extendedprice", 6)
add("ridge_simple", "model_tab", f"""
    SELECT reg AS reg_param, {r6('b / (1 + reg / sy)')} AS slope, {r6('my - mx * b / (1 + reg / sy)')} AS intercept
    FROM (SELECT regr_slope(TMP_C, DEW_C) AS b, avg(DEW_C) AS mx, avg(TMP_C) AS my, stddev_pop(TMP_C) AS sy
          FROM model_tab), (SELECT unnest([0.01e0, 0.1e0, 5.0e0]) AS reg)""")
add("cv_ols", "labelled", f"""
    SELECT f AS fold, n_train, {r6('any_value(b)')} AS slope, {r6('any_value(a)')} AS intercept,
      {r6(score('TMP_C', '(a + b * DEW_C)')[0])} AS rmse
    FROM (SELECT CAST(f AS INTEGER) AS f, count(*) AS n_train, regr_slope(TMP_C, DEW_C) AS b,
                 regr_intercept(TMP_C, DEW_C) AS a
          FROM labelled, (SELECT unnest([0, 1, 2]) AS f) WHERE fold <> f GROUP BY f)
    JOIN labelled ON fold = f GROUP BY f, n_train""")

SHIFTED = {"DEW_C": "DEW_C", "WIND_SPEED": "(WIND_SPEED - 10)", "TMP_C": "TMP_C"}
GRAM = list(SHIFTED.values())
add("gram_by_fold", "labelled", "SELECT fold, count(*) AS n, " + ", ".join(
    [f"{r6(f'sum({x})')} AS s_{i}" for i, x in enumerate(GRAM)]
    + [f"{r6(f'sum({GRAM[i]} * {GRAM[j]})')} AS p_{i}_{j}" for i in range(3) for j in range(i, 3)]
) + " FROM labelled GROUP BY fold")


def curve(feature: str, model: str, full: bool = True) -> str:
    """Learning curve of one feature: fits on growing samples of train, scores on both parts."""
    p = f"(a + b * {feature})"
    train_rmse = f"sqrt(avg((TMP_C - {p}) ** 2) FILTER (WHERE split = 'train'))"
    test = "FILTER (WHERE split = 'test')"
    return f"""
      SELECT '{model}' AS model, fraction, any_value(n) AS n_rows,
        {r6(train_rmse) if full else 'CAST(NULL AS DOUBLE)'} AS train_rmse,
        round(sqrt(avg((TMP_C - {p}) ** 2) {test}), 6) AS test_rmse,
        round(1.0e0 - sum((TMP_C - {p}) ** 2) {test} / (var_pop(TMP_C) {test} * count(TMP_C) {test}), 6) AS test_r2
      FROM (SELECT i, fraction, count(*) AS n, regr_slope(TMP_C, {feature}) AS b, regr_intercept(TMP_C, {feature}) AS a
            FROM labelled, fractions WHERE split = 'train' AND part <= i GROUP BY i, fraction)
      JOIN labelled ON split = 'test' OR part <= i GROUP BY i, fraction"""


FRACTION_CTE = "fractions AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, {f}e0)" for i, f in enumerate(FRACTIONS)) + ") AS v(i, fraction))"
add("learning_curve_ols", "labelled", curve("DEW_C", "LinearRegression_Tuned"), FRACTION_CTE)
add("learning_curve_union", "labelled",
    f"SELECT * FROM ({curve('DEW_C', 'dew', False)}) UNION ALL "
    f"SELECT model, fraction, n_rows, train_rmse, test_rmse, CAST(NULL AS DOUBLE) AS test_r2 FROM ({curve('WIND_SPEED', 'wind')})",
    FRACTION_CTE)

SAMPLED = f"split = 'test' AND {key_bucket('plot')} % 1000 < 10"


def trained_line(feature: str) -> str:
    return (f"(SELECT regr_slope(TMP_C, {feature}) AS b, regr_intercept(TMP_C, {feature}) AS a "
            "FROM labelled WHERE split = 'train')")


# --- scoring --------------------------------------------------------------------------

P = "(a + b * DEW_C)"
LINE = trained_line("DEW_C")
add("pred_vs_actual", "labelled", f"""
    SELECT STATION, DATE_HOUR, {r6(P)} AS Predicted_Temperature_C, TMP_C AS Actual_Temperature_C
    FROM labelled, {LINE} WHERE split = 'test'""")
add("pred_sample", "labelled", f"""
    SELECT STATION, DATE_HOUR, {r6(P)} AS Predicted_Temperature_C, TMP_C AS Actual_Temperature_C
    FROM labelled, {LINE} WHERE {SAMPLED}""")
add("resolve_prediction_columns", "labelled",
    f"SELECT TMP_C AS label, {r6(P)} AS prediction FROM labelled, {LINE}")
add("model_save_load", "labelled",
    f"SELECT STATION, DATE_HOUR, {r6(P)} AS prediction FROM labelled, {LINE} WHERE split = 'test'")
add("prediction_metrics", "labelled", f"""
    SELECT split, count(*) AS n_rows, {r6(score('TMP_C', P)[0])} AS rmse, {r6(f'avg(abs(TMP_C - {P}))')} AS mae,
      {r6(score('TMP_C', P)[1])} AS r2, {r6(f'least(min(TMP_C), min({P}))')} AS low,
      {r6(f'greatest(max(TMP_C), max({P}))')} AS high
    FROM labelled, {LINE} GROUP BY split""")
add("metrics_json_roundtrip", "labelled", f"""
    SELECT 'ols' AS model_name, {r6(score('TMP_C', P)[0])} AS test_rmse, {r6(score('TMP_C', P)[1])} AS test_r2,
      '{{"regParam":0.0}}' AS best_hyperparameters
    FROM labelled, {LINE} WHERE split = 'test'""")
ORACLE["capped_sample_lineitem"] = f"""
    SELECT l_returnflag, l_orderkey, l_linenumber, l_quantity FROM (
      SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY
          {bucket('plot', 'l_returnflag', 'l_orderkey', 'l_linenumber', 'l_quantity')},
          l_returnflag, l_orderkey, l_linenumber, l_quantity) AS rn
      FROM lineitem WHERE {bucket('plot', 'l_orderkey', 'l_linenumber')} % 1000 < 100) WHERE rn <= 500"""

# --- depth-one trees on the hour ------------------------------------------------------


def stump(table: str, target: str, prefix: str) -> str:
    """CTEs ending in ``<prefix>_cut``: threshold and side means of the best split."""
    return f"""
  {prefix}_bins AS (SELECT HOUR AS x, count(*) AS n, sum({target}) AS s FROM {table} GROUP BY HOUR),
  {prefix}_run AS (SELECT x, sum(n) OVER (ORDER BY x) AS nl, sum(s) OVER (ORDER BY x) AS sl,
      sum(n) OVER () AS nt, sum(s) OVER () AS st FROM {prefix}_bins),
  {prefix}_cut AS (SELECT x AS cut, sl / nl AS left_mean, (st - sl) / (nt - nl) AS right_mean
    FROM {prefix}_run WHERE nl < nt ORDER BY sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) DESC, x LIMIT 1)"""


ONE_STUMP = stump("model_tab", "TMP_C", "first")
STUMP_ROWS = f"""
    SELECT HOUR, count(*) AS n_rows, {r6('any_value(CASE WHEN HOUR <= cut THEN left_mean ELSE right_mean END)')} AS prediction
    FROM model_tab, first_cut GROUP BY HOUR"""
add("dt_stump", "model_tab", STUMP_ROWS, ONE_STUMP)
add("rf_single_tree", "model_tab", STUMP_ROWS, ONE_STUMP)
add("gbt_two_rounds", "model_tab", f"""
    SELECT HOUR, count(*) AS n_rows, {r6('''any_value(CASE WHEN HOUR <= f.cut THEN f.left_mean ELSE f.right_mean END
      + 0.1 * CASE WHEN HOUR <= g.cut THEN g.left_mean ELSE g.right_mean END)''')} AS prediction
    FROM model_tab, first_cut f, second_cut g GROUP BY HOUR""",
    ONE_STUMP + """,
  residual AS (SELECT HOUR, 2 * (TMP_C - CASE WHEN HOUR <= cut THEN left_mean ELSE right_mean END) AS r
    FROM model_tab, first_cut),""" + stump("residual", "r", "second"))

# --- the same splits inside folds, the test score and the learning curve ---------------


def grouped_stump(source: str, target: str, prefix: str) -> str:
    """CTEs ending in ``<prefix>_cut``: the best split of the 'fit' rows of each ``grp``."""
    return f"""
  {prefix}_bins AS (SELECT grp, HOUR AS x, count(*) AS n, sum({target}) AS s FROM {source} WHERE role = 'fit' GROUP BY grp, HOUR),
  {prefix}_run AS (SELECT grp, x, sum(n) OVER o AS nl, sum(s) OVER o AS sl, lead(x) OVER o AS nx,
      sum(n) OVER (PARTITION BY grp) AS nt, sum(s) OVER (PARTITION BY grp) AS st FROM {prefix}_bins
      WINDOW o AS (PARTITION BY grp ORDER BY x)),
  {prefix}_pick AS (SELECT *, row_number() OVER (PARTITION BY grp
      ORDER BY sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) DESC, x) AS place FROM {prefix}_run WHERE nl < nt),
  {prefix}_cut AS (SELECT grp, (x + nx) / 2.0e0 AS cut, sl / nl AS left_mean, (st - sl) / (nt - nl) AS right_mean
    FROM {prefix}_pick WHERE place = 1)"""


def side(cut: str) -> str:
    return f"CASE WHEN HOUR <= {cut}.cut THEN {cut}.left_mean ELSE {cut}.right_mean END"


HOUR_ROWS = """hour_rows AS MATERIALIZED (
    SELECT g AS grp, HOUR, TMP_C, CASE WHEN fold = g THEN 'score' ELSE 'fit' END AS role
      FROM labelled, (SELECT unnest([0, 1, 2]) AS g) WHERE split = 'train'
    UNION ALL SELECT 3, HOUR, TMP_C, CASE WHEN split = 'test' THEN 'score' ELSE 'fit' END FROM labelled)"""
BOOST = (HOUR_ROWS + "," + grouped_stump("hour_rows", "TMP_C", "one") + f""",
  rest_rows AS MATERIALIZED (SELECT h.grp, HOUR, TMP_C, role, {side('c')} AS p1, 2 * (TMP_C - {side('c')}) AS r
    FROM hour_rows h JOIN one_cut c ON h.grp = c.grp),""" + grouped_stump("rest_rows", "r", "two") + f""",
  boosted AS MATERIALIZED (SELECT h.grp, TMP_C, p1, p1 + 0.1 * {side('c')} AS p2
    FROM rest_rows h JOIN two_cut c ON h.grp = c.grp WHERE role = 'score'),
  cv_error AS (SELECT avg(e1) AS e1, avg(e2) AS e2 FROM (SELECT sqrt(avg((TMP_C - p1) ** 2)) AS e1,
    sqrt(avg((TMP_C - p2) ** 2)) AS e2 FROM boosted WHERE grp < 3 GROUP BY grp))""")
add("cv_dt_stump", "labelled", f"""
    SELECT CAST(i AS INTEGER) AS grid_idx, round(any_value(e1), 6) AS avg_rmse,
      {r6(score('TMP_C', 'p1')[0])} AS test_rmse, {r6(score('TMP_C', 'p1')[1])} AS test_r2
    FROM boosted, cv_error, (SELECT unnest([0, 1]) AS i) WHERE grp = 3 GROUP BY i""", BOOST)
add("cv_gbt_stump", "labelled", f"""
    SELECT CAST(i AS INTEGER) AS grid_idx, round(any_value(CASE WHEN i = 0 THEN e1 ELSE e2 END), 6) AS avg_rmse,
      {r6(score('TMP_C', '(CASE WHEN e1 <= e2 THEN p1 ELSE p2 END)')[0])} AS test_rmse,
      {r6(score('TMP_C', '(CASE WHEN e1 <= e2 THEN p1 ELSE p2 END)')[1])} AS test_r2
    FROM boosted, cv_error, (SELECT unnest([0, 1]) AS i) WHERE grp = 3 GROUP BY i""", BOOST)
add("learning_curve_stump", "labelled", f"""
    SELECT 'DecisionTree_Tuned' AS model, fraction, count(*) FILTER (WHERE role = 'fit') AS n_rows,
      round(sqrt(avg((TMP_C - {side('c')}) ** 2) FILTER (WHERE role = 'fit')), 6) AS train_rmse,
      round(sqrt(avg((TMP_C - {side('c')}) ** 2) FILTER (WHERE role = 'score')), 6) AS test_rmse,
      round(1.0e0 - sum((TMP_C - {side('c')}) ** 2) FILTER (WHERE role = 'score')
        / (var_pop(TMP_C) FILTER (WHERE role = 'score') * count(*) FILTER (WHERE role = 'score')), 6) AS test_r2
    FROM hour_curve h JOIN lcs_cut c ON h.grp = c.grp JOIN fractions ON h.grp = i GROUP BY i, fraction""",
    FRACTION_CTE + """,
  hour_curve AS MATERIALIZED (SELECT i AS grp, HOUR, TMP_C, CASE WHEN split = 'train' THEN 'fit' ELSE 'score' END AS role
    FROM labelled JOIN fractions ON split = 'test' OR part <= i),""" + grouped_stump("hour_curve", "TMP_C", "lcs"))

# --- many-feature least squares: one column made orthogonal at a time -----------------


def orthogonal(source: str, features: list[str], prefix: str) -> str:
    """CTEs that regress TMP_C on ``features`` within each ``grp``.

    ``source`` has grp, role ('fit' rows determine the slopes), split, the features and TMP_C.
    Step k takes column k out of all later columns and the label; a column with nothing
    left is skipped. ``<prefix>_<K>`` holds the residual as ``y``, ``<prefix>_s<k>`` the slopes.
    """
    k_max = len(features)
    mean = ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS d{i}" for i, c in enumerate(features))
    ctes = [f"{prefix}_std AS MATERIALIZED (SELECT grp, avg(TMP_C) AS my, {mean} FROM {source} WHERE role = 'fit' GROUP BY grp)"]
    cols = ", ".join(f"CASE WHEN d{i} > 0 THEN ({c} - m{i}) / d{i} ELSE 0.0 END AS x{i}" for i, c in enumerate(features))
    ctes.append(f"{prefix}_0 AS MATERIALIZED (SELECT t.grp, role, split, TMP_C, TMP_C - my AS y, {cols} "
                f"FROM {source} t JOIN {prefix}_std m ON t.grp = m.grp)")
    for k in range(k_max):
        slopes = ", ".join(
            [f"CASE WHEN sum(x{k} * x{k}) > 1e-9 * count(*) THEN sum(x{k} * y) / sum(x{k} * x{k}) ELSE 0.0 END AS by_"]
            + [f"CASE WHEN sum(x{k} * x{k}) > 1e-9 * count(*) THEN sum(x{k} * x{j}) / sum(x{k} * x{k}) ELSE 0.0 END AS b{j}"
               for j in range(k + 1, k_max)])
        ctes.append(f"{prefix}_s{k} AS MATERIALIZED (SELECT grp, {slopes} FROM {prefix}_{k} WHERE role = 'fit' GROUP BY grp)")
        later = "".join(f", x{j} - b{j} * x{k} AS x{j}" for j in range(k + 1, k_max))
        ctes.append(f"{prefix}_{k + 1} AS MATERIALIZED (SELECT t.grp, role, split, TMP_C, y - by_ * x{k} AS y{later} "
                    f"FROM {prefix}_{k} t JOIN {prefix}_s{k} s ON t.grp = s.grp)")
    return ",\n".join(ctes)


ALL_LIST = ", ".join([*S.FEATURES_ALL, S.LABEL])
CURVE_ROWS = f"""curve_rows AS MATERIALIZED (SELECT i AS grp, split, {ALL_LIST},
    CASE WHEN split = 'train' THEN 'fit' ELSE 'score' END AS role
    FROM labelled JOIN fractions ON split = 'test' OR part <= i)"""
K = len(S.FEATURES_ALL)
add("learning_curve_lr", "labelled", f"""
    SELECT 'LinearRegression_Tuned' AS model, fraction, count(*) FILTER (WHERE split = 'train') AS n_rows,
      round(sqrt(avg(y * y) FILTER (WHERE split = 'train')), 6) AS train_rmse,
      round(sqrt(avg(y * y) FILTER (WHERE split = 'test')), 6) AS test_rmse,
      round(1.0e0 - sum(y * y) FILTER (WHERE split = 'test')
        / (var_pop(TMP_C) FILTER (WHERE split = 'test') * count(*) FILTER (WHERE split = 'test')), 6) AS test_r2
    FROM lc_{K} JOIN fractions ON grp = i GROUP BY i, fraction""",
    f"{FRACTION_CTE},\n{CURVE_ROWS},\n{orthogonal('curve_rows', S.FEATURES_ALL, 'lc')}")


def cv_select(name: str, prefix: str, k: int) -> str:
    return f"""SELECT '{name}' AS features,
      (SELECT round(avg(r), 6) FROM (SELECT sqrt(avg(y * y)) AS r FROM {prefix}_{k} WHERE grp < 3 AND role = 'score' GROUP BY grp)) AS avg_rmse,
      (SELECT round(sqrt(avg(y * y)), 6) FROM {prefix}_{k} WHERE grp = 3 AND role = 'score') AS test_rmse,
      (SELECT round(1.0e0 - sum(y * y) / (var_pop(TMP_C) * count(*)), 6) FROM {prefix}_{k} WHERE grp = 3 AND role = 'score') AS test_r2"""


FOLD_ROWS = f"""fold_rows AS MATERIALIZED (
    SELECT g AS grp, split, {ALL_LIST}, CASE WHEN fold = g THEN 'score' ELSE 'fit' END AS role
      FROM labelled, (SELECT unnest([0, 1, 2]) AS g) WHERE split = 'train'
    UNION ALL
    SELECT 3, split, {ALL_LIST}, CASE WHEN split = 'test' THEN 'score' ELSE 'fit' END FROM labelled)"""
add("cv_lr", "labelled",
    cv_select("all", "fa", K) + " UNION ALL " + cv_select("no_leak", "fn", K - 1),
    f"{FOLD_ROWS},\n{orthogonal('fold_rows', S.FEATURES_ALL, 'fa')},\n{orthogonal('fold_rows', S.FEATURES_NO_LEAK, 'fn')}")

# --- the three linear models of the leaderboard ---------------------------------------

BOARD_ROWS = f"""board_rows AS MATERIALIZED (SELECT 0 AS grp, CASE WHEN split = 'train' THEN 'fit' ELSE 'score' END AS role,
    CASE WHEN {SAMPLED} THEN 'sampled' ELSE split END AS split, {ALL_LIST} FROM labelled)"""


def board_scores(model: str, rows: str, where: str = "TRUE") -> str:
    """Exact and sample scores from rows with the label y0, the error e and ``sampled``."""
    part = "FILTER (WHERE sampled)"
    return f"""SELECT {model} AS model, sqrt(avg(e * e)) AS test_rmse,
      1.0e0 - sum(e * e) / nullif(var_pop(y0) * count(*), 0) AS test_r2,
      CASE WHEN count(*) {part} >= 10 THEN sqrt(avg(e * e) {part}) END AS sample_rmse,
      CASE WHEN count(*) {part} >= 10 THEN 1.0e0 - sum(e * e) {part} / nullif(var_pop(y0) {part} * count(*) {part}, 0) END AS sample_r2,
      count(*) {part} AS sample_rows FROM {rows} WHERE {where} GROUP BY 1"""


def ranked(rows: str) -> str:
    return f"""SELECT model, {r6('test_rmse')} AS test_rmse, {r6('test_r2')} AS test_r2,
      {r6('sample_rmse')} AS sample_rmse, {r6('sample_r2')} AS sample_r2, sample_rows,
      CAST(row_number() OVER (ORDER BY test_rmse, model) AS INTEGER) AS rank FROM ({rows})"""


add("leaderboard", "labelled", ranked(" UNION ALL ".join(
    board_scores(f"'{name}'", f"(SELECT TMP_C AS y0, y AS e, split = 'sampled' AS sampled FROM lb{i}_{len(feats)} WHERE role = 'score')")
    for i, (name, feats) in enumerate(LEADERBOARD.items()))),
    BOARD_ROWS + "".join(f",\n{orthogonal('board_rows', feats, f'lb{i}')}" for i, feats in enumerate(LEADERBOARD.values())))

# --- many-feature elastic net: cyclic coordinate descent as a recursive query -----------
# Groups 0 to 2 are folds, 3 is training against test, 10 and more are points of the learning curve.

SWEEPS = 400
FLAGGED = f"labelled_rows AS MATERIALIZED (SELECT *, {SAMPLED} AS sampled FROM labelled)"


def study_rows(columns: str, source: str) -> str:
    return f"""
    SELECT g AS grp, CASE WHEN fold = g THEN 'score' ELSE 'fit' END AS role, sampled, {columns}
      FROM {source}, (SELECT unnest([0, 1, 2]) AS g) WHERE split = 'train'
    UNION ALL SELECT 3, CASE WHEN split = 'test' THEN 'score' ELSE 'fit' END, sampled, {columns} FROM {source}
    UNION ALL SELECT 10 + i, CASE WHEN split = 'test' THEN 'score' ELSE 'fit' END, sampled, {columns}
      FROM {source} JOIN fractions ON split = 'test' OR part <= i"""


NET_MEANS = ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS d{i}" for i, c in enumerate(S.FEATURES_ALL))
NET_X = ", ".join(f"CASE WHEN d{i} > 0 THEN ({c} - m{i}) / d{i} ELSE 0.0 END AS x{i}" for i, c in enumerate(S.FEATURES_ALL))
NET_CORR = "[" + ", ".join("[" + ", ".join(f"avg(x{i} * x{j})" for j in range(K)) + "]" for i in range(K)) + "]"
NET_TARGET = "[" + ", ".join(f"avg(x{i} * ys)" for i in range(K)) + "]"
NET_LIST = "[" + ", ".join(f"x{i}" for i in range(K)) + "]"
ZEROS = "[" + ", ".join(["0.0e0"] * K) + "]"
STANDARD = f"""net_std AS MATERIALIZED (SELECT grp, count(*) AS n, avg(TMP_C) AS my, stddev_pop(TMP_C) AS sy, {NET_MEANS}
    FROM net_source WHERE role = 'fit' GROUP BY grp),
  net_rows AS MATERIALIZED (SELECT f.grp, role, sampled, TMP_C, my, sy, (TMP_C - my) / sy AS ys, {NET_X}
    FROM net_source f JOIN net_std s ON f.grp = s.grp),
  net_system AS MATERIALIZED (SELECT grp, any_value(sy) AS sy, {NET_CORR} AS c, {NET_TARGET} AS t
    FROM net_rows WHERE role = 'fit' GROUP BY grp)"""
# ``lr_cv`` has the grid with its errors, ``lr_err`` the errors of the chosen setting.
NET = f"""{FLAGGED},
  net_source AS MATERIALIZED ({study_rows(ALL_LIST, 'labelled_rows')}),
  {STANDARD},
  grid AS (SELECT CAST(row_number() OVER (ORDER BY reg, alpha) - 1 AS INTEGER) AS grid_idx, reg, alpha
    FROM (SELECT unnest([0.0e0, 0.01e0, 0.1e0]) AS reg), (SELECT unnest([0.0e0, 0.5e0, 1.0e0]) AS alpha)),
  descent AS (
    SELECT 0 AS it, grp, grid_idx, c, t, reg / sy * alpha AS l1, reg / sy * (1 - alpha) AS l2, {ZEROS} AS w FROM net_system, grid
    UNION ALL
    SELECT it + 1, grp, grid_idx, c, t, l1, l2,
      list_transform(range(1, {K + 1}), lambda k: CASE WHEN k <> j THEN w[k] WHEN c[j][j] = 0 THEN 0.0e0
        ELSE sign(own) * greatest(abs(own) - l1, 0) / (c[j][j] + l2) END) AS w
    FROM (SELECT *, t[j] - list_dot_product(c[j], w) + c[j][j] * w[j] AS own
          FROM (SELECT *, it % {K} + 1 AS j FROM descent WHERE it < {K * SWEEPS}))),
  net_weights AS MATERIALIZED (SELECT grp, grid_idx, w FROM descent WHERE it = {K * SWEEPS}),
  net_errors AS MATERIALIZED (SELECT r.grp, grid_idx, role, sampled, TMP_C,
      TMP_C - my - sy * list_dot_product(w, {NET_LIST}) AS e
    FROM net_rows r JOIN net_weights n ON r.grp = n.grp WHERE role = 'score' OR r.grp >= 10),
  lr_cv AS MATERIALIZED (SELECT grid_idx, reg, alpha, avg(r) AS avg_rmse
    FROM (SELECT grp, grid_idx, sqrt(avg(e * e)) AS r FROM net_errors WHERE grp < 3 GROUP BY grp, grid_idx) JOIN grid USING (grid_idx)
    GROUP BY grid_idx, reg, alpha),
  lr_best AS MATERIALIZED (SELECT * FROM lr_cv ORDER BY round(avg_rmse, 9), grid_idx LIMIT 1),
  lr_err AS MATERIALIZED (SELECT 'LinearRegression_Tuned' AS model, grp, role, sampled, TMP_C AS y0, e
    FROM net_errors WHERE grid_idx = (SELECT grid_idx FROM lr_best))"""
NET_EXTRA = f"{FRACTION_CTE},\n{NET}"


def held_score(source: str) -> tuple[str, str]:
    where = f"FROM {source} WHERE grp = 3 AND role = 'score'"
    return (f"(SELECT round(sqrt(avg(e * e)), 6) {where})",
            f"(SELECT round(1.0e0 - sum(e * e) / (var_pop(y0) * count(*)), 6) {where})")


def add_recursive(name: str, body: str, extra: str) -> None:
    add(name, "labelled", body, extra)
    ORACLE[name] = ORACLE[name].replace("WITH ", "WITH RECURSIVE ", 1)


LR_SHOWN = f"'LinearRegression_Tuned' AS model, grid_idx, reg AS regParam, alpha AS elasticNetParam, {r6('avg_rmse')} AS avg_rmse"
LR_RMSE, LR_R2 = held_score("lr_err")
add_recursive("lr_tuned", f"SELECT {LR_SHOWN}, {LR_RMSE} AS test_rmse, {LR_R2} AS test_r2 FROM lr_cv", NET_EXTRA)
add_recursive("cv_table", f"SELECT {LR_SHOWN} FROM lr_cv", NET_EXTRA)
add_recursive("best_params", f"SELECT {LR_SHOWN} FROM lr_best", NET_EXTRA)
add_recursive("validation_curve", f"""
    SELECT 'LinearRegression_Tuned' AS model, 'regParam' AS param, reg AS value, {r6('avg(avg_rmse)')} AS avg_rmse FROM lr_cv GROUP BY reg
    UNION ALL
    SELECT 'LinearRegression_Tuned', 'elasticNetParam', alpha, {r6('avg(avg_rmse)')} FROM lr_cv GROUP BY alpha""", NET_EXTRA)

# --- smallest weights of all features: conjugate gradients from zero ---------------------
# Every step stays in the row space, so collinear columns share their weight.

STEPS = 60
DIRECT = f"list_transform(c, lambda row: list_dot_product(row, p))"
WEIGHTS = f"""net_source AS MATERIALIZED (SELECT 0 AS grp, 'fit' AS role, FALSE AS sampled, {ALL_LIST} FROM labelled),
  {STANDARD},
  climb AS (
    SELECT 0 AS it, c, {ZEROS} AS w, t AS r, t AS p, list_dot_product(t, t) AS rr FROM net_system
    UNION ALL
    SELECT it + 1, c, nw, nr, CASE WHEN live THEN list_transform(range(1, {K + 1}), lambda k: nr[k] + list_dot_product(nr, nr) / rr * p[k]) ELSE p END,
      CASE WHEN live THEN list_dot_product(nr, nr) ELSE rr END
    FROM (SELECT *, CASE WHEN live THEN list_transform(range(1, {K + 1}), lambda k: w[k] + a * p[k]) ELSE w END AS nw,
            CASE WHEN live THEN list_transform(range(1, {K + 1}), lambda k: r[k] - a * cp[k]) ELSE r END AS nr
      FROM (SELECT *, rr > 1e-26 AS live, rr / nullif(list_dot_product(p, cp), 0) AS a
        FROM (SELECT *, {DIRECT} AS cp FROM climb WHERE it < {STEPS})))),
  solution AS MATERIALIZED (SELECT w FROM climb WHERE it = {STEPS}),
  coefs AS MATERIALIZED ({" UNION ALL ".join(
      f"SELECT '{c}' AS feature, w[{i + 1}] * sy * sqrt(n / (n - 1.0e0)) AS coefficient, "
      f"CASE WHEN d{i} > 0 THEN w[{i + 1}] * sy / d{i} * m{i} ELSE 0 END AS shift_part FROM solution, net_std"
      for i, c in enumerate(S.FEATURES_ALL))})"""
add_recursive("lr_coefficients", f"""
    SELECT 'ols' AS model, feature, {r6('coefficient')} AS coefficient, {r6('abs(coefficient)')} AS abs_coeff,
      round((SELECT my FROM net_std) - (SELECT sum(shift_part) FROM coefs), 6) AS intercept FROM coefs""", WEIGHTS)
add_recursive("top_features", f"""
    SELECT 'ols' AS model, rank, feature, abs_coeff FROM (
      SELECT feature, abs_coeff, CAST(row_number() OVER (ORDER BY abs_coeff DESC, feature) AS INTEGER) AS rank
      FROM (SELECT feature, {r6('abs(coefficient)')} AS abs_coeff FROM coefs))
    WHERE rank <= 20""", WEIGHTS)

# --- trees over all features: binning, then one level of splits at a time ----------------


def grown_tree(source: str, bins: list[int], depth: int, prefix: str = "", least: int = 1, weight: str = "1", only: str = "") -> str:
    """CTEs for the tree of each ``grp`` and bin count, grown on the 'fit' rows of ``source``.

    ``source`` has grp, role, rid, y, the features and what ``weight`` names. Cut points: every midpoint where a
    feature has few values; else those where the running weight comes closest to equal
    shares. ``<prefix>grow_<L>`` holds the node of every row after L levels, ``<prefix>best_<L>`` the cuts. A cut leaves
    ``least`` rows on either side. ``only`` names a table (grp, f) of the features that a group may use.
    """
    p, w = prefix, "" if weight == "1" else ", w"
    of = "count(*)" if weight == "1" else "sum(w)"
    allowed = f" JOIN {only} USING (grp, f)" if only else ""
    long = " UNION ALL ".join(
        f"SELECT grp, role, rid, y, {i} AS f, CAST({c} AS DOUBLE) AS v{'' if weight == '1' else f', {weight} AS w'} FROM {source}"
        for i, c in enumerate(S.FEATURES_ALL))
    ctes = [f"""{p}long_rows AS MATERIALIZED (SELECT * FROM ({long}){allowed}),
  {p}value_runs AS MATERIALIZED (SELECT *, sum(n) OVER o AS c, row_number() OVER o AS i, lead(v) OVER o AS nv,
      sum(n) OVER o + lead(n) OVER o / 2.0e0 AS mid, count(*) OVER (PARTITION BY grp, f) AS d,
      sum(n) OVER (PARTITION BY grp, f) AS total
    FROM (SELECT grp, f, v, {of} AS n FROM {p}long_rows WHERE role = 'fit' GROUP BY grp, f, v)
    WINDOW o AS (PARTITION BY grp, f ORDER BY v)),
  {p}bin_counts AS (SELECT unnest({bins}) AS mb),
  {p}goals AS (SELECT grp, mb, f, k, min(i) AS g FROM {p}value_runs, {p}bin_counts, (SELECT unnest(range(1, {max(bins)})) AS k)
    WHERE d > mb AND k < mb AND mid > k * (total / CAST(mb AS DOUBLE)) GROUP BY grp, mb, f, k),
  {p}picks AS (SELECT grp, mb, f, k, k + max(g - k) OVER (PARTITION BY grp, mb, f ORDER BY k) AS i FROM {p}goals),
  {p}cuts AS MATERIALIZED (
    SELECT grp, mb, f, i - 1 AS b, (v + nv) / 2.0e0 AS cut FROM {p}value_runs, {p}bin_counts WHERE d <= mb AND nv IS NOT NULL
    UNION ALL
    SELECT p.grp, mb, p.f, k - 1, (v + nv) / 2.0e0 FROM {p}picks p JOIN {p}value_runs r
      ON p.grp = r.grp AND p.f = r.f AND p.i = r.i WHERE nv IS NOT NULL),
  {p}binned AS MATERIALIZED (SELECT grp, mb, rid, role, y{w}, f, count(*) FILTER (WHERE cut < v) AS bin
    FROM (SELECT * FROM {p}long_rows, {p}bin_counts) LEFT JOIN {p}cuts USING (grp, mb, f)
    GROUP BY grp, mb, rid, role, y{w}, f),
  {p}grow_0 AS MATERIALIZED (SELECT grp, mb, rid, role, y{'' if weight == '1' else f', {weight} AS w'}, 1 AS node FROM {source}, {p}bin_counts)"""]
    n_of, s_of = ("count(*)", "sum(b.y)") if weight == "1" else ("sum(b.w)", "sum(b.w * b.y)")
    for level in range(depth):
        ctes.append(f"""{p}best_{level} AS MATERIALIZED (SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY grp, mb, node ORDER BY round(gain, 7) DESC, f, bin) AS place FROM (
        SELECT grp, mb, node, f, bin, sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) - st * st / nt AS gain FROM (
          SELECT grp, mb, node, f, bin, sum(n) OVER o AS nl, sum(s) OVER o AS sl, sum(c) OVER o AS cl,
            sum(n) OVER (PARTITION BY grp, mb, node, f) AS nt, sum(s) OVER (PARTITION BY grp, mb, node, f) AS st,
            sum(c) OVER (PARTITION BY grp, mb, node, f) AS ct
          FROM (SELECT b.grp, b.mb, node, f, bin, count(*) AS c, {n_of} AS n, {s_of} AS s
                FROM {p}binned b JOIN {p}grow_{level} g ON b.grp = g.grp AND b.mb = g.mb AND b.rid = g.rid
                WHERE b.role = 'fit' GROUP BY b.grp, b.mb, node, f, bin)
          WINDOW o AS (PARTITION BY grp, mb, node, f ORDER BY bin)) WHERE nl < nt AND cl >= {least} AND ct - cl >= {least})
      WHERE gain > 1e-9) WHERE place = 1),
  {p}grow_{level + 1} AS MATERIALIZED (SELECT g.grp, g.mb, g.rid, g.role, g.y{'' if weight == '1' else ', g.w'},
      CASE WHEN s.f IS NULL THEN g.node ELSE 2 * g.node + CASE WHEN b.bin > s.bin THEN 1 ELSE 0 END END AS node
    FROM {p}grow_{level} g LEFT JOIN {p}best_{level} s ON g.grp = s.grp AND g.mb = s.mb AND g.node = s.node
    LEFT JOIN {p}binned b ON b.grp = g.grp AND b.mb = g.mb AND b.rid = g.rid AND b.f = s.f)""")
    return ",\n  ".join(ctes)


def leaf_errors(levels: list[int], prefix: str = "", weight: str = "1") -> str:
    """``<prefix>leaf_rows``: y, prediction and error of every row under the tree cut off at each listed depth."""
    mean = "avg(y)" if weight == "1" else "sum(w * y) / sum(w)"
    parts = [f"SELECT {n} AS depth, g.grp, g.mb, rid, role, y, p, y - p AS e FROM {prefix}grow_{n} g JOIN "
             f"(SELECT grp, mb, node, {mean} AS p FROM {prefix}grow_{n} WHERE role = 'fit' GROUP BY grp, mb, node) m "
             "ON g.grp = m.grp AND g.mb = m.mb AND g.node = m.node" for n in levels]
    return f"{prefix}leaf_rows AS MATERIALIZED (" + " UNION ALL ".join(parts) + ")"


NUMBERED = "numbered AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY STATION, DATE_HOUR) AS rid FROM labelled)"
INPUTS = ", ".join(S.FEATURES_ALL)
TREE_ROWS = f"""tree_rows AS MATERIALIZED (
    SELECT g AS grp, CASE WHEN fold = g THEN 'score' ELSE 'fit' END AS role, rid, TMP_C AS y, {INPUTS}
      FROM numbered, (SELECT unnest([0, 1, 2]) AS g) WHERE split = 'train'
    UNION ALL
    SELECT 3, CASE WHEN split = 'test' THEN 'score' ELSE 'fit' END, rid, TMP_C, {INPUTS} FROM numbered)"""


def tree_grid(depths: list[int], model: str = "") -> tuple[str, str]:
    """Cross-validated grid of depths x 32 and 64 bins with the test scores of the best."""
    head = f"'{model}' AS model, " if model else ""
    return f"""
    SELECT {head}CAST(grid_idx AS INTEGER) AS grid_idx, depth AS maxDepth, mb AS maxBins, round(avg_rmse, 6) AS avg_rmse,
      round((SELECT sqrt(avg(e * e)) FROM chosen), 6) AS test_rmse,
      round((SELECT 1.0e0 - sum(e * e) / (var_pop(y) * count(*)) FROM chosen), 6) AS test_r2 FROM tree_cv""", (
        f"{NUMBERED},\n{TREE_ROWS},\n{grown_tree('tree_rows', [32, 64], max(depths))},\n{leaf_errors(depths)}" + """,
  tree_cv AS MATERIALIZED (SELECT depth, mb, avg(r) AS avg_rmse, row_number() OVER (ORDER BY depth, mb) - 1 AS grid_idx
    FROM (SELECT depth, mb, grp, sqrt(avg(e * e)) AS r FROM leaf_rows WHERE grp < 3 AND role = 'score' GROUP BY depth, mb, grp)
    GROUP BY depth, mb),
  winner AS (SELECT depth, mb FROM tree_cv ORDER BY round(avg_rmse, 9), grid_idx LIMIT 1),
  chosen AS (SELECT y, e FROM leaf_rows JOIN winner USING (depth, mb) WHERE grp = 3 AND role = 'score')""")


ONE_TREE = f"""tree_rows AS MATERIALIZED (SELECT 3 AS grp, 'fit' AS role, rid, TMP_C AS y, {INPUTS}
    FROM numbered WHERE split = 'train')"""
FEATURE_NAMES = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(S.FEATURES_ALL))
# Share of the total error reduction owed to each feature, from ``gains``.
IMPORTANCE = f"""
    SELECT 'DecisionTree_Tuned' AS model, CASE i {FEATURE_NAMES} END AS feature,
      round(coalesce(sum(gain), 0) / (SELECT sum(gain) FROM gains), 6) AS importance
    FROM (SELECT unnest(range(0, {K})) AS i) LEFT JOIN gains ON f = i GROUP BY i"""


def tree_importance(depth: int, bins: int) -> tuple[str, str]:
    gains = " UNION ALL ".join(f"SELECT f, gain FROM best_{n}" for n in range(depth))
    return IMPORTANCE, f"{NUMBERED},\n{ONE_TREE},\n{grown_tree('tree_rows', [bins], depth)},\ngains AS ({gains})"


CURVE_TREE = f"""tree_rows AS MATERIALIZED (SELECT i AS grp, CASE WHEN split = 'train' THEN 'fit' ELSE 'score' END AS role,
    rid, TMP_C AS y, {INPUTS} FROM numbered JOIN fractions ON split = 'test' OR part <= i)"""


def tree_curve(depth: int, bins: int) -> tuple[str, str]:
    return """
    SELECT 'DecisionTree_Tuned' AS model, fraction, count(*) FILTER (WHERE role = 'fit') AS n_rows,
      round(sqrt(avg(e * e) FILTER (WHERE role = 'fit')), 6) AS train_rmse,
      round(sqrt(avg(e * e) FILTER (WHERE role = 'score')), 6) AS test_rmse,
      round(1.0e0 - sum(e * e) FILTER (WHERE role = 'score')
        / (var_pop(y) FILTER (WHERE role = 'score') * count(*) FILTER (WHERE role = 'score')), 6) AS test_r2
    FROM leaf_rows JOIN fractions ON grp = i GROUP BY i, fraction""", (
        f"{FRACTION_CTE},\n{NUMBERED},\n{CURVE_TREE},\n{grown_tree('tree_rows', [bins], depth)},\n{leaf_errors([depth])}")


for _name, (_body, _extra) in {
    "cv_dt_shallow": tree_grid([2, 3]),
    "feature_importance_shallow": tree_importance(3, 64),
    "learning_curve_shallow": tree_curve(2, 32),
    "dt_tuned": tree_grid([4, 6], "DecisionTree_Tuned"),
}.items():
    add(_name, "labelled", _body, _extra)

# --- the tuned tree: grid, chosen setting, curve and importances -----------------------
# ``dt_cv`` has the grid with its errors, ``dt_err`` the errors of the chosen setting.

LEAST = TIE_FREE["minInstancesPerNode"]
FLAGGED_ROWS = f"""flagged AS MATERIALIZED (SELECT *, {SAMPLED} AS sampled,
    row_number() OVER (ORDER BY STATION, DATE_HOUR) AS rid FROM labelled)"""
TUNED_TREE = f"""{FLAGGED_ROWS},
  tree_rows AS MATERIALIZED ({study_rows(f"rid, TMP_C AS y, {INPUTS}", 'flagged')}),
  {grown_tree('tree_rows', [32, 64], 6, least=LEAST)},
  {leaf_errors([4, 6])},
  dt_cv AS MATERIALIZED (SELECT depth, mb, avg(r) AS avg_rmse, CAST(row_number() OVER (ORDER BY depth, mb) - 1 AS INTEGER) AS grid_idx
    FROM (SELECT depth, mb, grp, sqrt(avg(e * e)) AS r FROM leaf_rows WHERE grp < 3 AND role = 'score' GROUP BY depth, mb, grp)
    GROUP BY depth, mb),
  dt_best AS MATERIALIZED (SELECT depth, mb FROM dt_cv ORDER BY round(avg_rmse, 9), grid_idx LIMIT 1),
  dt_err AS MATERIALIZED (SELECT 'DecisionTree_Tuned' AS model, l.grp, role, sampled, y AS y0, e
    FROM leaf_rows l JOIN dt_best USING (depth, mb) JOIN (SELECT rid, sampled FROM flagged) f ON l.rid = f.rid)"""
TREE_EXTRA = f"{FRACTION_CTE},\n{TUNED_TREE}"


def curve_of(source: str) -> str:
    return f"""
    SELECT model, fraction, count(*) FILTER (WHERE role = 'fit') AS n_rows,
      round(sqrt(avg(e * e) FILTER (WHERE role = 'fit')), 6) AS train_rmse,
      round(sqrt(avg(e * e) FILTER (WHERE role = 'score')), 6) AS test_rmse,
      round(1.0e0 - sum(e * e) FILTER (WHERE role = 'score')
        / (var_pop(y0) FILTER (WHERE role = 'score') * count(*) FILTER (WHERE role = 'score')), 6) AS test_r2
    FROM {source} JOIN fractions ON grp = 10 + i GROUP BY model, fraction"""


add("learning_curve_tree", "labelled", curve_of("dt_err"), TREE_EXTRA)
CHOSEN_GAINS = " UNION ALL ".join(
    f"SELECT f, gain FROM best_{n} JOIN dt_best USING (mb) WHERE grp = 3 AND {n} < depth" for n in range(6))
add("feature_importance", "labelled", IMPORTANCE, f"{TREE_EXTRA},\ngains AS ({CHOSEN_GAINS})")

# --- the stored linear model and tree --------------------------------------------------

BOTH = f"{NET_EXTRA},\n{TUNED_TREE},\nboth_err AS MATERIALIZED (SELECT * FROM lr_err UNION ALL SELECT * FROM dt_err)"
ON_TEST = "grp = 3 AND role = 'score'"
add_recursive("artifact_metrics", f"""
    SELECT model AS model_name, {r6('sqrt(avg(e * e))')} AS test_rmse, {r6('1.0e0 - sum(e * e) / (var_pop(y0) * count(*))')} AS test_r2,
      CASE WHEN model LIKE 'L%' THEN (SELECT reg FROM lr_best) END AS regParam,
      CASE WHEN model LIKE 'L%' THEN (SELECT alpha FROM lr_best) END AS elasticNetParam,
      CASE WHEN model LIKE 'D%' THEN (SELECT CAST(depth AS DOUBLE) FROM dt_best) END AS maxDepth,
      CASE WHEN model LIKE 'D%' THEN (SELECT CAST(mb AS DOUBLE) FROM dt_best) END AS maxBins
    FROM both_err WHERE {ON_TEST} GROUP BY model""", BOTH)
add_recursive("artifact_tables", curve_of("both_err"), BOTH)
add_recursive("artifact_catalogue", f"""
    SELECT model, kind, n AS n_rows FROM (
      SELECT 'LinearRegression_Tuned' AS model, 'cv_results_csv' AS kind, count(*) AS n FROM lr_cv
      UNION ALL SELECT 'DecisionTree_Tuned', 'cv_results_csv', count(*) FROM dt_cv
      UNION ALL SELECT model, 'learning_curve_csv', count(DISTINCT grp) FROM both_err WHERE grp >= 10 GROUP BY model
      UNION ALL SELECT 'LinearRegression_Tuned', 'coefficients_csv', {K}
      UNION ALL SELECT 'DecisionTree_Tuned', 'feature_importances_csv', {K}
      UNION ALL SELECT DISTINCT model, 'metrics.json', 1 FROM both_err
      UNION ALL SELECT model, 'plot_data_csv', count(*) FROM both_err WHERE {ON_TEST} AND sampled GROUP BY model) WHERE n > 0""", BOTH)
TWO_BOARD = ranked(board_scores("model", "both_err", ON_TEST))
add_recursive("report_leaderboard", TWO_BOARD, BOTH)
add_recursive("tidy_export", f"""
    SELECT 'cv' AS kind, 'LinearRegression_Tuned' AS model, CAST(grid_idx AS DOUBLE) AS item, {r6('avg_rmse')} AS value FROM lr_cv
    UNION ALL SELECT 'cv', 'DecisionTree_Tuned', CAST(grid_idx AS DOUBLE), {r6('avg_rmse')} FROM dt_cv
    UNION ALL SELECT 'curve', model, fraction, test_rmse FROM ({curve_of('both_err')})
    UNION ALL SELECT 'sample', model, CAST(count(*) AS DOUBLE), {r6('avg(y0 - e)')} FROM both_err WHERE {ON_TEST} AND sampled GROUP BY model
    UNION ALL SELECT 'board', model, CAST(rank AS DOUBLE), test_rmse FROM ({TWO_BOARD})""", BOTH)

# --- the hashed forest: Poisson weights and feature subsets from hashes -----------------

TREES = max(FOREST_GRID["numTrees"])


def poisson_steps() -> list[int]:
    """Hash values from which a row is drawn once, twice, and so on: the distribution times 2^32."""
    chances = [math.exp(-1.0) / math.factorial(k) for k in range(20)]
    steps = [math.floor(sum(chances[:k + 1]) * 2 ** 32) for k in range(20)]
    return [x for x in steps if x < 2 ** 32 - 1]


DRAWN = ("CAST('0x' || substr(md5('forest-' || t || '|' || CAST(STATION AS VARCHAR) || '|' || CAST(DATE_HOUR AS VARCHAR)), 1, 8) AS BIGINT)")
DRAWS = " + ".join(f"CASE WHEN h >= {x} THEN 1.0e0 ELSE 0.0e0 END" for x in poisson_steps())
NAMED = ", ".join(f"({i}, '{c}')" for i, c in enumerate(S.FEATURES_ALL))
FOREST_LEVELS = FOREST_GRID["maxDepth"]


def forest_ctes(source: str) -> str:
    """``hf_cv`` and ``hf_err`` from flagged rows; group and tree make one number."""
    counts = ", ".join(f"({n})" for n in FOREST_GRID["numTrees"])
    return f"""hf_draws AS MATERIALIZED (SELECT t, rid, {DRAWS} AS w FROM (SELECT t, rid, {DRAWN} AS h FROM {source}, (SELECT unnest(range(0, {TREES})) AS t))),
  hf_subsets AS MATERIALIZED (SELECT g * 100 + t AS grp, f FROM (SELECT t, f, row_number() OVER (PARTITION BY t
      ORDER BY substr(md5('forest|' || t || '|' || name), 1, 8), name) AS place
    FROM (VALUES {NAMED}) AS v(f, name), (SELECT unnest(range(0, {TREES})) AS t)), (SELECT unnest([0, 1, 2, 3]) AS g)
    WHERE place <= {math.ceil(K / 3)}),
  hf_rows AS MATERIALIZED (SELECT s.grp * 100 + t AS grp, role, s.rid, y, w, {INPUTS}
    FROM ({study_rows(f"rid, TMP_C AS y, {INPUTS}", source)}) s JOIN hf_draws d ON s.rid = d.rid
    WHERE s.grp < 10 AND (role = 'score' OR w > 0)),
  {grown_tree('hf_rows', [32], max(FOREST_LEVELS), 'hf_', LEAST, 'w', 'hf_subsets')},
  {leaf_errors(FOREST_LEVELS, 'hf_', 'w')},
  hf_sizes AS (SELECT * FROM (VALUES {counts}) AS v(trees)),
  hf_mean AS MATERIALIZED (SELECT grp // 100 AS grp, depth, trees, rid, any_value(y) AS y, any_value(y) - avg(p) AS e
    FROM hf_leaf_rows, hf_sizes WHERE role = 'score' AND grp % 100 < trees GROUP BY grp // 100, depth, trees, rid),
  hf_cv AS MATERIALIZED (SELECT depth, trees, avg(r) AS avg_rmse, CAST(row_number() OVER (ORDER BY depth, trees) - 1 AS INTEGER) AS grid_idx
    FROM (SELECT depth, trees, grp, sqrt(avg(e * e)) AS r FROM hf_mean WHERE grp < 3 GROUP BY depth, trees, grp) GROUP BY depth, trees),
  hf_best AS MATERIALIZED (SELECT depth, trees FROM hf_cv ORDER BY round(avg_rmse, 9), grid_idx LIMIT 1),
  hf_err AS MATERIALIZED (SELECT 'HashedForest_Tuned' AS model, m.grp, 'score' AS role, sampled, y AS y0, e
    FROM hf_mean m JOIN hf_best USING (depth, trees) JOIN (SELECT rid, sampled FROM {source}) f ON m.rid = f.rid)"""


FOREST = f"{FRACTION_CTE},\n{FLAGGED_ROWS},\n{forest_ctes('flagged')}"
HF_RMSE, HF_R2 = held_score("hf_err")
add("rf_hashed", "labelled", f"""
    SELECT 'HashedForest_Tuned' AS model, grid_idx, depth AS maxDepth, trees AS numTrees, {r6('avg_rmse')} AS avg_rmse,
      {HF_RMSE} AS test_rmse, {HF_R2} AS test_r2 FROM hf_cv""", FOREST)

# --- two rounds of boosting on all features: trees over the residuals of trees ----------

BOOST_LEVELS = BOOST_GRID["maxDepth"]


def boost_ctes(source: str) -> str:
    """``gbt_cv`` and ``gbt_err`` from flagged rows; the second round's groups are group and depth."""
    levels = " UNION ALL ".join(
        f"SELECT * FROM bt_leaf_rows WHERE depth = {n} AND grp % 10 = {n}" for n in BOOST_LEVELS)
    return f"""bo_rows AS MATERIALIZED (SELECT * FROM ({study_rows(f"rid, TMP_C AS y, {INPUTS}", source)}) WHERE grp < 10),
  {grown_tree('bo_rows', [32], max(BOOST_LEVELS), 'bo_', LEAST)},
  {leaf_errors(BOOST_LEVELS, 'bo_')},
  bt_rows AS MATERIALIZED (SELECT l.grp * 10 + depth AS grp, l.role, l.rid, 2 * l.e AS y, {INPUTS}
    FROM bo_leaf_rows l JOIN bo_rows b ON l.grp = b.grp AND l.rid = b.rid),
  {grown_tree('bt_rows', [32], max(BOOST_LEVELS), 'bt_', LEAST)},
  {leaf_errors(BOOST_LEVELS, 'bt_')},
  bt_own AS MATERIALIZED ({levels}),
  boosted_rows AS MATERIALIZED (SELECT l.grp, l.depth, rounds, l.role, l.rid, l.y, l.e - CASE WHEN rounds = 2 THEN 0.1e0 * t.p ELSE 0 END AS e
    FROM bo_leaf_rows l JOIN bt_own t ON t.grp = l.grp * 10 + l.depth AND t.rid = l.rid, (SELECT unnest([1, 2]) AS rounds)
    WHERE l.role = 'score'),
  gbt_cv AS MATERIALIZED (SELECT depth, rounds, avg(r) AS avg_rmse, CAST(row_number() OVER (ORDER BY depth, rounds) - 1 AS INTEGER) AS grid_idx
    FROM (SELECT depth, rounds, grp, sqrt(avg(e * e)) AS r FROM boosted_rows WHERE grp < 3 GROUP BY depth, rounds, grp) GROUP BY depth, rounds),
  gbt_best AS MATERIALIZED (SELECT depth, rounds FROM gbt_cv ORDER BY round(avg_rmse, 9), grid_idx LIMIT 1),
  gbt_err AS MATERIALIZED (SELECT 'GBT_Tuned' AS model, b.grp, role, sampled, y AS y0, e
    FROM boosted_rows b JOIN gbt_best USING (depth, rounds) JOIN (SELECT rid, sampled FROM {source}) f ON b.rid = f.rid)"""


BOOSTED = f"{FRACTION_CTE},\n{FLAGGED_ROWS},\n{boost_ctes('flagged')}"
GBT_RMSE, GBT_R2 = held_score("gbt_err")
add("gbt_shallow", "labelled", f"""
    SELECT 'GBT_Tuned' AS model, grid_idx, depth AS maxDepth, rounds AS maxIter, {r6('avg_rmse')} AS avg_rmse,
      {GBT_RMSE} AS test_rmse, {GBT_R2} AS test_r2 FROM gbt_cv""", BOOSTED)
FOUR = (f"{BOTH},\n{forest_ctes('flagged')},\n{boost_ctes('flagged')},\nfour_err AS MATERIALIZED (SELECT * FROM both_err WHERE {ON_TEST} "
        f"UNION ALL SELECT * FROM hf_err WHERE {ON_TEST} UNION ALL SELECT * FROM gbt_err WHERE {ON_TEST})")
add_recursive("report_four_checked", ranked(board_scores("model", "four_err")), FOUR)

# --- sources and sinks ----------------------------------------------------------------

add("src_csv_roundtrip", "obs", "SELECT " + ", ".join(S.RAW_COLUMNS) + " FROM obs")
add("src_csv_mixed_headers", "obs", "SELECT " + ", ".join(S.RAW_COLUMNS) + " FROM obs")
add("sink_parquet_roundtrip", "labelled", "SELECT STATION, DATE_HOUR, TMP_C, DEW_C, split FROM labelled")
