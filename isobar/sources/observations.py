"""Packed station observations derived from the ``events`` table.

No weather archive is at hand, so each event is spelled out as one raw observation in the
packed text layout, missing-value markers included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "ts")
    base = events.selectExpr(
        "event_id AS e",
        "user_id % 20 AS u",
        "cast(ts AS string) AS s",
        "(event_id * 71) % 700 - 200 AS t",
    ).selectExpr("*", "t + 10 - (e * 29) % 150 AS d")
    return base.selectExpr(
        "e AS obs_id",
        "'S' || lpad(cast(u AS string), 3, '0') AS STATION",
        """substr(s, 1, 10) || 'T' || substr(s, 12, 2) || ':'
           || CASE WHEN e % 4 <> 3 THEN '00' ELSE substr(s, 15, 2) END || ':00' AS DATE""",
        "cast(u * 4.5D - 40.0D AS string) AS LATITUDE",
        "cast(u * 17.5D - 170.0D AS string) AS LONGITUDE",
        "cast(u * 60.5D AS string) AS ELEVATION",
        """CASE WHEN e % 7 = 0 THEN '999,9,V,0021,1'
                WHEN e % 29 = 0 THEN '999,9,C,0000,1'
                WHEN e % 17 = 0 THEN '210,1,N,9999,9'
                ELSE lpad(cast((e * 37) % 361 AS string), 3, '0') || ',1,N,'
                     || lpad(cast((e * 13) % 300 AS string), 4, '0') || ',1' END AS WND""",
        """CASE WHEN e % 13 = 0 THEN '+9999,9'
                ELSE CASE WHEN t < 0 THEN '-' ELSE '+' END
                     || lpad(cast(abs(t) AS string), 4, '0') || ',1' END AS TMP""",
        """CASE WHEN e % 31 = 0 THEN '+9999,9'
                ELSE CASE WHEN d < 0 THEN '-' ELSE '+' END
                     || lpad(cast(abs(d) AS string), 4, '0') || ',1' END AS DEW""",
        """CASE WHEN e % 19 = 0 THEN '99999,9'
                ELSE lpad(cast(9500 + (e * 31) % 900 AS string), 5, '0') || ',1' END AS SLP""",
        """CASE WHEN e % 23 = 0 THEN '999999,9,N,9'
                ELSE lpad(cast((e * 97) % 20000 AS string), 6, '0') || ',1,N,1' END AS VIS""",
        """CASE WHEN e % 5 = 0 THEN NULL
                ELSE lpad(cast(1 + e % 24 AS string), 2, '0') || ','
                     || lpad(cast((e * 7) % 200 AS string), 4, '0') || ',9,5' END AS AA1""",
    )
