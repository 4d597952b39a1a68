"""Run every registered query next to its SQL and compare rows exactly.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return v


def as_multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str):
    """(spark rows, sql rows, spark-only, sql-only) or a column mismatch message."""
    cur = con.execute(sql)
    sql_cols = [c[0] for c in cur.description]
    if sorted(df.columns) != sorted(sql_cols):
        return f"columns {sorted(df.columns)} != {sorted(sql_cols)}"
    want = as_multiset(sql_cols, cur.fetchall())
    got = as_multiset(df.columns, [tuple(r) for r in df.collect()])
    return sum(got.values()), sum(want.values()), got - want, want - got


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from isobar.session import local_session, scratch_scope

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        t = time.time()
        try:
            with scratch_scope(spark):
                df = queries()[name](spark, sf_dir)
                if name not in oracle_sql():
                    print(f"\n{name}: rows only, {len(df.collect())} rows, {time.time() - t:.1f}s", flush=True)
                    continue
                result = differences(df, con, oracle_sql()[name])
        except Exception as exc:  # noqa: BLE001
            result = f"{type(exc).__name__}: {str(exc)[:600]}"
        if isinstance(result, str) or result[2] or result[3]:
            bad += 1
            shown = result if isinstance(result, str) else (result[:2], list(result[2].items())[:3], list(result[3].items())[:3])
            print(f"\n{name}: MISMATCH {shown}", flush=True)
        else:
            print(f"\n{name}: equal, {result[0]} rows, {time.time() - t:.1f}s", flush=True)
    print(f"\n{bad} mismatches of {len(names)}")


if __name__ == "__main__":
    main()
