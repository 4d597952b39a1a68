"""Exact top-k against a full scan."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.llm import topk

NAN, INF = float("nan"), float("inf")


def scan(rows, k, every):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in usable:  # a row that repeats an id is a query of its own
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, k=5, every=3, **blocks):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    got = topk.exact_top_k(df.repartition(3), F.col("vec_id") % every == 0, k, **blocks).collect()
    return sorted(tuple(r) for r in got)


@pytest.mark.parametrize("blocks", [{}, {"query_block": 3, "row_block": 7}])
def test_equals_a_full_scan(spark, blocks):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.3, 8) * (rng.random(8) < 0.6)]) for i in range(60)]
    rows += [(100, rows[0][1]), (101, rows[0][1]), (102, rows[3][1])]  # ties
    rows += [(200, None), (201, [0.1, None] + [0.0] * 6), (202, [NAN] * 8), (203, [INF] + [0.0] * 7), (None, rows[1][1]), (204, [])]
    assert run(spark, rows, **blocks) == scan(rows, 5, 3)


def test_fewer_candidates_than_k_and_empty_table(spark):
    assert run(spark, [(0, [1.0]), (1, [-0.001])]) == [(0, 1, 1, -256)]
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, []) == []


def test_repeated_query_ids_have_their_own_winners(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.3, 4)]) for i in range(30)]
    rows += [(0, rows[0][1]), (0, rows[5][1]), (7, rows[7][1]), (3, [0.5])]
    got = run(spark, rows)
    assert got == scan(rows, 5, 3)
    assert [g[1] for g in got if g[0] == 0] == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4, 5, 5, 5]
    assert run(spark, rows, query_block=2, row_block=5) == got
