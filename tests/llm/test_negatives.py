"""Hard negatives against a full scan; the tree's eliminations against all distances."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.llm import negatives

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int"


def scan(rows, every, positives=5, limit=10):
    """Every anchor row against every other row."""
    usable = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.append((i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for k, (i, a, label) in enumerate(usable):
        if i % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a, b)), j, own) for m, (j, b, own) in enumerate(usable) if m != k]
        for p, j, _ in sorted(s for s in scored if s[2] == label)[:positives]:
            fits = sorted((s, n) for s, n, own in scored if own != label and 30 * -p <= 100 * -s <= 90 * -p)
            out += [(i, j, r + 1, n, -p, -s) for r, (s, n) in enumerate(fits[:limit])]
    return sorted(out)


def run(spark, rows, every=10, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("row", "id", "v", "w", "score", "leaf")})
    got = negatives.hard_negatives(negatives.noisy_labels(df.repartition(3)), F.col("vec_id") % every == 0, **options)
    return sorted(map(tuple, got.collect()))


def clustered(seed, count, dim=3, centres=12):
    """Rows around a few centres: subtrees lie apart, so ranges exclude some."""
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 1, (centres, dim))
    near = middle[rng.integers(0, centres, count)] + rng.normal(0, 0.1, (count, dim))
    return [(i, [float(np.float32(x)) for x in v], int(rng.integers(0, 3))) for i, v in enumerate(near)]


@pytest.mark.parametrize("options", [{}, {"leaf_rows": 20, "fanout": 3, "query_block": 4, "row_block": 7}])
def test_equals_a_full_scan(spark, options):
    rows = clustered(1, 300)
    rows += [(1000 + k, rows[0][1], k % 3) for k in range(100)]  # a quarter of the table is one vector
    rows += [(2000, None, 1), (2010, [0.1, None, 0.2], 1), (2020, [NAN] * 3, 1), (2030, [INF, 0.0, 0.0], 1),
             (None, rows[1][1], 1), (2040, rows[2][1], None), (2050, [], 2), (2060, [0.5], 1), (2070, [0.0] * 3, 0)]
    assert run(spark, rows, **options) == scan(rows, 10)


def test_rows_that_repeat_an_id_are_rows_of_their_own(spark):
    rows = clustered(2, 80)
    rows += [(0, rows[0][1], rows[0][2]), (0, rows[3][1], 2), (20, rows[20][1], rows[20][2])]
    assert run(spark, rows, leaf_rows=16) == scan(rows, 10)


def test_small_and_empty_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(10, [1.0], 1)]) == []
    assert run(spark, [(10, [1.0], 1), (11, [1.0], 1), (12, [0.5], 2)]) == [(10, 11, 1, 12, 65536, 32768)]
    assert run(spark, [(10, [0.0], 1), (11, [0.0], 1), (12, [0.0], 2)]) == [(10, 11, 1, 12, 0, 0)]  # window of one score
    assert run(spark, [(10, [1.0], 1), (11, [-1.0], 1), (12, [-0.5], 2)]) == []  # a negative positive has no window


def test_vectors_beyond_exact_doubles(spark):
    rows = [(10, [2.0 ** 20, 3.0], 1), (11, [2.0 ** 20, 5.0], 1), (12, [2.0 ** 19, 7.0], 2), (13, [2.0 ** 19, 7.5], 2)]
    assert run(spark, rows) == scan(rows, 10)
    with pytest.raises(ValueError, match="long"):
        run(spark, [(10, [1e30], 1), (11, [1e30], 1)])


def test_ranges_leave_out_subtrees_and_lose_no_row():
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 300, (20, 4)).astype(np.int64)
    rows = centres[rng.integers(0, 20, 3000)] + rng.integers(-9, 10, (3000, 4))
    top = int((rows ** 2).sum(1).max())
    tree = negatives.Tree(4, top, *negatives.grown(negatives.lifted(rows[:800], top), 30, 4))
    for node in tree.nodes:
        node.least, node.most = np.full((len(node.points),) * 2, np.inf), np.full((len(node.points),) * 2, -np.inf)

    def seen(number, at, apart, child):
        node = tree.nodes[number]
        for j in np.unique(child):
            node.least[:, j] = np.minimum(node.least[:, j], apart[child == j].min(0))
            node.most[:, j] = np.maximum(node.most[:, j], apart[child == j].max(0))

    leaf = negatives.descended(tree, negatives.lifted(rows, top), seen)
    anchors = rows[::50]
    scores = anchors @ rows.T
    most = np.percentile(scores, 99, axis=1).astype(np.int64)[:, None]
    least = np.percentile(scores, 97, axis=1).astype(np.int64)[:, None]
    reach = (anchors ** 2).sum(1)[:, None] + top
    inner, outer = np.sqrt(reach - 2.0 * most), np.sqrt(reach - 2.0 * least)
    at, leaves = negatives.reached(tree, negatives.lifted(anchors, None), inner, outer)
    visited = set(zip(at.tolist(), leaves.tolist()))
    inside = (scores >= least) & (scores <= most)
    assert all((a, int(leaf[r])) in visited for a, r in zip(*np.nonzero(inside)))
    assert len(visited) < 0.6 * len(anchors) * tree.leaves
    one = negatives.reached(tree, negatives.lifted(anchors, None), inner, outer, True)
    assert len(one[0]) <= len(anchors) and set(zip(*map(np.ndarray.tolist, one))) <= visited


def test_one_vector_makes_one_leaf():
    same = np.ones((500, 3))
    assert negatives.grown(same, 40) == ([], 1)
