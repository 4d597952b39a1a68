"""Hard negatives: exact window search by a multiway hyperplane tree with distance ranges.

Inner products become distances by one more component: rows get sqrt(M - |x|^2), M the largest squared
norm, anchors get 0. Then |q - x|^2 = |q|^2 + M - 2 score, so a window of scores is an annulus
around the anchor.

1. A bounded sample of rows gives the tree: a node has up to ``FANOUT`` split points, far from each
   other, and every row goes to the subtree of the nearest one. All rows are dealt to leaves, and all
   rows count for the ranges: a split point stores the least and largest distance to the rows of each
   sibling subtree.
2. An anchor walks down with its windows. By the triangle inequality the ranges bound the distance to
   every row of a subtree; subtrees whose bounds meet no window are left out.
3. In the leaves that remain integer scores of blocks of anchors and rows are exact, and the best
   ``limit`` rows of every window go out of a block. A leaf above ``ROW_BLOCK`` rows is several blocks,
   so equal vectors or a hot leaf never come together in one task.

Every search runs twice: first in one promising leaf per window, whose ``limit``-th score raises the
window's lower end, then in all leaves that the narrowed windows reach.

Rows with a null id, label or vector, or a null or non-finite component, take no part. A vector's missing
trailing components count as zero. Rows that repeat an id are rows of their own, as anchors and as
candidates; an anchor row is never its own candidate. Ties go to the smaller id. An anchor without
positives, or a positive whose window is empty, gives no row; an empty table gives none. Vectors whose
squared norm does not fit a long are an error. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from isobar.llm.batches import offsets_of
from isobar.session import scratch_path

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
# A negative's score lies between these hundredths of the positive's.
LEAST_SHARE, MOST_SHARE = 30, 90

SAMPLE = 4096  # rows that the split points are chosen from
FANOUT = 8
MOST_LEAVES = 512  # bounds the tree that is sent to tasks
LEAF_ROWS = 4096
QUERY_BLOCK = 512
ROW_BLOCK = 4096
EXACT = 1 << 53  # integers below it are exact as doubles
FAR = 1 << 62


# --- the tree -------------------------------------------------------------------------

@dataclass
class Node:
    points: np.ndarray  # split points, with the added component
    children: list[int]  # number of a node, or -1 - number of a leaf
    least: np.ndarray = field(default_factory=lambda: np.empty(0))  # from point i to the rows under child j
    most: np.ndarray = field(default_factory=lambda: np.empty(0))


@dataclass
class Tree:
    dim: int
    top: int  # largest squared norm
    nodes: list[Node]
    leaves: int

    @property
    def slack(self) -> float:
        """More than distances can be off by rounding."""
        return 1e-6 * (1.0 + float(self.top) ** 0.5)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def lifted(rows: np.ndarray, top: int | None) -> np.ndarray:
    """Rows with the added component; 0 for anchors (``top`` None)."""
    rows = rows.astype(np.float64)
    extra = np.zeros(len(rows)) if top is None else np.sqrt(np.maximum(float(top) - (rows * rows).sum(1), 0))
    return np.column_stack([rows, extra])


def far_points(rows: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` different rows, each the farthest from those before it."""
    nearest = distances(rows, rows.mean(0)[None])[:, 0]
    least = 1e-6 * (1.0 + nearest.max())
    chosen = [int(nearest.argmax())]
    nearest = distances(rows, rows[chosen])[:, 0]
    while len(chosen) < count and nearest.max() > least:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, distances(rows, rows[chosen[-1:]])[:, 0])
    return rows[chosen]


def grown(sample: np.ndarray, leaves: int, fanout: int = FANOUT) -> tuple[list[Node], int]:
    """Nodes, the root first, and how many leaves; no node if one leaf is enough."""
    nodes: list[Node] = []
    made = 0

    def grow(rows: np.ndarray, share: int) -> int:
        nonlocal made
        points = far_points(rows, min(fanout, share)) if share > 1 and len(rows) > 1 else rows[:1]
        if len(points) < 2:
            made += 1
            return -made
        number = len(nodes)
        nodes.append(Node(points, []))
        child = distances(rows, points).argmin(1)
        sizes = np.bincount(child, minlength=len(points))
        for j, size in enumerate(sizes):
            nodes[number].children.append(grow(rows[child == j], round(share * size / len(rows))))
        return number

    grow(sample, leaves)
    return nodes, made


def descended(tree: Tree, rows: np.ndarray, seen: Callable[[int, np.ndarray, np.ndarray, np.ndarray], None] | None = None) -> np.ndarray:
    """Leaf of every row; ``seen`` is told each node's rows, their distances and children."""
    leaf = np.zeros(len(rows), np.int64)

    def walk(number: int, at: np.ndarray) -> None:
        node = tree.nodes[number]
        apart = distances(rows[at], node.points)
        child = apart.argmin(1)
        if seen:
            seen(number, at, apart, child)
        for j, goal in enumerate(node.children):
            mine = at[child == j]
            if len(mine):
                if goal < 0:
                    leaf[mine] = -1 - goal
                else:
                    walk(goal, mine)

    if tree.nodes and len(rows):
        walk(0, np.arange(len(rows)))
    return leaf


def reached(tree: Tree, anchors: np.ndarray, inner: np.ndarray, outer: np.ndarray, probe: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, leaf) pairs whose bounds meet one of the anchor's annuli (anchor x window; none: inner > outer).

    With ``probe`` each window goes down to one leaf only, whose bounds lie closest around its inner radius.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    slack = tree.slack

    def arrive(goal: int, at: np.ndarray, open_: np.ndarray) -> None:
        if not len(at):
            return
        if goal < 0:
            found.append((at, np.full(len(at), -1 - goal)))
            return
        node = tree.nodes[goal]
        apart = distances(anchors[at], node.points)[:, :, None]
        low = np.maximum(np.maximum(apart - node.most, node.least - apart).max(1), 0)  # anchor x child
        high = (apart + node.most).min(1)
        meets = open_[:, :, None] & (low[:, None] <= outer[at][:, :, None] + slack) & (high[:, None] >= inner[at][:, :, None] - slack)
        if probe:
            centre = np.where(np.isfinite(low + high), (low + high) / 2, np.inf)
            gap = np.where(meets, np.abs(centre[:, None] - inner[at][:, :, None]), np.inf)
            meets &= np.arange(gap.shape[2]) == gap.argmin(2)[:, :, None]
        for j, child in enumerate(node.children):
            some = meets[:, :, j].any(1)
            arrive(child, at[some], meets[some, :, j])

    used = inner <= outer
    some = used.any(1)
    arrive(0 if tree.nodes else -1, np.flatnonzero(some), used[some])
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


# --- vectors in tasks -----------------------------------------------------------------

def matrix(lists: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Integer rows, missing trailing components zero."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), dim), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(offsets_of(sizes)[:-1], sizes)] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def bounds(lists: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number, least and most score of every window, anchor x window; unused places have least > most."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(row)) - np.repeat(offsets_of(sizes)[:-1], sizes)
    flat = lists.flatten()
    out = []
    for name, unused in (("w", -1), ("least", 1), ("most", 0)):
        values = np.full((len(sizes), int(sizes.max(initial=1))), unused, np.int64)
        values[row, place] = flat.field(name).to_numpy(zero_copy_only=False)
        out.append(values)
    return out[0], out[1], out[2]


def inner_products(a: np.ndarray, b: np.ndarray, top: int) -> np.ndarray:
    """Exact scores; products and their sums stay below the largest squared norm."""
    if top < EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def best(scores: np.ndarray, allowed: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``limit`` best allowed columns of every row, best first; ties to the left."""
    masked = np.where(allowed, scores, -FAR)
    n = masked.shape[1]
    if n > limit:
        bound = np.partition(masked, n - limit, axis=1)[:, n - limit]
        row, column = np.nonzero(allowed & (masked >= bound[:, None]))
    else:
        row, column = np.nonzero(allowed)
    order = np.lexsort((column, -masked[row, column], row))
    row, column = row[order], column[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row, side="left") < limit
    return row[keep], column[keep]


# --- the search -----------------------------------------------------------------------

@dataclass
class Index:
    """All rows dealt to leaves, and the tree."""

    rows: DataFrame  # leaf, row, id, label, v, asks
    tree: Tree
    sizes: dict[int, int]  # rows of each leaf


def usable_rows(vectors: DataFrame, is_anchor: Column, id_column: str, label: str, column: str, scale: int) -> DataFrame:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    given = F.col(id_column).isNotNull() & F.col(label).isNotNull() & F.col(column).isNotNull()
    whole = F.forall(column, lambda x: F.coalesce(finite(x), F.lit(False)))
    scaled = F.transform(column, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    return vectors.filter(given & whole).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("bigint").alias("id"), F.col(label).alias("label"),
        scaled.alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    )


def indexed(rows: DataFrame, sample: int = SAMPLE, leaf_rows: int = LEAF_ROWS, fanout: int = FANOUT, most_leaves: int = MOST_LEAVES) -> Index | None:
    """The tree over a written table of (row, id, label, v, asks); None for an empty one."""
    spark = rows.sparkSession
    square = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    n, dim, top = rows.agg(F.count("*"), F.max(F.size("v")), F.max(square)).first()
    if not n:
        return None
    if top >= FAR:
        raise ValueError("vectors too long: scores would not fit a long")
    chosen = rows.orderBy(F.xxhash64("row"), "row").limit(sample).select("v").toArrow()
    # Sums of squares below 2^53 are exact; above, one more in a million keeps the added component real.
    tree = Tree(dim, int(top) if top < EXACT else int(top * (1 + 1e-6)), [], 1)
    tree.nodes, tree.leaves = grown(lifted(matrix(chosen.column("v"), dim), tree.top), min(most_leaves, -(-n // leaf_rows)), fanout)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = descended(tree, lifted(matrix(batch.column("v"), dim), tree.top))
            yield pa.RecordBatch.from_arrays([pa.array(leaf), *batch.columns], ["leaf", *batch.schema.names])

    kinds = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
    path = scratch_path(spark, "leaves")
    rows.mapInArrow(deal, f"leaf bigint, {kinds}").write.parquet(path)
    dealt = spark.read.parquet(path)
    sizes = {r.leaf: r["count"] for r in dealt.groupBy("leaf").count().collect()}  # at most MOST_LEAVES

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

        def seen(node: int, at: np.ndarray, apart: np.ndarray, child: np.ndarray) -> None:
            for j in np.unique(child):
                part = apart[child == j]
                low, high = kept.get((node, int(j)), (np.inf, -np.inf))
                kept[node, int(j)] = np.minimum(low, part.min(0)), np.maximum(high, part.max(0))

        for batch in batches:
            descended(tree, lifted(matrix(batch.column("v"), dim), tree.top), seen)
        rows = [(node, j, i, a, b) for (node, j), (low, high) in kept.items() for i, (a, b) in enumerate(zip(low, high))]
        names = ["node", "child", "point", "least", "most"]
        kinds = [pa.int64()] * 3 + [pa.float64()] * 2
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)

    for node in tree.nodes:
        count = len(node.points)
        node.least, node.most = np.full((count, count), np.inf), np.full((count, count), -np.inf)
    if tree.nodes:
        ranges = dealt.select("v").mapInArrow(measure, "node bigint, child bigint, point bigint, least double, most double")
        for r in ranges.groupBy("node", "child", "point").agg(F.min("least").alias("least"), F.max("most").alias("most")).collect():
            tree.nodes[r.node].least[r.point, r.child] = r.least
            tree.nodes[r.node].most[r.point, r.child] = r.most
    return Index(dealt, tree, sizes)


def visits(index: Index, anchors: DataFrame, probe: bool) -> DataFrame:
    """``anchors`` (row, id, label, v, windows) once per leaf to look into, with ``leaf``."""
    tree = index.tree

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column("v"), tree.dim)
            _, least, most = bounds(batch.column("windows"))
            reach = (rows.astype(np.float64) ** 2).sum(1)[:, None] + float(tree.top)
            inner, outer = (np.sqrt(np.maximum(reach - 2.0 * s, 0)) for s in (most, least))
            unused = least > most
            inner[unused], outer[unused] = 1, 0
            at, leaf = reached(tree, lifted(rows, None), inner, outer, probe)
            yield pa.RecordBatch.from_arrays([pa.array(leaf), *(c.take(pa.array(at)) for c in batch.columns)], ["leaf", *batch.schema.names])

    kinds = ", ".join(f"`{c}` {t}" for c, t in anchors.dtypes)
    return anchors.mapInArrow(run, f"leaf bigint, {kinds}")


def searched(
    index: Index, anchors: DataFrame, same: bool, limit: int, probe: bool = False,
    query_block: int = QUERY_BLOCK, row_block: int = ROW_BLOCK,
) -> DataFrame:
    """(row, w, rank, id, score): the ``limit`` best rows of equal (``same``) or other label in each window."""
    spark, dim, top = anchors.sparkSession, index.tree.dim, index.tree.top
    path = scratch_path(spark, "visits")
    visits(index, anchors, probe).write.parquet(path)
    asked = spark.read.parquet(path)
    # At most MOST_LEAVES rows.
    plan = [
        (r.leaf, -(-r["count"] // query_block), -(-index.sizes.get(r.leaf, 0) // row_block))
        for r in asked.groupBy("leaf").count().collect()
    ]
    blocks = F.broadcast(spark.createDataFrame(plan, "leaf long, qs long, rs long"))
    block = lambda n: F.pmod(F.xxhash64("row"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    rows = index.rows.join(blocks, "leaf").select("leaf", block("rs").alias("r"), every("qs").alias("q"), F.lit(False).alias("asks"), "row", "id", "label", "v")
    empty = F.array().cast("array<struct<w:bigint,least:bigint,most:bigint>>")
    rows = rows.withColumn("windows", empty)
    asked = asked.join(blocks.filter("rs > 0"), "leaf").select("leaf", block("qs").alias("q"), every("rs").alias("r"), F.lit(True).alias("asks"), "row", "id", "label", "v", "windows")
    names = ["row", "w", "id", "other", "score"]

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ask = table.filter(table.column("asks"))
        give = table.filter(pc.invert(table.column("asks"))).sort_by([("id", "ascending"), ("row", "ascending")])
        scores = inner_products(matrix(ask.column("v"), dim), matrix(give.column("v"), dim), top)
        a_row, a_label = ask.column("row").to_numpy(), ask.column("label").to_numpy()
        g_row, g_id, g_label = (give.column(c).to_numpy() for c in ("row", "id", "label"))
        fits = ((a_label[:, None] == g_label[None]) == same) & (a_row[:, None] != g_row[None])
        number, least, most = bounds(ask.column("windows"))
        out: list[list[np.ndarray]] = [[] for _ in names]
        for k in range(number.shape[1]):
            allowed = fits & (scores >= least[:, k, None]) & (scores <= most[:, k, None])
            a, g = best(scores, allowed, limit)
            for values, part in zip(out, (a_row[a], number[a, k], g_id[g], g_row[g], scores[a, g])):
                values.append(part)
        return pa.table({n: np.concatenate(v) if v else np.empty(0, np.int64) for n, v in zip(names, out)})

    found = rows.unionByName(asked).groupBy("leaf", "q", "r").applyInArrow(run, ", ".join(f"{n} bigint" for n in names))
    order = Window.partitionBy("row", "w").orderBy(F.desc("score"), "id", "other")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)
    return ranked.select("row", "w", "rank", "id", "score")


def narrowed(anchors: DataFrame, found: DataFrame, limit: int) -> DataFrame:
    """Windows whose lower end is raised to the ``limit``-th score already found in them."""
    full = found.filter(F.col("rank") == limit).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("got"))

    def raised(x: Column) -> Column:
        least = F.greatest(x["least"], F.coalesce(F.try_element_at("got", x["w"]), x["least"]))
        return F.struct(x["w"].alias("w"), least.alias("least"), x["most"].alias("most"))

    return anchors.join(full, "row", "left").withColumn("windows", F.transform("windows", raised)).drop("got")


def best_in_windows(index: Index, anchors: DataFrame, same: bool, limit: int, label: str, **blocks: int) -> DataFrame:
    """The probing search, then the whole one; a written table."""
    spark = anchors.sparkSession
    first = searched(index, anchors, same, limit, True, **blocks)
    path = scratch_path(spark, label)
    searched(index, narrowed(anchors, first, limit), same, limit, **blocks).write.parquet(path)
    return spark.read.parquet(path)


def noisy_labels(vectors: DataFrame, id_column: str = "vec_id", label: str = "label") -> DataFrame:
    """The same rows; where 7 divides the id, the label is the next of ten."""
    return vectors.withColumn(label, F.when(F.col(id_column) % 7 == 0, (F.col(label) + 1) % 10).otherwise(F.col(label)))


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    least_share: int = LEAST_SHARE, most_share: int = MOST_SHARE, id_column: str = "vec_id", label: str = "label",
    column: str = "embedding", scale: int = SCALE, sample: int = SAMPLE, leaf_rows: int = LEAF_ROWS, fanout: int = FANOUT,
    **blocks: int,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    An anchor's positives are its ``positives`` best rows of the same label; a positive's negatives are the
    best rows of other labels that score between ``least_share`` and ``most_share`` hundredths of it.
    """
    spark = vectors.sparkSession
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    path = scratch_path(spark, "vectors")
    usable_rows(vectors, is_anchor, id_column, label, column, scale).write.parquet(path)
    index = indexed(spark.read.parquet(path), sample, leaf_rows, fanout)
    if index is None:
        return spark.createDataFrame([], schema)
    window = lambda w, a, b: F.struct(w.cast("bigint").alias("w"), a.cast("bigint").alias("least"), b.cast("bigint").alias("most"))
    anchors = index.rows.filter("asks").select("row", "id", "label", "v")
    all_scores = F.array(window(F.lit(0), F.lit(-index.tree.top), F.lit(index.tree.top)))
    near = best_in_windows(index, anchors.withColumn("windows", all_scores), True, positives, "positives", **blocks)
    # Whole scores between the shares: the lower end rounded up, the upper one down.
    whole = lambda x: F.expr(f"({x} - pmod({x}, 100)) div 100")
    least, most = whole(f"(score * {int(least_share)}L + 99L)"), whole(f"(score * {int(most_share)}L)")
    ranges = near.select("row", window(F.col("rank"), least, most).alias("x")).filter("x.least <= x.most")
    asked = anchors.join(ranges.groupBy("row").agg(F.sort_array(F.collect_list("x")).alias("windows")), "row")
    far = best_in_windows(index, asked, False, negatives, "negatives", **blocks)
    pairs = near.select("row", F.col("rank").alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = pairs.join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
    return far.join(named, ["row", "w"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
