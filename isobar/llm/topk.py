"""Exact top-k by integer inner product: exhaustive term-at-a-time accumulation in blocks.

Candidates are dealt into blocks of rows. A block is an inverted index: for each dimension (term)
the posting list of its rows with a weight other than zero. A block of queries goes through the
terms one at a time; every query row with a weight for the term scatters weight times posting
weight into its dense score array over the block. The k best of each array are selected by
partition and the blocks' winners merged by rank, so nothing but k rows per query and block is
ever shuffled. All queries meet all blocks, in blocks of a fixed size on either side.

Vectors that are null, or hold a null or non-finite component, take no part; neither do rows with
a null id. A vector's missing trailing components count as zero. Rows that repeat an id are queries
and candidates of their own: each query row has its own k best, under the one id. No row is a candidate
for a query with its id. Ties go to the smaller id. With fewer than k candidates all are returned.
Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from isobar.llm.batches import offsets_of
from isobar.session import scratch_path

K = 5
SCALE = 256
QUERY_BLOCK = 512
ROW_BLOCK = 4096


def integer_vectors(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, v array<bigint>): floor(scale * component) of every usable vector."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    usable = F.col(id_column).isNotNull() & F.col(column).isNotNull() & F.forall(column, lambda x: F.coalesce(finite(x), F.lit(False)))
    scaled = F.transform(column, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    return vectors.filter(usable).select(id_column, scaled.alias("v"))


def matrix(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, dimension and weight of every component other than zero."""
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)
    dim = np.arange(len(flat)) - np.repeat(offsets_of(sizes)[:-1], sizes)
    used = flat != 0
    return row[used], dim[used], flat[used]


def by_dimension(row: np.ndarray, dim: np.ndarray, weight: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Posting lists: dimension -> (rows, weights)."""
    order = np.argsort(dim, kind="stable")
    row, dim, weight = row[order], dim[order], weight[order]
    cuts = np.flatnonzero(np.diff(dim, prepend=-1))
    ends = np.append(cuts[1:], len(dim))
    return {int(dim[a]): (row[a:b], weight[a:b]) for a, b in zip(cuts, ends)}


def accumulate(queries: dict, postings: dict, n_queries: int, n_rows: int) -> np.ndarray:
    """Dense integer scores, query by row, one term at a time."""
    scores = np.zeros((n_queries, n_rows), np.int64)
    for dim, (q_rows, q_weights) in queries.items():
        if dim in postings:
            rows, weights = postings[dim]
            if len(rows) == n_rows and len(q_rows) == n_queries:  # every cell gets a share
                scores += q_weights[:, None] * weights[None]
            else:
                scores[q_rows[:, None], rows[None]] += q_weights[:, None] * weights[None]
    return scores


def best_of(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, column) of each query's k best columns; ``ids`` ascend, so ties prefer smaller ids."""
    n = scores.shape[1]
    masked = np.where(ids[None] == own[:, None], np.iinfo(np.int64).min, scores)
    if n > k:
        bound = np.partition(masked, n - k, axis=1)[:, n - k]
        q, c = np.nonzero(masked >= bound[:, None])
    else:
        q, c = np.nonzero(np.ones_like(masked, bool))
    value = masked[q, c]
    order = np.lexsort((c, -value, q))
    q, c = q[order], c[order]
    first = np.searchsorted(q, q, side="left")
    keep = (np.arange(len(q)) - first < k) & (ids[c] != own[q])
    return q[keep], c[keep]


def exact_top_k(
    vectors: DataFrame, is_query: Column, k: int = K, id_column: str = "vec_id", column: str = "embedding",
    scale: int = SCALE, query_block: int = QUERY_BLOCK, row_block: int = ROW_BLOCK,
) -> DataFrame:
    """query_id, rank, id, score of each query's k best rows other than its own."""
    # Rows are numbered and written, so that rows of equal ids stay apart.
    path = scratch_path(vectors.sparkSession, "vectors")
    integer_vectors(vectors, id_column, column, scale).withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    rows = vectors.sparkSession.read.parquet(path)
    queries = rows.filter(is_query)
    n_queries, n_rows = queries.count(), rows.count()
    q_blocks, r_blocks = max(1, -(-n_queries // query_block)), max(1, -(-n_rows // row_block))
    spread = lambda n, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n)).cast("int")
    # A row block goes to each query block; the pair is the group that is worked on.
    candidates = (
        rows.withColumn("r", spread(r_blocks, 1))
        .withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
        .select("q", "r", F.lit(False).alias("asks"), F.col(id_column).alias("id"), "row", "v")
    )
    asked = (
        queries.withColumn("q", spread(q_blocks, 2))
        .withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(r_blocks - 1))))
        .select("q", "r", F.lit(True).alias("asks"), F.col(id_column).alias("id"), "row", "v")
    )

    def search(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        parts = []
        for asks in (True, False):
            part = table.filter(pc.equal(table.column("asks"), asks)).sort_by("id").combine_chunks()
            lists = part.column("v")
            lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
            parts.append((part.column("id").to_numpy(), part.column("row").to_numpy(), by_dimension(*matrix(lists))))
        (own, own_rows, q_terms), (ids, _, postings) = parts
        names = ["query", "query_id", "vec_id", "score"]
        if not len(own) or not len(ids):
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        scores = accumulate(q_terms, postings, len(own), len(ids))
        q, c = best_of(scores, ids, own, k)
        return pa.table({"query": own_rows[q], "query_id": own[q], "vec_id": ids[c], "score": scores[q, c]})

    found = candidates.unionByName(asked).groupBy("q", "r").applyInArrow(search, "query bigint, query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias(id_column), "score")
