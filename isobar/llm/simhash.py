"""SimHash near-duplicates: exact linking of fingerprints within a Hamming radius.

A fingerprint is 64 majority votes over the XXH64 values of a text's word shingles.
Fingerprints within ``radius`` bits are linked, and components of links are found without
ever listing the pairs of a group:

1. Distinct fingerprints are the nodes, so exact copies cost nothing further.
2. Correlated bits are put into the same partition of the 64 positions. Each partition gets a
   threshold of its own; by the generalised pigeonhole principle the thresholds of m partitions
   may sum to radius - m + 1 (-1 leaves a partition out). Dynamic programming picks them so that
   the estimated probes plus candidates are fewest, for several m.
3. A node is dealt to one bucket per partition, and as a visitor to the buckets whose key differs
   by up to the threshold; of two nodes only one visits the other. Buckets with a single row are
   dropped. Inside a bucket a breadth-first search with popcounts gives a spanning forest of the
   true links, at most one edge per row.
4. A bucket above ``block`` rows is cut into blocks, and pairs of blocks are separate work, so no
   task holds more than two blocks.
5. Components: every node joins its smallest neighbour in a hashed order, the graph is contracted,
   and again until no edge is left.

Null and empty texts have fingerprint zero and are linked like any other. Rows with equal ids or
texts stay separate rows. A null id keeps its row; it never names a component unless all ids of
the component are null. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from isobar.llm.batches import map_slices, offsets_of, words
from isobar.session import scratch_path

BITS = 64
SEED = 42
RADIUS = 4
SHINGLE = 4
BLOCK = 4096
SAMPLE = 2000  # fingerprints whose bits are compared to choose partitions
VOTES = 1 << 16  # shingles whose bits are unpacked at once
SMALL = 12  # buckets up to this size are compared pair by pair
# Cost of one dealt row against one compared pair.
ROW_COST = 20.0


# --- fingerprints ---------------------------------------------------------------------

def shingle_hashes(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle of the lower-cased texts, and where each text begins."""
    flat, begin = words(pc.ascii_lower(pc.fill_null(texts, "")))
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(begin, pa.int32()), flat), " ")
    lengths = pc.binary_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
    counts = np.diff(begin)
    # Word positions in the joined bytes: a blank follows every word but a text's last.
    owner = np.repeat(np.arange(len(counts)), counts)
    starts = np.cumsum(lengths + 1) - (lengths + 1) - owner_shift(owner, counts)
    stops = starts + lengths
    shingles = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    into = offsets_of(shingles)
    first = np.repeat(begin[:-1] - into[:-1], shingles) + np.arange(into[-1])
    last = np.minimum(first + size, np.repeat(begin[1:], shingles)) - 1
    data = b"".join(joined.cast(pa.binary()).to_pylist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(data[a:b], SEED) for a, b in zip(starts[first].tolist(), stops[last].tolist())),
        np.uint64, len(first),
    )
    return hashes, into


def owner_shift(owner: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Texts with words before a word's own text: each lacks the blank after its last word."""
    full = (counts > 0).astype(np.int64)
    return (np.cumsum(full) - full)[owner] if len(owner) else np.empty(0, np.int64)


def majority(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A bit is 1 where it is set in over half of a text's hashes; texts without hash get 0."""
    counts = np.diff(begin)
    votes = np.zeros((len(counts), BITS), np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    for at in range(0, len(hashes), VOTES):
        bits = np.unpackbits(hashes[at:at + VOTES].astype(">u8").view(np.uint8)).reshape(-1, BITS)
        own = owner[at:at + VOTES]
        cut = np.flatnonzero(np.diff(own, prepend=own[0] - 1))
        votes[own[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int32)
    return np.packbits(votes * 2 > counts[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprints(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", shingle: int = SHINGLE, keep: tuple[str, ...] = ()
) -> DataFrame:
    """(id, kept columns, fp bigint) for every row."""
    kept = [id_column, *keep]

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        hashes, begin = shingle_hashes(part.column(text), shingle)
        fp = pa.array(majority(hashes, begin).view(np.int64))
        return pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), fp], [*kept, "fp"])

    fields = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {fields[c]}" for c in kept), "fp bigint"])
    return map_slices(docs.select(*kept, text), text, run, schema)


# --- partitions and thresholds --------------------------------------------------------

def bit_matrix(fps: np.ndarray) -> np.ndarray:
    return ((fps[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)


def correlated_partitions(bits: np.ndarray, m: int) -> list[list[int]]:
    """m near-equal groups of bit positions; each grows by the bit most correlated with it."""
    centred = bits.astype(np.float64) - bits.mean(0) if len(bits) else np.zeros((1, BITS))
    scale = np.sqrt((centred ** 2).sum(0))
    scale[scale == 0] = 1
    corr = np.abs((centred / scale).T @ (centred / scale))
    left = list(range(BITS))
    groups = []
    for g in range(m):
        size = BITS // m + (g < BITS % m)
        inner = corr[np.ix_(left, left)]
        group = [left.pop(int((inner.sum(1) - inner.diagonal()).argmax()))]
        while len(group) < size:
            group.append(left.pop(int(corr[np.ix_(left, group)].sum(1).argmax())))
        groups.append(sorted(group))
    return groups


def match_rates(bits: np.ndarray, group: list[int], most: int) -> list[float]:
    """Share of random pairs within 0..most bits in a group: the larger of sample and uniform."""
    width = len(group)
    floor = np.cumsum([comb(width, t) for t in range(most + 1)]) / 2.0 ** width
    n = len(bits)
    if n < 2:
        return floor.tolist()
    part = bits[:, group].astype(np.float32)
    ones = part.sum(1)
    found = np.zeros(most + 1)
    for at in range(0, n, 512):
        apart = ones[at:at + 512, None] + ones[None] - 2 * (part[at:at + 512] @ part.T)
        found += [(apart <= t).sum() for t in range(most + 1)]
    return np.maximum((found - n) / (n * (n - 1)), floor).tolist()


def choose_partitions(sample: np.ndarray, n: int, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """(bit positions, threshold) of the cheapest plan; partitions with threshold -1 are left out."""
    bits = bit_matrix(sample)
    pairs = n * (n - 1) / 2
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for m in range(1, radius + 2):
        groups = correlated_partitions(bits, m)
        budget = radius - m + 1
        most = budget + m - 1  # if every other partition is left out
        costs = []
        for group in groups:
            rates = match_rates(bits, group, min(most, len(group)))
            probes = np.cumsum([comb(len(group), t) for t in range(len(rates))])
            costs.append([0.0, *(ROW_COST * n * (1 + p / 2) + pairs * r for p, r in zip(probes, rates))])
        # table[s]: cheapest thresholds so far with sum s - (partitions so far)
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for cost in costs:
            grown: dict[int, tuple[float, list[int]]] = {}
            for spent, (sofar, picks) in table.items():
                for t, c in enumerate(cost):
                    key = spent + t
                    if key <= budget + m and (key not in grown or sofar + c < grown[key][0]):
                        grown[key] = (sofar + c, [*picks, t - 1])
            table = grown
        total, picks = table[budget + m]
        if best is None or total < best[0]:
            best = (total, [(g, t) for g, t in zip(groups, picks) if t >= 0])
    return best[1]


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


@lru_cache(maxsize=64)
def flips(positions: tuple[int, ...], threshold: int) -> list[tuple[int, int]]:
    """(bits to flip, highest of them) for 1..threshold flipped positions."""
    out = []
    for t in range(1, threshold + 1):
        for chosen in combinations(positions, t):
            out.append((signed(sum(1 << b for b in chosen)), signed(1 << max(chosen))))
    return out


def dealt(nodes: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """(part, key, fp, own): a node in its own buckets, and as a visitor in near ones.

    Of two nodes that differ in a partition only the one with the highest differing bit set
    visits the other.
    """
    parts = []
    for i, (positions, threshold) in enumerate(plan):
        mask = F.lit(signed(sum(1 << b for b in positions)))
        key = F.col("fp").bitwiseAND(mask)
        rows = nodes.select(F.lit(i).alias("part"), key.alias("key"), "fp", F.lit(True).alias("own"))
        moves = flips(tuple(positions), threshold)
        if moves:
            move = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in moves]))
            visits = (
                nodes.select("fp", key.alias("key"), move.alias("m"))
                .filter(F.col("fp").bitwiseAND(F.col("m.b")) != 0)
                .select(F.lit(i).alias("part"), F.col("key").bitwiseXOR(F.col("m.a")).alias("key"), "fp", F.lit(False).alias("own"))
            )
            rows = rows.unionByName(visits)
        parts.append(rows)
    out = parts[0]
    for rows in parts[1:]:
        out = out.unionByName(rows)
    return out


# --- links ----------------------------------------------------------------------------

def spanning(fps: np.ndarray, radius: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Edges of a spanning forest of the links among ``fps`` (uint64)."""
    left, right, rest = [], [], fps
    while rest.size > 1:
        queue, rest = [rest[:1]], rest[1:]
        while queue and rest.size:
            wave = queue.pop()
            for i, p in enumerate(wave):
                near = np.bitwise_count(rest ^ p) <= radius
                if near.any():
                    hit, rest = rest[near], rest[~near]
                    left.append(np.full(hit.size, p))
                    right.append(hit)
                    queue.append(hit)
                if not rest.size:
                    break
    return left, right


def bucket_links(starts: np.ndarray, fps: np.ndarray, own: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """True links inside consecutive buckets; ``starts`` has the end as its last entry."""
    sizes = np.diff(starts)
    left, right = [], []
    small = np.repeat(sizes <= SMALL, sizes)
    place = np.arange(len(fps)) - np.repeat(starts[:-1], sizes)
    earlier = np.where(small, place, 0)
    a = np.repeat(np.arange(len(fps)), earlier)
    b = np.arange(len(a)) - np.repeat(offsets_of(earlier)[:-1], earlier) + a - np.repeat(place, earlier)
    true = (own[a] | own[b]) & (np.bitwise_count(fps[a] ^ fps[b]) <= radius) & (fps[a] != fps[b])
    left.append(fps[a[true]])
    right.append(fps[b[true]])
    for k in np.flatnonzero(sizes > SMALL):
        found = spanning(np.unique(fps[starts[k]:starts[k + 1]]), radius)
        left += found[0]
        right += found[1]
    return np.concatenate(left), np.concatenate(right)


def links(nodes: DataFrame, plan: list[tuple[list[int], int]], radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(u, v): verified links that connect the same nodes as all links do."""
    spark = nodes.sparkSession
    rows = dealt(nodes, plan)
    sizes = (
        rows.groupBy("part", "key").agg(F.count("*").alias("n"), F.max("own").alias("any_own"))
        .filter((F.col("n") > 1) & F.col("any_own"))
        .select("part", "key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    )
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks").cast("bigint")).cast("int")
    # With one block the pair is (0, 0); otherwise a row meets every block, its own included.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    work = (
        rows.join(sizes, ["part", "key"])
        .select("part", "key", "fp", "own", mine.alias("mine"), other.alias("other"))
        .select("part", "key", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "fp", "own")
    )
    task_key = ["part", "key", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: pa.Table | None = None
        names = ["u", "v"]

        def edges(table: pa.Table) -> pa.RecordBatch:
            cols = [table.column(c).to_numpy() for c in task_key]
            change = np.zeros(len(table), bool)
            change[0] = True
            for c in cols:
                change[1:] |= c[1:] != c[:-1]
            starts = np.append(np.flatnonzero(change), len(table))
            fps = table.column("fp").to_numpy().view(np.uint64)
            own = table.column("own").combine_chunks().to_numpy(zero_copy_only=False)
            u, v = bucket_links(starts, fps, own, radius)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if carry is not None:
                table = pa.concat_tables([carry, table]).combine_chunks()
            last = [table.column(c)[-1] for c in task_key]
            same = np.ones(len(table), bool)
            for c, value in zip(task_key, last):
                same &= table.column(c).to_numpy() == value.as_py()
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut:
                yield edges(table.slice(0, cut))
            carry = table.slice(cut)
        if carry is not None and len(carry):
            yield edges(carry)

    dealt_rows = work.repartition(*task_key).sortWithinPartitions(*task_key)
    found = dealt_rows.mapInArrow(run, "u bigint, v bigint")
    path = scratch_path(spark, "links")
    found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct().write.parquet(path)
    return spark.read.parquet(path)


# --- components -----------------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge table (u, v); one root per component.

    Each round maps a node to its smallest neighbour in a hashed order and contracts; the
    number of rounds grows with the logarithm of a component's size.
    """
    spark = edges.sparkSession
    mapping: DataFrame | None = None
    rank = lambda c: F.struct(F.xxhash64(c, F.lit(SEED)).alias("h"), F.col(c).alias("id"))
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min(rank("v")).alias("low"))
        step = low.select(F.col("u").alias("at"), F.least(rank("u"), F.col("low"))["id"].alias("to"))
        at = scratch_path(spark, "contract")
        step.write.parquet(at)
        step = spark.read.parquet(at)
        if mapping is None:
            mapping = step.select(F.col("at").alias("node"), F.col("to").alias("root"))
        else:
            joined = mapping.join(step, mapping["root"] == step["at"], "left")
            mapping = joined.select("node", F.coalesce("to", "root").alias("root"))
        path = scratch_path(spark, "roots")
        mapping.write.parquet(path)
        mapping = spark.read.parquet(path)
        one = edges.join(step, edges["u"] == step["at"]).select(F.col("to").alias("u"), "v")
        two = one.join(step, one["v"] == step["at"]).select("u", F.col("to").alias("v")).filter("u <> v")
        path = scratch_path(spark, "edges")
        two.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct().write.parquet(path)
        edges = spark.read.parquet(path)
        if edges.isEmpty():
            return mapping


def near_duplicate_components(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", shingle: int = SHINGLE, radius: int = RADIUS,
    block: int = BLOCK, sample: int = SAMPLE, keep: tuple[str, ...] = (),
) -> DataFrame:
    """(id, kept columns, fp bigint, root bigint, component_id) for every row.

    component_id is the smallest id that links reach from a row; root is one of the component's
    fingerprints and names it even where all ids are null.

    ``sample`` fingerprints, the first in a hashed order, only steer the choice of partitions;
    every fingerprint is compared.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "fingerprints")
    fingerprints(docs, text, id_column, shingle, keep).write.parquet(path)
    rows = spark.read.parquet(path)
    path = scratch_path(spark, "nodes")
    rows.groupBy("fp").agg(F.min(id_column).alias("low")).write.parquet(path)
    nodes = spark.read.parquet(path)
    steer = nodes.orderBy(F.xxhash64("fp")).limit(sample).select("fp").collect()
    seen = np.array([r.fp for r in steer], np.int64).view(np.uint64)
    plan = choose_partitions(seen, max(nodes.count(), 1), radius)
    edges = links(nodes.select("fp"), plan, radius, block)
    if edges.isEmpty():
        found = nodes.select("fp", F.col("fp").alias("root"), F.col("low").alias("component_id"))
    else:
        roots = components(edges)
        named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
        lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
        found = named.join(lows, "root").select("fp", "root", "component_id")
    return rows.join(found, "fp").select(id_column, *keep, "fp", "root", "component_id")


def quoted(name: str) -> str:
    """A column name as an expression, whatever signs it holds."""
    return "`" + name.replace("`", "``") + "`"


def row_keys(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a hash of every row, and the name of that column.

    Columns of any type and name take part; maps, which have no hash, as JSON in their own order.
    """
    key = "_row_key"
    while any(c.lower().startswith(key) for c in docs.columns):
        key = "_" + key
    hashed = [
        F.to_json(F.struct(F.col(quoted(f.name)).alias("v"))) if "map<" in f.dataType.simpleString() else F.col(quoted(f.name))
        for f in docs.schema
    ]
    return docs.withColumn(key, F.xxhash64(*hashed)), key


def first_of_each(keyed: DataFrame, found: DataFrame, id_column: str, key: str) -> DataFrame:
    """The rows of ``keyed`` with the smallest id, nulls last, of every root in ``found``."""
    order = F.struct(F.col(id_column).isNull().alias("a"), F.col(id_column).alias("b"), F.col(key).alias("c"))
    first = found.groupBy("root").agg(F.min(order).alias("first"))
    stays = first.select(F.col("first")["c"].alias(key), F.col("first")["b"].alias(f"{key}_id"))
    joined = keyed.join(stays, key).filter(F.col(id_column).eqNullSafe(F.col(f"{key}_id")))
    number = F.row_number().over(Window.partitionBy(key).orderBy(F.col(id_column)))
    names = [F.col(quoted(c)) for c in keyed.columns if c != key]
    return joined.withColumn(f"{key}_number", number).filter(F.col(f"{key}_number") == 1).select(*names)


def one_of_each(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """The rows of ``docs``, all columns, that are first of their component: smallest id, nulls last.

    Of rows that are equal in every column one stays.
    """
    keyed, key = row_keys(docs)
    found = near_duplicate_components(keyed.select(id_column, text, key), text, id_column, shingle, radius, keep=(key,))
    return first_of_each(keyed, found, id_column, key)
