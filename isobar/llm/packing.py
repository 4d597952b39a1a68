"""Token sequences of fixed capacity: documents cut into pieces, packed by a grouping genetic algorithm.

``token_pieces`` turns whole texts into ids and cuts only documents longer than the capacity.
Words between white space are tokenized once per task and joined back by position; no token of
the vocabulary spans white space.

``pack`` deals the pieces evenly into shards of about ``shard_items`` by row, whatever their ids.
A shard is evolved on several islands, each its own group of rows: solutions are assignments of
pieces to bins, and a child takes whole well-filled bins from one parent, the untouched bins of the
other, and best-fits what is displaced, largest first. After each round an island's best solution
migrates to the next island. The best of a shard's islands stands. Bins that are still underfilled
are dissolved and their pieces dealt and evolved once more, so shards leave no rests of their own.
A group never holds more than two solutions of a shard per row, so memory is bounded by
``shard_items``.

A null or empty text is one piece: the closing id alone. Rows with equal ids or texts are packed
separately. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.batches import distinct, gather, map_slices, offsets_of, words
from isobar.session import scratch_path

CAPACITY = 2048
CLOSING = 0
SHARD_ITEMS = 4000
ISLANDS = 2
ROUNDS = 2
POPULATION = 4
GENERATIONS = 12
WELL_FILLED = 0.995
KEEP_FILLED = 0.99  # bins below this share are dissolved after the first level
MEMO = 400_000  # table entries a task keeps
SLICE = 8_000_000  # bytes of text at once: fewer words are looked up again than in smaller slices
PARTS = re.compile(r"[a-z]+|[0-9]|[^a-z0-9]+")


# --- tokens ---------------------------------------------------------------------------

def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def byte_signs() -> dict[int, str]:
    """How byte-level models write bytes: visible Latin-1 signs stand for themselves, the rest follow from U+0100."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordTable:
    """Ids of words without white space; each distinct word goes through the model once."""

    # Below it letters are composed already and lower-case one by one.
    SIMPLE = "\u0300"
    CLOSERS = frozenset(".,!?;:*%$&#)]}")

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.signs = byte_signs()
        # Ids as bytes of 32-bit numbers: a third of the memory of lists, and they join in one call.
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def part(self, part: str) -> bytes:
        """Ids of one pre-token in the model's own signs."""
        ids = self.parts.get(part)
        if ids is None:
            ids = self.parts[part] = packed([t.id for t in self.model.tokenize(part)])
        return ids

    def letters(self, low: str) -> bytes | None:
        """Ids of a lower-cased run of simple letters; None if it is anything else."""
        if low.isalpha() and max(low) < self.SIMPLE:
            return self.part(low if low.isascii() else low.encode().decode("latin-1").translate(self.signs))
        return None

    def made(self, word: str) -> bytes:
        ids = self.letters(word.lower())
        if ids is None and word[-1] in self.CLOSERS:
            head = word.rstrip("".join(self.CLOSERS))
            ids = self.letters(head.lower()) if head else None
            if ids is not None:
                return ids + self.part(word[len(head):])
        if ids is not None:
            return ids
        if word.isascii() and word.isprintable() and "'" not in word and "<|" not in word:
            # For such words normalising is lower-casing, and the splits are runs of one kind.
            return b"".join(map(self.part, PARTS.findall(word.lower())))
        if any(s in word for s in self.special):
            return packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        plain = self.tokenizer.normalizer.normalize_str(word)
        return b"".join(self.part(p) for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(plain))

    def table(self, names: list[str]) -> list[bytes]:
        """Ids of each word, remembered for the task's next slices."""
        known, out = self.words, []
        for word in names:
            ids = known.get(word)
            if ids is None:
                ids = known[word] = self.made(word)
            out.append(ids)
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, the closing id after each, and where each begins."""
        if len(self.words) > MEMO or len(self.parts) > MEMO:
            self.words, self.parts = {}, {}
        flat, begin = words(texts)
        names, codes = distinct(flat)
        table = self.table(names)
        sizes = np.fromiter(map(len, table), np.int64, len(table)) // 4
        pool = np.frombuffer(b"".join(table), "<u4")
        places, each = gather(offsets_of(sizes)[:-1], sizes, codes)
        ends = offsets_of(each)[begin]
        lengths = np.diff(ends) + 1
        starts = offsets_of(lengths)
        out = np.full(int(starts[-1]), CLOSING, np.uint32)
        inside = np.ones(len(out), bool)
        inside[starts[1:] - 1] = False
        out[inside] = pool[places]
        return out, starts


def token_pieces(
    docs: DataFrame, tokenizer_file: str, text: str = "text", id_column: str = "doc_id", capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) per piece; CRC-32 over little-endian 32-bit ids."""
    state: dict[str, WordTable] = {}

    def setup() -> None:
        state["table"] = WordTable(tokenizer_file)

    names = [id_column, "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        ids, begin = state["table"].encode(part.column(text))
        ids = ids.astype("<u4")
        total = np.diff(begin)
        count = -(-total // capacity)
        row = np.repeat(np.arange(len(total)), count)
        piece = np.arange(len(row)) - np.repeat(offsets_of(count)[:-1], count)
        start = piece * capacity
        length = np.minimum(total[row] - start, capacity)
        a = begin[:-1][row] + start
        crc = [zlib.crc32(ids[x:x + n].tobytes()) for x, n in zip(a.tolist(), length.tolist())]
        columns = [
            part.column(id_column).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start),
            pa.array(length), pa.array(crc, pa.int64()),
        ]
        if with_ids:  # pieces of consecutive texts are consecutive
            columns.append(pa.ListArray.from_arrays(pa.array(offsets_of(length), pa.int32()), pa.array(ids.astype(np.int32))))
        return pa.RecordBatch.from_arrays(columns, names)

    id_type = dict(docs.dtypes)[id_column]
    schema = f"`{id_column}` {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return map_slices(docs.select(id_column, text), text, run, schema + ", ids array<int>" * with_ids, setup, SLICE)


# --- one shard ------------------------------------------------------------------------

class OpenBins:
    """Bins by what they have left; the fullest that still fits is found by one bit scan."""

    def __init__(self, capacity: int, left: list[int]):
        self.capacity, self.count, self.mask = capacity, 0, 0
        self.by_left: list[list[int]] = [[] for _ in range(capacity + 1)]
        for r in left:
            self._put(self.count, r)
            self.count += 1

    def _put(self, number: int, left: int) -> None:
        self.by_left[left].append(number)
        self.mask |= 1 << left

    def place(self, size: int) -> int:
        fits = self.mask >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            stack = self.by_left[left]
            number = stack.pop()
            if not stack:
                self.mask ^= 1 << left
        else:
            number, left = self.count, self.capacity
            self.count += 1
        self._put(number, left - size)
        return number


def numbered(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1].astype(np.int64)


def best_fit(sizes: np.ndarray, bins: np.ndarray, order: np.ndarray, capacity: int) -> np.ndarray:
    """Places the items of ``order`` (all that have bin -1) one by one."""
    bins = bins.copy()
    placed = bins >= 0
    bins[placed] = numbered(bins[placed])
    load = np.bincount(bins[placed], sizes[placed]).astype(np.int64) if placed.any() else np.empty(0, np.int64)
    rest = OpenBins(capacity, (capacity - load).tolist())
    bins[order] = [rest.place(s) for s in sizes[order].tolist()]
    return bins


def fitness(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones (larger mean square)."""
    load = np.bincount(bins, sizes) / capacity
    return -int((load > 0).sum()), float((load ** 2).sum())


def crossed(sizes: np.ndarray, giver: np.ndarray, taker: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Whole well-filled bins of the giver enter the taker; duplicates go, the displaced are best-fitted."""
    full = np.bincount(giver, sizes) / capacity >= WELL_FILLED
    chosen = full & (rng.random(len(full)) < rng.uniform(0.2, 0.8))
    injected = chosen[giver]
    broken = np.zeros(int(taker.max()) + 1, bool)
    broken[taker[injected]] = True
    load = np.bincount(taker, sizes)
    weak = load < capacity * WELL_FILLED
    broken |= weak & (rng.random(len(load)) < 0.5)
    child = np.where(broken[taker], -1, taker + int(giver.max()) + 1)
    child[injected] = giver[injected]
    loose = np.flatnonzero(child < 0)
    jitter = sizes[loose] * (1 + rng.uniform(0, 0.05)  * rng.random(len(loose)))
    return numbered(best_fit(sizes, child, loose[np.argsort(-jitter, kind="stable")], capacity))


def first_solutions(sizes: np.ndarray, count: int, capacity: int, rng: np.random.Generator) -> list[np.ndarray]:
    blank = np.full(len(sizes), -1, np.int64)
    out = [best_fit(sizes, blank, np.argsort(-sizes, kind="stable"), capacity)]
    while len(out) < count:
        noise = sizes * (1 + 0.1 * len(out) * rng.random(len(sizes)))
        out.append(best_fit(sizes, blank, np.argsort(-noise, kind="stable"), capacity))
    return [numbered(b) for b in out]


def evolve(sizes: np.ndarray, people: list[np.ndarray], generations: int, capacity: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Steady state: each child replaces the worst unless it is worse still. Best first."""
    ranked = sorted(((fitness(sizes, b, capacity), i, b) for i, b in enumerate(people)), key=lambda x: x[:2], reverse=True)
    least = -(-int(sizes.sum()) // capacity)
    number = len(ranked)
    for _ in range(generations):
        if -ranked[0][0][0] <= least or len(ranked) < 2:
            break
        a, b = rng.choice(len(ranked), 2, replace=False)
        if a > b and rng.random() < 0.7:
            a, b = b, a  # more often the better one gives
        child = crossed(sizes, ranked[a][2], ranked[b][2], capacity, rng)
        fit = fitness(sizes, child, capacity)
        if fit > ranked[-1][0] and all(fit != x[0] for x in ranked):
            ranked[-1] = (fit, number, child)
            ranked.sort(key=lambda x: x[:2], reverse=True)
        number += 1
    return [x[2] for x in ranked]


# --- all shards -----------------------------------------------------------------------

def in_order(table: pa.Table, keys: list[str]) -> pa.Table:
    return table.sort_by([("length", "descending"), *((k, "ascending") for k in keys)])


def pack_level(
    items: DataFrame, shard_items: int, islands: int, rounds: int, generations: int, capacity: int, level: int,
) -> DataFrame:
    """``items`` (row number ``at``, ``length``, payload) plus bin ``sequence_id``, ``offset`` and ``load``."""
    spark = items.sparkSession
    total = items.count()
    shards = max(1, ceil(total / shard_items))
    payload = items.columns
    fields = dict(items.dtypes)
    plain = ", ".join(f"`{c}` {fields[c]}" for c in payload)
    shard = F.pmod(F.xxhash64("at", F.lit(level)), F.lit(shards)).cast("int")
    rows = items.withColumn("shard", shard).withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))
    rows = rows.withColumns({"b0": F.lit(-1), "b1": F.lit(-1), "guest": F.lit(0)})
    schema = f"{plain}, shard int, island int, b0 int, b1 int, guest int"

    def step(round_number: int):
        def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            rng = np.random.default_rng([key[0].as_py(), key[1].as_py(), round_number, level])
            table = in_order(table, ["guest", "at"])
            guest = table.column("guest").to_numpy()
            own = table.filter(pa.array(guest == 0))
            sizes = own.column("length").to_numpy()
            if round_number == 0:
                people = first_solutions(sizes, POPULATION, capacity, rng)
            else:
                people = [own.column(c).to_numpy().astype(np.int64) for c in ("b0", "b1")]
                if (guest == 1).any():
                    people.append(table.filter(pa.array(guest == 1)).column("b0").to_numpy().astype(np.int64))
                people += first_solutions(sizes, POPULATION - len(people) + 1, capacity, rng)[1:]
            best = evolve(sizes, people, generations, capacity, rng)
            for c, b in (("b0", best[0]), ("b1", best[min(1, len(best) - 1)])):
                own = own.set_column(own.schema.get_field_index(c), c, pa.array(b.astype(np.int32)))
            return own
        return run

    for number in range(rounds):
        if number and islands > 1:
            moved = rows.withColumns({"island": (F.col("island") + 1) % islands, "guest": F.lit(1)})
            rows = rows.unionByName(moved)
        path = scratch_path(spark, f"islands-{level}-{number}")
        rows.groupBy("shard", "island").applyInArrow(step(number), schema).write.parquet(path)
        rows = spark.read.parquet(path)

    def choose(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        island = table.column("island").to_numpy()
        best = None
        for k in sorted(set(island.tolist())):
            own = in_order(table.filter(pa.array(island == k)), ["at"])
            sizes, bins = own.column("length").to_numpy(), own.column("b0").to_numpy().astype(np.int64)
            fit = fitness(sizes, bins, capacity)
            if best is None or fit > best[0]:
                best = (fit, own, sizes, bins)
        _, own, sizes, bins = best
        order = np.argsort(bins, kind="stable")
        before = np.cumsum(sizes[order]) - sizes[order]
        load = np.bincount(bins, sizes).astype(np.int64)
        first = offsets_of(load)[:-1]
        offset = np.empty(len(sizes), np.int64)
        offset[order] = before - first[bins[order]]
        sequence = (key[0].as_py() * (1 << 24) + bins) * 4 + level
        own = own.select(payload)
        for name, values in (("sequence_id", sequence), ("offset", offset), ("load", load[bins])):
            own = own.append_column(name, pa.array(values.astype(np.int64)))
        return own

    return rows.groupBy("shard").applyInArrow(choose, f"{plain}, sequence_id bigint, offset bigint, load bigint")


def pack(
    pieces: DataFrame, capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS, islands: int = ISLANDS,
    rounds: int = ROUNDS, generations: int = GENERATIONS,
) -> DataFrame:
    """``pieces`` (with ``length``) plus sequence_id and offset; ``pieces`` must be a stored table."""
    spark = pieces.sparkSession
    names = pieces.columns
    every = pieces.withColumn("at", F.monotonically_increasing_id())
    full = every.filter(F.col("length") >= capacity).select(
        *names, (F.col("at") * 4 + 3).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    open_items = every.filter(F.col("length") < capacity)
    path = scratch_path(spark, "packed")
    pack_level(open_items, shard_items, islands, rounds, generations, capacity, 0).write.parquet(path)
    first = spark.read.parquet(path)
    settled = F.col("load") >= capacity * KEEP_FILLED
    second = pack_level(
        first.filter(~settled).drop("sequence_id", "offset", "load"), shard_items, islands, rounds, generations, capacity, 1
    )
    done = first.filter(settled).select(*names, "sequence_id", "offset")
    return full.unionByName(done).unionByName(second.select(*names, "sequence_id", "offset"))


def packed_documents(docs: DataFrame, tokenizer_file: str, text: str = "text", id_column: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their place in a sequence."""
    spark = docs.sparkSession
    path = scratch_path(spark, "pieces")
    token_pieces(docs, tokenizer_file, text, id_column, capacity).write.parquet(path)
    return pack(spark.read.parquet(path), capacity)
