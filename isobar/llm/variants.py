"""Spelling variants: single edits among the words of a corpus, by dense tiles of padded words.

Two words differ by one inserted, deleted or replaced code point if, and only if, they are different
and their common prefix and common suffix together reach the longer length minus one. With s the
shorter length, one of the two then has at least s // 2 code points. So each word is dealt by its
prefix and by its suffix of that length, once as the shorter or equal word of a pair and once as the
longer one: four rows a word. Rows of one such key form a tile. A tile is a padded matrix of code
points, forwards and backwards, compared row by row in one dense block; several small keys share a
block, masked by key. A key above ``BLOCK`` words is cut into blocks of words that meet in pairs, so
no task holds more than two. A pair that shares both its prefix and its suffix key counts
under the prefix. A tile returns one row per word, the number of its near words and the most
frequent one, so links are counted and never listed.

``counted_words`` gives the distinct words of all texts. A null text has none, an empty table gives
an empty result; a null id is written ``null``, rows with equal ids or texts are counted row by row,
other columns are ignored. Very long texts and words are whole: the tile gets fewer rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.batches import map_slices
from isobar.session import scratch_path

LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
DROP_EVERY = 31
RUN = re.compile("[A-Za-zÀ-ÿ]+")
BLOCK = 512  # words of a key that meet as one block
TILE = 192  # rows of a dense comparison, unless one group has more
CELLS = 1 << 20  # pairs of words compared at once
SLICE = 2_000_000  # bytes of text that are counted at once
WIDE = 32  # signs of a word from which blocks and tiles get fewer rows
TASK_KEY = ["size", "side", "key", "lo", "hi"]


# --- words ----------------------------------------------------------------------------

def damaged(word: str, doc_id: object, every: int = DROP_EVERY) -> str:
    """The word, without one code point if ``every`` divides the CRC-32 of id and word."""
    value = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{word}".encode())
    if value % every:
        return word
    at = value % len(word)
    return word[:at] + word[at + 1:]


def counted_words(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT, every: int = DROP_EVERY,
) -> DataFrame:
    """(word, n) of all words of ``least_length`` code points or more that occur ``least_count`` times or more.

    Words are runs of Latin letters, A-Z lower-cased, some occurrences with a code point missing (``damaged``).
    Counts are combined per slice of text and again before the shuffle.
    """
    long_runs = re.compile(RUN.pattern[:-1] + f"{{{least_length},}}")

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        total: Counter[str] = Counter()
        texts = pc.ascii_lower(pc.fill_null(part.column(text), "")).to_pylist()
        for doc_id, body in zip(part.column(id_column).to_pylist(), texts):
            for word, n in Counter(long_runs.findall(body)).items():
                total[damaged(word, doc_id, every)] += n
        kept = {w: n for w, n in total.items() if len(w) >= least_length}
        return pa.RecordBatch.from_arrays([pa.array(kept.keys(), pa.string()), pa.array(kept.values(), pa.int64())], ["word", "n"])

    found = map_slices(docs.select(id_column, text), text, run, "word string, n bigint", size=SLICE)
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


# --- dense tiles ----------------------------------------------------------------------

@dataclass(frozen=True)
class Padded:
    """Words as rows of code points, forwards and backwards, padded with zeros; stored by column."""

    sizes: np.ndarray
    ahead: np.ndarray
    behind: np.ndarray


def padded(words: list[str]) -> Padded:
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    width = int(sizes.max())
    # One byte a sign where code points allow it.
    narrow = max(map(max, words)) <= "\u00ff"
    code, unit, kind = ("latin-1", "u1", f"S{width}") if narrow else ("utf-32-le", "<u4", f"S{4 * width}")
    pad = lambda ws: np.ascontiguousarray(np.array([w.encode(code) for w in ws], kind).view(unit).reshape(len(ws), width).T)
    return Padded(sizes.astype(np.int16 if width < 1 << 13 else np.int64), pad(words), pad([w[::-1] for w in words]))


def common(a: np.ndarray, b: np.ndarray, kind: type = np.int64) -> np.ndarray:
    """Code points that every word of ``a`` and every word of ``b`` begin with in common, padding included."""
    equal = a[0][:, None] == b[0][None]
    length = equal.astype(kind)
    for own, other in zip(a[1:], b[1:]):
        equal &= own[:, None] == other[None]
        if not equal.any():
            break
        length += equal
    return length


def tile_links(rows: dict[str, np.ndarray], words: list[str]) -> np.ndarray:
    """near[i, j]: row j holds a word one edit away from row i's, in the same group, counted for this side.

    ``group`` numbers the task groups, ``size`` is the shorter length of its pairs, ``side`` 0 for prefixes,
    ``mine`` the row's block and ``split`` whether the group is a pair of two different blocks.
    """
    own = padded(words)
    sizes, kind, n = own.sizes, own.sizes.dtype.type, len(words)
    near = np.zeros((n, n), bool)
    step = max(1, min(n, CELLS // max(n, own.ahead.shape[0])))
    group, least = rows["group"].astype(np.int32), rows["size"].astype(sizes.dtype)
    for at in range(0, n, step):
        a = slice(at, at + step)
        longer = np.maximum(sizes[a, None], sizes[None])
        shorter = np.minimum(sizes[a, None], sizes[None])
        together = (group[a, None] == group[None]) & (shorter == least[None])
        together &= ~rows["split"][None] | (rows["mine"][a, None] != rows["mine"][None])
        prefix = np.minimum(common(own.ahead[:, a], own.ahead, kind), shorter)
        suffix = np.minimum(common(own.behind[:, a], own.behind, kind), shorter)
        single = (prefix + suffix >= longer - 1) & (longer - shorter <= 1) & ((prefix < longer) | (longer > shorter))
        # Pairs that share the prefix key are counted there.
        mine = (rows["side"][None] == 0) | (prefix < least[None] // 2)
        near[a] = together & single & mine
    return near


def tile_rows(table: pa.Table) -> pa.RecordBatch:
    """(word, n, n_near, form_n, form) for the words of a tile that have near words there."""
    words = table.column("word").to_pylist()
    cols = {c: table.column(c).to_numpy() for c in [*TASK_KEY, "mine", "n"]}
    change = np.zeros(len(words), bool)
    for c in TASK_KEY:
        change[1:] |= cols[c][1:] != cols[c][:-1]
    rows = {"group": np.cumsum(change), "size": cols["size"], "side": cols["side"], "mine": cols["mine"], "split": cols["lo"] != cols["hi"]}
    near = tile_links(rows, words)
    # Most frequent first, ties in code-point order: the first near word in this order is the best.
    order = np.array(sorted(range(len(words)), key=lambda i: (-cols["n"][i], words[i])), np.int64)
    counts = near.sum(1)
    hit = np.flatnonzero(counts)
    best = order[near[np.ix_(hit, order)].argmax(1)] if len(hit) else hit
    return pa.RecordBatch.from_arrays(
        [pa.array([words[i] for i in hit], pa.string()), pa.array(counts[hit].astype(np.int64)),
         pa.array(cols["n"][best]), pa.array([words[i] for i in best], pa.string())],
        ["word", "n_near", "form_n", "form"],
    )


def compared(batches: Iterator[pa.RecordBatch], tile: int = TILE) -> Iterator[pa.RecordBatch]:
    """Tiles of whole groups from rows sorted by group; a group is never split."""
    carry: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if carry is not None and len(carry):
            table = pa.concat_tables([carry, table]).combine_chunks()
        ends, sizes = group_ends(table), table.column("size").to_numpy()
        start = 0
        for k, end in enumerate(ends[:-1]):  # the last group may go on in the next batch
            room = tile * WIDE // max(WIDE, int(sizes[ends[k + 1] - 1]))
            if ends[k + 1] - start > room or k == len(ends) - 2:
                yield tile_rows(table.slice(start, end - start))
                start = int(end)
        carry = table.slice(start)
    if carry is not None and len(carry):
        yield tile_rows(carry)


def group_ends(table: pa.Table) -> np.ndarray:
    change = np.zeros(len(table), bool)
    for c in TASK_KEY:
        values = table.column(c).to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(change), len(table))


# --- neighbours and forms -------------------------------------------------------------

def near_words(words: DataFrame, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """(word, n_near, form_n, form) of every word of (word, n) that has a near word; form is its most frequent one."""
    length = F.length("word")
    roles = []
    for size in (length, length - 1):  # as the shorter or equal word, as the longer one
        half = F.floor(size / 2).cast("int")
        for side, key in ((0, F.substring("word", F.lit(1), half)), (1, F.substring("word", length - half + 1, half))):
            # A hash is enough: rows that meet by accident are compared and found apart.
            roles.append(F.struct(size.cast("bigint").alias("size"), F.lit(side).cast("bigint").alias("side"), F.xxhash64(key).alias("key")))
    dealt = words.withColumn("role", F.explode(F.array(*roles))).select("role.*", "word", "n")
    crowds = (
        dealt.groupBy("size", "side", "key").agg(F.count("*").alias("rows"), F.min(F.length("word")).alias("shortest"))
        # A pair needs a word of the shorter length.
        .filter((F.col("rows") > 1) & (F.col("shortest") == F.col("size")))
        # Blocks of long words hold fewer of them.
        .select("size", "side", "key", F.ceil(F.col("rows") * F.greatest(F.col("size"), F.lit(WIDE)) / F.lit(block * WIDE)).alias("blocks"))
    )
    mine = F.pmod(F.xxhash64("word"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    work = (
        dealt.join(crowds, ["size", "side", "key"])
        .select("size", "side", "key", "word", "n", mine.alias("mine"), other.alias("other"))
        .select("size", "side", "key", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "mine", "word", "n")
        .repartition(*TASK_KEY).sortWithinPartitions(*TASK_KEY)
    )
    parts = work.mapInArrow(lambda batches: compared(batches, tile), "word string, n_near bigint, form_n bigint, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    merged = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return merged.select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every row of (word, form): the last word that forms lead to.

    Each round replaces a word's goal by its goal's goal, so rounds grow with the logarithm of a
    chain, and a form's count grows by the ratio, so chains are short. No form leads back.
    """
    spark = forms.sparkSession
    step = forms.select("word", F.col("form").alias("root"))
    while True:
        path = scratch_path(spark, "roots")
        step.write.parquet(path)
        step = spark.read.parquet(path)
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = step.join(ahead, "root")
        if moved.isEmpty():
            return step
        step = step.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"))


def variant_forms(words: DataFrame, ratio: int = RATIO, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of (word, n), words distinct.

    ``form`` is the most frequent near word, ties to the smaller, if it occurs ``ratio`` times as often.
    """
    spark = words.sparkSession
    path = scratch_path(spark, "words")
    words.select("word", "n").write.parquet(path)
    words = spark.read.parquet(path)
    path = scratch_path(spark, "near-words")
    found = words.join(near_words(words, block, tile), "word", "left")
    much = F.col("form_n") >= ratio * F.col("n")
    found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(much, F.col("form")).alias("form"), F.when(much, F.col("form_n")).alias("form_n"),
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    led = roots(rows.filter(F.col("form").isNotNull()))
    return rows.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
