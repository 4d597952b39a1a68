"""Arrow batches of text: slices of bounded size, words as one flat array."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

# Text that is worked on at once inside a task. Not a limit: longer texts form a slice of their own.
SLICE_BYTES = 4_000_000


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive pieces of a batch with about ``size`` bytes of ``column`` each."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def map_slices(
    df: DataFrame, column: str, fn: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table], schema: str,
    setup: Callable[[], None] | None = None, size: int = SLICE_BYTES,
) -> DataFrame:
    """``fn`` over slices of every Arrow batch of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if setup:
            setup()
        for batch in batches:
            for part in slices(batch, column, size):
                out = fn(part)
                yield from out.to_batches() if isinstance(out, pa.Table) else [out]

    return df.mapInArrow(run, schema)


def offsets_of(counts: np.ndarray) -> np.ndarray:
    """[0, c0, c0+c1, ...]"""
    return np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


def words(texts: pa.Array, lists: pa.Array | None = None) -> tuple[pa.Array, np.ndarray]:
    """Non-empty words between ASCII white space as one flat array, and where each text begins in it.

    A null text has no word.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, "")) if lists is None else lists
    flat = lists.flatten()
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.greater(pc.binary_length(flat), 0)
    if not pc.all(full, min_count=0).as_py():
        owner = np.repeat(np.arange(len(counts)), counts)
        keep = full.to_numpy(zero_copy_only=False)
        counts = np.bincount(owner[keep], minlength=len(counts))
        flat = flat.filter(full)
    return flat, offsets_of(counts)


def distinct(flat: pa.Array) -> tuple[list[str], np.ndarray]:
    """The distinct values of a flat array, and for every position the number of its value."""
    coded = pc.dictionary_encode(flat)
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def gather(starts: np.ndarray, counts: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in a concatenated table of the runs named by ``chosen``, and each run's length."""
    sizes = counts[chosen]
    total = int(sizes.sum())
    if not total:
        return np.empty(0, np.int64), sizes
    shift = np.repeat(starts[chosen] - (np.cumsum(sizes) - sizes), sizes)
    return shift + np.arange(total), sizes


class Kinds(dict):
    """Translation of digits to 9, capitals to A and other letters to a."""

    def __missing__(self, point: int) -> str:
        c = chr(point)
        self[point] = kind = "9" if c.isdigit() else ("A" if c.isupper() else "a") if c.isalpha() else c
        return kind


KIND = Kinds()
