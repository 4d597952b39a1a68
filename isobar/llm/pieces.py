"""SentencePiece encoding and decoding through a table of distinct chunks.

In a vocabulary whose pieces hold the white-space marker only at the front, or hold nothing
else, no piece crosses from a word into the next marker. A text is then a row of chunks, each a
run of markers with the word behind it, and a chunk has the same pieces in every text. For each
slice of an Arrow batch the distinct chunks form a table, each is segmented and decoded once,
and ids and text come back by position. Nothing is shuffled, and a slice bounds the table.

A null text counts as empty: only the end id, decoded to an empty text. Rows with equal ids or
texts stay separate rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from isobar.llm.batches import distinct, gather, map_slices, offsets_of

MARK = "▁"
CHUNK = re.compile(" +[^ ]*| *[^ ]+")
SENTINEL = "a"


class ChunkTable:
    """Segments texts with a model whose pieces stay inside a chunk."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        crossing = [
            p for p in map(self.model.id_to_piece, range(self.model.get_piece_size()))
            if MARK in p.lstrip(MARK)
        ]
        if crossing:
            raise ValueError(f"pieces that cross a white-space marker: {crossing[:5]}")
        self.end = self.model.eos_id()
        self.sentinel = self.model.piece_to_id(SENTINEL)
        self.lone = self.model.piece_to_id(MARK)

    def chunks(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All chunks without their first marker, and where each text begins."""
        plain = pc.replace_substring(pc.fill_null(texts, ""), MARK, " ")
        uneven = pc.match_substring_regex(plain, "^ | $|  ").to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(plain, " ")
        if uneven.any():
            rows = lists.to_pylist()
            for i in np.flatnonzero(uneven):
                rows[i] = [c[1:] for c in CHUNK.findall(" " + plain[i].as_py())]
            lists = pa.array(rows, pa.list_(pa.string()))
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        empty = pc.equal(pc.binary_length(plain), 0).to_numpy(zero_copy_only=False)
        flat = lists.flatten()
        if empty.any():  # splitting an empty text gives one empty chunk
            flat = flat.filter(pa.array(~np.repeat(empty, counts)))
            counts = np.where(empty, 0, counts)
        return flat, offsets_of(counts)

    def table(self, chunks: list[str]) -> list[list[int]]:
        ids = self.model.encode(chunks, num_threads=1)
        return [x or [self.lone] for x in ids]

    def decoded(self, ids: list[list[int]]) -> list[str]:
        """Text of each chunk with its markers as blanks."""
        return [t[len(SENTINEL):] for t in self.model.decode([[self.sentinel, *x] for x in ids])]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text, the end id last."""
        flat, begin = self.chunks(texts)
        names, codes = distinct(flat)
        table = self.table(names)
        sizes = np.fromiter(map(len, table), np.int64, len(table))
        pool = np.fromiter((i for x in table for i in x), np.int32, int(sizes.sum()))
        places, each = gather(offsets_of(sizes)[:-1], sizes, codes)
        ends = offsets_of(each)[begin]
        ids = pool[places]
        return [np.append(ids[a:b], np.int32(self.end)) for a, b in zip(ends[:-1], ends[1:])]


def _sha(values: list[str]) -> pa.Array:
    return pa.array([hashlib.sha256(v.encode()).hexdigest() for v in values], pa.string())


def piece_digests(docs: DataFrame, model_file: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) per row; ids are joined by one blank."""
    state: dict[str, ChunkTable] = {}

    def setup() -> None:
        state["table"] = ChunkTable(model_file)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        own = state["table"]
        flat, begin = own.chunks(part.column(text))
        names, codes = distinct(flat)
        table = own.table(names)
        sizes = np.fromiter(map(len, table), np.int64, len(table))
        totals = offsets_of(sizes[codes])[begin]
        starts = pa.array(begin, pa.int32())

        def join(values: list[str], sep: str) -> list[str]:
            picked = pa.array(values, pa.string()).take(pa.array(codes))
            return pc.binary_join(pa.ListArray.from_arrays(starts, picked), sep).to_pylist()

        ids = join([" ".join(map(str, x)) for x in table], " ")
        back = join(own.decoded(table), "")
        return pa.RecordBatch.from_arrays(
            [part.column(id_column), pa.array(np.diff(totals) + 1, pa.int64()),
             _sha([f"{x} {own.end}" if x else str(own.end) for x in ids]), _sha([x[1:] for x in back])],
            [id_column, "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    id_type = dict(docs.dtypes)[id_column]
    schema = f"`{id_column}` {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_slices(docs.select(id_column, text), text, run, schema, setup)
