"""Chunk tables and packing against the tokenizer libraries and a lower bound."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from isobar.llm import packing, pieces
from cases import documents, empty_documents, odd_documents, odd_rows

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    " ", "  ", "foo ", " foo", "  foo  bar ", "▁x", "x▁", "▁▁ y", "\n", "日本 語́ x", "😀 😀  \x00 z", "</s> <unk> <0x41>",
    "don't 's x're L'été", "İSTANBUL ΣΑΣ Σ", "é é ﬁ", "a b c\x85d", "123 4a5", "<|startoftext|>x <|endoftext|>", "ǅ ŉ 'S 'RE",
]


@pytest.fixture(scope="module")
def chunk_table():
    return pieces.ChunkTable(PIECES)


@pytest.fixture(scope="module")
def word_table():
    return packing.WordTable(WORDS)


ANY_TEXT = st.text(st.characters(codec="utf-8"), max_size=60) | st.text("a \t\n▁bé'1<|>", max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(ANY_TEXT, min_size=1, max_size=4))
def test_chunks_encode_and_decode_like_the_library(chunk_table, texts):
    for text, ids in zip(texts, chunk_table.encode(pa.array(texts, pa.string()))):
        assert ids.tolist() == chunk_table.model.encode(text, add_eos=True), repr(text)
    flat, begin = chunk_table.chunks(pa.array(texts, pa.string()))
    back = chunk_table.decoded(chunk_table.table(flat.to_pylist()))
    for i, text in enumerate(texts):
        whole = chunk_table.model.decode(chunk_table.model.encode(text, add_eos=True))
        assert "".join(back[begin[i]:begin[i + 1]])[1:] == whole, repr(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(ANY_TEXT, min_size=1, max_size=4))
def test_words_encode_like_the_library(word_table, texts):
    ids, begin = word_table.encode(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        want = word_table.tokenizer.encode(text, add_special_tokens=False).ids
        assert ids[begin[i]:begin[i + 1]].tolist() == [*want, packing.CLOSING], repr(text)


def test_digests_of_whole_documents(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = documents(spark).select("doc_id", "text").union(
        spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    ).union(odd_documents(spark, "n_tokens").select("doc_id", "text"))
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    want = []
    for i, text in rows:
        ids = model.encode(text, add_eos=True)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((str(i), len(ids), sha(" ".join(map(str, ids))), sha(model.decode(ids))))
    got = [(str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pieces.piece_digests(docs, PIECES).collect()]
    assert sorted(got) == sorted(want)
    assert pieces.piece_digests(empty_documents(spark), PIECES).count() == 0


def expected_pieces(rows, capacity):
    tokenizer = Tokenizer.from_file(WORDS)
    out = []
    for i, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a:a + capacity]
            out.append((str(i), k, a, len(part), zlib.crc32(part.tobytes())))
    return sorted(out)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing_places_every_piece_without_gaps(spark, capacity):
    docs = documents(spark).select("doc_id", "text").union(odd_documents(spark, "length").select("doc_id", "text"))
    got = packing.packed_documents(docs, WORDS, capacity=capacity).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected_pieces(rows, capacity)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    least = -(-sum(r.length for r in got) // capacity)
    assert len(sequences) <= least * 1.02 + 1


def test_pieces_with_ids_round_trip(spark):
    rows = packing.token_pieces(documents(spark), WORDS, with_ids=True, capacity=100).collect()
    assert all(len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)


def test_small_shards_and_equal_rows(spark):
    rows = [(5, k % 3, 0, 10 + k % 7, k) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long").repartition(4)
    path = packing.scratch_path(spark, "rows")
    df.write.parquet(path)
    got = packing.pack(spark.read.parquet(path), capacity=100, shard_items=40).collect()
    assert len(got) == 400
    load = {}
    for r in got:
        load[r.sequence_id] = load.get(r.sequence_id, 0) + r.length
    assert max(load.values()) <= 100 and len(load) <= -(-sum(r[3] for r in rows) // 100) + 3


def test_empty_table_packs_to_nothing(spark):
    assert packing.packed_documents(empty_documents(spark), WORDS).count() == 0


def test_children_keep_every_item_and_capacity():
    rng = np.random.default_rng(5)
    sizes = np.sort(rng.integers(30, 900, 500))[::-1].astype(np.int64)
    people = packing.first_solutions(sizes, 4, 1000, rng)
    for _ in range(20):
        child = packing.crossed(sizes, people[0], people[1], 1000, rng)
        assert len(child) == 500 and child.min() == 0 and np.bincount(child, sizes).max() <= 1000
        people = [child, people[0]]


def test_evolution_is_never_worse_than_best_fit():
    rng = np.random.default_rng(6)
    sizes = np.sort(rng.integers(200, 700, 300))[::-1].astype(np.int64)
    people = packing.first_solutions(sizes, 4, 1000, rng)
    first = packing.fitness(sizes, people[0], 1000)
    assert packing.fitness(sizes, packing.evolve(sizes, people, 40, 1000, rng)[0], 1000) >= first


def test_odd_rows_are_not_lost(spark):
    assert packing.packed_documents(odd_documents(spark), WORDS).select("doc_id").distinct().count() == len({r[0] for r in odd_rows()})
