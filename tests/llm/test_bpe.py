"""The backtracking encoder and the offset table against the tokenizers library."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from isobar.llm import bpe
from isobar.llm.queries import QUERIES
from cases import DOCS, SMALL, documents, empty_documents, odd_documents, odd_rows

FILE = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "a" * 5000, "ab" * 2000 + "c", "日本語" * 1500, "!" * 3000, "<|endoftext|>a<|startoftext|><|endoftext|", "don't 'S x'RE",
    "İSTANBUL ΣΑΣ Σ", "é é ﬁ", "a b c\x85d", "\x00 \x1c\x1d x", "😀 😀", "123 4a5", " ", "\n\t",
    "l'été, ²³¼ n°1 «Œuvre» ŉ ſ ǅ", "naïve\u00adsoft\u00a0hard ÀÉ!?", "don't we'll I'D o'reilly 's",
]
ANY_TEXT = st.text(st.characters(codec="utf-8"), max_size=60) | st.text("aeinrsth \t\nbé'1<|>!.", max_size=60)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@settings(max_examples=200, deadline=None)
@given(st.lists(ANY_TEXT, min_size=1, max_size=4))
@example(ODD)
def test_ids_and_text_equal_the_library(library, texts):
    ids, begin = bpe.encoder(FILE).encode(pa.array(texts, pa.string()))
    back = bpe.offset_table(FILE).decode(ids, begin)
    for i, text in enumerate(texts):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids[begin[i]:begin[i + 1]].tolist() == want, repr(text[:80])
        assert back[i].as_py() == library.decode(want, skip_special_tokens=False)


def merged(merges, word):
    """The plain merge loop: the earliest merge at its leftmost place, until none is left."""
    parts = list(word)
    while True:
        places = [(merges[a, b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (a, b) in merges]
        if not places:
            return parts
        _, i = min(places)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_any_merge_table_gives_the_merge_loops_tokens(data):
    """Small random vocabularies force steps back, tokens that never appear, and repeated signs."""
    tokens, merges = ["a", "b", "c"], {}
    for _ in range(data.draw(st.integers(0, 14))):
        pair = data.draw(st.sampled_from(tokens)), data.draw(st.sampled_from(tokens))
        if pair[0] + pair[1] not in tokens and len(pair[0] + pair[1]) < 9:
            merges[pair] = len(merges)
            tokens.append(pair[0] + pair[1])
    table = bpe.Merges({t: i for i, t in enumerate(tokens)}, list(merges), "")
    words = data.draw(st.lists(st.text("abc", min_size=1, max_size=30), min_size=1, max_size=6))
    ids, begin = table.encode_all(words)
    for k, word in enumerate(words):
        assert [tokens[i] for i in table.encode(word)] == merged(merges, word)
        assert [tokens[i] for i in ids[begin[k]:begin[k + 1]]] == merged(merges, word)


def test_merges_out_of_order_are_refused():
    with pytest.raises(ValueError, match="order"):
        bpe.Merges({"a": 0, "b": 1, "ab": 3, "ba": 2}, [("a", "b"), ("b", "a")], "")


def test_query_on_whole_documents(spark, library):
    want = []
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, QUERIES["op12_bpe_backtracking"](spark, SMALL).collect())) == sorted(want)


def test_odd_rows_stay_whole_and_separate(spark, library):
    docs = odd_documents(spark, "ids", "decoded")
    got = bpe.decode(bpe.encode(docs, FILE), FILE)
    assert got.columns == ["doc_id", "ids", "decoded"]
    want = sorted((str(r[0]), library.encode(r[1] or "", add_special_tokens=False).ids) for r in odd_rows())
    rows = got.collect()
    assert sorted((str(r.doc_id), r.ids) for r in rows) == want
    assert all(r.decoded == library.decode(r.ids, skip_special_tokens=False) for r in rows)
    both = bpe.encode(docs, FILE, decoded=True).collect()
    assert sorted(map(str, both)) == sorted(map(str, rows))
    assert bpe.decode(bpe.encode(empty_documents(spark), FILE), FILE).count() == 0


def test_unknown_and_null_ids_are_left_out(spark, library):
    rows = [(1, [320, None, -4, 60000, 518]), (2, None), (3, [])]
    got = {r.doc_id: r.decoded for r in bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), FILE).collect()}
    assert got == {1: library.decode([320, 518], skip_special_tokens=False), 2: "", 3: ""}


def test_long_runs_take_linear_time():
    import time

    own = bpe.Encoder(FILE)
    took = []
    for n in (20_000, 80_000):
        run = "".join(np.random.default_rng(n).choice(list("aeinrst"), n))
        start = time.process_time()
        own.encode(pa.array([run]))
        took.append(time.process_time() - start)
    assert took[1] < 12 * took[0] + 0.5
