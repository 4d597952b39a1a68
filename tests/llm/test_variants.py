"""Spelling variants against all pairs of words."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from isobar.llm import variants
from isobar.llm.queries import QUERIES
from cases import SMALL, documents, empty_documents, odd_documents, odd_rows


def one_edit(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def corpus_words(rows, least_length=7, least_count=2, every=31):
    total = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), run)
            h = zlib.crc32(f"{'null' if i is None else i}:{word}".encode())
            if h % every == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
            total[word] += 1
    return {w: n for w, n in total.items() if len(w) >= least_length and n >= least_count}


def restated(words, ratio=10):
    names = sorted(words)
    near = {w: [] for w in names}
    by_length = {}
    for w in names:
        by_length.setdefault(len(w), []).append(w)
    for w in names:
        for size in (len(w), len(w) + 1):
            for v in by_length.get(size, []):
                if (size > len(w) or w < v) and one_edit(w, v):
                    near[w].append(v)
                    near[v].append(w)
    form = {}
    for w in names:
        if near[w]:
            top = min(near[w], key=lambda v: (-words[v], v))
            if words[top] >= ratio * words[w]:
                form[w] = top
    out = []
    for w in names:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None))
    return out


def forms(spark, words, **sizes):
    df = spark.createDataFrame([(w, n, "clash") for w, n in words.items()], "word string, n long, form string").repartition(4)
    return sorted(map(tuple, variants.variant_forms(df, **sizes).collect()))


def random_words(seed, count, alphabet="abç", least=7, most=10):
    rng = np.random.default_rng(seed)
    make = lambda: "".join(rng.choice(list(alphabet), rng.integers(least, most)))
    return {make(): int(10 ** rng.integers(0, 5) * rng.integers(2, 6)) for _ in range(count)}


@pytest.mark.parametrize("sizes", [{}, {"block": 16, "tile": 24}, {"block": 5, "tile": 1}])
def test_equals_all_pairs(spark, sizes):
    words = random_words(3, 700)
    assert forms(spark, words, **sizes) == restated(words)


def test_hot_prefix_is_cut_into_blocks(spark):
    """A third of the words share their first half, the others their last."""
    words = {f"interna{a}{b}{c}": 2 + 50 * (a == "x") for a in "abcdx" for b in "abcde" for c in "abcde"}
    words |= {f"{a}{b}{c}zational": 3 + 40 * (b == "x") for a in "abcd" for b in "abcdx" for c in "abcde"}
    assert forms(spark, words, block=12, tile=16) == restated(words)


def test_chains_lead_to_the_last_form(spark):
    words = {"abcdefgh": 2, "abcdefg": 20, "abcdefgx": 5, "abcdxfg": 200, "abydxfg": 2000, "tiefirst": 2, "tiefirsu": 40, "tiefirsa": 40}
    got = {r[0]: r for r in forms(spark, words)}
    assert got["abcdefgh"][1:3] == ("abcdefg", "abydxfg") and got["abydxfg"][1:3] == (None, "abydxfg")
    assert got["tiefirst"][1:] == ("tiefirsa", "tiefirsa", 2, 2, 40)
    assert list(got.values()) == restated(words)


def test_very_long_words(spark):
    long = "".join(np.random.default_rng(1).choice(list("abc"), 40_000))
    words = {long: 2, long[:20_000] + "x" + long[20_000:]: 30, long[:-1] + "z": 3, long[1:]: 400, long[::-1]: 5}
    assert forms(spark, words) == restated(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abé", min_size=7, max_size=19) | st.text("ab日", min_size=7, max_size=9), min_size=2, max_size=12, unique=True))
def test_tiles_judge_single_edits(words):
    rows = variants.padded(words)
    ahead, behind = (variants.common(m, m) for m in (rows.ahead, rows.behind))
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            prefix = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert a == b or min(ahead[i, j], len(a), len(b)) == prefix
            reach = min(ahead[i, j], len(a), len(b)) + min(behind[i, j], len(a), len(b))
            assert (reach >= max(len(a), len(b)) - 1 and a != b) == one_edit(a, b)


def test_query_on_whole_documents(spark):
    words = corpus_words([(r.doc_id, r.text) for r in documents(spark).collect()])
    got = QUERIES["op11_spelling_variants"](spark, SMALL)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect())) == restated(words)


def test_odd_rows_and_empty_table(spark):
    docs = odd_documents(spark, "word", "n", "size", "key")
    want = corpus_words([(r[0], r[1]) for r in odd_rows()])
    assert {r.word: r.n for r in variants.counted_words(docs).collect()} == want
    assert sorted(map(tuple, variants.variant_forms(variants.counted_words(docs)).collect())) == restated(want)
    assert variants.variant_forms(variants.counted_words(empty_documents(spark))).count() == 0
