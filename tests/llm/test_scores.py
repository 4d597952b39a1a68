"""Scores of the learned operators, restated document by document from their definitions."""

import itertools
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from isobar.llm import ordinal, pii, toxicity
from cases import SMALL, documents, odd_documents, odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def kinds(word):
    return "".join("9" if c.isdigit() else ("A" if c.isupper() else "a") if c.isalpha() else c for c in word)


def quality(text, model):
    """(expected grade, P(grade >= 1)): shares of word forms, square roots, one sum, one sigmoid per threshold."""
    pieces = [w[i:i + 64] for w in WORD.findall(text or "") for i in range(0, len(w), 64)]
    starts = [(w_i, k) for w_i, w in enumerate(WORD.findall(text or "")) for k in range(0, len(w), 64)]
    assert len(starts) == len(pieces)
    width, times = len(model.weights), {}
    for k, p in enumerate(pieces):
        tail = re.search(r"[\W_]+$", p[-8:])
        core = p[:len(p) - len(tail[0])] if tail else p
        names = ["f" + re.sub(r"(.)\1+", r"\1", kinds(p), flags=re.S), "s" + (tail[0][-4:] if tail else ""),
                 f"n{min(len(core), 24) // 2}", "e" + core[-3:].lower()]
        names += ["repeats"] * (k > 0 and pieces[k - 1] == p)
        for n in names:
            slot = zlib.crc32(n.encode()) % width
            times[slot] = times.get(slot, 0) + 1
    eta = sum(model.weights[s] * math.sqrt(n / len(pieces)) for s, n in times.items())
    tails = [sigmoid(eta - t) for t in model.thresholds]
    return sum(tails), tails[0]


def test_quality_scores(spark):
    docs = documents(spark)
    model = ordinal.learn(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(f"odd{i}", r[1]) for i, r in enumerate(odd_rows())]
    rows += [("cjk", "文字と" * 100), ("again", "same same same other other x"), ("signs", "end!!!! a... --- ___")]
    df = spark.createDataFrame([(str(i), t) for i, t in rows], "doc_id string, text string").repartition(5)
    got = {r.doc_id: r for r in ordinal.score(df, model).collect()}
    for i, text in rows:
        expected, tail = quality(text, model)
        assert got[str(i)].expected_grade == pytest.approx(expected, abs=1e-9), i
        assert got[str(i)].tail_probability == pytest.approx(tail, abs=1e-9), i


def toxic(text, model):
    """Bias, weights of the kept terms a text has, and the products of all pairs of their factors."""
    place = {int(slot): k for k, slot in enumerate(model.kept)}
    found = set()
    for word in WORD.findall((text or "").lower()):
        for run in re.findall(r"[^\W\d_]+", word):
            names = [run.encode()] + [b"^" + run[:n].encode() for n in range(3, min(len(run), 8))]
            found |= {place[h] for n in names if (h := zlib.crc32(n) & ((1 << model.bits) - 1)) in place}
    pairs = sum(float(model.factors[a] @ model.factors[b]) for a, b in itertools.combinations(sorted(found), 2))
    return sigmoid(model.bias + sum(model.weights[k] for k in found) + pairs)


def test_toxicity_scores(spark):
    docs = documents(spark)
    model = toxicity.learn(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    assert len(model.kept) and np.abs(model.factors).max() > 0
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(f"odd{i}", r[1]) for i, r in enumerate(odd_rows())]
    df = spark.createDataFrame([(str(i), t) for i, t in rows], "doc_id string, text string").repartition(5)
    got = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    for i, text in rows:
        assert got[str(i)] == pytest.approx(toxic(text, model), abs=1e-9), i


def test_shapes_read_whole_words():
    long = "a" * 60 + "1" * 59
    assert pii.shape(long) == "a9" and pii.shape(long + "@host.com") == "a9@a.a" and pii.shape("") == ""
    assert pii.shape("Ab--12..x") == "Aa-9.a"


def test_labelled_runs_are_split_at_base_spans():
    text = "call 030111222, +49 30 1234567 or 030333444 555 now 0306667"
    base = pii.base_spans(text)
    assert [text[a:b] for a, b, _ in base] == ["+49 30 1234567"]
    words = WORD.findall(text)
    labels = np.array([0 if w in ("call", "or", "now") else 4 for w in words])
    got = pii.added_spans(text, labels, base)
    assert [text[a:b] for a, b, _ in got] == ["030111222", "030333444 555", "0306667"]
    assert pii.added_spans(text, np.full(len(words), 4), []) == [(0, len(text), 3)]
    assert pii.added_spans("", np.empty(0, np.int64), []) == []


def test_spans_of_odd_rows(spark):
    docs = odd_documents(spark, "spans", "n_email")
    field = pii.learn(documents(spark))
    for r in pii.find(docs, field).collect():
        assert r.spans is not None
    _, both = pii.spans_of(pa.array(["x" * 200 + " " + "1" * 200 + "@" + "y" * 100]), field)
    assert all(a < b <= 502 for a, b, _ in both[0])
