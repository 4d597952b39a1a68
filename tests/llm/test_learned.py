"""Operators that learn: accuracy on held-out rows, exact parts against plain restatements."""

import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from isobar.llm import language, ordinal, pii, toxicity
from isobar.llm.batches import words
from cases import DOCS, documents, empty_documents, odd_documents, odd_rows

MEDIUM = "/root/testdata/sf0.1"


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


# --- ordinal regression ---------------------------------------------------------------

def graded(levels, n, rng):
    """Sparse rows of one active slot each, whose true score sets the grade."""
    effect = rng.normal(0, 3, 40)
    at = rng.integers(0, 40, n)
    cuts = np.linspace(-3, 3, levels - 1)
    noise = rng.logistic(0, 1, n)
    return at, (effect[at] + noise > cuts[:, None]).sum(0), effect, cuts


@pytest.mark.parametrize("levels", [2, 3, 5])
def test_thresholds_are_ordered_and_grades_recovered(levels):
    rng = np.random.default_rng(levels)
    at, grades, effect, cuts = graded(levels, 6000, rng)
    begin = np.arange(6001)
    model = ordinal.fit(at, np.ones(6000), begin, grades, width=64, steps=600)
    assert (np.diff(model.thresholds) > 0).all() and len(model.thresholds) == levels - 1
    eta = model.eta(np.arange(40), np.ones(40), np.arange(41))
    truth = 1 / (1 + np.exp(cuts[None] - effect[:, None]))
    assert np.abs(model.tails(eta) - truth).mean() < 0.06
    assert np.corrcoef(model.expected(eta), truth.sum(1))[0, 1] > 0.99
    assert np.allclose(model.expected(eta), model.tails(eta).sum(1))


def test_one_grade_and_no_ratings(spark):
    docs = odd_documents(spark, "grade", "expected_grade")
    for ratings, grade in (([(0, 2), (1, 2), (2, None), (None, 1)], 2.0), ([], 0.0)):
        model = ordinal.learn(docs, spark.createDataFrame(ratings, "doc_id long, quality int"))
        rows = ordinal.score(docs.drop("expected_grade"), model).collect()
        assert len(rows) == len(odd_rows()) and {r.expected_grade for r in rows} == {grade}
        assert ordinal.accept(docs, model, 0.5).count() == (len(rows) if grade else 0)
    assert ordinal.score(empty_documents(spark), model).count() == 0


def test_quality_on_held_out_documents(spark):
    docs, labels = spark.read.parquet(f"{MEDIUM}/documents.parquet"), spark.read.parquet(f"{MEDIUM}/labels.parquet")
    out = language.held_out()
    model = ordinal.learn(docs, labels.filter(~out))
    rows = ordinal.score(docs, model).join(labels.filter(out), "doc_id").collect()
    assert np.mean([(r.tail_probability >= 0.5) == (r.quality == 1) for r in rows]) > 0.98
    kept = ordinal.accept(docs, model, 0.5)
    assert kept.columns == docs.columns
    assert kept.count() == ordinal.score(docs, model).filter("tail_probability >= 0.5").count()


# --- factorization machine ------------------------------------------------------------

def test_pairwise_part_equals_all_pairs():
    rng = np.random.default_rng(0)
    w, v = rng.normal(size=12), rng.normal(size=(12, 3))
    rows = [[1, 4, 7], [], [0], [2, 3, 5, 11]]
    begin = np.cumsum([0, *map(len, rows)])
    got = toxicity.margins(w, v, np.array([t for r in rows for t in r]), begin)[0]
    want = [sum(w[i] for i in r) + sum(v[i] @ v[j] for i, j in itertools.combinations(r, 2)) for r in rows]
    assert np.allclose(got, want)


def test_interaction_that_no_linear_model_can_learn():
    """Toxic only where both terms meet or neither does (exclusive or)."""
    rng = np.random.default_rng(1)
    rows = [[t for t, on in ((10, a), (20, b)) if on] + [30] for a, b in rng.integers(0, 2, (3000, 2))]
    labels = np.array([float((10 in r) == (20 in r)) for r in rows])
    # Extra copies of one case make each term informative on its own.
    keep = rng.random(3000) < np.where([10 in r and 20 in r for r in rows], 1.0, 0.6)
    rows, labels = [r for r, k in zip(rows, keep) if k], labels[keep]
    begin, at = np.cumsum([0, *map(len, rows)]), np.array([t for r in rows for t in r])
    model = toxicity.fit(at, begin, labels, np.ones(len(rows)), bits=6)
    place = {s: i for i, s in enumerate(model.kept.tolist())}
    inner = [[place[t] for t in r if t in place] for r in rows]
    logits = model.logits(np.array([t for r in inner for t in r]), np.cumsum([0, *map(len, inner)]))
    assert {10, 20} <= set(place) and ((logits > 0) == (labels == 1)).mean() > 0.95


def test_toxicity_on_held_out_documents(spark):
    docs, labels = spark.read.parquet(f"{MEDIUM}/documents.parquet"), spark.read.parquet(f"{MEDIUM}/labels.parquet")
    out = language.held_out()
    model = toxicity.learn(docs, labels.filter(~out))
    rows = toxicity.score(docs, model).join(labels.filter(out), "doc_id").collect()
    hit = np.array([r.score >= 0.5 for r in rows])
    truth = np.array([r.toxic == 1 for r in rows])
    assert hit[truth].mean() > 0.85 and hit[~truth].mean() < 0.01


def test_toxicity_edge_cases(spark):
    docs = odd_documents(spark, "label", "score")
    model = toxicity.learn(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    scores = [r.score for r in toxicity.score(docs.drop("score"), model).collect()]
    assert len(scores) == len(odd_rows()) and all(0 <= s < 0.5 for s in scores)
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(0, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    assert toxicity.score(empty_documents(spark), model).count() == 0
    got = {(str(r.doc_id), r.score) for r in toxicity.score(docs.drop("score"), model).collect()}
    assert len({s for i, s in got if i in ("4", "5")}) == 1  # equal texts, equal scores


# --- languages ------------------------------------------------------------------------

def plain_profile(texts, size):
    counts = {}
    for text in texts:
        word = ""
        for c in text.lower() + " ":
            if c.isalpha():
                word += c
            elif word:
                padded = f" {word} "
                for n in (1, 2, 3):
                    for i in range(len(padded) - n + 1):
                        gram = padded[i:i + n]
                        if gram.strip(" ") and (n < 3 or gram[1] != " "):
                            counts[gram] = counts.get(gram, 0) + 1
                word = ""
    code = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    return [code(g) for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))[:size]]


def plain_prediction(text, profiles, size):
    own = plain_profile([text or ""], size)
    if not own:
        return "und", 0.0
    apart = {
        name: sum(abs(p.index(g) - i) if g in p else size for i, g in enumerate(own)) for name, p in profiles.items()
    }
    best = min(sorted(apart), key=apart.get)
    return best, 1 - apart[best] / (size * len(own))


def test_profiles_and_distances_equal_a_plain_restatement(spark):
    docs = documents(spark).limit(60).cache()
    size = 80
    profiles = language.learn(docs, size=size)
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.lang, []).append(r.text)
    want = {k: plain_profile(v, size) for k, v in texts.items()}
    assert {k: v.tolist() for k, v in profiles.items()} == want
    both = docs.select(*DOCS_COLUMNS).union(odd_documents(spark).select(*DOCS_COLUMNS))
    got = sorted((str(r.doc_id), r.lang_pred, round(r.score, 9)) for r in language.predict(both, profiles, size=size).collect())
    plain = [(r.doc_id, *plain_prediction(r.text, want, size)) for r in both.collect()]
    assert got == sorted((str(i), name, round(s, 9)) for i, name, s in plain)


DOCS_COLUMNS = [c.split()[0] for c in DOCS.split(", ")]


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    out = language.held_out()
    profiles = language.learn(docs.filter(~out))
    rows = language.predict(docs, profiles, keep=("doc_id", "lang")).filter(out).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    assert {fold(r.doc_id) for r in rows} == {0}
    assert min(r.score for r in rows) > 0.2
    assert language.accept(docs, profiles, 0.2).columns == docs.columns


def test_language_without_anything_learned(spark):
    docs = odd_documents(spark, "code", "n").withColumn("lang", F.lit(None).cast("string"))
    profiles = language.learn(docs)
    assert profiles == {}
    assert {r.lang_pred for r in language.predict(docs, profiles).collect()} == {"und"}
    assert language.predict(empty_documents(spark), profiles).count() == 0
    assert language.accept(docs, profiles, 0.0).count() == 0


# --- personal data --------------------------------------------------------------------

def random_field(rng):
    labels = len(pii.KINDS) + 1
    return pii.RandomField(rng.normal(0, 0.5, (pii.WIDTH, labels)), rng.normal(0, 1, (labels, labels)), rng.normal(0, 1, labels))


def test_viterbi_finds_the_best_of_all_paths():
    rng = np.random.default_rng(4)
    field = random_field(rng)
    texts = ["a b", "", "x1 y2 z3 w4", "+1 (555) 1", "one"]
    flat, begin = words(pa.array(texts))
    emit = pii.emissions(field, flat, begin)
    got = pii.viterbi(field, emit, begin, caution=1.0)
    for i in range(len(texts)):
        own = emit[begin[i]:begin[i + 1]].copy()
        own[:, 0] += 1.0
        best = max(
            itertools.product(range(len(pii.KINDS) + 1), repeat=len(own)),
            key=lambda y: sum(own[t, k] for t, k in enumerate(y)) + sum(field.moves[a, b] for a, b in zip(y, y[1:]))
            + (field.starts[y[0]] if y else 0),
        )
        assert tuple(got[begin[i]:begin[i + 1]]) == best


def test_viterbi_over_long_texts_equals_the_plain_recursion():
    rng = np.random.default_rng(5)
    field = random_field(rng)
    begin = np.array([0, 300, 300, 1000])
    emit = rng.normal(0, 2, (1000, len(pii.KINDS) + 1))
    emit[:, 0] += 4 * (rng.random(1000) < 0.7)
    got = pii.viterbi(field, emit, begin)
    for a, b in zip(begin[:-1], begin[1:]):
        if a < b:
            own = emit[a:b].copy()
            own[:, 0] += pii.CAUTION
            score, back = field.starts + own[0], []
            for e in own[1:]:
                options = score[:, None] + field.moves
                back.append(options.argmax(0))
                score = options.max(0) + e
            path = [int(score.argmax())]
            for step in reversed(back):
                path.append(int(step[path[-1]]))
            assert got[a:b].tolist() == path[::-1]


def test_fit_raises_the_likelihood_of_a_marked_pattern():
    windows = [(["say", "call", f"+1 {n}".replace(" ", ""), "now", None], [0, 4, 0]) for n in range(5_550_000, 5_550_040)]
    field = pii.fit(windows)
    flat, begin = words(pa.array(["please call +15550123 now"]))
    assert pii.viterbi(field, pii.emissions(field, flat, begin), begin, 0.0).tolist() == [0, 0, 4, 0]
    assert pii.fit([(["a", "b", "c"], [0])]) is None


EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def plain_base(text):
    import re

    def luhn(d):
        total = 0
        for i, c in enumerate(reversed(d)):
            n = int(c) * (1 + i % 2)
            total += n - 9 if n > 9 else n
        return total % 10 == 0

    out = [(m.start(), 0, m.end()) for m in re.finditer(EMAIL, text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(IP, text) if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern, least, most in ((2, CARD, 14, 19), (3, PHONE, 10, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if least <= len(digits) <= most and (kind == 3 or luhn(digits)):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rng = np.random.default_rng(8)
    pool = ["a@b.c", "a@b", "@", ".", "x.y@", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111111111111111", "4111 1111-1111 1111",
            "+1 (555) 010-9999", "+1", "+12345678901234567890", " ", "  ", "-", "é", "9", "0", "(", ")", "\n", "_", "a", "12", "+", "b.c_d@e.f-g.h"]
    for _ in range(4000):
        text = "".join(rng.choice(pool, rng.integers(1, 12)))
        assert [(a, k, b) for a, b, k in pii.base_spans(text)] == plain_base(text), repr(text)


def test_pii_of_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    field = pii.learn(docs)
    assert field is not None
    rows = {r.doc_id: r for r in pii.find(docs, field).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert set(rows) == set(texts)
    total = added = 0
    for i, text in texts.items():
        base = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in plain_base(text)]
        spans = rows[i].spans.split(",") if rows[i].spans else []
        assert [s for s in spans if s in base] == base
        total, added = total + len(base), added + len(spans) - len(base)
    assert total > 50 and added < 0.2 * total
    clean = pii.redact(docs, field)
    assert clean.columns == docs.columns
    for r in clean.collect():
        assert not [s for s in plain_base(r.text) if s[1] != 1]
        if not rows[r.doc_id].spans:
            assert r.text == texts[r.doc_id]


def test_pii_edge_cases(spark):
    docs = odd_documents(spark, "spans", "words")
    for field in (None, random_field(np.random.default_rng(3))):
        assert pii.find(docs.drop("spans"), field).count() == len(odd_rows())
        clean = pii.redact(docs, field)
        assert clean.columns == docs.columns and clean.count() == len(odd_rows())
        assert sum(r.text is None for r in clean.collect()) == 1
        assert pii.find(empty_documents(spark), field).count() == 0
    assert pii.learn(empty_documents(spark)) is None


def test_replacing_overlapping_spans():
    assert pii.replaced("ab cd ef", [(0, 5, 2), (3, 8, 3)]) == "<CARD>"
    assert pii.replaced("ab cd ef", [(3, 5, 0)]) == "ab <EMAIL> ef"
