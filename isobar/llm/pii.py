"""Personal data: fixed patterns plus a linear-chain conditional random field over word shapes.

The patterns (email, ip, card, phone) give the base spans. The random field labels every
white-space word with one of the kinds or none. Its features are the shapes of a word and of its
neighbours; it is trained on a small table of word windows taken from a bounded sample of
documents and labelled by the base spans, and reads whole texts. Runs of words it labels
are added as spans of their own, punctuation trimmed off; words that a base span touches are not, and end a run.

Decoding is exact Viterbi. A word whose score for "none" leads by more than any two transitions
can change is "none" on every best path, so it splits the chain; what remains are short segments
that are decoded together in numpy.

A null or empty text has no spans. Rows with equal ids or texts get equal answers. Without any
labelled window (an empty table, or no base span in the sample) only base spans are given.
Offsets are code points, ends exclusive. Other columns are ignored by ``find`` and kept by
``redact``.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.batches import KIND, distinct, gather, map_slices, offsets_of, words

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, end, number of the kind

# The base patterns.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Every ip, card and phone lies inside one of these.
ZONE = re.compile(r"[0-9+][0-9\x20.()+-]{6,}")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
REPEATS = re.compile(r"(.)\1+", re.S)
TRIM = ",;:!?.()[]{}<>|\"'*#%&$"

# Training bounds.
DOCUMENTS = 3000
WINDOWS = 6  # of a document, in the training table only
REACH = 6  # words to either side of a window's middle
WIDTH = 1 << 12
STEPS = 120
L2 = 1e-6
CAUTION = 2.0  # added to the score of "none" when decoding


# --- base spans -----------------------------------------------------------------------

def luhn(digits: str) -> bool:
    values = [int(c) for c in reversed(digits)]
    return (sum(values[::2]) + sum(d * 2 - 9 * (d > 4) for d in values[1::2])) % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost, not overlapping: the run of local signs before an @ that a domain follows."""
    found, done = [], 0
    at = text.find("@")
    while at >= 0:
        if at > done:
            local = len(text[done:at]) - len(text[done:at].rstrip(LOCAL))
            domain = DOMAIN.match(text, at + 1) if local else None
            if domain:
                found.append((at - local, domain.end(), 0))
                done = domain.end()
        # An @ is neither a local nor a domain sign, so nothing before it matters to the next.
        done = max(done, at + 1)
        at = text.find("@", done)
    return found


def numeric_spans(text: str) -> list[Span]:
    found = []
    for zone in ZONE.finditer(text):
        a, b = zone.span()
        for m in IP.finditer(text, a, b):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.groups()):
                found.append((m.start(), m.end(), 1))
        for m in CARD.finditer(text, a, b):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), 2))
        for m in PHONE.finditer(text, a, b):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                found.append((m.start(), m.end(), 3))
    return found


def base_spans(text: str | None) -> list[Span]:
    if not text:
        return []
    return sorted(emails(text) + numeric_spans(text), key=lambda s: (s[0], s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


# --- features -------------------------------------------------------------------------

def shape(word: str) -> str:
    """Kinds of the signs of the whole word, repeats once."""
    return REPEATS.sub(r"\1", word.translate(KIND))


def bucket(n: int) -> int:
    return next((i for i, top in enumerate((0, 1, 3, 6, 9, 13, 19)) if n <= top), 7)


def word_features(word: str) -> list[str]:
    digits = sum(c.isdigit() for c in word)
    return [
        "bias", "s" + shape(word), f"d{bucket(digits)}", f"l{bucket(len(word))}", f"@{min(word.count('@'), 2)}",
        f".{min(word.count('.'), 4)}", "b" + shape(word[:1]), "e" + shape(word[-2:]), f"+{word[:1] == '+'}:{bucket(digits)}",
        f"m{word.rpartition('@')[2].count('.') > 0 and '@' in word}",
    ]


def near_features(word: str | None) -> list[str]:
    if word is None:
        return ["edge"]
    digits = sum(c.isdigit() for c in word)
    return [f"d{bucket(digits)}", "s" + (shape(word) if digits or "@" in word else ""), f"+{word[:1] == '+'}"]


def slots(word: str | None, place: str) -> list[int]:
    names = word_features(word) if place == "w" else near_features(word)
    return [zlib.crc32((place + n).encode()) % WIDTH for n in names]


# --- the random field -----------------------------------------------------------------

@dataclass(frozen=True)
class RandomField:
    weights: np.ndarray  # slots x labels; label 0 is none
    moves: np.ndarray  # from x to
    starts: np.ndarray


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def fit(windows: list[tuple[list[str | None], list[int]]], steps: int = STEPS, l2: float = L2) -> RandomField | None:
    """Maximum likelihood by Adam over all windows; a window has one context word at either end."""
    labels = len(KINDS) + 1
    if not any(any(y) for _, y in windows):
        return None
    # Most words share their features with many others: each distinct feature list is a class.
    classes: dict[tuple[int, ...], int] = {}
    known: dict[tuple[str | None, str], int] = {}

    def class_of(word: str | None, place: str) -> int:
        if (word, place) not in known:
            known[word, place] = classes.setdefault(tuple(slots(word, place)), len(classes))
        return known[word, place]

    by_length: dict[int, list[int]] = {}
    for i, (_, y) in enumerate(windows):
        by_length.setdefault(len(y), []).append(i)
    groups = []
    for length, members in sorted(by_length.items()):
        seen = np.array([
            [class_of(ws[t + 1], "w"), class_of(ws[t], "p"), class_of(ws[t + 2], "n")]
            for ws, _ in (windows[i] for i in members) for t in range(length)
        ])
        groups.append((length, seen, np.array([windows[i][1] for i in members])))
    sizes = np.fromiter(map(len, classes), np.int64, len(classes))
    pool = np.fromiter((s for c in classes for s in c), np.int64, int(sizes.sum()))
    cuts, owner = offsets_of(sizes)[:-1], np.repeat(np.arange(len(sizes)), sizes)
    total = sum(len(g[2]) * g[0] for g in groups)
    params = [np.zeros((WIDTH, labels)), np.zeros((labels, labels)), np.zeros(labels)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        w, moves, starts = params
        grads = [l2 * w, l2 * moves, l2 * starts]
        by_class = np.zeros((len(classes), labels))
        scores = np.add.reduceat(w[pool], cuts)
        for length, seen, truth in groups:
            n = len(truth)
            emit = scores[seen].sum(1).reshape(n, length, labels)
            ahead, behind = np.empty_like(emit), np.zeros_like(emit)
            ahead[:, 0] = starts + emit[:, 0]
            for t in range(1, length):
                ahead[:, t] = log_sum(ahead[:, t - 1, :, None] + moves, 1) + emit[:, t]
            for t in range(length - 2, -1, -1):
                behind[:, t] = log_sum(moves + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            norm = log_sum(ahead[:, -1], 1)
            chance = np.exp(ahead + behind - norm[:, None, None])
            slope = (chance - np.eye(labels)[truth]) / total
            for k in range(labels):
                each = np.repeat(slope[:, :, k].ravel(), 3)
                by_class[:, k] += np.bincount(seen.ravel(), each, len(classes))
            for t in range(1, length):
                pair = ahead[:, t - 1, :, None] + moves + (emit[:, t] + behind[:, t])[:, None, :] - norm[:, None, None]
                grads[1] += np.exp(pair).sum(0) / total
                np.add.at(grads[1], (truth[:, t - 1], truth[:, t]), -1 / total)
            grads[2] += slope[:, 0].sum(0)
        for k in range(labels):
            grads[0][:, k] += np.bincount(pool, by_class[owner, k], WIDTH)
        for i, grad in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * grad
            second[i] = 0.999 * second[i] + 0.001 * grad ** 2
            params[i] = params[i] - 0.1 * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    return RandomField(*params)


def word_scores(names: list[str | None], weights: np.ndarray, place: str) -> np.ndarray:
    rows = [slots(w, place) for w in names]
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    pool = np.fromiter((s for r in rows for s in r), np.int64, int(sizes.sum()))
    return np.add.reduceat(weights[pool], offsets_of(sizes)[:-1])


def emissions(field: RandomField, flat: pa.Array, begin: np.ndarray) -> np.ndarray:
    """Word by label. The features see only kinds of signs, so words are scored once per pattern of kinds."""
    every, codes = distinct(flat)
    patterns: dict[str, int] = {}
    codes = np.array([patterns.setdefault(w.translate(KIND), len(patterns)) for w in every], np.int64)[codes]
    names = list(patterns)
    edge = len(names)
    own = word_scores(names, field.weights, "w")
    left, right = (word_scores([*names, None], field.weights, p) for p in "pn")
    before = np.append([edge], codes[:-1])
    after = np.append(codes[1:], [edge])
    full = np.flatnonzero(np.diff(begin))
    before[begin[:-1][full]] = edge
    after[begin[1:][full] - 1] = edge
    return own[codes] + left[before] + right[after]


def viterbi(field: RandomField, emit: np.ndarray, begin: np.ndarray, caution: float = CAUTION) -> np.ndarray:
    """The best label of every word of all texts."""
    emit = emit.copy()
    emit[:, 0] += caution
    labels = np.zeros(len(emit), np.int64)
    moves = field.moves
    sway = max((moves - moves[:, :1]).max(), (field.starts - field.starts[0]).max()) + max((moves - moves[:1]).max(), 0)
    open_words = np.flatnonzero(emit[:, 0] - emit[:, 1:].max(1) <= sway)
    if not len(open_words):
        return labels
    text = np.searchsorted(begin, open_words, side="right") - 1
    cut = np.ones(len(open_words), bool)
    cut[1:] = (np.diff(open_words) != 1) | (np.diff(text) != 0)
    first = np.flatnonzero(cut)
    sizes = np.diff(np.append(first, len(open_words)))
    order = np.argsort(-sizes, kind="stable")
    first, sizes = first[order], sizes[order]
    at = open_words[first]  # position of each segment's first word
    owner = text[first]
    score = np.where((at > begin[owner])[:, None], moves[0], field.starts) + emit[at]
    back = np.zeros((len(open_words), len(KINDS) + 1), np.int8)
    longest = int(sizes[0])
    active = [int(np.searchsorted(-sizes, -t, side="left")) for t in range(longest + 1)]  # segments longer than t
    for t in range(1, longest):
        n = active[t]
        options = score[:n, :, None] + moves
        back[first[:n] + t] = options.argmax(1)
        score[:n] = options.max(1) + emit[at[:n] + t]
    ends = at + sizes
    score = score + np.where((ends < begin[owner + 1])[:, None], moves[:, 0], 0)
    now = score.argmax(1)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        labels[at[:n] + t] = now[:n]
        if t:
            now[:n] = back[first[:n] + t, now[:n]]
    return labels


# --- spans of texts -------------------------------------------------------------------

def added_spans(text: str, labels: np.ndarray, base: list[Span]) -> list[Span]:
    """Runs of equally labelled words; words that a base span touches are left out and end a run."""
    found: list[Span] = []
    places = [m.span() for m in WORD.finditer(text)]
    ends = np.array([b for _, b in places])
    starts = np.array([a for a, _ in places])
    free = labels.copy()
    for a, b, _ in base:
        free[np.searchsorted(ends, a, side="right"):np.searchsorted(starts, b)] = 0
    i = 0
    while i < len(free):
        j = i + 1
        while j < len(free) and free[j] == free[i]:
            j += 1
        if free[i]:
            a, b = places[i][0], places[j - 1][1]
            body = text[a:b]
            a, b = a + len(body) - len(body.lstrip(TRIM)), b - (len(body) - len(body.rstrip(TRIM)))
            if a < b and any(c.isdigit() or c == "@" for c in text[a:b]):
                found.append((a, b, int(free[i]) - 1))
        i = j
    return found


def spans_of(texts: pa.Array, field: RandomField | None) -> tuple[list[list[Span]], list[list[Span]]]:
    """Base spans and all spans of each text."""
    plain = texts.to_pylist()
    base = [base_spans(t) for t in plain]
    if field is None:
        return base, base
    flat, begin = words(texts)
    labels = viterbi(field, emissions(field, flat, begin), begin) if len(flat) else np.empty(0, np.int64)
    both = []
    hits = np.add.reduceat(np.append(labels, 0), begin[:-1]) if len(labels) else np.zeros(len(plain), np.int64)
    for i, spans in enumerate(base):
        a, b = begin[i], begin[i + 1]
        if a == b or not hits[i]:
            both.append(spans)
        else:
            both.append(sorted(spans + added_spans(plain[i], labels[a:b], spans), key=lambda s: (s[0], s[2])))
    return base, both


def training_windows(docs: DataFrame, text: str = "text", id_column: str = "doc_id", documents: int = DOCUMENTS) -> list:
    """Word windows and labels from about ``documents`` texts, chosen by a hash of the id."""
    named = docs.filter(F.col(id_column).isNotNull())
    draw = F.pmod(F.xxhash64(id_column, F.lit("pii")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    chosen = named.filter(draw < documents / max(named.count(), 1)).select(text)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        out_words, out_labels = [], []
        for t in part.column(text).to_pylist():
            places = [m.span() for m in WORD.finditer(t or "")]
            if not places:
                continue
            starts = np.array([a for a, _ in places])
            labels = np.zeros(len(places), np.int64)
            for a, b, k in base_spans(t):
                labels[max(0, np.searchsorted(starts, a, side="right") - 1):np.searchsorted(starts, b)] = k + 1
            hot = np.flatnonzero(labels)
            middles = [*hot[:: max(1, len(hot) // WINDOWS)][:WINDOWS].tolist(), zlib.crc32(t[:64].encode()) % len(places)]
            digits = [i for i, (a, b) in enumerate(places) if not labels[i] and t[a:b].strip(TRIM)[:1].isdigit()]
            for m in middles + digits[:2]:
                lo, hi = max(0, m - REACH), min(len(places), m + REACH + 1)
                around = [t[a:b] for a, b in places[max(0, lo - 1):hi + 1]]
                around = [None] * (lo == 0) + around + [None] * (hi == len(places))
                out_words.append(around)
                out_labels.append(labels[lo:hi].tolist())
        return pa.RecordBatch.from_arrays(
            [pa.array(out_words, pa.list_(pa.string())), pa.array(out_labels, pa.list_(pa.int64()))], ["words", "labels"]
        )

    got = map_slices(chosen, text, run, "words array<string>, labels array<bigint>").collect()
    windows = [(list(r["words"]), list(r["labels"])) for r in got]
    return sorted(windows, key=lambda w: (w[1], [x or "" for x in w[0]]))


def learn(docs: DataFrame, text: str = "text", id_column: str = "doc_id", documents: int = DOCUMENTS) -> RandomField | None:
    return fit(training_windows(docs, text, id_column, documents))


def find(docs: DataFrame, field: RandomField | None, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, n_<kind> of base spans, base_sha256, spans) for every row."""

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        base, both = spans_of(part.column(text), field)
        counts = np.array([[sum(s[2] == k for s in b) for k in range(len(KINDS))] for b in base], np.int64)
        return pa.RecordBatch.from_arrays(
            [part.column(id_column), *(pa.array(counts[:, k]) for k in range(len(KINDS))),
             pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b in base]),
             pa.array([written(b) for b in both], pa.string())],
            [id_column, *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
        )

    id_type = dict(docs.dtypes)[id_column]
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return map_slices(docs.select(id_column, text), text, run, f"`{id_column}` {id_type}, {counts}, base_sha256 string, spans string")


def replaced(text: str, spans: list[Span]) -> str:
    """Each span by its kind in angle brackets; overlapping spans by the first one's."""
    out, done = [], 0
    for a, b, k in spans:
        if a >= done:
            out += [text[done:a], f"<{KINDS[k].upper()}>"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, field: RandomField | None, text: str = "text") -> DataFrame:
    """The same columns with all spans of ``text`` replaced. A null text stays null."""
    names = docs.columns

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        column = part.column(text)
        _, both = spans_of(column, field)
        new = [t if t is None else replaced(t, s) for t, s in zip(column.to_pylist(), both)]
        at = names.index(text)
        return part.set_column(at, text, pa.array(new, pa.string()))

    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return map_slices(docs, text, run, schema)
