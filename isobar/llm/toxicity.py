"""Toxicity: a factorization machine over hashed terms.

score = sigmoid(b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), x_i = 1 for a term of the text.
The pairwise part lets two terms weigh together (an insult with a group's mention) where neither
does alone. Terms are lower-cased letter runs and their beginnings of 3 to 7 letters, hashed to
``1 << bits`` slots; beginnings reach the inflected and compound forms. From the training sample
the ``terms`` slots with the highest mutual information with the label are kept, so a long text
adds no noise from rare words.

The fit takes at most about ``rows`` labelled documents of each label, chosen by a hash of the id
(the bound is a parameter), and the two labels weigh the same in total. Whole texts are
scored. A null or empty text has no terms and gets the bias alone; with no labelled rows, or one
label only, the score is that label's. Other columns are ignored; lang, source and ids are no
inputs.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.batches import distinct, gather, map_slices, offsets_of, words
from isobar.llm.samples import labelled_sample

BITS = 18
ROWS = 4000
TERMS = 1024
FACTORS = 8
EPOCHS = 30
RATE = 0.02
L2 = 5e-5
LEAST = 3  # documents a kept slot must occur in
RUN = re.compile(r"[^\W\d_]+")


def slots(word: str, bits: int) -> list[int]:
    """Hashed terms of one lower-cased word."""
    out = []
    for run in RUN.findall(word):
        out.append(zlib.crc32(run.encode()))
        out += [zlib.crc32(b"^" + run[:n].encode()) for n in range(3, min(len(run), 8))]
    mask = (1 << bits) - 1
    return [h & mask for h in out]


def terms(texts: pa.Array, bits: int, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots of each text (numbers within ``kept`` if given), and where texts begin."""
    flat, begin = words(pc.utf8_lower(pc.fill_null(texts, "")))
    names, codes = distinct(flat)
    table = [slots(w, bits) for w in names]
    sizes = np.fromiter(map(len, table), np.int64, len(table))
    pool = np.fromiter((x for t in table for x in t), np.int64, int(sizes.sum()))
    width = 1 << bits
    if kept is not None:
        place = np.full(width, -1, np.int64)
        place[kept] = np.arange(len(kept))
        owner = np.repeat(np.arange(len(table)), sizes)
        pool = place[pool]
        sizes = np.bincount(owner[pool >= 0], minlength=len(table)).astype(np.int64)
        pool = pool[pool >= 0]
    places, each = gather(offsets_of(sizes)[:-1], sizes, codes)
    counts = np.diff(begin)
    rows = np.repeat(np.repeat(np.arange(len(counts)), counts), each)
    found = np.unique(rows * width + pool[places])
    return found % width, np.searchsorted(found // width, np.arange(len(counts) + 1))


@dataclass(frozen=True)
class FactorizationMachine:
    kept: np.ndarray  # slots
    bias: float
    weights: np.ndarray
    factors: np.ndarray  # terms x factors
    bits: int

    def logits(self, at: np.ndarray, begin: np.ndarray) -> np.ndarray:
        return self.bias + margins(self.weights, self.factors, at, begin)[0]


def margins(w: np.ndarray, v: np.ndarray, at: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Linear plus pairwise part of each row, and each row's factor sums."""
    full = np.flatnonzero(np.diff(begin))
    out, sums = np.zeros(len(begin) - 1), np.zeros((len(begin) - 1, v.shape[1]))
    if len(full):
        cut = begin[:-1][full]
        picked = v[at]
        sums[full] = np.add.reduceat(picked, cut)
        squares = np.add.reduceat((picked ** 2).sum(1), cut)
        out[full] = np.add.reduceat(w[at], cut) + 0.5 * ((sums[full] ** 2).sum(1) - squares)
    return out, sums


def informative(at: np.ndarray, begin: np.ndarray, labels: np.ndarray, weight: np.ndarray, bits: int, most: int) -> np.ndarray:
    """Slots with the highest mutual information with the label, in ascending order."""
    owner = np.repeat(np.arange(len(labels)), np.diff(begin))
    seen = np.bincount(at, minlength=1 << bits)
    n1 = np.bincount(at, (weight * labels)[owner], 1 << bits)
    n0 = np.bincount(at, (weight * (1 - labels))[owner], 1 << bits)
    t1, t0 = (weight * labels).sum(), (weight * (1 - labels)).sum()
    n = t1 + t0

    def part(joint, a, b):
        return np.where(joint > 0, joint / n * np.log(np.maximum(joint, 1e-300) * n / np.maximum(a * b, 1e-300)), 0)

    inn, out = n1 + n0, n - n1 - n0
    gain = part(n1, inn, t1) + part(n0, inn, t0) + part(t1 - n1, out, t1) + part(t0 - n0, out, t0)
    gain[seen < LEAST] = -1
    order = np.lexsort((np.arange(len(gain)), -gain))[:most]
    return np.sort(order[gain[order] > 0])


def fit(at: np.ndarray, begin: np.ndarray, labels: np.ndarray, weight: np.ndarray, bits: int = BITS, most: int = TERMS) -> FactorizationMachine:
    """Weighted logistic loss by Adam over mini-batches in a fixed shuffled order."""
    total = weight.sum()
    rate = float((weight * labels).sum() / total) if total else 0.0
    kept = informative(at, begin, labels, weight, bits, most) if 0 < rate < 1 else np.empty(0, np.int64)
    bias = float(np.log(np.clip(rate, 1e-4, 1 - 1e-4) / np.clip(1 - rate, 1e-4, 1 - 1e-4)))
    if not len(kept):
        return FactorizationMachine(kept, bias, np.zeros(0), np.zeros((0, FACTORS)), bits)
    place = np.full(1 << bits, -1, np.int64)
    place[kept] = np.arange(len(kept))
    owner = np.repeat(np.arange(len(labels)), np.diff(begin))
    inside = place[at] >= 0
    at = place[at][inside]
    begin = offsets_of(np.bincount(owner[inside], minlength=len(labels)))
    rng = np.random.default_rng(7)
    params = [np.full(1, bias), np.zeros(len(kept)), rng.normal(0, 0.01, (len(kept), FACTORS))]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    size, step = 256, 0
    weight = weight / weight.mean()
    for _ in range(EPOCHS):
        order = rng.permutation(len(labels))
        for k in range(0, len(order), size):
            rows = order[k:k + size]
            places, each = gather(begin[:-1], np.diff(begin), rows)
            idx, cuts = at[places], offsets_of(each)
            margin, sums = margins(params[1], params[2], idx, cuts)
            chance = 1 / (1 + np.exp(-np.clip(params[0][0] + margin, -40, 40)))
            slope = weight[rows] * (chance - labels[rows]) / len(rows)
            own = np.repeat(np.arange(len(rows)), each)
            by_w = np.bincount(idx, slope[own], len(kept)) + L2 * params[1]
            by_v = np.empty_like(params[2])
            for f in range(FACTORS):
                by_v[:, f] = np.bincount(idx, slope[own] * (sums[own, f] - params[2][idx, f]), len(kept))
            by_v += 10 * L2 * params[2]
            step += 1
            for i, grad in enumerate((np.array([slope.sum()]), by_w, by_v)):
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad ** 2
                params[i] = params[i] - RATE * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    return FactorizationMachine(kept, float(params[0][0]), params[1], params[2], bits)


def learn(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", id_column: str = "doc_id",
    rows: int = ROWS, bits: int = BITS, most: int = TERMS,
) -> FactorizationMachine:
    """Fit on labelled documents. Hashed terms of the bounded sample reach the driver."""
    known = labels.filter(F.col(label).isNotNull() & F.col(id_column).isNotNull())
    known = known.select(id_column, (F.col(label) > 0).cast("int").alias("label"))
    chosen = labelled_sample(docs, known, rows, text, id_column)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        at, begin = terms(part.column(text), bits)
        lists = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(at.astype(np.int32)))
        return pa.RecordBatch.from_arrays([part.column("label"), lists], ["label", "at"])

    # In a fixed order, so that the fit comes out the same each time.
    got = map_slices(chosen, text, run, "label int, at array<int>").toArrow().combine_chunks()
    column = got.column("at").combine_chunks()
    lists = np.split(column.flatten().to_numpy(), np.cumsum(pc.list_value_length(column).to_numpy())[:-1]) if len(got) else []
    truth = np.array(got.column("label").to_pylist(), np.int64)
    order = sorted(range(len(lists)), key=lambda i: (truth[i], len(lists[i]), lists[i].tobytes()))
    lists, truth = [lists[i] for i in order], truth[order].astype(np.float64)
    begin = offsets_of(np.array([len(x) for x in lists], np.int64))
    at = np.concatenate([np.empty(0, np.int32), *lists]).astype(np.int64)
    ones = max(truth.sum(), 1.0)
    weight = np.where(truth == 1, 1 / ones, 1 / max(len(truth) - ones, 1.0))
    return fit(at, begin, truth, weight, bits, most)


def score(docs: DataFrame, model: FactorizationMachine, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Kept columns and score in 0..1 for every row."""

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        if len(model.kept):
            logits = model.logits(*terms(part.column(text), model.bits, model.kept))
        else:
            logits = np.full(part.num_rows, model.bias)
        return pa.RecordBatch.from_arrays(
            [*(part.column(c) for c in keep), pa.array(1 / (1 + np.exp(-np.clip(logits, -40, 40))))], [*keep, "score"]
        )

    fields = dict(docs.dtypes)
    columns = list(dict.fromkeys([*keep, text]))
    return map_slices(docs.select(*columns), text, run, ", ".join([*(f"`{c}` {fields[c]}" for c in keep), "score double"]))
