"""Quality classifier: ordinal cumulative-link regression on hashed word forms.

Ratings are integer grades 0..K-1, any K >= 2. With a score eta the model says
P(grade <= k) = sigmoid(theta_k - eta) with ordered thresholds theta and one weight vector for all
grades (theta_0, then exponentials of free steps, so the order holds while fitting). From it come
the expected grade and the tail probability P(grade >= cut) that selects documents.

Inputs are word forms, hashed into ``width`` slots and counted as shares of a text's words, square
roots taken: the form with letter runs, digit runs and repeated signs collapsed, the trailing
signs, the length, the letters a word ends in, and whether a word repeats the one before. The fit
uses at most about ``rows`` rated documents per grade, chosen by a hash of the id; the bound is a
parameter. Scoring takes whole texts: a word of more than 64 signs counts as several of 64.

A null or empty text has no words and gets the score of an all-zero input. Null ratings and
ratings of missing documents are not learned from; a document rated twice counts twice. With
fewer than two grades among the ratings every document gets the only grade (or 0). Other columns
are ignored.
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

from isobar.llm.batches import KIND, distinct, gather, map_slices, offsets_of, words
from isobar.llm.samples import labelled_sample

WIDTH = 1 << 12
ROWS = 2500
STEPS = 400
L2 = 1e-4
PIECE = 64  # signs of a word; longer ones, as in texts without white space, count as several
SIGNS = re.compile(r"[\W_]+$")


def form(word: str) -> str:
    """Kinds of the signs, runs collapsed to one."""
    kinds = word.translate(KIND)
    return "".join(k for i, k in enumerate(kinds) if not i or k != kinds[i - 1])


def slots(word: str, width: int) -> list[int]:
    """Hashed features of one word."""
    tail = SIGNS.search(word[-8:])  # a longer run of signs says no more
    core = word[:len(word) - len(tail.group())] if tail else word
    names = (
        "f" + form(word), "s" + (tail.group()[-4:] if tail else ""), "n" + str(min(len(core), 24) // 2),
        "e" + core[-3:].lower(),
    )
    return [zlib.crc32(n.encode()) % width for n in names]


def cut_long(flat: pa.Array, begin: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Words of more than PIECE signs as consecutive words of at most PIECE signs."""
    lengths = pc.utf8_length(flat).to_numpy(zero_copy_only=False)
    if not (lengths > PIECE).any():
        return flat, begin
    pieces = np.maximum(-(-lengths // PIECE), 1).astype(np.int64)
    out: list[str] = []
    for word, n in zip(flat.to_pylist(), pieces.tolist()):
        out += [word] if n == 1 else [word[k * PIECE:(k + 1) * PIECE] for k in range(n)]
    return pa.array(out, flat.type), offsets_of(pieces)[begin]


def features(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of square-rooted shares: slots, values, where each text begins."""
    flat, begin = cut_long(*words(texts))
    names, codes = distinct(flat)
    table = [slots(w, width) for w in names]
    sizes = np.fromiter(map(len, table), np.int64, len(table))
    pool = np.fromiter((x for t in table for x in t), np.int64, int(sizes.sum()))
    places, each = gather(offsets_of(sizes)[:-1], sizes, codes)
    counts = np.diff(begin)
    owner = np.repeat(np.arange(len(counts)), counts)
    again = np.zeros(len(codes), bool)
    again[1:] = (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])
    key = np.concatenate([
        np.repeat(owner, each) * width + pool[places],
        owner[again] * width + zlib.crc32(b"repeats") % width,
    ])
    found, times = np.unique(key, return_counts=True)
    rows = found // width
    values = np.sqrt(times / counts[rows])
    return found % width, values, np.searchsorted(rows, np.arange(len(counts) + 1))


@dataclass(frozen=True)
class CumulativeLink:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades
    first: int = 0  # the only grade if there are no thresholds

    def eta(self, at: np.ndarray, values: np.ndarray, begin: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(self.weights[at] * values)])
        return sums[begin[1:]] - sums[begin[:-1]]

    def tails(self, eta: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k, one column per threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None] - eta[:, None], -40, 40)))

    def expected(self, eta: np.ndarray) -> np.ndarray:
        return self.first + self.tails(eta).sum(1)


def tail_of(model: CumulativeLink, eta: np.ndarray, cut: int) -> np.ndarray:
    """P(grade >= cut); certain where there is only one grade."""
    if 1 <= cut <= len(model.thresholds):
        return model.tails(eta)[:, cut - 1]
    return np.full(len(eta), float(cut < 1 or (not len(model.thresholds) and model.first >= cut)))


def fit(
    at: np.ndarray, values: np.ndarray, begin: np.ndarray, grades: np.ndarray, width: int = WIDTH, steps: int = STEPS,
    l2: float = L2,
) -> CumulativeLink:
    """Maximum likelihood by Adam over all rows; each grade weighs as its rows do."""
    levels = int(grades.max()) + 1 if len(grades) else 1
    if len(np.unique(grades)) < 2:
        return CumulativeLink(np.zeros(width), np.empty(0), int(grades[0]) if len(grades) else 0)
    owner = np.repeat(np.arange(len(grades)), np.diff(begin))
    share = np.array([(grades <= k).mean() for k in range(levels - 1)]).clip(1e-3, 1 - 1e-3)
    start = np.maximum.accumulate(np.log(share / (1 - share)))
    gaps = np.log(np.maximum(np.diff(start), 1e-2))
    state = np.concatenate([np.zeros(width), start[:1], gaps])
    one, two = np.zeros_like(state), np.zeros_like(state)
    rows = np.arange(len(grades))
    for step in range(1, steps + 1):
        w, jumps = state[:width], np.exp(state[width + 1:])
        theta = state[width] + np.concatenate([[0.0], np.cumsum(jumps)])
        eta = np.bincount(owner, w[at] * values, len(grades))
        cum = 1 / (1 + np.exp(-np.clip(theta[None] - eta[:, None], -40, 40)))
        full = np.hstack([np.zeros((len(grades), 1)), cum, np.ones((len(grades), 1))])
        slope = full * (1 - full)
        chance = np.maximum(full[rows, grades + 1] - full[rows, grades], 1e-12)
        up, down = slope[rows, grades + 1] / chance, slope[rows, grades] / chance
        by_eta = (up - down) / len(grades)  # of the negative log likelihood
        by_theta = np.zeros((len(grades), levels + 1))
        by_theta[rows, grades + 1] -= up
        by_theta[rows, grades] += down
        by_theta = by_theta[:, 1:-1].sum(0) / len(grades)
        grad = np.concatenate([
            np.bincount(at, by_eta[owner] * values, width) + l2 * w, [by_theta.sum()],
            np.cumsum(by_theta[::-1])[::-1][1:] * jumps,
        ])
        one = 0.9 * one + 0.1 * grad
        two = 0.999 * two + 0.001 * grad ** 2
        state = state - 0.05 * (one / (1 - 0.9 ** step)) / (np.sqrt(two / (1 - 0.999 ** step)) + 1e-8)
    theta = state[width] + np.concatenate([[0.0], np.cumsum(np.exp(state[width + 1:]))])
    return CumulativeLink(state[:width], theta)


def learn(
    docs: DataFrame, ratings: DataFrame, grade: str = "quality", text: str = "text", id_column: str = "doc_id",
    width: int = WIDTH, rows: int = ROWS,
) -> CumulativeLink:
    """Fit on rated documents. Sparse features of the bounded sample reach the driver."""
    rated = ratings.filter(F.col(grade).isNotNull() & F.col(id_column).isNotNull())
    chosen = labelled_sample(docs, rated.select(id_column, F.col(grade).cast("int").alias("label")), rows, text, id_column)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        at, values, begin = features(part.column(text), width)
        cuts = pa.array(begin, pa.int32())
        return pa.RecordBatch.from_arrays(
            [part.column("label"), pa.ListArray.from_arrays(cuts, pa.array(at.astype(np.int32))),
             pa.ListArray.from_arrays(cuts, pa.array(values.astype(np.float32)))],
            ["grade", "at", "share"],
        )

    # In a fixed order, so that sums and the fit come out the same each time.
    got = sorted(map(tuple, map_slices(chosen, text, run, "grade int, at array<int>, share array<float>").collect()))
    begin = offsets_of(np.array([len(r[1]) for r in got], np.int64))
    at = np.fromiter((x for r in got for x in r[1]), np.int64, int(begin[-1]))
    values = np.fromiter((x for r in got for x in r[2]), np.float64, int(begin[-1]))
    return fit(at, values, begin, np.array([r[0] for r in got], np.int64), width)


def score(
    docs: DataFrame, model: CumulativeLink, text: str = "text", keep: tuple[str, ...] = ("doc_id",), cut: int = 1
) -> DataFrame:
    """Kept columns, expected_grade and tail_probability = P(grade >= cut) for every row."""
    width = len(model.weights)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        eta = model.eta(*features(part.column(text), width))
        tail = tail_of(model, eta, cut)
        return pa.RecordBatch.from_arrays(
            [*(part.column(c) for c in keep), pa.array(model.expected(eta)), pa.array(tail)],
            [*keep, "expected_grade", "tail_probability"],
        )

    fields = dict(docs.dtypes)
    columns = list(dict.fromkeys([*keep, text]))
    schema = ", ".join([*(f"`{c}` {fields[c]}" for c in keep), "expected_grade double, tail_probability double"])
    return map_slices(docs.select(*columns), text, run, schema)


def accept(docs: DataFrame, model: CumulativeLink, least: float, text: str = "text", cut: int = 1) -> DataFrame:
    """The rows of ``docs``, all columns, with P(grade >= cut) of ``least`` or more."""
    width = len(model.weights)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        return part.filter(pa.array(tail_of(model, model.eta(*features(part.column(text), width)), cut) >= least))

    return map_slices(docs, text, run, ", ".join(f"`{c}` {t}" for c, t in docs.dtypes))
