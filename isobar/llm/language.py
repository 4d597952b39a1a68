"""Language identification by rank-order profiles.

A profile is the ``size`` most frequent letter n-grams (1 to 3 letters of lower-cased words with a
blank at either edge), ranked by count, ties by code. A text's own profile is compared with each
language's by the out-of-place distance: the sum over its n-grams of the difference of ranks, or
``size`` where the language lacks the n-gram. The nearest language wins, ties by name.
``score`` is 1 - distance / largest possible distance.

Profiles are learned from about ``per_language`` documents of each language, chosen by a hash of
the id (all documents where a language has no more); the bound is a parameter of the fit.
Texts that are null or hold no letter are ``und`` with score 0, and so is everything when nothing
could be learned. Equal texts get equal answers; rows with a null id or null language are
predicted but not learned from. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from isobar.llm.batches import map_slices, offsets_of

SIZE = 300
PER_LANGUAGE = 3000
UNKNOWN = "und"
SHIFT = 21  # a code point has at most 21 bits
BLANK = 32
Profiles = Mapping[str, np.ndarray]


def held_out(id_column: str = "doc_id", folds: int = 5) -> Column:
    """Whether the CRC-32 of the id's text falls into fold 0; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % folds == 0, F.lit(False))


def letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points with one blank for every run of others, and where texts begin.

    Every text begins and ends with a blank.
    """
    lower = pc.utf8_lower(pc.fill_null(texts, ""))
    counts = pc.utf8_length(lower).to_numpy(zero_copy_only=False).astype(np.int64) + 2
    joined = "\n" + "\n\n".join(lower.to_pylist()) + "\n" if len(lower) else ""
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
    present = np.flatnonzero(np.bincount(points)) if len(points) else np.empty(0, np.int64)
    is_letter = np.zeros(int(present[-1]) + 1 if len(present) else 1, bool)
    is_letter[[c for c in present.tolist() if chr(c).isalpha()]] = True
    points[~is_letter[points]] = BLANK
    begin = offsets_of(counts)
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != BLANK) | (points[:-1] != BLANK)
    keep[begin[:-1]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return points[keep], kept[begin]


def grams(run: np.ndarray) -> np.ndarray:
    """Codes of all 1- to 3-grams of one text's letters; none has a blank inside or is blank."""
    letter = run != BLANK
    two = run[:-1] << SHIFT | run[1:]
    three = two[:-1] << SHIFT | run[2:]
    return np.concatenate([run[letter], two[letter[:-1] | letter[1:]], three[letter[1:-1]]])


def top(codes: np.ndarray, size: int) -> np.ndarray:
    """The most frequent codes, most frequent first, ties by code."""
    values, counts = np.unique(codes, return_counts=True)
    if len(values) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        near = counts >= least
        values, counts = values[near], counts[near]
    return values[np.argsort(-counts, kind="stable")][:size]


def learn(
    docs: DataFrame, text: str = "text", lang: str = "lang", id_column: str = "doc_id", size: int = SIZE,
    per_language: int = PER_LANGUAGE,
) -> dict[str, np.ndarray]:
    """Language -> its n-gram codes by rank. Only ``size`` codes a language reach the driver."""
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    share = {r[lang]: per_language / r["count"] for r in known.groupBy(lang).count().collect()}
    if not share:
        return {}
    rate = F.create_map(*[x for k, v in share.items() for x in (F.lit(k), F.lit(v))])[F.col(lang)]
    draw = F.pmod(F.xxhash64(id_column), F.lit(1 << 20)) / F.lit(float(1 << 20))
    chosen = known.filter(draw < rate).select(text, lang)

    def count(part: pa.RecordBatch) -> pa.RecordBatch:
        run, begin = letters(part.column(text))
        langs = np.array(part.column(lang).to_pylist(), object)
        names, codes, counts = [], [], []
        for name in sorted(set(langs)):
            own = [grams(run[begin[i]:begin[i + 1]]) for i in np.flatnonzero(langs == name)]
            values, times = np.unique(np.concatenate(own), return_counts=True)
            names += [name] * len(values)
            codes.append(values)
            counts.append(times)
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(np.concatenate(codes)), pa.array(np.concatenate(counts))],
            ["lang", "code", "n"],
        )

    counted = map_slices(chosen, text, count, "lang string, code bigint, n bigint")
    totals = counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    rows = totals.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size).orderBy("lang", "rank")
    found: dict[str, list[int]] = {}
    for r in rows.collect():
        found.setdefault(r["lang"], []).append(r["code"])
    return {k: np.array(v, np.int64) for k, v in sorted(found.items())}


class Ranker:
    """Out-of-place distances to fixed profiles, all languages in one look-up."""

    def __init__(self, profiles: Profiles, size: int = SIZE):
        self.size = size
        self.names = list(profiles)
        every = np.unique(np.concatenate([np.empty(0, np.int64), *profiles.values()]))
        self.codes = every
        self.ranks = np.full((len(every) + 1, len(self.names)), -1, np.int64)
        for j, codes in enumerate(profiles.values()):
            self.ranks[np.searchsorted(every, codes), j] = np.arange(len(codes))

    def predict(self, run: np.ndarray) -> tuple[str, float]:
        own = top(grams(run), self.size)
        if not len(own) or not self.names:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.codes, own)
        at[at == len(self.codes)] = -1
        at[self.codes[at] != own] = -1
        ranks = self.ranks[at]
        apart = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))[:, None])).sum(0)
        best = int(apart.argmin())
        return self.names[best], float(1 - apart[best] / (self.size * len(own)))


def predict(
    docs: DataFrame, profiles: Profiles, text: str = "text", keep: tuple[str, ...] = ("doc_id",), size: int = SIZE
) -> DataFrame:
    """Kept columns, lang_pred and score for every row."""

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        ranker = Ranker(profiles, size)
        codes, begin = letters(part.column(text))
        found = [ranker.predict(codes[a:b]) for a, b in zip(begin[:-1], begin[1:])]
        return pa.RecordBatch.from_arrays(
            [*(part.column(c) for c in keep), pa.array([x[0] for x in found], pa.string()),
             pa.array([x[1] for x in found], pa.float64())],
            [*keep, "lang_pred", "score"],
        )

    fields = dict(docs.dtypes)
    columns = list(dict.fromkeys([*keep, text]))
    schema = ", ".join([*(f"`{c}` {fields[c]}" for c in keep), "lang_pred string, score double"])
    return map_slices(docs.select(*columns), text, run, schema)


def accept(docs: DataFrame, profiles: Profiles, least: float, text: str = "text", size: int = SIZE) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known with a score of ``least`` or more."""

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        ranker = Ranker(profiles, size)
        codes, begin = letters(part.column(text))
        found = [ranker.predict(codes[a:b]) for a, b in zip(begin[:-1], begin[1:])]
        return part.filter(pa.array([name != UNKNOWN and score >= least for name, score in found], pa.bool_()))

    return map_slices(docs, text, run, ", ".join(f"`{c}` {t}" for c, t in docs.dtypes))
