"""Document fingerprints from closed syncmers, with DataFrame functions only.

Tokens are hashed. Of every ``k`` consecutive tokens the inner runs of ``s`` tokens are compared by
hash; the k tokens are a closed syncmer if the smallest inner hash stands at either edge. Whether they
are depends on these k tokens alone, so an edit moves no anchor outside its reach.

The tokens are a text's words (between ASCII white space). Words cannot place an edit in a short text or
inside a word, so texts below ``SHORT`` code points get the syncmers of their code points besides, and longer
ones those of their words of ``LONG_WORD`` signs or more, joined by blanks. The anchors' 32-bit hashes in
text order, 8 hex digits each, words first, are the fingerprint. Fewer than k tokens make one anchor, the
hash of all; a text without words has none, and an empty fingerprint.

Likeness of two fingerprints is the Jaccard index of their anchor sets, 1 for two empty ones.

``with_next`` gives each row the text after it by ascending id without a global sort in one task:
rows are dealt into blocks of neighbouring ids cut at quantiles, and every block gets a copy of
the next block's first row as its last. A null text counts as empty. Null ids come first; rows
with equal ids are ordered by text. Very long texts are whole. Other columns are ignored, whatever
their names.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

K = 4
S = 1
# The same for code points.
SIGNS_K = 8
SIGNS_S = 4
SHORT = 512
LONG_WORD = 40
BLOCK_ROWS = 2000
MOST_BLOCKS = 1 << 16  # beyond that blocks grow; their rows are sorted with spilling
STRIDE = 64


def with_syncmers(df: DataFrame, tokens: str, out: str, k: int, s: int) -> DataFrame:
    """Adds ``out`` array<int>: the hashes of the closed syncmers of column ``tokens``, an array of hashes."""
    inner, runs = k - s + 1, f"{out}_runs"
    many = F.size(tokens) >= k
    # A column that the next refers to more than once, so that it isn't computed anew for every element.
    df = df.withColumn(runs, F.when(many, F.transform(
        tokens, lambda t, i: F.xxhash64(t, *[F.get(tokens, i + j) for j in range(1, s)])
    )))

    def closed(run: Column, i: Column) -> Column:
        last = F.get(runs, i + (inner - 1))
        low = F.least(*[F.get(runs, i + j) for j in range(1, inner - 1)])
        return F.when((run <= low) | (last <= low) | (inner <= 2), F.hash(*[F.get(tokens, i + j) for j in range(k)]))

    starts = F.slice(runs, 1, F.greatest(F.size(runs) - (k - 1), F.lit(0)))
    anchors = F.filter(F.transform(starts, closed), lambda a: a.isNotNull())
    short = F.when(F.size(tokens) > 0, F.array(F.hash(tokens))).otherwise(F.array().cast("array<int>"))
    return df.withColumn(out, F.when(many, anchors).otherwise(short)).drop(runs)


def with_anchors(df: DataFrame, text: str, out: str, k: int = K, s: int = S) -> DataFrame:
    """Adds ``out`` array<int>: the anchors of column ``text``, those of words before those of code points."""
    names, words, signs, tight = f"{out}_names", f"{out}_words", f"{out}_signs", f"{out}_tight"
    plain = F.translate(F.col(text), "\t\n\x0b\f\r", "     ")
    df = df.withColumn(names, F.filter(F.split(plain, " "), lambda w: w != ""))
    wide = F.filter(names, lambda w: F.length(w) >= LONG_WORD)
    body = F.when(F.size(names) == 0, "").when(F.length(text) < SHORT, F.col(text)).otherwise(F.array_join(wide, " "))
    points = F.when(body != "", F.transform(F.filter(F.split(body, ""), lambda c: c != ""), lambda c: F.xxhash64(c)))
    df = df.withColumns({
        words: F.transform(names, lambda w: F.xxhash64(w)), signs: F.coalesce(points, F.array().cast("array<bigint>")),
    }).drop(names)
    df = with_syncmers(with_syncmers(df, words, out, k, s), signs, tight, SIGNS_K, SIGNS_S)
    return df.withColumn(out, F.concat(out, tight)).drop(words, signs, tight)


def fingerprint(anchors: str) -> Column:
    unsigned = lambda a: a.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))
    return F.array_join(F.transform(anchors, lambda a: F.lpad(F.lower(F.hex(unsigned(a))), 8, "0")), "")


def likeness(a: str, b: str) -> Column:
    both = F.size(F.array_intersect(a, b))
    union = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - both
    return F.when(union == 0, 1.0).otherwise(both / union)


def cuts_of(rows: DataFrame, id_column: str, block_rows: int) -> list[int]:
    """First ids of the blocks, ascending; all are ids of the table."""
    number = rows.agg(F.count(id_column).alias("n"), F.min(id_column).alias("low")).first()
    if not number["n"]:
        return []
    blocks = min(MOST_BLOCKS, max(1, ceil(number["n"] / block_rows)))
    if blocks == 1:
        return [number["low"]]
    shares = [i / blocks for i in range(1, blocks)]
    found = rows.agg(F.percentile_approx(id_column, shares, 10 * max(1000, blocks)).alias("q")).first()["q"]
    return sorted({number["low"], *found})


def block_of(id_column: str, cuts: list[int]) -> Column:
    """How many cuts are not above the id: 0 for a null id. A coarse search, then a fine one."""
    ladder = F.lit(cuts)
    coarse = F.size(F.filter(F.lit(cuts[::STRIDE]), lambda c: c <= F.col(id_column)))
    before = F.greatest(coarse - 1, F.lit(0)) * STRIDE
    inside = F.size(F.filter(F.slice(ladder, before + 1, STRIDE), lambda c: c <= F.col(id_column)))
    return F.when(F.col(id_column).isNull(), 0).otherwise(before + inside)


def with_next(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", carried: tuple[str, ...] = (), block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(id, text, carried..., next_<each of text and carried>): the row after, the first after the last."""
    columns = [text, *carried]
    rows = docs.select(id_column, *columns)
    ids = docs.select(id_column)
    cuts = cuts_of(ids, id_column, block_rows)
    order = [F.col("guest"), F.col(id_column).asc_nulls_first(), F.col(text)]
    if not cuts:  # only null ids, or nothing: one block that follows itself
        dealt = rows.withColumns({"block": F.lit(0), "guest": F.lit(0)})
        heads = rows.groupBy().agg(F.min(F.struct(*columns)).alias("head")).filter("head IS NOT NULL")
        heads = heads.withColumn("block", F.lit(0))
    else:
        dealt = rows.withColumns({"block": block_of(id_column, cuts), "guest": F.lit(0)})
        # The first row of a block has its cut as id, so few rows are looked at.
        firsts = rows.filter(F.col(id_column).isin(cuts) | F.col(id_column).isNull())
        firsts = firsts.withColumn("at", block_of(id_column, cuts))
        heads = firsts.groupBy("at").agg(F.min(F.struct(*columns)).alias("head"))
        nulls = ids.filter(F.col(id_column).isNull()).isEmpty()
        first, last = (1 if nulls else 0), len(cuts)
        heads = heads.withColumn("block", F.when(F.col("at") == first, last).otherwise(F.col("at") - 1))
    guests = heads.select(
        F.lit(None).cast(dict(docs.dtypes)[id_column]).alias(id_column), *[F.col("head")[c].alias(c) for c in columns],
        "block", F.lit(1).alias("guest"),
    )
    along = Window.partitionBy("block").orderBy(*order)
    every = dealt.unionByName(guests)
    every = every.withColumns({f"next_{c}": F.lead(c).over(along) for c in columns})
    return every.filter(F.col("guest") == 0).drop("block", "guest")


def edited_fingerprints(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", k: int = K, s: int = S, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Fingerprints of every text and of the text whose second half the next text's beginning replaces."""
    plain = docs.select(id_column, F.coalesce(text, F.lit("")).alias("body"))
    rows = with_next(with_anchors(plain, "body", "own", k, s), "body", id_column, ("own",), block_rows)
    n = F.length("body")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumns({
        "n_chars": n.cast("bigint"),
        "edited": F.concat(F.substring("body", F.lit(1), n - half), F.substring("next_body", F.lit(1), half)),
    })
    rows = with_anchors(rows, "edited", "changed", k, s)
    return rows.select(
        id_column, "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint("own").alias("fingerprint"), fingerprint("changed").alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"), likeness("own", "next_own").alias("near_next"),
    )
