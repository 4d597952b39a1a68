"""Bounded samples of labelled documents for fitting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPREAD = 1 << 20
# Rows of (id, label) that may be broadcast: a few MB at most.
BROADCAST_ROWS = 200_000


def labelled_sample(
    docs: DataFrame, labels: DataFrame, rows: int, text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """(label, text) of about ``rows`` documents per label, chosen by a hash of the id.

    ``labels`` holds the id and ``label``, none of them null. The chosen ids are counted; as long
    as they are few they are broadcast, so texts are only filtered. If ids repeat so often that
    they are many, the join shuffles.
    """
    counts = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    if not counts:
        return docs.select(F.lit(0).alias("label"), text).limit(0)
    shares = [x for k, n in counts.items() for x in (F.lit(k), F.lit(rows / n))]
    draw = F.pmod(F.xxhash64(id_column), F.lit(SPREAD)) / F.lit(float(SPREAD))
    chosen = labels.filter(draw < F.create_map(*shares)[F.col("label")])
    few = chosen.count() <= BROADCAST_ROWS
    return docs.select(id_column, text).join(F.broadcast(chosen) if few else chosen, id_column).select("label", text)
