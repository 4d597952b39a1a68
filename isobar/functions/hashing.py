"""Stable hash buckets: the same row lands in the same bucket on any cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_hash(keys: Sequence[str], salt: str = "") -> Column:
    """First 32 bits of the MD5 of the salted key, as a non-negative bigint."""
    # concat_ws would skip a NULL, and rows that differ only in where it stands would collide.
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys]
    text = F.concat_ws("|", F.lit(salt), *parts)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def bucket(keys: Sequence[str], salt: str, buckets: int = 1000) -> Column:
    return (row_hash(keys, salt) % F.lit(buckets)).cast("int")
