"""Deterministic hash buckets (partitioning-independent sampling)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_bucket(*cols: str, buckets: int = 100) -> Column:
    """Bucket 0..buckets-1 from the md5 of the key columns joined by ``|``.

    Unlike ``randomSplit``, membership does not change with the number or
    order of input partitions, and the same bucket can be computed in SQL:
    first 8 hex digits of md5 as a number, modulo ``buckets``. A NULL key
    gives a NULL bucket.
    """
    parts = []
    for i, c in enumerate(cols):
        parts += [F.lit("|"), F.col(c)] if i else [F.col(c)]
    key = F.concat(*parts)  # NULL if any key is NULL, as ``a || '|' || b`` in SQL
    head = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return (head % F.lit(buckets)).cast("int")
