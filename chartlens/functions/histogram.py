"""Exact statistics per group from a counting histogram (group, value, n)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def histogram(df: DataFrame, by: Sequence[str], value: str, count: str = "n") -> DataFrame:
    """Rows per (group, value): ``by``, ``value``, ``count``. Counted with map-side combine; additive over shards."""
    return df.groupBy(*by, value).agg(F.count(F.lit(1)).alias(count))


def stats_of(hist: DataFrame, by: Sequence[str], value: str, suffix: str, count: str = "n") -> DataFrame:
    """avg, exact median, min and max of ``value`` per group: ``avg_<suffix>`` and so on.

    ``hist`` has rows (group, value, count); a value may come in several
    rows. The median is selected by cumulative counts, so no group keeps a map of
    its values: a window reads one row per distinct value of a group, and all
    aggregates have fixed-size buffers. NULL values count for nothing; a group with
    only NULLs has NULL statistics.
    """
    v = F.col(value)
    rows = hist.groupBy(*by, value).agg(F.sum(count).alias("_n"))
    rows = rows.withColumn("_n", F.when(v.isNull(), 0).otherwise(F.col("_n")))
    group = Window.partitionBy(*by)
    up_to = group.orderBy(v.asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_upto", F.sum("_n").over(up_to)).withColumn("_all", F.sum("_n").over(group))

    def at(position):
        return F.min(F.when(v.isNotNull() & (F.col("_upto") >= position), v))

    total = F.sum("_n")
    low, high = at(F.floor((F.col("_all") + 1) / 2)), at(F.floor(F.col("_all") / 2) + 1)
    return rows.groupBy(*by).agg(
        F.try_divide(F.sum(v * F.col("_n")), total).alias(f"avg_{suffix}"),
        ((low.cast("double") + high.cast("double")) / 2).alias(f"median_{suffix}"),
        F.min(v).alias(f"min_{suffix}"),
        F.max(v).alias(f"max_{suffix}"),
    )
