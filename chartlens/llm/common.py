"""Helpers shared by the training-data operators.

Everything here is small: reading a table, making this package importable in
the Python workers, writing an intermediate table to the shared folder, and
running totals that never put one whole group into one task.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chartlens.session import fresh_path

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


# Environment of the Python workers: the C library's allocator, and Arrow on top of it.
WORKER_MEMORY = {
    "MALLOC_MMAP_THRESHOLD_": str(4 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(8 << 20),
    "MALLOC_ARENA_MAX": "2",
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did.

    Needed where the folder is not on the workers' PYTHONPATH already (local
    sessions, shared code folders); a cluster with its own copy of the code
    passes it with ``--py-files`` and is unaffected.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Hand rows with whole texts to Python workers ``rows`` at a time.

    Spark's default of 10,000 rows a batch is meant for narrow rows; with long texts the JVM
    and the worker hold several copies of some 20 MB each. Sets the session's
    ``spark.sql.execution.arrow.maxRecordsPerBatch``, unless it is set to another value than the default.
    Workers also hand arrays of 4 MB and more back to the system when they are done with them;
    otherwise every idle worker of an executor keeps its largest working set.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(rows))
    for name, value in WORKER_MEMORY.items():
        spark.sparkContext.environment.setdefault(name, value)


def releasing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, handing free memory back to the system when a task ends.

    An executor keeps its idle Python workers for a while; without this each keeps the
    heap of its largest task beside those that work.
    """

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
                trim(0)

    return wrapped


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as parquet in the shared folder, and read back.

    Cuts the lineage: whatever reads it after an executor is lost re-reads
    the files instead of repeating the work above.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` words of a text (null: 0), in the JVM."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def running_total(
    df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, out: str, chunk: Column
) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of a group before this one.

    Rows of a ``group`` are ordered by (``chunk``, ``order``). Totals per
    (group, chunk) are summed first, so a task sees one chunk of a group's
    rows, or one row per chunk, and never a whole group's rows. Group values
    and chunks must not be null.
    """
    c, t, base = "__chunk", "__total", "__base"
    keys = [*group, c]
    rows = df.withColumn(c, chunk)
    before = Window.partitionBy(*group).orderBy(c).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    per_chunk = rows.groupBy(*keys).agg(F.sum(value).alias(t))
    per_chunk = per_chunk.select(*keys, F.coalesce(F.sum(t).over(before), F.lit(0)).alias(base))
    rows = rows.withColumn(t, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return rows.join(per_chunk, keys).select(*df.columns, (F.col(t) + F.col(base)).alias(out))


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Batches sorted by ``keys``, cut between groups: frames and where their groups begin and end."""
    held = None
    for batch in batches:
        if not len(batch):
            continue
        frame = batch if held is None else pd.concat([held, batch], ignore_index=True)
        cuts = _cuts(frame, keys)
        held = frame.iloc[cuts[-2] :]  # may go on in the next batch
        if cuts[-2]:
            yield frame.iloc[: cuts[-2]], cuts[:-1]
    if held is not None:
        yield held, np.array([0, len(held)])


def _cuts(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    change = np.zeros(len(frame), bool)
    for k in keys:
        col = frame[k].to_numpy()
        change[1:] |= col[1:] != col[:-1]
    return np.concatenate([[0], np.flatnonzero(change), [len(frame)]])


def hashed_chunk(key: Column) -> Column:
    """One of 4,096 chunks by the md5 of a key's text (null: the text ``null``)."""
    return F.conv(F.substring(hashed(key), 1, 3), 16, 10).cast("int")


def hashed(key: Column) -> Column:
    """md5 of a key's text, lowercase hex; the same in other SQL engines."""
    return F.md5(F.coalesce(key.cast("string"), F.lit("null")))


def by_bytes(sizes: Sequence[int], limit: int) -> Iterator[tuple[int, int]]:
    """Index ranges whose sizes sum to about ``limit``; a larger item is alone."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (node, root), root the smallest node.

    Alternates the large-star and small-star steps of Kiveris et al., "Connected
    Components in MapReduce and Beyond" (2014) until the edges stop changing.
    Each step is a grouped minimum (combined before the shuffle, so a hub's
    edges are not gathered) and a join; each round's edges are written to the
    shared folder. Nodes without edges are not returned.
    """

    def large(e: DataFrame) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = both.unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        m = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return both.join(m, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()

    def small(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        m = down.groupBy("u").agg(F.min("v").alias("m"))
        near = down.join(m, "u").where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return near.unionByName(m.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    e = written(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = mark(e)
    while True:
        e = written(small(large(e)), "edges")
        now = mark(e)
        if now == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
