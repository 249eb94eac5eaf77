"""Global row positions without funnelling all rows through one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartlens.session import fresh_path

#: Rows of one name range that ``split_points`` numbers in one task.
CELL = 65536
#: Characters by which it lengthens the prefix of a range that holds more.
STEP = 2


def with_global_position(
    df: DataFrame,
    order: Sequence[Column],
    name: str = "position",
    total_name: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add the 1-based position of each row in the total order ``order``.

    ``row_number()`` over an unpartitioned window moves every row into one
    task. Instead:

    1. range-partition by ``order`` (Spark samples the keys to pick
       balanced bounds), sort inside each partition, number the rows there
       with ``monotonically_increasing_id`` (documented layout: partition id
       in the upper 31 bits, consecutive record number in the lower 33) and
       write them once to the shared folder;
    2. count the written rows per partition and turn the counts into
       offsets - a table with one row per partition, so its size is bounded
       by ``partitions`` and it is safe to broadcast;
    3. position = partition offset + row number inside the partition.

    Offsets and positions come from the same written rows, so they agree
    whatever the planner does (range bounds are sampled anew for each copy
    of an exchange).

    ``order`` must be a total order (unique keys) for the result to be
    deterministic. Optionally adds the total row count as ``total_name``.
    """
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = fresh_path(spark, "positions")
    (
        df.repartitionByRange(n_parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    numbered = spark.read.parquet(path)
    sizes = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_pid",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
        F.sum("_n").over(Window.partitionBy()).alias("_total"),
    )
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33) + 1
    out = numbered.join(F.broadcast(offsets), "_pid").withColumn(name, F.col("_off") + local)
    if total_name:
        out = out.withColumn(total_name, F.col("_total"))
    return out.drop("_pid", "_mid", "_off", "_total")


def split_points(
    rows: DataFrame,
    value: str,
    name: str,
    ranks: Callable[[Column], Sequence[Column]],
    cell: int = CELL,
    step: int = STEP,
) -> list[tuple]:
    """(value, name) of the rows at ``ranks`` in the order ``value`` descending, ``name`` ascending (nulls first).

    ``ranks`` maps the number of rows to 1-based places; places that no row has are left out.
    Nothing is sorted as a whole or written: a histogram of ``value`` gives, by running
    totals over its distinct values, the value at each place. Rows that tie in
    it are counted by the first ``step`` characters of their names, the range
    with the place again by ``step`` more, until a range has at most ``cell`` rows or one name;
    those few are numbered. A round is a grouped count with map-side combine, and
    brings one row per rank to the driver. Its window holds the distinct values, or the
    distinct prefixes of one range. Whole numbers that sum to N over the rows have
    at most sqrt(2 N) distinct values. ``rows`` is computed anew in each round.
    """
    base = rows.select(F.col(value).alias("_v"), F.col(name).alias("_name"))
    down = Window.orderBy(F.col("_v").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = base.groupBy("_v").agg(F.count(F.lit(1)).alias("_n"))
    found = found.withColumn("_upto", F.sum("_n").over(down)).withColumn("_all", F.sum("_n").over(Window.partitionBy()))
    held = F.array(*[k.cast("long") for k in ranks(F.col("_all"))])
    hits = found.select("*", F.posexplode(held).alias("_i", "_k")).where("_upto >= _k and _upto - _n < _k")
    # rank -> range (value, prefix), whether the prefix is the whole name, place in the range, rows of the range
    todo = {r["_i"]: ((r["_v"], ""), False, r["_k"] - r["_upto"] + r["_n"], r["_n"]) for r in hits.collect()}
    length, out = 0, {}
    while True:
        out |= {i: t[0] for i, t in todo.items() if t[1]}
        few = {i: t for i, t in todo.items() if not t[1] and t[3] <= cell}
        out |= _numbered(base, few) if few else {}
        todo = {i: t for i, t in todo.items() if i not in out}
        if not todo:
            return [out[i] for i in sorted(out)]
        length += step
        todo = _narrowed(base, todo, length)


def _in_ranges(base: DataFrame, targets: dict) -> tuple[DataFrame, dict]:
    """The rows in the targets' ranges, with the range's number ``_g``; and each range's number."""
    which = {r: g for g, r in enumerate(dict.fromkeys(t[0] for t in targets.values()))}
    number = F.lit(None).cast("int")
    for (v, prefix), g in which.items():
        inside = F.col("_v").eqNullSafe(F.lit(v))
        number = F.when(inside & F.col("_name").startswith(prefix) if prefix else inside, g).otherwise(number)
    return base.withColumn("_g", number).where(F.col("_g").isNotNull()), which


def _numbered(base: DataFrame, targets: dict) -> dict:
    """The (value, name) of each target, by numbering the rows of its range."""
    rows, which = _in_ranges(base, targets)
    order = Window.partitionBy("_g").orderBy(F.col("_name").asc_nulls_first())
    rows = rows.select("_g", "_name", F.row_number().over(order).alias("_at"))
    places = {(which[t[0]], t[2]) for t in targets.values()}
    wanted = [(F.col("_g") == g) & (F.col("_at") == at) for g, at in sorted(places)]
    names = {(r["_g"], r["_at"]): r["_name"] for r in rows.where(reduce(or_, wanted)).collect()}
    return {i: (t[0][0], names[which[t[0]], t[2]]) for i, t in targets.items()}


def _narrowed(base: DataFrame, targets: dict, length: int) -> dict:
    """The targets with their ranges cut down to the names that share the first ``length`` characters."""
    rows, which = _in_ranges(base, targets)
    cells = rows.groupBy("_g", F.substring("_name", 1, length).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    up = Window.partitionBy("_g").orderBy(F.col("_p").asc_nulls_first())
    upto = F.sum("_n").over(up.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cells = cells.withColumn("_upto", upto).withColumn("_before", upto - F.col("_n"))
    places = {(which[t[0]], t[2]) for t in targets.values()}
    wanted = [(F.col("_g") == g) & F.lit(at).between(F.col("_before") + 1, F.col("_upto")) for g, at in sorted(places)]
    hits, out = cells.where(reduce(or_, wanted)).collect(), {}
    for i, ((v, prefix), _, place, _n) in targets.items():
        hit = next(r for r in hits if r["_g"] == which[v, prefix] and r["_before"] < place <= r["_upto"])
        whole = hit["_p"] is None or len(hit["_p"]) < length
        out[i] = ((v, hit["_p"]), whole, place - hit["_before"], hit["_n"])
    return out
