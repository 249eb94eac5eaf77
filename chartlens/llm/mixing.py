"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame expressions.

Each source's documents, in md5 order, are one stream of words, cut into blocks
of ``BLOCK`` words. The mix is a row of slots of one block each. Slot k belongs
to the source in whose stretch of the cumulated shares the point
``k * golden ratio mod 1`` falls (M. Drmota and R. Tichy, "Sequences,
Discrepancies and Applications", 1997), so any run of slots has every source in
its share to within a few blocks. Documents leave in the order of the slots that read them. A source's slots, ranked, take its blocks in
turn, from the first again after the last, up to its target exactly: slots
beyond it stay empty, and the few that the schedule leaves a source short of
follow at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import hashed, hashed_chunk, running_total, table, words, written

BLOCK = 1024  # words
WEIGHTS = (5, 2, 1)
SHARE = 1.5  # of all words
EPOCHS = 2  # times a source is read at most
GOLDEN = 0.6180339887498949  # (sqrt(5) - 1) / 2
CELLS = 4096  # of the unit interval, for the equi-join of points and shares
SLOT_CHUNK = 65536


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """Per source: rank, source, source_size, weight, target, from rows (source, size).

    Sources by code point (null last) weigh ``weights`` in turn. A target is
    the weight's part of ``share`` times all words, but at most ``epochs``
    times the source's own; what is over goes to the others by weight. In
    order of size / weight the sources at their limit come first, so running
    sums settle it with no repetition. The windows hold one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("rank", F.row_number().over(by_name))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") - 1) % len(weights) + 1)
    s = s.withColumn("weight", weight.cast("double"))
    everything = Window.partitionBy()
    s = s.withColumn("limit", F.col("source_size") * float(epochs))
    s = s.withColumn("per_weight", F.col("limit") / F.col("weight"))
    order = Window.orderBy("per_weight", "rank")
    earlier, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    s = s.withColumn("all_words", F.sum("source_size").over(everything) * share)
    rest = F.col("all_words") - F.coalesce(F.sum("limit").over(earlier), F.lit(0.0))
    s = s.withColumn("level", rest / F.sum("weight").over(onward))
    free = F.min(F.when(F.col("per_weight") > F.col("level"), F.struct("per_weight", "rank", "level"))).over(everything)
    # targets(): with share <= epochs some source is below its limit, or all are at it
    s = s.withColumn("level", free["level"])
    target = F.when(F.col("level").isNull() | (F.col("per_weight") <= F.col("level")), F.col("limit"))
    return s.select("rank", "source", "source_size", "weight", target.otherwise(F.col("weight") * F.col("level")).alias("target"))


def streams(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with words, with ``rank`` of their source and ``at``, their first word's place in its stream."""
    ranked = sizes.where("size > 0").alias("d").join(
        sources.select("rank", "source").alias("s"),
        F.col("d.source").eqNullSafe(F.col("s.source")),
    )
    ranked = ranked.select("d.doc_id", "d.size", "s.rank", hashed(F.col("d.doc_id")).alias("h"))
    return running_total(ranked, ["rank"], ["h", "size"], "size", "at", hashed_chunk(F.col("doc_id"))).drop("h")


def schedule(spark, sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """The slots of the mix: slot, rank (of the source), block, epoch, words.

    ``words`` is ``block`` but for a source's last block and its last slot.
    """
    s = sources.withColumn("goal", F.floor("target")).where("goal > 0")
    s = s.withColumn("blocks", F.ceil(F.col("source_size") / block))
    s = s.withColumn("whole", F.floor(F.col("goal") / F.col("source_size")))  # full readings
    s = s.withColumn("part", F.col("goal") - F.col("whole") * F.col("source_size"))
    s = s.withColumn("slots", F.col("whole") * F.col("blocks") + F.ceil(F.col("part") / block))
    upto = F.sum("slots").over(Window.orderBy("rank"))
    total = F.sum("slots").over(Window.partitionBy())
    s = written(s.withColumn("high", upto / total).withColumn("low", (upto - F.col("slots")) / total).withColumn("total", total), "sources")
    n = s.agg(F.first("total")).first()[0] or 0

    point = F.col("slot").cast("double") * F.lit(GOLDEN)
    points = spark.range(n).select(F.col("id").alias("slot")).withColumn("u", point - F.floor(point))
    points = points.withColumn("cell", F.floor(F.col("u") * CELLS).cast("int"))
    cells = s.select("rank", "low", "high", "slots", F.explode(F.sequence(F.floor(F.col("low") * CELLS).cast("int"), F.floor(F.col("high") * CELLS).cast("int"))).alias("cell"))
    taken = points.join(cells, "cell").where("u >= low and u < high").select("slot", "rank", "slots")
    one = taken.withColumn("one", F.lit(1).cast("long"))
    ranked = running_total(one, ["rank"], ["slot"], "one", "turn", F.floor(F.col("slot") / SLOT_CHUNK))
    ranked = written(ranked.where("turn < slots").select("slot", "rank", "turn"), "slots")
    had = ranked.groupBy("rank").agg(F.count("*").alias("had"))
    short = s.join(had, "rank", "left").withColumn("had", F.coalesce("had", F.lit(0))).where("had < slots")
    short = short.select("rank", F.explode(F.sequence(F.col("had"), F.col("slots") - 1)).alias("turn"))
    late = short.select((F.lit(n) + F.col("turn")).alias("slot"), "rank", "turn")

    every = ranked.unionByName(late).join(s.select("rank", "blocks", "whole", "part", "source_size"), "rank")
    every = every.withColumn("epoch", F.floor(F.col("turn") / F.col("blocks")))
    every = every.withColumn("block", F.col("turn") % F.col("blocks"))
    end = F.when(F.col("epoch") < F.col("whole"), F.col("source_size")).otherwise(F.col("part"))
    size = F.least(F.lit(block).cast("long"), end - F.col("block") * block)
    return every.select("slot", "rank", "block", "epoch", size.alias("words"))


def mix_readings(sizes: DataFrame, weights=WEIGHTS, share=SHARE, epochs=EPOCHS, block: int = BLOCK) -> DataFrame:
    """Per row of (doc_id, source, size): those, source_size, target, taken, first_slot, at and readings.

    ``readings`` has one entry (slot, held) for each time the mix reads the row, in
    order: the first slot in which it does and the words it takes then, all of the row's but for one
    that its source's target cuts. At most ``epochs`` entries; null for a row never taken. ``at`` is the
    row's place in its source's stream.
    """
    spark = sizes.sparkSession
    sizes = written(sizes.select("doc_id", "source", "size"), "sizes")
    sources = written(targets(sizes, weights, share, epochs), "targets")
    stream = written(streams(sizes, sources), "streams")
    pieces = stream.withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("size") - 1) / block)))
    )
    slots = schedule(spark, sources, block).select("slot", "rank", "block", "epoch", "words")
    held = F.least(F.col("at") + F.col("size"), F.col("block") * block + F.col("words"))
    held = held - F.greatest(F.col("at"), F.col("block") * block)
    # a row with words is known by its place in its stream; both groupings share one shuffle
    found = pieces.join(slots, ["rank", "block"]).select("rank", "at", "epoch", "slot", held.alias("held")).where("held > 0")
    found = found.repartition("rank", "at").groupBy("rank", "at", "epoch").agg(F.min("slot").alias("slot"), F.sum("held").alias("held"))
    found = found.groupBy("rank", "at").agg(
        F.sum("held").alias("taken"), F.min("slot").alias("first_slot"), F.sort_array(F.collect_list(F.struct("slot", "held"))).alias("readings")
    )
    rows = stream.join(found, ["rank", "at"], "left").join(sources, "rank")
    names = ["doc_id", "source", "size", "source_size", "target"]
    rows = rows.select(*names, F.coalesce("taken", F.lit(0)).alias("taken"), "first_slot", "at", "readings")
    bare = sizes.where("size = 0").alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
    bare = bare.select("d.doc_id", "d.source", "d.size", "s.source_size", "s.target", F.lit(0).cast("long").alias("taken"))
    return rows.unionByName(bare, allowMissingColumns=True)


def mix_amounts(sizes: DataFrame, weights=WEIGHTS, share=SHARE, epochs=EPOCHS, block: int = BLOCK) -> DataFrame:
    """Per row of (doc_id, source, size): those, source_size, target, taken, the words the mix has of it, and first_slot.

    ``first_slot`` is the first slot of the schedule that reads the row: null for a row that is never taken.
    Rows without words are never taken. A null source is a source; null and
    repeated doc_ids are taken row by row. An empty table gives no rows.
    """
    return mix_readings(sizes, weights, share, epochs, block).drop("at", "readings")


def _first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)), 1, n), "")


def mix(docs: DataFrame, weights=WEIGHTS, share=SHARE, epochs=EPOCHS, block: int = BLOCK) -> DataFrame:
    """The mix as documents, in the order of the schedule: each row as often as the mix reads it, cut where its target ends.

    Columns are those of ``docs``; a cut row has its own ``n_chars``. At most
    one row of a source is cut. Partition i of the result holds the i-th of equal
    stretches of slots, sorted by slot, so a reader that takes rows as
    they come has the sources in their shares to within a few blocks; rows read in one slot are in
    the order of their source's stream.
    """
    size = "__size"
    names = docs.columns
    sized = docs.withColumn(size, words(F.col("text")))
    amounts = mix_readings(sized.select("doc_id", "source", F.col(size).alias("size")), weights, share, epochs, block)
    amounts = written(amounts.where("taken > 0").select("doc_id", "source", "size", "taken", "first_slot", "at", "readings"), "readings")
    end = (amounts.select(F.max(F.array_max("readings")["slot"])).first()[0] or 0) + 1
    key = ["doc_id", "source", "size"]
    # rows alike in all three take the amounts in order
    alike = Window.partitionBy(*key).orderBy(F.desc("taken"), "first_slot", "at")
    amounts = amounts.withColumn("turn", F.row_number().over(alike)).alias("a")
    alike = Window.partitionBy("doc_id", "source", size).orderBy(F.col("text"))
    sized = sized.withColumn("__turn", F.row_number().over(alike)).alias("d")
    on = (F.col(f"d.{size}") == F.col("a.size")) & (F.col("d.__turn") == F.col("a.turn"))
    for k in key[:2]:
        on = on & F.col(f"d.{k}").eqNullSafe(F.col(f"a.{k}"))
    both = sized.join(amounts, on).select("d.*", F.col("a.at").alias("__at"), F.explode("a.readings").alias("__read"))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stretch = F.floor(F.col("__read.slot") * partitions / end).cast("int")
    out = both.repartitionById(partitions, stretch).sortWithinPartitions("__read.slot", "source", "__at")
    part = F.col("__read.held") < F.col(size)
    out = out.withColumn("__cut", F.when(part, _first_words(F.col("text"), F.col("__read.held").cast("int"))).otherwise(F.col("text")))
    changed = {"text": F.col("__cut"), "n_chars": F.when(part, F.length("__cut")).otherwise(F.col("n_chars")) if "n_chars" in names else None}
    return out.select(*[changed[c].cast(docs.schema[c].dataType).alias(c) if c in changed else F.col(c) for c in names])


def op4_source_mixing(spark, sf_dir) -> DataFrame:
    """The mix of all documents: 150 % of all words, sources weighing 5, 2, 1 in turn."""
    docs = table(spark, sf_dir, "documents")
    return mix_amounts(docs.select("doc_id", "source", words(F.col("text")).alias("size")))


OP4_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank
  FROM sizes GROUP BY source),
w AS (
  SELECT *, [5, 2, 1][((rank - 1) % 3 + 1)::INTEGER]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS lim FROM s),
l AS (
  SELECT *, lim / weight AS per_weight,
         (sum(source_size) OVER () * 1.5::DOUBLE
          - coalesce(sum(lim) OVER (ORDER BY lim / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY lim / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
f AS (SELECT level FROM l WHERE per_weight > level ORDER BY per_weight, rank LIMIT 1),
t AS (
  SELECT source, rank, source_size,
         CASE WHEN (SELECT count(*) FROM f) = 0 OR per_weight <= (SELECT level FROM f) THEN lim
              ELSE weight * (SELECT level FROM f) END AS target
  FROM l),
d AS (
  SELECT z.doc_id, z.size, t.*, floor(t.target)::BIGINT // nullif(t.source_size, 0) AS whole,
         floor(t.target)::BIGINT % nullif(t.source_size, 0) AS part,
         sum(z.size) OVER (PARTITION BY t.rank ORDER BY md5(coalesce(z.doc_id::VARCHAR, 'null')), z.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - z.size AS start
  FROM sizes z JOIN t ON z.source IS NOT DISTINCT FROM t.source),
g AS (
  SELECT rank, source_size, ceil(source_size / 1024)::BIGINT AS blocks, floor(target)::BIGINT // source_size AS whole,
         floor(target)::BIGINT % source_size AS part
  FROM t WHERE floor(target) > 0),
c AS (SELECT *, whole * blocks + ceil(part / 1024)::BIGINT AS slots FROM g),
u AS (
  SELECT *, sum(slots) OVER (ORDER BY rank) / sum(slots) OVER () AS high,
         (sum(slots) OVER (ORDER BY rank) - slots) / sum(slots) OVER () AS low, sum(slots) OVER () AS n
  FROM c),
points AS (
  SELECT slot, slot * 0.6180339887498949::DOUBLE - floor(slot * 0.6180339887498949::DOUBLE) AS x
  FROM (SELECT unnest(range((SELECT max(n) FROM u)::BIGINT)) AS slot)),
drawn AS (
  SELECT slot, rank, slots, row_number() OVER (PARTITION BY rank ORDER BY slot) - 1 AS turn
  FROM points JOIN u ON x >= low AND x < high),
had AS (SELECT rank, count(*) AS had FROM drawn WHERE turn < slots GROUP BY rank),
late AS (
  SELECT rank, n, unnest(range(coalesce(had, 0)::BIGINT, slots::BIGINT)) AS turn FROM u LEFT JOIN had USING (rank)),
turns AS (
  SELECT slot, rank, turn FROM drawn WHERE turn < slots
  UNION ALL SELECT n + turn, rank, turn FROM late),
placed AS (
  SELECT slot, rank, turn % blocks AS block,
         least(turn % blocks * 1024 + 1024, CASE WHEN turn // blocks < whole THEN source_size ELSE part END) AS upto
  FROM turns JOIN u USING (rank)),
met AS (
  SELECT rank, start, min(slot)::BIGINT AS first_slot
  FROM (SELECT rank, start, size, unnest(range((start // 1024)::BIGINT, ((start + size - 1) // 1024 + 1)::BIGINT)) AS block FROM d WHERE size > 0) e
  JOIN placed USING (rank, block)
  WHERE least(start + size, upto) > greatest(start, block * 1024)
  GROUP BY rank, start)
SELECT doc_id, source, size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE (whole * size + greatest(0, least(start + size, part) - start))::BIGINT END AS taken,
       CASE WHEN size > 0 THEN first_slot END AS first_slot
FROM d LEFT JOIN met USING (rank, start)
"""
