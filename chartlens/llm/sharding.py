"""Sharding by jump consistent hashing, in DataFrame expressions.

J. Lamping and E. Veach, "A Fast, Minimal Memory, Consistent Hash Algorithm"
(2014): a key's shard follows from the key and the number of shards alone, with
no ring table, and going from n to n + 1 shards moves a row only into the new
shard, with probability 1 / (n + 1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hashed_chunk, running_total, table

SHARDS = 24

# Fixed values of the published algorithm: multiplier of its 64-bit generator,
# the 31 bits it takes from the state, and the shift that takes them.
MULTIPLIER = 2862933555777941757
BITS = 1 << 31
SHIFT = 1 << 33
MODULUS = 1 << 64


def jump_shard(key: Column, shards: int) -> Column:
    """Shard 0 to ``shards`` - 1 of a 64-bit integer key (null: as -1).

    The generator's state is kept as a decimal of 20 digits, as its product
    with the multiplier needs 126 bits. The jump grows at each step, so
    ``shards`` steps are enough for any key; steps after the last jump change
    nothing.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    whole = "decimal(20,0)"
    signed = F.coalesce(key.cast("long"), F.lit(-1)).cast(whole)
    state = F.when(signed < 0, signed + F.lit(str(MODULUS)).cast(whole)).otherwise(signed).cast(whole)
    start = F.struct(state.alias("state"), F.lit(-1).cast("long").alias("at"), F.lit(0).cast("long").alias("jump"))

    def step(s: Column, _: Column) -> Column:
        product = s["state"] * F.lit(MULTIPLIER).cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)")
        new = (product % F.lit(str(MODULUS)).cast(whole)).cast(whole)
        bits = F.floor(new / F.lit(SHIFT).cast("decimal(10,0)")).cast("double")
        jump = F.floor((s["jump"] + 1).cast("double") * (F.lit(float(BITS)) / (bits + 1))).cast("long")
        moved = F.struct(new.alias("state"), s["jump"].alias("at"), jump.alias("jump"))
        return F.when(s["jump"] < shards, moved).otherwise(s)

    return F.aggregate(F.sequence(F.lit(0), F.lit(shards)), start, step, lambda s: s["at"].cast("int"))


def assign_shards(rows: DataFrame, key: str, shards: int = SHARDS, ties: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` with shard, grown_shard (with one more shard) and slot (gapless from 0 in its shard).

    Slots follow the md5 chunk of the key, then the key and the columns
    ``ties``; rows that agree in all of them take their slots in any order.
    Null keys are sharded as -1. Columns of these three names are replaced.
    """
    rows = rows.drop("shard", "grown_shard", "slot")
    sharded = rows.withColumn("shard", jump_shard(F.col(key), shards)).withColumn(
        "grown_shard", jump_shard(F.col(key), shards + 1)
    )
    one = sharded.withColumn("__one", F.lit(1).cast("long"))
    slots = running_total(one, ["shard"], [key, *ties], "__one", "slot", hashed_chunk(F.col(key)))
    return slots.drop("__one")


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", shards: int = SHARDS) -> None:
    """Writes the rows under ``path``, one folder ``shard=N`` per shard."""
    sharded = docs.withColumn("shard", jump_shard(F.col(key), shards))
    # a shard is written by several tasks, so a large one is no single task's work
    salt = F.pmod(F.xxhash64(F.struct(*docs.columns)), F.lit(16))
    sharded.repartition("shard", salt).write.partitionBy("shard").parquet(path)


def shard_documents(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Null and empty texts have size 8 and CRC 0. Repeated rows get a slot each.
    Other columns are not read.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    out = assign_shards(rows, "doc_id", shards, ("size", "text_crc32"))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op8_sharding(spark, sf_dir) -> DataFrame:
    """All documents in shards 0 to 23 under the law ``key``."""
    return shard_documents(table(spark, sf_dir, "documents"))


#: The same generator and jumps as a recursion, the CRC from its polynomial.
OP8_SQL = f"""
WITH RECURSIVE
bits(v, x, k) AS (
  SELECT i, i::BIGINT, 0 FROM range(256) t(i)
  UNION ALL
  SELECT v, CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, k + 1 FROM bits WHERE k < 8),
crcs AS (SELECT list(x ORDER BY v) AS t FROM bits WHERE k = 8),
jumps(doc_id, state, jump) AS (
  SELECT DISTINCT doc_id, CASE WHEN doc_id < 0 THEN doc_id::HUGEINT + {MODULUS}::HUGEINT ELSE doc_id::HUGEINT END,
         0::BIGINT
  FROM documents
  UNION ALL
  SELECT doc_id, new, floor((jump + 1)::DOUBLE * ({BITS}::DOUBLE / ((new // {SHIFT})::DOUBLE + 1)))::BIGINT
  FROM (SELECT doc_id, jump, (state * {MULTIPLIER}::HUGEINT + 1) % {MODULUS}::HUGEINT AS new
        FROM jumps WHERE jump <= {SHARDS})),
shards AS (
  SELECT doc_id, max(jump) FILTER (WHERE jump < {SHARDS})::INTEGER AS shard,
         max(jump) FILTER (WHERE jump <= {SHARDS})::INTEGER AS grown_shard
  FROM jumps GROUP BY doc_id),
sized AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex, '..'),
             lambda h: ('0x' || h)::BIGINT)),
           lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) AS text_crc32
  FROM (SELECT doc_id, text, hex(encode(coalesce(text, ''))) AS hex FROM documents), crcs)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY substr(md5(doc_id::VARCHAR), 1, 3), doc_id, size, text_crc32) - 1 AS slot,
       grown_shard
FROM sized JOIN shards USING (doc_id)
"""
