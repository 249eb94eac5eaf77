"""How filters interact: what each removes at every place of every order, and its Shapley share.

The filters of a stage are players of a removal game: v(S) is how many documents
a coalition S of filters removes, that is, how many fail at least one of them. Its
potential (S. Hart and A. Mas-Colell, "Potential, Value, and Consistency", 1989) is
computed recursively over all coalitions, P({}) = 0 and
P(S) = (v(S) + sum of P(S without i) over i in S) / |S|; the Shapley value of
filter i is P(all) - P(all without i). What a filter removes at a step of an
order is v(S with i) - v(S), where S are the filters before it.

Everything follows from the number of documents per part and set of failed
filters: 32 numbers a part, counted with partial aggregation. The duplicate
filter never gathers the copies of a text: the smallest id of each text is a
grouped minimum, and rows meet it by text and id together.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import releasing, ship, small_batches, table, written

LETTERS = "ABCDE"
WORDS = 50  # A: fewer words fail
DISTINCT = 65  # B: a lower percentage of distinct words fails
CAPITALS = 5  # C: a higher percentage of A-Z fails
SIGNS = b"#$%&*|"  # D: any of these fails
MEASURES = ("n", "good", "toxic")

_CAPITALS = bytes(range(65, 91))
_AFTER = bytes(range(0x80, 0xC0))  # all but the first bytes of a character


def text_failures(text: str) -> int:
    """Filters A to D that a text fails, as bits 1, 2, 4 and 8."""
    raw = text.encode()
    words = raw.split()  # at the bytes 0x20 and 0x09-0x0D
    n, distinct = len(words), len(set(words))
    del words
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    signs = len(raw) != len(raw.translate(None, SIGNS))
    return (n < WORDS) + 2 * (100 * distinct < DISTINCT * n) + 4 * (100 * capitals > CAPITALS * len(text)) + 8 * signs


def failures(docs: DataFrame, part: str = "source") -> DataFrame:
    """Per row: doc_id, part (null: empty), text_hash, mask (filters A to D that the text fails). Null texts are empty."""
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        "doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.sha2(text, 256).alias("text_hash"), text.alias("text")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[["doc_id", "part", "text_hash"]].copy()
            out["mask"] = np.array([text_failures(t) for t in batch["text"]], np.int32)
            yield out

    return rows.mapInPandas(releasing(run), f"doc_id {kind}, part string, text_hash string, mask int")


def failure_counts(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents per part and set of failed filters (A to E): part, mask, n, good, toxic.

    E, bit 16: the text is that of a row with a smaller doc_id. Rows without a
    doc_id are compared with none. A document is good (toxic) if a row of ``labels``
    with its doc_id has quality = 1 (toxic = 1).
    """
    bits = 1 << 4
    keys = ["doc_id", "part", "text_hash", "mask"]
    same = written(failed.groupBy(*keys).agg(F.count("*").alias("n")), "failures")
    known = same.where("doc_id IS NOT NULL")
    firsts = known.groupBy("text_hash").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    said = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    rows = known.join(firsts, ["text_hash", "doc_id"], "left").join(said, "doc_id", "left")
    copy = F.when(F.col("first").isNull(), bits).otherwise(0)
    rows = rows.select("part", (F.col("mask") + copy).alias("mask"), "n", "good", "toxic")
    nameless = same.where("doc_id IS NULL").select("part", "mask", "n", F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    rows = rows.unionByName(nameless)
    return rows.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")],
    )


def removed_by(counts: np.ndarray) -> np.ndarray:
    """v(S) for each coalition (last axis): documents whose failed filters meet S."""
    size = counts.shape[-1]
    masks = np.arange(size)
    out = np.zeros_like(counts)
    for s in range(size):
        out[..., s] = counts[..., (masks & s) > 0].sum(axis=-1)
    return out


def potentials(v: np.ndarray) -> np.ndarray:
    """n! times the Hart-Mas-Colell potential of each coalition (last axis), whole numbers.

    P(S) is a sum of whole dividends over 1 to |S|, so n! P(S) is whole and every
    division here leaves no remainder.
    """
    size = v.shape[-1]
    players = size.bit_length() - 1
    p = np.zeros_like(v)
    for s in range(1, size):
        inside = [i for i in range(players) if s >> i & 1]
        p[..., s] = (factorial(players) * v[..., s] + sum(p[..., s ^ (1 << i)] for i in inside)) // len(inside)
    return p


def shapley(v: np.ndarray, player: int) -> np.ndarray:
    """n! times the Shapley value: what the filter removes, summed over all orders."""
    p = potentials(v)
    everyone = v.shape[-1] - 1
    return p[..., everyone] - p[..., everyone ^ (1 << player)]


def steps(counts: dict[str, np.ndarray], letters: str = LETTERS) -> pd.DataFrame:
    """All orders and steps of parts (rows) with ``counts`` per set of failed filters (columns)."""
    n = len(letters)
    v = {m: removed_by(c) for m, c in counts.items()}
    parts, total = len(counts["n"]), counts["n"].sum(axis=1)
    share = [shapley(v["n"], i) for i in range(n)]
    out = {c: [] for c in ("at", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")}
    for order in permutations(range(n)):
        before = 0
        for step, i in enumerate(order, start=1):
            after = before | 1 << i
            removed = v["n"][:, after] - v["n"][:, before]
            out["at"].append(np.arange(parts))
            out["filter_order"].append(np.full(parts, "".join(letters[j] for j in order), object))
            out["step"].append(np.full(parts, step, np.int32))
            out["kept"].append(total - v["n"][:, after])
            out["removed"].append(removed)
            out["redundant"].append(v["n"][:, 1 << i] - removed)
            out["unique_fails"].append(counts["n"][:, 1 << i])
            out["good_lost"].append(v["good"][:, after] - v["good"][:, before])
            out["toxic_lost"].append(v["toxic"][:, after] - v["toxic"][:, before])
            out["shapley"].append(share[i])
            before = after
    return pd.DataFrame({k: np.concatenate(x) for k, x in out.items()})


STEP_SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)
PARTS_AT_ONCE = 64


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """One row per part, order of the five filters and step; see ``STEP_SCHEMA``.

    Null parts and the empty text are one part; null texts are empty; repeated rows
    count each. Without rows there are no parts and the result is empty. Other
    columns of ``docs`` and ``labels`` are not read.
    """
    counts = failure_counts(failures(docs, part), labels)
    cells = F.map_from_entries(F.collect_list(F.struct("mask", F.struct(*MEASURES))))  # 32 at most
    wide = counts.groupBy("part").agg(cells.alias("cells"))
    n = 1 << len(LETTERS)

    def column(m: str) -> Column:
        return F.array(*[F.coalesce(F.try_element_at("cells", F.lit(s))[m], F.lit(0)).cast("long") for s in range(n)]).alias(m)

    wide = wide.select("part", *[column(m) for m in MEASURES])

    def run(batches) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), PARTS_AT_ONCE):
                some = batch.iloc[a : a + PARTS_AT_ONCE]
                out = steps({m: np.stack(some[m].to_numpy()) for m in MEASURES})
                out.insert(0, "part", some["part"].to_numpy()[out.pop("at").to_numpy()])
                yield out

    return wide.mapInPandas(releasing(run), STEP_SCHEMA)


def shares(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """Per part and filter: documents failing it, failing only it, and its Shapley share of all removed (they sum to that)."""
    rows = audit(docs, labels, part).where("step = 1")
    letter = F.substring("filter_order", 1, 1)
    return rows.groupBy("part", letter.alias("filter")).agg(
        F.first("removed").alias("fails"), F.first("unique_fails").alias("unique_fails"),
        (F.first("shapley") / factorial(len(LETTERS))).alias("share"),
    )


def op12_filter_audit(spark, sf_dir) -> DataFrame:
    """The five filters over all documents, in all 120 orders, per source."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Filters are applied one after the other here, and what they remove is summed over the orders as such.
OP12_SQL = r"""
WITH l AS (
  SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce("text", '') AS t,
    regexp_extract_all(coalesce("text", ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
f AS (
  SELECT d.part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
    {'A': len(w) < 50,
     'B': 100 * list_unique(w) < 65 * len(w),
     'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t),
     'D': regexp_matches(t, '[#$%&*|]'),
     'E': coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)} AS x
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
g AS (
  SELECT part, x['A'] AS a, x['B'] AS b, x['C'] AS c, x['D'] AS d, x['E'] AS e, count(*) AS n,
    count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f GROUP BY ALL),
p AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS k),
o AS (
  SELECT p1.k || p2.k || p3.k || p4.k || p5.k AS filter_order
  FROM p p1 JOIN p p2 ON p2.k <> p1.k JOIN p p3 ON p3.k NOT IN (p1.k, p2.k)
  JOIN p p4 ON p4.k NOT IN (p1.k, p2.k, p3.k) JOIN p p5 ON p5.k NOT IN (p1.k, p2.k, p3.k, p4.k)),
s AS (
  SELECT g.part, o.filter_order, i.step, substr(o.filter_order, i.step, 1) AS k, g.n, g.good, g.toxic,
    CASE substr(o.filter_order, i.step, 1) WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS fails,
    (a AND instr(left(o.filter_order, i.step - 1), 'A') > 0) OR (b AND instr(left(o.filter_order, i.step - 1), 'B') > 0)
    OR (c AND instr(left(o.filter_order, i.step - 1), 'C') > 0) OR (d AND instr(left(o.filter_order, i.step - 1), 'D') > 0)
    OR (e AND instr(left(o.filter_order, i.step - 1), 'E') > 0) AS gone,
    a::INT + b::INT + c::INT + d::INT + e::INT AS failed
  FROM g, o, (SELECT unnest([1, 2, 3, 4, 5]) AS step) i),
r AS (
  SELECT part, filter_order, step, k,
    coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0) AS kept,
    coalesce(sum(n) FILTER (NOT gone AND fails), 0) AS removed,
    coalesce(sum(n) FILTER (gone AND fails), 0) AS redundant,
    coalesce(sum(n) FILTER (fails AND failed = 1), 0) AS unique_fails,
    coalesce(sum(good) FILTER (NOT gone AND fails), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (NOT gone AND fails), 0) AS toxic_lost
  FROM s GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, k))::BIGINT AS shapley
FROM r
"""
