"""Exact top-k inner products: norm-sorted vectors, rotated partial sums, residual bounds.

Vectors are rotated on the eigenvectors of their Gram matrix (the SVD's right
singular vectors), so the first few coordinates carry most of a product
(in the manner of C. Teflioudi and R. Gemulla, "Exact and Approximate Maximum
Inner Product Search with LEMP", 2016, and H. Li et al., "FEXIPRO", 2017). A task
holds one block of queries and one lane of candidates of like lengths, takes the candidates by
descending length, and drops a pair once Cauchy-Schwarz bounds it below the
query's k-th best score: first by the lengths, then by the partial sum over the
first coordinates plus the product of the residuals' lengths. What is left is
scored exactly in integers. First bounds come from the longest vectors; with them
a query is only sent to the lanes that are long enough for it, and a lane only to
the blocks of queries that come to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ship, table, written

SCALE = 256
K = 5
EVERY = 50  # queries: ids divisible by this
LANE = 16384  # candidates in a task
QUERIES = 8192  # queries in a task
BLOCK = 1024  # candidates at once
SEEDS = 2048  # longest vectors, for the first bounds
HEAD = 16  # rotated coordinates in the partial sum
LARGEST = 2.0**63  # scaled components are 64-bit integers
CLASSES = 64  # classes of length to a doubling; 64-bit components of any practical width give some 5,000


def _vectors(batches) -> Iterator[pd.DataFrame]:
    """Integer vectors as bytes."""
    for batch in batches:
        x = [v.astype("<i8") for v in batch["x"]]
        norms = [float(np.sqrt((v.astype(float) ** 2).sum())) for v in x]
        yield pd.DataFrame({"id": batch["id"], "x": [v.tobytes() for v in x], "norm": norms})


def _matrix(cells, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    return np.frombuffer(b"".join(c.ljust(8 * width, b"\0") for c in cells), "<i8").reshape(-1, width).astype(float)


def _gram(batches, width: int) -> Iterator[pd.DataFrame]:
    total = np.zeros((width, width))
    for batch in batches:
        if len(batch):
            x = _matrix(batch["x"], width)
            total += x.T @ x
    yield pd.DataFrame({"place": np.arange(width * width), "value": total.ravel()})


def _exact(q, c, i, j) -> np.ndarray:
    """Products of rows ``i`` of q with rows ``j`` of c; an error if one does not fit 64 bits."""
    qs, cs = q.astype(np.int64), c.astype(np.int64)
    score = np.empty(len(i), np.int64)
    for n in range(0, len(i), 65536):
        part = slice(n, n + 65536)
        score[part] = (qs[i[part]] * cs[j[part]]).sum(axis=1)  # modulo 2^64: right wherever the sum fits
    length_q, length_c = np.sqrt((q * q).sum(axis=1)), np.sqrt((c * c).sum(axis=1))
    for n in np.flatnonzero(length_q[i] * length_c[j] >= 2.0**62):
        whole = sum(a * b for a, b in zip(qs[i[n]].tolist(), cs[j[n]].tolist()))
        if not -(2**63) <= whole < 2**63:
            raise OverflowError(f"a score of {whole} does not fit 64 bits")
        score[n] = whole
    return score


def _leading(q, c, mask, order, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and exact score of the k best entries under ``mask`` in each row; ties to the smaller ``order``."""
    most = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * q.shape[1]
    if most * len(c) < 2.0**52:  # products and places among ties fit a double exactly
        key = np.where(mask, (q @ c.T) * len(c) + (len(c) - 1 - order), -np.inf)
        keep = min(k, len(c))
        j = np.argpartition(-key, keep - 1, axis=1)[:, :keep] if keep < len(c) else np.tile(np.arange(len(c)), (len(q), 1))
        best = np.take_along_axis(key, j, axis=1)
        i = np.repeat(np.arange(len(q)), keep)[np.isfinite(best).ravel()]
        score = np.floor(best[np.isfinite(best)] / len(c)).astype(np.int64)
        return i, j[np.isfinite(best)], score
    # pairs that rounding leaves among the k best, scored in integers
    about = q @ c.T
    error = 1e-12 * np.outer(np.sqrt((q * q).sum(axis=1)), np.sqrt((c * c).sum(axis=1))) + 1
    least = np.full(len(q), -np.inf)
    if k < len(c):
        least = np.partition(np.where(mask, about - error, -np.inf), len(c) - k, axis=1)[:, len(c) - k]
    i, j = np.nonzero(mask & (about + error >= least[:, None]))
    score = _exact(q, c, i, j)
    turn = np.lexsort((order[j], -score, i))
    i, j, score = i[turn], j[turn], score[turn]
    first = np.arange(len(i)) - np.searchsorted(i, i) < k
    return i[first], j[first], score[first]


def search(query_ids, q, floor, ids, c, norms, basis, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best candidates of each query with scores of at least ``floor``: positions of queries, positions of candidates, scores.

    Of equal scores the smaller id wins; candidates with the query's id are left out.
    """
    order = np.lexsort((ids, -norms))
    ids, c, norms = ids[order], c[order], norms[order]
    turned_q, turned_c = q @ basis, c @ basis
    head = min(HEAD, basis.shape[1])
    rest_q = np.sqrt((turned_q[:, head:] ** 2).sum(axis=1))
    rest_c = np.sqrt((turned_c[:, head:] ** 2).sum(axis=1))
    length_q = np.sqrt((q * q).sum(axis=1))
    bound = floor.astype(float)  # the least score that still counts
    best = [np.empty(0, np.int64)] * 3  # query, candidate, score
    for a in range(0, len(c), BLOCK):
        b = min(a + BLOCK, len(c))
        slack = 1 + 1e-9 * (length_q * norms[a] + 1)  # rounding of the rotated sums
        live = np.flatnonzero(length_q * norms[a] + slack >= bound)
        if not len(live):
            break  # no later candidate is longer
        upper = turned_q[live, :head] @ turned_c[a:b, :head].T + np.outer(rest_q[live], rest_c[a:b])
        mask = (upper + slack[live, None] >= bound[live, None]) & (query_ids[live, None] != ids[None, a:b])
        rows, columns = mask.any(axis=1), mask.any(axis=0)
        if not rows.any():
            continue
        rows, columns = live[rows], a + np.flatnonzero(columns)
        place = np.argsort(np.argsort(ids[columns], kind="stable"), kind="stable")
        within = mask[np.ix_(np.searchsorted(live, rows), columns - a)]
        i, j, score = _leading(q[rows], c[columns], within, place, k)
        i, j = rows[i], columns[j]
        enough = score.astype(float) >= bound[i]
        i, j, score = (np.concatenate([old, new[enough]]) for old, new in zip(best, (i, j, score)))
        turn = np.lexsort((ids[j], -score, i))
        i, j, score = i[turn], j[turn], score[turn]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        full = place == k - 1
        bound[i[full]] = np.maximum(bound[i[full]], score[full])
        best = [x[place < k] for x in (i, j, score)]
    return best[0], order[best[1]], best[2]


def _class(length: Column) -> Column:
    """Number of the class of a length: never falls with the length, 0 up to 1."""
    return F.floor(CLASSES * F.log2(F.greatest(length, F.lit(1.0)))).cast("int")


def _lanes(counts: dict[int, int], size: int) -> dict[int, tuple[int, int]]:
    """Lanes of about ``size`` rows from rows per value, larger values first: first lane and number of lanes of each value.

    A value of many rows has lanes of its own; smaller ones share one.
    """
    out, lane, held = {}, 0, 0
    for value in sorted(counts, reverse=True):
        n = counts[value]
        if held and held + n > size:
            lane, held = lane + 1, 0
        splits = max(1, -(-n // size))
        out[value] = (lane, splits)
        held += n
        if splits > 1:
            lane, held = lane + splits, 0
    return out


def deal(rows: DataFrame, queries: DataFrame, lane: int = LANE, block: int = QUERIES) -> tuple[DataFrame, DataFrame]:
    """(candidates, queries) with the columns lane and q_lane: one row per task that needs it.

    ``rows`` (norm, row and others) are dealt by classes of descending length into lanes of
    about ``lane`` rows; ``row`` tells rows of one class apart, so that equal ones spread.
    ``queries`` (norm, floor, row and others) go to the lanes that hold a vector
    of at least floor / norm (Cauchy-Schwarz), which are the first ones, and those that go equally
    far share blocks of about ``block``. A lane is copied to those blocks only. The driver
    holds counts per class of length, a number fixed by the range of a double and ``CLASSES``.
    """
    spark = rows.sparkSession
    classes = {r["class"]: r["count"] for r in rows.groupBy(_class(F.col("norm")).alias("class")).count().collect()}
    dealt = _lanes(classes, lane)
    last, ends = -1, {}
    for c in range(max(classes, default=0), min(classes, default=0) - 1, -1):
        if c in dealt:
            last = sum(dealt[c]) - 1
        ends[c] = last  # the last lane with vectors of this class or longer
    # a class less, for rounding; lanes hold whole classes
    needed = F.when(F.col("norm") > 0, _class((F.col("floor").cast("double") - 2) / F.col("norm") / (1 + 1e-8)) - 1).otherwise(0)
    needed = F.least(F.greatest(needed, F.lit(min(ends))), F.lit(max(ends)))
    ends = spark.createDataFrame([*ends.items()], "class int, last int")
    queries = written(queries.withColumn("class", needed).join(ends, "class").drop("class"), "reach")
    reaches = {r["last"]: r["count"] for r in queries.groupBy("last").count().collect()}  # at most one per class
    blocks = _lanes(reaches, block)
    come = [(c, f, n, max([b + m for far, (b, m) in blocks.items() if far >= f], default=0)) for c, (f, n) in dealt.items()]
    come = spark.createDataFrame(come, "class int, first int, splits int, blocks int")
    blocks = spark.createDataFrame([(far, b, m) for far, (b, m) in blocks.items()], "last int, first int, splits int")

    own = (F.col("first") + F.pmod(F.xxhash64("row"), F.col("splits"))).cast("int")
    candidates = rows.withColumn("class", _class(F.col("norm"))).join(come, "class").where("blocks > 0").withColumn("lane", own)
    candidates = candidates.withColumn("q_lane", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    queries = queries.join(blocks, "last").withColumn("q_lane", own).withColumn("lane", F.explode(F.sequence(F.lit(0), "last")))
    return candidates.drop("class", "first", "splits", "blocks"), queries.drop("last", "first", "splits")


def top_k(
    vectors: DataFrame, k: int = K, every: int = EVERY, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Rows query_id, rank (from 1), vec_id, score: each query's k best candidates.

    Components are ``floor(256 * x)``, x as double; queries are the rows whose
    id is divisible by ``every``, candidates all rows with another id. Ties go to the
    smaller vec_id; with fewer candidates all are returned. Rows that are null
    or hold a null or non-finite component, rows with a null id, and rows with
    a scaled component of 2^63 or more (not an integer of 64 bits) take no part. A score
    beyond 64 bits among a query's best of a block is an error. Repeated rows are candidates one by
    one and take a rank each; queries that repeat an id are one query whose candidates count once per row. A
    vector shorter than others ends in zeros.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("x")).where("id is not null")
    rows = rows.where(F.forall("x", lambda c: F.abs(c * SCALE) < LARGEST))  # false for NaN, which Spark puts above all
    rows = rows.select("id", F.transform("x", lambda c: F.floor(c * SCALE)).alias("x"))
    rows = rows.mapInPandas(_vectors, "id long, x binary, norm double").withColumn("row", F.monotonically_increasing_id())
    rows = written(rows, "vectors")
    is_query = F.col("id") % every == 0
    n_q, width = rows.agg(F.count_if(is_query), F.max(F.octet_length("x"))).first()
    width = (width or 8) // 8
    gram = rows.select("x").mapInPandas(lambda b: _gram(b, width), "place int, value double")
    gram = gram.groupBy("place").agg(F.sum("value").alias("value")).orderBy("place").collect()  # width^2 rows
    square = np.array([r["value"] for r in gram] or np.zeros(width * width)).reshape(width, width)
    basis = np.linalg.eigh(square)[1][:, ::-1].copy()

    q_lanes = max(1, -(-n_q // QUERIES))
    queries = rows.where(is_query).withColumn("q_lane", F.pmod(F.xxhash64("row"), F.lit(q_lanes)).cast("int"))
    seeds = rows.orderBy(F.desc("norm"), "id").limit(SEEDS)
    seeds = seeds.withColumn("q_lane", F.explode(F.sequence(F.lit(0), F.lit(q_lanes - 1))))

    def run(q: pd.DataFrame, c: pd.DataFrame):
        ids, others = q["id"].to_numpy(), c["id"].to_numpy()
        return search(
            ids, _matrix(q["x"], width), q["floor"].to_numpy(), others, _matrix(c["x"], width), c["norm"].to_numpy(), basis, k
        )

    def first_bounds(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        q["floor"] = np.iinfo(np.int64).min
        if len(q) and len(c):
            i, _, score = run(q, c)
            last = np.flatnonzero(np.arange(len(i)) - np.searchsorted(i, i) == k - 1)
            q.iloc[i[last], q.columns.get_loc("floor")] = score[last]
        return q[["id", "x", "norm", "row", "floor"]]

    def best(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        i, j, score = run(q, c)
        return pd.DataFrame({"query_id": q["id"].to_numpy()[i], "vec_id": c["id"].to_numpy()[j], "score": score})

    queries = queries.groupBy("q_lane").cogroup(seeds.groupBy("q_lane"))
    queries = written(queries.applyInPandas(first_bounds, "id long, x binary, norm double, row long, floor long"), "queries")
    candidates, queries = deal(rows, queries)
    pairs = queries.groupBy("lane", "q_lane").cogroup(candidates.groupBy("lane", "q_lane"))
    found = pairs.applyInPandas(best, "query_id long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    out = found.withColumn("rank", place).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")


def op7_exact_top_k(spark, sf_dir) -> DataFrame:
    """The 5 highest scores of every 50th embedding against all others."""
    return top_k(table(spark, sf_dir, "embeddings"))


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0),
r AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
  FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
