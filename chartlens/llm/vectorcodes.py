"""Codes of vectors from one codebook per part, trained by active-entry Lloyd rounds.

A vector is cut into equal consecutive parts, and each part is replaced by the
index of the nearest entry of its position's codebook (H. Jegou et al., "Product
Quantization for Nearest Neighbor Search", 2011). Rounds of Lloyd's method move the
entries. A part whose assigned entry did not move in a round keeps its exact
distance, which is stored with the row, and is compared with the moved entries
only: every other entry stands where it lost before (T. Kaukoranta, P. Franti and
O. Nevalainen, "A Fast Exact GLA Based on Code Vector Activity Detection", 2000).
The other parts are compared with all entries. Ties go to the lower index.

Rows stay where they are: a round reads the rows with their codes and distances,
and writes them again; only sums per (part, entry) are shuffled and collected, as
many as the codebooks have components. All distances are exact integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, table, written

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
HOT = 1000  # a label with more than this share of all rows is joined by broadcast; there are fewer of them
TOP = 2**63

STATE = "id {id}, label {label}, x binary, code binary, distance binary, error long"


@dataclass
class Books:
    """Entries of each part position: ``entries[part, index, component]``, whole numbers as doubles, all exact.

    ``moved[part, index]`` marks the entries that the last round moved; None before the first.
    """

    entries: np.ndarray
    moved: np.ndarray | None = None

    def text(self) -> str:
        """All components in decimal, by part, entry and position, joined by commas."""
        return ",".join(str(int(c)) for c in self.entries.ravel())

    def sha256(self) -> str:
        return hashlib.sha256(self.text().encode()).hexdigest()

    def decode(self, code: str) -> np.ndarray:
        """The scaled vector that a code stands for."""
        return np.concatenate([self.entries[p, k] for p, k in enumerate(bytes.fromhex(code))])


def packed(row: np.ndarray) -> bytes:
    """A row of whole numbers in doubles: 2 bytes each where they fit, else the doubles."""
    small = len(row) == 0 or np.abs(row).max() < 2**15
    return row.astype("<i2" if small else "<f8").tobytes()


def unpacked(column: pa.Array, size: int) -> np.ndarray:
    """Rows of ``packed``, as a matrix of doubles."""
    out = np.empty((len(column), size))
    if not size:
        return out
    length = pc.binary_length(column).to_numpy(zero_copy_only=False)
    for kind, width in (("<i2", 2), ("<f8", 8)):
        at = np.flatnonzero(length == width * size)
        out[at] = np.frombuffer(b"".join(column.take(pa.array(at)).to_pylist()), kind).reshape(len(at), size)
    return out


def scaled(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that take part, and floor(256 * x) of their components, followed by zeros up to ``size``."""
    length = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    x = pc.fill_null(column.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(length)), np.maximum(length, 0))
    bad = np.bincount(owner, ~np.isfinite(x), len(length)) > 0
    kept = np.flatnonzero((length >= 0) & ~bad)
    start = np.cumsum(np.maximum(length, 0)) - np.maximum(length, 0)
    with np.errstate(over="ignore"):
        x = np.floor(x * SCALE)
    out = np.zeros((len(kept), size))
    for n in np.unique(length[kept]):
        at = np.flatnonzero(length[kept] == n)
        out[at, :n] = x[start[kept[at]][:, None] + np.arange(n)]
    if not np.isfinite(out).all():
        raise OverflowError("a component of 2^1016 or more cannot be scaled")
    return kept, out


def distances(x: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each row and the squared distance to it: an exact integer, as int64 or as object."""
    most = max(np.abs(x).max(initial=0), np.abs(e).max(initial=0))
    if 4 * most * most * max(x.shape[1], 1) < 2.0**52:  # every sum below is a whole number that a double holds
        d = (x * x).sum(axis=1)[:, None] - 2 * (x @ e.T) + (e * e).sum(axis=1)
        k = d.argmin(axis=1)  # the first of equal ones
        return k, d[np.arange(len(x)), k].astype(np.int64)
    k, out = np.zeros(len(x), np.int64), np.empty(len(x), object)
    for i, row in enumerate(x):  # large components: entries that rounding cannot tell apart are compared in integers
        with np.errstate(over="ignore", invalid="ignore"):
            rough = ((row - e) ** 2).sum(axis=1)
            close = np.flatnonzero(~(rough > rough.min() * (1 + 1e-9)))
        whole = [sum((int(a) - int(b)) ** 2 for a, b in zip(row, e[c])) for c in close]
        out[i] = min(whole)
        k[i] = close[whole.index(out[i])]
    return k, out


def assign(
    x: np.ndarray, books: Books, code: np.ndarray | None = None, known: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, int]:
    """Codes and squared distances (rows x parts) under ``books``, and how many distances were computed.

    ``code`` and ``known`` are those under the books before their last round; a
    known distance of -1 is not known. Distances too large for 64 bits come as objects.
    """
    parts, size, width = books.entries.shape
    new, out, compared = np.zeros((len(x), parts), np.uint8), np.zeros((len(x), parts), np.int64), 0

    def put(at: np.ndarray, p: int, d: np.ndarray) -> None:
        nonlocal out
        if d.dtype == object and out.dtype != object and max(d, default=0) >= TOP:
            out = out.astype(object)
        out[at, p] = d

    for p in range(parts):
        v, e = x[:, p * width : (p + 1) * width], books.entries[p]
        stay = np.zeros(len(x), bool)
        if code is not None and books.moved is not None:
            stay = ~books.moved[p][code[:, p]] & (known[:, p] >= 0)
            moved = np.flatnonzero(books.moved[p])
            at = np.flatnonzero(stay)
            new[at, p], best = code[at, p], known[at, p]
            if len(moved) and len(at):
                k, d = distances(v[at], e[moved])
                k = moved[k]
                better = (d < best) | ((d == best) & (k < new[at, p]))
                new[at[better], p] = k[better]
                best = np.where(better, d, best)
            put(at, p, best)
            compared += len(at) * len(moved)
        rest = np.flatnonzero(~stay)
        if len(rest):
            k, d = distances(v[rest], e)
            new[rest, p] = k
            put(rest, p, d)
            compared += len(rest) * size
    return new, out, compared


def _step(books: Books, schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Assigns the rows of a task, from their stored codes and distances where there are any."""
    parts, _, width = books.entries.shape

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unpacked(batch.column("x"), parts * width)
            code = known = None
            if "code" in batch.schema.names:
                code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts)
                known = np.frombuffer(b"".join(batch.column("distance").to_pylist()), "<i8").reshape(-1, parts)
            code, distance, _ = assign(x, books, code, known)
            plain = distance.dtype != object
            fits = distance if plain else np.where(distance >= TOP, -1, distance).astype(np.int64)
            if plain and distance.max(initial=0) < TOP // parts:
                error = distance.sum(axis=1).tolist()
            else:
                error = [sum(map(int, row)) for row in distance]
            columns = [batch.column("id"), batch.column("label"), batch.column("x")]
            columns.append(pa.array([c.tobytes() for c in code], pa.binary()))
            columns.append(pa.array([d.astype("<i8").tobytes() for d in fits], pa.binary()))
            columns.append(pa.array([e if e < TOP else None for e in error], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _sums(parts: int, size: int, width: int):
    """Per task: count (place -1) and component sums of each entry's parts, as decimal texts."""

    def run(batches):
        count = np.zeros((parts, size), np.int64)
        total = np.zeros((parts, size, width), object)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unpacked(batch.column("x"), parts * width)
            code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts)
            exact = np.abs(x).max(initial=0) * len(x) < 2.0**53
            for p in range(parts):
                count[p] += np.bincount(code[:, p], minlength=size)
                for w in range(width):
                    v = x[:, p * width + w]
                    if exact:
                        total[p, :, w] += [int(s) for s in np.bincount(code[:, p], v, size)]
                    else:
                        for k, c in zip(code[:, p], v):
                            total[p, k, w] += int(c)
        p, k = np.nonzero(count)
        cells = [(*key, -1, str(n)) for *key, n in zip(p.tolist(), k.tolist(), count[p, k].tolist())]
        cells += [(a, b, w, str(total[a, b, w])) for a, b in zip(p.tolist(), k.tolist()) for w in range(width)]
        names = ["part", "entry", "place", "value"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*cells) if cells else [()] * 4, (pa.int32(),) * 3 + (pa.string(),))], names
        )

    return run


def _moved(books: Books, rows: DataFrame) -> Books:
    """The books after one round: each entry with parts becomes their mean, rounded down."""
    parts, size, width = books.entries.shape
    cells = rows.select("x", "code").mapInArrow(_sums(parts, size, width), "part int, entry int, place int, value string")
    cells = cells.groupBy("part", "entry", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    found = {(r["part"], r["entry"], r["place"]): int(r["value"]) for r in cells.collect()}  # one per component at most
    new = books.entries.copy()
    for (p, k, w), value in found.items():
        if w >= 0:
            new[p, k, w] = value // found[p, k, -1]
            if abs(new[p, k, w]) >= 2.0**53 and int(new[p, k, w]) != value // found[p, k, -1]:
                raise OverflowError("a mean of components beyond 2^53 is no double")
    return Books(new, (new != books.entries).any(axis=2))


def with_label_error(rows: DataFrame) -> DataFrame:
    """Adds ``label_error``: the sum of ``error`` over the rows of the same label, nulls together.

    Totals of labels with more than 1/``HOT`` of all rows, fewer than ``HOT`` of
    them, are broadcast; the other labels' rows are joined by label, no label
    having more than that share.
    """
    totals = written(rows.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "label-errors")
    n = totals.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * HOT > n
    far = F.broadcast(totals.where(hot).select(F.col("label").alias("_l"), "label_error"))
    near = totals.where(~hot).select(F.col("label").alias("_l"), "label_error")
    same = F.col("label").eqNullSafe(F.col("_l"))
    out = rows.join(far, same).drop("_l")
    rare = rows.join(far.select("_l"), same, "left_anti")
    return out.unionByName(rare.join(near, same).drop("_l"))


def train(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, Books]:
    """Rows (id, label, code, error) of all vectors that take part, written, and the final codebooks.

    Components are floor(256 * x). Rows that are null or hold a null or non-finite
    component take no part. A vector shorter than others, or not a multiple of
    ``parts`` long, ends in zeros. Codebooks start as the parts of the ``entries`` rows with the smallest
    ids (null ids last; repeated ids by their components' bytes; every repeated row counts). An error beyond
    64 bits ends the job.
    """
    if not 0 < entries <= 256:
        raise ValueError("an index has two hex digits: 1 to 256 entries")
    ship(vectors.sparkSession)
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(vector).alias("v"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    usable = ~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    width = -(-(rows.where(usable).agg(F.max(F.size("v"))).first()[0] or 0) // parts)

    def scale(batches):
        for batch in batches:
            kept, x = scaled(batch.column("v"), parts * width)
            at = pa.array(kept)
            out = [batch.column("id").take(at), batch.column("label").take(at), pa.array([packed(r) for r in x], pa.binary())]
            yield pa.RecordBatch.from_arrays(out, names=["id", "label", "x"])

    rows = rows.where(usable).mapInArrow(scale, f"id {kinds['id']}, label {kinds['label']}, x binary")
    rows = written(rows, "scaled")
    first = rows.orderBy(F.asc_nulls_last("id"), "x").select("x").limit(entries).toArrow()  # ``entries`` rows
    start = unpacked(first.column("x").combine_chunks(), parts * width).reshape(len(first), parts, width)
    books = Books(start.transpose(1, 0, 2).copy())
    schema = STATE.format(**kinds)
    arrow = rows.select("id", "label", "x").limit(0).toArrow().schema
    for name, kind in (("code", pa.binary()), ("distance", pa.binary()), ("error", pa.int64())):
        arrow = arrow.append(pa.field(name, kind))
    for _ in range(rounds):
        rows = written(rows.mapInArrow(_step(books, arrow), schema), "assigned")
        books = _moved(books, rows)
    rows = rows.mapInArrow(_step(books, arrow), schema)
    fits = F.coalesce("error", F.raise_error(F.lit("the error of a vector does not fit 64 bits")).cast("long"))
    return written(rows.select("id", "label", "code", fits.alias("error")), "coded"), books


def codes(vectors: DataFrame, vec_id: str = "vec_id", **more) -> DataFrame:
    """Per vector of ``train``: ``vec_id``, code (two hex digits a part), error, label_error, codebooks_sha256."""
    rows, books = train(vectors, vec_id=vec_id, **more)
    out = with_label_error(rows)
    return out.select(
        F.col("id").alias(vec_id), F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(books.sha256()).alias("codebooks_sha256"),
    )


def op11_vector_codes(spark, sf_dir) -> DataFrame:
    """Codes of all embeddings."""
    return codes(table(spark, sf_dir, "embeddings"))


_ASSIGN = """
{out} AS (
  SELECT r, part, entry, d FROM (
    SELECT x.r, x.part, b.entry, sum((x.c - b.c) * (x.c - b.c))::BIGINT AS d,
      row_number() OVER (PARTITION BY x.r, x.part ORDER BY sum((x.c - b.c) * (x.c - b.c)), b.entry) AS place
    FROM cells x JOIN {books} b ON x.part = b.part AND x.pos = b.pos
    GROUP BY x.r, x.part, b.entry)
  WHERE place = 1)"""

_MOVE = """
{out} AS (
  SELECT b.part, b.entry, b.pos, coalesce((s.total - ((s.total % s.n) + s.n) % s.n) // s.n, b.c)::BIGINT AS c
  FROM {books} b LEFT JOIN (
    SELECT a.part, a.entry, x.pos, sum(x.c) AS total, count(*) AS n
    FROM {assigned} a JOIN cells x ON a.r = x.r AND a.part = x.part GROUP BY 1, 2, 3) s
  ON b.part = s.part AND b.entry = s.entry AND b.pos = s.pos)"""

OP11_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS (
  SELECT r, (i - 1) // (len(v) // {PARTS}) AS part, (i - 1) % (len(v) // {PARTS}) AS pos, v[i] AS c
  FROM kept, unnest(range(1, len(v) + 1)) AS u(i)),
b0 AS (SELECT part, r - 1 AS entry, pos, c FROM cells WHERE r <= {ENTRIES}),
{_ASSIGN.format(out="a1", books="b0")}, {_MOVE.format(out="b1", books="b0", assigned="a1")},
{_ASSIGN.format(out="a2", books="b1")}, {_MOVE.format(out="b2", books="b1", assigned="a2")},
{_ASSIGN.format(out="a3", books="b2")},
coded AS (
  SELECT k.vec_id, k.label, string_agg(printf('%02x', a.entry), '' ORDER BY a.part) AS code, sum(a.d)::BIGINT AS error
  FROM a3 a JOIN kept k USING (r) GROUP BY k.r, k.vec_id, k.label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, pos)) FROM b2) AS codebooks_sha256
FROM coded
"""
