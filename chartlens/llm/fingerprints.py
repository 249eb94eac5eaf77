"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A paragraph (a line) is hashed to a wide vector and a document's fingerprint is
the sum of its paragraphs' vectors, so it does not depend on their order, and a
paragraph is inserted or deleted by adding or subtracting its vector. The
vector has two parts:

* equality: 16 lanes of BLAKE2b output, summed modulo 2^64 (1,024 bits);
* likeness: 256 lanes summed modulo 2^32, in which every 8-byte window of the
  paragraph, padded with 7 zero bytes at either end, adds +1 or -1 to one lane
  (a count sketch). The dot product of two documents' lanes estimates that of
  their window counts, so their cosine tells how alike the documents are, to
  about 1/sqrt(256) for unrelated texts.

Bellare and Micciancio, "A New Paradigm for Collision-Free Hashing" (1997), is
the source of the additive hash, Charikar et al. (2002) of the count sketch.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, ship, table
from .text import mix

LANES = 16
BUCKETS = 256
WINDOW = 8
BATCH_BYTES = 1 << 19
RANGES_PER_PARTITION = 4

_U = np.uint64
_PAD = b"\0" * (WINDOW - 1)


def paragraphs(text: str) -> list[bytes]:
    """A text's paragraphs; an empty text has none."""
    return text.encode().split(b"\n") if text else []


def equality_lanes(parts: list[bytes]) -> np.ndarray:
    """Sum of the paragraphs' equality vectors modulo 2^64."""
    if not parts:
        return np.zeros(LANES, _U)
    hashes = b"".join(
        hashlib.blake2b(p, digest_size=64).digest() + hashlib.blake2b(p, digest_size=64, salt=b"wide").digest() for p in parts
    )
    return np.frombuffer(hashes, "<u8").reshape(-1, LANES).sum(axis=0, dtype=_U)


def _signed_lanes(raw: bytes, first: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Lane and sign of the ``count`` windows of ``raw`` that start from ``first`` on; all-zero windows have sign 0."""
    part = raw[first : first + count + WINDOW - 1]
    part += b"\0" * (count + 2 * WINDOW - len(part))
    x = np.empty(count, _U)
    for k in range(min(WINDOW, count)):
        x[k::WINDOW] = np.frombuffer(part, "<u8", len(range(k, count, WINDOW)), k)
    h = mix(x)
    sign = np.where(h & _U(1), 1.0, -1.0)
    sign[x == 0] = 0
    return (h >> _U(56)).astype(np.int64), sign


def likeness_lanes(documents: list[list[bytes]]) -> np.ndarray:
    """The low 16 bits of ``wide_lanes``."""
    return wide_lanes(documents).astype(np.uint16)


def wide_lanes(documents: list[list[bytes]]) -> np.ndarray:
    """Rows of likeness lanes modulo 2^32, one for each document's paragraphs."""
    rows = [_PAD + _PAD.join(p for p in parts if p) + _PAD if any(parts) else b"" for parts in documents]
    out = np.zeros((len(rows), BUCKETS), np.int64)
    for a, b in by_bytes([len(r) for r in rows], BATCH_BYTES):
        raw = b"".join(rows[a:b])  # rows meet in zero bytes only
        owner = np.repeat(np.arange(b - a) * BUCKETS, [len(r) for r in rows[a:b]])
        for first in range(0, len(raw), 2 * BATCH_BYTES):  # more than one round: one long row
            lane, sign = _signed_lanes(raw, first, min(2 * BATCH_BYTES, len(raw) - first))
            lane += owner[first : first + len(lane)]
            out[a:b] += np.bincount(lane, sign, (b - a) * BUCKETS).astype(np.int64).reshape(-1, BUCKETS)
    return out.astype(np.uint32)


def fingerprints(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Equality and likeness lanes of each text."""
    parts = [paragraphs(t) for t in texts]
    equal = np.array([equality_lanes(p) for p in parts], _U).reshape(-1, LANES)
    return equal, wide_lanes(parts)


def encoded(equal: np.ndarray, like: np.ndarray) -> list[str]:
    """Fingerprints as strings (base64 of all lanes, little-endian)."""
    return [base64.b64encode(e.astype("<u8").tobytes() + v.astype("<u4").tobytes()).decode() for e, v in zip(equal, like)]


def decoded(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    raw = base64.b64decode(fingerprint)
    return np.frombuffer(raw, "<u8", LANES), np.frombuffer(raw, "<u4", BUCKETS, 8 * LANES)


def insert(fingerprint: str, paragraph: str, times: int = 1) -> str:
    """The fingerprint after ``paragraph`` (one line) is inserted; -1 deletes it."""
    equal, like = decoded(fingerprint)
    p = paragraph.encode()
    more_equal, more_like = equality_lanes([p]), wide_lanes([[p]])[0]
    if times < 0:
        more_equal, more_like = ~more_equal + _U(1), (-more_like.astype(np.int64)).astype(np.uint32)
    for _ in range(abs(times)):
        equal, like = equal + more_equal, like + more_like
    return encoded(equal[None], like[None])[0]


def likeness(equal_a, like_a, equal_b, like_b) -> np.ndarray:
    """Cosine of the window counts, 0 to 1, row by row; 1 where the fingerprints are equal."""
    a, b = like_a.astype(np.int32).astype(float), like_b.astype(np.int32).astype(float)
    norm = np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))
    cosine = np.divide((a * b).sum(axis=1), norm, out=np.zeros(len(a)), where=norm > 0)
    same = (equal_a == equal_b).all(axis=1) & (like_a == like_b).all(axis=1)
    return np.where(same, 1.0, np.clip(cosine, 0, 1))


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, fingerprint. Null texts count as empty; no shuffle."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            prints = [x for a, b in by_bytes([len(t) for t in texts], BATCH_BYTES) for x in encoded(*fingerprints(texts[a:b]))]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_chars": [len(t) for t in texts], "fingerprint": prints})

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(run, f"doc_id {kind}, n_chars long, fingerprint string")


def _edited(batches) -> Iterator[pd.DataFrame]:
    """Rows of whole ranges, each in descending order and with its successor at its end."""
    held = None  # the last row: its successor comes with the next one
    for batch in batches:
        names = list(batch["part"]), list(batch["id"]), [t if isinstance(t, str) else "" for t in batch["text"]], list(batch["guest"])
        rows = list(zip(*names))
        for a, b in by_bytes([len(r[2]) for r in rows], BATCH_BYTES):
            chunk = rows[a:b]
            equal, like = fingerprints([r[2] for r in chunk])
            if held:
                chunk = [held[0], *chunk]
                equal, like = np.vstack([held[1], equal]), np.vstack([held[2], like])
            held = chunk[-1], equal[-1], like[-1]
            at = [i for i in range(len(chunk) - 1) if not chunk[i][3] and chunk[i][0] == chunk[i + 1][0]]
            if not at:
                continue
            new, digests = [], []
            for i in at:
                mine, nxt = chunk[i][2], chunk[i + 1][2]
                cut = len(mine) // 3
                new.append(mine[: len(mine) - cut] + nxt[:cut])
                digests.append(hashlib.sha256(new[-1].encode()).hexdigest())
            new_equal, new_like = fingerprints(new)
            i, j = np.array(at), np.array(at) + 1
            yield pd.DataFrame(
                {
                    "doc_id": [chunk[k][1] for k in at],
                    "n_chars": [len(chunk[k][2]) for k in at],
                    "edited_sha256": digests,
                    "fingerprint": encoded(equal[i], like[i]),
                    "edited_fingerprint": encoded(new_equal, new_like),
                    "near_edited": likeness(equal[i], like[i], new_equal, new_like),
                    "near_next": likeness(equal[i], like[i], equal[j], like[j]),
                }
            )


def _range_of(value: Column, bounds: list[int]) -> Column:
    """Number of a value's range, counted from the top; null values come last.

    Two steps (coarse bounds, then those of one stretch), so a row is compared
    with about the square root of the number of bounds.
    """
    step = max(1, int(len(bounds) ** 0.5))
    stretches = [bounds[i : i + step] for i in range(0, len(bounds), step)] or [[]]

    def above(array: Column) -> Column:
        return F.size(F.filter(array, lambda b: b <= value))

    def literal(values: list[int]) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast("array<bigint>")

    coarse = F.greatest(above(literal([s[0] for s in stretches if s])), F.lit(1))
    inner = F.element_at(F.array(*[literal(s) for s in stretches]), coarse)
    number = F.lit(len(bounds)) - ((coarse - 1) * step + above(inner))
    return F.when(value.isNull(), F.lit(len(bounds) + 1)).otherwise(number).cast("int")


def edit_likeness(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: its fingerprint, that of its edited text, and likeness to that and to the next row.

    The edited text is the text with its last floor(n_chars / 3) code points
    replaced by the first as many (or all) of the next row's text, in
    descending ``doc_id``; after the last row comes the first. Null texts
    count as empty. Rows that repeat a doc_id follow each other by their
    texts, a null doc_id comes last, and a lone row is its own successor.

    The rows are dealt once into ranges of doc_id with about as many rows each
    (``percentile_approx``); each range's first row is also sent to the range
    before it, as the successor of its last row. Tasks stream sorted ranges and
    hold one row.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    n = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    points = [i / n for i in range(1, n)]
    bounds = sorted(set(rows.agg(F.percentile_approx("id", points, 20 * n)).first()[0] or []))
    dealt = rows.withColumn("part", _range_of(F.col("id"), bounds))

    # each range's first id, and the range before it (the last one for the first): one row per range
    firsts = dealt.groupBy("part").agg(F.max("id").alias("first")).orderBy("part").collect()
    heads = [(r["part"], r["first"], firsts[i - 1]["part"]) for i, r in enumerate(firsts)]
    heads = spark.createDataFrame(heads, "part int, first long, before int")
    dealt = dealt.join(F.broadcast(heads), "part")
    own = F.struct(F.col("part").alias("to"), F.lit(False).alias("guest"))
    ahead = F.struct(F.col("before").alias("to"), F.lit(True).alias("guest"))
    places = F.when(F.col("id").eqNullSafe(F.col("first")), F.array(own, ahead)).otherwise(F.array(own))
    sent = dealt.select("id", "text", F.xxhash64("text").alias("h"), F.explode(places).alias("p"))
    sent = sent.select(F.col("p.to").alias("part"), "id", "text", "h", "p.guest").repartition("part")
    sent = sent.sortWithinPartitions("part", "guest", F.desc_nulls_last("id"), F.desc("h"))
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return sent.select("part", "id", "text", "guest").mapInPandas(_edited, schema)


def op1_document_fingerprints(spark, sf_dir) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return edit_likeness(table(spark, sf_dir, "documents"))
