"""Toxicity from the nearest labelled examples, by exact TF-IDF cosine over a block-max index.

Terms are words: runs of digits, letters a-z and characters beyond ASCII of the
lower-cased text; an ideograph, kana or Hangul syllable is a word of its own. All terms of the
labelled examples are indexed; terms that no example holds share nothing with
one and do not count. Examples and texts are TF-IDF vectors over these terms, with
document frequencies of the whole corpus; a term that toxic examples have more
often than chance allows weighs more, by its chi-squared beyond that of chance. The
cosines here are those of these weighted vectors.

Examples that resemble each other are in one block of ``BLOCK``. The index keeps, for every
term and block, the term's largest weight there (S. Ding and T. Suel, "Faster Top-k Document Retrieval Using
Block-Max Indexes", 2011), so a text's terms bound its cosine with all of a
block's examples at once. A text's blocks are scored in order of their bounds until no
bound reaches the cosine of its k-th example so far; the others are never read. Rare terms
have postings by (term, block), frequent ones a dense matrix per block. The bounds and sums
of 32-bit numbers leave a margin, and what may be among the k nearest is summed again in 64 bits.

The neighbours' votes are weighted by their squared cosines, and the share of toxic votes is mapped to a
probability by isotonic regression on votes of each example's own neighbours,
weighted to the class sizes of all labels.

The examples are a bounded sample of labelled rows: the ``EXAMPLES`` first of
each class in md5 order. Everything else covers all rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, fields
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, hashed, releasing, ship, small_batches, table, written
from .text import mix, word_hashes

EXAMPLES = 2048  # of each class at most
NEIGHBOURS = 8
BLOCK = 64  # examples
HEAD = 4096  # most frequent terms at most, as dense matrices
FAINT = 0.02  # weight of the prior in a vote
OFTEN = 0.05  # share of the examples that such a term is in
TOGETHER = 128  # texts scored at once
MARGIN = 1e-5  # of 32-bit bounds and sums; cosines are at most 1
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
BATCH_BYTES = 1 << 19
EVIDENCE = 3  # examples returned with a score
REMEMBERED = 20_000  # results

_U = np.uint64
_APART = re.compile("([\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uac00-\ud7af])")
_WORDS = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_NONE = np.empty(0, np.int64)


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Terms of all texts as 64-bit numbers, and the text that each belongs to."""
    raws = [_APART.sub(r" \1 ", t.lower()).encode() for t in texts]
    starts, x = word_hashes(b" ".join(raws).translate(_WORDS))
    ends = np.cumsum(np.array([len(r) + 1 for r in raws], np.int64))
    return x, np.searchsorted(ends, starts, side="right")


class Terms:
    """Counts of a fixed vocabulary in texts."""

    def __init__(self, terms: np.ndarray):
        self.terms = np.sort(terms.astype(_U))
        self.bits = max(10, (8 * len(self.terms)).bit_length())
        slot, number = self._slot(self.terms), np.arange(len(self.terms), dtype=np.int32)
        self.at = np.full(1 << self.bits, -1, np.int32)  # term of each slot; -1: none, -2: several
        self.at[slot] = number
        self.at[slot[self.at[slot] != number]] = -2

    def __reduce__(self):
        return Terms, (self.terms,)

    def _slot(self, x: np.ndarray) -> np.ndarray:
        return ((x * _U(0x9E3779B97F4A7C15)) >> _U(64 - self.bits)).astype(np.int64)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Numbers of terms, -1 for others."""
        at = self.at[self._slot(x)]
        several = np.flatnonzero(at == -2)
        at[several] = np.minimum(np.searchsorted(self.terms, x[several]), len(self.terms) - 1)
        at[(at >= 0) & (self.terms[at] != x)] = -1
        return at

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, term number and count, sorted by text and term."""
        owners, numbers = [], []
        if len(self.terms):
            for a, b in by_bytes([len(t) for t in texts], BATCH_BYTES):
                x, owner = words(texts[a:b])
                at = self.find(x)
                hit = at >= 0
                owners.append(owner[hit] + a)
                numbers.append(at[hit].astype(np.int64))
        key = np.concatenate(owners or [np.empty(0, np.int64)]) * max(len(self.terms), 1)
        key += np.concatenate(numbers or [np.empty(0, np.int64)])
        key, count = np.unique(key, return_counts=True)
        owner, number = np.divmod(key, max(len(self.terms), 1))
        return owner, number, count


@dataclass
class Model:
    """Index of the examples, and the map from votes to probabilities."""

    terms: Terms
    idf: np.ndarray  # raised for terms of toxic examples
    ids: np.ndarray  # examples' doc_ids
    toxic: np.ndarray
    size: np.ndarray  # terms of each example
    number: np.ndarray  # their numbers, example by example
    count: np.ndarray
    steps: np.ndarray  # votes, rising
    levels: np.ndarray  # probabilities at these votes
    silent: float  # probability without any shared term
    prior: float  # share of toxic labels

    def __post_init__(self) -> None:
        #: results by vector, for copies
        self.known: dict[bytes, tuple[float, np.ndarray, np.ndarray]] = {}

    def __reduce__(self):
        return Model, tuple(getattr(self, f.name) for f in fields(self))  # the index is made where it is used

    @cached_property
    def index(self) -> Index:
        return Index(self)

    def scores(self, texts: list[str]) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """Probability, nearest examples (positions) and cosines of each text."""
        out: list = []
        for a, b in by_bytes([len(t) for t in texts], BATCH_BYTES):
            vectors = self.vectors(texts[a:b])
            keys = [hashlib.blake2b(x.tobytes() + w.tobytes(), digest_size=16).digest() for x, w in vectors]
            found = {k: self.known[k] for k in keys if k in self.known}
            new = list({k: i for i, k in enumerate(keys) if k not in found}.items())
            for c in range(0, len(new), TOGETHER):
                some = new[c : c + TOGETHER]
                for (k, _), (at, cosine) in zip(some, self.neighbours([vectors[i] for _, i in some])):
                    p = self.probability(self.vote(at, cosine)) if len(at) else self.silent
                    found[k] = (p, at[:EVIDENCE], cosine[:EVIDENCE])
            for k, _ in new[: max(REMEMBERED - len(self.known), 0)]:
                self.known[k] = found[k]
            out += [found[k] for k in keys]
        return out

    def vectors(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Term numbers and TF-IDF weights of unit length of each text."""
        owner, number, count = self.terms.counts(texts)
        return unit_vectors(owner, number, count, self.idf, len(texts))

    def neighbours(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int = NEIGHBOURS, but: list[int] | None = None):
        """The k nearest examples (positions) of each vector and their cosines, exactly; ``but`` are left out.

        Of equal cosines (to 12 places) the first positions come first.
        """
        return self.index.neighbours(vectors, k, but)

    def nearest(self, number: np.ndarray, w: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """``neighbours`` of one vector."""
        return self.neighbours([(number, w)], k)[0]

    def own_votes(self, a: int, b: int) -> list[float | None]:
        """Votes of the other examples on those from ``a`` to ``b``; None without a shared term."""
        start = np.concatenate([[0], np.cumsum(self.size)])
        part = slice(start[a], start[b])
        own = unit_vectors(np.repeat(np.arange(b - a), self.size[a:b]), self.number[part], self.count[part], self.idf, b - a)
        return [self.vote(at, s) if len(at) else None for at, s in self.neighbours(own, but=list(range(a, b)))]

    def vote(self, at: np.ndarray, cosine: np.ndarray) -> float:
        """Share of toxic votes, weighted by the squared cosine; faint neighbours give way to the prior."""
        weight = cosine * cosine
        return float(((weight * self.toxic[at]).sum() + FAINT * self.prior) / (weight.sum() + FAINT))

    def probability(self, vote: float) -> float:
        return float(np.interp(vote, self.steps, self.levels))


class Index:
    """Examples in blocks of similar ones, with each term's largest weight in each block."""

    def __init__(self, model: Model):
        n, terms = len(model.ids), len(model.terms.terms)
        owner = np.repeat(np.arange(n, dtype=np.int32), model.size)
        self.number = model.number
        self.weight = unit_weights(owner, model.number, model.count, model.idf, n).astype(np.float32)
        self.start = np.concatenate([[0], np.cumsum(model.size)])
        self.order = similar(owner, model.number, self.weight, n, BLOCK)  # example at each place
        place = np.empty(n, np.int64)
        place[self.order] = np.arange(n)
        self.n, self.blocks = n, -(-n // BLOCK)
        self.read = 0  # blocks read so far, of ...
        self.asked = 0

        often = np.bincount(model.number, minlength=terms)
        frequent = np.flatnonzero(often >= OFTEN * n)
        frequent = np.sort(frequent[np.argsort(-often[frequent], kind="stable")[:HEAD]])
        self.column = np.full(terms, -1, np.int32)  # of a frequent term
        self.column[frequent] = np.arange(len(frequent))
        at, column = place[owner], self.column[model.number]
        dense = column >= 0
        self.head = np.zeros((self.blocks, len(frequent), BLOCK), np.float32)
        self.head[at[dense] // BLOCK, column[dense], at[dense] % BLOCK] = self.weight[dense]
        self.head_most = np.ascontiguousarray(self.head.max(axis=2).T)  # terms x blocks

        # the other terms: cells of a term and a block, postings (place, weight) of each cell
        key = model.number[~dense].astype(np.int64) * n + at[~dense]
        turn = np.argsort(key)
        term, self.place = np.divmod(key[turn], n)
        self.posting = self.weight[~dense][turn]
        cell = term * self.blocks + self.place // BLOCK
        first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.empty(0, np.int64)
        self.cell_most = np.maximum.reduceat(self.posting, first) if len(first) else np.empty(0, np.float32)
        self.cell_block = cell[first] % self.blocks
        self.cell_start = np.append(first, len(cell))
        self.cells = np.searchsorted(cell[first] // self.blocks, np.arange(terms + 1))  # first cell of each term

    def neighbours(self, vectors, k: int, but: list[int] | None):
        """See ``Model.neighbours``."""
        rows, out = len(vectors), []
        query = np.zeros((rows, self.head.shape[1]), np.float32)
        bound, rare = np.empty((rows, self.blocks)), []
        for r, (number, w) in enumerate(vectors):
            column = self.column[number]
            query[r, column[column >= 0]] = w[column >= 0]
            number, w = number[column < 0], w[column < 0]
            length = self.cells[number + 1] - self.cells[number]
            cells = ranges(self.cells[number], length)
            weight, block = np.repeat(w, length), self.cell_block[cells]
            bound[r] = np.bincount(block, weight * self.cell_most[cells], self.blocks)
            rare.append((cells, weight, block))
        bound += query @ self.head_most
        possible = bound > 0
        bound += MARGIN
        by_bound = np.argsort(-bound, axis=1, kind="stable")
        cosine = np.zeros((rows, self.blocks * BLOCK), np.float32)
        done, least = np.zeros((rows, self.blocks), bool), np.zeros(rows)
        left_out = None
        if but is not None:
            place = np.empty(self.n, np.int64)
            place[self.order] = np.arange(self.n)
            left_out = place[but]
        for some in (2, 4, self.blocks):  # blocks of each text at once, the best bounds first
            wanted = possible & (bound >= least[:, None]) & ~done
            first = np.take_along_axis(wanted, by_bound, 1)
            first &= np.cumsum(first, axis=1) <= some
            np.put_along_axis(wanted, by_bound, first, 1)
            for b in np.flatnonzero(wanted.any(axis=0)):
                r = np.flatnonzero(wanted[:, b])
                cosine[r, b * BLOCK : (b + 1) * BLOCK] = query[r] @ self.head[b]
            for r in np.flatnonzero(wanted.any(axis=1)):
                cells, weight, block = rare[r]
                chosen = wanted[r][block]
                cells, weight = cells[chosen], weight[chosen]
                length = self.cell_start[cells + 1] - self.cell_start[cells]
                postings = ranges(self.cell_start[cells], length)
                cosine[r] += np.bincount(
                    self.place[postings], np.repeat(weight, length) * self.posting[postings], cosine.shape[1]
                )
            if left_out is not None:
                cosine[np.arange(rows), left_out] = 0
            done |= wanted
            if k < cosine.shape[1]:
                least = -np.partition(-cosine, k - 1, axis=1)[:, k - 1] - MARGIN
        self.read, self.asked = self.read + int(done.sum()), self.asked + done.size
        scattered = np.zeros(len(self.column))
        for r, (number, w) in enumerate(vectors):
            near = np.flatnonzero((cosine[r] >= least[r] - MARGIN) & (cosine[r] > 0))
            near = self.order[near]
            scattered[number] = w
            length = self.start[near + 1] - self.start[near]
            at = ranges(self.start[near], length)
            owner = np.repeat(np.arange(len(near)), length)
            exact = np.round(np.bincount(owner, scattered[self.number[at]] * self.weight[at], len(near)), 12)
            scattered[number] = 0
            turn = np.lexsort((near, -exact))[:k]
            turn = turn[exact[turn] > 0]
            out.append((near[turn], exact[turn]))
        return out


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers from each start on, ``length`` of them, one range after the other."""
    out = np.repeat(start - np.cumsum(length) + length, length)
    out += np.arange(len(out))
    return out


def similar(owner, number, weight, n: int, size: int) -> np.ndarray:
    """An order of the ``n`` examples in which each ``size`` on end resemble each other.

    They are halved again and again along the main axis of a random projection of their vectors.
    """
    width, hashed_number = 128, mix(np.asarray(number).astype(np.uint64), 5)
    column = (hashed_number & np.uint64(width - 1)).astype(np.int64)
    sign = np.where(hashed_number >> np.uint64(40) & np.uint64(1), weight, -weight)
    x = np.bincount(owner.astype(np.int64) * width + column, sign, n * width).reshape(n, width)

    def halves(rows: np.ndarray) -> list[np.ndarray]:
        if len(rows) <= size:
            return [rows]
        away = x[rows] - x[rows].mean(axis=0)
        axis = np.linalg.eigh(away.T @ away)[1][:, -1]
        rows = rows[np.argsort(away @ axis, kind="stable")]
        cut = (-(-len(rows) // size) + 1) // 2 * size
        return halves(rows[:cut]) + halves(rows[cut:])

    return np.concatenate(halves(np.arange(n)))


def unit_weights(owner, number, count, idf: np.ndarray, rows: int) -> np.ndarray:
    """TF-IDF weights, of unit length for each of ``rows`` texts."""
    w = np.log(np.asarray(count, float))
    w += 1
    w *= idf[number]
    w /= np.sqrt(np.bincount(owner, w * w, rows))[owner]
    return w


def unit_vectors(owner, number, count, idf: np.ndarray, rows: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Term numbers and weights of each text, from counts sorted by text."""
    w = unit_weights(owner, number, count, idf, rows)
    cuts = np.searchsorted(owner, np.arange(rows + 1))
    return [(number[a:b], w[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Rising levels of y over x (pool adjacent violators), each shrunk to ``prior`` by one row's weight."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # weight, weighted y, lowest x, highest x
    for i in order:
        pools.append([w[i], w[i] * y[i], x[i], x[i]])
        while len(pools) > 1 and (
            pools[-2][3] == pools[-1][2] or pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]
        ):
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    one = float(np.mean(w))
    steps, levels = [], []
    for weight, total, low, high in pools:
        level = (total + one * prior) / (weight + one)
        steps += [low, high]
        levels += [level, level]
    return np.array(steps), np.maximum.accumulate(np.array(levels))


def is_held_out(doc_id: Column, folds: int = FOLDS, held_out: int = HELD_OUT) -> Column:
    """Whether crc32 of the id's text leaves the remainder ``held_out`` (null: the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == held_out


def _texts(column) -> list[str]:
    return [t if isinstance(t, str) else "" for t in column]


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model of ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic); None without rows of both classes.

    Labels of rows held out by ``is_held_out`` are not read. Rows of ``labels``
    that repeat a doc_id count once, as toxic if one of them is; null labels are no labels.
    """
    spark = docs.sparkSession
    ship(spark)
    small_batches(spark)
    rows = docs.select(F.col("doc_id"), F.col("text"))
    known = labels.where(~is_held_out(F.col("doc_id")) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.where("toxic in (0, 1)")
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows
    if len(sizes) < 2:
        return None
    sample = [known.where(F.col("toxic") == c).orderBy(hashed(F.col("doc_id")), "doc_id").limit(EXAMPLES) for c in (0, 1)]
    sample = spark.createDataFrame(sample[0].union(sample[1]).toPandas(), "doc_id long, toxic int")  # at most 2 * EXAMPLES ids
    examples = rows.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic")
    first = F.min(F.struct(F.md5("text"), "text"))  # of several texts of one id always the same
    examples = written(examples.agg(first["text"].alias("text")), "examples")
    examples = examples.repartition("doc_id")

    def present(batches) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, toxic = _texts(batch["text"]), batch["toxic"].to_numpy()
            for a, b in by_bytes([len(t) for t in texts], BATCH_BYTES):
                x, owner = words(texts[a:b])
                pair = np.unique(np.rec.fromarrays([owner, x], names="o,x"))
                yield pd.DataFrame({"term": pair["x"].astype(np.int64), "toxic": toxic[a:b][pair["o"]].astype(np.int64)})

    n = {r["toxic"]: r["count"] for r in examples.groupBy("toxic").count().collect()}  # two rows
    if len(n) < 2:
        return None
    found = examples.select("text", "toxic").mapInPandas(releasing(present), "term long, toxic long").groupBy("term")
    found = found.agg(F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("b"))
    found = found.toArrow().to_pandas()  # the terms of at most 2 * EXAMPLES texts
    found = found.iloc[np.argsort(found["term"].to_numpy().astype(_U))]  # in the order of ``Terms``
    terms = Terms(found["term"].to_numpy().astype(_U))
    # terms that toxic examples have more often than chance: chi-squared beyond 2 ln(number of terms)
    n1, n0 = float(n[1]), float(n[0])
    a, b = found["a"].to_numpy(), found["b"].to_numpy()
    c, d = n1 - a, n0 - b
    chi = (n1 + n0) * (a * d - b * c) ** 2 / ((a + b) * np.maximum(c + d, 0.5) * n1 * n0)
    lift = 1 + np.where(a / n1 > b / n0, np.maximum(chi - 2 * np.log(max(len(found), 2)), 0), 0)

    def frequencies(batches) -> Iterator[pd.DataFrame]:
        total, rows_seen = np.zeros(len(terms.terms), np.int64), 0
        for batch in batches:
            texts = _texts(batch["text"])
            for a, b in by_bytes([len(t) for t in texts], BATCH_BYTES):
                total += np.bincount(terms.counts(texts[a:b])[1], minlength=len(total))
            rows_seen += len(batch)
        number = np.flatnonzero(total)
        yield pd.DataFrame({"number": [-1, *number], "n": [rows_seen, *total[number]]})

    frequency = rows.select("text").mapInPandas(releasing(frequencies), "number long, n long")
    frequency = frequency.groupBy("number").agg(F.sum("n").alias("n")).toArrow().to_pandas()  # one row per term
    corpus = int(frequency.loc[frequency["number"] < 0, "n"].sum())
    frequency = frequency[frequency["number"] >= 0]
    df = np.zeros(len(terms.terms))
    df[frequency["number"].to_numpy()] = frequency["n"].to_numpy()
    idf = (np.log((corpus + 1) / (df + 1)) + 1) * lift

    def vector(batches) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = _texts(batch["text"])
            for a, b in by_bytes([len(t) for t in texts], BATCH_BYTES):
                owner, number, count = terms.counts(texts[a:b])
                cuts = np.searchsorted(owner, np.arange(b - a + 1))
                spans = list(zip(cuts[:-1], cuts[1:]))
                out = batch[["doc_id", "toxic"]].iloc[a:b].copy()
                out["number"] = [number[i:j].astype("<i4").tobytes() for i, j in spans]
                out["count"] = [count[i:j].astype("<i4").tobytes() for i, j in spans]
                yield out

    # at most 2 * EXAMPLES rows
    kept = examples.mapInPandas(releasing(vector), "doc_id long, toxic int, number binary, count binary").toArrow()
    kept = kept.sort_by([("toxic", "ascending"), ("doc_id", "ascending")])
    ids, toxic = kept["doc_id"].to_numpy(), kept["toxic"].to_numpy().astype(float)
    number, count = (np.frombuffer(b"".join(x.as_py() for x in kept[c]), "<i4") for c in ("number", "count"))
    count = count.astype(np.min_scalar_type(count.max(initial=0)))
    size = np.array([len(x.as_py()) // 4 for x in kept["number"]])
    del kept
    prior = sizes[1] / (sizes[0] + sizes[1])
    model = Model(terms, idf, ids, toxic, size, number, count, np.zeros(1), np.zeros(1), 0.0, prior)

    # each example's own neighbours; classes weigh as in all labels
    scale = np.where(toxic == 1, sizes[1] / n[1], sizes[0] / n[0])
    shipped = spark.sparkContext.broadcast(model)

    def own_votes(batches) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in batch["id"]:
                b = min(a + TOGETHER, len(ids))
                yield pd.DataFrame({"place": np.arange(a, b), "vote": pd.Series(shipped.value.own_votes(a, b), dtype=float)})

    near = spark.range(0, len(ids), TOGETHER).mapInPandas(releasing(own_votes), "place long, vote double").toArrow().to_pandas()
    shipped.unpersist()
    votes = near.sort_values("place")["vote"].to_numpy()
    heard = ~np.isnan(votes)
    if heard.any():
        model.steps, model.levels = isotonic(votes[heard], toxic[heard], scale[heard], prior)
    else:
        model.levels = np.array([prior])
    quiet = ~heard
    one = float(scale.mean())
    model.silent = float(((scale * toxic)[quiet].sum() + one * prior) / (scale[quiet].sum() + one))
    return model


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1), predicted, evidence (the three nearest examples).

    Null and empty texts, and texts that share no term with any example, get the
    rate of toxic labels among such examples. Without labels of both classes
    every score is 0. One row per input row; other columns are not read.
    """
    model = fit(docs, labels)
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    del model
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "text")

    def run(batches) -> Iterator[pd.DataFrame]:
        model = shipped.value
        for batch in batches:
            texts = _texts(batch["text"])
            found = model.scores(texts) if model is not None else [(0.0, _NONE, _NONE)] * len(texts)
            out = batch[["doc_id", "held_out"]].copy()
            out["score"] = [f[0] for f in found]
            out["near"] = [model.ids[f[1]] if len(f[1]) else _NONE for f in found]
            out["cosine"] = [f[2] for f in found]
            out["toxic"] = [model.toxic[f[1]] if len(f[1]) else _NONE for f in found]
            yield out

    out = rows.mapInPandas(
        releasing(run), f"doc_id {kind}, held_out boolean, score double, near array<long>, cosine array<double>, toxic array<double>"
    )
    evidence = F.arrays_zip(F.col("near").alias("doc_id"), "cosine", F.col("toxic").cast("array<int>").alias("toxic"))
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return out.select("doc_id", "held_out", "score", predicted, evidence.alias("evidence"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; columns and other rows as given."""
    model = fit(docs, labels)
    if model is None:
        return docs
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    del model
    names = docs.columns

    def run(batches) -> Iterator[pd.DataFrame]:
        model = shipped.value
        for batch in batches:
            score = np.array([f[0] for f in model.scores(_texts(batch["text"]))])
            yield batch[names][score < threshold]

    return docs.mapInPandas(releasing(run), docs.schema)


def op9_toxicity(spark, sf_dir) -> DataFrame:
    """Toxicity of all documents, learnt from ``labels.toxic``."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
