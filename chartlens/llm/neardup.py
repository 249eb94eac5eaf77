"""Near-duplicate groups: SetSketch registers, banded, judged jointly, then confirmed.

Method (O. Ertl, "SetSketch: Filling the Gap between MinHash and HyperLogLog",
VLDB 2021). A document is the set of its distinct k-word shingles. Register i
keeps the largest ``floor(1 - log_b(E_i(x)))`` over the set, ``E_i(x)`` an
exponential value hashed from the shingle x, cut to [0, 65535]: registers of a
union are the element-wise maxima, and two sets agree on a register with a
probability not below their Jaccard similarity J. Bands of register values give
candidates, the counts of larger, smaller and equal registers give the maximum
likelihood estimate of J for the known set sizes, and what passes (with a
margin of several standard errors) is confirmed on the full sets.

With the defaults (128 registers, 32 bands of 4) a pair of J = 0.8 shares no
band with probability (1 - 0.8^4)^32 = 5e-8.

Large groups. Texts with equal sets are one class before anything is compared.
First each class is compared with the smallest class of each of its buckets;
connected classes are then one component. What is left are buckets with classes
of different components: pairs of different components in them are estimated
block against block inside tasks, and the rows of pairs that pass are dealt
again, with their sets, and confirmed there; a task returns only links that join
two components. So every pair that shares a bucket is either in one component
already or judged, and no list of pairs of a large group is ever written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, releasing, ship, small_batches, whole_groups, written
from .text import mix, shingles

REGISTERS = 128
ROWS = 4  # registers in a band
BASE = 1.02
RATE = 20.0
WORDS = 5
THRESHOLD = 80  # per cent of the union
MARGIN = 0.2  # below the threshold; over five standard errors of the estimate
BLOCK = 1 << 18  # shingles of a bucket that a block holds
PAIRS = 1 << 18  # looked at together
JUDGED = 1 << 14  # estimated together
BLOCK_KEYS = ["band", "bucket", "lo", "hi"]

_U = np.uint64
_SEEDS = mix(np.arange(1, REGISTERS + 1, dtype=_U), 0x5E75)
_ODD = mix(np.arange(1, REGISTERS + 1, dtype=_U), 0x0DD) | _U(1)


def registers(x: np.ndarray) -> np.ndarray:
    """SetSketch registers of a non-empty set of 64-bit hashes."""
    low = np.empty(REGISTERS, _U)
    for i in range(0, len(x), 4096):
        part = ((x[i : i + 4096, None] ^ _SEEDS) * _ODD).min(axis=0)
        low = np.minimum(low, part) if i else part
    u = (low >> _U(11)).astype(np.float64) + 0.5
    spaced = -np.log1p(-u * 2.0**-53) / RATE  # the smallest exponential value
    return np.clip(np.floor(1 - np.log(spaced) / np.log(BASE)), 0, 65535).astype(np.uint16)


def likelihood_slope(j, n_a, n_b, more, less):
    """Derivative in J of the joint log-likelihood of the register comparison."""
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    c, log_b = (BASE - 1) / BASE, np.log(BASE)

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * c) / log_b

    def dp(x):
        return c / (1 - np.clip(x, 0, 1) * c) / log_b

    a, b = u - v * j, v - u * j
    up, down = p(a), p(b)
    same = REGISTERS - more - less
    tiny = 1e-12
    return (
        -more * dp(a) * v / np.maximum(up, tiny)
        - less * dp(b) * u / np.maximum(down, tiny)
        + same * (dp(a) * v + dp(b) * u) / np.maximum(1 - up - down, tiny)
    )


def estimate(n_a, n_b, more, less) -> np.ndarray:
    """Maximum likelihood estimate of J (the log-likelihood is concave in J)."""
    n_a, n_b, more, less = (np.asarray(x, float) for x in (n_a, n_b, more, less))
    low, high = np.zeros(np.shape(more)), np.minimum(n_a, n_b) / np.maximum(n_a, n_b)
    for _ in range(40):
        mid = (low + high) / 2
        rising = likelihood_slope(mid, n_a, n_b, more, less) > 0
        low, high = np.where(rising, mid, low), np.where(rising, high, mid)
    return (low + high) / 2


def _sketch_rows(batches, k: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = {"id": batch["id"], "n": [], "sig": [], "sketch": []}
        for text in batch["text"]:
            x = shingles(text.encode() if isinstance(text, str) else b"", k)
            out["n"].append(len(x))
            if len(x):
                a, b = mix(x, 1).sum(dtype=_U), mix(x, 2).sum(dtype=_U)
                out["sig"].append(int(a).to_bytes(8, "big") + int(b).to_bytes(8, "big"))
                out["sketch"].append(registers(x).tobytes())
            else:
                out["sig"].append(None)
                out["sketch"].append(None)
        yield pd.DataFrame(out)


def sketches(docs: DataFrame, k: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, n (distinct shingles), sig (128-bit hash of the set), sketch."""
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    schema = "id long, n long, sig binary, sketch binary"
    return rows.mapInPandas(releasing(lambda batches: _sketch_rows(batches, k)), schema)


def _set_rows(batches, k: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for i in range(0, len(batch), 256):  # sets are larger than their texts
            sets = [shingles(t.encode(), k) for t in batch["text"].iloc[i : i + 256]]
            sig = [int(mix(x, 1).sum(dtype=_U)).to_bytes(8, "big") + int(mix(x, 2).sum(dtype=_U)).to_bytes(8, "big") for x in sets]
            yield pd.DataFrame({"sig": sig, "items": [x.view(np.int64) for x in sets]})


def _hopeful(batches, threshold: float) -> Iterator[pd.DataFrame]:
    """Pairs whose joint estimate does not rule the threshold out."""
    for batch in batches:
        if not len(batch):
            continue
        a = np.frombuffer(b"".join(batch["sa"]), np.uint16).reshape(-1, REGISTERS)
        b = np.frombuffer(b"".join(batch["sb"]), np.uint16).reshape(-1, REGISTERS)
        n_a, n_b = batch["na"].to_numpy(), batch["nb"].to_numpy()
        j = estimate(n_a, n_b, (a > b).sum(axis=1), (a < b).sum(axis=1))
        fits = np.minimum(n_a, n_b) >= threshold * np.maximum(n_a, n_b)
        yield batch.loc[fits & (j >= threshold - MARGIN), ["a", "b"]]


def _pairs(cuts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs i < j of rows of one group, in chunks."""
    sizes = np.diff(cuts)
    first = np.repeat(cuts[:-1], sizes)
    after = np.repeat(cuts[1:], sizes) - np.arange(len(first)) - 1  # partners that follow each row
    ends = np.cumsum(after)
    a = 0
    while a < len(after):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PAIRS, "right")))
        i = np.repeat(np.arange(a, b), after[a:b])
        start = np.repeat(ends[a:b] - after[a:b], after[a:b])
        j = i + 1 + np.arange(len(i)) + (ends[a - 1] if a else 0) - start
        yield i, j
        a = b


def _apart(frame: pd.DataFrame, cuts: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Hopeful pairs of different components within the groups of a frame of sorted blocks."""
    s = np.frombuffer(b"".join(frame["sketch"]), np.uint16).reshape(-1, REGISTERS)
    bands, n = s.view(np.uint64), frame["n"].to_numpy().astype(float)
    root = pd.factorize(frame["root"])[0]
    band, part = frame["band"].to_numpy(), frame["part"].to_numpy()
    two_blocks = frame["lo"].to_numpy() != frame["hi"].to_numpy()
    earlier = np.arange(REGISTERS // ROWS)
    found = [(np.empty(0, np.int64),) * 2]
    for i, j in _pairs(cuts):
        ok = (root[i] != root[j]) & (np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j]))
        ok &= ~two_blocks[i] | (part[i] != part[j])
        i, j = i[ok], j[ok]
        for x in range(0, len(i), JUDGED):
            u, v = i[x : x + JUDGED], j[x : x + JUDGED]
            # a pair that shares an earlier band meets in that band's bucket
            new = ~((bands[u] == bands[v]) & (earlier < band[u][:, None])).any(axis=1)
            u, v = u[new], v[new]
            est = estimate(n[u], n[v], (s[u] > s[v]).sum(axis=1), (s[u] < s[v]).sum(axis=1))
            good = est >= threshold - MARGIN
            found.append((u[good], v[good]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _open_rows(batches, threshold: float) -> Iterator[pd.DataFrame]:
    """The rows of blocks that have a hopeful pair across components."""
    for frame, cuts in whole_groups(batches, BLOCK_KEYS):
        i, j = _apart(frame, cuts, threshold)
        yield frame.iloc[np.union1d(i, j)]


def _joined(batches, threshold: float, percent: int) -> Iterator[pd.DataFrame]:
    """Links, confirmed on full sets, that join components; one for each two parts that meet in a block."""
    for frame, cuts in whole_groups(batches, BLOCK_KEYS):
        i, j = _apart(frame, cuts, threshold)
        sig = frame["sig"].to_numpy()
        items = [np.asarray(x, np.int64).view(_U) for x in frame["items"]]  # sorted as unsigned
        label = np.searchsorted(cuts, np.arange(len(frame)), "right") * len(frame) + pd.factorize(frame["root"])[0]
        turn = np.argsort(i, kind="stable")
        i, j = i[turn], j[turn]
        links = []
        for a, b in zip(*_stretches(i)):
            x, at = i[a], j[a:b]
            at = at[label[at] != label[x]]
            for c in range(0, len(at), 256):
                some = at[c : c + 256]
                some = some[label[some] != label[x]]
                if not len(some):
                    continue
                own, sizes = items[x], np.array([len(items[k]) for k in some])
                all_items = np.concatenate([items[k] for k in some])
                place = np.minimum(np.searchsorted(own, all_items), len(own) - 1)
                common = np.add.reduceat((own[place] == all_items).astype(np.int64), np.cumsum(sizes) - sizes)
                for k in some[100 * common >= percent * (len(own) + sizes - common)]:
                    if label[k] != label[x]:
                        links.append((sig[x], sig[k]))
                        label[label == label[k]] = label[x]
        if links:
            yield pd.DataFrame(links, columns=["a", "b"])


def _stretches(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each stretch of equal values begins and ends."""
    if not len(values):
        return values, values
    starts = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1])
    return starts, np.append(starts[1:], len(values))


def near_duplicates(
    docs: DataFrame, k: int = WORDS, percent: int = THRESHOLD, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when ``100 * |A and B| >= percent * |A or B|`` for
    their sets of distinct ``k``-word shingles; component_id is the smallest
    doc_id reachable over links (itself included), kept says that it is the
    document's own. One row per input row.

    Null, empty and white-space texts have an empty set: linked with nothing.
    Fewer than k words: one shingle of the whole sequence. Rows that share a
    doc_id are compared by their texts like any others. A row whose doc_id is
    null is linked too, but names no component: component_id is null only if
    no row of its group has a doc_id, and such a row counts as kept. Other
    columns of ``docs`` are not read.
    """
    return _judged(docs, k, percent, doc_id, text).select("doc_id", "n_shingles", "component_id", "kept")


def _judged(docs: DataFrame, k: int, percent: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``near_duplicates`` with the row's set (sig) and its group (root: a set of it), both null for an empty set."""
    spark = docs.sparkSession
    ship(spark)
    threshold = percent / 100
    rows = written(sketches(docs, k, doc_id, text), "sketches")
    classes = written(
        rows.where("n > 0")
        .groupBy("sig")
        .agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.count("*").alias("rows")),
        "classes",
    )

    n_bands = REGISTERS // ROWS
    members = classes.select(
        "sig", F.explode(F.sequence(F.lit(0), F.lit(n_bands - 1))).alias("band"), "sketch"
    ).select("sig", "band", F.expr(f"substring(sketch, band * {2 * ROWS} + 1, {2 * ROWS})").alias("bucket"))
    buckets = members.groupBy("band", "bucket").agg(F.min("sig").alias("least"), F.count("*").alias("size"))
    buckets = written(buckets.where("size > 1"), "buckets")
    met = written(members.join(buckets, ["band", "bucket"]), "met")

    full = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))

    def sets_of(wanted: DataFrame, name: str) -> DataFrame:
        """The full sets of some classes (rows: sig): read again from the row of a class's least doc_id."""
        ids = classes.join(wanted, "sig", "left_semi").select("id").distinct()
        texts = full.join(ids, full["id"].eqNullSafe(ids["id"]), "left_semi").where("text is not null").select("text")
        sets = texts.mapInPandas(releasing(lambda x: _set_rows(x, k)), "sig binary, items array<long>")
        # rows of one doc_id may differ in text, and rows of one text may repeat
        return written(sets.join(wanted, "sig", "left_semi").dropDuplicates(["sig"]), name)

    # 1. every class against the least class of each of its buckets
    side = classes.select("sig", "n", "sketch")
    a = side.select(F.col("sig").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    b = side.select(F.col("sig").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    stars = met.where("sig != least").select(F.col("sig").alias("a"), F.col("least").alias("b")).distinct()
    stars = stars.join(a, "a").join(b, "b").mapInPandas(releasing(lambda x: _hopeful(x, threshold)), "a binary, b binary")
    stars = written(stars, "stars")
    sets = sets_of(stars.select(F.col("a").alias("sig")).union(stars.select("b")).distinct(), "star-sets")
    both = stars.join(sets.select(F.col("sig").alias("a"), F.col("items").alias("xa")), "a")
    both = both.join(sets.select(F.col("sig").alias("b"), F.col("items").alias("xb")), "b")
    common = F.size(F.array_intersect("xa", "xb"))
    linked = 100 * common >= percent * (F.size("xa") + F.size("xb") - common)
    roots = components(both.where(linked).select("a", "b"))

    # 2. what is still apart inside a bucket of three or more
    root = F.coalesce("root", "sig").alias("root")
    placed = met.where("size > 2").join(roots.withColumnRenamed("node", "sig"), "sig", "left")
    placed = placed.select("sig", "band", "bucket", root)
    placed = placed.join(classes.select("sig", "n"), "sig")
    mixed = placed.groupBy("band", "bucket").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.sum("n").alias("weight"))
    apart = placed.join(mixed.where("x != y").select("band", "bucket", "weight"), ["band", "bucket"])
    apart = apart.join(classes.select("sig", "sketch"), "sig")
    blocks = F.ceil(F.col("weight") / BLOCK).cast("int")
    apart = apart.withColumn("blocks", blocks).withColumn("part", F.pmod(F.xxhash64("sig"), F.col("blocks")).cast("int"))
    apart = apart.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    apart = apart.select(
        "band", "bucket", F.least("part", "with").alias("lo"), F.greatest("part", "with").alias("hi"),
        "part", "sig", "root", "n", "sketch",
    )
    apart = apart.repartition(*BLOCK_KEYS).sortWithinPartitions(*BLOCK_KEYS, "sig")
    still = written(apart.mapInPandas(releasing(lambda x: _open_rows(x, threshold)), apart.schema), "open")
    sets = sets_of(still.select("sig").distinct(), "open-sets")
    still = still.join(sets, "sig").repartition(*BLOCK_KEYS).sortWithinPartitions(*BLOCK_KEYS, "sig")
    late = written(still.mapInPandas(releasing(lambda x: _joined(x, threshold, percent)), "a binary, b binary").distinct(), "late")
    if not late.isEmpty():
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(late))

    # 3. a component is named by its least doc_id
    named = classes.select("sig", "id").join(roots.withColumnRenamed("node", "sig"), "sig", "left")
    named = named.select("sig", "id", root)
    least = named.groupBy("root").agg(F.min("id").alias("component"))
    named = named.join(least, "root").select("sig", "component", "root")
    out = rows.join(named, "sig", "left")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component"))
    return out.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
        "sig",
        "root",
    )


def keep_one(docs: DataFrame, k: int = WORDS, percent: int = THRESHOLD) -> DataFrame:
    """``docs`` with one document left of each near-duplicate group.

    Rows and columns are as given; of rows that repeat a kept doc_id and its set one stays.
    Rows that share a doc_id with different sets are judged each in its own group: (5, A), (7, A), (7, B)
    keep 5 and the 7 of B; if they are near copies of each other, the one of the least set signature stays.
    Rows without a doc_id cannot be told apart by it: if one of them is kept, all stay.
    """
    judged = written(_judged(docs, k, percent), "judged")
    mark = F.xxhash64("sig")
    ids = judged.groupBy("doc_id").agg(F.max("kept").alias("kept"), (F.min(mark) != F.max(mark)).alias("mixed"))
    several = ids.where("mixed and doc_id is not null").select(F.col("doc_id").alias("__id"))
    keep = ids.where("kept and (doc_id is null or not mixed)").select(F.col("doc_id").alias("__id"))
    found = docs.join(keep, docs["doc_id"].eqNullSafe(keep["__id"]), "left_semi")
    named = found.where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"])
    out = named.unionByName(found.where(F.col("doc_id").isNull()))
    if several.isEmpty():
        return out

    # few: ids that name more than one text
    @F.pandas_udf("binary")
    def signature(texts: pd.Series) -> pd.Series:
        return next(_sketch_rows([pd.DataFrame({"id": 0, "text": texts})], k))["sig"]

    sets = judged.join(several, judged["doc_id"] == several["__id"], "left_semi").where("kept")
    sets = sets.groupBy("doc_id", "root").agg(F.min("sig").alias("__set")).select(F.col("doc_id").alias("__id"), "__set")
    rows = docs.join(several, docs["doc_id"] == several["__id"], "left_semi").withColumn("__sig", signature("text"))
    rows = rows.join(sets, (F.col("doc_id") == F.col("__id")) & F.col("__sig").eqNullSafe(F.col("__set")), "left_semi")
    return out.unionByName(rows.dropDuplicates(["doc_id", "__sig"]).drop("__sig"))


def op3_minhash_near_dedup(spark, sf_dir) -> DataFrame:
    """Near-duplicate groups of all documents on 4-word shingles at 80 %."""
    from .common import table

    return near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


SHINGLE_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0))
"""

OP3_SQL = (
    "WITH RECURSIVE "
    + SHINGLE_SQL.strip().removeprefix("WITH ")
    + r""",
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c ON c.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
)
