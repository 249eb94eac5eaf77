"""Language identification by Bayesian evidence fusion.

The posterior of language l for a row is proportional to

    P(text | l)^(1/3) * P(declared | l) * P(suffix | l) * P(l | host)

* text: a multinomial over hashed 3-byte windows of the lower-cased text,
  counted for each declared language over all rows (smoothed by one count per
  bucket); every declared value is a language. The power undoes the overlap of windows. ``und``, no known
  language, has every bucket alike;
* declared: how often rows whose text speaks for l declare each language
  (markup, or a column), smoothed; a missing or unknown one is no evidence;
* suffix: the same for the last label of the address, where it is the code of
  a language or something else;
* host prior: the languages that the texts of the same host speak for, without
  the row itself, smoothed by those of its domain, and these by those of all rows
  (weight ``PRIOR`` at each level). Counted by grouped aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, releasing, ship, small_batches, table, written

BUCKETS = 8192
GRAM = 3
PRIOR = 8.0  # rows
LEAST = 0.5  # posterior of an accepted row
BATCH_BYTES = 1 << 19
UNKNOWN = "und"

_U = np.uint64


def _buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of each window that lies inside a text and holds a letter."""
    raws = [b" " + t.lower().encode() + b" " for t in texts]
    raw = np.frombuffer(b"".join(raws), np.uint8)
    sizes = np.array([len(r) for r in raws], np.int64)
    n = max(len(raw) - GRAM + 1, 0)
    x, letter = np.zeros(n, np.uint32), np.zeros(n, bool)
    is_letter = (raw >= 0x80) | ((raw >= 97) & (raw <= 122))
    for k in range(GRAM):
        x = x << np.uint32(8) | raw[k : n + k]
        letter |= is_letter[k : n + k]
    owner = np.repeat(np.arange(len(texts)), sizes)[:n]
    room = np.repeat(np.cumsum(sizes), sizes)[:n] - np.arange(n)
    use = letter & (room >= GRAM)
    bucket = (x[use] * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
    return bucket.astype(np.int64), owner[use]


def _texts(column) -> list[str]:
    return [t if isinstance(t, str) else "" for t in column]


def _fit_rows(batches, classes: list[str]) -> Iterator[pd.DataFrame]:
    number = {c: i for i, c in enumerate(classes)}
    total: dict[int, np.ndarray] = {}  # buckets of the languages met
    for batch in batches:
        texts = _texts(batch["text"])
        label = np.array([number.get(d, -1) for d in batch["declared"]], np.int64)
        for a, b in by_bytes([len(t) for t in texts], BATCH_BYTES):
            bucket, owner = _buckets(texts[a:b])
            met, mine = np.unique(label[a:b], return_inverse=True)
            found = np.bincount(mine[owner] * BUCKETS + bucket, minlength=len(met) * BUCKETS).reshape(-1, BUCKETS)
            for c, counts in zip(met.tolist(), found):
                if c >= 0:
                    total[c] = total.get(c, 0) + counts
    for c, counts in total.items():
        place = np.flatnonzero(counts)
        yield pd.DataFrame({"place": c * BUCKETS + place, "n": counts[place]})


def _text_rows(batches, log_p: np.ndarray) -> Iterator[pd.DataFrame]:
    """Log-likelihoods of each text; ``best`` is -1 for a text without letters."""
    for batch in batches:
        texts = _texts(batch["text"])
        total, windows = np.zeros((len(texts), log_p.shape[1])), np.zeros(len(texts), np.int64)
        for a, b in by_bytes([len(t) for t in texts], BATCH_BYTES):
            bucket, owner = _buckets(texts[a:b])
            windows[a:b] = np.bincount(owner, minlength=b - a)
            for c in range(log_p.shape[1]):
                total[a:b, c] = np.bincount(owner, log_p[bucket, c], b - a)
        out = batch.drop(columns="text")
        out["likelihood"] = list(total / GRAM)
        out["best"] = np.where(windows > 0, total.argmax(axis=1), -1)
        yield out


def _confusion(seen: dict[tuple[int, int], int], rows: int, columns: int) -> np.ndarray:
    """log P(column | row), smoothed by half a count."""
    n = np.full((rows, columns), 0.5)
    for (r, c), count in seen.items():
        n[r, c] += count
    return np.log(n / n.sum(axis=1, keepdims=True))


def identify(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per row: ``keys``, declared, language, probability, accepted.

    ``rows`` has the columns ``keys``, text, declared, host, domain and suffix
    (any of them may be null). A text without letters has no language: it is
    ``und`` with its declared and host evidence ignored, and not accepted. A row
    is accepted if its language is not ``und`` and its posterior is at least
    ``LEAST``. Repeated rows are judged one by one. Without any declared
    language all rows are ``und``.
    """
    spark = rows.sparkSession
    ship(spark)
    small_batches(spark)
    rows = rows.select(*keys, "text", "declared", "host", "domain", "suffix")
    classes = sorted(r["declared"] for r in rows.where("declared != ''").select("declared").distinct().collect())  # one row per language
    size = len(classes)

    counted = rows.where("declared is not null").select("text", "declared")
    counted = counted.mapInPandas(releasing(lambda b: _fit_rows(b, classes)), "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    n = np.ones((size + 1, BUCKETS))
    counted = counted.toArrow()  # at most BUCKETS rows per language
    n.reshape(-1)[counted["place"].to_numpy()] += counted["n"].to_numpy()
    n[size] = 1
    log_p = np.log(n / n.sum(axis=1, keepdims=True)).T.copy()

    code = F.array(*[F.lit(c) for c in classes]) if classes else F.array().cast("array<string>")

    def place(value: Column) -> Column:
        return (F.coalesce(F.array_position(code, value), F.lit(0)) - 1).cast("int")

    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    read = rows.select(*keys, "text", "declared", "host", "domain", place(F.col("declared")).alias("said"), place(F.col("suffix")).alias("ending"))
    read = read.mapInPandas(
        releasing(lambda b: _text_rows(b, log_p)),
        f"{kinds}, declared string, host string, domain string, said int, ending int, likelihood array<double>, best int",
    )
    read = written(read, "likelihoods")

    # small tables: at most one row per two languages each
    heard = read.where("best >= 0")
    said = {(r["best"], r["said"]): r["count"] for r in heard.where("said >= 0").groupBy("best", "said").count().collect()}
    ending = {(r["best"], r["ending"] + 1): r["count"] for r in heard.groupBy("best", "ending").count().collect()}
    log_said = _confusion(said, size + 1, max(size, 1))
    log_ending = _confusion(ending, size + 1, size + 1)

    overall = np.full(size + 1, 0.5)
    for r in heard.groupBy("best").count().collect():  # one row per language
        overall[r["best"]] += r["count"]
    overall /= overall.sum()

    def votes_by(column: str) -> DataFrame:
        counted = heard.where(F.col(column).isNotNull()).groupBy(column, "best").agg(F.count("*").alias("n"))
        counted = counted.groupBy(column).agg(F.map_from_entries(F.collect_list(F.struct("best", "n"))).alias("n"))
        every = F.sequence(F.lit(0), F.lit(size))
        return counted.select(column, F.transform(every, lambda c: F.coalesce(F.try_element_at("n", c), F.lit(0))).alias(f"{column}_votes"))

    joined = read.join(votes_by("host"), "host", "left").join(votes_by("domain"), "domain", "left")
    names = classes + [UNKNOWN]

    def fuse(batches) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            best, said_, ending_ = (batch[c].to_numpy() for c in ("best", "said", "ending"))
            own = np.zeros((len(batch), size + 1))
            own[np.flatnonzero(best >= 0), best[best >= 0]] = 1
            prior = np.tile(overall, (len(batch), 1))
            for level in ("domain", "host"):
                has = batch[f"{level}_votes"].notna().to_numpy()
                seen = np.zeros((len(batch), size + 1))
                if has.any():
                    seen[has] = np.stack(batch.loc[has, f"{level}_votes"].to_numpy()) - own[has]
                prior = (seen + PRIOR * prior) / (seen.sum(axis=1, keepdims=True) + PRIOR)
            total = np.stack(batch["likelihood"].to_numpy()) + np.log(prior) + log_ending[:, ending_ + 1].T
            total += np.where(said_[:, None] >= 0, log_said[:, np.maximum(said_, 0)].T, 0)
            total -= total.max(axis=1, keepdims=True)
            p = np.exp(total)
            p /= p.sum(axis=1, keepdims=True)
            top = np.where(best >= 0, p.argmax(axis=1), size)
            out = batch[keys + ["declared"]].copy()
            out["language"] = [names[t] for t in top]
            out["probability"] = np.where(best >= 0, p[np.arange(len(p)), top], 0.0)
            out["accepted"] = (top != size) & (out["probability"].to_numpy() >= LEAST)
            yield out

    return joined.drop("host", "domain").mapInPandas(
        releasing(fuse), f"{kinds}, declared string, language string, probability double, accepted boolean"
    )


def _last_labels(host: Column, n: int) -> Column:
    labels = F.split(F.lower(F.regexp_replace(host, r":\d*$", "")), r"\.")
    return F.when(host != "", F.array_join(F.slice(labels, -F.least(F.lit(n), F.size(labels)), n), "."))


def document_evidence(docs: DataFrame) -> DataFrame:
    """Documents as rows of evidence: ``lang`` up to its region suffix is the declared language, ``source`` the host."""
    none = F.lit(None).cast("string")
    return docs.select(
        "doc_id", none.cast("long").alias("page_id"), "text", F.regexp_extract(F.lower("lang"), r"^\s*([^\s_-]*)", 1).alias("declared"),
        F.col("source").alias("host"), none.alias("domain"), none.alias("suffix"),
    )


def page_evidence(pages: DataFrame) -> DataFrame:
    """Web pages as rows of evidence: markup language, address suffix, host and its last two labels."""
    from .urlfilter import host_of

    html = F.col("html")
    text = F.regexp_replace(html, r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>", " ")
    declared = F.lower(F.regexp_extract(html, r"(?i)<html[^>]*\blang\s*=\s*[\"']?([a-z]+)", 1))
    host = F.when(host_of(F.col("url")) != "", host_of(F.col("url")))
    return pages.select(
        F.lit(None).cast("long").alias("doc_id"), "page_id", text.alias("text"), F.when(declared != "", declared).alias("declared"),
        host.alias("host"), _last_labels(host, 2).alias("domain"), _last_labels(host, 1).alias("suffix"),
    )


def keep_known(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that are not accepted; columns as given.

    Rows that share a doc_id stay if one of them is accepted.
    """
    judged = identify(document_evidence(docs), ["doc_id"])
    keep = judged.where("accepted").select(F.col("doc_id").alias("__keep")).distinct()
    return docs.join(keep, docs["doc_id"].eqNullSafe(keep["__keep"]), "left_semi")


def op2_language_id(spark, sf_dir) -> DataFrame:
    """The language of all documents (doc_id) and all web pages (page_id)."""
    rows = document_evidence(table(spark, sf_dir, "documents")).unionByName(page_evidence(table(spark, sf_dir, "pages")))
    return identify(rows, ["doc_id", "page_id"])
