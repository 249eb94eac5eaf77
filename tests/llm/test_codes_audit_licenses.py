"""Vector codes, filter audit and license scan: brute force, odd rows, empty tables, clashing names."""

from __future__ import annotations

import hashlib
import re
from itertools import permutations

import duckdb
import numpy as np
import pytest

from chartlens.llm import filteraudit, licensescan, vectorcodes
from chartlens.llm.licensescan import Automaton, Template

LONG = "lorem ipsum dolor sit amet consectetur " * 30000


# ---------------------------------------------------------------- vector codes
def lloyd(rows, parts, entries, rounds):
    """Codes, errors and books by full rescans in Python's integers. ``rows``: (id, label, ints)."""
    rows = sorted(rows, key=lambda r: r[0])
    width = -(-max(len(r[2]) for r in rows) // parts)
    cut = [[(*r[2], *[0] * (width * parts))[p * width : (p + 1) * width] for p in range(parts)] for r in rows]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for c in cut:
                members.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            for k, vs in members.items():
                books[p][k] = [sum(x) // len(vs) for x in zip(*vs)]
    out = []
    for (i, label, _), c in zip(rows, cut):
        best = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), label))
    total = {}
    for _, _, e, label in out:
        total[label] = total.get(label, 0) + e
    text = ",".join(str(c) for book in books for e in book for c in e)
    return sorted((i, c, e, total[label], hashlib.sha256(text.encode()).hexdigest()) for i, c, e, label in out)


def scaled(v):
    return [int(np.floor(256 * float(x))) for x in v]


def found(df):
    return sorted(tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())


SCHEMA = "vec_id long, embedding array<double>, label int, code string, error long, id string, x int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, "i", 2) for r in rows], SCHEMA).repartition(3)


def test_codes_are_exact(spark):
    """Ties, repeated vectors, null labels, one label with most rows, rows that take no part."""
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) / 16 for x in rng.integers(-3, 4, 12)], None if i % 5 == 0 else 0 if i % 3 else i) for i in range(300)]
    rows += [(1000 + i, rows[7][1], 1) for i in range(200)]
    inf, nan = float("inf"), float("nan")
    odd = [(2000, None, 1), (2001, [1.0, None], 1), (2002, [nan] * 12, 1), (2003, [inf] + [0.0] * 11, None)]
    want = lloyd([(i, label, scaled(v)) for i, v, label in rows], 4, 8, 3)
    assert found(vectorcodes.codes(frame(spark, rows + odd), parts=4, entries=8, rounds=3)) == want


def test_codes_of_large_and_short_vectors(spark):
    rows = [(i, [float(i % 7), -float(i % 3), 0.5 * (i % 5)], 0) for i in range(40)] + [(50, [], 1), (51, [2.0], 1)]
    rows += [(-2, [1e6, 2.0, 3.0], 2), (-1, [4e6, -1e6, 1e6], 2), (60, [1e6, 2.0, 3.5], 2)]
    want = lloyd([(i, label, scaled(v)) for i, v, label in rows], 2, 6, 2)
    assert found(vectorcodes.codes(frame(spark, rows), parts=2, entries=6)) == want
    far = frame(spark, rows + [(70, [1e12, 0.0, 0.0], 0), (71, [-1e12, 0.0, 0.0], 0)])
    with pytest.raises(Exception, match="does not fit 64 bits"):
        vectorcodes.codes(far, parts=2, entries=6, rounds=0).collect()


def test_codes_without_rows(spark):
    nothing = frame(spark, [(1, None, 1)])
    assert vectorcodes.codes(nothing).count() == 0
    alone = vectorcodes.codes(frame(spark, [(None, [0.5] * 16, None)])).collect()
    assert [(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in alone] == [(None, "00" * 16, 0, 0)]
    repeated = vectorcodes.codes(frame(spark, [(1, [0.5] * 16, 1)] * 3)).collect()
    assert [(r["vec_id"], r["error"]) for r in repeated] == [(1, 0)] * 3


def test_active_entries_save_distances():
    """Same codes and distances as a full rescan, with fewer of them computed."""
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(size=(2000, 8)) * 20)
    before = vectorcodes.Books(x[:64].reshape(64, 2, 4).transpose(1, 0, 2).copy())
    code, known, full = vectorcodes.assign(x, before)
    assert full == 2000 * 2 * 64
    after = before.entries.copy()
    after[0, [3, 9]] += 5  # two entries move
    after[1, 40] = after[1, 2]  # and one becomes equal to a lower one
    books = vectorcodes.Books(after, (after != before.entries).any(axis=2))
    want, distance, _ = vectorcodes.assign(x, vectorcodes.Books(after))
    got = vectorcodes.assign(x, books, code, known)
    assert (got[0] == want).all() and (got[1] == distance).all()
    stayed = sum((~books.moved[p][code[:, p]]).sum() * books.moved[p].sum() for p in range(2))
    assert got[2] == stayed + sum(books.moved[p][code[:, p]].sum() * 64 for p in range(2)) < full / 10


def test_decode(spark):
    rows = [(i, [float(i % 5), float(i % 3)], 0) for i in range(30)]
    out, books = vectorcodes.train(frame(spark, rows), parts=2, entries=15)
    for r in out.collect():
        v = books.decode(r["code"].hex())
        assert ((v - scaled(rows[r["id"]][1])) ** 2).sum() == r["error"]


# ---------------------------------------------------------------- filter audit
TEXTS = [
    None, "", "a", "$", " \t\n ", "A" * 100, "a b " * 100, "word" * 50000, LONG, "É" * 30, "x1 " * 49, " ".join(f"w{i}" for i in range(60)),
    " ".join(f"w{i}" for i in range(60)), " ".join(f"W{i}" for i in range(60)) + " #", "a\x00b\x1c\x85c",
]


def audit_rows():
    rng = np.random.default_rng(3)
    rows = [(int(i), TEXTS[rng.integers(len(TEXTS))], [None, "", "s1", "s2"][rng.integers(4)]) for i in range(60)]
    rows += [(5, TEXTS[11], "s1"), (5, TEXTS[11], "s1"), (5, TEXTS[12], "s3"), (None, TEXTS[11], "s1"), (None, None, None)]
    return rows + [(200 + i, TEXTS[7], "s2") for i in range(40)]


LABELS = [(1, 1, 1), (1, 0, None), (5, 1, 0), (7, None, 1), (None, 1, 1), (999, 1, 1), (201, 0, 1)]


def test_audit_by_applying_filters(spark):
    rows = audit_rows()
    docs = spark.createDataFrame([(*r, "p", 1) for r in rows], "doc_id long, text string, source string, part string, mask int")
    labels = spark.createDataFrame([(*x, "p") for x in LABELS], "doc_id long, quality int, toxic int, part string")
    good = {d for d, q, _ in LABELS if q == 1 and d is not None}
    toxic = {d for d, _, t in LABELS if t == 1 and d is not None}
    parts = {}
    for d, t, s in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {c for c, f in zip("ABCDE", (
            len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), re.search(r"[#$%&*|]", t),
            d is not None and any(o is not None and o < d and (u or "") == t for o, u, _ in rows),
        )) if f}
        parts.setdefault(s or "", []).append((d, fails))
    want = []
    for part, members in parts.items():
        removed_at = {}
        lines = []
        for order in permutations("ABCDE"):
            left = members
            for step, f in enumerate(order, start=1):
                gone = [m for m in left if f in m[1]]
                left = [m for m in left if f not in m[1]]
                removed_at[f] = removed_at.get(f, 0) + len(gone)
                fails = sum(f in m[1] for m in members)
                only = sum(m[1] == {f} for m in members)
                lines.append([part, "".join(order), step, len(left), len(gone), fails - len(gone), only,
                              sum(m[0] in good for m in gone), sum(m[0] in toxic for m in gone), f])
        want += [(*x[:-1], removed_at[x[-1]]) for x in lines]
    got = filteraudit.audit(docs, labels)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert got.columns == [c.split()[0] for c in filteraudit.STEP_SCHEMA.split(", ")]
    for r in filteraudit.shares(docs, labels).groupBy("part").agg({"share": "sum"}).collect():
        assert abs(r[1] - sum(bool(m[1]) for m in parts[r["part"]])) < 1e-9


def test_audit_without_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filteraudit.audit(docs, labels).count() == 0
    one = filteraudit.audit(spark.createDataFrame([(1, None, None)], docs.schema), labels).collect()
    assert len(one) == 600 and {r["part"] for r in one} == {""}


def test_potentials_are_shapley():
    """Against the average over all orders; the values of a part sum to all that is removed."""
    counts = np.random.default_rng(4).integers(0, 1000, (7, 32))
    v = filteraudit.removed_by(counts)
    for i in range(5):
        total = np.zeros(7, np.int64)
        for order in permutations(range(5)):
            before = sum(1 << j for j in order[: order.index(i)])
            total += v[:, before | 1 << i] - v[:, before]
        assert (filteraudit.shapley(v, i) == total).all()
    assert (sum(filteraudit.shapley(v, i) for i in range(5)) == 120 * (counts.sum(axis=1) - counts[:, 0])).all()


# ---------------------------------------------------------------- license scan
LICENSE_TEXTS = [
    None, "", "cc", "cc by", "CC-BY-4.0", "cc cc by by cc by", "MIT License, MIT LICENSE", "mit\x00license", "mit é license", "mité license",
    "This work is licensed under the GNU General Public License, version 3.", "GNU General Public License as published by the Free Software Foundation, either version 2",
    "gnu general public licence version 3", "Copyright (c) 2001-2004 Jane Q. Public. All rights reserved.", "copyright all rights reserved",
    "copyright a b c d e f g h i all rights reserved", "CREATIVE COMMONS Attribution 4.0 International License", "creative commons attribution license",
    "Permission is hereby granted to any person obtaining a copy of this software and associated documentation files",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of the software and associated documentation files",
    "BSD 3-Clause License", "bsd clause license", "SPDX-License-Identifier: BSD-2-Clause", LONG + " apache license version 2.0 " + LONG,
    "gnu " * 50000 + "general public license",
]


def test_licenses_against_sql(spark):
    rows = [(i, t) for i, t in enumerate(LICENSE_TEXTS)] + [(3, "cc by"), (None, "cc by nc 4 0")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n_words int, labels string").repartition(3)
    got = licensescan.licenses(docs)
    documents = docs.toPandas()  # noqa: F841  (DuckDB reads it by name)
    result = duckdb.sql(licensescan.OP13_SQL.replace("FROM documents", "FROM (SELECT doc_id, text FROM documents)"))
    assert got.columns == result.columns
    clean = [tuple(None if isinstance(x, float) and np.isnan(x) else x for x in r) for r in result.fetchall()]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((None if r[0] is None else int(r[0]), *r[1:]) for r in clean), key=repr)
    by_id = {r["doc_id"]: r for r in got.collect()}
    assert by_id[5]["n_base"] == 2 and (by_id[5]["first_word"], by_id[5]["last_word"]) == (1, 4)
    assert by_id[13]["labels"] == "all-rights-reserved" and by_id[14]["labels"] == by_id[15]["labels"] == ""
    assert by_id[18]["labels"] == "mit" and by_id[19]["labels"] == ""
    assert by_id[23]["labels"] == "apache,apache-2.0"
    assert by_id[0]["score"] == 0 and by_id[10]["score"] > 0.9


def test_scan_spans(spark):
    docs = spark.createDataFrame([(1, "x\nBSD 3-Clause\tLicence é; CC  BY/NC")], "doc_id long, text string")
    (row,) = licensescan.scan(docs).collect()
    assert {(m["name"], m["start"], m["end"], m["span"]) for m in row["matches"]} == {
        ("bsd-name", 1, 5, "BSD 3-Clause\tLicence"), ("cc-by-name", 6, 8, "CC  BY"), ("cc-by-nc", 6, 9, "CC  BY/NC"),
    }
    assert licensescan.scan(docs.where("doc_id = 2")).count() == 0


def test_random_templates_against_patterns():
    """Nested optional regions and replaceable words, at every place, against regular expressions."""
    rng = np.random.default_rng(6)

    def region(depth):
        kind = rng.integers(5)
        if kind == 0 and depth:
            return f"<<beginOptional>>{' '.join(region(depth - 1) for _ in range(rng.integers(1, 3)))}<<endOptional>>"
        if kind == 1:
            least = rng.integers(0, 2)
            return f"<<var;name=v;words={least}-{least + rng.integers(0, 3)}>>"
        return "|".join(rng.choice(list("abc"), rng.integers(1, 3)))

    templates = tuple(Template(str(i), "x", "a " + " ".join(region(2) for _ in range(rng.integers(1, 5)))) for i in range(40))
    automaton = Automaton(templates)
    for _ in range(150):
        words = list(rng.choice(list("abcd"), rng.integers(0, 12)))
        got = set(automaton.matches(automaton.numbers(" ".join(words).encode())))
        want = set()
        for t, template in enumerate(templates):
            for at in range(len(words)):
                ends = [e for e in range(at, len(words) + 1) if re.fullmatch(licensescan.pattern(licensescan.parse(template.markup)), "".join(w + " " for w in words[at:e]))]
                want |= {(t, at, max(ends))} if ends and max(ends) > at else set()
        assert got == want


def test_segments(monkeypatch):
    automaton = Automaton(licensescan.TEMPLATES)
    raw = ("some words and gnu general  public license, version 3 " * 50).encode()
    whole = automaton.matches(automaton.numbers(raw))
    for size in (1, 7, 100):
        monkeypatch.setattr(licensescan, "SEGMENT", size)
        assert automaton.matches(automaton.numbers(raw)) == whole
    monkeypatch.setattr(licensescan, "STATES", 1)
    assert automaton.matches(automaton.numbers(raw)) == whole


@pytest.mark.parametrize("markup", ["", "<<beginOptional>>a", "a <<endOptional>>", "a <<var;words=3-1>>", "<<what>> a", "<<beginOptional>>a<<endOptional>>"])
def test_bad_markup(markup):
    with pytest.raises(ValueError):
        licensescan.parse(markup)
