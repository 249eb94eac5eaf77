"""License wording by templates with optional and replaceable regions, as one automaton over words.

A template is wording in the markup of the SPDX license list's matching guidelines:
``<<beginOptional>>...<<endOptional>>`` may be missing (and may hold others),
``<<var;name=...;words=a-b>>`` stands for any a to b words, and ``one|other`` for
either word. Everything else is mandatory and must stand there word for word, in
order, with nothing between. All templates become one automaton over words,
whose deterministic states are made when a text first needs them. A text is read as
numbers of the templates' words (0: any other word); only places where the first
two words fit some template are followed, each to its longest match per template.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased: runs of
digits, a-z and all characters beyond ASCII. Whole texts are read, in segments
for the memory's sake; the numbers of all words are kept, so a match may cross them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, table


@dataclass(frozen=True)
class Template:
    name: str
    label: str
    markup: str
    base: bool = False


# The base phrases and their labels.
BASE = (
    Template("gpl-name", "gpl", "gnu general public license", True),
    Template("apache-name", "apache", "apache license", True),
    Template("cc-by-name", "cc-by", "cc by", True),
    Template("mit-name", "mit", "mit license", True),
)

_CC = "<<beginOptional>>international|unported<<endOptional>>"

# Wording of well-known licenses: their names with versions, grants and notices.
TEMPLATES = BASE + (
    Template("gpl-2", "gpl-2.0", "gnu general public license|licence <<beginOptional>>as published by the free software foundation <<beginOptional>>either<<endOptional>><<endOptional>> <<beginOptional>>version|v<<endOptional>> 2"),
    Template("gpl-3", "gpl-3.0", "gnu general public license|licence <<beginOptional>>as published by the free software foundation <<beginOptional>>either<<endOptional>><<endOptional>> <<beginOptional>>version|v<<endOptional>> 3"),
    Template("gpl-short-2", "gpl-2.0", "gpl <<beginOptional>>version|v<<endOptional>> 2|v2"),
    Template("gpl-short-3", "gpl-3.0", "gpl <<beginOptional>>version|v<<endOptional>> 3|v3"),
    Template("lgpl-name", "lgpl", "gnu lesser|library general public license|licence"),
    Template("agpl-name", "agpl", "gnu affero general public license|licence"),
    Template("apache-2", "apache-2.0", "apache license|licence <<beginOptional>>version|v<<endOptional>> 2 <<beginOptional>>0<<endOptional>>"),
    Template("apache-notice", "apache-2.0", "licensed under the apache license version 2 0 the license you may not use this <<var;name=thing;words=1-3>> except in compliance with the license"),
    Template("cc-by-nc", "cc-by-nc", "cc by nc <<beginOptional>>nd|sa<<endOptional>>"),
    Template("cc-by-sa", "cc-by-sa", "cc by sa"),
    Template("cc-by-nd", "cc-by-nd", "cc by nd"),
    Template("cc-by-4", "cc-by-4.0", f"cc by 4 0 {_CC}"),
    Template("cc-by-nc-4", "cc-by-nc-4.0", f"cc by nc 4 0 {_CC}"),
    Template("cc-long", "cc-by", f"creative commons attribution <<beginOptional>><<var;name=version;words=2-2>><<endOptional>> {_CC} license|licence"),
    Template("cc-nc-long", "cc-by-nc", f"creative commons attribution noncommercial <<beginOptional>>noderivatives|sharealike<<endOptional>> <<beginOptional>><<var;name=version;words=2-2>><<endOptional>> {_CC} license|licence"),
    Template("cc-sa-long", "cc-by-sa", f"creative commons attribution sharealike <<beginOptional>><<var;name=version;words=2-2>><<endOptional>> {_CC} license|licence"),
    Template("cc0", "cc0", "cc0 1 0 <<beginOptional>>universal<<endOptional>>"),
    Template("mit-grant", "mit", "permission is hereby granted <<beginOptional>>free of charge<<endOptional>> to any person obtaining a copy of this software and associated documentation files"),
    Template("mit-warranty", "mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    Template("isc-grant", "isc", "permission to use copy modify and <<beginOptional>>or<<endOptional>> distribute this software for any purpose with or without fee is hereby granted"),
    Template("bsd-grant", "bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("bsd-name", "bsd", "bsd <<beginOptional>><<var;name=clauses;words=1-1>> clause<<endOptional>> license|licence"),
    Template("mpl-name", "mpl", "mozilla public license|licence <<beginOptional>>version|v<<endOptional>> <<beginOptional>>2 0<<endOptional>>"),
    Template("unlicense", "unlicense", "this is free and unencumbered software released into the public domain"),
    Template("rights-reserved", "all-rights-reserved", "copyright <<beginOptional>>c<<endOptional>> <<var;name=holder;words=1-8>> all rights reserved"),
    Template("spdx-mit", "mit", "spdx license identifier mit"),
    Template("spdx-apache-2", "apache-2.0", "spdx license identifier apache 2 0"),
    Template("spdx-bsd", "bsd", "spdx license identifier bsd <<var;name=clauses;words=1-1>> clause"),
    Template("spdx-gpl-2", "gpl-2.0", "spdx license identifier gpl 2 0"),
    Template("spdx-gpl-3", "gpl-3.0", "spdx license identifier gpl 3 0"),
)

DOUBT = 0.75  # left by each mandatory word that stands there
SEGMENT = 1 << 20
STATES = 100_000  # deterministic states kept; made again beyond

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if _WORD[c] else 32 for c in range(256))

Region = tuple  # ("word", words) | ("any", least, most) | ("optional", regions)


def parse(markup: str) -> list[Region]:
    """Regions of a template."""
    open_regions: list[list[Region]] = [[]]
    for mark, word in re.findall(r"<<([^<>]*)>>|([^\s<>]+)", markup):
        if word:
            open_regions[-1].append(("word", tuple(sorted(set(word.lower().split("|"))))))
        elif mark == "beginOptional":
            open_regions.append([])
        elif mark == "endOptional" and len(open_regions) > 1:
            inside = open_regions.pop()
            open_regions[-1].append(("optional", tuple(inside)))
        elif (m := re.fullmatch(r"var;(?:name=\w+;)?words=(\d+)-(\d+)", mark)) and int(m[1]) <= int(m[2]):
            open_regions[-1].append(("any", int(m[1]), int(m[2])))
        else:
            raise ValueError(f"<<{mark}>> is no mark here: {markup}")
    if len(open_regions) > 1:
        raise ValueError(f"an optional region does not end: {markup}")
    if not strength(open_regions[0]):
        raise ValueError(f"a template needs a mandatory word: {markup}")
    return open_regions[0]


def strength(regions) -> int:
    """Mandatory words."""
    return sum(r[0] == "word" for r in regions)


class Automaton:
    """All templates as one automaton over word numbers."""

    def __init__(self, templates: tuple[Template, ...]):
        self.templates = templates
        self.words: dict[int, dict[str, list[int]]] = {}
        self.any: dict[int, list[int]] = {}
        self.free: dict[int, list[int]] = {}
        self.ends: dict[int, int] = {}
        self.nodes = 1
        for t, template in enumerate(templates):
            at = self._node()
            self.free.setdefault(0, []).append(at)
            self.ends[self._add(parse(template.markup), at)] = t
        vocabulary = sorted({w for edges in self.words.values() for w in edges})
        self.number = {w.encode(): i for i, w in enumerate(vocabulary, start=1)}
        self.spelled = [None, *vocabulary]
        self._forget()
        n = len(self.spelled)
        first = [self.after(self.start, w) for w in range(n)]
        self.alone = np.array([s >= 0 and bool(self.accepts[s]) for s in first])
        self.pairs = np.zeros((n, n), bool)
        for w in np.flatnonzero(np.array(first) >= 0):
            self.pairs[w] = [self.after(first[w], v) >= 0 for v in range(n)]

    def _node(self) -> int:
        self.nodes += 1
        return self.nodes - 1

    def _add(self, regions, at: int) -> int:
        for region in regions:
            if region[0] == "word":
                after = self._node()
                for w in region[1]:
                    self.words.setdefault(at, {}).setdefault(w, []).append(after)
                at = after
            elif region[0] == "any":
                ends = [at] if not region[1] else []
                for n in range(1, region[2] + 1):
                    after = self._node()
                    self.any.setdefault(at, []).append(after)
                    at = after
                    ends += [at] if n >= region[1] else []
                for e in ends[:-1]:
                    self.free.setdefault(e, []).append(at)
            else:
                after = self._add(region[1], at)
                if after != at:
                    self.free.setdefault(at, []).append(after)
                at = after
        return at

    def _forget(self) -> None:
        self.sets: dict[frozenset[int], int] = {}
        self.members: list[frozenset[int]] = []
        self.accepts: list[tuple[int, ...]] = []
        self.moves: list[dict[int, int]] = []
        self.start = self._state({0})

    def _state(self, nodes: set[int]) -> int:
        """The deterministic state of these nodes and all that they reach freely; -1 without nodes."""
        if not nodes:
            return -1
        todo, closed = list(nodes), set(nodes)
        while todo:
            for n in self.free.get(todo.pop(), ()):
                if n not in closed:
                    closed.add(n)
                    todo.append(n)
        key = frozenset(closed)
        if key not in self.sets:
            self.sets[key] = len(self.members)
            self.members.append(key)
            self.accepts.append(tuple(sorted(self.ends[n] for n in key if n in self.ends)))
            self.moves.append({})
        return self.sets[key]

    def after(self, state: int, word: int) -> int:
        """The state after one more word; -1: no template goes on."""
        if state < 0:
            return -1
        found = self.moves[state].get(word)
        if found is None:
            spelled, nodes = self.spelled[word], set()
            for n in self.members[state]:
                nodes.update(self.any.get(n, ()))
                nodes.update(self.words.get(n, {}).get(spelled, ()))
            found = self.moves[state][word] = self._state(nodes)
        return found

    def numbers(self, raw: bytes) -> np.ndarray:
        """Numbers of the words of a text, 0 for words of no template."""
        raw, get, out, at = raw.translate(_NORMAL), self.number.get, [], 0
        while at < len(raw):
            end = at + SEGMENT
            if end < len(raw):
                end = raw.find(b" ", end)
                end = len(raw) if end < 0 else end
            words = raw[at:end].split()
            out.append(np.fromiter((get(w, 0) for w in words), np.int32, len(words)))
            at = end
        return np.concatenate(out) if out else np.empty(0, np.int32)

    def matches(self, numbers: np.ndarray) -> list[tuple[int, int, int]]:
        """Template, first word and end (one past the last word) of the longest match of each template at each place."""
        if len(self.members) > STATES:
            self._forget()
        found = []
        near = np.append(self.pairs[numbers[:-1], numbers[1:]], False) if len(numbers) else np.empty(0, bool)
        for at in np.flatnonzero(near | self.alone[numbers]).tolist():
            state, longest = self.start, {}
            for end in range(at, len(numbers)):
                state = self.after(state, int(numbers[end]))
                if state < 0:
                    break
                for t in self.accepts[state]:
                    longest[t] = end + 1
            found += [(t, at, end) for t, end in longest.items()]
        return found


def spans(raw: bytes, found: list[tuple[int, int, int]]) -> list[str]:
    """The text of each match, as it stands in ``raw``."""
    if not found:
        return []
    word = _WORD[np.frombuffer(raw.translate(_NORMAL), np.uint8)]
    edge = np.diff(word.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return [raw[starts[a] : ends[b - 1]].decode() for _, a, b in found]


_automata: dict[tuple[Template, ...], Automaton] = {}


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Per row: doc_id, n_words and matches, an array of (name, label, base, start, end, strength, span).

    ``start`` and ``end`` count words from 0, the end is one past the last; ``strength`` is the
    template's number of mandatory words; ``span`` is the text matched. At each place
    a template has one match, the longest. Null texts are empty; every input row gives one row; other columns
    are not read.
    """
    ship(docs.sparkSession)
    templates = tuple(templates)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    weight = [strength(parse(t.markup)) for t in templates]

    def run(batches) -> Iterator[pd.DataFrame]:
        if templates not in _automata:
            _automata[templates] = Automaton(templates)
        automaton = _automata[templates]
        for batch in batches:
            n_words, matches = [], []
            for text in batch["text"]:
                raw = text.encode()
                numbers = automaton.numbers(raw)
                found = sorted(automaton.matches(numbers), key=lambda m: (m[1], m[2], m[0]))
                n_words.append(len(numbers))
                matches.append([
                    {"name": templates[t].name, "label": templates[t].label, "base": templates[t].base,
                     "start": a, "end": b, "strength": weight[t], "span": span}
                    for (t, a, b), span in zip(found, spans(raw, found))
                ])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_words": n_words, "matches": matches})

    match = "struct<name:string,label:string,base:boolean,start:bigint,end:bigint,strength:int,span:string>"
    return rows.mapInPandas(run, f"doc_id {kind}, n_words long, matches array<{match}>")


def _labels(matches: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")


def licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Per row: counts, places and labels of the base templates, all labels, and a score.

    The score is 1 - ``DOUBT`` ^ (mandatory words of the templates that match somewhere), to six places;
    without a match it is 0, labels are empty texts and places null.
    """
    rows = scan(docs, templates)
    base = F.filter("matches", lambda m: m["base"])
    places = F.transform(base, lambda m: m["start"])
    kinds = F.array_distinct(F.transform("matches", lambda m: F.struct(m["name"], m["strength"])))
    words = F.aggregate(kinds, F.lit(0), lambda total, k: total + k["strength"])
    return rows.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        _labels(base).alias("base_labels"), _labels(F.col("matches")).alias("labels"),
        F.round(1 - F.pow(F.lit(DOUBT), words), 6).alias("score"),
    )


def op13_license_scan(spark, sf_dir) -> DataFrame:
    """License wording in all documents."""
    return licenses(table(spark, sf_dir, "documents"))


def pattern(regions) -> str:
    """The same wording as a regular expression over words that a space follows each."""
    out = ""
    for region in regions:
        if region[0] == "word":
            out += f"(?:{'|'.join(region[1])}) "
        elif region[0] == "any":
            out += f"(?:[^ ]+ ){{{region[1]},{region[2]}}}"
        else:
            out += f"(?:{pattern(region[1])})?"
    return out


def _sql() -> str:
    found = ",\n    ".join(f"regexp_matches(t, ' {pattern(parse(t.markup))}') AS t{i}" for i, t in enumerate(TEMPLATES))
    strengths = " + ".join(f"t{i}::INT * {strength(parse(t.markup))}" for i, t in enumerate(TEMPLATES))
    every = ", ".join(f"CASE WHEN t{i} THEN '{t.label}' END" for i, t in enumerate(TEMPLATES))
    def places(words: list[str]) -> str:
        return " AND ".join(f"x{k} = '{w}'" if k else f"x = '{w}'" for k, w in enumerate(words))

    n_base = " + ".join(f"({places(t.markup.split())})::INT" for t in BASE)
    following = ", ".join(f"lead(x, {k}) OVER o AS x{k}" for k in range(1, max(len(t.markup.split()) for t in BASE)))
    base = ", ".join(f"CASE WHEN t{i} THEN '{t.label}' END" for i, t in enumerate(TEMPLATES) if t.base)

    def joined(labels: str) -> str:
        return f"coalesce(array_to_string(list_sort(list_distinct([{labels}])), ','), '')"

    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce("text", ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
u AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS i FROM d),
v AS (SELECT *, {following} FROM u WINDOW o AS (PARTITION BY r ORDER BY i)),
n AS (SELECT r, i, coalesce({n_base}, 0) AS n FROM (SELECT r, i, {", ".join(f"coalesce(x{k or ''}, '') AS x{k or ''}" for k in range(4))} FROM v)),
b AS (SELECT r, sum(n) AS n_base, min(i) AS first_word, max(i) AS last_word FROM n WHERE n > 0 GROUP BY r),
p AS (SELECT r, doc_id, len(w) AS n_words, ' ' || array_to_string(w, ' ') || ' ' AS t FROM d),
f AS (SELECT r, doc_id, n_words,
    {found}
  FROM p)
SELECT doc_id, n_words::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
  {joined(base)} AS base_labels,
  {joined(every)} AS labels,
  round(1 - pow({DOUBT}, {strengths}), 6) AS score
FROM f LEFT JOIN b USING (r)
"""


OP13_SQL = _sql()
