"""URL filters by a bit-parallel wildcard automaton.

All rules are packed into one automaton of multiword bit masks, in the manner
of Shift-And (R. Baeza-Yates and G. Gonnet, "A New Approach to Text Searching",
1992): bit i of a URL's state says that the first i elements of a pattern are
matched, a byte c moves it by ``((state & step[c]) << 1) | (state & loop[c])``,
where ``loop`` holds the wildcards. A batch of URLs moves together, one byte of
each at a time; a URL is done once its state is empty or can change no more.

A rule ``host/path`` stands for the pattern ``*.host/path*`` over the canonical
URL ``.host/path``: it fits the host and its subdomains, and paths that start
with the rule's. ``*`` stops at "/" in the host part and at nothing in the path
part; ``?`` is any one byte (any but "/" in the host part).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, table

#: Fixed by the contract of ``op10_url_filters``: verdict and rule.
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
DEFAULT = "allow"
LONG = 2048  # bytes; a longer URL is simulated by itself
BATCH = 8192

_U = np.uint64


class Automaton:
    """Globs ``host/path`` (see the module), packed into masks of 64-bit words."""

    def __init__(self, globs: list[str]):
        step, loop = [0] * 256, [0] * 256
        self.ends: list[int] = []
        start, at = 0, 0
        for glob in globs:
            host, slash, path = glob.partition("/")
            start |= 1 << at
            for text, stop in ((f"*.{host}", 0x2F), (f"{slash}{path}*" if slash else "", None)):
                for b in text.encode():
                    others = [c for c in range(256) if c != stop]
                    if b == 0x2A:  # *
                        for c in others:
                            loop[c] |= 1 << at
                    else:
                        for c in others if b == 0x3F else [b]:  # ?
                            step[c] |= 1 << at
                        at += 1
            self.ends.append(at)
            at += 1
        self.start, self.step, self.loop = start, step, loop
        fixed = (1 << at) - 1
        for c in range(256):
            fixed &= loop[c] & ~step[c]
        #: states that no byte changes
        self.fixed = fixed
        self.words = -(-at // 64)
        self._step, self._loop = self._split(step), self._split(loop)
        self._start, self._fixed = self._split([start])[0], self._split([fixed])[0]

    def _split(self, masks: list[int]) -> np.ndarray:
        return np.array([[m >> (64 * w) & (2**64 - 1) for w in range(self.words)] for m in masks], _U).reshape(-1, self.words)

    def _alone(self, url: bytes) -> np.ndarray:
        state = self.start
        for c in url:
            state = ((state & self.step[c]) << 1) | (state & self.loop[c])
            if not state & ~self.fixed:
                break
        return self._split([state])[0]

    def states(self, urls: list[bytes]) -> np.ndarray:
        """The state after each URL."""
        out = np.tile(self._start, (len(urls), 1))
        sizes = np.array([len(u) for u in urls], np.int64)
        for i in np.flatnonzero(sizes > LONG):
            out[i] = self._alone(urls[i])
        live = np.flatnonzero((sizes <= LONG) & (sizes > 0))
        raw = np.frombuffer(b"".join(urls), np.uint8)
        first = np.cumsum(sizes) - sizes
        for k in range(LONG):
            live = live[sizes[live] > k]
            if not len(live):
                break
            c = raw[first[live] + k]
            state = out[live]
            moved = state & self._step[c]
            shifted = moved << _U(1)
            shifted[:, 1:] |= moved[:, :-1] >> _U(63)
            state = shifted | (state & self._loop[c])
            out[live] = state
            live = live[(state & ~self._fixed).any(axis=1)]
        return out

    def first_match(self, urls: list[bytes], order: list[int]) -> np.ndarray:
        """Per URL: the first glob of ``order`` that matches it whole, or -1."""
        states, found = self.states(urls), np.full(len(urls), -1)
        for g in order:
            word, bit = divmod(self.ends[g], 64)
            found[(found < 0) & (states[:, word] >> _U(bit) & _U(1)).astype(bool)] = g
        return found


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def filter_urls(
    pages: DataFrame, rules=RULES, default: str = DEFAULT, page_id: str = "page_id", url: str = "url"
) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict.

    Of the rules that fit, the longest gives the verdict (of equally long ones
    the earlier); without one, rule is null and the verdict is ``default``. A
    null URL, or one without ``://``, has an empty host and path and fits no
    rule. Rows are judged one by one, repeated ones too; other columns are not
    read, and nothing is shuffled.
    """
    ship(pages.sparkSession)
    globs = [r for _, r in rules]
    order = sorted(range(len(globs)), key=lambda g: (-len(globs[g]), g))
    kind = pages.schema[page_id].dataType.simpleString()
    rows = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rows = rows.select("page_id", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"))

    def judge(batches) -> Iterator[pd.DataFrame]:
        automaton = Automaton(globs) if globs else None
        for batch in batches:
            for i in range(0, len(batch), BATCH):
                part = batch.iloc[i : i + BATCH]
                urls = [f".{h}{p}".encode() for h, p in zip(part["host"], part["path"])]
                found = automaton.first_match(urls, order) if automaton else np.full(len(part), -1)
                yield part.assign(
                    rule=[globs[g] if g >= 0 else None for g in found],
                    verdict=[rules[g][0] if g >= 0 else default for g in found],
                )

    return rows.mapInPandas(judge, f"page_id {kind}, host string, path string, rule string, verdict string")


def op10_url_filters(spark, sf_dir) -> DataFrame:
    """The verdict on the URL of every page."""
    return filter_urls(table(spark, sf_dir, "pages"))


OP10_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u),
r(verdict, host, path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
m AS (
  SELECT h.page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
         arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM h JOIN r ON ('.' || h.host) LIKE ('%.' || r.host) AND starts_with(h.path, r.path)
  GROUP BY h.page_id)
SELECT h.page_id, h.host, h.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM h LEFT JOIN m USING (page_id)
"""
