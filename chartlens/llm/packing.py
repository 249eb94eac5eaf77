"""Packing tokenized texts into training sequences: vector bin packing.

A sequence has three limits at once: tokens, segments (pieces) and tokens that
bear loss. Each task encodes its own rows and packs them as they come, holding
at most ``POOL`` unplaced pieces. The sequence being filled takes, of the pieces
that fit, the one with the greatest dot product of its demands and the room
left, both as shares of the limits (the dot-product heuristic of R. Panigrahy
et al., "Heuristics for Vector Bin Packing", 2011). If none fits, the best one
is cut to the room. At a task's end the rest goes into sequences whose lengths
are powers of two, which need no padding. Nothing is shuffled, and a repeated
task repeats its result, as rows come in file order.

Encoding (``word_bpe_49k.json``). Its normalizer turns white space into single
spaces and its pre-tokenizer drops them, so no token spans a space or a line
feed, and the strings between them are encoded independently: each distinct
one once per batch, remembered up to a bound. Strings of plain letters and
punctuation go straight to the library's merges. A vocabulary file with other
steps is used on whole texts.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, ship, table
from .tokencount import tokenizer_path

MODEL = "word_bpe_49k.json"
END_ID = 1
MAX_TOKENS = 2048
MAX_SEGMENTS = 256
MAX_LOSS = 2048
POOL = 256  # pieces
BATCH_BYTES = 1 << 20
REMEMBERED = 550_000
LONGEST_REMEMBERED = 48

_loaded: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Ids of whole texts, as little-endian unsigned 32-bit numbers."""

    #: Lower-case letters, then ASCII punctuation without the apostrophe (which
    #: may begin a contraction).
    SIMPLE = re.compile(r"([a-zß-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            steps = json.load(f)
        kinds = [x["type"] for x in (steps["normalizer"] or {}).get("normalizers", [])]
        splits = [x["type"] for x in (steps["pre_tokenizer"] or {}).get("pretokenizers", [])]
        #: whether the steps are those that make words independent
        self.by_words = kinds == ["NFC", "Replace", "Lowercase"] and splits == ["Split", "ByteLevel"]
        self.known: dict[str, bytes] = {"": b""}
        self.runs: dict[str, bytes] = {"": b""}  # lower-case letters, punctuation
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        rest = [b for b in range(256) if b not in keep]
        self.letters = {b: 256 + i for i, b in enumerate(rest)}

    def _encode(self, strings: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _run(self, run: str) -> bytes:
        """A lower-case run of letters: one pre-token, straight to the merges."""
        form = run if run.isascii() else run.encode().decode("latin-1").translate(self.letters)
        found = self.model.tokenize(form)
        ids = self.runs[run] = struct.pack(f"<{len(found)}I", *[t.id for t in found])
        return ids

    def _new(self, strings: list[str]) -> dict[str, bytes]:
        out, odd, match, runs = {}, [], self.SIMPLE.fullmatch, self.runs
        for w in strings:
            if len(w) <= LONGEST_REMEMBERED and (m := match(w)):
                run, tail = m.groups()
                ids = runs.get(run)
                if ids is None:
                    ids = self._run(run)
                if tail:
                    if tail not in runs:
                        runs[tail] = self._encode([tail])[0]
                    ids += runs[tail]
                out[w] = ids
            else:
                odd.append(w)
        out.update(zip(odd, self._encode(odd)))
        return out

    @staticmethod
    def _units(text: str) -> list[str]:
        """Strings that are encoded by themselves; lower-cased where that changes nothing."""
        if "<|" not in text:  # else it might become a special string
            try:
                text.encode("latin-1")
                text = text.lower()
            except UnicodeEncodeError:
                pass
        return text.replace("\n", " ").split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_words:
            return self._encode(texts)
        units = [self._units(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known = {"": b""}
        if len(self.runs) > REMEMBERED:
            self.runs = {"": b""}
        missing: set[str] = set()
        for u in units:  # most strings are known: looked up, not gathered
            missing.update(filterfalse(self.known.__contains__, u))
        fresh = self._new(list(missing))
        short = {w: x for w, x in fresh.items() if len(w) <= LONGEST_REMEMBERED}
        self.known.update(short)
        known = self.known
        if len(short) == len(fresh):
            get = known.__getitem__
        else:
            get = lambda w: known[w] if w in known else fresh[w]
        return [b"".join(map(get, u)) for u in units]


def _encoder(path: str) -> WordEncoder:
    if path not in _loaded:
        _loaded[path] = WordEncoder(path)
    return _loaded[path]


class Packer:
    """Fills sequences from a bounded pool of pieces.

    A piece is (doc_id, start, ids, prompt, doc_tokens): ``ids`` the bytes of its ids
    and ``prompt`` the number of the document's first ids that bear no loss.
    """

    def __init__(self, first: int, max_tokens=MAX_TOKENS, max_segments=MAX_SEGMENTS, max_loss=MAX_LOSS, pool=POOL):
        if min(max_tokens, max_segments, max_loss, pool) < 1:
            raise ValueError("limits must be at least 1")
        self.limits = np.array([max_tokens, max_segments, max_loss], float)
        self.pool_size, self.next = pool, first
        self.pieces: list[tuple | None] = [None] * (pool + 1)
        self.free = list(range(pool + 1))
        self.demand = np.zeros((pool + 1, 3))  # a free place demands nothing
        self.out: list[tuple] = []

    def _put(self, doc_id, start, ids, prompt, total) -> None:
        at = self.free.pop()
        n = len(ids) // 4
        self.pieces[at] = (doc_id, start, ids, prompt, total)
        self.demand[at] = n, 1, n - min(max(prompt - start, 0), n)

    def _take(self, at: int) -> tuple:
        piece = self.pieces[at]
        self.pieces[at] = None
        self.demand[at] = 0
        self.free.append(at)
        return piece

    def _fill(self, tokens: float) -> None:
        """One sequence of at most ``tokens`` tokens."""
        room = self.limits.copy()
        room[0] = tokens
        offset = 0
        while room.min() >= 1 and self.demand[:, 1].any():
            score = (self.demand / self.limits) @ (room / self.limits)
            fits = (self.demand[:, 1] > 0) & (self.demand <= room).all(axis=1)
            if fits.any():
                at = int(np.where(fits, score, -1).argmax())
                doc_id, start, ids, prompt, total = self._take(at)
            else:
                at = int(np.where(self.demand[:, 1] > 0, score, -1).argmax())
                doc_id, start, ids, prompt, total = self._take(at)
                bare = max(prompt - start, 0)
                n = int(min(room[0], bare + room[2]))
                self._put(doc_id, start + n, ids[4 * n :], prompt, total)
                ids = ids[: 4 * n]
            n = len(ids) // 4
            loss = n - min(max(prompt - start, 0), n)
            self.out.append((doc_id, start, n, loss, ids, total, self.next, offset))
            offset += n
            room -= n, 1, loss
        # a limit on loss below one token's still lets bare tokens in; here every limit is spent
        self.next += 1

    def add(self, doc_id, ids: bytes, prompt: int) -> None:
        """A whole document."""
        total = len(ids) // 4
        self._put(doc_id, 0, ids, prompt, total)
        while len(self.free) < 2 or self.demand[:, 0].max() >= self.limits[0]:
            self._fill(self.limits[0])

    def finish(self) -> None:
        """Places what is left; the last lengths are powers of two."""
        while (left := int(self.demand[:, 0].sum())) > 0:
            whole = left >= self.limits[0]
            self._fill(self.limits[0] if whole else 1 << (left.bit_length() - 1))

    def rows(self) -> pd.DataFrame:
        names = ["id", "start", "length", "loss", "ids", "doc_tokens", "sequence_id", "offset"]
        frame = pd.DataFrame(self.out, columns=names)
        self.out = []
        return frame


def _packed(batches, model: str, end_id: int, limits: dict) -> Iterator[pd.DataFrame]:
    encoder = _encoder(tokenizer_path(model))
    end = np.array([end_id], "<u4").tobytes()
    packer = Packer(TaskContext.get().partitionId() << 40, **limits)
    for batch in batches:
        texts = [t if isinstance(t, str) else "" for t in batch["text"]]
        prompts = [t if isinstance(t, str) else "" for t in batch["prompt"]]
        sizes = [len(t) + len(p) for t, p in zip(texts, prompts)]
        keys = list(batch["id"])
        for a, b in by_bytes(sizes, BATCH_BYTES):
            heads = encoder.encode(prompts[a:b]) if any(prompts[a:b]) else [b""] * (b - a)
            for key, head, ids in zip(keys[a:b], heads, encoder.encode(texts[a:b])):
                packer.add(key, head + ids + end, len(head) // 4)
                if len(packer.out) >= 2048:
                    yield packer.rows()
    packer.finish()
    yield packer.rows()


def pack(
    docs: DataFrame,
    model: str = MODEL,
    end_id: int = END_ID,
    max_tokens: int = MAX_TOKENS,
    max_segments: int = MAX_SEGMENTS,
    max_loss: int = MAX_LOSS,
    doc_id: str = "doc_id",
    text: str = "text",
    prompt: str | None = None,
) -> DataFrame:
    """Texts as pieces of packed sequences.

    Rows: doc_id, start (ids of the document before the piece), length, loss
    (ids that bear loss), ids (binary, little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset in the sequence. A document is the ids of
    ``prompt`` (a column whose ids bear no loss; none by default), the ids of
    ``text``, and ``end_id``. Sequence ids are unique, not consecutive.

    Null and empty texts are the end id alone. Repeated rows and ids are
    packed one by one; a null id stays null. Empty tables give no rows. Other
    columns are not read. A sequence ends short of ``max_tokens`` only at
    another limit or among a task's last powers of two.
    """
    ship(docs.sparkSession)
    limits = {"max_tokens": max_tokens, "max_segments": max_segments, "max_loss": max_loss}
    head = F.col(prompt) if prompt else F.lit(None).cast("string")
    rows = docs.select(F.col(doc_id).cast("string").alias("id"), head.alias("prompt"), F.col(text).alias("text"))
    schema = "id string, start long, length long, loss long, ids binary, doc_tokens long, sequence_id long, offset long"
    out = rows.mapInPandas(lambda b: _packed(b, model, end_id, limits), schema)
    kind = docs.schema[doc_id].dataType
    return out.select(F.col("id").cast(kind).alias("doc_id"), *out.columns[1:])


def op6_packing(spark, sf_dir) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    rows = pack(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "loss"
    )
