"""Token counts of whole texts, encoded in batches inside Arrow functions.

Only lengths leave the Python workers. Texts are taken in batches of about
``BATCH_BYTES`` bytes, so a batch's memory does not depend on how many texts
happen to be long, and a long text is cut where no merge can cross.

Safe boundaries (sentencepiece BPE with a dummy prefix, as in
``piece_bpe_32k.model``). A space becomes the mark U+2581. When no piece has
the mark after another character, no merge crosses the border between a
character other than the mark and a mark, so the text before a single space
and the text after it are encoded independently; the dummy prefix of the second
takes the space's place. When no piece holds a line feed, it is a token of its
own and separates in the same way. Both conditions are read from the model
when it is loaded; a model that does not meet them is used on whole texts.
Between safe boundaries the same strings occur again and again, so each
distinct one is encoded once per batch and remembered up to a bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, ship, table

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
BATCH_BYTES = 1 << 20
CHUNK_CHARS = 1 << 16
REMEMBERED = 300_000  # strings
LONGEST_REMEMBERED = 48  # characters

MARK = "▁"
_loaded: dict[str, "PieceCounter"] = {}


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary file is on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceCounter:
    """Numbers of sentencepiece tokens, without begin or end tokens."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [
            self.model.id_to_piece(i)
            for i in range(self.model.get_piece_size())
            if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))
        ]
        prefix = self.model.encode("a b", out_type=str) == self.model.encode("a", out_type=str) + self.model.encode("b", out_type=str)
        spaces = self.model.encode("a  ", out_type=str) != self.model.encode("a", out_type=str)
        self.safe_space = prefix and spaces and not any(MARK in p.lstrip(MARK) for p in normal)
        self.safe_line = self.safe_space and not any("\n" in p for p in normal)
        self.known: dict[str, int] = {}

    def _encode(self, strings: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode(strings, num_threads=1)]

    def chunks(self, text: str) -> list[str]:
        """Pieces of a long text whose counts add up to its own."""
        out, start = [], 0
        while self.safe_space and len(text) - start > CHUNK_CHARS:
            at = start + CHUNK_CHARS
            while True:
                at = text.find(" ", at)
                if at < 0 or at + 1 >= len(text):
                    at = -1
                    break
                if text[at - 1] not in (" ", MARK) and text[at + 1] not in (" ", MARK):
                    break
                at += 1
            if at < 0:
                break
            out.append(text[start:at])
            start = at + 1
        out.append(text[start:])
        return out

    def _plain(self, texts: list[str]) -> list[int]:
        parts = [self.chunks(t) for t in texts]
        counts = iter(self._encode([c for p in parts for c in p]))
        return [sum(next(counts) for _ in p) for p in parts]

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        if not self.safe_line:
            return self._plain(texts)
        units: list[list[str] | None] = []
        for t in texts:
            s = t.replace("\n", " \n")
            odd = not s or s[0] == " " or s[-1] == " " or "  " in s or MARK in s
            units.append(None if odd else s.split(" "))
        plain = [t for t, u in zip(texts, units) if u is None]
        odd_counts = iter(self._plain(plain)) if plain else iter(())
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list(set().union(*(u for u in units if u)) - self.known.keys())
        # a string that begins with a line feed has no dummy prefix in its text
        counts = {w: n - (w[0] == "\n") for w, n in zip(new, self._encode(new))}
        short = {w: n for w, n in counts.items() if len(w) <= LONGEST_REMEMBERED}
        self.known.update(short)
        if len(short) == len(counts):
            get = self.known.__getitem__
        else:
            both = {**self.known, **counts} if len(counts) * 8 > len(self.known) else None
            get = both.__getitem__ if both else lambda w: counts[w] if w in counts else self.known[w]
        return [next(odd_counts) if u is None else sum(map(get, u)) for u in units]


def _counter(path: str) -> PieceCounter:
    if path not in _loaded:
        _loaded[path] = PieceCounter(path)
    return _loaded[path]


def _count_rows(batches, model: str) -> Iterator[pd.DataFrame]:
    counter = _counter(tokenizer_path(model))
    for batch in batches:
        texts = [t if isinstance(t, str) else "" for t in batch["text"]]
        sizes = [len(t.encode()) for t in texts]
        tokens: list[int] = []
        for a, b in by_bytes(sizes, BATCH_BYTES):
            tokens += counter.count(texts[a:b])
        yield pd.DataFrame({"id": batch["id"], "n_bytes": sizes, "n_tokens": tokens})


def count_tokens(
    docs: DataFrame, model: str = MODEL, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Null and empty texts have 0 bytes and 0 tokens. One row per input row,
    repeated and null ids included; other columns are not read. No shuffle:
    each task counts its own rows.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long"
    out = rows.mapInPandas(lambda b: _count_rows(b, model), schema)
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op5_token_counts(spark, sf_dir) -> DataFrame:
    """Tokens of every whole document for piece_bpe_32k.model."""
    return count_tokens(table(spark, sf_dir, "documents"))
