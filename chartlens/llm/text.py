"""Words and shingles of whole texts as 64-bit numbers, in numpy.

A text is handled as UTF-8 bytes: A-Z lower-cased, words are the runs between
the bytes 0x20 and 0x09-0x0D. Long texts are hashed in segments cut at white
space, so temporary arrays stay small whatever the text's length.
"""

from __future__ import annotations

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SEGMENT = 1 << 19  # bytes hashed at once

_U = np.uint64
_BYTE = np.random.Generator(np.random.PCG64(11)).integers(1, 2**63, 256).astype(_U) | _U(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the finalizer of MurmurHash3)."""
    x = x ^ _U(seed)
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) <= n:
        _powers[:] = []
        for base in (_BASE, _INVERSE):
            steps = np.full(max(n + 1, SEGMENT + 4096), base, _U)
            steps[0] = 1
            _powers.append(np.cumprod(steps, dtype=_U))
    return _powers[0], _powers[1]


def _segment_words(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of one segment."""
    word = ~SPACE[buf]
    edge = np.diff(word.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return starts, np.empty(0, _U)
    power, inverse = _power_tables(len(buf))
    total = np.zeros(len(buf) + 1, _U)
    np.cumsum(_BYTE[buf] * power[: len(buf)], out=total[1:])
    h = (total[ends] - total[starts]) * inverse[starts]
    return starts, mix(h + (ends - starts).astype(_U))


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets and hashes of all words of ``raw`` (lower-cased here)."""
    buf = np.frombuffer(raw.translate(LOWER), np.uint8)
    if len(buf) <= SEGMENT:
        return _segment_words(buf)
    starts, hashes, at = [], [], 0
    while at < len(buf):
        end = min(at + SEGMENT, len(buf))
        while end < len(buf):  # move the cut on to white space
            near = np.flatnonzero(SPACE[buf[end : end + SEGMENT]])
            if len(near):
                end += int(near[0])
                break
            end = min(end + SEGMENT, len(buf))
        s, h = _segment_words(buf[at:end])
        starts.append(s + at)
        hashes.append(h)
        at = end
    return np.concatenate(starts), np.concatenate(hashes)


def shingles(raw: bytes, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; fewer words: one for the whole sequence."""
    w = word_hashes(raw)[1]
    if not len(w):
        return w
    n = min(k, len(w))
    x = np.full(len(w) - n + 1, n, _U)
    for i in range(n):
        x = mix(x * _U(0x9FB21C651E98DF25) + w[i : len(w) - n + 1 + i])
    x.sort()
    return x[np.concatenate([[True], x[1:] != x[:-1]])]
