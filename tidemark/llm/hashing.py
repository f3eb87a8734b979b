"""64-bit hashes in numpy that are the same in every process: of words, and of runs of words."""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)  # 2^64 divided by the golden ratio, made odd


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit (multiply and shift, twice)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def seeded(x: np.ndarray, seed: int) -> np.ndarray:
    return mix(x + np.uint64((seed * int(_ODD)) & 0xFFFFFFFFFFFFFFFF))


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in [0, 1)."""
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_POWERS = np.cumprod(np.full(1 << 12, _ODD))


def _powers(count: int) -> np.ndarray:
    return _POWERS if count <= len(_POWERS) else np.cumprod(np.full(count, _ODD))


def hash_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each (non-empty, ascending, disjoint) span of bytes."""
    if not len(starts):
        return np.empty(0, np.uint64)
    ends = np.cumsum(lengths)
    within = np.arange(int(ends[-1])) - np.repeat(ends - lengths, lengths)
    values = _BYTE[data[np.repeat(starts, lengths) + within]] * _powers(int(lengths.max()))[within]
    return mix(np.add.reduceat(values, ends - lengths) + lengths.astype(np.uint64))


def hash_words(words: list[bytes]) -> np.ndarray:
    if not words:
        return np.empty(0, np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8)
    return hash_spans(data, np.cumsum(lengths) - lengths, lengths)


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of bytes other than spaces."""
    word = np.concatenate([[False], data != 0x20, [False]])
    edges = np.flatnonzero(word[1:] != word[:-1])
    return edges[::2], edges[1::2] - edges[::2]


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words; a shorter, non-empty text is one run."""
    if not len(words):
        return words
    width = min(size, len(words))
    count = len(words) - width + 1
    total = np.full(count, np.uint64(width))
    for i in range(width):
        total = total * _ODD + words[i : i + count]
    return mix(total)
