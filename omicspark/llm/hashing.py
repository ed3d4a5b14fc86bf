"""Hashes of words, shingles and sets, vectorised over the bytes of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: Bytes of text that are hashed at once; a longer text is a batch of its own.
BATCH_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2 ** 64


def mix64(x: np.ndarray) -> np.ndarray:
    """Well-mixed 64-bit values of 64-bit values (a public finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, ``n`` of each."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(n, base, dtype=np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def batches(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``BATCH_BYTES`` characters each."""
    start = size = 0
    for k, t in enumerate(texts):
        size += len(t or "")
        if size >= BATCH_BYTES:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def shingle_sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its ``width``-word shingles.

    Words are runs of anything but the six ASCII blanks, A-Z in lower case. A text of fewer words
    is one shingle; one without words, or null, has none.
    """
    for start, end in batches(texts):
        yield from _shingle_sets(texts[start:end], width)


def _shingle_sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raw])
    power, inverse = _powers(1 << max(int(len(data)).bit_length(), 16))
    with np.errstate(over="ignore"):
        prefix = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[_LOWER[data]] * power[: len(data)], out=prefix[1:])
        edge = np.diff(np.concatenate(([True], _BLANK[data], [True])).astype(np.int8))
        first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        words = mix64((prefix[last] - prefix[first]) * inverse[first])
        cuts = np.searchsorted(first, np.concatenate(([0], ends)))
        factors = mix64(np.arange(7, 7 + width, dtype=np.uint64)) | np.uint64(1)
        many = max(0, len(words) - width + 1)
        grams = np.zeros(many, dtype=np.uint64)
        for k in range(width):
            grams += words[k : k + many] * factors[k]
        grams = mix64(grams)
        for k in range(len(raw)):
            low, high = cuts[k], cuts[k + 1]
            if high - low >= width:
                yield np.unique(grams[low : high - width + 1])
            elif high > low:
                part = words[low:high] * factors[: high - low]
                yield mix64(np.array([part.sum(dtype=np.uint64) + np.uint64(high - low)], dtype=np.uint64))
            else:
                yield grams[:0]


def set_proof(hashes: np.ndarray) -> int:
    """Another signed 64-bit hash of a set, independent of ``set_key``."""
    with np.errstate(over="ignore"):
        return int(np.bitwise_xor.reduce(mix64(hashes * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0x632BE59BD9B4E019)), initial=np.uint64(0)).view(np.int64))


def set_key(hashes: np.ndarray) -> int:
    """Signed 64-bit key of a set; equal sets have equal keys."""
    with np.errstate(over="ignore"):
        total = mix64(hashes ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(hashes))
    return int(mix64(np.array([total], dtype=np.uint64)).view(np.int64)[0])
