"""Words of Arrow arrays of texts as numpy arrays, without a Python step per word."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: What a byte is: part of a word, a gap between words, or the end of a piece as well.
PART, GAP, END = 0, 1, 2


def byte_classes(gaps: str, ends: str = "") -> np.ndarray:
    out = np.full(256, PART, np.uint8)
    out[[ord(c) for c in gaps]] = GAP
    out[[ord(c) for c in ends]] = END
    return out


@dataclass
class Words:
    """Words of several texts in order: ``codes`` into ``names``, the ``text`` each is of, and its ``piece`` of a text."""

    codes: np.ndarray
    names: pa.Array
    text: np.ndarray
    piece: np.ndarray
    lengths: np.ndarray


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts one after the other and the offsets of each; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(texts: pa.Array, classes: np.ndarray, lower: bool = False) -> Words:
    """The words of ``texts``; with ``lower`` A-Z become a-z. No word or piece crosses from one text to the next."""
    data, offsets = text_bytes(texts)
    if lower:
        table = np.arange(256, dtype=np.uint8)
        table[65:91] += 32
        data = table[data]
    kind = classes[data]
    part = kind == PART
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    first, last = part.copy(), part.copy()
    first[1:] &= ~part[:-1]
    first[heads] = part[heads]
    last[:-1] &= ~part[1:]
    last[heads[1:] - 1] = part[heads[1:] - 1]
    starts = np.flatnonzero(first)
    lengths = np.flatnonzero(last) - starts + 1
    breaks = kind == END
    breaks[heads] = True
    piece = np.searchsorted(np.flatnonzero(breaks), starts, side="right")
    del first, last, breaks, kind
    packed = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(np.append(0, np.cumsum(lengths)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[part]))
    )
    coded = packed.dictionary_encode()
    text = np.searchsorted(offsets, starts, side="right") - 1
    return Words(coded.indices.to_numpy().astype(np.int64), coded.dictionary, text, piece, lengths)


def mixed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers stirred so that all bits depend on all."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def name_hashes(names: pa.Array) -> np.ndarray:
    """A 64-bit hash per name from its bytes alone, the same in all tasks. Only filters rest on it."""
    data, offsets = text_bytes(names)
    if not len(names):
        return np.zeros(0, np.uint64)
    sizes = np.diff(offsets)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], sizes)
    powers = np.cumprod(np.full(int(sizes.max(initial=0)) + 1, 0x9E3779B97F4A7C15, np.uint64))
    sums = np.append(np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[place]))
    return mixed(sums[offsets[1:]] - sums[offsets[:-1]])
