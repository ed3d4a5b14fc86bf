"""Repeated passages: suffix buckets refined by the bucket pointers of later offsets."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash
from .hashing import _BYTE, _powers, mix64

#: Bytes of the initial buckets.
Q = 16
#: Rows that are combined in a task before they are shuffled, and bytes of text that are hashed at once.
CHUNK, BATCH_BYTES = 1_000_000, 1 << 17
#: Strings must be so much longer than ``Q`` at most: offsets within a run are kept in 16 bits.
MOST_LENGTH = 1 << 15
_LATER = mix64(np.arange(11, 15, dtype=np.uint64)) | np.uint64(1)
_WHOLE = np.uint64(0xFFFF)
_U16, _U32 = np.uint64(16), np.uint64(32)


def initial_buckets(data: np.ndarray) -> np.ndarray:
    """Bucket pointer of the ``Q`` bytes at every offset: their 64-bit hash."""
    n = len(data)
    if n < Q:
        return np.zeros(0, dtype=np.uint64)
    power, inverse = _powers(1 << max(n.bit_length(), 16))
    with np.errstate(over="ignore"):
        prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data] * power[:n], out=prefix[1:])
        return mix64((prefix[Q:] - prefix[:-Q]) * inverse[: n - Q + 1])


def refined(pointer: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Pointers of the ``length``-byte strings at ``at``.

    A bucket of the first d bytes is refined by the pointer at offset d, the last one overlapping,
    so every pointer once made serves all strings it is part of. Strings with one pointer are equal,
    but for a collision of 64-bit hashes.
    """
    out = pointer[at]
    with np.errstate(over="ignore"):
        for k, step in enumerate([*range(Q, length - Q, Q), length - Q] if length > Q else []):
            out = out * _LATER[k % 4] + pointer[at + step]
    return out


def suffix_runs(pointer: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last offset of each run of strings that share their representative, and its offset.

    ``bounds`` are the limits of the texts that stand one after another; no string crosses one. The
    representative of a ``length``-byte string is its leftmost least initial bucket, so equal
    strings have equal ones and the strings of one representative stand side by side.
    """
    width = length - Q + 1
    if len(pointer) < width:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    low = (pointer & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(pointer), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if width > span:
        low = np.minimum(low[: span - width], low[width - span :])
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.arange(len(at)) + length <= np.repeat(bounds[1:], np.diff(bounds))[: len(at)]
    turn = at[1:] != at[:-1]
    first = np.flatnonzero(inside & np.concatenate(([True], turn | ~inside[:-1])))
    last = np.flatnonzero(inside & np.concatenate((turn | ~inside[1:], [True])))
    return first, last, at[first]


def run_keys(pointer: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    """Pointer of all bytes of each run: of its first and last string and their distance."""
    with np.errstate(over="ignore"):
        return mix64(refined(pointer, first, length) * _LATER[2] + refined(pointer, last, length) * _LATER[3] + (last - first).astype(np.uint64))


def side_marks(pointer: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, length: int) -> np.ndarray:
    """Two 16-bit marks per representative, in the low 32 bits: of the ``half`` bytes before it and of those after it.

    A ``length``-byte string around a representative has at least ``half`` = (length - Q) // 2 bytes of it on
    one side, so two equal strings imply equal bytes there, one level between the initial bucket and the whole
    string. ``low`` and ``high`` limit the representative's text.
    """
    half = (length - Q) // 2
    if half < Q:
        return np.zeros(len(at), dtype=np.uint64)

    def mark(start: np.ndarray) -> np.ndarray:
        inside = (start >= low) & (start + half <= high)
        return np.where(inside, refined(pointer, np.where(inside, start, 0), half) >> np.uint64(48), np.uint64(0))

    return (mark(at - half) << _U16) | mark(at + Q)


def shared_sides(bucket: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """Bit 1 for rows whose mark before is that of another row of their bucket, bit 2 for the mark after."""
    out = np.zeros(len(bucket), dtype=np.int8)
    for bit, mark in ((1, sides >> np.uint64(48)), (2, (sides >> _U32) & _WHOLE)):
        order = np.lexsort((mark, bucket))
        b, m = bucket[order], mark[order]
        same = (b[1:] == b[:-1]) & (m[1:] == m[:-1])
        twin = np.zeros(len(b), dtype=bool)
        twin[1:] |= same
        twin[:-1] |= same
        out[order[twin]] |= bit
    return out


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of texts one after another and the offsets of their limits; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data or b"", dtype=np.uint8), bounds


def text_groups(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``BATCH_BYTES`` each; a longer text is one of its own."""
    start, n = 0, len(bounds) - 1
    while start < n:
        end = max(start + 1, min(n, int(np.searchsorted(bounds, bounds[start] + BATCH_BYTES))))
        yield start, end
        start = end


def packed(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Two numbers of 32 bits in one."""
    return (high.astype(np.int64) << 32) | low.astype(np.int64)


def later_holders(rows: DataFrame, length: int) -> DataFrame:
    """Refine buckets: ``doc_id, mark, span, found`` of ``rows(bucket, key, doc_id, mark, cover, sides)``.

    With ``found`` 0, ``span`` is the cover (start, length) of a key in a document when a smaller one holds that key too.
    With 1, it is where (start, number) the strings stand, in a smallest holder of one of several keys of a bucket, that
    another key may have as well: on the sides whose marks it shares. Rows without ``sides`` were found later where they
    were made, and pass. Documents are sorted within keys and keys within buckets; one pass reads them with the last key
    and its smallest holder as state, and takes both sides of a bucket that runs on into another batch as shared.
    """
    half = (length - Q) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: tuple[int, int, int] | None = None
        for batch in batches:
            b, k, d, mark, cover, sides = (batch.column(j).to_numpy() for j in range(6))
            here = np.flatnonzero(sides)
            out = [[x[sides == 0] for x in (d, mark, cover)] + [np.zeros(len(b) - len(here), dtype=np.int8)]]
            if len(here):
                b, k, d, mark, cover = (x[here] for x in (b, k, d, mark, cover))
                sides = sides[here].view(np.uint64)
                turn = np.concatenate(([True], b[1:] != b[:-1]))
                new = turn | np.concatenate(([True], k[1:] != k[:-1]))
                start, run_of = np.flatnonzero(new), np.cumsum(new) - 1
                least = d[start]
                edge = b == b[-1]
                if state and state[0] == b[0]:
                    edge |= b == b[0]
                    if state[1] == k[0]:
                        least[0] = state[2]
                state = int(b[-1]), int(k[-1]), int(least[-1])
                later = d != least[run_of]
                bucket_of = (np.cumsum(turn) - 1)[start]
                several = (np.bincount(bucket_of) > 1)[bucket_of]
                flags = np.zeros(len(start), dtype=np.int8)
                flags[several] = shared_sides(b[start[several]], sides[start[several]])
                flags = np.where(edge, 3, flags[run_of])
                hold = np.flatnonzero(~later & (flags > 0))
                flags, first, far = flags[hold], cover[hold] >> 32, (sides[hold] & _WHOLE).astype(np.int64)
                at = first + ((sides[hold] >> _U16) & _WHOLE).astype(np.int64)
                last = np.where(far == int(_WHOLE), first + (cover[hold] & 0xFFFFFFFF) - length, first + far - 1)
                flags = np.where(far == int(_WHOLE), 3, flags)
                low = np.where(flags & 1, first, np.maximum(first, at - half + 1))
                n = np.where(flags & 2, last, np.minimum(last, at - half)) - low + 1
                hold, low, n = hold[n > 0], low[n > 0], n[n > 0]
                out.append([x[later] for x in (d, mark, cover)] + [np.zeros(int(later.sum()), dtype=np.int8)])
                out.append([d[hold], mark[hold], packed(low, n), np.ones(len(hold), dtype=np.int8)])
            columns = [np.concatenate(x) for x in zip(*out, strict=True)]
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["doc_id", "mark", "span", "found"])

    route = F.when(F.col("sides") == 0, F.xxhash64("doc_id")).otherwise(F.col("bucket"))
    dealt = rows.repartition(route).sortWithinPartitions("bucket", "key", "doc_id")
    return dealt.mapInArrow(run, "doc_id bigint, mark bigint, span bigint, found tinyint")


def combined(bucket, key, doc, mark, first, size, sides) -> pa.RecordBatch:
    """Rows of a task by bucket, key and document; those of other documents than a key's smallest get no ``sides``.

    Places of one key in one document that overlap are one cover, as in a text that repeats a short period.
    """
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    twin = np.zeros(len(b) + 1, dtype=bool)
    np.equal(b[1:], b[:-1], out=twin[1:-1])
    many = np.flatnonzero(twin[1:] | twin[:-1])
    part = order[many]
    order[many] = part[np.lexsort((first[part], doc[part], key[part], bucket[part]))]
    k, d, m, at, sides = (x[order] for x in (key, doc, mark, first, sides))
    end = at + size[order]
    new = np.ones(len(b), dtype=bool)
    new[1:] = ~twin[1:-1] | (k[1:] != k[:-1])
    least = d[np.flatnonzero(new)][np.cumsum(new) - 1]
    apart = new.copy()
    apart[1:] |= (d[1:] != d[:-1]) | (m[1:] != m[:-1]) | (at[1:] > end[:-1])
    keep = np.flatnonzero(apart)
    stop = np.append(keep[1:], len(b))
    sides = sides[keep]
    sides[stop - keep > 1] |= _WHOLE
    sides[d[keep] != least[keep]] = 0
    return pa.RecordBatch.from_arrays(
        [
            pa.array(b[keep].view(np.int64)), pa.array(k[keep].view(np.int64)), pa.array(d[keep]), pa.array(m[keep]),
            pa.array(packed(at[keep], end[stop - 1] - at[keep])), pa.array(sides.view(np.int64)),
        ],
        names=["bucket", "key", "doc_id", "mark", "cover", "sides"],
    )


def bucket_rows(docs: DataFrame, make: Callable[..., tuple]) -> DataFrame:
    """``bucket, key, doc_id, mark, cover, sides`` of ``docs(doc_id, mark, text, ...)``, combined per chunk of rows.

    ``make(data, bounds, first text, *other columns)`` gives, for texts that stand one after another, per row the number of its text, bucket,
    key, offset in the text, covered bytes and sides.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        n = 0
        for batch in batches:
            data, bounds = text_bytes(batch.column(2))
            ids, marks = (batch.column(j).to_numpy() for j in range(2))
            for low, high in text_groups(bounds):
                text, *row = make(data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low], low, *batch.columns[3:])
                if len(text):
                    held.append((row[0], row[1], ids[low + text], marks[low + text], *row[2:]))
                    n += len(text)
                    if n >= CHUNK:
                        yield combined(*map(np.concatenate, zip(*held, strict=True)))
                        held, n = [], 0
        if held:
            yield combined(*map(np.concatenate, zip(*held, strict=True)))

    return docs.mapInArrow(run, "bucket bigint, key bigint, doc_id bigint, mark bigint, cover bigint, sides bigint")


def remove_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """Cut from every text of ``docs(doc_id, text, ...)`` the bytes that stand in an earlier document too.

    Returns per row ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans``: a byte goes if a
    ``length``-byte string that covers it also starts in a document of a smaller id; ``spans`` lists the
    removed ranges ``start, end`` in bytes. Overlapping strings count and all are judged on the input.

    Round one: each ``length``-byte string is represented by its least ``Q``-byte bucket, so strings that
    are equal meet in one bucket, and neighbouring strings share theirs as a run. The bucket is
    refined by the pointers of later offsets to the run's whole content: documents that hold a run
    after its smallest holder lose all its strings. Round two: where a bucket holds several
    runs, the smallest holder of each has its strings refined to their full length one by one, on the sides of the
    bucket that another run shares, and those that a smaller document has too go. Rows carry their places, so texts
    are hashed in these rounds and not for the cut. Pointers are content hashes, so no global ranking is
    needed; a task forwards few rows per bucket, key and chunk of its input, so a passage in a third of
    all documents makes no large group. Strings count as equal if both the 64-bit bucket and the 64-bit key that
    refines it to the whole content agree; their bytes are not compared.

    A null text counts as empty. Rows of a null id neither lose bytes nor cost others any; rows of one id are one
    document. Texts under ``length`` bytes stay. Extra columns are ignored; an empty table
    gives an empty result.
    """
    if not Q <= length <= MOST_LENGTH:
        raise ValueError(f"strings must have {Q} to {MOST_LENGTH} bytes")
    # Places belong to a text: where ids repeat, rows are told apart by a hash of the text as well.
    repeated = not docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty()
    mark = F.coalesce(F.xxhash64("text"), F.lit(0)) if repeated else F.lit(0).cast("long")
    numbered = docs.where("doc_id IS NOT NULL").select("doc_id", mark.alias("mark"), "text")

    def runs(data: np.ndarray, bounds: np.ndarray, _: int) -> tuple:
        pointer = initial_buckets(data)
        first, last, at = suffix_runs(pointer, bounds, length)
        text = np.searchsorted(bounds, first, side="right") - 1
        sides = side_marks(pointer, at, bounds[text], bounds[text + 1], length) << _U32
        sides |= ((at - first) << 16 | (last - first + 1)).astype(np.uint64)
        return text, pointer[at], run_keys(pointer, first, last, length) if len(first) else pointer[at], first - bounds[text], last - first + length, sides

    judged = later_holders(bucket_rows(numbered, runs), length)
    spans = lambda n: F.collect_list(F.when(F.col("found") == n, F.col("span")))
    lists = stash(
        judged.groupBy(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")).agg(spans(0).alias("later"), spans(1).alias("split")), "suffix_runs"
    )
    own = (F.col("doc_id") == F.col("__id")) & (F.col("mark") == F.col("__mark"))

    def strings(data: np.ndarray, bounds: np.ndarray, low: int, split: pa.Array) -> tuple:
        """Pointers of the strings at the places that other runs may share."""
        listed = split.slice(low, len(bounds) - 1)
        text, span = np.repeat(np.arange(len(listed)), listed.value_lengths().to_numpy()), listed.flatten().to_numpy()
        n = span & 0xFFFFFFFF
        text, place = np.repeat(text, n), np.repeat((span >> 32) - np.cumsum(n) + n, n) + np.arange(n.sum())
        bucket = refined(initial_buckets(data), place + bounds[text], length)
        rest = np.ones(len(place), dtype=np.uint64)
        return text, bucket, np.zeros(len(place), dtype=np.uint64), place, np.full(len(place), length), rest

    more = lists.where("size(split) > 0").select("__id", "__mark", "split")
    texts = numbered.join(more, own).select("doc_id", "mark", "text", "split")
    found = later_holders(bucket_rows(texts, strings), length).where("found = 0")
    single = stash(
        found.groupBy(F.col("doc_id").alias("__doc"), F.col("mark").alias("__text")).agg(F.collect_list("span").alias("strings")), "suffix_strings"
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            limits = bounds.tolist()
            places = [(c.value_lengths().fill_null(0).to_numpy(), c.flatten().to_numpy()) for c in batch.columns[2:]]
            ends = [np.cumsum(n) for n, _ in places]
            out = []
            for k in range(batch.num_rows):
                covers = np.concatenate([v[e[k] - n[k] : e[k]] for (n, v), e in zip(places, ends, strict=True)])
                out.append(cut(data[limits[k] : limits[k + 1]], covers))
            made = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), CUT_TYPES, strict=True)] if out else []
            if made:
                yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    joined = (
        docs.select("doc_id", mark.alias("mark"), "text")
        .join(lists.where(F.size("later") > 0).select("__id", "__mark", "later"), own, "left")
        .join(single, (F.col("doc_id") == F.col("__doc")) & (F.col("mark") == F.col("__text")), "left")
        .select("doc_id", "text", "later", "strings")
    )
    return joined.mapInArrow(rows, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<array<bigint>>")


CUT_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())))


def cut(data: np.ndarray, covers: np.ndarray) -> tuple[int, int, int, str, list[list[int]]]:
    """Bytes, removed bytes, spans, digest of the rest, and the spans, of packed covers (start, length)."""
    if not len(covers):
        return len(data), 0, 0, hashlib.sha256(data).hexdigest(), []
    covers = np.sort(covers)
    start = covers >> 32
    end = np.maximum.accumulate(start + (covers & 0xFFFFFFFF))
    new = np.flatnonzero(np.concatenate(([True], start[1:] > end[:-1])))
    spans = np.stack((start[new], np.append(end[new[1:] - 1], end[-1])), axis=1).tolist()
    digest, at = hashlib.sha256(), 0
    for low, high in spans:
        digest.update(data[at:low])
        at = high
    digest.update(data[at:])
    return len(data), sum(high - low for low, high in spans), len(spans), digest.hexdigest(), spans
