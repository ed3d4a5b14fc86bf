"""Quality scores by kernel ridge regression on random Fourier features of document statistics, calibrated by isotonic regression."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stash
from .word_arrays import byte_classes, text_bytes, words_of

CLASSES = byte_classes(" \t\n\x0b\x0c\r")
SYMBOLS, STOPS, CALLS, DIGITS = "#*$%&|<>", ".,;:", "!?", "0123456789"
#: What is known of a text; all but the first two are shares.
STATISTICS = (
    "words", "length", "word_length", "upper", "digits", "symbols", "stops", "calls", "blanks", "wide", "different",
    "commonest", "again", "triples", "lines", "single", "decorated", "capital",
)
#: Features are cosines in steps of 1 / STEPS, so that sums of products are whole numbers and do not depend on their order.
STEPS = 1024
FOLDS, BINS = 5, 2048
BATCH = 4 << 20


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of ``STATISTICS`` for every whole text; null counts as empty."""
    data, offsets = text_bytes(texts)
    n = len(offsets) - 1
    words = words_of(texts, CLASSES)
    of, codes, lengths = words.text, words.codes, words.lengths
    per_text = lambda at, k=n: np.bincount(at, minlength=k)[:k].astype(float)
    n_words = per_text(of)

    def bytes_in(table: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(table[data], dtype=np.int64))
        return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)

    def among(chars: str) -> np.ndarray:
        table = np.zeros(256, bool)
        table[[ord(c) for c in chars]] = True
        return table

    whole = np.arange(256)
    upper, lower = (whole >= 65) & (whole <= 90), (whole >= 97) & (whole <= 122)
    size = bytes_in((whole < 128) | (whole >= 192))  # code points
    share = lambda x, y: x / np.maximum(y, 1)
    pairs, times = np.unique(of * max(len(words.names), 1) + codes, return_counts=True)
    pair_text = pairs // max(len(words.names), 1)
    commonest = np.zeros(n)
    np.maximum.at(commonest, pair_text, times)
    same = (codes[1:] == codes[:-1]) & (of[1:] == of[:-1])
    inner = of[2:] == of[:-2]
    triple_of = of[2:][inner]
    names = np.unique(codes[:-1] * max(len(words.names), 1) + codes[1:], return_inverse=True)[1] if len(codes) > 1 else codes[:0]
    triples = (names[:-1] * max(len(words.names), 1) + codes[2:])[inner]
    order = np.lexsort((triples, triple_of))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (np.diff(triples[order]) != 0) | (np.diff(triple_of[order]) != 0)
    lines = words_of(texts, byte_classes("", "\n"))
    line_pairs = np.unique(lines.text * max(len(lines.names), 1) + lines.codes)
    n_lines = per_text(lines.text)
    first, last = _edges(words.names)
    rows = [
        np.log1p(n_words), np.log1p(size), share(bytes_in(CLASSES == 0), n_words), share(bytes_in(upper), bytes_in(upper | lower)),
        share(bytes_in(among(DIGITS)), size), share(bytes_in(among(SYMBOLS)), size), share(bytes_in(among(STOPS)), n_words), share(bytes_in(among(CALLS)), n_words),
        share(bytes_in(CLASSES != 0), size), share(bytes_in(whole >= 192), size), share(per_text(pair_text), n_words), share(commonest, n_words),
        share(per_text(of[1:][same]), n_words), share(per_text(triple_of[order][~fresh]), n_words), share(n_lines - per_text(line_pairs // max(len(lines.names), 1)), n_lines),
        share(per_text(of[lengths == 1]), n_words), share(per_text(of[~_letter(last)[codes]]), n_words), share(per_text(of[((first >= 65) & (first <= 90))[codes]]), n_words),
    ]
    rows[2] = np.log1p(rows[2])
    return np.stack(rows, axis=1).astype(np.float32)


def _edges(names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(names)
    return data[offsets[:-1]], data[offsets[1:] - 1]


def _letter(byte: np.ndarray) -> np.ndarray:
    return (byte >= 128) | (byte >= 65) & (byte <= 90) | (byte >= 97) & (byte <= 122)


def text_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, x``: the statistics of every whole text of ``docs(doc_id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, held = 0, 0
            ends = np.cumsum(np.diff(text_bytes(batch.column(1))[1]))
            while start < batch.num_rows:
                stop = max(int(np.searchsorted(ends, held + BATCH, side="right")), start + 1)
                x = statistics(batch.column(1).slice(start, stop - start))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), lists], names=["doc_id", "x"])
                start, held = stop, int(ends[stop - 1])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, x array<float>")


def matrix_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


@dataclass
class Features:
    """Random Fourier features: cosines whose mean products approximate a Gaussian kernel of ``width`` over standard scores."""

    mean: np.ndarray
    scale: np.ndarray
    number: int
    width: float
    seed: int

    def __post_init__(self) -> None:
        r = np.random.Generator(np.random.PCG64(self.seed))
        self.directions = r.standard_normal((len(self.mean), self.number)) / self.width
        self.phases = r.uniform(0, 2 * np.pi, self.number)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Whole numbers up to ``STEPS``, the last column constant."""
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([np.rint(STEPS * np.cos(z @ self.directions + self.phases)), np.full((len(x), 1), float(STEPS))])


def normal_equations(rows: DataFrame, features: Features) -> dict[int, np.ndarray]:
    """Per fold of ``rows(x, y, fold)`` the products of features and outcomes, summed per partition and then over all.

    A partition gives a row per fold and cell of the upper triangle, whatever its rows; the driver gets one matrix per fold.
    """
    size = features.number + 2
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                v = np.hstack([features(matrix_of(batch.column(0))), np.rint(STEPS * batch.column(1).to_numpy(zero_copy_only=False))[:, None]])
                folds = batch.column(2).to_numpy(zero_copy_only=False)
                for f in np.unique(folds):
                    part = v[folds == f]
                    sums[int(f)] = sums.get(int(f), 0) + part.T @ part
        for f, m in sums.items():
            cells = np.arange(len(upper[0]))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cells), f)), pa.array(cells), pa.array(m[upper].astype(np.int64))], names=["fold", "cell", "value"])

    found = rows.select("x", "y", "fold").mapInArrow(run, "fold bigint, cell bigint, value bigint").groupBy("fold", "cell").agg(F.sum("value").alias("value")).toArrow()
    out = {}
    folds, cells, values = (found[c].to_numpy() for c in ("fold", "cell", "value"))
    for f in np.unique(folds):
        m = np.zeros((size, size))
        at = folds == f
        m[upper[0][cells[at]], upper[1][cells[at]]] = values[at]
        out[int(f)] = (m + np.triu(m, 1).T) / STEPS**2
    return out


def ridge(products: np.ndarray, penalty: float) -> np.ndarray:
    """Weights of the features and the constant; the constant is not shrunk."""
    a, b = products[:-1, :-1], products[:-1, -1]
    shrink = np.full(len(a), penalty * max(a[-1, -1], 1.0))
    shrink[-1] = 1e-9
    return np.linalg.solve(a + np.diag(shrink), b)


def isotonic(at: np.ndarray, n: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: places and levels of the best non-decreasing fit to ``total / n`` at ascending ``at``."""
    blocks: list[list[float]] = []
    for x, w, y in zip(at, n, total, strict=True):
        blocks.append([x * w, w, y])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


def bins_of(raw: np.ndarray) -> np.ndarray:
    return np.clip(np.floor((raw + 0.5) * BINS / 2), 0, BINS - 1).astype(np.int64)


def fold_scores(rows: DataFrame, features: Features, weights: dict[int, np.ndarray]) -> pa.Table:
    """``bin, n, total``: rows and outcomes per bin of the scores that the weights without a row's own fold give it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(BINS, np.int64), np.zeros(BINS, np.int64)
        for batch in batches:
            if batch.num_rows:
                z, folds = features(matrix_of(batch.column(0))) / STEPS, batch.column(2).to_numpy(zero_copy_only=False)
                y = np.rint(STEPS * batch.column(1).to_numpy(zero_copy_only=False)).astype(np.int64)
                for f in np.unique(folds):
                    at = bins_of(z[folds == f] @ weights[int(f)])
                    np.add.at(n, at, 1)
                    np.add.at(total, at, y[folds == f])
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[used]), pa.array(total[used])], names=["bin", "n", "total"])

    made = rows.select("x", "y", "fold").mapInArrow(run, "bin bigint, n bigint, total bigint")
    return made.groupBy("bin").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("bin").toArrow()


def fit(stats: DataFrame, labels: DataFrame, number: int, width: float, penalty: float, seed: int) -> Callable[[np.ndarray], np.ndarray] | float:
    """A function from statistics to scores, learnt from all labelled rows that are not held out; a constant if these show one outcome or none."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.avg((F.col("quality") == 1).cast("double")).alias("y"))
    rows = stash(stats.join(known, F.col("doc_id") == F.col("__id")).select("x", "y", fold(F.col("doc_id")).alias("fold")), "quality_rows", large=False)
    share = rows.agg(F.avg("y")).first()[0]
    if share is None or share in (0.0, 1.0):
        return 0.5 if share is None else float(share)
    sums = rows.select([f(F.get("x", F.lit(k)).cast("double")) for k in range(len(STATISTICS)) for f in (F.avg, F.stddev_pop)]).first()
    digits = np.array([float(f"{v or 0.0:.6g}") for v in sums]).reshape(-1, 2)
    features = Features(digits[:, 0], np.where(digits[:, 1] > 1e-6, digits[:, 1], 1.0), number, width, seed)
    products = normal_equations(rows, features)
    whole = sum(products.values())
    weights = ridge(whole, penalty)
    counted = fold_scores(rows, features, {f: ridge(whole - m, penalty) for f, m in products.items()})
    at, n, total = (counted[c].to_numpy().astype(float) for c in ("bin", "n", "total"))
    places, levels = isotonic((at + 0.5) * 2 / BINS - 0.5, n, total / STEPS)
    return lambda x: np.round(np.interp(features(x) @ weights / STEPS, places, levels), 6)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, number: int = 160, width: float = 4.0, penalty: float = 1e-5, seed: int = 12) -> DataFrame:
    """Quality of every whole text of ``docs(doc_id, text)``: ``doc_id, held_out, score, predicted``.

    The score depends on 18 statistics of the text alone (sizes, shares of kinds of characters, repeated words, triples and lines). ``number`` random
    Fourier features of their standard scores approximate a Gaussian kernel of the given ``width``; their normal equations are summed over all labelled rows, per partition
    and fold, in whole numbers, so the order of sums does not show. A ridge regression on ``labels(doc_id, quality)`` is solved from them, and one without
    each fold; the scores that rows get without their fold are calibrated by isotonic regression over ``BINS`` bins.

    Rows whose crc32(doc_id) is divisible by 5 are held out: their labels are never read. Several labels of one id are averaged. Null and empty texts get
    the score of a text without words, repeated rows the same score each; null ids are not held out and never labelled; other columns are ignored. Without labels all
    scores are 0.5, with one outcome that outcome; an empty table gives an empty result.
    """
    stats = stash(text_statistics(docs), "quality_statistics", large=False)
    model = fit(stats, labels, number, width, penalty, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = model(matrix_of(batch.column(1))) if callable(model) else np.full(batch.num_rows, model)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    scored = stats.select("doc_id", "x").mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
