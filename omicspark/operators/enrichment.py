"""Over-representation and running enrichment scores."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tails import hypergeometric_tail
from ..sources.scratch import kept
from .inference import benjamini_hochberg


def background(tested: DataFrame, annotated: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    """Tested genes with an annotation, within the universe if one is given."""
    out = tested.select("gene_id").distinct().join(annotated, "gene_id", "left_semi")
    return out if universe is None else out.join(universe, "gene_id", "left_semi")


def over_representation(tests: DataFrame, sets: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    """Hypergeometric test of each set among the regulated genes, for All, Up and Down.

    ``tests(gene_id, Regulation)``, ``sets(gene_id, set_id)``. Returns ``direction, set_id, set_size, n_selected,
    overlap, background, PValue, FDR, genes``; nothing selected gives 1.
    """
    sets = sets.select("gene_id", "set_id").distinct()
    genes = background(tests, sets, universe)
    total = genes.count()
    chosen = tests.where("Regulation <> 'Unchanged'").join(genes, "gene_id", "left_semi")
    selected = chosen.select("gene_id", F.explode(F.array(F.lit("All"), F.col("Regulation"))).alias("direction")).distinct()
    inside = sets.join(genes, "gene_id", "left_semi")
    sizes = inside.groupBy("set_id").agg(F.count(F.lit(1)).alias("set_size"))
    frame = sizes.select("*", F.explode(F.array(*map(F.lit, ("All", "Up", "Down")))).alias("direction"))
    drawn = selected.groupBy("direction").agg(F.count(F.lit(1)).alias("n_selected"))
    hits = inside.join(selected, "gene_id").groupBy("direction", "set_id").agg(
        F.count(F.lit(1)).alias("overlap"), F.array_join(F.sort_array(F.collect_list("gene_id")), "|").alias("genes")
    )
    df = frame.join(drawn, "direction", "left").join(hits, ["direction", "set_id"], "left").na.fill(0, ["n_selected", "overlap"]).na.fill("", ["genes"])
    p = hypergeometric_tail(F.col("overlap"), F.col("set_size"), F.lit(total).cast("long"), F.col("n_selected"))
    return benjamini_hochberg(df.withColumn("background", F.lit(total)).withColumn("PValue", p), ["direction"], order="set_id")


def running_score(ranked: DataFrame, sets: DataFrame) -> DataFrame:
    """Extreme of the running sum of each set over genes by falling score: ``set_id, es, n_hits``.

    ``ranked(gene_id, score)``. Hits step up by their share of the absolute scores, other genes down evenly; between two hits
    the sum falls in a line, so only the ranks of hits are needed and no set meets every gene. Global
    ranks are the position within a range of scores plus the sizes of the ranges above.
    """
    ranks = global_rank(ranked)
    total = ranked.count()
    hits = ranks.join(sets.select("gene_id", "set_id").distinct(), "gene_id")
    w = Window.partitionBy("set_id")
    up = Window.partitionBy("set_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    h = hits.select(
        "set_id", "rank", F.count(F.lit(1)).over(w).alias("n_hits"), F.sum(F.abs("score")).over(w).alias("mass"), F.sum(F.abs("score")).over(up).alias("sum"),
        F.abs("score").alias("own"), F.row_number().over(w.orderBy("rank")).alias("i"),
    ).where((F.col("mass") > 0) & (F.col("n_hits") < total))
    down = (F.col("rank") - F.col("i")) / (F.lit(total) - F.col("n_hits"))
    h = h.withColumn("after", F.col("sum") / F.col("mass") - down).withColumn("before", (F.col("sum") - F.col("own")) / F.col("mass") - down)
    out = h.groupBy("set_id").agg(F.max("after").alias("hi"), F.min("before").alias("lo"), F.max("n_hits").alias("n_hits"))
    return out.select("set_id", F.when(F.col("hi") >= -F.col("lo"), F.col("hi")).otherwise(F.col("lo")).alias("es"), "n_hits")


def global_rank(ranked: DataFrame, ranges: int = 64) -> DataFrame:
    """``gene_id, score, rank`` by falling score, then id, without gathering all rows in one task."""
    cuts = ranked.select(F.percentile_approx("score", [i / ranges for i in range(1, ranges)], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))
    part = F.lit(0)
    for c in cuts:
        part = part + (F.col("score") < F.lit(c)).cast("int")
    parted = ranked.withColumn("__part", part)
    sizes = parted.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("__part", F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("__part").orderBy(F.desc("score"), "gene_id"))
    return parted.join(before, "__part").select("gene_id", "score", (F.col("before") + within).alias("rank"))


def preranked(tests: DataFrame, statistic: str = "statistic") -> DataFrame:
    """Signed root of an F statistic as the ranking score."""
    return tests.select("gene_id", (F.signum("logFC") * F.sqrt(F.abs(F.col(statistic)))).alias("score")).where("score IS NOT NULL")


#: Ranks in a range, and tries together, that one row of the permutations' table stands for.
RANGE, TRIES = 1 << 18, 25


def _width(n: int) -> int:
    """Bits of one half of the index in the Feistel network over ``n``."""
    return max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)


def _mixed(x: np.ndarray, key: int, turn: int) -> np.ndarray:
    x = (x + np.uint64((key * 6 + turn) % 2**61)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x >> np.uint64(31)


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """The places of ``index`` under a pseudorandom permutation of ``n``, without a table: a Feistel network that is walked until it falls below ``n``."""
    half = _width(n)
    mask, out = np.uint64((1 << half) - 1), np.asarray(index, np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for turn in range(6):
            left, right = right, left ^ (_mixed(right, key, turn) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def index_of(place: np.ndarray, n: int, key: int) -> np.ndarray:
    """The inverse of ``permuted``: what stands at each ``place``. The network is walked backwards."""
    half = _width(n)
    mask, out = np.uint64((1 << half) - 1), np.array(place, np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for turn in reversed(range(6)):
            left, right = right ^ (_mixed(left, key, turn) & mask), left
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _hits_by_size(weights: np.ndarray, first: int, sizes: np.ndarray, n: int, key: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per size, from the largest: the ranks (from 0) of the hits in the range of ``weights`` that begins at ``first``, and their weights.

    A set of k genes hits the places of the indices below k, so a smaller one's hits are among those of a larger.
    """
    index = index_of(np.arange(first, first + len(weights)), n, key)
    at = np.arange(len(weights))
    for k in sizes[::-1]:
        below = index < k
        index, at = index[below], at[below]
        yield int(k), at + first, weights[at]


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    """Rows of ``range, ws, batch, sizes, ...``, one at a time, with arrays of numbers as such."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            more = [row["known"].as_py()] if "known" in row else []
            yield [row["range"].as_py(), row["ws"].values.to_numpy(zero_copy_only=False), row["batch"].as_py(), row["sizes"].values.to_numpy(zero_copy_only=False), *more]


def _tasks(n: int, permutations: int) -> int:
    """A task per range of ranks and batch of tries, up to a thousand: few rows of much work, which adaptive execution would put in one task."""
    return min(1000, (n // RANGE + 1) * (max(permutations - 1, 0) // TRIES + 1))


def permutation_significance(ranked: DataFrame, sets: DataFrame, permutations: int = 1000, seed: int = 1) -> DataFrame:
    """``running_score`` with its significance: ``set_id, es, n_hits, nes, PValue``.

    Null scores depend on a set's size alone: for each size in use and each of the ``permutations`` a seeded index permutation, without a table, says which ranks are
    hits. Ranks are dealt to ranges, and a range asks the inverse permutation what stands at its ranks; a first pass gives the number and the weight of the hits in each range, a second, which
    knows what lies before a range, the extremes of the sum. No task and no driver has the scores of all genes. Of the null scores on the same side as ``es``, with ``es`` itself, ``PValue`` is the
    share that is as extreme, ``nes`` is ``es`` over the mean of their sizes. Null scores are kept as one array per size, ``permutations`` long, and can be merged.
    """
    ranks = kept(global_rank(ranked), "ranks")
    n = ranks.count()
    scores = kept(running_score(ranked, sets), "scores")
    used = scores.agg(F.array_sort(F.collect_set(F.col("n_hits").cast("bigint"))).alias("sizes"))
    cells = ranks.groupBy(F.floor((F.col("rank") - 1) / RANGE).alias("range")).agg(F.array_sort(F.collect_list(F.struct("rank", F.abs("score").cast("double").alias("w")))).alias("ws"))
    batches = F.sequence(F.lit(0), F.lit(max(permutations - 1, 0) // TRIES))
    rows = cells.select("range", F.col("ws.w").alias("ws"), F.explode(batches).alias("batch")).crossJoin(F.broadcast(used))
    dealt = kept(rows.repartition(_tasks(n, permutations), "range", "batch"), "cells")

    def tries(batch: int) -> range:
        return range(batch * TRIES, min(permutations, (batch + 1) * TRIES))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, ws, batch, sizes in _cells(batches):
            for b in tries(batch):
                got = [(k, len(at), float(own.sum())) for k, at, own in _hits_by_size(ws, first * RANGE, sizes, n, seed * 1_000_003 + b)]
                if got:
                    yield pa.RecordBatch.from_pylist([{"range": first, "batch": batch, "b": b, "k": k, "c": c, "m": m} for k, c, m in got])

    found = kept(dealt.mapInArrow(sums, "range bigint, batch bigint, b bigint, k bigint, c bigint, m double"), "sums")
    w = Window.partitionBy("b", "k")
    ahead = w.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    known = found.select("range", "batch", "b", "k", F.coalesce(F.sum("c").over(ahead), F.lit(0)).alias("c"), F.coalesce(F.sum("m").over(ahead), F.lit(0.0)).alias("m"), F.sum("m").over(w).alias("mass"))
    told = known.groupBy("range", "batch").agg(F.array_sort(F.collect_list(F.struct("b", "k", "c", "m", "mass"))).alias("known"))

    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, ws, batch, sizes, known in _cells(batches):
            before = {(x["b"], x["k"]): (x["c"], x["m"], x["mass"]) for x in known}
            for b in tries(batch):
                got = []
                for k, at, own in _hits_by_size(ws, first * RANGE, sizes, n, seed * 1_000_003 + b):
                    count, mass, total = before[b, k]
                    if not len(at) or total <= 0 or k >= n:
                        continue
                    after = (mass + np.cumsum(own)) / total - (at - count - np.arange(len(at))) / (n - k)
                    got.append({"b": b, "n_hits": k, "high": float(after.max()), "low": float((after - own / total).min())})
                if got:
                    yield pa.RecordBatch.from_pylist(got)

    ends = dealt.join(told, ["range", "batch"]).repartition(_tasks(n, permutations), "range", "batch").select("range", "ws", "batch", "sizes", "known")
    ends = ends.mapInArrow(extremes, "b bigint, n_hits bigint, high double, low double")
    null = F.when(F.max("high") >= -F.min("low"), F.max("high")).otherwise(F.min("low"))
    nulls = ends.groupBy("n_hits", "b").agg(null.alias("by_chance")).groupBy("n_hits").agg(F.sort_array(F.collect_list("by_chance")).alias("nulls"))
    told = scores.join(nulls, "n_hits", "left").withColumn("side", F.filter("nulls", lambda x: (x >= 0) == (F.col("es") >= 0)))
    extreme = F.size(F.filter("side", lambda x: F.abs(x) >= F.abs(F.col("es"))))
    mean = F.aggregate("side", F.lit(0.0), lambda s, x: s + F.abs(x)) / F.size("side")
    return told.select("set_id", "es", "n_hits", F.when(F.size("side") > 0, F.col("es") / mean).alias("nes"), ((1 + extreme) / (1 + F.size("side"))).alias("PValue"))
