"""Exploration of expression ``(sample_id, gene_id, logcpm)``: variance ranks, scores, distances, PCA and MDS."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import kept

#: Samples whose pairwise matrix may go to the driver, as an Arrow table of 8 million pairs (200 MB).
MOST_SAMPLES = 4_000
#: Cells that a task holds of two blocks of samples, and of the differences of a slice of genes.
TILE_CELLS = 4_000_000


def top_variable(expr: DataFrame, k: int | None = 500, share: float | None = None, value: str = "logcpm") -> DataFrame:
    """The ``k`` genes of the highest variance, or the top ``share`` of all: ``gene_id, variance``."""
    v = expr.groupBy("gene_id").agg(F.var_samp(value).alias("variance")).where("variance IS NOT NULL")
    if share is not None:
        k = math.ceil(share * v.count())
    return v.orderBy(F.desc(F.round("variance", 10)), "gene_id").limit(k)


def row_zscores(expr: DataFrame, value: str = "logcpm") -> DataFrame:
    """Values less their gene's mean, over its standard deviation; genes that do not vary are dropped."""
    w = Window.partitionBy("gene_id")
    z = expr.select("sample_id", "gene_id", F.col(value), F.avg(value).over(w).alias("mu"), F.stddev_samp(value).over(w).alias("sd"))
    return z.where("sd > 0").select("sample_id", "gene_id", ((F.col(value) - F.col("mu")) / F.col("sd")).alias("z"))


def _tiles(expr: DataFrame, value: str, compute: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], kind: str, most: int = 1, own: bool = False) -> DataFrame:
    """``s1, s2, part`` of pairs of samples, a row per slice of genes: a task has the genes of one slice of two blocks of samples as two matrices.

    ``compute(a, b)`` gives for genes x samples with NaN where missing what the slice holds of each pair of columns, of type ``kind``, and how many genes count; the caller puts slices together.
    Blocks are as wide as balances the values sent to several blocks with the ``most`` values of a pair's row, and slices as thick as ``TILE_CELLS`` allows, so more genes make more slices: the rows
    that move are genes x samples x blocks, whatever the genes. ``own`` keeps pairs of a sample with itself.
    """
    expr = kept(expr.select("sample_id", "gene_id", F.col(value).cast("double").alias("v")), "values")
    names = sorted(r[0] for r in expr.select("sample_id").distinct().limit(MOST_SAMPLES + 1).collect())
    if len(names) > MOST_SAMPLES:
        raise ValueError(f"distances of more than {MOST_SAMPLES} samples")
    id_type = expr.schema["sample_id"].dataType.simpleString()
    genes = expr.agg(F.approx_count_distinct("gene_id", 0.02)).first()[0]
    width = max(1, min(len(names), math.isqrt(TILE_CELLS // most)))
    blocks = -(-len(names) // width) if names else 0
    slices = max(1, -(-2 * genes * width // TILE_CELLS))
    place = expr.sparkSession.createDataFrame([(n, i) for i, n in enumerate(names)], f"sample_id {id_type}, __at int")
    near = F.sequence(F.lit(0), F.lit(max(blocks - 1, 0)))
    mine = F.floor(F.col("__at") / width).cast("int")
    told = expr.join(F.broadcast(place), "sample_id").withColumn("slice", F.pmod(F.xxhash64("gene_id"), F.lit(slices)).cast("int"))  # MOST_SAMPLES rows at most
    dealt = told.select("gene_id", "__at", "v", "slice", F.explode(F.transform(near, lambda j: F.struct(F.least(mine, j).alias("x"), F.greatest(mine, j).alias("y")))).alias("t"))
    keyed = dealt.select("gene_id", "__at", "v", "slice", "t.x", "t.y")

    def tile(key: tuple, rows: pa.Table) -> pa.Table:
        x, y = key[0].as_py(), key[1].as_py()
        coded = rows.column("gene_id").combine_chunks()
        coded = (coded.chunk(0) if isinstance(coded, pa.ChunkedArray) else coded).dictionary_encode()
        full = np.full((len(coded.dictionary), 2, width), np.nan)
        at = rows.column("__at").to_numpy()
        full[coded.indices.to_numpy(), (at // width != x).astype(int), at % width] = rows.column("v").to_numpy()
        a, b = full[:, 0], full[:, 1] if x != y else full[:, 0]
        got, counts = compute(a, b)
        i, j = np.nonzero(counts)
        keep = (x * width + i <= y * width + j) if own else (x * width + i < y * width + j)
        i, j = i[keep], j[keep]
        cells = pa.array(got[i, j]) if got.ndim == 2 else pa.array([v[v >= 0] for v in got[:, i, j].T], pa.list_(pa.float64()))
        return pa.table([pa.array((x * width + i).astype(np.int32)), pa.array((y * width + j).astype(np.int32)), cells], names=["a", "b", "part"])

    pairs = keyed.groupBy("x", "y", "slice").applyInArrow(tile, f"a int, b int, part {kind}")
    first, second = (place.select(F.col("sample_id").alias(s), F.col("__at").alias(c)) for s, c in (("s1", "a"), ("s2", "b")))
    return pairs.join(F.broadcast(first), "a").join(F.broadcast(second), "b").select("s1", "s2", "part")


def _squared_differences(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over the genes that both samples have, a slice of genes at a time, and the numbers of such genes."""
    total, n = np.zeros((a.shape[1], b.shape[1])), np.zeros((a.shape[1], b.shape[1]))
    step = max(1, TILE_CELLS // (a.shape[1] * b.shape[1]))
    for k in range(0, len(a), step):
        d = a[k : k + step, :, None] - b[k : k + step, None, :]
        n += (~np.isnan(d)).sum(axis=0)
        total += np.nansum(d * d, axis=0)
    return total, n


def _largest(k: int) -> Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    def largest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` largest squared differences of each pair, -1 where there are fewer: the best so far and those of a slice of genes are merged, ``k`` of them kept."""
        best = np.full((0, a.shape[1], b.shape[1]), -1.0)
        step = max(1, TILE_CELLS // (a.shape[1] * b.shape[1]))
        for at in range(0, len(a), step):
            d = (a[at : at + step, :, None] - b[at : at + step, None, :]) ** 2
            best = np.concatenate([best, np.where(np.isnan(d), -1.0, d)])
            if len(best) > k:
                best = np.partition(best, len(best) - k, axis=0)[-k:]
        return best, (best >= 0).sum(axis=0)

    return largest


def sample_distance(expr: DataFrame, value: str = "logcpm") -> DataFrame:
    """Euclidean distances of samples over the genes that both have: ``s1, s2, distance``, each pair once."""
    return _tiles(expr, value, _squared_differences, "double").groupBy("s1", "s2").agg(F.sqrt(F.sum("part")).alias("distance"))


def leading_distance(expr: DataFrame, k: int = 500, value: str = "logcpm") -> DataFrame:
    """Root mean of each pair's ``k`` largest squared differences: ``s1, s2, distance``.

    The largest of each slice of genes are merged in one array per pair, ``k`` values for as many genes as a tile holds.
    """
    top = F.slice(F.sort_array(F.flatten(F.collect_list("part")), asc=False), 1, k)
    best = _tiles(expr, value, _largest(k), "array<double>", k).groupBy("s1", "s2").agg(top.alias("d2"))
    return best.select("s1", "s2", F.sqrt(F.aggregate("d2", F.lit(0.0), lambda s, x: s + x) / F.size("d2")).alias("distance"))


def _square(pairs: DataFrame, value: str) -> tuple[list[str], np.ndarray]:
    """Names and symmetric matrix of a table of pairs, taken to the driver in columns, never as row objects."""
    most = MOST_SAMPLES * (MOST_SAMPLES + 1) // 2
    table = pairs.select("s1", "s2", F.col(value).cast("double").alias("v")).limit(most + 1).toArrow()
    if table.num_rows > most:
        raise ValueError(f"a matrix of more than {MOST_SAMPLES} samples is not taken to the driver")
    names = sorted(set(pc.unique(table["s1"]).to_pylist()) | set(pc.unique(table["s2"]).to_pylist()))
    known = pa.array(names, table.schema.field("s1").type)
    i, j = (pc.index_in(table[c], known).to_numpy() for c in ("s1", "s2"))
    out = np.zeros((len(names), len(names)))
    out[i, j] = out[j, i] = table["v"].to_numpy()
    return names, out


def _fixed_signs(vectors: np.ndarray) -> np.ndarray:
    """Each column turned so that its largest entry is positive."""
    top = np.abs(vectors).argmax(axis=0)
    return vectors * np.where(vectors[top, np.arange(vectors.shape[1])] < 0, -1, 1)


def gram_matrix(centred: DataFrame, value: str = "v") -> DataFrame:
    """Inner products of samples over the genes that both have, each pair once: ``s1, s2, g``."""

    def inner(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.nan_to_num(a).T @ np.nan_to_num(b), (~np.isnan(a)).T.astype(float) @ (~np.isnan(b)).astype(float)

    return _tiles(centred, value, inner, "double", own=True).groupBy("s1", "s2").agg(F.sum("part").alias("g"))


def pca(expr: DataFrame, genes: DataFrame | None = None, components: int = 3, value: str = "logcpm") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scores, variance shares and loadings of samples on centred, unscaled genes.

    The Gram matrix of samples is an aggregate; its eigenvectors (samples squared, not genes) are found on the driver.
    """
    spark = expr.sparkSession
    if genes is not None:
        expr = expr.join(genes.select("gene_id"), "gene_id", "left_semi")
    centred = expr.withColumn("v", F.col(value) - F.avg(value).over(Window.partitionBy("gene_id")))
    names, matrix = _square(gram_matrix(centred), "g")
    values, vectors = np.linalg.eigh(matrix) if names else (np.zeros(0), np.zeros((0, 0)))
    order = np.argsort(values)[::-1][:components]
    top, vectors = np.clip(values[order], 0, None), _fixed_signs(vectors[:, order]) if names else vectors
    total = max(float(np.clip(values, 0, None).sum()), 1e-300)
    pcs = [(n, k + 1, float(vectors[i, k] * math.sqrt(top[k]))) for i, n in enumerate(names) for k in range(len(order))]
    scores = spark.createDataFrame(pcs, "sample_id string, pc int, score double")
    shares = spark.createDataFrame([(k + 1, float(v / total)) for k, v in enumerate(top)], "pc int, variance_fraction double")
    unit = spark.createDataFrame([(n, k + 1, float(vectors[i, k])) for i, n in enumerate(names) for k in range(len(order))], "sample_id string, pc int, u double")
    spread = shares.select("pc", F.sqrt(F.col("variance_fraction") * total).alias("s")).where("s > 1e-9")
    loadings = centred.join(F.broadcast(unit), "sample_id").join(F.broadcast(spread), "pc").groupBy("gene_id", "pc").agg(F.sum(F.col("v") * F.col("u") / F.col("s")).alias("loading"))
    return scores, shares, loadings


def mds(distances: DataFrame, dimensions: int = 2) -> DataFrame:
    """Classical scaling of a distance table: ``sample_id, dim, coordinate``."""
    names, d = _square(distances, "distance")
    n = len(names)
    if not n:
        return distances.sparkSession.createDataFrame([], "sample_id string, dim int, coordinate double")
    centre = np.eye(n) - 1 / n
    values, vectors = np.linalg.eigh(-0.5 * centre @ (d**2) @ centre)
    order = np.argsort(values)[::-1][:dimensions]
    points = _fixed_signs(vectors[:, order]) * np.sqrt(np.clip(values[order], 0, None))
    rows = [(s, k + 1, float(points[i, k])) for i, s in enumerate(names) for k in range(len(order))]
    return distances.sparkSession.createDataFrame(rows, "sample_id string, dim int, coordinate double")


def candidate_expression(expr: DataFrame, candidates: DataFrame, samples: DataFrame, value: str = "logcpm") -> DataFrame:
    """Expression of the candidate genes beside their ``label, logFC, FDR`` and each sample's ``exposure_group``, for box plots."""
    few = candidates.select("gene_id", "label", "logFC", "FDR")
    return expr.join(few, "gene_id").join(samples.select("sample_id", "exposure_group"), "sample_id", "left").select("sample_id", "gene_id", F.col(value), "exposure_group", "label", "logFC", "FDR")


def top_per_group(df: DataFrame, by: list[str], order: list, k: int) -> DataFrame:
    """The first ``k`` rows of each group, no ties."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def ordered_levels(df: DataFrame, column: str, levels: str) -> DataFrame:
    """Rows sorted by the place of their value in a ``|`` list, the rest after it."""
    return df.orderBy(level_place(F.col(column), levels), column)


def level_place(value: Column, levels: str) -> Column:
    """Place of a value in a ``|`` list; those that are not in it come after all."""
    place = F.array_position(F.split(F.lit(levels), r"\|"), value)
    return F.when(place == 0, F.lit(1 << 30)).otherwise(place)


def attach_metadata(scores: DataFrame, samples: DataFrame) -> DataFrame:
    """Scores with their sample's metadata by id; an unknown id raises, as position means nothing."""
    unknown = scores.join(samples, "sample_id", "left_anti").select("sample_id").limit(5).collect()
    if unknown:
        raise ValueError(f"unknown samples: {[r['sample_id'] for r in unknown]}")
    return scores.join(samples, "sample_id")
