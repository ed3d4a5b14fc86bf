"""Designs, contrasts and per-gene tests: a linear model on log expression."""

from __future__ import annotations

from urllib.parse import quote

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tails import f_upper, student_two_sided
from .ranges import least_from_here, placed


def design_matrix(samples: list[dict], factors: dict[str, str], numerics: list[str] = (), interactions: list[tuple[str, str]] = ()) -> tuple[list[str], list[str], np.ndarray]:
    """Sample ids, coefficient ids and treatment-coded rows.

    ``factors`` maps each factor to its reference level, which must occur; other levels follow sorted.
    """
    ids = [s["sample_id"] for s in samples]
    names, columns = ["intercept"], [np.ones(len(ids))]
    coded: dict[str, list[tuple[str, np.ndarray]]] = {}
    for f, reference in factors.items():
        levels = sorted({s[f] for s in samples} - {reference})
        if not levels or reference not in {s[f] for s in samples}:
            raise ValueError(f"factor {f} needs its reference and another level")
        coded[f] = [(f"factor:{f}:{quote(v, safe='')}", np.array([float(s[f] == v) for s in samples])) for v in levels]
    for f in numerics:
        x = np.array([float(s[f]) for s in samples])
        if not np.isfinite(x).all():
            raise ValueError(f"{f} is not finite")
        if np.ptp(x) == 0:
            raise ValueError(f"{f} does not vary")
        coded[f] = [(f"numeric:{f}", x)]
    for parts in coded.values():
        for name, x in parts:
            names.append(name)
            columns.append(x)
    for a, b in interactions:
        for na, xa in coded[a]:
            for nb, xb in coded[b]:
                names.append(f"interaction:{na.partition(':')[2]}*{nb.partition(':')[2]}")
                columns.append(xa * xb)
    return ids, names, np.stack(columns, axis=1)


def design_problems(x: np.ndarray, samples: list[dict], cell: list[str], unit: str, subject: str | None = None) -> list[str]:
    """What keeps a design from being fitted: rank, residual freedom, replication, repeated units."""
    out = []
    rank = int(np.linalg.matrix_rank(x))
    if rank < x.shape[1]:
        out.append("design is not of full rank")
    if x.shape[0] - rank < 1:
        out.append("no residual degrees of freedom")
    cells: dict[tuple, set] = {}
    for s in samples:
        cells.setdefault(tuple(s[c] for c in cell), set()).add(s[unit])
    units = {s[unit] for s in samples}
    if subject is None:
        out += [f"cell {k} has fewer than two units" for k, v in sorted(cells.items()) if cell and len(v) < 2]
        if len(units) < len(samples):
            out.append("repeated units need a subject")
    else:
        pairs = {(s[unit], s[subject]) for s in samples}
        if len({u for u, _ in pairs}) < len(pairs) or len({v for _, v in pairs}) < len(pairs):
            out.append("subject and unit are not one to one")
        if len({v for _, v in pairs}) < 2:
            out.append("at least two subjects are needed")
    if not cell and len(units) < 3:
        out.append("a numeric design needs three units")
    return out


def leverage(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ji->i", x, np.linalg.pinv(x))


def coefficient_contrast(names: list[str], weights: dict[str, float]) -> np.ndarray:
    """Vector over the coefficients from weighted ids."""
    vector = np.array([weights.get(n, 0.0) for n in names])
    if set(weights) - set(names) or not vector.any():
        raise ValueError("unknown coefficients or an empty contrast")
    return vector


def cell_contrast(names: list[str], cells: list[tuple[dict, float]], factors: dict[str, str], means: dict[str, float] | None = None) -> np.ndarray:
    """Vector over the coefficients from weighted cells; factors not named are at their reference, numerics at their mean."""
    if abs(sum(w for _, w in cells)) > 1e-10:
        raise ValueError("cell weights must sum to 0")
    means = means or {}
    out = np.zeros(len(names))

    def term(part: str, cell: dict) -> float:
        variable, _, level = part.partition(":")
        if not level:
            return float(cell.get(variable, means.get(variable, 0.0)))
        return float(quote(str(cell.get(variable, factors.get(variable))), safe="") == level)

    for cell, weight in cells:
        for k, n in enumerate(names):
            kind, _, rest = n.partition(":")
            value = 1.0 if kind == "intercept" else np.prod([term(p, cell) for p in rest.split("*")])
            out[k] += weight * value
    if not out.any():
        raise ValueError("an empty contrast")
    return out


def _small(spark, ids: list[str], rows: np.ndarray, name: str) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(s, [float(v) for v in r]) for s, r in zip(ids, rows, strict=True)], f"sample_id string, {name} array<double>"))


def fit(expr: DataFrame, ids: list[str], x: np.ndarray, value: str = "logcpm") -> DataFrame:
    """Per gene: coefficients ``beta``, residual variance ``s2`` and freedom ``df``.

    All genes share the design, so its pseudo-inverse, one row per sample, is broadcast (samples times
    coefficients, whatever the genes), and one aggregate per gene sums ``P y``, ``y^2``; the residual
    sum follows from both. A gene that lacks a sample is left out: ``incomplete_genes`` lists them.
    """
    p = np.linalg.pinv(x).T
    both = _small(expr.sparkSession, ids, np.hstack([p, x]), "px")
    k = x.shape[1]
    y = F.col(value)
    sums = expr.join(both, "sample_id").groupBy("gene_id").agg(
        *[F.sum(y * F.col("px")[i]).alias(f"b{i}") for i in range(k)],
        *[F.sum(y * F.col("px")[k + i]).alias(f"c{i}") for i in range(k)],
        F.sum(y * y).alias("yy"),
        F.count(F.lit(1)).alias("n"),
    )
    df = x.shape[0] - int(np.linalg.matrix_rank(x))
    rss = F.col("yy") - sum(F.col(f"b{i}") * F.col(f"c{i}") for i in range(k))
    return sums.where(F.col("n") == x.shape[0]).select(
        "gene_id", F.array(*[F.col(f"b{i}") for i in range(k)]).alias("beta"), (F.greatest(rss, F.lit(0.0)) / df).alias("s2"), F.lit(df).alias("df")
    )


def incomplete_genes(expr: DataFrame, ids: list[str], value: str = "logcpm") -> DataFrame:
    """``gene_id, n_missing`` of genes that ``fit`` leaves out, as they lack some of the design's samples."""
    have = expr.where(F.col("sample_id").isin(*ids) & F.col(value).isNotNull()).groupBy("gene_id").agg(F.count_distinct("sample_id").alias("n"))
    genes = expr.select("gene_id").distinct().join(have, "gene_id", "left").withColumn("n_missing", F.lit(len(ids)) - F.coalesce("n", F.lit(0)))
    return genes.where("n_missing > 0").select("gene_id", "n_missing")


def contrast_test(fitted: DataFrame, x: np.ndarray, vector: np.ndarray) -> DataFrame:
    """``gene_id, logFC, statistic, PValue`` of one contrast by Student's t."""
    scale = float(vector @ np.linalg.pinv(x.T @ x) @ vector)
    effect = sum(F.col("beta")[i] * float(v) for i, v in enumerate(vector))
    t = F.col("logFC") / F.sqrt(F.col("s2") * scale)
    out = fitted.select("gene_id", effect.alias("logFC"), "s2", "df").withColumn("statistic", F.when(F.col("s2") > 0, t))
    return out.select("gene_id", "logFC", "statistic", student_two_sided(F.col("statistic"), F.col("df")).alias("PValue"))


def omnibus_test(fitted: DataFrame, x: np.ndarray, vectors: np.ndarray) -> DataFrame:
    """``gene_id, statistic, PValue`` of several contrasts at once by F, their rank the first freedom."""
    rank = int(np.linalg.matrix_rank(vectors))
    inner = np.linalg.pinv(vectors @ np.linalg.pinv(x.T @ x) @ vectors.T)
    effects = [sum(F.col("beta")[i] * float(v) for i, v in enumerate(row)) for row in vectors]
    form = sum(effects[i] * effects[j] * float(inner[i, j]) for i in range(len(effects)) for j in range(len(effects)))
    out = fitted.select("gene_id", "df", F.when(F.col("s2") > 0, form / rank / F.col("s2")).alias("statistic"))
    return out.select("gene_id", "statistic", f_upper(F.col("statistic"), F.lit(float(rank)), F.col("df")).alias("PValue"))


def benjamini_hochberg(df: DataFrame, by: list[str], p: str = "PValue", name: str = "FDR", order: str = "gene_id") -> DataFrame:
    """Adjusted p-values within each family; missing ones stay missing and do not count.

    No family lies in one task: ranks come from ranges of p-values, and each range takes the least of the later ones along. Missing p-values come first and weigh nothing.
    """
    ranked = placed(df, by, [p, order], F.col(p).isNotNull().cast("int")).withColumn("__q", F.col(p) * F.col("__total") / (F.col("__before") + 1))
    adjusted = F.when(F.col(p).isNotNull(), F.least(F.lit(1.0), "__least"))
    return least_from_here(ranked, by, [p, order], "__q", "__least").withColumn(name, adjusted).select(*df.columns, name)


def benjamini_hochberg_in_ranges(df: DataFrame, by: list[str], p: str = "PValue", name: str = "FDR", order: str = "gene_id") -> DataFrame:
    """``benjamini_hochberg``, which works in ranges."""
    return benjamini_hochberg(df, by, p, name, order)


def regulation(fdr: Column, lfc: Column, fdr_cut: float = 0.05, lfc_cut: float = 1.0) -> Column:
    """Up, Down or Unchanged; anything missing is Unchanged."""
    hit = F.coalesce(fdr < fdr_cut, F.lit(False))
    return F.when(hit & (lfc > lfc_cut), "Up").when(hit & (lfc < -lfc_cut), "Down").otherwise("Unchanged")


def minus_log10(p: Column) -> Column:
    """-log10 with the least positive normal double as floor."""
    return -F.log10(F.greatest(p, F.lit(2.2250738585072014e-308)))
