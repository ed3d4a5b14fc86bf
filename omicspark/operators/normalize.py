"""Normalisation of long count tables ``counts(sample_id, gene_id, n)``: CPM, filters, TMM, logCPM, length offsets."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import kept


def library_sizes(counts: DataFrame) -> DataFrame:
    return counts.groupBy("sample_id").agg(F.sum("n").alias("library"))


def cpm(counts: DataFrame) -> DataFrame:
    """Counts per million of each sample's library."""
    return counts.join(library_sizes(counts).where("library > 0"), "sample_id").withColumn("cpm", F.col("n") * 1e6 / F.col("library"))


def exploratory_filter(counts: DataFrame, n_samples: int, least_cpm: float = 1.0) -> DataFrame:
    """Genes with enough CPM in two samples, or in all if there are fewer: ``gene_id, n_pass``."""
    passed = F.count_if(F.col("cpm") >= least_cpm)
    return cpm(counts).groupBy("gene_id").agg(passed.alias("n_pass")).where(F.col("n_pass") >= min(2, n_samples))


def design_filter(counts: DataFrame, largest_leverage: float, least_count: float = 10, least_total: float = 15, large_n: float = 10, share: float = 0.7) -> DataFrame:
    """Genes expressed in as many samples as the design's smallest group (published filter rule).

    The group size is the inverse of the largest leverage, beyond ``large_n`` counted by ``share``; the CPM
    cut is that of ``least_count`` in the median library.
    """
    size = 1 / largest_leverage
    if size > large_n:
        size = large_n + (size - large_n) * share
    median = library_sizes(counts).agg(F.median("library")).first()[0]  # one number
    if not median:
        return counts.limit(0).select("gene_id", F.lit(0).alias("n_pass"), F.lit(0).cast("long").alias("total"))
    cut = least_count / median * 1e6
    out = cpm(counts).groupBy("gene_id").agg(F.count_if(F.col("cpm") >= cut).alias("n_pass"), F.sum("n").alias("total"))
    return out.where((F.col("n_pass") >= size - 1e-14) & (F.col("total") >= least_total - 1e-14))


def tmm_factors(counts: DataFrame, trim_m: float = 0.3, trim_a: float = 0.05) -> DataFrame:
    """Trimmed mean of M-values: ``sample_id, library, tmm_factor`` (published definition).

    The reference is the sample whose upper quartile share is nearest the mean of all. One row per sample, its library, quartile
    and factor, goes to the driver; ratios, ranks and weighted means are per sample. ``counts`` is read several times: give a
    written table (``kept``), not a plan that aggregates it anew.
    """
    libraries = library_sizes(counts).where("library > 0")
    some = counts.groupBy("gene_id").agg(F.sum("n").alias("t")).where("t > 0").select("gene_id")
    rows = counts.join(some, "gene_id", "left_semi").join(libraries, "sample_id")
    quart = {r["sample_id"]: (r["q"], r["library"]) for r in rows.groupBy("sample_id").agg(F.percentile("n", F.lit(0.75)).alias("q"), F.max("library").alias("library")).collect()}
    if not quart:
        return counts.limit(0).select("sample_id", F.col("n").alias("library"), F.lit(1.0).alias("tmm_factor"))
    mean = math.fsum(q / n for q, n in quart.values()) / len(quart)
    ref = min(quart, key=lambda s: (round(abs(quart[s][0] / quart[s][1] - mean), 12), s))
    base = rows.where(F.col("sample_id") == ref).select("gene_id", F.col("n").alias("r"), F.col("library").alias("rl"))
    both = rows.join(base, "gene_id").where("n > 0 AND r > 0")
    p, q = F.col("n") / F.col("library"), F.col("r") / F.col("rl")
    weight = 1 / ((F.col("library") - F.col("n")) / (F.col("library") * F.col("n")) + (F.col("rl") - F.col("r")) / (F.col("rl") * F.col("r")))
    ma = both.select("sample_id", "gene_id", F.log2(p / q).alias("m"), ((F.log2(p) + F.log2(q)) / 2).alias("a"), weight.alias("w"))
    w = Window.partitionBy("sample_id")
    order = lambda c: F.row_number().over(w.orderBy(F.round(c, 10), "gene_id"))
    ranked = ma.select("*", order(F.col("m")).alias("rm"), order(F.col("a")).alias("ra"), F.count(F.lit(1)).over(w).alias("g"))
    keep = lambda r, t: (r > F.floor(F.col("g") * t)) & (r <= F.col("g") - F.floor(F.col("g") * t))
    trimmed = ranked.where(keep(F.col("rm"), trim_m) & keep(F.col("ra"), trim_a))
    raw = trimmed.groupBy("sample_id").agg(F.pow(F.lit(2.0), F.sum(F.col("w") * F.col("m")) / F.sum("w")).alias("raw"))
    found = {r["sample_id"]: r["raw"] for r in raw.collect()}
    centre = math.exp(math.fsum(math.log(found.get(s, 1.0)) for s in quart) / len(quart))
    one = counts.sparkSession.createDataFrame([(s, n, found.get(s, 1.0) / centre) for s, (_, n) in quart.items()], libraries.withColumn("tmm_factor", F.lit(1.0)).schema)
    return F.broadcast(one)


def log_cpm(counts: DataFrame, factors: DataFrame, prior: float = 2.0) -> DataFrame:
    """log2 CPM with a prior count scaled to the effective library."""
    eff = factors.withColumn("eff", F.col("library") * F.col("tmm_factor"))
    mean = eff.agg(F.avg("eff")).first()[0]
    p = F.lit(prior) * F.col("eff") / F.lit(mean)
    value = F.log2((F.col("n") + p) / (F.col("eff") + 2 * p) * 1e6)
    return counts.join(eff.select("sample_id", "eff"), "sample_id").select("sample_id", "gene_id", value.alias("logcpm"))


def gene_lengths(quant: DataFrame, gene_map: DataFrame) -> DataFrame:
    """Abundance-weighted mean length per sample and gene, the plain mean where nothing is expressed."""
    t = quant.join(gene_map, "transcript_id")
    weighted = F.sum(F.col("eff_length") * F.col("tpm")) / F.sum("tpm")
    return t.groupBy("sample_id", "gene_id").agg(F.when(F.sum("tpm") > 0, weighted).otherwise(F.avg("eff_length")).alias("length"), F.sum("num_reads").alias("n"))


def length_offsets(lengths: DataFrame) -> DataFrame:
    """log offsets of ``lengths(sample_id, gene_id, length, n)``: relative length times effective library.

    Lengths are divided by the gene's geometric mean, counts by these, TMM runs on the result. Relative lengths are written, as TMM reads
    its counts in several jobs, each of which would sort all genes anew.
    """
    w = Window.partitionBy("gene_id")
    rel = kept(lengths.select("sample_id", "gene_id", "n", (F.col("length") / F.exp(F.avg(F.log("length")).over(w))).alias("rel")), "relative")
    factors = tmm_factors(rel.select("sample_id", "gene_id", (F.col("n") / F.col("rel")).alias("n")))
    return rel.join(factors, "sample_id").select("sample_id", "gene_id", F.log(F.col("rel") * F.col("library") * F.col("tmm_factor")).alias("offset"))


def zero_libraries(counts: DataFrame) -> DataFrame:
    """Samples without a count left; they stop an analysis."""
    return library_sizes(counts).where("library = 0").select("sample_id")
