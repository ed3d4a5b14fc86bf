"""Haplotype pairs: splitting a count matrix by alleles, and pairing ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clean_pairs(pairs: DataFrame, order: str) -> DataFrame:
    """Pairs with both sides, the last row of a side winning: ``ha_gene_id, hb_gene_id``."""
    full = pairs.where("trim(coalesce(ha_gene_id, '')) <> '' AND trim(coalesce(hb_gene_id, '')) <> ''")
    last = full.groupBy("ha_gene_id").agg(F.max_by("hb_gene_id", order).alias("hb_gene_id"), F.max(order).alias(order))
    return last.groupBy("hb_gene_id").agg(F.max_by("ha_gene_id", order).alias("ha_gene_id")).select("ha_gene_id", "hb_gene_id")


def split_by_haplotype(counts: DataFrame, pairs: DataFrame, compatible: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Summed pairs, the two sides of each pair, and genes in no pair.

    ``counts(sample_id, gene_id, n)``; a side absent from the matrix counts 0, whichever it is. With
    ``compatible`` a pair whose first side is absent is left out, as in the original tool.
    """
    long = pairs.select(
        "ha_gene_id", "hb_gene_id", F.explode(F.array(*[F.struct(F.lit(h).alias("haplotype"), F.col(c).alias("gene_id")) for h, c in (("HA", "ha_gene_id"), ("HB", "hb_gene_id"))])).alias("s")
    ).select("ha_gene_id", "hb_gene_id", "s.haplotype", "s.gene_id")
    hits = counts.join(long, "gene_id")
    wide = hits.groupBy("sample_id", "ha_gene_id", "hb_gene_id").agg(
        F.coalesce(F.sum(F.when(F.col("haplotype") == "HA", F.col("n"))), F.lit(0)).alias("ha"),
        F.coalesce(F.sum(F.when(F.col("haplotype") == "HB", F.col("n"))), F.lit(0)).alias("hb"),
        F.count_if(F.col("haplotype") == "HA").alias("__ha_seen"),
    )
    if compatible:
        wide = wide.where("__ha_seen > 0")
    pair_id = F.concat_ws("|", "ha_gene_id", "hb_gene_id").alias("pair_id")
    summed = wide.select("sample_id", pair_id, (F.col("ha") + F.col("hb")).alias("n"))
    sides = F.array(
        F.struct(F.lit("HA").alias("haplotype"), F.col("ha_gene_id").alias("gene_id"), F.col("ha").alias("n")),
        F.struct(F.lit("HB").alias("haplotype"), F.col("hb_gene_id").alias("gene_id"), F.col("hb").alias("n")),
    )
    specific = wide.select("sample_id", pair_id, F.explode(sides).alias("s")).select("sample_id", "pair_id", "s.*")
    paired = long.select("gene_id").distinct()
    return summed, specific, counts.join(paired, "gene_id", "left_anti")


def pair_by_stem(ids: DataFrame, first: str = "A", second: str = "B") -> DataFrame:
    """Pairs of ids that differ in their last letter: ``stem, ha_gene_id, hb_gene_id``."""
    stem = F.expr("substring(gene_id, 1, length(gene_id) - 1)")
    side = lambda s, name: ids.where(F.right("gene_id", F.lit(1)) == s).select(stem.alias("stem"), F.col("gene_id").alias(name))
    return side(first, "ha_gene_id").join(side(second, "hb_gene_id"), "stem")


def renamed_ids(ids: DataFrame, allele: str) -> DataFrame:
    """``seq_id, stem, new_id`` of ids that end in the allele's letter, which an underscore then sets apart."""
    stem = F.expr("substring(seq_id, 1, length(seq_id) - 1)")
    return ids.where(F.col("seq_id").endswith(allele)).select("seq_id", stem.alias("stem"), F.concat(stem, F.lit(f"_{allele}")).alias("new_id"))


def rename_problems(ha: DataFrame, hb: DataFrame) -> DataFrame:
    """``rule, key, detail``: ids of either side ``(seq_id)`` without their letter, and new ids that are not unique."""
    bad = [ids.where(~F.col("seq_id").endswith(x)).select(F.lit("wrong_letter").alias("rule"), F.col("seq_id").alias("key"), F.lit(x).alias("detail")) for ids, x in ((ha, "A"), (hb, "B"))]
    made = renamed_ids(ha, "A").unionByName(renamed_ids(hb, "B")).groupBy("new_id").count().where("count > 1")
    return bad[0].unionByName(bad[1]).unionByName(made.select(F.lit("collision").alias("rule"), F.col("new_id").alias("key"), F.col("count").cast("string").alias("detail")))


def unpaired_share(counts: DataFrame, unpaired: DataFrame, most: float = 0.3) -> DataFrame:
    """One row: genes, unpaired genes, their share, and whether it deserves a warning."""
    both = counts.select("gene_id", F.lit(0).alias("alone")).unionByName(unpaired.select("gene_id", F.lit(1).alias("alone"))).groupBy("gene_id").agg(F.max("alone").alias("alone"))
    share = F.sum("alone") / F.count(F.lit(1))
    return both.agg(F.count(F.lit(1)).alias("n_genes"), F.sum("alone").alias("n_unpaired"), share.alias("share"), (share > most).alias("warning"))
