"""Range joins on genomic intervals by bins, and what is built on them."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import cigar_ops, flag_set, reference_steps
from ..sources.scratch import kept


#: Bins of a level are as wide as this many of the level below; the widest of the last level hold any coordinate.
FACTOR, LEVELS = 8, 18

#: A block's bounds on either side, and whether it is turned round.
SPAN = ["chrom", "start", "end", "b_chrom", "b_start", "b_end", "inverted"]


def _level(start: Column, end: Column, width: int) -> Column:
    """The first level whose bins are at least as wide as the interval, so it lies in one bin or two."""
    size = (end - start + 1).cast("bigint")
    return F.coalesce(*[F.when(size <= min(width * FACTOR**m, 2**62), F.lit(m)) for m in range(LEVELS)], F.lit(LEVELS - 1))


def _bin(at: Column, level: Column, width: int) -> Column:
    return F.floor(at / (F.lit(width) * F.call_function("shiftleft", F.lit(1).cast("bigint"), (3 * level).cast("int"))))


def _levels(spans: DataFrame, start: str, end: str, width: int) -> list[int]:
    """Levels in use: at most ``LEVELS`` numbers."""
    used = spans.agg(F.collect_set(_level(F.col(start), F.col(end), width)).alias("m")).first()["m"]
    return sorted(used)


def _dealt(rows: DataFrame, start: str, end: str, width: int, at: list[Column], prefix: str) -> DataFrame:
    """``rows`` in the bins of each level of ``at``, structs of ``role`` and ``level``; null levels are left out."""
    told = rows.withColumn(f"{prefix}at", F.explode(F.filter(F.array(*at), lambda x: x["level"].isNotNull())))
    level = F.col(f"{prefix}at.level")
    bins = F.array_distinct(F.array(_bin(F.col(start), level, width), _bin(F.col(end), level, width)))
    return told.withColumn(f"{prefix}bin", F.explode(bins)).select("*", F.col(f"{prefix}at.role").alias(f"{prefix}role"), level.alias(f"{prefix}level")).drop(f"{prefix}at")


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], width: int, lo: tuple[str, str] = ("start", "end"), ro: tuple[str, str] = ("r_start", "r_end"), short: bool = False) -> DataFrame:
    """Inner join of closed intervals of the same ``keys`` that overlap, each pair once.

    Bins come in levels, each ``FACTOR`` times as wide as the one below; an interval belongs to the first level whose bins are as wide as itself and lies in one or two of
    them, however long it is. Of two intervals the shorter looks for the longer in the latter's level, so there is an equi-join on keys, level and bin with few rows
    per interval; a pair is kept in the first bin that both have. Levels in use are asked for first, a column-pruned scan of either side; ``short`` says that no interval of ``left`` is longer
    than ``width`` and spares one. ``width`` should be near the usual length of the shorter side's intervals. A bin that many rows share is split as a skewed join partition.
    """
    mine, theirs = [0] if short else _levels(left, *lo, width), _levels(right, *ro, width)
    a_level, b_level = _level(F.col(lo[0]), F.col(lo[1]), width), _level(F.col(ro[0]), F.col(ro[1]), width)
    place = lambda role, level: F.struct(F.lit(role).alias("role"), level.cast("int").alias("level"))
    # Role 0: the right one is of that level, the left one not longer; role 1: the left one is of that level, the right one shorter.
    a_at = [place(0, F.when(a_level <= m, F.lit(m))) for m in theirs] + [place(1, F.when(a_level == m, F.lit(m))) for m in mine if any(j < m for j in theirs)]
    b_at = [place(0, b_level)] + [place(1, F.when(b_level < m, F.lit(m))) for m in mine]
    a = _dealt(left, *lo, width, a_at or [place(0, F.lit(None))], "__a_")
    b = _dealt(right, *ro, width, b_at, "__b_")
    for k in keys:
        b = b.withColumnRenamed(k, f"__{k}")
    on = (F.col("__a_role") == F.col("__b_role")) & (F.col("__a_level") == F.col("__b_level")) & (F.col("__a_bin") == F.col("__b_bin"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"__{k}"))
    on = on & (F.col(lo[0]) <= F.col(ro[1])) & (F.col(ro[0]) <= F.col(lo[1]))
    first = F.col("__a_bin") == _bin(F.greatest(F.col(lo[0]), F.col(ro[0])), F.col("__a_level"), width)
    return a.join(b, on).where(first).drop(*[f"__{s}_{c}" for s in "ab" for c in ("bin", "role", "level")], *[f"__{k}" for k in keys])


def points_in(points: DataFrame, spans: DataFrame, keys: list[str], pos: str, width: int, anti: bool = False) -> DataFrame:
    """Rows of ``points`` whose position lies in some interval of ``spans(keys, start, end)``, or in none.

    A point asks one bin of each level in use, one after the other and only as long as it is in none: an equi-join per level on keys and bin.
    """
    level = _level(F.col("start"), F.col("end"), width)
    outside, inside = points, []
    for m in _levels(spans, "start", "end", width):
        of_level = _dealt(spans.where(level == m).select(*keys, "start", "end"), "start", "end", width, [F.struct(F.lit(0).alias("role"), F.lit(m).alias("level"))], "__b_")
        b = of_level.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("start").alias("__start"), F.col("end").alias("__end"), "__b_bin")
        on = (_bin(F.col(pos), F.lit(m), width) == F.col("__b_bin")) & (F.col(pos) >= F.col("__start")) & (F.col(pos) <= F.col("__end"))
        for k in keys:
            on = on & (F.col(k) == F.col(f"__{k}"))
        inside.append(outside.join(b, on, "left_semi"))
        outside = outside.join(b, on, "left_anti")
    return outside if anti else reduce(DataFrame.unionByName, inside, points.limit(0))


def genes_in_blocks(genes: DataFrame, blocks: DataFrame, width: int) -> DataFrame:
    """Genes contained in blocks of their chromosome: ``block_id, gene_id, chrom, start, end``.

    ``genes(gene_id, chrom, start, end)``, ``blocks(block_id, chrom, start, end)``; containment, not overlap. A block's bounds may
    stand either way round, as those of an inverted one do. A gene looks up its start in each level of bins that blocks use.
    """
    b = blocks.select("block_id", F.col("chrom").alias("__chrom"), F.least("start", "end").alias("lo"), F.greatest("start", "end").alias("hi"))
    place = lambda level: F.struct(F.lit(0).alias("role"), level.cast("int").alias("level"))
    levels = _levels(b, "lo", "hi", width)
    b = _dealt(b, "lo", "hi", width, [place(_level(F.col("lo"), F.col("hi"), width))], "__b_")
    g = _dealt(genes.select("gene_id", "chrom", "start", "end"), "start", "start", width, [place(F.lit(m)) for m in levels] or [place(F.lit(None))], "__a_")
    on = (
        (F.col("chrom") == F.col("__chrom"))
        & (F.col("__a_level") == F.col("__b_level"))
        & (F.col("__a_bin") == F.col("__b_bin"))
        & (F.col("start") >= F.col("lo"))
        & (F.col("end") <= F.col("hi"))
    )
    return g.join(b, on).select("block_id", "gene_id", "chrom", "start", "end")


def pair_by_position(ha: DataFrame, hb: DataFrame, inverted: DataFrame) -> DataFrame:
    """Nth gene of each block's first side with the Nth of its second, where both have as many.

    ``ha`` and ``hb`` are from ``genes_in_blocks``; ``inverted(block_id, inverted)`` turns the second side round.
    """
    by = ["chrom", "start", "end", "gene_id"]
    w = Window.partitionBy("block_id")
    a = ha.select("block_id", F.col("gene_id").alias("ha_gene_id"), F.row_number().over(w.orderBy(*by)).alias("rank"), F.count(F.lit(1)).over(w).alias("n_a"))
    turned = hb.join(inverted, "block_id").withColumn("__key", F.when(F.col("inverted"), -F.col("start")).otherwise(F.col("start")))
    order = ["__key", F.when(F.col("inverted"), F.lit(0)).otherwise(F.col("end")), "gene_id"]
    b = turned.select(
        "block_id", F.col("gene_id").alias("hb_gene_id"), F.row_number().over(w.orderBy(*order)).alias("rank"), F.count(F.lit(1)).over(w).alias("n_b")
    )
    return a.join(b, ["block_id", "rank"]).where("n_a = n_b").select("block_id", "rank", "ha_gene_id", "hb_gene_id")


def pairs_of_spans(a_genes: DataFrame, b_genes: DataFrame, blocks: DataFrame, width: int) -> DataFrame:
    """``pair_by_position`` for each different place of blocks: ``chrom, start, end, b_chrom, b_start, b_end, inverted, rank, ha_gene_id, hb_gene_id``.

    ``blocks`` has these seven columns, the block's bounds on either side. Blocks of the same bounds have the same pairs, so genes are looked up and ranked once for all of them. The
    result is written, and joined to blocks by their bounds it gives the pairs of each.
    """
    spans = kept(blocks.select(*SPAN).distinct().withColumn("block_id", F.monotonically_increasing_id()), "spans")
    ha = genes_in_blocks(a_genes, spans, width)
    hb = genes_in_blocks(b_genes, spans.select("block_id", F.col("b_chrom").alias("chrom"), F.col("b_start").alias("start"), F.col("b_end").alias("end")), width)
    pairs = pair_by_position(ha, hb, spans.select("block_id", "inverted"))
    return kept(spans.join(pairs, "block_id").drop("block_id"), "pairs")


def pairs_of_blocks(pairs: DataFrame, blocks: DataFrame) -> DataFrame:
    """``block_id, rank, ha_gene_id, hb_gene_id`` of each row of ``blocks(block_id, ...)``, with ``pairs`` of ``pairs_of_spans``; ids are of one row each."""
    there = pairs.select(*[F.col(c).alias(f"__{c}") for c in SPAN], "rank", "ha_gene_id", "hb_gene_id")
    on = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in SPAN])
    return blocks.where("block_id IS NOT NULL").join(there, on).select("block_id", "rank", "ha_gene_id", "hb_gene_id")


def allele_table(pairs: DataFrame, ha_genes: DataFrame, hb_genes: DataFrame) -> DataFrame:
    """Pairs, then the unpaired genes of either side with the other side blank. ``pairs`` is read three times: give a written table (``kept``)."""
    a = ha_genes.select(F.col("gene_id").alias("ha_gene_id")).join(pairs, "ha_gene_id", "left_anti")
    b = hb_genes.select(F.col("gene_id").alias("hb_gene_id")).join(pairs, "hb_gene_id", "left_anti")
    both = pairs.select("ha_gene_id", "hb_gene_id")
    return both.unionByName(a, allowMissingColumns=True).unionByName(b, allowMissingColumns=True)


def phased_sites(snps: DataFrame, genes: DataFrame | None = None, width: int = 10_000) -> DataFrame:
    """Single-base sites phased ``0|1``, upper case, inside genes if these are given."""
    base = lambda c: F.upper(F.col(c)).isin("A", "C", "G", "T")
    valid = snps.where(base("ref") & base("alt"))
    if genes is not None:
        valid = points_in(valid, genes, ["chrom"], "pos", width)
    return valid.select("chrom", "pos", F.upper("ref").alias("ref"), F.upper("alt").alias("alt"), F.lit("0|1").alias("gt"))


def aligned_blocks(alignments: DataFrame) -> DataFrame:
    """Aligned stretches of reads: their columns with ``start, end`` (1-based, closed) and ``seq_at``, the base of the read at ``start``, per M, = or X operation."""
    steps = reference_steps(cigar_ops(F.col("cigar")), F.col("pos0"))
    return (
        alignments.select("*", F.explode(F.filter(steps, lambda o: o["op"].isin("M", "=", "X"))).alias("o"))
        .withColumn("start", F.col("o.pos") + 1)
        .withColumn("end", F.col("o.pos") + F.col("o.len"))
        .withColumn("seq_at", F.col("o.seq_at") + 1)
        .drop("o")
    )


def base_at(reads: DataFrame, pos: Column) -> Column:
    """Place in the read of reference position ``pos``: whole reads start at ``start``, aligned blocks at their ``seq_at``."""
    first = F.col("seq_at") if "seq_at" in reads.columns else F.lit(1)
    return (pos - F.col("start") + first).cast("int")


def kept_alignments(alignments: DataFrame, first_only: bool = True) -> DataFrame:
    """Without unmapped, secondary, duplicate and supplementary records, and of pairs the first read only."""
    kept = alignments.where(~flag_set(F.col("flag"), 0x4 | 0x100 | 0x400 | 0x800))
    return kept.where(~flag_set(F.col("flag"), 0x1) | flag_set(F.col("flag"), 0x40)) if first_only else kept


def merged_spans(rows: DataFrame, by: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """``by, start, end``: the stretches that intervals of one ``by`` cover together, overlapping and adjoining ones as one."""
    w = Window.partitionBy(*by).orderBy(start, end)
    reached = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = rows.select(*by, start, end).withColumn("__new", F.when(F.col(start) <= reached + 1, 0).otherwise(1))
    named = fresh.withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return named.groupBy(*by, "__run").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("__run")


def fragment_status(reads: DataFrame, least_mapq: int = 10) -> DataFrame:
    """``read_id, status`` of every fragment from all of its rows, null if it is to be counted.

    ``__not_aligned`` if none of its mates is aligned; else the aligned ones decide: ``__alignment_not_unique`` if one of them has several places,
    else ``__too_low_aQual`` if the quality of one is below ``least_mapq``.
    """
    aligned = F.coalesce(F.col("mapped"), F.lit(False))
    return reads.groupBy("read_id").agg(
        F.when(~F.max(aligned), "__not_aligned")
        .when(F.max(F.when(aligned, F.col("nh"))) > 1, "__alignment_not_unique")
        .when(F.min(F.when(aligned, F.col("mapq"))) < least_mapq, "__too_low_aQual")
        .alias("status")
    )


#: How the genes at the positions of a fragment make its set of genes.
MODES = ("union", "intersection-strict", "intersection-nonempty")


def count_features(
    reads: DataFrame, exons: DataFrame, width: int, least_mapq: int = 10, stranded: str = "forward", mode: str = "union", fractional: bool = False
) -> DataFrame:
    """Fragments per gene, with the counters of what was not assigned: ``category, n``.

    ``reads(read_id, chrom, start, end, strand, mapq, nh, mapped)``, a row per read or per aligned block; the rows of one id, mates and blocks,
    are one fragment with one status (``fragment_status``). ``exons(gene_id, chrom, start, end, strand)``. ``stranded``: reads lie on their gene's strand
    (``forward``), on the other (``reverse``), or on either (``unstranded``); the second mate's strand is to be turned before.

    Each position of a fragment has the set of genes with an exon there. ``mode`` makes one set of these: all genes of any position (``union``), those of
    every position (``intersection-strict``), or of every position that has any (``intersection-nonempty``). One gene: counted; none: ``__no_feature``; several: ``__ambiguous``, or with ``fractional``
    an equal share for each. Sets are told from lengths: a gene is at every position if what its exons cover of the fragment is as long as the fragment, and at every
    position with a gene if it is as long as what all genes cover, so no position or elementary segment becomes a row.
    """
    sides = {"forward": "read_strand = exon_strand", "reverse": "read_strand <> exon_strand", "unstranded": "true"}
    if mode not in MODES:
        raise ValueError(f"mode {mode} is none of {MODES}")
    status = fragment_status(reads, least_mapq)
    counted = status.where("status IS NULL").select("read_id")
    aligned = reads.where("mapped").join(counted, "read_id", "left_semi").select("read_id", "chrom", "start", "end", F.col("strand").alias("read_strand"))
    genes = exons.select("gene_id", "chrom", F.col("start").alias("r_start"), F.col("end").alias("r_end"), F.col("strand").alias("exon_strand"))
    if mode == "union":
        hits = overlap_join(aligned, genes, ["chrom"], width).where(sides[stranded])
        held = hits.select("read_id", "gene_id").distinct()
    else:
        held = _genes_throughout(aligned, genes, width, sides[stranded], mode)
    size = held.groupBy("read_id").agg(F.count(F.lit(1)).alias("k"), F.min("gene_id").alias("gene_id"))
    called = counted.join(size, "read_id", "left")
    if fractional:
        shares = held.join(size.select("read_id", "k"), "read_id").select(F.col("gene_id").alias("category"), (1 / F.col("k")).alias("n"))
        none = called.where("k IS NULL").select(F.lit("__no_feature").alias("category"), F.lit(1.0).alias("n"))
        rest = status.where("status IS NOT NULL").select(F.col("status").alias("category"), F.lit(1.0).alias("n"))
        return shares.unionByName(none).unionByName(rest).groupBy("category").agg(F.sum("n").alias("n"))
    named = called.select(F.when(F.col("k").isNull(), "__no_feature").when(F.col("k") > 1, "__ambiguous").otherwise(F.col("gene_id")).alias("category"))
    rest = status.where("status IS NOT NULL").select(F.col("status").alias("category"))
    return named.unionByName(rest).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def _genes_throughout(aligned: DataFrame, genes: DataFrame, width: int, side: str, mode: str) -> DataFrame:
    """``read_id, gene_id`` of genes at every position of a fragment, or at every one that has a gene."""
    place = ["read_id", "chrom", "read_strand"]
    spans = kept(merged_spans(aligned, place), "fragments")
    exons = merged_spans(genes, ["gene_id", "chrom", "exon_strand"], "r_start", "r_end")
    hits = overlap_join(spans, exons, ["chrom"], width).where(side)
    part = hits.select(*place, "gene_id", F.greatest("start", "r_start").alias("from"), F.least("end", "r_end").alias("to"))
    # A gene may have exons on both strands, which may overlap where strands do not matter.
    mine = merged_spans(part, [*place, "gene_id"], "from", "to").groupBy("read_id", "gene_id").agg(F.sum(F.expr("to - from + 1")).alias("covered"))
    if mode == "intersection-strict":
        asked = spans.groupBy("read_id").agg(F.sum(F.expr("end - start + 1")).alias("asked"))
    else:
        asked = merged_spans(part, place, "from", "to").groupBy("read_id").agg(F.sum(F.expr("to - from + 1")).alias("asked"))
    return mine.join(asked, "read_id").where("covered = asked").select("read_id", "gene_id")


def split_by_snps(reads: DataFrame, snps: DataFrame, width: int) -> DataFrame:
    """``read_id, route``: reads with a variant in one of their rows (whole reads or aligned blocks) are to be mapped again, the others kept."""
    spans = reads.select("read_id", "chrom", "start", "end")
    if "seq_at" in reads.columns:
        spans = kept(spans, "spans")  # aligned blocks: CIGARs are parsed once, not for the levels, the join and the ids
    points = snps.select("chrom", F.col("pos").alias("r_start"), F.col("pos").alias("r_end"))
    hit = overlap_join(spans, points, ["chrom"], width).select("read_id", F.lit(True).alias("hit"))
    told = spans.select("read_id", F.lit(False).alias("hit")).unionByName(hit).groupBy("read_id").agg(F.max("hit").alias("hit"))
    return told.select("read_id", F.when(F.col("hit"), "to_remap").otherwise("keep").alias("route"))


def swapped_reads(reads: DataFrame, snps: DataFrame, width: int) -> DataFrame:
    """Reads over variants with the base at each replaced by the other allele: ``read_id, pos, seq``."""
    points = snps.select("chrom", F.col("pos").alias("r_start"), F.col("pos").alias("r_end"), "ref", "alt")
    hits = overlap_join(reads, points, ["chrom"], width)
    at = base_at(reads, F.col("r_start"))
    other = F.when(F.substring("seq", at, F.lit(1)) == F.col("ref"), F.col("alt")).otherwise(F.col("ref"))
    return hits.where(at <= F.length("seq")).select("read_id", F.col("r_start").alias("pos"), F.overlay("seq", other, at, F.lit(1)).alias("seq"))


def mapped_again(reads: DataFrame, snps: DataFrame, remapped: DataFrame, width: int) -> DataFrame:
    """Reads that a variant does not bias: those over none, and those that land at their place with the other allele.

    ``reads(read_id, mate, chrom, pos0, cigar, start, end)``; ``remapped`` has the same columns but the last two, of the reads with swapped
    alleles. Of a read all swapped forms must return: one that does not drops it.
    """
    routes = split_by_snps(reads, snps, width)
    through = reads.join(routes.where("route = 'keep'"), "read_id", "left_semi")
    again = reads.join(routes.where("route = 'to_remap'"), "read_id", "left_semi")
    place = ["read_id", "mate", "chrom", "pos0", "cigar"]
    moved = remapped.select(*place).join(again.select(*place), place, "left_anti").select("read_id").distinct()
    back = same_place(again, remapped).join(moved, "read_id", "left_anti")
    return through.unionByName(back)


def same_place(before: DataFrame, after: DataFrame) -> DataFrame:
    """Reads that map again to where they were: same id, mate, chromosome, position and CIGAR."""
    return before.join(after.select("read_id", "mate", "chrom", "pos0", "cigar"), ["read_id", "mate", "chrom", "pos0", "cigar"], "left_semi")


def allele_counts(reads: DataFrame, snps: DataFrame, width: int, least_mapq: int = 20, least_baseq: int = 10) -> DataFrame:
    """Reads with each allele per phased site: ``chrom, pos, ref, alt, a_count, b_count, total_count``.

    ``reads(chrom, start, end, seq, qual, mapq)``, ungapped reads or the aligned blocks of gapped ones; qualities are ASCII less 33.
    """
    points = snps.select("chrom", F.col("pos").alias("r_start"), F.col("pos").alias("r_end"), "ref", "alt")
    hits = overlap_join(reads.where(F.col("mapq") >= least_mapq), points, ["chrom"], width)
    at = base_at(reads, F.col("r_start"))
    seen = hits.select(
        "chrom", F.col("r_start").alias("pos"), "ref", "alt", F.substring("seq", at, F.lit(1)).alias("base"), (F.ascii(F.substring("qual", at, F.lit(1))) - 33).alias("q")
    ).where(F.col("q") >= least_baseq)
    a, b = F.col("base") == F.col("ref"), F.col("base") == F.col("alt")
    return seen.groupBy("chrom", "pos", "ref", "alt").agg(
        F.count_if(a).alias("a_count"), F.count_if(b).alias("b_count"), F.count_if(a | b).alias("total_count")
    )


def gene_allele_counts(sites: DataFrame, genes: DataFrame, width: int) -> DataFrame:
    """Allele counts of sites summed over the genes they lie in."""
    points = sites.withColumn("start", F.col("pos")).withColumn("end", F.col("pos"))
    spans = genes.select("gene_id", "chrom", F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    hits = overlap_join(points, spans, ["chrom"], width, short=True)
    return hits.groupBy("gene_id").agg(*[F.sum(c).alias(c) for c in ("a_count", "b_count", "total_count")])
