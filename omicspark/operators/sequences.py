"""Sequences and reads: genome statistics, ids, strandedness, read QC and subsampling."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import cigar_ops, flag_set, reference_steps
from .ranges import first_rows, placed

#: Splice motifs by strand, call bands and size classes.
PLUS = ("GT-AG", "GC-AG", "AT-AC")
MINUS = ("CT-AC", "CT-GC", "GT-AT")
SIZE_CLASSES = (("tiny", 10_000_000), ("small", 500_000_000), ("medium", 2_000_000_000), ("large", 5_000_000_000))
LARGEST_INDEXED = 536_870_912


def genome_stats(seqs: DataFrame, by: list[str] | None = None, prefix_bp: int | None = None) -> DataFrame:
    """Total, contigs, longest, and shares of N and lower-case bases of ``seqs(seq_id, sequence, ord)``.

    With ``prefix_bp`` the composition is of the contigs up to and with the one that reaches it, in the order of ``ord``: their lengths are
    placed in ranges, and the last contig's ``ord`` picks the sequences where they are.
    """
    by = by or []
    s = F.col("sequence")
    df = seqs.withColumn("bp", F.char_length(s).cast("long"))
    scanned = F.lit(True)
    if prefix_bp is not None:
        last = placed(df.select(*by, "ord", "bp"), by, ["ord"], F.col("bp")).where(F.col("__before") < prefix_bp).groupBy(*[F.col(c).alias(f"__k_{c}") for c in by]).agg(F.max("ord").alias("__last"))
        if by:
            df = df.join(last, reduce(and_, [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in by]), "left")
        else:
            df = df.withColumn("__last", F.lit(last.first()["__last"]))  # one key of all contigs
        scanned = F.coalesce(F.col("ord") <= F.col("__last"), F.lit(False))
    n = F.regexp_count(s, F.lit("[Nn]")).cast("long")
    low = F.regexp_count(s, F.lit("[a-z]")).cast("long")
    part = lambda c: F.sum(F.when(scanned, c).otherwise(0))
    out = df.groupBy(*by).agg(
        F.sum("bp").alias("total_bp"),
        F.count(F.lit(1)).alias("contigs"),
        F.max("bp").alias("max_contig_bp"),
        part(F.col("bp")).alias("composition_scanned_bp"),
        part(n).alias("n_bp"),
        part(low).alias("soft_bp"),
    )
    share = lambda c: F.when(F.col("composition_scanned_bp") > 0, F.col(c) / F.col("composition_scanned_bp"))
    return out.select(
        *by, "total_bp", "contigs", "max_contig_bp", share("n_bp").alias("n_fraction"), share("soft_bp").alias("softmask_fraction"), "composition_scanned_bp"
    )


def genome_line_stats(lines: DataFrame, prefix_bp: int | None = None) -> DataFrame:
    """The same figures per file from ``lines(path, record, at, chunk)``, sequence lines of records of any length.

    With ``prefix_bp`` the composition is of the lines up to and with the one that reaches it: their places are sums within a split
    and of the splits before, so no file is gathered.
    """
    df = lines.withColumn("bp", F.char_length("chunk").cast("long"))
    scanned = F.lit(True)
    if prefix_bp is not None:
        splits = df.groupBy(F.col("path").alias("__path"), F.col("at.block").alias("__block")).agg(F.sum("bp").alias("__bp"))
        earlier = Window.partitionBy("__path").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
        splits = splits.select("__path", "__block", F.coalesce(F.sum("__bp").over(earlier), F.lit(0)).alias("__base"))
        within = Window.partitionBy("path", "at.block").orderBy("at.i").rowsBetween(Window.unboundedPreceding, -1)
        df = df.withColumn("__in", F.coalesce(F.sum("bp").over(within), F.lit(0))).join(splits, (F.col("path") == F.col("__path")) & (F.col("at.block") == F.col("__block")))
        scanned = F.col("__in") + F.col("__base") < prefix_bp
    part = lambda c: F.sum(F.when(scanned, c).otherwise(0).cast("long"))
    per = df.groupBy("path", "record").agg(
        F.sum("bp").alias("bp"), part(F.col("bp")).alias("scanned"), part(F.regexp_count("chunk", F.lit("[Nn]"))).alias("n_bp"), part(F.regexp_count("chunk", F.lit("[a-z]"))).alias("soft_bp")
    )
    share = lambda c: F.when(F.sum("scanned") > 0, F.sum(c) / F.sum("scanned"))
    return per.groupBy("path").agg(
        F.sum("bp").alias("total_bp"), F.count(F.lit(1)).alias("contigs"), F.max("bp").alias("max_contig_bp"),
        share("n_bp").alias("n_fraction"), share("soft_bp").alias("softmask_fraction"), F.sum("scanned").alias("composition_scanned_bp"),
    )


def size_class(bp: Column) -> Column:
    out = None
    for name, top in SIZE_CLASSES:
        out = F.when(bp <= top, name) if out is None else out.when(bp <= top, name)
    return out.otherwise("huge")


def index_kind(longest: Column) -> Column:
    """Index formats that a genome's longest contig allows."""
    return F.when(longest > LARGEST_INDEXED, "csi").otherwise("both")


def evidence_mode(rna: Column, protein: Column, long_reads: Column) -> Column:
    """Label of an annotation run by the evidence at hand."""
    return (
        F.when(long_reads & rna, "dual").when(long_reads, "isoseq").when(rna & protein, "etp").when(rna, "et").when(protein, "ep").otherwise("es")
    )


def shared_ids(ids: DataFrame) -> DataFrame:
    """Ids found in more than one source of ``ids(source, seq_id)``: ``seq_id, n_sources, n_rows``."""
    return ids.groupBy("seq_id").agg(F.count_distinct("source").alias("n_sources"), F.count(F.lit(1)).alias("n_rows")).where("n_sources > 1")


def genome_chunks(lines: DataFrame, chunk_bp: int) -> DataFrame:
    """``path, chrom, chunk_no, chunk``: the genome of ``fasta_lines`` in chunks for lookups by position.

    Chunk k starts at k * ``chunk_bp`` and runs one base over, so two bases next to each other stand in one chunk. Lines know their place in their contig (``start``) and
    may be of any width, also a contig in one. Pieces of a chunk meet by its number.
    """
    placed = lines.withColumn("bp", F.length("chunk").cast("bigint"))
    first, last = F.greatest(F.floor((F.col("start") - 1) / chunk_bp), F.lit(0)), F.floor((F.col("start") + F.col("bp") - 1) / chunk_bp)
    cut = placed.where("bp > 0").select("path", "record", "seq_id", "start", "bp", F.encode("chunk", "utf-8").alias("line"), F.explode(F.sequence(first, last)).alias("chunk_no"))
    begin = F.greatest(F.col("start"), F.col("chunk_no") * chunk_bp)
    end = F.least(F.col("start") + F.col("bp"), (F.col("chunk_no") + 1) * chunk_bp + 1)
    piece = F.substring("line", (begin - F.col("start") + 1).cast("int"), (end - begin).cast("int")).cast("string")  # bytes are cut without a walk from the start
    pieces = cut.select("path", "record", "seq_id", "chunk_no", F.struct(begin.alias("at"), piece.alias("piece")).alias("p"))
    met = pieces.groupBy("path", "record", "seq_id", "chunk_no").agg(F.array_sort(F.collect_list("p")).alias("ps"))  # no more than one chunk
    return met.select("path", F.col("seq_id").alias("chrom"), "chunk_no", F.array_join("ps.piece", "").alias("chunk"))


def splice_evidence(alignments: DataFrame, chunks: DataFrame, chunk_bp: int) -> DataFrame:
    """Per spliced read its strand by the motifs at its introns: ``read_id, reverse, strands, noncanonical``.

    ``alignments(sample_id, read_id, flag, chrom, pos0, cigar)``, ``chunks(chrom, chunk_no, chunk)`` where chunk k
    starts at k * ``chunk_bp`` and runs one base over. Donor and acceptor are looked up by equi-joins.
    """
    steps = reference_steps(cigar_ops(F.col("cigar")), F.col("pos0"))
    introns = alignments.select("sample_id", "read_id", flag_set(F.col("flag"), 0x10).alias("reverse"), "chrom", F.posexplode(F.filter(steps, lambda o: o["op"] == "N")).alias("intron", "o"))
    ends = introns.select(
        "sample_id", "read_id", "reverse", "chrom", "intron",
        F.explode(F.array(F.struct(F.lit("d").alias("side"), F.col("o.pos").alias("at")), F.struct(F.lit("a").alias("side"), (F.col("o.pos") + F.col("o.len") - 2).alias("at")))).alias("e"),
    ).withColumn("chunk_no", F.floor(F.col("e.at") / chunk_bp))
    two = F.upper(F.substring("chunk", (F.col("e.at") - F.col("chunk_no") * chunk_bp + 1).cast("int"), F.lit(2)))
    looked = ends.join(chunks, ["chrom", "chunk_no"]).withColumn("two", two).repartition("sample_id", "read_id")  # one exchange for both aggregates
    motif = looked.groupBy("sample_id", "read_id", "reverse", "intron").agg(
        F.concat_ws("-", F.max(F.when(F.col("e.side") == "d", F.col("two"))), F.max(F.when(F.col("e.side") == "a", F.col("two")))).alias("motif")
    )
    strand = F.when(F.col("motif").isin(*PLUS), "+").when(F.col("motif").isin(*MINUS), "-")
    return motif.withColumn("strand", strand).groupBy("sample_id", "read_id", "reverse").agg(
        F.collect_set("strand").alias("strands"), F.count_if(F.col("strand").isNull()).alias("noncanonical")
    )


def strandedness(evidence: DataFrame, least: int = 20_000) -> DataFrame:
    """Call per sample from ``evidence(sample_id, reverse, strands, noncanonical)``."""
    one = F.size("strands") == 1
    agrees = (F.col("strands")[0] == "-") == F.col("reverse")
    out = evidence.groupBy("sample_id").agg(
        F.count_if(one & agrees).alias("agree"),
        F.count_if(one & ~agrees).alias("disagree"),
        F.count_if(F.size("strands") > 1).alias("discarded_conflict"),
        F.sum("noncanonical").alias("noncanonical"),
    )
    n = F.col("agree") + F.col("disagree")
    f = F.when(n > 0, F.col("agree") / n)
    return out.withColumn("fraction", f).withColumn("call", strand_call(f, n, least))


def strand_call(f: Column, n: Column, least: int) -> Column:
    return (
        F.when((n < least) | f.isNull(), "undetermined")
        .when(f >= 0.85, "forward")
        .when(f <= 0.15, "reverse")
        .when((f >= 0.40) & (f <= 0.60), "unstranded")
        .otherwise("ambiguous")
    )


def examined(alignments: DataFrame, order: list[str], most: int) -> DataFrame:
    """The first ``most`` usable records of each sample in file order, then first reads only; ``order`` tells the records of a sample apart."""
    usable = alignments.where(~flag_set(F.col("flag"), 0x4 | 0x100 | 0x400 | 0x800))
    first = first_rows(usable, ["sample_id"], order, most)
    return first.where(~flag_set(F.col("flag"), 0x1) | flag_set(F.col("flag"), 0x40))


def flag_counts(alignments: DataFrame, by: list[str]) -> DataFrame:
    """Records by flag: total, mapped, secondary, supplementary, duplicate, paired, properly paired, first and second reads."""
    masks = {"secondary": 0x100, "supplementary": 0x800, "duplicates": 0x400, "paired": 0x1, "proper": 0x2, "read1": 0x40, "read2": 0x80}
    return alignments.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~flag_set(F.col("flag"), 0x4)).alias("mapped"),
        *[F.count_if(flag_set(F.col("flag"), m)).alias(k) for k, m in masks.items()],
    )


def chromosome_counts(alignments: DataFrame) -> DataFrame:
    return alignments.groupBy("chrom").agg(
        F.count_if(~flag_set(F.col("flag"), 0x4)).alias("mapped"), F.count_if(flag_set(F.col("flag"), 0x4)).alias("unmapped")
    )


def read_qc(reads: DataFrame, by: list[str]) -> DataFrame:
    """Reads, bases, mean length and GC share of ``reads(seq)``."""
    bases = F.sum(F.char_length("seq").cast("long"))
    gc = F.sum(F.regexp_count("seq", F.lit("[GCgc]")).cast("long"))
    return reads.groupBy(*by).agg(
        F.count(F.lit(1)).alias("reads"), bases.alias("bases"), (bases / F.count(F.lit(1))).alias("mean_length"), (gc / bases).alias("gc_fraction")
    )


def quality_by_cycle(reads: DataFrame, by: list[str], most_cycles: int | None = None) -> DataFrame:
    """Mean quality of each position of ``reads(qual)``, ASCII less 33."""
    q = F.split("qual", "") if most_cycles is None else F.split(F.substring("qual", 1, most_cycles), "")
    cells = reads.select(*by, F.posexplode(q).alias("cycle", "c")).where("c <> ''")
    return cells.groupBy(*by, "cycle").agg(F.avg(F.ascii("c") - 33).alias("mean_quality"), F.count(F.lit(1)).alias("n"))


def long_enough(reads: DataFrame, least: int = 36) -> DataFrame:
    """Reads of ``least`` bases or more; of a pair both must have them."""
    w = Window.partitionBy("read_id")
    return reads.withColumn("__min", F.min(F.char_length("seq")).over(w)).where(F.col("__min") >= least).drop("__min")


def first_reads(reads: DataFrame, n: int, by: list[str], order: list[str]) -> DataFrame:
    """The first ``n`` reads of each file, both mates of a pair at the same place; ``order`` tells the reads of a file apart."""
    return first_rows(reads, by, order, n)


def sampled_reads(reads: DataFrame, n: int, seed: int) -> DataFrame:
    """``n`` read ids by a seeded hash; mates share their id and so their fate."""
    ids = reads.select("read_id").distinct().orderBy(F.md5(F.concat(F.lit(f"{seed}:"), "read_id")), "read_id").limit(n)
    return reads.join(ids, "read_id", "left_semi")
