"""Readers: each gives rows with the file they came from and, where order counts, their place in it."""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import gff_attributes, number

#: Headings that sample sheets use for a column, and endings of a sample's files.
SHEET_ALIASES = {
    "sample": "sample_id", "sample_id": "sample_id", "id": "sample_id", "name": "sample_id",
    "layout": "layout", "library_layout": "layout", "type": "layout",
    "fastq_1": "fastq_1", "fastq1": "fastq_1", "r1": "fastq_1", "read1": "fastq_1", "fq1": "fastq_1",
    "fastq_2": "fastq_2", "fastq2": "fastq_2", "r2": "fastq_2", "read2": "fastq_2", "fq2": "fastq_2",
    "strandedness": "strandedness", "strand": "strandedness", "condition": "condition", "group": "condition",
    "replicate": "replicate", "rep": "replicate", "read_type": "read_type", "bam": "bam", "alignment": "bam",
    "genome_id": "genome_id", "genome": "genome_id", "use_for": "use_for",
}
HTSEQ_ENDINGS = r"(\.htseq\.tsv|\.tsv|\.txt)$"
BAM_ENDINGS = r"(\.sorted)?\.bam$"
TRIM_METRICS = {
    "reads_processed": r"Total reads processed:\s+([\d,]+)",
    "reads_with_adapters": r"Reads with adapters:\s+([\d,]+)",
    "reads_written": r"Reads written \(passing filters\):\s+([\d,]+)",
    "bp_processed": r"Total basepairs processed:\s+([\d,]+)",
    "bp_trimmed": r"Quality-trimmed:\s+([\d,]+)",
    "bp_written": r"Total written \(filtered\):\s+([\d,]+)",
}
#: Fixed value: a peptidase family code.
MEROPS_CODE = r"\b([ACGMNPSTUI]\d{1,2}[A-Z]?)\b"


#: Names of the part files of a folder that Spark or Hadoop wrote.
PART_FILE = r"/part-(?:[mr]-)?\d{5}[^/]*$"


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, "[^/]+$", 0)


def lines(spark: SparkSession, path: str | list[str], deep: bool = False) -> DataFrame:
    """``path, file, at, value`` of text files, gzip included.

    ``at`` orders the lines of a file: the split they were read in, then the place within it. Files are known by their whole path, and no line
    moves: a large file stays in its splits. The part files of a folder, as Spark writes them, are one file that has the folder's path, and follow each
    other by name. With ``deep`` folders below are read too.
    """
    found = F.col("_metadata.file_path")
    whole = F.regexp_replace(found, PART_FILE, "")
    block = F.struct(F.regexp_extract(found, PART_FILE, 0).alias("part"), F.col("_metadata.file_block_start").alias("start"))
    return spark.read.option("recursiveFileLookup", deep).text(path).select(
        whole.alias("path"),
        base_name(whole).alias("file"),
        F.struct(block.alias("block"), F.monotonically_increasing_id().alias("i")).alias("at"),
        F.rtrim(F.regexp_replace("value", "^\\x{FEFF}|\\r$", "")).alias("value"),
    )


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``lines`` with ``line``, counted from 0 in each file: a count per split, summed over the splits before (one row each)."""
    rows = lines(spark, path)
    splits = rows.groupBy(F.col("path").alias("__path"), F.col("at.block").alias("__block")).agg(F.min("at.i").alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy("__path").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("__path", "__block", (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift"))
    return rows.join(splits, (F.col("path") == F.col("__path")) & (F.col("at.block") == F.col("__block"))).select(
        "path", "file", "at", "value", (F.col("at.i") + F.col("__shift")).alias("line")
    )


def _cut(sep: str = "\t") -> Column:
    return F.split("value", sep)


def refuse_shared_names(df: DataFrame, ending: str = "") -> None:
    """Raise if two files of ``df`` have one name, which here names the sample. The list of files is the driver's own."""
    files = {re.sub(PART_FILE, "", f) for f in df.inputFiles()}
    names = Counter(re.sub(ending, "", f.rsplit("/", 1)[-1]) if ending else f.rsplit("/", 1)[-1] for f in files)
    twice = sorted(n for n, k in names.items() if k > 1)
    if twice:
        raise ValueError(f"several files for one sample: {twice[:10]}")


def read_htseq(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Genes and counters of two-column files: ``sample_id, gene_id, n`` and ``sample_id, category, n``; the last of repeated keys wins.

    The sample is the file's name without its ending; two files that would share one are refused.
    """
    text = lines(spark, path)
    refuse_shared_names(text, HTSEQ_ENDINGS)
    raw = text.where("value <> ''").select(
        F.regexp_replace("file", HTSEQ_ENDINGS, "").alias("sample_id"), "at", _cut()[0].alias("key"), F.get(_cut(), F.lit(1)).try_cast("double").cast("bigint").alias("n")
    )
    last = raw.groupBy("sample_id", "key").agg(F.max_by("n", "at").alias("n"))
    special = F.col("key").startswith("__")
    return (
        last.where(~special).withColumnRenamed("key", "gene_id"),
        last.where(special).select("sample_id", F.substring("key", 3, 1000).alias("category"), "n"),
    )


def htseq_problems(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines without exactly two fields, empty or repeated keys, and counts that are no whole numbers: ``path, rule, key``."""
    raw = lines(spark, path).where("value <> ''").select("path", F.size(_cut()).alias("k"), _cut()[0].alias("key"), F.get(_cut(), F.lit(1)).alias("n"))
    x = F.col("n").try_cast("double")
    rule = F.when(F.col("k") != 2, "fields").when(F.trim("key") == "", "empty_key").when(x.isNull() | (x < 0) | (x != F.rint(x)), "count")
    twice = raw.groupBy("path", "key").count().where("count > 1").select("path", F.lit("duplicate").alias("rule"), "key")
    return raw.select("path", rule.alias("rule"), "key").where("rule IS NOT NULL").unionByName(twice)


def read_featurecounts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``sample_id, gene_id, n`` of raw feature tables: the last column counts, its heading names the sample."""
    raw = lines(spark, path).where("value <> '' AND NOT startswith(value, '#')")
    head = raw.where("startswith(value, 'Geneid\\t')").select("path", F.regexp_replace(base_name(F.element_at(_cut(), -1)), BAM_ENDINGS, "").alias("sample_id"))
    body = raw.where("NOT startswith(value, 'Geneid\\t')").select("path", "at", _cut()[0].alias("gene_id"), F.element_at(_cut(), -1).try_cast("bigint").alias("n"))
    return body.join(head, "path").groupBy("sample_id", "gene_id").agg(F.max_by("n", "at").alias("n"))


def read_matrix(spark: SparkSession, path: str, gene_column: str | None = None) -> DataFrame:
    """``sample_id, gene_id, n`` of a wide matrix; comma or tab by the ending, quoted ids kept, ``__`` rows left out."""
    wide = spark.read.csv(path, header=True, sep="," if path.endswith(".csv") else "\t", quote='"', comment="#")
    wide = wide.toDF(*[c.lstrip("﻿") for c in wide.columns])
    gene = gene_column or wide.columns[0]
    skip = {gene, "Chr", "Start", "End", "Strand", "Length"}
    values = [c for c in wide.columns if c not in skip]
    long = wide.unpivot([F.col(f"`{gene}`")], [F.col(f"`{c}`") for c in values], "sample_id", "n").withColumnRenamed(gene, "gene_id")
    long = long.where("NOT coalesce(startswith(gene_id, '__'), false)")
    return long.select("sample_id", "gene_id", number(F.col("n")).alias("n"))


def matrix_problems(long: DataFrame, integer: bool = True) -> DataFrame:
    """What a matrix read by ``read_matrix`` must not have: ``rule, key, detail`` of empty and repeated genes and of bad counts."""
    gene, n = F.coalesce(F.trim("gene_id"), F.lit("")), F.col("n")
    bad = F.when(gene == "", "empty_gene").when(n.isNull(), "not_a_number").when(n < 0, "negative").when(F.lit(integer) & (n != F.rint(n)), "not_integer")
    cells = long.select(bad.alias("rule"), gene.alias("key"), F.col("sample_id").alias("detail")).where("rule IS NOT NULL")
    twice = long.groupBy("sample_id", "gene_id").count().where("count > 1 AND gene_id IS NOT NULL")
    return cells.unionByName(twice.select(F.lit("duplicate_gene").alias("rule"), F.col("gene_id").alias("key"), F.col("sample_id").alias("detail")))


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """``sample_id, category, n`` of a counter's summary table."""
    wide = spark.read.csv(path, header=True, sep="\t")
    long = wide.unpivot([F.col(f"`{wide.columns[0]}`")], [F.col(f"`{c}`") for c in wide.columns[1:]], "sample", "n").withColumnRenamed(wide.columns[0], "category")
    return long.select(F.regexp_replace(base_name(F.col("sample")), BAM_ENDINGS, "").alias("sample_id"), "category", F.col("n").try_cast("bigint").alias("n"))


def legacy_rows(stats: DataFrame) -> DataFrame:
    """Statistics rows with ``key``, the first of three id columns that the table has."""
    key = next((c for c in ("sample_id_original", "sample", "sample_id") if c in stats.columns), None)
    if key is None:
        raise ValueError("no sample id column in the statistics")
    return stats.withColumn("key", F.col(f"`{key}`"))


def read_salmon(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``sample_id, transcript_id, length, eff_length, tpm, num_reads``; the sample is the folder of each file."""
    df = spark.read.csv(path, header=True, sep="\t")
    named = {"Name": "transcript_id", "Length": "length", "EffectiveLength": "eff_length", "TPM": "tpm", "NumReads": "num_reads"}
    return df.select(
        F.regexp_extract("_metadata.file_path", "([^/]+)/[^/]+$", 1).alias("sample_id"),
        *[(F.col(c) if n == "transcript_id" else F.col(c).try_cast("double")).alias(n) for c, n in named.items()],
    )


def read_salmon_meta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    schema = "num_processed bigint, num_mapped bigint"
    return spark.read.schema(schema).json(path, multiLine=True).select(F.regexp_extract("_metadata.file_path", "([^/]+)/(?:aux_info/)?[^/]+$", 1).alias("sample_id"), "num_processed", "num_mapped")


def read_gff(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Features of GFF3 and GTF, attributes as a map: ``path, file, at, seqid, source, type, start, end, score, strand, phase, attrs``."""
    c = _cut()
    rows = lines(spark, path).where("value <> '' AND NOT startswith(value, '#')").where(F.size(c) >= 9)
    return rows.select(
        "path", "file", "at", c[0].alias("seqid"), c[1].alias("source"), c[2].alias("type"), c[3].try_cast("bigint").alias("start"),
        c[4].try_cast("bigint").alias("end"), c[5].alias("score"), c[6].alias("strand"), c[7].alias("phase"), gff_attributes(c[8]).alias("attrs"),
    )


def genes_of(gff: DataFrame) -> DataFrame:
    return gff.where("type = 'gene'").select(F.col("seqid").alias("chrom"), "start", "end", F.col("attrs")["ID"].alias("gene_id"))


def with_transcripts(gff: DataFrame) -> DataFrame:
    """Features of the files that hold a transcript at all; the others would only add noise to a merge."""
    return gff.join(gff.where("type = 'transcript'").select("path").distinct(), "path", "left_semi")


def read_fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``path, file, ord, seq_id, descr, sequence``, a record in a row; contigs near 2 GB need ``fasta_lines``."""
    df = spark.read.option("lineSep", "\n>").text(path).select(
        F.col("_metadata.file_path").alias("path"), base_name(F.col("_metadata.file_path")).alias("file"), F.monotonically_increasing_id().alias("ord"), F.regexp_replace("value", "^>", "").alias("r")
    )
    head = F.regexp_replace(F.substring_index("r", "\n", 1), "\\r$", "")
    body = F.regexp_replace(F.expr("substring(r, length(substring_index(r, '\n', 1)) + 1)"), "\\s+", "")
    return df.where("trim(r) <> ''").select("path", "file", "ord", F.regexp_extract(head, r"^(\S+)", 1).alias("seq_id"), F.trim(F.regexp_replace(head, r"^\S+", "")).alias("descr"), body.alias("sequence"))


def _told_in_split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """FASTA ``path, at, value`` in the order of their splits, with ``own``, the number of the header line above in the split and ``head``, its text (null before the first), and
    ``before``, the bases between that header, or the beginning of the split, and the line. A batch takes from the one before only its last line's state.
    """
    place, own, head, sum_before = None, None, None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        path, at, value = batch.columns
        block, number = at.flatten()
        part, start = block.flatten()
        is_head = pc.starts_with(value, ">").to_numpy(zero_copy_only=False)
        bases = np.where(is_head, 0, pc.utf8_length(pc.utf8_trim(value, " ")).to_numpy(zero_copy_only=False)).astype(np.int64)
        fresh = np.zeros(n, bool)  # the first line of a split
        fresh[0] = (path[0].as_py(), part[0].as_py(), start[0].as_py()) != place
        for c in (path, part, start):
            fresh[1:] |= pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        at_row = np.arange(n)
        begin = np.maximum.accumulate(np.where(is_head | fresh, at_row, -1))  # the header or first line of a split that a line follows
        upto = np.cumsum(bases) - bases
        before = upto - np.where(begin >= 0, upto[begin], -sum_before)
        above = np.where(begin >= 0, np.where(is_head[begin], begin, -1), -2)  # a header's row, no header yet, or what the batch before left
        row = pa.array(above, mask=above < 0)
        owns, heads = pc.take(number, row), pc.take(value, row)
        if above[0] == -2 and own is not None:
            carried = pa.array(above == -2)
            owns, heads = pc.if_else(carried, pa.scalar(own, owns.type), owns), pc.if_else(carried, pa.scalar(head, heads.type), heads)
        place = path[n - 1].as_py(), part[n - 1].as_py(), start[n - 1].as_py()
        own, head, sum_before = owns[n - 1].as_py(), heads[n - 1].as_py(), int(before[-1] + bases[-1])
        yield pa.RecordBatch.from_arrays([path, at, value, owns, heads, pa.array(before)], names=["path", "at", "value", "own", "head", "before"])


def _ends_of_splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last lines of splits, and of batches, of what ``_told_in_split`` tells, with the bases up to and with each."""
    for told in _told_in_split(batches):
        path, at, value, owns, heads, before = told.columns
        block, number = at.flatten()
        last = np.ones(told.num_rows, bool)
        for c in (path, *block.flatten()):
            last[:-1] &= pc.equal(c.slice(1), c.slice(0, told.num_rows - 1)).to_numpy(zero_copy_only=False)
        last[:-1] = ~last[:-1]
        pick = pa.array(np.flatnonzero(last))
        bases = pc.if_else(pc.starts_with(value, ">"), 0, pc.utf8_length(pc.utf8_trim(value, " ")))
        upto = pc.add(before, pc.cast(bases, pa.int64()))
        yield pa.RecordBatch.from_arrays([pc.take(c, pick) for c in (path, block, number, owns, heads, upto)], names=["path", "block", "i", "own", "head", "tail"])


def fasta_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``path, file, record, seq_id, at, chunk, start``: sequence lines with the record they belong to, so that no contig stands in one row.

    A line belongs to the last header before it in its split, or else to the last one of the splits before. ``start`` is the number of bases of the same record before the line. Both
    are told where a split is read, from line to line, and one row per split says how it ends, so no line moves.
    """
    rows = lines(spark, path).select("path", "at", "value")
    at = rows.schema["at"].dataType
    ends = rows.mapInArrow(_ends_of_splits, f"path string, block {at['block'].dataType.simpleString()}, i bigint, own bigint, head string, tail bigint")
    splits = ends.groupBy("path", "block").agg(F.max_by(F.struct("own", "head", "tail"), "i").alias("e")).select(F.col("path").alias("__path"), F.col("block").alias("__block"), "e.*")
    order = Window.partitionBy("__path").orderBy("__block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    header = F.struct(F.struct(F.col("__block").alias("block"), F.col("own").alias("i")).alias("at"), F.col("head").alias("value"))
    splits = splits.withColumn("__all", F.coalesce(F.sum("tail").over(earlier), F.lit(0)))
    begun = F.col("own").isNotNull()
    splits = splits.select(
        "__path", "__block", F.last(F.when(begun, header), ignorenulls=True).over(earlier).alias("__carried"),
        (F.col("__all") - F.last(F.when(begun, F.col("__all")), ignorenulls=True).over(earlier)).alias("__start"),
    )
    marked = rows.mapInArrow(_told_in_split, f"path string, at {at.simpleString()}, value string, own bigint, head string, before bigint").where("NOT startswith(value, '>') AND value <> ''")
    joined = marked.join(F.broadcast(splits), (F.col("path") == F.col("__path")) & (F.col("at.block") == F.col("__block")))
    here = F.struct(F.struct(F.col("at.block").alias("block"), F.col("own").alias("i")).alias("at"), F.col("head").alias("value"))
    own = F.col("own").isNotNull()
    owner = F.when(own, here).otherwise(F.col("__carried"))
    told = joined.select(
        "path", base_name(F.col("path")).alias("file"), owner["at"].alias("record"), F.regexp_extract(F.when(own, F.col("head")).otherwise(F.col("__carried.value")), r"^>\s*(\S*)", 1).alias("seq_id"),
        "at", F.trim("value").alias("chunk"), (F.col("before") + F.when(own, 0).otherwise(F.col("__start"))).alias("start"),
    )
    return told.where("record IS NOT NULL")


def fasta_ids(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``path, source, seq_id``: first words of the header lines."""
    return spark.read.text(path).where("startswith(value, '>')").select(
        F.col("_metadata.file_path").alias("path"), base_name(F.col("_metadata.file_path")).alias("source"), F.regexp_extract("value", r"^>\s*(\S*)", 1).alias("seq_id")
    )


def read_fastq(spark: SparkSession, path: str | list[str], split_bytes: int | None = None) -> DataFrame:
    """``path, file, ord, read_id, seq, qual`` of four-line records; mate endings are cut from ids. ``ord`` rises within a file.

    Files are read in ranges of ``split_bytes`` (by default Spark's own) that begin with the first record in them; packed files are one range. In a store that only
    Spark's readers open, lines are numbered and gathered instead, which moves them.
    """
    from .fastq import Fastq

    files = listed(spark, path)
    if not reachable([uri for uri, _ in files]):
        return _fastq_lines(spark, path)
    size = split_bytes or int(spark.conf.get("spark.sql.files.maxPartitionBytes").removesuffix("b"))
    spark.dataSource.register(Fastq)
    rows = spark.read.format(Fastq.name()).option("files", json.dumps(files)).option("bytes", size).load()
    clean = lambda c: F.rtrim(F.regexp_replace(c, "^\\x{FEFF}|\\r$", ""))
    rows = rows.select("path", base_name(F.col("path")).alias("file"), "ord", clean("h").alias("h"), clean("seq").alias("seq"), clean("qual").alias("qual"))
    return rows.where("startswith(h, '@')").select("path", "file", "ord", read_id_of(F.col("h")).alias("read_id"), "seq", "qual")


def plain_uri(path: str) -> str:
    """A path as Spark lists it, as the Arrow file systems take it."""
    return re.sub("^file:/+", "file:///", path)


def listed(spark: SparkSession, path: str | list[str]) -> list[tuple[str, int]]:
    """Name and size of the files that ``path`` stands for, by name: patterns and folders are looked up, hidden files left out, empty ones not."""
    out = []
    for p in [path] if isinstance(path, str) else path:
        place = spark._jvm.org.apache.hadoop.fs.Path(p)
        store = place.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in store.globStatus(place) or []:
            inside = [x for x in store.listStatus(found.getPath()) if x.isFile() and x.getPath().getName()[0] not in "._"] if found.isDirectory() else [found]
            out += [(plain_uri(x.getPath().toString()), x.getLen()) for x in inside]
    return sorted(out)


def reachable(paths: list[str]) -> bool:
    """Whether the Arrow file systems know the stores of all paths."""
    from pyarrow import ArrowInvalid, fs

    try:
        for uri in {p.split(":", 1)[0]: p for p in paths if not p.startswith("file:")}.values():
            fs.FileSystem.from_uri(plain_uri(uri))
    except (ArrowInvalid, NotImplementedError, OSError):
        return False
    return True


def read_id_of(header: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(header, r"^@(\S+)", 1), "[/._][12]$", "")


def _fastq_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    rows = numbered_lines(spark, path).withColumn("ord", F.floor(F.col("line") / 4)).withColumn("k", F.col("line") % 4)
    part = lambda k: F.max(F.when(F.col("k") == k, F.col("value")))
    reads = rows.groupBy("path", "file", "ord").agg(part(0).alias("h"), part(1).alias("seq"), part(3).alias("qual"))
    return reads.where("startswith(h, '@')").select("path", "file", "ord", read_id_of(F.col("h")).alias("read_id"), "seq", F.coalesce("qual", F.lit("")).alias("qual"))


SYRI_COLUMNS = "ref_chr ref_start ref_end ref_seq query_seq query_chr query_start query_end id parent_id type copy_status".split()


def read_syri(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.csv(path, sep="\t", schema=T.StructType([T.StructField(c, T.StringType()) for c in SYRI_COLUMNS]))
    return df.select(*[F.col(c).try_cast("bigint").alias(c) if c.endswith(("start", "end")) else F.col(c) for c in SYRI_COLUMNS])


def syri_blocks(syri: DataFrame) -> DataFrame:
    """Syntenic blocks: ``block_id``, both sides' ranges, and whether the query side runs backwards."""
    ends = ("ref_start", "ref_end", "query_start", "query_end")
    whole = syri.where("type = 'SYN'").dropna(subset=list(ends))
    return whole.select(F.col("id").alias("block_id"), "ref_chr", "ref_start", "ref_end", "query_chr", "query_start", "query_end", (F.col("query_start") > F.col("query_end")).alias("inverted"))


def syri_snps(syri: DataFrame) -> DataFrame:
    return syri.where("type = 'SNP'").select(F.col("ref_chr").alias("chrom"), F.col("ref_start").alias("pos"), F.col("ref_seq").alias("ref"), F.col("query_seq").alias("alt"))


def read_vcf(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``chrom, pos, id, ref, alt`` of the records."""
    c = F.split("value", "\t")
    rows = spark.read.text(path).where("value <> '' AND NOT startswith(value, '#')").where(F.size(c) >= 5)
    return rows.select(c[0].alias("chrom"), c[1].try_cast("bigint").alias("pos"), c[2].alias("id"), c[3].alias("ref"), c[4].alias("alt"))


def single_base(variants: DataFrame) -> DataFrame:
    """Variants of one base on either side; lists of alleles drop out by their length."""
    return variants.where((F.length("ref") == 1) & (F.length("alt") == 1))


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """Six-column homology hits with their place in the file as ``ord``."""
    c = _cut()
    typed = [c[0].alias("query_id"), c[1].alias("subject_id"), c[2].try_cast("double").alias("pident"), c[3].try_cast("int").alias("length"), c[4].try_cast("double").alias("evalue"), c[5].try_cast("double").alias("bitscore")]
    return lines(spark, path).where("value <> '' AND NOT startswith(value, '#')").where(F.size(c) >= 6).select(*typed, F.col("at").alias("ord"))


def read_eggnog(spark: SparkSession, path: str) -> DataFrame:
    """Orthology annotations with their place as ``ord``; the heading is the first line with one ``#``."""
    raw = lines(spark, path).where("value <> '' AND NOT startswith(value, '##')")
    head = raw.where("startswith(value, '#')").select("value").first()
    names = head["value"].lstrip("#").split("\t") if head else []
    wanted = {"query": "protein_id", "Description": "description", "Preferred_name": "preferred_name", "GOs": "gos", "EC": "ec", "KEGG_ko": "kegg_ko", "COG_category": "cog"}
    c = F.split("value", "\t")
    at = {n: names.index(n) for n in wanted if n in names}
    return raw.where("NOT startswith(value, '#')").select(*[(F.get(c, F.lit(at[n])) if n in at else F.lit(None).cast("string")).alias(a) for n, a in wanted.items()], F.col("at").alias("ord"))


def read_interpro(spark: SparkSession, path: str) -> DataFrame:
    """``protein_id, product``: the first description of each protein that is one."""
    c = _cut()
    rows = lines(spark, path).where(F.size(c) >= 6).select(c[0].alias("protein_id"), c[5].alias("product"), "at").where("trim(product) NOT IN ('', '-')")
    return rows.groupBy("protein_id").agg(F.min_by("product", "at").alias("product"))


def with_columns(df: DataFrame, names: dict[str, tuple[str, ...]]) -> DataFrame:
    """Columns by the first of their aliases that has text, null where none has."""
    return df.select(*[F.coalesce(*[F.nullif(F.col(f"`{a}`"), F.lit("")) for a in aliases if a in df.columns] or [F.lit(None).cast("string")]).alias(n) for n, aliases in names.items()])


def read_dbcan(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.csv(path, header=True, sep="\t")
    return with_columns(df, {"protein_id": ("Gene ID", df.columns[0]), "hmmer": ("HMMER",), "ecami": ("eCAMI",), "diamond": ("DIAMOND",), "n_tools": ("#ofTools",)})


def read_funannotate(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.csv(path, header=True, sep="\t")
    return with_columns(df, {"protein_id": ("gene_id", "ID", "query_id"), "product": ("product", "Product")})


def _first_word(c: Column) -> Column:
    return F.regexp_extract(c, r"^\s*(\S+)", 1)


def read_signalp(spark: SparkSession, path: str) -> DataFrame:
    """``protein_id, call`` of a two-column prediction table; the last row of a protein wins."""
    c = F.split("value", "\t")
    rows = lines(spark, path).where("trim(value) <> '' AND NOT startswith(value, '#')").where(F.size(c) > 1)
    return rows.groupBy(_first_word(c[0]).alias("protein_id")).agg(F.max_by(c[1], F.col("at")).alias("call"))


read_targetp = read_signalp


def read_deeploc(spark: SparkSession, path: str) -> DataFrame:
    """``protein_id, compartment, signals``; the last row of a protein wins."""
    at = F.format_string("%s %019d %019d", F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    df = spark.read.csv(path, header=True).withColumn("__at", at)
    out = with_columns(df, {"protein_id": ("Protein_ID",), "compartment": ("Localizations",), "signals": ("Signals",), "at": ("__at",)})
    return last_of(out.withColumn("protein_id", _first_word(F.col("protein_id"))), ["compartment", "signals"])


def last_of(rows: DataFrame, cells: list[str], first: bool = False) -> DataFrame:
    """``protein_id`` and ``cells`` of the last row of each protein by ``at``, or the first."""
    pick = F.min_by if first else F.max_by
    return rows.groupBy("protein_id").agg(pick(F.struct(*cells), "at").alias("c")).select("protein_id", "c.*")


def read_topology(spark: SparkSession, path: str) -> DataFrame:
    """Three-line topology records: ``protein_id, kind, n_tm``, spans counted as runs of M or of B; the last record of a protein wins."""
    rows = numbered_lines(spark, path).where("value <> ''").withColumn("k", F.col("line") % 3).withColumn("r", F.floor(F.col("line") / 3))
    part = lambda k: F.max(F.when(F.col("k") == k, F.col("value")))
    rec = rows.groupBy("path", "r").agg(part(0).alias("h"), part(2).alias("t"))
    told = rec.select(F.regexp_extract("h", r"^>\s*(\S+)", 1).alias("protein_id"), F.regexp_extract("h", r"\|\s*(\S+)", 1).alias("kind"), F.regexp_count("t", F.lit("M+|B+")).alias("n_tm"), F.struct("path", "r").alias("at"))
    return last_of(told, ["kind", "n_tm"])


def read_phobius(spark: SparkSession, path: str) -> DataFrame:
    """Short output of four columns: ``protein_id, n_tm, call``; the last row of a protein wins."""
    c = F.split(F.trim("value"), r"\s+")
    rows = lines(spark, path).where(F.size(c) >= 4).where("NOT startswith(value, 'SEQ')")
    told = rows.select("at", c[0].alias("protein_id"), c[1].try_cast("int").alias("n_tm"), F.when(c[2] == "Y", "SP").otherwise("-").alias("call"))
    return last_of(told, ["n_tm", "call"])


def read_effectors(spark: SparkSession, path: str) -> DataFrame:
    """``protein_id, call``: the last column of each row, whatever it says."""
    c = F.split("value", "\t")
    rows = lines(spark, path).where("trim(value) <> '' AND NOT startswith(value, '#')")
    return rows.groupBy(_first_word(c[0]).alias("protein_id")).agg(F.max_by(F.element_at(c, -1), F.col("at")).alias("call"))


def read_merops(spark: SparkSession, path: str) -> DataFrame:
    """``protein_id, family``: of each protein's first hit the family code in its last column (the second if there are few), else that text."""
    c = F.split("value", "\t")
    rows = lines(spark, path).where("trim(value) <> '' AND NOT startswith(value, '#')").where(F.size(c) >= 2)
    code = F.regexp_extract(F.when(F.size(c) > 5, F.element_at(c, -1)).otherwise(c[1]), MEROPS_CODE, 1)
    return rows.groupBy(c[0].alias("protein_id")).agg(F.min_by(F.when(code != "", code).otherwise(c[1]), F.col("at")).alias("family"))


def read_trim_reports(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Six figures per trimming report, null where a report lacks one."""
    df = spark.read.text(path, wholetext=True)
    figures = [F.replace(F.nullif(F.regexp_extract("value", p, 1), F.lit("")), F.lit(","), F.lit("")).try_cast("bigint").alias(n) for n, p in TRIM_METRICS.items()]
    return df.select(F.col("_metadata.file_path").alias("path"), base_name(F.col("_metadata.file_path")).alias("file"), *figures)


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Sample sheet with headings by alias, lists as arrays, and the line of each row; other headings are left out."""
    comma = path.lower().rstrip("/").endswith(".csv")
    sep, inner = (",", ";") if comma else ("\t", ",")
    rows = numbered_lines(spark, path).where("trim(value) <> '' AND NOT startswith(ltrim(value), '#')")
    head = rows.orderBy("at").first()
    found = [SHEET_ALIASES.get(h.strip().lower()) for h in head["value"].split(sep)] if head else []
    if head and "sample_id" not in found:
        raise ValueError(f"{path}: no sample id column")
    cells = F.split("value", sep)
    body = rows.where(F.col("line") > (head["line"] if head else 0))
    out = body.select((F.col("line") + 1).alias("line"), *[F.trim(F.get(cells, F.lit(i))).alias(n) for i, n in enumerate(found) if n])
    return out.select("line", *[(F.split(c, inner) if c.startswith("fastq_") else F.col(c)).alias(c) for c in out.columns[1:]])


def read_control(spark: SparkSession, path: str, columns: list[str], extra: bool = False) -> DataFrame:
    """A control table as text; unknown headings or ragged rows raise, and extra columns only if allowed."""
    first = spark.read.text(path).first()
    header = first["value"].lstrip("﻿").split("\t") if first else []
    if len(set(header)) < len(header) or set(columns) - set(header) or (set(header) - set(columns) and not extra):
        raise ValueError(f"{path}: headings {header} do not match {columns}")
    cells = spark.read.text(path).where("trim(value) <> ''").select(F.size(F.split("value", "\t")).alias("n"))
    if not cells.where(F.col("n") != len(header)).isEmpty():
        raise ValueError(f"{path}: rows with another number of cells")
    return spark.read.csv(path, header=True, sep="\t", schema=", ".join(f"`{h}` string" for h in header))


def read_sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Alignments of SAM text: ``path, file, at, read_id, flag, chrom, pos0, mapq, cigar, seq, qual, nh``."""
    c = _cut()
    rows = lines(spark, path).where("value <> '' AND NOT startswith(value, '@')").where(F.size(c) >= 11)
    return rows.select(
        "path", "file", "at", c[0].alias("read_id"), c[1].try_cast("int").alias("flag"), c[2].alias("chrom"), (c[3].try_cast("bigint") - 1).alias("pos0"), c[4].try_cast("int").alias("mapq"),
        c[5].alias("cigar"), c[9].alias("seq"), c[10].alias("qual"), F.regexp_extract("value", r"\tNH:i:(\d+)", 1).try_cast("int").alias("nh"),
    )


def file_hashes(spark: SparkSession, path: str | list[str], block: int = 8 << 20) -> DataFrame:
    """``path, sha256`` of whole files of any size.

    A list of names and sizes is dealt to tasks; each streams its files through the digest, ``block`` bytes at a time, so no file stands in a row. In a store
    that only Spark's readers open a file is a row, of 2 GB at most.
    """
    files = listed(spark, path)
    if not reachable([uri for uri, _ in files]):
        return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .fastq import opened

        for batch in batches:
            out = []
            for uri in batch.column(0).to_pylist():
                whole = hashlib.sha256()
                with opened(uri, packed=True) as stream:
                    while data := stream.read(block):
                        whole.update(data)
                out.append(whole.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["path", "sha256"])

    names = spark.createDataFrame([(uri,) for uri, _ in files], "path string")
    return names.repartition(4 * spark.sparkContext.defaultParallelism, "path").mapInArrow(digest, "path string, sha256 string")


#: Options of a run that count as provenance.
RUN_OPTIONS = ("count_feature", "count_attribute", "nonunique", "count_multimappers", "overlap_mode", "fractional", "tool_version")


def read_run_metadata(spark: SparkSession, path: str | list[str], keys: list[str] = RUN_OPTIONS) -> DataFrame:
    """Options of run-metadata JSON, nested under ``quantification`` or ``options``, or on top: ``path, file`` and a column per key."""
    df = spark.read.text(path, wholetext=True)
    value = lambda k: F.coalesce(*[F.get_json_object("value", f"$.{p}{k}") for p in ("quantification.", "options.", "")])
    return df.select(F.col("_metadata.file_path").alias("path"), base_name(F.col("_metadata.file_path")).alias("file"), *[value(k).alias(k) for k in keys])


def provenance(inputs: DataFrame, hashes: DataFrame, options: DataFrame) -> DataFrame:
    """Inputs with the hash of their counts and, as ``effective_`` columns, the options their run was made with.

    ``inputs(input_id, counts_file, metadata_file, ...)``, ``hashes(file, sha256)``, ``options(file, ...)``; what is missing stays null.
    """
    h = hashes.select(F.col("file").alias("counts_file"), F.col("sha256").alias("counts_sha256"))
    named = [F.col(c).alias(f"effective_{c}") for c in options.columns if c not in ("path", "file")]
    o = options.select(F.col("file").alias("metadata_file"), *named)
    return inputs.join(h, "counts_file", "left").join(o, "metadata_file", "left")


def read_strand_map(spark: SparkSession, path: str) -> DataFrame:
    c = F.split("value", "\t")
    return spark.read.text(path).where("value <> ''").where(c[0] != "sample").select(c[0].alias("sample_id"), c[1].alias("effective"), F.get(c, F.lit(2)).alias("conflict"))


def read_libraries(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """Count files of a manifest ``(sample_id, organism, file)`` as ``sample_id, organism, gene_id, n``, counters with their ``__``.

    ``file`` is a path below ``folder``; it matches the end of the path that was read.
    """
    raw = lines(spark, folder, deep=True).select("path", _cut()[0].alias("gene_id"), F.get(_cut(), F.lit(1)).try_cast("bigint").alias("n"))
    root = folder.rstrip("/").rsplit("/", 1)[-1] + "/"
    inside = raw.withColumn("file", F.expr(f"substring(path, length(path) - length(substring_index(path, '/{root}', -1)) + 1)"))
    return inside.join(manifest, "file").select("sample_id", "organism", "gene_id", "n")


def read_map(spark: SparkSession, path: str, names: tuple[str, str]) -> DataFrame:
    """Two-column map, headings and repeated rows dropped."""
    df = spark.read.csv(path, sep="," if path.endswith(".csv") else "\t", header=True)
    return df.select(F.col(f"`{df.columns[0]}`").alias(names[0]), F.col(f"`{df.columns[1]}`").alias(names[1])).distinct()
