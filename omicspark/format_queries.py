"""Sources and sinks: the driver's tables written in each format to the shared folder, read back, and held against SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .operators import annotation, sequences
from .queries import SAMPLES
from .registry import query
from .sources import readers, writers
from .sources.scratch import shared_folder

text = lambda c: F.col(c).cast("string")
tabbed = lambda *cells: F.concat_ws("\t", *cells)


def _folder(t, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}"


def _files(t, rows: DataFrame, name: str = "files") -> str:
    """Write ``rows(file, ord, value)`` as files and give their folder."""
    path = _folder(t, name)
    writers.write_named_files(rows, path, ["ord", "value"])
    return path


def _parts(t, rows: DataFrame, file: str, header: list[str] | None = None, order: list[str] | None = None) -> str:
    """``rows(value)`` as one file that many tasks write, a folder of part files, and its path."""
    path = f"{_folder(t, 'files')}/{file}"
    writers.write_lines(rows, path, order, header)
    return path


def _headed(rows: DataFrame, header: str) -> DataFrame:
    """``rows(file, value)`` with a heading on top of each file."""
    top = rows.select("file").distinct().select("file", F.lit(0).alias("ord"), F.lit(header).alias("value"))
    return top.unionByName(rows.select("file", F.lit(1).alias("ord"), "value"))


def _one(rows: DataFrame, header: list[str], file: str) -> DataFrame:
    """``rows(value)`` as one file below the lines of ``header``."""
    body = rows.select(F.lit(file).alias("file"), F.lit(len(header)).alias("ord"), "value")
    top = rows.sparkSession.createDataFrame([(file, i, h) for i, h in enumerate(header)], "file string, ord int, value string")
    return top.unionByName(body)


# Counts


def _htseq(t) -> str:
    genes = t.counts().select(F.concat("sample_id", F.lit(".htseq.tsv")).alias("file"), F.lit(0).alias("ord"), tabbed("gene_id", text("n")).alias("value"))
    special = t.counters().where("sample_id IS NOT NULL").select(F.concat("sample_id", F.lit(".htseq.tsv")).alias("file"), F.lit(1).alias("ord"), tabbed(F.concat(F.lit("__"), "category"), text("n")).alias("value"))
    return _files(t, genes.unionByName(special))


@query("io_htseq_genes", "SELECT sample_id, gene_id, n FROM counts", "counts")
def _(t):
    return readers.read_htseq(t.spark, _htseq(t))[0]


@query("io_htseq_counters", "SELECT sample_id, category, n FROM counters", "counters")
def _(t):
    return readers.read_htseq(t.spark, _htseq(t))[1]


@query(
    "io_htseq_problems",
    """WITH l AS (SELECT p_size % 4 AS f, CASE WHEN p_partkey % 50 = 0 THEN '' ELSE 'g' || (p_partkey // 2) END AS k, p_partkey % 70 = 1 AS short, CASE WHEN p_partkey % 30 = 2 THEN 'x' ELSE '4' END AS n FROM part)
    SELECT 'f' || f AS file, 'fields' AS rule, k AS key FROM l WHERE short UNION ALL SELECT 'f' || f, 'empty_key', k FROM l WHERE NOT short AND k = '' UNION ALL SELECT 'f' || f, 'count', k FROM l WHERE NOT short AND k <> '' AND n = 'x'
    UNION ALL SELECT 'f' || f, 'duplicate', k FROM l WHERE NOT (short AND k = '') GROUP BY f, k HAVING count(*) > 1""",
)
def _(t):
    k = F.col("p_partkey")
    key = F.when(k % 50 == 0, "").otherwise(F.concat(F.lit("g"), F.floor(k / 2).cast("string")))
    value = F.when(k % 70 == 1, key).otherwise(tabbed(key, F.when(k % 30 == 2, "x").otherwise("4")))
    rows = t.read("part").select(F.concat(F.lit("f"), (F.col("p_size") % 4).cast("string"), F.lit(".txt")).alias("file"), F.lit(0).alias("ord"), value.alias("value"))
    return readers.htseq_problems(t.spark, _files(t, rows)).select(F.regexp_extract("path", r"([^/]+)\.txt$", 1).alias("file"), "rule", "key")


@query("io_featurecounts", "SELECT sample_id, gene_id, n FROM counts", "counts")
def _(t):
    rows = t.counts().select(F.concat("sample_id", F.lit(".txt")).alias("file"), "sample_id", tabbed("gene_id", F.lit("c1"), F.lit("1"), F.lit("9"), F.lit("+"), F.lit("9"), text("n")).alias("value"))
    heads = rows.select("file", "sample_id").distinct().select("file", F.lit(0).alias("ord"), F.concat(F.lit("# made\nGeneid\tChr\tStart\tEnd\tStrand\tLength\t/bam/"), "sample_id", F.lit(".sorted.bam")).alias("value"))
    return readers.read_featurecounts(t.spark, _files(t, heads.unionByName(rows.select("file", F.lit(1).alias("ord"), "value"))))


GRID = "SELECT sample_id, gene_id, {} AS n FROM (SELECT DISTINCT gene_id FROM counts) CROSS JOIN samples LEFT JOIN counts USING (sample_id, gene_id)"


@query("io_matrix", GRID.format("CAST(n AS DOUBLE)"), "counts", "samples")
def _(t):
    path = _folder(t, "matrix")
    writers.write_matrix(t.counts(), path, SAMPLES)
    return readers.read_matrix(t.spark, path)


@query("io_matrix_order", "SELECT gene_id, row_number() OVER (ORDER BY CAST(gene_id[2:] AS INT) DESC) - 1 AS place FROM (SELECT DISTINCT gene_id FROM counts)", "counts")
def _(t):
    """The row order of a matrix, across its part files."""
    path = _folder(t, "matrix")
    c = t.counts()
    order = c.select("gene_id").distinct().select("gene_id", (-F.substring("gene_id", 2, 20).cast("int")).alias("ord"))
    writers.write_matrix(c, path, SAMPLES, order)
    rows = readers.numbered_lines(t.spark, path).where("NOT startswith(value, 'gene_id')").select("path", "line", F.split("value", "\t")[0].alias("gene_id"))
    from pyspark.sql import Window

    return rows.select("gene_id", (F.row_number().over(Window.orderBy("path", "line")) - 1).cast("bigint").alias("place"))


@query("io_decimal_matrix", GRID.format("CAST(coalesce(n, 0) AS DOUBLE)"), "counts", "samples")
def _(t):
    path = _folder(t, "decimals")
    writers.write_decimal_matrix(t.counts(), path, SAMPLES)
    return readers.read_matrix(t.spark, path)


@query(
    "io_matrix_problems",
    """WITH l AS (SELECT CASE WHEN p_partkey % 90 = 0 THEN '' ELSE 'g' || (p_partkey // 2) END AS g, CASE WHEN p_partkey % 40 = 1 THEN 'x' WHEN p_partkey % 40 = 2 THEN '-3' WHEN p_partkey % 40 = 3 THEN '1.5' ELSE '7' END AS n FROM part)
    SELECT CASE WHEN g = '' THEN 'empty_gene' WHEN n = 'x' THEN 'not_a_number' WHEN n = '-3' THEN 'negative' ELSE 'not_integer' END AS rule, g AS key, 's1' AS detail FROM l WHERE g = '' OR n <> '7'
    UNION ALL SELECT 'duplicate_gene', g, 's1' FROM l WHERE g <> '' GROUP BY g HAVING count(*) > 1""",
)
def _(t):
    k = F.col("p_partkey")
    gene = F.when(k % 90 == 0, '""').otherwise(F.concat(F.lit("g"), F.floor(k / 2).cast("string")))
    n = F.when(k % 40 == 1, "x").when(k % 40 == 2, "-3").when(k % 40 == 3, "1.5").otherwise("7")
    path = _files(t, _one(t.read("part").select(F.concat_ws(",", gene, n).alias("value")), ["gene_id,s1"], "m.csv"))
    return readers.matrix_problems(readers.read_matrix(t.spark, f"{path}/m.csv"))


@query("io_summary", "SELECT sample_id, category, n FROM counters", "counters")
def _(t):
    wide = t.counters().where("sample_id IS NOT NULL").groupBy("category").pivot("sample_id", SAMPLES).agg(F.sum("n"))
    value = tabbed("category", *[F.coalesce(text(s), F.lit("NA")) for s in SAMPLES])
    path = _files(t, _one(wide.select(value.alias("value")), ["Status\t" + "\t".join(f"/b/{s}.bam" for s in SAMPLES)], "x.summary"))
    return readers.read_summary(t.spark, f"{path}/x.summary").where("n IS NOT NULL")


@query("io_legacy_statistics", "SELECT 'k' || s_suppkey AS key, CAST(s_nationkey AS VARCHAR) AS assigned FROM supplier")
def _(t):
    path = _folder(t, "stats")
    writers.write_table(t.read("supplier").select(F.concat(F.lit("other"), text("s_suppkey")).alias("sample_id"), F.concat(F.lit("k"), text("s_suppkey")).alias("sample_id_original"), F.col("s_nationkey").alias("assigned")), path)
    return readers.legacy_rows(t.spark.read.csv(path, sep="\t", header=True)).select("key", "assigned")


@query("io_salmon", "SELECT sample_id, transcript_id, 900.0::DOUBLE AS length, 750.5::DOUBLE AS eff_length, CAST(length(transcript_id) AS DOUBLE) AS tpm, CAST(num_reads AS DOUBLE) AS num_reads FROM quant", "quant")
def _(t):
    value = tabbed("transcript_id", F.lit("900"), F.lit("750.5"), F.length("transcript_id").cast("string"), text("num_reads"))
    rows = t.quant().select(F.concat("sample_id", F.lit("/quant.sf")).alias("file"), value.alias("value"))
    return readers.read_salmon(t.spark, _files(t, _headed(rows, "Name\tLength\tEffectiveLength\tTPM\tNumReads")) + "/*/quant.sf")


@query("io_salmon_meta", "SELECT 'S' || n_nationkey AS sample_id, 100 + CAST(n_nationkey AS BIGINT) AS num_processed, CAST(n_nationkey AS BIGINT) AS num_mapped FROM nation")
def _(t):
    k = F.col("n_nationkey").cast("bigint")
    value = F.to_json(F.struct((100 + k).alias("num_processed"), k.alias("num_mapped"), F.lit("x").alias("other")))
    rows = t.read("nation").select(F.concat(F.lit("S"), k.cast("string"), F.lit("/aux_info/meta_info.json")).alias("file"), F.lit(0).alias("ord"), value.alias("value"))
    return readers.read_salmon_meta(t.spark, _files(t, rows) + "/*/aux_info/meta_info.json")


@query("io_strand_map", "SELECT sample_id, CASE WHEN number % 2 = 0 THEN 'forward' ELSE 'reverse' END AS effective, CASE WHEN number % 5 = 0 THEN 'true' END AS conflict FROM samples", "samples")
def _(t):
    side = F.when(F.col("number") % 2 == 0, "forward").otherwise("reverse")
    rows = t.samples().select(tabbed("sample_id", side, F.when(F.col("number") % 5 == 0, "true")).alias("value"))
    return readers.read_strand_map(t.spark, _files(t, _one(rows, ["sample\teffective\tconflict"], "strand.tsv")))


@query(
    "io_libraries",
    "SELECT 'S' || (user_id % 25) AS sample_id, CASE event_id % 2 WHEN 0 THEN 'pine' ELSE 'fungus' END AS organism, event_type AS gene_id, count(*) AS n FROM events GROUP BY ALL",
)
def _(t):
    organism = F.when(F.col("event_id") % 2 == 0, "pine").otherwise("fungus")
    sample = F.concat(F.lit("S"), (F.col("user_id") % 25).cast("string"))
    n = t.read("events").groupBy(organism.alias("organism"), sample.alias("sample_id"), F.col("event_type").alias("gene_id")).agg(F.count(F.lit(1)).alias("n"))
    file = F.concat_ws("/", "organism", F.concat("sample_id", F.lit(".tsv")))
    folder = _files(t, n.select(file.alias("file"), F.lit(0).alias("ord"), tabbed("gene_id", text("n")).alias("value")), "libraries")
    return readers.read_libraries(t.spark, n.select("sample_id", "organism", file.alias("file")).distinct(), folder)


@query("io_gene_map", "SELECT CAST(p_partkey AS VARCHAR) AS transcript_id, p_brand AS gene_id FROM part")
def _(t):
    rows = t.read("part").select(tabbed(text("p_partkey"), "p_brand").alias("value"))
    rows = rows.unionByName(rows.where("value LIKE '1%'"))  # repeated rows count once
    return readers.read_map(t.spark, _files(t, _one(rows, ["transcript_id\tgene_id"], "map.tsv")), ("transcript_id", "gene_id"))


# Features, sequences and variants


def _gff(t) -> str:
    g = t.genes()
    attrs = F.create_map(F.lit("ID"), F.col("gene_id"), F.lit("Note"), F.concat(F.lit("x y"), text("chrom")))
    genes = g.select(F.concat(F.lit("c"), text("chrom")).alias("seqid"), F.lit("t").alias("source"), F.lit("gene").alias("type"), "start", "end", F.lit(None).cast("string").alias("score"), "strand", F.lit(None).cast("string").alias("phase"), attrs.alias("attrs"))
    exons = genes.withColumn("type", F.lit("exon")).withColumn("attrs", F.create_map(F.lit("gene_id"), F.col("attrs")["ID"], F.lit("transcript_id"), F.concat(F.col("attrs")["ID"], F.lit(".1"))))
    path = _folder(t, "gff")
    writers.write_lines(writers.gff_rows(genes.unionByName(exons)), path, ["seqid", "start"], ["##gff-version 3"])
    return path


@query(
    "io_gff",
    """SELECT 'c' || chrom AS seqid, 'gene' AS type, "start", "end", strand, gene_id AS id, 'x y' || chrom AS note, NULL AS tx FROM genes UNION ALL SELECT 'c' || chrom, 'exon', "start", "end", strand, gene_id, NULL, gene_id || '.1' FROM genes""",
    "genes",
)
def _(t):
    gff = readers.read_gff(t.spark, _gff(t))
    a = F.col("attrs")
    return gff.select("seqid", "type", "start", "end", "strand", F.coalesce(a["ID"], a["gene_id"]).alias("id"), a["Note"].alias("note"), a["transcript_id"].alias("tx"))


@query("io_gff_genes", "SELECT 'c' || chrom AS chrom, \"start\", \"end\", gene_id FROM genes", "genes")
def _(t):
    return readers.genes_of(readers.read_gff(t.spark, _gff(t)))


@query("io_gff_style", "SELECT 'gene' AS type, count(*) AS n, count(*) AS n_gff3 FROM genes UNION ALL SELECT 'exon', count(*), 0 FROM genes", "genes")
def _(t):
    """Each line in its own style."""
    rows = readers.lines(t.spark, _gff(t)).where("NOT startswith(value, '#')").select(F.split("value", "\t").alias("c"))
    return rows.groupBy(F.col("c")[2].alias("type")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("c")[8].rlike("^ID=[^;]+;.*;$")).alias("n_gff3"))


def _fasta(t) -> str:
    seqs = t.read("part").select("p_partkey", F.concat(F.lit("s"), text("p_partkey"), F.lit(" "), "p_brand").alias("seq_id"), F.concat_ws("\n", F.repeat(F.lit("ACGTn"), F.lit(6)), F.repeat(F.lit("NNac"), F.col("p_size"))).alias("sequence"))
    path = _folder(t, "fasta")
    writers.fasta_rows(seqs).select("value").write.text(path)
    return path


@query("io_fasta", "SELECT 's' || p_partkey AS seq_id, p_brand AS descr, 30 + 4 * p_size AS bp, md5(repeat('ACGTn', 6) || repeat('NNac', p_size)) AS digest FROM part")
def _(t):
    return readers.read_fasta(t.spark, _fasta(t)).select("seq_id", "descr", F.length("sequence").alias("bp"), F.md5("sequence").alias("digest"))


@query("io_fasta_ids", "SELECT 's' || p_partkey AS seq_id FROM part")
def _(t):
    return readers.fasta_ids(t.spark, _fasta(t)).select("seq_id")


@query(
    "io_genome_lines",
    "SELECT CAST(sum(30 + 4 * p_size) AS BIGINT) AS total_bp, count(*) AS contigs, CAST(max(30 + 4 * p_size) AS BIGINT) AS max_contig_bp, round(sum(6 + 2 * p_size) / sum(30 + 4 * p_size), 9) AS n_fraction, round(sum(6 + 2 * p_size) / sum(30 + 4 * p_size), 9) AS softmask_fraction FROM part",
)
def _(t):
    """Statistics from sequence lines, so that no contig stands in one row; files of a folder are summed."""
    per = sequences.genome_line_stats(readers.fasta_lines(t.spark, _fasta(t)))
    share = lambda c: F.round(F.sum(F.col(c) * F.col("composition_scanned_bp")) / F.sum("composition_scanned_bp"), 9).alias(c)
    return per.agg(F.sum("total_bp").alias("total_bp"), F.sum("contigs").alias("contigs"), F.max("max_contig_bp").alias("max_contig_bp"), share("n_fraction"), share("softmask_fraction"))


@query(
    "io_genome_chunks",
    """WITH s AS (SELECT 's' || p_partkey AS chrom, repeat('ACGTn', 6) || repeat('NNac', p_size) AS seq FROM part)
    SELECT chrom, k AS chunk_no, substr(seq, k * 20 + 1, 21) AS chunk FROM s, range(0, 20) r(k) WHERE k * 20 < length(seq)""",
)
def _(t):
    return sequences.genome_chunks(readers.fasta_lines(t.spark, _fasta(t)), 20).drop("path")


@query(
    "splice_motifs_of_a_genome",
    """WITH c AS (SELECT o_orderkey AS k, (o_orderkey * 13) % 900 AS p, o_orderkey % 2 = 1 AS reverse FROM orders), m AS (SELECT *,
      substr('GTAGCATC', CAST((p + 20) % 8 AS INT) + 1, 1) || substr('GTAGCATC', CAST((p + 21) % 8 AS INT) + 1, 1) AS d, substr('GTAGCATC', CAST((p + 54) % 8 AS INT) + 1, 1) || substr('GTAGCATC', CAST((p + 55) % 8 AS INT) + 1, 1) AS a FROM c)
    SELECT k AS read_id, CASE WHEN d || '-' || a IN ('GT-AG', 'GC-AG', 'AT-AC') THEN '+' WHEN d || '-' || a IN ('CT-AC', 'CT-GC', 'GT-AT') THEN '-' ELSE '' END AS strand, reverse FROM m""",
)
def _(t):
    """Spliced reads of customers' contigs, written as FASTA lines of different widths and looked up in the chunks made of them."""
    width = 7 + F.col("c_custkey") % 50
    seqs = t.read("customer").select(F.concat(F.lit("k"), text("c_custkey")).alias("seq_id"), F.regexp_replace(F.repeat(F.lit("gtAGCATC"), F.lit(125)), F.concat(F.lit("(.{"), width.cast("string"), F.lit("})")), F.lit("$1\n")).alias("sequence"))
    path = _folder(t, "genome")
    writers.fasta_rows(seqs).select("value").write.text(path)
    k = F.col("o_orderkey")
    al = t.read("orders").select(F.lit("s").alias("sample_id"), k.alias("read_id"), F.when(k % 2 == 1, 16).otherwise(0).alias("flag"), F.concat(F.lit("k"), text("o_custkey")).alias("chrom"), ((k * 13) % 900).alias("pos0"), F.lit("20M36N30M").alias("cigar"))
    ev = sequences.splice_evidence(al, sequences.genome_chunks(readers.fasta_lines(t.spark, path), 100), 100)
    return ev.select("read_id", F.coalesce(F.get("strands", F.lit(0)), F.lit("")).alias("strand"), "reverse")


@query("io_fastq", "SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'a.fastq' ELSE 'b.fastq' END AS file, 'r' || o_orderkey AS read_id, o_orderpriority AS seq, repeat('I', length(o_orderpriority)) AS qual FROM orders")
def _(t):
    k = F.col("o_orderkey")
    record = F.concat_ws("\n", F.concat(F.lit("@r"), k.cast("string"), F.lit("/1 more")), "o_orderpriority", F.lit("+"), F.repeat(F.lit("I"), F.length("o_orderpriority")))
    rows = t.read("orders").select(F.when(k % 2 == 0, "x/a.fastq").otherwise("y/b.fastq").alias("file"), k.alias("ord"), record.alias("value"))
    return readers.read_fastq(t.spark, _files(t, rows) + "/*/*.fastq").select("file", "read_id", "seq", "qual")


SYRI_SQL = """WITH b AS (SELECT o_orderkey AS k, 1000 * (o_orderkey % 280) AS s, o_orderstatus = 'F' AS inv FROM orders)"""


def _syri(t) -> str:
    k, start = F.col("o_orderkey"), 1000 * (F.col("o_orderkey") % 280)
    lo, hi = start.cast("string"), (start + 5000).cast("string")
    inv = F.col("o_orderstatus") == "F"
    block = tabbed(F.lit("c1"), lo, hi, F.lit("-"), F.lit("-"), F.lit("q1"), F.when(inv, hi).otherwise(lo), F.when(inv, lo).otherwise(hi), F.concat(F.lit("B"), k.cast("string")), F.lit("-"), F.when(k % 7 == 0, "INV").otherwise("SYN"), F.lit("-"))
    snp = tabbed(F.lit("c1"), k.cast("string"), k.cast("string"), F.lit("A"), F.lit("G"), F.lit("q1"), F.lit("1"), F.lit("1"), F.lit("x"), F.lit("-"), F.lit("SNP"), F.lit("-"))
    o = t.read("orders")
    rows = o.select(block.alias("value")).unionByName(o.where("o_orderkey % 3 = 0").select(snp.alias("value")))
    return _parts(t, rows, "syri.out")


@query("io_syri_blocks", SYRI_SQL + " SELECT 'B' || k AS block_id, s AS ref_start, s + 5000 AS ref_end, inv AS inverted FROM b WHERE k % 7 <> 0")
def _(t):
    return readers.syri_blocks(readers.read_syri(t.spark, _syri(t))).select("block_id", "ref_start", "ref_end", "inverted")


@query("io_syri_snps", "SELECT 'c1' AS chrom, o_orderkey AS pos, 'A' AS ref, 'G' AS alt FROM orders WHERE o_orderkey % 3 = 0")
def _(t):
    return readers.syri_snps(readers.read_syri(t.spark, _syri(t)))


SITE_SQL = "SELECT DISTINCT 'c' || chrom AS chrom, pos, ref, alt FROM snps WHERE ref <> 'N' AND alt <> 'N'"


def _sites(t) -> DataFrame:
    return t.snps().where("ref <> 'N' AND alt <> 'N'").select(F.concat(F.lit("c"), text("chrom")).alias("chrom"), "pos", "ref", "alt").distinct()


@query("io_vcf", SITE_SQL, "snps")
def _(t):
    path = _folder(t, "vcf")
    writers.write_vcf(_sites(t).withColumn("gt", F.lit("0|1")), path, "F1")
    return readers.read_vcf(t.spark, path).drop("id")


@query("io_vcf_order", f"WITH s AS ({SITE_SQL.replace('FROM snps', 'FROM snps')}) SELECT chrom, pos, ref, alt, row_number() OVER (ORDER BY chrom, pos, ref, alt) + 2 AS line FROM s".replace("WITH s", "+ s"), "snps")
def _(t):
    """Header lines first, then sites by place, across the part files."""
    path = _folder(t, "vcf")
    writers.write_vcf(_sites(t).withColumn("gt", F.lit("0|1")), path, "F1")
    rows = readers.numbered_lines(t.spark, path).select("line", F.split("value", "\t").alias("c"))
    return rows.where("size(c) > 4 AND c[0] <> '#CHROM'").select(F.col("c")[0].alias("chrom"), F.col("c")[1].cast("bigint").alias("pos"), F.col("c")[3].alias("ref"), F.col("c")[4].alias("alt"), "line")


@query("io_snps_by_chromosome", SITE_SQL, "snps")
def _(t):
    path = _folder(t, "snps")
    writers.write_snps_by_chromosome(_sites(t), path)
    rows = readers.lines(t.spark, f"{path}/*.snps.txt").select(F.regexp_extract("path", r"/([^/]+)\.snps\.txt$", 1).alias("chrom"), F.split("value", "\t").alias("c"))
    return rows.select("chrom", F.col("c")[0].cast("bigint").alias("pos"), F.col("c")[1].alias("ref"), F.col("c")[2].alias("alt"))


@query("io_snp_files", SITE_SQL, "snps")
def _(t):
    """One file per chromosome, in order: lines out of order would get a negative position."""
    path = _folder(t, "snp_files")
    writers.write_snps_by_chromosome(_sites(t), path, one_file=True)
    rows = readers.numbered_lines(t.spark, f"{path}/*.snps.txt").select(F.regexp_extract("path", r"/([^/]+)\.snps\.txt$", 1).alias("chrom"), "line", F.split("value", "\t").alias("c"))
    pos = F.col("c")[0].cast("bigint")
    before = F.lag(pos).over(Window.partitionBy("chrom").orderBy("line"))
    return rows.select("chrom", F.when(before > pos, -pos).otherwise(pos).alias("pos"), F.col("c")[1].alias("ref"), F.col("c")[2].alias("alt"))


@query("io_bed", 'SELECT CAST(chrom AS VARCHAR) AS chrom, "start" - 1 AS "start", "end", gene_id FROM genes', "genes")
def _(t):
    path = _folder(t, "bed")
    writers.write_lines(writers.bed_rows(t.genes()), path, ["chrom", "start"])
    c = F.split("value", "\t")
    return t.spark.read.text(path).select(c[0].alias("chrom"), c[1].cast("bigint").alias("start"), c[2].cast("bigint").alias("end"), c[3].alias("gene_id"))


@query("io_sam", 'SELECT read_id, flag, CAST(chrom AS VARCHAR) AS chrom, "start" - 1 AS pos0, CAST(mapq AS INT) AS mapq, nh FROM alignments', "alignments")
def _(t):
    a = t.alignments()
    value = tabbed("read_id", text("flag"), text("chrom"), text("start"), text("mapq"), F.lit("10M"), F.lit("*"), F.lit("0"), F.lit("0"), F.lit("ACGTACGTAC"), F.lit("IIIIIIIIII"), F.concat(F.lit("NH:i:"), text("nh")))
    path = _parts(t, a.select(value.alias("value")), "x.sam", ["@HD\tVN:1.6"])
    return readers.read_sam(t.spark, path).select("read_id", "flag", "chrom", "pos0", "mapq", "nh")


# Hits and evidence


@query("io_hits", "SELECT CAST(query_id AS VARCHAR) AS query_id, CAST(subject_id AS VARCHAR) AS subject_id, round(pident, 6) AS pident, CAST(l_linenumber AS INT) AS length, CAST(bitscore AS DOUBLE) AS bitscore FROM hits", "hits")
def _(t):
    value = tabbed(text("query_id"), text("subject_id"), text("pident"), text("l_linenumber"), text("evalue"), text("bitscore"))
    return readers.read_hits(t.spark, _parts(t, t.hits().select(value.alias("value")), "x.tsv")).select("query_id", "subject_id", F.round("pident", 6).alias("pident"), "length", "bitscore")


@query("io_eggnog", "SELECT 'p' || p_partkey AS protein_id, p_name AS description, p_brand AS preferred_name, 'GO:1,GO:2' AS gos FROM part")
def _(t):
    value = tabbed(F.concat(F.lit("p"), text("p_partkey")), "p_brand", F.lit("GO:1,GO:2"), F.lit("-"), "p_name")
    path = _files(t, _one(t.read("part").select(value.alias("value")), ["## made", "#query\tPreferred_name\tGOs\tEC\tDescription"], "x.annotations"))
    return readers.read_eggnog(t.spark, path).select("protein_id", "description", "preferred_name", "gos")


@query("io_interpro", "SELECT 'p' || l_partkey AS protein_id, arg_min('d' || l_orderkey, (l_orderkey, l_suppkey)) AS product FROM lineitem WHERE l_orderkey % 3 <> 0 GROUP BY 1")
def _(t):
    k = F.col("l_orderkey")
    value = tabbed(F.concat(F.lit("p"), text("l_partkey")), F.lit("m"), F.lit("1"), F.lit("Pfam"), F.lit("PF1"), F.when(k % 3 == 0, "-").otherwise(F.concat(F.lit("d"), k.cast("string"))))
    rows = t.read("lineitem").select("l_orderkey", "l_suppkey", value.alias("value"))
    return readers.read_interpro(t.spark, _parts(t, rows, "ips.tsv", order=["l_orderkey", "l_suppkey"]))


@query("io_dbcan", "SELECT 'p' || p_partkey AS protein_id, CASE WHEN p_size % 5 <> 0 THEN 'GH' || (p_size % 5) ELSE '' END AS family, CASE WHEN p_partkey % 3 = 0 THEN '2' ELSE '1' END AS n_tools FROM part")
def _(t):
    value = tabbed(F.concat(F.lit("p"), text("p_partkey")), F.when(F.col("p_size") % 5 != 0, F.concat(F.lit("GH"), (F.col("p_size") % 5).cast("string"), F.lit("(2-30)"))).otherwise("-"), F.when(F.col("p_partkey") % 3 == 0, "2").otherwise("1"))
    path = _files(t, _one(t.read("part").select(value.alias("value")), ["Gene ID\tHMMER\t#ofTools"], "overview.txt"))
    return annotation.family_calls(readers.read_dbcan(t.spark, path))


@query("io_funannotate", "SELECT 'p' || p_partkey AS protein_id, CASE WHEN p_size % 2 = 0 THEN p_name END AS product FROM part")
def _(t):
    value = tabbed(F.concat(F.lit("p"), text("p_partkey")), F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(""))
    return readers.read_funannotate(t.spark, _files(t, _one(t.read("part").select(value.alias("value")), ["ID\tProduct"], "f2.tsv")))


@query(
    "io_predictors",
    """SELECT 'p' || p_partkey AS protein_id, CASE WHEN p_partkey % 2 = 0 THEN 'SP' ELSE '-' END AS signalp6, CASE WHEN p_partkey % 3 = 0 THEN 'SP' ELSE 'noTP' END AS targetp2, CASE WHEN p_partkey % 5 = 0 THEN 'Extracellular' ELSE '-' END AS deeploc2,
    CASE WHEN p_partkey % 7 = 0 THEN 'SP+TM:2' WHEN p_partkey % 7 = 1 THEN 'BETA:3' ELSE ':0' END AS deeptmhmm, 'SP=' || CASE WHEN p_partkey % 4 = 0 THEN 'Y' ELSE 'N' END || ';TM=' || (p_size % 2) AS phobius, CASE WHEN p_partkey % 9 = 0 THEN 'S8A' WHEN p_partkey % 9 = 1 THEN 'unknown' ELSE '-' END AS merops FROM part""",
)
def _(t):
    p = t.read("part")
    k = F.col("p_partkey")
    name = F.concat(F.lit("p"), k.cast("string"))
    put = lambda rows, header, file: _files(t, _one(rows.select(F.col("v").alias("value")), header, file))
    rows = lambda v, cond=None: (p if cond is None else p.where(cond)).select(v.alias("v"))
    topology = F.concat_ws("\n", F.concat(F.lit(">"), name, F.lit(" | "), F.when(k % 7 == 0, "SP+TM").otherwise("BETA")), F.lit("MKLV"), F.when(k % 7 == 0, "SSIIMMMOOMMI").otherwise("IBBOBBIBBI"))
    tools = {
        "signalp6": readers.read_signalp(t.spark, put(rows(tabbed(F.concat(name, F.lit(" x")), F.when(k % 2 == 0, "SP").otherwise("OTHER"))), ["# made"], "signalp.txt")),
        "targetp2": readers.read_targetp(t.spark, put(rows(tabbed(name, F.lit("SP")), k % 3 == 0), ["# made"], "targetp.txt")),
        "deeploc2": readers.read_deeploc(t.spark, put(rows(F.concat_ws(",", name, F.lit("Extracellular"), F.lit("")), k % 5 == 0), ["Protein_ID,Localizations,Signals"], "deeploc.csv")),
        "deeptmhmm": readers.read_topology(t.spark, put(rows(topology, k % 7 < 2), [], "topology.3line")),
        "phobius": readers.read_phobius(t.spark, put(rows(F.concat_ws("   ", name, (F.col("p_size") % 2).cast("string"), F.when(k % 4 == 0, "Y").otherwise("0"), F.lit("i5-20o"))), ["SEQENCE ID   TM SP PREDICTION"], "phobius.txt")),
        "merops": readers.read_merops(t.spark, put(rows(tabbed(name, F.when(k % 9 == 0, "MER1 - subtilisin S8A family").otherwise("unknown")), k % 9 < 2), [], "merops.txt")),
    }
    return annotation.predictor_table(p.select(name.alias("protein_id")), tools).drop("n_sp_tools", "n_tm", "secreted")


@query(
    "io_predictor_rows_repeated",
    """SELECT 'p' || p_partkey AS protein_id, 'Nucleus' || (p_size % 3) AS compartment, 'TM' AS kind, 2 AS n_tm, p_size % 2 AS phobius_tm FROM part""",
)
def _(t):
    """Files that tell each protein twice: what stands further down counts."""
    p = t.read("part")
    name = F.concat(F.lit("p"), text("p_partkey"))
    both = lambda first, last: p.select(F.lit(0).alias("ord"), first.alias("value")).unionByName(p.select(F.lit(1).alias("ord"), last.alias("value")))

    def put(rows: DataFrame, header: list[str], file: str) -> str:
        top = t.spark.createDataFrame([(-1, h) for h in header], "ord int, value string")
        return _files(t, top.unionByName(rows).select(F.lit(file).alias("file"), "ord", "value"))

    record = lambda kind, topology: F.concat_ws("\n", F.concat(F.lit(">"), name, F.lit(f" | {kind}")), F.lit("MKLV"), F.lit(topology))
    deeploc = readers.read_deeploc(t.spark, put(both(F.concat(name, F.lit(",Golgi,")), F.concat(name, F.lit(",Nucleus"), (F.col("p_size") % 3).cast("string"), F.lit(","))), ["Protein_ID,Localizations,Signals"], "d.csv"))
    topology = readers.read_topology(t.spark, put(both(record("GLOB", "IIII"), record("TM", "IMMOMI")), [], "t.3line"))
    phobius = readers.read_phobius(t.spark, put(both(F.concat(name, F.lit("  7  Y  o")), F.concat(name, F.lit("  "), (F.col("p_size") % 2).cast("string"), F.lit("  0  o"))), ["SEQENCE ID   TM SP PREDICTION"], "p.txt"))
    return deeploc.drop("signals").join(topology, "protein_id").join(phobius.select("protein_id", F.col("n_tm").alias("phobius_tm")), "protein_id")


@query("io_effectors", "SELECT 'p' || p_partkey AS protein_id, CASE WHEN p_size % 2 = 0 THEN 'Apoplastic effector' ELSE 'Non-effector' END AS call FROM part")
def _(t):
    value = tabbed(F.concat(F.lit("p"), text("p_partkey"), F.lit(" extra")), F.lit("0.5"), F.when(F.col("p_size") % 2 == 0, "Apoplastic effector").otherwise("Non-effector"))
    return readers.read_effectors(t.spark, _files(t, _one(t.read("part").select(value.alias("value")), ["# Identifier"], "effectors.txt")))


# Control tables, reports and summaries


@query("io_trim_reports", "SELECT 't' || n_nationkey || '.txt' AS file, 1000000 + CAST(n_nationkey AS BIGINT) AS reads_processed, CASE WHEN n_nationkey % 3 <> 0 THEN 5000 + CAST(n_nationkey AS BIGINT) END AS reads_with_adapters FROM nation")
def _(t):
    k = F.col("n_nationkey").cast("bigint")
    body = F.concat(F.lit("=== Summary ===\nTotal reads processed:    "), F.format_number(1_000_000 + k, 0), F.when(k % 3 != 0, F.concat(F.lit("\nReads with adapters:   "), F.format_number(5_000 + k, 0), F.lit(" (1%)"))).otherwise(""))
    rows = t.read("nation").select(F.concat(F.lit("t"), k.cast("string"), F.lit(".txt")).alias("file"), F.lit(0).alias("ord"), body.alias("value"))
    return readers.read_trim_reports(t.spark, _files(t, rows)).select("file", "reads_processed", "reads_with_adapters")


@query("io_sample_sheet", "SELECT 's' || n_nationkey AS sample_id, CASE WHEN n_nationkey % 2 = 0 THEN 'PE' ELSE 'SE' END AS layout, ['a' || n_nationkey || '_1.fq', 'b' || n_nationkey || '_1.fq'] AS fastq_1, CAST(row_number() OVER (ORDER BY n_nationkey) + 2 AS BIGINT) AS line FROM nation")
def _(t):
    k = text("n_nationkey")
    value = F.concat_ws(",", F.concat(F.lit("s"), k), F.when(F.col("n_nationkey") % 2 == 0, "PE").otherwise("SE"), F.concat(F.lit("a"), k, F.lit("_1.fq;b"), k, F.lit("_1.fq")), F.lit("ignored"))
    rows = t.read("nation").select(F.lit("sheet.csv").alias("file"), (F.col("n_nationkey") + 2).cast("int").alias("ord"), value.alias("value"))
    top = t.spark.createDataFrame([("sheet.csv", 0, "# a comment"), ("sheet.csv", 1, "Name,Type,R1,Colour")], "file string, ord int, value string")
    return readers.read_sheet(t.spark, _files(t, top.unionByName(rows)) + "/sheet.csv").select("sample_id", "layout", "fastq_1", F.col("line").cast("bigint").alias("line"))


@query("io_control_table", "SELECT CAST(s_suppkey AS VARCHAR) AS input_id, s_name AS path, CAST(s_nationkey AS VARCHAR) AS batch FROM supplier")
def _(t):
    rows = t.read("supplier").select(tabbed(text("s_suppkey"), "s_name", text("s_nationkey")).alias("value"))
    return readers.read_control(t.spark, _files(t, _one(rows, ["input_id\tpath\tbatch"], "inputs.tsv")), ["input_id", "path"], extra=True)


def _runs(t):
    k = text("n_nationkey")
    option = F.to_json(F.struct(F.lit("exon").alias("count_feature"), F.when(F.col("n_nationkey") % 4 != 0, k).alias("tool_version")))
    nest = F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit('{"quantification": '), option, F.lit("}"))).when(F.col("n_nationkey") % 3 == 1, F.concat(F.lit('{"options": '), option, F.lit("}"))).otherwise(option)
    meta = t.read("nation").select(F.concat(F.lit("m"), k, F.lit(".json")).alias("file"), F.lit(0).alias("ord"), nest.alias("value"))
    return readers.read_run_metadata(t.spark, _files(t, meta, "meta"), ["count_feature", "tool_version"])


@query("io_run_metadata", "SELECT 'm' || n_nationkey || '.json' AS file, 'exon' AS count_feature, CASE WHEN n_nationkey % 4 <> 0 THEN CAST(n_nationkey AS VARCHAR) END AS tool_version FROM nation")
def _(t):
    return _runs(t).drop("path")


def _hashed(t):
    rows = t.read("nation").select(F.concat(F.lit("n"), text("n_nationkey")).alias("file"), F.lit(0).alias("ord"), F.col("n_name").alias("value"))
    return readers.file_hashes(t.spark, _files(t, rows, "hashed")).select(readers.base_name(F.col("path")).alias("file"), "sha256")


@query("io_file_hashes", "SELECT 'n' || n_nationkey AS file, sha256(n_name || chr(10)) AS sha256 FROM nation")
def _(t):
    return _hashed(t)


@query(
    "io_provenance",
    """SELECT s_suppkey AS input_id, CASE WHEN s_nationkey % 2 = 0 THEN sha256(n_name || chr(10)) END AS counts_sha256, CASE WHEN s_suppkey % 5 <> 0 THEN 'exon' END AS effective_count_feature,
    CASE WHEN s_suppkey % 5 <> 0 AND s_nationkey % 4 <> 0 THEN CAST(s_nationkey AS VARCHAR) END AS effective_tool_version FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def _(t):
    k = text("s_nationkey")
    inputs = t.read("supplier").select(F.col("s_suppkey").alias("input_id"), F.concat(F.when(F.col("s_nationkey") % 2 == 0, "n").otherwise("lost"), k).alias("counts_file"), F.when(F.col("s_suppkey") % 5 != 0, F.concat(F.lit("m"), k, F.lit(".json"))).alias("metadata_file"))
    return readers.provenance(inputs, _hashed(t), _runs(t)).drop("counts_file", "metadata_file")


@query("io_table", "SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_size % 4 = 0 THEN 'NA' ELSE p_name END AS name, '[' || p_size || ',1]' AS cells FROM part")
def _(t):
    path = _folder(t, "table")
    writers.write_table(t.read("part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 4 != 0, F.col("p_name")).alias("name"), F.array(F.col("p_size"), F.lit(1)).alias("cells")), path)
    return t.spark.read.csv(path, sep="\t", header=True)


@query("io_json_summary", "SELECT count(*) AS n, max(p_size) AS largest, NULL AS missing FROM part")
def _(t):
    path = _folder(t, "summary")
    writers.write_json_summary(t.read("part").agg(F.count(F.lit(1)).alias("n"), F.max("p_size").alias("largest"), F.lit(None).cast("string").alias("missing")), path)
    return t.spark.read.schema("n bigint, largest int, missing string").json(path)


@query("io_qc_bundle", "SELECT 'sample_metrics' AS name, sample_id AS key, CAST(sum(n) AS VARCHAR) AS value FROM counts GROUP BY 2 UNION ALL SELECT 'unassigned_long', sample_id || ':' || category, CAST(n AS VARCHAR) FROM counters", "counts", "counters")
def _(t):
    path = _folder(t, "qc")
    metrics = t.counts().groupBy("sample_id").agg(F.sum("n").alias("gene_count_sum"))
    writers.write_qc_bundle({"sample_metrics": metrics, "unassigned_long": t.counters().where("sample_id IS NOT NULL")}, path)
    read = lambda name: t.spark.read.csv(f"{path}/{name}", sep="\t", header=True)
    a = read("sample_metrics").select(F.lit("sample_metrics").alias("name"), F.col("sample_id").alias("key"), F.col("gene_count_sum").alias("value"))
    return a.unionByName(read("unassigned_long").select(F.lit("unassigned_long").alias("name"), F.concat_ws(":", "sample_id", "category").alias("key"), F.col("n").alias("value")))
