"""Writers: tables, features, variants and sequences as the text formats of the field."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str) -> None:
    """Tab-separated with a heading, null as ``NA``, nested cells as JSON."""
    flat = df.select(*[F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes])
    flat.write.mode("overwrite").csv(path, sep="\t", header=True, nullValue="NA", emptyValue="")


def write_matrix(counts: DataFrame, path: str, samples: list[str], order: DataFrame | None = None) -> None:
    """Wide matrix, samples sorted, genes in the order of ``order(gene_id, ord)`` or by id."""
    wide = counts.groupBy("gene_id").pivot("sample_id", sorted(samples)).agg(F.sum("n"))
    sorted_rows = wide.orderBy("gene_id") if order is None else wide.join(order, "gene_id").orderBy("ord").drop("ord")
    write_table(sorted_rows, path)


def write_decimal_matrix(values: DataFrame, path: str, samples: list[str]) -> None:
    """Wide matrix of three decimals (halves rounded up), genes sorted, absent cells ``0.000``."""
    wide = values.groupBy("gene_id").pivot("sample_id", samples).agg(F.sum("n")).na.fill(0.0, samples)
    write_table(wide.orderBy("gene_id").select("gene_id", *[F.format_string("%.3f", F.col(f"`{s}`").cast("double")).alias(s) for s in samples]), path)


def write_lines(df: DataFrame, path: str, order: list[str] | None = None, header: list[str] | None = None) -> None:
    """The ``value`` column as text: header lines first, then rows by ``order``.

    One range sort over both, headers with the least keys, so the order holds across the part files. Without an ``order`` no row moves: the header is the first part file.
    """
    order = order or []
    top = None if header is None else df.sparkSession.createDataFrame(list(enumerate(header)), "__h int, value string").withColumn("__k", F.lit(0))
    if not order:
        rows = df.select("value") if not header else top.coalesce(1).sortWithinPartitions("__h").select("value").union(df.select("value"))
    else:
        rows = df.select(F.lit(1).alias("__k"), F.lit(0).alias("__h"), *order, "value")
        rows = (rows if top is None else rows.unionByName(top, allowMissingColumns=True)).orderBy("__k", "__h", *order)
    rows.select("value").write.mode("overwrite").text(path)


def write_vcf(sites: DataFrame, path: str, sample: str = "sample") -> None:
    """Phased sites sorted by chromosome and position."""
    row = F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."), F.lit("PASS"), F.lit("."), F.lit("GT"), "gt")
    head = ["##fileformat=VCFv4.2", '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">', f"#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t{sample}"]
    write_lines(sites.select("chrom", "pos", "ref", "alt", row.alias("value")), path, ["chrom", "pos", "ref", "alt"], head)


def write_snps_by_chromosome(snps: DataFrame, path: str, one_file: bool = False) -> None:
    """``<chrom>.snps.txt`` for each chromosome, ``pos ref alt`` lines by position: a folder, or ``one_file`` as mappers take it.

    For folders rows are dealt by ranges of chromosome and position, so a chromosome is written by several tasks; Spark reads them like
    a file. A single file is written by a task per chromosome. Only the names, one per chromosome, are the driver's.
    """
    if one_file:
        line = F.concat_ws("\t", F.col("pos").cast("string"), "ref", "alt")
        named = snps.select(F.concat(F.col("chrom").cast("string"), F.lit(".snps.txt")).alias("file"), "pos", "ref", "alt", line.alias("value"))
        write_named_files(named, path, ["pos", "ref", "alt"])
        return
    rows = snps.select("chrom", "pos", F.concat_ws("\t", F.col("pos").cast("string"), "ref", "alt").alias("value"))
    dealt = rows.repartitionByRange("chrom", "pos").sortWithinPartitions("chrom", "pos").select("chrom", "value")
    dealt.write.mode("overwrite").partitionBy("chrom").text(path)
    spark = snps.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("chrom="):
            fs.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(folder, unescape(name.removeprefix("chrom=")) + ".snps.txt"))


def bed_rows(genes: DataFrame) -> DataFrame:
    """Zero-based half-open lines of genes."""
    return genes.select("chrom", "start", F.concat_ws("\t", F.col("chrom").cast("string"), (F.col("start") - 1).cast("string"), F.col("end").cast("string"), "gene_id").alias("value"))


def gff_rows(features: DataFrame) -> DataFrame:
    """Features as lines, each in its own style: GTF if it has a ``transcript_id`` and no ``Parent``, else GFF3."""
    attrs = F.col("attrs")
    gtf = F.map_contains_key(attrs, F.lit("transcript_id")) & ~F.map_contains_key(attrs, F.lit("Parent"))
    join = lambda form, sep: F.array_join(F.transform(F.map_entries(attrs), form), sep)
    quoted = join(lambda e: F.concat(e["key"], F.lit(' "'), e["value"], F.lit('";')), " ")
    plain = F.concat(join(lambda e: F.concat(e["key"], F.lit("="), e["value"]), ";"), F.lit(";"))
    text = [F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in ("seqid", "source", "type", "start", "end", "score", "strand", "phase")]
    return features.select("seqid", "start", F.concat_ws("\t", *text, F.when(gtf, quoted).otherwise(plain)).alias("value"))


def fasta_rows(seqs: DataFrame) -> DataFrame:
    """Records of ``seqs(seq_id, sequence)`` as FASTA text."""
    return seqs.select("seq_id", F.concat(F.lit(">"), "seq_id", F.lit("\n"), "sequence").alias("value"))


def write_json_summary(row: DataFrame, path: str) -> None:
    row.coalesce(1).write.mode("overwrite").json(path, ignoreNullFields=False)


def write_qc_bundle(tables: dict[str, DataFrame], path: str) -> None:
    """The QC tables by name, each in a folder of its own."""
    for name, df in tables.items():
        write_table(df, f"{path}/{name}")


def write_named_files(rows: DataFrame, path: str, order: list[str]) -> None:
    """``rows(file, value, ...)`` as text files of those names below ``path``, lines by ``order``.

    A file is what one library, report or sheet has, so a task writes it whole; the driver only gives it its name.
    """
    dealt = rows.repartition("file").sortWithinPartitions("file", *order).select("file", "value")
    spark = rows.sparkSession
    jvm = spark._jvm
    parts, target = jvm.org.apache.hadoop.fs.Path(f"{path}/_parts"), jvm.org.apache.hadoop.fs.Path(path)
    dealt.write.mode("overwrite").partitionBy("file").text(f"{path}/_parts")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    for folder in fs.listStatus(parts):
        name = folder.getPath().getName()
        if name.startswith("file="):
            goal = jvm.org.apache.hadoop.fs.Path(target, unescape(name.removeprefix("file=")))
            fs.mkdirs(goal.getParent())
            (part,) = [x.getPath() for x in fs.listStatus(folder.getPath()) if x.getPath().getName().startswith("part-")]
            fs.rename(part, goal)
    fs.delete(parts, True)
