"""Constraint queries: each returns its violations as ``rule, key, detail``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import SHEET_MISSING, bar_list

#: Mate rules, tried in order, as pattern and replacement.
MATE_RULES = (
    (r"_R1_(\d+)$", r"_R2_$1"), (r"_R1$", "_R2"), (r"\.R1$", ".R2"), (r"_1$", "_2"), (r"\.1$", ".2"),
    (r"_fwd$", "_rev"), (r"_f$", "_r"), (r"-1$", "-2"),
)
FASTQ_END = r"(?i)\.(fastq|fq)(\.(gz|bz2|zst))?$"
STRANDS = ("auto", "unstranded", "forward", "reverse")
READ_TYPES = ("short", "isoseq", "ont_cdna", "ont_drna")
USES = ("braker", "stringtie", "count", "all")
DESIGNS = ("group", "additive", "factorial", "paired", "trend")
TESTS = ("qlf", "treat", "deseq2")


def violations(df: DataFrame, rule: str, broken: Column, key: Column, detail: Column | None = None) -> DataFrame:
    text = detail if detail is not None else F.lit("")
    return df.where(F.coalesce(broken, F.lit(True))).select(F.lit(rule).alias("rule"), key.cast("string").alias("key"), text.cast("string").alias("detail"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def require_none(found: DataFrame) -> None:
    """Raise with the first ten violations, if there are any."""
    first = found.limit(10).collect()
    if first:
        raise ValueError("; ".join(f"{r['rule']}: {r['key']} {r['detail']}".strip() for r in first))


def duplicates(df: DataFrame, keys: list[str], rule: str = "duplicate") -> DataFrame:
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return n.select(F.lit(rule).alias("rule"), F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("key"), F.col("n").cast("string").alias("detail"))


def bad_numbers(df: DataFrame, key: str, value: str, integer: bool) -> DataFrame:
    """Cells that are no number, not finite, negative, or not whole where whole ones are asked for."""
    x = F.col(value).try_cast("double")
    rule = (
        F.when(x.isNull(), "not_a_number")
        .when(F.isnan(x) | (F.abs(x) == float("inf")), "not_finite")
        .when(x < 0, "negative")
        .when(F.lit(integer) & (x != F.rint(x)), "not_integer")
    )
    return df.select(rule.alias("rule"), F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("detail")).where("rule IS NOT NULL")


def foreign_key(df: DataFrame, key: str, parent: DataFrame, parent_key: str, rule: str) -> DataFrame:
    p = parent.select(F.col(parent_key).alias("__p")).distinct()
    return df.join(p, F.col(key) == F.col("__p"), "left_anti").select(F.lit(rule).alias("rule"), F.col(key).cast("string").alias("key"), F.lit("").alias("detail"))


def input_contract(inputs: DataFrame, samples: DataFrame) -> DataFrame:
    """Rules of the input and sample tables: required cells, enumerations, hash shape, keys and reasons."""
    iid, sid = F.col("input_id"), F.col("sample_id")
    modes = F.col("count_mode").isin("exclusive", "multiassign", "estimated")
    sha = F.coalesce(F.col("sha256"), F.lit(""))
    return union_all(
        [
            violations(inputs, "input_required", F.trim(F.coalesce(F.col("path"), F.lit(""))) == "", iid),
            violations(inputs, "count_mode", ~modes, iid, F.col("count_mode")),
            violations(inputs, "sha256", (sha != "") & ~sha.rlike("^[0-9a-f]{64}$"), iid, sha),
            violations(samples, "include_analysis", ~F.col("include_analysis").isin("true", "false"), sid, F.col("include_analysis")),
            violations(samples, "exclusion_reason", (F.col("include_analysis") == "false") & (F.trim(F.coalesce(F.col("exclusion_reason"), F.lit(""))) == ""), sid),
            foreign_key(samples, "input_id", inputs, "input_id", "unknown_input"),
            duplicates(samples, ["sample_id"], "duplicate_sample"),
            duplicates(samples, ["input_id", "source_sample_id"], "duplicate_column"),
        ]
    )


#: Fixed value: what the name of a variable looks like.
VARIABLE = r"^[A-Za-z][A-Za-z0-9_]*$"


def declared_variables(analyses: DataFrame) -> Column:
    """All variables of an analysis as an array: factors, numbers, nuisance factors and numbers, and the subject, as far as there are such columns."""
    lists = [bar_list(F.col(c)) for c in ("factor_cols", "numeric_cols", "nuisance_factor_cols", "nuisance_numeric_cols", "subject_col") if c in analyses.columns]
    return F.filter(F.concat(*[F.coalesce(x, F.array().cast("array<string>")) for x in lists]), lambda v: v != "")


def analysis_contract(analyses: DataFrame, contrasts: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """Rules of analyses and contrasts: enumerations, ranges, variables named once and well and given for every sample, presence, and cell weights that sum to nothing.

    ``analyses(analysis_id, analysis_mode, design_type, effect_test, fdr_cut, lfc_cut, seed, factor_cols, numeric_cols[, nuisance_factor_cols,
    nuisance_numeric_cols, subject_col])``, ``contrasts(analysis_id, contrast_id, basis, weight)``, all text. ``metadata(analysis_id, sample_id, variable, value)`` has a row per
    sample of an analysis and variable it has; a variable that a sample lacks or leaves empty is ``metadata_missing``.
    """
    a = F.col("analysis_id")
    fdr, lfc = F.col("fdr_cut").try_cast("double"), F.col("lfc_cut").try_cast("double")
    finite = lambda x: ~F.isnan(x) & (x < float("inf"))
    names = declared_variables(analyses)
    named = analyses.select("analysis_id", F.explode(names).alias("variable")).distinct()
    given = []
    if metadata is not None:
        people = metadata.select("analysis_id", "sample_id").distinct()
        filled = metadata.where("trim(value) <> ''").select("analysis_id", "sample_id", "variable")
        lacking = named.join(people, "analysis_id").join(filled, ["analysis_id", "sample_id", "variable"], "left_anti").select("analysis_id", "variable").distinct()
        given.append(violations(lacking, "metadata_missing", F.lit(True), a, F.col("variable")))
    weights = contrasts.groupBy("analysis_id", "contrast_id").agg(F.sum(F.col("weight").try_cast("double")).alias("w"), F.count_distinct("basis").alias("b"), F.max("basis").alias("basis"))
    cid = F.concat_ws("|", "analysis_id", "contrast_id")
    return union_all(
        [
            violations(analyses, "mode", ~F.col("analysis_mode").isin("inferential", "exploratory"), a, F.col("analysis_mode")),
            violations(analyses, "design_type", ~F.col("design_type").isin(*DESIGNS), a, F.col("design_type")),
            violations(analyses, "effect_test", ~F.col("effect_test").isin(*TESTS), a, F.col("effect_test")),
            violations(analyses, "fdr_cut", ~((fdr > 0) & (fdr <= 1)), a, F.col("fdr_cut")),
            violations(analyses, "lfc_cut", ~((lfc >= 0) & finite(lfc)), a, F.col("lfc_cut")),
            violations(analyses, "seed", ~F.col("seed").try_cast("bigint").between(0, 2147483647), a, F.col("seed")),
            violations(analyses, "variables", F.size(F.array_distinct(names)) < F.size(names), a),
            violations(named, "variable_name", ~F.col("variable").rlike(VARIABLE), a, F.col("variable")),
            *given,
            violations(analyses.where("analysis_mode = 'inferential'").join(contrasts, "analysis_id", "left_anti"), "no_contrast", F.lit(True), a),
            violations(analyses.where("analysis_mode = 'exploratory'").join(contrasts, "analysis_id", "left_semi"), "contrast_not_wanted", F.lit(True), a),
            violations(contrasts, "contrast_basis", ~F.col("basis").isin("cell", "coefficient"), cid, F.col("basis")),
            violations(contrasts, "contrast_weight", ~finite(F.abs(F.col("weight").try_cast("double"))), cid, F.col("weight")),
            violations(weights, "weights", (F.col("basis") == "cell") & (F.abs("w") > 1e-10), cid, F.col("w")),
            violations(weights, "basis", F.col("b") > 1, cid),
        ]
    )


def technical_members(samples: DataFrame, same: list[str]) -> DataFrame:
    """Rules of technical groups of ``samples(sample_id, technical_merge_id, technical_partition_id, technical_disjoint, ...)``."""
    members = samples.where("technical_merge_id IS NOT NULL")
    key = F.col("technical_merge_id")
    per = members.groupBy("technical_merge_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("technical_partition_id").alias("parts"),
        F.count_if(F.coalesce(F.col("technical_disjoint"), F.lit("")) != "true").alias("not_disjoint"),
        *[F.count_distinct(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(f"v_{c}") for c in same],
    )
    parts = [violations(per, "partitions", F.col("parts") < F.col("n"), key), violations(per, "disjoint", F.col("not_disjoint") > 0, key)]
    parts += [violations(per, f"differs:{c}", F.col(f"v_{c}") > 1, key) for c in same]
    clash = members.select("technical_merge_id").distinct().join(samples.select(F.col("sample_id").alias("technical_merge_id")), "technical_merge_id", "left_semi")
    return union_all([*parts, violations(clash, "merge_id_is_sample", F.lit(True), key)])


def statistics_consistency(metrics: DataFrame) -> DataFrame:
    """Numerator over denominator, and reported figures that differ from recomputed ones."""
    key = F.col("sample_id")
    return union_all(
        [
            violations(metrics, "numerator_over_denominator", F.coalesce(F.col("assigned") > F.col("processed"), F.lit(False)), key),
            violations(metrics, "assigned_differs", F.coalesce(F.col("reported_assigned") != F.col("assigned"), F.lit(False)), key),
            violations(metrics, "total_differs", F.coalesce(F.col("reported_total") != F.col("processed"), F.lit(False)), key),
        ]
    )


def metadata_conflicts(declared: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Declared values that differ from those of the run's metadata, both long ``(keys..., field, value)``."""
    f = found.withColumnRenamed("value", "found")
    both = declared.join(f, [*keys, "field"]).where("value IS NOT NULL AND found IS NOT NULL AND value <> found")
    return both.select(F.lit("metadata").alias("rule"), F.concat_ws("|", *keys, "field").alias("key"), F.concat_ws(" vs ", "value", "found").alias("detail"))


def sheet_rules(sheet: DataFrame) -> DataFrame:
    """Sample-sheet rules on ``sheet(line, sample_id, layout, fastq_1, fastq_2, strandedness, read_type, use_for, bam)``; columns it lacks count as blank."""
    for c in ("read_type", "use_for"):
        sheet = sheet if c in sheet.columns else sheet.withColumn(c, F.lit(""))
    cell = lambda c: F.when(~F.lower(F.trim(F.coalesce(F.col(c), F.lit("")))).isin(*SHEET_MISSING), F.trim(F.col(c)))
    key = F.col("sample_id")
    layout, mate = F.lower(F.coalesce(cell("layout"), F.lit(""))), cell("fastq_2").isNotNull()
    bam, reads = cell("bam").isNotNull(), cell("fastq_1").isNotNull()
    n1, n2 = (F.size(F.split(F.coalesce(cell(c), F.lit("")), "[;,]")) for c in ("fastq_1", "fastq_2"))
    first = sheet.groupBy("sample_id").agg(F.min("line").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    uses = F.filter(F.transform(F.split(F.lower(F.coalesce(cell("use_for"), F.lit(""))), "[,;]"), lambda u: F.trim(u)), lambda u: u != "")
    enum = lambda c, values: cell(c).isNotNull() & ~F.lower(cell(c)).isin(*values)
    return union_all(
        [
            violations(sheet, "pe_without_mate", reads & (layout == "pe") & ~mate, key),
            violations(sheet, "se_with_mate", (layout == "se") & mate, key),
            violations(sheet, "interleaved_with_mate", (layout == "interleaved") & mate, key),
            violations(sheet, "bam_or_fastq", bam == reads, key),
            violations(sheet, "replicate_lists", mate & (n1 != n2), key),
            violations(sheet, "sample_id", ~F.coalesce(F.col("sample_id"), F.lit("")).rlike("^[A-Za-z0-9][A-Za-z0-9_.-]{0,63}$"), key),
            violations(sheet, "strandedness", enum("strandedness", STRANDS), key, F.col("strandedness")),
            violations(sheet, "read_type", enum("read_type", READ_TYPES), key, F.col("read_type")),
            violations(sheet, "use_for", cell("use_for").isNotNull() & (F.size(F.array_except(uses, F.array(*map(F.lit, USES)))) > 0), key, F.col("use_for")),
            first.select(F.lit("duplicate_sample").alias("rule"), F.col("sample_id").alias("key"), F.col("first").cast("string").alias("detail")),
        ]
    )


def resolved_layout(layout: Column, has_bam: Column, paired_bam: Column, has_mate: Column, mate_found: Column) -> Column:
    """Layout in effect: of a BAM its pairing; else interleaved, PE by a mate, declared SE, PE by an inferred mate, SE."""
    return (
        F.when(has_bam, F.when(F.coalesce(paired_bam, F.lit(False)), "PE").otherwise("SE"))
        .when(F.lower(layout) == "interleaved", "interleaved")
        .when(has_mate, "PE")
        .when(F.lower(layout) == "se", "SE")
        .when(mate_found, "PE")
        .otherwise("SE")
    )


def inferred_mates(files: DataFrame, listing: DataFrame) -> DataFrame:
    """Mate of each first-read file of ``files(path)`` among ``listing(path, size)``: the first rule whose result exists and is not empty.

    A name without a FASTQ ending has no mate.
    """
    files = files.where(F.col("path").rlike(FASTQ_END))
    stem, end = F.regexp_replace("path", FASTQ_END, ""), F.regexp_extract("path", FASTQ_END, 0)
    rules = F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(p).alias("p"), F.lit(r).alias("r")) for i, (p, r) in enumerate(MATE_RULES)])
    tried = files.select("path", stem.alias("stem"), end.alias("end"), F.explode(rules).alias("m"))
    tried = tried.where(F.expr("regexp_like(stem, m.p)")).select("path", "m.rule", F.concat(F.expr("regexp_replace(stem, m.p, m.r)"), "end").alias("mate"))
    real = listing.where("size > 0").select(F.col("path").alias("mate"))
    return tried.join(real, "mate").groupBy("path").agg(F.min_by("mate", "rule").alias("mate"), F.min("rule").alias("rule"))


def mate_id_conflicts(pairs: DataFrame, reads: DataFrame, n: int = 4) -> DataFrame:
    """Pairs ``(path, mate)`` whose first ``n`` read ids differ: ``rule, key, detail``; ``reads(path, ord, read_id)``.

    A file without reads says nothing.
    """
    first = reads.where(F.col("ord") < n).groupBy("path").agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", "read_id"))), lambda r: r["read_id"]).alias("ids"))
    left = pairs.join(first, "path")
    both = left.join(first.select(F.col("path").alias("mate"), F.col("ids").alias("mate_ids")), "mate")
    return violations(both, "mate_ids", F.col("ids") != F.col("mate_ids"), F.col("path"), F.concat_ws(" vs ", F.col("ids")[0], F.col("mate_ids")[0]))


def selected_uses(rows: DataFrame, consumer: str, every: tuple[str, ...] = USES[:3]) -> DataFrame:
    """Rows whose ``use_for`` list names the consumer; ``all`` names each."""
    uses = F.flatten(F.transform(bar_list(F.translate("use_for", ";,", "||")), lambda u: F.when(F.lower(u) == "all", F.array(*map(F.lit, every))).otherwise(F.array(F.lower(u)))))
    return rows.where(F.array_contains(uses, consumer))


def prealigned(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that come as alignments, and those to be aligned."""
    has = F.trim(F.coalesce("bam", F.lit(""))) != ""
    return rows.where(has), rows.where(~has)


def provenance_gaps(rows: DataFrame) -> DataFrame:
    """Inputs without both content hashes."""
    gap = F.col("input_sha256").isNull() | F.col("annotation_sha256").isNull()
    return violations(rows, "provenance", gap, F.col("input_id"))
