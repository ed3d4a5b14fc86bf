"""Count tables: merging, roll-ups, library QC, technical replicates, composition and selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import EXACT_DOUBLE, bar_list, ratio, sum_if_complete
from .ranges import exact_quantiles

#: The five counters that HTSeq writes beside the genes.
HTSEQ_COUNTERS = ("no_feature", "ambiguous", "too_low_aQual", "not_aligned", "alignment_not_unique")


def sample_stats(counts: DataFrame) -> DataFrame:
    """Per sample of ``counts(sample_id, gene_id, n)``: assigned reads and genes detected."""
    return counts.groupBy("sample_id").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("assigned"), F.count_if(F.col("n") > 0).alias("genes_detected")
    )


def universe_differences(counts: DataFrame) -> DataFrame:
    """Per sample, genes of the union that it lacks: ``sample_id, n_genes, n_missing``.

    The matrix is consistent if every ``n_missing`` is 0. Gene sets are compared by size, since each is
    part of the union: one aggregate and no self-join.
    """
    union = counts.select("gene_id").distinct().agg(F.count(F.lit(1)).alias("n_union"))
    own = counts.groupBy("sample_id").agg(F.count_distinct("gene_id").alias("n_genes"))
    total = union.first()["n_union"]  # one number
    return own.select("sample_id", "n_genes", (F.lit(total) - F.col("n_genes")).alias("n_missing"))


def merge_counts(counts: DataFrame, samples: list[str], fill: int | None = None) -> DataFrame:
    """Wide matrix, one column per listed sample; absent cells stay null or become ``fill``."""
    wide = counts.groupBy("gene_id").pivot("sample_id", samples).agg(F.sum("n"))
    return wide if fill is None else wide.na.fill(fill, samples)


def unpivot_matrix(matrix: DataFrame, gene_column: str = "gene_id") -> DataFrame:
    """Long ``sample_id, gene_id, n`` of a wide matrix."""
    values = [c for c in matrix.columns if c != gene_column]
    return matrix.unpivot([gene_column], values, "sample_id", "n").withColumnRenamed(gene_column, "gene_id")


def roll_up(quant: DataFrame, gene_map: DataFrame, values: list[str]) -> DataFrame:
    """Sum transcript ``values`` per sample and gene; transcripts without a gene stand for themselves.

    ``quant(sample_id, transcript_id, ...)``, ``gene_map(transcript_id, gene_id)``. ``n_fallback`` counts the
    rows that were not mapped.
    """
    mapped = quant.join(gene_map, "transcript_id", "left")
    return mapped.groupBy("sample_id", F.coalesce("gene_id", "transcript_id").alias("gene_id")).agg(
        *[F.sum(v).alias(v) for v in values], F.count_if(F.col("gene_id").isNull()).alias("n_fallback")
    )


def unmapped_transcripts(quant: DataFrame, gene_map: DataFrame) -> DataFrame:
    """Violations of a strict map: transcripts without a gene, and those with more than one row."""
    missing = quant.select("transcript_id").distinct().join(gene_map, "transcript_id", "left_anti")
    twice = gene_map.groupBy("transcript_id").count().where("count > 1").select("transcript_id")
    return missing.withColumn("rule", F.lit("unmapped")).unionByName(twice.withColumn("rule", F.lit("duplicate")))


def htseq_metrics(counts: DataFrame, counters: DataFrame, unit: Column | None = None) -> DataFrame:
    """Library QC of exclusive two-column counts over a full gene universe.

    ``counts(sample_id, gene_id, n)``, ``counters(sample_id, category, n)``. A rate needs all five counters:
    missing is not zero. ``unit`` is the counting unit by sample; where it is ``unknown`` the physical
    rate is withheld and the counter rate stays.
    """
    genes = counts.groupBy("sample_id").agg(
        F.sum("n").alias("gene_count_sum"),
        F.count_if(F.col("n") > 0).alias("genes_detected"),
        F.count(F.lit(1)).alias("quantified_gene_count"),
    )
    special = counters.where(F.col("category").isin(*HTSEQ_COUNTERS)).groupBy("sample_id").agg(
        *[F.sum(F.when(F.col("category") == c, F.col("n"))).alias(c) for c in HTSEQ_COUNTERS]
    )
    df = genes.join(special, "sample_id", "left").withColumn("count_unit", unit if unit is not None else F.lit("fragment"))
    missing = F.concat_ws("; ", *[F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in HTSEQ_COUNTERS])
    processed = F.when(missing == "", F.col("gene_count_sum") + sum((F.col(c) for c in HTSEQ_COUNTERS), F.lit(0)))
    df = df.withColumn("processed", processed).withColumn("counter_rate_pct", ratio(F.col("gene_count_sum"), F.col("processed")))
    known = F.col("count_unit") != "unknown"
    ok = F.col("processed") > 0
    return df.select(
        "sample_id",
        "gene_count_sum",
        "genes_detected",
        "quantified_gene_count",
        ratio(F.col("genes_detected"), F.col("quantified_gene_count")).alias("genes_detected_pct"),
        "processed",
        "counter_rate_pct",
        F.when(F.coalesce(ok, F.lit(False)), "ok").otherwise("unavailable").alias("counter_status"),
        F.when(known, F.col("counter_rate_pct")).alias("assignment_rate_pct"),
        F.when(F.coalesce(ok & known, F.lit(False)), "ok").otherwise("unavailable").alias("assignment_status"),
        (F.col("gene_count_sum") == 0).alias("zero_assigned"),
        F.concat_ws("; ", F.when(~known, F.lit("counting unit unknown")), F.when(missing != "", missing)).alias("reason"),
    )


def featurecounts_metrics(counts: DataFrame, summary: DataFrame) -> DataFrame:
    """Library QC of a feature counter's summary ``(sample_id, category, n)``.

    The denominator is the sum of all categories, and only if an ``Unassigned_*`` category exists.
    """
    genes = counts.groupBy("sample_id").agg(F.sum("n").alias("gene_count_sum"), F.count_if(F.col("n") > 0).alias("genes_detected"))
    cats = summary.groupBy("sample_id").agg(
        F.sum(F.when(F.col("category") == "Assigned", F.col("n"))).alias("assigned"),
        F.when(F.count_if(F.col("category").startswith("Unassigned_")) > 0, F.sum("n")).alias("processed"),
    )
    df = genes.join(cats, "sample_id", "left")
    return df.select(
        "*",
        ratio(F.col("assigned"), F.col("processed")).alias("assignment_rate_pct"),
        (F.col("assigned") != F.col("gene_count_sum")).alias("sum_differs"),
    )


def salmon_mapping(meta: DataFrame) -> DataFrame:
    """``mapping_rate_pct`` of ``meta(sample_id, num_processed, num_mapped)``, impossible rows flagged."""
    return meta.select(
        "*",
        ratio(F.col("num_mapped"), F.col("num_processed")).alias("mapping_rate_pct"),
        (F.col("num_mapped") > F.col("num_processed")).alias("impossible"),
    )


def technical_merge(counts: DataFrame, members: DataFrame) -> DataFrame:
    """Sum counts per gene over the members of each technical group.

    ``members(sample_id, merge_id)``; a sample without a group is its own. Returns ``merge_id, gene_id, n``.
    """
    grouped = counts.join(members, "sample_id", "left")
    return grouped.groupBy(F.coalesce("merge_id", "sample_id").alias("merge_id"), "gene_id").agg(F.sum("n").alias("n"))


def technical_metrics(metrics: DataFrame, members: DataFrame, numerator: str, denominator: str) -> DataFrame:
    """Rates of technical groups: sums divided, and null if any member's part is null.

    Members are listed in the order of ``members(sample_id, merge_id, ord)`` if that has one, else by id.
    """
    grouped = metrics.join(members, "sample_id", "left").groupBy(F.coalesce("merge_id", "sample_id").alias("merge_id"))
    place = F.struct(F.col("ord") if "ord" in members.columns else F.lit(0), F.col("sample_id"))
    out = grouped.agg(
        F.count(F.lit(1)).alias("n_members"),
        F.array_join(F.transform(F.sort_array(F.collect_set(place)), lambda m: m["sample_id"]), "|").alias("constituent_sample_ids"),
        sum_if_complete(F.col(numerator)).alias("numerator"),
        sum_if_complete(F.col(denominator)).alias("denominator"),
    )
    return out.withColumn("rate_pct", ratio(F.col("numerator"), F.col("denominator")))


def merged_categories(counters: DataFrame, members: DataFrame) -> DataFrame:
    """Counter categories of technical groups; null unless every member has the category."""
    sizes = members.groupBy("merge_id").agg(F.count(F.lit(1)).alias("n_members"))
    seen = counters.join(members, "sample_id").groupBy("merge_id", "category").agg(
        F.sum("n").alias("n"), F.count_distinct("sample_id").alias("n_seen")
    )
    return seen.join(sizes, "merge_id").select("merge_id", "category", F.when(F.col("n_seen") == F.col("n_members"), F.col("n")).alias("n"))


def group_summary(values: DataFrame, keys: list[str], value: str, unit: str) -> DataFrame:
    """Per group: totals, valid, missing and zero rows, distinct units, and exact quartiles by linear interpolation, whose state is bounded by ranges of values."""
    labels = [F.when(F.col(k).isNull() | (F.trim(F.col(k)) == ""), "(missing)").otherwise(F.col(k)).alias(k) for k in keys]
    named, v = values.select(*labels, F.col(value).alias("__value"), F.col(unit).alias("__unit")), F.col("__value")
    out = named.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count(v).alias("n_valid"),
        (F.count(F.lit(1)) - F.count(v)).alias("n_missing"),
        F.count_if(v == 0).alias("n_zero"),
        F.count_distinct("__unit").alias("n_units"),
    )
    out = out.join(exact_quantiles(named, keys, "__value", [0.0, 0.25, 0.5, 0.75, 1.0]), keys, "left")
    return out.select("*", *[F.col("q")[i].alias(n) for i, n in enumerate(("minimum", "q1", "median", "q3", "maximum"))]).drop("q")


def scope_totals(values: DataFrame, keys: list[str], value: str, unit: str) -> DataFrame:
    """Sum per scope, only where every value is present and every unit known."""
    complete = (F.count(value) == F.count(F.lit(1))) & (F.count_if(F.coalesce(F.col(unit), F.lit("unknown")) == "unknown") == 0)
    return values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.when(complete, F.sum(value)).alias("total"))


def headline_cards(metrics: DataFrame, small_pct: float = 0.01) -> DataFrame:
    """One row of counts: zero assigned, zero sum, unavailable and tiny positive rates; technical aggregates do not count."""
    rate = F.col("assignment_rate_pct")
    if "qc_level" in metrics.columns:
        metrics = metrics.where(~F.col("qc_level").eqNullSafe("technical_aggregate"))
    return metrics.agg(
        F.count_if("zero_assigned").alias("n_zero_assigned"),
        F.count_if(F.col("gene_count_sum") == 0).alias("n_zero_sum"),
        F.count_if(rate.isNull()).alias("n_unavailable"),
        F.count_if((rate > 0) & (rate < small_pct)).alias("n_tiny"),
    )


def composition(libraries: DataFrame, primary: str, least_aligned: int, high_ppm: float = 1000.0) -> DataFrame:
    """Read composition per sample and organism.

    ``libraries(sample_id, organism, assigned, not_aligned, total)``. The primary organism's total is the
    input; a sample without it has null rates. Long form, one row per pair.
    """
    w = Window.partitionBy("sample_id")
    is_primary = F.col("organism") == primary
    aligned = F.col("total") - F.col("not_aligned")
    df = libraries.select(
        "*",
        aligned.alias("aligned"),
        F.max(F.when(is_primary, F.col("total"))).over(w).alias("input_pairs"),
        F.max(F.when(is_primary, aligned)).over(w).alias("primary_aligned"),
    )
    ppm = F.round(ratio(F.col("assigned"), F.col("input_pairs"), 1e6), 4)
    return df.select(
        "sample_id",
        "organism",
        "input_pairs",
        "aligned",
        F.round(ratio(F.col("aligned"), F.col("input_pairs")), 4).alias("aligned_pct"),
        ppm.alias("assigned_ppm"),
        (F.col("primary_aligned") >= least_aligned).alias("qc_pass"),
        F.when(ppm.isNull(), "NA").when(ppm >= high_ppm, "high").otherwise("low").alias("signal_group"),
    )


def exposure_groups(libraries: DataFrame, label: str, control: str, high_ppm: float, least_aligned: int, groups: list[str]) -> DataFrame:
    """Exposure group, gates and the first failing reason of ``libraries(sample_id, label, ppm, primary_aligned, age_group)``."""
    passed = F.col("primary_aligned") >= least_aligned
    listed = F.col("age_group").isin(*groups)
    return libraries.select(
        "sample_id",
        F.when(F.col(label) == control, "control").when(F.col("ppm") >= high_ppm, "high").otherwise("treated_low").alias("exposure_group"),
        passed.alias("qc_pass"),
        (passed & listed).alias("in_model"),
        F.when(~passed, "low_alignment").when(~listed, "age_group").otherwise("").alias("exclusion_reason"),
    )


def library_qc(metadata: DataFrame, stats: DataFrame, companions: DataFrame, label: str, control: str, signal: str, high_ppm: float, least_aligned: int, groups: list[str]) -> DataFrame:
    """Libraries with their alignment and each companion organism's share, exposure group and gates.

    ``stats(sample, ...)`` has some of the six counters, whose sum is the library's fragments; ``companions(sample_id, organism,
    gene_id, n)`` are count rows with their ``__`` counters. Samples must be in all of them; ``signal`` names the organism whose
    parts per million set the group.
    """
    names = [c for c in ("assigned", *HTSEQ_COUNTERS) if c in stats.columns]
    st = stats.select(F.col("sample").alias("sample_id"), sum((F.col(c) for c in names), F.lit(0)).alias("fragments"), "assigned", "not_aligned")
    q = metadata.join(st, "sample_id").withColumn("primary_aligned", F.col("fragments") - F.col("not_aligned"))
    special = F.col("gene_id").startswith("__")
    per = companions.groupBy("sample_id").pivot("organism", organisms_of(companions)).agg(
        F.sum(F.when(~special, F.col("n"))).alias("assigned"), F.sum(F.when(F.col("gene_id") != "__not_aligned", F.col("n"))).alias("aligned"), F.sum("n").alias("total")
    )
    q = q.join(per, "sample_id")
    for organism in organisms_of(companions):
        q = q.where(F.col(f"{organism}_total").isNotNull())
        q = q.withColumn(f"{organism}_aligned_pct", ratio(F.col(f"{organism}_aligned"), F.col(f"{organism}_total")))
        q = q.withColumn(f"{organism}_ppm", ratio(F.col(f"{organism}_assigned"), F.col("fragments"), 1e6)).drop(f"{organism}_aligned", f"{organism}_total")
    grouped = exposure_groups(q.withColumn("ppm", F.col(f"{signal}_ppm")), label, control, high_ppm, least_aligned, groups)
    return q.join(grouped, "sample_id")


def organisms_of(companions: DataFrame) -> list[str]:
    """The companion organisms, sorted; one short name each goes to the driver, as a pivot needs its columns."""
    return sorted(r["organism"] for r in companions.select("organism").distinct().collect())


def export_subset(counts: DataFrame, samples: list[str]) -> DataFrame:
    """Wide matrix of the chosen samples in their order, genes of the whole matrix; a sample it lacks raises."""
    wanted = counts.where(F.col("sample_id").isin(*samples))
    found = {r["sample_id"] for r in wanted.select("sample_id").distinct().collect()}  # at most the samples asked for
    if set(samples) - found:
        raise ValueError(f"samples missing from the matrix: {sorted(set(samples) - found)}")
    genes = counts.select("gene_id").distinct()
    return genes.join(merge_counts(wanted, samples), "gene_id", "left")


def matched_statistics(samples: DataFrame, stats: DataFrame) -> DataFrame:
    """Samples with their statistics row by ``(stats_path, stats_key)``; those without one keep nulls."""
    s = stats.withColumnsRenamed({"stats_path": "__path", "stats_key": "__key"})
    return samples.join(s, (F.col("stats_path") == F.col("__path")) & (F.col("stats_key") == F.col("__key")), "left").drop("__path", "__key")


def statistics_problems(samples: DataFrame, stats: DataFrame) -> DataFrame:
    """``rule, key, detail`` where a sample has no or several statistics rows, or samples share one."""
    key = F.concat_ws("|", "stats_path", "stats_key").alias("key")
    wanted = samples.where("stats_path IS NOT NULL").groupBy("stats_path", "stats_key").agg(F.count(F.lit(1)).alias("n_samples"))
    there = stats.groupBy("stats_path", "stats_key").agg(F.count(F.lit(1)).alias("n_rows"))
    both = wanted.join(there, ["stats_path", "stats_key"], "left").na.fill(0, ["n_rows"])
    reused = both.where("n_samples > 1").select(F.lit("reused").alias("rule"), key, F.col("n_samples").cast("string").alias("detail"))
    return reused.unionByName(both.where("n_rows <> 1").select(F.lit("not_one_row").alias("rule"), key, F.col("n_rows").cast("string").alias("detail")))


def categories_with_metrics(categories: DataFrame, metrics: DataFrame) -> DataFrame:
    """Unassigned categories beside the metrics of their sample and level; a level that is not given is the library's."""
    level = lambda df: df.withColumn("qc_level", F.coalesce("qc_level", F.lit("library")) if "qc_level" in df.columns else F.lit("library"))
    return level(categories).join(level(metrics), ["sample_id", "qc_level"], "left")


def modelling_gates(samples: DataFrame) -> DataFrame:
    """Per analysis of ``samples(analysis_id, analysis_mode, count_unit, biological_unit_status)`` the first reason not to model it, or ''."""
    unit = F.coalesce("count_unit", F.lit("unknown"))
    open_status = F.lower(F.coalesce("biological_unit_status", F.lit(""))).isin("unverified", "unknown")
    per = samples.groupBy("analysis_id", "analysis_mode").agg(F.count_distinct(unit).alias("n_units"), F.count_if(open_status).alias("n_unverified"))
    reason = F.when(F.col("n_units") > 1, "mixed_units").when((F.col("analysis_mode") == "inferential") & (F.col("n_unverified") > 0), "unverified_biology").otherwise("")
    return per.withColumn("reason", reason)


def dashboard_defaults(metrics: DataFrame) -> DataFrame:
    """Metrics with the detection share computed anew and groups that are not named ``unknown``."""
    name = lambda c, default: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(default)).alias(c)
    detected = ratio(F.col("genes_detected").try_cast("double"), F.col("quantified_gene_count").try_cast("double")).alias("supplied_gene_detection_pct")
    study = name("study_id", "unknown study") if "study_id" in metrics.columns else F.lit("all samples").alias("study_id")
    others = [c for c in metrics.columns if c not in ("group", "study_id", "supplied_gene_detection_pct")]
    return metrics.select(*others, name("group", "unknown"), study, detected)


def composition_bars(libraries: DataFrame, shares: dict[str, str]) -> DataFrame:
    """``sample_id, genome, pct`` of the named share columns and of the rest of 100 %, which is never negative."""
    rest = F.greatest(F.lit(0.0), F.lit(100.0) - sum((F.col(c) for c in shares.values()), F.lit(0.0)))
    wide = libraries.select("sample_id", *[F.col(c).cast("double").alias(n) for n, c in shares.items()], rest.alias("other"))
    return wide.unpivot(["sample_id"], [*shares, "other"], "genome", "pct")


def membership(samples: DataFrame, chosen: str, sets: str = "sample_sets") -> DataFrame:
    """Whether each sample is analysed and why not: ``sample_id, selected, reason``."""
    inside = F.array_contains(bar_list(F.col(sets)), chosen)
    selected = F.col("include_analysis") & inside
    reason = F.when(selected, "").when(~F.col("include_analysis"), F.coalesce("exclusion_reason", F.lit(""))).otherwise("outside_sample_set")
    return samples.select("sample_id", selected.alias("selected"), reason.alias("reason"))


def eligibility(counts: DataFrame, least_cpm: float = 1.0, least_samples: int = 2) -> DataFrame:
    """Per sample: library, detected genes and the sum retained over genes with enough CPM in enough samples."""
    libraries = counts.groupBy("sample_id").agg(F.sum("n").alias("library"))
    cpm = counts.join(libraries, "sample_id").withColumn("cpm", ratio(F.col("n"), F.col("library"), 1e6))
    positive = libraries.where("library > 0").count()
    genes = cpm.groupBy("gene_id").agg(F.count_if(F.col("cpm") >= least_cpm).alias("k"))
    genes = genes.where(F.col("k") >= min(least_samples, positive)).select("gene_id", F.lit(True).alias("kept"))
    return cpm.join(genes, "gene_id", "left").groupBy("sample_id").agg(
        F.max("library").alias("library_sum"),
        F.count_if(F.col("n") > 0).alias("detected_genes"),
        F.coalesce(F.sum(F.when(F.col("kept"), F.col("n"))), F.lit(0)).alias("retained_sum"),
    )


def assay_conflicts(inputs: DataFrame, assay: str, fields: list[str]) -> DataFrame:
    """Fields of an assay's inputs that disagree: ``assay, field, n_values``, and how many of them."""
    long = inputs.unpivot([assay], [F.col(f).cast("string").alias(f) for f in fields], "field", "value")
    return long.groupBy(assay, "field").agg(F.count_distinct("value").alias("n_values")).where("n_values > 1")


def exactness(counts: DataFrame, value: str = "n") -> DataFrame:
    """Per sample, whether all counts fit a double exactly; those that do not block modelling, not QC."""
    return counts.groupBy("sample_id").agg((F.max(value) > EXACT_DOUBLE).alias("blocked"))


def strand_mix(calls: DataFrame) -> DataFrame:
    """One row: the stranded directions in use, and whether they are mixed."""
    used = F.sort_array(F.collect_set(F.when(F.col("effective").isin("forward", "reverse"), F.col("effective"))))
    return calls.agg(F.array_join(used, ",").alias("directions"), (F.size(used) > 1).alias("mixed"))


def declared_or_called(samples: DataFrame, calls: DataFrame) -> DataFrame:
    """Strandedness in effect: what was declared, else the call, undecided calls counting as unstranded."""
    declared = F.when(~F.coalesce("declared", F.lit("")).isin("", "-", "auto"), F.col("declared"))
    call = F.when(F.col("call").isin("forward", "reverse", "unstranded"), F.col("call"))
    return samples.join(calls, "sample_id", "left").select(
        "sample_id",
        F.coalesce(declared, call, F.lit("unstranded")).alias("effective"),
        F.coalesce(declared.isNotNull() & call.isNotNull() & (declared != call), F.lit(False)).alias("conflict"),
    )
