"""QC of libraries of any counter, mode and gene universe, and of the technical groups they make."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ratio, sum_if_complete
from .counts import HTSEQ_COUNTERS

#: Formats whose files hold every gene, whatever is said of the universe. Fixed values.
COMPLETE = ("htseq_raw", "featurecounts_raw")
#: Why a figure is missing.
REASONS = {
    "none": "no assignment statistics",
    "universe": "gene universe not complete and no assigned number reported",
    "counters": "not all five counters; missing is not zero",
    "shared": "reads may count for several genes: the sum is no number of assigned reads",
    "summary": "categories of the summary not known to exclude each other",
    "zero": "denominator is zero",
    "unit": "unit of counting unknown",
    "mapping": "no mapping statistics",
    "members": "a member lacks a denominator",
    "member mapping": "a member lacks mapping statistics",
    "member units": "members need one known unit and complete counters",
}


def library_metrics(counts: DataFrame, categories: DataFrame, libraries: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """One row per library of ``libraries(sample_id, format, mode, universe, unit[, reported_assigned, reported_total])``.

    ``counts(sample_id, gene_id, n)``, ``categories(sample_id, category, n)``: counters beside genes or a summary, ``mapping(sample_id, num_processed, num_mapped)``.
    The tool is what ``format`` begins with.

    The number assigned is the sum over genes only where each read counts once (``mode`` exclusive) and all genes are there (``universe`` full, or a raw
    format); else the one reported, or for a feature counter its category ``Assigned``. The denominator adds the five counters, which must all be there, or all categories of a summary that are known to
    exclude each other. Missing is not zero: what cannot be told is null, with a reason. Counter rates are kept where the unit is unknown, physical rates are not.
    ``problems`` lists what contradicts: ``assigned_differs``, ``total_differs``, ``assigned_exceeds_total``, ``mapped_exceeds_processed``.
    """
    reported = [c if c in libraries.columns else F.lit(None).cast("bigint").alias(c) for c in ("reported_assigned", "reported_total")]
    base = libraries.select("sample_id", "format", "mode", "universe", F.coalesce("unit", F.lit("unknown")).alias("count_unit"), *reported)
    genes = counts.groupBy("sample_id").agg(F.sum("n").alias("gene_count_sum"), F.count_if(F.col("n") > 0).alias("genes_detected"), F.count(F.lit(1)).alias("quantified_gene_count"))
    cats = categories.groupBy("sample_id").agg(
        F.sum("n").alias("__all"), F.count_if(F.col("category").startswith("Unassigned_")).alias("__unassigned"), F.sum(F.when(F.col("category") == "Assigned", F.col("n"))).alias("__assigned"),
        F.count_distinct(F.when(F.col("category").isin(*HTSEQ_COUNTERS), F.col("category"))).alias("__counters"),
    )
    mapped = F.lit(None).cast("bigint")
    df = base.join(genes, "sample_id", "left").na.fill(0, ["gene_count_sum", "genes_detected", "quantified_gene_count"]).join(cats, "sample_id", "left")
    if mapping is not None:
        df = df.join(mapping.select("sample_id", F.col("num_mapped").alias("__mapped"), F.col("num_processed").alias("__run")), "sample_id", "left")
    else:
        df = df.withColumns({"__mapped": mapped, "__run": mapped})

    tool = F.substring_index("format", "_", 1)
    exclusive = F.coalesce(F.col("mode") == "exclusive", F.lit(False))
    complete = F.coalesce(F.col("universe") == "full", F.lit(False)) | F.col("format").isin(*COMPLETE)
    htseq, feature = (tool == "htseq") & exclusive, (tool == "featurecounts") & F.col("__assigned").isNotNull()
    counters = F.coalesce(F.col("__counters") == len(HTSEQ_COUNTERS), F.lit(False))
    assigned = F.when(htseq, F.when(complete, F.col("gene_count_sum")).otherwise(F.col("reported_assigned"))).when(feature, F.col("__assigned"))
    told = F.coalesce(F.col("__unassigned") > 0, F.lit(False))
    df = df.withColumn("quant_tool", tool).withColumn("assigned_count", assigned.cast("bigint"))
    processed = F.when(htseq & counters, F.col("assigned_count") + F.col("__all")).when(feature & exclusive & told, F.col("__all"))
    lacking = F.concat_ws("; ", F.when(F.col("assigned_count").isNull(), REASONS["universe"]), F.when(~counters, REASONS["counters"]))
    why = F.when(htseq, lacking).when(feature, REASONS["summary"]).when(~exclusive, REASONS["shared"]).otherwise(REASONS["none"])
    df = df.withColumn("counting_processed_count", processed.cast("bigint"))
    total = F.col("counting_processed_count")
    why = F.when(total > 0, "").when(total == 0, REASONS["zero"]).otherwise(why)
    rate, known = ratio(F.col("assigned_count"), total), F.col("count_unit") != "unknown"
    ok = F.coalesce(total > 0, F.lit(False))
    word = lambda c: F.when(c, "ok").otherwise("unavailable")
    ran = F.col("__mapped").isNotNull() & F.col("__run").isNotNull()
    problem = lambda name, c: F.when(F.coalesce(c, F.lit(False)), F.lit(name))
    problems = F.array_compact(F.array(
        problem("assigned_differs", (htseq & complete & (F.col("reported_assigned") != F.col("gene_count_sum"))) | (feature & exclusive & complete & (F.col("__assigned") != F.col("gene_count_sum")))),
        problem("total_differs", htseq & (F.col("reported_total") != total)),
        problem("assigned_exceeds_total", F.col("assigned_count") > total),
        problem("mapped_exceeds_processed", F.col("__mapped") > F.col("__run")),
    ))
    detected = ratio(F.col("genes_detected"), F.col("quantified_gene_count"))
    return df.select(
        "sample_id", F.lit("library").alias("qc_level"), "quant_tool", F.col("mode").alias("assignment_mode"), F.col("universe").alias("gene_universe"), "count_unit",
        "gene_count_sum", "genes_detected", "quantified_gene_count",
        F.when(F.col("universe") == "full", detected).alias("genes_detected_pct"), detected.alias("supplied_gene_detection_pct"),
        "assigned_count", "counting_processed_count",
        F.when(known, rate).alias("assignment_rate_pct"), word(ok & known).alias("assignment_status"),
        F.concat_ws("; ", F.nullif(why, F.lit("")), F.when(~known, REASONS["unit"])).alias("assignment_reason"),
        rate.alias("assignment_counter_rate_pct"), word(ok).alias("assignment_counter_status"), F.concat_ws("; ", F.nullif(why, F.lit("")), F.when(ok & ~known, REASONS["unit"])).alias("assignment_counter_reason"),
        (F.col("assigned_count") == 0).alias("zero_assigned"), F.coalesce(total.isNotNull(), F.lit(False)).alias("composition_valid"),
        F.when(ran, F.col("__mapped")).cast("bigint").alias("mapping_numerator"), F.when(ran, F.col("__run")).cast("bigint").alias("mapping_denominator"),
        F.when(ran, ratio(F.col("__mapped"), F.col("__run"))).alias("mapping_rate_pct"), word(ran & (F.col("__run") > 0)).alias("mapping_status"),
        F.when(~ran, REASONS["mapping"]).when(F.col("__run") == 0, REASONS["zero"]).otherwise("").alias("mapping_reason"),
        problems.alias("problems"),
    )


def technical_aggregates(metrics: DataFrame, counts: DataFrame, members: DataFrame) -> DataFrame:
    """Rows of technical groups in the columns of ``library_metrics``, with ``qc_level`` ``technical_aggregate`` and ``constituent_sample_ids``.

    ``members(sample_id, merge_id[, ord])``. Genes are counted in the summed counts, not in the members; numerators and denominators are summed where all members have
    them, and rates divided after that, and only if the status of every member is ``ok``: the counter's rate also needs one known unit. ``problems``: ``units_differ``, and ``salmon_group``
    for estimates that cannot be summed.
    """
    order = F.struct(F.col("ord") if "ord" in members.columns else F.lit(0), F.col("sample_id"))
    joined = metrics.join(members, "sample_id")
    every = lambda c: F.count_if(~F.coalesce(c, F.lit(False))) == 0
    first = lambda c: F.min_by(c, order).alias(c)
    sums = ("assigned_count", "counting_processed_count", "mapping_numerator", "mapping_denominator")
    groups = joined.groupBy("merge_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_set(order)), lambda m: m["sample_id"]), "|").alias("constituent_sample_ids"),
        *[first(c) for c in ("quant_tool", "assignment_mode", "gene_universe", "count_unit")],
        *[sum_if_complete(F.col(c)).alias(c) for c in sums],
        every(F.col("assignment_status") == "ok").alias("__assigned"), every(F.col("mapping_status") == "ok").alias("__mapped"), every(F.col("assignment_counter_status") == "ok").alias("__counted"),
        every(F.col("composition_valid")).alias("composition_valid"),
        (F.count_distinct("count_unit") > 1).alias("__units"), (F.count_if(F.col("quant_tool") == "salmon") > 0).alias("__salmon"),
    )
    summed = counts.join(members.select("sample_id", "merge_id"), "sample_id").groupBy("merge_id", "gene_id").agg(F.sum("n").alias("n"))
    genes = summed.groupBy("merge_id").agg(F.sum("n").alias("gene_count_sum"), F.count_if(F.col("n") > 0).alias("genes_detected"), F.count(F.lit(1)).alias("quantified_gene_count"))
    df = groups.join(genes, "merge_id", "left")
    rate = ratio(F.col("assigned_count"), F.col("counting_processed_count"))
    detected = ratio(F.col("genes_detected"), F.col("quantified_gene_count"))
    given = {
        "assignment": (F.when(F.col("__assigned"), rate), "members"),
        "assignment_counter": (F.when(F.col("__counted") & ~F.col("__units") & (F.col("count_unit") != "unknown"), rate), "member units"),
        "mapping": (F.when(F.col("__mapped"), ratio(F.col("mapping_numerator"), F.col("mapping_denominator"))), "member mapping"),
    }
    for name, (value, reason) in given.items():
        df = df.withColumn(f"{name}_rate_pct", value).withColumn(f"{name}_status", F.when(F.col(f"{name}_rate_pct").isNotNull(), "ok").otherwise("unavailable"))
        df = df.withColumn(f"{name}_reason", F.when(F.col(f"{name}_rate_pct").isNotNull(), "").otherwise(REASONS[reason]))
    df = df.withColumns({
        "sample_id": F.col("merge_id"), "qc_level": F.lit("technical_aggregate"), "genes_detected_pct": F.when(F.col("gene_universe") == "full", detected), "supplied_gene_detection_pct": detected,
        "zero_assigned": F.col("assigned_count") == 0, "problems": F.array_compact(F.array(F.when(F.col("__units"), F.lit("units_differ")), F.when(F.col("__salmon"), F.lit("salmon_group")))),
    })
    return df.select(*metrics.columns, "constituent_sample_ids")


def metric_problems(metrics: DataFrame) -> DataFrame:
    """``rule, key`` of contradictions among metrics."""
    return metrics.select(F.explode("problems").alias("rule"), F.col("sample_id").alias("key"))
