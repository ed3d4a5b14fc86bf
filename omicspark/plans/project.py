"""Whole analyses: from control tables and count files to QC, matrices, contrasts and enrichment."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import counts, enrichment, explore, inference, library_qc, normalize, validate
from ..sources.scratch import kept


@dataclass
class Assay:
    """Counts of an assay with its QC; ``problems`` is empty if it may be modelled."""

    counts: DataFrame
    metrics: DataFrame
    groups: DataFrame
    problems: DataFrame
    status: dict[str, str] = field(default_factory=dict)


def import_assay(count_rows: DataFrame, counters: DataFrame, samples: DataFrame, inputs: DataFrame, libraries: DataFrame | None = None, mapping: DataFrame | None = None) -> Assay:
    """Check the control tables, compute QC before anything else, and merge technical replicates.

    ``samples(sample_id, input_id, source_sample_id, include_analysis, exclusion_reason, technical_merge_id,
    technical_partition_id, technical_disjoint, ...)``, ``inputs(input_id, path, count_mode, sha256)``. Count columns and
    samples must match one to one; QC is given even if the assay cannot be modelled. With ``libraries`` (``library_qc.library_metrics``) libraries may come from any counter, in any mode
    and universe, ``counters`` are its categories, and groups are rows of the same columns; without, they are exclusive counts of all genes with the five counters.
    """
    columns = count_rows.select("sample_id").distinct()
    listed = samples.select("sample_id")
    unmatched = columns.join(listed, "sample_id", "left_anti").unionByName(listed.join(columns, "sample_id", "left_anti"))
    blocked = counts.exactness(count_rows).where("blocked").select("sample_id")
    differing = counts.universe_differences(count_rows).where("n_missing > 0")
    problems = validate.union_all(
        [
            validate.input_contract(inputs, samples),
            validate.technical_members(samples, ["input_id"]),
            validate.violations(unmatched, "not_one_to_one", F.lit(True), F.col("sample_id")),
            validate.violations(blocked, "beyond_2_53", F.lit(True), F.col("sample_id")),
            validate.violations(differing, "gene_sets_differ", F.lit(True), F.col("sample_id"), F.col("n_missing")),
            validate.duplicates(count_rows, ["sample_id", "gene_id"], "duplicate_gene"),
        ]
    )
    members = samples.where("technical_merge_id IS NOT NULL").select("sample_id", F.col("technical_merge_id").alias("merge_id"))
    merged = counts.technical_merge(count_rows, members).withColumnRenamed("merge_id", "sample_id")
    if libraries is None:
        metrics = counts.htseq_metrics(count_rows, counters)
        groups = counts.technical_metrics(metrics, members, "gene_count_sum", "processed")
    else:
        metrics = library_qc.library_metrics(count_rows, counters, libraries, mapping)
        groups = library_qc.technical_aggregates(metrics, count_rows, members)
        told = library_qc.metric_problems(metrics).unionByName(library_qc.metric_problems(groups))
        problems = problems.unionByName(told.select("rule", "key", F.lit("").alias("detail")))
    return Assay(merged, metrics, groups, problems, {"qc": "ok"})


def analyse(
    assay_counts: DataFrame,
    samples: list[dict],
    factors: dict[str, str],
    contrasts: dict[str, dict[str, float]],
    sets: DataFrame | None = None,
    fdr_cut: float = 0.05,
    lfc_cut: float = 1.0,
) -> tuple[dict[str, DataFrame], list[tuple[str, str]]]:
    """Normalise, explore and test: tables by name, and the status of each stage.

    Genes pass the design's filter, libraries get TMM factors, expression is log CPM, and each contrast
    is tested and adjusted on its own: one that fails is reported and the others go on.
    """
    status: list[tuple[str, str]] = []
    ids, names, x = inference.design_matrix(samples, factors)
    passed = normalize.design_filter(assay_counts, float(inference.leverage(x).max())).select("gene_id")
    used = kept(assay_counts.join(passed, "gene_id", "left_semi"), "used")
    empty = [r["sample_id"] for r in normalize.zero_libraries(used).collect()]
    if empty:
        return {}, [("libraries", f"without counts: {empty}")]
    expr = kept(normalize.log_cpm(used, normalize.tmm_factors(used)), "logcpm")
    tables = {"logcpm": expr, "variable": explore.top_variable(expr), "distance": explore.sample_distance(expr)}
    tables["scores"], tables["variance"], tables["loadings"] = explore.pca(expr, tables["variable"])
    fitted = inference.fit(expr, ids, x)
    tables["incomplete"] = inference.incomplete_genes(expr, ids)
    for name, weights in contrasts.items():
        try:
            vector = inference.coefficient_contrast(names, weights)
            test = inference.contrast_test(fitted, x, vector).withColumn("contrast_id", F.lit(name))
            test = inference.benjamini_hochberg(test, ["contrast_id"])
            test = test.withColumn("Regulation", inference.regulation(F.col("FDR"), F.col("logFC"), fdr_cut, lfc_cut))
            tables[f"test:{name}"] = test
            if sets is not None:
                tables[f"sets:{name}"] = enrichment.over_representation(test, sets)
            status.append((name, "ok"))
        except ValueError as e:
            status.append((name, str(e)))
    if len(contrasts) > 1:
        rows = [inference.coefficient_contrast(names, w) for n, w in contrasts.items() if (n, "ok") in status]
        if len(rows) > 1:
            tables["omnibus"] = inference.omnibus_test(fitted, x, np.stack(rows))
    return tables, status
