"""Queries on libraries of several counters, modes and universes, each branch with rows of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import designs, library_qc, validate
from .plans.bindings import Tables
from .registry import query

#: Libraries by number mod 8: a complete counter; a filtered one without and with a reported number; one that shares reads; two feature counters; an unknown unit; an estimator.
FORMATS = ("htseq_raw", "htseq_matrix", "htseq_matrix", "htseq_raw", "featurecounts_raw", "featurecounts_matrix", "htseq_raw", "salmon")
MODES = ("exclusive", "exclusive", "exclusive", "shared", "exclusive", None, "exclusive", "estimated")
UNIVERSES = ("full", "unknown", "filtered", "full", "filtered", "full", "full", "full")
#: The same in SQL: counters as the format names them, sample S16 without one of its five, reported numbers that agree but for S10 and S18.
LIBRARIES_SQL = """+ lib AS (SELECT sample_id, number AS k, ['htseq_raw', 'htseq_matrix', 'htseq_matrix', 'htseq_raw', 'featurecounts_raw', 'featurecounts_matrix', 'htseq_raw', 'salmon'][number % 8 + 1] AS format,
      ['exclusive', 'exclusive', 'exclusive', 'shared', 'exclusive', NULL, 'exclusive', 'estimated'][number % 8 + 1] AS mode,
      ['full', 'unknown', 'filtered', 'full', 'filtered', 'full', 'full', 'full'][number % 8 + 1] AS universe, CASE WHEN number % 8 = 6 THEN 'unknown' ELSE 'fragment' END AS unit FROM samples),
    g AS (SELECT sample_id, CAST(sum(n) AS BIGINT) AS s, count(*) FILTER (n > 0) AS d, count(*) AS q FROM counts GROUP BY 1),
    rep AS (SELECT sample_id, CASE WHEN k % 8 = 2 THEN s + 5 WHEN k % 8 = 0 THEN s + (k = 8)::INT END AS reported FROM lib JOIN g USING (sample_id)),
    c AS (SELECT sample_id, k, CASE WHEN k % 8 IN (4, 5) THEN 'Unassigned_' || category ELSE category END AS category, n FROM counters JOIN lib USING (sample_id) WHERE category IS NOT NULL AND NOT (k = 16 AND category = 'ambiguous')
      UNION ALL SELECT sample_id, k, 'Assigned', s + (k = 12)::INT FROM g JOIN lib USING (sample_id) WHERE k % 8 IN (4, 5)),
    x AS (SELECT sample_id, CAST(sum(n) AS BIGINT) AS total, count(DISTINCT category) FILTER (category NOT LIKE 'Unassigned%' AND category <> 'Assigned') AS five, CAST(sum(n) FILTER (category = 'Assigned') AS BIGINT) AS assigned FROM c GROUP BY 1),
    a AS (SELECT lib.*, s, d, q, reported, total, five, CASE WHEN k % 8 IN (0, 3, 6) AND mode = 'exclusive' THEN s WHEN k % 8 IN (1, 2) THEN reported WHEN k % 8 IN (4, 5) THEN assigned END AS num FROM lib JOIN g USING (sample_id) LEFT JOIN rep USING (sample_id) LEFT JOIN x USING (sample_id)),
    m AS (SELECT *, CASE WHEN k % 8 IN (0, 1, 2, 6) AND five = 5 THEN num + total WHEN k % 8 = 4 THEN total END AS den FROM a)"""


def _libraries(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    k = F.col("number") % 8
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), (k + 1).cast("int"))
    s = t.counts().groupBy("sample_id").agg(F.sum("n").alias("s"))
    reported = F.when(k == 2, F.col("s") + 5).when(k == 0, F.col("s") + (F.col("number") == 8).cast("int"))
    lib = t.samples().join(s, "sample_id").select("sample_id", "number", "s", pick(FORMATS).alias("format"), pick(MODES).alias("mode"), pick(UNIVERSES).alias("universe"), F.when(k == 6, "unknown").otherwise("fragment").alias("unit"), reported.alias("reported_assigned"))
    feature = k.isin(4, 5)
    rows = t.counters().join(lib, "sample_id").where("category IS NOT NULL AND NOT (number = 16 AND category = 'ambiguous')")
    cats = rows.select("sample_id", F.when(feature, F.concat(F.lit("Unassigned_"), "category")).otherwise(F.col("category")).alias("category"), "n")
    cats = cats.unionByName(lib.where(feature).select("sample_id", F.lit("Assigned").alias("category"), (F.col("s") + (F.col("number") == 12).cast("int")).alias("n")))
    runs = lib.where(k == 7).select("sample_id", (F.col("s") * F.when(F.col("number") == 15, 0).otherwise(2)).alias("num_processed"), F.col("s").alias("num_mapped"))
    return t.counts(), cats, lib.drop("number", "s"), runs


@query(
    "library_metrics",
    LIBRARIES_SQL + """ SELECT sample_id, split_part(format, '_', 1) AS quant_tool, s AS gene_count_sum, d AS genes_detected, CASE WHEN universe = 'full' THEN 100.0 * d / q END AS genes_detected_pct, 100.0 * d / q AS supplied_gene_detection_pct,
    num AS assigned_count, den AS counting_processed_count, CASE WHEN den > 0 AND unit <> 'unknown' THEN 100.0 * num / den END AS assignment_rate_pct, CASE WHEN den > 0 AND unit <> 'unknown' THEN 'ok' ELSE 'unavailable' END AS assignment_status,
    CASE WHEN den > 0 THEN 100.0 * num / den END AS assignment_counter_rate_pct, CASE WHEN den > 0 THEN 'ok' ELSE 'unavailable' END AS assignment_counter_status, num = 0 AS zero_assigned, den IS NOT NULL AS composition_valid,
    CASE WHEN k % 8 = 7 AND k <> 15 THEN 50.0 END AS mapping_rate_pct, CASE WHEN k % 8 = 7 AND k <> 15 THEN 'ok' ELSE 'unavailable' END AS mapping_status FROM m""",
    "counts", "counters", "samples",
)
def _(t):
    hidden = ("qc_level", "assignment_mode", "gene_universe", "count_unit", "quantified_gene_count", "assignment_reason", "assignment_counter_reason", "mapping_numerator", "mapping_denominator", "mapping_reason", "problems")
    return library_qc.library_metrics(*_libraries(t)).drop(*hidden)


@query(
    "library_reasons",
    LIBRARIES_SQL + """ SELECT sample_id, concat_ws('; ', CASE WHEN den > 0 THEN NULL WHEN k % 8 IN (0, 1, 2, 6) THEN nullif(concat_ws('; ', CASE WHEN num IS NULL THEN 'gene universe not complete and no assigned number reported' END, CASE WHEN coalesce(five, 0) < 5 THEN 'not all five counters; missing is not zero' END), '')
      WHEN k % 8 IN (4, 5) THEN 'categories of the summary not known to exclude each other' ELSE 'reads may count for several genes: the sum is no number of assigned reads' END, CASE WHEN unit = 'unknown' THEN 'unit of counting unknown' END) AS assignment_reason,
    CASE WHEN k = 15 THEN 'denominator is zero' WHEN k % 8 = 7 THEN '' ELSE 'no mapping statistics' END AS mapping_reason FROM m""",
    "counts", "counters", "samples",
)
def _(t):
    return library_qc.library_metrics(*_libraries(t)).select("sample_id", "assignment_reason", "mapping_reason")


@query(
    "library_problems",
    "SELECT * FROM (VALUES ('assigned_differs', 'S8'), ('assigned_differs', 'S12'), ('mapped_exceeds_processed', 'S15')) x(rule, key)",
)
def _(t):
    return library_qc.metric_problems(library_qc.library_metrics(*_libraries(t)))


@query(
    "technical_aggregates",
    LIBRARIES_SQL + """, e AS (SELECT 'T' || (k // 16) || '_' || (k % 8) AS sample_id, m.sample_id AS member, m.* EXCLUDE (sample_id) FROM m WHERE k < 24),
    n AS (SELECT e.sample_id, gene_id, sum(counts.n) AS n FROM e JOIN counts ON counts.sample_id = member GROUP BY 1, 2), h AS (SELECT sample_id, CAST(sum(n) AS BIGINT) AS s, count(*) FILTER (n > 0) AS d, count(*) AS q FROM n GROUP BY 1),
    t AS (SELECT sample_id, string_agg(member, '|' ORDER BY k) AS ids, CASE WHEN count(num) = count(*) THEN CAST(sum(num) AS BIGINT) END AS num, CASE WHEN count(den) = count(*) THEN CAST(sum(den) AS BIGINT) END AS den,
      bool_and(coalesce(den > 0, false) AND unit <> 'unknown') AS ok, bool_and(coalesce(den > 0, false)) AS counted, min(unit) AS unit, bool_and(den IS NOT NULL) AS valid, min(universe) AS universe FROM e GROUP BY 1)
    SELECT sample_id, ids AS constituent_sample_ids, s AS gene_count_sum, d AS genes_detected, CASE WHEN universe = 'full' THEN 100.0 * d / q END AS genes_detected_pct, num AS assigned_count, den AS counting_processed_count,
      CASE WHEN ok THEN 100.0 * num / den END AS assignment_rate_pct, CASE WHEN ok THEN 'ok' ELSE 'unavailable' END AS assignment_status,
      CASE WHEN counted AND unit <> 'unknown' THEN 100.0 * num / den END AS assignment_counter_rate_pct, valid AS composition_valid, num = 0 AS zero_assigned FROM t JOIN h USING (sample_id)""",
    "counts", "counters", "samples",
)
def _(t):
    """Libraries of one kind and two numbers sixteen apart or less, in the order of their numbers."""
    counts, cats, lib, runs = _libraries(t)
    k = F.col("number")
    members = t.samples().where("number < 24").select("sample_id", F.concat(F.lit("T"), F.floor(k / 16).cast("string"), F.lit("_"), (k % 8).cast("string")).alias("merge_id"), k.alias("ord"))
    got = library_qc.technical_aggregates(library_qc.library_metrics(counts, cats, lib, runs), counts, members)
    return got.select("sample_id", "constituent_sample_ids", "gene_count_sum", "genes_detected", "genes_detected_pct", "assigned_count", "counting_processed_count", "assignment_rate_pct", "assignment_status", "assignment_counter_rate_pct", "composition_valid", "zero_assigned")


# Designs


#: Customers as samples of their nations' analyses: some numbers are spanned by the segment, some nations lack a level, a number or a unit's value, or repeat units.
DESIGN_SQL = """WITH s AS (SELECT c_nationkey AS analysis, c_custkey AS sample_id, CASE WHEN c_nationkey % 6 = 1 THEN 'BUILDING' WHEN c_nationkey % 6 = 2 AND c_mktsegment = 'BUILDING' THEN 'MACHINERY' ELSE c_mktsegment END AS segment,
      CASE WHEN c_nationkey % 5 = 0 THEN (c_mktsegment = 'MACHINERY')::INT * 2.0 + 1 WHEN c_nationkey % 5 = 3 AND c_custkey % 7 = 0 THEN NULL WHEN c_nationkey % 5 = 4 THEN 7.0 ELSE CAST(c_acctbal AS DOUBLE) END AS dose,
      CASE WHEN c_nationkey % 4 = 0 THEN c_custkey // 2 ELSE c_custkey END AS unit FROM customer)"""


def _designs(t: Tables) -> DataFrame:
    n, seg = F.col("c_nationkey"), F.col("c_mktsegment")
    dose = F.when(n % 5 == 0, (seg == "MACHINERY").cast("double") * 2 + 1).when((n % 5 == 3) & (F.col("c_custkey") % 7 == 0), None).when(n % 5 == 4, 7.0).otherwise(F.col("c_acctbal").cast("double"))
    segment = F.when(n % 6 == 1, "BUILDING").when((n % 6 == 2) & (seg == "BUILDING"), "MACHINERY").otherwise(seg)
    unit = F.when(n % 4 == 0, F.floor(F.col("c_custkey") / 2)).otherwise(F.col("c_custkey"))
    return t.read("customer").select(n.alias("analysis"), F.col("c_custkey").alias("sample_id"), segment.alias("segment"), dose.alias("dose"), unit.alias("unit"))


@query(
    "design_checks",
    DESIGN_SQL + """, p AS (SELECT analysis, count(*) AS n, count(DISTINCT unit) AS units, count(DISTINCT segment) AS levels, count(*) FILTER (segment = 'BUILDING') AS refs, count(*) - count(dose) AS gaps, max(dose) > min(dose) AS varies FROM s GROUP BY 1)
    SELECT 'missing' AS rule, CAST(analysis AS VARCHAR) AS key, 'dose' AS detail FROM p WHERE gaps > 0 UNION ALL SELECT 'not_finite', CAST(analysis AS VARCHAR), 'dose' FROM p WHERE gaps > 0
    UNION ALL SELECT 'not_varying', CAST(analysis AS VARCHAR), 'dose' FROM p WHERE NOT coalesce(varies, false) UNION ALL SELECT 'levels', CAST(analysis AS VARCHAR), 'segment' FROM p WHERE levels < 2
    UNION ALL SELECT 'reference', CAST(analysis AS VARCHAR), 'segment' FROM p WHERE refs = 0 UNION ALL SELECT 'repeated_units', CAST(analysis AS VARCHAR), '' FROM p WHERE units < n
    UNION ALL SELECT 'replication', CAST(analysis AS VARCHAR), segment FROM s GROUP BY analysis, segment HAVING count(DISTINCT unit) < 2
    UNION ALL SELECT 'rank', CAST(analysis AS VARCHAR), concat_ws('|', CASE WHEN refs = 0 THEN 'segment=MACHINERY' END, CASE WHEN (analysis % 5 = 0 AND analysis % 6 NOT IN (1, 2)) OR analysis % 5 = 4 THEN 'dose' END)
      FROM p WHERE refs = 0 OR (analysis % 5 = 0 AND analysis % 6 NOT IN (1, 2)) OR analysis % 5 = 4""",
)
def _(t):
    """Without the reference level, the last of the others is spanned by the intercept and the rest."""
    return designs.design_checks(_designs(t), "analysis", {"segment": "BUILDING"}, ["dose"], unit="unit")


@query("design_ranks", DESIGN_SQL + """, p AS (SELECT analysis, count(*) AS n, count(DISTINCT segment) - (count(*) FILTER (segment = 'BUILDING') > 0)::INT AS others, count(*) FILTER (segment = 'BUILDING') AS refs FROM s GROUP BY 1),
    q AS (SELECT analysis, n, 2 + others AS c, CAST(refs = 0 AS BIGINT) + CAST((analysis % 5 = 0 AND analysis % 6 NOT IN (1, 2)) OR analysis % 5 = 4 AS BIGINT) AS lost FROM p)
    SELECT analysis, n AS n_samples, c AS n_columns, c - lost AS rank, n - c + lost AS residual_df FROM q""")
def _(t):
    return designs.design_ranks(_designs(t), "analysis", {"segment": "BUILDING"}, ["dose"]).drop("aliased")


@query(
    "contrast_support",
    """WITH c AS (SELECT n_nationkey AS id, k, ['BUILDING', 'MACHINERY', 'NOWHERE'][k + 1] AS segment, CASE WHEN k = 0 AND n_nationkey % 3 = 0 THEN 0 ELSE 1 - k END AS weight FROM nation, range(3) r(k) WHERE k < 2 OR n_nationkey % 4 = 0),
    u AS (SELECT c.id, c.k, weight, count(DISTINCT c_custkey) AS units FROM c LEFT JOIN customer ON c_mktsegment = segment AND c_nationkey = id GROUP BY 1, 2, 3)
    SELECT 'empty_cell' AS rule, id || '|' || k AS key, '' AS detail FROM u WHERE units = 0 UNION ALL SELECT 'few_units', id || '|' || k, '' FROM u WHERE units = 1 AND weight <> 0""",
)
def _(t):
    n = F.col("n_nationkey")
    each = t.read("nation").select(n.alias("contrast_id"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("cell_id")).where("cell_id < 2 OR contrast_id % 4 = 0")
    k = F.col("cell_id")
    cells = each.select("contrast_id", "cell_id", F.when((k == 0) & (F.col("contrast_id") % 3 == 0), 0).otherwise(1 - k).alias("weight"), F.element_at(F.array(*map(F.lit, ("BUILDING", "MACHINERY", "NOWHERE"))), k + 1).alias("segment"), F.col("contrast_id").alias("country"))
    people = t.read("customer").select(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("country"), F.col("c_custkey").alias("unit"))
    return designs.contrast_support(people, cells, ["segment", "country"], unit="unit")


@query(
    "contract_of_nuisance",
    """WITH a AS (SELECT n_nationkey AS k, 'a' || n_nationkey AS id FROM nation)
    SELECT 'variables' AS rule, id AS key, '' AS detail FROM a WHERE k % 4 = 3 UNION ALL SELECT 'variable_name', id, '2nd batch' FROM a WHERE k % 5 = 2
    UNION ALL SELECT DISTINCT 'metadata_missing', 'a' || s_nationkey, v FROM supplier, (VALUES ('treatment'), ('donor'), ('2nd batch'), ('lane')) x(v)
      WHERE (v = 'donor' AND s_suppkey % 3 = 0) OR (v = '2nd batch' AND s_nationkey % 5 = 2) OR (v = 'lane' AND s_nationkey % 5 <> 2 AND s_suppkey % 7 = 0)""",
)
def _(t):
    """Suppliers as samples of their nations' analyses: a subject that some lack, a nuisance variable with a bad name, one that is empty for some."""
    k = F.col("n_nationkey")
    bad = k % 5 == 2
    analyses = t.read("nation").select(
        F.concat(F.lit("a"), k.cast("string")).alias("analysis_id"), F.lit("exploratory").alias("analysis_mode"), F.lit("paired").alias("design_type"), F.lit("qlf").alias("effect_test"), F.lit("0.05").alias("fdr_cut"), F.lit("1").alias("lfc_cut"),
        F.lit("1").alias("seed"), F.lit("treatment").alias("factor_cols"), F.lit("").alias("numeric_cols"), F.when(bad, "2nd batch").otherwise("lane").alias("nuisance_factor_cols"),
        F.when(k % 4 == 3, "treatment").otherwise("").alias("nuisance_numeric_cols"), F.lit("donor").alias("subject_col"),
    )
    s = F.col("s_suppkey")
    value = lambda name, v: F.struct(F.lit(name).alias("variable"), v.alias("value"))
    told = F.array(value("treatment", F.lit("x")), value("donor", F.when(s % 3 != 0, "d")), value("lane", F.when(s % 7 != 0, "l").otherwise(" ")))
    people = t.read("supplier").select(F.concat(F.lit("a"), F.col("s_nationkey").cast("string")).alias("analysis_id"), s.alias("sample_id"), F.explode(told).alias("m")).select("analysis_id", "sample_id", "m.*")
    return validate.analysis_contract(analyses, t.spark.createDataFrame([], "analysis_id string, contrast_id string, basis string, weight string"), people)
