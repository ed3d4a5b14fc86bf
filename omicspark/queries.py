"""Queries of the library over the driver's tables, with DuckDB SQL to hold them against."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .functions.columns import percent_map
from .operators import annotation, counts, enrichment, explore, features, haplotypes, inference, intervals, normalize, sequences, tables, validate
from .registry import query
from .sources import readers
from .sources.scratch import kept

SAMPLES = [f"S{i}" for i in range(25)]


# Counts


@query("sample_stats", "SELECT sample_id, CAST(sum(n) AS BIGINT) AS assigned, count(*) FILTER (n > 0) AS genes_detected FROM counts GROUP BY 1", "counts")
def _(t):
    return counts.sample_stats(t.counts())


@query("merge_counts", "PIVOT counts ON sample_id IN (" + ", ".join(f"'{s}'" for s in SAMPLES) + ") USING CAST(sum(n) AS BIGINT) GROUP BY gene_id", "counts")
def _(t):
    return counts.merge_counts(t.counts(), SAMPLES)


@query(
    "universe_diff",
    """SELECT sample_id, count(DISTINCT gene_id) AS n_genes, (SELECT count(DISTINCT gene_id) FROM counts) - count(DISTINCT gene_id) AS n_missing
    FROM counts GROUP BY 1""",
    "counts",
)
def _(t):
    return counts.universe_differences(t.counts())


@query(
    "tx_rollup_fallback",
    """SELECT sample_id, coalesce(gene_id, transcript_id) AS gene_id, sum(num_reads) AS num_reads, count(*) FILTER (gene_id IS NULL) AS n_fallback
    FROM quant LEFT JOIN tx_map USING (transcript_id) GROUP BY sample_id, coalesce(gene_id, transcript_id)""",
    "quant", "tx_map",
)
def _(t):
    return counts.roll_up(t.quant(), t.tx_map(), ["num_reads"])


@query(
    "strict_map_violations",
    """SELECT DISTINCT transcript_id, 'unmapped' AS rule FROM quant WHERE transcript_id NOT IN (SELECT transcript_id FROM tx_map)
    UNION ALL SELECT transcript_id, 'duplicate' FROM tx_map GROUP BY 1 HAVING count(*) > 1""",
    "quant", "tx_map",
)
def _(t):
    return counts.unmapped_transcripts(t.quant(), t.tx_map())


QC_SQL = """+ g AS (SELECT sample_id, CAST(sum(n) AS BIGINT) AS gene_count_sum, count(*) FILTER (n > 0) AS genes_detected, count(*) AS quantified_gene_count FROM counts GROUP BY 1),
    c AS (SELECT sample_id, CAST(sum(n) AS BIGINT) AS special, count(DISTINCT category) AS k FROM counters GROUP BY 1),
    m AS (SELECT g.*, CASE WHEN k = 5 THEN gene_count_sum + special END AS processed FROM g LEFT JOIN c USING (sample_id))"""


@query(
    "qc_metrics",
    QC_SQL + """ SELECT sample_id, gene_count_sum, genes_detected, quantified_gene_count, 100.0 * genes_detected / quantified_gene_count AS genes_detected_pct, processed,
    CASE WHEN processed > 0 THEN 100.0 * gene_count_sum / processed END AS counter_rate_pct,
    CASE WHEN processed > 0 THEN 'ok' ELSE 'unavailable' END AS counter_status FROM m""",
    "counts", "counters",
)
def _(t):
    cols = ["sample_id", "gene_count_sum", "genes_detected", "quantified_gene_count", "genes_detected_pct", "processed", "counter_rate_pct", "counter_status"]
    return counts.htseq_metrics(t.counts(), t.counters()).select(*cols)


@query(
    "headline_cards",
    QC_SQL + """ SELECT count(*) FILTER (gene_count_sum = 0) AS n_zero_assigned, count(*) FILTER (gene_count_sum = 0) AS n_zero_sum,
    count(*) FILTER (NOT coalesce(processed > 0, false) OR sample_id IN ('S3', 'S4')) AS n_unavailable, 0 AS n_tiny FROM m""",
    "counts", "counters",
)
def _(t):
    unit = F.when(F.col("sample_id").isin("S3", "S4"), "unknown").otherwise("fragment")
    return counts.headline_cards(counts.htseq_metrics(t.counts(), t.counters(), unit)).withColumn("n_tiny", F.col("n_tiny").cast("int"))


@query(
    "group_summary",
    """SELECT coalesce(treatment, '(missing)') AS treatment, batch, count(*) AS n_total, count(n) AS n_valid, count(*) - count(n) AS n_missing,
    count(*) FILTER (n = 0) AS n_zero, count(DISTINCT sample_id) AS n_units, CAST(min(n) AS DOUBLE) AS minimum, quantile_cont(n, 0.25) AS q1, quantile_cont(n, 0.5) AS median,
    quantile_cont(n, 0.75) AS q3, CAST(max(n) AS DOUBLE) AS maximum FROM counts JOIN samples USING (sample_id) GROUP BY 1, 2""",
    "counts", "samples",
)
def _(t):
    return counts.group_summary(t.counts().join(t.samples(), "sample_id"), ["treatment", "batch"], "n", "sample_id")


MEMBERS_SQL = "+ members AS (SELECT 'S' || number AS sample_id, 'T' || (number // 2) AS merge_id FROM samples WHERE number < 20)"


def _members(t):
    merge = F.concat(F.lit("T"), F.floor(F.col("number") / 2).cast("string"))
    return t.samples().where("number < 20").select("sample_id", merge.alias("merge_id"))


@query(
    "technical_merge",
    MEMBERS_SQL + " SELECT coalesce(merge_id, sample_id) AS merge_id, gene_id, CAST(sum(n) AS BIGINT) AS n FROM counts LEFT JOIN members USING (sample_id) GROUP BY 1, 2",
    "counts", "samples",
)
def _(t):
    return counts.technical_merge(t.counts(), _members(t))


@query(
    "technical_metrics",
    QC_SQL + """, members AS (SELECT 'S' || number AS sample_id, 'T' || (number // 2) AS merge_id FROM samples WHERE number < 20),
    x AS (SELECT m.sample_id, coalesce(merge_id, m.sample_id) AS merge_id, CASE WHEN m.sample_id = 'S5' THEN NULL ELSE gene_count_sum END AS num, processed FROM m LEFT JOIN members USING (sample_id)),
    s AS (SELECT merge_id, count(*) AS n_members, string_agg(sample_id, '|' ORDER BY sample_id) AS constituent_sample_ids,
      CASE WHEN count(num) = count(*) THEN CAST(sum(num) AS BIGINT) END AS numerator, CASE WHEN count(processed) = count(*) THEN CAST(sum(processed) AS BIGINT) END AS denominator FROM x GROUP BY 1)
    SELECT *, CASE WHEN denominator > 0 THEN 100.0 * numerator / denominator END AS rate_pct FROM s""",
    "counts", "counters", "samples",
)
def _(t):
    m = counts.htseq_metrics(t.counts(), t.counters()).withColumn("num", F.when(F.col("sample_id") != "S5", F.col("gene_count_sum")))
    return counts.technical_metrics(m, _members(t), "num", "processed")


@query(
    "technical_categories",
    MEMBERS_SQL + """, k AS (SELECT merge_id, count(*) AS m FROM members GROUP BY 1)
    SELECT merge_id, category, CASE WHEN count(DISTINCT sample_id) = max(m) THEN CAST(sum(n) AS BIGINT) END AS n
    FROM counters JOIN members USING (sample_id) JOIN k USING (merge_id) GROUP BY 1, 2""",
    "counters", "samples",
)
def _(t):
    return counts.merged_categories(t.counters(), _members(t))


@query(
    "scope_totals",
    """SELECT region, count(*) AS n_rows, CASE WHEN count(*) FILTER (sample_id = 'S7') = 0 THEN CAST(sum(n) AS BIGINT) END AS total
    FROM counts JOIN samples USING (sample_id) GROUP BY 1""",
    "counts", "samples",
)
def _(t):
    df = t.counts().join(t.samples(), "sample_id").withColumn("unit", F.when(F.col("sample_id") != "S7", "fragment"))
    return counts.scope_totals(df, ["region"], "n", "unit")


LIB_SQL = """+ lib AS (SELECT sample_id, CASE WHEN number % 3 = 0 THEN 'pine' WHEN number % 3 = 1 THEN 'fungus' ELSE 'bacterium' END AS organism0, number FROM samples),
    e AS (SELECT 'S' || (user_id % 25) AS sample_id, CASE event_id % 3 WHEN 0 THEN 'pine' WHEN 1 THEN 'fungus' ELSE 'bacterium' END AS organism,
      CAST(count(*) FILTER (event_type IN ('view', 'click')) AS BIGINT) AS assigned, CAST(count(*) FILTER (event_type = 'purchase') AS BIGINT) AS not_aligned, count(*) AS total FROM events GROUP BY 1, 2),
    p AS (SELECT sample_id, total AS input_pairs, total - not_aligned AS primary_aligned FROM e WHERE organism = 'pine')"""


def _libraries(t):
    organism = F.when(F.col("event_id") % 3 == 0, "pine").when(F.col("event_id") % 3 == 1, "fungus").otherwise("bacterium")
    sample = F.concat(F.lit("S"), (F.col("user_id") % 25).cast("string"))
    return t.read("events").groupBy(sample.alias("sample_id"), organism.alias("organism")).agg(
        F.count_if(F.col("event_type").isin("view", "click")).alias("assigned"), F.count_if(F.col("event_type") == "purchase").alias("not_aligned"), F.count(F.lit(1)).alias("total")
    )


@query(
    "composition",
    LIB_SQL + """ SELECT sample_id, organism, input_pairs, total - not_aligned AS aligned, round(100.0 * (total - not_aligned) / input_pairs, 4) AS aligned_pct,
    round(1e6 * assigned / input_pairs, 4) AS assigned_ppm, primary_aligned >= 100 AS qc_pass,
    CASE WHEN input_pairs IS NULL THEN 'NA' WHEN round(1e6 * assigned / input_pairs, 4) >= 400000 THEN 'high' ELSE 'low' END AS signal_group FROM e LEFT JOIN p USING (sample_id)""",
    "samples",
)
def _(t):
    return counts.composition(_libraries(t), "pine", 100, 400_000)


@query(
    "exposure_groups",
    LIB_SQL + """ SELECT f.sample_id, CASE WHEN treatment = 'control' THEN 'control' WHEN 1e6 * f.assigned / input_pairs >= 400000 THEN 'high' ELSE 'treated_low' END AS exposure_group,
    primary_aligned >= 110 AS qc_pass, primary_aligned >= 110 AND batch IN ('b0', 'b1') AS in_model,
    CASE WHEN primary_aligned < 110 THEN 'low_alignment' WHEN batch NOT IN ('b0', 'b1') THEN 'age_group' ELSE '' END AS exclusion_reason
    FROM e f JOIN p USING (sample_id) JOIN samples USING (sample_id) WHERE f.organism = 'fungus'""",
    "samples",
)
def _(t):
    lib = _libraries(t)
    pine = lib.where("organism = 'pine'").select("sample_id", F.col("total").alias("input_pairs"), (F.col("total") - F.col("not_aligned")).alias("primary_aligned"))
    fun = lib.where("organism = 'fungus'").join(pine, "sample_id").join(t.samples(), "sample_id")
    fun = fun.select("sample_id", "treatment", (1e6 * F.col("assigned") / F.col("input_pairs")).alias("ppm"), "primary_aligned", F.col("batch").alias("age_group"))
    return counts.exposure_groups(fun, "treatment", "control", 400_000, 110, ["b0", "b1"])


@query(
    "sample_membership",
    """SELECT 'S' || n_nationkey AS sample_id, n_nationkey % 4 <> 0 AND n_nationkey % 3 <> 2 AS selected,
    CASE WHEN n_nationkey % 4 = 0 THEN 'failed' WHEN n_nationkey % 3 = 2 THEN 'outside_sample_set' ELSE '' END AS reason FROM nation""",
)
def _(t):
    s = t.samples().select(
        "sample_id", (F.col("number") % 4 != 0).alias("include_analysis"), F.when(F.col("number") % 4 == 0, "failed").alias("exclusion_reason"),
        F.when(F.col("number") % 3 == 2, "late").otherwise("main|late").alias("sample_sets"),
    )
    return counts.membership(s, "main")


@query(
    "eligibility",
    """+ l AS (SELECT sample_id, sum(n) AS lib FROM counts GROUP BY 1), k AS (SELECT gene_id FROM counts JOIN l USING (sample_id) GROUP BY 1 HAVING count(*) FILTER (1e6 * n / lib >= 700) >= 2)
    SELECT sample_id, CAST(max(lib) AS BIGINT) AS library_sum, count(*) FILTER (n > 0) AS detected_genes, CAST(coalesce(sum(n) FILTER (gene_id IN (SELECT gene_id FROM k)), 0) AS BIGINT) AS retained_sum
    FROM counts JOIN l USING (sample_id) GROUP BY 1""",
    "counts",
)
def _(t):
    return counts.eligibility(t.counts(), least_cpm=700.0)


@query(
    "assay_compat",
    """SELECT c_mktsegment AS assay, field, count(DISTINCT value) AS n_values FROM (
      SELECT c_mktsegment, 'reference' AS field, CAST(c_nationkey AS VARCHAR) AS value FROM customer UNION ALL SELECT c_mktsegment, 'annotation', 'a1' FROM customer UNION ALL SELECT c_mktsegment, 'assignment_mode', 'exclusive' FROM customer
      UNION ALL SELECT c_mktsegment, 'gene_universe', CASE WHEN c_custkey % 2 = 0 THEN 'full' ELSE 'filtered' END FROM customer UNION ALL SELECT c_mktsegment, 'annotation_sha256', CASE WHEN c_mktsegment[1:1] < 'F' THEN md5(c_name) END FROM customer
      UNION ALL SELECT c_mktsegment, 'effective_nonunique', CASE WHEN c_acctbal < 0 THEN 'all' ELSE 'none' END FROM customer UNION ALL SELECT c_mktsegment, 'quant_tool', 'htseq' FROM customer) GROUP BY 1, 2 HAVING count(DISTINCT value) > 1""",
)
def _(t):
    fields = {
        "reference": F.col("c_nationkey"), "annotation": F.lit("a1"), "assignment_mode": F.lit("exclusive"), "gene_universe": F.when(F.col("c_custkey") % 2 == 0, "full").otherwise("filtered"),
        "annotation_sha256": F.when(F.substring("c_mktsegment", 1, 1) < "F", F.md5("c_name")), "effective_nonunique": F.when(F.col("c_acctbal") < 0, "all").otherwise("none"), "quant_tool": F.lit("htseq"),
    }
    return counts.assay_conflicts(t.read("customer").select(F.col("c_mktsegment").alias("assay"), *[c.alias(n) for n, c in fields.items()]), "assay", list(fields))


@query(
    "strand_mix",
    """SELECT string_agg(DISTINCT e, ',' ORDER BY e) AS directions, count(DISTINCT e) > 1 AS mixed FROM (SELECT CASE WHEN number % 2 = 0 THEN 'forward' ELSE 'reverse' END AS e FROM samples WHERE number % 3 <> 0)""",
    "samples",
)
def _(t):
    return counts.strand_mix(t.samples().where("number % 3 <> 0").select(F.when(F.col("number") % 2 == 0, "forward").otherwise("reverse").alias("effective")))


@query(
    "declared_or_called",
    """SELECT sample_id, CASE WHEN number % 3 = 0 THEN 'forward' WHEN number % 5 = 0 THEN 'reverse' ELSE 'unstranded' END AS effective,
    number % 3 = 0 AND number % 5 = 0 AS conflict FROM samples""",
    "samples",
)
def _(t):
    s = t.samples()
    declared = s.select("sample_id", F.when(F.col("number") % 3 == 0, "forward").otherwise("auto").alias("declared"))
    called = s.select("sample_id", F.when(F.col("number") % 5 == 0, "reverse").otherwise("ambiguous").alias("call"))
    return counts.declared_or_called(declared, called)


# Haplotypes

SPLIT_SQL = """+ h AS (SELECT sample_id, ha_gene_id, hb_gene_id, CAST(coalesce(sum(n) FILTER (gene_id = ha_gene_id), 0) AS BIGINT) AS ha, CAST(coalesce(sum(n) FILTER (gene_id = hb_gene_id), 0) AS BIGINT) AS hb
    FROM counts JOIN pairs ON gene_id = ha_gene_id OR gene_id = hb_gene_id GROUP BY 1, 2, 3)"""


@query("haplotype_summed", SPLIT_SQL + " SELECT sample_id, ha_gene_id || '|' || hb_gene_id AS pair_id, ha + hb AS n FROM h", "counts", "pairs")
def _(t):
    return haplotypes.split_by_haplotype(t.counts(), haplotypes.clean_pairs(t.pairs(), "ord"))[0]


@query(
    "haplotype_specific",
    SPLIT_SQL + """ SELECT sample_id, ha_gene_id || '|' || hb_gene_id AS pair_id, 'HA' AS haplotype, ha_gene_id AS gene_id, ha AS n FROM h
    UNION ALL SELECT sample_id, ha_gene_id || '|' || hb_gene_id, 'HB', hb_gene_id, hb FROM h""",
    "counts", "pairs",
)
def _(t):
    return haplotypes.split_by_haplotype(t.counts(), haplotypes.clean_pairs(t.pairs(), "ord"))[1]


@query(
    "haplotype_unpaired",
    "SELECT sample_id, gene_id, n FROM counts WHERE gene_id NOT IN (SELECT ha_gene_id FROM pairs UNION ALL SELECT hb_gene_id FROM pairs)",
    "counts", "pairs",
)
def _(t):
    return haplotypes.split_by_haplotype(t.counts(), haplotypes.clean_pairs(t.pairs(), "ord"))[2].select("sample_id", "gene_id", "n")


@query(
    "stem_pairs",
    """+ i AS (SELECT 'p' || (p_partkey // 2) || CASE WHEN p_partkey % 2 = 0 THEN 'A' ELSE 'B' END AS gene_id FROM part WHERE p_partkey % 7 <> 0)
    SELECT a.gene_id[:-2] AS stem, a.gene_id AS ha_gene_id, b.gene_id AS hb_gene_id FROM i a JOIN i b ON a.gene_id[:-2] = b.gene_id[:-2] AND a.gene_id[-1:] = 'A' AND b.gene_id[-1:] = 'B'""",
    "genes",
)
def _(t):
    side = F.when(F.col("p_partkey") % 2 == 0, "A").otherwise("B")
    ids = t.read("part").where("p_partkey % 7 <> 0").select(F.concat(F.lit("p"), F.floor(F.col("p_partkey") / 2).cast("string"), side).alias("gene_id"))
    return haplotypes.pair_by_stem(ids)


@query(
    "id_collisions",
    "SELECT seq_id, count(DISTINCT source) AS n_sources, count(*) AS n_rows FROM (SELECT p_brand AS source, p_name AS seq_id FROM part) GROUP BY 1 HAVING count(DISTINCT source) > 1",
)
def _(t):
    return sequences.shared_ids(t.read("part").select(F.col("p_brand").alias("source"), F.col("p_name").alias("seq_id")))


# Hits and products

BEST_SQL = """+ b AS (SELECT query_id, subject_id, pident, evalue, bitscore FROM hits WHERE pident >= 30 AND evalue <= 1e-5
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY bitscore DESC, l_orderkey, l_linenumber, subject_id) = 1)"""


def _best(t):
    return annotation.best_hit(t.hits(), order=["l_orderkey", "l_linenumber", "subject_id"])


@query("best_hit", BEST_SQL + " SELECT query_id, subject_id, bitscore, round(pident, 6) AS pident, round(evalue, 9) AS evalue FROM b", "hits")
def _(t):
    return _best(t).select("query_id", "subject_id", "bitscore", F.round("pident", 6).alias("pident"), F.round("evalue", 9).alias("evalue"))


@query(
    "hit_annotation",
    BEST_SQL + " SELECT query_id, CAST(subject_id AS VARCHAR) AS subject_id, coalesce(s_name, CAST(subject_id AS VARCHAR)) AS description FROM b LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 3 <> 0) ON s_suppkey = subject_id",
    "hits",
)
def _(t):
    best = _best(t).select("query_id", F.col("subject_id").cast("string").alias("subject_id"))
    heads = t.read("supplier").where("s_suppkey % 3 <> 0").select(F.col("s_suppkey").cast("string").alias("accession"), F.col("s_name").alias("description"))
    return annotation.describe_hits(best, heads)


LADDER_SQL = """WITH d AS (SELECT doc_id AS protein_id, lang, source, CASE WHEN length(trim(text, ' ')) = 0 THEN '' ELSE split_part(trim(text, ' '), ' ', 1) END AS w FROM documents),
    f AS (SELECT protein_id, CASE WHEN protein_id % 17 = 0 THEN 'kinase ' || source END AS p FROM d WHERE protein_id % 11 = 0 OR protein_id % 17 = 0),
    s AS (SELECT protein_id, CASE WHEN lower(trim(coalesce(w, ''), ' ')) NOT IN ('', '-', 'n/a', 'na', 'unknown', 'unnamed protein product', 'uncharacterized protein', 'hypothetical protein') THEN trim(w, ' ') END AS p
      FROM d WHERE protein_id % 3 = 0 AND protein_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
    e AS (SELECT protein_id, CASE WHEN lang <> 'en' THEN 'domain ' || lang END AS p FROM d WHERE protein_id % 4 = 1),
    c AS (SELECT protein_id FROM d WHERE protein_id % 9 = 2), i AS (SELECT protein_id, source AS p FROM d WHERE protein_id % 5 = 2),
    r AS (SELECT d.protein_id, coalesce(f.p, s.p, e.p, i.p, 'hypothetical protein') AS product,
      CASE WHEN f.p IS NOT NULL THEN 'funannotate2' WHEN s.p IS NOT NULL THEN 'swissprot' WHEN e.p IS NOT NULL THEN 'eggnog' WHEN i.p IS NOT NULL THEN 'interpro' ELSE 'none' END AS product_source,
      concat_ws(',', CASE WHEN f.p IS NOT NULL THEN 'funannotate2' END, CASE WHEN s.p IS NOT NULL THEN 'swissprot' END, CASE WHEN e.protein_id IS NOT NULL THEN 'eggnog' END,
        CASE WHEN c.protein_id IS NOT NULL THEN 'dbcan' END, CASE WHEN i.p IS NOT NULL THEN 'interpro' END) AS evidence
      FROM d LEFT JOIN f USING (protein_id) LEFT JOIN s USING (protein_id) LEFT JOIN e USING (protein_id) LEFT JOIN c USING (protein_id) LEFT JOIN i USING (protein_id))"""


@query("product_ladder", LADDER_SQL + " SELECT *, CASE WHEN evidence = '' THEN 0 ELSE len(string_split(evidence, ',')) END AS n_evidence FROM r")
def _(t):
    return annotation.product_table(t.proteins(), t.evidence())


@query("evidence_tags", LADDER_SQL + " SELECT tag, count(*) AS n FROM (SELECT unnest(string_split(evidence, ',')) AS tag FROM r) WHERE tag <> '' GROUP BY 1")
def _(t):
    return annotation.evidence_tags(annotation.product_table(t.proteins(), t.evidence()))


@query(
    "hypothetical_qc",
    LADDER_SQL + """ SELECT product_source, count(*) AS n, round(count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM r), 4) AS fraction,
    product_source = 'none' AND round(count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM r), 4) > 0.3 AS flagged FROM r GROUP BY 1""",
)
def _(t):
    return annotation.product_quality(annotation.product_table(t.proteins(), t.evidence()), 0.3)


@query(
    "secretome_vote",
    """WITH v AS (SELECT l_partkey AS protein_id, count(*) FILTER (l_returnflag = 'R') AS votes, max(CASE WHEN l_linenumber = 7 AND l_quantity > 40 THEN 1 ELSE 0 END) AS n_tm FROM lineitem GROUP BY 1)
    SELECT p_partkey AS protein_id, coalesce(votes, 0) AS votes, coalesce(n_tm, 0) AS n_tm, coalesce(votes, 0) >= 2 AND coalesce(n_tm, 0) = 0 AS secreted FROM part LEFT JOIN v ON p_partkey = protein_id""",
)
def _(t):
    li = t.read("lineitem")
    votes = li.select(F.col("l_partkey").alias("protein_id"), F.lit("tool").alias("tool"), F.when(F.col("l_returnflag") == "R", "SP+TM").otherwise("OTHER").alias("call"))
    tm = li.select(F.col("l_partkey").alias("protein_id"), F.when((F.col("l_linenumber") == 7) & (F.col("l_quantity") > 40), 1).otherwise(0).alias("n_tm"))
    return annotation.secretome(t.read("part").select(F.col("p_partkey").alias("protein_id")), votes, tm, tools_run=3)


@query(
    "localization",
    """SELECT p_partkey AS protein_id, CASE WHEN p_size % 3 = 0 THEN p_type ELSE '-' END AS compartment, p_size > 25 AS secreted,
    CASE WHEN p_size > 25 AND p_partkey % 4 = 0 THEN 'effector' ELSE '-' END AS effector FROM part""",
)
def _(t):
    p = t.read("part").withColumnRenamed("p_partkey", "protein_id")
    return annotation.localization(
        p, p.select("protein_id", (F.col("p_size") > 25).alias("secreted")), p.where("protein_id % 4 = 0"), p.where("p_size % 3 = 0").select("protein_id", F.col("p_type").alias("compartment"))
    )


@query(
    "family_sets",
    """SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter([split_part(p_brand, '#', 1) || p_size, p_type, 'GH' || p_size], lambda x: x NOT IN ('', '-')))), ';') AS families FROM part""",
)
def _(t):
    a = F.concat(F.split_part("p_brand", F.lit("#"), F.lit(1)), F.col("p_size").cast("string"), F.lit("(1-20)"))
    b = F.concat("p_type", F.lit("+x"))
    return t.read("part").select("p_partkey", annotation.family_set(a, b, F.concat(F.lit("GH"), F.col("p_size").cast("string")), F.lit("-")).alias("families"))


@query(
    "go_explode",
    "SELECT DISTINCT 'g' || o_custkey AS gene_id, 'GO:' || (o_orderkey % 50) AS go_id FROM orders UNION SELECT DISTINCT 'g' || o_custkey, 'GO:' || o_orderpriority[1] FROM orders",
)
def _(t):
    gos = F.concat_ws(",", F.concat(F.lit("GO:"), (F.col("o_orderkey") % 50).cast("string")), F.lit("-"), F.concat(F.lit("GO:"), F.substring("o_orderpriority", 1, 1)))
    return annotation.go_terms(t.read("orders").select(F.concat(F.lit("g"), F.col("o_custkey").cast("string")).alias("gene_id"), gos.alias("gos")))


@query(
    "gene_labels",
    "SELECT DISTINCT 'g' || p_partkey AS gene_id, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE substr(p_name || ' of the type ' || p_type || ' and more', 1, 40) END AS label FROM part",
)
def _(t):
    rows = t.read("part").select(
        F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("gene_id"), F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise("-").alias("preferred_name"),
        F.concat("p_name", F.lit(" of the type "), "p_type", F.lit(" and more")).alias("description"),
    )
    return annotation.gene_labels(rows)


# Intervals

INSIDE = 'EXISTS (SELECT 1 FROM genes g WHERE g.chrom = s.chrom AND s.pos BETWEEN g."start" AND g."end")'


@query("snp_in_gene", f"SELECT event_id, chrom, pos FROM snps s WHERE {INSIDE}", "snps", "genes")
def _(t):
    return intervals.points_in(t.snps(), t.genes(), ["chrom"], "pos", 2000).select("event_id", "chrom", "pos")


@query(
    "phased_sites",
    f"SELECT chrom, pos, ref, alt, '0|1' AS gt FROM snps s WHERE ref <> 'N' AND alt <> 'N' AND {INSIDE}",
    "snps", "genes",
)
def _(t):
    return intervals.phased_sites(t.snps(), t.genes(), 2000)


@query(
    "genes_in_block",
    """SELECT block_id, gene_id, g.chrom, g."start", g."end" FROM blocks b JOIN genes g ON g.chrom = b.chrom AND g."start" >= b."start" AND g."end" <= b."end" """,
    "blocks", "genes",
)
def _(t):
    return intervals.genes_in_blocks(t.genes(), t.blocks(), 5000)


PAIR_SQL = """+ a AS (SELECT block_id, gene_id AS ha_gene_id, row_number() OVER (PARTITION BY block_id ORDER BY g.chrom, g."start", g."end", gene_id) AS rank, count(*) OVER (PARTITION BY block_id) AS n
      FROM blocks b JOIN genes g ON g.chrom = b.chrom AND g."start" >= b."start" AND g."end" <= b."end"),
    c AS (SELECT block_id, gene_id AS hb_gene_id, row_number() OVER (PARTITION BY block_id ORDER BY CASE WHEN inverted THEN -g."start" ELSE g."start" END, CASE WHEN inverted THEN 0 ELSE g."end" END, gene_id) AS rank, count(*) OVER (PARTITION BY block_id) AS n
      FROM blocks b JOIN genes g ON g.chrom = (b.chrom + 1) % 7 AND g."start" >= b."start" AND g."end" <= b."end")"""


def _two_sided(t):
    """Blocks with their bounds on the second side too: the next chromosome, the same places."""
    return t.blocks().select("*", ((F.col("chrom") + 1) % 7).alias("b_chrom"), F.col("start").alias("b_start"), F.col("end").alias("b_end"))


@query("block_pairing", PAIR_SQL + " SELECT block_id, rank, ha_gene_id, hb_gene_id FROM a JOIN c USING (block_id, rank) WHERE a.n = c.n", "blocks", "genes")
def _(t):
    pairs = intervals.pairs_of_spans(t.genes(), t.genes(), _two_sided(t), 5000)
    return intervals.pairs_of_blocks(pairs, _two_sided(t)).withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "allele_table",
    PAIR_SQL + """, p AS (SELECT DISTINCT ha_gene_id, hb_gene_id FROM a JOIN c USING (block_id, rank) WHERE a.n = c.n)
    SELECT ha_gene_id, hb_gene_id FROM p UNION ALL SELECT gene_id, NULL FROM genes WHERE chrom < 3 AND gene_id NOT IN (SELECT ha_gene_id FROM p)
    UNION ALL SELECT NULL, gene_id FROM genes WHERE chrom >= 3 AND gene_id NOT IN (SELECT hb_gene_id FROM p)""",
    "blocks", "genes",
)
def _(t):
    p = kept(intervals.pairs_of_spans(t.genes(), t.genes(), _two_sided(t), 5000).select("ha_gene_id", "hb_gene_id").distinct(), "paired")
    return intervals.allele_table(p, t.genes().where("chrom < 3"), t.genes().where("chrom >= 3"))


@query(
    "feature_counting",
    """+ u AS (SELECT *, CASE WHEN NOT mapped THEN '__not_aligned' WHEN nh > 1 THEN '__alignment_not_unique' WHEN mapq < 10 THEN '__too_low_aQual' END AS status FROM alignments),
    h AS (SELECT read_id, count(DISTINCT gene_id) AS k, min(gene_id) AS g FROM (SELECT u.read_id, g.gene_id FROM u JOIN genes g ON g.chrom = u.chrom AND g.strand = u.strand AND u."start" <= g."end" AND g."start" <= u."end" WHERE status IS NULL) GROUP BY 1)
    SELECT category, count(*) AS n FROM (SELECT CASE WHEN k IS NULL THEN '__no_feature' WHEN k > 1 THEN '__ambiguous' ELSE g END AS category FROM u LEFT JOIN h USING (read_id) WHERE status IS NULL
      UNION ALL SELECT status FROM u WHERE status IS NOT NULL) GROUP BY 1""",
    "alignments", "genes",
)
def _(t):
    return intervals.count_features(t.alignments(), t.genes(), 2000)


SITES = "+ sites AS (SELECT DISTINCT chrom, pos, ref, alt FROM snps WHERE ref <> 'N' AND alt <> 'N')"


@query(
    "read_routing",
    SITES + """ SELECT read_id, CASE WHEN EXISTS (SELECT 1 FROM sites s WHERE s.chrom = a.chrom AND s.pos BETWEEN a."start" AND a."end") THEN 'to_remap' ELSE 'keep' END AS route FROM alignments a""",
    "alignments", "snps",
)
def _(t):
    return intervals.split_by_snps(t.alignments(), intervals.phased_sites(t.snps()).distinct(), 500)


SEQ_SQL = SITES + """, q AS (SELECT *, repeat('ACGT', 13) AS seq, repeat('I?#', 18) AS qual FROM alignments WHERE mapq >= 20),
    x AS (SELECT q.chrom, pos, ref, alt, seq[CAST(pos - "start" + 1 AS INT)] AS base, ascii(qual[CAST(pos - "start" + 1 AS INT)]) - 33 AS bq
      FROM q JOIN sites s ON s.chrom = q.chrom AND pos BETWEEN "start" AND "end"),
    y AS (SELECT chrom, pos, ref, alt, count(*) FILTER (base = ref) AS a_count, count(*) FILTER (base = alt) AS b_count, count(*) FILTER (base IN (ref, alt)) AS total_count FROM x WHERE bq >= 10 GROUP BY 1, 2, 3, 4)"""


def _allele_counts(t):
    reads = t.alignments().withColumn("seq", F.repeat(F.lit("ACGT"), F.lit(13))).withColumn("qual", F.repeat(F.lit("I?#"), F.lit(18)))
    return intervals.allele_counts(reads, intervals.phased_sites(t.snps()).distinct(), 500)


@query("haplotype_counts", SEQ_SQL + " SELECT * FROM y", "alignments", "snps")
def _(t):
    return _allele_counts(t)


@query(
    "gene_ae",
    SEQ_SQL + """ SELECT gene_id, CAST(sum(a_count) AS BIGINT) AS a_count, CAST(sum(b_count) AS BIGINT) AS b_count, CAST(sum(total_count) AS BIGINT) AS total_count
    FROM y JOIN genes g ON g.chrom = y.chrom AND pos BETWEEN "start" AND "end" GROUP BY 1""",
    "alignments", "snps", "genes",
)
def _(t):
    return intervals.gene_allele_counts(_allele_counts(t), t.genes(), 2000)


@query(
    "allele_swap",
    SITES + """, q AS (SELECT *, repeat('ACGT', 13) AS seq FROM alignments)
    SELECT read_id, pos, seq[1:CAST(pos - "start" AS INT)] || CASE WHEN seq[CAST(pos - "start" + 1 AS INT)] = ref THEN alt ELSE ref END || seq[CAST(pos - "start" + 2 AS INT):] AS seq
    FROM q JOIN sites s ON s.chrom = q.chrom AND pos BETWEEN "start" AND "end" WHERE pos - "start" + 1 <= 52""",
    "alignments", "snps",
)
def _(t):
    reads = t.alignments().withColumn("seq", F.repeat(F.lit("ACGT"), F.lit(13)))
    return intervals.swapped_reads(reads, intervals.phased_sites(t.snps()).distinct(), 500).select("read_id", "pos", "seq")


@query(
    "same_place",
    """SELECT read_id, nh AS mate, chrom, "start" AS pos0, '50M' AS cigar FROM alignments WHERE mapq % 3 <> 0""",
    "alignments",
)
def _(t):
    before = t.alignments().select("read_id", F.col("nh").alias("mate"), "chrom", F.col("start").alias("pos0"), F.lit("50M").alias("cigar"), "mapq")
    after = before.withColumn("pos0", F.when(F.col("mapq") % 3 == 0, F.col("pos0") + 1).otherwise(F.col("pos0")))
    return intervals.same_place(before, after).drop("mapq")


# Features

ATTR_SQL = """WITH f AS (SELECT 'gene' AS type, 'ID' AS a, CAST(o_orderkey AS VARCHAR) AS v FROM orders UNION ALL SELECT 'gene', 'Name', o_orderpriority FROM orders WHERE o_orderkey % 5 <> 0
    UNION ALL SELECT 'exon', 'ID', l_orderkey || ':' || l_partkey FROM lineitem UNION ALL SELECT 'exon', 'Parent', CAST(l_orderkey AS VARCHAR) FROM lineitem),
    n AS (SELECT 'gene' AS type, count(*) AS n_rows FROM orders UNION ALL SELECT 'exon', count(*) FROM lineitem),
    c AS (SELECT type, a AS attribute, n_rows, count(*) AS n_with, count(DISTINCT v) AS n_values FROM f JOIN n USING (type) GROUP BY 1, 2, 3)"""


def _features(t):
    from .functions.columns import gff_pairs, last_pairs

    k = lambda c: F.col(c).cast("string")
    name = F.when(F.col("o_orderkey") % 5 != 0, F.concat(F.lit(";Name="), "o_orderpriority")).otherwise("")
    genes = t.read("orders").select(F.lit("gene").alias("type"), F.concat(F.lit("ID="), k("o_orderkey"), name).alias("text"))
    exon = F.concat(F.lit('ID "'), k("l_orderkey"), F.lit(":"), k("l_partkey"), F.lit('"; Parent "'), k("l_orderkey"), F.lit('";'))
    exons = t.read("lineitem").select(F.lit("exon").alias("type"), exon.alias("text"))
    return genes.unionByName(exons).select("type", last_pairs(gff_pairs(F.col("text"))).alias("attrs"))


@query("attr_coverage", ATTR_SQL + " SELECT * FROM c")
def _(t):
    return features.attribute_coverage(_features(t))


@query("choose_attribute", ATTR_SQL + " SELECT 'exon' AS type, n_rows, attribute, n_values AS n_groups FROM c WHERE type = 'exon' AND attribute = 'ID'")
def _(t):
    return features.choose_feature_and_attribute(features.attribute_coverage(_features(t)))


@query(
    "resolve_parent",
    """SELECT 'l' || l_orderkey || ':' || l_partkey || ':' || l_suppkey AS id, 'c' || o_custkey AS gene_id, 2 AS depth FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey % 10 <> 0
    UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey, 1 FROM orders WHERE o_custkey % 10 <> 0 UNION ALL SELECT 'c' || c_custkey, 'c' || c_custkey, 0 FROM customer WHERE c_custkey % 10 <> 0""",
)
def _(t):
    tag = lambda p, c: F.concat(F.lit(p), *[x for k, n in enumerate(c) for x in ([F.lit(":")] * (k > 0) + [F.col(n).cast("string")])])
    kind = F.when(F.col("c_custkey") % 10 != 0, "gene").otherwise("region")
    nodes = t.read("customer").select(tag("c", ["c_custkey"]).alias("id"), kind.alias("type"), F.lit(None).cast("string").alias("gene_id"))
    up = t.read("orders").select(tag("o", ["o_orderkey"]).alias("id"), tag("c", ["o_custkey"]).alias("parent"), F.lit(0).alias("ord"))
    exons = t.read("lineitem").select(tag("l", ["l_orderkey", "l_partkey", "l_suppkey"]).alias("id"), tag("o", ["l_orderkey"]).alias("parent"), F.lit(0).alias("ord"))
    return features.resolve_genes(nodes, up.unionByName(exons))


@query(
    "resolve_ordered_parents",
    """WITH o AS (SELECT 'o' || o_orderkey AS id, CASE WHEN o_custkey % 10 <> 0 THEN 'c' || o_custkey WHEN o_orderkey % 3 = 0 THEN 'c1' END AS gene_id, CAST(1 AS INTEGER) AS depth FROM orders),
    l AS (SELECT DISTINCT 'l' || l_orderkey || ':' || l_partkey || ':' || l_suppkey AS id, coalesce(o.gene_id, CASE WHEN l_partkey % 2 = 0 THEN 'c2' END) AS gene_id, CASE WHEN o.gene_id IS NULL THEN 1 ELSE 2 END AS depth
          FROM lineitem JOIN o ON o.id = 'o' || l_orderkey)
    SELECT 'c' || c_custkey AS id, 'c' || c_custkey AS gene_id, 0 AS depth FROM customer WHERE c_custkey % 10 <> 0
    UNION ALL SELECT * FROM o WHERE gene_id IS NOT NULL UNION ALL SELECT * FROM l WHERE gene_id IS NOT NULL
    UNION ALL SELECT 's' || s_suppkey, 'c1', s_suppkey FROM supplier WHERE s_suppkey > 0 UNION ALL SELECT 'n' || n_nationkey, 'c1', (32 - n_nationkey) % 25 + 1 FROM nation""",
)
def _(t):
    """Parents in written order: orders of lost customers take a second parent or fail, lines ask their order before a nearer gene, suppliers are a chain as long as their number, nations a ring with one way out."""
    name = lambda p, *c: F.concat(F.lit(p), *[x for k, n in enumerate(c) for x in ([F.lit(":")] * (k > 0) + [F.col(n).cast("string")])])
    up = lambda rows, id_, parent, ord_=0: rows.select(id_.alias("id"), parent.alias("parent"), F.lit(ord_).alias("ord"))
    kind = F.when(F.col("c_custkey") % 10 != 0, "gene").otherwise("region")
    nodes = t.read("customer").select(name("c", "c_custkey").alias("id"), kind.alias("type"), F.lit(None).cast("string").alias("gene_id"))
    o, li, n = t.read("orders"), t.read("lineitem"), t.read("nation")
    line = name("l", "l_orderkey", "l_partkey", "l_suppkey")
    supplier = t.read("supplier").withColumn("before", F.col("s_suppkey") - 1)
    edges = [
        up(o, name("o", "o_orderkey"), name("c", "o_custkey")), up(o.where("o_orderkey % 3 = 0"), name("o", "o_orderkey"), F.lit("c1"), 1),
        up(li, line, F.lit("nowhere")), up(li, line, name("o", "l_orderkey"), 1), up(li.where("l_partkey % 2 = 0"), line, F.lit("c2"), 2),
        up(supplier.where("before > 0"), name("s", "s_suppkey"), name("s", "before")), up(supplier.where("before = 0"), F.lit("s1"), F.lit("c1")),
        up(n, name("n", "n_nationkey"), F.concat(F.lit("n"), ((F.col("n_nationkey") + 1) % 25).cast("string"))), up(n.where("n_nationkey = 7"), F.lit("n7"), F.lit("c1"), 1),
    ]
    return features.resolve_genes(nodes, reduce(DataFrame.unionByName, edges))


# Sequences


@query(
    "genome_stats",
    """SELECT source, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS total_bp, count(*) AS contigs, CAST(max(length(coalesce(text, ''))) AS BIGINT) AS max_contig_bp,
    round(sum(length(regexp_replace(coalesce(text, ''), '[^Nn]', '', 'g'))) / sum(length(coalesce(text, ''))), 9) AS n_fraction,
    round(sum(length(regexp_replace(coalesce(text, ''), '[^a-z]', '', 'g'))) / sum(length(coalesce(text, ''))), 9) AS softmask_fraction FROM documents GROUP BY 1""",
)
def _(t):
    seqs = t.proteins().select("source", F.col("protein_id").alias("ord"), F.coalesce("text", F.lit("")).alias("sequence"))
    out = sequences.genome_stats(seqs, ["source"])
    return out.select("source", "total_bp", "contigs", "max_contig_bp", F.round("n_fraction", 9).alias("n_fraction"), F.round("softmask_fraction", 9).alias("softmask_fraction"))


@query(
    "size_class",
    """SELECT o_orderkey, CASE WHEN bp <= 10000000 THEN 'tiny' WHEN bp <= 500000000 THEN 'small' WHEN bp <= 2000000000 THEN 'medium' WHEN bp <= 5000000000 THEN 'large' ELSE 'huge' END AS size_class,
    CASE WHEN bp > 536870912 THEN 'csi' ELSE 'both' END AS index_kind,
    CASE WHEN l AND r THEN 'dual' WHEN l THEN 'isoseq' WHEN r AND p THEN 'etp' WHEN r THEN 'et' WHEN p THEN 'ep' ELSE 'es' END AS evidence
    FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) * (o_orderkey % 20000) AS bp, o_orderkey % 2 = 0 AS r, o_orderkey % 3 = 0 AS p, o_orderkey % 5 = 0 AS l FROM orders)""",
)
def _(t):
    k = F.col("o_orderkey")
    bp = F.floor(F.col("o_totalprice")).cast("bigint") * (k % 20000)
    return t.read("orders").select(
        "o_orderkey", sequences.size_class(bp).alias("size_class"), sequences.index_kind(bp).alias("index_kind"), sequences.evidence_mode(k % 2 == 0, k % 3 == 0, k % 5 == 0).alias("evidence")
    )


@query(
    "strandedness_call",
    """SELECT sample_id, agree, disagree, CASE WHEN agree + disagree < 20 THEN 'undetermined' WHEN f >= 0.85 THEN 'forward' WHEN f <= 0.15 THEN 'reverse' WHEN f BETWEEN 0.4 AND 0.6 THEN 'unstranded' ELSE 'ambiguous' END AS call
    FROM (SELECT s_nationkey AS sample_id, count(*) FILTER (l_linenumber % 7 <> 0 AND ((l_returnflag = 'R') = (l_linestatus = 'F'))) AS agree,
      count(*) FILTER (l_linenumber % 7 <> 0 AND ((l_returnflag = 'R') <> (l_linestatus = 'F'))) AS disagree, agree / (agree + disagree) AS f FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1)""",
)
def _(t):
    minus = F.when(F.col("l_returnflag") == "R", F.array(F.lit("-"))).otherwise(F.array(F.lit("+")))
    strands = F.when(F.col("l_linenumber") % 7 == 0, F.array(F.lit("+"), F.lit("-"))).otherwise(minus)
    ev = t.read("lineitem").join(t.read("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("s_nationkey").alias("sample_id"), (F.col("l_linestatus") == "F").alias("reverse"), strands.alias("strands"), F.lit(0).alias("noncanonical")
    )
    return sequences.strandedness(ev, 20).select("sample_id", "agree", "disagree", "call")


@query(
    "splice_motifs",
    """WITH c AS (SELECT o_orderkey AS k, o_custkey % 7 AS chrom, (o_orderkey * 13) % 9000 AS p, o_orderkey % 2 = 1 AS reverse FROM orders), m AS (SELECT *,
      substr('GTAGCATC', CAST((p + 20) % 8 AS INT) + 1, 1) || substr('GTAGCATC', CAST((p + 21) % 8 AS INT) + 1, 1) AS d, substr('GTAGCATC', CAST((p + 54) % 8 AS INT) + 1, 1) || substr('GTAGCATC', CAST((p + 55) % 8 AS INT) + 1, 1) AS a FROM c)
    SELECT k AS read_id, CASE WHEN d || '-' || a IN ('GT-AG', 'GC-AG', 'AT-AC') THEN '+' WHEN d || '-' || a IN ('CT-AC', 'CT-GC', 'GT-AT') THEN '-' ELSE '' END AS strand, reverse FROM m""",
)
def _(t):
    k = F.col("o_orderkey")
    al = t.read("orders").select(F.lit("s").alias("sample_id"), k.alias("read_id"), F.when(k % 2 == 1, 16).otherwise(0).alias("flag"), (F.col("o_custkey") % 7).alias("chrom"), ((k * 13) % 9000).alias("pos0"), F.lit("20M36N30M").alias("cigar"))
    spots = t.read("orders").select((F.col("o_custkey") % 7).alias("chrom")).distinct()
    numbered = spots.select("chrom", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("chunk_no"))
    chunks = numbered.select("chrom", F.col("chunk_no").cast("bigint").alias("chunk_no"), F.substring(F.repeat(F.lit("GTAGCATC"), F.lit(126)), 1, 1001).alias("chunk"))
    ev = sequences.splice_evidence(al, chunks, 1000)
    return ev.select("read_id", F.coalesce(F.get("strands", F.lit(0)), F.lit("")).alias("strand"), "reverse")


@query(
    "flag_counts",
    """SELECT library, count(*) AS total, count(*) FILTER (flag & 4 = 0) AS mapped, count(*) FILTER (flag & 256 <> 0) AS secondary, count(*) FILTER (flag & 2048 <> 0) AS supplementary, count(*) FILTER (flag & 1024 <> 0) AS duplicates,
    count(*) FILTER (flag & 1 <> 0) AS paired, count(*) FILTER (flag & 2 <> 0) AS proper, count(*) FILTER (flag & 64 <> 0) AS read1, count(*) FILTER (flag & 128 <> 0) AS read2 FROM alignments GROUP BY 1""",
    "alignments",
)
def _(t):
    return sequences.flag_counts(t.alignments(), ["library"])


@query("chromosome_counts", "SELECT chrom, count(*) FILTER (flag & 4 = 0) AS mapped, count(*) FILTER (flag & 4 <> 0) AS unmapped FROM alignments GROUP BY 1", "alignments")
def _(t):
    return sequences.chromosome_counts(t.alignments())


@query(
    "read_qc",
    """SELECT mate, count(*) AS reads, CAST(sum(length(seq)) AS BIGINT) AS bases, round(sum(length(seq)) / count(*), 6) AS mean_length,
    round(sum(length(regexp_replace(seq, '[^GCgc]', '', 'g'))) / sum(length(seq)), 9) AS gc_fraction FROM reads GROUP BY 1""",
    "reads",
)
def _(t):
    out = sequences.read_qc(t.reads(), ["mate"])
    return out.select("mate", "reads", "bases", F.round("mean_length", 6).alias("mean_length"), F.round("gc_fraction", 9).alias("gc_fraction"))


@query(
    "quality_by_cycle",
    "SELECT mate, CAST(i AS INT) AS \"cycle\", round(avg(unicode(c) - 33), 6) AS mean_quality, count(*) AS n FROM (SELECT mate, unnest(range(0, length(seq))) AS i, unnest(string_split(seq, '')) AS c FROM reads WHERE seq <> '') GROUP BY 1, 2",
    "reads",
)
def _(t):
    out = sequences.quality_by_cycle(t.reads().withColumn("qual", F.col("seq")), ["mate"])
    return out.withColumn("mean_quality", F.round("mean_quality", 6))


@query("long_reads", "SELECT read_id, mate, length(seq) AS bases FROM reads QUALIFY min(length(seq)) OVER (PARTITION BY read_id) >= 200", "reads")
def _(t):
    return sequences.long_enough(t.reads(), 200).select("read_id", "mate", F.char_length("seq").cast("bigint").alias("bases"))


@query("subsample_head", "SELECT read_id, mate FROM reads QUALIFY row_number() OVER (PARTITION BY mate ORDER BY conv_id, turn) <= 100", "reads")
def _(t):
    return sequences.first_reads(t.reads(), 100, ["mate"], ["conv_id", "turn"]).select("read_id", "mate")


# Validation


@query("dup_violations", "SELECT 'duplicate' AS rule, p_name AS key, CAST(count(*) AS VARCHAR) AS detail FROM part GROUP BY p_name HAVING count(*) > 1")
def _(t):
    return validate.duplicates(t.read("part"), ["p_name"])


@query(
    "numeric_violations",
    """SELECT * FROM (SELECT CASE WHEN l_orderkey % 97 = 0 THEN 'not_a_number' WHEN l_orderkey % 89 = 0 THEN 'negative' WHEN l_orderkey % 83 = 0 THEN 'not_integer' END AS rule,
    l_orderkey || ':' || l_partkey || ':' || l_suppkey AS key, CASE WHEN l_orderkey % 97 = 0 THEN 'x' WHEN l_orderkey % 89 = 0 THEN '-1' WHEN l_orderkey % 83 = 0 THEN '1.5' ELSE '7' END AS detail FROM lineitem) WHERE rule IS NOT NULL""",
)
def _(t):
    k = F.col("l_orderkey")
    value = F.when(k % 97 == 0, "x").when(k % 89 == 0, "-1").when(k % 83 == 0, "1.5").otherwise("7")
    df = t.read("lineitem").select(F.concat_ws(":", k.cast("string"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("key"), value.alias("v"))
    return validate.bad_numbers(df, "key", "v", True)


@query("key_violations", "SELECT 'unknown_customer' AS rule, CAST(o_custkey AS VARCHAR) AS key, '' AS detail FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0)")
def _(t):
    return validate.foreign_key(t.read("orders"), "o_custkey", t.read("customer").where("c_custkey % 3 <> 0"), "c_custkey", "unknown_customer")


@query(
    "manifest_rules",
    """WITH s AS (SELECT o_orderkey AS k, 's' || (o_orderkey % 5000) AS id, o_orderkey FROM orders)
    SELECT 'pe_without_mate' AS rule, id AS key, '' AS detail FROM s WHERE k % 7 = 0 AND k % 3 <> 0 UNION ALL SELECT 'se_with_mate', id, '' FROM s WHERE k % 7 = 1 AND k % 3 = 0
    UNION ALL SELECT 'read_type', id, 'pacbio' FROM s WHERE k % 19 = 0 UNION ALL SELECT 'use_for', id, 'count;maps' FROM s WHERE k % 23 = 0
    UNION ALL SELECT 'strandedness', id, 'sideways' FROM s WHERE k % 11 = 0 UNION ALL SELECT 'bam_or_fastq', id, '' FROM s WHERE k % 13 = 0
    UNION ALL SELECT 'duplicate_sample', id, CAST(min(k) AS VARCHAR) FROM s GROUP BY id HAVING count(*) > 1""",
)
def _(t):
    k = F.col("o_orderkey")
    sheet = t.read("orders").select(
        k.alias("line"), F.concat(F.lit("s"), (k % 5000).cast("string")).alias("sample_id"), F.when(k % 7 == 0, "PE").when(k % 7 == 1, "SE").otherwise("").alias("layout"),
        F.lit("a_R1.fastq.gz").alias("fastq_1"), F.when(k % 3 == 0, "a_R2.fastq.gz").otherwise("-").alias("fastq_2"),
        F.when(k % 11 == 0, "sideways").otherwise("auto").alias("strandedness"), F.when(k % 13 == 0, "a.bam").otherwise("NA").alias("bam"),
        F.when(k % 19 == 0, "pacbio").otherwise("Short").alias("read_type"), F.when(k % 23 == 0, "count;maps").otherwise("all").alias("use_for"),
    )
    return validate.sheet_rules(sheet)


@query(
    "mate_inference",
    """SELECT 'f' || p_partkey || CASE p_partkey % 4 WHEN 0 THEN '_R1' WHEN 1 THEN '_1' WHEN 2 THEN '_fwd' ELSE '_R1_001' END || '.fastq.gz' AS path,
    'f' || p_partkey || CASE p_partkey % 4 WHEN 0 THEN '_R2' WHEN 1 THEN '_2' WHEN 2 THEN '_rev' ELSE '_R2_001' END || '.fastq.gz' AS mate, CASE p_partkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 5 ELSE 0 END AS rule
    FROM part WHERE p_size % 5 <> 0""",
)
def _(t):
    k = F.col("p_partkey")
    pick = lambda names: F.when(k % 4 == 0, names[0]).when(k % 4 == 1, names[1]).when(k % 4 == 2, names[2]).otherwise(names[3])
    path = lambda names: F.concat(F.lit("f"), k.cast("string"), pick(names), F.lit(".fastq.gz"))
    files = t.read("part").select(path(["_R1", "_1", "_fwd", "_R1_001"]).alias("path"))
    listing = t.read("part").select(path(["_R2", "_2", "_rev", "_R2_001"]).alias("path"), (F.col("p_size") % 5).alias("size"))
    return validate.inferred_mates(files, listing)


@query(
    "input_contract",
    """SELECT 'count_mode' AS rule, CAST(s_suppkey AS VARCHAR) AS key, 'odd' AS detail FROM supplier WHERE s_suppkey % 10 = 0
    UNION ALL SELECT 'sha256', CAST(s_suppkey AS VARCHAR), 'xyz' FROM supplier WHERE s_suppkey % 7 = 0
    UNION ALL SELECT 'exclusion_reason', CAST(c_custkey AS VARCHAR), '' FROM customer WHERE c_custkey % 9 = 0
    UNION ALL SELECT 'unknown_input', CAST(c_custkey % 130 AS VARCHAR), '' FROM customer WHERE c_custkey % 130 NOT IN (SELECT s_suppkey FROM supplier)""",
)
def _(t):
    inputs = t.read("supplier").select(
        F.col("s_suppkey").cast("string").alias("input_id"), F.lit("x.tsv").alias("path"), F.when(F.col("s_suppkey") % 10 == 0, "odd").otherwise("exclusive").alias("count_mode"), F.when(F.col("s_suppkey") % 7 == 0, "xyz").alias("sha256")
    )
    samples = t.read("customer").select(
        F.col("c_custkey").cast("string").alias("sample_id"), (F.col("c_custkey") % 130).cast("string").alias("input_id"), F.col("c_custkey").cast("string").alias("source_sample_id"),
        F.when(F.col("c_custkey") % 9 == 0, "false").otherwise("true").alias("include_analysis"), F.lit(None).cast("string").alias("exclusion_reason"),
    )
    return validate.input_contract(inputs, samples)


@query(
    "technical_rules",
    """WITH s AS (SELECT c_custkey AS k, 'm' || (c_custkey // 2) AS m FROM customer WHERE c_custkey % 3 <> 2)
    SELECT 'partitions' AS rule, m AS key, '' AS detail FROM s GROUP BY m HAVING count(*) > count(DISTINCT k % 4)
    UNION ALL SELECT 'disjoint', m, '' FROM s GROUP BY m HAVING count(*) FILTER (k % 50 = 0) > 0
    UNION ALL SELECT 'differs:segment', m, '' FROM (SELECT m, c_mktsegment AS g FROM s JOIN customer ON k = c_custkey) GROUP BY m HAVING count(DISTINCT g) > 1""",
)
def _(t):
    k = F.col("c_custkey")
    s = t.read("customer").select(
        k.cast("string").alias("sample_id"), F.when(k % 3 != 2, F.concat(F.lit("m"), F.floor(k / 2).cast("string"))).alias("technical_merge_id"),
        (k % 4).alias("technical_partition_id"), F.when(k % 50 == 0, "false").otherwise("true").alias("technical_disjoint"), F.col("c_mktsegment").alias("segment"),
    )
    return validate.technical_members(s, ["segment"])


@query(
    "metric_consistency",
    QC_SQL + """ SELECT 'assigned_differs' AS rule, sample_id AS key, '' AS detail FROM m WHERE sample_id IN ('S1', 'S2') UNION ALL SELECT 'total_differs', sample_id, '' FROM m WHERE sample_id = 'S3'""",
    "counts", "counters",
)
def _(t):
    m = counts.htseq_metrics(t.counts(), t.counters()).withColumn("assigned", F.col("gene_count_sum"))
    m = m.withColumn("reported_assigned", F.when(F.col("sample_id").isin("S1", "S2"), F.col("assigned") + 1).otherwise(F.col("assigned")))
    m = m.withColumn("reported_total", F.when(F.col("sample_id") == "S3", F.col("processed") - 1))
    return validate.statistics_consistency(m)


@query(
    "use_routing",
    "SELECT o_orderkey FROM orders WHERE o_orderkey % 4 IN (0, 1)",
)
def _(t):
    use = F.when(F.col("o_orderkey") % 4 == 0, "count;braker").when(F.col("o_orderkey") % 4 == 1, "ALL").otherwise("stringtie")
    return validate.selected_uses(t.read("orders").select("o_orderkey", use.alias("use_for")), "count").select("o_orderkey")


# Normalisation and exploration

DENSE_SQL = """+ lib AS (SELECT sample_id, sum(n) AS library FROM counts GROUP BY 1)"""


@query("cpm_filter", DENSE_SQL + " SELECT gene_id, count(*) FILTER (n * 1e6 / library >= 900) AS n_pass FROM counts JOIN lib USING (sample_id) GROUP BY 1 HAVING count(*) FILTER (n * 1e6 / library >= 900) >= 2", "counts")
def _(t):
    return normalize.exploratory_filter(t.counts(), 25, 900.0)


@query(
    "expr_filter",
    DENSE_SQL + """, cut AS (SELECT 10 / median(library) * 1e6 AS c FROM lib) SELECT gene_id, count(*) FILTER (n * 1e6 / library >= c) AS n_pass, CAST(sum(n) AS BIGINT) AS total
    FROM counts JOIN lib USING (sample_id), cut GROUP BY 1 HAVING count(*) FILTER (n * 1e6 / library >= c) >= 10.7 - 1e-14 AND sum(n) >= 15""",
    "counts",
)
def _(t):
    return normalize.design_filter(t.counts(), 1 / 11)


TMM_SQL = """+ t AS (SELECT gene_id FROM counts GROUP BY 1 HAVING sum(n) > 0), r0 AS (SELECT c.*, library FROM counts c SEMI JOIN t USING (gene_id) JOIN (SELECT sample_id, sum(n) AS library FROM counts GROUP BY 1) USING (sample_id)),
    q AS (SELECT sample_id, quantile_cont(n, 0.75) / max(library) AS f FROM r0 GROUP BY 1), ref AS (SELECT sample_id AS rid FROM q ORDER BY round(abs(f - (SELECT avg(f) FROM q)), 12), sample_id LIMIT 1),
    b AS (SELECT gene_id, n AS r, library AS rl FROM r0 WHERE sample_id = (SELECT rid FROM ref)),
    ma AS (SELECT sample_id, gene_id, log2((n / library) / (r / rl)) AS m, (log2(n / library) + log2(r / rl)) / 2 AS a, 1 / ((library - n) / (library * n) + (rl - r) / (rl * r)) AS w FROM r0 JOIN b USING (gene_id) WHERE n > 0 AND r > 0),
    k AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY round(m, 10), gene_id) AS rm, row_number() OVER (PARTITION BY sample_id ORDER BY round(a, 10), gene_id) AS ra, count(*) OVER (PARTITION BY sample_id) AS g FROM ma),
    f AS (SELECT sample_id, 2 ** (sum(w * m) / sum(w)) AS raw FROM k WHERE rm > floor(g * 0.3) AND rm <= g - floor(g * 0.3) AND ra > floor(g * 0.05) AND ra <= g - floor(g * 0.05) GROUP BY 1),
    tmm AS (SELECT sample_id, CAST((SELECT sum(n) FROM counts c WHERE c.sample_id = f.sample_id) AS DOUBLE) AS library, raw / (SELECT exp(avg(ln(raw))) FROM f) AS factor FROM f)"""


@query("tmm_factors", TMM_SQL + " SELECT sample_id, CAST(library AS BIGINT) AS library, round(factor, 8) AS tmm_factor FROM tmm", "counts")
def _(t):
    return normalize.tmm_factors(kept(t.counts(), "counts")).withColumn("tmm_factor", F.round("tmm_factor", 8))


LOGCPM_SQL = TMM_SQL + """, eff AS (SELECT sample_id, library * factor AS e FROM tmm), lc AS (SELECT c.sample_id, c.gene_id,
    log2((n + 2 * e / (SELECT avg(e) FROM eff)) / (e + 4 * e / (SELECT avg(e) FROM eff)) * 1e6) AS logcpm FROM counts c JOIN eff USING (sample_id))"""


def _log_cpm(t):
    c = kept(t.counts(), "counts")
    return normalize.log_cpm(c, normalize.tmm_factors(c))


@query("log_cpm", LOGCPM_SQL + " SELECT sample_id, gene_id, round(logcpm, 6) AS logcpm FROM lc", "counts")
def _(t):
    return _log_cpm(t).withColumn("logcpm", F.round("logcpm", 6))


@query("top_variable", LOGCPM_SQL + " SELECT gene_id, round(v, 6) AS variance FROM (SELECT gene_id, var_samp(logcpm) AS v FROM lc GROUP BY 1) WHERE v IS NOT NULL ORDER BY round(v, 10) DESC, gene_id LIMIT 500", "counts")
def _(t):
    return explore.top_variable(_log_cpm(t), 500).withColumn("variance", F.round("variance", 6))


@query(
    "row_zscore",
    LOGCPM_SQL + """ SELECT sample_id, gene_id, round((logcpm - mu) / sd, 5) AS z FROM (SELECT *, avg(logcpm) OVER (PARTITION BY gene_id) AS mu, stddev_samp(logcpm) OVER (PARTITION BY gene_id) AS sd FROM lc) WHERE sd > 0""",
    "counts",
)
def _(t):
    return explore.row_zscores(_log_cpm(t)).withColumn("z", F.round("z", 5))


LEN_SQL = """+ len AS (SELECT 'S' || s_nationkey AS sample_id, 'g' || l_partkey AS gene_id, CASE WHEN sum(l_quantity) > 0 THEN sum(l_extendedprice * l_quantity) / sum(l_quantity) ELSE avg(l_extendedprice) END AS length, sum(l_quantity) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
    rel AS (SELECT *, length / exp(avg(ln(length)) OVER (PARTITION BY gene_id)) AS rel FROM len), counts AS (SELECT sample_id, gene_id, n / rel AS n FROM rel),"""


@query(
    "length_offsets",
    LEN_SQL + TMM_SQL.removeprefix("+") + " SELECT r.sample_id, r.gene_id, round(ln(rel * library * factor), 6) AS \"offset\" FROM rel r JOIN tmm USING (sample_id)",
    "tx_map",
)
def _(t):
    li = t.read("lineitem").join(t.read("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    quant = li.select(
        F.concat(F.lit("S"), F.col("s_nationkey").cast("string")).alias("sample_id"), F.col("l_partkey").alias("transcript_id"), F.col("l_extendedprice").alias("eff_length"), F.col("l_quantity").alias("tpm"), F.col("l_quantity").alias("num_reads")
    )
    gene_map = t.read("part").select(F.col("p_partkey").alias("transcript_id"), F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("gene_id"))
    return normalize.length_offsets(kept(normalize.gene_lengths(quant, gene_map), "lengths")).withColumn("offset", F.round("offset", 6))


PAIRS_SQL = "+ x AS (SELECT * FROM expression WHERE sample_id % 10 = 0), d AS (SELECT a.sample_id AS s1, b.sample_id AS s2, a.gene_id, (a.logcpm - b.logcpm) ** 2 AS d2 FROM x a JOIN x b USING (gene_id) WHERE a.sample_id < b.sample_id)"


@query(
    "sample_distance",
    DENSE_SQL + """, x AS (SELECT sample_id, gene_id, log2(n + 1) AS v FROM counts) SELECT a.sample_id AS s1, b.sample_id AS s2, round(sqrt(sum((a.v - b.v) ** 2)), 6) AS distance
    FROM x a JOIN x b USING (gene_id) WHERE a.sample_id < b.sample_id GROUP BY 1, 2""",
    "counts",
)
def _(t):
    expr = t.counts().withColumn("logcpm", F.log2(F.col("n") + 1))
    return explore.sample_distance(expr).withColumn("distance", F.round("distance", 6))


LEAD_SQL = """+ x AS (SELECT sample_id, gene_id, log2(n + 1) AS v FROM counts), d AS (SELECT a.sample_id AS s1, b.sample_id AS s2, (a.v - b.v) ** 2 AS d2, row_number() OVER (PARTITION BY a.sample_id, b.sample_id ORDER BY round((a.v - b.v) ** 2, 10) DESC, gene_id) AS r
    FROM x a JOIN x b USING (gene_id) WHERE a.sample_id < b.sample_id)"""


@query("mds_distance", LEAD_SQL + " SELECT s1, s2, round(sqrt(avg(d2)), 6) AS distance FROM d WHERE r <= 500 GROUP BY 1, 2", "counts")
def _(t):
    expr = t.counts().withColumn("logcpm", F.log2(F.col("n") + 1))
    return explore.leading_distance(expr, 500).withColumn("distance", F.round("distance", 6))


@query("mds_points")
def _(t):
    expr = t.counts().withColumn("logcpm", F.log2(F.col("n") + 1))
    return explore.mds(explore.leading_distance(expr, 500)).withColumn("coordinate", F.round("coordinate", 6))


def _pca(t):
    expr = kept(_log_cpm(t), "logcpm")
    return explore.pca(expr, explore.top_variable(expr, 500))


@query("pca_variance")
def _(t):
    return _pca(t)[1].withColumn("variance_fraction", F.round("variance_fraction", 6))


@query("pca_scores")
def _(t):
    return _pca(t)[0].withColumn("score", F.round("score", 5))


@query(
    "sample_gram",
    DENSE_SQL + """, x AS (SELECT sample_id, gene_id, log2(n + 1) - avg(log2(n + 1)) OVER (PARTITION BY gene_id) AS v FROM counts)
    SELECT a.sample_id AS s1, b.sample_id AS s2, round(sum(a.v * b.v), 4) AS g FROM x a JOIN x b USING (gene_id) WHERE a.sample_id <= b.sample_id GROUP BY 1, 2""",
    "counts",
)
def _(t):
    """What the principal components are taken from."""
    expr = t.counts().withColumn("v", F.log2(F.col("n") + 1))
    centred = expr.withColumn("v", F.col("v") - F.avg("v").over(Window.partitionBy("gene_id")))
    return explore.gram_matrix(centred).withColumn("g", F.round("g", 4))


# Inference and enrichment


def _dense(t):
    """log2 counts of all samples for the genes that the design's filter keeps (groups of ten)."""
    c = kept(t.dense_counts(), "dense")
    genes = normalize.design_filter(c, 1 / 10).select("gene_id")
    return c.join(genes, "gene_id", "left_semi").select("sample_id", "gene_id", F.log2(F.col("n") + 1).alias("logcpm"))


DENSE_Y = """+ dl AS (SELECT sample_id, sum(n) AS lib FROM dense GROUP BY 1), cut AS (SELECT 10 / median(lib) * 1e6 AS c FROM dl),
    few AS (SELECT gene_id FROM dense JOIN dl USING (sample_id), cut GROUP BY 1 HAVING count(*) FILTER (n * 1e6 / lib >= c) >= 10 - 1e-14 AND sum(n) >= 15),
    y AS (SELECT gene_id, sample_id, treatment, batch, CASE WHEN treatment = 'treated' THEN 1 ELSE 0 END AS x, log2(n + 1) AS v FROM dense JOIN few USING (gene_id) JOIN samples USING (sample_id))"""
#: The effect of one factor beside another by residuals: of both its indicator and the values, less the means of the other's levels.
EFFECT_SQL = DENSE_Y + """, w AS (SELECT gene_id, treatment, v, x - avg(x) OVER (PARTITION BY gene_id, batch) AS r, v - avg(v) OVER (PARTITION BY gene_id, batch) AS e, v - avg(v) OVER (PARTITION BY gene_id, treatment) AS e0 FROM y),
    g AS (SELECT gene_id, sum(r * e) / sum(r * r) AS lfc, sum(r * r) AS srr, sum(e * e) - sum(r * e) ** 2 / sum(r * r) AS rss, sum(e0 * e0) AS rss0 FROM w GROUP BY 1)"""


def _design(t):
    rows = [{**r.asDict()} for r in t.samples().orderBy("sample_id").collect()]
    return inference.design_matrix(rows, {"treatment": "control", "batch": "b0"})


def _tested(t):
    ids, names, x = _design(t)
    fitted = inference.fit(_dense(t), ids, x)
    return names, x, fitted


def _contrast(t):
    names, x, fitted = _tested(t)
    out = inference.contrast_test(fitted, x, inference.coefficient_contrast(names, {"factor:treatment:treated": 1.0}))
    out = inference.benjamini_hochberg(out.withColumn("contrast_id", F.lit("treated")), ["contrast_id"])
    return out.withColumn("Regulation", inference.regulation(F.col("FDR"), F.col("logFC"), 0.9, 0.3))


@query(
    "group_effect",
    DENSE_Y + """ SELECT gene_id, round(avg(v) FILTER (treatment = 'treated') - avg(v) FILTER (treatment = 'control'), 6) AS "logFC",
    round((avg(v) FILTER (treatment = 'treated') - avg(v) FILTER (treatment = 'control')) / sqrt((var_samp(v) FILTER (treatment = 'treated') * (count(*) FILTER (treatment = 'treated') - 1) + var_samp(v) FILTER (treatment = 'control') * (count(*) FILTER (treatment = 'control') - 1)) / 23.0
      * (1.0 / count(*) FILTER (treatment = 'treated') + 1.0 / count(*) FILTER (treatment = 'control'))), 5) AS statistic FROM y GROUP BY 1""",
    "counts", "samples", "dense",
)
def _(t):
    rows = [r.asDict() for r in t.samples().orderBy("sample_id").collect()]
    ids, names, x = inference.design_matrix(rows, {"treatment": "control"})
    out = inference.contrast_test(inference.fit(_dense(t), ids, x), x, inference.coefficient_contrast(names, {names[1]: 1.0}))
    return out.select("gene_id", F.round("logFC", 6).alias("logFC"), F.round("statistic", 5).alias("statistic"))


def _student_sql(df: int) -> str:
    """Two-sided tail of Student's t for odd freedom, a finite sum in the angle whose tangent is |t| / sqrt(df)."""
    c, terms = 1.0, []
    for k in range((df - 1) // 2):
        c *= 2 * k / (2 * k + 1) if k else 1.0
        terms.append(f"{c!r} * cos(a) ** {2 * k + 1}")
    return f"1 - 2 / pi() * (a + sin(a) * ({' + '.join(terms)}))"


@query(
    "contrast_fit",
    EFFECT_SQL + f""", s AS (SELECT gene_id, lfc, lfc / sqrt(rss / 21 / srr) AS st, atan(abs(lfc / sqrt(rss / 21 / srr)) / sqrt(21)) AS a FROM g), p AS (SELECT gene_id, lfc, st, {_student_sql(21)} AS p FROM s),
    q AS (SELECT *, p * count(*) OVER () / row_number() OVER (ORDER BY p, gene_id) AS q FROM p), f AS (SELECT *, least(1.0, min(q) OVER (ORDER BY p DESC, gene_id DESC ROWS UNBOUNDED PRECEDING)) AS fdr FROM q)
    SELECT 'treated' AS contrast_id, gene_id, round(lfc, 6) AS "logFC", round(st, 6) AS statistic, round(p, 6) AS "PValue", round(fdr, 6) AS "FDR",
    CASE WHEN fdr < 0.9 AND lfc > 0.3 THEN 'Up' WHEN fdr < 0.9 AND lfc < -0.3 THEN 'Down' ELSE 'Unchanged' END AS "Regulation" FROM f""",
    "counts", "samples", "dense",
)
def _(t):
    return _contrast(t).select("contrast_id", "gene_id", *[F.round(c, 6).alias(c) for c in ("logFC", "statistic", "PValue", "FDR")], "Regulation")


@query(
    "omnibus",
    EFFECT_SQL + """ SELECT gene_id, round((rss0 - rss) / 2 / (rss / 21), 6) AS statistic, round((1 + 2 * ((rss0 - rss) / 2 / (rss / 21)) / 21) ** (-10.5), 6) AS "PValue" FROM g""",
    "counts", "samples", "dense",
)
def _(t):
    names, x, fitted = _tested(t)
    vectors = [inference.coefficient_contrast(names, {n: 1.0}) for n in names if n.startswith("factor:batch")]
    out = inference.omnibus_test(fitted, x, np.stack(vectors))
    return out.select("gene_id", F.round("statistic", 6).alias("statistic"), F.round("PValue", 6).alias("PValue"))


BH_SQL = """WITH p AS (SELECT l_suppkey % 10 AS family, l_orderkey || ':' || l_partkey || ':' || l_suppkey AS gene_id, CASE WHEN l_orderkey % 31 <> 0 THEN (l_orderkey * 7919 + l_partkey * 104729) % 1000003 / 1000003.0 END AS p FROM lineitem),
    q AS (SELECT *, p * count(p) OVER (PARTITION BY family) / row_number() OVER (PARTITION BY family, p IS NULL ORDER BY p, gene_id) AS q FROM p),
    a AS (SELECT family, gene_id, p, CASE WHEN p IS NOT NULL THEN least(1.0, min(q) OVER (PARTITION BY family, p IS NULL ORDER BY p DESC, gene_id DESC ROWS UNBOUNDED PRECEDING)) END AS fdr FROM q)"""


def _bh(t):
    k = F.col("l_orderkey")
    p = F.when(k % 31 != 0, (k * 7919 + F.col("l_partkey") * 104729) % 1000003 / 1000003.0)
    df = t.read("lineitem").select((F.col("l_suppkey") % 10).alias("family"), F.concat_ws(":", k.cast("string"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("gene_id"), p.alias("p"))
    return inference.benjamini_hochberg(df, ["family"], "p", "fdr")


@query("bh_adjust", BH_SQL + " SELECT family, gene_id, round(p, 9) AS p, round(fdr, 9) AS fdr FROM a")
def _(t):
    return _bh(t).select("family", "gene_id", F.round("p", 9).alias("p"), F.round("fdr", 9).alias("fdr"))


@query("bh_adjust_in_ranges", BH_SQL + " SELECT family, gene_id, round(p, 9) AS p, round(fdr, 9) AS fdr FROM a")
def _(t):
    """The same families as if each were too large for a task."""
    df = _bh(t).select("family", "gene_id", "p")
    return inference.benjamini_hochberg_in_ranges(df, ["family"], "p", "fdr").select("family", "gene_id", F.round("p", 9).alias("p"), F.round("fdr", 9).alias("fdr"))


@query(
    "regulation",
    """SELECT l_orderkey || ':' || l_partkey || ':' || l_suppkey AS gene_id, CASE WHEN l_tax < 0.03 AND l_discount - 0.05 > 0.02 THEN 'Up' WHEN l_tax < 0.03 AND l_discount - 0.05 < -0.02 THEN 'Down' ELSE 'Unchanged' END AS regulation,
    round(-log10(greatest(l_tax, 2.2250738585072014e-308)), 6) AS neg_log10 FROM lineitem""",
)
def _(t):
    key = F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
    return t.read("lineitem").select(key.alias("gene_id"), inference.regulation(F.col("l_tax"), F.col("l_discount") - 0.05, 0.03, 0.02).alias("regulation"), F.round(inference.minus_log10(F.col("l_tax")), 6).alias("neg_log10"))


@query(
    "candidate_topk",
    """SELECT p_brand, p_partkey, p_retailprice FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) <= 12""",
)
def _(t):
    return explore.top_per_group(t.read("part"), ["p_brand"], [F.desc("p_retailprice"), "p_partkey"], 12).select("p_brand", "p_partkey", "p_retailprice")


def _sets(t):
    """Parts regulated by price, in sets by type and size."""
    part = t.read("part")
    state = F.when(F.col("p_size") > 40, "Up").when(F.col("p_size") < 8, "Down").otherwise("Unchanged")
    tests = part.select(F.col("p_partkey").alias("gene_id"), state.alias("Regulation"))
    sets = part.where("p_partkey % 6 <> 0").select(F.col("p_partkey").alias("gene_id"), F.concat_ws("-", "p_type", (F.col("p_partkey") % 5).cast("string")).alias("set_id"))
    return tests, sets


@query(
    "ora",
    """WITH g AS (SELECT p_partkey AS gene_id, p_type || '-' || (p_partkey % 5) AS set_id, CASE WHEN p_size > 40 THEN 'Up' WHEN p_size < 8 THEN 'Down' END AS r FROM part WHERE p_partkey % 6 <> 0),
    s AS (SELECT set_id, count(*) AS set_size FROM g GROUP BY 1), d(direction) AS (VALUES ('All'), ('Up'), ('Down')), n AS (SELECT direction, count(*) AS n_selected FROM g JOIN d ON r = direction OR (direction = 'All' AND r IS NOT NULL) GROUP BY 1),
    o AS (SELECT direction, set_id, count(*) AS overlap FROM g JOIN d ON r = direction OR (direction = 'All' AND r IS NOT NULL) GROUP BY 1, 2),
    x AS (SELECT direction, set_id, set_size, coalesce(n_selected, 0) AS n_selected, coalesce(overlap, 0) AS overlap, (SELECT count(*) FROM g) AS background FROM s CROSS JOIN d LEFT JOIN n USING (direction) LEFT JOIN o USING (direction, set_id)),
    p AS (SELECT *, CASE WHEN overlap <= 0 THEN 1.0 ELSE least(1.0, list_sum([exp(lgamma(set_size + 1) - lgamma(i + 1) - lgamma(set_size - i + 1) + lgamma(background - set_size + 1) - lgamma(n_selected - i + 1) - lgamma(background - set_size - n_selected + i + 1)
      - lgamma(background + 1) + lgamma(n_selected + 1) + lgamma(background - n_selected + 1)) FOR i IN range(overlap, least(set_size, n_selected) + 1)])) END AS pv FROM x)
    SELECT direction, set_id, set_size, n_selected, overlap, background, round(pv, 8) AS "PValue" FROM p""",
)
def _(t):
    out = enrichment.over_representation(*_sets(t))
    return out.select("direction", "set_id", "set_size", "n_selected", "overlap", F.col("background").cast("bigint").alias("background"), F.round("PValue", 8).alias("PValue"))


@query(
    "running_score",
    """WITH r AS (SELECT p_partkey AS gene_id, p_retailprice - 1000 AS score, row_number() OVER (ORDER BY p_retailprice - 1000 DESC, p_partkey) AS rank FROM part), s AS (SELECT p_partkey AS gene_id, p_type AS set_id FROM part WHERE p_partkey % 6 <> 0),
    h AS (SELECT set_id, rank, abs(score) AS w, sum(abs(score)) OVER (PARTITION BY set_id) AS mass, count(*) OVER (PARTITION BY set_id) AS k, sum(abs(score)) OVER (PARTITION BY set_id ORDER BY rank) AS c, row_number() OVER (PARTITION BY set_id ORDER BY rank) AS i FROM r JOIN s USING (gene_id)),
    e AS (SELECT set_id, max(c / mass - (rank - i) / ((SELECT count(*) FROM part) - k)) AS hi, min((c - w) / mass - (rank - i) / ((SELECT count(*) FROM part) - k)) AS lo, max(k) AS n_hits FROM h GROUP BY 1)
    SELECT set_id, round(CASE WHEN hi >= -lo THEN hi ELSE lo END, 8) AS es, n_hits FROM e""",
)
def _(t):
    ranked = t.read("part").select(F.col("p_partkey").alias("gene_id"), (F.col("p_retailprice") - 1000).alias("score"))
    sets = t.read("part").where("p_partkey % 6 <> 0").select(F.col("p_partkey").alias("gene_id"), F.col("p_type").alias("set_id"))
    return enrichment.running_score(ranked, sets).withColumn("es", F.round("es", 8))


@query("permutation_significance")
def _(t):
    """Significance of sets by seeded permutations; a plain loop over the same permutations is its test."""
    ranked = t.read("part").select(F.col("p_partkey").alias("gene_id"), (F.col("p_retailprice") - 1000).alias("score"))
    sets = t.read("part").where("p_partkey % 6 <> 0").select(F.col("p_partkey").alias("gene_id"), F.col("p_type").alias("set_id"))
    return enrichment.permutation_significance(ranked, sets, 200)


# Sets and text


@query("union_distinct", "SELECT p_brand AS label FROM part UNION SELECT c_mktsegment FROM customer UNION SELECT o_orderpriority FROM orders")
def _(t):
    return tables.union_distinct([t.read(a).select(F.col(c).alias("label")) for a, c in (("part", "p_brand"), ("customer", "c_mktsegment"), ("orders", "o_orderpriority"))])


@query("set_difference", "SELECT c_custkey AS id FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 0")
def _(t):
    used = t.read("orders").where("o_orderkey % 3 = 0").select(F.col("o_custkey").alias("id"))
    return tables.only_in(t.read("customer").select(F.col("c_custkey").alias("id")), used, ["id"])


@query("set_intersection", "SELECT c_custkey AS id FROM customer WHERE c_custkey % 2 = 0 INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    used = t.read("orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id"))
    return tables.in_both(t.read("customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id")), used, ["id"])


@query("percent_decode_map", "SELECT p_partkey, p_name AS name, p_brand || '+x' AS brand FROM part")
def _(t):
    text = F.concat(F.lit("name="), F.replace("p_name", F.lit(" "), F.lit("%20")), F.lit(";brand="), F.replace("p_brand", F.lit("#"), F.lit("%23")), F.lit("+x"))
    m = percent_map(text)
    return t.read("part").select("p_partkey", m["name"].alias("name"), m["brand"].alias("brand"))


@query("first_wins", "SELECT user_id, arg_min(event_type, event_id) AS first_type, arg_max(event_type, event_id) AS last_type FROM events GROUP BY 1")
def _(t):
    e = t.read("events").select("user_id", "event_type", "event_id")
    first = tables.one_per_key(e, ["user_id"], ["event_id"], last=False).select("user_id", F.col("event_type").alias("first_type"))
    return first.join(tables.one_per_key(e, ["user_id"], ["event_id"]).select("user_id", F.col("event_type").alias("last_type")), "user_id")


@query("single_base_sites", "SELECT event_id, chrom, pos FROM snps WHERE ref <> 'N' AND length(ref) = 1", "snps")
def _(t):
    return readers.single_base(t.snps().withColumn("alt", F.when(F.col("ref") == "N", "A,C").otherwise(F.col("alt")))).select("event_id", "chrom", "pos")
