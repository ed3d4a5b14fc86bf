"""More queries over the driver's tables: selection, gates, annotation, alignments, designs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from .operators import annotation, counts, explore, features, haplotypes, inference, intervals, normalize, sequences, validate
from .queries import EFFECT_SQL, _dense
from .registry import query
from .sources import readers

text = lambda c: F.col(c).cast("string")


# Alignments and reads


@query("kept_alignments", "SELECT read_id, flag FROM alignments WHERE flag & 3332 = 0", "alignments")
def _(t):
    return intervals.kept_alignments(t.alignments()).select("read_id", "flag")


@query(
    "examined_reads",
    """SELECT sample_id, read_id, flag FROM (SELECT library AS sample_id, read_id, flag, l_number FROM (SELECT *, row_number() OVER (PARTITION BY library ORDER BY read_id) AS l_number FROM alignments WHERE flag & 3332 = 0)) WHERE l_number <= 40""",
    "alignments",
)
def _(t):
    return sequences.examined(t.alignments().withColumnRenamed("library", "sample_id"), ["read_id"], 40).select("sample_id", "read_id", "flag")


@query("sampled_reads", "SELECT read_id, mate FROM reads WHERE read_id IN (SELECT read_id FROM (SELECT DISTINCT read_id FROM reads) ORDER BY md5('7:' || read_id), read_id LIMIT 200)", "reads")
def _(t):
    return sequences.sampled_reads(t.reads(), 200, 7).select("read_id", "mate")


@query("prealigned_split", "SELECT o_orderkey, o_orderkey % 3 = 0 AS aligned FROM orders")
def _(t):
    rows = t.read("orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, "x.bam").otherwise(" ").alias("bam"))
    has, lacks = validate.prealigned(rows)
    return has.withColumn("aligned", F.lit(True)).unionByName(lacks.withColumn("aligned", F.lit(False))).drop("bam")


def _counting(name, stranded, condition):
    @query(
        name,
        f"""+ u AS (SELECT *, CASE WHEN NOT mapped THEN '__not_aligned' WHEN nh > 1 THEN '__alignment_not_unique' WHEN mapq < 10 THEN '__too_low_aQual' END AS status FROM alignments),
        h AS (SELECT read_id, count(DISTINCT gene_id) AS k, min(gene_id) AS g FROM (SELECT u.read_id, g.gene_id FROM u JOIN genes g ON g.chrom = u.chrom AND {condition} AND u."start" <= g."end" AND g."start" <= u."end" WHERE status IS NULL) GROUP BY 1)
        SELECT category, count(*) AS n FROM (SELECT CASE WHEN k IS NULL THEN '__no_feature' WHEN k > 1 THEN '__ambiguous' ELSE g END AS category FROM u LEFT JOIN h USING (read_id) WHERE status IS NULL
          UNION ALL SELECT status FROM u WHERE status IS NOT NULL) GROUP BY 1""",
        "alignments", "genes",
    )
    def _(t):
        return intervals.count_features(t.alignments(), t.genes(), 2000, stranded=stranded)


_counting("feature_counting_reverse", "reverse", "g.strand <> u.strand")
_counting("feature_counting_unstranded", "unstranded", "true")

#: Gapped reads of the alignments: ten bases, a gap of 90 or 190, ten more behind two inserted ones.
GAPPED = """+ gapped AS (SELECT read_id, chrom, mapq, "start", CASE WHEN library % 2 = 0 THEN 90 ELSE 190 END AS gap FROM alignments),
    blocks2 AS (SELECT *, "start" AS s, "start" + 9 AS e, 1 AS seq_at FROM gapped UNION ALL SELECT *, "start" + 10 + gap, "start" + 19 + gap, 13 FROM gapped),
    sites AS (SELECT DISTINCT chrom, pos, ref, alt FROM snps WHERE ref <> 'N' AND alt <> 'N')"""


def _gapped(t):
    gap = F.when(F.col("library") % 2 == 0, "10M90N2I10M").otherwise("10M190N2I10M")
    reads = t.alignments().select("read_id", F.lit(1).alias("mate"), "chrom", "mapq", (F.col("start") - 1).alias("pos0"), gap.alias("cigar"), F.lit("ACGTACGTACGTACGTACGTAC").alias("seq"), F.lit("I" * 22).alias("qual"))
    return reads, intervals.aligned_blocks(reads)


@query(
    "gapped_routing",
    GAPPED + """ SELECT read_id, CASE WHEN read_id IN (SELECT read_id FROM blocks2 b JOIN sites x ON x.chrom = b.chrom AND pos BETWEEN s AND e) THEN 'to_remap' ELSE 'keep' END AS route FROM gapped""",
    "alignments", "snps",
)
def _(t):
    return intervals.split_by_snps(_gapped(t)[1], intervals.phased_sites(t.snps()).distinct(), 500)


@query(
    "gapped_haplotype_counts",
    GAPPED + """, z AS (SELECT b.chrom, pos, ref, alt, substr('ACGTACGTACGTACGTACGTAC', CAST(pos - s + seq_at AS INT), 1) AS base FROM blocks2 b JOIN sites x ON x.chrom = b.chrom AND pos BETWEEN s AND e WHERE mapq >= 20)
    SELECT chrom, pos, ref, alt, count(*) FILTER (base = ref) AS a_count, count(*) FILTER (base = alt) AS b_count, count(*) FILTER (base IN (ref, alt)) AS total_count FROM z GROUP BY 1, 2, 3, 4""",
    "alignments", "snps",
)
def _(t):
    return intervals.allele_counts(_gapped(t)[1], intervals.phased_sites(t.snps()).distinct(), 500)


@query(
    "unbiased_reads",
    """+ sites AS (SELECT DISTINCT chrom, pos FROM snps WHERE ref <> 'N' AND alt <> 'N'),
    r AS (SELECT *, EXISTS (SELECT 1 FROM sites s WHERE s.chrom = a.chrom AND s.pos BETWEEN a."start" AND a."end") AS hit FROM alignments a)
    SELECT read_id FROM r WHERE NOT hit OR mapq % 3 <> 0""",
    "alignments", "snps",
)
def _(t):
    reads = t.alignments().select("read_id", F.lit(1).alias("mate"), "chrom", (F.col("start") - 1).alias("pos0"), F.lit("50M").alias("cigar"), "start", "end", "mapq")
    moved = F.when(F.col("mapq") % 3 == 0, F.col("pos0") + 7).otherwise(F.col("pos0"))
    again = reads.withColumn("pos0", moved)
    return intervals.mapped_again(reads, intervals.phased_sites(t.snps()).distinct(), again, 500).select("read_id")


@query(
    "genome_prefix",
    """WITH d AS (SELECT source, doc_id, coalesce(text, '') AS s, coalesce(sum(length(coalesce(text, ''))) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto FROM documents)
    SELECT source, CAST(sum(length(s)) AS BIGINT) AS total_bp, CAST(sum(length(s)) FILTER (upto < 100000) AS BIGINT) AS composition_scanned_bp,
    round(coalesce(sum(length(regexp_replace(s, '[^Nn]', '', 'g'))) FILTER (upto < 100000), 0) / sum(length(s)) FILTER (upto < 100000), 9) AS n_fraction FROM d GROUP BY 1""",
)
def _(t):
    seqs = t.proteins().select("source", F.col("protein_id").alias("ord"), F.coalesce("text", F.lit("")).alias("sequence"))
    return sequences.genome_stats(seqs, ["source"], 100_000).select("source", "total_bp", "composition_scanned_bp", F.round("n_fraction", 9).alias("n_fraction"))


# Counts, gates and reports


@query(
    "export_subset",
    "PIVOT (SELECT gene_id, sample_id, CASE WHEN sample_id IN ('S2', 'S7', 'S11') THEN n END AS n FROM counts) ON sample_id IN ('S7', 'S2', 'S11') USING CAST(sum(n) AS BIGINT) GROUP BY gene_id",
    "counts",
)
def _(t):
    return counts.export_subset(t.counts(), ["S7", "S2", "S11"])


STAT_SQL = """+ st AS (SELECT 'f' || (c_custkey % 5) AS stats_path, 'k' || (c_custkey // 2) AS stats_key, c_custkey AS v FROM customer WHERE c_custkey % 7 <> 0),
    sa AS (SELECT s_suppkey AS sample_id, 'f' || (s_suppkey % 5) AS stats_path, 'k' || (s_suppkey % 90) AS stats_key FROM supplier)"""


def _statistics(t):
    st = t.read("customer").where("c_custkey % 7 <> 0").select(F.concat(F.lit("f"), (F.col("c_custkey") % 5).cast("string")).alias("stats_path"), F.concat(F.lit("k"), F.floor(F.col("c_custkey") / 2).cast("string")).alias("stats_key"), F.col("c_custkey").alias("v"))
    sa = t.read("supplier").select(F.col("s_suppkey").alias("sample_id"), F.concat(F.lit("f"), (F.col("s_suppkey") % 5).cast("string")).alias("stats_path"), F.concat(F.lit("k"), (F.col("s_suppkey") % 90).cast("string")).alias("stats_key"))
    return sa, st


@query("matched_statistics", STAT_SQL + " SELECT sample_id, stats_path, stats_key, v FROM sa LEFT JOIN st USING (stats_path, stats_key)", "genes")
def _(t):
    return counts.matched_statistics(*_statistics(t))


@query(
    "statistics_rules",
    STAT_SQL + """, w AS (SELECT stats_path, stats_key, count(*) AS ns, (SELECT count(*) FROM st WHERE st.stats_path = sa.stats_path AND st.stats_key = sa.stats_key) AS nr FROM sa GROUP BY 1, 2)
    SELECT 'reused' AS rule, stats_path || '|' || stats_key AS key, CAST(ns AS VARCHAR) AS detail FROM w WHERE ns > 1 UNION ALL SELECT 'not_one_row', stats_path || '|' || stats_key, CAST(nr AS VARCHAR) FROM w WHERE nr <> 1""",
    "genes",
)
def _(t):
    return counts.statistics_problems(*_statistics(t))


@query(
    "categories_with_metrics",
    """+ m AS (SELECT sample_id, count(*) AS quantified FROM counts WHERE sample_id <> 'S4' GROUP BY 1) SELECT sample_id, 'library' AS qc_level, category, n, quantified FROM counters LEFT JOIN m USING (sample_id)""",
    "counters", "counts",
)
def _(t):
    m = t.counts().where("sample_id <> 'S4'").groupBy("sample_id").agg(F.count(F.lit(1)).alias("quantified")).withColumn("qc_level", F.lit("library"))
    return counts.categories_with_metrics(t.counters(), m)


@query(
    "modelling_gates",
    """WITH s AS (SELECT c_nationkey AS analysis_id, CASE WHEN c_nationkey % 2 = 0 THEN 'inferential' ELSE 'exploratory' END AS analysis_mode, CASE WHEN c_nationkey % 3 = 0 AND c_custkey % 5 = 0 THEN 'pair' ELSE 'fragment' END AS u, c_nationkey % 4 = 0 AND c_custkey % 3 = 0 AS open FROM customer),
    g AS (SELECT analysis_id, analysis_mode, count(DISTINCT u) AS n_units, count(*) FILTER (open) AS n_unverified FROM s GROUP BY 1, 2)
    SELECT *, CASE WHEN n_units > 1 THEN 'mixed_units' WHEN analysis_mode = 'inferential' AND n_unverified > 0 THEN 'unverified_biology' ELSE '' END AS reason FROM g""",
)
def _(t):
    nation, k = F.col("c_nationkey"), F.col("c_custkey")
    s = t.read("customer").select(
        nation.alias("analysis_id"), F.when(nation % 2 == 0, "inferential").otherwise("exploratory").alias("analysis_mode"),
        F.when((nation % 3 == 0) & (k % 5 == 0), "pair").otherwise("fragment").alias("count_unit"), F.when((nation % 4 == 0) & (k % 3 == 0), "Unverified").otherwise("verified").alias("biological_unit_status"),
    )
    return counts.modelling_gates(s)


@query(
    "dashboard_defaults",
    """SELECT c_custkey AS sample_id, CASE WHEN c_custkey % 3 = 0 THEN 'unknown' ELSE c_mktsegment END AS "group", 'all samples' AS study_id, CASE WHEN c_nationkey > 0 THEN round(100.0 * (c_custkey % 20) / c_nationkey, 6) END AS supplied_gene_detection_pct FROM customer""",
)
def _(t):
    m = t.read("customer").select(F.col("c_custkey").alias("sample_id"), F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_mktsegment")).alias("group"), (F.col("c_custkey") % 20).alias("genes_detected"), F.col("c_nationkey").alias("quantified_gene_count"))
    return counts.dashboard_defaults(m).select("sample_id", "group", "study_id", F.round("supplied_gene_detection_pct", 6).alias("supplied_gene_detection_pct"))


@query(
    "composition_bars",
    """WITH l AS (SELECT p_partkey AS sample_id, p_size * 1.5 AS pine, p_retailprice / 30 AS fungus FROM part) SELECT sample_id, 'pine' AS genome, round(pine, 6) AS pct FROM l UNION ALL SELECT sample_id, 'fungus', round(fungus, 6) FROM l
    UNION ALL SELECT sample_id, 'other', round(greatest(0, 100 - pine - fungus), 6) FROM l""",
)
def _(t):
    lib = t.read("part").select(F.col("p_partkey").alias("sample_id"), (F.col("p_size") * 1.5).alias("pine_pct"), (F.col("p_retailprice") / 30).alias("fungus_pct"))
    return counts.composition_bars(lib, {"pine": "pine_pct", "fungus": "fungus_pct"}).withColumn("pct", F.round("pct", 6))


@query(
    "library_table",
    """+ e AS (SELECT 'S' || (user_id % 25) AS sample_id, event_type FROM events),
    st AS (SELECT sample_id, CAST(count(*) FILTER (event_type = 'view') AS BIGINT) AS assigned, CAST(count(*) FILTER (event_type = 'purchase') AS BIGINT) AS not_aligned, CAST(count(*) FILTER (event_type IN ('view', 'purchase', 'click')) AS BIGINT) AS fragments FROM e GROUP BY 1),
    co AS (SELECT 'S' || (user_id % 25) AS sample_id, CAST(sum(v) FILTER (g < 3) AS BIGINT) AS fungus_assigned, CAST(sum(v) FILTER (g <> 3) AS BIGINT) AS al, CAST(sum(v) AS BIGINT) AS tot FROM (SELECT user_id, event_id % 4 AS g, event_id % 7 AS v FROM events) GROUP BY 1)
    SELECT sample_id, fragments, fragments - not_aligned AS primary_aligned, fungus_assigned, round(100.0 * al / tot, 6) AS fungus_aligned_pct, round(1e6 * fungus_assigned / fragments, 4) AS fungus_ppm,
    CASE WHEN treatment = 'control' THEN 'control' WHEN 1e6 * fungus_assigned / fragments >= 3600000 THEN 'high' ELSE 'treated_low' END AS exposure_group, fragments - not_aligned >= 120 AS qc_pass
    FROM samples JOIN st USING (sample_id) JOIN co USING (sample_id)""",
    "samples",
)
def _(t):
    sample = F.concat(F.lit("S"), (F.col("user_id") % 25).cast("string"))
    kinds = {"view": "assigned", "purchase": "not_aligned", "click": "no_feature"}
    st = t.read("events").groupBy(sample.alias("sample")).agg(*[F.count_if(F.col("event_type") == k).alias(c) for k, c in kinds.items()])
    gene = F.when(F.col("event_id") % 4 == 3, "__not_aligned").otherwise(F.concat(F.lit("f"), (F.col("event_id") % 4).cast("string")))
    co = t.read("events").groupBy(sample.alias("sample_id"), F.lit("fungus").alias("organism"), gene.alias("gene_id")).agg(F.sum(F.col("event_id") % 7).alias("n"))
    meta = t.samples().select("sample_id", "treatment", F.col("batch").alias("age_group"))
    out = counts.library_qc(meta, st, co, "treatment", "control", "fungus", 3_600_000, 120, ["b0", "b1"])
    return out.select("sample_id", "fragments", "primary_aligned", "fungus_assigned", F.round("fungus_aligned_pct", 6).alias("fungus_aligned_pct"), F.round("fungus_ppm", 4).alias("fungus_ppm"), "exposure_group", "qc_pass")


@query(
    "featurecounts_metrics",
    """+ g AS (SELECT sample_id, CAST(sum(n) AS BIGINT) AS gene_count_sum, count(*) FILTER (n > 0) AS genes_detected FROM counts GROUP BY 1),
    c AS (SELECT sample_id, CAST(sum(n) FILTER (category = 'no_feature') AS BIGINT) AS assigned, CASE WHEN count(*) FILTER (category = 'ambiguous') > 0 THEN CAST(sum(n) AS BIGINT) END AS processed FROM counters WHERE category IN ('no_feature', 'ambiguous', 'not_aligned') GROUP BY 1)
    SELECT sample_id, gene_count_sum, genes_detected, assigned, processed, CASE WHEN processed > 0 THEN round(100.0 * assigned / processed, 9) END AS assignment_rate_pct, assigned <> gene_count_sum AS sum_differs FROM g LEFT JOIN c USING (sample_id)""",
    "counts", "counters",
)
def _(t):
    name = F.when(F.col("category") == "no_feature", "Assigned").when(F.col("category") == "ambiguous", "Unassigned_Ambiguity").when(F.col("category") == "not_aligned", "Unassigned_Unmapped")
    out = counts.featurecounts_metrics(t.counts(), t.counters().withColumn("category", name).where("category IS NOT NULL"))
    return out.withColumn("assignment_rate_pct", F.round("assignment_rate_pct", 9))


@query(
    "salmon_mapping",
    "SELECT o_orderkey AS sample_id, o_custkey AS num_processed, o_orderkey % 500 AS num_mapped, CASE WHEN o_custkey > 0 THEN round(100.0 * (o_orderkey % 500) / o_custkey, 9) END AS mapping_rate_pct, o_orderkey % 500 > o_custkey AS impossible FROM orders",
)
def _(t):
    meta = t.read("orders").select(F.col("o_orderkey").alias("sample_id"), F.col("o_custkey").alias("num_processed"), (F.col("o_orderkey") % 500).alias("num_mapped"))
    return counts.salmon_mapping(meta).withColumn("mapping_rate_pct", F.round("mapping_rate_pct", 9))


@query("zero_libraries", "SELECT sample_id FROM counts GROUP BY 1 HAVING sum(CASE WHEN sample_id IN ('S3', 'S9') THEN 0 ELSE n END) = 0", "counts")
def _(t):
    n = F.when(F.col("sample_id").isin("S3", "S9"), 0).otherwise(F.col("n"))
    return normalize.zero_libraries(t.counts().withColumn("n", n))


@query("exact_counts", "SELECT sample_id, max(CASE WHEN sample_id = 'S1' THEN n + 9007199254740992 ELSE n END) > 9007199254740992 AS blocked FROM counts GROUP BY 1", "counts")
def _(t):
    n = F.when(F.col("sample_id") == "S1", F.col("n") + 9007199254740992).otherwise(F.col("n"))
    return counts.exactness(t.counts().withColumn("n", n))


@query("level_order", "SELECT p_partkey, p_type, coalesce(list_position(['LARGE', 'SMALL'], p_type[1:5]), 1073741824) AS place FROM part")
def _(t):
    df = t.read("part").select("p_partkey", "p_type", F.substring("p_type", 1, 5).alias("kind"))
    return explore.ordered_levels(df, "kind", "LARGE|SMALL").select("p_partkey", "p_type", explore.level_place(F.col("kind"), "LARGE|SMALL").cast("bigint").alias("place"))


@query("scores_with_metadata", "SELECT sample_id, treatment, batch, CAST(sum(n) AS BIGINT) AS score FROM counts JOIN samples USING (sample_id) GROUP BY 1, 2, 3", "counts", "samples")
def _(t):
    scores = t.counts().groupBy("sample_id").agg(F.sum("n").alias("score"))
    return explore.attach_metadata(scores, t.samples().select("sample_id", "treatment", "batch"))


@query(
    "candidate_expression",
    """+ top AS (SELECT gene_id, sum(n) AS s FROM counts GROUP BY 1 ORDER BY s DESC, gene_id LIMIT 12) SELECT sample_id, gene_id, round(log2(n + 1), 6) AS logcpm, treatment AS exposure_group, CASE WHEN CAST(gene_id[2:] AS INT) % 2 = 0 THEN 'P' || gene_id[2:] || ' (' || gene_id || ')' ELSE gene_id END AS label
    FROM counts JOIN top USING (gene_id) LEFT JOIN (SELECT * FROM samples WHERE number % 4 <> 0) USING (sample_id)""",
    "counts", "samples",
)
def _(t):
    c = t.counts()
    top = c.groupBy("gene_id").agg(F.sum("n").alias("s")).orderBy(F.desc("s"), "gene_id").limit(12).select("gene_id", F.lit(1.0).alias("logFC"), F.lit(0.01).alias("FDR"))
    labels = t.read("part").where("p_partkey % 2 = 0").select(F.concat(F.lit("g"), text("p_partkey")).alias("gene_id"), F.concat(F.lit("P"), text("p_partkey")).alias("label"))
    groups = t.samples().where("number % 4 <> 0").select("sample_id", F.col("treatment").alias("exposure_group"))
    expr = c.withColumn("logcpm", F.round(F.log2(F.col("n") + 1), 6))
    return explore.candidate_expression(expr, annotation.labelled(top, labels, with_id=True), groups).select("sample_id", "gene_id", "logcpm", "exposure_group", "label")


# Annotation


@query(
    "eggnog_product",
    """SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name WHEN p_partkey % 3 = 1 THEN p_brand END AS product FROM part""",
)
def _(t):
    k = F.col("p_partkey")
    description = F.when(k % 3 == 0, F.col("p_name")).when(k % 3 == 1, "-").otherwise("N/A")
    return t.read("part").select("p_partkey", annotation.eggnog_product(description, F.when(k % 3 == 1, F.col("p_brand"))).alias("product"))


@query(
    "uniprot_headers",
    """SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'A' || s_suppkey END AS accession, CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE 'odd ' || s_name END AS description, CASE WHEN s_suppkey % 4 = 0 THEN 'Zea mays' END AS organism FROM supplier""",
)
def _(t):
    k = F.col("s_suppkey")
    known = F.concat(F.lit(">sp|A"), k.cast("string"), F.lit("|E"), k.cast("string"), F.lit(" "), "s_name", F.when(k % 4 == 0, " OS=Zea mays OX=4577 PE=1").otherwise(""))
    head = annotation.parse_uniprot_header(F.when(k % 2 == 0, known).otherwise(F.concat(F.lit(">odd "), "s_name")))
    return t.read("supplier").select("s_suppkey", head["accession"].alias("accession"), head["description"].alias("description"), head["organism"].alias("organism"))


@query(
    "predictor_table",
    """WITH p AS (SELECT p_partkey AS k, p_size AS z FROM part), v AS (SELECT *, (k % 2 = 0)::INT + (k % 3 = 0)::INT + (k % 5 = 0)::INT + (k % 7 = 0)::INT AS n, greatest(CASE WHEN k % 7 IN (0, 1) THEN z % 2 ELSE 0 END, CASE WHEN k % 4 = 0 THEN z % 3 ELSE 0 END) AS tm FROM p)
    SELECT k AS protein_id, CASE WHEN k % 2 = 0 THEN 'SP' ELSE '-' END AS signalp6, CASE WHEN k % 3 = 0 THEN 'SP' WHEN k % 3 = 1 THEN 'mTP' ELSE 'noTP' END AS targetp2, CASE WHEN k % 5 = 0 THEN 'Extracellular' ELSE '-' END AS deeploc2,
    CASE WHEN k % 7 = 0 THEN 'SP+TM:' || (z % 2) WHEN k % 7 = 1 THEN 'TM:' || (z % 2) ELSE ':0' END AS deeptmhmm, 'SP=N;TM=' || (CASE WHEN k % 4 = 0 THEN z % 3 ELSE 0 END) AS phobius, n AS n_sp_tools, tm AS n_tm,
    CASE WHEN n >= 2 AND tm = 0 THEN 'yes' ELSE 'no' END AS secreted, CASE WHEN n >= 2 AND tm = 0 AND k % 6 = 0 THEN 'Apoplastic effector' ELSE '-' END AS effectorp, CASE WHEN k % 9 = 0 THEN 'S8' ELSE '-' END AS merops FROM v""",
)
def _(t):
    p = t.read("part").withColumnRenamed("p_partkey", "protein_id")
    k = F.col("protein_id")
    pick = lambda cond, *cols: p.where(cond).select("protein_id", *cols)
    tools = {
        "signalp6": p.select("protein_id", F.when(k % 2 == 0, "SP").otherwise("OTHER").alias("call")),
        "targetp2": pick(k % 3 < 2, F.when(k % 3 == 0, "SP").otherwise("mTP").alias("call")),
        "deeploc2": pick(k % 5 == 0, F.lit("Extracellular").alias("compartment"), F.lit("Signal peptide|Nuclear").alias("signals")),
        "deeptmhmm": pick(k % 7 < 2, F.when(k % 7 == 0, "SP+TM").otherwise("TM").alias("kind"), (F.col("p_size") % 2).alias("n_tm")),
        "phobius": pick(k % 4 == 0, (F.col("p_size") % 3).alias("n_tm"), F.lit("-").alias("call")),
        "effectorp": pick(k % 6 == 0, F.lit("Apoplastic effector").alias("call")),
        "merops": pick(k % 9 == 0, F.lit("S8").alias("family")),
    }
    return annotation.predictor_table(p, tools)


@query(
    "predictor_rows_repeated",
    """SELECT p_partkey AS protein_id, CASE WHEN p_partkey % 2 = 0 THEN 'SP' ELSE '-' END AS signalp6, CASE WHEN p_partkey % 3 = 0 THEN 'mTP' ELSE 'SP' END AS targetp2,
    (CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE 1 END)::INT AS n_sp_tools, 0 AS n_tm, CASE WHEN p_partkey % 2 = 0 AND p_partkey % 3 <> 0 THEN 'yes' ELSE 'no' END AS secreted,
    'first' || (p_partkey % 4) AS merops FROM part""",
)
def _(t):
    """Two rows per protein and tool: the later ones count, of peptidases the earlier."""
    k = F.col("protein_id")
    twice = t.read("part").withColumnRenamed("p_partkey", "protein_id").select("protein_id", F.explode(F.array(F.lit(5), F.lit(9))).alias("at"))
    late = F.col("at") == 9
    tools = {
        "signalp6": twice.select("protein_id", "at", F.when(late == (k % 2 == 0), "SP").otherwise("OTHER").alias("call")),
        "targetp2": twice.select("protein_id", "at", F.when(late & (k % 3 == 0), "mTP").otherwise("SP").alias("call")),
        "merops": twice.select("protein_id", "at", F.concat(F.when(late, "last").otherwise("first"), (k % 4).cast("string")).alias("family")),
    }
    return annotation.predictor_table(twice.select("protein_id").distinct(), tools)


@query(
    "family_calls",
    """WITH d AS (SELECT p_partkey AS protein_id, CASE WHEN p_partkey % 3 = 0 THEN 'GH' || (p_size % 5) END AS a, CASE WHEN p_partkey % 4 = 0 THEN 'GH1' END AS b, CASE WHEN p_partkey % 5 = 0 THEN '2' WHEN p_partkey % 7 = 0 THEN '0' END AS n FROM part),
    f AS (SELECT protein_id, list_sort(list_distinct(list_filter([a, b], lambda x: x IS NOT NULL))) AS l, n FROM d)
    SELECT protein_id, array_to_string(l, ';') AS family, coalesce(n, CAST(len(l) AS VARCHAR)) AS n_tools FROM f WHERE len(l) > 0 OR coalesce(n, '0') NOT IN ('', '0')""",
)
def _(t):
    k = F.col("p_partkey")
    overview = t.read("part").select(
        k.alias("protein_id"), F.when(k % 3 == 0, F.concat(F.lit("GH"), (F.col("p_size") % 5).cast("string"), F.lit("(1-9)+CBM2"))).otherwise("-").alias("hmmer"),
        F.when(k % 4 == 0, "GH1").alias("ecami"), F.lit("-").alias("diamond"), F.when(k % 5 == 0, "2").when(k % 7 == 0, "0").alias("n_tools"),
    )
    return annotation.family_calls(overview)


MAPPED_SQL = "WITH a AS (SELECT o_custkey AS sid, 'GO:' || (o_orderkey % 40) AS go_id FROM orders), m AS (SELECT c_custkey AS sid, 'g' || (c_custkey // 3) AS gene_id FROM customer WHERE c_custkey % 4 <> 0)"


def _mapped(t):
    rows = t.read("orders").select(text("o_custkey").alias("gene_id"), F.concat(F.lit("GO:"), (F.col("o_orderkey") % 40).cast("string")).alias("go_id"))
    m = t.read("customer").where("c_custkey % 4 <> 0").select(text("c_custkey").alias("source_id"), F.concat(F.lit("g"), F.floor(F.col("c_custkey") / 3).cast("string")).alias("gene_id"))
    return annotation.mapped_annotation(rows, m)


@query("mapped_annotation", MAPPED_SQL + " SELECT DISTINCT gene_id, go_id FROM a JOIN m USING (sid)")
def _(t):
    return _mapped(t)[0]


@query("annotation_mapping_report", MAPPED_SQL + " SELECT count(*) AS rows, count(*) FILTER (gene_id IS NULL) AS unmapped_rows FROM a LEFT JOIN m USING (sid)")
def _(t):
    return _mapped(t)[1]


# Features

NODE_SQL = """WITH f AS (SELECT 'c' || c_custkey AS id, 'gene' AS type, '' AS parent, NULL AS gene_id, 0 AS ord FROM customer WHERE c_custkey % 10 <> 0
    UNION ALL SELECT 'o' || (o_orderkey % 7000), 'mRNA', 'c' || o_custkey, CASE WHEN o_orderkey % 9 = 0 THEN 'x' || o_custkey END, o_orderkey + 1 FROM orders)"""


def _node_rows(t):
    attr = lambda **kv: F.map_filter(F.create_map(*[x for k, v in kv.items() for x in (F.lit(k), v)]), lambda _, v: v.isNotNull())
    genes = t.read("customer").where("c_custkey % 10 <> 0").select(F.lit("gene").alias("type"), attr(ID=F.concat(F.lit("c"), text("c_custkey"))).alias("attrs"), F.lit(0).cast("bigint").alias("ord"))
    k = F.col("o_orderkey")
    rna = t.read("orders").select(
        F.lit("mRNA").alias("type"),
        attr(ID=F.concat(F.lit("o"), (k % 7000).cast("string")), Parent=F.concat(F.lit("c"), text("o_custkey")), gene_id=F.when(k % 9 == 0, F.concat(F.lit("x"), text("o_custkey")))).alias("attrs"),
        (k + 1).alias("ord"),
    )
    return genes.unionByName(rna)


MERGED_SQL = """, m AS (SELECT id, CASE WHEN bool_or(type = 'gene') THEN 'gene' ELSE arg_min(type, ord) END AS type, arg_min(gene_id, ord) FILTER (gene_id IS NOT NULL) AS gene_id, arg_min(parent, ord) FILTER (parent <> '') AS parent FROM f GROUP BY 1)"""


@query("merged_nodes", NODE_SQL + MERGED_SQL + " SELECT id, type, gene_id, parent FROM m")
def _(t):
    nodes, edges = features.merged_nodes(_node_rows(t))
    return nodes.join(edges.select("id", "parent"), "id", "left")


RESOLVED_SQL = MERGED_SQL + """, r AS (SELECT id, CASE WHEN type = 'gene' THEN id WHEN gene_id IS NOT NULL THEN gene_id WHEN parent IN (SELECT id FROM f WHERE type = 'gene') THEN parent END AS g FROM m),
    a AS (SELECT f.id, f.ord, CASE WHEN f.gene_id IS NOT NULL THEN f.gene_id ELSE g END AS gene, f.gene_id IS NULL AND g IS NOT NULL AS added FROM f JOIN r USING (id) WHERE type = 'mRNA')"""


def _with_genes(t):
    rows = _node_rows(t)
    resolved = features.resolve_genes(*features.merged_nodes(rows))
    return features.add_gene_id(rows.withColumn("id", F.col("attrs")["ID"]), resolved, ["mRNA"])


@query("added_gene_ids", NODE_SQL + RESOLVED_SQL + " SELECT id, gene, added FROM a")
def _(t):
    return _with_genes(t).where("type = 'mRNA'").select("id", F.col("attrs")["gene_id"].alias("gene"), "added")


@query("gene_id_coverage", NODE_SQL + RESOLVED_SQL + " SELECT count(*) AS n_rows, count(gene) AS n_with, count(gene) >= 0.99 * count(*) AS passed FROM a")
def _(t):
    return features.gene_id_coverage(_with_genes(t), ["mRNA"])


@query("first_unresolved", NODE_SQL + RESOLVED_SQL + " SELECT id, 'mRNA' AS type FROM a WHERE gene IS NULL ORDER BY ord LIMIT 10")
def _(t):
    return features.unresolved(_with_genes(t), ["mRNA"])


@query("transcript_map", "SELECT DISTINCT 'o' || (o_orderkey % 7000) AS transcript_id, 'c' || o_custkey AS gene_id FROM orders")
def _(t):
    return features.transcript_map(_node_rows(t))


@query("transcript_map_by_gene", "SELECT 'c' || c_custkey AS transcript_id, 'c' || c_custkey AS gene_id FROM customer WHERE c_custkey % 10 <> 0")
def _(t):
    return features.transcript_map(_node_rows(t).where("type = 'gene'"))


@query(
    "choice_notes",
    """WITH c AS (SELECT count(*) AS n FROM orders), g AS (SELECT count(*) AS n FROM customer), v AS (SELECT count(*) AS n FROM supplier), k AS (SELECT count(DISTINCT o_orderkey) AS n FROM orders)
    SELECT 'groups_and_genes' AS note, k.n || ' vs ' || g.n AS detail FROM k, g WHERE abs(k.n - g.n) / g.n > 0.05 UNION ALL SELECT 'case_variants', CAST(v.n AS VARCHAR) FROM v""",
)
def _(t):
    part = lambda table, key, name: t.read(table).select(F.lit(name).alias("type"), F.create_map(F.lit("gene_id"), text(key)).alias("attrs"))
    rows = part("orders", "o_orderkey", "CDS").unionByName(part("supplier", "s_suppkey", "cds")).unionByName(part("customer", "c_custkey", "gene"))
    coverage = features.attribute_coverage(rows)
    return features.choice_notes(coverage, features.choose_feature_and_attribute(coverage))


@query("with_transcripts", "SELECT p_partkey, p_size % 6 AS path FROM part WHERE p_size % 6 IN (SELECT p_size % 6 FROM part WHERE p_partkey % 13 = 0 AND p_size % 2 = 0)")
def _(t):
    kind = F.when((F.col("p_partkey") % 13 == 0) & (F.col("p_size") % 2 == 0), "transcript").otherwise("exon")
    return readers.with_transcripts(t.read("part").select("p_partkey", (F.col("p_size") % 6).alias("path"), kind.alias("type"))).select("p_partkey", "path")


# Haplotypes


@query(
    "renamed_ids",
    """SELECT 's' || p_partkey || 'A' AS seq_id, 's' || p_partkey AS stem, 's' || p_partkey || '_A' AS new_id FROM part WHERE p_size % 4 <> 0""",
)
def _(t):
    last = F.when(F.col("p_size") % 4 == 0, "C").otherwise("A")
    return haplotypes.renamed_ids(t.read("part").select(F.concat(F.lit("s"), text("p_partkey"), last).alias("seq_id")), "A")


@query(
    "rename_rules",
    """WITH a AS (SELECT 's' || (p_partkey // 2) || CASE WHEN p_size % 9 = 0 THEN 'C' ELSE 'A' END AS id FROM part), b AS (SELECT 's' || p_partkey || CASE WHEN p_size % 8 = 0 THEN 'A' ELSE 'B' END AS id FROM part)
    SELECT 'wrong_letter' AS rule, id AS key, 'A' AS detail FROM a WHERE id NOT LIKE '%A' UNION ALL SELECT 'wrong_letter', id, 'B' FROM b WHERE id NOT LIKE '%B'
    UNION ALL SELECT 'collision', id[:-2] || '_A', CAST(count(*) AS VARCHAR) FROM a WHERE id LIKE '%A' GROUP BY id HAVING count(*) > 1""",
)
def _(t):
    a = t.read("part").select(F.concat(F.lit("s"), F.floor(F.col("p_partkey") / 2).cast("string"), F.when(F.col("p_size") % 9 == 0, "C").otherwise("A")).alias("seq_id"))
    b = t.read("part").select(F.concat(F.lit("s"), text("p_partkey"), F.when(F.col("p_size") % 8 == 0, "A").otherwise("B")).alias("seq_id"))
    return haplotypes.rename_problems(a, b)


@query(
    "unpaired_share",
    """+ g AS (SELECT DISTINCT gene_id FROM counts), u AS (SELECT gene_id FROM g WHERE gene_id NOT IN (SELECT ha_gene_id FROM pairs UNION ALL SELECT hb_gene_id FROM pairs))
    SELECT (SELECT count(*) FROM g) AS n_genes, count(*) AS n_unpaired, round(count(*) / (SELECT count(*) FROM g), 9) AS share, count(*) / (SELECT count(*) FROM g) > 0.3 AS warning FROM u""",
    "counts", "pairs",
)
def _(t):
    alone = haplotypes.split_by_haplotype(t.counts(), haplotypes.clean_pairs(t.pairs(), "ord"))[2]
    return haplotypes.unpaired_share(t.counts(), alone).withColumn("share", F.round("share", 9)).withColumn("n_unpaired", F.col("n_unpaired").cast("bigint"))


# Rules


@query(
    "analysis_contract",
    """WITH a AS (SELECT n_nationkey AS k, 'a' || n_nationkey AS id FROM nation), c AS (SELECT 'a' || (c_nationkey) AS id, 'c' || (c_custkey % 4) AS cid, c_custkey AS k FROM customer WHERE c_nationkey % 5 <> 4)
    SELECT 'mode' AS rule, id AS key, 'guess' AS detail FROM a WHERE k % 11 = 10 UNION ALL SELECT 'design_type', id, 'nested' FROM a WHERE k % 7 = 6 UNION ALL SELECT 'effect_test', id, 'wald' FROM a WHERE k % 6 = 5
    UNION ALL SELECT 'fdr_cut', id, '0' FROM a WHERE k % 8 = 7 UNION ALL SELECT 'lfc_cut', id, '-1' FROM a WHERE k % 9 = 8 UNION ALL SELECT 'seed', id, 'x' FROM a WHERE k % 10 = 9 UNION ALL SELECT 'variables', id, '' FROM a WHERE k % 4 = 3
    UNION ALL SELECT 'no_contrast', id, '' FROM a WHERE k % 11 <> 10 AND k % 2 = 0 AND id NOT IN (SELECT id FROM c) UNION ALL SELECT 'contrast_not_wanted', id, '' FROM a WHERE k % 11 <> 10 AND k % 2 = 1 AND id IN (SELECT id FROM c)
    UNION ALL SELECT 'contrast_basis', id || '|' || cid, 'row' FROM c WHERE k % 41 = 40 UNION ALL SELECT 'contrast_weight', id || '|' || cid, 'NaN' FROM c WHERE k % 43 = 42
    UNION ALL SELECT 'basis', id || '|' || cid, '' FROM c GROUP BY id, cid HAVING count(DISTINCT CASE WHEN k % 41 = 40 THEN 'row' ELSE 'coefficient' END) > 1""",
)
def _(t):
    k = F.col("n_nationkey")
    a = t.read("nation").select(
        F.concat(F.lit("a"), k.cast("string")).alias("analysis_id"), F.when(k % 11 == 10, "guess").when(k % 2 == 0, "inferential").otherwise("exploratory").alias("analysis_mode"),
        F.when(k % 7 == 6, "nested").otherwise("group").alias("design_type"), F.when(k % 6 == 5, "wald").otherwise("qlf").alias("effect_test"), F.when(k % 8 == 7, "0").otherwise("0.05").alias("fdr_cut"),
        F.when(k % 9 == 8, "-1").otherwise("1").alias("lfc_cut"), F.when(k % 10 == 9, "x").otherwise("7").alias("seed"), F.lit("day|treatment").alias("factor_cols"), F.when(k % 4 == 3, "day").otherwise("").alias("numeric_cols"),
    )
    j = F.col("c_custkey")
    c = t.read("customer").where("c_nationkey % 5 <> 4").select(
        F.concat(F.lit("a"), text("c_nationkey")).alias("analysis_id"), F.concat(F.lit("c"), (j % 4).cast("string")).alias("contrast_id"), F.when(j % 41 == 40, "row").otherwise("coefficient").alias("basis"), F.when(j % 43 == 42, "NaN").otherwise("1").alias("weight")
    )
    return validate.analysis_contract(a, c)


@query(
    "metadata_conflicts",
    "SELECT 'metadata' AS rule, 'i' || s_suppkey || '|mode' AS key, 'union vs strict' AS detail FROM supplier WHERE s_suppkey % 6 = 0 AND s_suppkey % 4 <> 0",
)
def _(t):
    k = F.col("s_suppkey")
    row = lambda value: t.read("supplier").select(F.concat(F.lit("i"), k.cast("string")).alias("input_id"), F.lit("mode").alias("field"), value.alias("value"))
    return validate.metadata_conflicts(row(F.when(k % 4 != 0, "union")), row(F.when(k % 6 == 0, "strict").otherwise("union")), ["input_id"])


@query("provenance_gaps", "SELECT 'provenance' AS rule, CAST(s_suppkey AS VARCHAR) AS key, '' AS detail FROM supplier WHERE s_suppkey % 3 = 0 OR s_suppkey % 5 = 0")
def _(t):
    k = F.col("s_suppkey")
    return validate.provenance_gaps(t.read("supplier").select(k.alias("input_id"), F.when(k % 3 != 0, "a").alias("input_sha256"), F.when(k % 5 != 0, "b").alias("annotation_sha256")))


@query(
    "mate_id_rules",
    "SELECT 'mate_ids' AS rule, 'f' || o_custkey || '_1' AS key, 'r' || min(o_orderkey) || ' vs ' || CASE WHEN o_custkey % 5 = 0 THEN 'q' ELSE 'r' END || min(o_orderkey) AS detail FROM orders WHERE o_custkey % 5 = 0 GROUP BY o_custkey",
)
def _(t):
    from pyspark.sql import Window

    order = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1
    o = t.read("orders").select("o_custkey", "o_orderkey", order.alias("ord"))
    file = lambda side: F.concat(F.lit("f"), text("o_custkey"), F.lit(side))
    left = o.select(file("_1").alias("path"), "ord", F.concat(F.lit("r"), text("o_orderkey")).alias("read_id"))
    right = o.select(file("_2").alias("path"), "ord", F.concat(F.when(F.col("o_custkey") % 5 == 0, "q").otherwise("r"), text("o_orderkey")).alias("read_id"))
    pairs = o.select(file("_1").alias("path"), file("_2").alias("mate")).distinct()
    return validate.mate_id_conflicts(pairs, left.unionByName(right))


# Inference


@query("cell_effect", EFFECT_SQL + ' SELECT gene_id, round(lfc, 6) AS "logFC" FROM g', "counts", "samples", "dense")
def _(t):
    rows = [r.asDict() for r in t.samples().orderBy("sample_id").collect()]
    factors = {"treatment": "control", "batch": "b0"}
    ids, names, x = inference.design_matrix(rows, factors)
    vector = inference.cell_contrast(names, [({"treatment": "treated", "batch": "b1"}, 1.0), ({"treatment": "control", "batch": "b1"}, -1.0)], factors)
    fitted = inference.fit(_dense(t), ids, x)
    return fitted.select("gene_id", F.round(sum(F.col("beta")[i] * float(v) for i, v in enumerate(np.asarray(vector))), 6).alias("logFC"))


# Whole assays


@query(
    "import_problems",
    """+ u AS (SELECT sample_id, (SELECT count(DISTINCT gene_id) FROM counts) - count(DISTINCT gene_id) AS m FROM counts GROUP BY 1)
    SELECT 'gene_sets_differ' AS rule, sample_id AS key, CAST(m AS VARCHAR) AS detail FROM u WHERE m > 0 UNION ALL SELECT 'not_one_to_one', k, '' FROM (VALUES ('S24'), ('SX')) x(k)
    UNION ALL SELECT 'disjoint', 'T' || (number // 2), '' FROM samples WHERE number = 6""",
    "counts", "samples",
)
def _(t):
    return _imported(t).problems


@query(
    "import_groups",
    """+ s AS (SELECT sample_id, CAST(sum(n) AS BIGINT) AS a FROM counts GROUP BY 1), c AS (SELECT sample_id, CAST(sum(n) AS BIGINT) AS b, count(*) AS k FROM counters GROUP BY 1),
    m AS (SELECT sample_id, CASE WHEN number < 20 THEN 'T' || (number // 2) ELSE sample_id END AS merge_id, a, CASE WHEN k = 5 THEN a + b END AS p FROM s LEFT JOIN c USING (sample_id) JOIN samples USING (sample_id))
    SELECT merge_id, count(*) AS n_members, CAST(sum(a) AS BIGINT) AS numerator, CASE WHEN count(p) = count(*) THEN CAST(sum(p) AS BIGINT) END AS denominator FROM m GROUP BY 1""",
    "counts", "counters", "samples",
)
def _(t):
    return _imported(t).groups.select("merge_id", "n_members", "numerator", "denominator")


def _imported(t):
    from .plans import project

    k = F.col("number")
    merge = F.when(k < 20, F.concat(F.lit("T"), F.floor(k / 2).cast("string")))
    listed = t.samples().where("number <> 24").select("sample_id", "number")
    listed = listed.unionByName(listed.where("number = 0").select(F.lit("SX").alias("sample_id"), F.lit(99).alias("number")))
    samples = listed.select(
        "sample_id", F.lit("i").alias("input_id"), F.col("sample_id").alias("source_sample_id"), F.lit("true").alias("include_analysis"), F.lit("").alias("exclusion_reason"),
        merge.alias("technical_merge_id"), (k % 2).alias("technical_partition_id"), F.when(k == 6, "no").otherwise("true").alias("technical_disjoint"),
    )
    inputs = t.spark.createDataFrame([("i", "x.tsv", "exclusive", None)], "input_id string, path string, count_mode string, sha256 string")
    return project.import_assay(t.counts(), t.counters(), samples, inputs)
