"""Queries over intervals of very different lengths and over fragments of two mates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import intervals
from .plans.bindings import Tables
from .registry import query

# Intervals as long as a chromosome beside short ones

LONG = 'long AS (SELECT * FROM genes UNION ALL SELECT \'long\' || c, c, 1, 1000000000, CASE WHEN c % 2 = 0 THEN \'+\' ELSE \'-\' END FROM range(0, 6, 2) r(c))'


def _long(t: Tables) -> DataFrame:
    c = F.col("id")
    whole = t.spark.range(0, 6, 2).select(
        F.concat(F.lit("long"), c.cast("string")).alias("gene_id"), c.cast("int").alias("chrom"), F.lit(1).alias("start"), F.lit(1_000_000_000).alias("end"), F.when(c % 2 == 0, "+").otherwise("-").alias("strand")
    )
    return t.genes().unionByName(whole)


@query("snp_in_long_gene", f'+ {LONG} SELECT event_id, chrom, pos FROM snps s WHERE EXISTS (SELECT 1 FROM long g WHERE g.chrom = s.chrom AND s.pos BETWEEN g."start" AND g."end")', "snps", "genes")
def _(t):
    return intervals.points_in(t.snps(), _long(t), ["chrom"], "pos", 2000).select("event_id", "chrom", "pos")


@query(
    "snp_outside_long_gene",
    f'+ {LONG} SELECT event_id, chrom, pos FROM snps s WHERE NOT EXISTS (SELECT 1 FROM long g WHERE g.chrom = s.chrom AND s.pos BETWEEN g."start" AND g."end")',
    "snps", "genes",
)
def _(t):
    return intervals.points_in(t.snps(), _long(t), ["chrom"], "pos", 2000, anti=True).select("event_id", "chrom", "pos")


LONG_BLOCKS = """+ long AS (SELECT block_id, chrom, "start", "end" FROM blocks WHERE block_id % 5 = 0 UNION ALL SELECT -c, c, 900000000, 0 FROM range(1, 6, 2) r(c))"""


@query(
    "genes_in_long_block",
    LONG_BLOCKS + """ SELECT block_id, gene_id, g.chrom, g."start", g."end" FROM long b JOIN genes g ON g.chrom = b.chrom AND g."start" >= least(b."start", b."end") AND g."end" <= greatest(b."start", b."end")""",
    "blocks", "genes",
)
def _(t):
    c = F.col("id")
    whole = t.spark.range(1, 6, 2).select((-c).alias("block_id"), c.alias("chrom"), F.lit(900_000_000).alias("start"), F.lit(0).alias("end"))
    blocks = t.blocks().where("block_id % 5 = 0").select("block_id", "chrom", "start", "end").unionByName(whole)
    return intervals.genes_in_blocks(t.genes(), blocks, 5000)


@query(
    "overlaps_of_all_lengths",
    """+ b AS (SELECT block_id, chrom, "start", "start" + CASE block_id % 4 WHEN 0 THEN 10 WHEN 1 THEN 700 WHEN 2 THEN 60000 ELSE 5000 END AS "end" FROM blocks WHERE block_id % 16 < 4)
    SELECT block_id, gene_id, b."start", g."end" FROM b JOIN genes g ON g.chrom = b.chrom AND b."start" <= g."end" AND g."start" <= b."end" """,
    "blocks", "genes",
)
def _(t):
    k = F.col("block_id") % 4
    size = F.when(k == 0, 10).when(k == 1, 700).when(k == 2, 60_000).otherwise(5000)
    blocks = t.blocks().where("block_id % 16 < 4").select("block_id", "chrom", "start", (F.col("start") + size).alias("end"))
    genes = t.genes().select("gene_id", "chrom", F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    return intervals.overlap_join(blocks, genes, ["chrom"], 300).select("block_id", "gene_id", "start", F.col("r_end").alias("end"))


# Fragments of two mates, whose statuses differ

MATES = """mates AS (SELECT l_orderkey || ':' || l_linenumber AS read_id, l_partkey % 7 AS chrom, 1000 * (l_partkey // 7) + 1 + l_orderkey % 900 + m * ((l_orderkey * 7) % 200) AS "start",
        1000 * (l_partkey // 7) + 1 + l_orderkey % 900 + m * ((l_orderkey * 7) % 200) + CAST(l_quantity AS BIGINT) AS "end", CASE WHEN l_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand,
        CASE m WHEN 0 THEN l_suppkey % 40 ELSE l_partkey % 40 END AS mapq, CASE WHEN (l_orderkey + m * l_linenumber) % 13 = 0 THEN 2 ELSE 1 END AS nh, (l_orderkey + m) % (17 - 11 * m) <> 0 AS mapped
      FROM lineitem, range(2) r(m)),
    st AS (SELECT read_id, CASE WHEN NOT bool_or(mapped) THEN '__not_aligned' WHEN max(nh) FILTER (mapped) > 1 THEN '__alignment_not_unique' WHEN min(mapq) FILTER (mapped) < 10 THEN '__too_low_aQual' END AS status FROM mates GROUP BY 1)"""


def mates(t: Tables) -> DataFrame:
    """Order lines as pairs: a mate where ``alignments`` has it and one up to 200 bases on, with quality, places and status of its own."""
    k, m = F.col("l_orderkey"), F.col("m")
    start = 1000 * F.floor(F.col("l_partkey") / 7) + 1 + (k % 900) + m * ((k * 7) % 200)
    rows = t.read("lineitem").select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("m"))
    return rows.select(
        F.concat_ws(":", k.cast("string"), F.col("l_linenumber").cast("string")).alias("read_id"), (F.col("l_partkey") % 7).alias("chrom"), start.alias("start"),
        (start + F.col("l_quantity").cast("bigint")).alias("end"), F.when(k % 2 == 0, "+").otherwise("-").alias("strand"),
        F.when(m == 0, F.col("l_suppkey") % 40).otherwise(F.col("l_partkey") % 40).alias("mapq"), F.when((k + m * F.col("l_linenumber")) % 13 == 0, 2).otherwise(1).alias("nh"),
        ((k + m) % (17 - 11 * m) != 0).alias("mapped"),
    )


@query("fragment_status", f"WITH {MATES} SELECT * FROM st")
def _(t):
    return intervals.fragment_status(mates(t))


#: Every position of a fragment with the genes there: the sets that the modes are about, position by position.
POSITIONS = """, p AS (SELECT DISTINCT read_id, chrom, strand, unnest(range("start", "end" + 1)) AS p FROM mates JOIN st USING (read_id) WHERE status IS NULL AND mapped),
    g AS (SELECT *, unnest(range("start" // 1000, "end" // 1000 + 1)) AS bucket FROM genes),
    h AS (SELECT DISTINCT read_id, p.chrom, p, gene_id FROM p JOIN g ON g.chrom = p.chrom AND g.bucket = p.p // 1000 AND p.p BETWEEN g."start" AND g."end" AND {side}),
    per AS (SELECT read_id, gene_id, count(*) AS c FROM h GROUP BY 1, 2),
    asked AS (SELECT read_id, {asked} AS c FROM {of} GROUP BY 1),
    held AS (SELECT read_id, gene_id FROM per JOIN asked USING (read_id) WHERE per.c >= asked.c),
    size AS (SELECT read_id, count(*) AS k, min(gene_id) AS g FROM held GROUP BY 1)"""
WHOLE = """ SELECT category, count(*) AS n FROM (SELECT coalesce(status, CASE WHEN k IS NULL THEN '__no_feature' WHEN k > 1 THEN '__ambiguous' ELSE g END) AS category FROM st LEFT JOIN size USING (read_id)) GROUP BY 1"""
SHARES = """ SELECT category, sum(n) AS n FROM (SELECT gene_id AS category, 1.0::DOUBLE / k AS n FROM held JOIN size USING (read_id)
    UNION ALL SELECT coalesce(status, '__no_feature'), 1.0 FROM st LEFT JOIN size USING (read_id) WHERE k IS NULL) GROUP BY 1"""
ASKED = {"union": ("1", "h"), "intersection-strict": ("count(*)", "p"), "intersection-nonempty": ("count(DISTINCT chrom || ':' || p)", "h")}
SIDES = {"forward": "g.strand = p.strand", "reverse": "g.strand <> p.strand", "unstranded": "true"}


def _fragments(name: str, mode: str, stranded: str, fractional: bool = False) -> None:
    asked, of = ASKED[mode]
    sql = "+ " + MATES + POSITIONS.format(side=SIDES[stranded], asked=asked, of=of) + (SHARES if fractional else WHOLE)

    @query(name, sql, "genes")
    def _(t):
        return intervals.count_features(mates(t), t.genes(), 2000, stranded=stranded, mode=mode, fractional=fractional)


_fragments("feature_counting_union_mates", "union", "forward")
_fragments("feature_counting_strict", "intersection-strict", "unstranded")
_fragments("feature_counting_nonempty", "intersection-nonempty", "unstranded")
_fragments("feature_counting_strict_reverse", "intersection-strict", "reverse")
_fragments("feature_counting_fractional", "union", "unstranded", fractional=True)


@query(
    "feature_counting_long_gene",
    "+ " + LONG + ", " + MATES + """, h AS (SELECT read_id, count(DISTINCT gene_id) AS k, min(gene_id) AS g FROM mates m JOIN st USING (read_id)
        JOIN long g ON g.chrom = m.chrom AND g.strand = m.strand AND m."start" <= g."end" AND g."start" <= m."end" WHERE status IS NULL AND mapped GROUP BY 1)
    SELECT category, count(*) AS n FROM (SELECT coalesce(status, CASE WHEN k IS NULL THEN '__no_feature' WHEN k > 1 THEN '__ambiguous' ELSE g END) AS category FROM st LEFT JOIN h USING (read_id)) GROUP BY 1""",
    "genes",
)
def _(t):
    return intervals.count_features(mates(t), _long(t), 2000)
