"""The driver's tables seen as counts, hits, genes, reads and evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The counter each event type stands for.
COUNTER_OF = {"view": "no_feature", "click": "ambiguous", "error": "too_low_aQual", "purchase": "not_aligned", "signup": "alignment_not_unique"}


class Tables:
    """Views of one folder of driver tables; nothing is read before it is used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def counts(self) -> DataFrame:
        """``sample_id`` from the supplier's nation, ``gene_id`` from the part, ``n`` the summed quantity."""
        li, s = self.read("lineitem"), self.read("supplier")
        key = [F.concat(F.lit("S"), F.col("s_nationkey").cast("string")).alias("sample_id"), F.concat(F.lit("g"), F.col("l_partkey").cast("string")).alias("gene_id")]
        return li.join(s, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(*key).agg(F.sum("l_quantity").cast("bigint").alias("n"))

    def dense_counts(self) -> DataFrame:
        """Counts of every sample and part, as a counter writes them: 0 where a library has no read."""
        names = [r["sample_id"] for r in self.samples().select("sample_id").collect()]
        genes = self.read("part").select(F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("gene_id"))
        grid = genes.select("gene_id", F.explode(F.array(*map(F.lit, sorted(names)))).alias("sample_id"))
        return grid.join(self.counts(), ["gene_id", "sample_id"], "left").select("sample_id", "gene_id", F.coalesce("n", F.lit(0)).alias("n"))

    def samples(self) -> DataFrame:
        n, r = self.read("nation"), self.read("region")
        return n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("sample_id"),
            F.when(F.col("n_regionkey") % 2 == 0, "control").otherwise("treated").alias("treatment"),
            F.concat(F.lit("b"), (F.col("n_nationkey") % 3).cast("string")).alias("batch"),
            F.col("r_name").alias("region"),
            F.col("n_nationkey").alias("number"),
        )

    def counters(self) -> DataFrame:
        names = F.create_map(*[F.lit(x) for kv in COUNTER_OF.items() for x in kv])
        sample = F.concat(F.lit("S"), (F.col("user_id") % 25).cast("string"))
        return self.read("events").groupBy(sample.alias("sample_id"), names[F.col("event_type")].alias("category")).agg(F.count(F.lit(1)).alias("n"))

    def tx_map(self) -> DataFrame:
        return self.read("part").where("p_partkey % 10 <> 0").select(F.col("p_partkey").cast("string").alias("transcript_id"), F.col("p_brand").alias("gene_id"))

    def quant(self) -> DataFrame:
        li, s = self.read("lineitem"), self.read("supplier")
        return li.join(s, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(
            F.concat(F.lit("S"), F.col("s_nationkey").cast("string")).alias("sample_id"), F.col("l_partkey").cast("string").alias("transcript_id")
        ).agg(F.sum("l_quantity").alias("num_reads"))

    def hits(self) -> DataFrame:
        return self.read("lineitem").select(
            F.col("l_partkey").alias("query_id"),
            F.col("l_suppkey").alias("subject_id"),
            (20 + 800 * F.col("l_discount")).alias("pident"),
            (F.col("l_tax") * 2e-4).alias("evalue"),
            F.floor(F.col("l_extendedprice") / 1000).alias("bitscore"),
            "l_orderkey",
            "l_linenumber",
        )

    def genes(self) -> DataFrame:
        start = 1000 * F.floor(F.col("p_partkey") / 7) + 1
        return self.read("part").select(
            F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("gene_id"),
            (F.col("p_partkey") % 7).alias("chrom"),
            start.alias("start"),
            (start + 30 * F.col("p_size")).alias("end"),
            F.when(F.col("p_size") % 2 == 0, "+").otherwise("-").alias("strand"),
        )

    def snps(self) -> DataFrame:
        pick = lambda t: F.substring(F.lit("ACGTN"), F.pmod(F.col("event_id") * t + F.col("user_id"), F.lit(5)).cast("int") + 1, F.lit(1))
        return self.read("events").select(
            (F.col("user_id") % 7).alias("chrom"), ((F.col("event_id") * 37) % 300_000 + 1).alias("pos"), pick(1).alias("ref"), pick(3).alias("alt"), "event_id"
        )

    def blocks(self) -> DataFrame:
        start = 1000 * (F.col("o_orderkey") % 280)
        return self.read("orders").select(
            F.col("o_orderkey").alias("block_id"), (F.col("o_custkey") % 7).alias("chrom"), start.alias("start"), (start + 5000).alias("end"), (F.col("o_orderstatus") == "F").alias("inverted")
        )

    def pairs(self) -> DataFrame:
        return self.read("part").where("p_partkey % 2 = 0 AND (p_partkey div 2) % 5 <> 0").select(
            F.concat(F.lit("g"), F.col("p_partkey").cast("string")).alias("ha_gene_id"), F.concat(F.lit("g"), (F.col("p_partkey") + 1).cast("string")).alias("hb_gene_id"), F.col("p_partkey").alias("ord")
        )

    def proteins(self) -> DataFrame:
        return self.read("documents").select(F.col("doc_id").alias("protein_id"), "lang", "source", "text")

    def evidence(self) -> dict[str, DataFrame]:
        d = self.proteins()
        label = self.read("labels").where("quality = 1").select(F.col("doc_id").alias("protein_id"))
        first = F.substring_index(F.trim(F.col("text")), " ", 1)
        return {
            "funannotate2": d.where("protein_id % 11 = 0").select("protein_id", F.lit("Hypothetical protein").alias("product")).unionByName(
                d.where("protein_id % 17 = 0").select("protein_id", F.concat(F.lit("kinase "), "source").alias("product"))
            ),
            "swissprot": d.join(label, "protein_id", "left_semi").where("protein_id % 3 = 0").select("protein_id", first.alias("product")),
            "eggnog": d.where("protein_id % 4 = 1").select("protein_id", F.when(F.col("lang") == "en", "-").otherwise(F.concat(F.lit("domain "), "lang")).alias("product")),
            "dbcan": d.where("protein_id % 9 = 2").select("protein_id", F.lit("GH1").alias("product")),
            "interpro": d.where("protein_id % 5 = 2").select("protein_id", F.col("source").alias("product")),
        }

    def reads(self) -> DataFrame:
        """Conversations as reads: user turns are first mates, the assistant's second."""
        return self.read("conversations").where("role <> 'system'").select(
            F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") - F.col("turn") % 2).cast("string")).alias("read_id"),
            F.when(F.col("role") == "user", 1).otherwise(2).alias("mate"),
            F.coalesce("text", F.lit("")).alias("seq"),
            "conv_id",
            "turn",
        )

    def alignments(self) -> DataFrame:
        """Order lines as reads on parts' chromosomes: ungapped, with flags, qualities and multiplicity."""
        k = F.col("l_orderkey")
        start = 1000 * F.floor(F.col("l_partkey") / 7) + 1 + (k % 900)
        return self.read("lineitem").select(
            F.concat_ws(":", k.cast("string"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("read_id"),
            (F.col("l_partkey") % 7).alias("chrom"),
            start.alias("start"),
            (start + F.col("l_quantity").cast("bigint")).alias("end"),
            F.when(k % 2 == 0, "+").otherwise("-").alias("strand"),
            (F.col("l_suppkey") % 40).alias("mapq"),
            F.when(k % 13 == 0, 2).otherwise(1).alias("nh"),
            (k % 17 != 0).alias("mapped"),
            F.col("l_suppkey").alias("library"),
            (F.when(k % 17 == 0, 4).otherwise(0) + F.when(k % 2 == 0, 0).otherwise(16) + F.when(k % 19 == 0, 256).otherwise(0) + F.when(k % 23 == 0, 1024).otherwise(0)).cast("int").alias("flag"),
        )

    def expression(self) -> DataFrame:
        """Embeddings as samples and their positions as genes."""
        return self.read("embeddings").select(F.col("vec_id").alias("sample_id"), "label", F.posexplode("embedding").alias("gene_id", "v")).select(
            "sample_id", "label", "gene_id", F.col("v").cast("double").alias("logcpm")
        )


#: DuckDB definitions of the same views.
SQL = {
    "counts": """SELECT 'S' || s_nationkey AS sample_id, 'g' || l_partkey AS gene_id, CAST(sum(l_quantity) AS BIGINT) AS n
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL""",
    "samples": """SELECT 'S' || n_nationkey AS sample_id, CASE WHEN n_regionkey % 2 = 0 THEN 'control' ELSE 'treated' END AS treatment,
        'b' || (n_nationkey % 3) AS batch, r_name AS region, n_nationkey AS number FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "dense": """SELECT sample_id, gene_id, coalesce(n, 0) AS n FROM samples CROSS JOIN (SELECT 'g' || p_partkey AS gene_id FROM part) LEFT JOIN counts USING (sample_id, gene_id)""",
    "counters": """SELECT 'S' || (user_id % 25) AS sample_id, CASE event_type WHEN 'view' THEN 'no_feature' WHEN 'click' THEN 'ambiguous'
        WHEN 'error' THEN 'too_low_aQual' WHEN 'purchase' THEN 'not_aligned' WHEN 'signup' THEN 'alignment_not_unique' END AS category,
        count(*) AS n FROM events GROUP BY ALL""",
    "tx_map": "SELECT CAST(p_partkey AS VARCHAR) AS transcript_id, p_brand AS gene_id FROM part WHERE p_partkey % 10 <> 0",
    "quant": """SELECT 'S' || s_nationkey AS sample_id, CAST(l_partkey AS VARCHAR) AS transcript_id, sum(l_quantity) AS num_reads
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL""",
    "hits": """SELECT l_partkey AS query_id, l_suppkey AS subject_id, 20 + 800 * l_discount AS pident, l_tax * 2e-4 AS evalue,
        CAST(floor(l_extendedprice / 1000) AS BIGINT) AS bitscore, l_orderkey, l_linenumber FROM lineitem""",
    "genes": """SELECT 'g' || p_partkey AS gene_id, p_partkey % 7 AS chrom, 1000 * (p_partkey // 7) + 1 AS "start",
        1000 * (p_partkey // 7) + 1 + 30 * p_size AS "end", CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand FROM part""",
    "snps": """SELECT user_id % 7 AS chrom, (event_id * 37) % 300000 + 1 AS pos, substr('ACGTN', CAST((event_id + user_id) % 5 AS INT) + 1, 1) AS ref,
        substr('ACGTN', CAST((event_id * 3 + user_id) % 5 AS INT) + 1, 1) AS alt, event_id FROM events""",
    "blocks": """SELECT o_orderkey AS block_id, o_custkey % 7 AS chrom, 1000 * (o_orderkey % 280) AS "start", 1000 * (o_orderkey % 280) + 5000 AS "end",
        o_orderstatus = 'F' AS inverted FROM orders""",
    "pairs": """SELECT 'g' || p_partkey AS ha_gene_id, 'g' || (p_partkey + 1) AS hb_gene_id, p_partkey AS ord FROM part
        WHERE p_partkey % 2 = 0 AND (p_partkey // 2) % 5 <> 0""",
    "reads": """SELECT conv_id || ':' || (turn - turn % 2) AS read_id, CASE WHEN role = 'user' THEN 1 ELSE 2 END AS mate, coalesce(text, '') AS seq, conv_id, turn
        FROM conversations WHERE role <> 'system'""",
    "alignments": """SELECT l_orderkey || ':' || l_partkey || ':' || l_suppkey AS read_id, l_partkey % 7 AS chrom,
        1000 * (l_partkey // 7) + 1 + l_orderkey % 900 AS "start", 1000 * (l_partkey // 7) + 1 + l_orderkey % 900 + CAST(l_quantity AS BIGINT) AS "end",
        CASE WHEN l_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand, l_suppkey % 40 AS mapq, CASE WHEN l_orderkey % 13 = 0 THEN 2 ELSE 1 END AS nh,
        l_orderkey % 17 <> 0 AS mapped, l_suppkey AS library,
        CAST(CASE WHEN l_orderkey % 17 = 0 THEN 4 ELSE 0 END + CASE WHEN l_orderkey % 2 = 0 THEN 0 ELSE 16 END + CASE WHEN l_orderkey % 19 = 0 THEN 256 ELSE 0 END
        + CASE WHEN l_orderkey % 23 = 0 THEN 1024 ELSE 0 END AS INT) AS flag FROM lineitem""",
    "expression": """SELECT vec_id AS sample_id, label, CAST(i AS INT) AS gene_id, CAST(embedding[i + 1] AS DOUBLE) AS logcpm
        FROM embeddings, range(0, 64) t(i)""",
}


def with_views(query: str, *names: str) -> str:
    """DuckDB SQL of ``query`` over the named views."""
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in names) + ("," if query.lstrip().startswith("+") else "\n") + query.lstrip().removeprefix("+")
