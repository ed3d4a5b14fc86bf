"""Functional annotation: best hits, the product ladder, votes and evidence tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Descriptions that say nothing, and the order in which sources name a product.
PLACEHOLDERS = (
    "", "-", "n/a", "na", "unknown", "unnamed protein product", "uncharacterized protein", "hypothetical protein",
)
LADDER = ("funannotate2", "swissprot", "eggnog", "interpro")
EVIDENCE = ("funannotate2", "swissprot", "eggnog", "dbcan", "interpro")
UNNAMED = ("eggnog", "dbcan")
HYPOTHETICAL = "hypothetical protein"


def informative(c: Column) -> Column:
    """The trimmed description, null if it is a placeholder."""
    return F.when(~F.lower(F.trim(F.coalesce(c, F.lit("")))).isin(*PLACEHOLDERS), F.trim(c))


def best_hit(hits: DataFrame, least_identity: float = 30.0, most_evalue: float = 1e-5, order: list[str] | None = None) -> DataFrame:
    """Per query of ``hits(query_id, subject_id, pident, evalue, bitscore, ...)`` the hit of the highest score, the first in ``order`` on ties.

    An aggregate of one struct per query: filters reach the scan, partial maxima are combined before the shuffle.
    """
    keep = hits.where((F.col("pident") >= least_identity) & (F.col("evalue") <= most_evalue))
    others = [c for c in hits.columns if c != "query_id"]
    key = F.struct((-F.col("bitscore")).alias("s"), *[F.col(c) for c in (order or ["ord"])])
    best = keep.groupBy("query_id").agg(F.min_by(F.struct(*others), key).alias("h"))
    return best.select("query_id", "h.*")


def accession(subject: Column) -> Column:
    """Middle part of ``db|accession|entry``, else the whole id."""
    return F.when(F.size(F.split(subject, r"\|")) >= 3, F.split_part(subject, F.lit("|"), F.lit(2))).otherwise(subject)


def describe_hits(hits: DataFrame, headers: DataFrame) -> DataFrame:
    """Hits with their subject's description; subjects without a header describe themselves."""
    h = headers.select(F.col("accession").alias("__acc"), F.col("description").alias("__text"))
    return hits.join(h, accession(F.col("subject_id")) == F.col("__acc"), "left").select(
        *hits.columns, F.coalesce("__text", "subject_id").alias("description")
    )


def parse_uniprot_header(header: Column) -> Column:
    """Struct of database, accession, entry, description and organism of a FASTA header; others keep the text as description."""
    pattern = r"^>?(sp|tr)\|([^|]+)\|(\S+)\s+(.*?)(?:\s+OS=(.*?))?(?:\s+(?:OX|GN|PE|SV)=.*)?$"
    part = lambda i: F.nullif(F.regexp_extract(header, pattern, i), F.lit(""))
    return F.struct(
        part(1).alias("db"), part(2).alias("accession"), part(3).alias("entry"), F.coalesce(part(4), F.ltrim(F.regexp_replace(header, "^>", ""))).alias("description"), part(5).alias("organism")
    )


def eggnog_product(description: Column, preferred_name: Column) -> Column:
    """The description unless empty or a dash, else the preferred name; a placeholder is no product."""
    empty = F.coalesce(F.trim(description), F.lit("")).isin("", "-")
    return informative(F.when(empty, preferred_name).otherwise(description))


def product_table(proteins: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """Product, its source and the evidence of every protein.

    Each of ``sources`` has ``protein_id, product`` and, where order counts, ``ord``; a source that is absent is left out of the
    dict. Of a protein's rows in a source the last with an informative product counts (without ``ord`` the greatest text).
    The first source of the ladder that has one names the protein. Such sources are evidence, and so is any row of
    the two that annotate without naming.
    """
    df = proteins.select("protein_id")
    for name, table in sources.items():
        named, order = informative(F.col("product")), F.col("ord" if "ord" in table.columns else "product")
        one = table.groupBy("protein_id").agg(F.max_by(named, F.when(named.isNotNull(), F.struct(order, named))).alias(f"p_{name}"))
        df = df.join(one.withColumn(f"e_{name}", F.lit(True) if name in UNNAMED else F.col(f"p_{name}").isNotNull()), "protein_id", "left")
    named = [n for n in LADDER if n in sources]
    source = F.coalesce(*[F.when(F.col(f"p_{n}").isNotNull(), n) for n in named], F.lit("none"))
    evidence = F.array_compact(F.array(*[F.when(F.col(f"e_{n}"), F.lit(n)) for n in EVIDENCE if n in sources]))
    return df.select(
        "protein_id",
        F.coalesce(*[F.col(f"p_{n}") for n in named], F.lit(HYPOTHETICAL)).alias("product"),
        source.alias("product_source"),
        F.array_join(evidence, ",").alias("evidence"),
        F.size(evidence).alias("n_evidence"),
    )


def product_quality(products: DataFrame, most_hypothetical: float = 0.5) -> DataFrame:
    """Rows per source with their share, and whether unnamed products exceed the limit."""
    total = products.count()
    n = F.count(F.lit(1))
    return products.groupBy("product_source").agg(n.alias("n"), F.round(n / F.lit(float(max(total, 1))), 4).alias("fraction")).withColumn(
        "flagged", (F.col("product_source") == "none") & (F.col("fraction") > most_hypothetical)
    )


def evidence_tags(products: DataFrame) -> DataFrame:
    """Proteins per evidence tag."""
    return products.select(F.explode(F.split("evidence", ",")).alias("tag")).where("tag <> ''").groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


def secretome(proteins: DataFrame, votes: DataFrame, membranes: DataFrame, tools_run: int, least_tools: int = 2) -> DataFrame:
    """Secreted if enough tools call a signal peptide and none a membrane span.

    ``votes(protein_id, tool, call)``, a call that begins with SP counts; ``membranes(protein_id, n_tm)``.
    ``secreted`` is null if no tool ran.
    """
    need = max(min(least_tools, tools_run), 1)
    sp = votes.groupBy("protein_id").agg(F.count_if(F.col("call").startswith("SP")).alias("votes"))
    tm = membranes.groupBy("protein_id").agg(F.max("n_tm").alias("n_tm"))
    df = proteins.select("protein_id").join(sp, "protein_id", "left").join(tm, "protein_id", "left").na.fill(0, ["votes", "n_tm"])
    verdict = (F.col("votes") >= need) & (F.col("n_tm") == 0) if tools_run else F.lit(None).cast("boolean")
    return df.withColumn("secreted", verdict)


def _one_row(rows: DataFrame, cells: list[str], first: bool) -> DataFrame:
    """A row per protein: the last by ``at``, or the first; without ``at`` that of the greatest cells, or the least, so that runs agree."""
    pick, place = (F.min_by if first else F.max_by), F.col("at") if "at" in rows.columns else F.struct(*cells)
    return rows.groupBy("protein_id").agg(pick(F.struct(*cells), place).alias("c")).select("protein_id", "c.*")


def predictor_table(proteins: DataFrame, tools: dict[str, DataFrame], least_tools: int = 2) -> DataFrame:
    """Every protein beside the predictors that ran, with their defaults, and the secretome vote.

    ``tools`` holds those that ran: ``signalp6(call)``, ``targetp2(call)``, ``deeploc2(compartment, signals)``, ``deeptmhmm(kind, n_tm)``,
    ``phobius(n_tm, call)``, ``effectorp(call)`` and ``merops(family)``, each with ``protein_id``. The first five vote on the signal
    peptide. Of several rows of a protein the last by ``at`` counts, of ``merops`` the first. A protein is secreted if enough of them call one and none sees a membrane span, unknown if none ran. An effector
    call is shown only for secreted proteins.
    """
    df, votes, spans, shown = proteins.select("protein_id"), [], [], []
    shape = {"signalp6": ["call"], "targetp2": ["call"], "deeploc2": ["compartment", "signals"], "deeptmhmm": ["kind", "n_tm"], "phobius": ["n_tm", "call"], "effectorp": ["call"], "merops": ["family"]}
    one = {name: _one_row(rows, shape[name], first=name == "merops") for name, rows in tools.items() if name in shape}
    for name, cells in shape.items():
        if name in one:
            df = df.join(one[name].select("protein_id", *[F.col(c).alias(f"{name}_{c}") for c in cells]), "protein_id", "left")
    cell = lambda name, default: F.coalesce(F.col(name), F.lit(default))
    if "signalp6" in one:
        hit = cell("signalp6_call", "OTHER") != "OTHER"
        votes.append(hit)
        shown.append(F.when(hit, "SP").otherwise("-").alias("signalp6"))
    if "targetp2" in one:
        votes.append(cell("targetp2_call", "noTP") == "SP")
        shown.append(cell("targetp2_call", "noTP").alias("targetp2"))
    if "deeploc2" in one:
        votes.append(F.contains(cell("deeploc2_signals", ""), F.lit("Signal peptide")))
        shown.append(F.coalesce(F.nullif("deeploc2_compartment", F.lit("")), F.lit("-")).alias("deeploc2"))
    if "deeptmhmm" in one:
        votes.append(cell("deeptmhmm_kind", "").startswith("SP"))
        spans.append(cell("deeptmhmm_n_tm", 0))
        shown.append(F.concat_ws(":", cell("deeptmhmm_kind", ""), spans[-1].cast("string")).alias("deeptmhmm"))
    if "phobius" in one:
        votes.append(cell("phobius_call", "-") == "SP")
        spans.append(cell("phobius_n_tm", 0))
        shown.append(F.concat(F.lit("SP="), F.when(votes[-1], "Y").otherwise("N"), F.lit(";TM="), spans[-1].cast("string")).alias("phobius"))
    n = sum((v.cast("int") for v in votes), F.lit(0))
    tm = F.greatest(F.lit(0), F.lit(0), *spans).cast("int")
    need = max(min(least_tools, len(votes)), 1)
    secreted = (n >= need) & (tm == 0) if votes else F.lit(None).cast("boolean")
    out = [*shown, n.alias("n_sp_tools"), tm.alias("n_tm"), F.coalesce(F.when(secreted, "yes").when(~secreted, "no"), F.lit("NA")).alias("secreted")]
    if "effectorp" in one:
        out.append(F.when(secreted, cell("effectorp_call", "-")).otherwise("-").alias("effectorp"))
    if "merops" in one:
        out.append(cell("merops_family", "-").alias("merops"))
    return df.select("protein_id", *out)


def localization(proteins: DataFrame, secreted: DataFrame, effectors: DataFrame, compartments: DataFrame) -> DataFrame:
    """Compartment of each protein with defaults ``-``; an effector is shown only if it is secreted."""
    df = proteins.select("protein_id").join(secreted, "protein_id", "left")
    df = df.join(compartments.select("protein_id", "compartment"), "protein_id", "left").join(effectors.select("protein_id", F.lit(True).alias("e")), "protein_id", "left")
    return df.select(
        "protein_id",
        F.coalesce("compartment", F.lit("-")).alias("compartment"),
        "secreted",
        F.when(F.col("secreted") & F.col("e"), "effector").otherwise("-").alias("effector"),
    )


def family_set(*callers: Column) -> Column:
    """Families of several callers' cells: text before ``+``, then before ``(``; distinct, sorted, joined by ``;``."""
    names = [F.trim(F.substring_index(F.substring_index(F.coalesce(c, F.lit("")), "+", 1), "(", 1)) for c in callers]
    found = F.array_sort(F.array_distinct(F.filter(F.array(*names), lambda x: ~x.isin("", "-"))))
    return F.array_join(found, ";")


def family_calls(overview: DataFrame) -> DataFrame:
    """``protein_id, family, n_tools`` of ``overview(protein_id, hmmer, ecami, diamond, n_tools)``: proteins with a family or a tool.

    The number of tools is what the table says, else that of the different families.
    """
    family = family_set(F.col("hmmer"), F.col("ecami"), F.col("diamond"))
    size = F.when(family == "", 0).otherwise(F.size(F.split(family, ";"))).cast("string")
    out = overview.select("protein_id", family.alias("family"), F.coalesce(F.trim("n_tools"), size).alias("n_tools"))
    return out.where("family <> '' OR n_tools NOT IN ('', '0')")


def mapped_annotation(annotation: DataFrame, id_map: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Annotation rows under the ids of ``id_map(source_id, gene_id)``, and one row ``rows, unmapped_rows``; a source id with two genes raises."""
    twice = id_map.groupBy("source_id").count().where("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"ambiguous ids: {[r['source_id'] for r in twice]}")
    m = id_map.select(F.col("source_id").alias("__source"), F.col("gene_id").alias("__gene"))
    both = annotation.join(m, F.col("gene_id") == F.col("__source"), "left")
    report = both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("__gene").isNull()).alias("unmapped_rows"))
    others = [F.col("__gene").alias(c) if c == "gene_id" else F.col(c) for c in annotation.columns]
    return both.where("__gene IS NOT NULL").select(*others).distinct(), report


def labelled(genes: DataFrame, labels: DataFrame, with_id: bool = False) -> DataFrame:
    """``genes(gene_id, ...)`` with ``label``: that of ``labels(gene_id, label)`` where it has text, else the id."""
    known = labels.groupBy("gene_id").agg(F.min("label").alias("__label")).where("__label <> ''")
    text = F.concat("__label", F.lit(" ("), "gene_id", F.lit(")")) if with_id else F.col("__label")
    return genes.join(known, "gene_id", "left").withColumn("label", F.coalesce(text, "gene_id")).drop("__label")


def go_terms(rows: DataFrame) -> DataFrame:
    """Distinct ``gene_id, go_id`` of a comma list, GO ids only."""
    return rows.select("gene_id", F.explode(F.split("gos", ",")).alias("go_id")).withColumn("go_id", F.trim("go_id")).where("go_id LIKE 'GO:%'").distinct()


def gene_labels(rows: DataFrame) -> DataFrame:
    """Preferred name, else the first 40 characters of the description."""
    name = F.col("preferred_name")
    return rows.select("gene_id", F.when(~F.coalesce(F.trim(name), F.lit("")).isin("", "-"), name).otherwise(F.substring("description", 1, 40)).alias("label")).distinct()
