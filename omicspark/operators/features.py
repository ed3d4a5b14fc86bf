"""Feature annotation: attribute coverage and choice, and resolution of parents to genes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from ..sources.scratch import kept

#: Orders of preference.
FEATURES = ("exon", "CDS", "cds", "transcript", "mRNA", "gene")
ATTRIBUTES = ("gene_id", "gene", "ID", "Name", "locus_tag", "Parent")

#: So few edges are followed with their leaves. A parent of more than one in so many edges is common. Words of a segment, and bits at most (64 MB), of the set of parents that goes to every task.
FEW = 100_000
COMMON = 1000
SEGMENT = 512
MOST_BITS = 1 << 29


def attribute_coverage(features: DataFrame) -> DataFrame:
    """Per feature type and attribute of ``features(type, attrs)``: rows, rows with it, distinct values.

    ``attrs`` is a map, or the array of ``struct(k, v)`` of ``last_pairs(gff_pairs(...))``, which spares a map per row.
    """
    totals = features.groupBy("type").agg(F.count(F.lit(1)).alias("n_rows"))
    pairs = F.map_entries("attrs") if isinstance(features.schema["attrs"].dataType, MapType) else F.col("attrs")
    seen = features.select("type", F.explode(pairs).alias("p")).select("type", "p.*").toDF("type", "key", "value")
    values = seen.groupBy("type", "key", "value").agg(F.count(F.lit(1)).alias("n"))  # a row per value: no set of values in one state
    known = values.groupBy("type", F.col("key").alias("attribute")).agg(F.sum("n").alias("n_with"), F.count("value").alias("n_values"))
    return known.join(totals, "type").select("type", "attribute", "n_rows", "n_with", "n_values")


def choice_notes(coverage: DataFrame, chosen: DataFrame, most_apart: float = 0.05) -> DataFrame:
    """``note, detail`` on a choice: groups far from the number of genes, and other spellings of the feature with their rows."""
    types = coverage.groupBy("type").agg(F.max("n_rows").alias("n_rows"))
    pick = chosen.first()  # one row
    name, groups = (pick["type"], pick["n_groups"]) if pick else (None, None)
    genes = types.where("type = 'gene'").withColumn("n_groups", F.lit(groups).cast("bigint"))
    apart = genes.where(F.abs(F.col("n_groups") - F.col("n_rows")) / F.col("n_rows") > most_apart)
    other = types.where((F.lower("type") == F.lower(F.lit(name))) & (F.col("type") != F.lit(name)))
    return apart.select(F.lit("groups_and_genes").alias("note"), F.concat_ws(" vs ", "n_groups", "n_rows").alias("detail")).unionByName(
        other.agg(F.sum("n_rows").alias("n")).where("n IS NOT NULL").select(F.lit("case_variants").alias("note"), F.col("n").cast("string").alias("detail"))
    )


def merged_nodes(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes ``id, type, gene_id`` and edges ``id, parent, ord`` of ``features(type, attrs, ord)``.

    Rows of one id are one node: its first parents and first gene id that are not empty, and a gene if any of them is. A row
    without an id stands under its gene id.
    """
    a = lambda k: F.nullif(F.trim(F.col("attrs")[k]), F.lit(""))
    rows = features.select(F.coalesce(a("ID"), a("gene_id")).alias("id"), "type", a("gene_id").alias("gene_id"), a("Parent").alias("parents"), "ord").where("id IS NOT NULL")
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("ord"))).alias(c)
    merged = rows.groupBy("id").agg(F.when(F.max(F.col("type") == "gene"), "gene").otherwise(F.min_by("type", "ord")).alias("type"), first("gene_id"), first("parents"))
    edges = merged.where("parents IS NOT NULL").select("id", F.posexplode(F.split("parents", ",")).alias("ord", "parent"))
    return merged.select("id", "type", "gene_id"), edges.select("id", F.trim("parent").alias("parent"), "ord").where("parent <> ''")


def choose_feature_and_attribute(coverage: DataFrame, feature: str | None = None, attribute: str | None = None, least: float = 0.99) -> DataFrame:
    """One row: the feature to count on and the attribute to group by.

    The feature is the requested one, else the first preferred that is present, else the commonest; the
    attribute is the requested one or else the first preferred one that ``least`` of those rows have, null if none has.
    """
    order = lambda c, names: F.coalesce(*[F.when(c == n, F.lit(i)) for i, n in enumerate(names)], F.lit(len(names)))
    rank = order(F.col("type"), ((feature,) if feature else ()) + FEATURES)
    types = coverage.groupBy("type").agg(F.max("n_rows").alias("n_rows"))
    chosen = types.select(F.struct(rank, -F.col("n_rows"), "type").alias("k"), "type", "n_rows").agg(
        F.min_by("type", "k").alias("type"), F.min_by("n_rows", "k").alias("n_rows")
    )
    usable = coverage.where(F.col("n_with") >= least * F.col("n_rows")).select("type", "attribute", "n_values")
    names = (attribute,) if attribute else ATTRIBUTES
    usable = usable.where(F.col("attribute").isin(*names)).withColumn("rank", order(F.col("attribute"), names))
    best = usable.groupBy("type").agg(F.min_by("attribute", "rank").alias("attribute"), F.min_by("n_values", "rank").alias("n_groups"))
    return chosen.join(best, "type", "left")


def resolve_genes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Gene of every id: ``id, gene_id, depth``.

    ``nodes(id, type, gene_id)``, ``edges(id, parent, ord)``. A gene is its own; an id with a stored gene has that; any other takes the gene of
    its first parent, by ``ord``, that has one, however many levels up. Ids without a gene are left out.

    Most ids are no one's parent: such leaves are set aside, and again among the rest as long as that halves the edges and these are many. Only what is left is followed level by level (``_inner_genes``);
    then each layer of leaves, the last one first, takes the first of its parents that has a gene. So a leaf's edges are dealt by parent and by id once, whatever the number of levels or of failing parents.
    """
    own = F.when(F.col("type") == "gene", F.col("id")).otherwise(F.col("gene_id"))
    genes = kept(nodes.select("id", own.alias("gene_id")).where("gene_id IS NOT NULL").withColumn("depth", F.lit(0)), "genes")
    live, layers = edges.select("id", "parent", "ord").where("id IS NOT NULL AND parent IS NOT NULL"), []
    while True:
        parents = kept(live.groupBy("parent").agg(F.count(F.lit(1)).alias("n")), "parents")
        keys, left = parents.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()  # one row
        if left <= FEW:
            break
        inner, leaves = _parents_apart(live, parents, keys)
        inner, total = kept(inner, "inner_edges"), left
        left = inner.count()
        if 2 * left > total:
            break
        layers.append((leaves, kept(parents.where(F.col("n") * COMMON > total).select("parent"), "common_parents")))
        live = inner
        if left <= FEW:
            break
    found = [genes, *(_inner_genes(genes, live) if left else [])]
    for i, (leaves, common) in enumerate(reversed(layers), 1):
        taken = _leaf_genes(leaves, common, reduce(DataFrame.unionByName, found)).join(genes.select("id"), "id", "left_anti")
        found.append(taken if i == len(layers) else kept(taken, "leaf_genes"))
    return reduce(DataFrame.unionByName, found)


def _parents_apart(live: DataFrame, parents: DataFrame, keys: int) -> tuple[DataFrame, DataFrame]:
    """The edges ``live`` of ids that may be among the ``keys`` ``parents``, and those of ids that surely are not.

    A bit set of the parents goes to every task, so no edge moves; a few more ids may seem to be parents. For more parents than it can tell apart a join decides.
    """
    if 8 * keys > MOST_BITS:
        ids = parents.select(F.col("parent").alias("id"))
        return live.join(ids, "id", "left_semi"), live.join(ids, "id", "left_anti")
    size = min(max(1 << (16 * keys).bit_length(), 64 * SEGMENT), MOST_BITS) // 64
    word, mask = _place("id", size)
    at = live.join(F.broadcast(_bit_set(parents, "parent", size)), F.floor(word / SEGMENT) == F.col("segment"))
    marked = F.get("words", word.bitwiseAND(F.lit(SEGMENT - 1)).cast("int")).bitwiseAND(mask) == mask
    return at.where(marked).select(*live.columns), at.where(~marked).select(*live.columns)


def _bit_set(rows: DataFrame, key: str, size: int) -> DataFrame:
    """Bits of a key's hashes, two in one of ``size`` words of 64 (a power of two): rows ``segment, words`` of ``SEGMENT`` words each."""
    word, mask = _place(key, size)
    zeros = rows.sparkSession.range(size).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    words = rows.select(word.alias("word"), mask.alias("bits")).unionByName(zeros).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return kept(words.groupBy(F.floor(F.col("word") / SEGMENT).alias("segment")).agg(F.sort_array(F.collect_list(F.struct("word", "bits")))["bits"].alias("words")), "bits")


def _place(key: str, size: int) -> tuple[Column, Column]:
    """The word of a key in a bit set, and its bits there; keys of different types have the same if their texts have."""
    h = F.xxhash64(F.col(key).cast("string"))
    bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, k).bitwiseAND(F.lit(63)).cast("int"))
    return h.bitwiseAND(F.lit(size - 1).cast("bigint")), bit(40).bitwiseOR(bit(46))


def _leaf_genes(leaves: DataFrame, common: DataFrame, known: DataFrame) -> DataFrame:
    """``id, gene_id, depth`` of the ids of the edges ``leaves`` that have a parent with a gene: that of the first such one.

    The few ``common`` parents are looked up in every task, so their edges are not dealt by parent, and those without a gene not at all.
    """
    known, common = known.select(F.col("id").alias("parent"), "gene_id", "depth"), F.broadcast(common)
    near = leaves.join(F.broadcast(known.join(common, "parent", "left_semi")), "parent")
    far = leaves.join(common, "parent", "left_anti").join(known, "parent")
    took = near.unionByName(far).select("id", "ord", "parent", "gene_id", (F.col("depth") + 1).cast("int").alias("depth"))
    first = took.repartition("id").groupBy("id").agg(F.min_by(F.struct("gene_id", "depth"), F.struct("ord", "parent")).alias("g"))  # dealt first: hardly an id has two rows in a task
    return first.select("id", "g.gene_id", "g.depth")


def _inner_genes(genes: DataFrame, edges: DataFrame) -> list[DataFrame]:
    """``id, gene_id, depth`` of ids without a gene of their own, in parts, where chains may be long and lead round.

    Each open id points to its first parent still possible. Pointers are doubled, so ``d`` levels take ``log d`` joins, and end at an
    id with a gene or at a dead one. Of a chain with a dead end the last id that has another parent goes on to that one; ids behind
    it are dead, and so are all of a chain without such an id. Where pointers lead round, the greatest id of the cycle that has another parent goes on to that. Rounds
    are needed per failing parent on a chain, not per level.
    """
    found = [genes]
    live = edges.join(genes, "id", "left_anti")
    while True:
        ended, round_about = _chains(live, reduce(DataFrame.unionByName, found))
        found.append(ended.where("kind = 'gene'").select("id", "gene_id", (F.col("steps") + F.col("depth")).cast("int").alias("depth")))
        lost = ended.where("kind = 'dead'").unionByName(round_about)
        if lost.where("other IS NOT NULL").isEmpty():  # no chain without a gene has another parent to try
            return found[1:]
        found[-1] = kept(found[-1], "genes")
        dead = kept(lost.where("other IS NULL").select("id").union(ended.where("kind = 'dead'").select("at")).distinct(), "dead_ids")
        on_cycle = round_about.join(round_about.select(F.col("at").alias("id")).distinct(), "id", "left_semi").where("more")
        left = on_cycle.groupBy("least").agg(F.max_by(F.struct("id", F.col("first").alias("parent")), "id").alias("e")).select("e.id", "e.parent")
        closed = found[-1].select("id").unionByName(dead)
        live = live.join(closed, "id", "left_anti").join(dead.select(F.col("id").alias("parent")), "parent", "left_anti").join(left, ["id", "parent"], "left_anti")
        live = kept(live.select("id", "parent", "ord"), "edges")


def _chains(live: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Where the first parents of each id lead: rows that end, at an id with a gene or a dead one, and rows that go round for ever.

    ``id, at, asked, more, other, steps, kind, gene_id, depth, first, least``: ``asked`` says that the id is a parent itself, so others look it up, ``more`` whether it has several
    parents; ``other`` is the last id of the chain with other parents, ``steps`` its length. Rows that go on have the parent pointed to as ``first`` and the least id on the chain as ``least``.
    """
    parents = live.select(F.col("parent").alias("id")).distinct()
    asked = kept(parents.join(live.select("id"), "id", "left_semi").withColumn("asked", F.lit(True)), "asked")
    one = live.groupBy("id").agg(F.min_by("parent", F.struct("ord", "parent")).alias("at"), (F.min("parent") < F.max("parent")).alias("more"))
    pointers = one.join(asked, "id", "left").withColumns({"other": F.when(F.col("more"), F.col("id")), "steps": F.lit(1).cast("bigint")})
    ends = known.select(F.col("id").alias("at"), F.lit("gene").alias("kind"), "gene_id", "depth")
    ends = ends.unionByName(asked.select(F.col("id").alias("at"), F.lit("open").alias("kind")), allowMissingColumns=True)
    rows = pointers.join(ends, "at", "left").withColumn("kind", F.coalesce("kind", F.lit("dead")))
    rows = kept(rows.withColumns({c: F.when(F.col("kind") == "open", F.col("at")) for c in ("first", "least")}), "chains")
    names, ended, going, before, span = rows.columns, rows.where("kind <> 'open'"), rows.where("kind = 'open'"), None, 1
    while (n := going.count()) and not (n == before and span >= n):
        ahead = ended.unionByName(going).where("asked").select(*[F.col(c).alias(f"__{c}") for c in ("id", "at", "other", "least", "steps", "kind", "gene_id", "depth")])
        joined = going.drop("kind", "gene_id", "depth").join(ahead, F.col("at") == F.col("__id"))
        open_ = F.col("__kind") == "open"
        rows = kept(joined.select(
            "id", F.col("__at").alias("at"), "asked", "more", F.coalesce("__other", "other").alias("other"), F.when(open_, F.col("first")).alias("first"), F.when(open_, F.least("least", "__least")).alias("least"),
            (F.col("steps") + F.col("__steps")).alias("steps"), *[F.col(f"__{c}").alias(c) for c in ("kind", "gene_id", "depth")],
        ).select(*names), "chains")
        ended, going, before, span = ended.unionByName(rows.where("kind <> 'open'")), rows.where("kind = 'open'"), n, 2 * span
    return ended, going


def add_gene_id(features: DataFrame, resolved: DataFrame, wanted: list[str]) -> DataFrame:
    """``features(id, type, attrs)`` of the wanted types with ``gene_id`` added where it is missing."""
    r = resolved.select(F.col("id").alias("__id"), F.col("gene_id").alias("__gene"))
    need = F.col("type").isin(*wanted) & F.col("attrs")["gene_id"].isNull() & F.col("__gene").isNotNull()
    added = F.map_concat("attrs", F.create_map(F.lit("gene_id"), F.col("__gene")))
    out = features.join(r, F.col("id") == F.col("__id"), "left")
    return out.select("id", "type", F.when(need, added).otherwise(F.col("attrs")).alias("attrs"), need.alias("added"))


def gene_id_coverage(features: DataFrame, wanted: list[str], least: float = 0.99) -> DataFrame:
    """One row: rows of the wanted types, those with a gene, and whether they suffice."""
    rows = features.where(F.col("type").isin(*wanted))
    has = F.count_if(F.col("attrs")["gene_id"].isNotNull())
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), has.alias("n_with"), (has >= least * F.count(F.lit(1))).alias("passed"))


def unresolved(features: DataFrame, wanted: list[str], most: int = 10) -> DataFrame:
    """The first ``most`` rows of the wanted types without a gene, by ``ord``: a report."""
    rows = features.where(F.col("type").isin(*wanted) & F.col("attrs")["gene_id"].isNull())
    return rows.orderBy("ord").limit(most).select(F.coalesce(F.col("attrs")["ID"], F.col("attrs")["Parent"]).alias("id"), "type")


def transcript_map(features: DataFrame) -> DataFrame:
    """``transcript_id, gene_id`` of transcripts with id and parent (the first of a list).

    If no transcript has both, every gene stands for itself.
    """
    parent = F.split(F.col("attrs")["Parent"], ",")[0]
    made = features.where(F.col("type").isin("mRNA", "transcript")).select(F.col("attrs")["ID"].alias("transcript_id"), parent.alias("gene_id"))
    made = made.where("transcript_id IS NOT NULL AND gene_id IS NOT NULL").distinct()
    if not made.isEmpty():
        return made
    gene = F.col("attrs")["ID"]
    return features.where("type = 'gene'").select(gene.alias("transcript_id"), gene.alias("gene_id")).where("gene_id IS NOT NULL").distinct()
