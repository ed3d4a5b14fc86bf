"""Operators on small invented tables: rules, missing values and edge cases."""

import gzip
import hashlib
import io
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from omicspark.functions import columns, tails
from omicspark.operators import annotation, counts, designs, enrichment, explore, features, haplotypes, inference, intervals, library_qc, normalize, ranges, sequences, validate
from omicspark.plans import project
from omicspark.sources import fastq, readers, writers


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


COUNTERS = {"no_feature": 4752, "ambiguous": 0, "alignment_not_unique": 86124, "not_aligned": 35041973, "too_low_aQual": 108062}


def library(spark, genes, counters):
    c = spark.createDataFrame([("s", g, n) for g, n in genes.items()], "sample_id string, gene_id string, n bigint")
    k = spark.createDataFrame([("s", g, n) for g, n in counters.items()], "sample_id string, category string, n bigint")
    return c, k


def test_tiny_rate_is_not_zero(spark):
    m = one(counts.htseq_metrics(*library(spark, {"g1": 11, "g2": 0}, COUNTERS)))
    assert m.processed == 35240922 and 0 < m.assignment_rate_pct < 0.0001 and m.zero_assigned is False


def test_missing_counters_give_no_rate(spark):
    m = one(counts.htseq_metrics(*library(spark, {"g1": 8}, {"no_feature": 2})))
    assert m.gene_count_sum == 8 and m.assignment_rate_pct is None and m.assignment_status == "unavailable" and "not_aligned" in m.reason


def test_unknown_unit_keeps_the_counter_rate(spark):
    zero = {k: 0 for k in COUNTERS} | {"no_feature": 2}
    m = one(counts.htseq_metrics(*library(spark, {"g1": 8}, zero), unit=F.lit("unknown")))
    assert m.counter_rate_pct == 80 and m.counter_status == "ok" and m.assignment_rate_pct is None


def test_feature_counter_summary(spark):
    c, k = library(spark, {"g1": 8}, {"Assigned": 8, "Unassigned_Unmapped": 2})
    assert one(counts.featurecounts_metrics(c, k)).assignment_rate_pct == 80
    assert one(counts.featurecounts_metrics(c, k.where("category = 'Assigned'"))).assignment_rate_pct is None


def test_technical_merge(spark):
    c = spark.createDataFrame([("s1", "g1", 8), ("s1", "g2", 0), ("s2", "g1", 0), ("s2", "g2", 2)], "sample_id string, gene_id string, n bigint")
    k = spark.createDataFrame([(s, n, (2 if s == "s1" else 98) if n == "no_feature" else 0) for s in ("s1", "s2") for n in COUNTERS], "sample_id string, category string, n bigint")
    members = spark.createDataFrame([("s1", "m"), ("s2", "m")], "sample_id string, merge_id string")
    m = one(counts.technical_metrics(counts.htseq_metrics(c, k), members, "gene_count_sum", "processed"))
    assert m.rate_pct == pytest.approx(1000 / 110) and m.constituent_sample_ids == "s1|s2"
    assert {(r.gene_id, r.n) for r in counts.technical_merge(c, members).collect()} == {("g1", 8), ("g2", 2)}


def test_composition(spark):
    rows = [("a", "pine", 80, 10, 100), ("a", "fun", 5, 90, 100), ("b", "pine", 80, 20, 100), ("b", "fun", 0, 100, 100), ("c", "fun", 1, 0, 1)]
    df = spark.createDataFrame(rows, "sample_id string, organism string, assigned bigint, not_aligned bigint, total bigint")
    got = {(r.sample_id, r.organism): r for r in counts.composition(df, "pine", 85, 50_000).collect()}
    a, b, c = got["a", "fun"], got["b", "fun"], got["c", "fun"]
    assert got["a", "pine"].aligned == 90 and a.aligned_pct == 10.0 and a.signal_group == "high" and a.qc_pass
    assert b.signal_group == "low" and not b.qc_pass
    assert c.aligned_pct is None and c.signal_group == "NA"


def test_group_summary_counts_missing(spark):
    df = spark.createDataFrame([("q", 1e-7, "u"), ("q", 0.0, "u"), ("q", None, "v"), (None, 2.0, "w")], "k string, v double, u string")
    got = {r.k: r for r in counts.group_summary(df, ["k"], "v", "u").collect()}
    q = got["q"]
    assert (q.n_total, q.n_valid, q.n_missing, q.n_zero, q.n_units) == (3, 2, 1, 1, 2) and "(missing)" in got


def test_haplotypes(spark):
    c = spark.createDataFrame([("s", "a1", 5), ("s", "b2", 7), ("s", "u", 1)], "sample_id string, gene_id string, n bigint")
    p = spark.createDataFrame([("a1", "b1", 1), ("a2", "b2", 2), ("", "b3", 3)], "ha_gene_id string, hb_gene_id string, ord int")
    p = haplotypes.clean_pairs(p, "ord")
    summed, specific, rest = haplotypes.split_by_haplotype(c, p)
    assert {(r.pair_id, r.n) for r in summed.collect()} == {("a1|b1", 5), ("a2|b2", 7)}
    assert {(r.gene_id, r.n) for r in specific.collect()} == {("a1", 5), ("b1", 0), ("a2", 0), ("b2", 7)}
    assert [r.gene_id for r in rest.collect()] == ["u"]
    assert {r.pair_id for r in haplotypes.split_by_haplotype(c, p, compatible=True)[0].collect()} == {"a1|b1"}


def test_overlap_join_matches_brute_force(spark):
    r = random.Random(1)
    a = [(i, r.randrange(3), s := r.randrange(1, 5000), s + r.randrange(300)) for i in range(150)]
    b = [(i, r.randrange(3), s := r.randrange(1, 5000), s + r.choice([0, 10, 3000])) for i in range(150)]
    left = spark.createDataFrame(a, "i int, chrom int, start int, end int")
    right = spark.createDataFrame(b, "j int, chrom int, r_start int, r_end int")
    for width in (50, 1000):
        got = sorted((x.i, x.j) for x in intervals.overlap_join(left, right, ["chrom"], width).collect())
        assert got == sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3])


def gene_of(start, own, parents):
    """The first parent that has a gene, depth first in written order; what was seen is not asked again."""
    seen, stack = set(), [(start, 0)]
    while stack:
        at, depth = stack.pop()
        if at in seen:
            continue
        seen.add(at)
        if at in own:
            return own[at], depth
        stack += [(p, depth + 1) for p in reversed(parents.get(at, []))]


def resolved(spark, own, parents):
    nodes = spark.createDataFrame([(k, "mRNA", v) for k, v in own.items()], "id string, type string, gene_id string")
    edges = spark.createDataFrame([(k, p, i) for k, ps in parents.items() for i, p in enumerate(ps)], "id string, parent string, ord int")
    return {r.id: (r.gene_id, r.depth) for r in features.resolve_genes(nodes, edges).collect()}


def test_parents_in_written_order(spark):
    r = random.Random(4)
    own = {"gene1": "gene1", "geneX": "geneX"} | {f"g{i}": f"G{i}" for i in range(3)}
    parents = {"tx1": ["gene1"], "exon": ["tx1", "geneX"], "lost": ["nowhere", "gone"], "late": ["lost", "tx1"], "deep": ["late", "geneX"]}
    parents |= {f"c{i + 1}": [f"c{i}"] for i in range(1000)} | {"c0": ["g0"]}
    names = [f"x{i}" for i in range(25)]
    for i, n in enumerate(names):  # parents have smaller numbers, so nothing leads round
        parents[n] = r.sample(names[:i] + ["nowhere", "g1", "g2"] * (i % 4 == 0) + ["gone"], k=min(r.randint(1, 4), i + 1)) if i else ["gone"]
    got = resolved(spark, own, parents)
    want = {k: gene_of(k, own, parents) for k in [*own, *parents]}
    assert got == {k: v for k, v in want.items() if v}
    assert got["exon"] == ("gene1", 2) and "lost" not in got and got["late"] == ("gene1", 2) and got["deep"] == ("gene1", 3) and got["c1000"] == ("G0", 1001)


def test_parents_that_lead_round(spark):
    own = {"g": "g"}
    ring = lambda p: {f"{p}{i}": [f"{p}{(i + 1) % 7}"] for i in range(7)}
    way_out = ring("r") | {"r3": ["r4", "g"], "tail": ["tail2"], "tail2": ["nowhere", "r6"]}
    closed = ring("q") | {"end": ["q1", "g"], "self": ["self"]}
    got = resolved(spark, own, way_out | closed)
    assert got == {k: gene_of(k, own, way_out) for k in [*own, *way_out]} | {"end": ("g", 1)}


def test_resolution_of_parents(spark):
    nodes = spark.createDataFrame([("g1", "gene", None), ("t1", "mRNA", None), ("x1", "exon", "stored"), ("loop", "mRNA", None)], "id string, type string, gene_id string")
    edges = spark.createDataFrame([("t1", "g1", 0), ("e1", "t1", 0), ("e2", "nowhere", 0), ("e2", "t1", 1), ("loop", "pool", 0), ("pool", "loop", 0)], "id string, parent string, ord int")
    assert {r.id: r.gene_id for r in features.resolve_genes(nodes, edges).collect()} == {"g1": "g1", "t1": "g1", "e1": "g1", "e2": "g1", "x1": "stored"}


def test_attributes(spark):
    df = spark.createDataFrame([("ID=a;Parent=b,c;ID=z;",), ('gene_id "g 1"; note "x";',)], "f string")
    got = [r[0] for r in df.select(columns.gff_attributes(F.col("f"))).collect()]
    assert got == [{"ID": "z", "Parent": "b,c"}, {"gene_id": "g 1", "note": "x"}]
    m = df.limit(1).select(columns.percent_map(F.lit("a=1%2B;b=x+y;bad=%zz;a=2%20"))).first()[0]
    assert m == {"a": "2 ", "b": "x+y", "bad": None}


def test_strand_call_bands(spark):
    rows = [(0.9, 30_000), (0.1, 30_000), (0.5, 30_000), (0.7, 30_000), (0.9, 100), (None, 0)]
    df = spark.createDataFrame(rows, "f double, n int")
    got = [r[0] for r in df.select(sequences.strand_call(F.col("f"), F.col("n"), 20_000)).collect()]
    assert got == ["forward", "reverse", "unstranded", "ambiguous", "undetermined", "undetermined"]


def test_best_hit_keeps_the_first_of_ties(spark):
    df = spark.createDataFrame([("q", "s1", 90.0, 1e-9, 50.0, 1), ("q", "s2", 90.0, 1e-9, 50.0, 2), ("q", "s3", 10.0, 1e-9, 99.0, 3)], "query_id string, subject_id string, pident double, evalue double, bitscore double, ord int")
    assert one(annotation.best_hit(df)).subject_id == "s1"


def test_secretome(spark):
    p = spark.createDataFrame([("a",), ("b",), ("c",)], "protein_id string")
    v = spark.createDataFrame([("a", "x", "SP"), ("a", "y", "SP+TM"), ("b", "x", "SP")], "protein_id string, tool string, call string")
    tm = spark.createDataFrame([("a", 0), ("b", 0), ("c", 2)], "protein_id string, n_tm int")
    assert {r.protein_id: r.secreted for r in annotation.secretome(p, v, tm, 2).collect()} == {"a": True, "b": False, "c": False}
    assert {r.secreted for r in annotation.secretome(p, v, tm, 0).collect()} == {None}


def test_bad_numbers(spark):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(["NaN", "-1", "1.1", "inf", "x", "3"])], "k int, v string")
    got = {r.key: r.rule for r in validate.bad_numbers(df, "k", "v", True).collect()}
    assert got == {"0": "not_finite", "1": "negative", "2": "not_integer", "3": "not_finite", "4": "not_a_number"}
    with pytest.raises(ValueError, match="negative"):
        validate.require_none(validate.bad_numbers(df, "k", "v", True))


def test_tails(spark):
    df = spark.createDataFrame([(3, 10, 50, 8), (0, 10, 50, 0)], "x bigint, k bigint, n bigint, s bigint")
    p = [r[0] for r in df.select(tails.hypergeometric_tail(F.col("x"), F.col("k"), F.col("n"), F.col("s"))).collect()]
    exact = sum(math.comb(10, i) * math.comb(40, 8 - i) for i in range(3, 9)) / math.comb(50, 8)
    assert p[0] == pytest.approx(exact, rel=1e-9) and p[1] == 1
    t = one(spark.range(1).select(tails.student_two_sided(F.lit(2.0), F.lit(10)).alias("t"), tails.f_upper(F.lit(4.0), F.lit(1.0), F.lit(10)).alias("f")))
    assert t.t == pytest.approx(0.0733880348, abs=1e-8) and t.f == pytest.approx(t.t, abs=1e-10)


def test_adjusted_p_values(spark):
    df = spark.createDataFrame([("a", 0.01), ("b", 0.03), ("c", 0.04), ("d", 0.2), ("e", None)], "gene_id string, PValue double")
    got = {r.gene_id: r.FDR for r in inference.benjamini_hochberg(df, []).collect()}
    assert got["a"] == pytest.approx(0.04) and got["b"] == got["c"] == pytest.approx(0.16 / 3) and got["d"] == pytest.approx(0.2) and got["e"] is None


def expression(spark, seed=321):
    """Planted effects: the first genes rise with treatment."""
    r = np.random.default_rng(seed)
    ids = [f"s{i:02d}" for i in range(16)]
    samples = [{"sample_id": s, "treatment": "treated" if i % 2 else "control", "batch": f"b{i // 2 % 2}"} for i, s in enumerate(ids)]
    rows = []
    for g in range(120):
        for i, s in enumerate(ids):
            n = max(1, round(r.normal(100, 24))) * (8 if g < 10 and i % 2 else 1)
            rows.append((s, f"g{g}", n))
    return spark.createDataFrame(rows, "sample_id string, gene_id string, n bigint"), samples


def test_planted_effects_and_formulas(spark):
    c, samples = expression(spark)
    sets = spark.createDataFrame([(f"g{g}", "hit" if g < 12 else f"set{g % 5}") for g in range(120)], "gene_id string, set_id string")
    tables, status = project.analyse(c, samples, {"treatment": "control", "batch": "b0"}, {"t": {"factor:treatment:treated": 1.0}, "b": {"factor:batch:b1": 1.0}, "no": {"x": 1.0}}, sets)
    assert dict(status)["t"] == "ok" and dict(status)["no"] != "ok"
    test = {r.gene_id: r for r in tables["test:t"].collect()}
    assert all(test[f"g{g}"].logFC > 1.5 and test[f"g{g}"].Regulation == "Up" for g in range(10))
    assert sum(r.Regulation != "Unchanged" for g, r in test.items() if int(g[1:]) >= 10) <= 3
    best = tables["sets:t"].where("direction = 'Up'").orderBy("PValue").first()
    assert best.set_id == "hit" and best.PValue < 1e-6 and best.overlap == 10
    ids, names, x = inference.design_matrix(samples, {"treatment": "control", "batch": "b0"})
    expr = tables["logcpm"].toPandas().pivot(index="sample_id", columns="gene_id", values="logcpm").loc[ids]
    beta, rss, *_ = np.linalg.lstsq(x, expr.to_numpy(), rcond=None)
    k = list(expr.columns).index("g0")
    assert test["g0"].logFC == pytest.approx(beta[1, k], abs=1e-9)
    se = math.sqrt(rss[k] / (len(ids) - 3) * np.linalg.inv(x.T @ x)[1, 1])
    assert test["g0"].statistic == pytest.approx(beta[1, k] / se, rel=1e-6)
    fit = inference.fit(tables["logcpm"], ids, x)
    f = {r.gene_id: r.statistic for r in inference.omnibus_test(fit, x, np.eye(3)[1:2]).collect()}
    assert f["g0"] == pytest.approx(test["g0"].statistic ** 2, rel=1e-8)
    assert sum(r.variance_fraction for r in tables["variance"].collect()) <= 1 + 1e-9
    assert inference.design_problems(np.ones((4, 2)), [{"sample_id": i, "treatment": "a", "u": i} for i in range(4)], ["treatment"], "u")[0] == "design is not of full rank"
    again = normalize.tmm_factors(c.orderBy(F.rand(3))).orderBy("sample_id").collect()
    assert [round(r.tmm_factor, 9) for r in again] == [round(r.tmm_factor, 9) for r in normalize.tmm_factors(c).orderBy("sample_id").collect()]


def test_cell_contrast():
    samples = [{"sample_id": str(i), "a": "xy"[i % 2], "b": "uv"[i // 2 % 2]} for i in range(8)]
    _, names, x = inference.design_matrix(samples, {"a": "x", "b": "u"}, interactions=[("a", "b")])
    v = inference.cell_contrast(names, [({"a": "y", "b": "v"}, 1.0), ({"a": "x", "b": "v"}, -1.0)], {"a": "x", "b": "u"})
    assert dict(zip(names, v)) == {"intercept": 0, "factor:a:y": 1, "factor:b:v": 0, "interaction:a:y*b:v": 1}
    with pytest.raises(ValueError):
        inference.cell_contrast(names, [({"a": "y"}, 1.0)], {"a": "x", "b": "u"})


def test_running_score_matches_a_plain_loop(spark):
    r = random.Random(5)
    scores = [(f"g{i}", r.gauss(0, 1)) for i in range(300)]
    chosen = {f"g{i}" for i in range(0, 300, 7)}
    got = one(enrichment.running_score(spark.createDataFrame(scores, "gene_id string, score double"), spark.createDataFrame([(g, "s") for g in chosen], "gene_id string, set_id string"))).es
    total, run, best = sum(abs(s) for g, s in scores if g in chosen), 0.0, 0.0
    for g, s in sorted(scores, key=lambda x: (-x[1], x[0])):
        run += abs(s) / total if g in chosen else -1 / (300 - len(chosen))
        best = run if abs(run) > abs(best) else best
    assert got == pytest.approx(best, abs=1e-9)


def test_mds_recovers_distances(spark):
    pts = {"a": (0, 0), "b": (3, 0), "c": (0, 4)}
    rows = [(s, t, math.dist(pts[s], pts[t])) for s in pts for t in pts if s < t]
    got = {}
    for r in explore.mds(spark.createDataFrame(rows, "s1 string, s2 string, distance double")).collect():
        got.setdefault(r.sample_id, {})[r.dim] = r.coordinate
    for s, t, d in rows:
        assert math.dist([got[s][1], got[s][2]], [got[t][1], got[t][2]]) == pytest.approx(d, abs=1e-9)


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "s1.htseq.tsv").write_text("g1\t3\ng2\t0\ng1\t5\n__no_feature\t7\n")
    genes, special = readers.read_htseq(spark, str(tmp_path / "s1.htseq.tsv"))
    assert {(r.sample_id, r.gene_id, r.n) for r in genes.collect()} == {("s1", "g1", 5), ("s1", "g2", 0)}
    assert one(special).category == "no_feature"
    assert {r.rule for r in readers.htseq_problems(spark, str(tmp_path / "s1.htseq.tsv")).collect()} == {"duplicate"}
    (tmp_path / "fc.txt").write_text("# made\nGeneid\tChr\tStart\tEnd\tStrand\tLength\t/x/s2.sorted.bam\ng1\t1\t1\t20\t+\t20\t8\n")
    assert one(readers.read_featurecounts(spark, str(tmp_path / "fc.txt")))[0:3] == ("s2", "g1", 8)
    (tmp_path / "m.csv").write_text('gene_id,s1,s2\n"gene,one",3,0\n__x,1,1\n')
    assert {(r.sample_id, r.gene_id, r.n) for r in readers.read_matrix(spark, str(tmp_path / "m.csv")).collect()} == {("s1", "gene,one", 3.0), ("s2", "gene,one", 0.0)}
    (tmp_path / "a.gff3").write_text("##gff\nc1\ts\tgene\t1\t9\t.\t+\t.\tID=g1;Name=x\nc1\ts\texon\t1\t5\t.\t+\t.\tParent=g1\nbad line\n")
    gff = readers.read_gff(spark, str(tmp_path / "a.gff3"))
    assert gff.count() == 2 and one(readers.genes_of(gff)).gene_id == "g1"
    lines = [r.value for r in writers.gff_rows(gff.orderBy("at")).collect()]
    assert lines[1] == "c1\ts\texon\t1\t5\t.\t+\t.\tParent=g1;"
    (tmp_path / "a.fa").write_text(">q1 first one\nACG\nTnn\n>q2\nAC\n")
    assert [(r.seq_id, r.descr, r.sequence) for r in readers.read_fasta(spark, str(tmp_path / "a.fa")).orderBy("ord").collect()] == [("q1", "first one", "ACGTnn"), ("q2", "", "AC")]
    (tmp_path / "r.fastq").write_text("@r1/1 x\nACGT\n+\nIIII\n@r2/1\nAC\n+\nII\n")
    assert [(r.read_id, r.seq, r.qual) for r in readers.read_fastq(spark, str(tmp_path / "r.fastq")).orderBy("ord").collect()] == [("r1", "ACGT", "IIII"), ("r2", "AC", "II")]
    (tmp_path / "v.vcf").write_text("##x\n#CHROM\nc\t5\t.\tA\tG\nc\t6\t.\tA\tG,T\n")
    assert one(readers.single_base(readers.read_vcf(spark, str(tmp_path / "v.vcf")))).pos == 5
    (tmp_path / "sheet.csv").write_text("Sample,R1,R2\n# note\ns1,a.fq;b.fq,\n")
    row = one(readers.read_sheet(spark, str(tmp_path / "sheet.csv")))
    assert row.sample_id == "s1" and row.fastq_1 == ["a.fq", "b.fq"]
    (tmp_path / "t.txt").write_text("Total reads processed:   1,234\nReads with adapters: 5 (1%)\n")
    t = one(readers.read_trim_reports(spark, str(tmp_path / "t.txt")))
    assert t.reads_processed == 1234 and t.bp_written is None
    (tmp_path / "x.sam").write_text("@HD\nr\t16\tc1\t11\t60\t10M200N10M\t*\t0\t0\tACGT\tIIII\tNH:i:2\n")
    sam = one(readers.read_sam(spark, str(tmp_path / "x.sam")))
    assert (sam.pos0, sam.nh, sam.flag) == (10, 2, 16)
    blocks = intervals.aligned_blocks(readers.read_sam(spark, str(tmp_path / "x.sam"))).collect()
    assert [(b.start, b.end) for b in blocks] == [(11, 20), (221, 230)]
    writers.write_table(genes.unionByName(genes.limit(1).withColumn("n", F.lit(None).cast("bigint"))), str(tmp_path / "out"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part*")))
    assert "\tNA" in text and text.startswith("sample_id\tgene_id\tn")
    (tmp_path / "c.tsv").write_text("a\tb\n1\t2\n")
    assert one(readers.read_control(spark, str(tmp_path / "c.tsv"), ["a", "b"])).b == "2"
    with pytest.raises(ValueError):
        readers.read_control(spark, str(tmp_path / "c.tsv"), ["a"])
    assert len(one(readers.file_hashes(spark, str(tmp_path / "c.tsv"))).sha256) == 64


def test_import_reports_problems_and_still_gives_qc(spark):
    c, k = library(spark, {"g1": 8, "g2": 1}, {x: 0 for x in COUNTERS})
    samples = spark.createDataFrame([("s", "i", "s", "true", None, None, None, None), ("t", "i", "t", "maybe", None, None, None, None)], "sample_id string, input_id string, source_sample_id string, include_analysis string, exclusion_reason string, technical_merge_id string, technical_partition_id string, technical_disjoint string")
    inputs = spark.createDataFrame([("i", "x.tsv", "exclusive", "0" * 64)], "input_id string, path string, count_mode string, sha256 string")
    assay = project.import_assay(c, k, samples, inputs)
    assert {r.rule for r in assay.problems.collect()} == {"include_analysis", "not_one_to_one"}
    assert one(assay.metrics).assignment_rate_pct == 100


# Files: names, places, sizes


def test_files_of_one_name_stay_apart(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        want = set()
        for folder, tag, end in (("a", "x", "\n"), ("b", "y", "\r\n")):
            (tmp_path / folder).mkdir()
            text = "".join(f"@{tag}{i}/1 more{end}ACGT{i}{end}+{end}IIII{i}{end}" for i in range(60))
            (tmp_path / folder / "r.fastq").write_bytes(text.encode())
            want |= {(folder, f"{tag}{i}", f"ACGT{i}", f"IIII{i}") for i in range(60)}
        reads = readers.read_fastq(spark, [str(tmp_path / "a" / "r.fastq"), str(tmp_path / "b" / "r.fastq")])
        got = {(r.path.split("/")[-2], r.read_id, r.seq, r.qual) for r in reads.collect()}
        assert got == want
        contig = "\n".join("ACGTNacgtn"[: 1 + i % 10] for i in range(300))
        (tmp_path / "g.fa").write_text(f">c1 long\n{contig}\n>c2\nNN\nac\n")
        rows = readers.fasta_lines(spark, str(tmp_path / "g.fa"))
        assert {(r.seq_id, r.n) for r in rows.groupBy("seq_id").agg(F.count("*").alias("n")).collect()} == {("c1", 300), ("c2", 2)}
        stats = one(sequences.genome_line_stats(rows))
        assert (stats.total_bp, stats.contigs, stats.max_contig_bp) == (1654, 2, 1650)
        lines = contig.split("\n") + ["NN", "ac"]
        some, total = [], 0
        for line in lines:
            if total < 500:
                some.append(line)
                total += len(line)
        prefix = one(sequences.genome_line_stats(rows, 500))
        text = "".join(some)
        assert prefix.composition_scanned_bp == len(text) and prefix.total_bp == 1654
        assert prefix.n_fraction == pytest.approx(sum(c in "Nn" for c in text) / len(text)) and prefix.softmask_fraction == pytest.approx(sum(c.islower() for c in text) / len(text))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_samples_that_share_a_name_are_refused(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "s1.tsv").write_text("g1\t3\n")
    with pytest.raises(ValueError):
        readers.read_htseq(spark, [str(tmp_path / "a" / "s1.tsv"), str(tmp_path / "b" / "s1.tsv")])


def test_gzip_and_last_value_wins(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "s1.htseq.tsv.gz", "wt") as f:
        f.write("g1\t3\ng1\t4\n__ambiguous\t2\n")
    genes, special = readers.read_htseq(spark, str(tmp_path / "s1.htseq.tsv.gz"))
    assert one(genes).n == 4 and one(special).n == 2


def test_attribute_style_is_the_lines(spark):
    from omicspark.functions.columns import gff_attributes

    texts = ['ID=a; Name = b c ;ID=z', 'gene_id "g1"; note "x=y"; level 2', 'Parent=p1,p2;', '']
    got = [r.m for r in spark.createDataFrame([(t,) for t in texts], "t string").select(gff_attributes(F.col("t")).alias("m")).collect()]
    assert got == [{"Name": "b c", "ID": "z"}, {"gene_id": "g1", "note": "x=y", "level": "2"}, {"Parent": "p1,p2"}, {}]


def test_constants_of_the_formats(spark, tmp_path):
    assert [one(spark.range(1).select(annotation.informative(F.lit(t)).alias("x"))).x for t in ("N/A", "Unnamed protein product", "none", "predicted protein")] == [None, None, "none", "predicted protein"]
    assert readers.SHEET_ALIASES["type"] == "layout" and "treatment" not in readers.SHEET_ALIASES and "cram" not in readers.SHEET_ALIASES
    ends = spark.createDataFrame([(n,) for n in ("a_R1.fq.BZ2", "a_R1.fastq.zst", "a_R1.txt")], "path string")
    listing = spark.createDataFrame([("a_R2.fq.BZ2", 1), ("a_R2.fastq.zst", 1), ("a_R2.txt", 1)], "path string, size bigint")
    assert {r.mate for r in validate.inferred_mates(ends, listing).collect()} == {"a_R2.fq.BZ2", "a_R2.fastq.zst"}
    (tmp_path / "t.3line").write_text(">p1 | TM\nMKL\nIMMMOBBI\n>p2 | GLOB\nMKL\nIIIIIIII\n")
    assert {(r.protein_id, r.kind, r.n_tm) for r in readers.read_topology(spark, str(tmp_path / "t.3line")).collect()} == {("p1", "TM", 2), ("p2", "GLOB", 0)}
    (tmp_path / "syri.out").write_text("c\t1\t90\t-\t-\tq\t95\t2\tB1\t-\tSYN\t-\nc\t1\t90\t-\t-\tq\t2\t95\tB2\t-\tINV\t-\n")
    block = one(readers.syri_blocks(readers.read_syri(spark, str(tmp_path / "syri.out"))))
    assert block.block_id == "B1" and block.inverted
    genes = spark.createDataFrame([("g", "q", 10, 20)], "gene_id string, chrom string, start bigint, end bigint")
    blocks = spark.createDataFrame([("B1", "q", 95, 2)], "block_id string, chrom string, start bigint, end bigint")
    assert one(intervals.genes_in_blocks(genes, blocks, 10)).gene_id == "g"
    snps = spark.createDataFrame([("c1", 30, "A", "G"), ("c1", 4, "C", "T")], "chrom string, pos bigint, ref string, alt string")
    writers.write_snps_by_chromosome(snps, str(tmp_path / "snps"))
    assert "".join(p.read_text() for p in sorted((tmp_path / "snps" / "c1.snps.txt").glob("part*"))) == "4\tC\tT\n30\tA\tG\n"
    long_id = spark.createDataFrame([(1, "s" * 65, "", "a.fq", "", "", "")], "line bigint, sample_id string, layout string, fastq_1 string, fastq_2 string, strandedness string, bam string")
    assert {r.rule for r in validate.sheet_rules(long_id).collect()} == {"sample_id"}


def test_merops_takes_the_first_hit(spark, tmp_path):
    (tmp_path / "m.txt").write_text("# made\np1\tMER1 S8A like\np1\tMER2 C1\np2\tx\t1\t2\t3\tM10 family\np3\todd\n")
    assert {(r.protein_id, r.family) for r in readers.read_merops(spark, str(tmp_path / "m.txt")).collect()} == {("p1", "S8A"), ("p2", "M10"), ("p3", "odd")}


def test_last_product_wins_by_its_place(spark):
    rows = spark.createDataFrame([("p", "kinase", 1), ("p", "ligase", 2), ("p", "n/a", 3)], "protein_id string, product string, ord int")
    got = one(annotation.product_table(rows.select("protein_id").distinct(), {"swissprot": rows}))
    assert got.product == "ligase" and got.evidence == "swissprot"


# Limits raise


def test_limits_raise(spark, monkeypatch):
    monkeypatch.setattr(explore, "MOST_SAMPLES", 2)
    pairs = spark.createDataFrame([("a", "b", 1.0), ("a", "c", 1.0), ("b", "c", 1.0), ("a", "d", 2.0)], "s1 string, s2 string, distance double")
    with pytest.raises(ValueError):
        explore.mds(pairs)


def test_reused_ids_fill_what_is_empty(spark):
    rows = spark.createDataFrame([("gene", {"ID": "x"}, 1), ("exon", {"ID": "x", "Parent": "p, q", "gene_id": ""}, 2), ("exon", {"ID": "x", "Parent": "r", "gene_id": "late"}, 3), ("exon", {"gene_id": "only"}, 4)], "type string, attrs map<string,string>, ord int")
    nodes, edges = features.merged_nodes(rows)
    assert {(r.id, r.type, r.gene_id) for r in nodes.collect()} == {("x", "gene", "late"), ("only", "exon", "only")}
    assert {(r.id, r.parent, r.ord) for r in edges.collect()} == {("x", "p", 0), ("x", "q", 1)}


def test_designs_are_checked(spark):
    samples = [{"sample_id": f"s{i}", "treatment": "t" if i % 2 else "c", "unit": f"u{i // 2}", "subject": f"p{i // 2}"} for i in range(6)]
    _, _, x = inference.design_matrix(samples, {"treatment": "c"})
    assert inference.design_problems(x, samples, ["treatment"], "unit") == ["repeated units need a subject"]
    assert inference.design_problems(x, samples, ["treatment"], "unit", "subject") == []
    samples[0]["subject"] = "p2"
    assert "subject and unit are not one to one" in inference.design_problems(x, samples, ["treatment"], "unit", "subject")
    with pytest.raises(ValueError):
        inference.design_matrix([{**s, "dose": "nan"} for s in samples], {}, ["dose"])


def test_gapped_reads_are_judged_by_block(spark):
    reads = spark.createDataFrame([("r", 1, "c", 9, 60, "2S4M100N3I4M", "xxACGTyyyACGT", "I" * 13)], "read_id string, mate int, chrom string, pos0 bigint, mapq int, cigar string, seq string, qual string")
    blocks = intervals.aligned_blocks(reads)
    assert {(b.start, b.end, b.seq_at) for b in blocks.collect()} == {(10, 13, 3), (114, 117, 10)}
    snps = spark.createDataFrame([("c", 11, "C", "T"), ("c", 50, "A", "G"), ("c", 116, "A", "G")], "chrom string, pos bigint, ref string, alt string")
    got = {(r.pos, r.a_count, r.b_count) for r in intervals.allele_counts(blocks, snps, 50).collect()}
    assert got == {(11, 1, 0), (116, 0, 1)}
    assert one(intervals.split_by_snps(blocks, snps.where("pos = 50"), 50)).route == "keep"


# Intervals of all lengths and fragments of mates


def test_overlaps_and_points_of_all_lengths(spark):
    r = random.Random(11)
    span = lambda i: (i, r.randrange(2), s := r.randrange(1, 4000), s + r.choice([0, 3, 40, 900, 10**6, 10**12]))
    a, b = [span(i) for i in range(80)], [span(i) for i in range(80)] + [(900, 1, 1, 10**15)]
    left = spark.createDataFrame(a, "i int, chrom int, start bigint, end bigint")
    right = spark.createDataFrame(b, "j int, chrom int, r_start bigint, r_end bigint")
    want = sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3])
    for width in (1, 300):
        assert sorted((x.i, x.j) for x in intervals.overlap_join(left, right, ["chrom"], width).collect()) == want
    spans = right.select("chrom", F.col("r_start").alias("start"), F.col("r_end").alias("end"))
    inside = {x[0] for x in a if any(x[1] == y[1] and y[2] <= x[2] <= y[3] for y in b)}
    points = left.select("i", "chrom", F.col("start").alias("pos"))
    assert {x.i for x in intervals.points_in(points, spans, ["chrom"], "pos", 7).collect()} == inside
    assert {x.i for x in intervals.points_in(points, spans, ["chrom"], "pos", 7, anti=True).collect()} == {x[0] for x in a} - inside
    assert intervals.points_in(points, spans.limit(0), ["chrom"], "pos", 7).count() == 0
    assert intervals.overlap_join(left, right.limit(0), ["chrom"], 7).count() == 0
    blocks = spark.createDataFrame([(y[0], y[1], y[3], y[2]) for y in b], "block_id int, chrom int, start bigint, end bigint")
    genes = left.withColumnRenamed("i", "gene_id")
    got = {(x.block_id, x.gene_id) for x in intervals.genes_in_blocks(genes, blocks, 7).collect()}
    assert got == {(y[0], x[0]) for x in a for y in b if x[1] == y[1] and y[2] <= x[2] and x[3] <= y[3]}


def test_a_chromosome_long_interval_is_one_row(spark):
    spans = spark.createDataFrame([(1, 250_000_000)], "start bigint, end bigint")
    place = F.struct(F.lit(0).alias("role"), intervals._level(F.col("start"), F.col("end"), 100).alias("level"))
    assert intervals._dealt(spans, "start", "end", 100, [place], "x_").count() == 1


def fragments_brute(rows, exons, mode, stranded, fractional):
    out = {}
    for read in {x[0] for x in rows}:
        mates = [x for x in rows if x[0] == read]
        aligned = [x for x in mates if x[7]]
        if not aligned:
            sets = "__not_aligned"
        elif any(x[6] > 1 for x in aligned):
            sets = "__alignment_not_unique"
        elif any(x[5] < 10 for x in aligned):
            sets = "__too_low_aQual"
        else:
            fits = lambda x, e: {"forward": x[4] == e[4], "reverse": x[4] != e[4], "unstranded": True}[stranded]
            at = [{e[0] for e in exons if e[1] == x[1] and e[2] <= p <= e[3] and fits(x, e)} for x in aligned for p in range(x[2], x[3] + 1)]
            if mode == "union":
                sets = set().union(*at)
            else:
                at = [s for s in at if s] if mode == "intersection-nonempty" else at
                sets = set.intersection(*at) if at else set()
        if isinstance(sets, str):
            share = {sets: 1}
        elif fractional and sets:
            share = {g: 1 / len(sets) for g in sets}
        else:
            share = {"__no_feature" if not sets else "__ambiguous" if len(sets) > 1 else next(iter(sets)): 1}
        for k, v in share.items():
            out[k] = out.get(k, 0) + v
    return out


def test_one_status_per_fragment_and_modes(spark):
    reads = "read_id string, chrom string, start bigint, end bigint, strand string, mapq int, nh int, mapped boolean"
    two = [("a", "c", 10, 20, "+", 60, 1, True), ("a", "c", 10, 20, "+", 0, 1, False), ("b", "c", 12, 22, "+", 60, 1, True), ("b", "c", 30, 40, "+", 3, 1, True)]
    exons = spark.createDataFrame([("g1", "c", 1, 100, "+")], "gene_id string, chrom string, start bigint, end bigint, strand string")
    got = {x.category: x.n for x in intervals.count_features(spark.createDataFrame(two, reads), exons, 50).collect()}
    assert got == {"g1": 1, "__too_low_aQual": 1}  # two pairs, two counts
    r = random.Random(8)
    rows = []
    for i in range(60):
        at, strand = r.randrange(1, 150), r.choice("+-")
        for _ in range(r.choice([1, 2, 2, 3])):
            s = at + r.randrange(0, 40)
            rows.append((f"r{i}", r.choice("ccd"), s, s + r.randrange(0, 25), strand, r.choice([60, 60, 60, 5]), r.choice([1] * 9 + [2]), r.random() < 0.85))
    parts = [(f"g{r.randrange(7)}", r.choice("cd"), s := r.randrange(1, 180), s + r.choice([5, 30, 120]), r.choice("+-")) for _ in range(18)]
    frame, genes = spark.createDataFrame(rows, reads), spark.createDataFrame(parts, exons.schema)
    for mode, stranded, fractional in (("union", "forward", False), ("union", "unstranded", True), ("intersection-strict", "unstranded", False), ("intersection-nonempty", "reverse", False), ("intersection-nonempty", "unstranded", True)):
        got = {x.category: x.n for x in intervals.count_features(frame, genes, 20, stranded=stranded, mode=mode, fractional=fractional).collect()}
        assert got == pytest.approx(fragments_brute(rows, parts, mode, stranded, fractional)), (mode, stranded, fractional)
    with pytest.raises(ValueError):
        intervals.count_features(frame, genes, 20, mode="none")


# Files in ranges


def test_fastq_in_ranges(spark, tmp_path):
    r = random.Random(12)
    want = []
    for name in ("a.fastq", "b.fq"):
        text = b""
        for i in range(60):
            n = r.choice([0, 1, 5, 40])
            qual = "".join(r.choice("@+I#") for _ in range(n))  # quality lines that look like headers
            want.append((name, f"r{i}", "ACGT"[i % 4] * n, qual))
            text += f"@r{i}/1 more\n{'ACGT'[i % 4] * n}\n+{'again' * (i % 2)}\n{qual}\n".encode()
        (tmp_path / name).write_bytes(text if name == "a.fastq" else text.removesuffix(b"\n"))
    (tmp_path / "c.fq.gz").write_bytes(gzip.compress(b"@x 1\nAC\n+\n@@\n") + gzip.compress(b"@y\r\nGG\r\n+\r\n++\r\n"))  # two members
    (tmp_path / "d.fq").write_bytes(b"")
    want += [("c.fq.gz", "x", "AC", "@@"), ("c.fq.gz", "y", "GG", "++")]
    for size in (150, 1 << 20):
        reads = readers.read_fastq(spark, [str(tmp_path / n) for n in ("a.fastq", "b.fq", "c.fq.gz", "d.fq")], split_bytes=size)
        assert sorted((x.file, x.read_id, x.seq, x.qual) for x in reads.collect()) == sorted(want)
        assert [x.read_id for x in reads.where("file = 'a.fastq'").orderBy("ord").collect()] == [f"r{i}" for i in range(60)]
    assert "Exchange" not in reads._jdf.queryExecution().executedPlan().toString()
    lines = readers._fastq_lines(spark, [str(tmp_path / n) for n in ("a.fastq", "b.fq")])
    assert sorted((x.file, x.read_id, x.seq, x.qual) for x in lines.collect()) == sorted(want[:120])


def test_records_of_a_stream_do_not_depend_on_blocks():
    r = random.Random(3)
    rows = [[f"@h{i}".encode(), b"A" * (n := r.randrange(6)), b"+", bytes(r.choice(b"@+I") for _ in range(n))] for i in range(60)]
    data = b"".join(b"\n".join(x) + b"\n" for x in rows)
    for size in (1, 13, 64, 1000):
        for block in (1, 7, 10_000):
            got = [x for s in range(0, len(data), size) for _, lines in fastq.records(io.BytesIO(data), s, min(s + size, len(data)), block) for x in lines]
            assert got == [x for row in rows for x in row], (size, block)


def test_chunks_of_a_genome(spark, tmp_path):
    r = random.Random(14)
    contigs = {f"c{i}": "".join(r.choice("ACGTacgtN") for _ in range(r.choice([1, 9, 10, 11, 500, 3000]))) for i in range(12)}
    text = ""
    for name, seq in contigs.items():
        width = r.choice([1, 7, 60, 10_000])
        text += f">{name} some words\n" + "".join(seq[i : i + width] + "\n" * r.choice([1, 1, 2]) for i in range(0, len(seq), width))
    (tmp_path / "g.fa").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in ("700b", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            for size in (10, 333):
                got = {(x.chrom, x.chunk_no): x.chunk for x in sequences.genome_chunks(readers.fasta_lines(spark, str(tmp_path / "g.fa")), size).collect()}
                assert got == {(n, k): s[k * size : (k + 1) * size + 1] for n, s in contigs.items() for k in range(-(-len(s) // size))}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


# Order in ranges


def test_placed_in_ranges(spark):
    r = random.Random(17)
    rows = [(g, r.choice([None, 0.5, 1.0, r.random()]), i, r.randrange(1, 5)) for i in range(900) for g in [r.choice(["big"] * 8 + ["small", None])]]
    df = spark.createDataFrame(rows, "g string, p double, id int, w int").repartition(6)
    got = {x.id: (x["__before"], x["__total"]) for x in ranges.placed(df, ["g"], ["p", "id"], F.col("w")).collect()}
    key = lambda x: (x[1] is not None, x[1] or 0.0, x[2])
    for g in ("big", "small", None):
        before, group = 0, sorted((x for x in rows if x[0] == g), key=key)
        for x in group:
            assert got[x[2]] == (before, sum(y[3] for y in group))
            before += x[3]
    first = ranges.first_rows(df.where("p IS NOT NULL"), ["g"], ["p", "id"], 7)
    for g in ("big", "small", None):
        group = sorted((x for x in rows if x[0] == g and x[1] is not None), key=key)[:7]
        assert {x.id for x in first.where(F.col("g").eqNullSafe(g)).collect()} == {x[2] for x in group}
    assert sorted(x.id for x in ranges.first_rows(df, [], ["id"], 5).collect()) == [0, 1, 2, 3, 4]
    shares = [0.0, 0.1, 0.25, 0.5, 0.99, 1.0]
    for x in ranges.exact_quantiles(df, ["g"], "p", shares).collect():
        assert list(x.q) == pytest.approx(list(np.quantile([y[1] for y in rows if y[0] == x.g and y[1] is not None], shares)))
    assert ranges.placed(df.limit(0), ["g"], ["p"]).count() == 0 and ranges.exact_quantiles(df.limit(0), ["g"], "p", [0.5]).count() == 0


def test_one_family_in_many_ranges(spark):
    r = random.Random(19)
    rows = [("f" if i % 9 else "g", f"g{i}", r.choice([None, 0.01, 0.02, 1.0, r.random()])) for i in range(2000)]
    df = spark.createDataFrame(rows, "family string, gene_id string, p double").repartition(5)
    want = {x.gene_id: x.FDR for x in inference.benjamini_hochberg(df, ["family"], "p").collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = inference.benjamini_hochberg_in_ranges(df, ["family"], "p")
        assert {x.gene_id: x.FDR for x in got.collect()} == pytest.approx(want)
        parts = ranges.placed(df.where("family = 'f' AND p IS NOT NULL"), ["family"], ["p", "gene_id"]).select("__part").distinct().count()
        assert parts > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ranges_are_walked_once(spark):
    """A frame that ends with its group is computed anew for every row, in time that grows with the square of a range."""
    df = spark.range(60).select(F.lit("f").alias("family"), F.col("id").cast("string").alias("gene_id"), (F.col("id") * 7 % 60 / 60).alias("p"))
    plan = inference.benjamini_hochberg_in_ranges(df, ["family"], "p")._jdf.queryExecution().analyzed().treeString().lower()
    assert "currentrow$()" in plan and "currentrow$(), unboundedfollowing" not in plan


def test_only_parents_are_looked_up(spark):
    """Leaves, mostly the bulk of all ids, are not sent to be looked up, and rows at their end carry no more of their way than is needed."""
    live = spark.createDataFrame([("a", "g", 0), ("b", "a", 0), ("c", "b", 0), ("x", "y", 0), ("x", "z", 1)], "id string, parent string, ord int")
    known = spark.createDataFrame([("g", "g", 0)], "id string, gene_id string, depth int")
    ended, round_about = features._chains(live, known)
    got = {x.id: (x.at, x.asked, x.more, x.steps, x.kind, x["first"], x.least) for x in ended.collect()}
    assert got == {"a": ("g", True, False, 1, "gene", None, None), "b": ("g", True, False, 2, "gene", None, None), "c": ("g", None, False, 3, "gene", None, None), "x": ("y", None, True, 1, "dead", None, None)}
    assert round_about.count() == 0


def test_leaves_are_not_followed(spark, monkeypatch):
    """Ids that are no one's parent stay out of the chains, and have the gene of their first parent that has one, whether parents are common or not, and whatever their bit set can tell."""
    r = random.Random(8)
    own = {"g1": "G1", "g2": "G2", "named": "G3"}
    inner = {f"m{i}": [f"m{i - 1}"] for i in range(1, 9)} | {"m0": ["nowhere", "g1"], "lost": ["gone"], "round": ["again"], "again": ["round"]}
    leaves = {f"e{i}": r.sample(["nowhere", "lost", "round", "g2", *inner], k=r.randint(1, 4)) for i in range(60)} | {"only": ["lost", "again"], "named": ["g1"]}
    want = {k: v for k in [*own, *inner, *leaves] if (v := gene_of(k, own, inner | leaves))}
    assert "only" not in want and want["named"] == ("G3", 0) and want["m8"] == ("G1", 9)
    followed, chains = [], features._chains
    monkeypatch.setattr(features, "FEW", 0, raising=False)
    monkeypatch.setattr(features, "_chains", lambda live, known: followed.append({x.id for x in live.select("id").collect()}) or chains(live, known))
    assert resolved(spark, own, inner | leaves) == want
    assert followed and not any(ids & set(leaves) for ids in followed)
    monkeypatch.setattr(features, "COMMON", 5)  # a parent of over a fifth of the edges
    assert resolved(spark, own, inner | leaves) == want
    monkeypatch.setattr(features, "SEGMENT", 1)
    for most in (128, 64):  # of two words some leaves seem to be parents; one word cannot hold them
        monkeypatch.setattr(features, "MOST_BITS", most)
        assert resolved(spark, own, inner | leaves) == want


# Files of several parts


def test_part_files_are_one_file(spark, tmp_path):
    rows = spark.range(0, 500, 1, 5).select(F.format_string("p%d\tm\t1\tPfam\tPF1\t%s", F.col("id") % 7, F.when(F.col("id") < 100, "-").otherwise(F.concat(F.lit("d"), "id"))).alias("value"))
    path = str(tmp_path / "x.tsv")
    writers.write_lines(rows, path, header=["# made"])
    assert len(list((tmp_path / "x.tsv").glob("part-*"))) > 3  # no task writes them all
    got = {x.line: x.value for x in readers.numbered_lines(spark, path).collect()}
    assert got == {0: "# made"} | {i + 1: x.value for i, x in enumerate(rows.orderBy(F.monotonically_increasing_id()).collect())}
    assert {(x.path.rsplit("/", 1)[1], x.file) for x in readers.lines(spark, path).collect()} == {("x.tsv", "x.tsv")}
    assert {x.protein_id: x["product"] for x in readers.read_interpro(spark, path).collect()} == {f"p{i % 7}": f"d{i}" for i in range(100, 107)}
    ordered = str(tmp_path / "y.tsv")
    writers.write_lines(rows.select((-F.monotonically_increasing_id()).alias("o"), "value"), ordered, ["o"], ["# made"])
    assert [got[i] for i in sorted(got, reverse=True) if i] == [x.value for x in readers.numbered_lines(spark, ordered).where("line > 0").orderBy("line").collect()]


# Tiles and permutations


def test_distances_in_tiles(spark, monkeypatch):
    r = np.random.default_rng(23)
    full = r.standard_normal((40, 11))
    full[r.random(full.shape) < 0.3] = np.nan
    full[:, 9] = np.nan
    rows = [(f"s{j}", f"g{i}", float(full[i, j])) for i in range(40) for j in range(11) if not np.isnan(full[i, j])]
    expr = spark.createDataFrame(rows, "sample_id string, gene_id string, logcpm double")
    names = sorted({x[0] for x in rows})
    columns = {n: full[:, int(n[1:])] for n in names}
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    squares = {p: np.sort((lambda d: d[~np.isnan(d)])((columns[p[0]] - columns[p[1]]) ** 2))[::-1] for p in pairs}
    for cells in (100, 300, 10**6):  # blocks of one sample, of a few, of all
        monkeypatch.setattr(explore, "TILE_CELLS", cells)
        assert {(x.s1, x.s2): x.distance for x in explore.sample_distance(expr).collect()} == pytest.approx({p: math.sqrt(d.sum()) for p, d in squares.items() if len(d)})
        assert {(x.s1, x.s2): x.distance for x in explore.leading_distance(expr, 5).collect()} == pytest.approx({p: math.sqrt(d[:5].mean()) for p, d in squares.items() if len(d)})
        got = {(x.s1, x.s2): x.g for x in explore.gram_matrix(expr, "logcpm").collect()}
        assert got == pytest.approx({(a, b): float(np.nansum(columns[a] * columns[b])) for i, a in enumerate(names) for b in names[i:]})
    assert explore.sample_distance(expr.limit(0)).count() == 0
    plan = explore.sample_distance(expr)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    monkeypatch.setattr(explore, "MOST_SAMPLES", 3)
    with pytest.raises(ValueError):
        explore.sample_distance(expr)


def test_more_genes_make_more_slices(spark, monkeypatch):
    """Values are sent once where a tile has room for all samples, however many genes there are."""
    expr = spark.range(400).select(F.concat(F.lit("s"), F.col("id") % 4).alias("sample_id"), F.floor(F.col("id") / 4).alias("gene_id"), F.sqrt("id").alias("logcpm"))
    store, none = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway.new_array(spark._jvm.double, 0)

    def sent(df):
        before = store.stageList(None, False, False, none, None).size()
        rows = df.collect()
        stages = store.stageList(None, False, False, none, None)  # the newest first
        return rows, sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size() - before))

    want = {(x.s1, x.s2): x.distance for x in explore.sample_distance(expr).collect()}
    monkeypatch.setattr(explore, "TILE_CELLS", 100)
    rows, records = sent(explore.sample_distance(expr))
    assert {(x.s1, x.s2): x.distance for x in rows} == pytest.approx(want)
    assert 400 <= records < 800


def test_index_permutations_are_permutations():
    for n in (1, 2, 3, 10, 64, 1000):
        seen = [tuple(enrichment.permuted(np.arange(n), n, key)) for key in range(4)]
        assert all(sorted(x) == list(range(n)) for x in seen)
        assert n < 10 or len(set(seen)) == 4


def test_significance_against_a_plain_loop(spark):
    r = random.Random(29)
    scores = {f"g{i}": r.gauss(0, 1) for i in range(80)}
    sets = {"top": sorted(scores, key=scores.get)[-8:], "low": sorted(scores, key=scores.get)[:8], "mixed": r.sample(sorted(scores), 8), "other": r.sample(sorted(scores), 15)}
    ranked = spark.createDataFrame(list(scores.items()), "gene_id string, score double")
    members = spark.createDataFrame([(g, s) for s, gs in sets.items() for g in gs], "gene_id string, set_id string")
    got = {x.set_id: x for x in enrichment.permutation_significance(ranked, members, 60, seed=3).collect()}
    order = sorted(scores, key=lambda g: (-scores[g], g))

    def extreme(hits):
        mass, total, best = sum(abs(scores[order[k]]) for k in hits), 0.0, 0.0
        for k, g in enumerate(order):
            total += abs(scores[g]) / mass if k in hits else -1 / (len(order) - len(hits))
            best = total if abs(total) > abs(best) + 1e-12 else best
        return best

    for name, genes in sets.items():
        es = extreme({order.index(g) for g in genes})
        nulls = [extreme(set(enrichment.permuted(np.arange(len(genes)), 80, 3 * 1_000_003 + b).tolist())) for b in range(60)]
        side = [x for x in nulls if (x >= 0) == (es >= 0)]
        assert got[name].es == pytest.approx(es)
        assert got[name].PValue == pytest.approx((1 + sum(abs(x) >= abs(es) for x in side)) / (1 + len(side)))
        assert got[name].nes == pytest.approx(es / (sum(map(abs, side)) / len(side)))
    assert got["top"].PValue < 0.1 and got["low"].PValue < 0.1 and got["low"].es < 0


# Hashes, libraries and designs


def test_hashes_are_streamed(spark, tmp_path):
    want = {}
    for i in range(7):
        data = random.Random(i).randbytes(1000 * i)
        (tmp_path / f"f {i}.gz").write_bytes(data)  # packed files are hashed as they are
        want[f"f {i}.gz"] = hashlib.sha256(data).hexdigest()
    got = readers.file_hashes(spark, str(tmp_path), block=64)
    assert {x.path.rsplit("/", 1)[1]: x.sha256 for x in got.collect()} == want
    assert "content" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_libraries_of_any_mode(spark):
    counts_ = spark.createDataFrame([(s, f"g{i}", n) for s in "abcd" for i, n in enumerate([3, 0, 7])], "sample_id string, gene_id string, n bigint")
    cats = spark.createDataFrame([(s, c, 1) for s in "ab" for c in library_qc.HTSEQ_COUNTERS] + [("c", "Assigned", 10), ("c", "Unassigned_x", 10)], "sample_id string, category string, n bigint")
    lib = [("a", "htseq_raw", "exclusive", "full", "fragment", None, 16), ("b", "htseq_matrix", "exclusive", "filtered", None, 12, None), ("c", "featurecounts_raw", "exclusive", "full", "read", None, None), ("d", "htseq_raw", "shared", "full", "read", None, None)]
    libraries = spark.createDataFrame(lib, "sample_id string, format string, mode string, universe string, unit string, reported_assigned bigint, reported_total bigint")
    metrics = library_qc.library_metrics(counts_, cats, libraries)
    m = {x.sample_id: x for x in metrics.collect()}
    assert (m["a"].assignment_rate_pct, m["a"].problems) == (pytest.approx(1000 / 15), ["total_differs"])
    assert (m["b"].assignment_rate_pct, m["b"].assignment_counter_rate_pct, m["b"].assignment_status) == (None, pytest.approx(1200 / 17), "unavailable")
    assert m["c"].assignment_rate_pct == 50 and m["d"].assigned_count is None and m["d"].assignment_reason == library_qc.REASONS["shared"]
    members = spark.createDataFrame([("a", "T", 2), ("c", "T", 1), ("b", "U", 1), ("d", "U", 2)], "sample_id string, merge_id string, ord int")
    t = {x.sample_id: x for x in library_qc.technical_aggregates(metrics, counts_, members).collect()}
    assert (t["T"].constituent_sample_ids, t["T"].gene_count_sum, t["T"].genes_detected, t["T"].assignment_rate_pct, t["T"].problems) == ("c|a", 20, 2, pytest.approx(2000 / 35), ["units_differ"])
    assert t["T"].assignment_counter_rate_pct is None and t["U"].assigned_count is None and t["U"].assignment_rate_pct is None and t["U"].qc_level == "technical_aggregate"


def test_designs_of_many_analyses(spark):
    rows = [("ok", i, "t" if i % 2 else "c", float(i % 3), f"u{i}", f"p{i}") for i in range(8)]
    rows += [("alias", i, "t" if i % 2 else "c", float(i % 2), f"u{i}", f"p{i}") for i in range(8)]
    rows += [("few", i, "t" if i else "c", float(i), f"u{i}", f"p{i}") for i in range(2)]
    rows += [("pairs", i, "t" if i % 2 else "c", float(i), f"u{i // 2}", f"p{min(i // 2, 2)}") for i in range(8)]
    df = spark.createDataFrame(rows, "a string, sample_id int, treatment string, dose double, unit string, subject string")
    got = {}
    for x in designs.design_checks(df, "a", {"treatment": "c"}, ["dose"], unit="unit").collect():
        got.setdefault(x.key, set()).add((x.rule, x.detail))
    assert "ok" not in got and got["alias"] == {("rank", "dose")} and got["pairs"] == {("repeated_units", "")}
    assert got["few"] == {("rank", "dose"), ("residual_df", ""), ("replication", "c"), ("replication", "t")}
    paired = {(x.rule, x.key) for x in designs.design_checks(df.where("a = 'pairs'"), "a", {"treatment": "c"}, ["dose"], unit="unit", subject="subject").collect()}
    assert paired == {("subject_unit", "pairs")}
    for name in ("ok", "alias", "pairs"):
        part = [x for x in rows if x[0] == name]
        x = np.array([[1.0, r[2] == "t", r[3], (r[2] == "t") * r[3]] for r in part])
        assert one(designs.design_ranks(df.where(F.col("a") == name), "a", {"treatment": "c"}, ["dose"], [("treatment", "dose")])).rank == np.linalg.matrix_rank(x)
    cells = spark.createDataFrame([("k", "c1", 1.0, "t"), ("k", "c2", -1.0, "c"), ("l", "c1", 1.0, "none"), ("l", "c2", -1.0, "t")], "contrast_id string, cell_id string, weight double, treatment string")
    assert {(x.rule, x.key) for x in designs.contrast_support(df.where("a = 'few'"), cells, ["treatment"], "unit").collect()} == {("few_units", "k|c1"), ("few_units", "k|c2"), ("empty_cell", "l|c1"), ("few_units", "l|c2")}
    assert {(x.rule, x.key) for x in designs.contrast_support(df.where("a = 'pairs'"), cells, ["treatment"], "unit", "subject").collect()} == {("empty_cell", "l|c1"), ("few_subjects", "l")}


# Work that is done once


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_cigar_is_parsed_once(spark, monkeypatch):
    reads = spark.createDataFrame(
        [("r1", "c", 20, 9, "3S4M2D3M5N2I6M", "A" * 18), ("r2", "c", 20, 0, "*", ""), ("r3", "c", 20, 4, None, ""), ("r4", "c", 20, 99, "5=x2X", "A" * 7)],
        "read_id string, chrom string, mapq int, pos0 int, cigar string, seq string",
    )
    blocks = intervals.aligned_blocks(reads.repartition(2))  # a local table would be computed by the optimizer
    assert plan_of(blocks).count("regexp_extract_all(") == 1
    got = sorted((x.read_id, x.start, x.end, x.seq_at) for x in blocks.collect())
    assert got == [("r1", 10, 13, 4), ("r1", 16, 18, 8), ("r1", 24, 29, 13), ("r4", 100, 104, 1), ("r4", 105, 106, 6)]
    seen = []
    join = intervals.overlap_join
    monkeypatch.setattr(intervals, "overlap_join", lambda left, *a, **b: seen.append(plan_of(left)) or join(left, *a, **b))
    snps = spark.createDataFrame([("c", 17), ("c", 50)], "chrom string, pos int")
    routes = intervals.split_by_snps(blocks, snps, 500)
    assert {x.read_id: x.route for x in routes.collect()} == {"r1": "to_remap", "r4": "keep"}
    assert "regexp_extract_all(" not in seen[0] and "regexp_extract_all(" not in plan_of(routes)


def test_blocks_of_one_place_are_paired_once(spark):
    genes = spark.createDataFrame([(f"g{i}", "c", 100 * i, 100 * i + 50) for i in range(20)] + [(f"h{i}", "d", 100 * i, 100 * i + 60) for i in range(20)], "gene_id string, chrom string, start int, end int")
    rows = [(i, "c", 100 * (i % 3), 100 * (i % 3) + 470, "d", 200, 680, i % 2 == 0) for i in range(60)] + [(60, "c", 0, 470, "d", 0, 900, False), (61, None, 0, 470, "d", 0, 470, False), (62, "c", 0, 470, "d", 200, 680, None)]
    blocks = spark.createDataFrame(rows, "block_id int, chrom string, start int, end int, b_chrom string, b_start int, b_end int, inverted boolean")
    pairs = intervals.pairs_of_spans(genes, genes, blocks, 300)
    assert pairs.count() == 6 * 5 + 5  # six places, and that of the block without a direction, not 61 blocks
    other = blocks.select("block_id", F.col("b_chrom").alias("chrom"), F.col("b_start").alias("start"), F.col("b_end").alias("end"))
    want = intervals.pair_by_position(intervals.genes_in_blocks(genes, blocks, 300), intervals.genes_in_blocks(genes, other, 300), blocks.select("block_id", "inverted"))
    got = sorted(map(tuple, intervals.pairs_of_blocks(pairs, blocks).collect()))
    assert got == sorted(map(tuple, want.collect())) and len(got) == 61 * 5


def test_permutations_by_ranges_of_ranks(spark, monkeypatch):
    for n in (1, 2, 3, 10, 1000):
        assert all((enrichment.index_of(enrichment.permuted(np.arange(n), n, key), n, key) == np.arange(n)).all() for key in range(4))
    r = random.Random(31)
    ranked = spark.createDataFrame([(i, r.gauss(0, 1)) for i in range(300)], "gene_id int, score double")
    members = spark.createDataFrame([(g, s) for s, k in (("a", 5), ("b", 40), ("c", 41), ("all", 300)) for g in r.sample(range(300), k)], "gene_id int, set_id string")

    def told():
        return {x.set_id: (x.es, x.n_hits, x.nes, x.PValue) for x in enrichment.permutation_significance(ranked, members, 60, seed=5).collect()}

    want = told()
    monkeypatch.setattr(enrichment, "RANGE", 37)
    monkeypatch.setattr(enrichment, "TRIES", 7)
    got = told()
    assert set(got) == {"a", "b", "c"} and all(got[k] == pytest.approx(want[k]) for k in want)
    monkeypatch.setattr(enrichment, "MOST_RANKED", 100, raising=False)  # there was a limit that raised
    assert told() == got
    assert enrichment._tasks(300, 60) == 9 * 9  # work of few rows is not put in one task


def test_length_offsets_sort_genes_once(spark, monkeypatch):
    r = random.Random(7)
    rows = [(f"S{s}", f"g{g}", r.uniform(500, 3000), r.randint(0, 50)) for s in range(3) for g in range(40)]
    lengths = spark.createDataFrame(rows, "sample_id string, gene_id string, length double, n int")
    seen = []
    tmm = normalize.tmm_factors
    monkeypatch.setattr(normalize, "tmm_factors", lambda counts: seen.append(plan_of(counts)) or tmm(counts))
    got = {(x.sample_id, x.gene_id): x.offset for x in normalize.length_offsets(lengths).collect()}
    assert "Window" not in seen[0] and len(got) == 120
    mean = {f"g{g}": math.fsum(math.log(x[2]) for x in rows if x[1] == f"g{g}") / 3 for g in range(40)}
    base = {s: got[s, "g0"] - math.log(next(x[2] for x in rows if x[:2] == (s, "g0"))) + mean["g0"] for s in ("S0", "S1", "S2")}
    assert all(got[s, g] == pytest.approx(math.log(length) - mean[g] + base[s]) for s, g, length, _ in rows)


def test_fasta_lines_stay_in_their_splits(spark, tmp_path):
    r = random.Random(17)
    seqs = {f"k{i}": "".join(r.choices("ACGT", k=r.choice((0, 1, 30, 700)))) for i in range(60)}
    text = "stray\n" + "".join(f">{k} x\n" + "".join(f" {s[i : i + 7]} \n\n" for i in range(0, len(s), 7)) for k, s in seqs.items())
    (tmp_path / "g.fa").write_text(text)
    before, batch = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for split, rows in (("128m", "10000"), ("900", "10000"), ("900", "3"), ("128m", "5")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
            lines = readers.fasta_lines(spark, str(tmp_path / "g.fa"))
            assert plan_of(lines).split("Window")[0].count("MapInArrow") == 1  # rows of splits alone are in windows
            got = {}
            for x in lines.orderBy("at").collect():
                parts = got.setdefault(x.seq_id, [])
                assert x.start == sum(map(len, parts))
                parts.append(x.chunk)
            assert {k: "".join(v) for k, v in got.items()} == {k: s for k, s in seqs.items() if s}
            chunks = {(x.chrom, x.chunk_no): x.chunk for x in sequences.genome_chunks(lines, 50).collect()}
            assert chunks == {(k, i): s[50 * i : 50 * i + 51] for k, s in seqs.items() for i in range((len(s) + 49) // 50)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
