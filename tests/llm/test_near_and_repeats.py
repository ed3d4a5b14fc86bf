"""Near duplicates, exact copies and repeated passages against brute force."""

import hashlib
import random
import re

import pytest

from omicspark.llm import exact_dedup, partenum_join, suffix_dedup
from omicspark.llm.hashing import shingle_sets
from tests.comparing import connection, difference

WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def texts(n=60, seed=3):
    """Invented rows: bases, copies, near copies, shared passages, edge cases."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeéfg") for _ in range(r.randint(1, 7))) for _ in range(400)]
    base = [[r.choice(vocab) for _ in range(r.choice([3, 20, 60, 150, 400]))] for _ in range(n)]
    passage = [r.choice(vocab) for _ in range(60)]
    out = []
    for words in base:
        out.append(" ".join(words))
        near = list(words)
        for _ in range(len(near) // r.choice([20, 60, 150])):
            near[r.randrange(len(near))] = r.choice(vocab)
        out.append("\n".join(near).upper() if r.random() < 0.3 else " ".join(near))
        if r.random() < 0.4:
            at = r.randrange(len(words))
            out.append(" ".join(words[:at] + passage + words[at:]))
    out += [None, "", "   ", "one", "one", "x" * 3000, "x" * 3000, "\n\t", "É a b c", "é a b c"]
    return [(i * 3 % 1009, t) for i, t in enumerate(out)]


def near_brute(rows, width, percent):
    sets = {}
    for d, t in rows:
        w = WORD.findall((t or "").translate(LOW))
        sets[d] = {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in ids}


@pytest.mark.parametrize("width,percent", [(4, 85), (5, 80), (2, 60)])
def test_near_duplicates(spark, width, percent):
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in partenum_join.near_duplicates(docs, width, percent).collect()}
    assert got == near_brute(rows, width, percent)


def test_signatures_are_shared_by_all_linked_sets():
    r = random.Random(5)
    import numpy as np

    for size in (1, 5, 30, 60, 200, 900, 4000):
        for _ in range(20):
            a = np.unique(np.array([r.getrandbits(64) for _ in range(size)], dtype=np.uint64))
            for percent in (80, 85):
                drop = r.randint(0, size * (100 - percent) // 100)
                b = a[sorted(r.sample(range(len(a)), len(a) - drop))]
                extra = max(0, (100 * len(b) // percent) - len(a) - 1)
                more = np.array([r.getrandbits(64) for _ in range(r.randint(0, extra) if extra else 0)], dtype=np.uint64)
                b = np.unique(np.concatenate((b, more)))
                both = len(np.intersect1d(a, b))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    assert set(partenum_join.signatures(a, percent).tolist()) & set(partenum_join.signatures(b, percent).tolist())


def test_large_group_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(partenum_join, "BLOCK", 500)
    r = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for d in range(60):
        words = list(base)
        for _ in range(r.randint(0, 5)):
            words[r.randrange(120)] = f"m{r.random()}"
        rows.append((d, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in partenum_join.near_duplicates(docs, 4, 85).collect()}
    assert got == near_brute(rows, 4, 85)


def test_near_duplicates_edges(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert partenum_join.near_duplicates(empty).count() == 0
    odd = spark.createDataFrame(
        [(None, "a b c d e f", 1), (4, "a b c d e f", 2), (4, "a b c d e f", 3), (9, "z " * 5000, 4)], "doc_id bigint, text string, node int"
    )
    rows = partenum_join.near_duplicates(odd).collect()
    assert {r.n_links for r in rows} == {0}
    got = sorted((r.doc_id or -1, r.component_id) for r in rows)
    assert got == [(-1, 4), (4, 4), (4, 4), (9, 9)]
    assert sorted(r.doc_id or -1 for r in partenum_join.keep_one_of_each(odd).collect()) == [-1, 4, 4, 9]


def test_rows_are_told_by_id_and_text(spark):
    words = [f"w{i}" for i in range(60)]
    one, other, third = " ".join(words), " ".join(words[:58] + ["x", "y"]), " ".join(reversed(words))
    docs = spark.createDataFrame([(1, one), (1, one), (2, other), (2, third), (9, third)], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.component_id, r.n_links) for r in partenum_join.near_duplicates(docs).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (2, 2, 0), (9, 2, 0)]
    assert sorted((r.doc_id, r.text) for r in partenum_join.keep_one_of_each(docs).collect()) == sorted([(1, one), (1, one), (2, third)])
    rows = spark.createDataFrame([(5, "a", 1), (5, "b", 2), (7, "A", 3), (7, "A", 4), (None, "b", 5)], "doc_id bigint, text string, kept int")
    assert sorted((r.doc_id, r.text, r.kept) for r in exact_dedup.keep_one_copy(rows).collect()) == [(5, "b", 2), (7, "A", 3), (7, "A", 4)]


def test_set_collisions_are_refused(spark, monkeypatch):
    docs = spark.createDataFrame([(1, 5, 7, 3), (2, 5, 8, 3)], "doc_id bigint, node bigint, proof bigint, n_shingles bigint")
    with pytest.raises(ValueError):
        partenum_join.refuse_collisions(docs)


def test_shingles_do_not_cross_texts():
    whole = list(shingle_sets(["a b c", None, "d e f g", ""], 4))
    assert [len(s) for s in whole] == [1, 0, 1, 0]
    assert whole[0][0] != whole[2][0]


@pytest.mark.parametrize("name", ["op1_quality_rules", "op3_exact_dedup", "op4_url_filter"])
def test_sql(spark, name):
    from omicspark.llm.queries import ORACLES, QUERIES

    sf = "/root/testdata/sf0.001"
    assert difference(QUERIES[name](spark, sf), connection(sf), ORACLES[name]) is None


def test_exact_dedup_with_colliding_digests(spark):
    from pyspark.sql import functions as F

    rows = [(1, "A"), (2, "a"), (3, "b"), (4, None), (5, ""), (6, "Ä"), (7, "ä"), (None, "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("digest", F.lit("clash"))
    for digest in (exact_dedup.sha256, lambda c: F.lit("same")):
        got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(docs, digest=digest).collect()}
        assert got == {1: (2, 2, False), 2: (2, 2, True), 3: (3, 2, True), 4: (5, 2, False), 5: (5, 2, True), 6: (6, 1, True), 7: (7, 1, True), None: (3, 2, False)}
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0
    assert sorted(r.doc_id for r in exact_dedup.keep_one_copy(docs).collect()) == [2, 3, 5, 6, 7]


def repeats_brute(rows, length):
    first, out = {}, {}
    rows = sorted((d, (t or "").encode()) for d, t in rows)
    for d, b in rows:
        for i in range(len(b) - length + 1):
            first.setdefault(b[i : i + length], d)
    for d, b in rows:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < d:
                gone[i : i + length] = [True] * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("length", [16, 50, 77])
def test_repeats(spark, length, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
    rows = texts(25, 8) + [(2000, "ab" * 400), (2001, "ba" * 300), (2002, "ab" * 20), (2003, "é" * 200), (2004, "é" * 90)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(docs, length).collect()}
    assert got == repeats_brute(rows, length)


def test_repeats_edges(spark):
    long = "the quick brown fox jumps over the lazy dog and runs away from it"
    docs = spark.createDataFrame([(None, long, 1), (3, long, 2), (3, long, 3), (5, long, 4), (6, None, 5)], "doc_id bigint, text string, later int")
    got = sorted((r.doc_id or -1, r.n_removed) for r in suffix_dedup.remove_repeats(docs).collect())
    assert got == [(-1, 0), (3, 0), (3, 0), (5, len(long)), (6, 0)]
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0
    other = long.replace("fox", "cat").replace("dog", "cow") + " and home"
    docs = spark.createDataFrame([(3, long), (3, other), (5, other + long)], "doc_id bigint, text string")
    got = sorted((r.doc_id, r.n_removed) for r in suffix_dedup.remove_repeats(docs, 20).collect())
    assert got == [(3, 0), (3, 0), (5, len(other + long))]


def test_repeats_of_runs_that_stand_often(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 300)
    r = random.Random(5)
    parts = ["".join(r.choice("abc ") for _ in range(r.randint(20, 130))) for _ in range(12)]
    rows = [(d, "".join(r.choice(parts) for _ in range(r.randint(1, 9)))) for d in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in suffix_dedup.remove_repeats(docs).collect()}
    assert got == repeats_brute(rows, 50)
