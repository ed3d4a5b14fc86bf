"""Conversation repair, quality scores and collocations against plain loops."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from omicspark.llm import collocations, conversation_repair, quality_classifier, word_arrays
from tests.llm.test_rows import DOCS, frame

SF = "/root/testdata/sf0.01"
ROWS = "conv_id bigint, turn bigint, role string, text string, mark int, present2 int, again string, place string"
LEGAL = re.compile(r"(s?(ua)+)?")


# Conversations


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        ink = text.strip(" \t\n\v\f\r")
        out.append("blank" if not ink else "duplicate" if (role, text) in seen else "" if ink[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def every_repair(rows):
    """All edits of few rows, with up to two inserted rows at each place: the cheapest, of equal ones the first audit."""
    found = []
    ways = [("", "", ""), ("I", "u", "user:"), ("I", "a", "assistant:"), ("II", "ua", "user:\nassistant:"), ("II", "au", "assistant:\nuser:")]
    for inserted in itertools.product(ways, repeat=len(rows) + 1):
        for edits in itertools.product("KRSD", repeat=len(rows)):  # S is the other new role
            audit, letters, lines, cost = inserted[0][0], inserted[0][1], [inserted[0][2]] * bool(inserted[0][0]), 3 * len(inserted[0][0])
            for (role, text), fault, edit, more in zip(rows, faults_of(rows), edits, inserted[1:]):
                if edit != "D" and fault in ("blank", "duplicate"):
                    break
                if edit == "D":
                    cost += 4
                else:
                    role = {"K": role, "R": "user", "S": "assistant"}[edit]
                    cost += 3 * (edit != "K") + 3 * (fault == "truncated")
                    letters += role[:1] or "?"
                    lines.append(f"{role}:{text}")
                audit += "R" if edit == "S" else edit
                audit, letters, cost = audit + more[0], letters + more[1], cost + 3 * len(more[0])
                lines += [more[2]] * bool(more[0])
            else:
                if LEGAL.fullmatch(letters):
                    found.append((cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return min(found)


def whole_strings(rows):
    """The same by a search that keeps the whole audit of each state and hands out nothing."""
    states = {0: (0, "")}

    def insert(states):
        for s, to in ((0, 2), (1, 2), (3, 2), (2, 3)):
            if s in states:
                new = (states[s][0] + 3, states[s][1] + "I")
                states[to] = min(states.get(to, new), new)
        return states

    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    states = insert(states)
    for (role, _), fault in zip(rows, faults_of(rows)):
        new = {}
        for s, (cost, audit) in states.items():
            ways = [(s, cost + 4, "D")]
            if fault in ("", "truncated"):
                extra = 3 * (fault == "truncated")
                ways += [(step.get((s, role[:1])), cost + extra, "K")] + [(step.get((s, x)), cost + extra + 3, "R") for x in "ua"]
            for to, c, e in ways:
                if to is not None:
                    new[to] = min(new.get(to, (c, audit + e)), (c, audit + e))
        states = insert(new)
    return min(states[s] for s in (0, 3) if s in states)


def repaired(rows):
    seen, audit, result = set(), [], None
    flagged = []
    for k, (role, text) in enumerate(rows):
        flagged.append((k, role, text, (role, text) in seen))
        seen.add((role, text))
    lines = []
    for x in conversation_repair.repair(iter(flagged)):
        if isinstance(x, dict):
            result = x
        else:
            audit.append(x.edit)
            if x.role is not None:
                lines.append(f"{x.role}:{x.text}")
    return result["cost"], "".join(audit), hashlib.sha256("\n".join(lines).encode()).hexdigest()


def random_rows(r, n):
    return [(r.choice(["user", "user", "assistant", "assistant", "system", "tool", ""]), r.choice(["Hi.", "so", " \n", "What?", "", "yes! ", f"{r.random()}."])) for _ in range(n)]


def test_repairs_against_all_edits():
    r = random.Random(2)
    assert repaired([]) == (0, "", hashlib.sha256(b"").hexdigest())
    for n in [1] * 20 + [2] * 20 + [3] * 8:
        rows = random_rows(r, n)
        assert repaired(rows) == every_repair(rows), rows


def test_repairs_of_long_conversations():
    r = random.Random(3)
    for roles in (["user", "assistant"], ["user"], ["assistant"], ["tool", "system"], ["user", "assistant", "tool", "system", ""]):
        rows = [(r.choice(roles), r.choice([f"{i}.", f"{i}", "Hi."])) for i in range(250)]
        assert repaired(rows)[:2] == whole_strings(rows), roles


def test_unresolved_ties_take_no_walk_back():
    rows = [("tool", f"{i}.") for i in range(20_001)]  # the first edit rests on the last
    cost, audit, _ = repaired(rows)
    assert (cost, audit) == (3 * 20_000 + 4, "D" + "R" * 20_000)


def held_nodes(root):
    stack, n = [root], 0
    while stack:
        n += 1
        stack += stack.pop().children
    return n


def test_only_unresolved_edits_are_held():
    for roles in (["user", "assistant"], ["user"], ["system", "user", "user"]):
        s, most = conversation_repair.Survivors(), 0
        for i in range(5000):
            for _ in s.row(roles[i % len(roles)], f"{i}", ["", "truncated", "blank"][i % 3]):
                pass
            most = max(most, held_nodes(s.root))
        assert most < 60, roles


def test_rows_that_are_odd(spark):
    rows = [
        (1, None, "user", "Hi."), (1, 0, "assistant", "Yes."), (1, 0, "assistant", "Yes."), (1, 9, None, None), (2, 5, "user", ""), (None, 1, "user", "A."), (None, 2, "assistant", "B."),
    ]
    talk = spark.createDataFrame([(*x, 1, 2, "c", "d") for x in rows], ROWS)
    got = {x.conv_id: x for x in conversation_repair.repair_summary(talk).collect()}
    assert (got[1].gaps, got[1].blank, got[1].duplicate, got[1].truncated, got[1].illegal, got[1].cost, got[1].audit) == (8, 1, 1, 0, 2, 8, "KKDD")
    assert (got[2].cost, got[2].audit, got[2].gaps) == (4, "D", 0) and got[2].repaired_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[None].audit == "KK" and got[None].repaired_sha256 == hashlib.sha256(b"user:A.\nassistant:B.").hexdigest()
    assert conversation_repair.repair_summary(talk.limit(0)).count() == 0
    named = talk.where("conv_id = 2").withColumn("present", F.lit(False))
    only = conversation_repair.repair_summary(named).collect()
    assert len(only) == 1 and only[0].audit == "" and only[0].cost == 0 and only[0].blank == 0
    kept = conversation_repair.repaired_rows(talk).where("conv_id = 1").orderBy("place").collect()
    assert [(x.edit, x.role, x.text) for x in kept] == [("keep", "user", "Hi."), ("keep", "assistant", "Yes.")]


def test_very_long_texts_and_conversations(spark):
    talk = spark.range(30_000).select(F.lit(7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.col("id").cast("string"), F.lit(".")).alias("text"))
    long = spark.createDataFrame([(8, 0, "user", "x" * 5_000_000 + "."), (8, 1, "assistant", "y" * 5_000_000)], "conv_id bigint, turn bigint, role string, text string")
    got = {x.conv_id: x for x in conversation_repair.repair_summary(talk.unionByName(long)).collect()}
    assert got[7].audit == "K" * 30_000 and got[7].cost == 0
    assert got[8].audit == "KK" and got[8].truncated == 1 and got[8].repaired_sha256 == hashlib.sha256(b"user:" + b"x" * 5_000_000 + b".\nassistant:" + b"y" * 5_000_000).hexdigest()


def test_damage_is_by_checksum(spark):
    talk = spark.createDataFrame([(i, t, "assistant", "Yes. No!") for i in range(30) for t in (None, 1, 2)] + [(None, 3, None, None)], "conv_id bigint, turn bigint, role string, text string")
    got = Counter((x.conv_id, x.turn, x.role, x.text, x.present) for x in conversation_repair.damaged(talk).collect())
    want = Counter()
    for x in talk.collect():
        case = zlib.crc32(f"{' ' if x.conv_id is None else x.conv_id}:{' ' if x.turn is None else x.turn}".encode()) % 20
        role, text = x.role or " ", x.text or " "
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        want[x.conv_id, x.turn, "user" if case == 4 else role, text, case != 0] += 2 if case == 3 else 1
    assert got == want


# Quality


def statistics_brute(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    share = lambda x, y: x / max(y, 1)
    n, size, raw = len(words), len(text), text.encode()
    triples = Counter(zip(words, words[1:], words[2:]))
    lines = [x for x in text.split("\n") if x]
    return [
        math.log1p(n), math.log1p(size), math.log1p(share(sum(len(w.encode()) for w in words), n)), share(sum(65 <= b <= 90 for b in raw), sum(chr(b).isalpha() and b < 128 for b in raw)),
        share(sum(c in "0123456789" for c in text), size), share(sum(c in "#*$%&|<>" for c in text), size), share(sum(c in ".,;:" for c in text), n), share(sum(c in "!?" for c in text), n),
        share(sum(c in " \t\n\v\f\r" for c in text), size), share(sum(ord(c) > 127 for c in text), size), share(len(set(words)), n), share(max(Counter(words).values(), default=0), n),
        share(sum(x == y for x, y in zip(words, words[1:])), n), share(sum(v - 1 for v in triples.values()), n), share(len(lines) - len(set(lines)), len(lines)),
        share(sum(len(w.encode()) == 1 for w in words), n), share(sum(not (w[-1].isalpha() or ord(w[-1]) > 127) for w in words), n), share(sum("A" <= w[0] <= "Z" for w in words), n),
    ]


def test_statistics_of_texts():
    r = random.Random(5)
    texts = ["", None, " ", "\n\n", "a"] + ["".join(r.choice(["Über ", "der ", "X", "7", "#!", "\n", "one two three ", "one two three\n", ". ", "é"]) for _ in range(r.randrange(60))) for _ in range(80)]
    got = quality_classifier.statistics(pa.array(texts, pa.string()))
    assert got == pytest.approx(np.array([statistics_brute(t or "") for t in texts]), abs=1e-5)
    assert quality_classifier.statistics(pa.array(texts, pa.string()).slice(5, 20)) == pytest.approx(got[5:25])


def test_features_approximate_a_gaussian_kernel():
    r = np.random.default_rng(1)
    f = quality_classifier.Features(np.zeros(5), np.ones(5), 4000, 2.0, 3)
    x = r.standard_normal((12, 5))
    z = f(x)[:, :-1] / quality_classifier.STEPS
    near = np.exp(-((x[:, None] - x) ** 2).sum(-1) / (2 * 2.0**2))
    assert np.abs(2 / 4000 * z @ z.T - near).max() < 0.08


def test_products_are_summed_whole(spark):
    r = np.random.default_rng(2)
    rows = [([float(v) for v in r.standard_normal(18)], float(r.integers(2)), int(r.integers(1, 4))) for _ in range(300)]
    df = spark.createDataFrame(rows, "x array<float>, y double, fold bigint").repartition(5)
    f = quality_classifier.Features(np.zeros(18), np.ones(18), 20, 4.0, 1)
    got = quality_classifier.normal_equations(df, f)
    for k in (1, 2, 3):
        part = [x for x in rows if x[2] == k]
        v = np.hstack([f(np.array([x[0] for x in part], np.float32).astype(float)), 1024 * np.array([[x[1]] for x in part])]) / 1024
        assert got[k] == pytest.approx(v.T @ v)
    weights = quality_classifier.ridge(sum(got.values()), 0.01)
    a = sum(got.values())
    shrunk = a[:-1, :-1] + np.diag([0.01 * a[-2, -2]] * 20 + [1e-9])
    assert shrunk @ weights == pytest.approx(a[:-1, -1])


def test_isotonic_fit():
    r = np.random.default_rng(4)
    at, n = np.sort(r.random(40)), r.integers(1, 5, 40).astype(float)
    total = r.random(40) * n
    places, levels = quality_classifier.isotonic(at, n, total)
    # The fit at k is the largest over starts of the smallest mean over ends.
    mean = lambda i, j: total[i : j + 1].sum() / n[i : j + 1].sum()
    fit = [max(min(mean(i, j) for j in range(k, 40)) for i in range(k + 1)) for k in range(40)]
    assert (np.diff(places) > 0).all() and (np.diff(levels) > 0).all()
    assert sorted(set(np.round(fit, 9))) == pytest.approx(sorted(np.round(levels, 9)))


def test_quality_of_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    scored = quality_classifier.score_quality(docs, labels)
    told = scored.where("held_out").join(labels.where("quality IS NOT NULL"), "doc_id").collect()
    assert sum(x.predicted == x.quality for x in told) >= 0.95 * len(told)
    first = {x.doc_id: x.score for x in scored.collect()}
    turned = labels.withColumn("quality", F.when(quality_classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {x.doc_id: x.score for x in quality_classifier.score_quality(docs.repartition(7), turned).collect()} == first


def test_quality_of_odd_rows(spark):
    rows = [(i, "Some good words here. And more of them." if i % 3 else "### $$$ ### |||", "en", "a") for i in range(60)] + [(None, "x", None, None), (70, None, None, None), (71, "", "en", "a"), (3, "twice", "en", "a")]
    rows.append((72, "word " * 1_200_000, "en", "a"))
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(60)] + [(None, 1, 0), (2, None, 0)], "doc_id bigint, quality int, toxic int")
    got = quality_classifier.score_quality(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.3) for x in got)
    by = {x.doc_id: x.score for x in got}
    assert by[70] == by[71] and not next(x for x in got if x.doc_id is None).held_out
    assert {x.score for x in quality_classifier.score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert {x.score for x in quality_classifier.score_quality(docs, labels.where("quality = 1")).collect()} == {1.0}
    assert quality_classifier.score_quality(docs.limit(0), labels).count() == 0


# Collocations


def phrases_brute(rows, most_words=3, least=10, most=2000, share=50):
    found = {}
    for _, text, lang, _ in rows:
        counts = found.setdefault(lang or "und", Counter())
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            counts.update(tuple(words[i : i + m]) for m in range(1, most_words + 1) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in found.items():
        n = sum(v for k, v in counts.items() if len(k) == 1)
        good = {k: v for k, v in counts.items() if len(k) > 1 and v >= least}
        inside = lambda a, b: any(b[i : i + len(a)] == a for i in range(len(b) - len(a) + 1))
        ranked = []
        for k, a in good.items():
            score, cut = min((10**6 * a * a // (counts[k[:i]] * counts[k[i:]]), i) for i in range(1, len(k)))
            if not any(len(o) > len(k) and 100 * v >= share * a and inside(k, o) for o, v in good.items()):
                ranked.append((-score, -a, " ".join(k).encode(), counts[k[:cut]], counts[k[cut:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(ranked)[:most])]
    return sorted(out)


def phrases_of(docs, **options):
    return sorted(tuple(x) for x in collocations.collocations(docs, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def phrase_rows(r, n, words):
    text = lambda: "".join(r.choice(words) + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]) for _ in range(r.randrange(60)))
    return [(i, text(), r.choice(["en", "en", "fr", None]), "a") for i in range(n)]


WORDS = ["the", "The", "red", "red", "house", "é", "É", "#", "a\x01", "a", "z q", "new", "york", "\U0001f600"]


@pytest.mark.parametrize("most_words, least, share", [(3, 4, 50), (2, 3, 50), (4, 2, 70), (5, 2, 100)])
def test_collocations_against_plain_counts(spark, monkeypatch, most_words, least, share):
    monkeypatch.setattr(collocations, "CHUNK", 300)  # many chunks, and texts in several windows
    monkeypatch.setattr(collocations, "FILTER_BITS", (64, 64))  # a filter that is full
    rows = phrase_rows(random.Random(most_words), 120, WORDS)
    docs = spark.createDataFrame([(i, t, lang, s, 0, 1, 2, 3) for i, t, lang, s in rows], DOCS).repartition(3)
    assert phrases_of(docs, most_words=most_words, least=least, most=40, share=share) == phrases_brute(rows, most_words, least, 40, share)


def test_collocations_of_one_hot_word_cross_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(i, f"the w{i % 97} x{i % 5}. the the the", "en", "a") for i in range(1500)]
        assert phrases_of(frame(spark, rows), least=2, most=500) == phrases_brute(rows, 3, 2, 500)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_collocations_of_odd_rows(spark):
    rows = [(1, None, None, None), (2, "", "en", "a"), (None, "a b " * 20, None, "a"), (None, "a b " * 20, "und", "a"), (3, "x" * 3_000_000 + " y" + " a b" * 30, "en", "a"), (4, ". , ;", "fr", "a")]
    assert phrases_of(frame(spark, rows)) == phrases_brute(rows)
    assert phrases_of(frame(spark, rows).limit(0)) == []
    assert phrases_of(frame(spark, [(1, "too few words", "en", "a")])) == []


def test_windows_end_with_pieces():
    r = random.Random(6)
    for _ in range(200):
        text = "".join(r.choice("ab .é\n") for _ in range(r.randrange(80))).encode()
        parts = list(collocations.windows(text, 10))
        assert b"".join(parts) == text
        assert all(chr(p[-1]) in collocations.ENDS for p in parts[:-1])


def test_hashes_depend_on_bytes_alone():
    names = ["", "a", "ab", "ba", "é", "a\x00", "a" * 5000] + [f"w{i}" for i in range(2000)]
    got = word_arrays.name_hashes(pa.array(names))
    assert len(set(got.tolist())) == len(names)
    assert (word_arrays.name_hashes(pa.array(names[::-1])) == got[::-1]).all()
