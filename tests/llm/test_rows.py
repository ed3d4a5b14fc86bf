"""Operators that judge rows or sources: quality, URLs, secrets, PII, mixing, BPE and toxicity."""

import base64
import hashlib
import json
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from omicspark.llm import bpe_tree, mixing, pii, quality_rules, secrets, toxicity, url_reputation
from omicspark.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0d]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, bad int, label int"


def frame(spark, rows):
    """Documents with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, lang, s, 0, 1, 2, 3) for i, t, lang, s in rows], DOCS)


# Quality


def counts_brute(text):
    words = WORD.findall(text)
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_text_counts():
    r = random.Random(1)
    for _ in range(300):
        text = "".join(r.choice(["a ", "b ", "c ", "\n", "# ", "a b c\n", "\t"]) for _ in range(r.randint(0, 60)))
        assert quality_rules.text_counts(text) == counts_brute(text)


def test_quality_thresholds_follow_their_group(spark):
    good = " ".join(f"word{i}" for i in range(60))
    noisy = " ".join(f"#{i}" for i in range(60))
    rows = [(i, good + f" x{i}", "en", "a") for i in range(40)] + [(100, noisy, "en", "a"), (101, "short", "en", "a"), (102, None, None, None)]
    rows += [(200 + i, noisy + f" y{i}", "en", "b") for i in range(40)]
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality_rules.quality_rules(frame(spark, rows)).collect()}
    assert got[0] == (False, True) and got[100] == (False, False) and got[101] == (True, False) and got[102] == (True, False)
    assert all(got[200 + i] == (False, True) for i in range(40))  # what is odd in one source is usual in the other
    assert quality_rules.quality_rules(frame(spark, rows[:1]).limit(0)).count() == 0
    assert quality_rules.quality_rules(frame(spark, [(1, "a", None, None)])).collect()[0].kept is False


def test_sketch_merges_and_bounds_the_error(spark):
    r = random.Random(2)
    values = [int(r.expovariate(0.001)) for _ in range(3000)]
    df = spark.createDataFrame([("k", v) for v in values], "k string, value bigint")
    whole = quality_rules.quantile_sketch(df, ["k"])
    parts = quality_rules.quantile_sketch(df.where("value % 2 = 0"), ["k"]).unionByName(quality_rules.quantile_sketch(df.where("value % 2 = 1"), ["k"]))
    merged = parts.groupBy("k", "bucket").agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, merged.collect()))
    q = quality_rules.quantiles(whole, ["k"], {"q": 500}).first()
    true = sorted(values)[1499]
    assert q.n == 3000 and true * (1 - 1 / 32) - 1 <= q.q <= true


# URLs

#: In these tests others register names below the example domains.
REGISTRIES = ("example.com", "example.net", "example.org")


def test_url_rules_and_reputation(spark):
    rows = [
        (1, "https://example.com/en/7/x"), (2, "http://A.Example.COM/en/6?q"), (3, "https://x.net/de/1"), (4, "https://example.net/de/80"),
        (5, None), (6, "no scheme"), (7, "ftp://org/es/#f"), (8, "https://myorg/es/"), (9, "https://h.example.net"), (10, "a://b://c/d"),
    ]
    bad = [(100 + i, "https://spam.example.net/x") for i in range(60)] + [(300 + i, "https://fine.example.org/x") for i in range(60)]
    pages = spark.createDataFrame(rows + bad, "page_id bigint, url string").withColumn("host", F.lit("clash"))
    outcomes = spark.createDataFrame([(i, 1) for i in range(100, 160)] + [(i, 0) for i in range(300, 360)] + [(None, 1), (1, None)], "page_id bigint, bad int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_reputation.filter_urls(pages, outcomes, suffixes=REGISTRIES).collect()}
    assert got[1] == ("example.com", "/en/7/x", "example.com/en/7", "allow")
    assert got[2] == ("a.example.com", "/en/6", "com/en/", "block")
    assert got[3] == ("x.net", "/de/1", "net/de/", "allow") and got[4][2:] == ("example.net/de/8", "block")
    assert got[5] == ("", "", None, "allow") and got[6] == ("", "", None, "allow")
    assert got[7] == ("org", "/es/", "org/es/", "block") and got[8][2] is None
    assert got[9] == ("h.example.net", "", None, "block")  # all that is known of its suffix is bad
    assert got[10][:2] == ("b:", "//c/d")
    assert got[100][3] == "block" and got[300][3] == "allow" and len(got) == 130
    assert url_reputation.filter_urls(pages.limit(0), outcomes).count() == 0
    assert url_reputation.filter_urls(pages, outcomes.limit(0)).count() == 130


def test_hosts_shrink_to_their_domain(spark):
    seen = [("a.one.example.com", 1)] * 40 + [("b.one.example.com", 1)] + [("c.two.example.com", 0)] * 40 + [("d.two.example.com", 1)] + [("e.three.example.com", k % 2) for k in range(40)]
    posterior = {r.host: r.a / (r.a + r.b) for r in url_reputation.host_reputation(spark.createDataFrame(seen, "host string, bad int"), REGISTRIES)[0].collect()}
    assert posterior["b.one.example.com"] > posterior["d.two.example.com"]


# Secrets


def der(tag, *parts):
    body = b"".join(parts)
    n = len(body)
    return bytes([tag]) + (bytes([n]) if n < 128 else bytes([0x82]) + n.to_bytes(2, "big")) + body


def rsa_key():
    r = random.Random(4)
    return der(0x30, der(2, b"\0"), *[der(2, bytes([1]) + r.randbytes(n)) for n in (64, 3, 64, 32, 32, 32, 32, 32)])


def base_brute(text):
    out = []
    for m in re.finditer(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end(), "assign"))
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def test_secret_base_spans():
    r = random.Random(7)
    bits = ["password", "Token", "api_key", "APIKEY", "=", ":", " ", '"', "abc12345", "AKIA", "ABCDEFGH1234", "0123456789abcdef" * 2, "deadbeef", "é", "\n", "ſecret=abcdefgh1"]
    for _ in range(800):
        text = "".join(r.choice(bits) for _ in range(r.randint(1, 14)))
        assert secrets._joined(secrets.base_spans(text)) == base_brute(text)


def test_secrets_are_confirmed_by_structure(spark):
    key = rsa_key()
    b64 = base64.b64encode(key).decode()
    head = base64.urlsafe_b64encode(json.dumps({"alg": "HS256", "typ": "JWT"}).encode()).decode().rstrip("=")
    token = f"{head}.eyJzdWIiOiIxIn0.abc_DEF-123abc_DEF-12345"
    cut = lambda x: len(x).to_bytes(4, "big") + x
    ssh = base64.b64encode(b"openssh-key-v1\0" + cut(b"none") + cut(b"none") + cut(b"") + (1).to_bytes(4, "big") + cut(cut(b"ssh-ed25519") + cut(bytes(32))) + cut(bytes(range(64)))).decode()
    cases = {
        "pem": f"x\n-----BEGIN RSA PRIVATE KEY-----\n{b64[:64]}\n{b64[64:]}\n-----END RSA PRIVATE KEY-----",
        "token": f"id {token} end",
        "key": f"blob {b64} end",
        "key ssh": f"blob {ssh} end",
        "key hex": f"blob {key.hex().upper()} end",
    }
    for name, text in cases.items():
        assert [k for _, _, k in secrets.confirmed_spans(text)][:1] == [name.split()[0]], name
    broken = base64.b64encode(key[:-5]).decode()
    fake = base64.urlsafe_b64encode(b'{"no":"algorithm"}').decode().rstrip("=")
    for text in (f"blob {broken} end", f"id {fake}.eyJzdWIiOiIxIn0.abc", "M" * 80, "30" * 60, "-----BEGIN RSA PRIVATE KEY-----\nnonsense\n-----END RSA PRIVATE KEY-----", "a" * 50_000):
        assert secrets.confirmed_spans(text) == []
    rows = [(1, cases["token"] + " password=abcdefgh1", None, None), (2, None, "en", "s"), (None, "", "en", "s"), (1, "", "en", "s")]
    got = secrets.scan_secrets(frame(spark, rows)).collect()
    assert len(got) == 4 and {r.n_assign for r in got if r.spans} == {1} and [r for r in got if "token:" in r.spans]
    assert secrets.scan_secrets(frame(spark, rows).limit(0)).count() == 0
    clean = {r.text for r in secrets.redact_secrets(frame(spark, rows[:1])).collect()}
    assert clean == {"id [SECRET] end [SECRET]"}


# PII


def pii_brute(text):
    out = [(0, m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, m.start(), m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        total = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d)))
        if 16 <= len(d) <= 19 and total % 10 == 0:
            out.append((2, m.start(), m.end(), "card"))
    out += [(3, m.start(), m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return ",".join(f"{k}:{s}:{e}" for _, s, e, k in sorted(out))


def test_pii_base_spans():
    r = random.Random(11)
    bits = ["a", "b.c", "@", "x-y", ".", "com", "12", "7", "255", "256", "0", " ", "-", "+1", "(555) ", "4111 1111 1111 1111", "4111111111111111", "é", "\n", "%", "_", "٣"]
    for _ in range(3000):
        text = "".join(r.choice(bits) for _ in range(r.randint(1, 14)))
        assert pii.joined(pii.base_spans(text)) == pii_brute(text), text


def test_revealing_terms(spark):
    fill = ["lorem", "ipsum", "dolor", "amet", "sit"]
    rows = [(i, f"{' '.join(fill)} {i} zubrowka ann@mail.example.com {' '.join(fill)} n{i}", "en", "s") for i in range(4)]
    rows += [(10 + i, " ".join(fill) + f" text {i}", "en", "s") for i in range(20)] + [(50, "Zubrowka alone", "en", "s"), (51, None, None, None), (50, "Zubrowka alone", "en", "s"), (None, "zubrowka", None, None)]
    got = [(r.doc_id, r.n_email, r.base, r.spans) for r in pii.find_pii(frame(spark, rows), disclosure=0.5).collect()]
    assert len(got) == len(rows)
    assert all(s.startswith(b) for _, _, b, s in got)
    by = defaultdict(list)
    for i, n, b, s in got:
        by[i].append((n, s))
    assert by[50] == [(0, "term:0:8")] * 2 and by[None] == [(0, "term:0:8")] and by[51] == [(0, "")]
    assert all("term" not in s for i in range(10, 30) for _, s in by[i])
    assert by[0][0][0] == 1 and by[0][0][1].count("term:") == 1
    strict = pii.find_pii(frame(spark, rows), disclosure=0.95).collect()
    assert not any("term" in r.spans for r in strict)
    clean = {r.text for r in pii.sanitise(frame(spark, rows), disclosure=0.5).collect()}
    assert "[NAME] alone" in clean and any("[TERM] [EMAIL]" in (t or "") for t in clean)
    assert pii.find_pii(frame(spark, rows).limit(0)).count() == 0


# Mixing


def test_permutation():
    for n in (1, 2, 3, 7, 64, 1000, 4097):
        assert sorted(mixing.permute(np.arange(n), n, 5).tolist()) == list(range(n))
    assert mixing.permute(np.arange(1000), 1000, 5).tolist() != mixing.permute(np.arange(1000), 1000, 6).tolist()


def targets_brute(sizes, weights, budget):
    out, full = [0.0] * len(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in full and sizes[i]]
        left = budget - sum(out[i] for i in full)
        for i in free:
            out[i] = left * weights[i] / sum(weights[j] for j in free)
        over = [i for i in free if out[i] > 2 * sizes[i] + 1e-9]
        if not over:
            return out
        for i in over:
            out[i] = 2.0 * sizes[i]
            full.add(i)


def test_targets():
    r = random.Random(3)
    for _ in range(300):
        sizes = [r.choice([0, r.randint(1, 50), r.randint(1, 5000)]) for _ in range(r.randint(1, 9))]
        w = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
        assert np.allclose(mixing.targets(sizes, w, 1.5 * sum(sizes)), targets_brute(sizes, w, 1.5 * sum(sizes)))


def test_mixing(spark):
    r = random.Random(8)
    rows = [(i, " ".join("w" for _ in range(r.choice([0, 5, 60, 300, 900]))), "en", r.choice(["a", "a", "a", "b", "ç", None])) for i in range(300)]
    rows += [(7, "w " * 40, "en", "a"), (None, "w " * 30, "en", "b"), (400, None, None, None), (401, "w", "en", "tiny")]
    docs = frame(spark, rows)
    got = mixing.mix(docs.repartition(7), chunk_docs=40).collect()
    again = mixing.mix(docs.repartition(3), chunk_docs=40).collect()
    key = lambda x: (x.doc_id is None, x.doc_id, x.size, x.taken)
    assert sorted(got, key=key) == sorted(again, key=key) and len(got) == len(rows)
    assert all(0 <= x.taken <= 2 * x.size for x in got)
    sizes = Counter()
    for x in got:
        sizes[x.source] += x.size
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = dict(zip(names, targets_brute([sizes[n] for n in names], [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5 * sum(sizes.values()))))
    taken = Counter()
    for x in got:
        taken[x.source] += x.taken
        assert x.source_size == sizes[x.source] and abs(x.target - want[x.source]) < 1e-6
    for n in names:
        assert abs(taken[n] - want[n]) <= 0.02 * want[n] + 130, (n, taken[n], want[n])
    assert mixing.mix(docs.limit(0)).count() == 0
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and 0 < out.count() and out.where("text IS NULL OR trim(text) = ''").count() == 0


# BPE


def encode_all(path, texts):
    t = bpe_tree.tokenizer(path)
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_tree_gives_the_whole_encoding(monkeypatch):
    monkeypatch.setattr(bpe_tree, "MARGIN", 20)
    path, r = tokenizer_path(), random.Random(6)
    letters = ["a", "b", "'s", "é", "e\u0301", "!", "'", " ", "1", "漢", "Ab", "<|endoftext|>", "\n", "\u0301", "ll", "ſ", "🙂", "Σ", "\u00a0", "\t", ", "]
    for k in range(600):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 700)))
        text = text.replace(" ", "").replace("\n", "") if k % 3 == 0 else text
        (want,) = encode_all(path, [text])
        assert bpe_tree.encode_tree(path, text, r.choice([40, 100, 250])) == want
        assert [x.tolist() for x in bpe_tree.encode_texts(path, [text])] == [want]
        assert bpe_tree.decode_ids(path, want) == bpe_tree.tokenizer(path).decode(want, skip_special_tokens=False)


def test_bpe_rows(spark):
    path = tokenizer_path()
    texts = ["Hello, World's end", None, "", "x" * 5000, "ab cd " * 900, "ab cd " * 900, "<|endoftext|> hi"]
    docs = frame(spark, [(i if i != 4 else 5, t, "en", "s") for i, t in enumerate(texts)] + [(None, "a b " * 700, None, None)])
    sent = texts + ["a b " * 700]
    got = bpe_tree.encode(docs, path, long_chars=300).collect()
    assert Counter(tuple(r.ids) for r in got) == Counter(map(tuple, encode_all(path, sent)))
    back = bpe_tree.decode(bpe_tree.encode(docs, path), path).collect()
    t = bpe_tree.tokenizer(path)
    assert Counter(r.text for r in back) == Counter(t.decode(x, skip_special_tokens=False) for x in encode_all(path, sent))
    digests = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe_tree.code_digests(docs, path, long_chars=300).collect()}
    ids = encode_all(path, [texts[0]])[0]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (0, len(ids), sha(" ".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))) in digests
    assert bpe_tree.code_digests(docs.limit(0), path).count() == 0


# Toxicity


def test_toxicity_learns_new_words(spark):
    r = random.Random(12)
    vocab = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(800)]
    rows, labels = [], []
    for i in range(900):
        words = [r.choice(vocab) for _ in range(40)]
        toxic = i % 9 == 0
        if toxic:
            words[r.randrange(40)] = "grulx" + r.choice(["a", "ing", "or"])
        rows.append((i, " ".join(words), "en", "s"))
        if i % 2:
            labels.append((i, 1, int(toxic)))
    rows += [(2000, "", "en", "s"), (2001, None, None, None), (None, "you are such an idiot", None, None)]
    labs = spark.createDataFrame(labels + [(None, 1, 1), (5000, 1, None)], "doc_id bigint, quality int, toxic int")
    got = {x.doc_id: x for x in toxicity.score_toxicity(frame(spark, rows), labs).collect()}
    assert len(got) == len(rows) and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in got.values())
    wrong = [i for i in range(900) if got[i].predicted != int(i % 9 == 0)]
    assert len(wrong) <= 5, wrong
    assert got[2000].score == got[2001].score < 0.5 and not got[None].held_out
    kept = toxicity.drop_toxic(frame(spark, rows), labs)
    assert kept.columns == frame(spark, rows[:1]).columns and kept.count() == sum(x.predicted == 0 for x in got.values())
    assert toxicity.score_toxicity(frame(spark, rows).limit(0), labs).count() == 0
    assert toxicity.score_toxicity(frame(spark, rows[-3:]), labs.limit(0)).count() == 3


def test_held_out_labels_are_not_read(spark):
    import zlib

    ids = spark.range(200).select(F.col("id").alias("doc_id"))
    got = {r.doc_id: r.h for r in ids.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(200)}
