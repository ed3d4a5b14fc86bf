"""Secrets below several encodings, names that clash in every stage, and tokenizers whose normaliser replaces words."""

import base64
import json
import random
import textwrap

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from omicspark.llm import bpe_tree, secrets
from omicspark.llm.queries import tokenizer_path
from tests.llm.test_rows import der, frame, rsa_key

KEY = rsa_key()
B64 = base64.b64encode(KEY).decode()
PEM = f"-----BEGIN RSA PRIVATE KEY-----\n{textwrap.fill(B64, 64)}\n-----END RSA PRIVATE KEY-----"
TOKEN = ".".join(base64.urlsafe_b64encode(x).decode().rstrip("=") for x in (b'{"alg":"HS256"}', b'{"sub":"1"}', bytes(32)))
twice = lambda x: base64.b64encode(base64.b64encode(x)).decode()


@pytest.mark.parametrize(
    "secret, kind",
    [
        (base64.b64encode(PEM.encode()).decode(), "key"),
        (PEM.encode().hex(), "key"),
        (twice(KEY), "key"),
        (KEY.hex().encode().hex(), "key"),
        (base64.b64encode(KEY.hex().encode()).decode(), "key"),
        (base64.b64encode(TOKEN.encode()).decode(), "key"),
        (textwrap.fill(B64, 76), "key"),
        (textwrap.fill(base64.b64encode(PEM.encode()).decode(), 64), "key"),
        (json.dumps({"k": PEM})[7:-2], "pem"),
        (PEM.replace("\n", "\\r\\n"), "pem"),
    ],
)
def test_secrets_below_encodings(secret, kind):
    text = f"one two {secret} three"
    assert secrets.confirmed_spans(text) == [(8, 8 + len(secret), kind)]


def test_near_misses_are_no_secrets():
    r = random.Random(9)
    nine = der(0x30, *[der(2, bytes([1])) for _ in range(9)])
    primes = der(0x30, der(2, b"\0"), *[der(2, bytes([1]) + r.randbytes(n)) for n in (64, 3, 64, 8, 8, 32, 32, 32)])
    short = der(0x30, der(2, b"\0"), der(0x30, der(0x06, bytes([42, 134, 72]))), der(0x04, der(0x04, b"abc")))
    for data in (nine, primes, short, b"just a long text that is encoded and says nothing at all", r.randbytes(90)):
        for form in (base64.b64encode(data).decode(), data.hex(), twice(data), base64.b64encode(data.hex().encode()).decode()):
            assert not secrets.confirmed_spans(f"x {form} y"), data
    for _ in range(4):
        deep = KEY
        for _ in range(secrets.LAYERS + 2):
            deep = base64.b64encode(deep)
    assert not secrets.confirmed_spans(deep.decode())  # below more layers than are looked at


def test_stages_take_any_column_names(spark, tmp_path):
    rows = [(1, "a b c d e f", "en", "s"), (2, "A b c d e f", "en", "s"), (3, "an idiot and a moron", "en", None), (None, None, None, None), (5, " ".join(f"w{i}" for i in range(40)), "en", "t")]
    spark.createDataFrame([(1, 1, 0), (3, 1, 1)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = frame(spark, rows)
    for c in ("__id", "__MARK", "__keep_id", "__sha", "__copies", "__copy", "___id", "mark", "found", "keep_id", "component_id", "ratio", "taken"):
        docs = docs.withColumn(c, F.lit(f"kept {c}"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        assert {tuple(r[8:]) for r in out.collect()} <= {tuple(f"kept {c}" for c in docs.columns[8:])}, name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == len(rows)


def test_words_that_are_replaced(tmp_path):
    made = json.load(open(tokenizer_path(), encoding="utf-8"))
    steps = made["normalizer"]["normalizers"]
    steps.insert(1, {"type": "Replace", "pattern": {"String": "new york"}, "content": "nyc"})
    path = tmp_path / "replacing.json"
    path.write_text(json.dumps(made), encoding="utf-8")
    assert bpe_tree.by_runs(tokenizer_path()) and not bpe_tree.by_runs(str(path))
