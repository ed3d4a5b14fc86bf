"""A corpus pipeline of five stages, each one of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from omicspark.llm import bpe_tree, exact_dedup, mixing, partenum_join, toxicity
from omicspark.llm.common import stash
from omicspark.llm.queries import table, tokenizer_path


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows predicted toxic go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return exact_dedup.keep_one_copy(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicate texts stays: five words, a similarity of 0.8."""
    return partenum_join.keep_one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with the digests of the ids and of the text they decode to."""
    path = tokenizer_path()
    return bpe_tree.code_digests(docs, path)


STAGES = [
    ("toxicity", toxic),
    ("exact dedup", copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing", mix),
    ("bpe", encode),
]

#: Learnt scores, permutations and tokens are beyond SQL; tests hold the rows of the whole against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stash(docs, name.replace(" ", "_"))
    return docs
