"""Exact deduplication by skew-safe combining, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stash, unused


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def equal_text_groups(
    docs: DataFrame, salts: int = 64, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """Group rows of equal normalised text: ``content, digest, keep_id, group_size``.

    Three combining stages, and the whole content is part of the key in each, so two texts with
    one digest never merge: the map-side half of the first ``groupBy`` joins the copies within a
    partition, its other half merges the groups of one digest and salt, and the second ``groupBy``
    combines the at most ``salts`` winners of each text. No task sees more than its share of a
    group, however many copies the group has.
    """
    content = ascii_lower(F.col("text"))
    salted = (
        docs.select("doc_id", content.alias("content"))
        .select("*", digest(F.col("content")).alias("digest"), F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"))
        .groupBy("digest", "content", "salt")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    return salted.groupBy("digest", "content").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )


def exact_dedup(
    docs: DataFrame, salts: int = 64, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """Mark for every row of ``docs(doc_id, text, ...)`` the copy that stays.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``, one row per input row. Texts are
    equal if identical after lower-casing A-Z; null counts as empty; the largest ``doc_id`` stays.
    A null ``doc_id`` never wins over a number; a group of null ids only keeps all its rows, as do
    rows that repeat the winning ``doc_id``. An empty table gives an empty result; columns other
    than ``doc_id`` and ``text`` are ignored.

    Rows find their group by digest alone where each digest proved to have one content; if any
    digest has two, the join compares the contents as well.
    """
    groups = equal_text_groups(docs, salts, digest)
    classes = stash(groups.select("digest", "keep_id", "group_size"), "exact_classes")
    collided = classes.groupBy("digest").count().where("count > 1")
    content = ascii_lower(F.col("text"))
    if collided.isEmpty():
        rows = docs.select("doc_id", digest(content).alias("digest"))
        if digest is sha256:
            rows = rows.withColumn("text_sha256", F.col("digest"))
        else:
            rows = docs.select("doc_id", digest(content).alias("digest"), sha256(content).alias("text_sha256"))
        joined = rows.join(classes, "digest")
    else:
        rows = docs.select("doc_id", content.alias("content"), sha256(content).alias("text_sha256"))
        joined = rows.join(groups.drop("digest"), "content")
    return joined.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def keep_one_copy(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns as they were.

    A row is known by its id and its text: rows of one id with different texts are judged each, and equal ones all stay. Null texts are empty ones;
    any other column may have any name; an empty table stays empty.
    """
    keep_id, sha = unused(docs, "__keep_id", "__sha")
    kept = exact_dedup(docs).where("kept").select(F.col("doc_id").alias(keep_id), F.col("text_sha256").alias(sha)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(keep_id)) & (sha256(ascii_lower(F.col("text"))) == F.col(sha))
    return docs.join(kept, same, "left_semi")
