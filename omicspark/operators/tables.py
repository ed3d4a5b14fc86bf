"""Keyed tables: unions, what is in both or in one, and the first or last row of a key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_distinct(parts: list[DataFrame]) -> DataFrame:
    """Different rows of tables with the same columns."""
    return reduce(DataFrame.unionByName, parts).distinct()


def in_both(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Different keys of ``left`` that ``right`` has too: a semi-join, so the right side's copies do not multiply."""
    return left.select(*keys).distinct().join(right, keys, "left_semi")


def only_in(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Different keys of ``left`` that ``right`` lacks."""
    return left.select(*keys).distinct().join(right, keys, "left_anti")


def one_per_key(df: DataFrame, keys: list[str], order: list[str], last: bool = True) -> DataFrame:
    """The last (or first) row of each key by ``order``: one struct per key is kept on the map side already."""
    others = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    return df.groupBy(*keys).agg(pick(F.struct(*others), F.struct(*order)).alias("row")).select(*keys, "row.*")
