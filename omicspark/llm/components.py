"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash


def forest(pairs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Node and root for every node of ``pairs`` that is not a root: the same components, no cycles."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return [(x, r) for x in list(up) if (r := root(x)) != x]


def components(edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """``node, label`` for every node of ``edges(a, b)``: the label is the component's least node.

    Large stars and small stars in turn, each an aggregate and an equi-join, until the edges no
    longer change; the number of rounds grows with the logarithm of the graph. Edges are written
    to the shared folder each round. No component is gathered in one place: minima are
    combined on the map side and large joins keys can be split.
    """
    a, b = F.col("a"), F.col("b")
    now = edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    now, before = stash(now, "edges", large=False), None
    for _ in range(most_rounds):
        both = now.unionByName(now.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.where(b > a).join(least, a == F.col("u")).select(b.alias("a"), F.col("m").alias("b"))
        large = large.unionByName(least.where("m < u").select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low.withColumnRenamed("a", "u"), a == F.col("u"))
            .where(b != F.col("m"))
            .select(b.alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b")))
            .distinct()
        )
        now = stash(small, "edges", large=False)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(a.alias("node"), b.alias("label")).unionByName(now.select(b.alias("node"), b.alias("label")).distinct())
