"""Order within groups that are too large for one task: rows dealt to ranges, each with what lies before it."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import kept


def _same(by: list[str], prefix: str = "__k_") -> Column:
    on = F.col("__part") == F.col("__p")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(prefix + c))
    return on


def placed(rows: DataFrame, by: list[str], order: list, weight: Column | None = None) -> DataFrame:
    """``rows`` with ``__before``, the weight of the rows of the same group before each, ``__total``, that of the group, and ``__part``, its range.

    Rows are dealt to ranges of ``by`` and ``order`` of equal size, wherever groups end, and written, as ranges are drawn anew each time. Within a range one sort per group
    gives the sum so far; the sums of ranges, a row per group and range, are summed over the ranges before. No group lies in one task. ``order`` should
    tell rows of a group apart, or equal ones stand in any order.
    """
    weighted = rows.withColumn("__w", F.lit(1) if weight is None else weight)
    ranged = kept(weighted.repartitionByRange(*by, *order).withColumn("__part", F.spark_partition_id()), "ranges")
    sums = ranged.groupBy(*by, "__part").agg(F.sum("__w").alias("__s"))
    group = Window.partitionBy(*by)
    ahead = F.coalesce(F.sum("__s").over(group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(*[F.col(c).alias(f"__k_{c}") for c in by], F.col("__part").alias("__p"), ahead.alias("__ahead"), F.sum("__s").over(group).alias("__total"))
    here = F.coalesce(F.sum("__w").over(Window.partitionBy(*by, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    local = ranged.withColumn("__here", here)
    return local.join(sums, _same(by)).withColumn("__before", F.col("__ahead") + F.col("__here")).select(*rows.columns, "__before", "__total", "__part")


def least_from_here(ranged: DataFrame, by: list[str], order: list, value: str, name: str) -> DataFrame:
    """``ranged`` of ``placed`` with the least ``value`` of this row and those after it in its group; each range takes the least of the later ones along.

    Rows are walked from the last one on, as a frame that ends with the group is computed anew for every row.
    """
    upto, down = Window.unboundedPreceding, [F.desc(c) for c in order]
    least = ranged.groupBy(*by, "__part").agg(F.min(value).alias("__m"))
    later = F.min("__m").over(Window.partitionBy(*by).orderBy(F.desc("__part")).rowsBetween(upto, -1))
    least = least.select(*[F.col(c).alias(f"__k_{c}") for c in by], F.col("__part").alias("__p"), later.alias("__later"))
    here = F.min(value).over(Window.partitionBy(*by, "__part").orderBy(*down).rowsBetween(upto, Window.currentRow))
    joined = ranged.withColumn("__here", here).join(least, _same(by))
    return joined.withColumn(name, F.least("__here", "__later")).drop("__here", "__later", "__p", *[f"__k_{c}" for c in by])


def first_rows(rows: DataFrame, by: list[str], order: list[str], most: int, weight: Column | None = None) -> DataFrame:
    """The first rows of each group in ``order``, up to and with the one with which ``most`` (rows, or weight) is reached.

    Only the keys are dealt to ranges; each group's last key picks its rows where they are. Rows of one key stay or go together.
    """
    narrow = rows.select(*by, *order, (F.lit(1) if weight is None else weight).alias("__weight"))
    within = placed(narrow, by, order, F.col("__weight")).where(F.col("__before") < most)
    last = within.groupBy(*[F.col(c).alias(f"__k_{c}") for c in by]).agg(F.max(F.struct(*order)).alias("__last"))
    if not by:
        key = last.first()["__last"]  # one key of all rows
        return rows.limit(0) if key is None else rows.where(F.struct(*order) <= F.struct(*[F.lit(v).cast(rows.schema[c].dataType).alias(c) for c, v in zip(order, key, strict=True)]))
    on = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in by])
    return rows.join(last, on).where(F.struct(*order) <= F.col("__last")).select(*rows.columns)


def exact_quantiles(rows: DataFrame, by: list[str], value: str, shares: list[float]) -> DataFrame:
    """``by, q``: quantiles of the values that are not missing, by linear interpolation between neighbours, as an array in the order of ``shares``.

    Values are counted first, so equal ones make one row, and placed in ranges; the two rows that hold a quantile's places are picked by their sums.
    """
    counted = rows.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    at = placed(counted, by, ["__v"], F.col("__n"))
    holds = lambda k: F.max(F.when((F.col("__before") <= k) & (k < F.col("__before") + F.col("__n")), F.col("__v")))
    place = lambda p: (F.col("__total") - 1) * F.lit(float(p))
    picked = at.groupBy(*by).agg(
        F.max("__total").alias("__total"), *[f(place(p)).alias(f"__{n}{i}") for i, p in enumerate(shares) for n, f in (("lo", lambda x: holds(F.floor(x))), ("hi", lambda x: holds(F.ceil(x))))]
    )
    between = [F.col(f"__lo{i}") + (F.col(f"__hi{i}") - F.col(f"__lo{i}")) * (place(p) - F.floor(place(p))) for i, p in enumerate(shares)]
    return picked.select(*by, F.array(*between).alias("q"))
