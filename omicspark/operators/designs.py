"""Checks of designs and contrasts over sample tables, for many analyses at once, as rows of what is wrong."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .validate import union_all, violations

#: Levels of all factors together: columns of one design.
MOST_LEVELS = 500


def _filled(c: str) -> Column:
    return F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))


def _levels(samples: DataFrame, factors: dict[str, str]) -> dict[str, list[str]]:
    """Levels of each factor but its reference, sorted; of all analyses together."""
    out = {}
    for f, reference in factors.items():
        found = [r[0] for r in samples.select(_filled(f).alias("v")).where("v IS NOT NULL").distinct().limit(MOST_LEVELS + 1).collect()]
        if len(found) > MOST_LEVELS:
            raise ValueError(f"factor {f} has more than {MOST_LEVELS} levels")
        out[f] = sorted(set(found) - {reference})
    return out


def cross_products(samples: DataFrame, by: str, factors: dict[str, str], numerics: list[str] = (), interactions: list[tuple[str, str]] = ()) -> tuple[DataFrame, list[str]]:
    """Per analysis the cross products of its design's columns, ``by, n, products`` (the upper triangle), and the columns' names.

    Columns are treatment-coded: an intercept, a column for each level that is not the reference, numbers, and products for interactions. All come from one aggregate, in which partial sums are
    combined before the shuffle; samples never leave their tasks.
    """
    coded = {f: [(f"{f}={v}", F.coalesce(_filled(f) == v, F.lit(False)).cast("double")) for v in levels] for f, levels in _levels(samples, factors).items()}
    coded |= {c: [(c, F.coalesce(F.col(c).cast("double"), F.lit(0.0)))] for c in numerics}
    columns = [("intercept", F.lit(1.0)), *[x for parts in coded.values() for x in parts]]
    columns += [(f"{na}*{nb}", xa * xb) for a, b in interactions for na, xa in coded[a] for nb, xb in coded[b]]
    rows = samples.select(by, *[x.alias(f"x{i}") for i, (_, x) in enumerate(columns)])
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    sums = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(F.col(f"x{i}") * F.col(f"x{j}")) for i, j in pairs]).alias("products"))
    return sums, [n for n, _ in columns]


def design_ranks(samples: DataFrame, by: str, factors: dict[str, str], numerics: list[str] = (), interactions: list[tuple[str, str]] = ()) -> DataFrame:
    """``by, n_samples, n_columns, rank, residual_df, aliased``: rank of each analysis's design, from its cross products.

    Columns that an analysis does not have (levels that do not occur in it) do not count. ``aliased`` are columns that those before them already span.
    """
    sums, names = cross_products(samples, by, factors, numerics, interactions)
    kind = samples.schema[by].dataType.simpleString()
    size = len(names)

    def ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for n, products in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                m = np.zeros((size, size))
                m[np.triu_indices(size)] = products
                m += np.triu(m, 1).T
                used = np.flatnonzero(np.diag(m) > 0)
                scale = np.sqrt(np.diag(m)[used])
                chosen, aliased = [], []
                for k, i in enumerate(used):  # a column counts if it is not in the span of those before it
                    rest = 1.0
                    if chosen:
                        at = [c for c, _ in chosen]
                        inner, own = m[np.ix_(at, at)] / np.outer([s for _, s in chosen], [s for _, s in chosen]), m[at, i] / (np.array([s for _, s in chosen]) * scale[k])
                        rest = 1.0 - own @ np.linalg.lstsq(inner, own, rcond=None)[0]
                    (chosen.append((i, scale[k])) if rest > 1e-9 else aliased.append(names[i]))
                rows.append((n, len(used), len(chosen), n - len(chosen), aliased))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            types = [pa.int64()] * 4 + [pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]], names=[by, "n_samples", "n_columns", "rank", "residual_df", "aliased"])

    return sums.select(by, "n", "products").mapInArrow(ranks, f"{by} {kind}, n_samples bigint, n_columns bigint, rank bigint, residual_df bigint, aliased array<string>")


def design_checks(
    samples: DataFrame, by: str, factors: dict[str, str], numerics: list[str] = (), interactions: list[tuple[str, str]] = (), unit: str = "biological_unit_id", subject: str | None = None
) -> DataFrame:
    """What keeps the designs of ``samples(by, sample_id, ...)`` from being fitted: ``rule, key, detail``, the key an analysis.

    ``missing`` metadata, ``reference`` that does not occur, fewer than two ``levels``, numbers ``not_finite`` or ``not_varying``, ``rank`` (the detail names the columns that others span), no
    ``residual_df``, fewer than two units in a cell (``replication``), ``repeated_units`` without a subject, ``subject_unit`` not one to one, fewer than two ``subjects``, and
    ``few_units`` of a design of numbers alone.
    """
    key = F.col(by)
    columns = [*factors, *numerics, unit, *([subject] if subject else [])]
    gaps = [violations(samples.where(_filled(c).isNull()).groupBy(by).count(), "missing", F.lit(True), key, F.lit(c)) for c in columns]
    per = samples.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(unit).alias("units"), *([F.count_distinct(subject).alias("subjects")] if subject else []),
        *[F.count_distinct(_filled(f)).alias(f"levels_{i}") for i, f in enumerate(factors)], *[F.count_if(_filled(f) == r).alias(f"reference_{i}") for i, (f, r) in enumerate(factors.items())],
        *[F.count_if(~F.coalesce(_finite(c), F.lit(False))).alias(f"odd_{i}") for i, c in enumerate(numerics)], *[(F.max(F.col(c).try_cast("double")) > F.min(F.col(c).try_cast("double"))).alias(f"varies_{i}") for i, c in enumerate(numerics)],
    )
    out = [*gaps]
    for i, f in enumerate(factors):
        out += [violations(per, "reference", F.col(f"reference_{i}") == 0, key, F.lit(f)), violations(per, "levels", F.col(f"levels_{i}") < 2, key, F.lit(f))]
    for i, c in enumerate(numerics):
        out += [violations(per, "not_finite", F.col(f"odd_{i}") > 0, key, F.lit(c)), violations(per, "not_varying", ~F.coalesce(F.col(f"varies_{i}"), F.lit(False)), key, F.lit(c))]
    ranks = design_ranks(samples, by, factors, numerics, interactions)
    out += [violations(ranks, "rank", F.size("aliased") > 0, key, F.array_join("aliased", "|")), violations(ranks, "residual_df", F.col("residual_df") < 1, key)]
    if subject:
        pairs = samples.select(by, unit, subject).distinct()
        twice = lambda c: pairs.groupBy(by, c).agg(F.count(F.lit(1)).alias("k")).where("k > 1").select(by).distinct()
        out += [violations(twice(unit).unionByName(twice(subject)).distinct(), "subject_unit", F.lit(True), key), violations(per, "subjects", F.col("subjects") < 2, key)]
    else:
        out.append(violations(per, "repeated_units", F.col("units") < F.col("n"), key))
        if factors:
            cells = samples.groupBy(by, *factors).agg(F.count_distinct(unit).alias("k"))
            out.append(violations(cells, "replication", F.col("k") < 2, key, F.concat_ws("|", *factors)))
    if not factors:
        out.append(violations(per, "few_units", F.col("units") < 3, key))
    return union_all(out)


def _finite(c: str) -> Column:
    x = F.col(c).try_cast("double")
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def contrast_support(samples: DataFrame, cells: DataFrame, factors: list[str], unit: str = "biological_unit_id", subject: str | None = None) -> DataFrame:
    """What keeps contrasts of cells from being tested: ``rule, key, detail``.

    ``cells(contrast_id, cell_id, weight, *factors)`` gives each cell a value of every factor. ``empty_cell``: no sample has them; ``few_units``: a cell of weight has fewer than two units (without a subject);
    ``few_subjects``: fewer than two subjects are in all cells of weight. Cells meet samples by an equi-join on their values.
    """
    wanted = cells.select("contrast_id", "cell_id", "weight", *[F.col(f).cast("string").alias(f) for f in factors])
    have = samples.select(*[F.col(f).cast("string").alias(f) for f in factors], unit, *([subject] if subject else []))
    met = wanted.join(have, list(factors), "left")
    key = F.concat_ws("|", "contrast_id", "cell_id")
    per = met.groupBy("contrast_id", "cell_id", "weight").agg(F.count_distinct(unit).alias("units"))
    out = [violations(per, "empty_cell", F.col("units") == 0, key)]
    if subject is None:
        return union_all([*out, violations(per, "few_units", (F.col("units") == 1) & (F.col("weight") != 0), key)])
    weighed = met.where("weight <> 0")
    n_cells = weighed.groupBy("contrast_id").agg(F.count_distinct("cell_id").alias("n"))
    whole = weighed.where(F.col(subject).isNotNull()).groupBy("contrast_id", subject).agg(F.count_distinct("cell_id").alias("k"))
    complete = n_cells.join(whole, "contrast_id", "left").groupBy("contrast_id").agg(F.count_if(F.col("k") == F.col("n")).alias("subjects"))
    return union_all([*out, violations(complete, "few_subjects", F.col("subjects") < 2, F.col("contrast_id"))])
