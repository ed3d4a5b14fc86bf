"""Quality rules whose thresholds adapt to each language and source."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, map_batches, stash

WORDS = re.compile(WORD)
SYMBOL = re.compile(r"[#*$%&|<>]")
#: The base rules.
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
#: Per metric: its count, the side that is bad, and the slack in thousandths of a word.
METRICS = {
    "word_length": ("word_chars", "both", 1000),
    "symbols": ("n_symbols", "high", 100),
    "dup_lines": ("n_dup_lines", "high", 50),
    "repeats": ("n_repeat_words", "high", 250),
}


def text_counts(text: str, window: int = 3) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of one text."""
    words = WORDS.findall(text)
    n = len(words)
    seen: set[str] = set()
    dup_lines = 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup_lines += line in seen
            seen.add(line)
    grams = list(zip(*(words[k:] for k in range(window)), strict=False))
    repeated = 0
    if len(set(grams)) < len(grams):
        often = Counter(grams)
        covered = 0  # first word position not yet counted
        for i, gram in enumerate(grams):
            if often[gram] > 1:
                repeated += i + window - max(i, covered)
                covered = i + window
    return n, sum(map(len, words)), len(SYMBOL.findall(text)), dup_lines, repeated


def measure(docs: DataFrame) -> DataFrame:
    """Counts of every whole text with its ``lang`` and ``source``; a null text has no words."""

    def rows(keys: list, texts: list) -> Iterator[tuple]:
        for key, text in zip(keys, texts, strict=True):
            yield (key["doc_id"], key["lang"], key["source"], *text_counts(text or ""))

    keyed = docs.select(F.struct("doc_id", "lang", "source").alias("key"), "text")
    return map_batches(
        keyed,
        rows,
        "doc_id bigint, lang string, source string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint",
        ("key", "text"),
    )


def bucket_of(value: Column, bits: int = 5) -> Column:
    """Sketch bucket of a non-negative long: its leading ``bits`` + 1 binary digits and their place.

    Values below ``2 ** (bits + 1)`` have a bucket of their own; above, a bucket spans at most
    ``1 / 2 ** bits`` of its lower bound. Buckets are numbered in the order of their values.
    """
    shift = F.greatest(F.lit(0), F.length(F.bin(value)) - F.lit(bits + 1)).cast("int")
    lead = F.call_function("shiftright", value, shift)
    return shift.cast("long") * F.lit(1 << bits) + lead


def bucket_floor(bucket: Column, bits: int = 5) -> Column:
    """Least value of a bucket."""
    shift = F.greatest(F.lit(0), F.floor(bucket / F.lit(1 << bits)) - 1).cast("int")
    lead = bucket - shift.cast("long") * F.lit(1 << bits)
    return F.call_function("shiftleft", lead, shift)


def quantile_sketch(values: DataFrame, keys: list[str]) -> DataFrame:
    """Counts per ``keys`` and bucket of ``value``.

    The sketch of a union is the sum of the sketches, so partial counts merge on the map side and
    across days or shards, and its size depends on the range of values alone.
    """
    return values.groupBy(*keys, bucket_of(F.col("value")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def quantiles(sketch: DataFrame, keys: list[str], at: dict[str, int]) -> DataFrame:
    """Per ``keys``: total ``n`` and, per name of ``at``, the quantile at that many thousandths."""
    w = Window.partitionBy(*keys)
    ranked = sketch.select(
        *keys,
        F.col("bucket"),
        "n",
        F.sum("n").over(w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.sum("n").over(w).alias("total"),
    )
    return ranked.groupBy(*keys).agg(
        F.max("total").alias("n"),
        *[F.min(F.when(F.round("upto", 6) * 1000 >= F.round("total", 6) * q, bucket_floor(F.col("bucket")))).alias(k) for k, q in at.items()],
    )


def blended_sketch(sketch: DataFrame, shrink: float) -> DataFrame:
    """Sketch ``lang, source, metric, bucket, n`` with the weight of ``shrink`` rows of the language's sketch mixed into each source's.

    A language's is the sum of its sources' with ``shrink`` rows of the sketch of all rows mixed in likewise, so a group of few rows
    has nearly the quantiles of the level above and a large one its own. Sketches are small, whatever the rows.
    """
    above = sketch.groupBy("metric", "bucket").agg(F.sum("n").alias("n"))
    above = above.select("metric", "bucket", (F.col("n") / F.sum("n").over(Window.partitionBy("metric"))).alias("share"))
    for keys in (["lang"], ["lang", "source"]):
        own = sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
        totals = own.groupBy(*keys, "metric").agg(F.sum("n").alias("total"))
        up = above.select(*[F.col(c).alias(f"__{c}") for c in above.columns])
        on = F.col("metric") == F.col("__metric")
        frame = totals.join(up, on & F.col("lang").eqNullSafe(F.col("__lang")) if "lang" in above.columns else on).select(*keys, "metric", "total", F.col("__bucket").alias("bucket"), F.col("__share").alias("share"))
        mine = own.select(*[F.col(c).alias(f"__{c}") for c in own.columns])
        same = (F.col("metric") == F.col("__metric")) & (F.col("bucket") == F.col("__bucket"))
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
        weight = F.coalesce(F.col("__n"), F.lit(0)) + shrink * F.col("share")
        above = frame.join(mine, same, "left").select(*keys, "metric", "bucket", weight.alias("n"), (weight / (F.col("total") + shrink)).alias("share"))
    return above.select("lang", "source", "metric", "bucket", "n")


def quality_rules(docs: DataFrame, spread: int = 6, shrink: float = 30.0) -> DataFrame:
    """Judge ``docs(doc_id, text, lang, source, ...)`` by thresholds of their own language and source.

    Rows that fail the base rules (fewer than 50 words, or over half of the words in repeated
    three-word windows) are rejected and stay out of the sketches. Of the others each metric, in
    thousandths of a word, is sketched per language and source; a text is rejected if a metric lies
    more than ``spread`` interquartile ranges and the metric's slack beyond the quartiles. A group's sketch has ``shrink`` rows of its
    language's mixed in, and this has as many of that of all rows, so groups of few rows have nearly the thresholds of the level above.

    Returns one row per input row: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, lang, source``. Null texts have no words and fail; a null
    language or source is a group of its own; extra columns are ignored; empty in, empty out.
    """
    measured = stash(measure(docs), "quality_counts")
    base = measured.withColumn(
        "base_failed",
        (F.col("n_words") < LEAST_WORDS)
        | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")),
    )
    per_word = {k: F.floor(F.lit(1000) * F.col(c) / F.col("n_words")) for k, (c, _, _) in METRICS.items()}
    long = base.where(~F.col("base_failed")).select(
        "lang", "source", F.explode(F.create_map(*[x for k, v in per_word.items() for x in (F.lit(k), v)])).alias("metric", "value")
    )
    sketch = stash(quantile_sketch(long, ["lang", "source", "metric"]), "quality_sketch", large=False)
    q = quantiles(blended_sketch(sketch, shrink), ["lang", "source", "metric"], {"q1": 250, "q3": 750})
    side = F.create_map(*[x for k, (_, s, _) in METRICS.items() for x in (F.lit(k), F.lit(s))])[F.col("metric")]
    slack = F.create_map(*[x for k, (_, _, s) in METRICS.items() for x in (F.lit(k), F.lit(s))])[F.col("metric")]
    reach = spread * (F.col("q3") - F.col("q1")) + slack
    ends = {"low": F.when(side == "both", F.col("q1") - reach), "high": F.col("q3") + reach}
    limits = q.groupBy(F.col("lang").alias("__lang"), F.col("source").alias("__source")).agg(
        *[F.max(F.when(F.col("metric") == k, e)).alias(f"{k}_{end}") for k in METRICS for end, e in ends.items()]
    )
    odd = F.lit(False)
    for k, v in per_word.items():
        odd = odd | F.coalesce(v < F.col(f"{k}_low"), F.lit(False)) | F.coalesce(v > F.col(f"{k}_high"), F.lit(False))
    joined = base.join(
        limits, F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source")), "left"
    )
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.when(F.col("base_failed"), F.lit(False)).otherwise(~odd).alias("kept"), "lang", "source",
    )
