"""Mixing sources to target weights by blocks of tokens."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stash, unused, word_count
from .hashing import mix64

#: Places of a running total that one task sums; the totals of such groups are summed apart.
GROUP = 1024
#: Slots that one task places, at about.
TASK_SLOTS = 250_000
#: Slots up to which numpy draws without replacement.
EXACT_SLOTS = 1_000_000_000


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Images of ``index`` under a pseudorandom permutation of ``range(n)`` that ``key`` picks.

    A four-round Feistel network over the next even number of bits; images outside the range go
    through it again until they fall inside, so no table of the permutation is needed.
    """
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    low = np.uint64((1 << int(half)) - 1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    with np.errstate(over="ignore"):
        keys = mix64(np.uint64(key & 0xFFFFFFFFFFFFFFFF) + np.arange(1, 5, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        while len(todo):
            left, right = out[todo] >> half, out[todo] & low
            for k in keys:
                left, right = right, left ^ (mix64(right ^ k) & low)
            out[todo] = (left << half) | right
            todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def targets(sizes: list[int], weights: list[float], budget: float, ceiling: float = 2.0) -> list[float]:
    """Split ``budget`` by weight; nothing over ``ceiling`` times its size, the excess shared again."""
    out = [0.0] * len(sizes)
    free = [k for k, s in enumerate(sizes) if s > 0]
    left = budget
    while free:
        share = sum(weights[k] for k in free)
        full = [k for k in free if left * weights[k] >= ceiling * sizes[k] * share]
        if not full:
            for k in free:
                out[k] = left * weights[k] / share
            break
        for k in full:
            out[k] = ceiling * sizes[k]
        left -= sum(out[k] for k in full)
        free = [k for k in free if k not in set(full)]
    return out


def source_targets(sized: DataFrame, cycle: tuple[float, ...], budget: float) -> DataFrame:
    """``sid, source, source_size, target`` per source in code-point order, null last.

    Of each source one row with its name and size goes to the driver: sources are named lists that people weigh, not data.
    """
    per = [(r["source"], r["size"]) for r in sized.groupBy("source").agg(F.sum("size").alias("size")).collect()]
    per.sort(key=lambda r: (r[0] is None, r[0] or ""))
    goal = targets([s for _, s in per], [cycle[k % len(cycle)] for k in range(len(per))], budget * sum(s for _, s in per))
    rows = [(k, name, size, t) for k, ((name, size), t) in enumerate(zip(per, goal, strict=True))]
    return sized.sparkSession.createDataFrame(rows, "sid int, source string, source_size bigint, target double")


def running_total(df: DataFrame, key: str, place: str, value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the smaller ``place`` of its ``key``, one row per key and place.

    Sums within groups of ``GROUP`` places and sums of the groups before, so no task sees all places of a key that is hot.
    """
    grouped = df.withColumn("__group", F.floor(F.col(place) / GROUP))
    sums = grouped.groupBy(key, "__group").agg(F.sum(value).alias("__sum"))
    before = Window.partitionBy(key).orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col(key).alias("__key"), F.col("__group").alias("__of"), F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base"))
    within = Window.partitionBy(key, "__group").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    summed = grouped.withColumn("__in", F.coalesce(F.sum(value).over(within), F.lit(0)))
    joined = summed.join(sums, (F.col(key) == F.col("__key")) & (F.col("__group") == F.col("__of")))
    return joined.withColumn(name, F.col("__in") + F.col("__base")).drop("__group", "__key", "__of", "__base", "__in")


def mix(
    docs: DataFrame,
    cycle: tuple[float, ...] = (3, 1, 2),
    budget: float = 1.5,
    block: int = 64,
    slots: int = 4096,
    seed: int = 17,
    chunk_docs: int = 512,
) -> DataFrame:
    """How many words a mix takes of every row of ``docs(doc_id, text, source, ...)``.

    Returns ``doc_id, size, source_size, target, taken, source, mark``, one row per input row; ``mark`` is a hash of the text. Sources in
    code-point order (null last) weigh ``cycle``, repeating, and share ``budget`` times all words;
    no target exceeds twice its source.

    Each source's words, row after row in a hashed order, are packed into blocks of ``block`` words.
    The output is shards of ``slots`` slots; each shard draws how many of its slots each source
    gets, a multinomial draw given that all shards add up to the targets. A source's slots are numbered through all shards, and
    slot j takes the block that a pseudorandom permutation of the source's blocks gives to j modulo
    their number; slots beyond two rounds are left empty, so no word is taken over twice. Everything
    follows from ``seed``, the ids, texts and sizes, so reruns agree.

    A null text has no words and takes none; null sources form a source; repeated ids are rows of
    their own, in the order of size and a hash of the text; extra columns are ignored; an empty table gives an
    empty result.
    """
    mark = F.coalesce(F.xxhash64("text"), F.lit(0)).alias("mark")
    sized = stash(docs.select("doc_id", "source", mark, word_count(F.col("text")).alias("size")), "mix_sizes")
    goals = source_targets(sized, cycle, budget)
    named = goals.withColumnRenamed("source", "__source")
    rows = sized.join(named, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")

    # Places in the source's stream: sums within chunks of rows, then sums of the chunks before.
    chunks = max(1, sized.count() // chunk_docs)
    order = F.xxhash64("doc_id", F.lit(seed))
    rows = rows.withColumn("order", order).withColumn("chunk", F.pmod(F.xxhash64("order"), F.lit(chunks)))
    starts = running_total(rows.groupBy("sid", "chunk").agg(F.sum("size").alias("n")), "sid", "chunk", "n", "base").drop("n")
    within = Window.partitionBy("sid", "chunk").orderBy("order", "doc_id", "size", "mark").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("offset", F.coalesce(F.sum("size").over(within), F.lit(0))).join(starts, ["sid", "chunk"])
    placed = stash(placed.withColumn("start", F.col("base") + F.col("offset")).drop("base", "offset", "order", "chunk"), "mix_placed")

    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    pieces = (
        placed.where("size > 0")
        .select("sid", "start", "size", F.explode(F.sequence(first, last)).alias("index"))
        .select(
            "sid", "start", "index",
            (F.least(F.col("start") + F.col("size"), (F.col("index") + 1) * block) - F.greatest("start", F.col("index") * block)).alias("words"),
        )
    )
    times = block_times(goals, block, slots, seed)
    # The size of what Python makes is guessed from its few input rows; a hint keeps it from being broadcast.
    taken = pieces.join(times.hint("merge"), ["sid", "index"]).groupBy(F.col("sid").alias("__sid"), F.col("start").alias("__start")).agg(
        F.sum(F.col("words") * F.col("times")).alias("taken")
    )
    # A start belongs to one row with words, as no two of a source begin at one place.
    return placed.join(taken, (F.col("sid") == F.col("__sid")) & (F.col("start") == F.col("__start")) & (F.col("size") > 0), "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "source", "mark",
    )


def slots_of_sources(expected: np.ndarray, seed: int) -> np.ndarray:
    """Slots per source in all shards: whole parts of the expectation and a multinomial draw of the rest."""
    counts = np.floor(expected)
    rest, extra = expected - counts, round(float(expected.sum())) - int(counts.sum())
    if extra > 0:
        counts += np.random.default_rng(seed).multinomial(extra, rest / rest.sum())
    return counts.astype(np.int64)


def draw_part(counts: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    """How many of ``size`` slots each source gets if they are drawn from slots with ``counts`` per source.

    Beyond numpy's range of a thousand million slots the draw of each source is the normal limit of the hypergeometric one.
    """
    if counts.sum() < EXACT_SLOTS:
        return rng.multivariate_hypergeometric(counts, size, method="marginals")
    out, total = np.zeros_like(counts), int(counts.sum())
    for k, n in enumerate(counts.tolist()):
        others = total - n
        if total < EXACT_SLOTS:
            out[k] = rng.hypergeometric(n, others, size) if total else 0
        else:
            share = size / total
            spread = math.sqrt(max(share * (1 - share) * n * (others / total), 0.0))
            out[k] = min(max(round(rng.normal(share * n, spread)), size - others, 0), n, size)
        total, size = others, size - int(out[k])
    return out


def draw_shards(totals: np.ndarray, slots: int, seed: int, first: int, last: int) -> Iterator[tuple[int, np.ndarray]]:
    """Shards ``first`` to ``last`` (exclusive) with their slots per source: multinomial draws that add up to ``totals``.

    Independent multinomial draws of all shards, given what they add up to, are a multivariate hypergeometric draw. It is made down a
    binary tree of shards: each node draws what its left half gets, from a generator known by its range. So any task has the same draws for
    a shard, at a cost of the tree's depth, and a source of few blocks is as near to its target as one of many.
    """
    n = int(totals.sum())
    open_nodes = [(0, -(-n // slots), totals)] if n else []
    while open_nodes:
        low, high, counts = open_nodes.pop()
        if high <= first or low >= last:
            continue
        if high - low == 1:
            yield low, counts
            continue
        middle = (low + high) // 2
        left = draw_part(counts, slots * (middle - low), np.random.default_rng((seed, low, high)))
        open_nodes += [(middle, high, counts - left), (low, middle, left)]


def blocks_of_slots(sid: int, first: int, n: int, blocks: int, seed: int) -> np.ndarray:
    """Blocks that slots ``first`` to ``first + n`` of a source take; those beyond two rounds take none."""
    j = np.arange(first, min(first + n, 2 * blocks))
    return permute(j % blocks, blocks, seed * 1_000_003 + sid) if len(j) else j


def block_times(goals: DataFrame, block: int, slots: int, seed: int) -> DataFrame:
    """``sid, index, times``: how often the shards' slots take each block of each source."""
    sources = [(r["source_size"], -(-r["source_size"] // block), r["target"]) for r in goals.orderBy("sid").collect()]
    expected = np.array([goal * blocks / size if size else 0.0 for size, blocks, goal in sources])
    totals = slots_of_sources(expected, seed)
    total = int(totals.sum())
    shards = -(-total // slots)
    blocks = [b for _, b, _ in sources]

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:  # a range's batches are runs of numbers
                first = batch.column(0)[0].as_py()
                for shard, counts in draw_shards(totals, slots, seed, first, first + batch.num_rows):
                    own = np.flatnonzero(counts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own, pa.int32()), pa.array(np.full(len(own), shard), pa.int64()), pa.array(counts[own])], names=["sid", "shard", "n"]
                    )

    drawn = goals.sparkSession.range(shards).mapInArrow(draw, "sid int, shard bigint, n bigint")
    runs = running_total(drawn, "sid", "shard", "n", "first")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sid, first, n in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                index = blocks_of_slots(sid, first, n, blocks[sid], seed)
                if len(index):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(index), sid), pa.int32()), pa.array(index, pa.int64())], names=["sid", "index"])

    # The few rows of the runs become many slots: they are dealt to a number of tasks that grows with these.
    spread = runs.select("sid", "first", "n").repartition(max(1, -(-total // TASK_SLOTS)), "sid", "first")
    placed = spread.mapInArrow(place, "sid int, index bigint")
    return placed.groupBy("sid", "index").agg(F.count(F.lit(1)).alias("times"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` as often as the mix takes them, columns as they were.

    A row stands ``taken / size`` times, the fraction decided by a hash of its id and text, so the words of
    each source stay near its target; rows without words go. Rows that share id and text are each taken as often as they
    are on average, the fraction decided once for all. Any other column may have any name; an empty table stays empty.
    """
    known, mark, n, copy = unused(docs, "__id", "__mark", "__copies", "__copy")
    key = [F.col("doc_id").alias(known), F.col("mark").alias(mark)]
    found = mix(docs, **options).where("size > 0").groupBy(*key).agg((F.sum("taken") / F.sum("size")).alias("ratio"))
    chance = F.pmod(F.xxhash64(known, mark, F.lit("copies")), F.lit(1 << 20)) / float(1 << 20)
    copies = F.floor("ratio") + F.when(chance < F.col("ratio") - F.floor("ratio"), 1).otherwise(0)
    counted = found.select(known, mark, copies.cast("int").alias(n)).where(F.col(n) > 0)
    same = F.col("doc_id").eqNullSafe(F.col(known)) & (F.coalesce(F.xxhash64("text"), F.lit(0)) == F.col(mark))
    joined = docs.join(counted, same)
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n)))).drop(known, mark, n, copy)
