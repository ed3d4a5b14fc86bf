"""Near duplicates: an n-gram Jaccard join by PartEnum signatures."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, stash, unused
from .components import components, forest
from .hashing import mix64, set_key, set_proof, shingle_sets

#: Signatures that are combined in a task before they are shuffled.
CHUNK = 500_000
#: Least elements of a signature, and least size of sets that have partition signatures.
LEAST_ELEMENTS, LEAST_SIZE = 1, 32
#: One text in so many is looked at for common shingles; in how many of these a shingle is common; how many are kept at most.
COMMON_SAMPLE, COMMON_TEXTS, MOST_COMMON = 8, 3, 100_000
#: Shingles of a block of sets that are compared at once; a set counts as this many at least.
BLOCK, LEAST_WEIGHT = 100_000, 100


class Bands:
    """Size bands and signature parameters for a similarity of ``percent`` / 100.

    Band i holds the sizes from ``low[i]`` to ``high[i]``; linked sets are in one band or in
    neighbouring ones. Group i joins the sets of band i with those of bands i and i + 1, so a set
    is in two groups. ``distance[i]`` bounds the symmetric difference of linked sets in group i.
    """

    def __init__(self, percent: int):
        self.percent = percent
        self.low, self.high = [1], [max(1, 100 // percent)]

    def band(self, size: int) -> int:
        while self.high[-1] < size:
            self.low.append(self.high[-1] + 1)
            self.high.append(self.low[-1] * 100 // self.percent)
        return int(np.searchsorted(self.high, size))

    def blocks(self, group: int) -> tuple[int, int]:
        """First-level partitions of a group, and how many may be weak.

        Each is split in three, and each two of the three make a signature. Of linked sets at most
        distance // 2 first-level partitions differ in two elements or more; the others share a
        signature, and there are ``slack`` + 1 of them.
        """
        self.band(self.high[-1] if group < len(self.high) else group)
        top = self.high[group]
        distance = (100 - self.percent) * (top + top * 100 // self.percent) // (100 + self.percent)
        slack = 2 + distance // 20
        return distance // 2 + 1 + slack, slack


@lru_cache(maxsize=8)
def bands(percent: int) -> Bands:
    return Bands(percent)


@lru_cache(maxsize=512)
def _layout(percent: int, group: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bounds of a group's second-level partitions in the hash domain, keys of its signatures, slack."""
    n, slack = bands(percent).blocks(group)
    bounds = np.array([(j << 64) // (3 * n) for j in range(3 * n)], dtype=np.uint64)
    keys = mix64(np.arange(3 * n, dtype=np.uint64) + np.uint64((group + 1) << 32)).reshape(n, 3)
    return bounds, keys, slack


def signatures(hashes: np.ndarray, percent: int, common: np.ndarray | None = None) -> np.ndarray:
    """PartEnum signatures of a sorted set of uniform 64-bit hashes.

    Two sets with 100 * intersection >= percent * union share one. The domain is cut into equal
    ranges; a signature combines the elements of two of the three ranges of a first-level
    partition. Signatures of fewer than ``LEAST_ELEMENTS`` elements are left out; a set with more
    such weak partitions than the slack, or a small one, also gets its prefix in the
    hash order, of which two linked sets share an element.

    ``common`` elements, sorted, are left out of the domain of the partitions: that can only bring two sets
    nearer, so any choice of them is right, and passages of many texts then make no signatures.
    """
    size, whole = len(hashes), hashes
    if not size:
        return hashes
    if common is not None and len(common):
        at = np.searchsorted(common, hashes)
        hashes = hashes[common[np.minimum(at, len(common) - 1)] != hashes]
    own = bands(percent).band(size)
    out, rest = [], size < LEAST_SIZE * 100 // percent + 2
    with np.errstate(over="ignore"):
        sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(mix64(hashes), out=sums[1:])
        for group in (own - 1, own):
            if group < 0 or bands(percent).high[group] < LEAST_SIZE:
                rest = True
                continue
            bounds, keys, slack = _layout(percent, group)
            at = np.append(np.searchsorted(hashes, bounds), len(hashes))
            count = np.diff(at).reshape(-1, 3)
            part = np.diff(sums[at]).reshape(-1, 3)
            count = count.sum(axis=1, keepdims=True) - count
            part = part.sum(axis=1, keepdims=True, dtype=np.uint64) - part
            strong = count >= LEAST_ELEMENTS
            out.append(mix64(part + keys)[strong])
            rest = rest or int((~strong).any(axis=1).sum()) > slack
        if rest:
            prefix = size - (size * percent + 99) // 100 + 1
            out.append(mix64(whole[:prefix] + np.uint64(0xD1B54A32D192ED03)))
    return np.concatenate(out)


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, mark, n_shingles, node, proof``: a row's text by ``mark``, its set by ``node`` and, independent of it, ``proof``."""

    def rows(keys: list, texts: list) -> Iterator[tuple]:
        for key, s in zip(keys, shingle_sets(texts, width), strict=True):
            yield key["doc_id"], key["mark"], len(s), set_key(s) if len(s) else None, set_proof(s)

    keyed = docs.select(F.struct("doc_id", text_mark().alias("mark")).alias("key"), "text")
    return map_batches(keyed, rows, "doc_id bigint, mark bigint, n_shingles bigint, node bigint, proof bigint", ("key", "text"))


def text_mark() -> Column:
    return F.coalesce(F.xxhash64("text"), F.lit(0))


def refuse_collisions(sets: DataFrame) -> None:
    """Raise if two different sets have one key, which the second hash and the size of their elements tell."""
    found = sets.where("node IS NOT NULL").groupBy("node").agg(F.min("proof").alias("a"), F.max("proof").alias("b"), F.min("n_shingles").alias("m"), F.max("n_shingles").alias("n"))
    if not found.where("a <> b OR m <> n").isEmpty():
        raise ValueError("two different sets have one 64-bit key; choose another hash base")


def common_shingles(docs: DataFrame, width: int) -> np.ndarray:
    """Sorted hashes of shingles that many texts have, from a sample of texts by a hash of their content.

    At most ``MOST_COMMON`` go to the driver and on to the tasks. They only save work.
    """

    def rows(_: list, texts: list) -> Iterator[tuple]:
        sets = list(shingle_sets(texts, width))
        found, n = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, dtype=np.uint64),) * 2
        return zip(found.view(np.int64).tolist(), n.tolist(), strict=True)

    sample = docs.where(F.pmod(F.xxhash64("text"), F.lit(COMMON_SAMPLE)) == 0)
    counts = map_batches(sample, rows, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = counts.where(F.col("n") >= COMMON_TEXTS).orderBy(F.desc("n"), "shingle").limit(MOST_COMMON).collect()
    return np.sort(np.array([r["shingle"] for r in top], dtype=np.int64).view(np.uint64))


def candidate_edges(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Edges ``a, b`` between set keys so that sets with a signature in common are connected.

    A task first combines the signatures it made: of the sets that share one, each further set is tied
    to the first by an edge, written as a signature of its own that the two have, and the shared one
    goes on once. So the rows of one signature are at most as many as such chunks, whatever the group.
    """

    common = common_shingles(docs, width)

    def combined(sigs: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((nodes, sigs))
        sigs, nodes = sigs[order], nodes[order]
        new = np.ones(len(sigs), dtype=bool)
        new[1:] = sigs[1:] != sigs[:-1]
        tied = ~new & (nodes != np.concatenate((nodes[:1], nodes[:-1])))
        where = np.flatnonzero(tied)
        pairs = forest(set(zip(nodes[where].tolist(), nodes[where - 1].tolist(), strict=True)))
        left = np.array([a for a, _ in pairs], dtype=np.int64)
        right = np.array([b for _, b in pairs], dtype=np.int64)
        with np.errstate(over="ignore"):
            own = mix64(mix64(left.view(np.uint64)) + right.view(np.uint64))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((sigs[new], own, own)).view(np.int64)), pa.array(np.concatenate((nodes[new], left, right)))],
            names=["sig", "node"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs: list[np.ndarray] = []
        nodes: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for s in shingle_sets(batch.column(0).to_pylist(), width):
                if len(s):
                    sigs.append(signatures(s, percent, common))
                    nodes.append(np.full(len(sigs[-1]), set_key(s), dtype=np.int64))
                    held += len(sigs[-1])
                    if held >= CHUNK:
                        yield combined(np.concatenate(sigs), np.concatenate(nodes))
                        sigs, nodes, held = [], [], 0
        if held:
            yield combined(np.concatenate(sigs), np.concatenate(nodes))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: set[tuple[int, int]] = set()
        sig = node = None
        for batch in batches:
            s, n = (batch.column(k).to_numpy() for k in range(2))
            if not len(s):
                continue
            if sig is not None:
                s, n = np.append(sig, s), np.append(node, n)
            same = np.flatnonzero((s[1:] == s[:-1]) & (n[1:] != n[:-1]))
            pairs.update(zip(n[same + 1].tolist(), n[same].tolist(), strict=True))
            sig, node = s[-1:], n[-1:]
            if len(pairs) > CHUNK:
                yield _edges(forest(pairs))
                pairs = set()
        if pairs:
            yield _edges(forest(pairs))

    made = docs.select("text").mapInArrow(run, "sig bigint, node bigint")
    return made.repartition("sig").sortWithinPartitions("sig", "node").mapInArrow(link, "a bigint, b bigint")


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64())], names=["a", "b"]
    )


def linked_pairs(nodes: np.ndarray, sides: np.ndarray, values: np.ndarray, offsets: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sets that link: of different sides if there are two, else of all.

    Intersections are counted for all pairs at once, as products of the sets' 0/1 rows over the
    elements that two sets or more have, a bounded number of elements at a time.
    """
    n = len(nodes)
    sizes = np.diff(offsets)
    _, column, often = np.unique(values, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), sizes)
    shared = often[column] > 1
    number = np.cumsum(often > 1) - 1
    row, column = row[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((n, n), dtype=np.float32)
    step = max(1, 2_000_000 // max(n, 1))
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, b = np.searchsorted(column, (low, low + step))
        table = np.zeros((n, step), dtype=np.float32)
        table[row[a:b], column[a:b] - low] = 1
        common += table @ table.T
    both = len(set(sides.tolist())) > 1
    found = []
    for low in range(0, n, 256):
        part = common[low : low + 256].astype(np.int64)
        hit = 100 * part >= percent * (sizes[low : low + 256, None] + sizes[None, :] - part)
        hit &= np.arange(n)[None, :] > np.arange(low, low + len(part))[:, None]
        if both:
            hit &= sides[low : low + 256, None] != sides[None, :]
        a, b = np.nonzero(hit)
        found.append((a + low, b))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, dtype=int),) * 2


def verified_links(docs: DataFrame, sets: DataFrame, clusters: DataFrame, width: int, percent: int) -> DataFrame:
    """Exact check within the groups that share signatures: ``a, b, n_links`` per set with links.

    One text stands for each set. A group of up to ``BLOCK`` shingles is compared in one task; a
    larger one is cut, by size band and hash, into blocks that meet in pairs if their sizes can
    link. A task returns a spanning forest of the links it found and their number per set, not the
    pairs.
    """
    stand = (
        sets.where("node IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("node")
        .agg(F.min("doc_id").alias("doc_id"))
        .join(clusters, "node")
        .select(F.col("doc_id").alias("__id"), F.col("node").alias("__node"), "label")
    )
    texts = docs.select("doc_id", "text").join(stand, F.col("doc_id") == F.col("__id"))

    def rows(keys: list, texts: list) -> Iterator[tuple]:
        for key, s in zip(keys, shingle_sets(texts, width), strict=True):
            if len(s) and set_key(s) == key["__node"]:
                yield key["label"], key["__node"], bands(percent).band(len(s)), max(len(s), LEAST_WEIGHT), s.view(np.int64)

    keyed = texts.select(F.struct("label", "__node").alias("key"), "text")
    members = stash(
        map_batches(keyed, rows, "label bigint, node bigint, band int, weight bigint, items array<bigint>", ("key", "text")), "members"
    )
    weight = members.groupBy("label", "band").agg(F.sum("weight").alias("weight"))
    whole = weight.groupBy("label").agg(F.sum("weight").alias("total"))
    cuts = weight.join(whole, "label").select(
        "label", "band", (F.col("total") <= BLOCK).alias("alone"), F.ceil(F.col("weight") / BLOCK).cast("int").alias("n")
    )
    above = cuts.select("label", (F.col("band") - 1).alias("band"), F.col("n").alias("above"))
    below = cuts.select("label", (F.col("band") + 1).alias("band"), F.col("n").alias("below"))
    cuts = cuts.join(above, ["label", "band"], "left").join(below, ["label", "band"], "left")
    placed = members.join(cuts, ["label", "band"]).withColumn("x", F.pmod(F.xxhash64("node"), F.col("n")).cast("int"))

    def meet(band: int, other: str, first: bool):
        """Tasks with each block of the band above or below."""
        y = F.when(F.col(other).isNotNull(), F.sequence(F.lit(0), F.col(other) - 1)).otherwise(F.array().cast("array<int>"))
        lower = F.col("band") + min(band, 0)
        return F.transform(
            y,
            lambda v: F.struct(
                lower.alias("band"), (F.col("x") if first else v).alias("x"), F.lit(1).alias("up"), (v if first else F.col("x")).alias("y"), F.lit(0 if first else 1).alias("side")
            ),
        )

    own = F.transform(
        F.sequence(F.lit(0), F.col("n") - 1),
        lambda v: F.struct(
            F.col("band").alias("band"), F.least(F.col("x"), v).alias("x"), F.lit(0).alias("up"), F.greatest(F.col("x"), v).alias("y"), (v < F.col("x")).cast("int").alias("side")
        ),
    )
    single = F.array(F.struct(F.lit(-1).alias("band"), F.lit(0).alias("x"), F.lit(0).alias("up"), F.lit(0).alias("y"), F.lit(0).alias("side")))
    tasks = F.when(F.col("alone"), single).otherwise(F.concat(own, meet(1, "above", True), meet(-1, "below", False)))
    dealt = placed.select("label", "node", "items", F.explode(tasks).alias("t")).select("label", "node", "items", "t.*")

    def compare(group: pa.Table) -> pa.Table:
        # Rows that repeat an id and its text stand for one set.
        sides = np.stack((group.column("node").to_numpy(), group.column("side").to_numpy().astype(np.int64)))
        once = np.unique(sides, axis=1, return_index=True)[1]
        group = (group.take(pa.array(np.sort(once))) if len(once) < group.num_rows else group).combine_chunks()
        nodes = group.column("node").to_numpy()
        items = group.column("items").combine_chunks()
        items = items if isinstance(items, pa.ListArray) else items.chunk(0)
        a, b = linked_pairs(nodes, group.column("side").to_numpy(), items.flatten().to_numpy(), np.cumsum(np.append(0, items.value_lengths().to_numpy())), percent)
        n = np.bincount(np.concatenate((a, b)), minlength=len(nodes)) if len(a) else np.zeros(len(nodes), dtype=int)
        up = dict(forest(zip(nodes[a].tolist(), nodes[b].tolist(), strict=True)))
        has = np.flatnonzero(n)
        return pa.table(
            [pa.array(nodes[has]), pa.array([up.get(x, x) for x in nodes[has].tolist()], pa.int64()), pa.array(n[has].astype(np.int64))],
            names=["a", "b", "n_links"],
        )

    return dealt.groupBy("label", "band", "x", "up", "y").applyInArrow(compare, "a bigint, b bigint, n_links bigint")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Classes of near-duplicate texts of ``docs(doc_id, text, ...)``.

    Returns per row ``doc_id, n_shingles, component_id, n_links``. A text's set is its distinct
    ``width``-word shingles (the whole sequence if it has fewer words); two rows link when
    100 * intersection >= percent * union, and ``component_id`` is the smallest ``doc_id`` reachable by
    links, itself included. ``n_links`` counts the different sets that the row's set links to.

    Equal sets are one node from the start, so copies never make pairs. Nodes that share a
    PartEnum signature are gathered in groups, and an exact check in blocks decides the links. Shingles are known by 64-bit
    hashes, sets by 64 bits that a second hash and their size must confirm, or the call raises.

    Texts that are null or have no words have an empty set and link with nothing. Rows of a
    null id share the component of rows with the same set, but stand for no set themselves. Repeated ids are judged by
    text each. Extra columns are ignored; an empty table gives an empty result.
    """
    return _classes(docs, width, percent).drop("mark")


def _classes(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Rows of ``near_duplicates`` with the ``mark`` of their text."""
    sets = stash(_sets(docs, width), "sets")
    refuse_collisions(sets)
    clusters = stash(components(candidate_edges(docs, width, percent)), "clusters")
    links = stash(verified_links(docs, sets, clusters, width, percent), "links")
    labels = components(links.select("a", "b"))
    known = labels.select(F.col("node").alias("__node"), "label")
    rows = sets.join(known, F.col("node") == F.col("__node"), "left").select("doc_id", "mark", "n_shingles", "node", F.coalesce("label", "node").alias("label"))
    least = rows.where("label IS NOT NULL").groupBy(F.col("label").alias("__label")).agg(F.min("doc_id").alias("component_id"))
    counts = links.groupBy(F.col("a").alias("__a")).agg(F.sum("n_links").alias("n_links"))
    return (
        rows.join(least, F.col("label") == F.col("__label"), "left")
        .join(counts, F.col("node") == F.col("__a"), "left")
        .select(
            "doc_id",
            "mark",
            "n_shingles",
            F.coalesce("component_id", "doc_id").alias("component_id"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
        )
    )


def keep_one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs`` whose id is the least of their class, and those without an id.

    A row is known by its id and text, so rows of one id with different texts are judged each. Rows without words stay;
    any other column may have any name; an empty table stays empty.
    """
    known, mark = unused(docs, "__id", "__mark")
    dropped = _classes(docs, width, percent).where("component_id <> doc_id").select(F.col("doc_id").alias(known), F.col("mark").alias(mark)).distinct()
    return docs.join(dropped, (F.col("doc_id") == F.col(known)) & (text_mark() == F.col(mark)), "left_anti")
