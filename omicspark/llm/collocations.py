"""Phrases whose words occur together: count streams in prefix and in suffix order, merged in lockstep."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stash
from .word_arrays import Words, byte_classes, mixed, name_hashes, words_of

GAPS, ENDS = " \t", ".,;:!?\n\x0b\x0c\r"
CLASSES = byte_classes(GAPS, ENDS)
#: Bytes of text that are counted together in a task, and bounds of the filter of phrases, in bits.
CHUNK = 4 << 20
FILTER_BITS = (1 << 16, 1 << 27)


def windows(text: bytes, most: int) -> Iterator[bytes]:
    """``text`` cut behind ends of pieces into parts of ``most`` bytes; only a longer piece makes a longer part."""
    at = 0
    while len(text) - at > most:
        cut = max(text.rfind(c.encode(), at, at + most) for c in ENDS)
        if cut < 0:
            cut = min((k for c in ENDS if (k := text.find(c.encode(), at + most)) >= 0), default=len(text))
        yield text[at : cut + 1]
        at = cut + 1
    if at < len(text):
        yield text[at:]


def gram_hashes(words: Words, at: np.ndarray, m: int) -> np.ndarray:
    hashes = name_hashes(words.names)
    out = np.zeros(len(at), np.uint64)
    for k in range(m):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[words.codes[at + k]])
    return out


def grams(words: Words, m: int, bits: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray]:
    """Different phrases of ``m`` words within pieces, space-joined, and the number of each.

    With ``bits`` only those whose first and last ``m - 1`` words may be in the filter.
    """
    n = len(words.codes) - m + 1
    at = np.flatnonzero(words.piece[: max(n, 0)] == words.piece[m - 1 :]) if n > 0 else np.zeros(0, np.int64)
    if bits is not None and len(at):
        for shift in (0, 1):
            slot = gram_hashes(words, at + shift, m - 1) & np.uint64(64 * len(bits) - 1)
            at = at[(bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1]
    key, size = words.codes[at], len(words.names)
    for k in range(1, m):
        if len(key) and int(key.max()) >= (1 << 63) // size - 1:  # no room for another word: rank what is there
            key = np.unique(key, return_inverse=True)[1]
        key = key * size + words.codes[at + k]
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    named = [words.names.take(pa.array(words.codes[at[first] + k])) for k in range(m)]
    return pc.binary_join_element_wise(*named, pa.scalar(" ", pa.large_string())), counts


def phrase_counts(docs: DataFrame, sizes: tuple[int, ...], bits: np.ndarray | None = None) -> DataFrame:
    """``lang, phrase, n`` of all phrases of the given sizes; size 0 is the empty phrase, which counts all words.

    Texts are counted in chunks of one language within a task, so what is shuffled has one row per chunk and different phrase.
    """
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])

    def counted(lang: str, texts: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        words = words_of(pa.concat_arrays(texts), CLASSES, lower=True)
        for m in sizes:
            phrases, counts = grams(words, m, bits) if m else (pa.array([""]), np.array([len(words.codes)]))
            if len(counts):
                langs = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(counts), np.int32)), pa.array([lang])).cast(pa.string())
                whole = pa.table([langs, phrases.cast(pa.string()), pa.array(counts.astype(np.int64))], schema=schema)
                yield from whole.to_batches(max_chunksize=50_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size: dict[str, int] = {}
        for batch in batches:
            for start, stop in runs_of(batch.column(1)):
                rows = batch.slice(start, stop - start)
                for lang in pc.unique(rows.column(0)).to_pylist():
                    texts = rows.column(1).filter(pc.equal(rows.column(0), lang)).cast(pa.large_string())  # a copy: the batch can go
                    for part in [texts] if texts.nbytes <= 2 * CHUNK else parts_of(texts):
                        if size.get(lang, 0) + part.nbytes > CHUNK and lang in held:
                            yield from counted(lang, held.pop(lang))
                            size[lang] = 0
                        held.setdefault(lang, []).append(part)
                        size[lang] = size.get(lang, 0) + part.nbytes
        for lang in list(held):
            yield from counted(lang, held.pop(lang))

    named = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    made = named.mapInArrow(run, "lang string, phrase string, n bigint")
    # Chunks are counted already: most phrases of a task are in it once, and a second count before the shuffle would only hold them all.
    return made.repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def runs_of(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have up to ``CHUNK`` bytes together, a longer text alone."""
    start, held = 0, 0
    for k, size in enumerate(pc.binary_length(texts).to_pylist()):
        if k > start and held + size > CHUNK:
            yield start, k
            start, held = k, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


def parts_of(texts: pa.Array) -> Iterator[pa.Array]:
    """A long text in windows of its own."""
    for text in texts.to_pylist():
        for w in windows(text.encode(), CHUNK):
            yield pa.array([w], pa.large_binary()).cast(pa.large_string())


def filter_of(phrases: DataFrame, m: int, n: int) -> np.ndarray:
    """Bits of the ``n`` phrases of ``m`` words: 16 a phrase, within bounds, so a full filter costs time and loses nothing."""
    size = min(max(1 << (16 * max(n, 1) - 1).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = words_of(batch.column(0), CLASSES)
            slots = np.unique(gram_hashes(words, np.arange(0, len(words.codes), m), m) & np.uint64(size - 1))
            if len(slots):
                place, first = np.unique(slots >> np.uint64(6), return_index=True)
                value = np.bitwise_or.reduceat(np.uint64(1) << (slots & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int64)), pa.array(value.view(np.int64))], names=["place", "value"])

    made = phrases.select("phrase").mapInArrow(run, "place bigint, value bigint").groupBy("place").agg(F.bit_or("value").alias("value"))
    found = made.toArrow()  # at most size / 64 rows
    out = np.zeros(size // 64, np.uint64)
    out[found["place"].to_numpy()] = found["value"].to_numpy().view(np.uint64)
    return out


def common_phrases(docs: DataFrame, most_words: int, least: int) -> DataFrame:
    """``lang, phrase, m, n`` of all phrases of up to ``most_words`` words found ``least`` times, and per language the empty phrase.

    No phrase is commoner than its parts: from three words on, only those whose shorter parts pass a filter of the common ones are counted.
    """
    kept = lambda m, counts: counts.where((F.col("n") >= least) | (F.col("phrase") == "")).withColumn("m", m)
    spaces = F.char_length("phrase") - F.char_length(F.translate("phrase", " ", "")) + 1
    out = stash(kept(F.when(F.col("phrase") == "", 0).otherwise(spaces), phrase_counts(docs, tuple(range(min(most_words, 2) + 1)))), "phrases_2")
    last = out.where("m = 2")
    for m in range(3, most_words + 1):
        n = last.count()
        if not n:
            break
        last = stash(kept(F.lit(m), phrase_counts(docs, (m,), filter_of(last, m - 1, n))), f"phrases_{m}")
        out = out.unionByName(last)
    return out.select("lang", "phrase", "m", "n")


def lockstep(rows: Iterator[tuple], back: bool) -> Iterator[tuple]:
    """``lang, phrase, n, parts, longer`` of a stream in order of language and words.

    Shorter phrases stand right before those they begin, so the open ones are a stack: ``parts`` are the counts of the parts a
    phrase begins with, ``longer`` the count of its commonest phrase of one word more. ``back`` says that words are in reverse.
    A row with ``carried`` opens a phrase that lies in a range before; only its ``longer`` is told.
    """
    stack: list[list] = []

    def told(entry: list) -> Iterator[tuple]:
        lang, words, n, carried, longer = entry
        if not carried or longer:
            phrase = " ".join(reversed(words) if back else words)
            yield lang, phrase, None if carried else n, None if carried else [x[2] for x in stack], longer

    for at, lang, words, n, carried in rows:
        while stack and (stack[-1][0] != (at, lang) or words[: len(stack)] != stack[-1][1]):
            entry = stack.pop()
            yield from told([entry[0][1], *entry[1:]])
        if stack:
            stack[-1][4] = max(stack[-1][4], n)
        stack.append([(at, lang), words, n, carried, 0])
    while stack:
        entry = stack.pop()
        yield from told([entry[0][1], *entry[1:]])


def stream_of(phrases: DataFrame, back: bool, name: str) -> DataFrame:
    """``lockstep`` of all phrases in prefix order, or in suffix order with ``back``.

    The stream is dealt to ranges of equal size wherever they end, even between phrases of one first word. What is open where a range begins, the
    parts of its first phrase, is put before it, so ranges are merged apart and no word is too common for a task.
    """
    words = F.split("phrase", " ", -1)
    keyed = phrases.where("m > 0").select("lang", (F.reverse(words) if back else words).alias("words"), "n")
    ranged = keyed.repartitionByRange("lang", "words").withColumn("part", F.spark_partition_id())
    ranged = stash(ranged, name, large=False)
    heads = ranged.groupBy("part").agg(F.min(F.struct("lang", "words")).alias("h")).select("part", "h.lang", "h.words").where(F.size("words") > 1)
    opened = heads.select("part", "lang", F.explode(F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda k: F.slice("words", F.lit(1), k))).alias("words"))
    # One head per range, of fewer than most_words parts: as small as the number of ranges.
    carried = keyed.join(F.broadcast(opened), ["lang", "words"]).select("part", "lang", "words", "n", F.lit(True).alias("carried"))
    rows = ranged.select("part", "lang", "words", "n", F.lit(False).alias("carried")).unionByName(carried)
    rows = rows.repartition("part").sortWithinPartitions("part", "lang", "words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        held = []
        for row in lockstep(flat, back):
            held.append(row)
            if len(held) >= 20_000:
                yield batch_of(held)
                held = []
        if held:
            yield batch_of(held)

    return rows.mapInArrow(run, "lang string, phrase string, n bigint, parts array<bigint>, longer bigint")


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["lang", "phrase", "n", "parts", "longer"])


def wide(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def collocations(docs: DataFrame, most_words: int = 3, least: int = 10, most: int = 2000, share: int = 50) -> DataFrame:
    """The ``most`` best phrases of 2 to ``most_words`` words of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A-Z count as a-z; pieces end at ``[.,;:!?]`` and line ends, words at blanks and tabs, and no phrase leaves its piece. A phrase found
    ``a >= least`` times is a candidate. Its cut into a first part found ``l`` times and a rest found ``r`` times with the lowest
    ``floor(1000000 a a / (l r))`` counts, the earliest of equal ones. It goes if a longer candidate that holds it is found at least ``share`` times per 100 of its own; ``n`` counts all words of the language.
    Ranks go by score and ``a`` descending, then by the bytes of the phrase.

    Counting texts is the only pass that sees them. Common phrases are then written as a stream in prefix order and one in suffix order;
    each is sorted once and merged in lockstep with its own shorter phrases, which gives the counts of all first parts and of words added behind, and
    in suffix order those of all rests and of words added before. No table of phrases is held in memory.

    Null texts are empty; a null language is ``und``; repeated rows count again; ids and other columns are ignored; an empty table or one without candidates
    gives an empty result. Texts longer than a chunk are counted in windows that end with a piece.
    """
    phrases = common_phrases(docs, most_words, least)
    totals = phrases.where("m = 0").select("lang", F.col("n").alias("total"))
    front, back = stream_of(phrases, False, "prefix_order"), stream_of(phrases, True, "suffix_order")
    both = front.withColumn("rests", F.lit(None).cast("array<bigint>")).unionByName(
        back.select("lang", "phrase", "n", F.lit(None).cast("array<bigint>").alias("parts"), F.col("parts").alias("rests"), "longer")
    )
    known = both.groupBy("lang", "phrase").agg(F.max("n").alias("a"), F.max("parts").alias("parts"), F.max("rests").alias("rests"), F.max("longer").alias("longer"))
    size = F.size("parts") + 1
    cut = lambda k: (F.get("parts", k - 1), F.get("rests", size - k - 1))
    whole = F.lit(1_000_000).cast("decimal(7,0)") * (wide(F.col("a")) * wide(F.col("a")))
    quotient = lambda l, r: F.call_function("div", whole, wide(l) * wide(r))  # noqa: E731, E741
    cuts = F.transform(F.sequence(F.lit(1), size - 1), lambda k: F.struct(quotient(*cut(k)).alias("score"), k.alias("k"), cut(k)[0].alias("l"), cut(k)[1].alias("r")))
    told = known.where((F.size("parts") > 0) & (100 * F.col("longer") < share * F.col("a"))).withColumn("c", F.array_min(cuts))
    best = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = told.select("lang", "phrase", "a", "c.l", "c.r", "c.score").withColumn("rank", best).where(F.col("rank") <= most)
    return ranked.join(F.broadcast(totals), "lang").select(  # a row per language
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )
