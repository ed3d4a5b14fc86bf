"""Personal data: pattern hits, and terms that reveal a protected entity by co-occurrence."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, stash

#: Base patterns; runs of digits start where no digit stands before.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone", "term")
DIGIT = re.compile(r"[0-9]")
#: A term: letters and digits, three or more.
TERM = re.compile(r"[^\W_]{3,}")
#: Bits of the fixed-size filter that picks texts with possibly revealing terms.
FILTER_BITS = 1 << 22


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping e-mail addresses, found from their ``@`` in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Base hits ``(start, end, kind)``, leftmost and non-overlapping per kind; failing ones dropped."""
    out = [(s, e, "email") for s, e in emails(text)]
    if not DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out.append((m.start(), m.end(), "phone"))
    return out


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (KINDS.index(x[2]), x[0], x[1])))


def term_hash(term: str) -> int:
    return xxhash.xxh64_intdigest(term) - (1 << 63)


def nearby_terms(text: str, spans: list[tuple[int, int, str]], reach: int) -> list[tuple[int, int]]:
    """``(entity, term)`` hashes of whole terms within ``reach`` characters of an entity, itself left out.

    Entities are the value found and its class: a term may give away whose data it is, or that there are some.
    """
    out = set()
    for start, end, kind in spans:
        entities = term_hash(f"{kind} {text[start:end].lower()}"), term_hash(kind)
        for low, high in ((max(0, start - reach), start), (end, min(len(text), end + reach))):
            for m in TERM.finditer(text, low, high):
                cut = (m.start() == low > 0 and text[low - 1].isalnum()) or (
                    m.end() == high < len(text) and text[high].isalnum()
                )
                if not cut and not any(s < m.end() and m.start() < e for s, e, _ in spans):
                    term = term_hash(m[0].lower())
                    out.update((entity, term) for entity in entities)
    return sorted(out)


def base_table(docs: DataFrame, reach: int) -> DataFrame:
    """Base hits of every row and the terms near them; ``mark`` is a hash of the text."""

    def rows(ids: list, texts: list) -> Iterator[tuple]:
        for i, text in zip(ids, texts, strict=True):
            text = text or ""
            spans = base_spans(text)
            kinds = [k for _, _, k in spans]
            pairs = [{"entity": e, "term": t} for e, t in nearby_terms(text, spans, reach)] if spans else []
            yield (i, term_hash(text), *(kinds.count(k) for k in KINDS[:4]), joined(spans), pairs)

    return map_batches(
        docs,
        rows,
        "doc_id bigint, mark bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, pairs array<struct<entity:bigint,term:bigint>>",
    )


def filter_bits(terms: DataFrame) -> bytes:
    """Bit set of ``FILTER_BITS`` bits, whatever the number of terms: bit ``hash mod FILTER_BITS``."""
    slots = terms.select(F.pmod("term", F.lit(FILTER_BITS)).cast("int").alias("slot")).distinct()
    words = slots.groupBy(F.floor(F.col("slot") / 32).cast("int").alias("word")).agg(
        F.sum(F.pow(F.lit(2.0), F.col("slot") % 32).cast("long")).alias("bits")
    )
    out = np.zeros(FILTER_BITS // 32, dtype="<u4")
    for word, bits in words.collect():  # at most FILTER_BITS / 32 rows
        out[word] = bits
    return out.tobytes()


class Picker:
    """Hashes of words whose bit is set in a filter, remembered word by word within bounds."""

    def __init__(self, bits: bytes):
        self.bits, self.seen = bits, {}

    def __call__(self, word: str) -> int | None:
        if word not in self.seen:
            if len(self.seen) > 200_000:
                self.seen.clear()
            h = term_hash(word.lower())
            slot = h % FILTER_BITS
            self.seen[word] = h if self.bits[slot >> 3] >> (slot & 7) & 1 else None
        return self.seen[word]


def texts_with(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``term, n_t``: rows of ``docs`` that hold each of ``terms(term)``.

    A bit set of fixed size goes to the tasks and picks candidates, which are counted per batch; the join
    with ``terms`` is exact, so a full bit set costs time and loses nothing.
    """
    bits = filter_bits(terms)

    def rows(_: list, texts: list) -> Iterator[tuple]:
        pick, counts = Picker(bits), Counter()
        for text in texts:
            counts.update({pick(w) for w in set(TERM.findall(text or ""))})
        counts.pop(None, None)
        yield from counts.items()

    found = map_batches(docs, rows, "term bigint, n bigint")
    return found.groupBy("term").agg(F.sum("n").alias("n_t")).join(terms, "term", "left_semi")


def places_of(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Places of ``terms(term)`` in whole texts, picked and joined likewise: ``doc_id, mark, term, start, end``."""
    bits = filter_bits(terms)

    def rows(ids: list, texts: list) -> Iterator[tuple]:
        if not any(bits):
            return
        pick = Picker(bits)
        for i, text in zip(ids, texts, strict=True):
            hit = {w: h for w in set(TERM.findall(text or "")) if (h := pick(w)) is not None}
            if hit:
                mark = term_hash(text)
                yield from ((i, mark, hit[m[0]], m.start(), m.end()) for m in TERM.finditer(text) if m[0] in hit)

    found = map_batches(docs, rows, "doc_id bigint, mark bigint, term bigint, start int, end int")
    return found.join(terms, "term", "left_semi")


def revealing_terms(docs: DataFrame, base: DataFrame, least_texts: int, disclosure: float) -> DataFrame:
    """Terms above the disclosure thresholds: ``term, bits``."""
    near = base.select("mark", F.explode("pairs").alias("p")).select("mark", "p.entity", "p.term")
    per_text = near.groupBy("entity", "term", "mark").agg(F.count(F.lit(1)).alias("n"))
    pairs = per_text.groupBy("entity", "term").agg(F.sum("n").alias("n_te"), F.count(F.lit(1)).alias("texts"))
    pairs = stash(pairs.where(F.col("texts") >= least_texts), "pii_pairs")
    held = base.select(F.explode(F.array_distinct("pairs.entity")).alias("entity"))
    entities = held.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    totals = texts_with(docs, pairs.select("term").distinct())
    total = float(base.count())
    bits = F.log2(F.col("n_te") * F.lit(total) / (F.col("n_t") * F.col("n_e")))
    own = F.log2(F.lit(total) / F.col("n_e"))
    return (
        pairs.join(entities, "entity")
        .join(totals, "term")
        .where((F.col("n_te") >= disclosure * F.col("n_t")) & (bits >= disclosure * own))
        .groupBy("term")
        .agg(F.max(bits).alias("bits"))
    )


def find_pii(docs: DataFrame, reach: int = 80, least_texts: int = 3, disclosure: float = 0.8) -> DataFrame:
    """Personal data in every whole text of ``docs(doc_id, text, ...)``.

    Returns ``doc_id, n_email, n_ip, n_card, n_phone, base, spans`` per input row; ``base`` and
    ``spans`` list ``kind:start:end`` by kind, then start, in code points, the end exclusive.

    Beside the base patterns, terms that give an entity (an address, number or card, or the class of these) away are spans
    of kind ``term``. Over all rows, ``n_te`` counts those where the term stands within ``reach``
    characters of the entity, ``n_t`` and ``n_e`` those that hold each. A term is revealing if
    ``least_texts`` different texts show the pair, ``P(e|t) = n_te / n_t >= disclosure``, and its pointwise mutual
    information ``log2(n_te N / (n_t n_e))`` is at least ``disclosure`` of the entity's own
    ``log2(N / n_e)``. It is marked wherever it stands, with or without the entity.

    A null text counts as empty. Repeated rows get the same answer each; null ids pass. Other columns
    are ignored; an empty table gives an empty result.
    """
    base = stash(base_table(docs, reach), "pii_base")
    terms = stash(revealing_terms(docs, base, least_texts, disclosure), "pii_terms")
    places = places_of(docs, terms.select("term"))
    found = (
        places.groupBy(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark"))
        .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("places"))
        .select("__id", "__mark", F.transform("places", lambda p: F.concat_ws(":", F.lit("term"), p["start"], p["end"])).alias("terms"))
    )
    return base.join(found, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("mark") == F.col("__mark")), "left").select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base",
        F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.array_join("terms", ",")).alias("spans"),
        "mark",
    )


def sanitise(docs: DataFrame, remove_terms: bool = False, **options) -> DataFrame:
    """``doc_id, text`` with entities replaced by their kind and revealing terms generalised or removed.

    A term with a digit becomes ``[NUMBER]``, one that starts with a capital ``[NAME]`` and any other
    ``[TERM]``; with ``remove_terms`` they go without trace.
    """
    found = find_pii(docs, **options).where("spans != ''").select(F.col("doc_id").alias("__id"), "mark", "spans").distinct()

    def clean(text: str | None, spans: str | None) -> str | None:
        if text is None or not spans:
            return text
        out, at = [], 0
        for start, end, kind in sorted((int(s), int(e), k) for k, s, e in (x.split(":") for x in spans.split(","))):
            if start >= at:
                word = text[start:end]
                name = kind.upper() if kind != "term" else "NUMBER" if DIGIT.search(word) else "NAME" if word[0].isupper() else "TERM"
                out += [text[at:start], "" if kind == "term" and remove_terms else f"[{name}]"]
            at = max(at, end)
        return "".join(out) + text[at:]

    def marks(ids: list, texts: list) -> Iterator[tuple]:
        for i, text in zip(ids, texts, strict=True):
            yield i, term_hash(text or ""), text

    def rows(keys: list, texts: list) -> Iterator[tuple]:
        for key, text in zip(keys, texts, strict=True):
            yield key["doc_id"], clean(text, key["spans"])

    marked = map_batches(docs, marks, "doc_id bigint, mark bigint, text string")
    both = marked.join(found.withColumnRenamed("mark", "__mark"), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("mark") == F.col("__mark")), "left")
    return map_batches(both.select(F.struct("doc_id", "spans").alias("key"), "text"), rows, "doc_id bigint, text string", ("key", "text"))


def base_digest(found: DataFrame) -> DataFrame:
    return found.withColumn("base_sha256", F.sha2("base", 256))
