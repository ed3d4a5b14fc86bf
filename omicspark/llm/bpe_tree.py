"""BPE encoding of whole texts, long ones by tree concatenation, and decoding."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

#: Texts of more characters are encoded in pieces by different tasks.
LONG_CHARS = 32_768
#: Characters at either end of a piece whose tokens are kept with their offsets for the join.
MARGIN = 512
#: Runs between blanks whose tokens a worker remembers in its young generation, and the characters it looks up at once.
REMEMBERED, GROUP_CHARS = 300_000, 300_000

Token = tuple[int, int, int]  # id, start, end


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The tokenizer of a file, loaded once per Python worker, without truncation and padding."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def encode_plain(path: str, text: str, shift: int = 0) -> list[Token]:
    e = tokenizer(path).encode(text, add_special_tokens=False)
    return [(i, a + shift, b + shift) for i, (a, b) in zip(e.ids, e.offsets, strict=True)]


#: The normaliser and pre-tokenizer of files whose texts are the encodings of their runs between blanks, in any case.
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


@lru_cache(maxsize=4)
def by_runs(path: str) -> bool:
    """Whether the file's tokenizer drops white space, lets no piece cross it and lower-cases: known by what the file says."""
    import json

    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    steps = (made.get("normalizer") or {}).get("normalizers") or [made.get("normalizer") or {}]
    cuts = (made.get("pre_tokenizer") or {}).get("pretokenizers") or [made.get("pre_tokenizer") or {}]
    first = cuts[0]
    drops = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and first.get("pattern") == {"Regex": _SPLIT}
    plain = all(c.get("type") == "ByteLevel" and not c.get("add_prefix_space") and not c.get("use_regex") for c in cuts[1:])
    kinds = [s.get("type") for s in steps]
    # What replaces must act on white space alone, or a replacement could join runs or depend on what surrounds them.
    blanks = all(s.get("pattern") == {"Regex": "\\s+"} and s.get("content") == " " for s in steps if s.get("type") == "Replace")
    return bool(blanks and drops and plain and set(kinds) <= {"NFC", "Replace", "Lowercase"} and "Lowercase" in kinds)


class Runs:
    """Ids of runs between blanks as packed 32-bit numbers, remembered within bounds.

    The pre-tokenizer drops white space and no piece crosses it, so a text's encoding is that of
    its runs one after another. Runs not seen lately are encoded together; a full young generation becomes the old
    one. Nothing but speed depends on it. An ASCII word shares the ids of its lower-case
    letters, a comma or stop behind it has its own.
    """

    def __init__(self, path: str):
        self.path = path
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def _encode(self, runs: list[str]) -> None:
        found = tokenizer(self.path).encode_batch_fast(runs, add_special_tokens=False)
        self.young.update((r, np.array(e.ids, dtype="<i4").tobytes()) for r, e in zip(runs, found, strict=True))

    def learn(self, texts: list[list[str]]) -> dict[str, bytes]:
        """A mapping that holds every run of ``texts``."""
        if len(self.young) > REMEMBERED:
            self.young, self.old = {"": b""}, self.young
        young, old = self.young, self.old
        shared, plain = [], set()
        for run in set().union(*texts):
            if run in young:
                continue
            if run in old:
                young[run] = old[run]
                continue
            if run.isascii():
                end = run[-1] if run[-1] in ",." else ""
                word = run[: len(run) - len(end)].lower()
                if word.isalpha():
                    shared.append((run, word, end))
                    plain.update(w for w in (word, end) if w not in young)
                    continue
            plain.add(run)
        self._encode(sorted(plain))
        for run, word, end in shared:
            young[run] = young[word] + young[end]
        return young


@lru_cache(maxsize=4)
def runs_of(path: str) -> Runs:
    return Runs(path)


def encode_texts(path: str, texts: list[str]) -> Iterator[np.ndarray]:
    """Ids of each text: by its runs between blanks where the tokenizer allows it (``by_runs``), else by the library as a whole."""
    if not by_runs(path):
        for e in tokenizer(path).encode_batch_fast(texts, add_special_tokens=False):
            yield np.array(e.ids, dtype="<i4")
        return
    group: list[list[str]] = []
    size = 0
    for k, text in enumerate(texts):
        group.append(text.replace("\n", " ").split(" "))
        size += len(text)
        if size >= GROUP_CHARS or k + 1 == len(texts):
            known = runs_of(path).learn(group).__getitem__
            for runs in group:
                yield np.frombuffer(b"".join(map(known, runs)), dtype="<i4")
            group, size = [], 0


class Piece(NamedTuple):
    """Tokens of a piece: with offsets at its ends, ids alone between them.

    ``head`` and ``tail`` are the texts at the ends and ``first`` and ``last`` their tokens; a short piece
    has all of it in ``head`` and no ``middle``.
    """

    head: str
    first: list[Token]
    middle: np.ndarray | None
    tail: str
    last: list[Token]


def encode_piece(path: str, text: str) -> Piece:
    """One leaf of the tree. The ends reach to the first blank beyond the margin, so they stand on their own; without runs it is kept whole."""
    if not by_runs(path):
        return Piece(text, encode_plain(path, text), None, "", [])
    low, high = text.find(" ", MARGIN), text.rfind(" ", 0, max(0, len(text) - MARGIN))
    if low < 0 or high <= low:
        return Piece(text, encode_plain(path, text), None, "", [])
    (middle,) = encode_texts(path, [text[low:high]])
    return Piece(text[:low], encode_plain(path, text[:low]), middle, text[high:], encode_plain(path, text[high:]))


def ids_of(tokens: list[Token]) -> np.ndarray:
    return np.array([t[0] for t in tokens], dtype="<i4")


def alone(tokens: list[Token], k: int) -> bool:
    """No neighbour of token ``k`` shares its characters."""
    _, start, end = tokens[k]
    return (
        start < end
        and (k == 0 or tokens[k - 1][2] <= start)
        and (k + 1 == len(tokens) or tokens[k + 1][1] >= end)
    )


def join_at(path: str, text: str, cut: int, left: list[Token], right: list[Token], width: int = 64) -> list[Token]:
    """Tokens of ``text`` from those of its parts before and after ``cut``.

    A window around the cut is encoded again and doubled until it has a whole token in common with
    the left tokens before the cut and another with the right tokens after it: same id, start and
    end, apart from the window's own edges. The result takes the left tokens up to the first, the
    window's between and the right ones from the second, so each pair of neighbours stands in one
    real encoding, which for BPE makes the sequence the encoding of the whole.
    """
    low, high = (0, len(text)) if not left or not right else (max(0, cut - width), min(len(text), cut + width))
    while True:
        window = encode_plain(path, text[low:high], low)
        whole = {t: k for k, t in enumerate(window) if alone(window, k)}
        head = tail = None
        if low == 0:
            head = (0, 0)
        else:
            margin = low + (cut - low) // 4
            k = len(left) - 1
            while k >= 0 and left[k][1] > margin:
                if left[k][2] <= cut and left[k] in whole and alone(left, k):
                    head = (k, whole[left[k]])
                k -= 1
        if high == len(text):
            tail = (len(right), len(window))
        else:
            margin = high - (high - cut) // 4
            for k, t in enumerate(right):
                if t[2] >= margin:
                    break
                if t[1] >= cut and t in whole and alone(right, k):
                    tail = (k, whole[t])
        if head and tail and head[1] <= tail[1]:
            return left[: head[0]] + window[head[1] : tail[1]] + right[tail[0] :]
        width *= 2
        low, high = max(0, cut - width), min(len(text), cut + width)


def join_pieces(path: str, a: Piece, b: Piece) -> Piece:
    """An inner node: the ends that meet are joined, the others stay."""
    left, tokens = (a.head, a.first) if a.middle is None else (a.tail, a.last)
    right = [(i, s + len(left), e + len(left)) for i, s, e in b.first]
    text, met = left + b.head, join_at(path, left + b.head, len(left), tokens, right)
    if a.middle is None and b.middle is None:
        return Piece(text, met, None, "", [])
    if a.middle is None:
        return Piece(text, met, b.middle, b.tail, b.last)
    if b.middle is None:
        return Piece(a.head, a.first, a.middle, text, met)
    return Piece(a.head, a.first, np.concatenate((a.middle, ids_of(met), b.middle)), b.tail, b.last)


def concatenate(path: str, pieces: list[Piece]) -> np.ndarray:
    """Ids of a text from its pieces, joined in pairs up the tree."""
    level = list(pieces)
    while len(level) > 1:
        level = [join_pieces(path, *level[i : i + 2]) for i in range(0, len(level) - 1, 2)] + level[len(level) // 2 * 2 :]
    if not level:
        return np.zeros(0, dtype="<i4")
    p = level[0]
    return np.concatenate((ids_of(p.first), p.middle if p.middle is not None else ids_of([]), ids_of(p.last)))


def halves(text: str, most: int) -> list[str]:
    """Leaves of the tree: the text is halved until no piece is longer than ``most``."""
    if len(text) <= most:
        return [text]
    return halves(text[: len(text) // 2], most) + halves(text[len(text) // 2 :], most)


def encode_tree(path: str, text: str, most: int = LONG_CHARS) -> list[int]:
    """Ids of one text by tree concatenation in this process."""
    return concatenate(path, [encode_piece(path, p) for p in halves(text, most)]).tolist()


def encode(docs: DataFrame, path: str, long_chars: int = LONG_CHARS) -> DataFrame:
    """``doc_id, ids`` of every whole text of ``docs(doc_id, text, ...)``, in the library's ids.

    Texts up to ``long_chars`` are encoded where they are read, run by run if the tokenizer allows it. Longer ones are halved to
    pieces that different tasks encode, then joined per text as a tree; copies of a long text are encoded once. A null text counts as
    empty and has no ids. Repeated and null ``doc_id`` are encoded each; other columns are ignored; an
    empty table gives an empty result.
    """
    return _encoded(docs, path, long_chars, lambda ids: (ids,), "ids array<int>")


def code_digests(docs: DataFrame, path: str, long_chars: int = LONG_CHARS) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every whole text, encoded as ``encode`` does and decoded.

    The digests are of the decimal ids joined by a blank and of the decoded text in UTF-8.
    """

    def digests(ids: np.ndarray) -> tuple[int, str, str]:
        numbers, listed = number_texts(path), ids.tolist()
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        return len(listed), sha(" ".join(map(numbers.__getitem__, listed))), sha(decode_ids(path, listed))

    return _encoded(docs, path, long_chars, digests, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def _encoded(docs: DataFrame, path: str, most: int, finish: Callable[[np.ndarray], tuple], columns: str) -> DataFrame:
    """``doc_id`` and what ``finish`` makes of each text's ids."""
    schema = f"doc_id bigint, {columns}"

    def short(ids: list, texts: list) -> Iterator[tuple]:
        for i, found in zip(ids, encode_texts(path, texts), strict=True):
            yield (i, *finish(found))

    def cut(marks: list, texts: list) -> Iterator[tuple]:
        for mark, text in zip(marks, texts, strict=True):
            for k, piece in enumerate(halves(text, most)):
                yield mark, k, piece

    def leaf(keys: list, texts: list) -> Iterator[tuple]:
        for key, text in zip(keys, texts, strict=True):
            p = encode_piece(path, text)
            yield (*key.values(), p.head, _flat(p.first), p.middle, p.tail, _flat(p.last))

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        pieces = [Piece(r.head, _tokens(r.first), r.middle, r.tail, _tokens(r.last)) for r in pdf.sort_values("k").itertuples()]
        out = pd.DataFrame([finish(concatenate(path, pieces))], columns=[c.split()[0] for c in columns.split(", ")])
        out.insert(0, "mark", pdf["mark"].iloc[0])
        return out

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    whole = map_batches(rows.where(F.char_length("text") <= most), short, schema)
    long = rows.where(F.char_length("text") > most).withColumn("mark", F.sha2("text", 256))
    pieces = map_batches(long.dropDuplicates(["mark"]), cut, "mark string, k int, piece string", ("mark", "text"))
    spread = pieces.repartition("mark", "k").select(F.struct("mark", "k").alias("key"), "piece")
    leaves = map_batches(spread, leaf, "mark string, k int, head string, first array<int>, middle array<int>, tail string, last array<int>", ("key", "piece"))
    done = leaves.groupBy("mark").applyInPandas(join, f"mark string, {columns}")
    return whole.unionByName(long.select("doc_id", "mark").join(done, "mark").drop("mark"))


def _flat(tokens: list[Token]) -> list[int]:
    return [x for t in tokens for x in t]


def _tokens(flat: np.ndarray) -> list[Token]:
    return [tuple(t) for t in np.asarray(flat).reshape(-1, 3).tolist()]


@lru_cache(maxsize=4)
def number_texts(path: str) -> list[str]:
    """Decimal text of every id."""
    return [str(i) for i in range(tokenizer(path).get_vocab_size(with_added_tokens=True))]


@lru_cache(maxsize=4)
def token_texts(path: str) -> list[str] | None:
    """Text of every id if decoding is to join these with blanks: of tokenizers without a decoder."""
    t = tokenizer(path)
    if t.decoder is not None:
        return None
    return [t.id_to_token(i) or "" for i in range(t.get_vocab_size(with_added_tokens=True))]


def decode_ids(path: str, ids: list[int]) -> str:
    """Text of ids, special tokens written out."""
    texts = token_texts(path)
    if texts is None:
        return tokenizer(path).decode(ids, skip_special_tokens=False)
    return " ".join(map(texts.__getitem__, ids))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` of ``encoded(doc_id, ids)``, special tokens written out; null ids give null."""

    def rows(keys: list, ids: list) -> Iterator[tuple]:
        for i, x in zip(keys, ids, strict=True):
            yield i, None if x is None else decode_ids(path, x)

    return map_batches(encoded, rows, "doc_id bigint, text string", ("doc_id", "ids"))
