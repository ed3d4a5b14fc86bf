"""Toxicity scores by weak supervision: voters, a generative label model and a linear classifier."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, stash, unused

WORD = re.compile(r"[^\W\d_]+")
#: Insults that vote before any are learnt.
LEXICON = (
    "idiot", "moron", "stupid", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "clown",
    "imbécile", "connard", "crétin", "salaud", "dummkopf", "arschloch", "scheisse", "idiota", "estúpido", "imbécil",
)
#: Patterns that vote on the way a text is written.
PATTERNS = {
    "#shout": re.compile(r"(?:\b[A-Z]{4,}\b[^\w]*){3}"),
    "#bangs": re.compile(r"[!?]{3,}"),
    "#stretch": re.compile(r"([a-z])\1{3}"),
    "#you": re.compile(r"(?i)\byou(?:'re| are) (?:an?|such)\b"),
}
#: Lexicon voters, the fixed one and bands of learnt words, and bands of prefixes; with the patterns 16 in all.
LEXICON_VOTERS, PREFIX_VOTERS = 8, 4
#: Terms with company that a task remembers at a time.
MOST_SEEN = 100_000
VOTERS = LEXICON_VOTERS + PREFIX_VOTERS + len(PATTERNS)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def hash64(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def terms_in_company(text: str) -> dict[str, int]:
    """The terms of a text, words in lower case and ``abcd*`` for the first four and five letters of longer ones, with a hash of the words beside the first place of each."""
    words = WORD.findall(text.lower())
    out: dict[str, int] = {}
    for k, w in enumerate(words):
        if len(w) > 2 and w not in out:
            company = hash64(" ".join(words[max(0, k - 1) : k + 2]))
            for term in (w, *([w[:4] + "*"] if len(w) > 4 else ()), *([w[:5] + "*"] if len(w) > 5 else ())):
                out.setdefault(term, company)
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """Texts of at most ``most`` labelled rows of each class that are not held out, by a hash of the id."""
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("__id"))
        .agg(F.max("toxic").alias("toxic"))
    )
    picked = [known.where(c).orderBy(F.xxhash64("__id"), "__id").limit(most) for c in ("toxic = 1", "toxic <> 1")]
    few = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 * most rows of two numbers
    return docs.select("doc_id", "text").join(few, F.col("doc_id") == F.col("__id")).select("doc_id", "text", "toxic")


def learn_terms(sample: DataFrame, least_texts: int = 3, least_ratio: float = 6.0, margin: float = 4.0) -> list[tuple[str, float]]:
    """Terms far commoner in toxic texts of the sample, with their log ratio, the surest first.

    The likelihood-ratio statistic of a term must exceed what the best of as many terms would reach by
    chance (twice the log of their number) by ``margin``, so rare words of a large vocabulary do not pass. Clean texts may
    have it too: its share of toxic texts must exceed ``least_ratio`` times that of clean ones, and how far it does is
    the label model's to judge.

    What is counted per class are the different companies a term keeps, the words beside its first place in a text: words of
    passages that many texts copy keep one. Equal rows are dropped per batch first. The sample bounds the terms that go to the driver.
    """

    def rows(labels: list, texts: list) -> Iterator[tuple]:
        seen = set()  # spares copies within a batch; what is told twice is dropped below
        for k, (toxic, text) in enumerate(zip(labels, texts, strict=True)):
            for told in ((*x, toxic == 1) for x in terms_in_company(text or "").items()):
                if told not in seen:
                    if len(seen) == MOST_SEEN:
                        seen.clear()
                    seen.add(told)
                    yield told
            yield "", hash64(f"{k} {text}"), toxic == 1

    # Copies of texts and passages say nothing new about their words: a term counts once per class and company.
    told = map_batches(sample.dropDuplicates(["text", "toxic"]), rows, "term string, company bigint, toxic boolean", ("toxic", "text"), most=20_000).distinct()
    counts = stash(told.groupBy("term").agg(F.count_if(~F.col("toxic")).alias("clean"), F.count_if("toxic").alias("toxic")), "toxic_terms")
    total = counts.where("term = ''").first()
    if not total or not total["toxic"] or not total["clean"]:
        return []
    t, c = F.col("toxic"), F.col("clean")
    share = total["toxic"] / (total["toxic"] + total["clean"])
    ratio = F.log((t + 0.5) / (total["toxic"] + 1)) - F.log((c + 0.5) / (total["clean"] + 1))
    part = lambda n, p: F.when(n > 0, n * F.log(n / ((t + c) * p))).otherwise(0.0)
    evidence = 2 * (part(t, share) + part(c, 1 - share))
    tried = counts.count()
    surest = (
        counts.where(f"term <> '' AND toxic >= {least_texts}")
        .select("term", ratio.alias("ratio"), evidence.alias("g"))
        .where((F.col("ratio") >= math.log(least_ratio)) & (F.col("g") >= 2 * math.log(tried) + margin))
        .orderBy(F.desc("g"), "term")
    )
    return [(r["term"], r["ratio"]) for r in surest.collect()]


def find_terms(docs: DataFrame, terms: list[str]) -> DataFrame:
    """``doc_id, mark, found``: which of ``terms`` and patterns each whole text has; null counts as empty."""
    known = frozenset(terms)

    def rows(keys: list, texts: list) -> Iterator[tuple]:
        for key, text in zip(keys, texts, strict=True):
            text = text or ""
            found = set()
            for w in set(WORD.findall(text.lower())):
                if w in known:
                    found.add(w)
                if (p := w[:4] + "*") in known and len(w) > 4:
                    found.add(p)
                if (p := w[:5] + "*") in known and len(w) > 5:
                    found.add(p)
            yield key["doc_id"], key["mark"], sorted(found) + [k for k, p in PATTERNS.items() if p.search(text)]

    keyed = docs.select(F.struct("doc_id", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("mark")).alias("key"), "text")
    return map_batches(keyed, rows, "doc_id bigint, mark bigint, found array<string>", ("key", "text"))


def voter_of(learnt: list[tuple[str, float]]) -> dict[str, int]:
    """The voter each term and pattern belongs to.

    The fixed lexicon is the first voter. Learnt words, and apart from them learnt prefixes, are lexicons of like
    strength: bands of equal size in order of their log ratio. Each has thus an accuracy of its own; each pattern is a voter too.
    """
    out = dict.fromkeys(LEXICON, 0)
    strong = [t for t, _ in sorted(learnt, key=lambda x: (-x[1], x[0])) if t not in out]
    for first, n, band in (
        (1, LEXICON_VOTERS - 1, [t for t in strong if not t.endswith("*")]),
        (LEXICON_VOTERS, PREFIX_VOTERS, [t for t in strong if t.endswith("*")]),
    ):
        out |= {t: first + k * n // len(band) for k, t in enumerate(band)}
    return out | {k: LEXICON_VOTERS + PREFIX_VOTERS + n for n, k in enumerate(PATTERNS)}


def votes(found: Column, voters: dict[str, int]) -> Column:
    """Bit set of the voters that speak for toxic; the others abstain."""
    bits = F.create_map(*[x for t, v in voters.items() for x in (F.lit(t), F.lit(1 << v))])
    return F.aggregate(found, F.lit(0), lambda acc, t: acc.bitwiseOR(F.coalesce(bits[t], F.lit(0))))


class LabelModel:
    """A generative model of the votes: per class, how often each voter speaks, given the voter it depends on.

    Dependencies form a tree that is part of the likelihood: of all trees the one whose edges explain most (the mutual information of two
    voters within the classes, Chow and Liu), without edges that gain less than their two parameters cost (half the log of the rows each).
    Expectation maximisation over the counts of vote vectors (at most 2 ** VOTERS rows, whatever the corpus), labelled counts keeping their
    class, chooses tree and rates anew each round until a round adds less than ``least_gain`` to the mean log likelihood of a row.
    """

    def __init__(self, vectors: np.ndarray, counts: np.ndarray, labelled: np.ndarray, prior: float, rounds: int = 200, least_gain: float = 1e-7):
        x = votes_of(vectors)
        self.prior = min(max(prior, 1e-3), 0.5)
        speaks = x[:, : LEXICON_VOTERS + PREFIX_VOTERS].any(axis=1)
        q = np.where(speaks, 0.9, 0.02)
        seen = labelled.sum(axis=1)
        free = np.maximum(counts - seen, 0)
        q = np.where(seen > 0, (labelled[:, 1] + 2 * q) / (seen + 2), q)
        self.gains: list[float] = []
        for _ in range(rounds):
            self._fit(x, np.stack([free * (1 - q) + labelled[:, 0], free * q + labelled[:, 1]]))
            joint = self._joint(x)
            whole = np.logaddexp(*joint)
            q = np.exp(joint[1] - whole)
            self.gains.append(float((free * whole).sum() + (labelled.T * joint).sum()) / max(float(counts.sum()), 1.0))
            if len(self.gains) > 1 and abs(self.gains[-1] - self.gains[-2]) < least_gain:
                break

    def _fit(self, x: np.ndarray, mass: np.ndarray) -> None:
        size = mass.sum(axis=1)
        both = np.stack([(x * m[:, None]).T @ x for m in mass])
        alone = np.stack([np.diag(b) for b in both])
        self.rate = (alone + np.array([[0.02], [0.2]])) / (size[:, None] + 1)
        self.parent = tree_of(both, size)
        # What a voter does beside its parent's vote or silence is shrunk, by two rows, to what it does anyway.
        child = np.flatnonzero(self.parent >= 0)
        spoken = np.zeros_like(alone)
        beside, spoken[:, child] = np.zeros_like(alone), alone[:, self.parent[child]]
        beside[:, child] = both[:, child, self.parent[child]]
        silent = (alone - beside + 2 * self.rate) / (size[:, None] - spoken + 2)
        self.given = np.stack([np.where(self.parent >= 0, silent, self.rate), (beside + 2 * self.rate) / (spoken + 2)], axis=2)

    def _joint(self, x: np.ndarray) -> np.ndarray:
        """Log probability of each class and vote vector."""
        above = np.where(self.parent >= 0, x[:, self.parent], 0)
        p = self.given[:, np.arange(VOTERS), above]
        logs = np.where(x == 1, np.log(p), np.log1p(-p)).sum(axis=2)
        return logs + np.log([[1 - self.prior], [self.prior]])

    def posterior(self, vectors: np.ndarray) -> np.ndarray:
        """Probability of toxic for each vote vector."""
        joint = self._joint(votes_of(vectors))
        return np.exp(joint[1] - np.logaddexp(*joint))


def votes_of(vectors: np.ndarray) -> np.ndarray:
    return (vectors[:, None] >> np.arange(VOTERS)) & 1


def tree_of(both: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The parent of each voter, or -1, from how often two voters speak together in each class."""
    gain = np.zeros(both.shape[1:])
    for b, n in zip(both, np.maximum(size, 1e-9), strict=True):
        one = np.diag(b)
        cells = (b, one[:, None] - b, one[None, :] - b, n - one[:, None] - one[None, :] + b)
        sides = ((one, one), (one, n - one), (n - one, one), (n - one, n - one))
        for cell, (i, j) in zip(cells, sides, strict=True):
            cell = np.maximum(cell, 0)
            expected = np.outer(i, j) / n
            gain += np.where((cell > 0) & (expected > 0), cell * np.log(np.where(cell > 0, cell, 1) / np.where(expected > 0, expected, 1)), 0)
    near: dict[int, list[int]] = {k: [] for k in range(len(gain))}
    part = list(range(len(gain)))
    edges = sorted((-gain[i, j], i, j) for i in range(len(gain)) for j in range(i))
    for less, i, j in edges:
        if -less <= math.log(max(size.sum(), 1)):
            break
        if part[i] != part[j]:
            near[i].append(j)
            near[j].append(i)
            part = [part[j] if p == part[i] else p for p in part]
    parent = np.full(len(gain), -1)
    for root in range(len(gain)):
        todo = [root] if part[root] >= 0 else []
        while todo:
            k = todo.pop()
            part[k] = -1
            for c in near[k]:
                if part[c] >= 0:
                    parent[c] = k
                    todo.append(c)
    return parent


def score_toxicity(docs: DataFrame, labels: DataFrame, most_labelled: int = 10_000, most_train: int = 20_000) -> DataFrame:
    """Score every whole text of ``docs(doc_id, text, ...)``: ``doc_id, held_out, score, predicted``.

    Rows whose crc32(doc_id) is divisible by 5 are held out: their labels are never read. Of the
    others at most ``most_labelled`` of each class teach which terms and prefixes mark toxic texts; these vote in lexicons of like strength, beside a fixed lexicon and
    patterns. The label model is fitted to the votes of all texts and gives each a posterior; a logistic
    regression on the terms found learns these posteriors from at most ``most_train`` rows, again by
    a hash of the id. The score depends on the text alone.

    Null and empty texts get the score of a text without any term. Null ids are not held out and
    never labelled; repeated rows get the same score each; other columns are ignored. Without labels
    of both classes the fixed lexicon alone votes; an empty table gives an empty result.
    """
    found, score = _scores(docs, labels, most_labelled, most_train)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def _scores(docs: DataFrame, labels: DataFrame, most_labelled: int = 10_000, most_train: int = 20_000) -> tuple[DataFrame, Column]:
    """``doc_id, mark, found`` of every row and the score as an expression of them."""
    sample = stash(labelled_sample(docs, labels, most_labelled), "toxic_sample")
    learnt = learn_terms(sample)
    terms = list(dict.fromkeys([t for t, _ in learnt] + list(LEXICON)))
    found = stash(find_terms(docs, terms), "toxic_found")
    voters = voter_of(learnt)
    voted = found.select("doc_id", "found", votes(F.col("found"), voters).alias("votes"))

    known = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    share = known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    truth = sample.select(F.col("doc_id").alias("__id"), "toxic").distinct()
    counts = voted.groupBy("votes").count().collect()  # at most 2 ** VOTERS rows
    seen = voted.join(truth, F.col("doc_id") == F.col("__id")).groupBy("votes", "toxic").count().collect()
    place = {r["votes"]: k for k, r in enumerate(counts)}
    labelled = np.zeros((len(counts), 2))
    for r in seen:
        labelled[place[r["votes"]], int(r["toxic"] == 1)] += r["count"]
    vectors = np.array([r["votes"] for r in counts], dtype=np.int64)
    model = LabelModel(vectors, np.array([r["count"] for r in counts], dtype=float), labelled, 0.05 if share is None else share)
    weights, bias = _classifier(voted.where(~held_out(F.col("doc_id"))), terms, model, vectors, most_train)

    points = F.create_map(*[x for t, w in weights.items() for x in (F.lit(t), F.lit(w))])
    total = F.aggregate("found", F.lit(float(bias)), lambda acc, t: acc + F.coalesce(points[t], F.lit(0.0)))
    return found, F.round(1 / (1 + F.exp(-total)), 9)


def _classifier(voted: DataFrame, terms: list[str], model: LabelModel, vectors: np.ndarray, most: int) -> tuple[dict[str, float], float]:
    """Weight per term and bias of a logistic regression on the label model's posteriors."""
    names = [*terms, *PATTERNS]
    if not len(vectors):
        return dict.fromkeys(names, 0.0), 0.0
    spark = voted.sparkSession
    posterior = spark.createDataFrame(
        [(int(v), float(q)) for v, q in zip(vectors, model.posterior(vectors), strict=True)], "votes int, q double"
    )
    rows = voted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).join(posterior, "votes")
    sides = F.explode(F.array(*[F.struct(F.lit(y).alias("label"), w.alias("w")) for y, w in ((1.0, F.col("q")), (0.0, 1 - F.col("q")))]))
    rows = rows.select("found", sides.alias("s")).select("found", "s.label", "s.w").where("w > 0")
    features = CountVectorizerModel.from_vocabulary(names, inputCol="found", outputCol="features").setBinary(True)
    rows = stash(rows, "toxic_train")
    fitted = LogisticRegression(weightCol="w", regParam=1e-4, maxIter=40, standardization=False, family="binomial").fit(features.transform(rows))
    return dict(zip(names, map(float, fitted.coefficients.toArray()), strict=True)), float(fitted.intercept)


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` that are not predicted toxic, columns as they were; a row is known by its id and text.

    Null texts are scored as empty ones; any other column may have any name; an empty table stays empty.
    """
    known, mark = unused(docs, "__id", "__mark")
    found, score = _scores(docs, labels, **options)
    bad = found.where(score >= 0.5).select(F.col("doc_id").alias(known), F.col("mark").alias(mark)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(known)) & (F.coalesce(F.xxhash64("text"), F.lit(0)) == F.col(mark))
    return docs.join(bad, same, "left_anti")
