"""Toxicity scores by weak supervision.

1. Voters. Lexicon terms are mined from all labelled documents: words and word beginnings
   whose document frequencies in the two classes differ far beyond chance. They are dealt to `LEXICON_VOTERS` lexicon voters
   in order of strength. Pattern voters look at shouting, runs of marks, symbol noise and short texts.
2. A generative label model learns each voter's accuracy by expectation maximisation over the counts of all vote
   patterns of all documents (at most 2**voters, whatever the input), where labelled documents keep their label. Voters
   that still agree beyond what the model explains share their weight, by the measured residual correlation.
3. A linear classifier over the lexicon terms, their share of the text and the pattern votes is trained on the posteriors of a bounded sample of
   documents (`MAX_FIT`) and scores every document.

Labels are joined, not collected: their number is not bounded. The texts of labelled documents are read twice, whole, for the
term frequencies and for the votes; what is written down is the short list of a document's lexicon terms and votes.

Defined cases: a null or empty text has no lexicon terms and is scored by its pattern votes; repeated rows get equal
scores; null doc_ids are scored and never used as labelled; labels other than 0 and 1, and ids with contradicting labels,
are not used; without labelled documents of both classes every score is 0; empty tables give no rows; other columns are left out.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderweave.session import materialize

#: Documents the classifier is fitted on: bound of the sample.
MAX_FIT = 20_000
#: Terms kept, and the least evidence for one: log-likelihood ratio and documents of the class it speaks for.
MAX_TERMS, MIN_EVIDENCE, MIN_DOCUMENTS = 256, 15.0, 3
#: Letters of a word beginning; longer words give both the word and its beginning with a star.
BEGINNING = 5
LEXICON_VOTERS = 12
#: Words added to a text's own when the share of its terms is taken.
SHORTEST = 20
EM_ROUNDS, FIT_ROUNDS, RIDGE = 50, 50, 1e-3

PATTERN_VOTERS = ("shouting", "marks", "noise", "short")


def words_of(text: Column) -> Column:
    return F.split(F.lower(text), r"[^\p{L}\p{N}']+")


def terms_of(words: Column) -> Column:
    beginnings = F.transform(
        F.filter(words, lambda w: F.length(w) > BEGINNING), lambda w: F.concat(F.substring(w, 1, BEGINNING), F.lit("*")))
    return F.concat(words, beginnings)


def pattern_votes(text: Column) -> list[Column]:
    """One boolean for each pattern voter."""
    length = F.greatest(F.length(text), F.lit(1))
    capitals = length - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    marks = length - F.length(F.translate(text, "!?", ""))
    noise = length - F.length(F.translate(text, "#$%&*@^~", ""))
    return [capitals > length * 0.3, marks > length * 0.05, noise > length * 0.1, F.length(text) < 100]


def usable_labels(labels: DataFrame) -> DataFrame:
    """(id, y): every labelled id whose labels agree."""
    return (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("id")).agg(F.min("toxic").alias("y"), F.max("toxic").alias("hi"))
        .where("y = hi").drop("hi")
    )


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def mine_words(docs: DataFrame, known: DataFrame) -> list[str]:
    """Terms that speak for label 1, strongest first, by their frequencies in all labelled documents."""
    # by shuffle whatever the size: the labels of a partition are the smaller side, so texts need no sort
    chosen = docs.join(known.hint("shuffle_hash"), F.col("doc_id") == F.col("id"))
    sizes = {r["y"]: r["n"] for r in chosen.groupBy("y").agg(F.count("*").alias("n")).collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    if not pos or not neg:
        return []
    counts = (
        chosen.select("y", F.explode(F.array_distinct(terms_of(words_of(F.coalesce("text", F.lit("")))))).alias("word"))
        .where(F.length("word") > 1)
        .groupBy("word").agg(F.sum("y").alias("a"), F.count("*").alias("n"))
        .where(F.col("a") >= MIN_DOCUMENTS).withColumn("b", F.col("n") - F.col("a"))
    )

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    a, b, total = F.col("a"), F.col("b"), pos + neg
    share = (a + b) / F.lit(float(total))
    evidence = 2 * (
        part(a, share * pos) + part(b, share * neg)
        + part(pos - a, (1 - share) * pos) + part(neg - b, (1 - share) * neg))
    best = (
        counts.withColumn("evidence", evidence)
        .where((F.col("evidence") >= MIN_EVIDENCE) & (a / F.lit(float(pos)) > 2 * b / F.lit(float(neg))))
        .orderBy(F.col("evidence").desc(), "word").limit(MAX_TERMS)
    )
    return [r["word"] for r in best.collect()]


def marked(docs: DataFrame, words: list[str], known: DataFrame) -> DataFrame:
    """doc_id, y (or null), hits (lexicon terms of the text), n_words and votes (bits: lexicon, then pattern voters)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lexicon = F.array(*map(F.lit, words)) if words else F.array().cast("array<string>")
    votes = F.lit(0)
    for n, vote in enumerate(pattern_votes(text)):
        votes = votes + F.when(vote, 1 << (LEXICON_VOTERS + n)).otherwise(0)
    found = docs.select(
        "doc_id", F.array_sort(F.array_intersect(terms_of(words_of(text)), lexicon)).alias("hits"),
        F.size(words_of(text)).alias("n_words"), votes.alias("votes"))
    for n in range(LEXICON_VOTERS):
        group = words[n::LEXICON_VOTERS]
        if group:
            hit = F.arrays_overlap("hits", F.array(*map(F.lit, group)))
            found = found.withColumn("votes", F.col("votes") + F.when(hit, 1 << n).otherwise(0))
    return found.join(known.hint("shuffle_hash"), F.col("doc_id") == F.col("id"), "left").select(
        "doc_id", "y", "hits", "n_words", "votes")


def _bits(votes: np.ndarray, voters: int) -> np.ndarray:
    return ((votes[:, None] >> np.arange(voters)) & 1).astype(float)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


class LabelModel:
    """P(vote = 1 | class) of every voter, the prior, and each voter's share of its weight."""

    def __init__(self, votes: np.ndarray, known: np.ndarray, n: np.ndarray, voters: int):
        x = _bits(votes, voters)
        anchored = known >= 0
        truth = np.where(anchored, known, 0)
        y, weight = truth[anchored], n[anchored]

        def rates(q: np.ndarray, w: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            hit = (rows.T @ (w * q) + 0.5) / ((w * q).sum() + 1)
            miss = (rows.T @ (w * (1 - q)) + 0.5) / ((w * (1 - q)).sum() + 1)
            return hit, miss

        # the labelled documents give the start, all documents the estimate
        self.hit, self.miss = rates(y, weight, x[anchored])
        self.prior = (float((weight * y).sum()) + 1) / (float(weight.sum()) + 2)
        self.share = np.ones(voters)
        q = truth.astype(float)
        for _ in range(EM_ROUNDS):
            q = np.where(anchored, truth, self.posterior(votes))
            self.hit, self.miss = rates(q, n, x)
            self.prior = float((n * q).sum() + 1) / float(n.sum() + 2)
        # what two voters agree on beyond the model: correlation of their residuals
        expected = q[:, None] * self.hit + (1 - q[:, None]) * self.miss
        residual = (x - expected) * np.sqrt(n)[:, None]
        cov = residual.T @ residual
        scale = np.sqrt(np.outer(np.diag(cov), np.diag(cov))) + 1e-9
        corr = np.clip(cov / scale, 0, 1)
        np.fill_diagonal(corr, 0)
        self.share = 1 / (1 + np.where(corr > 0.1, corr, 0).sum(axis=1))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        x = _bits(votes, len(self.hit))
        odds = np.log(self.hit / self.miss) * x + np.log((1 - self.hit) / (1 - self.miss)) * (1 - x)
        return _sigmoid(math.log(self.prior / (1 - self.prior)) + odds @ self.share)


def _fit_linear(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Ridge logistic regression on soft labels by Newton steps; the bias is the last weight."""
    x = np.c_[x, np.ones(len(x))]
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], RIDGE * len(x))
    penalty[-1] = 0
    for _ in range(FIT_ROUNDS):
        p = _sigmoid(x @ w)
        slope = x.T @ (q - p) - penalty * w
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score and predicted of every document; ``labels`` are those that may be learned from."""
    labelled = materialize(usable_labels(labels), "labelled-ids")
    narrow = docs.select("doc_id", "text")
    words = mine_words(narrow, labelled)
    seen = materialize(marked(narrow, words, labelled), "votes")
    if not words:
        return seen.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))

    voters = LEXICON_VOTERS + len(PATTERN_VOTERS)
    table = seen.groupBy("votes", F.coalesce("y", F.lit(-1)).alias("y")).agg(F.count("*").alias("n")).collect()
    votes, known, n = (np.array([r[c] for r in table], np.int64) for c in ("votes", "y", "n"))
    model = LabelModel(votes, known, n.astype(float), voters)

    # a bounded sample by hash, half of it from documents with a lexicon word if there are so many
    picked = []
    for has in (F.size("hits") > 0, F.size("hits") == 0):
        picked += seen.where(has).select("hits", "n_words", "votes", F.coalesce("y", F.lit(-1)).alias("y")).orderBy(
            F.xxhash64("doc_id"), "doc_id").limit(MAX_FIT // 2).collect()
    place = {w: i for i, w in enumerate(words)}
    x = np.zeros((len(picked), len(words) + len(PATTERN_VOTERS) + 1))
    for i, r in enumerate(picked):
        x[i, [place[w] for w in r["hits"]]] = 1
        x[i, len(words):-1] = [(r["votes"] >> (LEXICON_VOTERS + k)) & 1 for k in range(len(PATTERN_VOTERS))]
        x[i, -1] = math.log((1 + len(r["hits"])) / (SHORTEST + r["n_words"]))
    known = np.array([r["y"] for r in picked])
    believed = model.posterior(np.array([r["votes"] for r in picked], np.int64))
    w = _fit_linear(x, np.where(known >= 0, known, believed))

    weights = F.create_map(*[c for word, v in zip(words, w) for c in (F.lit(word), F.lit(float(v)))])
    total = F.lit(float(w[-1])) + F.aggregate(
        "hits", F.lit(0.0), lambda sum_, word: sum_ + F.element_at(weights, word))
    total = total + F.log((1 + F.size("hits")) / (SHORTEST + F.col("n_words"))) * F.lit(float(w[-2]))
    for k, v in enumerate(w[len(words):-2]):
        total = total + F.shiftright("votes", LEXICON_VOTERS + k).bitwiseAND(F.lit(1)) * F.lit(float(v))
    score = 1.0 / (1.0 + F.exp(-total))
    return seen.select("doc_id", score.alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def remove_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns. Of rows that repeat a doc_id, each toxic one
    takes the others with it."""
    toxic = materialize(
        score_documents(docs, labels).where("predicted = 1").select(F.col("doc_id").alias("__toxic")).distinct(), "toxic")
    return docs.join(toxic, F.col("doc_id").eqNullSafe(F.col("__toxic")), "left_anti")
