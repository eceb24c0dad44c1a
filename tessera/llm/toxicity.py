"""Toxicity by non-negative positive-unlabelled learning.

The classifier is linear over which words and word beginnings a text holds once,
twice and three times: a family of inflected words shares its beginning, and a
single mention may be harmless where two are not.  It is trained in numpy from confirmed
toxic texts (positives) and texts whose label isn't looked at (unlabelled).
With the class prior ``pi`` the risk of the negatives is what the unlabelled
texts cost as negatives less ``pi`` times what the positives would, and never
counts as below zero:

    risk = pi * E_p[l(+g)] + max(0, E_u[l(-g)] - pi * E_p[l(-g)])

Features are chosen by the same correction: the rate of a feature among the
negatives is ``(u - pi p) / (1 - pi)``.  The prior is the share of toxic ones
among the labelled rows used for training.

Bounds: the classifier sees at most ``POSITIVES`` and ``UNLABELLED`` whole
texts, those of least hash, and at most ``FEATURES`` features; every text is
scored whole.  Nothing but the text is an input of a score.

Defined cases: a null text is empty and scores as the text without features;
null ids aren't trained on, and are held out where their remainder is null: no;
labels that are null, and documents without one, count as unlabelled; a document
labelled both ways counts as toxic; without positives every score is 0; an empty
table gives an empty table; columns besides id and text are ignored by the
report and carried by ``without_toxic``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import durable

#: Most texts of either kind that the classifier is fitted on.
POSITIVES, UNLABELLED = 2000, 6000
#: Most features that it keeps.
FEATURES = 4096
#: Lengths of the word beginnings that are features.
BEGINNINGS = (3, 4, 5, 6, 7)
#: A feature counts at each of these numbers of occurrences.
LEVELS = (1, 2, 3)
#: Positives that must hold a feature, and log-likelihood ratio by which they must hold it more often than negatives.
SUPPORT, EVIDENCE = 4, 16.0

_WORDS = re.compile(r"\w+")


def folds(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 5; remainder 0 is held out."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(5))


def features_of(word: str) -> tuple[str, ...]:
    """A word and its beginnings, the latter marked with a hyphen."""
    return (word, *[word[:n] + "-" for n in BEGINNINGS if n < len(word)])


def features_in(text: str) -> set[str]:
    """All features of a text; those of second and third occurrences end in the number."""
    count: Counter = Counter()
    for word, n in Counter(_WORDS.findall(text.lower())).items():
        for f in features_of(word):
            count[f] += n
    return {f"{f}|{level}" for f, n in count.items() for level in LEVELS if n >= level}


class Classifier:
    """Weights of features, and the bias."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self._stems = {f.rpartition("|")[0] for f in weights}
        self._seen: dict[str, tuple[str, ...]] = {}

    def score(self, text: str) -> float:
        count: dict[str, int] = {}
        seen, stems = self._seen, self._stems
        for word, n in Counter(_WORDS.findall(text.lower())).items():
            hits = seen.get(word)
            if hits is None:
                if len(seen) > 200_000:
                    seen.clear()
                hits = seen[word] = tuple(f for f in features_of(word) if f in stems)
            for f in hits:
                count[f] = count.get(f, 0) + n
        g = self.bias
        for f in sorted(count):
            g += sum(self.weights.get(f"{f}|{level}", 0.0) for level in LEVELS if count[f] >= level)
        return float(1 / (1 + np.exp(-np.clip(g, -500, 500))))


def _presence(texts: DataFrame) -> DataFrame:
    """(positive, feature, n): how many texts of either kind hold a feature, summed by task."""

    def run(batches):
        count = {0: Counter(), 1: Counter()}

        def flush():
            rows = [(k, f, n) for k, c in count.items() for f, n in c.items()]
            for c in count.values():
                c.clear()
            kind, feature, n = zip(*rows) if rows else ((), (), ())
            return pa.record_batch([pa.array(kind, pa.int32()), pa.array(feature, pa.string()), pa.array(n, pa.int64())], names=["positive", "feature", "n"])

        for batch in batches:
            for text, positive in zip(batch.column("text").to_pylist(), batch.column("positive").to_pylist()):
                count[positive].update(features_in(text))
                if sum(map(len, count.values())) > 500_000:
                    yield flush()
        yield flush()

    return texts.mapInArrow(run, "positive int, feature string, n long")


def choose_features(counts: DataFrame, positives: int, unlabelled: int, prior: float, limit: int = FEATURES) -> list[str]:
    """The features whose rate among positives most exceeds their corrected rate among negatives."""
    side = lambda k: F.sum(F.when(F.col("positive") == k, F.col("n")).otherwise(0))
    rows = counts.groupBy("feature").agg(side(1).alias("p"), side(0).alias("u")).filter(F.col("p") >= SUPPORT)
    p, u = F.col("p") / float(positives), F.col("u") / float(unlabelled)
    negative = F.greatest((u - p * prior) / (1 - prior), F.lit(0.0)) + F.lit(1.0 / unlabelled)
    lift = F.log(p / negative)
    gain = F.col("p") * lift - (F.col("p") - negative * positives)
    rows = rows.withColumn("gain", gain).filter((lift > F.lit(float(np.log(3)))) & (gain > EVIDENCE))
    return [r[0] for r in rows.orderBy(F.desc("gain"), "feature").select("feature").limit(limit).collect()]


def fit(x_p: list[np.ndarray], x_u: list[np.ndarray], n: int, prior: float, steps: int = 600, rate: float = 0.05, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of least non-negative risk with the logistic loss, by Adam on all texts at once.

    ``x_p`` and ``x_u`` hold, for each text, the numbers of its features.
    """
    rows = [*x_p, *x_u]
    text = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    at = np.concatenate(rows).astype("i8") if rows else np.zeros(0, "i8")
    n_p, n_u = len(x_p), len(x_u)
    w, b = np.zeros(n), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -50, 50)))
    soft = lambda z: np.logaddexp(0, z)
    for step in range(1, steps + 1):
        g = b + np.bincount(text, w[at], n_p + n_u)
        g_p, g_u = g[:n_p], g[n_p:]
        slope = np.zeros(n_p + n_u)
        negative = soft(g_u).mean() - prior * soft(g_p).mean()
        if negative >= 0:
            slope[:n_p] = prior * (sigmoid(g_p) - 1) / n_p - prior * sigmoid(g_p) / n_p
            slope[n_p:] = sigmoid(g_u) / n_u
        else:  # the correction has eaten up the risk of the negatives: step back along it alone
            slope[:n_p] = prior * sigmoid(g_p) / n_p
            slope[n_p:] = -sigmoid(g_u) / n_u
        grad = np.r_[np.bincount(at, slope[text], n) + decay * w, slope.sum()]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def least_ids(ids: DataFrame, seed: int, most: int) -> DataFrame:
    """The ``most`` ids of least hash.  A threshold from a count lets about twice as many through, so no task sends more than its share."""
    steps = 1 << 30
    level = min(steps, -(-2 * most * steps // max(1, ids.count())))
    some = ids.filter(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(steps)) < level).distinct()
    return some.orderBy(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(steps)), "id").limit(most)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Classifier:
    """A classifier from the rows that aren't held out."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter("id is not null and y is not null")
    known = known.filter(folds(F.col("id")) != 0).groupBy("id").agg(F.max("y").alias("y"))
    every, toxic = known.agg(F.count("*"), F.sum((F.col("y") == 1).cast("int"))).first()
    if not toxic:
        return Classifier({}, -800.0)
    prior = min(0.9, toxic / every)
    positive = least_ids(known.filter("y = 1").select("id"), 5, POSITIVES).select("id", F.lit(1).alias("positive"))
    ids = docs.select(F.col(id_col).alias("id")).filter("id is not null").filter(folds(F.col("id")) != 0)
    unlabelled = least_ids(ids, 6, UNLABELLED).select("id", F.lit(0).alias("positive"))
    picked = F.broadcast(positive.unionByName(unlabelled))  # POSITIVES + UNLABELLED ids at most
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(picked, "id")
    texts = durable(texts.select("text", "positive"), "sample")
    size = {r["positive"]: r["count"] for r in texts.groupBy("positive").count().collect()}
    if not size.get(1) or not size.get(0):
        return Classifier({}, -800.0)
    names = choose_features(_presence(texts), size[1], size[0], prior)
    number = {f: i for i, f in enumerate(names)}

    def run(batches):
        for batch in batches:
            held = []
            for text in batch.column("text").to_pylist():
                held.append(sorted(number[f] for f in features_in(text) if f in number))
            yield pa.record_batch([batch.column("positive"), pa.array(held, pa.list_(pa.int32()))], names=["positive", "held"])

    rows = texts.select("text", "positive").mapInArrow(run, "positive int, held array<int>").toArrow()
    held = [np.array(x, "i4") for x in rows["held"].to_pylist()]
    kind = rows["positive"].to_pylist()
    order = sorted(range(len(held)), key=lambda i: (kind[i], held[i].tolist()))  # the same sums whatever the partitioning
    w, b = fit([held[i] for i in order if kind[i] == 1], [held[i] for i in order if kind[i] == 0], len(names), prior)
    return Classifier({f: float(x) for f, x in zip(names, w) if abs(x) > 1e-6}, b)


def score(docs: DataFrame, classifier: Classifier, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` as struct ``row`` with their ``score``."""
    packed = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    weights, bias = classifier.weights, classifier.bias

    @F.pandas_udf("double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = Classifier(weights, bias)  # one for each task: it remembers the words that it has seen
        for text in texts:
            yield text.map(model.score).astype("float64")

    return packed.select("row", run("text").alias("score"))


def score_ids(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score, predicted of every document."""
    got = score(docs.select(id_col, text_col), classifier, text_col).select(F.col(f"row.{id_col}").alias(id_col), "score")
    held = F.coalesce(folds(F.col(id_col)) == 0, F.lit(False))
    return got.select(id_col, held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the classifier doesn't call toxic, with all their columns."""
    return score(docs, train(docs, labels, id_col, text_col), text_col).filter(F.col("score") < threshold).select("row.*")
