"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; all other text is unlabelled, not
negative. With p the share of toxic text, the risk of a classifier g is

    p * mean_pos[loss(g, +1)] + max(0, mean_unl[loss(g, -1)] - p * mean_pos[loss(g, -1)])

The bracket estimates the risk on clean text. Where it falls below zero the
classifier has started to overfit and the step goes the other way.

Linear classifiers over words and beginnings of words, their logistic loss
minimised with numpy, are trained in Spark tasks, each on the training rows
without one fold, and averaged. Training rows are a sample bounded by the
parameters MOST_POSITIVE and MOST_UNLABELLED, drawn by hash; everything else
covers all rows. Features are those of the sample whose share in toxic and unlabelled
texts differs by more than chance, so the sample bounds the model, which is
broadcast. Scoring is one pass without a shuffle.

Defined cases: a NULL text is an empty one; it scores by the bias alone. A
document labelled twice is toxic if one label says so; NULL labels and labels of
unknown documents count for nothing. Without any confirmed toxic text every
score is the prior. Rows with a NULL id have no label and are not held out. Very long
texts are scored whole; equal texts score the same and are fitted on once. A score of 0.5
counts as toxic. An empty table gives no rows. A column `score` of the caller is replaced
by `scored`; `without_toxic` returns all columns as they came.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout.llm.common import draw, one_row, table

MOST_POSITIVE = 4_000
MOST_UNLABELLED = 8_000
CLASSIFIERS = 3
PRIOR = 0.1
FOLDS = 5
PREFIXES = (4, 5, 6, 8)
LEAST_POSITIVES = 3
STEPS, RATE, DECAY = 400, 0.1, 1e-4

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
BIAS = b""


def features(text: bytes | None) -> set[bytes]:
    """The words of a text and how they begin: with one star, or two if several do."""
    words = set(WORD.findall(text.lower())) if text else set()
    found = set(words)
    for n in PREFIXES:
        once, again = set(), set()
        for start in [w[:n] for w in words if len(w) >= n]:
            (again if start in once else once).add(start)
        found.update([start + b"*" for start in once])
        found.update([start + b"**" for start in again])
    return found


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    """Whether the id is in the fold that training never sees."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % folds
    return F.coalesce(fold == 0, F.lit(False))


# --- training, on the rows of one classifier -----------------------------------------


def telling_features(texts: list[bytes]) -> dict[bytes, int]:
    """Numbers of the features that several of the texts have."""
    counts = Counter(f for t in texts for f in features(t))
    return {f: i for i, f in enumerate(sorted(f for f, n in counts.items() if n >= LEAST_POSITIVES))}


def pick_features(in_pos: np.ndarray, n_pos: int, in_unl: np.ndarray, n_unl: int) -> np.ndarray:
    """All features whose share differs between positives and unlabelled texts.

    The difference must be larger than chance would make that of one of all features
    tried, so that rare words of a few texts are not learnt. Whether a feature speaks for
    toxic or clean text, and how much it tells at the given prior, the risk weighs.
    """
    by_chance = 2 * np.log(max(len(in_pos), 2))
    gains = [likelihood_ratio(a, n_pos, b, n_unl) for a, b in zip(in_pos.tolist(), in_unl.tolist())]
    return np.flatnonzero(np.array(gains) > by_chance)


def likelihood_ratio(a: int, n: int, b: int, m: int) -> float:
    """Twice the log-likelihood gained by giving a of n and b of m rates of their own."""
    rate = (a + b) / (n + m)

    def gain(k: int, of: int) -> float:
        parts = ((k, rate), (of - k, 1 - rate))
        return sum(x * np.log(x / (of * r)) for x, r in parts if x)

    return 2 * (gain(a, n) + gain(b, m))


def nn_pu(rows, cols, n_rows: int, n_cols: int, positive: np.ndarray, prior: float):
    """Weights and bias of least non-negative risk, by gradient steps (Adam)."""
    pos, unl = positive, ~positive
    w, b = np.zeros(n_cols), np.log(prior / (1 - prior))
    m, v = np.zeros(n_cols + 1), np.zeros(n_cols + 1)
    for step in range(1, STEPS + 1):
        g = b + np.bincount(rows, weights=w[cols], minlength=n_rows)
        toxic = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
        loss_clean = np.logaddexp(0, g)
        clean_risk = loss_clean[unl].mean() - prior * loss_clean[pos].mean()
        # Derivatives by g of the two parts of the risk.
        as_clean = np.where(pos, -prior * toxic / pos.sum(), toxic / unl.sum())
        as_toxic = np.where(pos, prior * (toxic - 1) / pos.sum(), 0.0)
        by_g = as_toxic + as_clean if clean_risk >= 0 else -as_clean
        grad = np.append(
            np.bincount(cols, weights=by_g[rows], minlength=n_cols) + DECAY * w, by_g.sum()
        )
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def train(texts: list[bytes], positive: np.ndarray, prior: float) -> dict[bytes, float]:
    """Weight by feature, the bias under BIAS."""
    if not positive.any() or positive.all():
        return {BIAS: float(np.log(prior / (1 - prior)))}
    number = telling_features([t for t, p in zip(texts, positive) if p])
    found = [np.array([number[f] for f in features(t) & number.keys()], np.int64) for t in texts]
    rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
    cols = np.concatenate(found)
    in_pos = np.bincount(cols[positive[rows]], minlength=len(number))
    in_unl = np.bincount(cols[~positive[rows]], minlength=len(number))
    n_pos = int(positive.sum())
    best = pick_features(in_pos, n_pos, in_unl, len(texts) - n_pos)
    place = np.full(len(number), -1)
    place[best] = np.arange(len(best))
    used = place[cols] >= 0
    w, b = nn_pu(rows[used], place[cols[used]], len(texts), len(best), positive, prior)
    names = list(number)
    return {BIAS: float(b)} | {names[i]: float(v) for i, v in zip(best, w)}


# --- on Spark -----------------------------------------------------------------------


def training_rows(
    docs: DataFrame,
    labels: DataFrame,
    most_positive: int,
    most_unlabelled: int,
    prior: float | None,
    prior_unknown: float,
) -> tuple[DataFrame, float]:
    """(text, positive, fold) of a bounded sample without held-out rows, and the prior."""
    texts = docs.select(
        F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).cast("binary").alias("text")
    ).where(~held_out(F.col("doc_id")))
    known = (
        labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    counts = one_row(known.agg(F.count("*").alias("n"), F.count_if(F.col("toxic") == 1).alias("t")))
    if prior is None:
        # Where only one kind is labelled, its share says nothing.
        estimable = 0 < counts["t"] < counts["n"]
        prior = counts["t"] / counts["n"] if estimable else prior_unknown
    # At most about most_positive ids: small enough to broadcast, whatever the input.
    toxic = known.where("toxic = 1").where(
        draw(F.lit("positive"), F.col("doc_id")) < most_positive / max(counts["t"], 1)
    )
    toxic = toxic.select(F.col("doc_id").alias("_toxic"))
    joined = texts.join(F.broadcast(toxic), F.col("id") == F.col("_toxic"), "left")
    is_positive = F.col("_toxic").isNotNull()
    sizes = one_row(joined.agg(F.count("*").alias("n"), F.count_if(is_positive).alias("t")))
    by_row = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 40)) / float(1 << 40)
    as_positive = is_positive & (by_row < most_positive / max(sizes["t"], 1))
    again = F.pmod(F.xxhash64("text", "id"), F.lit(1 << 40)) / float(1 << 40)
    as_unlabelled = again < most_unlabelled / max(sizes["n"], 1)
    kinds = F.filter(
        F.array(F.when(as_positive, F.lit(True)), F.when(as_unlabelled, F.lit(False))),
        lambda kind: kind.isNotNull(),
    )
    rows = joined.select(
        "text",
        F.explode(kinds).alias("positive"),
        F.pmod(F.xxhash64("text"), F.lit(CLASSIFIERS)).alias("fold"),
    )
    # Copies teach nothing new, and one text may be most of the sample.
    return rows.dropDuplicates(), prior


def fit(
    docs: DataFrame,
    labels: DataFrame,
    most_positive: int = MOST_POSITIVE,
    most_unlabelled: int = MOST_UNLABELLED,
    prior: float | None = None,
    prior_unknown: float = PRIOR,
) -> dict[bytes, float]:
    """The averaged classifier: weight by feature.

    `prior` is the share of toxic texts, between 0 and 1, both exclusive. By default it is
    that of the labels (without held-out rows), or `prior_unknown` where they are all of
    one kind and so tell nothing of it. A hash sample of about `most_positive` and
    `most_unlabelled` texts is fitted on: the variance of the risk falls with their numbers,
    its mean does not depend on them.
    """
    for given in (prior, prior_unknown):
        if given is not None and not 0 < given < 1:
            raise ValueError("a prior lies between 0 and 1")
    rows, prior = training_rows(docs, labels, most_positive, most_unlabelled, prior, prior_unknown)
    others = F.filter(
        F.sequence(F.lit(0), F.lit(CLASSIFIERS - 1)), lambda k: k != F.col("fold").cast("int")
    )

    def fit_one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["text", "positive"])
        positive = pdf["positive"].to_numpy(dtype=bool)
        model = train([bytes(t) for t in pdf["text"]], positive, prior)
        return pd.DataFrame({"feature": list(model), "weight": list(model.values())})

    weights = (
        rows.withColumn("classifier", F.explode(others))
        .groupBy("classifier")
        .applyInPandas(fit_one, "feature binary, weight double")
        .collect()  # features of the bounded sample that pass the test
    )
    trained = sum(bytes(r["feature"]) == BIAS for r in weights)
    model: dict[bytes, float] = {BIAS: 0.0 if trained else float(np.log(prior / (1 - prior)))}
    for r in sorted(weights, key=lambda r: (bytes(r["feature"]), r["weight"])):
        key = bytes(r["feature"])
        model[key] = model.get(key, 0.0) + r["weight"] / trained
    return model


def scored(docs: DataFrame, model: dict[bytes, float], text_col: str = "text") -> DataFrame:
    """Add `score`, the probability that the text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = dict(shared.value)
        bias = weights.pop(BIAS)
        known = weights.keys()
        for texts in batches:
            g = np.array([sum(weights[f] for f in sorted(features(t) & known)) for t in texts])
            yield pd.Series(1 / (1 + np.exp(-np.clip(g + bias, -30, 30))), dtype="float64")

    return docs.withColumn("score", score(F.col(text_col).cast("binary")))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **settings) -> DataFrame:
    """The documents that score below the threshold; `settings` go to `fit`."""
    rows = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    model = fit(docs, labels, **settings)
    return scored(rows, model).where(F.col("score") < threshold).select("row.*")


def op1_toxicity_nnpu(spark, sf_dir):
    """Scores of all documents by classifiers that never saw the held-out ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
