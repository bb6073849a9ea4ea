"""Toxicity by non-negative positive-unlabelled learning.

A linear model over hashed features (words and word beginnings of four to six bytes, present or not) is fitted by numpy
from confirmed toxic examples and unlabelled text. With class prior p the risk is p*R+(positive) plus
max(0, R-(unlabelled) - p*R-(positive)): unlabelled text stands for both classes, the prior takes the toxic part out
again, and the bound at zero stops the fit from calling hidden positives negative for sure. A quarter of the toxic
examples stays out of the fit: afterwards the bias is shifted so that the decision threshold parts them best from
examples confirmed as clean, weighted by the prior. Without such examples, or with fewer than
20 toxic ones, at most a share of the unlabelled text as large as the prior lies above the threshold: texts that tie there,
as those without any telling word do, stay below it.

The fit uses bounded samples, chosen by a hash of the id: about ``max_positive`` toxic documents, as many
clean ones and about ``max_unlabelled`` of all; the prior comes from all labels. Features of the samples are computed in tasks and reach the
driver as packed feature numbers, at most ``max_features`` of 4 bytes for each sampled document. Scoring is one pass over whole texts without
a shuffle; the weights (2^bits floats) are broadcast.

Edge cases: null and empty texts have no feature and score by the bias alone. Without a toxic example everything scores
0. A document with several labels counts as toxic if one of them says so. Null ids are never sampled by label. Of rows
with one id a single text is learnt from, the first in order; all are scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Words, chunks, letters, unit_hash

THRESHOLD = 0.7
BITS = 18
BEGINNINGS = (4, 5, 6)


def _features(texts: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct (text, feature) pairs."""
    w = Words(texts)
    size = w.end - w.start
    doc, value = [w.doc], [w.hashes(w.start, w.end) >> np.uint64(64 - bits)]
    for k in BEGINNINGS:
        at = np.flatnonzero(size > k)
        h = w.hashes(w.start[at], w.start[at] + k) * np.uint64(0x9E3779B97F4A7C15 + 2 * k)
        doc.append(w.doc[at])
        value.append(h >> np.uint64(64 - bits))
    pairs = np.unique((np.concatenate(doc).astype(np.int64) << bits) | np.concatenate(value).astype(np.int64))
    return pairs >> bits, pairs & ((1 << bits) - 1)


def _some(features: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` of them, those that come first in an order that has nothing to do with the text."""
    if len(features) <= most:
        return features
    order = (features.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return np.sort(features[np.argsort(order)[:most]])


@dataclass
class Toxicity:
    weights: np.ndarray
    bias: float
    bits: int

    def logits(self, texts: list[bytes]) -> np.ndarray:
        doc, feature = _features(texts, self.bits)
        return np.bincount(doc, weights=self.weights[feature], minlength=len(texts)) + self.bias


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def best_cut(positive: np.ndarray, negative: np.ndarray, prior: float) -> float:
    """The cut between two scores with the least weighted error; of equally good ones the highest."""
    at = np.unique(np.concatenate((positive, negative)))
    cuts = np.concatenate(([at[0] - 1], (at[1:] + at[:-1]) / 2, [at[-1] + 1]))
    missed = np.searchsorted(np.sort(positive), cuts, "left") / len(positive)
    false = 1 - np.searchsorted(np.sort(negative), cuts, "left") / len(negative)
    error = prior * missed + (1 - prior) * false
    return float(cuts[np.flatnonzero(error <= error.min() + 1e-12)[-1]])


def cut_above(scores: np.ndarray, prior: float) -> float:
    """A cut that leaves at most the share ``prior`` of the scores above it, never equal to a score."""
    at = np.unique(scores)
    below = np.searchsorted(at, np.sort(scores)[max(int(np.ceil((1 - prior) * len(scores))) - 1, 0)])
    return float(at[below] + 1 if below + 1 == len(at) else (at[below] + at[below + 1]) / 2)


def fit_pu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, clean: list[np.ndarray] = (),
           bits: int = BITS, rounds: int = 60, rate: float = 0.08, decay: float = 2e-5, threshold: float = THRESHOLD,
           support: int = 3, lift: float = 2.0) -> Toxicity:
    """Full-batch Adam on the non-negative risk with the logistic loss.

    Features count that stand in ``support`` positive texts at least and are ``lift`` times as common there as in
    unlabelled text; others only let a text be learnt by heart.
    """
    held = positive[::4] if len(clean) and len(positive) >= 20 else []
    positive = [x for k, x in enumerate(positive) if k % 4] if held else positive
    n_pos, n_unl = len(positive), len(unlabelled)
    if not n_pos or not n_unl:
        return Toxicity(np.zeros(1 << bits), -40.0, bits)
    in_pos = np.bincount(np.concatenate(positive), minlength=1 << bits)
    in_unl = np.bincount(np.concatenate(unlabelled), minlength=1 << bits)
    used = (in_pos >= max(support, n_pos / 400)) & (in_pos * n_unl >= lift * in_unl * n_pos)
    rows = [r[used[r]] for r in positive + unlabelled]
    feature = np.concatenate(rows)
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    w, bias = np.zeros(1 << bits), float(np.log(prior / (1 - prior)))
    m, v = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    for t in range(1, rounds + 1):
        z = np.bincount(doc, weights=w[feature], minlength=len(rows)) + bias
        p = _sigmoid(z)
        loss_neg = np.logaddexp(0, z)
        negative = loss_neg[n_pos:].mean() - prior * loss_neg[:n_pos].mean()
        grad = np.zeros(len(rows))
        if negative >= 0:
            grad[:n_pos] = prior * (p[:n_pos] - 1) / n_pos - prior * p[:n_pos] / n_pos
            grad[n_pos:] = p[n_pos:] / n_unl
        else:  # step back where the estimate fell below zero
            grad[:n_pos] = prior * p[:n_pos] / n_pos
            grad[n_pos:] = -p[n_pos:] / n_unl
        g = np.append(np.bincount(feature, weights=grad[doc], minlength=1 << bits) + decay * w, grad.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w -= step[:-1]
        bias -= step[-1]
    if held:
        logit = lambda texts: np.asarray([w[x].sum() + bias for x in texts])
        cut = best_cut(logit(held), logit(clean), prior)
    else:
        z = np.bincount(doc, weights=w[feature], minlength=len(rows)) + bias
        cut = cut_above(z[n_pos:], prior)
    return Toxicity(w, float(bias - cut + np.log(threshold / (1 - threshold))), bits)


def train(documents: DataFrame, labels: DataFrame, learn: Column | None = None, max_positive: int = 2000,
          max_unlabelled: int = 6000, bits: int = BITS, max_features: int = 8192) -> Toxicity:
    """Fit on documents for which ``learn`` (an expression over ``doc_id``) holds."""
    learn = F.lit(True) if learn is None else learn
    marks = labels.select("doc_id", "toxic").filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & learn)
    marks = marks.groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    n_marks, n_toxic = marks.agg(F.count("*"), F.sum("toxic")).first()
    if not n_toxic:
        return fit_pu([], [], 0.5, bits=bits)
    prior = min(max(n_toxic / n_marks, 1e-4), 0.5)
    # the hash thresholds bound the list by about 2 * max_positive ids, whatever the number of labels
    part = F.when(F.col("toxic") == 1, max_positive / n_toxic).otherwise(max_positive / max(n_marks - n_toxic, 1))
    known = marks.filter(unit_hash(F.col("doc_id")) < part)
    base = documents.select("doc_id", "text").filter(learn)
    n_base = base.select("doc_id").count()
    drawn = unit_hash(F.lit("u"), F.col("doc_id")) < max_unlabelled / max(n_base, 1)
    sample = base.join(F.broadcast(known), "doc_id", "left").filter(F.col("toxic").isNotNull() | drawn)
    # one text per id: an id that repeats without end is still one example
    sample = sample.groupBy("doc_id").agg(
        F.max(F.coalesce("toxic", F.lit(-1))).alias("mark"), F.max(drawn).alias("drawn"), F.min("text").alias("text")
    ).select("mark", "drawn", "text")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [_some(_features([letters(t)], bits)[1], max_features).astype("<i4").tobytes() for t in batch["text"]]
            yield pd.DataFrame({"mark": batch["mark"], "drawn": batch["drawn"], "features": rows})

    rows = sample.mapInPandas(pack, "mark int, drawn boolean, features binary").collect()
    rows = sorted((bytes(r["features"]), r["mark"], bool(r["drawn"])) for r in rows)
    unpack = lambda keep: [np.frombuffer(f, "<i4") for f, m, u in rows if keep(m, u)]
    positive, clean = unpack(lambda m, u: m == 1), unpack(lambda m, u: m == 0)
    return fit_pu(positive, unpack(lambda m, u: u), prior, clean, bits)


def score(model: Toxicity, documents: DataFrame) -> Column:
    """Probability of being toxic for the text column of ``documents``."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast((model.weights.astype(np.float32), model.bias, model.bits))

    @F.pandas_udf("double")
    def toxicity(texts: pd.Series) -> pd.Series:
        known = Toxicity(*shared.value)
        found = [_sigmoid(known.logits(part)) for part in chunks(texts, letters)]
        return pd.Series(np.concatenate(found) if found else np.empty(0))

    return toxicity(F.col("text"))


def keep_clean(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, learn: Column | None = None):
    """The documents that score below the threshold, with their columns as they came."""
    model = train(documents, labels, learn)
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row")
    return documents.select(row, score(model, documents).alias("_s")).filter(F.col("_s") < threshold).select("_row.*")
