"""Quality classifier by positive-unlabelled learning.

Trusted positives are the training documents labelled good; the unlabelled set
is all web text of the training fold, good and bad mixed. With class prior
``pi`` the risk of a linear score z is estimated without negatives as
``pi * E_p[l(z, +)] + max(0, E_u[l(z, -)] - pi * E_p[l(z, -)])``: what the
unlabelled set loses as negatives, less the share that positives among it
cause. That difference estimates a loss, so it is held non-negative: a step
that would drive it below zero is shortened. With the logistic loss the risk is
convex, and damped Newton steps minimise it.

Every step is one distributed pass that adds up gradient and curvature over all
training documents; nothing is sampled, and only sums of fixed size reach the
driver. The prior is estimated from the positives and the unlabelled text alone:
above any score the unlabelled text holds at least ``pi`` times the share that the
positives have there, and as little as that where no negatives reach. A first fit
gives the scores, the least of the ratios the prior, and a second fit the result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecdex.session import cut_lineage

STEPS, RIDGE, THRESHOLD = 12, 1e-4, 0.7
#: ranges of the score in which the prior is looked for, and the share of the positives above the last of them
PRIOR_BINS, PRIOR_TAIL = 400, 0.1
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SIGNS, _MARKS = "#*$%&<>", ".,;:"


def text_features(text: str) -> list[float]:
    """Shape of a text as bounded numbers; an empty text gives its own point."""
    words = _WORD.findall(text)
    n, size = len(words), len(text)
    if not n:
        return [0.0] * (N_RAW - 1) + [1.0]
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:])) if n > 1 else Counter()
    lines = [x for x in text.split("\n") if x.strip()]
    chars = sum(map(len, words))
    upper = sum(map(str.isupper, words)) / n
    letters = sum(1 for w in words if w[0].isalpha()) / n
    top = counts.most_common(1)[0][1] / n
    raw = [math.log(n + 1) / 10, min(chars / n, 20) / 10, upper, letters,
           sum(text.count(c) for c in _SIGNS) / size, text.count("|") / n, text.count("!") / n,
           sum(text.count(c) for c in _MARKS) / n, sum(text.count(c) for c in "0123456789") / size,
           len(counts) / n, top, max(0, n - 1 - len(pairs)) / n, sum(map(str.__eq__, words, words[1:])) / n,
           1 - len(set(lines)) / len(lines), sum(1 for w in words if len(w) <= 3) / n,
           sum(1 for w in words if w[0].isupper()) / n, sum(map(str.islower, words)) / n, math.log(max(map(len, words)) + 1) / 5,
           1 / math.sqrt(n), 0.0]
    return raw


N_RAW = 20
_SHARES = (2, 4, 5, 6, 10, 11, 12, 13)


def features(text: str | None) -> np.ndarray:
    """Raw features, saturating forms of the share-like ones, and a constant."""
    raw = np.array(text_features(text or ""))
    share = raw[list(_SHARES)]
    return np.concatenate([raw, share / (share + 0.03), share / (share + 0.2), raw[:4] ** 2, [1.0]])


WIDTH = N_RAW + 2 * len(_SHARES) + 5


@dataclass
class Classifier:
    """Weights of the features, and the prior they were fitted with."""

    weights: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -500, 500)))


def featurised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, x`` for every row; null text counts as empty."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("x", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t).astype(np.float32) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float32()))], schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _sums(rows: DataFrame, weights: np.ndarray) -> dict[str, np.ndarray]:
    """Sums over the training rows at ``weights``: for positives count, loss as
    negative, loss as positive and x; for all rows the count, the loss as
    negative, its gradient and its curvature."""
    d = len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(5 + 2 * d + d * d)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(0))
            positive = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            z = np.clip(x @ weights, -500, 500)
            p = 1 / (1 + np.exp(-z))
            minus = np.logaddexp(0, z)
            total[:5] += [positive.sum(), minus[positive].sum(), (minus - z)[positive].sum(), len(x), minus.sum()]
            total[5:5 + d] += x[positive].sum(axis=0)
            total[5 + d:5 + 2 * d] += p @ x
            total[5 + 2 * d:] += ((p * (1 - p))[:, None] * x).T.dot(x).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["k", "v"])

    parts = rows.select("x", "positive").mapInArrow(run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v"))
    found = np.zeros(5 + 2 * d + d * d)
    for r in parts.collect():  # as many rows as sums
        found[r.k] = r.v
    return {"n_p": found[0], "p_minus": found[1], "p_plus": found[2], "n_u": found[3], "u_minus": found[4],
            "x_p": found[5:5 + d], "grad": found[5 + d:5 + 2 * d], "curve": found[5 + 2 * d:].reshape(d, d)}


def fit(rows: DataFrame, prior: float, steps: int = STEPS, ridge: float = RIDGE) -> Classifier:
    """Minimise the non-negative risk over ``rows`` (``x``, ``positive``), all of
    them unlabelled text and some of them trusted positives.

    Without any positive, or any row, the classifier answers the prior."""
    weights = np.zeros(WIDTH)
    weights[-1] = math.log(prior / (1 - prior))
    keep = np.full(WIDTH, ridge)
    keep[-1] = 0
    best, risk, step = weights, math.inf, 1.0
    direction = np.zeros(WIDTH)
    for _ in range(steps):
        s = _sums(rows, weights)
        if not s["n_p"] or not s["n_u"]:
            break
        negative_part = s["u_minus"] / s["n_u"] - prior * s["p_minus"] / s["n_p"]
        now = prior * s["p_plus"] / s["n_p"] + negative_part + keep @ weights ** 2 / 2
        if negative_part < 0 or now > risk + 1e-9:  # shorten the step
            step /= 2
            if step < 1 / 16:
                break
            weights = best + step * direction
            continue
        if risk - now < 1e-7:
            best = weights
            break
        best, risk, step = weights, now, 1.0
        gradient = s["grad"] / s["n_u"] - prior * s["x_p"] / s["n_p"] + keep * weights
        curve = s["curve"] / s["n_u"] + np.diag(keep) + 1e-9 * np.eye(WIDTH)
        direction = -np.linalg.solve(curve, gradient)
        reach = np.abs(direction).max()
        direction *= min(1.0, 20 / reach) if reach else 1.0
        weights = best + direction
    return Classifier(best, prior)


def estimated_prior(rows: DataFrame, model: Classifier, bins: int = PRIOR_BINS) -> float:
    """The class prior from ``rows`` (``x``, ``positive``) and a classifier's scores:
    the least ratio, over thresholds, of the shares of all rows and of the positives
    that lie above, each a standard error to the safe side. Counts per range of the
    score are all that reaches the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, bins), np.int64)
        for batch in batches:
            if batch.num_rows:
                at = np.minimum((model.score(_matrix(batch.column(0))) * bins).astype(int), bins - 1)
                positive = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
                total += [np.bincount(at[positive], minlength=bins), np.bincount(at, minlength=bins)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(2 * bins)), pa.array(total.ravel())], ["k", "n"])

    counts = np.zeros(2 * bins)
    for r in rows.select("x", "positive").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        counts[r["k"]] = r["n"]
    above = counts.reshape(2, bins)[:, ::-1].cumsum(axis=1)
    n_p, n_u = above[:, -1]
    if not n_p or not n_u:
        return 0.5
    p, u = above[0] / n_p, above[1] / n_u
    used = p >= PRIOR_TAIL
    low = np.maximum(p - np.sqrt(p * (1 - p) / n_p), 1e-9)
    ratio = (u + np.sqrt(u * (1 - u) / n_u)) / low
    return float(np.clip(ratio[used].min(), 0.02, 0.98))


def fold(id_col: Column) -> Column:
    """Remainder by 4 of the id's checksum; 2 is held out of training."""
    return F.pmod(F.crc32(F.encode(F.coalesce(id_col.cast("string"), F.lit("")), "UTF-8")), F.lit(4))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """``id_col, held_out, score, predicted`` for every row of ``docs``.

    Labels of held-out ids are never read. Null and empty texts are scored like
    any other; rows that share an id share its label. Labels that are null or
    name no document count for nothing; an id labelled more than once is a
    positive only if all its labels are 1. With no usable label every score is
    one half. An empty table gives an empty result.
    """
    rows = cut_lineage(featurised(docs, id_col, text_col))
    known = (labels.where(F.col(label_col).isNotNull() & (fold(F.col(id_col)) != 2))
             .groupBy(F.col(id_col).alias("doc_id")).agg((F.min(label_col) == 1).alias("positive")))
    training = cut_lineage(rows.where(fold(F.col("doc_id")) != 2).join(known, "doc_id", "left").select(
        "x", F.coalesce("positive", F.lit(False)).alias("positive")))
    first = fit(training, 0.5)
    model = fit(training, estimated_prior(training, first))
    schema = T.StructType([T.StructField(id_col, rows.schema["doc_id"].dataType), T.StructField("held_out", T.BooleanType()),
                           T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_matrix(batch.column(2))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))], schema.names)

    return rows.select("doc_id", (fold(F.col("doc_id")) == 2).alias("held_out"), "x").mapInArrow(run, schema)
