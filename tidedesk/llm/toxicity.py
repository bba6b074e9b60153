"""Toxicity by a factorization machine over hashed terms.

Beside a linear weight every hashed term has a short vector; the product of two terms' vectors is the weight of
the pair. So a pair such as an insult and a mention of a group can count for more than its two words. The model
is fitted on a bounded sample of labelled rows and broadcast; its size does not depend on the data.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType, FloatType, LongType, StructType

BUCKETS = 1 << 17
FACTORS = 8
#: Labelled rows that the model is fitted on at most, chosen by a hash of their id.
TRAINING_ROWS = 16_000
#: Terms in fewer of these rows have no weight.
LEAST_ROWS = 5
#: Every so many-th of these rows is kept from the fit and sets the scale and the offset of the scores.
CALIBRATION = 5
EPOCHS = 15
BATCH_ROWS = 64
LEARNING_RATE = 0.5
#: Penalties on squared weights and vectors, and the spread of the first vectors.
WEIGHT_PENALTY = 1e-5
VECTOR_PENALTY = 3e-4
SPREAD = 0.01
TERM = re.compile(rb"[^\x00-/:-@\[-`{-\x7f]+")


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Probabilities of label 1 for rows of (buckets, values); a row without terms gets the bias alone."""
        margins = np.empty(len(rows))
        for n, (at, x) in enumerate(rows):
            v = self.vectors[at] * x[:, None]
            s = v.sum(axis=0)
            margins[n] = self.bias + self.weights[at] @ x + 0.5 * (s @ s - (v * v).sum())
        return 1.0 / (1.0 + np.exp(-np.clip(margins, -30, 30)))


def terms(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of the terms of a whole UTF-8 text: log counts, scaled to length 1."""
    counts = Counter(TERM.findall((text or b"").lower()))
    at = np.fromiter((zlib.crc32(t) % BUCKETS for t in counts), np.int64, len(counts))
    x = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
    norm = np.sqrt(x @ x)
    return at, (x / norm if norm else x).astype(np.float32)


def _margins(scores: np.ndarray) -> np.ndarray:
    return np.log(scores / (1 - scores))


def _scaled(model: Machine, margins: np.ndarray, labels: np.ndarray) -> Machine:
    """``model`` with its margins stretched and shifted to fit ``labels``, by Newton steps on logistic loss."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(a * margins + b, -30, 30)))
        w = p * (1 - p) + 1e-6
        slope = np.array([((p - labels) * margins).sum() + 1e-3 * (a - 1), (p - labels).sum()])
        curve = np.array([[(w * margins**2).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum()]])
        a, b = np.array([a, b]) - np.linalg.solve(curve, slope)
    if not (np.isfinite(a) and np.isfinite(b) and a > 0):
        return model
    # Scaling a margin scales its three parts; a pair's weight is a product, so its vectors take the root.
    return Machine(a * model.bias + b, (a * model.weights).astype(np.float32), (np.sqrt(a) * model.vectors).astype(np.float32))


def train_calibrated(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Machine:
    """``fit`` on the more frequent terms of most rows, scaled on the others."""
    often = np.zeros(BUCKETS, np.int64)
    for at, _ in rows:
        often[np.unique(at)] += 1
    kept = [(at[often[at] >= LEAST_ROWS], x[often[at] >= LEAST_ROWS]) for at, x in rows]
    apart = np.arange(len(rows)) % CALIBRATION == CALIBRATION - 1
    model = fit([r for r, c in zip(kept, apart) if not c], labels[~apart])
    if not 0 < labels[apart].sum() < apart.sum():
        return model
    return _scaled(model, _margins(model.scores([r for r, c in zip(kept, apart) if c])), labels[apart])


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Machine:
    """A machine fitted by AdaGrad on logistic loss. Without rows of both labels it gives the share of label 1."""
    draw = np.random.default_rng(17)
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)) if len(labels) else 0.5
    model = Machine(
        float(np.log(share / (1 - share))),
        np.zeros(BUCKETS, np.float32),
        draw.normal(0, SPREAD, (BUCKETS, FACTORS)).astype(np.float32),
    )
    if not 0 < labels.sum() < len(labels):
        model.vectors[:] = 0
        return model
    seen = np.zeros(BUCKETS, bool)
    for at, _ in rows:
        seen[at] = True
    model.vectors[~seen] = 0  # terms that no row has had stay without effect
    w2, v2 = np.full(BUCKETS, 1e-6, np.float32), np.full((BUCKETS, FACTORS), 1e-6, np.float32)
    bias2 = 1e-6
    for _ in range(EPOCHS):
        order = draw.permutation(len(rows))
        for start in range(0, len(order), BATCH_ROWS):
            batch = order[start : start + BATCH_ROWS]
            sizes = np.array([len(rows[i][0]) for i in batch])
            batch, sizes = batch[sizes > 0], sizes[sizes > 0]
            if not len(batch):
                continue
            at = np.concatenate([rows[i][0] for i in batch])
            x = np.concatenate([rows[i][1] for i in batch])
            begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            owner = np.repeat(np.arange(len(batch)), sizes)
            v = model.vectors[at] * x[:, None]
            s = np.add.reduceat(v, begins)
            margin = (
                model.bias
                + np.add.reduceat(model.weights[at] * x, begins)
                + 0.5 * ((s * s).sum(axis=1) - np.add.reduceat((v * v).sum(axis=1), begins))
            )
            error = (1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30))) - labels[batch]).astype(np.float32) / len(batch)
            bias2 += float(error.sum()) ** 2
            model.bias -= LEARNING_RATE * float(error.sum()) / np.sqrt(bias2)
            step = (error[owner] * x)[:, None]
            sort = np.argsort(at, kind="stable")
            first = np.concatenate(([0], np.nonzero(np.diff(at[sort]))[0] + 1))
            which = at[sort][first]
            gw = np.add.reduceat(step[sort, 0], first) + WEIGHT_PENALTY * model.weights[which]
            gv = np.add.reduceat((step * (s[owner] - v))[sort], first) + VECTOR_PENALTY * model.vectors[which]
            w2[which] += gw * gw
            v2[which] += gv * gv
            model.weights[which] -= LEARNING_RATE * gw / np.sqrt(w2[which])
            model.vectors[which] -= LEARNING_RATE * gv / np.sqrt(v2[which])
    return model


@pandas_udf(StructType().add("buckets", ArrayType(LongType())).add("values", ArrayType(FloatType())))
def _terms(texts: pd.Series) -> pd.DataFrame:
    found = [terms(t) for t in texts]
    return pd.DataFrame({"buckets": [a for a, _ in found], "values": [x for _, x in found]})


def held_out(doc_id: Column) -> Column:
    """Whether a row's label may not be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame) -> Machine:
    """A machine from at most ``TRAINING_ROWS`` labelled rows that are not held out."""
    chosen = (
        labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1))
        .select("doc_id", "toxic")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic")
        .limit(TRAINING_ROWS)
    )
    # Broadcast: TRAINING_ROWS rows of two numbers. A repeated id counts once, with its least text.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = sample.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    found = sample.select("doc_id", "toxic", _terms(F.col("text").cast("binary")).alias("t")).select("doc_id", "toxic", "t.*")
    found = found.toArrow().sort_by([("doc_id", "ascending"), ("toxic", "ascending")])  # whatever order tasks end in
    each = zip(found["buckets"].to_pylist(), found["values"].to_pylist())
    rows = [(np.array(a, np.int64), np.array(x, np.float32)) for a, x in each]
    return train_calibrated(rows, found["toxic"].to_numpy().astype(np.float32))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` of every row of ``docs``.

    The score depends on the text alone. NULL and empty texts get that of the bias. A NULL ``doc_id`` is held
    out. Labels that are NULL or not 0 or 1 are passed over; repeated rows are rows of their own. With no
    label of either kind the score is the share of label 1, or 0.5. Other columns are ignored; empty
    ``docs`` give an empty result.
    """
    machine = train(docs, labels)
    # Arrays, not the class: a broadcast value is pickled by reference, and workers have no copy of this package.
    parts = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.weights, machine.vectors))

    @pandas_udf(DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(Machine(*parts.value).scores([terms(t) for t in texts]))

    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text").cast("binary")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


# Workers get these functions by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
