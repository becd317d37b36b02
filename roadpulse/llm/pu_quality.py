"""Quality classifier: positive-unlabelled learning with the non-negative risk.

Trusted positives are documents labelled good; everything without a label is unlabelled web text. Both
are sampled by the hash of the id, up to documented bounds, and their features come to the driver. The class
prior is estimated first: a model tells positives from unlabelled ones, and on rows it did not see the
smallest ratio of unlabelled to positive share above a score bounds the prior. A small network then
minimises prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)); where the second part is negative, steps go
against it. Labels of bad documents are never read.

Null and empty texts are scored from empty features. A null doc_id counts as empty text in the fold and is
never learned from. Repeated rows are scored each; a labelled id in several rows is learned from as often.
Long texts are whole. Extra columns are ignored; an empty table gives no rows; without positives or
unlabelled texts every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.llm import hashing
from roadpulse.llm.common import first_by_hash, fold, labelled, ship
from roadpulse.llm.features import WIDTH, features

FOLDS, HELD = 5, 0
#: Bounds of the training sample, in documents.
POSITIVES, UNLABELLED = 10_000, 20_000
HIDDEN = 24
EPOCHS, LEAST_STEPS = 60, 1_500
LIMIT = 0.3
#: Standard errors added to the ratios that bound the prior: the smallest of many is low by chance.
MARGIN = 0.25


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    bias: np.ndarray

    def values(self) -> list[np.ndarray]:
        return [self.first, self.first_bias, self.second, self.bias]

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(self.scaled(x) @ self.first + self.first_bias) @ self.second + self.bias

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _network(x: np.ndarray, seed: int) -> Network:
    rng = np.random.default_rng(seed)
    return Network(
        x.mean(0),
        x.std(0) + 1e-3,
        rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, HIDDEN**-0.5, HIDDEN),
        np.zeros(1),
    )


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, seed: int = 3) -> Network:
    """With a prior: the non-negative risk. Without: positives against unlabelled ones, as they are."""
    net = _network(np.concatenate([positive, unlabelled]).astype(np.float64), seed)
    p, u = net.scaled(positive), net.scaled(unlabelled)
    rng = np.random.default_rng(seed)
    values = net.values()
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    step = 0
    batches = max(1, len(u) // 512)
    for _ in range(max(EPOCHS, LEAST_STEPS // batches)):
        parts = zip(
            np.array_split(rng.permutation(len(p)), batches), np.array_split(rng.permutation(len(u)), batches), strict=True
        )
        for at_p, at_u in parts:
            if not len(at_p) or not len(at_u):
                continue
            x = np.concatenate([p[at_p], u[at_u]])
            hidden = np.tanh(x @ net.first + net.first_bias)
            margin = hidden @ net.second + net.bias
            yes, n_p, n_u = _sigmoid(margin), len(at_p), len(at_u)
            slope = np.empty(len(x))
            if prior is None:
                slope[:n_p], slope[n_p:] = (yes[:n_p] - 1) / n_p, yes[n_p:] / n_u
            else:
                # Sigmoid loss: bounded, so positives known by heart do not drive the second part below zero.
                steep = yes * (1 - yes)
                if yes[n_p:].mean() - prior * yes[:n_p].mean() >= 0:
                    slope[:n_p], slope[n_p:] = -2 * prior * steep[:n_p] / n_p, steep[n_p:] / n_u
                else:
                    slope[:n_p], slope[n_p:] = prior * steep[:n_p] / n_p, -steep[n_p:] / n_u
            back = np.outer(slope, net.second) * (1 - hidden**2)
            slopes = [x.T @ back, back.sum(0), hidden.T @ slope, slope.sum(keepdims=True)]
            step += 1
            for value, m, v, g in zip(values, first, second, slopes, strict=True):
                g = g + 1e-4 * value
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                value -= 0.005 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled: the smallest of U(score >= t) / P(score >= t).

    No part of the scale can hold fewer of the unlabelled than the positives among them. Each half of
    the rows is scored by a model of the other half; the ratios of both are averaged.
    """
    shares, ratios = np.linspace(0.5, 1, 26), []
    for k in range(2):
        p, u = positive[k::2], unlabelled[k::2]
        if not len(p) or not len(u):
            continue
        net = fit(positive[1 - k :: 2], unlabelled[1 - k :: 2], None)
        p, u = net.margin(p), net.margin(u)
        cuts = np.quantile(p, 1 - shares)
        in_p, in_u = (np.array([(x >= t).mean() for t in cuts]) for x in (p, u))
        error = np.sqrt(in_p * (1 - in_p) / len(p) + in_u * (1 - in_u) / len(u)) / in_p
        ratios.append(in_u / in_p + MARGIN * error)
    return float(np.clip(np.mean(ratios, 0).min(), 0.05, 0.98)) if ratios else 0.5


@hashing.giving_back
def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in hashing.pieces(batch):
            x = features(hashing.as_texts(piece.column("text")))
            rows = pa.array([r.tobytes() for r in x], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("positive"), piece.column("print"), rows],
                names=["doc_id", "positive", "print", "x"],
            )


def _apply(net: Network | None):
    @hashing.giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("own")
            text = own.field("text") if len(batch.columns) == 1 else batch.column("text")
            for piece in hashing.pieces(pa.RecordBatch.from_arrays([own, text], names=["own", "text"])):
                x = features(hashing.as_texts(piece.column("text"))).astype(np.float64)
                score = _sigmoid(net.margin(x)) if net is not None else np.full(len(x), 0.5)
                yield pa.RecordBatch.from_arrays([piece.column("own"), pa.array(score)], names=["own", "score"])

    return run


def train(documents: DataFrame, labels: DataFrame) -> Network | None:
    ship(documents.sparkSession)
    marked = labelled(labels, "quality")
    learn = fold(F.col("doc_id"), FOLDS) != HELD
    good = first_by_hash(marked.filter(learn & (F.col("mark") == 1)).select("doc_id"), POSITIVES)
    ids = documents.filter(F.col("doc_id").isNotNull() & learn).select("doc_id").distinct()
    rest = first_by_hash(ids.join(marked, "doc_id", "left_anti"), UNLABELLED)
    sample = good.withColumn("positive", F.lit(True)).union(rest.withColumn("positive", F.lit(False)))
    # An id may stand on many rows; one of its texts speaks for it, so that rows are as bounded as ids.
    rows = (
        documents.select("doc_id", "text")
        .join(F.broadcast(sample), "doc_id")
        .select(F.col("doc_id").cast("string").alias("doc_id"), "positive", "text", F.xxhash64("text").alias("print"))
        .mapInArrow(_features, "doc_id string, positive boolean, print long, x binary")
        .groupBy("doc_id", "positive")
        .agg(F.min(F.struct("print", "x")).alias("least"))
        .select("positive", "least.x")
        .toArrow()
    )
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), np.float32).reshape(-1, WIDTH).astype(np.float64)
    positive = rows.column("positive").to_numpy().astype(bool)
    order = np.lexsort(x.T)  # rows come in any order; learning must not depend on it
    x, positive = x[order], positive[order]
    if not positive.any() or positive.all():
        return None
    p, u = x[positive], x[~positive]
    return fit(p, u, estimate_prior(p, u))


def classify(documents: DataFrame, labels: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(own, score): each row's own columns, or those named, as a struct, and a score between 0 and 1. A text travels
    once, and back only if it is one of the columns."""
    net = train(documents, labels)
    columns = documents.columns if columns is None else columns
    own = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("own")
    inner = documents.select(own, *([] if "text" in columns else ["text"]))
    schema = T.StructType([inner.schema["own"], T.StructField("score", T.DoubleType())])
    return inner.mapInArrow(_apply(net), schema)


def accepted(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that the classifier does not reject, as they are."""
    return classify(documents, labels).filter(F.col("score") >= LIMIT).select("own.*")


def pu_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row."""
    scored = classify(documents, labels, ["doc_id"])
    return scored.select(
        "own.doc_id",
        (fold(F.col("own.doc_id"), FOLDS) == HELD).alias("held_out"),
        "score",
        (F.col("score") >= LIMIT).cast("int").alias("predicted"),
    )
