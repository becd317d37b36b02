"""Scores under a log-bilinear language model trained with noise-contrastive estimation.

Counts cover every training text. Each word's count gives the base score, add-one smoothed. The
CLASSES - 3 most frequent words, the end of a text, its beginning and all other words are the model's
classes; how often each class follows each other is counted over the whole training corpus. On these
counts numpy fits r(context) . q(class) + b(class): noise-contrastive estimation tells corpus pairs from
NOISE draws of the class frequencies, the expectation over draws taken exactly. Scores are normalised:
one matrix product gives a batch of contexts against all classes, and a softmax their log-probabilities.
A word outside the classes is its class times its smoothed share of that class.

Words are kept as 64-bit hashes. Counts of the HEAD most frequent go to every task (a bound in rows); the
others leave a document as (hash, times) and join the table of counts.

Null and empty texts have one token, the end. A null doc_id counts as empty text in the fold. Repeated
rows are scored each and, in training, counted each. Long texts are whole. Extra columns are ignored;
an empty table gives no rows, and with no training text every count is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm import hashing
from roadpulse.llm.common import fold, ship
from roadpulse.session import materialize

CLASSES = 1024
OTHER, END, BEGIN = 0, 1, 2
WIDTH = 32
NOISE = 16
STEPS = 120
#: At most so many words' counts are held by every task.
HEAD = 500_000
FOLDS, HELD = 7, 2

_END_HASH = np.uint64(0x5EED0E4D)


def _words(batch: pa.RecordBatch) -> tuple[hashing.Words, int]:
    texts = hashing.as_texts(batch.column("text"))
    return hashing.words(texts), len(texts)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in hashing.pieces(batch):
            found, n = _words(piece)
            value, times = np.unique(found.hash, return_counts=True)
            value, times = np.append(value, _END_HASH), np.append(times, n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(value.view(np.int64)), pa.array(times.astype(np.int64))], names=["hash", "times"]
            )


@dataclass
class Head:
    """The most frequent words: hashes in order, their counts and classes."""

    hash: np.ndarray
    count: np.ndarray
    cls: np.ndarray

    def find(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, class) of each value; count -1 where it is not among the head."""
        if not len(self.hash):
            return np.full(len(value), -1), np.zeros(len(value), np.int64)
        at = np.minimum(np.searchsorted(self.hash, value), len(self.hash) - 1)
        hit = self.hash[at] == value
        return np.where(hit, self.count[at], -1), np.where(hit, self.cls[at], OTHER)


def head_of(vocabulary: DataFrame, most: int) -> Head:
    """The words of the highest counts, whole levels of count at a time, at most ``most`` in all."""
    level = F.floor(F.log2(F.col("times").cast("double")) * 16)
    levels = {r["level"]: r["n"] for r in vocabulary.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()}
    least, n = 10**6, 0
    for at in sorted(levels, reverse=True):
        n += levels[at]
        if n > most:
            break
        least = at
    rows = vocabulary.filter(level >= least).toArrow()
    value = rows.column("hash").to_numpy().view(np.uint64)
    times = rows.column("times").to_numpy()
    order = np.argsort(value)
    value, times = value[order], times[order]
    frequent = np.lexsort((value, -times))
    frequent = frequent[value[frequent] != _END_HASH][: CLASSES - 3]
    cls = np.zeros(len(value), np.int64)
    cls[frequent] = np.arange(3, 3 + len(frequent))
    cls[value == _END_HASH] = END
    return Head(value, times, cls)


def token_classes(found: hashing.Words, n: int, head: Head) -> tuple[np.ndarray, ...]:
    """Of all tokens of n texts, ends last: text, class before, class, count (-1: not in the head)."""
    distinct, back = np.unique(found.hash, return_inverse=True)
    times, cls = (x[back] for x in head.find(distinct))
    before = np.empty(len(cls), np.int64)
    before[:1] = BEGIN
    before[1:] = np.where(found.text[1:] == found.text[:-1], cls[:-1], BEGIN)
    last = np.full(n, BEGIN)
    last[found.text] = cls  # of a text's words the last stays
    end_count = head.find(np.array([_END_HASH]))[0]
    return (
        np.append(found.text, np.arange(n)),
        np.append(before, last),
        np.append(cls, np.full(n, END)),
        np.append(times, np.repeat(end_count, n)),
    )


def _pairs(head: Head):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            for piece in hashing.pieces(batch):
                found, n = _words(piece)
                _, before, cls, _ = token_classes(found, n, head)
                seen += np.bincount(before * CLASSES + cls, minlength=len(seen))
        pair = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(seen[pair])], names=["pair", "times"])

    return run


@dataclass
class Model:
    context: np.ndarray
    target: np.ndarray
    bias: np.ndarray

    def log_probabilities(self, contexts: np.ndarray) -> np.ndarray:
        """Natural log-probability of every class after each of the contexts."""
        scores = self.context[contexts] @ self.target.T + self.bias
        scores -= scores.max(1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(1, keepdims=True))


def train(pairs: np.ndarray, steps: int | None = None) -> Model:
    """Fit on pairs[context, class], counts of the whole corpus, by Adam on the full NCE objective."""
    size, steps = len(pairs), steps or STEPS
    total = max(pairs.sum(), 1)
    noise = (pairs.sum(0) + 0.01) / (pairs.sum() + 0.01 * size)
    noise[BEGIN] = 1e-9  # never a target
    data = (pairs / total).astype(np.float32)
    drawn = (NOISE * np.outer(pairs.sum(1) / total, noise)).astype(np.float32)
    shift = np.log(NOISE * noise).astype(np.float32)
    rng = np.random.default_rng(7)
    values = [
        rng.normal(0, 0.1, (size, WIDTH)).astype(np.float32),
        rng.normal(0, 0.1, (size, WIDTH)).astype(np.float32),
        np.log(noise).astype(np.float32),
    ]
    first = [np.zeros_like(v) for v in values]
    second = [np.zeros_like(v) for v in values]
    for step in range(1, steps + 1):
        context, target, bias = values
        odds = context @ target.T
        odds += bias - shift
        np.clip(odds, -30, 30, out=odds)
        real = 1 / (1 + np.exp(-odds))
        slope = data * (real - 1) + drawn * real
        slopes = [slope @ target, slope.T @ context, slope.sum(0)]
        rate = 0.05 * (1 - 0.9 * step / steps)
        for value, m, v, g in zip(values, first, second, slopes, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return Model(*values)


def _score(head: Head, model: Model, others: float):
    """Per text: counts, sums over tokens whose counts are at hand, and the other words with their times.

    ``others`` is the denominator of a word's share of the class of other words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in hashing.pieces(batch):
                found, n = _words(piece)
                text, before, cls, times = token_classes(found, n, head)
                contexts, at = np.unique(before, return_inverse=True)
                table = model.log_probabilities(contexts) / np.log(10)
                score = table[at, cls].astype(np.float64)
                count = np.maximum(times, 0)
                word = np.log10(count + 1.0)
                score += np.where(cls == OTHER, word - np.log10(others), 0)
                rare, value = hashing.distinct(*_rare(found, times))
                tf = _times(found, times, rare, value)
                total = lambda x: np.bincount(text, weights=x, minlength=n)
                rows = pa.StructArray.from_arrays(
                    [pa.array(value.view(np.int64)), pa.array(tf)], names=["hash", "tf"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("row"),
                        piece.column("doc_id"),
                        piece.column("held_out"),
                        pa.array(total(np.ones(len(text))).astype(np.int64)),
                        pa.array(total(times > 0).astype(np.int64)),
                        pa.array(total(word)),
                        pa.array(total(score)),
                        hashing.lists(rare, rows, n),
                    ],
                    names=["row", "doc_id", "held_out", "n_tokens", "known", "words", "model", "rare"],
                )

    return run


def _rare(found: hashing.Words, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    missing = times[: len(found.hash)] < 0
    return found.text[missing], found.hash[missing]


def _times(found: hashing.Words, times: np.ndarray, text: np.ndarray, value: np.ndarray) -> np.ndarray:
    """How often each distinct (text, value), given in order, occurs."""
    owner, h = _rare(found, times)
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    change = np.ones(len(h), bool)
    change[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
    return np.diff(np.append(np.flatnonzero(change), len(h))).astype(np.int64)


_ROWS = (
    "row long, doc_id long, held_out boolean, n_tokens long, known long, words double, model double,"
    " rare array<struct<hash:bigint,tf:bigint>>"
)


def lm_scores(documents: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row."""
    spark = documents.sparkSession
    ship(spark)
    texts = documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        (fold(F.col("doc_id"), FOLDS) == HELD).alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    training = texts.filter(~F.col("held_out")).select("text")
    vocabulary = materialize(
        training.mapInArrow(_count, "hash long, times long").groupBy("hash").agg(F.sum("times").alias("times")),
        "lm-vocabulary",
    )
    sums = vocabulary.agg(F.coalesce(F.sum("times"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    head = head_of(vocabulary, HEAD)
    counted = (
        training.mapInArrow(_pairs(head), "pair long, times long")
        .groupBy("pair")
        .agg(F.sum("times").alias("times"))
        .toArrow()
    )
    pairs = np.zeros(CLASSES * CLASSES)
    pairs[counted.column("pair").to_numpy()] = counted.column("times").to_numpy()
    model = train(pairs.reshape(CLASSES, CLASSES))
    # The class of other words: its tokens, its distinct words, and one for any unseen word.
    inside = head.cls != OTHER
    others = float(sums["n"] - head.count[inside].sum() + sums["v"] - inside.sum() + 1)
    rows = materialize(texts.mapInArrow(_score(head, model, others), _ROWS), "lm-rows")
    rare = (
        rows.select("row", F.explode("rare").alias("x"))
        .select("row", "x.hash", "x.tf")
        .join(vocabulary, "hash")
        .groupBy("row")
        .agg(F.sum("tf").alias("found"), F.sum(F.col("tf") * F.log10(F.col("times") + 1)).alias("more"))
    )
    more = F.coalesce("more", F.lit(0.0))
    each = F.log10(F.lit(float(sums["n"] + sums["v"] + 1)))
    return rows.join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(sums["n"]).cast("long").alias("train_tokens"),
        (F.col("words") + more - F.col("n_tokens") * each).alias("base_score"),
        (F.col("model") + more).alias("score"),
    )
