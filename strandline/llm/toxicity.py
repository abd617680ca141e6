"""Toxicity by multiple-instance learning.

A text is a bag of sentences. A sentence's logit is a bias plus the weights of its words;
a word's weight is the sum of the weights of hashed features: the word and its shorter prefixes of
three to eight letters, and so carries over to other endings. Noisy-or joins the sentences: a
text is toxic unless every sentence is clean. Weights come from document labels alone, by
gradient descent on the noisy-or likelihood, and then point at the offending sentences.
Weights are 0 or more, and an L1 penalty keeps most at 0: plain words neither excuse a
sentence nor add up to an offence, however long it is.

The fit uses about ``fit_docs`` labelled ids at most of each class, chosen by a hash, and one text
of each, so that repeated ids don't add to it.

Cases: null and empty texts have one empty sentence, and the score of the bias; without
labels of both classes every score is 0; rows with a null label don't take part in a fit;
several labels of one id count as their maximum, and of several texts of one id the fit
takes the least; repeated rows are each scored; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import Codes, blocks, fold, short_batches, strings, texts, trim

PARTS = re.compile(r"[^\W\d_]+|[.!?\n]")
STOPS = ".!?\n"
BUCKETS = 1 << 18
PREFIXES = (3, 4, 5, 6, 7, 8)
BIAS = -9.0
EPOCHS, RATE, PENALTY = 60, 0.3, 1.0
CLEAN_WEIGHT = 1.0  #: how much more a clean text counts than a toxic one


def features(words: list[str]) -> np.ndarray:
    """Buckets of each word: itself and its prefixes; BUCKETS where there is none. Stops have none."""
    out = np.full((len(words), 1 + len(PREFIXES)), BUCKETS, np.int64)
    crc = zlib.crc32
    for i, w in enumerate(words):
        if w in STOPS:
            continue
        out[i, 0] = crc(w.encode()) % BUCKETS
        for k, n in enumerate(PREFIXES, 1):
            if len(w) > n:
                out[i, k] = crc(w[:n].encode(), n) % BUCKETS
    return out


@dataclass
class Model:
    weights: np.ndarray  #: one more than BUCKETS, the last 0
    bias: float
    fitted: bool = True

    def word_weights(self, words: list[str]) -> np.ndarray:
        return self.weights[features(words)].sum(axis=1)


def sentences(which: list[np.ndarray], stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words of all texts, the sentence of each, and the text of each sentence. ``stop`` says which codes end a sentence."""
    sizes = np.array([len(w) for w in which], np.int64)
    flat = np.concatenate([*which, np.empty(0, np.int64)])
    starts = np.zeros(len(flat), np.int64)
    if len(flat):
        ended = stop[flat]
        starts[1:] = ended[:-1] & ~ended[1:]
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])[sizes > 0]
    starts[begins] = 0
    local = np.cumsum(starts)
    doc_of_word = np.repeat(np.arange(len(which)), sizes)
    number = local + doc_of_word  # each text begins a sentence of its own, empty texts too
    n = int(number[-1]) + 1 if len(number) else 0
    trailing = len(which) - 1 - int(doc_of_word[-1]) if len(number) else len(which)
    doc_of_sentence = np.full(n + trailing, -1, np.int64)
    doc_of_sentence[number] = doc_of_word
    missing = np.flatnonzero(sizes == 0)
    doc_of_sentence[doc_of_sentence < 0] = missing
    return flat, number, doc_of_sentence


def coded(values: list[str]) -> tuple[list[np.ndarray], list[str], np.ndarray]:
    codes = Codes()
    which = [np.fromiter(map(codes.__getitem__, PARTS.findall(v.lower())), np.int64) for v in values]
    words = list(codes)
    return which, words, np.array([w in STOPS for w in words], bool)


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def noisy_or(model: Model, values: list[str]) -> list[float]:
    """The probability of each text."""
    if not model.fitted or not values:
        return [0.0] * len(values)
    which, words, stop = coded(values)
    flat, number, doc = sentences(which, stop)
    weights = model.word_weights(words) if words else np.zeros(0)
    logits = model.bias + np.bincount(number, weights=weights[flat], minlength=len(doc))
    return (-np.expm1(-np.bincount(doc, weights=softplus(logits), minlength=len(values)))).clip(0, 1).tolist()


def train(values: list[str], labels: list[int]) -> Model:
    """Full-batch Adagrad on the noisy-or likelihood, from weights of presence log-odds."""
    y = np.array(labels, bool)
    if not y.any() or y.all():
        return Model(np.zeros(BUCKETS + 1), BIAS, False)
    which, words, stop = coded(values)
    buckets = features(words)
    flat, number, doc = sentences(which, stop)
    present = np.unique(np.repeat(np.arange(len(values)), [len(w) for w in which]) * len(words) + flat)
    docs, seen = present // len(words), present % len(words)
    hits = [np.zeros(BUCKETS + 1, np.int64), np.zeros(BUCKETS + 1, np.int64)]
    for k in range(buckets.shape[1]):  # in how many texts of each class a feature is
        pairs = np.unique(docs * (BUCKETS + 1) + buckets[seen, k])
        for c in (0, 1):
            hits[c] += np.bincount((pairs % (BUCKETS + 1))[y[pairs // (BUCKETS + 1)] == c], minlength=BUCKETS + 1)
    del present, docs, seen, pairs
    odds = np.log((hits[1] + 0.5) / (y.sum() + 1)) - np.log((hits[0] + 0.5) / ((~y).sum() + 1))
    odds[hits[0] + hits[1] == 0] = 0
    w = np.where(hits[1] > 1, np.clip(odds - 2, 0, 6), 0) / 2
    w[BUCKETS] = 0
    bias, squares, bias_square = BIAS, np.full(BUCKETS + 1, 1e-3), 1e-3
    importance = np.where(y, 1.0, CLEAN_WEIGHT) / len(y)
    for epoch in range(2 * EPOCHS):
        if epoch == EPOCHS:  # the features are chosen; from here on their weights grow freely
            chosen = w > 0
            squares, bias_square = np.full(BUCKETS + 1, 1e-3), 1e-3
        penalty = PENALTY if epoch < EPOCHS else 0.0
        z = bias + np.bincount(number, weights=w[buckets].sum(axis=1)[flat], minlength=len(doc))
        a = np.bincount(doc, weights=softplus(z), minlength=len(y))
        pull = np.where(y, -1 / np.expm1(a.clip(1e-9, 500)), 1.0) * importance
        by_sentence = pull[doc] / (1 + np.exp(-z.clip(-500, 500)))
        by_word = np.bincount(flat, weights=by_sentence[number], minlength=len(words))
        grad = np.bincount(buckets.ravel(), weights=np.repeat(by_word, buckets.shape[1]), minlength=BUCKETS + 1)
        grad = (grad + penalty / len(y)) * 100
        squares += grad**2
        w = np.maximum(0, w - RATE * grad / np.sqrt(squares))
        w[BUCKETS] = 0
        if epoch >= EPOCHS:
            w[~chosen] = 0
        g = float(by_sentence.sum()) * 100
        bias_square += g**2
        bias -= RATE * g / np.sqrt(bias_square)
    return Model(w, float(bias))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id", label_col: str = "toxic", fit_docs: int = 1_500) -> Model:
    """Trains on the driver, on about ``fit_docs`` texts of each class at most, none of them held out."""
    seen = labels.select(F.col(label_id_col).alias("label_id"), F.col(label_col).cast("int").alias("y")).where(F.col("y").isin(0, 1) & (fold("label_id") != 0))
    known = seen.groupBy("label_id").agg(F.max("y").alias("y"))
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    share = F.lit(0.0)
    for y, n in counts.items():
        share = F.when(F.col("y") == y, min(1.0, fit_docs / n)).otherwise(share)
    sample = known.where(F.pmod(F.xxhash64("label_id"), F.lit(1 << 30)) < share * (1 << 30))
    # The sample's size is bounded by fit_docs, so it may be broadcast.
    met = texts(docs, id_col, text_col).join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"))
    rows = met.groupBy("doc_id", "y").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")).toPandas()
    rows = rows.sort_values("doc_id")  # the same order whatever the partitions
    model = train(rows["text"].tolist(), rows["y"].tolist())
    del rows
    trim()
    return model


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of each text."""

    def run(batches):
        for block in blocks(batches):
            yield pa.RecordBatch.from_arrays([block.column("doc_id").cast(pa.int64()), pa.array(noisy_or(model, strings(block)), pa.float64())], ["doc_id", "score"])

    return texts(df, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def offending(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """doc_id, sentence number, its text and probability, of each sentence at or above the threshold."""

    def run(batches):
        for block in blocks(batches):
            rows = []
            for doc, text in zip(block.column("doc_id").to_pylist(), strings(block), strict=True):
                parts = [p for p in re.split(r"(?<=[.!?\n])(?![.!?\n])", text) if p.strip()]
                for k, p in enumerate(noisy_or(model, parts)):
                    if p >= threshold:
                        rows.append((doc, k, parts[k].strip(), p))
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.float64()), strict=True)], ["doc_id", "sentence", "text", "score"])

    return texts(df, id_col, text_col).mapInArrow(run, "doc_id long, sentence long, text string, score double")


def keep_clean(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, whose text scores below one half."""

    def run(batches):
        for block in blocks(batches, text_col):
            yield block.filter(pa.array([p < 0.5 for p in noisy_or(model, strings(block, text_col))], pa.bool_()))

    short_batches(df.sparkSession)
    return df.mapInArrow(run, df.schema)
