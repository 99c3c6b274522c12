"""Operator 11: quality classifier of hashed word and character n-gram vectors.

Every word, word pair, pattern of a word pair (the same word twice or not) and
character n-gram (within words, marked ends) of a text hashes to one of ``BUCKETS`` learned vectors. A document is their average, a
softmax layer on it gives the classes. Vectors and layer are learned together
by stochastic gradient descent in numpy.

Counting the features of texts is spread over the tasks. The fit runs in one
task on a bounded sample: ``SAMPLE`` labelled documents (those of the smallest
id hashes), each reduced to at most ``BUCKETS`` counts beforehand, so that task
holds at most ``SAMPLE * BUCKETS`` counts whatever the corpus. The model has
``BUCKETS`` rows. For scores the layer is applied to the vectors once: the
average of projected vectors is the projection of the average.

Held out is a document whose crc32 of the id (as decimal text) divides by
``FOLDS``; no label of one is learned from. Inputs are texts only.

Results for odd rows: a null or empty text has no features and gets the score
of the bias alone. A null id is held out and kept. Labels that are null or other
than 0 and 1 and labels without a document teach nothing. Documents that share
an id and a label are one example (the smallest text); each of them is scored.
Without usable labels every score is 0.5. An empty table gives an empty table.
Words over ``CHUNK`` characters are taken in pieces. Further columns are not
carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import materialise, text_or_empty

FOLDS = 5
#: Labelled documents that the fit takes at most.
SAMPLE = 4000
BUCKETS = 1 << 14
DIMENSIONS = 16
GRAMS = (3, 4, 5)
EPOCHS = 5
RATE = 0.2
THRESHOLD = 0.3
#: Code points of a text that are hashed at a time.
CHUNK = 1 << 18

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_MIX = _U(0xD6E8FEB86659FD93)
_POWERS: list[np.ndarray] = []


def _powers() -> list[np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64."""
    if not _POWERS:
        for b in (int(_BASE), pow(int(_BASE), -1, 1 << 64)):
            steps = np.full(CHUNK + 2, b, dtype=_U)
            steps[0] = 1
            _POWERS.append(np.cumprod(steps, dtype=_U))
    return _POWERS


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    h = (h + _U(kind)) * _MIX
    h = (h ^ (h >> _U(32))) * _MIX
    return (h >> _U(64 - (BUCKETS.bit_length() - 1))).astype(np.int64)


def _chunks(codes: np.ndarray, space: np.ndarray) -> Iterator[np.ndarray]:
    """The code points in pieces of at most CHUNK, cut at white space where there is any."""
    at = 0
    while at < len(codes):
        end = min(at + CHUNK, len(codes))
        if end < len(codes):
            gaps = np.nonzero(space[at:end])[0]
            end = at + int(gaps[-1]) + 1 if len(gaps) else end
        yield np.where(space[at:end], 0, codes[at:end].astype(_U) + _U(1)).astype(_U)
        at = end


def features(text: str) -> np.ndarray:
    """How often the features of a text fall into each bucket."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    counts, last = np.zeros(BUCKETS, np.int64), np.zeros(0, _U)
    up, down = _powers()
    for piece in _chunks(codes, space):
        marked = np.concatenate([np.zeros(1, _U), piece, np.zeros(1, _U)])
        marked = marked[(marked != 0) | np.r_[True, marked[:-1] != 0]]  # one mark between words
        if marked[-1]:
            marked = np.r_[marked, _U(0)]
        ends = np.nonzero(marked == 0)[0]
        if len(ends) < 2:
            continue
        sums = np.cumsum(marked * up[:len(marked)], dtype=_U)
        words = (sums[ends[1:]] - sums[ends[:-1]]) * down[ends[:-1]]
        found = [_bucket(words, 1)]
        chain = np.concatenate([last, words])
        found.append(_bucket(chain[:-1] * _BASE + chain[1:], 2))
        found.append(_bucket((chain[:-1] == chain[1:]).astype(_U), 3))
        last = words[-1:]
        h, inside = marked, np.ones(len(marked), bool)  # of every start: the hash so far, no mark within
        for n in range(2, min(max(GRAMS), len(marked)) + 1):
            h = h[:-1] * _BASE + marked[n - 1:]
            if n > 2:
                inside = inside[:-1] & (marked[n - 2:-1] != 0)
            else:
                inside = inside[:-1]
            if n in GRAMS:
                found.append(_bucket(h[inside], 3 + n))
        counts += np.bincount(np.concatenate(found), minlength=BUCKETS)
    return counts


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


@dataclass
class Model:
    vectors: np.ndarray  # BUCKETS x DIMENSIONS
    layer: np.ndarray  # DIMENSIONS x 2
    bias: np.ndarray  # 2

    def scorer(self):
        """counts -> probability of label 1."""
        projected = self.vectors.astype(np.float64) @ self.layer.astype(np.float64)

        def score(counts: np.ndarray) -> float:
            at = np.nonzero(counts)[0]
            average = (counts[at] @ projected[at]) / counts[at].sum() if len(at) else np.zeros(2)
            return float(softmax(average + self.bias)[1])

        return score


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, rate: float = RATE,
          dimensions: int = DIMENSIONS, seed: int = 7) -> Model:
    """Stochastic gradient descent over (buckets, counts, label), one example a step, falling rate."""
    rng = np.random.default_rng(seed)
    vectors = ((rng.random((BUCKETS, dimensions)) - 0.5) / dimensions).astype(np.float32)
    layer, bias = np.zeros((dimensions, 2), np.float32), np.zeros(2, np.float32)
    shares = [(c / max(1, c.sum())).astype(np.float32) for _, c, _ in examples]
    steps, done = max(1, epochs * len(examples)), 0
    for _ in range(epochs):
        for k in rng.permutation(len(examples)):
            buckets, _, label = examples[k]
            share, step = shares[k], np.float32(rate * (1 - done / steps))
            hidden = share @ vectors[buckets]
            slope = softmax(hidden @ layer + bias).astype(np.float32)
            slope[label] -= 1
            back = layer @ slope
            layer -= step * np.outer(hidden, slope)
            bias -= step * np.float32(0.1) * slope
            # scaled so that the document's average moves by one step, however many features share it
            vectors[buckets] -= np.outer(step * share / max(share @ share, np.float32(1e-12)), back)
            done += 1
    return Model(vectors, layer, bias)


def held_out(id_col: str = "doc_id") -> Column:
    """True for documents whose labels must not be learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == 0, F.lit(True))


def examples(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, label, h, buckets, counts: the sampled labelled documents that may be learned from."""
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isin(0, 1)).distinct()
    there = docs.select(F.col(id_col).cast("long").alias("id")).where(F.col("id").isNotNull()).distinct()
    chosen = materialise(known.where(~held_out("id")).join(there, "id", "left_semi").withColumn(
        "h", F.xxhash64("id")).orderBy("h", "id", "label").limit(sample), "classifier-sample")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text")).join(
        F.broadcast(chosen), "id").groupBy("id", "label", "h").agg(F.min("text").alias("text"))  # sample rows at most

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k in range(0, len(b), 128):
                part = b.iloc[k:k + 128]
                counts = [features(t) for t in part["text"]]
                at = [np.nonzero(c)[0] for c in counts]
                yield pd.DataFrame({"id": part["id"], "label": part["label"], "h": part["h"],
                                    "buckets": [a.astype(np.int32) for a in at],
                                    "counts": [c[a].astype(np.int64) for c, a in zip(counts, at)]})

    return texts.mapInPandas(run, "id long, label int, h long, buckets array<int>, counts array<long>")


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE,
        id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model of a bounded sample of the labelled documents that are not held out."""
    rows = examples(docs, labels, label_col, sample, id_col, text_col)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [(h, i, y, np.asarray(b, np.int64), np.asarray(c, np.float32)) for part in batches for h, i, y, b, c
               in zip(part["h"], part["id"], part["label"], part["buckets"], part["counts"])]
        got.sort(key=lambda r: r[:3])
        m = train([(b, c, int(y)) for _, _, y, b, c in got])
        yield pd.DataFrame({"bucket": np.arange(BUCKETS), "v": list(m.vectors.astype(np.float64))})
        yield pd.DataFrame({"bucket": [-1, -2], "v": [m.layer.astype(np.float64).ravel(), m.bias.astype(np.float64)]})

    kept = materialise(rows.repartition(1).mapInPandas(run, "bucket int, v array<double>"), "classifier-model")
    by = {r["bucket"]: r["v"] for r in kept.collect()}  # BUCKETS + 2 rows
    if not by:
        return Model(np.zeros((BUCKETS, DIMENSIONS)), np.zeros((DIMENSIONS, 2)), np.zeros(2))
    return Model(np.array([by[k] for k in range(BUCKETS)]), np.array(by[-1]).reshape(-1, 2), np.array(by[-2]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted: a row for each document."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rate = model.scorer()
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "score": [rate(features(t)) for t in b["text"]]})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInPandas(run, "doc_id long, score double").select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> DataFrame:
    return score(docs, fit(docs, labels, label_col))


def accuracy(scored: DataFrame, labels: DataFrame, label_col: str = "quality") -> dict[str, float]:
    """Held-out rows: count, share of right predictions, log loss (a row with counts and sums)."""
    known = labels.select("doc_id", F.col(label_col).cast("int").alias("y")).where(F.col("y").isin(0, 1))
    p = F.greatest(F.least("score", F.lit(1 - 1e-9)), F.lit(1e-9))
    r = scored.where("held_out").join(known, "doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("predicted") == F.col("y")).alias("right"),
        F.sum(-F.log(F.when(F.col("y") == 1, p).otherwise(1 - p))).alias("loss")).first()
    return {"n": r["n"], "accuracy": r["right"] / r["n"] if r["n"] else math.nan,
            "log_loss": r["loss"] / r["n"] if r["n"] else math.nan}
