"""Toxicity by subword bags (operator 4).

A word is its character n-grams, word ends marked, hashed to vectors; a bag is the
average of the vectors of eight consecutive words; a linear softmax on the bag gives
its class, and a text is as toxic as its most toxic bag. Vectors and softmax are
trained jointly in numpy; unseen misspellings share most n-grams with known words.

Trained on the driver from a bounded sample (``SAMPLE`` labelled texts of each class, of at
most ``SAMPLE_CHARS`` characters). Scoring is one narrow pass: for two classes a vector matters
only through its product with the softmax weights, so tasks get one number a bucket (1 MB).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import ship
from ._words import slices

ship(__name__)

SIZES = (3, 4, 5, 6)      # characters of an n-gram
BUCKETS_LOG2 = 18
DIMENSIONS = 4
BAG_WORDS = 8
SAMPLE = 1000             # of each class
SAMPLE_CHARS = 3000       # only texts up to this length are learnt from; all are scored whole
EPOCHS = 100
STEP = 1.0                # of Adagrad
FOLDS, HELD_OUT = 5, 0


class Model:
    """One weight for each bucket (vector times softmax weights) and a bias; ``constant`` if there was nothing to learn."""

    def __init__(self, weights: np.ndarray, bias: float, constant: float | None = None):
        self.weights, self.bias, self.constant = weights, bias, constant

    def parts(self) -> tuple:
        return self.weights, self.bias, self.constant


def _characters(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Code points of lower-cased texts, each after a blank, and the n + 1 places of these blanks; 1 stands for what is no letter or digit."""
    low = [(t or "").lower() for t in texts]
    x = np.frombuffer((" " + " ".join(low) + " ").encode("utf-32-le", "replace"), np.uint32)
    at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in low])]).astype(np.int64)
    letter = ((x >= 97) & (x <= 122)) | ((x >= 48) & (x <= 57)) | ((x >= 0xC0) & (x != 0xD7) & (x != 0xF7))
    letter &= ~(((x >= 0x2000) & (x <= 0x206F)) | ((x >= 0x3000) & (x <= 0x303F)))
    return np.where(letter, x, np.uint32(1)).astype(np.uint64), at


def _grams(x: np.ndarray):
    """For each n-gram size: places, and buckets, of the n-grams within words (an end mark may be first or last)."""
    n = len(x)
    gap = np.concatenate([[0], np.cumsum(x == 1)])
    h = x * np.uint64(0x9E3779B97F4A7C15)
    for k in range(2, max(SIZES) + 1):
        h = h[:n - k + 1] * np.uint64(0xD6E8FEB86659FD93) + x[k - 1:]
        if k in SIZES:
            i = np.arange(n - k + 1)
            ok = np.flatnonzero(gap[i + k - 1] - gap[i + 1] == 0)
            z = h[ok]
            z = (z ^ (z >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            yield ok, (z >> np.uint64(64 - BUCKETS_LOG2)).astype(np.int32)


def _bags(x: np.ndarray, at: np.ndarray):
    """Start and end places of the bags (from the blank before a word), and the text of each."""
    word = np.flatnonzero((x[:-1] == 1) & (x[1:] != 1))  # the mark before each word
    first = np.searchsorted(word, at)  # the blank before a text belongs to it
    rank = np.arange(len(word)) - np.repeat(first[:-1], np.diff(first))
    lead = np.flatnonzero(rank % BAG_WORDS == 0)
    of = np.repeat(np.arange(len(at) - 1), np.diff(first))[lead]
    start = word[lead]
    end = np.append(start[1:], len(x))
    end = np.minimum(end, at[of + 1])  # not into the next text
    return start, end, of


def logits(model: Model, texts: list) -> np.ndarray:
    """Of each text: the highest logit of its bags, the bias without any."""
    out = np.full(len(texts), model.bias)
    if model.constant is not None or not texts:
        return out
    x, at = _characters(texts)
    value, number = np.zeros(len(x) + 1), np.zeros(len(x) + 1)
    for place, bucket in _grams(x):
        value[place + 1] += model.weights[bucket]
        number[place + 1] += 1
    value, number = np.cumsum(value), np.cumsum(number)
    start, end, of = _bags(x, at)
    if len(start):
        mean = (value[end] - value[start]) / np.maximum(number[end] - number[start], 1)
        some, lead = np.unique(of, return_index=True)
        out[some] = model.bias + np.maximum.reduceat(mean, lead)
    return out


def probabilities(model: Model, texts: list) -> np.ndarray:
    if model.constant is not None:
        return np.full(len(texts), model.constant)
    return 1 / (1 + np.exp(-np.clip(logits(model, texts), -500, 500)))


def fit(texts: list, labels: list, epochs: int = EPOCHS, seed: int = 11) -> Model:
    """Vectors and softmax weights by full-batch Adagrad on the log loss of each text's strongest bag.

    The first coordinate of the vectors starts at the log odds of texts with the n-gram, so that the
    strongest bag of a toxic text is a toxic one from the start; both are then trained together.
    """
    y = np.array(labels, dtype=float)
    if len(y) == 0 or y.min() == y.max():
        return Model(np.zeros(1, np.float32), 0.0, (y.sum() + 1) / (len(y) + 2) if len(y) else 0.0)
    x, at = _characters(texts)
    start, end, of = _bags(x, at)
    buckets = 1 << BUCKETS_LOG2
    ids, bag = [], []
    has = [np.full(buckets, 0.5), np.full(buckets, 0.5)]  # texts of each class that have the n-gram
    for place, bucket in _grams(x):
        b = np.searchsorted(start, place, side="right") - 1
        ok = (b >= 0) & (place < end[np.maximum(b, 0)])
        ids.append(bucket[ok])
        bag.append(b[ok].astype(np.int32))
        seen = np.unique(of[bag[-1]] * buckets + ids[-1])
        for c in (0, 1):
            has[c] += np.bincount(seen[y[seen // buckets] == c] % buckets, minlength=buckets)
    ids, bag = np.concatenate(ids), np.concatenate(bag)
    order = np.argsort(bag, kind="stable").astype(np.int32)
    ids, bag = ids[order], bag[order]
    cut = np.searchsorted(bag, np.arange(len(start) + 1))
    del bag, order, seen
    size = np.maximum(np.diff(cut), 1).astype(float)
    odds = np.log(has[1] / ((y == 1).sum() + 1)) - np.log(has[0] / ((y == 0).sum() + 1))
    odds[(has[0] + has[1]) < 3] = 0
    rng = np.random.Generator(np.random.PCG64(seed))
    vectors = rng.normal(0, 0.05, (buckets, DIMENSIONS))
    vectors[:, 0] = odds
    softmax, bias = rng.normal(0, 0.05, (DIMENSIONS, 2)), np.zeros(2)
    softmax[0] = (-1.0, 1.0)
    memory = [np.full_like(vectors, 1e-2), np.full_like(softmax, 1e-2), np.full_like(bias, 1e-2)]
    some, lead = np.unique(of, return_index=True)
    target = np.stack([1 - y[some], y[some]], 1)
    for _ in range(epochs):
        direction = softmax[:, 1] - softmax[:, 0]
        per_bag = np.add.reduceat(np.append((vectors @ direction).astype(np.float32)[ids], np.float32(0)), np.minimum(cut[:-1], len(ids)), dtype=float)
        per_bag = np.where(np.diff(cut) > 0, per_bag, 0.0) / size
        top = np.array([a + int(np.argmax(per_bag[a:b])) for a, b in zip(lead, np.append(lead[1:], len(of)))])
        n = np.diff(cut)[top]
        inside = np.concatenate([np.arange(cut[t], cut[t + 1]) for t in top])
        owner = np.repeat(np.arange(len(top)), n)
        mean = np.zeros((len(top), DIMENSIONS))
        np.add.at(mean, owner, vectors[ids[inside]])
        mean /= size[top][:, None]
        z = mean @ softmax + bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        error = (p - target) / len(top)
        by_text = (error @ softmax.T) / size[top][:, None]
        grad_v = np.zeros_like(vectors)
        np.add.at(grad_v, ids[inside], by_text[owner])
        for w, m, g in zip((vectors, softmax, bias), memory, (grad_v, mean.T @ error + 1e-4 * softmax, error.sum(0))):
            m += g * g
            w -= STEP * g / np.sqrt(m)
    return Model((vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 5; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Fit on a bounded sample: ids with remainder 0, null ids and null labels are not used.

    Ids are sampled by hash from the labels (three times as many as wanted, for texts
    that are missing or too long), their texts are then looked up in one pass.
    """
    key = F.col(f"`{id_col}`").cast("long")
    marks = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("toxic"))
    marks = marks.filter((fold(F.col("doc_id")) != HELD_OUT) & F.col("toxic").isin(0, 1))
    some = [marks.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").limit(3 * sample) for c in (0, 1)]
    wanted = F.broadcast(some[0].unionByName(some[1]))  # 6 * sample ids at most
    rows = docs.select(key.alias("doc_id"), F.col(f"`{text_col}`").alias("text")).filter(F.length("text") <= sample_chars).join(wanted, "doc_id")
    picked = [rows.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id", F.xxhash64("text")).limit(sample) for c in (0, 1)]
    got = picked[0].unionByName(picked[1]).select("text", "toxic").toArrow()
    return fit(got.column(0).to_pylist(), got.column(1).to_pylist())


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. Null and empty texts score like an empty bag.

    held_out: remainder 0 (a null id: false). Repeated rows each give a row; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.parts())

    def run(batches):
        model = Model(*shared.value)
        for b in slices(batches, size=1_000_000):
            p = probabilities(model, b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32), pa.int32())],
                                             ["doc_id", "held_out", "score", "predicted"])

    doc_id = F.col(f"`{id_col}`").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), F.coalesce(fold(doc_id) == HELD_OUT, F.lit(False)).alias("held_out"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    shared, place = docs.sparkSession.sparkContext.broadcast(model.parts()), docs.columns.index(text_col)

    def run(batches):
        model = Model(*shared.value)
        for b in slices(batches, text_col, 1_000_000):
            yield b.filter(pa.array(probabilities(model, b.column(place).to_pylist()) < 0.5))

    return docs.mapInArrow(run, docs.schema)
