"""Quality classifier: random-indexing word vectors, pooled, and a calibrated two-layer network.

*Vectors.* Words (runs of non-space) are hashed into ``SLOTS`` slots, and so are their shapes (runs of upper case, lower case, digits collapsed,
other characters as they are). Each slot has a sparse random index vector; its context vector is the sum of the index vectors of its
neighbours over the whole corpus, plus its own, to unit length. Tasks add up contexts in an array of fixed size, so
what moves is a fixed amount per task, and the finished vectors are ``SLOTS * DIM`` floats (4 MB) whatever the corpus.

*Documents.* Mean and standard deviation of the vectors of all words, the same of all shapes, the lengths of both
means, and the logarithm of the number of words.

*Network.* One hidden layer, trained in numpy on the driver on at most ``max_train`` labelled documents, those of
the smallest hashes of doc_id; a fifth of them is set aside to choose when to stop and to fit the temperature that
divides the logit. Rows with crc32(doc_id as text) mod 5 = 0 are never learned from; labels, lang, source and
doc_id are not features.

Defined results: null text is empty; an empty text has all features 0 and a score like any other; null labels and ids are
not learned from; repeated rows are scored each; of contradicting labels the smallest counts; without two classes among the labels
every score is their share (0.5 without labels); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import CHUNK_BYTES, hash_runs, random_words, text_chunks, whole_text, word_runs

SLOTS, SHAPE_SLOTS, DIM, NONZERO = 1 << 15, 1 << 12, 32, 2
BLOCKS = 32  # pieces of the vector table that travel separately
WORDS_AT_ONCE = 200_000
FEATURES = 4 * DIM + 3

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123], _SHAPE[65:91], _SHAPE[48:58], _SHAPE[128:] = 97, 65, 48, 97


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text is 0 modulo 5; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """(dimension, sign) of the non-zero entries of each slot's index vector."""
    noise = random_words(SLOTS * NONZERO, 41).reshape(SLOTS, NONZERO)
    return ((noise >> np.uint64(8)) % np.uint64(DIM)).astype(np.int64), np.where(noise >> np.uint64(63), 1.0, -1.0)


def slots_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slot of each word, slot of its shape, row) over rows of UTF-8 bytes."""
    starts, ends, rows = word_runs(~_SPACE[data], offsets)
    if not len(starts):
        return starts, starts, rows
    words = hash_runs(data, starts, ends) % np.uint64(SLOTS - SHAPE_SLOTS)
    kinds = _SHAPE[data]
    kept = np.ones(len(kinds), bool)
    kept[1:] = kinds[1:] != kinds[:-1]
    kept[starts] = True
    upto = np.concatenate([[0], np.cumsum(kept)])
    shapes = hash_runs(kinds[kept], upto[starts], upto[ends]) % np.uint64(SHAPE_SLOTS)
    return words.astype(np.int64), shapes.astype(np.int64) + (SLOTS - SHAPE_SLOTS), rows


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The context vectors of all slots, from the whole corpus."""

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims, signs = _index_vectors()
        total = np.zeros(SLOTS * DIM)
        seen = False
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch["text"]):
                words, shapes, rows = slots_of(data, offsets)
                beside = rows[1:] == rows[:-1]
                for slots in (words, shapes):
                    left, right = slots[:-1][beside], slots[1:][beside]
                    for to, of in ((left, right), (right, left)):
                        for k in range(NONZERO):
                            total += np.bincount(to * DIM + dims[of, k], signs[of, k], SLOTS * DIM)
                seen = seen or len(words) > 0
        if seen:
            parts = np.split(total.astype(np.float32), BLOCKS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(BLOCKS), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
                names=["block", "part"],
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                part = np.frombuffer(row["part"], np.float32)
                sums[row["block"]] = sums[row["block"]] + part if row["block"] in sums else part.astype(np.float64)
        for block, part in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([part.astype(np.float32).tobytes()], pa.binary())],
                names=["block", "part"],
            )

    schema = "block int, part binary"
    partial = docs.select(whole_text().alias("text")).mapInArrow(contexts, schema)
    table = np.zeros((BLOCKS, SLOTS * DIM // BLOCKS))
    for row in partial.repartition(BLOCKS, "block").mapInArrow(add, schema).collect():  # SLOTS * DIM floats in all
        table[row["block"]] = np.frombuffer(row["part"], np.float32)
    vectors = table.reshape(SLOTS, DIM)
    dims, signs = _index_vectors()
    for k in range(NONZERO):
        vectors[np.arange(SLOTS), dims[:, k]] += signs[:, k]
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def features(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """One row of pooled features per text."""
    found = np.zeros((len(texts), FEATURES))
    for first, end, data, offsets in text_chunks(texts, CHUNK_BYTES // 4):
        words, shapes, rows = slots_of(data, offsets)
        n = np.bincount(rows, minlength=end - first).astype(float)
        some = np.maximum(n, 1)[:, None]
        out = found[first:end]
        for at, slots in ((0, words), (2 * DIM, shapes)):
            sums, squares = np.zeros((end - first, DIM)), np.zeros((end - first, DIM))
            for a in range(0, len(slots), WORDS_AT_ONCE):
                part = vectors[slots[a : a + WORDS_AT_ONCE]]
                present, begin = np.unique(rows[a : a + WORDS_AT_ONCE], return_index=True)
                sums[present] += np.add.reduceat(part, begin)
                squares[present] += np.add.reduceat(part * part, begin)
            mean = sums / some
            out[:, at : at + DIM] = mean
            out[:, at + DIM : at + 2 * DIM] = np.sqrt(np.maximum(squares / some - mean * mean, 0))
            out[:, 4 * DIM + at // (2 * DIM)] = np.linalg.norm(mean, axis=1)
        out[:, 4 * DIM + 2] = np.log1p(n)
    return found


@dataclass
class Network:
    """Standardised features, one hidden layer, temperature."""

    centre: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -8, 8)
        return np.tanh(z @ self.hidden + self.hidden_bias) @ self.out + self.out_bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def train(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 120, seed: int = 0) -> Network:
    """Adam on mini-batches with weight decay; keeps the epoch of least validation loss, then fits the temperature."""
    if len(set(y.tolist())) < 2:
        share = float(np.mean(y)) if len(y) else 0.5
        bias = float(np.log(max(share, 1e-3) / max(1 - share, 1e-3)))
        zero = np.zeros(FEATURES)
        return Network(zero, zero + 1, np.zeros((FEATURES, 1)), np.zeros(1), np.zeros(1), bias)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    apart = max(1, len(y) // 5)
    held, used = order[:apart], order[apart:]
    centre, scale = x[used].mean(0), x[used].std(0) + 1e-3
    z, t = np.clip((x[used] - centre) / scale, -8, 8), y[used].astype(float)
    weights = [
        rng.normal(0, 1 / np.sqrt(FEATURES), (FEATURES, hidden)),
        np.zeros(hidden),
        rng.normal(0, 1 / np.sqrt(hidden), hidden),
        np.zeros(1),
    ]
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    best, best_loss, step = None, np.inf, 0
    for _ in range(epochs):
        shuffled = rng.permutation(len(t))
        for at in range(0, len(t), 128):
            rows = shuffled[at : at + 128]
            inner = np.tanh(z[rows] @ weights[0] + weights[1])
            error = (_sigmoid(inner @ weights[2] + weights[3][0]) - t[rows]) / len(rows)
            back = np.outer(error, weights[2]) * (1 - inner**2)
            slopes = [z[rows].T @ back + 1e-4 * weights[0], back.sum(0), inner.T @ error + 1e-4 * weights[2], error.sum(keepdims=True)]
            step += 1
            for w, g, m, v in zip(weights, slopes, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        net = Network(centre, scale, weights[0].copy(), weights[1].copy(), weights[2].copy(), float(weights[3][0]))
        loss = _loss(net.logits(x[held]), y[held])
        if loss < best_loss:
            best, best_loss = net, loss
    logits = best.logits(x[held])
    grid = np.exp(np.linspace(np.log(0.25), np.log(4), 81))
    best.temperature = float(grid[int(np.argmin([_loss(logits / g, y[held]) for g in grid]))])
    return best


def fit(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, max_train: int = 20_000) -> Network:
    """Learn ``quality`` from labelled documents outside the held-out fold, ``max_train`` of them at most."""
    known = labels.filter("doc_id is not null and quality is not null").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)  # at most 12 bytes a row: safe to broadcast
    table = docs.sparkSession.sparkContext.broadcast(vectors)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = features(batch["text"], table.value).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["label"], pa.array([x.tobytes() for x in found], pa.binary())],
                names=["doc_id", "label", "features"],
            )

    rows = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(sample), "doc_id")
    pooled = rows.select("doc_id", F.col("label").cast("int").alias("label"), "text").mapInArrow(
        pool, "doc_id long, label int, features binary"
    )
    # rows that repeat a doc_id do not count twice, and the order of arrival has no effect
    got = pooled.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("features").alias("features")).collect()
    got.sort(key=lambda r: r["doc_id"])
    x = np.array([np.frombuffer(r["features"], np.float32) for r in got], float).reshape(len(got), FEATURES)
    return train(x, np.array([int(r["label"] == 1) for r in got]))


def score(docs: DataFrame, net: Network, vectors: np.ndarray, keep: list[str]) -> DataFrame:
    """(kept, quality_score) for every document; ``kept`` is a struct of the columns to keep."""
    table = docs.sparkSession.sparkContext.broadcast(vectors)
    wanted = docs.select(F.struct(*keep).alias("kept"), whole_text().alias("text"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = net.scores(features(batch["text"], table.value)) if len(batch) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch["kept"], pa.array(scores, pa.float64())], ["kept", "quality_score"])

    schema = wanted.select("kept").schema.add("quality_score", "double")
    return wanted.mapInArrow(apply, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, keep: list[str], max_train: int = 20_000) -> DataFrame:
    """Fit on the labelled documents and score all."""
    vectors = word_vectors(docs)
    return score(docs, fit(docs, labels, vectors, max_train), vectors, keep)
