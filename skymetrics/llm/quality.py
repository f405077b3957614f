"""Quality scores by supervised subword embeddings.

Every word and every character n-gram inside a word (its two ends marked) has a
learnt vector, found by hashing; a text is the average of its vectors, and a
softmax over two classes gives the score.  The vectors are learnt by stochastic
gradient descent in numpy from a bounded sample on the driver.  For scoring, a
vector and the output layer fold into one number per hash bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skymetrics.llm.labelled import fold, labelled_sample
from skymetrics.llm.text import SPACES, U64, Words, _byte_values, mix, slices, window_sums

#: rows of either class that the vectors are learnt from, at most
PER_CLASS = 1024
BUCKET_BITS, SIZE = 18, 8
GRAMS = (3, 4, 5)
EPOCHS, RATE, BATCH = 8, 0.5, 32


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Hash buckets of a slice's words and n-grams.

    Returns a list of (buckets, places), places ascending, and the offsets of
    the texts on the scale of the places.
    """
    padded = np.insert(data, offsets, 0x20)  # a space before each text and after the last
    at = offsets + np.arange(len(offsets))
    space = SPACES[padded]
    padded = np.where(space, np.uint8(0x20), padded)
    shift = U64(64 - BUCKET_BITS)
    words = Words(padded, np.array([0, len(padded)]), SPACES)
    hashes = words.hashes(seed=1)
    out = [((hashes >> shift).astype(np.int64), words.starts)]
    values = _byte_values()[padded]
    spaces = np.concatenate([[0], np.cumsum(space)])
    for n in GRAMS:
        first = np.arange(max(0, len(padded) - n + 1))
        inner = first[spaces[first + n - 1] == spaces[first + 1]]
        keys = mix(window_sums(values, inner, inner + n) + U64(n))
        out.append(((keys >> shift).astype(np.int64), inner))
    return out, at


@dataclass
class Embeddings:
    """The folded model: difference of the two classes' outputs per bucket, and the bias."""

    table: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        found, at = features(data, offsets)
        total, count = np.zeros(len(at) - 1), np.zeros(len(at) - 1)
        for buckets, places in found:
            ends = np.searchsorted(places, at)
            sums = np.concatenate([[0.0], np.cumsum(self.table[buckets], dtype=np.float64)])
            total += sums[ends[1:]] - sums[ends[:-1]]
            count += np.diff(ends)
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + self.bias, -30, 30)))


def learn(rows: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 7) -> Embeddings:
    """Embeddings for (label, buckets, counts) rows; equal rows count once."""
    named = {(r[0], hashlib.sha256(r[1].tobytes() + r[2].tobytes()).digest()): r for r in rows}
    rows = [named[k] for k in sorted(named)]
    y = np.array([r[0] for r in rows])
    if not len(y) or y.min() == y.max():  # nothing to tell apart: the share of label 1 (a half without any rows)
        p = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
        return Embeddings(np.zeros(1 << BUCKET_BITS, np.float32), float(np.log(p / (1 - p))))
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / SIZE, 1 / SIZE, (1 << BUCKET_BITS, SIZE)).astype(np.float32)
    output, bias = np.zeros((SIZE, 2), np.float32), np.zeros(2, np.float32)
    classes = [np.flatnonzero(y == c) for c in (0, 1)]
    steps = max(1, 2 * max(map(len, classes)) // BATCH)
    for step in range(total := EPOCHS * max(steps, 8)):
        rate = RATE * (1 - step / total)
        chosen = np.concatenate([random.choice(c, BATCH // 2) for c in classes])
        buckets = np.concatenate([rows[i][1] for i in chosen])
        sizes = [len(rows[i][1]) for i in chosen]
        share = np.concatenate([rows[i][2] / max(1, rows[i][2].sum()) for i in chosen]).astype(np.float32)
        owner = np.repeat(np.arange(BATCH), sizes)
        weighted = vectors[buckets] * share[:, None]
        text = np.stack([np.bincount(owner, weighted[:, k], BATCH) for k in range(SIZE)], axis=1)
        logits = text @ output + bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(BATCH), y[chosen]] -= 1
        slope = (p @ output.T).astype(np.float32)
        output -= rate * (text.T @ p / BATCH * 4).astype(np.float32)
        bias -= rate * p.mean(axis=0).astype(np.float32)
        used, place = np.unique(buckets, return_inverse=True)
        change = np.stack([np.bincount(place, share * slope[owner, k], len(used)) for k in range(SIZE)], axis=1)
        vectors[used] -= (rate * VECTOR_RATE * change).astype(np.float32)
    return Embeddings((vectors @ (output[:, 1] - output[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


#: vectors move this much faster than the output layer: a text's step is shared among its features
VECTOR_RATE = 20.0


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 4, held_out: int = 2,
          per_class: int = PER_CLASS) -> Embeddings:
    """Embeddings learnt from at most ``per_class`` labelled rows of either class (see ``labelled_sample``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("label").to_pylist()
            for a, b, data, offsets in slices(batch.column("text")):
                found, at = features(data, offsets)
                ends = [np.searchsorted(places, at) for _, places in found]
                keys, counts = [], []
                for i in range(b - a):
                    mine = np.concatenate([buckets[e[i]:e[i + 1]] for (buckets, _), e in zip(found, ends, strict=True)])
                    k, n = np.unique(mine, return_counts=True)
                    keys.append(k.astype("<i4").tobytes())
                    counts.append(n.astype("<f4").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(label[a:b], pa.int32()), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())], ["label", "keys", "counts"])

    sample = labelled_sample(docs, labels, label, folds, held_out, per_class).select("label", "text")
    rows = sample.mapInArrow(run, "label int, keys binary, counts binary").toLocalIterator()
    return learn([(r.label, np.frombuffer(bytes(r["keys"]), np.int32), np.frombuffer(bytes(r.counts), np.float32)) for r in rows])


def score(docs: DataFrame, model: Embeddings, folds: int = 4, held_out: int = 2, threshold: float = 0.7) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    NULL and empty texts have no features and the score of the bias; a NULL
    doc_id is carried along, repeated rows are scored each, an empty table
    gives an empty result.  Only doc_id and text are read, and the score is a
    function of the text alone.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column("text"), 1 << 20):
                found = model.scores(data, offsets)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(a, b - a), pa.array(found), pa.array((found >= threshold).astype(np.int32)),
                ], ["doc_id", "score", "predicted"])

    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, predicted int")
    return scored.withColumn("held_out", fold(scored["doc_id"], folds) == held_out).select("doc_id", "held_out", "score", "predicted")
