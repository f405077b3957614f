"""Toxicity scores by a factorization machine over hashed terms.

Terms are the distinct lower-cased words of a text, hashed.  The score is the
logistic function of a bias, a weight per term, and for each two terms the
product of their factor vectors: so an insult and the mention of a group can
weigh together what neither does alone.  The machine learns from a bounded
sample on the driver; scoring reads whole texts in the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skymetrics.llm.labelled import fold, labelled_sample
from skymetrics.llm.text import LOWER, NOT_ALNUM, U64, Words, distinct, slices

#: rows of either class that the machine learns from, at most
PER_CLASS = 4096
#: hashed terms are numbers below this
BUCKETS = 1 << 40
#: a term or pair enters the machine if the root of its likelihood ratio statistic reaches this
TERM_EVIDENCE, PAIR_EVIDENCE = 4.0, 6.0
#: terms whose pairs are counted at once
PAIR_BLOCK = 512
FACTORS, EPOCHS, RATE, SHRINK = 8, 150, 0.1, 1e-4


@dataclass
class Machine:
    """terms: sorted hashed terms; weights and factors in their order."""

    terms: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margins(self, term: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
        """For (number of a term, number of its text), each pair once: the margin of each of ``n`` texts."""
        out = self.bias + np.bincount(text, self.weights[term], n)
        for f in self.factors.T:
            out += 0.5 * (np.bincount(text, f[term], n) ** 2 - np.bincount(text, f[term] ** 2, n))
        return out

    def scores(self, keys: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.terms, keys), max(0, len(self.terms) - 1))
        known = self.terms[at] == keys if len(self.terms) else np.zeros(len(keys), bool)
        return 1 / (1 + np.exp(-np.clip(self.margins(at[known], text[known], n), -30, 30)))


def text_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashed term, number of its text): the distinct terms of each text of a slice."""
    words = Words(LOWER[data], offsets, NOT_ALNUM)
    return distinct(words.hashes() % U64(BUCKETS), words.text_of_words())


def _evidence(a: np.ndarray, b: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Root of the likelihood ratio statistic of ``a`` of n1 and ``b`` of n0 against one rate for both."""
    def part(k, n, p):
        with np.errstate(divide="ignore", invalid="ignore"):
            x = np.where(k > 0, k * np.log(k / (n * p)), 0.0)
            y = np.where(n - k > 0, (n - k) * np.log((n - k) / (n * (1 - p))), 0.0)
        return x + y

    p = (a + b) / (n1 + n0)
    return np.sqrt(np.maximum(0, 2 * (part(a, n1, p) + part(b, n0, p))))


def _interacting(term: np.ndarray, text: np.ndarray, a: np.ndarray, b: np.ndarray, evidence: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """The terms of pairs whose evidence goes beyond that of their terms; texts of label 0 come first."""
    # a pair is in at most the texts of its term, and evidence is convex in both counts: it is largest at a corner
    none = np.zeros_like(a)
    most = np.maximum(evidence, np.maximum(_evidence(a, none, n1, n0), _evidence(none, b, n1, n0)))
    able = np.flatnonzero((most >= PAIR_EVIDENCE) & (most >= evidence + TERM_EVIDENCE))
    place = np.full(len(a), -1)
    place[able] = np.arange(len(able))
    inside = place[term] >= 0
    order = np.argsort(place[term[inside]], kind="stable")
    at, of = place[term[inside]][order], text[inside][order]

    def block(i: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = np.searchsorted(at, [i, i + PAIR_BLOCK])
        x = np.zeros((n0 + n1, min(PAIR_BLOCK, len(able) - i)), np.float32)
        x[of[lo:hi], at[lo:hi] - i] = 1
        return x[:n0], x[n0:]

    strong = np.zeros(len(able), bool)
    for i in range(0, len(able), PAIR_BLOCK):
        one0, one1 = block(i)
        for j in range(i, len(able), PAIR_BLOCK):
            two0, two1 = (one0, one1) if i == j else block(j)
            pair = _evidence((one1.T @ two1).astype(float), (one0.T @ two0).astype(float), n1, n0)
            ones, twos = able[i:i + PAIR_BLOCK], able[j:j + PAIR_BLOCK]
            found = (pair >= PAIR_EVIDENCE) & (pair >= np.maximum(evidence[ones][:, None], evidence[twos][None, :]) + TERM_EVIDENCE)
            strong[i:i + PAIR_BLOCK] |= found.any(axis=1)
            strong[j:j + PAIR_BLOCK] |= found.any(axis=0)
    return able[strong]


def learn(rows: list[tuple[int, np.ndarray]]) -> Machine:
    """The machine for (label, sorted distinct hashed terms) rows; equal rows count once."""
    rows = sorted({(label, terms.tobytes()): (label, terms) for label, terms in rows}.values(), key=lambda r: (r[0], r[1].tobytes()))
    y = np.array([label for label, _ in rows], np.float64)
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    if not n1 or not n0:  # nothing to tell apart: the share of label 1 (a half without any rows)
        p = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
        return Machine(np.zeros(0, U64), float(np.log(p / (1 - p))), np.zeros(0), np.zeros((0, FACTORS)))
    text = np.repeat(np.arange(len(rows)), [len(t) for _, t in rows])
    vocabulary, term = np.unique(np.concatenate([t for _, t in rows]), return_inverse=True)
    a = np.bincount(term[y[text] == 1], minlength=len(vocabulary))
    b = np.bincount(term[y[text] == 0], minlength=len(vocabulary))
    evidence = _evidence(a, b, n1, n0)
    chosen = evidence >= TERM_EVIDENCE
    chosen[_interacting(term, text, a, b, evidence, n1, n0)] = True
    number = np.full(len(vocabulary), -1)
    number[chosen] = np.arange(chosen.sum())
    inside = number[term] >= 0
    return _descend(vocabulary[chosen], number[term[inside]], text[inside], y)


def _descend(terms: np.ndarray, term: np.ndarray, text: np.ndarray, y: np.ndarray) -> Machine:
    """Gradient descent with a step size per parameter; texts of either class weigh alike in sum."""
    n, m = len(y), len(terms)
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, n - y.sum()))
    machine = Machine(terms, 0.0, np.zeros(m), np.random.default_rng(7).normal(0, 0.05, (m, FACTORS)))
    squares = [1e-12, np.full(m, 1e-12), np.full((m, FACTORS), 1e-12)]
    for _ in range(EPOCHS):
        error = weight * (1 / (1 + np.exp(-np.clip(machine.margins(term, text, n), -30, 30))) - y)
        e = error[text]
        sums = np.stack([np.bincount(text, f[term], n) for f in machine.factors.T], axis=1)
        by_term = np.bincount(term, e, m)
        slope = [error.sum(), by_term + SHRINK * machine.weights,
                 np.stack([np.bincount(term, e * sums[text, k], m) for k in range(FACTORS)], axis=1)
                 - by_term[:, None] * machine.factors + SHRINK * machine.factors]
        squares = [s + g * g for s, g in zip(squares, slope, strict=True)]
        step = [RATE * g / np.sqrt(s) for s, g in zip(squares, slope, strict=True)]
        machine.bias -= float(step[0])
        machine.weights -= step[1]
        machine.factors -= step[2]
    return machine


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 3, held_out: int = 1,
          per_class: int = PER_CLASS) -> Machine:
    """The machine learnt from at most ``per_class`` labelled rows of either class (see ``labelled_sample``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column("text")):
                keys, text = text_terms(data, offsets)
                ends = np.searchsorted(text, np.arange(b - a + 1))
                lists = [keys[i:j].astype("<i8").tobytes() for i, j in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("label").slice(a, b - a), pa.array(lists, pa.binary())], ["label", "terms"])

    sample = labelled_sample(docs, labels, label, folds, held_out, per_class)
    rows = sample.select("label", "text").mapInArrow(run, "label int, terms binary").collect()
    return learn([(r.label, np.frombuffer(bytes(r.terms), U64)) for r in rows])


def score(docs: DataFrame, machine: Machine, folds: int = 3, held_out: int = 1, threshold: float = 0.7) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    NULL and empty texts have no terms and the score of the bias; a NULL doc_id
    is carried along, repeated rows are scored each, an empty table gives an
    empty result.  Only doc_id and text are read, and the score is a function
    of the text alone.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column("text")):
                found = machine.scores(*text_terms(data, offsets), b - a)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(a, b - a), pa.array(found), pa.array((found >= threshold).astype(np.int32)),
                ], ["doc_id", "score", "predicted"])

    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, predicted int")
    return scored.withColumn("held_out", fold(scored["doc_id"], folds) == held_out).select("doc_id", "held_out", "score", "predicted")


def reject(docs: DataFrame, machine: Machine, threshold: float = 0.7) -> DataFrame:
    """The documents, with all their columns, whose score is below ``threshold``; rows as in ``score``."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column("text")):
                stays = machine.scores(*text_terms(data, offsets), b - a) < threshold
                yield batch.slice(a, b - a).filter(pa.array(stays))

    return docs.mapInArrow(run, schema)
