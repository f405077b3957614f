"""Importance resampling towards a target distribution (hashed words and pairs).

Words and pairs of adjacent words are counted in ``BUCKETS`` buckets by CRC, over
all documents and over all texts of the target; a document's weight is the mean
log ratio of its features' buckets, and noise made from its id turns the highest
scores into a random draw in proportion to the weights.

The vocabulary has a head and a tail.  The head is what is frequent in some part
of the corpus: the words' exact CRC states and the buckets of frequent pairs,
bounded in number and length, which every task gets by broadcast.  All other
features take their CRC directly, a pair from the state of its first word.  The
head saves time only: both ways give the same exact bucket.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skymetrics.llm.staging import partitions, stage
from skymetrics.llm.text import LOWER, NOT_ALNUM, Words, memo, slices

#: fixed values of the contract
BUCKETS, SMOOTHING, SCALE, SEED, LEAST_WORDS, PERCENT = 10_000, 10_000, 1000, 7, 20, 25

#: a feature that makes up this share of all words (pairs) is that frequent in some slice, and so a candidate of the head
WORD_SHARE, PAIR_SHARE = 1 / (1 << 14), 1 / (1 << 15)
#: no word or pair of the head is longer than so many bytes (so the head has at most 6 MB: 1 / share of either at most)
HEAD_BYTES = 128


class Head:
    """Frequent words and pairs: ids and CRC states of words, buckets of pairs by their words' ids."""

    def __init__(self, words: list[bytes], pairs: list[bytes]):
        split = [p.split(b" ", 1) for p in pairs]
        known = sorted({*words, *(w for p in split for w in p)})
        self.ids = {w: i for i, w in enumerate(known)}
        self.states = [zlib.crc32(w) for w in known]
        keys = np.array([self.ids[a] * len(known) + self.ids[b] for a, b in split], np.int64)
        order = np.argsort(keys)
        self.pairs = keys[order]
        self.pair_buckets = np.array([zlib.crc32(p) % BUCKETS for p in pairs], np.int64)[order]

    def pair_bucket(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Buckets of pairs of word ids; -1 outside the head, and where a word has the id -1."""
        out = np.full(len(first), -1, np.int64)
        if len(self.pairs):
            keys = first * len(self.ids) + second
            at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            found = (first >= 0) & (second >= 0) & (self.pairs[at] == keys)
            out[found] = self.pair_buckets[at[found]]
        return out


class Features:
    """Words and pairs of a slice of texts; equal ones stand once."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words = words = Words(LOWER[data], offsets, NOT_ALNUM)
        _, first, self.word = np.unique(words.hashes(), return_index=True, return_inverse=True)
        blob = words.data.tobytes()
        self.texts = [blob[a:b] for a, b in zip(words.starts[first].tolist(), words.ends[first].tolist(), strict=True)]
        #: places of words with a next one in their text
        last = words.offsets[1:][words.counts > 0] - 1
        inside = np.ones(len(words.starts), bool)
        inside[last] = False
        self.first = np.flatnonzero(inside)
        kinds = max(1, len(self.texts))
        pairs, self.pair = np.unique(self.word[self.first].astype(np.int64) * kinds + self.word[self.first + 1], return_inverse=True)
        self.left, self.right = pairs // kinds, pairs % kinds

    def n_features(self) -> np.ndarray:
        n = self.words.counts
        return n + np.maximum(n - 1, 0)

    def buckets(self, head: Head) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the distinct words and of the distinct pairs."""
        ids = [head.ids.get(w, -1) for w in self.texts]
        states = [head.states[i] if i >= 0 else zlib.crc32(w) for i, w in zip(ids, self.texts, strict=True)]
        ids = np.array(ids, np.int64)
        of_pairs = head.pair_bucket(ids[self.left], ids[self.right])
        tail = np.flatnonzero(of_pairs < 0)
        spaced = [b" " + w for w in self.texts]
        crc = zlib.crc32
        of_pairs[tail] = [crc(spaced[b], states[a]) % BUCKETS for a, b in zip(self.left[tail].tolist(), self.right[tail].tolist(), strict=True)]
        return np.array(states, np.int64) % BUCKETS, of_pairs

    def frequent(self) -> tuple[list[tuple[bytes, int]], list[tuple[bytes, int]]]:
        """(word, count) and (pair, count) of those that make up WORD_SHARE and PAIR_SHARE here; at most 1 / share of either."""
        seen = np.bincount(self.word, minlength=len(self.texts))
        words = [(self.texts[i], int(seen[i])) for i in np.flatnonzero(seen >= WORD_SHARE * len(self.word)) if len(self.texts[i]) <= HEAD_BYTES]
        seen = np.bincount(self.pair, minlength=len(self.left))
        often = np.flatnonzero(seen >= PAIR_SHARE * len(self.pair))
        pairs = [(self.texts[a] + b" " + self.texts[b], int(n))
                 for a, b, n in zip(self.left[often].tolist(), self.right[often].tolist(), seen[often].tolist(), strict=True)]
        return words, [(p, n) for p, n in pairs if len(p) <= HEAD_BYTES]


def _features(column: pa.Array) -> Iterator[tuple[int, int, Features]]:
    for a, b, data, offsets in slices(column):
        yield a, b, Features(data, offsets)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, found in _features(batch.column("text")):
            words, pairs = found.frequent()
            both = [(b"", len(found.word)), *words, (b"", len(found.pair)), *pairs]  # the empty feature counts all
            yield pa.RecordBatch.from_arrays([
                pa.array([False] * (1 + len(words)) + [True] * (1 + len(pairs)), pa.bool_()),
                pa.array([f for f, _ in both], pa.binary()), pa.array([n for _, n in both], pa.int64())], ["pair", "feature", "n"])


class Shared:
    """The head's words and pairs as a broadcast; each Python worker builds the tables once."""

    def __init__(self, spark: SparkSession, words: list[bytes], pairs: list[bytes]):
        self.data = spark.sparkContext.broadcast((words, pairs))
        self.key = uuid.uuid4().hex

    def head(self) -> Head:
        return memo(("resampling head", self.key), lambda: Head(*self.data.value))


def head_vocabulary(docs: DataFrame) -> Shared:
    """The candidates of all slices that make up WORD_SHARE of all words or PAIR_SHARE of all pairs, at most 1 / share of either."""
    seen = stage(docs.select("text").mapInArrow(_candidates, "pair boolean, feature binary, n long")
                 .groupBy("pair", "feature").agg(F.sum("n").alias("n")), "head")
    total = {r.pair: r.n for r in seen.filter(F.length("feature") == 0).collect()}
    parts = []
    for pair, share in ((False, WORD_SHARE), (True, PAIR_SHARE)):
        often = seen.filter((F.col("pair") == pair) & (F.length("feature") > 0) & (F.col("n") >= share * total.get(pair, 0)))
        parts.append([bytes(r.feature) for r in often.select("feature").collect()])
    return Shared(docs.sparkSession, *parts)


def _counter(head: Shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, found in _features(batch.column("text")):
                of_words, of_pairs = found.buckets(head.head())
                np.add.at(total, of_words, np.bincount(found.word, minlength=len(of_words)))
                np.add.at(total, of_pairs, np.bincount(found.pair, minlength=len(of_pairs)))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    return run


def bucket_totals(texts: DataFrame, head: Shared) -> np.ndarray:
    """How many features of all texts each bucket holds."""
    total = np.zeros(BUCKETS, np.int64)
    counted = texts.select("text").mapInArrow(_counter(head), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in counted.collect():  # at most BUCKETS rows
        total[r.bucket] = r.n
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket, the scaled log ratio of its share of the target to its share of the source."""
    s_all, t_all = float(source.sum()), float(target.sum())
    return np.array([math.floor(SCALE * math.log((t + 1.0) * (s_all + SMOOTHING) / ((s + 1.0) * (t_all + SMOOTHING))))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def _weigher(head: Shared, gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, found in _features(batch.column("text")):
                of_words, of_pairs = found.buckets(head.head())
                value = gain[of_words][found.word]
                value[found.first] += gain[of_pairs][found.pair]
                before = np.concatenate([[0], np.cumsum(value)])
                at, n = found.words.offsets, found.n_features()
                weight = (before[at[1:]] - before[at[:-1]]) // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(a, b - a), pa.array(found.words.counts.astype(np.int64)),
                    pa.array(n.astype(np.int64)), pa.array(weight.astype(np.int64))], ["doc_id", "n_words", "n_features", "weight"])

    return run


def noise(doc_id: Column) -> Column:
    """Scaled Gumbel noise of an id: floor(-1000 ln(-ln u)), with u from the id's SHA-256."""
    text = F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3 ... by descending score and ascending doc_id, without one task for all.

    The range exchange cuts the order into parts (a random number splits rows
    that are equal in both); a part's rows are numbered as they are written, and
    the counts of the parts before, one number per part, are added.
    """
    spark = rows.sparkSession
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_tie")]
    mixed = stage(rows.withColumn("_tie", F.rand(SEED)), "ties")
    numbered = stage(
        mixed.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part, nth = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted((r.part, r.n) for r in numbered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())  # one row per partition
    before, done = [], 0
    for p, n in sizes:
        before.append((p, done))
        done += n
    offsets = spark.createDataFrame(before, "part long, before long")
    return (numbered.withColumn("part", part).join(F.broadcast(offsets), "part")
            .withColumn("rank", F.col("before") + nth + 1).drop("part", "before", "_at", "_tie"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, rank (NULL where not drawn).

    Drawn are the ``percent`` hundredths, rounded down, with the highest scores
    of the documents of at least ``least_words`` words; equal scores go to the
    smaller doc_id.  ``target`` needs a column text.  A NULL or empty text has
    no features and weight 0; a NULL doc_id has the noise of an empty id and
    comes last among equal scores.  Rows that repeat are documents each (which
    of them is ranked first does not show).  A text of any length is taken
    whole, and a task holds one slice of texts at a time, or one text longer
    than that.  Only doc_id and text are read; an empty table gives an empty
    result, and an empty target equal shares of all buckets.
    """
    texts = docs.select("doc_id", "text")
    head = head_vocabulary(texts)
    gain = gains(bucket_totals(texts, head), bucket_totals(target, head))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long"
    scored = stage(
        texts.mapInArrow(_weigher(head, gain), schema).withColumn("score", F.col("weight") + noise(F.col("doc_id"))), "scored")
    fit = F.col("n_words") >= least_words
    drawn = scored.filter(fit).count() * percent // 100
    # scores are whole numbers in a small range (some 100,000 at most): counts by score find the lowest one drawn
    lowest, left = None, drawn
    for r in scored.filter(fit).groupBy("score").count().orderBy(F.col("score").desc()).toLocalIterator():
        if left <= 0:
            break
        lowest, left = r.score, left - r["count"]
    if lowest is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    high = fit & (F.col("score") >= lowest)
    ranked = _ranked(scored.filter(high)).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.unionByName(scored.filter(~high).withColumn("rank", F.lit(None).cast("long")))
