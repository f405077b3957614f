import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import types as T

from skymetrics.llm import resampling
from skymetrics.llm.resampling import Features, Head, resample

DATA = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("score", T.StringType()), T.StructField("rank", T.LongType()), T.StructField("weight", T.LongType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 5, 1) for i, t in rows], DOCS)


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [zlib.crc32(f.encode()) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def brute(rows, target, percent=25, least=20):
    found = [features(t) for _, t in rows]
    s, t = Counter(), Counter()
    for _, f in found:
        s.update(f)
    for x in target:
        t.update(features(x)[1])
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10000) / ((s[b] + 1) * (t.total() + 10000)))) for b in range(10000)]
    out = []
    for (i, _), (words, f) in zip(rows, found):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(words), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    for n, r in enumerate(fit[:len(fit) * percent // 100]):
        r[5] = n + 1
    return sorted(map(tuple, out), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    rows += [(None, "word " * 30), (None, "other Ünïcode 東京 " * 20), (7000, None), (7001, ""), (7002, " ;,- "), (7003, "One"), (7004, "A b"),
             (7005, "x\x00y " * 25), (7006, "y" * 300 + " tail" * 40), (7007, "Very long text of words " * 40_000)]
    rows += [(8000, "the same row again and again " * 5)] * 40  # ties in score and id
    assert got(resample(frame(spark, rows), frame(spark, enumerate([*target, None])))) == brute(rows, target)


def test_head_and_tail_give_the_same_buckets(spark):
    text = "of the a of the b rare word of the a"
    data = np.frombuffer(text.encode(), "u1")
    found = Features(data, np.array([0, len(data)]))
    want = [x.tolist() for x in found.buckets(Head([], []))]
    assert [x.tolist() for x in found.buckets(Head([b"of", b"the", b"zzz"], [b"of the", b"zzz of"]))] == want
    words, pairs = found.frequent()
    assert dict(words)[b"of"] == 3 and dict(pairs)[b"of the"] == 3


def test_words_over_the_head_s_bounds_are_tail(spark, monkeypatch):
    rows = [(i, f"w{i % 7} and w{i} again " * 9) for i in range(200)]
    want = brute(rows, ["w1 and w2"])
    for share in (0.01, 0.3, 2.0):
        monkeypatch.setattr(resampling, "WORD_SHARE", share)
        monkeypatch.setattr(resampling, "PAIR_SHARE", share)
        assert got(resample(frame(spark, rows), frame(spark, [(1, "w1 and w2")]))) == want


def test_share_and_empty_tables(spark):
    rows = [(i, "a b c " * (i % 4 + 5)) for i in range(11)]
    assert got(resample(frame(spark, rows), frame(spark, []), percent=50, least_words=18)) == brute(rows, [], 50, 18)
    assert sum(r.rank is not None for r in resample(frame(spark, rows), frame(spark, []), percent=0).collect()) == 0
    empty = resample(frame(spark, []), frame(spark, [(1, "a")]))
    assert empty.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"] and empty.count() == 0


def test_string_ids(spark):
    docs = spark.createDataFrame([("b", "x " * 30), ("a", "x " * 30), ("c", "y " * 30), (None, "x")], "doc_id string, text string")
    rows = {r.doc_id: r for r in resample(docs, docs, percent=100).collect()}
    assert sorted(r.rank for r in rows.values() if r.rank) == [1, 2, 3] and rows[None].rank is None
