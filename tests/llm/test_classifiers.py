import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from skymetrics.llm import quality, toxicity
from skymetrics.llm.labelled import labelled_sample
from skymetrics.llm.text import slices

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("score", T.StringType()), T.StructField("label", T.LongType())])
DATA = "/root/testdata/sf0.01"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)


def terms(texts):
    out = []
    for a, b, data, offsets in slices(pa.array(texts, pa.string())):
        keys, text = toxicity.text_terms(data, offsets)
        ends = np.searchsorted(text, np.arange(b - a + 1))
        out += [keys[i:j] for i, j in zip(ends[:-1], ends[1:])]
    return out


def scores(machine, texts):
    found = terms(texts)
    return machine.scores(np.concatenate(found), np.repeat(np.arange(len(texts)), list(map(len, found))), len(texts))


def test_factors_learn_what_single_terms_do_not_tell():
    r = random.Random(3)
    texts, labels = [], []
    for _ in range(1500):
        a, b = r.choice(["fools", "folks"]), r.choice(["they", "gardens"])
        rest = " ".join(f"w{r.randrange(400)}" for _ in range(12))
        texts.append(f"{a} {rest} {b}")
        labels.append(int((a, b) in (("fools", "they"), ("folks", "gardens"))))
    machine = toxicity.learn(list(zip(labels[:1000], terms(texts[:1000]))))
    right = (scores(machine, texts[1000:]) >= 0.5) == np.array(labels[1000:])
    assert right.mean() > 0.95


def test_factors_learn_pairs_of_rare_terms_in_a_large_vocabulary():
    r = random.Random(4)
    texts, labels, pairs = [], [], []
    for k in range(3000):
        label, words = k % 2, [f"f{i}" for i in range(700) if r.random() < 0.4] + [f"w{r.randrange(40_000)}" for _ in range(60)]
        pair = r.random() < 0.4
        if pair:
            words += r.choice([("fools", "they"), ("folks", "gardens")] if label else [("fools", "gardens"), ("folks", "they")])
        texts.append(" ".join(r.sample(words, len(words))))
        labels.append(label)
        pairs.append(pair)
    known = terms(texts[:2000])
    assert len(np.unique(np.concatenate(known))) > 30_000
    machine = toxicity.learn(list(zip(labels[:2000], known)))
    right = (scores(machine, texts[2000:]) >= 0.5) == np.array(labels[2000:])
    assert right[np.array(pairs[2000:])].mean() > 0.95


@pytest.mark.parametrize("module, column, folds, out, least", [(toxicity, "toxic", 3, 1, 0.93), (quality, "quality", 4, 2, 0.93)])
def test_held_out_accuracy_and_contract(spark, module, column, folds, out, least):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    model = module.train(docs, labels)
    rows = {r.doc_id: r for r in module.score(docs, model).collect()}
    assert len(rows) == docs.count()
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % folds == out)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    test = [(rows[r.doc_id].predicted, r[column]) for r in labels.collect() if rows[r.doc_id].held_out]
    assert sum(p == y for p, y in test) / len(test) >= least
    # whatever the labels of held-out rows say, the scores stay
    from pyspark.sql import functions as F
    turned = labels.withColumn(column, F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == out, 1 - F.col(column)).otherwise(F.col(column)))
    again = {r.doc_id: r.score for r in module.score(docs, module.train(docs, turned)).collect()}
    assert again == {i: r.score for i, r in rows.items()}


@pytest.mark.parametrize("module", [toxicity, quality])
def test_odd_rows(spark, module):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    model = module.train(docs, labels)
    rows = [(1, None), (2, ""), (None, "idiot"), (3, "word " * 200_000), (4, "same"), (4, "same"), (5, "\n\t é")]
    got = [tuple(r) for r in module.score(frame(spark, rows), model).collect()]
    assert len(got) == len(rows) and all(0 <= r[2] <= 1 for r in got)
    assert got[0][2] == got[1][2] and got[4] == got[5]
    assert module.score(frame(spark, []), model).count() == 0
    none = module.train(frame(spark, []), labels)
    assert {r.score for r in module.score(frame(spark, rows), none).collect()} == {0.5}


def test_a_texts_score_does_not_depend_on_its_neighbours(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    model = quality.train(docs, labels)
    texts = [r.text for r in docs.orderBy("doc_id").limit(30).collect()]
    alone = [float(model.scores(d, o)[0]) for t in texts for _, _, d, o in slices(pa.array([t]))]
    (_, _, d, o), = slices(pa.array(texts), 1 << 30)
    assert np.allclose(alone, model.scores(d, o), atol=1e-6)


def test_the_sample_is_bounded_by_rows_and_bytes(spark):
    docs = frame(spark, [(1, f"text {i}") for i in range(500)] + [(2, "é" * 60), (3, "b"), (3, None), (4, "c"), (None, "d"), (5, "e")])
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 0), (4, 0), (5, 2), (None, 1)], "doc_id long, toxic int")
    sample = lambda n, split=1, longest=1 << 20: sorted(
        tuple(r) for r in labelled_sample(docs.repartition(split), labels, "toxic", 1, 1, n, longest).collect())
    every = sample(9)
    assert [(i, y) for i, y, _ in every] == [(1, 1), (2, 0), (3, 0), (4, 0)] and every == sample(9, 5)
    assert [i for i, _, _ in sample(9, longest=119)] == [1, 3, 4]
    assert sum(y for _, y, _ in sample(1)) == 1 and len(sample(1)) <= 2


def test_toxicity_is_the_sum_over_terms_and_pairs(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    machine = toxicity.train(docs, labels)
    number = {int(t): i for i, t in enumerate(machine.terms)}
    texts = [r.text or "" for r in docs.orderBy("doc_id").limit(40).collect()] + ["", None]
    found = scores(machine, texts)
    for text, got in zip(texts, found):
        (mine,) = terms([text])
        known = sorted(number[int(t)] for t in mine if int(t) in number)
        margin = machine.bias + sum(machine.weights[i] for i in known)
        margin += sum(float(machine.factors[i] @ machine.factors[j]) for i in known for j in known if i < j)
        assert abs(got - 1 / (1 + np.exp(-np.clip(margin, -30, 30)))) < 1e-9


def test_quality_is_the_average_over_words_and_grams(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    model = quality.train(docs, labels)

    def bucket(piece):  # the bucket of one word or n-gram, found by itself
        (_, _, data, offsets), = slices(pa.array([piece]))
        return quality.features(data, offsets)[0]

    for text in ["plain words, twice plain words", "é ab", "", "one"] + [r.text or "" for r in docs.orderBy("doc_id").limit(5).collect()]:
        text = text[:300]
        (_, _, data, offsets), = slices(pa.array([text]))
        values = []
        for word in text.encode().split():
            word = word.decode()
            per_size = bucket(word)  # of a word alone: itself, then its n-grams by size
            size = len(word.encode()) + 2
            assert [len(b) for b, _ in per_size] == [1] + [max(0, size - n + 1) for n in quality.GRAMS]
            values += [float(model.table[b]) for buckets, _ in per_size for b in buckets]
        margin = (sum(values) / len(values) if values else 0.0) + model.bias
        assert abs(float(model.scores(data, offsets)[0]) - 1 / (1 + np.exp(-margin))) < 1e-5
