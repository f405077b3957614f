import random
import re
from collections import Counter

import pytest
from pyspark.sql import types as T

from skymetrics.llm.substring_dedup import levels, remove_repeats

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("part", T.StringType()), T.StructField("hash", T.LongType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)


def brute(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r)[:4] for r in df.collect()), key=str)


def rows(seed):
    r = random.Random(seed)
    pool = ["a", "b", "é", "d,", "e"]
    passages = [" ".join(r.choice(pool) for _ in range(r.randrange(4, 20))) for _ in range(3)]
    out = [(i, r.choice(["\n", " ", "\t "]).join(r.choice([*pool, *(f"w{r.randrange(99)}" for _ in range(9)), r.choice(passages)]) for _ in range(r.randrange(30))))
           for i in range(60)]
    return out + [(None, passages[0]), (60, None), (61, ""), (62, "x " * 3000), (63, " ".join(f"n{i}" for i in range(3000))),
                  (64, "same row " * 9), (64, "same row " * 9), (64, "another " + passages[1])]


@pytest.mark.parametrize("window, shortest", [(7, 2), (5, 17), (12, 5), (20, 2)])
def test_equals_brute_force(spark, window, shortest):
    data = rows(window)
    assert got(remove_repeats(frame(spark, data), window, shortest)) == brute(data, window)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    data = [(r.doc_id, r.text) for r in docs.collect()]
    out = remove_repeats(docs, keep=("lang",))
    assert got(out) == brute(data, 35)
    assert {r.doc_id: r.lang for r in out.collect()} == {r.doc_id: r.lang for r in docs.collect()}


def test_levels_at_most_double():
    for window in range(1, 200):
        found = levels(window, 4)
        assert found[-1] == window and all(a < b <= 2 * a for a, b in zip(found[:-1], found[1:]))


def test_the_search_starts_short_and_doubles():
    assert levels(35) == [9, 18, 35] and levels(50) == [13, 25, 50]


def test_repeats_of_every_length_up_to_the_window_and_beyond(spark):
    r = random.Random(9)
    fresh = lambda n: [f"u{r.randrange(10**9)}" for _ in range(n)]
    data = []
    for n in (5, 8, 9, 10, 17, 18, 19, 26, 34, 35, 36, 52, 70, 71):
        passage = fresh(n)
        data += [(len(data) + k, " ".join(fresh(r.randrange(40)) + passage + fresh(r.randrange(40)))) for k in range(3)]
    out = remove_repeats(frame(spark, data))
    assert got(out) == brute(data, 35)
    assert {x.n_removed for x in out.collect()} == {0, 35, 36, 52, 70, 71}


def test_empty_table(spark):
    assert remove_repeats(frame(spark, [])).count() == 0
