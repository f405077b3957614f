import math

import numpy as np
import pytest
from pyspark.sql import types as T

from skymetrics.llm.embedding_dedup import hadamard, near_duplicates, tables_for

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("rep", T.LongType()), T.StructField("copies", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)


def brute(rows):
    unit = {}
    for n, (i, v) in enumerate(rows):
        if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v):
            x = np.array(v, np.float32).astype(np.float64)
            unit[n] = x / np.linalg.norm(x)
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    links = [0] * len(rows)
    for a in unit:
        for b in unit:
            if a != b and len(unit[a]) == len(unit[b]) and float(unit[a] @ unit[b]) >= 0.9:
                links[a] += 1
                top[find(a)] = find(b)
    out = []
    for n, (i, _) in enumerate(rows):
        c = min((rows[m][0] for m in range(len(rows)) if find(m) == find(n) and rows[m][0] is not None), default=None)
        out.append((i, links[n], c if i is not None else None, i is not None and c == i))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def clusters(seed, groups, each, low, high):
    r = np.random.default_rng(seed)
    out = []
    for _ in range(groups):
        base = r.normal(size=64)
        base /= np.linalg.norm(base)
        for _ in range(each):
            noise = r.normal(size=64)
            noise -= (noise @ base) * base
            noise /= np.linalg.norm(noise)
            c = r.uniform(low, high)
            out.append((c * base + math.sqrt(1 - c * c) * noise).astype(np.float32).tolist())
    return out


def test_equals_brute_force_where_copies_are_close(spark):
    vectors = clusters(1, 12, 9, 0.985, 1.0) + clusters(2, 150, 1, 1.0, 1.0)
    rows = list(enumerate(vectors)) + [(1000, vectors[0]), (1001, vectors[0]), (1002, None), (1003, []), (1004, [0.0] * 64), (None, vectors[3]),
                                       (1005, [float("nan")] * 64), (1006, [None] + [1.0] * 63), (1007, [float("inf")] + [1.0] * 63),
                                       (1008, [1.0, 2.0, 2.0]), (1009, [2.0, 4.0, 4.0]), (1010, [1e-30] * 64), (1011, [3e30] * 64)]
    assert got(near_duplicates(frame(spark, rows))) == brute(rows)


def test_recall_near_the_limit(spark):
    rows = list(enumerate(clusters(3, 60, 4, 0.955, 0.965) + clusters(4, 300, 1, 1.0, 1.0)))
    want = {r[0]: r for r in brute(rows)}
    have = {r[0]: r for r in got(near_duplicates(frame(spark, rows)))}
    total = sum(r[1] for r in want.values())
    assert total > 300 and all(have[i][1] <= want[i][1] for i in want)
    assert sum(r[1] for r in have.values()) >= 0.9 * total


def test_hadamard_is_the_matrix():
    h = np.array([[1.0]])
    while len(h) < 16:
        h = np.block([[h, h], [h, -h]])
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(hadamard(x), x @ h / 4)


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [])).count() == 0


def test_rows_of_one_id_with_unlike_vectors(spark):
    vectors = clusters(5, 3, 1, 1.0, 1.0)
    rows = [(1, vectors[0]), (1, vectors[1]), (2, vectors[2]), (3, vectors[2]), (1, vectors[0]), (0, vectors[1])]
    out = got(near_duplicates(frame(spark, rows)))
    assert out == sorted([(1, 1, 1, True), (1, 1, 1, True), (1, 1, 0, False), (0, 1, 0, True), (2, 1, 2, True), (3, 1, 2, False)], key=str)


@pytest.mark.parametrize("hashes", [1, 3, 4, 5, 6])
def test_recall_whatever_the_number_of_hashes(spark, hashes):
    # pairs at exactly the limit, the hardest ones
    r = np.random.default_rng(hashes)
    x, z = r.normal(size=(2, 200, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z -= np.einsum("ij,ij->i", x, z)[:, None] * x
    z /= np.linalg.norm(z, axis=1)[:, None]
    y = 0.9001 * x + math.sqrt(1 - 0.9001 ** 2) * z
    rows = list(enumerate(np.vstack([x, y]).astype(np.float32).tolist()))
    want = sum(r[1] for r in brute(rows))
    have = sum(r[1] for r in got(near_duplicates(frame(spark, rows), hashes=hashes)))
    assert want == 400 and 0.94 * want <= have <= want


def test_tables_grow_with_hashes_and_width():
    counts = {(w, h): tables_for(w, h, 0.9) for w in (64, 384, 768) for h in (2, 4, 6)}
    assert all(counts[w, 2] < counts[w, 4] < counts[w, 6] for w in (64, 384, 768))
    assert all(counts[64, h] <= counts[384, h] <= counts[768, h] for h in (2, 4, 6))
    assert tables_for(64, 1, 1.0) == 1
