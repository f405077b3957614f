import math

import numpy as np
import pytest
from pyspark.sql import types as T

from skymetrics.llm import hard_negatives as H

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType()),
                       T.StructField("row", T.StringType()), T.StructField("cell", T.LongType()), T.StructField("v", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, v, c, "x", 1, "y") for i, v, c in rows], SCHEMA)


def brute(rows, anchors=50):
    whole = []
    for i, v, c in rows:
        if None in (i, v, c) or None in v or not all(map(math.isfinite, v)):
            continue
        x = [math.floor(256 * float(a)) for a in v]
        if sum(a * a for a in x) < 1 << 62:
            whole.append((i, int(math.fmod(c + 1, 10)) if i % 7 == 0 else c, x))
    out = []
    for n, (i, c, x) in enumerate(whole):
        if i % anchors:
            continue
        scored = [(-sum(a * b for a, b in zip(x, y)), j, k) for m, (j, k, y) in enumerate(whole) if m != n]
        for p, j, k in sorted(s for s in scored if s[2] == c)[:5]:
            fits = sorted(s for s in scored if s[2] != c and 50 * -p <= 100 * -s[0] <= 95 * -p)[:3]
            out += [(i, j, r + 1, s[1], -p, -s[0]) for r, s in enumerate(fits)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def groups(seed, n, width, scale=1.0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, width))
    return [(i, (scale * (centres[i % 6] + 0.4 * r.normal(size=width))).tolist(), int(r.integers(0, 4))) for i in range(n)]


def odd(width):
    return [(5000, None, 1), (5050, [1.0] * width, None), (None, [1.0] * width, 1), (5100, [None] + [1.0] * (width - 1), 2),
            (5150, [math.nan] * width, 2), (5200, [math.inf] * width, 2), (5250, [0.0] * width, 0), (5300, [], 1), (5350, [2.0], 1),
            (5400, [-1.0] * width, 3), (5450, [1e-9] * width, 2), (-50, [1.0] * width, -3), (-7, [1.0] * width, -11), (5600, [1e200] * width, 1)]


def test_equals_brute_force(spark):
    rows = groups(1, 400, 12)
    rows += odd(12) + rows[:40] + [(50, rows[50][1], 3)] * 3 + [(6000 + i, rows[7][1], i % 4) for i in range(80)]
    assert got(H.hard_negatives(frame(spark, rows))) == brute(rows)


@pytest.mark.parametrize("scale", [1.0, 1e6])  # products beyond 2^53 are whole numbers, too
def test_many_slices_levels_and_blocks(spark, monkeypatch, scale):
    for name, value in (("SLICE_ROWS", 64), ("LEAST_CELLS", 5), ("PIVOT_BYTES", 300), ("FAN", 3), ("LEAF", 4), ("MARKS", 6), ("WAVE", 1), ("ROUND", 7)):
        monkeypatch.setattr(H, name, value)
    rows = groups(2, 500, 8, scale) + [(7000 + i, groups(3, 1, 8, scale)[0][1], i % 3) for i in range(200)]  # a group of copies over many slices
    assert got(H.hard_negatives(frame(spark, rows), anchors=4)) == brute(rows, 4)


def test_cover_tree_covers():
    r = np.random.default_rng(4)
    x = np.vstack([r.normal(size=(700, 5)), np.ones((300, 5))])
    x /= np.linalg.norm(x, axis=1)[:, None]
    labels = r.integers(0, 3, 1000)
    order, nodes = H.cover(x, labels)
    assert sorted(order) == list(range(1000))
    placed = x[order]
    for n in nodes:
        inside = placed[n["begin"]:n["end"]]
        assert (np.arccos(np.clip(inside @ placed[n["centre"]], -1, 1)) <= n["radius"] + 1e-9).all()
        children = nodes[n["child"]:n["child"] + n["children"]]
        if len(children):
            assert children["begin"][0] == n["begin"] and children["end"][-1] == n["end"] and (children["begin"][1:] == children["end"][:-1]).all()
            assert (children["radius"] <= n["radius"] * 2 + 1e-9).all()


def test_descent_skips_nodes_outside_the_window():
    rows = groups(5, 4000, 6)
    x = np.floor(256 * np.array([v for _, v, _ in rows]))
    space = H.Space(6, float(np.sqrt((x * x).sum(1).max())) * (1 + 1e-12))
    labels = np.array([c for *_, c in rows])
    order, nodes = H.cover(space.unit(x), labels)
    tree = H.Tree(space, x[order], np.arange(4000), np.arange(4000), labels[order], nodes)
    q = x[:5]
    scores = (x[order] @ q.T).astype(np.int64)
    high = np.sort(scores, axis=0)[-200]
    low = high - 50
    leaves, upper = tree._leaves(space.unit(tree.vectors[nodes["centre"]]), q, labels[:5], low, high, False)
    assert 0 < (upper > -np.inf).sum() < 0.8 * 5 * (nodes["children"] == 0).sum()
    for j in range(5):
        held = np.concatenate([np.arange(n["begin"], n["end"]) for n in nodes[leaves[upper[j] > -np.inf]]])
        assert set(np.flatnonzero((scores[:, j] >= low[j]) & (scores[:, j] <= high[j]) & (tree.labels != labels[j]))) <= set(held.tolist())


def test_windows_are_the_contract_s():
    scores = np.array([-100, -3, -1, 0, 1, 2, 3, 19, 20, 21, 39, 100, 10**17 + 7])
    for p, low, high in zip(scores.tolist(), *(w.tolist() for w in H.windows(scores))):
        assert 100 * low >= 50 * p > 100 * (low - 1) and 100 * high <= 95 * p < 100 * (high + 1)


def test_empty_tables(spark):
    for rows in ([], [(50, None, 1)], [(51, [1.0], 1), (52, [1.0], 1)], [(50, [1.0], 1)], [(50, [], 1), (51, [], 1), (52, [], 2)]):
        out = H.hard_negatives(frame(spark, rows))
        assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        assert got(out) == brute(rows)
