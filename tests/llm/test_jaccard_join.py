import random
import re

import numpy as np
import pytest
from pyspark.sql import types as T

from skymetrics.llm import jaccard_join as J
from skymetrics.llm.components import components

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("hash", T.StringType()), T.StructField("part", T.LongType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)


def shingle_sets(rows, width):
    out = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append({tuple(w[k:k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    return out


def brute(rows, width, percent):
    sets = shingle_sets(rows, width)
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                top[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        key = (doc is not None, doc or 0)
        least[find(i)] = min(least.get(find(i), key), key)
    return sorted(((doc, len(s), least[find(i)][1] if least[find(i)][0] else None) for i, ((doc, _), s) in enumerate(zip(rows, sets))), key=str)


def got(df):
    return sorted((tuple(r)[:3] for r in df.collect()), key=str)


def rows(seed, groups=5, each=14):
    r = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [f"w{r.randrange(500)}" for _ in range(r.choice([6, 30, 90, 200]))]
        for _ in range(each):
            w = list(base)
            for _ in range(r.randrange(0, max(2, len(w) // 15))):
                at = r.randrange(len(w))
                w[at:at + 1] = r.choice([[], ["new", f"n{r.randrange(99)}"], [f"n{r.randrange(99)}"]])
            out.append(" ".join(w).upper() if r.random() < 0.2 else "\n".join(w))
    r.shuffle(out)
    return [*enumerate(out), (None, out[0]), (900, None), (901, ""), (902, " \t"), (903, "one two"), (904, "One  TWO"), (905, "é É"),
            (906, "long " * 4000), (907, "same row again and again here"), (907, "same row again and again here"), (907, "other words under one id")]


@pytest.mark.parametrize("width, percent, block, groups, each", [(4, 85, 256, 4, 60), (3, 70, 4, 5, 14)])
def test_equals_brute_force(spark, monkeypatch, width, percent, block, groups, each):
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "FOLD", 1 if block < 9 else 32)
    data = rows(width, groups, each)
    assert got(J.jaccard_join(frame(spark, data).repartition(11), width, percent)) == brute(data, width, percent)


@pytest.mark.parametrize("head", [1024, 3])
def test_copies_are_one_set(spark, monkeypatch, head):
    monkeypatch.setattr(J, "HEAD", head)
    one, other = (" ".join(f"{c}{i % 37}" for i in range(n)) for c, n in (("a", 60), ("b", 50)))
    data = [*((i, one if i % 3 else one.upper() + " ") for i in range(5, 200)), (300, one + " end"), (301, other), (302, other), (None, ""), (2, "")]
    r = J.jaccard_join(frame(spark, data).repartition(7), 4, 85)
    assert got(r) == brute(data, 4, 85)
    assert r.filter("kept").count() == 4


def test_a_task_sends_equal_sets_once():
    sender = J._Sender(3)
    owners, keys = np.zeros(50, J.OWNER), np.zeros(100, J.KEY)
    owners["id"], owners["first"], owners["n"] = np.arange(50), np.arange(50) % 2, 7
    keys["key"], keys["first"], keys["n"] = np.arange(100) % 4, np.arange(100) % 2, 7
    list(sender.add(keys, owners, [b"x" * 8] * 50))
    sent = [x for batch in sender.send() for x in batch.to_pylist()]
    of = lambda kind, dtype: np.concatenate([np.frombuffer(x["records"], dtype) for x in sent if x["kind"] == kind])
    assert len(of(J.KEYS, J.KEY)) == 4 and len(of(J.OWNERS, J.OWNER)) == 50
    assert sum(x["kind"] == J.SKETCHES for x in sent) == 2


@pytest.mark.parametrize("n_words", [1, 1 << 20])
def test_filter_lets_all_wanted_rows_through(spark, monkeypatch, n_words):
    monkeypatch.setattr(J, "FILTER_WORDS", n_words)
    rows = spark.range(4000).selectExpr("named_struct('id', id, 'hash', xxhash64(id), 'more', 0L) AS row")
    wanted = rows.filter("row.id % 10 = 0")
    kept = {r.row.id for r in J._may_be_in(rows, wanted).collect()}
    assert set(range(0, 4000, 10)) <= kept and (len(kept) < 410 or n_words == 1)


def test_empty_table(spark):
    assert J.jaccard_join(frame(spark, [])).count() == 0


def test_linked_sets_share_a_chunk():
    r = random.Random(2)
    for percent in (80, 85, 95):
        for _ in range(400):
            n = r.choice([1, 3, 8, 20, 60, 300])
            a = {r.getrandbits(64) for _ in range(n)}
            most = n * (100 - percent) // 100
            gone = r.randrange(most + 1)
            b = set(list(a)[gone:]) | {r.getrandbits(64) for _ in range(r.randrange(most - gone + 1))}
            if not b or 100 * len(a & b) < percent * len(a | b):
                continue
            keys = np.concatenate([np.sort(np.array(list(s), np.uint64)) for s in (a, b)])
            sizes = np.array([len(a), len(b)])
            found, of = J.chunk_keys(keys, np.repeat([0, 1], sizes), sizes, percent)
            assert set(found[of == 0]) & set(found[of == 1])


@pytest.mark.parametrize("percent", [30, 50, 70, 76, 80, 85])
def test_linked_sets_share_a_chunk_when_given_apart(percent):
    r = np.random.default_rng(percent)
    keys_of = lambda *sets: J.chunk_keys(np.concatenate([np.sort(s) for s in sets]), np.repeat(np.arange(len(sets)), list(map(len, sets))),
                                         np.array(list(map(len, sets))), percent)
    missed, other = [], []
    for edge in J.bands(12_000).tolist():
        for n in {max(1, edge - 1), edge, edge + 1}:
            a = r.integers(1 << 64, size=n, dtype=np.uint64)
            alone, _ = keys_of(a)
            for m in {min(edge + 1, 100 * n // percent), 100 * n // percent}:
                b = np.concatenate([a, r.integers(1 << 64, size=max(0, m - n), dtype=np.uint64)])
                if not set(alone) & set(keys_of(b)[0]):
                    missed.append((n, len(b)))
            found, of = keys_of(a, r.integers(1 << 64, size=3 * n, dtype=np.uint64))
            if not np.array_equal(np.sort(alone), np.sort(found[of == 0])):
                other.append(n)
    assert not missed and not other, f"{len(missed)} linked pairs share no chunk, {len(other)} sets have other chunks next to a larger one: {missed[:9]}"


def test_components(spark):
    r = random.Random(5)
    for n, m in ((40, 30), (200, 150), (30, 200)):
        edges = [(r.randrange(n), r.randrange(n)) for _ in range(m)] + [(1000, 1000 + i) for i in range(50)] + [(2000 + i, 2001 + i) for i in range(40)]
        top = {x: x for e in edges for x in e}

        def find(x):
            while top[x] != x:
                x = top[x]
            return x

        for a, b in edges:
            a, b = find(a), find(b)
            top[max(a, b)] = min(a, b)
        found = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert found == {x: find(x) for x in top if find(x) != x}


def test_rows_of_one_id_with_equal_short_hashes(spark, monkeypatch):
    from pyspark.sql import functions as F

    from skymetrics.llm import exchange
    from skymetrics.llm.substring_dedup import remove_repeats

    real = exchange.row_hash
    monkeypatch.setattr(exchange, "row_hash", lambda: F.struct(F.lit(5).cast("long").alias("hash"), real()["more"].alias("more")))
    one, two = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    docs = spark.createDataFrame([(None, one), (None, two), (3, one), (-(1 << 63), two + " x")], "doc_id long, text string")
    out = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in J.jaccard_join(docs, 5, 80).collect())
    assert [r[1] for r in out] == [37, 36, 36, 36] and len(set(r[2] for r in out)) <= 3
    cut = {(r.doc_id, r.n_words): r.n_removed for r in remove_repeats(docs.filter("doc_id IS NULL OR doc_id = 3")).collect()}
    removed = sorted((str(r.doc_id), r.n_removed) for r in remove_repeats(docs.filter("doc_id IS NULL OR doc_id = 3")).collect())
    assert removed == [("3", 40), ("None", 0), ("None", 40)] and cut


def test_ids_that_are_no_integers_are_refused(spark):
    with pytest.raises(TypeError):
        J.jaccard_join(spark.createDataFrame([("x", "a")], "doc_id string, text string"))


def test_many_rows_without_an_id_stay_apart(spark):
    from pyspark.sql import functions as F

    from skymetrics.llm import exchange

    docs = spark.range(300_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    assert exchange.with_row_key(docs, 4).select("id", "hash", "more").distinct().count() == 300_000
