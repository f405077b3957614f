import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skymetrics.llm.exact_dedup import exact_dedup, name_texts

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("name", T.StringType()), T.StructField("h1", T.LongType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 7) for i, t in rows], SCHEMA)


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=str)


ROWS = [(1, "abcdefgh" * 5), (2, "abcdefgh" * 5), (3, None), (4, ""), (5, "abcdefgh" * 4 + "abcdefgx"),
        (6, "é" * 33), (7, "é" * 33), (8, "x"), (9, "abcdefgh"), (9, "abcdefgh"), (10, "abcdefgh" * 2),
        (None, "n"), (None, "abcdefgh"), (11, "y" * 500), (12, "y" * 500), (13, "y" * 499)]


@pytest.mark.parametrize("block", [4, 7, 4096])
def test_equals_brute_force(spark, block):
    assert got(exact_dedup(frame(spark, ROWS), block)) == expected(ROWS)


def test_blocks_that_share_a_digest_are_told_apart(spark):
    weak = lambda b: (F.octet_length(b).cast("long"), F.lit(0).cast("long"))
    assert got(exact_dedup(frame(spark, ROWS), 8, weak)) == expected(ROWS)


def test_names_are_one_per_text(spark):
    names = name_texts(frame(spark, ROWS), 8).collect()
    assert len({(r.n_blocks, r.name) for r in names}) == len({t or "" for _, t in ROWS})


def test_empty_table(spark):
    assert exact_dedup(frame(spark, [])).count() == 0
