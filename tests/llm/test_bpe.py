import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import types as T
from tokenizers import Tokenizer

from skymetrics.llm import byte_bpe, packing

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
VOCAB = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("ids", T.StringType()), T.StructField("length", T.LongType())])
PARTS = ["'", "s", "t", "re", "ve", "ll", " ", "  ", "\n", "\r\n", "!", "é", "日本", "1", "²", "　", "\x1c", "​",
         "'s", "'S", "😀", "́", "_", "Ⅷ", "﻿", "idiot ", "<|endoftext|>"]


def texts(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randrange(15))) for _ in range(n)]


def frame(spark, values):
    return spark.createDataFrame([(i, t, "x", 3) for i, t in enumerate(values)], SCHEMA)


VALUES = [*texts(300), None, "", "word " * 6000, " " * 3000, "a" * 5000, "same", "same"]


def test_ids_are_tiktokens_and_decode_to_the_bytes(spark):
    tokens = byte_bpe.read_ranks(RANKS)
    reference = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    want = {i: reference.encode_ordinary(t or "") for i, t in enumerate(VALUES)}
    encoded = byte_bpe.encode(frame(spark, VALUES), RANKS)
    assert {r.doc_id: r.ids for r in encoded.collect()} == want
    assert {r.doc_id: r.text for r in byte_bpe.decode(encoded, RANKS).collect()} == {i: t or "" for i, t in enumerate(VALUES)}
    for r in byte_bpe.round_trip(frame(spark, VALUES), RANKS).collect():
        assert r.n_tokens == len(want[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(np.array(want[r.doc_id], "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((VALUES[r.doc_id] or "").encode()).hexdigest()


def test_every_token_encodes_to_itself():
    tokens = byte_bpe.read_ranks(RANKS)
    vocabulary = byte_bpe.Vocabulary(tokens)
    pieces = [t.decode("latin-1").translate(vocabulary.letters) for t in tokens]
    assert [vocabulary.whole.get(p, ids) for p, ids in zip(pieces, vocabulary.model.encode(pieces))] == [[i] for i in range(len(tokens))]


def test_empty_tables(spark):
    assert byte_bpe.round_trip(frame(spark, []), RANKS).count() == 0
    assert packing.pack(frame(spark, []), VOCAB).count() == 0


@pytest.mark.parametrize("capacity", [2048, 100])
def test_packing_places_every_id_once(spark, capacity):
    library = Tokenizer.from_file(VOCAB)
    want = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(VALUES)}
    rows = packing.pack(frame(spark, VALUES), VOCAB, capacity=capacity, with_ids=True).collect()
    got: dict = {}
    sequences: dict = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == len(got.setdefault(r.doc_id, [])) and r.length == len(r.ids) > 0 and r.doc_tokens == len(want[r.doc_id])
        got[r.doc_id] += r.ids
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == want
    assert sorted(sequences) == list(range(len(sequences)))
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    total = sum(map(len, want.values()))
    assert len(sequences) * capacity <= total * 1.05 + capacity


@pytest.mark.parametrize("n", [0, 1, 63, 64, 1024, 1500, 2047, 2048, 9000])
def test_cut_lengths(n):
    cut = packing.cut_lengths(n)
    assert sum(cut) == n and all(0 < x <= 2048 for x in cut)
