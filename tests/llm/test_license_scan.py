import random
import re

import pytest
from pyspark.sql import types as T

from skymetrics.llm.license_scan import PHRASES, TEMPLATES, Scanner, scan

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("labels", T.StringType()), T.StructField("score", T.LongType())])
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def base(text):
    w = words(text)
    places = [(i, label) for phrase, label in PHRASES for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def texts(n):
    r = random.Random(4)
    pool = ["MIT", "license", "License,", "apache", "general", "public", "the", "gnu", "é", "foo", "\n", "v2", "mit license general public license"]
    return [" ".join(r.choice(pool) for _ in range(r.randrange(25))) for _ in range(n)]


ROWS = [*enumerate([*texts(200), None, "", "MIT-License! mit\x00license", "mit license " * 3000, "x" * 100_000]), (None, "Apache License"), (1, "same"), (1, "same")]


def test_base_places_equal_brute_force(spark):
    got = sorted((tuple(r)[:6] for r in scan(frame(spark, ROWS)).collect()), key=str)
    assert got == sorted(((i, *base(t)) for i, t in ROWS), key=str)


def test_phrases_of_one_word(spark):
    docs = [(1, "foo gpl bar GPL"), (2, "gpl"), (3, "foo bar"), (4, "foo MIT license gpl"), (5, "foo license")]
    got = sorted(tuple(r)[:6] for r in scan(frame(spark, docs), phrases=[("gpl", "gpl"), ("mit license", "mit")]).collect())
    assert got == [(1, 4, 2, 1, 3, "gpl"), (2, 1, 1, 0, 0, "gpl"), (3, 2, 0, None, None, ""), (4, 4, 2, 1, 3, "gpl,mit"), (5, 2, 0, None, None, "")]


def test_shared_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {r.doc_id: base(r.text) for r in docs.collect()}
    rows = scan(docs).collect()
    assert {r.doc_id: tuple(r)[1:6] for r in rows} == want
    with_notice = {d.doc_id for d in docs.collect() if "CC BY-NC 4.0" in (d.text or "")}
    assert with_notice and all("cc-by-nc" in r.labels.split(",") for r in rows if r.doc_id in with_notice)


def test_empty_table(spark):
    assert scan(frame(spark, [])).count() == 0


def test_matching_statistics_equal_brute_force():
    r = random.Random(8)
    templates = [("a", "a b c a b d"), ("b", "b c a b c e f"), ("c", "a a a a a"), ("d", "e")]
    scanner = Scanner.build([], templates)
    inside = {" ".join(w[i:j]) for _, t in templates for w in [t.split()] for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
    step, link, length = scanner.automaton.step, scanner.automaton.link, scanner.automaton.length
    for _ in range(300):
        text = [r.choice("abcdefg") for _ in range(30)]
        s = n = 0
        for i, c in enumerate(text):
            word = scanner.automaton.words.get(c, -1)
            while s > 0 and word not in step[s]:
                s = link[s]
                n = length[s]
            s = step[s].get(word, 0)
            n = n + 1 if s else 0
            assert n == max((k for k in range(1, i + 2) if " ".join(text[i + 1 - k:i + 1]) in inside), default=0)


@pytest.mark.parametrize("number", [0, 1, 5, 10])
def test_templates_with_gaps_are_covered(spark, number):
    label, text = TEMPLATES[number]
    w = text.split()
    cut = " ".join(["foo", "bar", *w[:len(w) // 2], *["(inserted)"] * (len(w) > 10), *w[len(w) // 2:], "baz"])
    (r,) = scan(frame(spark, [(1, cut)])).collect()
    assert label in r.labels.split(",") and 0.6 <= r.score <= 1
    assert any(s.label == label and s.first_word == 2 for s in r.spans)
    (r,) = scan(frame(spark, [(1, "nothing of this kind here")])).collect()
    assert (r.labels, r.score) == ("", 0.0)


LONG = [i for i, (_, t) in enumerate(TEMPLATES) if len(t.split()) >= 20]


@pytest.mark.parametrize("piece", [5, 9])
def test_a_notice_s_own_words_before_it_do_not_hide_it(spark, piece):
    # the last words of a notice, another word, and the whole notice with a foreign word after every few
    rows, want = [], {}
    for number in LONG:
        label, text = TEMPLATES[number]
        w = text.split()
        pieces = [x for i in range(0, len(w), piece) for x in (*w[i:i + piece], "zzforeign")]
        for tail in (0, 6, 10, 15, 19):
            key = 100 * number + tail
            rows.append((key, " ".join([*w[len(w) - tail:], "zzother", *pieces] if tail else pieces)))
            want[key] = label
    for r in scan(frame(spark, rows)).collect():
        assert want[r.doc_id] in r.labels.split(","), (r.doc_id, r.labels)
        assert max(x.share for x in r.spans if x.label == want[r.doc_id]) >= 0.6


def test_two_notices_in_one_text_are_two_spans(spark):
    text = TEMPLATES[LONG[0]][1]
    (r,) = scan(frame(spark, [(1, f"{text} and elsewhere we say nothing more of it for a while at all so that the gap is wide {text}")])).collect()
    spans = [s for s in r.spans if s.label == TEMPLATES[LONG[0]][0]]
    n = len(text.split())
    assert [(s.first_word, s.words, s.covered) for s in spans if s.words == n] == [(0, n, n), (n + 19, n, n)]


def test_long_texts_of_one_notice_s_words_are_scanned_in_time(spark):
    import time

    text = TEMPLATES[LONG[0]][1]
    begin = time.time()
    assert scan(frame(spark, [(1, (text + " ") * 2000), (2, " ".join(text.split()[:8]) * 20_000)])).count() == 2
    assert time.time() - begin < 60
