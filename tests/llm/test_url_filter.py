import math
import random
import re
from collections import Counter

from pyspark.sql import types as T

from skymetrics.llm import url_filter
from skymetrics.llm.url_filter import BLOCK_WORDS, RULES, WORD_COUNT, judge, segment

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                       T.StructField("host", T.StringType()), T.StructField("score", T.LongType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, u, "x", 1) for i, u in rows], SCHEMA)


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def cut(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    return lower(host), re.match("[^?#]*", rest[len(host):])[0]


def rule(host, path):
    best = None
    for verdict, text in RULES:
        h, _, p = text.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(text) > len(best[1])):
            best = (verdict, text)
    return best


def brute(rows):
    cuts = [cut(u) for _, u in rows]
    path_words = lambda p: ["0" if re.fullmatch("[0-9]+", w) else w for w in re.split(r"[^a-z0-9\x80-\U0010ffff]+", lower(p)) if w]
    split = lambda s: [w for w in re.split("[^a-z0-9]+", s) if w]
    def parts(host):
        labels = host.split(".")
        return split(".".join(labels[:max(1, len(labels) - 1)]))
    words = Counter({w: WORD_COUNT for w in BLOCK_WORDS})
    for host, path in cuts:
        words.update(path_words(path))
        for label in host.split("."):
            if re.search("[a-z0-9][^a-z0-9]+[a-z0-9]", label):
                words.update(split(label))
    total = sum(words.values())
    def tokens(host):
        out = []
        for name in parts(host):
            found = {(i, j): math.log(words[name[i:j]] / total) for i in range(len(name)) for j in range(i + 1, len(name) + 1) if name[i:j] in words}
            out += segment(name, found, total)
        return out
    bags = [(tokens(h), path_words(p)) for h, p in cuts]
    marked = [any(t in BLOCK_WORDS for t in a) for a, _ in bags]
    seen = {True: Counter(), False: Counter()}
    for (a, b), m in zip(bags, marked):
        seen[m].update(a + b)
    kinds = len(set(seen[True]) | set(seen[False]))
    odds = lambda t: math.log((seen[True][t] + 1) / (sum(seen[True].values()) + kinds)) - math.log((seen[False][t] + 1) / (sum(seen[False].values()) + kinds))
    prior = math.log((sum(marked) + 1) / (len(rows) - sum(marked) + 1))
    out = []
    for (i, _), (h, p), (a, b) in zip(rows, cuts, bags):
        score, said = prior + sum(map(odds, a + b)), rule(h, p)
        out.append((i, h, p, said and said[1], said[0] if said else "block" if score > 0 else "allow", round(score, 6)))
    return sorted(out, key=str)


def got(spark, rows):
    return sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, round(r.score, 6)) for r in judge(frame(spark, rows)).collect()), key=str)


def test_equals_brute_force(spark):
    rows = [(r.page_id, r.url) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    rows += [(None, "http://A.NET"), (7, None), (7, None), (8, "no host"), (9, ""), (10, "x://net/?q"), (11, "x://NET/a#b"), (12, "x://example.net/en"),
             (13, "x://example.net/en/"), (14, "x://my.example.com/de/1?x"), (15, "x://notorg/fr/"), (16, "x://cheappills.info/buy"),
             (17, "http://" + "freebets" * 40 + ".biz/" + "long/" * 500), (18, "://"), (19, "a://b://c")]
    assert got(spark, rows) == brute(rows)


def test_names_run_together_are_split(spark):
    rows = [(i, f"http://cheap-pills.example.com/en/{i}") for i in range(5)] + [(i, f"http://garden{i}.example.org/en/{i}") for i in range(5, 60)]
    rows += [(100, "http://www.cheappills.example.org/en/4")]
    r = {r.page_id: r for r in judge(frame(spark, rows)).collect()}
    assert {"cheap", "pills"} <= set(r[100].tokens) and r[100].verdict == "block" and r[7].verdict == "allow"


def test_segment_takes_the_likeliest_words():
    p = {"now": 5, "here": 5, "nowhere": 3, "no": 8, "where": 4}
    name, total = "nowhere", 25.0
    found = {(i, j): math.log(p[name[i:j]] / total) for i in range(7) for j in range(i + 1, 8) if name[i:j] in p}
    assert segment(name, found, total) == ["nowhere"]
    del found[(0, 7)]
    assert segment(name, found, total) == ["no", "where"]
    assert segment("", {}, 1.0) == []


def test_long_words_and_names_are_whole(spark):
    known, unknown = "donaudampfschifffahrtsgesellschaft", "q" * 700
    rows = [(i, f"http://a{i}.example.org/{known}/x") for i in range(9)]
    rows += [(20, f"http://cheap{known}{unknown}.example.org/"), (21, f"http://{'n' * 250}{known}.example.org/")]
    r = {r.page_id: r for r in judge(frame(spark, rows)).collect()}
    assert known in r[20].tokens and unknown in r[20].tokens and known in r[21].tokens
    assert got(spark, rows) == brute(rows)


def test_segment_equals_a_search_over_all_starts():
    def slow(name, found, total):
        best = [(0.0, ())]
        for j in range(1, len(name) + 1):
            best.append(max((best[i][0] + found.get((i, j), math.log(10 / total) - (j - i) * math.log(10)), best[i][1] + (i,)) for i in range(j)))
        return best[-1][0]
    r = random.Random(5)
    for _ in range(200):
        name, total = "".join(r.choice("ab") for _ in range(r.randrange(1, 40))), 1000.0
        found = {(i, j): math.log(r.randrange(1, 50) / total) for i in range(len(name)) for j in range(i + 1, len(name) + 1) if r.random() < 0.05}
        cut, cost, at = segment(name, found, total), 0.0, 0
        for word in cut:
            cost += found.get((at, at + len(word)), math.log(10 / total) - len(word) * math.log(10))
            at += len(word)
        assert "".join(cut) == name and abs(cost - slow(name, found, total)) < 1e-9


def test_empty_table(spark):
    assert url_filter.judge(frame(spark, [])).count() == 0
