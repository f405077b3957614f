"""URL filter: rules first, then naive Bayes over segmented hosts.

Names run together in hosts (``cheappills``) are split by a unigram Viterbi
search; the unigrams are counted over all urls, from words that stand alone
there (words of paths and of hyphenated names).  A multinomial naive Bayes model
then scores host and path tokens.  It learns from the urls themselves: those
whose host holds a word of a given list are its block class, all others its
allow class, and the counts of both cover every url.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymetrics.llm.staging import stage

#: fixed values: rules of the contract, as (verdict, host and path)
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
#: words that mark a host for the block class
BLOCK_WORDS = ["ads", "adserver", "bets", "casino", "lottery", "malware", "phishing", "pills", "poker", "porn", "spam", "viagra", "warez", "xxx"]
#: each of them counts as seen this often, so that it is known where it never stands alone
WORD_COUNT = 10
#: long names are cut into parts that start this far apart, so that a place of a name costs no more for its length
STRIDE = 256


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """``host`` and ``path`` columns; a url that is NULL or without ``://`` has empty ones."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return pages.withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})


def rule_columns(rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(the longest rule that fits, its verdict), NULL without one; of equally long rules the first in the alphabet."""
    rule = verdict = F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(slash + path))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def _parts(host: Column) -> Column:
    """Names of a host: letters and digits between other characters, without the last label."""
    labels = F.split(host, r"\.")
    names = F.split(F.array_join(F.slice(labels, 1, F.greatest(F.size(labels) - 1, F.lit(1))), "."), "[^a-z0-9]+")
    return F.filter(names, lambda x: x != "")


def _hyphenated(host: Column) -> Column:
    """Names of a host's labels that hold a hyphen or another such character."""
    labels = F.filter(F.split(host, r"\."), lambda x: x.rlike("[a-z0-9][^a-z0-9]+[a-z0-9]"))
    return F.filter(F.flatten(F.transform(labels, lambda x: F.split(x, "[^a-z0-9]+"))), lambda x: x != "")


def _path_words(path: Column) -> Column:
    """Words of a path, lower-cased; numbers are one word."""
    words = F.split(F.translate(path, string.ascii_uppercase, string.ascii_lowercase), r"[^a-z0-9\x{80}-\x{10FFFF}]+")
    return F.transform(F.filter(words, lambda x: x != ""), lambda x: F.when(x.rlike("^[0-9]+$"), F.lit("0")).otherwise(x))


def segment(name: str, found: dict[tuple[int, int], float], total: float) -> list[str]:
    """The most likely words of ``name``: ``found`` has log probabilities of known words by place, others cost by length."""
    ending: list[list[tuple[int, float]]] = [[] for _ in range(len(name) + 1)]
    for (i, j), p in found.items():
        ending[j].append((i, p))
    letter = math.log(10)
    best: list[tuple[float, int]] = [(0.0, 0)]
    # an unknown word costs a constant and its letters: the best start so far is best for every end
    start = (0.0, 0)
    for j in range(1, len(name) + 1):
        unknown = (start[0] + math.log(10 / total) - j * letter, start[1])
        p, i = max([unknown, *((best[i][0] + p, -i) for i, p in ending[j])])
        best.append((p, -i))
        start = max(start, (p + j * letter, -j))
    out, j = [], len(name)
    while j:
        i = best[j][1]
        out.append(name[i:j])
        j = i
    return out[::-1]


def _segmented(names: DataFrame, words: DataFrame, total: float) -> DataFrame:
    """(name, tokens) for distinct names: their substrings are joined with the word counts, then searched.

    Substrings are looked at in the lengths that words have, and go under a
    fixed-size digest of their name.
    """
    longest = names.agg(F.max(F.length("name"))).first()[0] or 0
    lengths = words.filter(F.length("word") <= longest).agg(F.array_sort(F.collect_set(F.length("word")))).first()[0]
    names = names.withColumn("digest", F.sha2("name", 256))
    most = max(lengths, default=0)
    spots = (
        names.withColumn("part", F.explode(F.expr(f"sequence(0, (length(name) - 1) div {STRIDE})").cast("array<int>")))
        .select("digest", (F.col("part") * STRIDE).alias("from"), F.expr(f"substring(name, part * {STRIDE} + 1, {STRIDE + most})").alias("text"))
        .withColumn("at", F.explode(F.sequence(F.lit(0), F.least(F.lit(STRIDE), F.length("text")) - 1)))
        .withColumn("n", F.explode(F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("text") - F.col("at"))))
        .select("digest", (F.col("from") + F.col("at")).alias("i"), "n", F.expr("substring(text, at + 1, n)").alias("word"))
    )
    known = spots.join(words, "word").select("digest", F.struct("i", (F.col("i") + F.col("n")).alias("j"), F.log(F.col("n_seen") / total).alias("p")).alias("spot"))
    spots_of = known.groupBy("digest").agg(F.collect_list("spot").alias("spots"))

    @F.pandas_udf("array<string>")
    def search(name: pd.Series, spots: pd.Series) -> pd.Series:
        return pd.Series([segment(n, {} if s is None else {(x["i"], x["j"]): x["p"] for x in s}, total)
                          for n, s in zip(name, spots, strict=True)])

    return names.join(spots_of, "digest", "left").select("name", search("name", "spots").alias("tokens"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, block_words: Sequence[str] = BLOCK_WORDS) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score, tokens.

    ``score`` is the model's log odds of block; without a rule, a page is
    blocked if it is above 0.  A url without a host has no tokens and the odds
    of the class sizes.  A NULL page_id is carried along, repeated rows are
    judged each, an empty table gives an empty result; of equally likely cuts
    of a name that with the longest last word is taken; hosts, paths and words may have any
    length.  Only page_id and url are read, whatever the other columns' names.
    """
    spark = pages.sparkSession
    rows = stage(with_host_and_path(pages.select("page_id", "url")).select("page_id", "host", "path"), "urls")
    urls = stage(rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")), "distinct_urls")
    seeds = spark.createDataFrame([(w, WORD_COUNT) for w in sorted(set(block_words))], "word string, n_seen long")
    alone = (
        urls.select(F.explode(F.concat(_path_words(F.col("path")), _hyphenated(F.col("host")))).alias("word"), "n")
        .groupBy("word").agg(F.sum("n").alias("n_seen"))
    )
    words = stage(alone.unionByName(seeds).groupBy("word").agg(F.sum("n_seen").alias("n_seen")), "words")
    total = float(words.agg(F.sum("n_seen")).first()[0])
    hosts = stage(urls.groupBy("host").agg(F.sum("n").alias("n")).withColumn("names", _parts(F.col("host"))), "hosts")
    names = hosts.select(F.explode("names").alias("name")).distinct()
    segmented = stage(_segmented(names, words, total), "segmented")
    tokens = stage(
        hosts.select("host", "n", F.explode("names").alias("name")).join(segmented, "name")
        .select("host", "n", F.explode("tokens").alias("token")), "host_tokens")
    marked = stage(
        hosts.select("host", "n").join(
            tokens.filter(F.col("token").isin(list(set(block_words)))).select("host").distinct().withColumn("marked", F.lit(1)), "host", "left")
        .withColumn("marked", F.coalesce("marked", F.lit(0))), "marked")
    path_tokens = urls.select("host", "path", "n", F.explode(_path_words(F.col("path"))).alias("token"))
    seen = (
        tokens.select("host", "token", "n").unionByName(path_tokens.select("host", "token", "n"))
        .join(marked.select("host", "marked"), "host")
        .groupBy("token").agg(F.sum(F.col("n") * F.col("marked")).alias("in_block"), F.sum(F.col("n") * (1 - F.col("marked"))).alias("in_allow"))
    )
    counts = stage(seen, "token_counts")
    sums = counts.agg(F.sum("in_block"), F.sum("in_allow"), F.count(F.lit(1))).first()
    n_block, n_allow, kinds = (float(x or 0) for x in sums)
    sizes = marked.agg(F.sum(F.col("n") * F.col("marked")), F.sum("n")).first()
    blocked, all_ = (float(x or 0) for x in sizes)
    prior = math.log((blocked + 1) / (all_ - blocked + 1))
    odds = stage(counts.select("token", (
        F.log((F.col("in_block") + 1) / (n_block + kinds)) - F.log((F.col("in_allow") + 1) / (n_allow + kinds))).alias("odds")), "odds")
    of_host = tokens.join(odds, "token").groupBy("host").agg(F.sum("odds").alias("host_odds"), F.array_sort(F.collect_set("token")).alias("tokens"))
    of_path = path_tokens.join(odds, "token").groupBy("host", "path").agg(F.sum("odds").alias("path_odds"))
    rule, verdict = rule_columns(rules)
    score = F.round(prior + F.coalesce("host_odds", F.lit(0.0)) + F.coalesce("path_odds", F.lit(0.0)), 9)
    judged = stage(
        urls.join(stage(of_host, "host_odds"), "host", "left").join(stage(of_path, "path_odds"), ["host", "path"], "left")
        .withColumns({"score": score, "rule": rule, "said": verdict, "tokens": F.coalesce("tokens", F.array().cast("array<string>"))})
        .select("host", "path", "rule", F.coalesce("said", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"), "score", "tokens"),
        "judged")
    return rows.join(judged, ["host", "path"]).select("page_id", "host", "path", "rule", "verdict", "score", "tokens")
