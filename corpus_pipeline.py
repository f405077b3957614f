"""A corpus cleaning pipeline over the operators of ``skymetrics.llm``.

Toxic documents go, then exact copies, then near copies; passages that repeat
are cut out of what is left, and the rest is packed into token sequences.  Each
stage reads what the one before it wrote; all but the last return the columns
of ``documents``.

NULL and empty texts, NULL and repeated ids, very long texts and further columns
of any name go through every stage as its operator's docstring says: rows that
share an id are told apart by 128 bits or more of hashes of their texts, and
rows equal in id and text are one document after the second stage.  doc_id is an
integer.  An empty table gives empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skymetrics.llm import exact_dedup as exact
from skymetrics.llm import exchange, jaccard_join, packing, substring_dedup
from skymetrics.llm import toxicity as toxic
from skymetrics.llm.staging import stage

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _only(docs: DataFrame, decided: DataFrame, name: Column) -> DataFrame:
    """The documents that ``decided`` (row, kept) keeps, each once; ``name`` of their columns is what ``row`` holds.

    The documents travel as one struct, so no column of theirs can clash with another.
    """
    kept = decided.filter("kept").select("row")
    rows = docs.select(name.alias("row"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    return rows.dropDuplicates(["row"]).join(kept, "row", "left_semi").select("doc.*")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores 0.7 or more go; it learns from the labelled ones among ``docs``."""
    return toxic.reject(docs, toxic.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (NULL is empty) the document with the largest doc_id stays, a NULL one last; of rows equal in both, one."""
    name = F.struct("doc_id", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))
    decided = exact.exact_dedup(docs).select(F.struct("doc_id", "text_sha256").alias("row"), "kept")
    return _only(docs, decided, name)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more on five-word shingles, that with the smallest doc_id stays; texts without words all do."""
    linked = jaccard_join.jaccard_join(docs, width=5, percent=80)
    return _only(docs, linked.select(F.struct("doc_id", "row_hash").alias("row"), "kept"),
                 F.struct(F.col("doc_id").cast("long").alias("doc_id"), exchange.row_hash().alias("row_hash")))


def substring_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows of 35 words that repeat go; a document stays even without words, and ``n_chars`` follows its text."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    cut = substring_dedup.remove_repeats(docs, keep=others, as_is=True).withColumnRenamed("kept_text", "text")
    cut = cut.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
    if "n_chars" in others:
        changed = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, changed).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and the sequences of at most 2048 tokens that they stand in."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("n-gram jaccard join", ngram_jaccard_join),
    ("substring dedup", substring_removal),
    ("packing", pack),
]

#: the stages score, link and tokenise in ways that SQL does not express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage's are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
