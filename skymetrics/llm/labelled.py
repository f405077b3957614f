"""Bounded samples of labelled documents, for the operators that learn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (a NULL id is the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


#: texts of more bytes are not learnt from
LONGEST = 1 << 20


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, per_class: int,
                    longest: int = LONGEST) -> DataFrame:
    """(doc_id, label, text) of at most ``per_class`` labelled rows of either class, each of at most ``longest`` bytes.

    Rows of the fold ``held_out`` and labels other than 0 and 1 are left out; of
    several labels of one id the largest counts, and of several texts of one id
    that with the smallest hash (NULL is the empty text).  The sample is the ids
    with the smallest hashes, so it does not depend on how rows are split.  The
    chosen ids, at most ``2 * per_class``, are broadcast to the documents, and
    rows of one id are folded before they are sent.  What is learnt from thus
    has at most ``2 * per_class * longest`` bytes; longer texts are only scored.
    """
    known = (
        labels.select(F.col("doc_id").alias("labelled_id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("labelled_id").isNotNull() & (fold(F.col("labelled_id"), folds) != held_out))
        .groupBy("labelled_id").agg(F.max("label").alias("label"))
    )
    order = [F.xxhash64("labelled_id"), F.col("labelled_id")]
    chosen = known.filter("label = 0").orderBy(*order).limit(per_class).unionByName(
        known.filter("label = 1").orderBy(*order).limit(per_class))
    text = F.coalesce("text", F.lit(""))
    return (
        docs.select("doc_id", text.alias("text")).filter(F.octet_length("text") <= longest)
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id"))
        .groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first"))
        .select("doc_id", "label", "first.text")
    )
