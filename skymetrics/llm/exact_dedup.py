"""Exact deduplication by deterministic block naming.

Every text is cut into blocks of a fixed number of bytes.  The distinct blocks
are sorted and each takes its place in the sorted order as an integer name;
then adjacent names are paired, the distinct pairs sorted and named in turn,
until every text has a single name.  Texts of the same number of blocks have
the same name exactly if they are byte for byte equal.

Only DataFrame functions are used.  The sort key of a block is abbreviated: its
digest first, its bytes only where two blocks share a digest, so the bytes are
shuffled once, after a map-side combine that folds copies.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymetrics.llm.staging import stage

BLOCK_BYTES = 4096


def block_digest(block: Column) -> tuple[Column, Column]:
    """Two 64-bit digests of a block; equal digests are told apart by the bytes."""
    return F.xxhash64(block), F.xxhash64(F.lit(1), block)


def row_hash() -> Column:
    """A hash of a document's text."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _cut(docs: DataFrame, block_bytes: int, digest: Callable[[Column], tuple[Column, Column]]) -> DataFrame:
    """One row per block: doc_id, row_hash, sha, n_blocks, place, h1, h2, block."""
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = docs.select(
        "doc_id", text.cast("binary").alias("bytes"),
        row_hash().alias("row_hash"), F.unhex(F.sha2(text, 256)).alias("sha"),
    )
    n = F.greatest(F.ceil(F.octet_length("bytes") / F.lit(block_bytes)), F.lit(1)).cast("int")
    cut = (
        whole.withColumn("n_blocks", n)
        .withColumn("place", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .select("doc_id", "row_hash", "sha", "n_blocks", "place",
                F.substring("bytes", F.col("place") * block_bytes + 1, F.lit(block_bytes)).alias("block"))
    )
    h1, h2 = digest(F.col("block"))
    return cut.withColumns({"h1": h1, "h2": h2})


def _named(distinct: DataFrame, *order: str) -> DataFrame:
    """The rows in sorted order with their integer names, written to the shared folder."""
    return stage(distinct.orderBy(*order).withColumn("name", F.monotonically_increasing_id()), "names")


def name_texts(docs: DataFrame, block_bytes: int = BLOCK_BYTES,
               digest: Callable[[Column], tuple[Column, Column]] = block_digest) -> DataFrame:
    """One row per distinct (doc_id, text): doc_id, row_hash, sha, copies, n_blocks, name.

    Two rows have equal (n_blocks, name) exactly if their texts are equal; NULL
    text counts as empty.  ``copies`` counts repeated rows.  ``digest`` only
    abbreviates the sort key: any function of the block gives the same classes.
    """
    cut = _cut(docs, block_bytes, digest)
    ranked = (
        cut.groupBy("h1", "h2").agg(F.sort_array(F.collect_set("block")).alias("blocks"))
        .select("h1", "h2", F.size("blocks").alias("sharers"),
                F.posexplode(F.when(F.size("blocks") > 1, F.col("blocks")).otherwise(F.array(F.lit(b"")))).alias("rank", "block"))
    )
    names = _named(ranked, "h1", "h2", "rank")
    places = stage(
        cut.drop("block").groupBy("doc_id", "row_hash", "n_blocks", "place", "h1", "h2")
        .agg(F.first("sha").alias("sha"), F.count(F.lit(1)).alias("copies")), "places")
    alone = names.filter("sharers = 1").select("h1", "h2", "name")
    now = places.join(alone, ["h1", "h2"]).drop("h1", "h2")
    shared = names.filter("sharers > 1").select("h1", "h2", "block", "name")
    if not shared.isEmpty():
        exact = (cut.select("doc_id", "row_hash", "n_blocks", "place", "sha", "h1", "h2", "block")
                 .join(shared, ["h1", "h2", "block"])
                 .groupBy("doc_id", "row_hash", "n_blocks", "place", "name")
                 .agg(F.first("sha").alias("sha"), F.count(F.lit(1)).alias("copies")))
        now = now.unionByName(exact.select(*now.columns))
    now = stage(now, "named").withColumn("left", F.col("n_blocks"))
    done = [now.filter("left = 1")]
    while True:
        rest = now.filter("left > 1")
        if rest.isEmpty():
            break
        even = F.col("place") % 2 == 0
        pairs = stage(
            rest.groupBy("doc_id", "row_hash", "n_blocks", "left", F.expr("place div 2").cast("int").alias("place"))
            .agg(F.max(F.when(even, F.col("name"))).alias("a"),
                 F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1).cast("long")).alias("b"),
                 F.max("sha").alias("sha"), F.max("copies").alias("copies")), "pairs")
        named = _named(pairs.select("a", "b").distinct(), "a", "b")
        now = stage(
            pairs.withColumn("left", F.ceil(F.col("left") / 2).cast("int"))
            .join(named, ["a", "b"]).drop("a", "b"), "named")
        done.append(now.filter("left = 1"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("doc_id", "row_hash", "sha", "copies", "n_blocks", "name")


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES,
                digest: Callable[[Column], tuple[Column, Column]] = block_digest) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, row_hash.

    Of equal texts the row with the largest doc_id stays.  NULL text counts as
    empty; an empty text is a text like any other.  Rows that repeat a doc_id
    with the same text are counted and returned each, all with the same
    decision; a NULL doc_id is smaller than any other, and a group of nothing
    but NULL ids keeps them (keep_id NULL).  An empty table gives an empty
    result.  Other columns are not read.
    """
    texts = stage(name_texts(docs, block_bytes, digest), "texts")
    groups = stage(
        texts.groupBy("n_blocks", "name")
        .agg(F.max("doc_id").alias("keep_id"), F.sum("copies").cast("long").alias("group_size")), "groups")
    rows = texts.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return rows.join(groups, ["n_blocks", "name"]).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), "row_hash",
    )
