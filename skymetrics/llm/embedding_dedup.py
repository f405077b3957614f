"""Near-duplicate embeddings by cross-polytope hashing.

A vector is rotated by three rounds of random signs and a fast Hadamard
transform; its hash is the signed axis it then points along most.  A table's
bucket is several such hashes; besides its own bucket a vector probes those it
nearly fell into.  Vectors that meet in a bucket, at home there or one of them
probing, are compared by cosine in double precision, large buckets in blocks.
Equal vectors are folded to one with a count first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skymetrics.llm import exchange
from skymetrics.llm.components import components
from skymetrics.llm.staging import stage
from skymetrics.llm.text import U64, mix

COSINE = 0.9
#: buckets that a vector probes in a table besides its own
PROBES = 6
#: share of the pairs at exactly the cosine asked for that there are enough tables for; ones nearer are found more often
RECALL = 0.97
#: random pairs from which the share that meets in one table is estimated
TRIALS = 2000
#: axes of one hash that probes are made from
NEAR = 4
#: vectors of a bucket that are compared with as many others at once
BLOCK = 512
SEED = 11


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (their length a power of two)."""
    n, half = x.shape[1], 1
    x = x.copy()
    while half < n:
        y = x.reshape(len(x), n // (2 * half), 2, half)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2).reshape(len(x), n)
        half *= 2
    return x / math.sqrt(n)


def axes(x: np.ndarray, rotation: int) -> tuple[np.ndarray, np.ndarray]:
    """(signed axes, loss) of the NEAR axes that each rotated row points along most, best first."""
    signs = np.random.default_rng([SEED, rotation, x.shape[1]]).choice([-1.0, 1.0], (3, x.shape[1]))
    for s in signs:
        x = hadamard(x * s)
    size = np.abs(x)
    best = np.argsort(-size, axis=1, kind="stable")[:, :min(NEAR, x.shape[1])]
    values = np.take_along_axis(size, best, 1)
    return 2 * best + (np.take_along_axis(x, best, 1) < 0), (values[:, :1] - values) ** 2


def buckets(vectors: np.ndarray, hashes: int, tables: int) -> np.ndarray:
    """For each row and table its own bucket, then those it probes."""
    n, d = vectors.shape
    padded = np.zeros((n, max(2, 1 << (d - 1).bit_length())))
    padded[:, :d] = vectors
    out = np.zeros((n, tables, 1 + PROBES), U64)
    for table in range(tables):
        found = [axes(padded, table * hashes + h) for h in range(hashes)]
        places = _probed([cost for _, cost in found])
        for place in range(1 + PROBES):
            key = np.full(n, mix(np.array([table * 4099 + d], U64))[0])
            for h, (axis, _) in enumerate(found):
                key = mix(key ^ (axis[np.arange(n), places[:, place, h]].astype(U64) + U64(1)))
            out[:, table, place] = key
    return out


def _probed(losses: list[np.ndarray]) -> np.ndarray:
    """For each row the PROBES + 1 choices of an axis per hash that lose least, its own bucket first.

    Choices are built up hash by hash; only the best so far can be among the best of more hashes.
    """
    n = len(losses[0])
    cost, places = np.zeros((n, 1)), np.zeros((n, 1, 0), np.int64)
    for loss in losses:
        width = loss.shape[1]
        each = (cost[:, :, None] + loss[:, None, :]).reshape(n, -1)
        best = np.argsort(each, axis=1, kind="stable")[:, :1 + PROBES]
        cost = np.take_along_axis(each, best, 1)
        before = np.take_along_axis(places, (best // width)[:, :, None], 1)
        places = np.concatenate([before, (best % width)[:, :, None]], axis=2)
    short = 1 + PROBES - places.shape[1]
    return np.concatenate([places, np.repeat(places[:, -1:], short, axis=1)], axis=1) if short > 0 else places


def meeting_share(width: int, hashes: int, cosine: float) -> float:
    """Of random pairs of vectors at this cosine, the share that meets in one table: at home, or one probing the other's home."""
    padded = max(2, 1 << (width - 1).bit_length())
    random = np.random.default_rng([SEED, width, hashes])
    x, z = np.zeros((2, TRIALS, padded))
    x[:, :width], z[:, :width] = random.normal(size=(2, TRIALS, width))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z -= np.einsum("ij,ij->i", x, z)[:, None] * x
    z /= np.maximum(np.linalg.norm(z, axis=1), 1e-300)[:, None]
    pairs = [[axes(side, h) for h in range(hashes)] for side in (x, cosine * x + math.sqrt(max(0.0, 1 - cosine * cosine)) * z)]
    taken = []
    for found in pairs:
        places = _probed([loss for _, loss in found])
        taken.append(np.stack([np.take_along_axis(axis, places[:, :, h], 1) for h, (axis, _) in enumerate(found)], axis=2))
    one, two = taken
    forth, back = ((a == b[:, :1]).all(axis=2).any(axis=1) for a, b in ((one, two), (two, one)))
    return float((forth | back).mean())


def tables_for(width: int, hashes: int, cosine: float, recall: float = RECALL) -> int:
    """How many tables find ``recall`` of the pairs at the cosine; the share of one table is taken a little low."""
    share = meeting_share(width, hashes, cosine)
    share = max(1.0 / TRIALS, share - 2 * math.sqrt(share * (1 - share) / TRIALS))
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - share))) if share < 1 else 1


def usable(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """(rows, unit vectors) of those that are finite, whole and not zero."""
    rows, vectors = [], []
    for i, x in enumerate(column):
        if not x.is_valid or not len(x.values) or x.values.null_count:
            continue
        v = np.asarray(x.values, np.float64)
        top = np.abs(v).max()
        if not np.isfinite(top) or top == 0:
            continue
        v = v / top
        rows.append(i)
        vectors.append(v / math.sqrt(float(v @ v)))
    return np.array(rows, np.int64), vectors


def _codes(hashes: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 2048):
                part = batch.slice(a, 2048)
                rows, vectors = usable(part.column("embedding"))
                lengths = np.array([len(v) for v in vectors], np.int64)
                for d in np.unique(lengths):
                    mine = np.flatnonzero(lengths == d)
                    unit = np.stack([vectors[i] for i in mine])
                    keys = buckets(unit, hashes, tables)
                    chosen = part.take(pa.array(rows[mine]))
                    yield pa.RecordBatch.from_arrays([
                        chosen.column("rep"), chosen.column("copies"),
                        pa.array([v.tobytes() for v in unit], pa.binary()),
                        pa.array([k.view(np.int64).ravel() for k in keys], pa.list_(pa.int64())),
                    ], ["rep", "copies", "unit", "codes"])

    return run


def _compare(cosine: float, tables: int):
    def run(table: pa.Table) -> pa.Table:
        """Links between the vectors of each block pair, every pair counted in one bucket only."""
        place, block, bucket = (table.column(c).to_numpy() for c in ("place", "block", "bucket"))
        rep, copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
        codes = np.stack([np.asarray(x.values, np.int64) for x in table.column("codes").combine_chunks()]) if len(rep) else np.zeros((0, 1), np.int64)
        codes = codes.reshape(len(rep), tables, -1)
        unit = [np.frombuffer(x.as_py(), np.float64) for x in table.column("unit")]
        order = np.lexsort((block, place))
        cuts = np.flatnonzero(np.diff(place[order])) + 1
        a, b, n = [], [], []
        for members in np.split(order, cuts):
            blocks = np.unique(block[members])
            one = members[block[members] == blocks[0]]
            two = members if len(blocks) == 1 else members[block[members] == blocks[1]]
            x, y = (np.stack([unit[i] for i in side]) for side in (one, two))
            i, j = np.nonzero(x @ y.T >= cosine)
            i, j = one[i], two[j]
            if len(blocks) == 1:
                i, j = i[rep[i] < rep[j]], j[rep[i] < rep[j]]
            keep = _first_meeting(codes, i, j, bucket[members[0]])
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            ends, both = np.unique(np.concatenate([i, j]), return_inverse=True)
            i, j = both[:len(i)], both[len(i):]
            label, before = np.arange(len(ends)), None
            while before is None or (label != before).any():  # smallest end reached inside the block pair
                before = label.copy()
                np.minimum.at(label, i, label[j])
                np.minimum.at(label, j, label[i])
            a.append(rep[ends])
            b.append(rep[ends[label]])
            n.append((np.bincount(i, copies[ends[j]], len(ends)) + np.bincount(j, copies[ends[i]], len(ends))).astype(np.int64))
        empty = [np.zeros(0, np.int64)]
        return pa.table({"a": np.concatenate(a + empty), "b": np.concatenate(b + empty), "links": np.concatenate(n + empty)})

    return run


def _first_meeting(codes: np.ndarray, i: np.ndarray, j: np.ndarray, bucket: int) -> np.ndarray:
    """Whether ``bucket`` is the one in which the pairs (i, j) count: the first table where both are at home, else the first probe."""
    home = codes[:, :, 0]
    keep = np.zeros(len(i), bool)
    for at in range(0, len(i), 1 << 16):
        p, q = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
        same = home[p] == home[q]
        first = same.argmax(axis=1)
        together = same.any(axis=1)
        out = together & (home[p, first] == bucket)
        rest = np.flatnonzero(~together)
        if len(rest):
            p, q = p[rest], q[rest]
            forth = codes[q, :, 1:] == home[p][:, :, None]  # q probes p's home
            back = codes[p, :, 1:] == home[q][:, :, None]
            found = np.where(forth.any(axis=2), home[p], np.where(back.any(axis=2), home[q], 0))
            met = forth.any(axis=2) | back.any(axis=2)
            first = met.argmax(axis=1)
            out[rest] = met.any(axis=1) & (found[np.arange(len(p)), first] == bucket)
        keep[at:at + len(out)] = out
    return keep


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE, hashes: int | None = None, recall: float = RECALL) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Links are the pairs found of cosine at least ``cosine``; ``n_links`` counts
    other rows.  There are as many tables as find the share ``recall`` of the
    pairs at just that cosine, whatever the number of ``hashes`` in a table
    (by default as many as let about one unlike vector share a bucket).  Vectors
    that are NULL, empty, zero, or hold NULL or non-finite components link with
    nothing, nor do vectors of different lengths.  vec_id is cast to long; rows
    that share one are rows each, and a NULL one is left out of ``component_id``
    (NULL for itself, and not kept).  An empty table gives an empty result.
    Other columns are not read.
    """
    n_parts = exchange.parts(embeddings.sparkSession)
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    # distinct vectors are numbered in the order of their smallest vec_id: the smallest number reached names a component
    reps = stage(
        rows.filter("embedding IS NOT NULL AND vec_id IS NOT NULL").groupBy("embedding")
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
        .orderBy("least").withColumn("rep", F.monotonically_increasing_id()), "reps")
    count, width = reps.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    # so many hashes a table that about one unlike vector shares a bucket by chance
    hashes = hashes or max(1, math.ceil(math.log(max(2, count)) / math.log(2 * max(2, width or 2))))
    tables = tables_for(max(2, width or 2), hashes, cosine, recall)
    coded = stage(reps.select("rep", "copies", "embedding").mapInArrow(_codes(hashes, tables), "rep long, copies long, unit binary, codes array<long>"), "codes")
    met = coded.select("rep", F.posexplode("codes").alias("at", "bucket")).withColumn("home", (F.col("at") % (1 + PROBES) == 0).cast("int"))
    sizes = stage(
        met.groupBy("bucket").agg(F.countDistinct("rep").alias("n"), F.max("home").alias("home")).filter("n > 1 AND home = 1")
        .select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "buckets")
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    members = met.select("bucket", "rep").distinct().join(sizes, "bucket").withColumn("block", block)
    pairs = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    places = pairs.select("bucket", "rep", "block", F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other")).alias("place"))
    links = stage(
        stage(places, "places").join(coded, "rep").withColumn("part", F.pmod("place", F.lit(n_parts)))
        .groupBy("part").applyInArrow(_compare(cosine, tables), "a long, b long, links long"), "links")
    counts = links.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    reached = components(links.select("a", "b")).select(F.col("node").alias("rep"), F.col("component").alias("top"))
    names = reps.select(F.col("rep").alias("top"), F.col("least").alias("component_id"))
    classes = stage(
        coded.select("rep", "copies").join(counts, "rep", "left").join(reached, "rep", "left")
        .withColumn("top", F.coalesce("top", "rep")).join(names, "top")
        .select("rep", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"), "classes")
    known = stage(reps.select("embedding", "rep").join(classes, "rep"), "known")
    out = rows.join(known, "embedding", "left")
    alone = F.col("rep").isNull() | F.col("vec_id").isNull()
    component = F.when(alone, F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
