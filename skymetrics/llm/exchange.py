"""Packed exchange of many small records between Arrow tasks.

Tasks that find millions of (key, owner) records a second would spend their time
on rows.  They send them packed instead: one row per destination and flush, its
records as the bytes of a numpy structured array.  ``part`` says where to; there
are a few parts per shuffle partition, so that a group stays small and tasks even.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skymetrics.llm.staging import partitions

PARTS_PER_TASK = 2
#: a task sends what it has gathered when it holds this many records
FLUSH = 1 << 20

#: which document: its id, and 128 bits of hashes of its id and text, which tell apart rows that share an id;
#: the last bit of ``more`` says that the id is NULL
ROW = [("id", "<i8"), ("hash", "<i8"), ("more", "<i8")]
ROW_NAMES = [name for name, _ in ROW]
ROW_SCHEMA = "id long, hash long, more long"
ROW_STRUCT = "struct<id:long,hash:long,more:long>"


def parts(spark: SparkSession) -> int:
    return PARTS_PER_TASK * partitions(spark)


def row_hash() -> Column:
    """Two hashes of a document's doc_id and text: struct<hash, more>, 127 bits and whether the id is NULL."""
    none = F.col("doc_id").isNull()
    first, second = (F.xxhash64(F.lit(seed), F.col("doc_id"), none, F.col("text").isNull(), F.col("text")) for seed in (1, 2))
    return F.struct(first.alias("hash"), second.bitwiseAND(F.lit(-2).cast("long")).bitwiseOR(none.cast("long")).alias("more"))


def with_row_key(docs: DataFrame, n_parts: int, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """text, ``id``, ``hash`` and ``more`` of each row, the part they make it belong to, and the columns ``keep`` as ``keep_0``, ...

    A NULL id becomes the smallest number.  Ids have to be of an integer type (TypeError otherwise).
    """
    kind = docs.schema["doc_id"].dataType
    if not isinstance(kind, T.IntegralType | T.NullType):
        raise TypeError(f"doc_id has to be an integer, not {kind.simpleString()}")
    return (
        docs.select(F.col("text").cast("string").alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"),
                    row_hash().alias("_hash"), *(F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)))
        .select("text", "id", "_hash.hash", "_hash.more", *(f"keep_{i}" for i in range(len(keep))))
        .withColumn("part", F.pmod("hash", F.lit(n_parts)).cast("int"))
    )


def original_id(row: str = "") -> Column:
    """The id of ``with_row_key`` as it was; ``row`` names the struct it is in."""
    prefix = f"{row}." if row else ""
    return F.when(F.col(f"{prefix}more").bitwiseAND(F.lit(1)) == 0, F.col(f"{prefix}id"))


def copy_rows(target: np.ndarray, rows: np.ndarray) -> None:
    """Write the ROW fields of ``rows`` into those of ``target``."""
    for name in ROW_NAMES:
        target[name] = rows[name]


def same_row(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([a[name] == b[name] for name in ROW_NAMES])


def packed(part: np.ndarray, records: np.ndarray, n_parts: int) -> tuple[np.ndarray, list[bytes]]:
    """(parts, bytes of each part's records)."""
    order = np.argsort(part, kind="stable")
    records = records[order]
    ends = np.searchsorted(part[order], np.arange(n_parts + 1))
    used = np.flatnonzero(np.diff(ends))
    return used, [records[ends[p]:ends[p + 1]].tobytes() for p in used]


def rows(part: np.ndarray, records: np.ndarray, n_parts: int, kind: int) -> Iterator[pa.RecordBatch]:
    """One row (part, kind, records) per part that has records."""
    if len(records):
        used, data = packed(part, records, n_parts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(np.full(len(used), kind), pa.int32()), pa.array(data, pa.binary())],
            ["part", "kind", "records"])


SCHEMA = "part int, kind int, records binary"


def unpacked(table: pa.Table, kind: int, dtype: list) -> np.ndarray:
    """All records of a kind in a group."""
    column = table.column("records").filter(pa.compute.equal(table.column("kind"), kind))
    return np.frombuffer(b"".join(x.as_py() for x in column), np.dtype(dtype))


def row_array(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    """ROW records of a table with the columns of ``with_row_key``."""
    out = np.zeros(table.num_rows, ROW)
    for name in ROW_NAMES:
        out[name] = table.column(name).to_numpy()
    return out


def row_keys(rows: np.ndarray) -> list[tuple[int, int, int]]:
    return list(zip(*(rows[name].tolist() for name in ROW_NAMES), strict=True))


def by_row(records: np.ndarray) -> dict[tuple[int, int, int], np.ndarray]:
    """The records of each row."""
    if not len(records):
        return {}
    records = records[np.lexsort([records[name] for name in reversed(ROW_NAMES)])]
    new = np.flatnonzero(~same_row(records[1:], records[:-1])) + 1
    pieces = np.split(records, new)
    return {row_keys(p[:1])[0]: p for p in pieces}
