"""Packing of token sequences by reciprocal-capacity classes (harmonic packing).

Texts are cut where that avoids padding: whole sequences first; the remainder
into the largest piece of ``capacity // k`` tokens (k = 2, 3, ...), and so on
with what is left; a rest under ``capacity // KINDS`` tokens is one piece.  Each
piece length is a class, and a class's bins hold ``capacity // length`` pieces
each.  Tasks number their pieces by class independently; a table of counts by
task and class turns these numbers into bins, so every bin but the last of a
class is full.  The pieces of those last bins, whose number the capacity bounds,
are packed once more by first-fit decreasing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skymetrics.llm.byte_bpe import _texts, byte_characters
from skymetrics.llm.pretokens import Encoder
from skymetrics.llm.staging import TEXT_ROWS, stage
from skymetrics.llm.text import give_back, memo, slices

CAPACITY, END_ID = 2048, 1
#: the smallest class of cut pieces has this many to a bin
KINDS = 32


def cut_lengths(n: int, capacity: int = CAPACITY, kinds: int = KINDS) -> list[int]:
    """Lengths of the pieces of a text of ``n`` tokens."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    smallest = max(1, capacity // kinds)
    while rest:
        piece = capacity // -(-capacity // rest)  # the largest capacity // k that fits
        while piece > rest:
            piece = capacity // (capacity // piece + 1)
        piece = rest if rest < smallest else piece
        out.append(piece)
        rest -= piece
    return out


class _Tokens:
    """Ids of texts as the tokenizers library gives them, built once per worker."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.letters = str.maketrans(dict(enumerate(byte_characters())))
        self.encode = Encoder(self._pieces)

    def _pieces(self, pretokens: list[str]) -> list[list[int]]:
        mapped = [p.encode("utf-8").decode("latin-1").translate(self.letters) for p in pretokens]
        return [[t.id for t in self.model.tokenize(m)] for m in mapped]

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, at = self.encode(texts)
        odd = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        if odd:  # a special token's own text: as the library takes it
            lists = [ids[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
            for i in odd:
                lists[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32)
            ids, at = np.concatenate(lists), np.concatenate([[0], np.cumsum([len(x) for x in lists])])
        return ids, at


def _pieces_of(batch: pa.RecordBatch, tokens: _Tokens, end_id: int, capacity: int,
               cuts: dict[int, list[int]]) -> Iterator[tuple[np.ndarray, list[tuple]]]:
    """For each slice of texts: their ids, and (row, start, length, first id's place) of each piece."""
    for a, _, data, offsets in slices(batch.column("text")):
        ids, at = tokens(_texts(data, offsets))
        n = len(at) - 1
        with_end = np.insert(ids, at[1:], np.uint32(end_id))
        begin = (at + np.arange(n + 1)).tolist()
        pieces = []
        for i in range(n):
            size = begin[i + 1] - begin[i]
            rest = size % capacity
            if rest not in cuts:
                cuts[rest] = cut_lengths(rest, capacity)
            start = 0
            for length in [capacity] * (size // capacity) + cuts[rest]:
                pieces.append((a + i, start, length, size, begin[i] + start))
                start += length
        yield with_end, pieces


def cut_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
               with_ids: bool = False) -> DataFrame:
    """The pieces of every text, each with its task and its number of its class in that task.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, task, nth, and ids on demand.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()  # what other steps left
        tokens = memo(("tokenizer", hash(definition)), lambda: _Tokens(definition))
        task = TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        cuts: dict[int, list[int]] = {}
        for batch in batches:
            for ids, pieces in _pieces_of(batch, tokens, end_id, capacity, cuts):
                rows, starts, lengths, sizes, places = (list(x) for x in zip(*pieces, strict=True))
                nth = []
                for n in lengths:
                    nth.append(seen.get(n, 0))
                    seen[n] = nth[-1] + 1
                crc = [zlib.crc32(ids[p:p + n].astype("<u4").tobytes()) for p, n in zip(places, lengths, strict=True)]
                columns = [batch.column("doc_id").take(pa.array(rows)), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                           pa.array(crc, pa.int64()), pa.array(sizes, pa.int64()),
                           pa.array([task] * len(rows), pa.int64()), pa.array(nth, pa.int64())]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "nth"]
                if with_ids:
                    columns.append(pa.array([ids[p:p + n].astype(np.int32) for p, n in zip(places, lengths, strict=True)], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)
        give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, task long, nth long" + ", ids array<int>" * with_ids)


def _first_fit(capacity: int):
    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        """Bins of the few pieces that fill no bin of their class."""
        pieces = pieces.sort_values(["length", "number"], ascending=[False, True], kind="stable")
        room: list[int] = []
        first_with: dict[int, int] = {}  # by length: bins before this one have no room
        bins, offsets = [], []
        for n in pieces["length"]:
            i = first_with.get(n, 0)
            while i < len(room) and room[i] < n:
                i += 1
            first_with[n] = i
            if i == len(room):
                room.append(capacity)
            bins.append(i)
            offsets.append(capacity - room[i])
            room[i] -= n
        return pd.DataFrame({"length": pieces["length"], "number": pieces["number"], "bin": bins, "bin_offset": offsets})

    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids on demand).

    A text's ids are those of the tokenizers file, then ``end_id``; NULL and
    empty texts are ``end_id`` alone.  Sequences hold at most ``capacity`` ids,
    their offsets have no gaps, and what is missing to ``capacity`` is padding.
    A NULL doc_id is carried along, repeated rows are packed each, and an empty
    table gives an empty result.  Other columns are not read.
    """
    pieces = stage(cut_pieces(docs, tokenizer_path, capacity, end_id, with_ids), "pieces", TEXT_ROWS)
    by_task = Window.partitionBy("length").orderBy("task")
    counts = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = stage(counts.withColumn("before", F.sum("n").over(by_task) - F.col("n")), "counts")
    per_bin = F.expr(f"{capacity} div length")
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("length"))  # as many rows as there are classes
    classes = (
        before.groupBy("length").agg(F.sum("n").alias("pieces"))
        .withColumn("bins", F.floor(F.col("pieces") / per_bin))
        .withColumn("first_bin", F.sum("bins").over(order) - F.col("bins"))
        .withColumn("all_bins", F.sum("bins").over(Window.partitionBy(F.lit(0))))
    )
    places = before.join(classes, "length").select("length", "task", "before", "bins", "first_bin", "all_bins")
    numbered = stage(
        pieces.join(places, ["length", "task"])
        .withColumn("number", F.col("before") + F.col("nth"))
        .withColumn("full", F.col("number") < F.col("bins") * per_bin)
        .drop("before", "task", "nth"), "numbered")
    left = numbered.filter("NOT full").select("length", "number", "all_bins")
    again = left.groupBy().applyInPandas(_first_fit(capacity), "length long, number long, bin long, bin_offset long")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    full = numbered.filter("full").withColumns({
        "sequence_id": F.col("first_bin") + F.floor(F.col("number") / per_bin),
        "offset": F.col("number") % per_bin * F.col("length"),
    })
    last = numbered.filter("NOT full").join(again, ["length", "number"]).withColumns({
        "sequence_id": F.col("all_bins") + F.col("bin"), "offset": F.col("bin_offset"),
    })
    return full.select(*columns).unionByName(last.select(*columns))
