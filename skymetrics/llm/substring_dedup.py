"""Removal of passages that repeat, by level-wise doubling.

A window of words can only repeat if the shorter windows inside it do.  So
windows are looked for at one length first; only where they repeat are windows
of twice that length (at last, of the length asked for) looked at, and the search
ends where no candidates survive.  Below the last level one window speaks for
its neighbours: of every run of windows that a longer window holds, the one with
the smallest hash, which is the same wherever the longer window stands.

Windows are compared by 96 bits of hashes.  Within a task, windows that repeat
are folded to one record before the shuffle, and their places are sent as runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skymetrics.llm import exchange
from skymetrics.llm.exchange import FLUSH, ROW, ROW_NAMES, ROW_SCHEMA, by_row, copy_rows, original_id, row_array, row_keys, same_row, unpacked
from skymetrics.llm.staging import partitions, stage
from skymetrics.llm.text import SPACES, U64, Words, mix, slices, window_sums

WINDOW = 35
#: the first level has windows of this many words at least
SHORTEST = 9

WINDOW_KEY = [("key", "<u8"), ("check", "<u4")]
PLACE = [*ROW, ("at", "<i4")]
RUN = [*PLACE, ("n", "<i4")]
SINGLE, KNOWN, KNOWN_RUN = 0, 1, 2
#: as a place: the window repeats, and its places are known already
NOWHERE = -1
_LOW = U64((1 << 20) - 1)


def levels(window: int, shortest: int = SHORTEST) -> list[int]:
    """Lengths from about ``shortest`` on, each at most twice the one before; the last is ``window``."""
    out = [window]
    while out[0] >= 2 * shortest:
        out.insert(0, -(-out[0] // 2))
    return out


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every ``n`` values in a row."""
    have, out = 1, values
    while 2 * have <= n:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[:len(values) - n + 1], out[n - have:]) if have < n else out


class Windows:
    """The windows of a slice's texts, and for each the shorter window that speaks for it."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int, length: int):
        words = Words(data, offsets, SPACES)
        self.words, self.window = words, window
        n = np.maximum(words.counts - window + 1, 0)  # windows of each text
        self.text = np.repeat(np.arange(len(n)), n)
        self.starts = np.arange(len(self.text)) - (np.cumsum(n) - n)[self.text] + words.offsets[:-1][self.text]
        self.speaker = np.zeros(0, np.int64)
        if not len(self.text):
            self.key = self.check = np.zeros(0, U64)
            return
        hashes = words.hashes()
        first = np.arange(len(hashes) - length + 1)
        self.key = mix(window_sums(hashes, first, first + length, 1))
        self.check = mix(window_sums(hashes, first, first + length, 2)) if length == window else self.key >> U64(32)
        order = (self.key & ~_LOW) | (first.astype(U64) & _LOW)
        least = _least(order, window - length + 1)[self.starts]
        self.speaker = self.starts + ((least - self.starts.astype(U64)) & _LOW).astype(np.int64)

    def speakers(self, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, text) of the shorter windows that speak for the windows ``alive``, each once."""
        place, first = np.unique(self.speaker[alive], return_index=True)
        return place, self.text[alive][first]

    def of_text(self, place: np.ndarray, text: np.ndarray) -> np.ndarray:
        return place - self.words.offsets[text]


class _Sender:
    """Gathers window records of a task and sends them packed."""

    def __init__(self, n_parts: int):
        self.n_parts, self.held, self.size = n_parts, [], 0

    def add(self, windows: Windows, alive: np.ndarray, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        place, text = windows.speakers(alive)
        keys, places = np.zeros(len(place), WINDOW_KEY), np.zeros(len(place), PLACE)
        keys["key"], keys["check"] = windows.key[place], windows.check[place] & U64(0xFFFFFFFF)
        copy_rows(places, rows[text])
        places["at"] = windows.of_text(place, text)
        self.held.append((keys, places))
        self.size += len(keys)
        if self.size >= FLUSH:
            yield from self.send()

    def send(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        keys, places = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self.held, self.size = [], 0
        order = np.lexsort((keys["check"], keys["key"]))
        first, again = np.empty(len(keys), bool), np.empty(len(keys), bool)
        first[order], again[order] = _repeats(keys[order])
        places_known = _runs(places[again])
        places["at"][again] = NOWHERE
        single = first | ~again  # in the order of documents and places, which packs well
        both = np.zeros(int(single.sum()), [*WINDOW_KEY, *PLACE])
        for source in (keys, places):
            for name in source.dtype.names:
                both[name] = source[name][single]
        part = lambda k: (k["key"] >> U64(33)).astype(np.int64) % self.n_parts
        yield from exchange.rows(part(both), both, self.n_parts, SINGLE)
        yield from exchange.rows(places_known["hash"] % self.n_parts, places_known, self.n_parts, KNOWN_RUN)


def _runs(places: np.ndarray) -> np.ndarray:
    """Places that follow each other in a document, as runs."""
    new = np.ones(len(places) + 1, bool)
    new[1:-1] = ~same_row(places[1:], places[:-1]) | (places["at"][1:] != places["at"][:-1] + 1)
    edges = np.flatnonzero(new)
    out = np.zeros(len(edges) - 1, RUN)
    for name in places.dtype.names:
        out[name] = places[name][edges[:-1]]
    out["n"] = np.diff(edges)
    return out


def _places(table: pa.Table) -> np.ndarray:
    """All repeated places that a part's records name."""
    runs = unpacked(table, KNOWN_RUN, RUN)
    out = np.repeat(runs[[*ROW_NAMES, "at"]].astype(PLACE), runs["n"])
    ends = np.cumsum(runs["n"])
    out["at"] += (np.arange(len(out)) - np.repeat(ends - runs["n"], runs["n"])).astype(np.int32)
    return np.concatenate([unpacked(table, KNOWN, PLACE), out])


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first of its run, in a run of several) for sorted keys."""
    same = (keys["key"][1:] == keys["key"][:-1]) & (keys["check"][1:] == keys["check"][:-1])
    edge = np.zeros(min(1, len(keys)), bool)
    before, after = np.concatenate([edge, same]), np.concatenate([same, edge])
    return ~before, before | after


def _repeating(n_parts: int):
    """Of a part's records, the places whose window occurs several times, by the part of their document."""
    def run(table: pa.Table) -> pa.Table:
        single = unpacked(table, SINGLE, [*WINDOW_KEY, *PLACE])
        keys = single[["key", "check"]].astype(WINDOW_KEY)
        every = np.concatenate([keys, keys[single["at"] == NOWHERE]])  # those count twice
        order = np.lexsort((every["check"], every["key"]))
        _, again = _repeats(every[order])
        found = order[again]
        found = single[found[found < len(single)]]
        found = found[found["at"] != NOWHERE]
        places = found[[*ROW_NAMES, "at"]].astype(PLACE)
        places = places[np.lexsort((places["at"], places["more"], places["id"], places["hash"]))]
        runs = unpacked(table, KNOWN_RUN, RUN)
        batches = [*exchange.rows(places["hash"] % n_parts, places, n_parts, KNOWN),
                   *exchange.rows(runs["hash"] % n_parts, runs, n_parts, KNOWN_RUN)]
        return pa.Table.from_batches(batches, _ARROW)

    return run


_ARROW = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("records", pa.binary())])


def _alive(windows: Windows, rows: np.ndarray, found: dict, at: int) -> np.ndarray:
    """Which windows the places ``found`` (a text's speakers that repeat) leave."""
    mark = np.zeros(len(windows.key) + 1, bool)
    for i, key in enumerate(row_keys(rows[at:at + len(windows.words.counts)])):
        places = found.get(key)
        if places is not None:
            mark[windows.words.offsets[i] + places["at"]] = True
    return mark[windows.speaker]


def _extended(window: int, shorter: int, length: int, n_parts: int):
    """The windows of ``length`` words that the repeated ones of ``shorter`` words leave."""
    def longer(texts: pa.Table, places: pa.Table) -> pa.Table:
        out, known = [], by_row(_places(places))
        sender, rows = _Sender(n_parts), row_array(texts)
        wanted = np.array([k in known for k in row_keys(rows)], bool)
        texts, rows = texts.filter(pa.array(wanted, pa.bool_())), rows[wanted]
        for a, b, data, offsets in slices(texts.column("text")):
            alive = _alive(Windows(data, offsets, window, shorter), rows, known, a)
            out.extend(sender.add(Windows(data, offsets, window, length), alive, rows[a:b]))
        out.extend(sender.send())
        return pa.Table.from_batches(out, _ARROW)

    return longer


def repeated_windows(keyed: DataFrame, n_parts: int, window: int = WINDOW, shortest: int = SHORTEST) -> DataFrame:
    """Packed places of the windows of ``window`` words that start in more than one place.

    ``keyed`` is what ``exchange.with_row_key`` makes of the documents.  The
    first level is written; all later ones are one plan, which sends the texts once.
    """
    lengths = levels(window, shortest)
    # windows are small records: one part per task, and half the packets between window parts and document parts
    key_parts = partitions(keyed.sparkSession)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = _Sender(key_parts)
        for batch in batches:
            rows = row_array(batch)
            for a, b, data, offsets in slices(batch.column("text")):
                windows = Windows(data, offsets, window, lengths[0])
                yield from sender.add(windows, np.ones(len(windows.text), bool), rows[a:b])
        yield from sender.send()

    found = keyed.mapInArrow(first, exchange.SCHEMA).groupBy("part").applyInArrow(_repeating(n_parts), exchange.SCHEMA)
    if len(lengths) > 1:
        found = stage(found, "windows")
        if found.isEmpty():
            return found
    for shorter, length in zip(lengths[:-1], lengths[1:], strict=True):
        found = (
            keyed.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(_extended(window, shorter, length, key_parts), exchange.SCHEMA)
            .groupBy("part").applyInArrow(_repeating(n_parts), exchange.SCHEMA)
        )
    return found


def remove_repeats(docs: DataFrame, window: int = WINDOW, shortest: int = SHORTEST, keep: tuple[str, ...] = (),
                   as_is: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text, and the columns ``keep``.

    Words are what stands between spaces and control characters 9 to 13.  A
    word goes if a window of ``window`` words that covers it starts in another
    place too, in any document; repeated rows are other places.  What stays is
    joined by single spaces (``as_is``: a text that loses nothing stays as it
    was, NULL too).  NULL and empty texts have no words, and a text of any
    length is taken whole by one task.  doc_id has to be an integer (TypeError
    otherwise); NULL and repeated ones are carried along, their rows told apart
    by 128 bits of hashes.  Columns outside ``keep`` are not read, whatever their
    names; there are no ties to break, since every repeat goes.  An empty table
    gives an empty result.
    """
    n_parts = exchange.parts(docs.sparkSession)
    keyed = exchange.with_row_key(docs, n_parts, keep=keep)
    # one plan for the last level and the removal: both use the same exchange of the texts
    found = repeated_windows(keyed, n_parts, window, shortest)
    others = [f"keep_{i}" for i in range(len(keep))]

    def remove(texts: pa.Table, places: pa.Table) -> pa.Table:
        known = by_row(_places(places))
        kept, counts, removed = [], [], []
        for key, text in zip(row_keys(row_array(texts)), texts.column("text"), strict=True):
            words = (text.as_py() or "").encode("utf-8").split()
            counts.append(len(words))
            mine = known.get(key)
            if mine is not None:
                change = np.zeros(len(words) + 1, np.int64)
                starts = np.unique(mine["at"])
                np.add.at(change, starts, 1)
                np.add.at(change, starts + window, -1)
                stays = np.cumsum(change[:-1]) == 0
                words = list(compress(words, stays.tolist()))
            removed.append(counts[-1] - len(words))
            kept.append(text.as_py() if as_is and not removed[-1] else b" ".join(words).decode("utf-8"))
        return pa.table([*(texts.column(name) for name in ROW_NAMES), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()),
                         *(texts.column(c) for c in others)], [*ROW_NAMES, "n_words", "n_removed", "kept_text", *others])

    kinds = "".join(f", keep_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    out = keyed.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(
        remove, f"{ROW_SCHEMA}, n_words long, n_removed long, kept_text string{kinds}")
    return out.select(original_id().alias("doc_id"), "n_words", "n_removed", "kept_text",
                      *(F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)))
