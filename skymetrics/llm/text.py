"""Words and their hashes, for whole Arrow batches of texts at once.

Everything here works on the UTF-8 bytes of many texts laid end to end, cut in
slices of a few megabytes so that a task's memory does not depend on how many
texts a batch holds (one text is never cut).  Hashes are 64 bit; arithmetic
wraps.
"""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
U64 = np.uint64

#: separators of plain words: space and the control characters 9 to 13
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: every ASCII character that is neither a letter nor a digit
NOT_ALNUM = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

_STEP = 0x9E3779B97F4A7C15 | 1


def memo(key: object, make: Callable[[], object]) -> object:
    """``make()`` once per Python process; later tasks of the same worker find it again."""
    store = sys.modules.setdefault("_skymetrics_memo", types.ModuleType("_skymetrics_memo")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def give_back() -> None:
    """Return the memory that ended work has left free in this worker; Spark keeps workers, and without this each keeps its largest task's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # no GNU C library
        pass


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word (the splitmix64 finaliser)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _powers(bits: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd step and of its inverse, for ``1 << bits`` places."""
    if bits > 23:  # one very long text: not kept
        return _make_powers(bits, seed)
    return memo(("powers", seed, bits), lambda: _make_powers(bits, seed))


def _make_powers(bits: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    step = (_STEP * (2 * seed + 1)) % (1 << 64) | 1
    inverse = pow(step, -1, 1 << 64)
    out = []
    for base in (step, inverse):
        p = np.full(1 << bits, base, U64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def window_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Polynomial hash of ``values[start:end]``, the same wherever the values stand."""
    n = len(values)
    power, inverse = _powers(max(20, int(n).bit_length()), seed)
    total = np.empty(n + 1, U64)
    total[0] = 0
    np.cumsum(values * power[:n], out=total[1:])
    return (total[ends] - total[starts]) * inverse[starts]


def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64) * U64(_STEP))


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) for runs of rows of about ``limit`` bytes; NULL is empty."""
    at = 0
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        chunk = chunk.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(chunk.buffers()[1], np.int64)[chunk.offset:chunk.offset + len(chunk) + 1]
        data = np.frombuffer(chunk.buffers()[2] or b"", np.uint8)
        i = 0
        while i < len(chunk):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
            j = min(j, len(chunk))
            yield at + i, at + j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            i = j
        at += len(chunk)


class Words:
    """The words of a slice: byte ranges, and the first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray):
        inside = ~separators[data]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        full = np.flatnonzero(offsets[1:] > offsets[:-1])
        first, last = offsets[:-1][full], offsets[1:][full] - 1
        begins[first] = inside[first]
        ends[last] = inside[last]
        self.data = data
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        self.offsets = np.searchsorted(self.starts, offsets)  # by text
        self.counts = np.diff(self.offsets)

    def hashes(self, seed: int = 0) -> np.ndarray:
        h = window_sums(_byte_values()[self.data], self.starts, self.ends, seed)
        return mix(h + (self.ends - self.starts).astype(U64) * U64(_STEP))

    def text_of_words(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def shingles(words: Words, hashes: np.ndarray, width: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(hash, number of its text) of every run of ``width`` words; a text of fewer words is one run."""
    n = words.counts
    runs = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(len(n)), runs)
    first = np.cumsum(runs) - runs
    start = np.arange(len(owner)) - first[owner] + words.offsets[:-1][owner]
    end = np.minimum(start + width, words.offsets[1:][owner])
    sums = window_sums(hashes, start, end, seed + 1)
    return mix(sums + (end - start).astype(U64)), owner


def distinct(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of each owner, sorted by owner and key (owners ascending in the input)."""
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    return keys[new], owner[new]
