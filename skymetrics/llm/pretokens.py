"""Pre-tokens of byte-level BPE vocabularies, and their ids, for whole batches.

The usual pattern (contractions; letters, digits or other characters with one
leading space; white space) is applied to runs of character classes with numpy.
Each distinct pre-token of a slice is encoded once; the ids of all texts are
then gathered from the distinct ones.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import regex

from skymetrics.llm.text import U64, memo, mix, window_sums

LETTER, NUMBER, SPACE = 1, 2, 3
#: contractions that the pattern takes as one pre-token: one and two letters after the apostrophe
ONE, TWO = "stmd", ("re", "ve", "ll")
#: pre-tokens whose ids a worker keeps between slices
KEPT = 1 << 21


def _classes() -> np.ndarray:
    """Class of every code point."""
    table = np.zeros(0x110000, np.uint8)
    for low, high in ((0, 0xD800), (0xE000, 0x110000)):
        chars = "".join(map(chr, range(low, high)))
        for code, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for m in regex.finditer(pattern, chars):
                table[low + m.start():low + m.end()] = code
    return table


def token_starts(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pre-tokens start, for the code points of texts laid end to end (offsets by text)."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    kind = memo("classes", _classes)[codes]
    edge = np.zeros(n + 1, bool)  # first characters of texts, and the end
    edge[offsets] = True
    start = edge[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # the last of several spaces goes with what follows, if it is a plain one, or stands alone
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~edge[1:n])
    start[last] = True
    start[last[codes[last] == 0x20] + 1] = False
    quote = np.flatnonzero((codes == 0x27) & start)
    if len(quote):
        padded = np.concatenate([codes, np.zeros(3, codes.dtype)])
        first, second = padded[quote + 1], padded[quote + 2]
        inside = ~edge[np.minimum(quote + 1, n)]
        one = quote[inside & np.isin(first, [ord(c) for c in ONE])]
        room = inside & ~edge[np.minimum(quote + 2, n)]
        pair = np.zeros(len(quote), bool)
        for a, b in TWO:
            pair |= (first == ord(a)) & (second == ord(b))
        two = quote[room & pair]
        for at, length in ((one, 2), (two, 3)):
            start[at + 1] = False
            after = at + length
            start[after[after < n]] = True
    return np.flatnonzero(start)


class Encoder:
    """Ids of texts, one distinct pre-token at a time.

    ``encode_many`` gives the ids of a list of pre-tokens.  What a worker has
    encoded is kept, sorted by its hash (up to ``KEPT`` pre-tokens, then
    forgotten and begun anew).
    """

    def __init__(self, encode_many: Callable[[list[str]], list[list[int]]]):
        self.encode_many = encode_many
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, U64)
        self.begins, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, found: list[list[int]]) -> None:
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        begins = np.cumsum(lengths) - lengths + len(self.flat)
        self.flat = np.concatenate([self.flat, np.fromiter((i for ids in found for i in ids), np.uint32, int(lengths.sum()))])
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.begins = np.insert(self.begins, at, begins)
        self.lengths = np.insert(self.lengths, at, lengths)

    def _known(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        return at, known

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, offsets by text)."""
        whole = "".join(texts)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = token_starts(codes, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        ends = np.append(starts[1:], len(codes))
        keys = mix(window_sums(codes.astype(U64) + U64(1), starts, ends) + (ends - starts).astype(U64))
        distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) > KEPT:
            self._forget()
        at, known = self._known(distinct)
        if not known.all():
            one = first[~known]
            self._learn(distinct[~known], self.encode_many(
                [whole[a:b] for a, b in zip(starts[one].tolist(), ends[one].tolist(), strict=True)]))
            at, known = self._known(distinct)
        ids, ends_of = gather(self.flat, self.begins, self.lengths, at[inverse])
        token_of = np.searchsorted(starts, offsets)
        return ids, np.concatenate([[0], ends_of])[token_of]


def gather(flat: np.ndarray, begins: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges ``which`` of ``flat`` end to end, and where each ends."""
    n = lengths[which]
    ends = np.cumsum(n)
    step = np.repeat(begins[which] - (ends - n), n)
    return flat[step + np.arange(len(step))], ends
