"""Licence scans with a generalised suffix automaton of licence texts.

The automaton holds every run of words of every template and phrase.  A text's
words are streamed through it: after each word the state and length are the
longest run ending there that some template contains (matching statistics).
Runs that cannot grow and are long enough are chained, in the order of both the
text and the template, into covered spans.  Phrases are found at the same time:
one ends wherever its state is a suffix of the state reached.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skymetrics.llm.text import LOWER, NOT_ALNUM, Words, slices

#: a match has this many words at least; a chain leaves out this many words of the text at most in one place
LEAST_MATCH, MOST_GAP = 4, 12
#: a chain labels a text if it covers this share of the template, or this many words of it
LEAST_SHARE, ENOUGH_WORDS = 0.6, 20

#: fixed values: phrases and their labels
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

#: fixed values: notices and passages of public licences, and their labels
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation the "
            "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
            "persons to whom the software is furnished to do so subject to the following conditions the above copyright "
            "notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
               "the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required "
               "by applicable law or agreed to in writing software distributed under the license is distributed on an as is "
               "basis without warranties or conditions of any kind either express or implied"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
            "license as published by the free software foundation either version 3 of the license or at your option any later "
            "version this program is distributed in the hope that it will be useful but without any warranty without even the "
            "implied warranty of merchantability or fitness for a particular purpose"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
            "following conditions are met redistributions of source code must retain the above copyright notice this list of "
            "conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
            "provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
                     "derived from this software without specific prior written permission"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public "
             "license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free "
             "software foundation either version 3 of the license or at your option any later version"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is "
            "available at https www eclipse org legal epl 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile "
                  "sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or "
                  "non commercial and by any means"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any "
             "damages arising from the use of this software permission is granted to anyone to use this software for any purpose including "
             "commercial applications and to alter it and redistribute it freely subject to the following restrictions"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
            "distributed with this file you can obtain one at http mozilla org mpl 2 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
]


@dataclass
class Automaton:
    """Generalised suffix automaton over numbered words."""

    words: dict[str, int] = field(default_factory=dict)
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    ends: list[set] = field(default_factory=lambda: [set()])

    def _state(self, length: int, step: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.step.append(step)
        self.link.append(link)
        self.ends.append(set())
        return len(self.length) - 1

    def _split(self, p: int, word: int) -> int:
        """The state of the longest run that p's run and ``word`` make, apart from longer ones."""
        q = self.step[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, dict(self.step[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, owner: object, text: list[str]) -> None:
        """Every run of ``text``; (owner, words up to there) marks where each prefix ends."""
        last = 0
        for i, name in enumerate(text):
            word = self.words.setdefault(name, len(self.words))
            if word in self.step[last]:
                last = self._split(last, word)
            else:
                new, p = self._state(self.length[last] + 1, {}, 0), last
                while p >= 0 and word not in self.step[p]:
                    self.step[p][word] = new
                    p = self.link[p]
                if p >= 0:
                    self.link[new] = self._split(p, word)
                last = new
            self.ends[last].add((owner, i + 1))

    def finish(self) -> None:
        """Pass the ends of longer runs on to the runs that end them."""
        for s in sorted(range(1, len(self.length)), key=lambda s: -self.length[s]):
            if self.link[s] > 0:
                self.ends[self.link[s]] |= self.ends[s]


@dataclass
class Scanner:
    """The automaton of phrases and templates, ready for streams of word numbers (-1: in no template)."""

    automaton: Automaton
    templates: list[tuple[str, int]]  # label and words of each
    phrases: list[tuple[str, int]]
    phrase_ends: list[list[int]]  # by state: phrases that end there
    hashes: np.ndarray
    numbers: np.ndarray

    @classmethod
    def build(cls, phrases: list[tuple[str, str]], templates: list[tuple[str, str]]) -> Scanner:
        automaton = Automaton()
        for i, (_, text) in enumerate(templates):
            automaton.add(i, text.split())
        for i, (text, _) in enumerate(phrases):
            automaton.add(("phrase", i), text.split())
        automaton.finish()
        sizes = [len(text.split()) for text, _ in phrases]
        ends = [[] for _ in automaton.length]
        for s, found in enumerate(automaton.ends):
            ends[s] = [i for i, n in enumerate(sizes) if (("phrase", i), n) in found and automaton.length[s] == n]
        for s in sorted(range(1, len(ends)), key=lambda s: automaton.length[s]):
            ends[s] = ends[s] + ends[automaton.link[s]]
        for s, found in enumerate(automaton.ends):
            automaton.ends[s] = sorted(x for x in found if not isinstance(x[0], tuple)) if automaton.length[s] >= LEAST_MATCH else []
        names = list(automaton.words)
        (_, _, data, offsets), = slices(pa.array(names), 1 << 30)
        hashes = Words(data, offsets, NOT_ALNUM).hashes()
        order = np.argsort(hashes)
        return cls(automaton, [(label, len(text.split())) for label, text in templates],
                   [(label, n) for (_, label), n in zip(phrases, sizes, strict=True)], ends, hashes[order], order)

    def number(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.numbers[at], -1)

    def stream(self, run: list[int], at: int, places: list, matches: list) -> None:
        """Matching statistics of words ``at``, ``at + 1``, ...: phrases to ``places``, longest runs to ``matches``."""
        step, link, length = self.automaton.step, self.automaton.link, self.automaton.length
        s = n = 0
        for i, word in enumerate(run, at):
            before, had = s, n
            while s > 0 and word not in step[s]:
                s = link[s]
                n = length[s]
            s = step[s].get(word, 0)
            n = n + 1 if s else 0
            if n <= had and had >= LEAST_MATCH:
                matches.append((i - had, had, before))
            for p in self.phrase_ends[s]:
                if n >= self.phrases[p][1]:
                    places.append((i + 1 - self.phrases[p][1], p))
        if n >= LEAST_MATCH:
            matches.append((at + len(run) - n, n, s))

    def chains(self, matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
        """(template, first word, word after the last, words covered) of the chains of matches, in text order.

        A match goes on from every place of its template where it stands, each
        time with the open chain that makes it cover most (one whose end is near
        and lies before that place), or begins a chain.  Chains stay open until
        the text has left them behind, whatever other ones hold; of chains within
        another of their template that covers as much, only that one is given.
        """
        open_: dict[int, list[list[int]]] = {}  # template: chains as first, after, covered, place in the template, whether gone on from
        ended: dict[int, list[list[int]]] = {}
        for start, n, state in matches:
            found: dict[int, list[int]] = {}
            for t, end in self.automaton.ends[state]:
                found.setdefault(t, []).append(end - n)
            for t, begins in found.items():
                near = []
                for chain in open_.get(t, ()):
                    (near if start - chain[1] <= MOST_GAP else ended.setdefault(t, [])).append(chain)
                new = []
                for begin in begins:
                    best, most = None, n
                    for chain in near:
                        overlap = max(0, chain[1] - start)
                        if begin + overlap >= chain[3] and n > overlap and chain[2] + n - overlap > most:
                            best, most = chain, chain[2] + n - overlap
                    if best:
                        best[4] = 1
                    new.append([best[0] if best else start, start + n, most, begin + n, 0])
                open_[t] = near + new
        out = []
        for t in {*open_, *ended}:
            holder = None
            for chain in sorted((c for c in ended.get(t, []) + open_.get(t, []) if not c[4]), key=lambda c: (c[0], -c[1], -c[2])):
                if holder and chain[1] <= holder[1] and chain[2] <= holder[2]:
                    continue
                out.append((t, *chain[:3]))
                if not holder or chain[1] >= holder[1]:
                    holder = chain
        return sorted(out, key=lambda c: (c[1], c[0], c[2]))


def _scan(scanner: Scanner, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, list, list]]:
    """(words, phrase places, chains) of each text of a slice."""
    words = Words(LOWER[data], offsets, NOT_ALNUM)
    number = scanner.number(words.hashes())
    n_texts = len(words.counts)
    text = words.text_of_words()
    known = number >= 0
    begin = known.copy()
    begin[1:] &= ~known[:-1] | (text[1:] != text[:-1])
    first = np.flatnonzero(begin)
    size = np.add.reduceat(known, first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)
    keep = size >= min([2, *(n for _, n in scanner.phrases)])  # shorter runs hold no phrase and no match
    found: dict[int, tuple[list, list]] = {}
    for a, n, t in zip(first[keep].tolist(), size[keep].tolist(), text[first[keep]].tolist(), strict=True):
        places, matches = found.setdefault(t, ([], []))
        scanner.stream(number[a:a + n].tolist(), a - int(words.offsets[t]), places, matches)
    for t in range(n_texts):
        places, matches = found.get(t, ([], []))
        yield int(words.counts[t]), places, scanner.chains(matches) if matches else []


def _labelling(scanner: Scanner, chains: list) -> list[tuple[int, int, int, int, float]]:
    out = []
    for t, first, after, covered in chains:
        share = covered / scanner.templates[t][1]
        if share >= LEAST_SHARE or covered >= ENOUGH_WORDS:
            out.append((t, first, after, covered, share))
    return out


def scan(docs: DataFrame, phrases: list[tuple[str, str]] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and spans.

    ``n_base`` counts the places of phrases, ``first_word`` and ``last_word`` are
    the smallest and largest start of one (NULL without any).  ``labels`` adds
    those of the templates whose spans cover enough.  ``score`` is the largest
    share of a template that a span covers; a phrase found is a share of 1.
    ``spans`` holds (label, first_word, words, covered, share).  NULL and empty
    texts have no words and no labels (empty strings); a text of any length is
    taken whole by one task.  A NULL doc_id is carried along, repeated rows are
    scanned each, and an empty table gives an empty result.  Other columns are
    not read.
    """
    scanner = Scanner.build(phrases, templates)
    span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("words", pa.int64()), ("covered", pa.int64()), ("share", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column("text")):
                rows = []
                for n, places, chains in _scan(scanner, data, offsets):
                    spans = _labelling(scanner, chains)
                    starts = [i for i, _ in places]
                    base = {scanner.phrases[p][0] for _, p in places}
                    more = {scanner.templates[t][0] for t, *_ in spans}
                    share = max([c / scanner.templates[t][1] for t, _, _, c in chains], default=0.0)
                    rows.append((n, len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
                                 ",".join(sorted(base | more)), 1.0 if base else share,
                                 [{"label": scanner.templates[t][0], "first_word": i, "words": j - i, "covered": c, "share": s} for t, i, j, c, s in spans]))
                columns = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(span)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_base long, first_word long, last_word long, "
             "base_labels string, labels string, score double, "
             "spans array<struct<label:string,first_word:long,words:long,covered:long,share:double>>")
