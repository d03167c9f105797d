"""License scan: matching statistics of a generalised suffix automaton, chained into covered template spans.

The automaton of all template token sequences is a few thousand states, built once per worker. A document is streamed
through it word by word; stretches of words that no template uses reset the state, so they are skipped without a step.
Every maximal match of at least `MIN_MATCH` words is a template interval; matches of one template that follow each other
in the document and in the template are chained, and a chain that covers enough of its template is a span.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelkit.llm.common import blocks, id_and_text
from panelkit.llm.hashing import WORD_BYTES

#: Phrases whose places are the base result, with their labels.
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Openings of public licence notices, by label.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
)

MIN_MATCH = 4  # words of a match that enters a chain
MAX_GAP = 6  # words that may lie between two matches of a chain, in the document and in the template
COVERED = 0.8  # share of a template's words a chain must cover
_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
     ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.string())]
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class SuffixAutomaton:
    """Of several token sequences; each state knows every (template, end) at which its longest string ends."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, ends = [-1], [0], [set()]
        for number, tokens in enumerate(sequences):
            last = 0
            for at, token in enumerate(tokens):
                last = self._extend(last, token, ends)
                ends[last].add((number, at + 1))
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            ends[self.link[state]] |= ends[state]
        self.ends = [sorted(x) for x in ends]

    def _state(self, like: int | None, length: int, ends: list[set]) -> int:
        self.next.append(dict(self.next[like]) if like is not None else {})
        self.link.append(self.link[like] if like is not None else 0)
        self.length.append(length)
        ends.append(set())
        return len(self.link) - 1

    def _split(self, state: int, target: int, token: int, ends: list[set]) -> int:
        """The state for the suffixes of `target` no longer than those that `state` extends by the token."""
        if self.length[target] == self.length[state] + 1:
            return target
        clone = self._state(target, self.length[state] + 1, ends)
        self.link[target] = clone
        while state >= 0 and self.next[state].get(token) == target:
            self.next[state][token] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, token: int, ends: list[set]) -> int:
        if token in self.next[last]:
            return self._split(last, self.next[last][token], token, ends)
        new, state = self._state(None, self.length[last] + 1, ends), last
        while state >= 0 and token not in self.next[state]:
            self.next[state][token] = new
            state = self.link[state]
        self.link[new] = 0 if state < 0 else self._split(state, self.next[state][token], token, ends)
        return new

    def matches(self, tokens: list[int], least: int) -> list[tuple[int, int, int]]:
        """(end, length, state) of each match that cannot be made longer to the right, `least` tokens or more."""
        out, state, length = [], 0, 0
        for at, token in enumerate(tokens):
            kept = (at, length, state)
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if token in self.next[state]:
                state, length = self.next[state][token], length + 1
            else:
                length = 0
            if kept[1] >= least and length <= kept[1]:
                out.append(kept)
        if length >= least:
            out.append((len(tokens), length, state))
        return out


class Scanner:
    """Finds template spans in word lists; holds only the templates."""

    def __init__(self, templates=TEMPLATES):
        self.labels = [label for label, _ in templates]
        sequences = [words_of(text.encode()) for _, text in templates]
        self.ids = {w: i for i, w in enumerate(sorted({w for s in sequences for w in s}))}
        self.sizes = [len(s) for s in sequences]
        self.automaton = SuffixAutomaton([[self.ids[w] for w in s] for s in sequences])
        # a template shorter than the least match could never be found
        self.least = min([MIN_MATCH, *self.sizes])

    def spans(self, words: list[bytes]) -> list[tuple[int, int, str, float]]:
        """(start, end, label, coverage) in words, in order of start."""
        get = self.ids.get
        codes = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        known = np.flatnonzero(codes >= 0)
        if len(known) < self.least:
            return []
        found = []
        for run in np.split(known, np.flatnonzero(np.diff(known) > 1) + 1):
            if len(run) >= self.least:
                base = int(run[0])
                found += [(base + e, n, s) for e, n, s in self.automaton.matches(codes[run].tolist(), self.least)]
        # open chains by template: [start in text, end in text, end in template, words covered]
        # open chains by template: [start in text, end in text, end in template, words covered]
        open_chains: dict[int, list[list[int]]] = {}
        out: dict[tuple[int, str], tuple[int, int, str, float]] = {}
        for end, length, state in found:
            for template, at in self.automaton.ends[state]:
                # only chains that this or a later match can still continue stay open
                chains = [c for c in open_chains.get(template, ()) if c[1] >= end - length - MAX_GAP]
                best, overlap = None, 0
                for chain in chains:
                    gap_text, gap_template = end - length - chain[1], at - length - chain[2]
                    shared = max(0, -min(gap_text, gap_template))
                    if gap_template <= MAX_GAP and shared < length and end > chain[1] and at > chain[2]:
                        if best is None or chain[3] - shared > best[3] - overlap:
                            best, overlap = chain, shared
                added = [[end - length, end, at, length]]
                if best:
                    added.append([best[0], end, at, best[3] + length - overlap])
                open_chains[template] = chains + added
                for start, _, _, covered in added:
                    share, key = min(1.0, covered / self.sizes[template]), (start, self.labels[template])
                    if share >= COVERED and (key not in out or (share, end) > (out[key][3], out[key][1])):
                        out[key] = (start, end, self.labels[template], share)
        return sorted(out.values())


def base_places(words: list[bytes], text: bytes) -> list[tuple[int, str]]:
    """Each place (first word's index) of each base phrase. `text` is only asked whether a last word occurs at all."""
    out = []
    for phrase, label in BASE_PHRASES:
        parts = phrase.encode().split()
        if parts[0] not in text or parts[-1] not in text:
            continue
        at, first = -1, parts[0]
        while True:
            try:
                at = words.index(first, at + 1)
            except ValueError:
                break
            if words[at : at + len(parts)] == parts:
                out.append((at, label))
    return out


def scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """One row per document: word count, base phrase places, labels, best template coverage, spans.

    Nulls and empty texts have no words, no labels and score 0; equal rows give equal rows; an empty table gives none;
    other columns are ignored. A document is scanned whole; work and memory are linear in its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for ids, texts in blocks(batches):
            rows = []
            for doc_id, raw in zip(ids, texts, strict=True):
                text = raw.translate(WORD_BYTES)
                words = text.split()
                places = base_places(words, text)
                spans = scanner.spans(words)
                base = sorted({label for _, label in places})
                rows.append(
                    (doc_id, len(words), len(places), min((p for p, _ in places), default=None), max((p for p, _ in places), default=None),
                     ",".join(base), ",".join(sorted({*base, *(s[2] for s in spans)})), max((s[3] for s in spans), default=0.0),
                     ",".join(f"{label}:{start}:{end}" for start, end, label, _ in spans))
                )
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)

    return id_and_text(docs).mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans string"
    )
