"""License scans: matching statistics from a suffix automaton, chained into template spans."""

from __future__ import annotations

from bisect import bisect, bisect_left
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_words, map_texts

#: Phrases and their labels. Fixed values.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: License templates by label: notices and opening grants as licensors publish them. Fixed values.
TEMPLATES = {
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software without
        restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software""",
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
        this file except in compliance with the License. You may obtain a copy of the License at""",
    "gpl-3.0": "licensed under the GNU General Public License, version 3",
    "gpl-notice": """This program is free software: you can redistribute it and/or modify it under the terms
        of the GNU General Public License as published by the Free Software Foundation, either version 3
        of the License, or (at your option) any later version.""",
    "bsd-text": """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met""",
    "isc-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission notice
        appear in all copies""",
    "mpl-2.0-notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.
        If a copy of the MPL was not distributed with this file""",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0": "licensed under a Creative Commons Attribution 4.0 International License",
    "mit-notice": "Released under the MIT License",
}
#: A match counts from this many words on; matches are chained over gaps of up to
#: MOST_GAP words in text and template; a span is a label's when it covers
#: LEAST_COVER of the template's words.
LEAST_MATCH, MOST_GAP, LEAST_COVER = 3, 8, 0.6


class SuffixAutomaton:
    """All substrings of several word sequences, as one minimal automaton.

    Each state knows all places, as (sequence, position), where its strings end.
    """

    def __init__(self, sequences: Sequence[Sequence[int]]):
        self.length, self.link, self.next = [0], [-1], [{}]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for number, sequence in enumerate(sequences):
            last = 0
            for at, word in enumerate(sequence):
                last = self._extend(last, word)
                self.ends[last].add((number, at))
        # What ends at a state ends at the states of its suffixes too.
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.ends[self.link[state]] |= self.ends[state]

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        self.ends.append(set())
        return len(self.length) - 1

    def _split(self, state: int, word: int) -> int:
        """The state that holds exactly ``state``'s string and ``word``, parted off if need be."""
        target = self.next[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new, state = self._state(self.length[last] + 1, 0, {}), last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, word)
        return new

    def places(self, state: int, length: int, least: int) -> Iterator[tuple[int, int, int]]:
        """(sequence, position, words) of every place that the match ends at with ``least`` words or more.

        The longest match's own places come first; those of its suffixes, on the way
        up, have that suffix in common with it and not a word more.
        """
        seen: set[tuple[int, int]] = set()
        while state > 0 and length >= least:
            for place in self.ends[state] - seen:
                yield (*place, length)
            seen |= self.ends[state]
            state = self.link[state]
            length = self.length[state]

    def find(self, sequence: Sequence[int]) -> int:
        state = 0
        for word in sequence:
            state = self.next[state][word]
        return state

    def statistics(self, words: Sequence[int]) -> Iterator[tuple[int, int]]:
        """After each word, the state and length of the longest suffix that is in a sequence."""
        state = length = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            yield state, length


class LicenseScanner:
    """The automaton of phrases and templates, and what it finds in a list of words."""

    def __init__(self, phrases: Mapping[str, str], templates: Mapping[str, str]):
        self.phrase_labels = list(phrases.values())
        self.labels = list(templates)
        texts = [byte_words(t.encode()) for t in [*phrases, *templates.values()]]
        self.ids = {w: i for i, w in enumerate(dict.fromkeys(w for t in texts for w in t))}
        sequences = [[self.ids[w] for w in t] for t in texts]
        self.phrases, self.templates = sequences[: len(phrases)], sequences[len(phrases) :]
        self.automaton = SuffixAutomaton(sequences)
        self.shortest = min([LEAST_MATCH, *map(len, self.phrases)])
        # The phrases that end wherever a state is reached: those on its way of suffixes.
        at = {self.automaton.find(p): (i, len(p)) for i, p in enumerate(self.phrases)}
        self.ending: list[list[tuple[int, int]]] = [[] for _ in self.automaton.length]
        for state in range(1, len(self.ending)):
            up = state
            while up > 0:
                if up in at:
                    self.ending[state].append(at[up])
                up = self.automaton.link[up]

    def runs(self, words: list[bytes]) -> Iterator[tuple[int, list[int]]]:
        """Stretches of words that all stand in a phrase or template, as long as the shortest match or longer."""
        ids = np.fromiter(map(self.ids.get, words, _minus_ones()), np.int32, len(words))
        known = np.concatenate(([0], (ids >= 0).view(np.int8), [0]))
        edges = np.diff(known)
        for start, stop in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True):
            if stop - start >= self.shortest:
                yield int(start), ids[start:stop].tolist()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, float]]]:
        """Places (start, phrase) and spans (template, start, stop, share covered)."""
        places, matches = [], {}
        for offset, ids in self.runs(words):
            state = length = 0
            for i, (following, grown) in enumerate(self.automaton.statistics(ids)):
                if length >= LEAST_MATCH:
                    self._note(matches, state, length, offset + i, ids[i])
                state, length = following, grown
                for phrase, size in self.ending[state]:
                    if length >= size:
                        places.append((offset + i + 1 - size, phrase))
            if length >= LEAST_MATCH:
                self._note(matches, state, length, offset + len(ids), -1)
        spans = [span for template, found in matches.items() for span in self._chains(template, found)]
        return places, sorted(spans, key=lambda s: (s[1], s[2], s[0]))

    def _note(self, matches: dict, state: int, length: int, stop: int, following: int) -> None:
        """The matches that end before word ``stop`` and do not go on with it, as (start, stop, from, to)."""
        first = len(self.phrases)
        for number, at, size in self.automaton.places(state, length, LEAST_MATCH):
            if number >= first:
                words = self.templates[number - first]
                if at + 1 == len(words) or words[at + 1] != following:
                    matches.setdefault(number - first, []).append((stop - size, stop, at + 1 - size, at + 1))

    def _chains(self, template: int, found: list[tuple[int, int, int, int]]) -> Iterator[tuple[int, int, int, float]]:
        """Chains of matches that go on in text and in template, as spans with their cover.

        By dynamic programming each match ends the chain that covers most; of the
        chains that cover enough the best is a span, then the best of those that do
        not overlap it, and so on.
        """
        size = len(self.templates[template])
        found.sort(key=lambda m: (m[1], m[3], m[0]))
        covered, starts, stops = [], [], [m[1] for m in found]
        for i, (a, b, c, d) in enumerate(found):
            best, start = b - a, a
            for j in range(bisect_left(stops, a - MOST_GAP, 0, i), i):
                _, stop, _, end = found[j]
                gain = min(b - max(a, stop), d - max(c, end))
                if gain > 0 and c - end <= MOST_GAP and covered[j] + gain > best:
                    best, start = covered[j] + gain, starts[j]
            covered.append(best)
            starts.append(start)
        taken: list[tuple[int, int]] = []
        for i in sorted(range(len(found)), key=lambda i: (-covered[i], found[i][1] - starts[i], starts[i])):
            if covered[i] < LEAST_COVER * size:
                break
            start, stop = starts[i], found[i][1]
            at = bisect(taken, (start, stop))
            if (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or stop <= taken[at][0]):
                taken.insert(at, (start, stop))
                yield template, start, stop, min(1.0, covered[i] / size)


def _minus_ones() -> Iterator[int]:
    while True:
        yield -1


SCAN_FIELDS = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
    " score double, spans array<struct<label:string,start:bigint,stop:bigint,cover:double>>"
)


def scan_licenses(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    phrases: Mapping[str, str] = BASE_PHRASES,
    templates: Mapping[str, str] = TEMPLATES,
) -> DataFrame:
    """Every row's licenses: base phrases by count and place, template spans by cover.

    One narrow pass without a shuffle. Each task builds the automaton of some
    hundred template words once and streams the words of its texts through it:
    after each word the longest suffix known to a template (the matching
    statistics) is at hand. Maximal matches of a few words are chained into
    spans, and a span that covers enough of a template adds the template's
    label. ``score`` is 1 with a base phrase, else the best cover of a span.

    Null counts as the empty text: no words, no labels (empty strings), score 0.
    Very long texts are streamed whole; repeated rows are scanned each for
    itself; the id may be null or of any type; other columns are ignored.
    """
    fields = dict(phrases), dict(templates)

    def start():
        scanner = LicenseScanner(*fields)
        return lambda text: _report(scanner, byte_words(text))

    return map_texts(docs, [id_column], F.col(text_column), SCAN_FIELDS, start)


def _report(scanner: LicenseScanner, words: list[bytes]) -> tuple:
    places, spans = scanner.scan(words)
    starts = [start for start, _ in places]
    base = {scanner.phrase_labels[p] for _, p in places}
    labels = base | {scanner.labels[t] for t, *_ in spans}
    return (
        len(words),
        len(places),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(labels)),
        1.0 if base else max((cover for *_, cover in spans), default=0.0),
        [{"label": scanner.labels[t], "start": a, "stop": b, "cover": c} for t, a, b, c in spans],
    )
