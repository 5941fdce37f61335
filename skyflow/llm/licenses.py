"""Licence detection with a generalised suffix automaton of licence texts.

The automaton holds every run of words of every template. A document is streamed through it, which
gives, for each word, the longest run ending there that some template contains: the matching
statistics. Long matches that continue each other in text and template are chained, and a chain's
share of its template is the coverage of that template.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyflow.llm import common

# Phrases that name a licence, with its label.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

# Sentences of well-known public licences and notices, with their labels.
TEMPLATES = [
    ("Released under the MIT License", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the Software), to deal in the Software without restriction, including without limitation "
     "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", "mit"),
    ("Licensed under the Apache License, Version 2.0", "apache"),
    ("you may not use this file except in compliance with the License. You may obtain a copy of the License at", "apache"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
     "option) any later version", "gpl"),
    ("GNU Lesser General Public License as published by the Free Software Foundation", "lgpl"),
    ("GNU Affero General Public License as published by the Free Software Foundation", "agpl"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met", "bsd"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted", "isc"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mpl"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc"),
    ("Licensed under CC BY-SA 4.0", "cc-by-sa"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
     "this work", "cc0"),
    ("This is free and unencumbered software released into the public domain", "unlicense"),
]

#: Words of a match that may start or continue a chain.
LONG_MATCH = 4
#: Words that may lie between two matches of a chain.
LONGEST_GAP = 8
#: Coverage from which a template counts as found.
COVERED = 0.8

MATCH = "array<struct<label:string,start:long,end:long,coverage:double>>"


def words_of(data: bytes) -> list[bytes]:
    """Words of a text: A-Z lower-cased, everything outside 0-9, a-z and non-ASCII separates."""
    return data.translate(common.LOWER_WORDS).split()


class SuffixAutomaton:
    """All runs of words of several texts, with where they end."""

    def __init__(self, texts: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]
        for number, text in enumerate(texts):
            last = 0
            for place, word in enumerate(text, 1):
                last = self._extend(last, word)
                self.ends[last].append((number, place))
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.ends[self.link[state]].extend(self.ends[state])

    def _state(self, length: int, link: int, arcs: dict[int, int]) -> int:
        self.next.append(arcs)
        self.link.append(link)
        self.length.append(length)
        self.ends.append([])
        return len(self.next) - 1

    def _split(self, before: int, word: int) -> int:
        """The state of the run that ``before`` and ``word`` make, cloned where it ends more often."""
        target = self.next[before][word]
        if self.length[target] == self.length[before] + 1:
            return target
        clone = self._state(self.length[before] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = clone
        while before >= 0 and self.next[before].get(word) == target:
            self.next[before][word] = clone
            before = self.link[before]
        return clone

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new, before = self._state(self.length[last] + 1, 0, {}), last
        while before >= 0 and word not in self.next[before]:
            self.next[before][word] = new
            before = self.link[before]
        if before >= 0:
            self.link[new] = self._split(before, word)
        return new

    def stream(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """Matching statistics: state and length of the longest known run that ends at each word."""
        state = length = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            yield state, length


class LicenseIndex:
    """Phrases and templates in one automaton, with what is needed to skip other text quickly."""

    def __init__(self, phrases: list[tuple[str, str]], templates: list[tuple[str, str]]):
        texts = [words_of(text.encode()) for text, _ in [*phrases, *templates]]
        self.labels = [label for _, label in [*phrases, *templates]]
        self.phrases = len(phrases)
        self.numbers = {w: i for i, w in enumerate(sorted({w for text in texts for w in text}), 1)}
        ids = [[self.numbers[w] for w in text] for text in texts]
        self.sizes = list(map(len, ids))
        self.automaton = SuffixAutomaton(ids)
        self.pairs = np.zeros((len(self.numbers) + 1,) * 2, bool)
        for text in ids:
            self.pairs[text[:-1], text[1:]] = True
        self.shortest = min([LONG_MATCH, *self.sizes[: self.phrases]])
        # Phrases that end wherever a state's runs end, by the state; a phrase is the longest run of its own state.
        self.own: dict[int, int] = {}
        for number in range(self.phrases):
            state = 0
            for word in ids[number]:
                state = self.automaton.next[state][word]
            self.own[state] = number
        self.ending: list[list[int]] = []
        for state in range(len(self.automaton.next)):
            found, at = [], self.automaton.link[state]
            while at > 0:
                if at in self.own:
                    found.append(self.own[at])
                at = self.automaton.link[at]
            self.ending.append(found)

    def scan(self, data: bytes) -> tuple[int, list[tuple], list[tuple]]:
        """Number of words, places of phrases, and covered spans of templates."""
        words = words_of(data)
        ids = np.fromiter(map(self.numbers.get, words, repeat(0)), np.int32, len(words))
        # A run of two words or more can only match where every pair of neighbours is known.
        known = np.concatenate([[False], self.pairs[ids[:-1], ids[1:]], [False]])
        edges = np.flatnonzero(known[1:] != known[:-1])
        places, matches = [], []
        for start, end in zip(edges[::2].tolist(), (edges[1::2] + 1).tolist(), strict=True):
            if end - start >= self.shortest:
                self._stream(ids[start:end].tolist(), start, places, matches)
        return len(words), places, self._chains(matches)

    def _stream(self, run: list[int], first: int, places: list[tuple], matches: list[tuple]) -> None:
        stats = [*self.automaton.stream(run), (0, 0)]
        for at, (state, length) in enumerate(stats[:-1]):
            end = first + at + 1
            ending = self.ending[state]
            if state in self.own and length == self.automaton.length[state]:
                ending = [*ending, self.own[state]]
            places.extend((self.labels[p], end - self.sizes[p], end) for p in ending)
            if length >= LONG_MATCH and stats[at + 1][1] <= length:
                matches.extend((n, end, place, length) for n, place in self.automaton.ends[state] if n >= self.phrases)

    def _chains(self, matches: list[tuple]) -> list[tuple]:
        """(label, first word, word after the last, share of the template) of covered templates."""
        open_: dict[int, list[int]] = {}
        found = []

        def close(number: int) -> None:
            start, end, _, covered = open_.pop(number)
            if covered >= COVERED * self.sizes[number]:
                found.append((self.labels[number], start, end, covered / self.sizes[number]))

        for number, end, place, length in sorted(matches, key=lambda m: (m[0], m[1], m[2])):
            if number in open_:
                _, last, last_place, _ = chain = open_[number]
                new = min(length, place - last_place)
                if place > last_place and new > 0 and last <= end - new <= last + LONGEST_GAP:
                    chain[1], chain[2], chain[3] = end, place, chain[3] + new
                    continue
                if end <= last:
                    continue
                close(number)
            open_[number] = [end - length, end, place, length]
        for number in [*open_]:
            close(number)
        return sorted(found, key=lambda f: (f[1], f[2], f[0]))


def scan(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: list[tuple[str, str]] = PHRASES,
    templates: list[tuple[str, str]] = TEMPLATES,
) -> DataFrame:
    """Rows (doc_id, n_words, phrases, templates), one per row of ``docs``.

    ``phrases`` are all places of the phrases with coverage 1, ``templates`` the chains that cover
    enough of a template; both have word numbers from 0, the end exclusive. Null and empty texts
    have no words and no places; repeated rows, null ids and other columns make no difference.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = LicenseIndex(phrases, templates)
        kind = pa.list_(
            pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())])
        )
        names = [field.name for field in kind.value_type]
        for batch in common.slices(batches):
            found = [index.scan(data) for data in common.as_bytes(batch["text"])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array([n for n, _, _ in found], pa.int64()),
                    pa.array([[dict(zip(names, (*x, 1.0), strict=True)) for x in places] for _, places, _ in found], kind),
                    pa.array([[dict(zip(names, x, strict=True)) for x in chains] for _, _, chains in found], kind),
                ],
                ["doc_id", "n_words", "phrases", "templates"],
            )

    return common.id_and_text(docs, id_col, text_col).mapInArrow(
        common.releasing(run), f"doc_id long, n_words long, phrases {MATCH}, templates {MATCH}"
    )


def report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: counts and places of phrases, labels of phrases and of all, best coverage."""
    joined = lambda column: F.array_join(F.array_sort(F.array_distinct(column)), ",")
    return scan(docs, **options).select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min("phrases.start").alias("first_word"),
        F.array_max("phrases.start").alias("last_word"),
        joined("phrases.label").alias("base_labels"),
        joined(F.concat("phrases.label", "templates.label")).alias("labels"),
        F.coalesce(F.array_max(F.concat("phrases.coverage", "templates.coverage")), F.lit(0.0)).alias("score"),
    )
