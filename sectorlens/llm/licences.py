"""Operator 2: licence scans with a generalised suffix automaton of licence tokens.

All templates and base phrases go into one automaton over word numbers. A
document streams through it once; at each word the automaton knows the
longest stretch ending there that occurs in some template (the matching
statistics), and by its suffix links the longest of every other template.
Stretches that cannot be longer are chained, in order, along a template: every
stretch starts a chain and extends all that it fits, and of chains that share
words the one that covers most is kept. A chain that covers enough is a span
with the template's label. A base phrase ends wherever the matched stretch
ends with it.

Defined cases: a null text counts as empty; texts without words have n_words
0, no spans, score 0 and empty labels; every row gives one row, repeated rows
alike; input columns named like an output column are replaced by it.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame

from .textmap import map_texts
from .words import alnum_words

# The base phrases with their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Sentences by which licences are commonly stated, with the label each supports.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2.0", "distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("mit-notice", "released under the mit license"),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software"
                   " and associated documentation files"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("gpl-notice", "you can redistribute it and or modify it under the terms of the gnu general public license"
                   " as published by the free software foundation"),
    ("lgpl-notice", "licensed under the gnu lesser general public license"),
    ("bsd-notice", "redistribution and use in source and binary forms with or without modification are permitted"
                   " provided that the following conditions are met"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license"),
)
MIN_MATCH, MAX_GAP, COVER = 3, 8, 0.9
OUT = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
       "spans array<struct<label:string,start:int,end:int,cover:double>>")


class Automaton:
    """Generalised suffix automaton of token sequences, with the places where each state's strings end."""

    def __init__(self, sequences: Sequence[Sequence[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for n, sequence in enumerate(sequences):
            last = 0
            for i, token in enumerate(sequence):
                last = self._extend(last, token)
                self.ends[last].add((n, i + 1))
        for state in sorted(range(1, len(self.size)), key=lambda s: -self.size[s]):
            self.ends[self.link[state]] |= self.ends[state]

    def _add(self, size: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.size.append(size)
        self.link.append(link)
        self.ends.append(set())
        return len(self.size) - 1

    def _split(self, state: int, token: int, target: int) -> int:
        copy = self._add(self.size[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(token) == target:
            self.next[state][token] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, token: int) -> int:
        target = self.next[last].get(token)
        if target is not None:  # an earlier sequence has this stretch
            return target if self.size[target] == self.size[last] + 1 else self._split(last, token, target)
        new = self._add(self.size[last] + 1, {}, 0)
        state = last
        while state >= 0 and token not in self.next[state]:
            self.next[state][token] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][token]
            self.link[new] = target if self.size[target] == self.size[state] + 1 else self._split(state, token, target)
        return new

    def statistics(self, tokens: Sequence[int]) -> Iterator[tuple[int, int]]:
        """(length, state) of the longest known stretch that ends at each token."""
        state = length = 0
        for token in tokens:
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.size[state]
            if token in self.next[state]:
                state = self.next[state][token]
                length += 1
            yield length, state


class Scanner:
    """The automaton of templates and phrases, and the scan of one document."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        self.terms: dict[bytes, int] = {}

        def numbers(text: str) -> list[int]:
            return [self.terms.setdefault(w, len(self.terms)) for w in alnum_words(text.encode())]
        self.labels = [label for label, _ in templates]
        self.base = [label for _, label in phrases]
        self.sequences = [numbers(t) for _, t in templates] + [numbers(p) for p, _ in phrases]
        self.automaton = Automaton(self.sequences)
        # for each state the phrases that its strings end with, if long enough
        self.phrases: list[list[tuple[int, int]]] = [[] for _ in self.automaton.size]
        for state in range(1, len(self.automaton.size)):
            n, end = min(self.automaton.ends[state])
            longest = self.sequences[n][end - self.automaton.size[state]:end]
            for i, p in enumerate(self.sequences[len(templates):]):
                if longest[len(longest) - len(p):] == p:
                    self.phrases[state].append((i, len(p)))
        # for each state (template, end in it, length) of the longest stretches; length 0 stands for the matched one
        self.places: list[list[tuple[int, int, int]]] = [[] for _ in self.automaton.size]
        for state in range(1, len(self.automaton.size)):
            seen, at = set(), state
            while self.automaton.size[at] >= MIN_MATCH:
                new = {e for e in self.automaton.ends[at] if e[0] < len(self.labels)} - seen
                self.places[state] += [(n, stop, self.automaton.size[at] if at != state else 0) for n, stop in sorted(new)]
                seen |= new
                at = self.automaton.link[at]

    def scan(self, words: list[bytes]):
        """(places of base phrases, matched stretches as (template, start, end, end in the template)) of a document's words."""
        get = self.terms.get
        ids = np.fromiter((get(w, -1) for w in words), dtype=np.int32, count=len(words))
        known = np.flatnonzero(ids >= 0)
        places, stretches = [], []
        if len(known) < 2:
            return places, stretches
        for run in np.split(known, np.flatnonzero(np.diff(known) > 1) + 1):  # a foreign word ends every stretch
            if len(run) < 2:
                continue
            first, tokens = int(run[0]), [*ids[run].tolist(), -1]
            for i, (length, state) in enumerate(self.automaton.statistics(tokens[:-1]), 1):
                if length >= MIN_MATCH:
                    for n, stop, size in self.places[state]:
                        if stop == len(self.sequences[n]) or self.sequences[n][stop] != tokens[i]:
                            stretches.append((n, first + i - (size or length), first + i, stop))
                for phrase, size in self.phrases[state]:
                    if length >= size:
                        places.append((first + i - size, phrase))
        return places, stretches

    def chains(self, stretches) -> tuple[list[tuple[str, int, int, float]], float]:
        """((label, start, end, cover) of the spans, best cover of any chain).

        Per template, the most words matched are kept for each last stretch
        and start of a chain. Longer chains than ``reach`` need no look: they
        have a part that covers as much.
        """
        spans, best = [], 0.0
        of: dict[int, list[tuple[int, int, int]]] = {}
        for n, start, end, stop in stretches:
            of.setdefault(n, []).append((end, start, stop))
        for n, mine in of.items():
            size = len(self.sequences[n])
            reach = 3 * size + MAX_GAP
            found: list[tuple[float, int, int]] = []
            recent: deque[tuple[int, int, dict[int, int]]] = deque()  # end, end in the template, start: words matched
            for end, start, stop in sorted(mine):
                while recent and recent[0][0] < end - size - MAX_GAP:
                    recent.popleft()
                chains = {start: end - start}
                for till, reached, others in recent:
                    cut = max(till - start, reached - stop + end - start, 0)
                    if stop > reached and start - till <= MAX_GAP and cut < end - start:
                        for first, matched in others.items():
                            if first < start and end - first <= reach:
                                chains[first] = max(chains.get(first, 0), matched + end - start - cut)
                recent.append((end, stop, chains))
                for first, matched in chains.items():
                    cover = matched / max(size, end - first)
                    best = max(best, cover)
                    if cover >= COVER:
                        found.append((-cover, first, end))
            taken: list[tuple[int, int]] = []
            for cover, start, end in sorted(found):
                at = bisect_left(taken, (start, end))
                if (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or end <= taken[at][0]):
                    taken.insert(at, (start, end))
                    spans.append((self.labels[n], start, end, -cover))
        return sorted(spans, key=lambda c: (c[1], c[2], c[0])), best

    def row(self, words: list[bytes]) -> tuple:
        places, stretches = self.scan(words)
        spans, best = self.chains(stretches)
        base = {self.base[p] for _, p in places}
        starts = [s for s, _ in places]
        return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
                ",".join(sorted(base | {c[0] for c in spans})), best,
                [dict(zip(("label", "start", "end", "cover"), c)) for c in spans])


def scan_licences(docs: DataFrame, keep: Sequence[str] = ("doc_id",), templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """``keep`` columns plus n_words, n_base, first_word, last_word, base_labels, labels, score, spans."""
    def make():
        scanner = Scanner(templates, phrases)
        return lambda texts, _: list(zip(*[scanner.row(alnum_words(t)) for t in texts]))
    return map_texts(docs, "text", keep, OUT, make)
