"""Licence scans with a generalised suffix automaton of licence templates.

One automaton holds every template (words of letters and digits, A-Z lowered). A file's words are streamed through it,
which gives at each word the longest template substring that ends there (matching statistics). Matches of at least
MIN_MATCH words that cannot be longer are chained, template by template, with the places they have in the template: a
chain goes on in the text, over gaps of up to MAX_GAP words, and in the template, and counts each word of the template
once, so repeated or shuffled fragments don't add up. A chain that covers MIN_COVER of its template is a labelled span;
the best come first and spans of a template don't overlap. Base phrases are templates too: they are found, overlaps
included, where a phrase is a suffix of the present match.

Words outside the templates break every match, so only runs of template words are streamed, and only those with a word
that every match must hold (RARE: checked against the templates when the automaton is built). The automaton is a few
thousand states, whatever the data.

Defined cases: a null text is empty: no words, no labels, score 0. Repeated rows are scanned one by one. Only doc_id
and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacunar.llm.textops import IS_ALNUM, Words, slices

MIN_MATCH, MAX_GAP, MIN_COVER = 4, 3, 0.8

# The base phrases and the wording of public licence notices.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0-1.0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
COMMON = frozenset("the of and to a in is or for this that with by as on be are it any at you may not if its an from can was use all".split())


class Automaton:
    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES, base: tuple[tuple[str, str], ...] = BASE, min_match: int = MIN_MATCH):
        self.base = [(tuple(p.split()), label) for p, label in base]
        self.templates = [(tuple(t.split()), label) for label, t in templates]
        self.min_match = min_match
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.vocab: dict[str, int] = {}
        ends = []
        for k, (words, _) in enumerate([*self.templates, *self.base]):
            last = 0
            for w in words:
                last = self._extend(last, self.vocab.setdefault(w, len(self.vocab)))
            ends.append(last)
        self.ends: list[dict[int, list[int]]] = [{} for _ in self.next]  # of each state, by template: where its strings end
        for k, (words, _) in enumerate(self.templates):
            s = 0
            for i, w in enumerate(words, 1):
                s = v = self.next[s][self.vocab[w]]
                while v > 0:
                    self.ends[v].setdefault(k, []).append(i)
                    v = self.link[v]
        own: dict[int, list[int]] = {}
        for b, (words, _) in enumerate(self.base):
            s = 0
            for w in words:
                s = self.next[s][self.vocab[w]]
            own.setdefault(s, []).append(b)
        self.phrases: list[tuple[int, ...]] = [()] * len(self.next)  # phrases that end where a match in this state does
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.phrases[s] = (*self.phrases[self.link[s]], *own.get(s, ()))
        rare = set(self.vocab) - COMMON
        for words in [w for w, _ in self.templates]:
            for i in range(len(words) - min_match + 1):
                if not rare.intersection(part := words[i : i + min_match]):
                    rare.add(part[0])
        for words, _ in self.base:
            if not rare.intersection(words):
                rare.add(words[0])
        self.rare = np.zeros(len(self.vocab) + 1, bool)
        self.rare[[self.vocab[w] for w in rare]] = True

    def _extend(self, last: int, c: int) -> int:
        def clone(p: int, q: int) -> int:
            n = len(self.next)
            self.next.append(dict(self.next[q]))
            self.link.append(self.link[q])
            self.length.append(self.length[p] + 1)
            while p != -1 and self.next[p].get(c) == q:
                self.next[p][c] = n
                p = self.link[p]
            self.link[q] = n
            return n

        if (q := self.next[last].get(c)) is not None:
            return q if self.length[q] == self.length[last] + 1 else clone(last, q)
        new = len(self.next)
        self.next.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p != -1:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else clone(p, q)
        return new

    def stream(self, codes: list[int]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
        """For a run of template words: (start, phrase) of the base phrases; (start, end, state) of the longest matches."""
        places, matches = [], []
        state = matched = 0
        for i, c in enumerate(codes):
            if c not in self.next[state] and matched >= self.min_match:
                matches.append((i - matched, i, state))
            while state and c not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if c in self.next[state]:
                state, matched = self.next[state][c], matched + 1
            for b in self.phrases[state]:
                if (n := len(self.base[b][0])) <= matched:
                    places.append((i + 1 - n, b))
        if matched >= self.min_match:
            matches.append((len(codes) - matched, len(codes), state))
        return places, matches

    def chains(self, matches: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """(label, start, end, covered share) of every template's chains of matches that cover MIN_COVER, the best first
        and none over another, or else of its best chain; by label and place."""
        anchors: dict[int, list[tuple[int, int, int]]] = {}
        for a, b, state in matches:
            for k, ends in self.ends[state].items():
                anchors.setdefault(k, []).extend((a, b, e) for e in ends)
        out = []
        for k, mine in anchors.items():
            words, label = self.templates[k]
            total, start = self._joined(mine)
            order = sorted(range(len(mine)), key=lambda i: (-total[i], mine[i][1]))
            taken: list[tuple[int, int]] = []
            for i in order:
                share, span = total[i] / len(words), (start[i], mine[i][1])
                if taken and share < MIN_COVER:
                    break
                if all(span[1] <= a or b <= span[0] for a, b in taken):
                    taken.append(span)
                    out.append((label, *span, share))
                    if share < MIN_COVER:
                        break
        return sorted(out)

    @staticmethod
    def _joined(anchors: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
        """For each (start, end, end in the template), by place: how many different words of the template the best chain
        up to it covers, and where that chain starts. A chain goes on in the text and in the template; what an anchor
        shares with the one before it counts once."""
        total, start = [], []
        low = 0
        for j, (a, b, e) in enumerate(anchors):
            n = b - a
            best, first = n, a
            while anchors[low][1] < a - MAX_GAP:
                low += 1
            for i in range(low, j):
                _, stop, end = anchors[i]
                shared = max(0, stop - a, end - (e - n))
                if end < e and shared < n and a + shared - stop <= MAX_GAP and total[i] + n - shared > best:
                    best, first = total[i] + n - shared, start[i]
            total.append(best)
            start.append(first)
        return total, start


SCAN = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label: string, start: long, stop: long, covered: double>>"
_SPAN = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("covered", pa.float64())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    auto = Automaton()
    for batch in batches:
        for part in slices(batch, "text"):
            words = Words(part.column("text"), IS_ALNUM, lower=True)
            index, distinct = words.coded()
            known = np.array([auto.vocab.get(w.decode("utf-8", "replace"), -1) for w in distinct.to_pylist()], dtype=np.int32)
            codes = known[index] if len(index) else np.zeros(0, np.int32)
            inside = codes >= 0
            row = np.repeat(np.arange(len(part)), np.diff(words.docs))
            starts = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1] | (row[1:] != row[:-1])])) if len(codes) else np.zeros(0, np.int64)
            stops = np.flatnonzero(inside & np.concatenate([~inside[1:] | (row[1:] != row[:-1]), [True]])) + 1 if len(codes) else np.zeros(0, np.int64)
            rare = np.concatenate([[0], np.cumsum(inside & auto.rare[codes])])
            some = (stops - starts >= 2) & (rare[stops] > rare[starts])
            found: dict[int, tuple[list, list]] = {}
            for a, b in zip(starts[some].tolist(), stops[some].tolist(), strict=True):
                places, matches = auto.stream(codes[a:b].tolist())
                if places or matches:
                    d = int(row[a])
                    at = a - int(words.docs[d])
                    p, m = found.setdefault(d, ([], []))
                    p += [(at + s, k) for s, k in places]
                    m += [(at + s, at + e, v) for s, e, v in matches]
            n = len(part)
            n_base, first, last = [0] * n, [None] * n, [None] * n
            base_labels, labels, scores, spans = [""] * n, [""] * n, [0.0] * n, [[] for _ in range(n)]
            for d, (places, matches) in found.items():
                chains = auto.chains(matches)
                own = {auto.base[k][1] for _, k in places}
                if places:
                    n_base[d], first[d], last[d] = len(places), min(places)[0], max(places)[0]
                    base_labels[d] = ",".join(sorted(own))
                whole = [c for c in chains if c[3] >= MIN_COVER]
                labels[d] = ",".join(sorted(own | {c[0] for c in whole}))
                scores[d] = 1.0 if places else max((c[3] for c in chains), default=0.0)
                spans[d] = [{"label": label, "start": a, "stop": b, "covered": share} for label, a, b, share in whole]
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"), "n_words": pa.array(np.diff(words.docs)), "n_base": pa.array(n_base, pa.int64()), "first_word": pa.array(first, pa.int64()), "last_word": pa.array(last, pa.int64()),
                "base_labels": pa.array(base_labels, pa.string()), "labels": pa.array(labels, pa.string()), "score": pa.array(scores, pa.float64()), "spans": pa.array(spans, _SPAN),
            })


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Base places, labels, the best covered share and the labelled spans (in words) of every document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_scan, SCAN)
