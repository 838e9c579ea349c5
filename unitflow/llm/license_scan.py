"""Licence scan: a generalised suffix automaton over the tokens of licence templates.

The automaton of all templates is built once; each state knows every place of every template where its strings end. Each text's
words are streamed through it; the matching statistics (the longest suffix of what was read that occurs in a template)
give maximal matches of at least ``MIN_RUN`` words, and for templates that have only the end of such a match, that end. The
matches of one template are chained, in order in both the text and the template, by dynamic programming, into spans.
A span gives its template's label if it covers enough of it and has a match that stands in no template of another label:
what licences have in common tells none of them. The base phrases are counted by the same stream over word numbers.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_text

#: Phrases whose places are counted, and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Names in licence families, by label.
GNU = {"gpl": ("general public license", "2 3"), "lgpl": ("lesser general public license", "2.1 3"), "agpl": ("affero general public license", "3")}
CREATIVE = {"by": "attribution", "by-sa": "attribution sharealike", "by-nc": "attribution noncommercial", "by-nd": "attribution noderivatives", "by-nc-sa": "attribution noncommercial sharealike", "by-nc-nd": "attribution noncommercial noderivatives"}
#: Usual wordings of licences and their notices, by label; several of one label stand apart by "|".
WORDINGS = {
    "apache-2.0": """licensed under the apache license version 2.0 | licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license
        you may obtain a copy of the license at http www apache org licenses license 2.0 unless required by applicable law or agreed to in
        writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either
        express or implied see the license for the specific language governing permissions and limitations under the license""",
    "bsd-2-clause": """redistribution and use in source and binary forms with or without modification are permitted provided that the following
        conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the following
        disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
        in the documentation and or other materials provided with the distribution this software is provided by the copyright holders and
        contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and
        fitness for a particular purpose are disclaimed""",
    "bsd-3-clause": """neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
        derived from this software without specific prior written permission""",
    "bsl-1.0": """boost software license version 1.0 | permission is hereby granted free of charge to any person or organization obtaining a copy
        of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit
        the software and to prepare derivative works of the software""",
    "cc0-1.0": """to the extent possible under law the author has waived all copyright and related or neighboring rights to this work |
        creative commons zero v1.0 universal | cc0 1.0 universal public domain dedication""",
    "isc": """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the
        above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all
        warranties with regard to this software including all implied warranties of merchantability and fitness""",
    "mit": """released under the mit license | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
        the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish
        distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to
        the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions
        of the software the software is provided as is without warranty of any kind express or implied including but not limited to the
        warranties of merchantability fitness for a particular purpose and noninfringement""",
    "mpl-2.0": """this source code form is subject to the terms of the mozilla public license v 2.0 if a copy of the mpl was not distributed with
        this file you can obtain one at http mozilla org mpl 2.0 | mozilla public license version 2.0""",
    "unlicense": """this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or
        distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means""",
    "zlib": """this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages
        arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications
        and to alter it and redistribute it freely subject to the following restrictions the origin of this software must not be misrepresented""",
}


def usual_templates() -> dict[str, list[str]]:
    """Wordings by label: those above, and those of the families by their names and versions."""
    out = {label: [t.strip() for t in text.split("|")] for label, text in WORDINGS.items()}
    for label, (name, versions) in GNU.items():
        for v in versions.split():
            out[f"{label}-{v if '.' in v else v + '.0'}"] = [
                f"licensed under the gnu {name} version {v}",
                f"this program is free software you can redistribute it and or modify it under the terms of the gnu {name} as published by the free software foundation either version {v} of the license or at your option any later version",
            ]
    for code, name in CREATIVE.items():
        for v, kind in (("3.0", "unported"), ("4.0", "international")):
            out[f"cc-{code}-{v}"] = [f"licensed under a creative commons {name} {v} {kind} license", f"licensed under cc {code} {v}"]
    return out


#: Words are runs of other bytes than these; A-Z are lower-cased first.
OTHER = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
CLEAN = bytes(0x20 if FOLD[b] in OTHER else FOLD[b] for b in range(256))
MIN_RUN, MIN_COVERED, MIN_SHARE, MAX_GAP = 3, 5, 0.15, 12


def words_of(text: bytes) -> list[bytes]:
    return text.translate(CLEAN).split()


class Automaton:
    """Generalised suffix automaton. ``ends[s]``: all (template, position after) where state s's strings end, for states of ``least`` words or more."""

    def __init__(self, templates: list[list[int]], least: int = 1):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.least = [-1], [0], least
        prefixes = []
        for k, words in enumerate(templates):
            last = 0
            for at, w in enumerate(words):
                last = self.grow(last, w)
                prefixes.append((last, k, at + 1))
        self.ends: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for state, k, end in prefixes:  # a prefix's suffixes are the states up its links
            while state > 0 and self.length[state] >= least:
                self.ends[state].append((k, end))
                state = self.link[state]

    def state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def split(self, p: int, w: int, q: int) -> int:
        copy = self.state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def grow(self, last: int, w: int) -> int:
        if (q := self.next[last].get(w)) is not None:  # an earlier template has this prefix
            return q if self.length[q] == self.length[last] + 1 else self.split(last, w, q)
        new, p = self.state(self.length[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self.split(p, w, q)
        return new

    def matches(self, stream: list[int]) -> list[tuple[int, int, int]]:
        """Maximal matches (first word, words, state) of ``least`` words or more; -1 in the stream is a word of no template."""
        out, state, n = [], 0, 0
        nexts, link, length, least = self.next, self.link, self.length, self.least
        for at, w in enumerate([*stream, -1]):
            to = nexts[state].get(w)
            if to is not None:
                state, n = to, n + 1
                continue
            if n >= least:
                out.append((at - n, n, state))
            while state and w not in nexts[state]:
                state = link[state]
            n = length[state]
            if w in nexts[state]:
                state, n = nexts[state][w], n + 1
            else:
                state, n = 0, 0
        return out

    def places(self, first: int, n: int, state: int) -> list[tuple[int, int, int, int]]:
        """(template, first word, words, place in it) of a match: where the whole of it stands, and where only an end of it does, in templates without more."""
        out, seen, end = [], set(), first + n
        while state > 0 and n >= self.least:
            out += [(k, end - n, n, e - n) for k, e in self.ends[state] if k not in seen]
            seen.update(k for k, _ in self.ends[state])
            state = self.link[state]
            n = self.length[state]
        return out


def chained(matches: list[tuple], gap: int = MAX_GAP) -> list[list[tuple]]:
    """Chains of one template's matches (first word, words, place, ...): in order in text and template, at most ``gap`` words apart.

    Dynamic programming: each match goes on from the chain that covers most before it (what overlaps counts once); of the
    chains from one first match the one that covers most is given, as (first word, words, place, ...) without overlaps.
    """
    matches = sorted(matches, key=lambda m: (m[0] + m[1], *m))
    best: list[tuple[int, int, int, int]] = []  # (covered, match before or -1, overlap with it, first match)
    for i, (first, n, place, *_) in enumerate(matches):
        own = (n, -1, 0, i)
        for j in range(i - 1, -1, -1):
            a, m, p, *_ = matches[j]
            if a + m < first - gap:
                break
            over = max(0, a + m - first)
            if over < n and a < first and p + m <= place + over and best[j][0] + n - over > own[0]:
                own = (best[j][0] + n - over, j, over, best[j][3])
        best.append(own)
    top: dict[int, int] = {}
    for i, (covered, _, _, root) in enumerate(best):
        if root not in top or covered > best[top[root]][0]:
            top[root] = i
    out = []
    for i in top.values():
        chain = []
        while i >= 0:
            (first, n, place, *more), (_, before, over, _) = matches[i], best[i]
            chain.append((first + over, n - over, place + over, *more))
            i = before
        out.append(chain[::-1])
    return out


class Scanner:
    def __init__(self, base: dict[str, str], templates: dict[str, list[str]]):
        texts = [(label, words_of(t.encode())) for label, own in templates.items() for t in own]
        phrases = [words_of(p.encode()) for p in base]
        self.names, self.labels = [label for label, _ in texts], list(base.values())
        self.number = {w: i for i, w in enumerate(dict.fromkeys(w for t in [*(t for _, t in texts), *phrases] for w in t))}
        self.phrases = [[self.number[w] for w in p] for p in phrases]
        self.shortest = min((len(p) for p in phrases), default=1)
        numbers = [[self.number[w] for w in t] for _, t in texts]
        self.sizes = [len(t) for t in numbers]
        self.automaton = Automaton(numbers, MIN_RUN)

    def spans(self, at: int, stream: list[int]) -> list[tuple[int, int, int, int]]:
        """Spans (template, first word, end, covered words) in a stretch of template words from word ``at`` on that tell their label."""
        by: dict[int, list[tuple[int, int, int, bool]]] = {}
        for m in self.automaton.matches(stream):
            tells = len({self.names[k] for k, _ in self.automaton.ends[m[2]]}) == 1
            for k, first, n, place in self.automaton.places(*m):
                by.setdefault(k, []).append((first, n, place, tells and n == m[1]))
        out = []
        for k, own in by.items():
            for chain in chained(own):
                covered = sum(m[1] for m in chain)
                if any(m[3] for m in chain) and covered >= min(MIN_COVERED, self.sizes[k]) and covered >= MIN_SHARE * self.sizes[k]:
                    out.append((k, at + chain[0][0], at + chain[-1][0] + chain[-1][1], covered))
        return out

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, str]], list[tuple[str, int, int, int, float]]]:
        """(number of words, places of base phrases with labels, spans of templates with label, first word, end, covered words, share of the template)."""
        words = words_of(text)
        found = list(map(self.number.get, words))
        places: list[tuple[int, str]] = []
        spans = []
        known = [i for i, x in enumerate(found) if x is not None]
        at = 0
        while at < len(known):
            a = at
            while at + 1 < len(known) and known[at + 1] - known[at] <= MAX_GAP:
                at += 1
            first, end = known[a], known[at] + 1
            at += 1
            if at - a < min(self.shortest, MIN_RUN):
                continue
            stream = [-1 if x is None else x for x in found[first:end]]
            for phrase, label in zip(self.phrases, self.labels, strict=True):
                i, n = -1, len(phrase)
                if phrase[-1] in stream:
                    while True:
                        try:
                            i = stream.index(phrase[0], i + 1)
                        except ValueError:
                            break
                        if stream[i : i + n] == phrase:
                            places.append((first + i, label))
            for k, s, e, n in self.spans(first, stream):
                spans.append((self.names[k], s, e, n, n / self.sizes[k]))
        return len(words), sorted(places), sorted(spans)


def scan_licences(df: DataFrame, doc_id: str = "doc_id", text: str = "text", base: dict[str, str] | None = None, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans of every row.

    Null text is empty: no words, null first_word and last_word, empty labels, score 0. A null id stays null; repeated rows
    each give a row; an empty table gives none; other columns are not read. Labels are distinct, sorted and comma-joined.
    score: 1 with a base phrase, else the largest covered share of a template. Overlapping base phrases all count.
    ``base``: phrases (one word or more) and their labels; ``templates``: labels and their wordings.
    """
    scanner = Scanner(BASE if base is None else base, usual_templates() if templates is None else templates)
    kind = df.schema[doc_id].dataType.simpleString()
    span = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("covered", pa.int64()), ("share", pa.float64())]))

    def fn(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        rows = [scanner.scan(x) for x in texts]
        own = [sorted({x[1] for x in r[1]}) for r in rows]
        every = [sorted({*b, *(s[0] for s in r[2])}) for b, r in zip(own, rows, strict=True)]
        cols = [
            part.column(0),
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([len(r[1]) for r in rows], pa.int64()),
            pa.array([r[1][0][0] if r[1] else None for r in rows], pa.int64()),
            pa.array([r[1][-1][0] if r[1] else None for r in rows], pa.int64()),
            pa.array([",".join(x) for x in own], pa.string()),
            pa.array([",".join(x) for x in every], pa.string()),
            pa.array([1.0 if r[1] else min(1.0, max((s[4] for s in r[2]), default=0.0)) for r in rows], pa.float64()),
            pa.array([[dict(zip(("label", "first_word", "end_word", "covered", "share"), s, strict=True)) for s in r[2]] for r in rows], span),
        ]
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    return map_text(df, [doc_id], text, fn, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,first_word:long,end_word:long,covered:long,share:double>>")
