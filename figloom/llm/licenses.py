"""License scans: a generalised suffix automaton of licence phrases and templates, run over the words of whole texts.

The automaton holds every run of words of every phrase and template. It is built once, goes to the tasks as arrays (some 100
bytes a word of the templates; `most_words` bounds them), and reads each text once: at each word it tells the longest run
of words ending there that some template has, too (matching statistics). A phrase stands wherever its state is on the
suffix path of the current one. Matches that the next word doesn't lengthen, of `min_match` words and more, are looked up in
the templates and chained: a match goes on the chain that covers most and that it follows in both text and template, at most
`max_gap` words apart in either; overlaps count once. A template is found where a chain covers `min_coverage` of its words.

Words are compared letter by letter after their hashes. Null and empty texts have no words; texts may be of any length, and
memory is bounded by a block of texts or the longest one; ties between chains go to the earlier, repeated rows are scanned
alike; an empty table gives an empty result; without phrases and templates nothing is found; other columns are left out.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figloom.llm.textblocks import LOWER, NOT_TERM, text_blocks, word_hashes, word_spans

# Phrases that tell a licence wherever they stand.
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
# Notices of common licences, as their authors publish them.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit", "Released under the MIT License"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]


def words_of(text: str) -> list[bytes]:
    """A text's words: runs of letters, digits and characters beyond ASCII, A-Z lower-cased."""
    data = LOWER[np.frombuffer(text.encode(), np.uint8)]
    starts, stops, _ = word_spans(data, np.array([0, len(data)]), NOT_TERM)
    return [data[a:b].tobytes() for a, b in zip(starts, stops, strict=True)]


class Automaton:
    """A suffix automaton of several sequences of codes, as arrays."""

    def __init__(self, sequences: list[list[int]], codes: int):
        link, length, step = [-1], [0], [{}]
        ends: list[list[tuple[int, int]]] = [[]]

        def new(n, to):
            link.append(-1)
            length.append(n)
            step.append(to)
            ends.append([])
            return len(link) - 1

        def split(p, c, q):
            twin = new(length[p] + 1, dict(step[q]))
            link[twin], link[q] = link[q], twin
            while p >= 0 and step[p].get(c) == q:
                step[p][c] = twin
                p = link[p]
            return twin

        for s, sequence in enumerate(sequences):
            last = 0
            for at, c in enumerate(sequence):
                q = step[last].get(c)
                if q is not None:
                    last = q if length[q] == length[last] + 1 else split(last, c, q)
                else:
                    p, cur = last, new(length[last] + 1, {})
                    while p >= 0 and c not in step[p]:
                        step[p][c] = cur
                        p = link[p]
                    if p < 0:
                        link[cur] = 0
                    else:
                        q = step[p][c]
                        link[cur] = q if length[q] == length[p] + 1 else split(p, c, q)
                    last = cur
                ends[last].append((s, at))
        self.codes, self.link, self.length = codes, np.array(link), np.array(length)
        moves = sorted((v * codes + c, t) for v, to in enumerate(step) for c, t in to.items())
        self.moves, self.targets = np.array([m for m, _ in moves], np.int64), np.array([t for _, t in moves], np.int64)
        # A state's runs end wherever those of the states that it is the suffix of do.
        for v in sorted(range(1, len(link)), key=lambda v: -length[v]):
            ends[link[v]].extend(ends[v])
        ends[0] = []
        self.ends = [np.array(sorted(e), np.int64).reshape(-1, 2) for e in ends]

    def move(self, state: np.ndarray, code: np.ndarray):
        """The states after these codes, -1 where there is none."""
        key = state * self.codes + code
        at = np.minimum(np.searchsorted(self.moves, key), len(self.moves) - 1)
        return np.where(self.moves[at] == key, self.targets[at], -1)

    def statistics(self, codes: np.ndarray, starts: np.ndarray, stops: np.ndarray):
        """For each place of the runs [start, stop) of known codes: the state of the longest known run of codes that ends
        there, and its length; all runs are read side by side. 0 elsewhere."""
        states, lengths = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
        order = np.argsort(starts - stops, kind="stable")
        starts, long = starts[order], (stops - starts)[order]
        state, n = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        left = np.searchsorted(-long, -np.arange(long[0] if len(long) else 0), "left")
        for t, k in enumerate(left):
            state, n = state[:k], n[:k]
            code = codes[starts[:k] + t]
            to = self.move(state, code)
            stuck = np.flatnonzero(to < 0)
            while len(stuck):
                state[stuck] = self.link[state[stuck]]
                n[stuck] = self.length[state[stuck]]
                to[stuck] = self.move(state[stuck], code[stuck])
                stuck = stuck[to[stuck] < 0]  # the root has a step for every known code
            state, n = to, n + 1
            states[starts[:k] + t], lengths[starts[:k] + t] = state, n
        return states, lengths


def chains(matches: list[tuple[int, int, np.ndarray]], max_gap: int) -> list[list[int]]:
    """Matches of one text with one template (last word, words, last words in the template), by last word, to chains
    [first word, last word + 1, end in the template, words covered]."""
    done, open_ = [], []
    for last, n, ends in matches:
        first = last - n + 1
        done += [c for c in open_ if c[1] + max_gap < first]
        open_ = [c for c in open_ if c[1] + max_gap >= first]
        best = None
        for c in open_:
            new = last + 1 - max(first, c[1])  # words beyond the chain
            where = [e + 1 for e in ends if 0 <= e + 1 - new - c[2] <= max_gap]
            if new > 0 and where and (best is None or c[3] > best[0][3]):
                best = (c, where[0], new)
        if best:
            c, end, new = best
            c[1], c[2], c[3] = last + 1, end, c[3] + new
        elif not any(c[1] > last for c in open_):
            open_.append([first, last + 1, int(ends[0]) + 1, n])
    return done + open_


class Scanner:
    """What the tasks need: the words, the automaton, the phrases on each state's suffix path."""

    def __init__(self, phrases, templates, min_match: int, max_gap: int, min_coverage: float):
        told = [(label, words_of(text)) for label, text in [*phrases, *templates]]
        self.labels, self.sizes, self.n_phrases = [x for x, _ in told], np.array([len(w) for _, w in told], np.int64), len(phrases)
        self.min_match, self.max_gap, self.min_coverage = min_match, max_gap, min_coverage
        words = sorted({w for _, ws in told for w in ws})
        self.width = max(map(len, words), default=0)
        self.letters = np.zeros((len(words), self.width), np.uint8)
        for row, w in zip(self.letters, words, strict=True):
            row[: len(w)] = np.frombuffer(w, np.uint8)
        self.word_sizes = np.array([len(w) for w in words], np.int64)
        hashes = np.array([word_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0] for w in words], np.uint64)
        self.by_hash = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.by_hash]
        code = {w: i for i, w in enumerate(words)}
        self.automaton = Automaton([[code[w] for w in ws] for _, ws in told], max(1, len(words)))
        a = self.automaton
        own: list[list[int]] = [[] for _ in a.link]
        for k in range(self.n_phrases):
            v = 0
            for w in told[k][1]:
                v = int(a.move(np.array([v]), np.array([code[w]]))[0])
            own[v].append(k)
        for v in sorted(range(1, len(own)), key=lambda v: a.length[v]):
            own[v] = own[v] + [k for k in own[a.link[v]] if k not in own[v]] if v else []
        self.path_at = np.concatenate([[0], np.cumsum([len(o) for o in own])])
        self.path = np.array([k for o in own for k in o], np.int64)

    def codes(self, data, starts, stops) -> np.ndarray:
        """The code of each word, -1 for unknown ones."""
        out = np.full(len(starts), -1, np.int64)
        if not len(self.hashes):
            return out
        short = np.flatnonzero(stops - starts <= self.width)
        h = word_hashes(data, starts, stops)[short]
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == h)
        word, guess = short[hit], self.by_hash[at[hit]]
        size = stops[word] - starts[word]
        same = size == self.word_sizes[guess]
        for k in range(self.width):
            inside = same & (k < size)
            same &= ~inside | (data[np.minimum(starts[word] + k, len(data) - 1)] == self.letters[guess, k])
        out[word[same]] = guess[same]
        return out

    def block(self, data, offsets):
        """For the texts of a block: words, and by text its phrases' places (start, phrase) and template spans."""
        data = LOWER[data]
        starts, stops, rows = word_spans(data, offsets, NOT_TERM)
        codes = self.codes(data, starts, stops)
        known = codes >= 0
        begins, ends = known.copy(), known.copy()
        inner = rows[1:-1][(rows[1:-1] > 0) & (rows[1:-1] < len(codes))]
        begins[1:] &= ~known[:-1]
        begins[inner] = known[inner]
        ends[:-1] &= ~known[1:]
        ends[inner - 1] = known[inner - 1]
        begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        least = self.sizes.min() if len(self.sizes) else 1
        long = ends - begins >= min(least, self.min_match)
        begins, ends = begins[long], ends[long]
        states, lengths = self.automaton.statistics(codes, begins, ends)
        row_of = lambda places: np.searchsorted(rows, places, "right") - 1
        # Phrases
        n = np.diff(self.path_at)[states]
        place = np.repeat(np.arange(len(states)), n)
        within = np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n)
        phrase = self.path[self.path_at[states[place]] + within] if len(place) else np.zeros(0, np.int64)
        whole = lengths[place] >= self.sizes[phrase] if len(place) else np.zeros(0, bool)
        place, phrase = place[whole], phrase[whole]
        row = row_of(place)
        base = np.stack([row, place - self.sizes[phrase] + 1 - rows[row], phrase], 1) if len(place) else np.zeros((0, 3), np.int64)
        # Templates
        goes_on = np.zeros(len(states), bool)
        goes_on[:-1] = (lengths[1:] == lengths[:-1] + 1) & (lengths[:-1] > 0)
        goes_on[rows[1:-1][rows[1:-1] > 0] - 1] = False
        last = np.flatnonzero((lengths >= self.min_match) & ~goes_on)
        matches: dict[tuple[int, int], list] = {}
        for at, r in zip(last.tolist(), row_of(last).tolist(), strict=True):
            where = self.automaton.ends[states[at]]
            where = where[where[:, 0] >= self.n_phrases]
            for t in np.unique(where[:, 0]).tolist():
                matches.setdefault((r, t), []).append((at - int(rows[r]), int(lengths[at]), where[where[:, 0] == t, 1]))
        spans: dict[int, list] = {}
        for (r, t), found in matches.items():
            for first, stop, _, covered in chains(found, self.max_gap):
                spans.setdefault(r, []).append((covered / int(self.sizes[t]), t, first, stop - first))
        return np.diff(rows), base, spans


SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,template:int,first_word:long,n_words:long,coverage:double>>"


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text", min_match: int = 4, max_gap: int = 8, min_coverage: float = 0.6, most_words: int = 5_000_000) -> DataFrame:
    """id, n_words, n_base (places of phrases), first_word and last_word (the smallest and largest start of these), their
    labels, all labels, score (1 if a phrase stands in the text, else the best coverage of a template), and spans: chains
    that cover min_coverage of a template, by place.

    phrases and templates are (label, text); those without words, and templates of less than min_match words, are refused."""
    for need, (label, text) in [*((1, x) for x in phrases), *((min_match, x) for x in templates)]:
        if len(words_of(text)) < need:
            raise ValueError(f"too few words to look for: {label}: {text!r}")
    if sum(len(text.split()) for _, text in [*phrases, *templates]) > most_words:
        raise ValueError(f"more than {most_words} words of templates")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Scanner(phrases, templates, min_match, max_gap, min_coverage))
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, {SCHEMA}"

    def run(batches):
        s = shared.value
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(1)):
                n, base, spans = s.block(data, offsets)
                size = hi - lo
                count = np.bincount(base[:, 0], minlength=size)
                first, last = np.full(size, np.iinfo(np.int64).max), np.full(size, -1)
                np.minimum.at(first, base[:, 0], base[:, 1])
                np.maximum.at(last, base[:, 0], base[:, 1])
                told: list[set[str]] = [set() for _ in range(size)]
                for r, k in np.unique(base[:, [0, 2]], axis=0).tolist():
                    told[r].add(s.labels[k])
                every, best, kept = [set(x) for x in told], (count > 0).astype(float), [[] for _ in range(size)]
                for r, found in spans.items():
                    best[r] = max(best[r], *(min(1.0, c) for c, *_ in found))
                    kept[r] = [{"label": s.labels[t], "template": t - s.n_phrases, "first_word": at, "n_words": long, "coverage": c} for c, t, at, long in sorted(found, key=lambda x: (x[2], x[1])) if c >= s.min_coverage]
                    every[r].update(x["label"] for x in kept[r])
                none = count == 0
                joined = lambda sets: pa.array([",".join(sorted(x)) for x in sets], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, size), pa.array(n, pa.int64()), pa.array(count, pa.int64()), pa.array(first, pa.int64(), mask=none), pa.array(last, pa.int64(), mask=none), joined(told), joined(every), pa.array(best), pa.array(kept, pa.list_(pa.struct([("label", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("coverage", pa.float64())])))],
                    [id_col, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
                )

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
