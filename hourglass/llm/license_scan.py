"""License scan: phrases at their places, and an exact set-similarity join with templates.

The join pairs text blocks with license templates of which they hold at least a share
`containment` of the distinct words: |B & T| >= ceil(containment * |T|). Blocks are the lines,
and in paragraphs (runs of lines with words) the windows of consecutive lines that a
template of so many words can be wrapped over. Words that no
template holds cannot count, so a block's set is what it shares with the templates'
vocabulary. Words are ordered by how many blocks of the corpus hold them, rarest first.
Then with a = ceil(containment * |T|) shared words needed:

- length: a block of fewer than a words cannot match;
- prefix: the first |T|-a+1 words of the template and the first |B|-a+1 of the block share
  a word, or the two don't match; templates are indexed by their prefix words;
- position: with the first shared word at i in the template and j in the block, at most
  1 + min(|T|-i-1, |B|-j-1) words are shared.

What passes all three is verified by counting. A paragraph's windows are counted for the
templates alone that the paragraph as a whole meets. A line of more than twice a template's
words is judged by its windows of twice as many consecutive words, so that scattered words
make no notice.

Telling words. A template's own text may come so near to another license's that containment
cannot tell them apart. Of a template T and one U of another label whose words contain the
share `containment` of T's, a block must hold every word of T that U lacks; where U has all of
T's words and more, a block that holds all of those more is U's and not T's.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import WORD_BYTES, sliced

#: fixed values: phrases and their labels
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: fixed values: sentences of public licenses and notices, with labels of this method
TEMPLATES = (
    ("gpl-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-2-notice", "This work is licensed under the GNU General Public License, version 2."),
    ("lgpl-notice", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("lgpl-notice", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("agpl-notice", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl-2-notice", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("lgpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("apache-notice", "Licensed under the Apache License, Version 2.0."),
    ("apache-1-notice", "Licensed under the Apache License, Version 1.0."),
    ("apache-1-notice", "Licensed under the Apache License, Version 1.1."),
    ("apache-notice", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    ("mit-notice", "Released under the MIT License."),
    ("isc", "Released under the ISC License."),
    ("bsd", "Released under the BSD License."),
    ("mit-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("cc-by-notice", "Licensed under CC BY 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0."),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0."),
    ("cc-by-nc-nd", "Licensed under CC BY-NC-ND 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("cc-by-nc-sa", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("cc-by-nc-nd", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("epl", "This Source Code Form is subject to the terms of the Eclipse Public License, v. 2.0."),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License, v. 2.0."),
)
CONTAINMENT = (8, 10)
_FIND = re.compile(WORD_BYTES)


def words(text: str | None) -> list[bytes]:
    """Words of the lower-cased text; lower() of bytes changes A-Z alone."""
    return _FIND.findall((text or "").encode("utf-8", "surrogatepass").lower())


class TemplateIndex:
    """Templates in global order, indexed by the words of their prefixes."""

    def __init__(self, templates, frequency: dict[bytes, int], containment: tuple[int, int] = CONTAINMENT, telling: bool = False):
        num, den = containment
        sets = [(label, frozenset(words(text))) for label, text in templates]
        self.lengths = [len(words(text)) for (_, text), (_, s) in zip(templates, sets, strict=True) if s]
        sets = [(label, s) for label, s in sets if s]
        self.vocabulary = frozenset().union(*(s for _, s in sets))
        order = sorted(self.vocabulary, key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: k for k, w in enumerate(order)}
        self.templates = [(label, s, -(-num * len(s) // den)) for label, s in sets]
        self.least = min((a for _, _, a in self.templates), default=1)
        #: words that a block must hold, and sets of words of which it must not hold all
        self.own, self.others, self.near = [frozenset()] * len(sets), [[] for _ in sets], [set() for _ in sets]
        for t, (label, s, a) in enumerate(self.templates if telling else ()):
            for k, (u_label, u, _) in enumerate(self.templates):
                if u_label != label and len(s & u) >= a and s != u:
                    self.near[t].add(k)
                    if s <= u:
                        self.others[t].append(u - s)
                    else:
                        self.own[t] |= s - u
        self.prefix: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, (_, s, a) in enumerate(self.templates):
            for i, w in enumerate(sorted(s, key=self.rank.__getitem__)[: len(s) - a + 1]):
                self.prefix[w].append((t, i))

    def _met(self, block: set[bytes]) -> list[tuple[int, int]]:
        """(template, shared words) of every template that the block's words meet."""
        block = block & self.vocabulary
        size = len(block)
        if size < self.least:
            return []
        out, seen = [], set()
        for j, w in enumerate(sorted(block, key=self.rank.__getitem__)[: size - self.least + 1]):
            for t, i in self.prefix.get(w, ()):
                _, s, a = self.templates[t]
                if t in seen or size < a or j > size - a or 1 + min(len(s) - i - 1, size - j - 1) < a:
                    continue
                seen.add(t)
                shared = len(s & block)
                if shared >= a:
                    out.append((t, shared))
        return out

    def told(self, t: int, block) -> bool:
        """Whether the block holds template t's telling words, and no nearest other's."""
        return self.own[t] <= block and not any(other <= block for other in self.others[t])

    def matches(self, block: set[bytes]) -> list[tuple[str, float]]:
        """(label, containment) of every template that the block's words meet."""
        return [(self.templates[t][0], shared / len(self.templates[t][1])) for t, shared in self._met(block) if self.told(t, block)]

    def in_line(self, line: list[bytes]) -> list[tuple[str, float]]:
        """(label, containment) of every template that a line meets: as a whole where it has at
        most twice the template's words, else in a window of so many consecutive words."""
        return [(self.templates[t][0], shared / len(self.templates[t][1])) for t, shared in self._of_line(line)]

    def _of_line(self, line: list[bytes]) -> list[tuple[int, int]]:
        out, block = [], set(line)
        for t, shared in self._met(block):
            a = self.templates[t][2]
            if len(line) > 2 * self.lengths[t]:
                shared = self._best_window(t, line, 2 * self.lengths[t])
            elif not self.told(t, block):
                continue
            if shared >= a:
                out.append((t, shared))
        return out

    def _best_window(self, t: int, line: list[bytes], size: int) -> int:
        """Most shared words of a window of `size` words that holds what tells template t."""
        _, s, a = self.templates[t]
        held, count, most = defaultdict(int), 0, 0
        for end, w in enumerate(line):
            if w in s:
                count += not held[w]
                held[w] += 1
            start = end + 1 - size
            if start > 0 and line[start - 1] in s:
                held[line[start - 1]] -= 1
                count -= not held[line[start - 1]]
            if start >= 0 and count >= a and count > most and self.told(t, set(line[start : end + 1])):
                most = count
        return most

    def wrapped(self, lines: list[list[bytes]]) -> list[tuple[str, float]]:
        """(label, containment) of every template that consecutive lines of a paragraph meet.

        With a template of n words a window is two lines or more: the last n words of its first
        line, the first n of its last, and all lines between, which hold fewer than n words. No
        line of it is by itself a notice of a nearest other template: a telling word that stands
        by chance beside such a line makes no other license of it.
        """
        out, met = [], self._met(set().union(*map(self.vocabulary.intersection, lines)))
        if not met:
            return out
        alone = [{t for t, _ in self._of_line(line)} if len(line) >= self.least else set() for line in lines]
        for t, _ in met:
            label, s, a = self.templates[t]
            n, most = self.lengths[t], 0
            for i in range(len(lines) - 1):
                if alone[i] & self.near[t]:
                    continue
                held, between = self.vocabulary.intersection(lines[i][-n:]), 0
                for k in range(i + 1, len(lines)):
                    if alone[k] & self.near[t]:
                        break
                    held |= self.vocabulary.intersection(lines[k][:n])
                    between += len(lines[k])
                    shared = len(s & held)
                    if shared >= a and shared > most and self.told(t, held):
                        most = shared
                    if between >= n:
                        break
            if most >= a:
                out.append((label, most / len(s)))
        return out


def _lines(text: str | None) -> list[str]:
    return (text or "").split("\n")


def _frequencies(vocabulary: frozenset):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[bytes, int] = defaultdict(int)
        for batch in sliced(batches, 256):
            for text in batch.column("text").to_pylist():
                for line in _lines(text):
                    for w in vocabulary.intersection(words(line)):
                        count[w] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.binary()), pa.array(list(count.values()), pa.int64())], ["word", "n"])

    return run


def _scan(shared, phrases: dict[str, str]):
    wanted = [(f" {p} ".encode(), label, len(p.split())) for p, label in phrases.items()]

    def base(found: list[bytes]) -> tuple[int, int | None, int | None, set[str]]:
        text = b" " + b" ".join(found) + b" "
        at, labels = [], set()
        for phrase, label, _ in wanted:
            k = text.find(phrase)
            while k >= 0:
                at.append(text.count(b" ", 0, k))
                labels.add(label)
                k = text.find(phrase, k + 1)
        return len(at), min(at, default=None), max(at, default=None), labels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TemplateIndex(*shared.value, telling=True)
        for batch in sliced(batches, 256):
            rows = []
            for text in batch.column("text").to_pylist():
                found, met, paragraph = [], [], []
                for line in [*_lines(text), ""]:
                    own = words(line)
                    found += own
                    if len(own) >= index.least:
                        met += index.in_line(own)
                    if own:
                        paragraph.append(own)
                    elif paragraph:
                        met += index.wrapped(paragraph) if len(paragraph) > 1 else []
                        paragraph = []
                n, first, last, labels = base(found)
                every = labels | {label for label, _ in met}
                score = max([1.0] * bool(labels) + [c for _, c in met], default=0.0)
                rows.append((len(found), n, first, last, ",".join(sorted(labels)), ",".join(sorted(every)), score))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds))],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return run


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, templates=TEMPLATES,
         containment: tuple[int, int] = CONTAINMENT) -> DataFrame:
    """One row per document row: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score.

    n_base counts all places of all phrases; score is 1 with a phrase, else the largest
    containment of a template that a line or a window of words or lines meets, else 0. Time is
    linear in a line's length, whatever its words. Null and empty texts have no words
    and no labels (empty strings); null ids stay; repeated rows come out as often as they
    went in; an empty table gives no rows. Other columns are not read.

    The word frequencies that order the sets are counted over all lines of all texts; only
    words of the templates are counted, so that what reaches the driver does not grow.
    """
    vocabulary = TemplateIndex(templates, {}, containment).vocabulary
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = text.select("text").mapInArrow(_frequencies(vocabulary), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    frequency = {bytes(r["word"]): r["n"] for r in counted}
    shared = docs.sparkSession.sparkContext.broadcast((templates, frequency, containment))
    return text.mapInArrow(_scan(shared, PHRASES if phrases is None else phrases),
                           "doc_id long, n_words long, n_base long, first_word long, last_word long, "
                           "base_labels string, labels string, score double")
