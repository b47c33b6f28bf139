"""License scans by an exact set-similarity join of text blocks with license templates.

A template of w words is looked for in the blocks of 2 w words that start at every multiple of w, over the whole text
and whatever its lines, so that any w consecutive words lie within one block. A block meets a template if it holds at
least the threshold share of the template's distinct tokens. Tokens are ordered by how many documents hold them, rarest
first, counted over all documents. A template of n tokens that needs o of them has to share one of its first n - o + 1
with the block, so only these are indexed (prefix filter); a block of fewer than o tokens that templates have can't
meet it (length filter); a first common token at place i of the template and j of the block leaves at most the smaller
of n - i and m - j common ones (positional filter). What passes is counted exactly. Base phrases are found as words
that stand consecutively, over the whole text.
"""

from __future__ import annotations

import bisect
import math
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.scratch import small_batches

#: Bytes of words in lower case, everything else a space. Bytes from 0x80 belong to characters outside ASCII.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
THRESHOLD = 0.8

# The phrases of the contract, and the texts of common license notices.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use,
copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included
in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("apache-2", "licensed under the apache license version 2.0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable
law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations
under the License."""),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", """Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""),
    ("cc-by", "licensed under a creative commons attribution 4.0 international license"),
    ("cc-by-nc", "licensed under cc by-nc 4.0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4.0 international license"),
    ("cc-by-sa", "licensed under cc by-sa 4.0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4.0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""),
    ("gpl-2", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2"),
    ("gpl-2", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."""),
    ("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
Public License as published by the Free Software Foundation"""),
    ("agpl-3", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General
Public License as published by the Free Software Foundation"""),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2.0"),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software."""),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("proprietary", "all rights reserved"),
)


def fold(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


def token_counts(docs: DataFrame, tokens: frozenset[bytes]) -> Counter:
    """In how many documents each of the given tokens occurs; a row for each token comes back."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for b in batches:
            for t in b.column(0):
                held.update(tokens.intersection(fold(t.as_py())))
        yield pa.record_batch([pa.array([*held], pa.binary()), pa.array([*held.values()], pa.int64())], names=["token", "n"])

    counted = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "token binary, n long")
    return Counter({bytes(r["token"]): r["n"] for r in counted.groupBy("token").agg(F.sum("n").alias("n")).collect()})


@dataclass(frozen=True)
class Met:
    """A block that meets a template: the block's first word, the share of the template's tokens that it holds, and the
    places of words that the template has."""

    template: int
    block: int
    share: float
    at: frozenset[int]


class Index:
    """Templates(label, text) by the tokens of their prefixes."""

    def __init__(self, templates: Sequence[tuple[str, str]], counts: Mapping[bytes, int], threshold: float = THRESHOLD):
        if not 0 < threshold <= 1:
            raise ValueError("the threshold is a share above 0")
        folded = [fold(text.encode()) for _, text in templates]
        self.labels = [label for label, _ in templates]
        self.rank = {t: k for k, t in enumerate(sorted({t for f in folded for t in f}, key=lambda t: (counts.get(t, 0), t)))}
        self.words = [len(f) for f in folded]
        self.places = [{t: k for k, t in enumerate(sorted(set(f), key=self.rank.__getitem__))} for f in folded]
        self.needs = [max(1, math.ceil(threshold * len(p) - 1e-9)) for p in self.places]
        self.prefixes: dict[bytes, list[int]] = defaultdict(list)
        for number, (own, need) in enumerate(zip(self.places, self.needs)):
            for token in list(own)[: len(own) - need + 1]:
                self.prefixes[token].append(number)

    def met(self, words: list[bytes]) -> list[Met]:
        """Every block of a text's words that meets a template."""
        if self.prefixes.keys().isdisjoint(words):
            return []
        known = [(at, w) for at, w in enumerate(words) if w in self.rank]
        tried, out = set(), []
        for at, word in known:
            for number in self.prefixes.get(word, ()):
                w = self.words[number]
                for block in {max(0, at // w - 1) * w, at // w * w}:
                    if (number, block) not in tried:
                        tried.add((number, block))
                        out += self._compared(number, block, known)
        return out

    def _compared(self, number: int, block: int, known: list[tuple[int, bytes]]) -> Iterator[Met]:
        own, need = self.places[number], self.needs[number]
        start = bisect.bisect_left(known, (block,))
        inside = known[start : bisect.bisect_left(known, (block + 2 * self.words[number],))]
        held = sorted({w for _, w in inside}, key=self.rank.__getitem__)
        if len(held) < need:
            return
        first = next((k for k, w in enumerate(held) if w in own), len(held))
        if first == len(held) or min(len(own) - own[held[first]], len(held) - first) < need:
            return
        common = sum(w in own for w in held)
        if common >= need:
            yield Met(number, block, common / len(own), frozenset(at for at, w in inside if w in own))

    def best(self, found: Sequence[Met]) -> set[str]:
        """The labels of found, without those of templates that stand mostly where one of another label is met better:
        similar notices share most of their words."""
        by_place = defaultdict(list)
        for m in found:
            for at in m.at:
                by_place[at].append(m)
        kept = set()
        for m in found:
            shared = Counter(
                id(o) for at in m.at for o in by_place[at] if o.share > m.share and self.labels[o.template] != self.labels[m.template]
            )
            if max(shared.values(), default=0) * 2 <= len(m.at):
                kept.add(self.labels[m.template])
        return kept


def places(words: list[bytes], joined: bytes, phrase: bytes) -> list[int]:
    """Numbers of the words at which the phrase starts; joined: the words with one space between."""
    out, at = [], joined.find(phrase)
    while at >= 0:
        end = at + len(phrase)
        if (at == 0 or joined[at - 1] == 0x20) and (end == len(joined) or joined[end] == 0x20):
            out.append(joined.count(b" ", 0, at))
        at = joined.find(phrase, at + 1)
    return out


def scan(
    docs: DataFrame, phrases: Mapping[str, str] = PHRASES, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, met) for each row of docs(doc_id, text).

    met lists every block that meets a template, by block and template: its template's number and label, first word,
    and containment. labels holds the base labels and those of the templates met, each once, sorted and joined by
    commas; where a block meets similar templates of several labels, those that another one meets better on most of
    the same words are left out of labels, not of met. score is the largest containment met, 1 where a base phrase
    stands, else 0. A null or empty text has no words, labels or places. An empty table gives an empty result; other
    columns are not read. The index of the templates is broadcast once to each executor; a library of all known
    licenses has a few megabytes.
    """
    spark = docs.sparkSession
    small_batches(spark)
    vocabulary = frozenset(t for _, text in templates for t in fold(text.encode()))
    index = Index(templates, token_counts(docs, vocabulary), threshold)
    shared = spark.sparkContext.broadcast(index)
    exact = [(b" ".join(fold(p.encode())), label) for p, label in phrases.items()]

    def one(index: Index, text: bytes | None) -> tuple:
        words = fold(text)
        joined = b" ".join(words)
        hits = [(at, label) for phrase, label in exact for at in places(words, joined, phrase)]
        base = sorted({label for _, label in hits})
        starts = [at for at, _ in hits]
        found = index.met(words)
        labels, score = {*base, *index.best(found)}, 1.0 if base else max((m.share for m in found), default=0.0)
        met = [
            {"template": m.template, "label": index.labels[m.template], "block": m.block, "share": m.share}
            for m in sorted(found, key=lambda m: (m.block, m.template))
        ]
        return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(sorted(labels)), score, met

    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "met"]
    block = pa.struct([("template", pa.int32()), ("label", pa.string()), ("block", pa.int64()), ("share", pa.float64())])
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(block)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [one(shared.value, t.as_py()) for t in b.column(1)]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["doc_id", *names])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "met array<struct<template: int, label: string, block: long, share: double>>",
    )
