"""Licence scan by a positional rare-token index.

The licence templates are indexed by word: a posting is (template, position in
it).  The documents' frequencies of the licence words, counted over the whole
table, give each word its inverse document frequency.  For every file the
rarest words of a template are looked up: as many as leave the others too light
to reach ``COVERAGE`` by themselves, so every match holds one of them in its own
place.  Each occurrence names a place where its template would start (file
position minus template position), and the template's postings are intersected
there by relative position.  The share of
the template's IDF weight found at a place is its coverage.  A template is
reported when its coverage reaches ``COVERAGE`` and its mandatory key phrase
stands, word by word, in its own place.  A file whose held licence words weigh
too little for any template is passed over (an upper bound of the coverage).

Beside it the places of the base phrases (consecutive words) are counted; their
labels are always reported.  Words are runs of digits, lower-cased ASCII
letters and non-ASCII characters.

Each case has a defined result: a null or empty text has no words, null places,
empty label strings and score 0; a template cut short scores what is there;
copies of a row give the same row again; an empty table gives an empty table;
further input columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm import scan as S
from cardwatch.llm.spark_io import text_columns

#: Phrases whose every place is counted, with their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Wordings of licence and rights notices: (label, mandatory key phrase, text).
NOTICES = [
    ("mit", "mit license", "released under the mit license"),
    ("apache", "apache license", "licensed under the apache license version 2 0"),
    ("apache", "apache license", "you may not use this file except in compliance with the license you may obtain a copy of the apache license"),
    ("gpl", "general public license", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "general public license", "under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "lesser general public license", "under the terms of the gnu lesser general public license"),
    ("agpl", "affero general public license", "under the terms of the gnu affero general public license"),
    ("mpl", "mozilla public license", "subject to the terms of the mozilla public license version 2 0"),
    ("cc-by", "cc by 4", "licensed under cc by 4 0"),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by", "creative commons attribution", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "cc0", "licensed under cc0 1 0 universal"),
    ("unlicense", "public domain", "this is free and unencumbered software released into the public domain"),
    ("proprietary", "all rights reserved", "all rights reserved"),
    ("proprietary", "proprietary and confidential", "proprietary and confidential"),
    ("proprietary", "unauthorized copying", "unauthorized copying of this file via any medium is strictly prohibited"),
]

#: Whole licence texts, in the same form.
TEXTS = [
    ("mit", "permission is hereby granted", """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
        is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be
        included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY
        KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
        AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
        WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
        OTHER DEALINGS IN THE SOFTWARE."""),
    ("mit", "permission is hereby granted", """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"""),
    ("bsd", "redistribution and use", """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
        the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of
        the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software
        without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY
        EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
        PARTICULAR PURPOSE ARE DISCLAIMED."""),
    ("bsd", "redistribution and use", """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met"""),
    ("isc", "permission to use copy modify and or distribute", """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND
        THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
        FITNESS."""),
    ("zlib", "altered source versions", """
        This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for
        any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,
        including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The
        origin of this software must not be misrepresented; you must not claim that you wrote the original software. 2. Altered source
        versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not
        be removed or altered from any source distribution."""),
    ("apache", "apache license", """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
        License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law
        or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License."""),
    ("gpl", "general public license", """
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This
        program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
]
TEMPLATES = NOTICES + TEXTS
COVERAGE = 0.6
#: Starts of a template that are compared together, in cells of (start, template word).
CELLS = 1 << 22

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, n_matches long"
)


def _hash_words(text: str) -> np.ndarray:
    return S.words_of(S.chunk_of(np.zeros(1, np.int64), [text.encode()]), S.ALNUM_WORDS, S.ASCII_LOWER).hash


class LicenceIndex:
    """Postings of the templates' words, with IDF weights; its size is that of the template list."""

    def __init__(self, templates: list[tuple[str, str, str]], df: dict[int, int], n_docs: int):
        self.labels = [t[0] for t in templates]
        words = [_hash_words(t[2]) for t in templates]
        self.vocab = np.unique(np.concatenate(words))
        self.idf = np.array([math.log(1 + n_docs / (1 + df.get(int(h), 0))) for h in self.vocab])
        self.terms_of = [np.searchsorted(self.vocab, w) for w in words]
        self.key = [self._key_place(w, _hash_words(t[1])) for w, t in zip(words, templates, strict=True)]
        self.parts = np.zeros((len(words), len(self.vocab)))
        for t, terms in enumerate(self.terms_of):
            np.add.at(self.parts[t], terms, self.idf[terms])
        self.weight = self.parts.sum(axis=1)
        self.anchors = [self._anchors(t) for t in range(len(words))]

    def _anchors(self, t: int) -> np.ndarray:
        """Places in a template of its rarest words, so many that the other places weigh less than COVERAGE of it."""
        own = self.terms_of[t]
        order = np.argsort(-self.idf[own], kind="stable")
        rest = self.weight[t] - np.cumsum(self.idf[own][order])
        enough = np.flatnonzero(rest < COVERAGE * self.weight[t] - 1e-9)
        return order[: enough[0] + 1] if len(enough) else order

    @staticmethod
    def _key_place(words: np.ndarray, key: np.ndarray) -> slice:
        for i in range(len(words) - len(key) + 1):
            if np.array_equal(words[i : i + len(key)], key):
                return slice(i, i + len(key))
        raise ValueError("a template's key phrase must stand in its text")

    def terms(self, h: np.ndarray) -> np.ndarray:
        """Index of each word in the vocabulary, -1 if it isn't there."""
        at = np.minimum(np.searchsorted(self.vocab, h), len(self.vocab) - 1)
        return np.where(self.vocab[at] == h, at, -1)

    def possible(self, text: np.ndarray, term: np.ndarray, n_texts: int) -> np.ndarray:
        """(text, template) pairs whose held licence words weigh enough for the coverage; an upper bound, so none is lost."""
        held = np.zeros((n_texts, len(self.vocab)))
        hit = term >= 0
        held[text[hit], term[hit]] = 1
        return np.argwhere(held @ self.parts.T >= COVERAGE * self.weight - 1e-9)

    def matches(self, term: np.ndarray, t: int) -> list[tuple[int, float]]:
        """(start, coverage) of a template's matches in one file, from the file's vocabulary entries by position."""
        own, anchors = self.terms_of[t], self.anchors[t]
        starts = [np.flatnonzero(term == own[j]) - j for j in anchors]
        starts = np.unique(np.concatenate(starts)) if starts else np.zeros(0, np.int64)
        # a match holds its key phrase in place: other starts go first
        key = self.key[t]
        padded = np.concatenate((np.full(len(own), -1), term, np.full(len(own), -1)))
        for j in range(key.start, key.stop):
            starts = starts[padded[starts + j + len(own)] == own[j]]
        out = []
        for block in np.array_split(starts, len(starts) * len(own) // CELLS + 1):
            same = padded[block[:, None] + np.arange(len(own)) + len(own)] == own
            cover = same @ self.idf[own] / self.weight[t]
            ok = cover >= COVERAGE
            out += zip(block[ok].tolist(), cover[ok].tolist(), strict=True)
        return out


def licence_word_counts(docs: DataFrame, templates=TEMPLATES) -> tuple[dict[int, int], int]:
    """Documents that hold each licence word, and the number of documents; one row per licence word at the driver."""
    vocab = np.unique(np.concatenate([_hash_words(t[2]) for t in templates]))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(len(vocab), dtype=np.int64), 0
        for c in S.chunks(batches):
            w = S.words_of(c, S.ALNUM_WORDS, S.ASCII_LOWER)
            at = np.minimum(np.searchsorted(vocab, w.hash), len(vocab) - 1)
            hit = vocab[at] == w.hash
            pairs = np.unique(w.text_of()[hit] * len(vocab) + at[hit])
            df += np.bincount(pairs % len(vocab), minlength=len(vocab))
            n += len(c)
        yield pa.RecordBatch.from_arrays([np.append(np.arange(len(vocab)), -1), np.append(df, n)], names=["term", "n"])

    rows = text_columns(docs).mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    got = {r["term"]: r["n"] for r in rows}
    return {int(h): got.get(k, 0) for k, h in enumerate(vocab)}, got.get(-1, 0)


def scan_chunk(c: S.Chunk, index: LicenceIndex) -> dict[str, list]:
    w = S.words_of(c, S.ALNUM_WORDS, S.ASCII_LOWER)
    text, total = w.text_of(), len(w.hash)
    n_base, names = np.zeros(len(c), dtype=np.int64), [set() for _ in range(len(c))]
    first = np.full(len(c), np.iinfo(np.int64).max)
    last = np.full(len(c), -1)
    for phrase, label in BASE_PHRASES.items():
        k = _hash_words(phrase)
        m = max(0, total - len(k) + 1)
        hit = S.whole(w.first, len(k), total)
        for j, h in enumerate(k):
            hit &= w.hash[j : j + m] == h
        at = np.flatnonzero(hit)
        place = at - w.first[text[at]]
        n_base += np.bincount(text[at], minlength=len(c))
        np.minimum.at(first, text[at], place)
        np.maximum.at(last, text[at], place)
        for d in np.unique(text[at]):
            names[d].add(label)
    term = index.terms(w.hash)
    score, n_matches, labels = np.zeros(len(c)), np.zeros(len(c), dtype=np.int64), [set(x) for x in names]
    for d, t in index.possible(text, term, len(c)).tolist():
        for _start, cover in index.matches(term[w.first[d] : w.first[d + 1]], t):
            labels[d].add(index.labels[t])
            n_matches[d] += 1
            score[d] = min(1.0, max(score[d], cover))
    has = n_base > 0
    score[has] = np.maximum(score[has], COVERAGE)
    return {
        "n_words": pa.array(w.count), "n_base": pa.array(n_base),
        "first_word": pa.array(np.where(has, first, 0), mask=~has), "last_word": pa.array(np.where(has, last, 0), mask=~has),
        "base_labels": pa.array([",".join(sorted(x)) for x in names]), "labels": pa.array([",".join(sorted(x)) for x in labels]),
        "score": pa.array(score), "n_matches": pa.array(n_matches),
    }


def licence_scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """One row per document with base places, labels and score; two scans, no shuffle of texts."""
    df, n_docs = licence_word_counts(docs, templates)
    index = LicenceIndex(templates, df, n_docs)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in S.chunks(batches):
            m = scan_chunk(c, index)
            yield pa.RecordBatch.from_arrays([c.ids, *m.values()], names=["doc_id", *m])

    return text_columns(docs).mapInArrow(run, SCHEMA)
