"""Licence scan by a positional index of rare licence words.

The document frequency of every word of the licence templates is counted
over all documents.  The index has the positions of all words that are among
the ``RARE`` words of highest IDF of a template, in every template they stand
in.  Of each stretch of ``STRETCH`` words of a file the ``LOOKED_UP`` words of
highest IDF among those are looked up; a posting at template position p for a
word at file position i votes for the template at i - p, and a cluster of votes
within ``SLACK`` words from enough different words makes a candidate.  It is
verified by the template's mandatory key phrases, word for word inside the
candidate's stretch, and scored by the IDF-weighted share of template words
that stand where they should.  Where the key phrase of one licence lies within
that of another (CC BY-NC within CC BY-NC-SA), the longer one is the licence.

Base phrases are counted at every place besides; a file with base phrases
only scores ``BASE_SCORE``.

Defined results: null and empty texts have no words, no labels and score 0;
very long texts are looked up stretch by stretch; of words of equal IDF all are
looked up or none; null and repeated ids pass through; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmart.llm.common import ship

RARE = 6
STRETCH, LOOKED_UP = 32, 8
SLACK = 4
LEAST = 0.6
BASE_SCORE = 0.5

#: Phrases counted at every place, and their labels (fixed values).
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Sentences of the public licences and of the notices that point to them, by label (fixed values).
_SENTENCES = {
    "mit": [
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
        "to deal in the software without restriction | permission is hereby granted free of charge",
        "including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions | sublicense and or sell copies",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software "
        "| this permission notice shall be included in all copies or substantial portions",
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability "
        "fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other "
        "liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings "
        "in the software | merchantability fitness for a particular purpose and noninfringement"],
    "apache": [
        "licensed under the apache license version 2 0 | apache license",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 "
        "| apache org licenses",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without "
        "warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations "
        "under the license | governing permissions and limitations under the license"],
    "gpl": [
        "licensed under the gnu general public license version 3 | gnu general public license",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
        "free software foundation either version 3 of the license or at your option any later version | gnu general public license",
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or "
        "fitness for a particular purpose see the gnu general public license for more details | gnu general public license for more details"],
    "lgpl": [
        "licensed under the gnu lesser general public license | lesser general public license",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by "
        "the free software foundation | gnu lesser general public license"],
    "agpl": [
        "licensed under the gnu affero general public license | affero general public license",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by "
        "the free software foundation | gnu affero general public license"],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
        "| source and binary forms",
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the "
        "documentation and or other materials provided with the distribution | redistributions in binary form must reproduce",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission | endorse or promote products derived from this software",
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the "
        "implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors "
        "be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute "
        "goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict "
        "liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of "
        "such damage | procurement of substitute goods or services"],
    "mpl": [
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you "
        "can obtain one at | mozilla public license",
        "licensed under the mozilla public license version 2 0 | mozilla public license"],
    "epl": [
        "this program and the accompanying materials are made available under the terms of the eclipse public license | eclipse public license",
        "licensed under the eclipse public license 2 0 | eclipse public license"],
    "isc": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "| with or without fee is hereby granted",
        "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of "
        "merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages "
        "whatsoever resulting from loss of use data or profits | the author disclaims all warranties with regard to this software"],
    "zlib": [
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from "
        "the use of this software | will the authors be held liable for any damages",
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely "
        "subject to the following restrictions | to alter it and redistribute it freely"],
    "bsl": [
        "distributed under the boost software license version 1 0 | boost software license",
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered "
        "by this license | any person or organization obtaining a copy of the software"],
    "unlicense": [
        "this is free and unencumbered software released into the public domain | free and unencumbered software",
        "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any "
        "purpose commercial or non commercial and by any means | either in source code form or as a compiled binary"],
    "cc0": [
        "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work "
        "| all copyright and related or neighboring rights",
        "licensed under cc0 1 0 universal | cc0 1 0"],
}
#: Creative Commons licences: label, short name, long name (fixed values).
_COMMONS = [("cc-by", "by", "attribution"), ("cc-by-sa", "by sa", "attribution sharealike"), ("cc-by-nc", "by nc", "attribution noncommercial"),
            ("cc-by-nd", "by nd", "attribution noderivatives"), ("cc-by-nc-sa", "by nc sa", "attribution noncommercial sharealike"),
            ("cc-by-nc-nd", "by nc nd", "attribution noncommercial noderivatives")]
#: Identifiers of the SPDX list in the words of a file, by label (fixed values).
_SPDX = {"mit": ["mit"], "apache": ["apache 2 0"], "gpl": ["gpl 2 0", "gpl 3 0"], "lgpl": ["lgpl 2 1", "lgpl 3 0"], "agpl": ["agpl 3 0"],
         "bsd": ["bsd 2 clause", "bsd 3 clause"], "mpl": ["mpl 2 0"], "epl": ["epl 1 0", "epl 2 0"], "isc": ["isc"], "zlib": ["zlib"], "bsl": ["bsl 1 0"],
         "unlicense": ["unlicense"], "cc0": ["cc0 1 0"], **{label: [f"cc {short} 4 0", f"cc {short} 3 0"] for label, short, _ in _COMMONS}}


def _templates() -> list[tuple[str, str, list[str]]]:
    """Template label, text, mandatory key phrases."""
    out = []
    for label, sentences in _SENTENCES.items():
        for sentence in sentences:
            text, _, key = sentence.partition(" | ")
            out.append((label, text, [key or text.split(" the ", 1)[1]]))
    for label, short, long in _COMMONS:
        out += [(label, f"licensed under cc {short} {v} 0", [f"cc {short} {v} 0"]) for v in (3, 4)]
        out.append((label, f"licensed under a creative commons {long} 4 0 international license", [f"creative commons {long} 4 0"]))
    for label, ids in _SPDX.items():
        out += [(label, f"spdx license identifier {x}", [f"spdx license identifier {x}"]) for x in ids]
    return out


TEMPLATES = _templates()

#: ASCII letters to lower case, other ASCII that is no digit to a space.
_SPLIT = bytes(b + 32 if 65 <= b < 91 else b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_SPLIT).split()


def places(words: list[bytes], phrase: list[bytes], lo: int = 0, hi: int | None = None) -> list[int]:
    """Where the words of a phrase stand consecutively in words[lo:hi]."""
    hi = len(words) if hi is None else min(hi, len(words))
    n, out, at = len(phrase), [], max(0, lo)
    while True:
        try:
            at = words.index(phrase[0], at, hi)
        except ValueError:
            return out
        if words[at:min(at + n, hi)] == phrase:
            out.append(at)
        at += 1


class Templates:
    def __init__(self, templates, df: dict[bytes, int], docs: int):
        self.labels = [t[0] for t in templates]
        self.words = [t[1].encode().split() for t in templates]
        self.keys = [[k.encode().split() for k in t[2]] for t in templates]
        self.idf = {w: math.log((docs + 1) / (df.get(w, 0) + 1)) + 1 for ws in self.words for w in ws}
        rare = {w for ws in self.words for w in sorted(set(ws), key=lambda w: (-self.idf[w], w))[:RARE]}
        self.index: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, ws in enumerate(self.words):
            for p, w in enumerate(ws):
                if w in rare:
                    self.index[w].append((t, p))
        # votes from so many different words: one for a few words, verified word for word
        self.need = [min(3, 1 + len(ws) // 8) for ws in self.words]
        self.looked_up = set(self.index)

    def rarest(self, words: list[bytes]) -> Iterator[tuple[int, bytes]]:
        """Places of the words of highest IDF of each stretch that the index has."""
        for lo in range(0, len(words), STRETCH):
            part = words[lo:lo + STRETCH]
            if held := self.looked_up.intersection(part):
                if len(held) > LOOKED_UP:
                    least = sorted((self.idf[w] for w in held), reverse=True)[LOOKED_UP - 1]
                    held = {w for w in held if self.idf[w] >= least}
                yield from ((lo + i, w) for i, w in enumerate(part) if w in held)

    def candidates(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """Template, and first and last offset of a cluster of votes."""
        votes: dict[int, list[tuple[int, bytes]]] = defaultdict(list)
        for i, w in self.rarest(words):
            for t, p in self.index[w]:
                votes[t].append((i - p, w))
        for t, cast in votes.items():
            cast.sort()
            lo = 0
            for hi in range(len(cast)):
                while cast[hi][0] - cast[lo][0] > SLACK:
                    lo += 1
                last = hi + 1 == len(cast) or cast[hi + 1][0] - cast[lo][0] > SLACK
                if last and len({w for _, w in cast[lo:hi + 1]}) >= self.need[t]:
                    yield t, cast[lo][0], cast[hi][0]

    def scan(self, words: list[bytes]) -> tuple[set[str], float]:
        if self.looked_up.isdisjoint(words):
            return set(), 0.0
        hits: dict[tuple[str, int, int], float] = {}  # label, stretch of a key phrase -> score
        for t, first, last in self.candidates(words):
            want = self.words[t]
            lo, hi = max(0, first - SLACK), min(len(words), last + len(want) + SLACK)
            keys = [[(at, at + len(key)) for at in places(words, key, lo, hi)] for key in self.keys[t]]
            if not all(keys):
                continue
            held = sum(self.idf[w] for p, w in enumerate(want) if w in words[max(0, first + p - SLACK):last + p + SLACK + 1])
            score = held / sum(self.idf[w] for w in want)
            if score >= LEAST:
                for found in keys:
                    for key in found:
                        hits[self.labels[t], *key] = max(score, hits.get((self.labels[t], *key), 0.0))
        own = {h: x for h, x in hits.items() if not any(
            o[0] != h[0] and o[1] <= h[1] and h[2] <= o[2] and o[2] - o[1] > h[2] - h[1] for o in hits)}
        return {label for label, _, _ in own}, min(1.0, max(own.values(), default=0.0))


def _frequencies(vocabulary: frozenset):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: Counter = Counter()
        docs = 0
        for got in batches:
            for text in got.column(0):
                df.update(vocabulary.intersection(words_of(text.as_py())))
            docs += got.num_rows
        rows = [*df.items(), (b"", docs)]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.binary()), pa.array([n for _, n in rows], pa.int64())],
                                         names=["word", "n"])

    return count


SCANNED = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
           "labels array<string>, score double")
_TYPES = [pa.int64(), *[pa.int64()] * 4, pa.list_(pa.string()), pa.list_(pa.string()), pa.float64()]


def _scan(shared, base: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(*shared.value)
        phrases = [(p.encode().split(), label) for p, label in base.items()]
        for got in batches:
            rows = []
            for text in got.column(1):
                words = words_of(text.as_py())
                starts, named = [], set()
                for phrase, label in phrases:
                    if found := places(words, phrase):
                        starts += found
                        named.add(label)
                labels, score = templates.scan(words)
                rows.append((len(words), len(starts), min(starts, default=None), max(starts, default=None), sorted(named),
                             sorted(named | labels), max(score, BASE_SCORE if named else 0.0)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [got.column(0), *[pa.array(c, t) for c, t in zip(columns, _TYPES[1:], strict=True)]],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return run


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=None, base: dict[str, str] | None = None) -> DataFrame:
    """Words, places of base phrases, labels and score of every document."""
    spark = docs.sparkSession
    ship(spark)
    templates = TEMPLATES if templates is None else templates
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    vocabulary = frozenset(w for t in templates for w in t[1].encode().split())
    counted = slim.select("text").mapInArrow(_frequencies(vocabulary), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    df = {bytes(w): n for w, n in counted.collect()}  # a row for each template word at most
    shared = spark.sparkContext.broadcast((templates, df, df.pop(b"", 0)))
    return slim.mapInArrow(_scan(shared, BASE if base is None else base), SCANNED)
