from __future__ import annotations

import re

from bankmart.llm.licenses import BASE, scan_licenses
from bankmart.llm.queries import op4_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    hits = [(i, label) for phrase, label in BASE.items() for p in [phrase.split()]
            for i in range(len(words)) if words[i:i + len(p)] == p]
    at = [i for i, _ in hits]
    return (len(words), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits})))


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op4_licenses(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
        assert ("cc-by-nc" in r.labels.split(",")) == ("CC BY-NC 4.0" in (texts[r.doc_id] or ""))


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, "MIT License. mit-license MIT\nLICENSE"), (4, "général public license General Public License"),
            (5, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
                "files (the “Software”), to deal in the Software without restriction"),
            (6, "permission charge person copy software files deal restriction"), (7, "word " * 50000 + "apache license"), (7, "dup"),
            (None, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 labels", "'x' score")
    got = scan_licenses(df).collect()
    assert len(got) == len(docs)
    by = {(r.doc_id, r.n_words): r for r in got}
    for i, t in docs:
        r = by[i, brute(t)[0]]
        assert (r.n_base, r.first_word, r.last_word, ",".join(r.base_labels)) == brute(t)[1:]
    assert "mit" in by[5, brute(docs[4][1])[0]].labels and by[6, 8].labels == [] and by[6, 8].score == 0
    assert by[None, brute(docs[-1][1])[0]].labels == ["bsd"]
    assert scan_licenses(df.limit(0)).collect() == []


TEXTS = {
    "// SPDX-License-Identifier: MIT": "mit", "# SPDX-License-Identifier: Apache-2.0": "apache", "SPDX-License-Identifier: CC-BY-NC-SA-4.0": "cc-by-nc-sa",
    "SPDX-License-Identifier: GPL-3.0-or-later": "gpl", "SPDX-License-Identifier: BSD-3-Clause": "bsd", "SPDX-License-Identifier: Zlib": "zlib",
    "This program is distributed in the hope that it will be useful,\n * but WITHOUT ANY WARRANTY; without even the implied warranty of\n * "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the\n * GNU General Public License for more details.": "gpl",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission.": "bsd",
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND "
    "ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.": "bsd",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0": "epl",
    "To the extent possible under law, Jo Roe has waived all copyright and related or neighboring rights to this work.": "cc0",
    "Licensed under CC BY-ND 4.0": "cc-by-nd", "Licensed under CC BY-NC-SA 4.0.": "cc-by-nc-sa", "Licensed under CC BY-NC 4.0.": "cc-by-nc", "Licensed under CC BY 4.0": "cc-by",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.": "cc-by-nc-sa",
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
    "subject to the following restrictions:": "zlib",
    "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt)": "bsl",
    "Licensed under the GNU Lesser General Public License": "gpl,lgpl",  # the base phrase counts as well
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
    "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations "
    "under the License.": "apache",
    "The program is free and the license is with the public, general use of the software is permitted by law.": "", "cc by 4 o'clock, 0 people": ""}


def test_notices_and_texts_of_licences(spark):
    filler = "the river and the stone of the garden is a window to the morning paper. " * 40
    docs = list(TEXTS) + [filler + t + " " + filler for t in TEXTS]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {r.doc_id: ",".join(r.labels) for r in scan_licenses(df).collect()}
    assert [got[i] for i in range(len(docs))] == list(TEXTS.values()) * 2


def test_a_file_of_all_licences_has_all_labels(spark):
    text = "\n\n".join(TEXTS)
    got = scan_licenses(spark.createDataFrame([(1, text)] + [(i, "plain words of a text") for i in range(2, 30)], "doc_id long, text string"))
    assert set(got.where("doc_id = 1").first().labels) == {x for v in TEXTS.values() for x in v.split(",") if x}


def test_every_template_is_found_word_for_word():
    """Against a plain search of every template's words in order."""
    import random

    from bankmart.llm.licenses import TEMPLATES, Templates

    rng = random.Random(4)
    vocabulary = sorted({w for t in TEMPLATES for w in t[1].split()})
    templates = Templates(TEMPLATES, {}, 10)
    for _ in range(60):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 30))) for _ in range(4)]
        whole = rng.sample(TEMPLATES, 3)
        text = " ".join(x for pair in zip(parts, [t[1] for t in whole] + [""], strict=True) for x in pair)
        labels, score = templates.scan(text.encode().split())
        longer = {t[0] for t in TEMPLATES if any(k in text for k in t[2])}
        assert {t[0] for t in whole} - labels <= {t[0] for t in whole if any(t[2][0] in o[2][0] and o[0] != t[0] and o[0] in longer for o in TEMPLATES)}
        assert score > 0.99
