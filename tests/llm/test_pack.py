from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bankmart.llm import pack
from bankmart.llm.queries import pack_pieces, tokenizer_path


def expected_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return [[*e.ids, 0] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def check(rows, docs):
    ids = {d: i for (d, _), i in zip(docs, expected_ids([t for _, t in docs]), strict=True)}
    seqs, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        whole = ids[r.doc_id]
        assert r.doc_tokens == len(whole)
        assert r.ids_crc32 == zlib.crc32(np.array(whole[r.start:r.start + r.length], "<u4").tobytes())
        seqs[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, r.length))
    for d, whole in ids.items():
        at = 0
        for start, length in sorted(pieces[d]):
            assert start == at and length > 0
            at += length
        assert at == len(whole)
    for s in seqs.values():
        at = 0
        for off, length in sorted(s):
            assert off == at
            at += length
        assert at <= 1024
    return len(seqs), sum(map(len, ids.values()))


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, "a  b \n c"), (4, "x " * 5000), (5, " lead"), (6, "trail "), (7, "<|endoftext|> it's 1,000 ok"),
            (8, "été " * 900), (9, "same"), (10, "same"), (11, "q" * 3000), (12, "a\n\nb\tc \t d"),
            (13, "<|endoftext|>"), (14, "<|endoftext|> hi"), (15, "x<|endoftext|><|endoftext|> \n<|endoftext"), (16, "<|endoftext|>y " * 800)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 ids", "'x' start")
    check(pack_pieces(df).collect(), docs)
    assert pack_pieces(df.limit(0)).collect() == []


def test_whole_table_little_padding(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = [(r.doc_id, r.text) for r in df.collect()]
    n, tokens = check(pack_pieces(df).collect(), docs)
    assert tokens / (n * 1024) > 0.985


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 1023), min_size=1, max_size=60))
def test_windows_hold(sizes):
    part, k = pack.windows(sizes, 1024)
    sums = np.bincount(part, weights=sizes, minlength=k)
    assert sums.max() <= 1024 and len(sums) == k


@pytest.mark.parametrize("n", [1, 15, 16, 31, 32, 33, 1023])
def test_halves(n):
    assert sum(pack.halves(n, 16)) == n and min(pack.halves(n, 16)) >= 1
