from __future__ import annotations

import hashlib
import random

import duckdb
import numpy as np
import pytest

from bankmart.llm import queries, suffix_dedup
from bankmart.llm.suffix_dedup import drop_repeats


def brute(docs: list[tuple[int | None, str | None]], threshold: int) -> list[tuple]:
    """doc_id, size, removed runs and kept bytes of documents in order, window by window."""
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0, i))
    seen, out = set(), []
    for i in order:
        raw = (docs[i][1] or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - threshold + 1):
            w = raw[s:s + threshold]
            if w in seen:
                gone[s:s + threshold] = b"\1" * threshold
            seen.add(w)
        spans, at = [], None
        for j, g in enumerate([*gone, 0]):
            if g and at is None:
                at = j
            elif not g and at is not None:
                spans.append((at, j))
                at = None
        out.append((docs[i][0], len(raw), tuple(spans), bytes(b for b, g in zip(raw, gone, strict=True) if not g)))
    return sorted(out, key=str)


def found(df, threshold: int) -> list[tuple]:
    return sorted(((r.doc_id, r.n_bytes, tuple(map(tuple, r.spans)), bytes(r.kept)) for r in drop_repeats(df, threshold=threshold).collect()), key=str)


def texts(rng: random.Random, n: int) -> list[str]:
    """Texts of shared passages, cut and joined anywhere, with copies and near copies."""
    passages = ["".join(rng.choice("ab cdé") for _ in range(rng.randint(10, 400))) for _ in range(12)]
    out = []
    for _ in range(n):
        kind = rng.random()
        if out and kind < 0.2:
            out.append(rng.choice(out))
        elif out and kind < 0.4:
            t = list(rng.choice(out) or "x")
            t[rng.randrange(len(t))] = "#"
            out.append("".join(t))
        else:
            parts = []
            for _ in range(rng.randint(0, 5)):
                p = rng.choice(passages)
                a = rng.randint(0, len(p))
                parts += [p[a:rng.randint(a, len(p))], "".join(rng.choice("xyz ") for _ in range(rng.randint(0, 30)))]
            out.append("".join(parts))
    return out


@pytest.mark.parametrize(("threshold", "parts"), [(100, 1), (100, 5), (37, 3), (16, 4), (200, 2)])
def test_same_as_brute_force(spark, threshold, parts):
    rng = random.Random(threshold + parts)
    docs = list(zip(rng.sample(range(1000), 120), texts(rng, 120), strict=True))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    assert found(df, threshold) == brute(docs, threshold)


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, "a" * 5000), (4, "ab" * 900), (5, "a" * 99), (6, "a" * 100), (None, "q" * 150), (8, "é" * 300), (9, "é" * 300),
            (7, "tail " * 50), (7, "tail " * 50), (7, "other"), (None, "q" * 150), (10, "z" + "ab" * 60), (11, "\u0000" * 130)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("text", "'x' kept", "1 spans", "doc_id", "2 as row").coalesce(1)
    assert found(df, 100) == brute(docs, 100)
    assert drop_repeats(df.limit(0)).collect() == []
    assert found(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), 100) == [(1, 0, (), b""), (2, 0, (), b"")]
    with pytest.raises(ValueError, match="threshold"):
        drop_repeats(df, threshold=8)


def test_a_passage_in_every_document_and_many_copies(spark):
    passage = "the passage that a third of all documents share, word for word, and that is a little longer than one window is. "
    docs = [(i, f"{i * 7919} begins. " + (passage if i % 3 == 0 else "no such thing. ") + f"ends {i * 104729}." if i % 5 else "one copy of many " * 20) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    assert found(df, 100) == brute(docs, 100)


def test_slices_and_runs_cover_every_window(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 64)
    rng = random.Random(5)
    parts = [rng.choice(["", "short", "".join(rng.choice("ab") for _ in range(500))]).encode() for _ in range(30)]
    raw, lengths = b"".join(parts), np.array([len(p) for p in parts])
    starts = np.cumsum(lengths) - lengths
    run = suffix_dedup.runs(raw, starts, lengths, 50)
    windows = np.concatenate([np.arange(a, b + 1) for a, b in zip(run["s0"], run["s1"], strict=True)])
    want = np.concatenate([np.arange(s, max(s, s + n - 49)) for s, n in zip(starts, lengths, strict=True)])
    assert sorted(windows) == sorted(want)
    k = suffix_dedup.anchor_width(50)
    assert ((run["s1"] <= run["p"]) & (run["p"] + k <= run["s0"] + 50)).all()
    by_text = {}
    for a, b, p in zip(run["s0"].tolist(), run["s1"].tolist(), run["p"].tolist(), strict=True):
        for s in range(a, b + 1):
            assert by_text.setdefault(raw[s:s + 50], p - s) == p - s  # equal windows, equal offsets


def test_long_text(spark):
    rng = random.Random(9)
    base = "".join(rng.choice("abcdefgh ") for _ in range(700_000))
    docs = [(1, base), (2, base[100_000:650_000] + "!" + base[:99])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    got = {r.doc_id: r for r in drop_repeats(df).collect()}
    assert got[1].kept == base.encode() and [tuple(s) for s in got[2].spans] == [(0, 550_000)]


def test_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"create view documents as from '{sf}/documents.parquet'")
    want = con.sql(queries.ORACLE_SQL["op12_suffix_dedup"]).fetchall()
    got = queries.op12_suffix_dedup(spark, sf)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert hashlib.sha256(b"").hexdigest()


def test_a_task_takes_little_beside_its_block(monkeypatch):
    import tracemalloc

    import pyarrow as pa

    n = 200
    raw = np.random.default_rng(3).integers(97, 123, n * 20_000, np.uint8).tobytes()
    lengths = np.full(n, 20_000)
    starts = np.cumsum(lengths) - lengths
    block = object.__new__(suffix_dedup._Block)
    block.id, block.ids, block.raw, block.lengths, block.starts = 0, pa.array(range(n)), raw, lengths, starts

    def peak(work):
        tracemalloc.start()
        try:
            return work(), tracemalloc.get_traced_memory()[1] / len(raw)
        finally:
            tracemalloc.stop()

    cut, most = peak(lambda: suffix_dedup._cut_block(block, starts + 7, starts + 207))
    assert most < 3  # it was over 20 times the block
    assert cut.column(2)[5].as_py() == [{"start": 7, "end": 207}] and cut.column(3)[5].as_py() == raw[100_000:100_007] + raw[100_207:120_000]
    _, most = peak(lambda: suffix_dedup.runs(raw, starts, lengths, 100))
    assert most < 10  # it was over 12 times
    # what a task hands back comes in bounded batches
    monkeypatch.setattr(suffix_dedup, "PART", 1000)
    got = pa.RecordBatch.from_arrays(
        [pa.array([0]), pa.array([list(range(n))], pa.list_(pa.int64())), pa.array([lengths.tolist()], pa.list_(pa.int64())), pa.array([pa.compress(raw, codec="zstd", asbytes=True)])],
        schema=suffix_dedup._BLOCKS)
    assert max(b.num_rows for b in suffix_dedup._first_runs(100)(iter([got]))) == 1000
