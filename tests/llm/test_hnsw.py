from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest

from bankmart.llm import hnsw
from bankmart.llm.hnsw import nearest
from bankmart.llm.queries import op7_hnsw


def brute(rows, k=20, step=20):
    good = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    ids, x = np.array([i for i, _ in good]), np.array([v for _, v in good])
    out = {}
    for i, v in good:
        if i % step == 0:
            s = x @ v
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def grouped(rows):
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    return got


def test_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in df.collect()])
    whole = grouped(op7_hnsw(spark, "/root/testdata/sf0.1").collect())
    split = grouped(nearest(df, lambda c: c % 20 == 0, shard=300).collect())
    for got in (whole, split):
        assert set(got) == set(want)
        hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
        assert hit / sum(map(len, want.values())) >= 0.97
        for q, found in got.items():
            assert len(found) == 20 and found == sorted(found, key=lambda p: (-p[1], p[0]))


def test_edge_cases(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(60)]
    rows += [(i, [1.0] * 8) for i in range(100, 180)]  # one very common vector
    rows += [(200, None), (201, [0.0] * 8), (202, [None] + [1.0] * 7), (203, [float("nan")] * 8), (220, [float("inf")] * 8), (None, [1.0] * 8),
             (240, []), (100, [1.0] * 8), (260, [-0.0] * 7 + [2.0]), (261, [0.0] * 7 + [2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 node", "'x' v")
    want = brute(list({(i, tuple(v) if v else None): (i, v) for i, v in rows}.values()))
    got = grouped(nearest(df, lambda c: c % 20 == 0).collect())
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]])
    assert nearest(df.limit(0), lambda c: c % 20 == 0).collect() == []
    assert nearest(df.where("vec_id = 20"), lambda c: c % 20 == 0).collect() == []


def unit(a):
    return a / np.linalg.norm(a, axis=1, keepdims=True)


def full_shard(kind: str, n: int = 8192, d: int = 64) -> np.ndarray:
    rng = np.random.default_rng(3)
    even, lengths = unit(rng.normal(size=(n, d))), rng.lognormal(0, 0.6, (n, 1))
    if kind == "uniform":
        return even
    if kind == "unequal":
        return even * lengths
    size = int(kind.removeprefix("half").removeprefix("groups"))
    x = np.repeat(unit(rng.normal(size=(n // size + 1, d))), size, axis=0)[:n] + rng.normal(size=(n, d)) * 0.01
    if kind.startswith("half"):
        x[n // 2:] = (even * lengths)[n // 2:]
    return x


@pytest.mark.parametrize("kind", ["uniform", "unequal", "groups50", "groups256", "groups1000", "half256"])
def test_recall_of_a_full_shard(kind):
    """Share of the 20 largest inner products found, and of the worst query."""
    x = full_shard(kind)
    layers = [hnsw.Layer(nodes, len(x), links) for nodes, links in hnsw.build(x)]
    asked = np.arange(0, len(x), 40)
    found = hnsw.search(x, layers, x[asked], hnsw.EF)
    scores = x[asked] @ x.T
    scores[np.arange(len(asked)), asked] = -np.inf
    least = np.sort(scores, axis=1)[:, -20]
    hit = (found >= 0) & (found != asked[:, None])
    got = np.where(hit, np.einsum("qd,qbd->qb", x[asked], x[found]), -np.inf)
    recall = np.minimum((got >= least[:, None] - 1e-9).sum(1), 20) / 20
    assert recall.mean() >= 0.97 and recall.min() >= 0.7


def test_layers_hold_every_node_once():
    for n in (1, 2, 7, 40, 500):
        layers = hnsw.build(np.random.default_rng(n).normal(size=(n, 3)))
        assert sorted(layers[0][0].tolist()) == list(range(n))
        for nodes, links in layers:
            inside = set(nodes.tolist())
            for a, own in zip(nodes.tolist(), links.tolist(), strict=True):
                to = [b for b in own if b >= 0]
                assert len(to) == len(set(to)) and a not in to and set(to) <= inside
