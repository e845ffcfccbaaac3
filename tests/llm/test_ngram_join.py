from __future__ import annotations

import random
import re

from bankmart.llm.ngram_join import Shingler, jaccard_components
from bankmart.llm.queries import op2_ngram_join


def brute(rows, n, percent):
    sets = []
    for _, t in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    comp = list(range(len(rows)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    where = {}
    for i, s in enumerate(sets):
        tried = set()
        for g in s:
            for j in where.setdefault(g, []):
                if j not in tried:
                    tried.add(j)
                    if 100 * len(s & sets[j]) >= percent * len(s | sets[j]):
                        comp[find(i)] = find(j)
            where[g].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def result(df, **how):
    return sorted(((r.id, r.n_shingles, r.component_id) for r in jaccard_components(df, **how).collect()), key=str)


def noisy(rng, words, share):
    out = list(words)
    for _ in range(int(share * len(words))):
        out[rng.randrange(len(out))] = f"n{rng.randrange(10 ** 6)}"
    return " ".join(out)


def test_near_copies_against_brute_force(spark):
    rng = random.Random(2)
    rows, i = [], 0
    for group in range(25):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.choice([5, 8, 15, 30, 60, 150, 400]))]
        for _ in range(rng.choice([1, 2, 5, 40])):
            rows.append((i, noisy(rng, base, rng.choice([0, 0.02, 0.04, 0.08]))[: rng.choice([None, None, -6])]))
            i += 1
    common = " ".join(f"c{k}" for k in range(60))  # a passage that many unlike documents share
    rows += [(i + k, common + " " + " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(rng.choice([3, 20, 100])))) for k in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for n, percent in ((4, 85), (5, 80), (2, 60)):
        assert result(df, words=n, percent=percent) == brute(rows, n, percent)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in op2_ngram_join(spark, sf).collect()), key=str) == brute(rows, 4, 85)


def test_edge_cases(spark):
    rows = [(5, None), (4, ""), (3, " \t"), (9, "A b"), (2, "a B"), (7, "a b c"), (8, "É b c d e"), (6, "é b c d e"), (None, "a b"), (None, "zz yy xx ww vv"),
            (20, "w " * 30000), (21, "w w w w w"), (22, "x y z u v"), (1, "a b"), (1, "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 id", "'x' sig", "2 n")
    assert result(df, words=4, percent=85) == brute(rows, 4, 85)
    assert result(df.limit(0)) == []


def test_every_similar_pair_shares_a_key():
    rng = random.Random(9)
    for percent in (85, 80):
        shingler = Shingler(3, percent)
        for _ in range(1500):
            base = [f"v{rng.randrange(50)}" for _ in range(rng.choice([4, 6, 9, 14, 22, 40, 80, 200]))]
            a, b = shingler.grams(noisy(rng, base, rng.choice([0.02, 0.05]))), shingler.grams(noisy(rng, base, 0.03))
            common = len(set(a.tolist()) & set(b.tolist()))
            if 100 * common >= percent * (len(a) + len(b) - common):
                assert set(shingler.keys(a).tolist()) & set(shingler.keys(b).tolist())
