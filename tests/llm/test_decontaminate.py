from __future__ import annotations

import random

from bankmart.llm.decontaminate import TAU, Index, leaks, without_leaks, words_of
from bankmart.llm.queries import op5_decontaminate

SF = "/root/testdata/sf0.01"


def infix_distance(a, b):
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a):
        nxt = [i + 1]
        for j, y in enumerate(b):
            nxt.append(min(row[j + 1] + 1, nxt[j] + 1, row[j] + (x != y)))
        row = nxt
    return min(row)


def test_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars < 2500").limit(250)
    items = [(r.item_id, words_of(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = set()
    for r in docs.collect():
        words = words_of(r.text)
        known = set(words)
        for i, item in items:
            if sum(w in known for w in item) >= (1 - TAU) * len(item) and infix_distance(item, words) <= int(TAU * len(item)):
                want.add((r.doc_id, i))
    got = {(r.doc_id, r.item_id) for r in leaks(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert got <= want and len(got) >= 0.95 * len(want)


def test_all_exact_passages(spark):
    items = [(r.item_id, b" " + b" ".join(words_of(r.text)) + b" ") for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {(r.doc_id, i) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()
            for joined in [b" " + b" ".join(words_of(r.text)) + b" "] for i, t in items if t in joined}
    rows = op5_decontaminate(spark, SF).collect()
    assert want and want == {(r.doc_id, r.item_id) for r in rows if r.edits == 0}


def test_recall_of_edited_passages():
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(3000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(15, 70)))) for i in range(60)]
    index = Index(items)
    texts, want = [], []
    for i, t in items:
        words = t.split()
        for _ in range(int(rng.random() * TAU * len(words))):
            j = rng.randrange(len(words))
            words[j:j + 1] = [["odd"], [], [words[j], "odd"]][rng.randrange(3)]
        texts.append([index.of.get(w.encode(), 0) for w in rng.choices(vocabulary, k=40) + words + rng.choices(vocabulary, k=40)])
        want.append(i)
    found = [{index.ids[i] for i, *_ in f} for f in index.found(texts)]
    assert sum(i in f for i, f in zip(want, found)) >= 0.93 * len(want)
    assert sum(len(f) for f in found) <= len(want) + 1


def test_edge_cases(spark):
    bench = spark.createDataFrame([(1, "One two three four five six seven."), (2, None), (3, "..."), (4, "solo"), (4, "solo")],
                                  "item_id long, text string").selectExpr("*", "1 doc_id")
    docs = [(1, "x ONE, two three; four five six seven y"), (2, None), (3, ""), (4, "one two three four five"), (5, "go solo"),
            (None, "one two three four five six seven"), (6, "one two three four five six seven " * 3000), (6, "one two three five six seven")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "2 item_id", "'q' edits")
    got = sorted((str(r.doc_id), r.item_id) for r in leaks(df, bench).collect())
    assert got == sorted([("1", 1), ("None", 1), ("6", 1), ("6", 1), ("5", 4), ("5", 4)])
    blocks = sorted((str(r.doc_id), r.item_id) for r in leaks(df, bench, items=2).collect())
    assert blocks == got
    kept = without_leaks(df, bench, items=2)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]
    assert leaks(df.limit(0), bench).collect() == [] and leaks(df, bench.limit(0)).collect() == []
    assert without_leaks(df, bench.limit(0)).count() == len(docs)


def at_the_bound(lengths, seed, first=False):
    """Share of copies with as many edits as allowed that are found."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=n))) for i, n in enumerate(lengths)]
    index = Index(items)
    texts = []
    for _, t in items:
        words = t.split()
        places = set(rng.sample(range(1, len(words)), int(TAU * len(words)) - first)) | ({0} if first else set())
        for j in sorted(places, reverse=True):
            words[j:j + 1] = [["odd"], [], [words[j], "odd"]][rng.randrange(3) if j else 0]
        texts.append([index.of.get(w.encode(), 0) for w in rng.choices(vocabulary, k=40) + words + rng.choices(vocabulary, k=40)])
    found = [{i for i, *_ in f} for f in index.found(texts)]
    return index, sum(i in f for i, f in enumerate(found)) / len(items)


def test_recall_at_the_bound():
    assert at_the_bound([15 + i % 45 for i in range(400)], 1)[1] >= 0.96
    assert at_the_bound([15 + i % 45 for i in range(400)], 2, first=True)[1] >= 0.96
    assert at_the_bound([5 + i % 10 for i in range(400)], 3)[1] >= 0.96


def test_long_items_are_searched_exactly():
    index, share = at_the_bound([400 + i for i in range(30)], 4)
    assert set(index.repeats) == {0} and share == 1


def test_first_and_last_words_of_documents():
    items = [(1, " ".join(f"w{k}" for k in range(20)))]
    index = Index(items)
    texts = [[index.of.get(w.encode(), 0) for w in t.split()] for t in
             (items[0][1], "odd " + items[0][1], " ".join(items[0][1].split()[1:]), " ".join(items[0][1].split()[:-3]), "", "w1 w2")]
    assert [[(e, a) for _, e, a in f] for f in index.found(texts)] == [[(0, 0)], [(0, 1)], [(1, 0)], [(3, 0)], [], []]
