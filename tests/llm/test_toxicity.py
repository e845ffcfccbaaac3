from __future__ import annotations

import zlib

import numpy as np
import pytest

from bankmart.llm import toxicity as tox
from bankmart.llm.queries import op6_toxicity, toxicity

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op6_toxicity(spark, SF).collect()
    assert len(rows) == 1000
    out = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert r.predicted == (r.score >= 0.7)
    tp = sum(p and y for p, y in out)
    assert tp / sum(y for _, y in out) > 0.6 and tp / max(1, sum(p for p, _ in out)) > 0.9


def test_disguised_words(spark):
    words = "river stone garden window letter summer winter morning evening paper table chair".split()
    docs = [(i, " ".join(words[(i * k) % 12] for k in range(1, 9)) + (" idiot" if i % 4 == 0 else " moron" if i % 4 == 1 else ""))
            for i in range(400)]
    labels = [(i, int(i % 4 < 2)) for i in range(400)] + [(0, None), (None, 1), (2, 0), (2, 0)]
    tests = {1000: "river stone you 1d10t garden", 1001: "i d i o t of the morning", 1002: "what an idiooooot", 1003: "m.o.r.o.n at the table",
             1004: "m0r0n", 1005: "you iiddiioott", 1006: "river stone 1234 garden a b c", 1007: "", 1008: None, 1009: "window letter " * 20000,
             1010: "M O R O N", 1011: "paper id 10 t 5"}
    df = spark.createDataFrame(docs + list(tests.items()) + [(None, "table")], "doc_id long, text string").selectExpr("*", "'z' score", "1 cell")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity(df, lab).collect()}
    assert [got[i] for i in (1000, 1001, 1002, 1003, 1004, 1005, 1010)] == [1] * 7
    assert [got[i] for i in (1006, 1007, 1008, 1009, 1011, None)] == [0] * 6
    assert {r.score for r in toxicity(df, lab.limit(0)).collect()} == {0.0}
    assert toxicity(df.limit(0), lab).collect() == []


def test_long_and_widely_spaced_disguises(spark):
    words = "river stone garden window letter summer winter morning evening paper table chair".split()
    docs = [(i, " ".join(words[(i * k) % 12] for k in range(1, 9)) + (" idiot" if i % 4 == 0 else " moron" if i % 4 == 1 else ""))
            for i in range(400)]
    joined = ".".join(words[k % 12] for k in range(40))
    tests = {1000: "an idi" + "o" * 70 + "t", 1001: f"{joined}.m0r0n.{joined}", 1002: "i  d  i  o  t", 1003: "m\no\nr\no\nn",
             1004: "you m 0 r @ n, m o r o n!", 1005: "1 d ! 0 t", 1006: joined, 1007: "* * * * * | | | | |", 1008: "x." * 20000}
    df = spark.createDataFrame(docs + list(tests.items()), "doc_id long, text string")
    lab = spark.createDataFrame([(i, int(i % 4 < 2)) for i in range(400)], "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity(df, lab).collect()}
    assert [got[i] for i in range(1000, 1009)] == [1] * 6 + [0] * 3


def brute_reading(model, lattice):
    """The cheapest of all readings, scored letter by letter."""
    from itertools import product

    best = None
    for choice in product(*lattice, [(" ", 0.0)]):
        a = b = 0
        cost, read = 0.0, ""
        for letters, price in choice:
            cost += price
            for c in letters:
                z = tox.NUMBER.get(c, 0)
                if z or b:
                    cost -= model.logp[a][b][z]
                    a, b = b, z
            read += letters
        if best is None or cost < best[0] - 1e-9:
            best = (cost, read)
    return best


@pytest.mark.parametrize("token", ["m0r0n", "id1ot", "st.u.p", "l0ooser", "$c@m", "he||o", "4ss!", "b-a-d", "a", "x1y2", "t+e+n"])
def test_decoding_is_the_cheapest_of_all_readings(token):
    rng = np.random.default_rng(len(token))
    words = ["moron", "idiot", "stupid", "loser", "scam", "hello", "ass", "bad", "ten", "the", "and"]
    counts = np.zeros(tox.SIZE ** 3, np.int64)
    for w in rng.choice(words, 400):
        ids = [0, 0, *[tox.NUMBER[c] for c in w], 0]
        for a, b, c in zip(ids, ids[1:], ids[2:], strict=False):
            counts[(a * tox.SIZE + b) * tox.SIZE + c] += 1
    model = tox.Model(counts)
    for lattice in (tox.lattice_of(token), tox.lattice_of(token, free_bounds=True)):
        want = brute_reading(model, lattice)
        got = model.decode(lattice)
        assert got.split() == want[1].split()


def test_a_repeated_labelled_id_is_one_row(spark):
    """Rows that share a labelled id count once, whatever their number and order."""
    docs = [(i, "a fine day" if i % 2 else "you moron") for i in range(40)] + [(1, f"text {i}") for i in range(300)]
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)], "doc_id long, toxic int")
    schema = "doc_id long, text string"
    one = tox.score_toxicity(spark.createDataFrame(docs, schema), labels).orderBy("doc_id", "score").collect()
    two = tox.score_toxicity(spark.createDataFrame(docs[::-1], schema).repartition(7), labels).orderBy("doc_id", "score").collect()
    assert one == two and len(one) == 340
    assert {r.score > 0.5 for r in one if r.doc_id % 2 == 0} == {True}
