from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from bankmart.llm import queries
from bankmart.llm.prefix_trie import ordered_turns, prefix_trie, shared_heads

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def sequences(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    return {c: [t[3:] for t in sorted(ts)] for c, ts in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(abs(c) % 20 * (1 if c >= 0 else -1))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids, out = defaultdict(int), []
    for path in members:
        if path:
            kids[path[:-1]] += 1
    for path, cs in members.items():
        below = [p for p in members if p[:len(path)] == path]
        ends = sorted(c for c in cs if len(convs[c]) == len(path))
        out.append((min(cs), len(path), min(members[path[:-1]]) if path else None, len(cs), kids[path], sum(not kids[p] for p in below),
                    sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(df):
    return sorted(map(tuple, df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=str)


def plain_trie(df):
    turns = ordered_turns(df)
    return prefix_trie(turns.selectExpr("conv_id", "place as depth", "digest", "words"), turns.where("place = 0").selectExpr("conv_id", "n_turns as length"))


def op13(spark, df, tmp):
    df.write.parquet(f"{tmp}/conversations.parquet")
    return queries.op13_prefix_trie(spark, tmp)


@pytest.mark.parametrize("seed", range(3))
def test_same_as_brute_force(spark, scratch, seed):
    rng = random.Random(seed)
    words = ["yes", "no  way", "a b c", "", "tab\there", "  x"]
    rows = [(c, t, rng.choice(["user", "bot", None]), rng.choice(words)) for c in rng.sample(range(-40, 90), 60) for t in range(rng.randint(1, 9))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert nodes(plain_trie(df)) == brute(sequences(rows))
    assert nodes(op13(spark, df, scratch)) == brute(rebuilt(sequences(rows)))


def test_edge_cases(spark, scratch):
    rows = [(None, 0, "user", "x"), (21, 0, None, None), (22, None, "user", "null turn"), (22, 0, "user", "zero"), (40, 1, "a", "b"), (40, 1, "a", "b"),
            (41, 5, "a", "b"), (41, 1, "a", "b"), (61, 0, "r", "only"), (62, 0, "ab", "c"), (63, 0, "a", "bc"), (64, 0, "r", "w " * 40_000), (65, 0, "r", "w " * 40_000)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 depth", "'x' digest", "3 as name")
    assert nodes(plain_trie(df)) == brute(sequences(rows))
    assert nodes(op13(spark, df, scratch)) == brute(rebuilt(sequences(rows)))
    assert plain_trie(df.limit(0)).collect() == []
    one = spark.createDataFrame([(7, 0, "r", "t")], SCHEMA)
    assert nodes(plain_trie(one)) == brute(sequences([(7, 0, "r", "t")]))


def test_one_long_conversation_and_many_copies(spark):
    """A conversation with most of all turns, branches off it at depths that no cut meets, and copies."""
    long = [(0, t, "r", f"turn {t % 50}") for t in range(130)]
    rows = long + [(c, t, "r", f"turn {t % 50}") for c, n in ((1, 129), (2, 64), (3, 65), (4, 1)) for t in range(n)]
    rows += [(c, t, "r", f"turn {t}" if t < 7 else f"own {c % 3}") for c in range(5, 40) for t in range(9)]
    got = nodes(plain_trie(spark.createDataFrame(rows, SCHEMA).repartition(6)))
    assert got == brute(sequences(rows))


def test_conversations_without_turns(spark):
    convs = spark.createDataFrame([(3, 0), (1, 0), (2, 1)], "conv_id long, length long")
    seq = spark.createDataFrame([(2, 0, b"0123456789abcdef", 4)], "conv_id long, depth long, digest binary, words long")
    empty = hashlib.sha256(b"").hexdigest()
    assert nodes(prefix_trie(seq, convs)) == sorted([(1, 0, None, 3, 1, 1, 0, hashlib.sha256(b"1,3").hexdigest()),
                                                     (2, 1, 1, 1, 0, 1, 0, hashlib.sha256(b"2").hexdigest())], key=str)
    assert nodes(prefix_trie(seq.limit(0), convs.where("length = 0"))) == [(1, 0, None, 2, 0, 1, 0, hashlib.sha256(b"1,3").hexdigest())]
    assert empty


def test_heads(spark):
    turns = ordered_turns(spark.createDataFrame([(20, 0, "r", "s"), (20, 1, "r", "t"), (23, 0, "r", "own")], SCHEMA))
    from pyspark.sql import functions as F

    seq, convs = shared_heads(turns, 20, F.lit(3), 3)
    assert {(r.conv_id, r.length) for r in convs.collect()} == {(20, 2), (23, 2)} and seq.count() == 4


def test_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view conversations as from '{sf}/conversations.parquet'")
    want = con.sql(queries.ORACLE_SQL["op13_prefix_trie"]).fetchall()
    assert sorted(map(tuple, queries.op13_prefix_trie(spark, sf).collect()), key=str) == sorted(want, key=str)
