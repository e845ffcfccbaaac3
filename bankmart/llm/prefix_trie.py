"""Prefix trie of conversations by van Emde Boas recursion.

A conversation is the sequence of its turns.  The trie's levels are cut at
half depth into an upper trie and lower forests, and those again, until a
block is one level high.  All blocks of a height are worked on together, so
there are as many rounds as halvings, whatever the number of turns.

Down: the prefixes that end at a cut are named by their smallest member (the
least conversation that starts with them) and become the roots of the lower
forests.  What tells prefixes of one root apart is the digest of the block
between root and cut, built bottom up from pairs of half blocks.  When
blocks are one level high, the root of each is its node's parent.

Up: totals of the lower forests are grafted on the cut nodes and their
ancestors in the upper trie, smallest blocks first; a round adds each
forest's total once, so that a subtree's total is whole after the last.

Places of turns come from a sort of all turns by range and a count per
conversation and partition, so that one conversation with a large part of
all turns is spread like any other rows.  Joins on prefixes have one row per
prefix on one side; Spark splits large partitions of the other.  Members that
end at a node go through a hash in order of their ids: SHA-256 is sequential,
so the task of a node reads its ids as a stream, with one state in memory.

Defined results: rows without a conversation id take no part; null roles and
texts are empty; turns are ordered by number, null first, ties by the SHA-256
digest of role and text; repeated rows are repeated turns; very long texts
and conversations are digested whole, 128 bits each (two different turns or
blocks fall together with odds of about their pairs / 2 ** 128); an empty
table gives no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankmart.llm.common import ship, written

WORD = "[^\\x20\\x09-\\x0D]+"


def _digest(data: F.Column) -> F.Column:
    return F.substring(F.unhex(F.sha2(data, 256)), 1, 16)


def ordered_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, place (from 0), n_turns of the conversation, digest and words of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        _digest(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("digest")]
    turns = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    turns = written(turns.select("conv_id", "digest", "words", F.monotonically_increasing_id().alias("at")), "trie-turns")
    part = F.shiftright("at", 33)
    # a row for each conversation and partition that holds some of it
    runs = turns.groupBy("conv_id", part.alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    of_conv = Window.partitionBy("conv_id")
    runs = runs.select("conv_id", "part", "first", F.sum("n").over(of_conv).alias("n_turns"),
                       F.coalesce(F.sum("n").over(of_conv.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return (turns.withColumn("part", part).join(runs, ["conv_id", "part"])
            .select("conv_id", (F.col("at") - F.col("first") + F.col("before")).alias("place"), "n_turns", "digest", "words"))


def shared_heads(turns: DataFrame, span: int, head: F.Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on common heads: of conversation c the first ``head`` turns (a
    column of conv_id, at most ``most``) come from conversation c - c % ``span``, the
    others are its own.  Returns the sequences and the conversations with their lengths."""
    turns = written(turns, "trie-places")
    lengths = turns.where("place = 0").select("conv_id", "n_turns", (F.col("conv_id") - F.col("conv_id") % span).alias("base"), head.alias("head"))
    base = turns.where(F.col("place") < most).select(F.col("conv_id").alias("base"), F.col("place").alias("depth"), "digest", "words")
    of_base = turns.where("place = 0").select(F.col("conv_id").alias("base"), F.col("n_turns").alias("base_turns"))
    convs = lengths.join(of_base, "base", "left").select(
        "conv_id", "base", "head", F.least("head", F.coalesce("base_turns", F.lit(0))).alias("taken"),
        F.greatest(F.col("n_turns") - F.col("head"), F.lit(0)).alias("own"))
    convs = written(convs, "trie-convs")
    heads = convs.join(base, "base").where("depth < head").select("conv_id", "depth", "digest", "words")
    own = turns.join(convs.select("conv_id", "head", "taken"), "conv_id").where("place >= head").select(
        "conv_id", (F.col("place") - F.col("head") + F.col("taken")).alias("depth"), "digest", "words")
    return heads.unionByName(own), convs.select("conv_id", (F.col("taken") + F.col("own")).alias("length"))


def _ends_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the comma-joined ids of each (depth, name), sorted rows as a stream."""
    key, state = None, None
    done: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) or [(), (), ()]
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
                                          names=["depth", "name", "ends_sha256"])

    for got in batches:
        for depth, name, conv in zip(*(got.column(i).to_pylist() for i in range(3)), strict=True):
            if (depth, name) != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (depth, name), hashlib.sha256(str(conv).encode())
            else:
                state.update(b",%d" % conv)
        if len(done) >= 10_000:
            yield flush()
    if key is not None:
        done.append((*key, state.hexdigest()))
    if done:
        yield flush()


def _named(turns: DataFrame, convs: DataFrame, levels: int, root: int) -> DataFrame:
    """conv_id, level, up: for every turn the name of the prefix above it."""
    blocks = [turns.select("conv_id", F.col("level").alias("block"), "digest")]
    for _ in range(1, levels):
        half = F.col("block") % 2 == 0
        pair = blocks[-1].groupBy("conv_id", F.shiftright("block", 1).alias("block")).agg(
            F.max(F.when(half, F.col("digest"))).alias("a"), F.max(F.when(~half, F.col("digest"))).alias("b"))
        whole = pair.where("a is not null and b is not null")
        blocks.append(written(whole.select("conv_id", "block", _digest(F.concat("a", "b")).alias("digest")), "trie-blocks"))
    state = convs.where("length > 0").select("conv_id", "length", F.lit(0).cast("long").alias("block"), F.lit(root).cast("long").alias("up"))
    for j in range(levels - 1, -1, -1):
        upper = blocks[j].where("block % 2 = 0").select("conv_id", F.shiftright("block", 1).alias("block"), "digest")
        depth = (2 * F.col("block") + 1) * (1 << j)  # of the cut; members that end there count for its names, too
        cut = state.where(F.col("length") >= depth).join(upper, ["conv_id", "block"])
        # written, so that the join shuffles both sides and Spark may split what a hot prefix makes large
        names = written(cut.groupBy("block", "up", "digest").agg(F.min("conv_id").alias("name")), "trie-cuts")
        lower = cut.where(F.col("length") > depth).join(names, ["block", "up", "digest"]).select(
            "conv_id", "length", (2 * F.col("block") + 1).alias("block"), F.col("name").alias("up"))
        state = written(state.withColumn("block", 2 * F.col("block")).unionByName(lower), "trie-names")
    return state.select("conv_id", F.col("block").alias("level"), "up")


def prefix_trie(sequences: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the trie: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    ``sequences`` has conv_id, depth (from 0, gapless), digest and words of every
    turn, ``convs`` each conversation once with its length."""
    ship(sequences.sparkSession)
    turns = written(sequences.select("conv_id", F.col("depth").cast("long").alias("level"), "digest", "words"), "trie-turns")
    convs = written(convs.select("conv_id", F.col("length").cast("long").alias("length")), "trie-convs")
    all_convs = convs.agg(F.min("conv_id").alias("root"), F.count(F.lit(1)).alias("n"), F.max("length").alias("height")).first()
    root, height = all_convs.root or 0, all_convs.height or 0
    levels = max(0, height - 1).bit_length()

    above = _named(turns, convs, levels, root)
    rows = above.join(turns, ["conv_id", "level"])
    grouped = written(rows.groupBy("level", "up", "digest").agg(
        F.min("conv_id").alias("name"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words")), "trie-nodes")
    last = rows.join(convs.where("length > 0"), "conv_id").where("level = length - 1")
    ends = last.join(grouped.select("level", "up", "digest", "name"), ["level", "up", "digest"]).select(
        "conv_id", F.col("length").alias("depth"), "name")
    # the name of every prefix of every conversation but the textless one
    prefix = written(above.where("level > 0").select("conv_id", F.col("level").alias("depth"), F.col("up").alias("name")).unionByName(ends), "trie-prefixes")

    nodes = grouped.select((F.col("level") + 1).alias("depth"), "name", "up", "n_convs", "words")
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("up").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, ["depth", "name"], "left").select(
        "depth", "name", "up", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    nodes = written(nodes, "trie-nodes")
    for j in range(levels):
        nodes = written(_grafted(nodes, prefix, j), "trie-nodes")

    total = nodes.where("depth = 1").agg(F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    top = total.select(F.lit(0).cast("long").alias("depth"), F.lit(root).cast("long").alias("name"), F.lit(None).cast("long").alias("up"),
                       F.lit(all_convs.n).cast("long").alias("n_convs"), "n_children",
                       F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"), F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"))
    turnless = convs.where("length = 0").select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(root).cast("long").alias("name"))
    ended = prefix.join(convs, "conv_id").where("depth = length").select("conv_id", "depth", "name").unionByName(turnless)
    stream = ended.select("depth", "name", "conv_id").repartition("depth", "name").sortWithinPartitions("depth", "name", "conv_id")
    hashed = stream.mapInArrow(_ends_digest, "depth long, name long, ends_sha256 string")
    whole = nodes.unionByName(top.where(F.col("n_convs") > 0)).join(hashed, ["depth", "name"], "left")
    return whole.select(F.col("name").alias("conv_id"), "depth", F.col("up").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                        "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def _grafted(nodes: DataFrame, prefix: DataFrame, j: int) -> DataFrame:
    """``nodes`` with the totals of the lower forests of height 2 ** j added to the
    cut nodes above them and to those nodes' ancestors in the upper tries."""
    top = F.col("depth") - 1  # level of a node, from 0
    tops = nodes.where((top % (1 << j) == 0) & (F.shiftright(top, j) % 2 == 1))
    forests = tops.groupBy(top.alias("cut"), F.col("up").alias("conv_id")).agg(
        F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    reached = forests.withColumn("depth", F.explode(F.sequence(F.col("cut") - (1 << j) + 1, F.col("cut"))))
    grafts = reached.join(prefix, ["conv_id", "depth"]).groupBy("depth", "name").agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    more = reduce(lambda df, c: df.withColumn(c[0], F.col(c[0]) + F.coalesce(c[1], F.lit(0))),
                  [("n_leaves", "leaves"), ("saved_tokens", "saved")], nodes.join(grafts, ["depth", "name"], "left"))
    return more.select(*nodes.columns)
