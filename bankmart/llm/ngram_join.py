"""N-gram Jaccard join by vertical partitioning.

A document is its set of word n-grams as 64-bit hashes; the global n-gram
order is the order of the hashes.  Documents with equal sets are one node.

Candidates.  Cutting the order into F fragments cuts a set into segments.
Similarity of at least t bounds the differing n-grams of a pair by
D = (1 - t) / t * n, each spoils one segment, so a node with more than D
segments that aren't empty shares whole segments with every partner; of the
segments in one order for all (larger first, then by hash) the first D + 1
of both hold a common one.  These are a node's keys.  F follows the size
class of a node; a node that may have partners in the next class has keys
for that too.  A node with D segments or fewer (small sets) has its first
D + 1 n-grams as further keys, the usual prefix filter, as both partners
must be such nodes to be missed otherwise.

Links.  The nodes of all keys with the same least node are its star.  All
members are tested against it and some more members (in number about the
logarithm of the star's size, chosen by hash), and then every pair of the
star that is in different components still.  Sizes and bitmaps of the sets
rule out most pairs within the join, exactly.  So no link between
components is missed, and a group of copies needs no pair of each two.
A test joins the pair's segments by vertical fragment, counts the partial
overlaps separately and sums them per pair.

The hash has 64 bits: two n-grams of a pair of documents fall together with
odds of about the product of their sizes / 2 ** 64.

Defined results: documents without words have an empty set and are linked
with nothing; with fewer words than n the whole sequence is one n-gram; null
ids count as larger than any other, and a component without ids has a null
id; repeated rows are in one component; very long texts are one set of n-grams, held
by the task that reads them; pivots and segments of equal hash or size are taken
by the smaller hash; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankmart.llm.common import ship, written
from bankmart.llm.components import components

WORDS = 5
PERCENT = 80
CLASS = 1.6  # ratio of the size classes
VERTICAL = 4  # fragments of the overlap counts
BITMAP = 16  # longs of a set's bitmap
REMEMBERED = 100_000

_LOWER = bytes(b + 32 if 65 <= b < 91 else b for b in range(256))
_M1, _M2, _GOLD = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)


def _times(n: int, odd: np.uint64) -> np.uint64:
    return np.uint64(n * int(odd) & 0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


class Shingler:
    def __init__(self, n: int, percent: int):
        self.n, self.percent = n, percent
        self.odd = [np.uint64(int(x) | 1) for x in np.random.default_rng(17).integers(1 << 62, 1 << 63, n)]
        self.full = 0.88 * percent / (100 - percent) if percent < 100 else 8.0  # n-grams in a segment, at most on average

    def grams(self, text: str | None) -> np.ndarray:
        """The sorted set of hashed n-grams of the words between ASCII white space, A-Z in lower case."""
        words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
        if not words:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        if len(h) < self.n:  # its own kind of n-gram, with its length
            total = (h * np.array(self.odd[:len(h)])).sum(dtype=np.uint64)
            return _mix(np.array([total]) + _times(len(h), _GOLD))
        out = h[:len(h) - self.n + 1] * self.odd[0]
        for i in range(1, self.n):
            out = out + h[i:len(h) - self.n + 1 + i] * self.odd[i]
        return np.unique(_mix(out))

    def differing(self, n: int) -> int:
        return (100 - self.percent) * n // self.percent

    def levels(self, n: int) -> list[int]:
        level = int(math.log(n) / math.log(CLASS) + 1e-9)
        while math.ceil(CLASS ** (level + 1)) <= n:
            level += 1
        while math.ceil(CLASS ** level) > n:
            level -= 1
        return [level, level + 1] if 100 * n >= self.percent * math.ceil(CLASS ** (level + 1)) else [level]

    def keys(self, grams: np.ndarray) -> np.ndarray:
        n = len(grams)
        d = self.differing(n)
        out = []
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_mix(grams ^ _GOLD))])
        for level in self.levels(n):
            fragments = np.uint64(max(1, round(CLASS ** (level + 1) / self.full)))
            at = ((grams >> np.uint64(32)) * fragments) >> np.uint64(32)
            first = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
            size = np.diff(np.append(first, n))
            key = _mix(sums[first + size] - sums[first] + at[first] * _M1 + _times(level + 1, _M2))
            out.append(key[np.lexsort((key, -size))[:d + 1]])
            if len(first) <= d:
                out.append(_mix(grams[:d + 1] ^ _times(level + 1, _GOLD)))
        return np.concatenate(out)

    def bitmap(self, grams: np.ndarray) -> np.ndarray:
        bits = np.zeros(64 * BITMAP, bool)
        bits[(grams >> np.uint64(11)) % np.uint64(64 * BITMAP)] = True
        return np.packbits(bits).view(np.int64)

    def signature(self, grams: np.ndarray) -> int:
        total = np.array([_mix(grams + _M2).sum(dtype=np.uint64)])
        return int(_mix(total + _times(len(grams), _GOLD)).view(np.int64)[0])


_BITS = [f"b{i}" for i in range(BITMAP)]
_SETS = "id long, n long, sig long, keys array<long>, " + ", ".join(f"{b} long" for b in _BITS)


def _describe(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(n, percent), set()
        for got in batches:
            sizes, sigs, keys, bits = [], [], [], np.zeros((got.num_rows, BITMAP), np.int64)
            for row, text in enumerate(got.column(1)):
                grams = shingler.grams(text.as_py())
                sig = shingler.signature(grams)
                sizes.append(len(grams))
                bits[row] = shingler.bitmap(grams)
                sigs.append(sig)
                # a task gives the keys of equal sets once
                keys.append(shingler.keys(grams).view(np.int64) if len(grams) and sig not in seen else None)
                seen.add(sig)
                if len(seen) > REMEMBERED:
                    seen.clear()
            yield pa.RecordBatch.from_arrays(
                [got.column(0), pa.array(sizes, pa.int64()), pa.array(sigs, pa.int64()), pa.array(keys, pa.list_(pa.int64())),
                 *[pa.array(np.ascontiguousarray(bits[:, i])) for i in range(BITMAP)]], names=["id", "n", "sig", "keys", *_BITS])

    return run


def _segments(n: int, percent: int, vertical: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(n, percent), set()
        for got in batches:
            rows: tuple[list, list, list] = ([], [], [])
            for text in got.column(0):
                grams = shingler.grams(text.as_py())
                sig = shingler.signature(grams)
                if not len(grams) or sig in seen:
                    continue
                seen.add(sig)
                if len(seen) > REMEMBERED:
                    seen.clear()
                at = ((grams >> np.uint64(32)) * np.uint64(vertical)) >> np.uint64(32)
                cuts = np.searchsorted(at, np.arange(vertical + 1, dtype=np.uint64))
                for f in range(vertical):
                    if cuts[f] < cuts[f + 1]:
                        for column, x in zip(rows, (sig, f, grams[cuts[f]:cuts[f + 1]].view(np.int64)), strict=True):
                            column.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.list_(pa.int64()))],
                names=["sig", "f", "grams"])

    return run


def _similar(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, na, b, nb) that link, by summed partial overlaps."""
    one = pairs.join(segments.select(F.col("sig").alias("a"), "f", F.col("grams").alias("ga")), "a")
    both = one.join(segments.select(F.col("sig").alias("b"), "f", F.col("grams").alias("gb")), ["b", "f"])
    counted = both.select("a", "b", "na", "nb", F.size(F.array_intersect("ga", "gb")).cast("long").alias("part"))
    total = counted.groupBy("a", "b").agg(F.sum("part").alias("common"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    return total.where(F.col("common") * 100 >= percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def _may_link(x: str, y: str, percent: int) -> F.Column:
    """Whether sizes and bitmaps of the sides ``x`` and ``y`` of a join allow a
    link: a bit that one side lacks is an n-gram of the other that it lacks."""
    nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
    fit = F.lit(True)
    for one, other, n in ((x, y, nx), (y, x, ny)):
        lacking = F.lit(0)
        for b in _BITS:
            lacking = lacking + F.bit_count(F.col(f"{one}.{b}").bitwiseAND(F.bitwise_not(F.col(f"{other}.{b}"))))
        fit = fit & ((100 + percent) * (n - lacking) >= percent * (nx + ny))
    return fit


def _candidates(left: DataFrame, right: DataFrame, percent: int, also: F.Column | None = None) -> DataFrame:
    """Distinct pairs a < b of members of a star (p) that may link."""
    x, y = F.col("x.sig"), F.col("y.sig")
    on = (F.col("x.p") == F.col("y.p")) & (x != y) & _may_link("x", "y", percent)
    both = left.alias("x").join(right.alias("y"), on if also is None else on & also)
    swap = x < y
    return both.select(
        F.least(x, y).alias("a"), F.when(swap, F.col("x.n")).otherwise(F.col("y.n")).alias("na"),
        F.greatest(x, y).alias("b"), F.when(swap, F.col("y.n")).otherwise(F.col("x.n")).alias("nb")).distinct()


def _relabelled(label: DataFrame, roots: DataFrame) -> DataFrame:
    """Nodes' components after links between components."""
    moved = roots.select(F.col("node").alias("c"), F.col("root").alias("c2"))
    return label.join(moved, "c", "left").withColumn("c", F.coalesce("c2", "c")).drop("c2")


def _contracted(links: DataFrame, label: DataFrame) -> DataFrame:
    """Links between components, from links between nodes."""
    out = links
    for side in ("a", "b"):
        out = out.join(label.select(F.col("sig").alias(side), F.col("c").alias(f"c{side}")), side, "left")
    ca, cb = F.coalesce("ca", "a"), F.coalesce("cb", "b")
    return out.select(F.least(ca, cb).alias("a"), F.greatest(ca, cb).alias("b")).where("a <> b").distinct()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                       percent: int = PERCENT, vertical: int = VERTICAL) -> DataFrame:
    """id, n_shingles and component_id (the smallest id reachable by links) of
    every document; two documents link when 100 * common >= percent * union."""
    spark = docs.sparkSession
    ship(spark)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sets = written(slim.mapInArrow(_describe(words, percent), _SETS), "sets")

    in_key = Window.partitionBy("key")
    rows = sets.select("sig", F.explode("keys").alias("key"))
    rows = rows.withColumns({"p": F.min("sig").over(in_key), "q": F.max("sig").over(in_key)}).where("p <> q")
    bits = sets.where("n > 0").groupBy("sig").agg(*[F.max(c).alias(c) for c in ["n", *_BITS]])
    stars = written(rows.select("p", "sig").distinct().join(bits, "sig"), "stars")  # the pivot is a member too

    def linked(pairs: DataFrame, what: str) -> DataFrame:
        pairs = written(pairs, f"{what}-pairs")
        nodes = written(pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct(), f"{what}-nodes")
        segments = written(slim.select("text").mapInArrow(_segments(words, percent, vertical), "sig long, f int, grams array<long>")
                           .join(nodes, "sig", "left_semi").dropDuplicates(["sig", "f"]), f"{what}-segments")
        return written(_similar(pairs, segments, percent), what)

    # every member of a star against its pivot and some more members by hash
    sizes = stars.groupBy("p").agg(F.count(F.lit(1)).alias("m"))
    share = F.ceil(F.log2(F.col("m"))) * 4 / F.col("m")
    chosen = F.pmod(F.xxhash64("sig", F.lit(5)), F.lit(1 << 30)) < share * (1 << 30)
    pivots = stars.join(sizes, "p").where((F.col("sig") == F.col("p")) | chosen).drop("m")
    roots = components(linked(_candidates(stars, pivots, percent), "links"))
    nodes = stars.select("sig").distinct()
    label = written(nodes.join(roots.withColumnRenamed("node", "sig"), "sig", "left")
                    .select("sig", F.coalesce("root", "sig").alias("c")), "label")

    # then every pair of a star that is in different components still
    members = stars.join(label, "sig")
    several = (members.groupBy("p", "c").agg(F.count(F.lit(1)).alias("k")).groupBy("p")
               .agg(F.count(F.lit(1)).alias("cs"), F.max(F.struct("k", "c")).alias("top")).where("cs > 1"))
    members = written(members.join(several, "p").withColumn("main", F.col("c") == F.col("top.c")).drop("cs", "top"), "unsettled")
    rest = written(_candidates(members.where("not main"), members, percent, F.col("x.c") != F.col("y.c")), "rest")
    if not rest.isEmpty():
        found = linked(rest, "late-links")
        label = written(_relabelled(label, components(_contracted(found, label))), "label")

    known = sets.where("n > 0").groupBy("sig").agg(F.min("id").alias("least")).join(label, "sig", "left").withColumn("c", F.coalesce("c", "sig"))
    smallest = known.groupBy("c").agg(F.min("least").alias("component_id"))
    known = known.join(smallest, "c").select("sig", "component_id")
    plain = sets.select("id", "n", "sig")
    grouped = plain.where("n > 0").join(known, "sig", "left").select("id", F.col("n").alias("n_shingles"), "component_id")
    return grouped.unionByName(plain.where("n = 0").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id")))
