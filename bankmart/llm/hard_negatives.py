"""Hard-negative mining with segment summary filtering.

A vector is cut into segments, and those into halves.  Of the finest segments
the mean and the deviation are stored with the vector; those of the coarser
levels follow from them.  For two segments of n components

    n * (mean * mean' - dev * dev') <= inner product <= n * (mean * mean' + dev * dev'),

so sums over the segments bound a score.  An anchor's score with each row is
bounded level by level, from the whole vector to the finest segments; rows
whose bounds rule them out go, and only what is left is scored exactly.

Positives: a row goes if its upper bound is under the fifth best lower bound
of the anchor's label so far.  Negatives: a row goes if it can't lie in the
band of any positive, or lies under five others in each band that it can.

Rows are dealt by hash into blocks of about ``ROWS`` rows, anchors into blocks
of about ``ANCHORS``; a task has a block of each, whatever labels and copies
there are, and sends at most five rows for each anchor (and positive) on.
The anchors are a stated part of the rows, so all blocks meet; the work grows
with anchors times rows, and so do the blocks' rows that are shuffled.

Components are floor(scale * x), whole numbers held as doubles while products
stay under 2 ** 53, as Python's whole numbers beyond.  A score outside of a
long fails the query.

Defined results: rows without an id, label or vector, or with null or
non-finite components, take no part; vectors of different lengths have no
score with each other (empty ones have 0); repeated rows (equal in id, label
and vector) count once; rows that share an id but not the rest are rows of
their own, and none of them is another's partner; ties go to the smaller id,
then the smaller label; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankmart.llm.common import ship, written

ROWS, ANCHORS = 16_384, 8_192
#: Components of a block at most, and of the finest segments.
CELLS, FINEST = 1 << 22, 2
#: Scores that are bounded at once, and of those multiplied out at once.
PAIRS, SLICE = 1 << 19, 1 << 13
EXACT = float(1 << 53)


def segments(dim: int) -> list[np.ndarray]:
    """Where the segments of each level start, the whole vector first."""
    levels = [np.zeros(1, np.int64)]
    while dim and np.diff(np.append(levels[-1], dim)).max() > FINEST:
        edges = np.append(levels[-1], dim)
        levels.append(np.unique(np.concatenate([edges[:-1], (edges[:-1] + edges[1:]) // 2])))
    return levels


def summary(x: np.ndarray) -> np.ndarray:
    """Means and deviations of the finest segments of each row of ``x``, side by side."""
    starts = segments(x.shape[1])[-1]
    if not x.shape[1]:
        return np.zeros((len(x), 2))
    n = np.diff(np.append(starts, x.shape[1]))
    mean = np.add.reduceat(x, starts, axis=1) / n
    dev = np.sqrt(np.add.reduceat((x - np.repeat(mean, n, axis=1)) ** 2, starts, axis=1) / n)
    return np.concatenate([mean, dev], 1)


def coarser(stored: np.ndarray, dim: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Means and deviations of every level, each times the root of its segment's
    length, so that sums of products bound scores; the whole vector first."""
    levels = segments(dim)
    half = stored.shape[1] // 2
    mean, square = stored[:, :half], stored[:, half:] ** 2 + stored[:, :half] ** 2
    finest = np.diff(np.append(levels[-1], dim)) if dim else np.ones(1)
    out = []
    for starts in levels:
        at = np.searchsorted(levels[-1], starts)
        n = np.add.reduceat(finest, at)
        m = np.add.reduceat(mean * finest, at, axis=1) / n
        dev = np.sqrt(np.maximum(np.add.reduceat(square * finest, at, axis=1) / n - m ** 2, 0))
        out.append((m * np.sqrt(n), dev * np.sqrt(n)))
    return out


class Side:
    """Vectors of a block with what is stored of them."""

    def __init__(self, got: pa.Table, dim: int):
        self.ids = got["vec_id"].to_numpy()
        self.labels = got["label"].to_numpy()
        self.x = _matrix(got["v"], dim)
        self.levels = coarser(_matrix(got["summary"], max(2, 2 * len(segments(dim)[-1]))), dim)
        self.norm = np.sqrt((self.x ** 2).sum(1))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.asarray(pa.concat_arrays(column.chunks).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), width)


def _dots(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of rows ``i`` of ``a`` with rows ``j`` of ``b``."""
    out = np.empty(len(i))
    for lo in range(0, len(i), SLICE):
        at = slice(lo, lo + SLICE)
        out[at] = np.einsum("pd,pd->p", a[i[at]], b[j[at]])
    return out


def _exact(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The same as whole numbers, exactly."""
    largest = max(np.abs(a).max(initial=0), 1) * max(np.abs(b).max(initial=0), 1) * max(a.shape[1], 1)
    if largest < EXACT:
        return _dots(a, i, b, j).astype(np.int64)
    whole = [sum(int(u) * int(v) for u, v in zip(a[p].tolist(), b[q].tolist(), strict=True)) for p, q in zip(i, j, strict=True)]
    return np.array(whole, np.int64)  # fails beyond a long


class Bounds:
    """Bounds on the scores of some anchors with all rows, refined level by level
    where ``alive``; a bound is widened by what rounding may have taken."""

    def __init__(self, anchors: Side, pick: np.ndarray, rows: Side):
        self.anchors, self.pick, self.rows = anchors, pick, rows
        self.slack = 1e-9 * anchors.norm[pick, None] * rows.norm[None] + 1e-6

    def level(self, k: int, alive: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        (ma, da), (mr, dr) = self.anchors.levels[k], self.rows.levels[k]
        ma, da = ma[self.pick], da[self.pick]
        i, j = np.nonzero(alive)
        if 4 * len(i) > alive.size:
            mean, dev = ma @ mr.T, da @ dr.T + self.slack
            np.maximum(low, mean - dev, out=low)
            np.minimum(high, mean + dev, out=high)
        else:
            mean, dev = _dots(ma, i, mr, j), _dots(da, i, dr, j) + self.slack[i, j]
            low[i, j] = np.maximum(low[i, j], mean - dev)
            high[i, j] = np.minimum(high[i, j], mean + dev)


def _nth(values: np.ndarray, keep: np.ndarray, n: int) -> np.ndarray:
    """The n-th largest of each row's kept values, -inf where fewer."""
    if values.shape[1] < n:
        return np.full(len(values), -np.inf)
    return np.partition(np.where(keep, values, -np.inf), values.shape[1] - n, axis=1)[:, values.shape[1] - n]


def _refined(bounds: Bounds, mask: np.ndarray, drop) -> np.ndarray:
    """``mask`` without the pairs that ``drop(mask, low, high)`` rules out at some level."""
    low, high = np.full(mask.shape, -np.inf), np.full(mask.shape, np.inf)
    alive = mask.copy()
    for k in range(len(bounds.rows.levels)):
        if not alive.any():
            break
        bounds.level(k, alive, low, high)
        alive &= ~drop(alive, low, high)
    return alive


def _best(anchor: np.ndarray, score: np.ndarray, row_id: np.ndarray, row_label: np.ndarray, n: int) -> np.ndarray:
    """Places of the first ``n`` of each anchor: larger scores, smaller ids, smaller labels first."""
    order = np.lexsort((row_label, row_id, -score, anchor))
    first = np.searchsorted(anchor[order], anchor[order])
    return order[np.arange(len(order)) - first < n]


_FOUND = pa.schema([("anchor", pa.int64()), ("anchor_label", pa.int64()), ("anchor_hash", pa.int64()), ("band", pa.int64()),
                    ("vec_id", pa.int64()), ("label", pa.int64()), ("score", pa.int64())])
FOUND = "anchor long, anchor_label long, anchor_hash long, band long, vec_id long, label long, score long"


def _found(anchors: Side, hashes: np.ndarray, rows: Side, parts: list[tuple]) -> pa.Table:
    """Parts are (places of anchors, bands, places of rows, scores)."""
    if not parts:
        return _FOUND.empty_table()
    a, band, r, score = (np.concatenate(x) for x in zip(*parts, strict=True))
    return pa.table([anchors.ids[a], anchors.labels[a], hashes[a], band, rows.ids[r], rows.labels[r], score], schema=_FOUND)


def _chunks(anchors: Side, rows: Side):
    step = max(1, PAIRS // max(1, len(rows.ids)))
    for lo in range(0, len(anchors.ids), step):
        yield np.arange(lo, min(lo + step, len(anchors.ids)))


def _positives(n: int):
    def run(key: tuple, row_table: pa.Table, anchor_table: pa.Table) -> pa.Table:
        if not row_table.num_rows or not anchor_table.num_rows:
            return _FOUND.empty_table()
        dim, anchor_table = key[0].as_py(), anchor_table.rename_columns([c.removeprefix("anchor_") for c in anchor_table.schema.names])
        rows, anchors = Side(row_table, dim), Side(anchor_table, dim)
        parts = []
        for pick in _chunks(anchors, rows):
            mask = (anchors.labels[pick, None] == rows.labels[None]) & (anchors.ids[pick, None] != rows.ids[None])
            alive = _refined(Bounds(anchors, pick, rows), mask,
                             lambda alive, low, high: high < _nth(low, alive, n)[:, None])
            i, r = np.nonzero(alive)
            score = _exact(anchors.x, pick[i], rows.x, r)
            best = _best(i, score, rows.ids[r], rows.labels[r], n)
            parts.append((pick[i[best]], np.zeros(len(best), np.int64), r[best], score[best]))
        return _found(anchors, anchor_table["hash"].to_numpy(), rows, parts)

    return run


def _negatives(n: int, share: tuple[int, int]):
    least, whole = share

    def run(key: tuple, row_table: pa.Table, anchor_table: pa.Table) -> pa.Table:
        if not row_table.num_rows or not anchor_table.num_rows:
            return _FOUND.empty_table()
        dim, anchor_table = key[0].as_py(), anchor_table.rename_columns([c.removeprefix("anchor_") for c in anchor_table.schema.names])
        rows, anchors = Side(row_table, dim), Side(anchor_table, dim)
        lists = pa.concat_arrays(anchor_table["tops"].chunks)
        sizes = np.diff(lists.offsets.to_numpy())
        tops = np.full((len(sizes), max(1, sizes.max(initial=0))), -1, np.int64)  # scores of positives; under 0 there is no band
        tops[np.arange(tops.shape[1])[None] < sizes[:, None]] = lists.flatten().to_numpy()
        floors = -((-least * tops.astype(object)) // whole)  # least * top <= whole * score
        floors = np.where(tops < 0, 1, floors).astype(np.int64)
        parts = []
        for pick in _chunks(anchors, rows):
            top, floor = tops[pick].astype(np.float64), floors[pick].astype(np.float64)

            def drop(alive, low, high, top=top, floor=floor):
                needed = np.zeros(alive.shape, bool)
                for b in range(top.shape[1]):
                    t, f = top[:, b, None], floor[:, b, None]
                    surely = alive & (low >= f) & (high <= t)
                    needed |= (t >= 0) & (high >= f) & (low <= t) & (high >= _nth(low, surely, n)[:, None])
                return alive & ~needed

            mask = (anchors.labels[pick, None] != rows.labels[None]) & (anchors.ids[pick, None] != rows.ids[None]) & (top >= 0).any(1)[:, None]
            i, r = np.nonzero(_refined(Bounds(anchors, pick, rows), mask, drop))
            score = _exact(anchors.x, pick[i], rows.x, r)
            for b in range(tops.shape[1]):
                t, f = tops[pick[i], b], floors[pick[i], b]
                hit = np.flatnonzero((t >= 0) & (score >= f) & (score <= t))
                best = hit[_best(i[hit], score[hit], rows.ids[r[hit]], rows.labels[r[hit]], n)]
                parts.append((pick[i[best]], np.full(len(best), b, np.int64), r[best], score[best]))
        return _found(anchors, anchor_table["hash"].to_numpy(), rows, parts)

    return run


def _summed(batches):
    for got in batches:
        lists, names = got.column(got.schema.get_field_index("v")), got.schema.names
        rows = [None] * got.num_rows
        dims = got.column(got.schema.get_field_index("dim")).to_numpy()
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            x = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim)
            for i, s in zip(at, summary(x), strict=True):
                rows[i] = s
        yield pa.RecordBatch.from_arrays([*got.columns, pa.array(rows, pa.list_(pa.float64()))], names=[*names, "summary"])


def mine(vectors: DataFrame, anchors, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         positives: int = 5, negatives: int = 5, scale: int = 256, share: tuple[int, int] = (80, 100)) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows of which ``anchors(id column)`` holds; their positives the
    first rows of their label.  Negatives are the first rows of other labels with
    share[0] * positive score <= share[1] * score <= share[1] * positive score."""
    spark = vectors.sparkSession
    ship(spark)
    slim = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("v")).where("vec_id is not null and label is not null and v is not null")
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    # floor as a double; adding 0 makes -0.0 and 0.0 equal
    slim = slim.where(~bad).select("vec_id", "label", F.transform("v", lambda c: F.rint(F.lit(float(scale)) * c - F.pmod(F.lit(float(scale)) * c, F.lit(1.0))) + F.lit(0.0)).alias("v"))
    slim = slim.distinct().withColumns({"dim": F.size("v"), "hash": F.xxhash64("v")})
    stored = written(slim.mapInArrow(_summed, "vec_id long, label long, v array<double>, dim int, hash long, summary array<double>"), "negatives-vectors")

    sizes = stored.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.count_if(anchors(F.col("vec_id"))).alias("a")).collect()  # a row for each vector length
    sizes = [s for s in sizes if s.a]
    if not sizes:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    blocks = {s.dim: (-(-s.n // max(1, min(ROWS, CELLS // max(1, s.dim)))), -(-s.a // max(1, min(ANCHORS, CELLS // max(1, s.dim))))) for s in sizes}
    of_rows = F.create_map(*[F.lit(x) for d, (n, _) in blocks.items() for x in (d, n)])[F.col("dim")]
    of_anchors = F.create_map(*[F.lit(x) for d, (_, n) in blocks.items() for x in (d, n)])[F.col("dim")]
    stored = stored.where(F.col("dim").isin(list(blocks)))

    def dealt(seed: int, n: F.Column) -> F.Column:
        return F.pmod(F.xxhash64("vec_id", "label", "hash", F.lit(seed)), n).cast("int")

    def every(n: F.Column) -> F.Column:
        return F.explode(F.sequence(F.lit(0), (n - 1).cast("int")))

    rows = stored.withColumn("row_block", dealt(1, of_rows)).withColumn("anchor_block", every(of_anchors))
    asked = stored.where(anchors(F.col("vec_id")))
    keys = ["dim", "row_block", "anchor_block"]

    def met(asked: DataFrame, task) -> DataFrame:
        spread = asked.withColumn("anchor_block", dealt(2, of_anchors)).withColumn("row_block", every(of_rows))
        # both sides read one table; other names keep their columns apart
        spread = spread.select(*[F.col(c).alias(f"anchor_{c}") for c in spread.columns])
        return rows.groupBy(*keys).cogroup(spread.groupBy(*[f"anchor_{k}" for k in keys])).applyInArrow(task, FOUND)

    anchor = ["anchor", "anchor_label", "anchor_hash"]
    order = [F.desc("score"), F.asc("vec_id"), F.asc("label")]
    first = Window.partitionBy(*anchor).orderBy(*order)
    tops = met(asked, _positives(positives)).withColumn("r", F.row_number().over(first)).where(F.col("r") <= positives)
    tops = written(tops.select(*anchor, "r", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")
    ranked = tops.groupBy(*anchor).agg(F.transform(F.sort_array(F.collect_list(F.struct("r", "positive_score"))), lambda s: s["positive_score"]).alias("tops"))
    with_tops = asked.join(ranked.toDF("vec_id", "label", "hash", "tops"), ["vec_id", "label", "hash"])
    band = Window.partitionBy(*anchor, "band").orderBy(*order)
    found = met(with_tops, _negatives(negatives, share)).withColumn("rank", F.row_number().over(band)).where(F.col("rank") <= negatives)
    found = found.select(*anchor, (F.col("band") + 1).cast("int").alias("r"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return found.join(tops, [*anchor, "r"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
