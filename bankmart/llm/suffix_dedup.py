"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Of all suffixes only the first ``threshold`` bytes are told apart, by most
significant digit passes over groups; what is still equal at that depth is a
repeated window, and all of a group but its first are removed.

A window's most significant digit is the content of its anchor: the place in
the window whose ``K`` bytes have the smallest hash (leftmost of equals).
Equal windows have equal anchors at equal offsets, and neighbouring windows
mostly share one, so a run of windows with one anchor is sorted as one record:

1. digit: the anchor's bytes.  A run alone in its group has no repeated window.
   Of runs of a group whose whole spans are equal, all but the first are
   repeated.  If different spans are left, their first ones go on, cut into
   cells of ``CELL`` offsets.
2. digit: the bytes that all windows of a cell have in common, all but
   ``CELL - 1``.  The same again; what goes on is cut into single windows.
3. digit: the whole window.

So few windows are ever sorted one by one: those near the ends of repeated
passages.  Before the first pass, equal runs within a block of documents are
reduced to their first; so a passage in a third of all documents sends one
record per block to its group, and a pass reads groups as a sorted stream with
constant memory.

Documents travel in blocks of about ``BLOCK`` bytes, compressed, and are
shuffled by block twice: to fetch the runs that go on, and to cut.

Groups are told apart by 64-bit hashes of digits, and runs by a further 64
bits over their span: two different strings count as equal with odds of about
their pairs / 2 ** 128.

Defined results: null text is empty; null ids come after all others; rows with
equal ids are documents of their own, in the order in which they are read;
repeated rows are cut like any other copies, all but one; very long texts are
worked on in slices and each is a block by itself; an empty table gives no
rows; other columns are ignored.  Bytes may be cut within a character, so
what is kept is binary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmart.llm.common import ship, written

THRESHOLD = 100
CELL = 8
BLOCK = 4 << 20
#: Documents of a block, and windows worked on at once.
ROWS, SLICE = 1 << 20, 1 << 18
#: Records of a batch that a task hands back, or cells cut at once.
PART = 1 << 15

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x ^= x >> np.uint64(27)
    x *= _C
    x ^= x >> np.uint64(31)
    return x


def _words(raw: bytes) -> np.ndarray:
    """The eight bytes from each place on as a number; zeros follow the end."""
    padded = raw + bytes(72)
    return np.ndarray((len(raw) + 64,), "<u8", padded, strides=(1,))


def _hash_ranges(words: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of byte ranges of at least eight bytes."""
    out = _mix(length.astype(np.uint64) * _A + np.uint64(seed))
    last = start + length - 8
    for j in range(0, int(length.max(initial=0)), 8):
        at = np.flatnonzero(length > j)
        out[at] = _mix(out[at] * _A ^ words[np.minimum(start[at] + j, last[at])])
    return out


def anchor_width(threshold: int) -> int:
    return 8 * max(1, threshold // 24)


def runs(raw: bytes, starts: np.ndarray, lengths: np.ndarray, threshold: int) -> dict[str, np.ndarray]:
    """The runs of windows with one anchor: document, anchor ``p`` and first and
    last window (places in ``raw``), ``key`` of the anchor, hash of the ``span``."""
    k = anchor_width(threshold)
    reach = threshold - k + 1  # places that may be a window's anchor
    words = _words(raw)
    holds = lengths >= threshold
    opens, closes = starts[holds], (starts + lengths - threshold + 1)[holds]  # windows within one document
    found = []
    for lo in range(0, len(raw) - threshold + 1, SLICE):
        hi = min(lo + SLICE, len(raw) - threshold + 1)
        mixed = _mix(words[lo:hi + threshold] * _A)
        n = hi - lo + reach - 1
        h = mixed[:n].copy()
        for j in range(8, k, 8):
            h *= _B
            h += mixed[j:j + n]
        h = _mix(h)
        least = (h & ~np.uint64(0xFFFFFF)) | np.arange(n, dtype=np.uint64)
        width = 1
        while 2 * width <= reach:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < reach:
            least = np.minimum(least[:len(least) - (reach - width)], least[reach - width:])
        some = slice(np.searchsorted(closes, lo, "right"), np.searchsorted(opens, hi))
        edge = np.bincount(np.maximum(opens[some], lo) - lo, minlength=hi - lo + 1) - np.bincount(np.minimum(closes[some], hi) - lo, minlength=hi - lo + 1)
        at = np.flatnonzero(np.cumsum(edge[:-1]))
        if not len(at):
            continue
        anchor = (least[at] & np.uint64(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.diff(anchor, prepend=-1))
        last = np.append(first[1:], len(at)) - 1
        found.append((anchor[first] + lo, at[first] + lo, at[last] + lo, h[anchor[first]]))
    p, s0, s1, key = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (*[np.zeros(0, np.int64)] * 3, np.zeros(0, np.uint64))
    doc = np.searchsorted(starts, p, "right") - 1  # of documents that start at one place only the last holds bytes
    return {"doc": doc, "p": p, "s0": s0, "s1": s1, "key": key, "span": _hash_ranges(words, s0, s1 - s0 + threshold, 1)}


def first_in_block(run: dict[str, np.ndarray], rank: np.ndarray) -> np.ndarray:
    """Which runs are the first of their kind in the block; ``rank`` orders documents."""
    ab = _ab(run)
    kind = run["key"] * _A + run["span"] * _B + ab.astype(np.uint64)
    order = np.lexsort((run["p"], rank[run["doc"]], kind))
    same = np.ones(max(0, len(order) - 1), bool)
    for column in (run["key"], run["span"], ab):
        same &= np.diff(column[order]) == 0
    first = np.ones(len(order), bool)
    first[order[1:][same]] = False
    return first


def _ab(run: dict[str, np.ndarray]) -> np.ndarray:
    """Smallest and largest offset of the anchor in the run's windows, as one number."""
    return ((run["p"] - run["s1"]) << 20) + run["p"] - run["s0"]


_BLOCKS = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("data", pa.binary())])


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = TaskContext.get().partitionId() << 20
    for got in batches:
        text = pc.fill_null(got.column(1), "").cast(pa.large_string())
        if not len(text):
            continue
        ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
        data, lo = text.buffers()[2], 0
        while lo < len(text):
            hi = min(max(lo + 1, int(np.searchsorted(ends, ends[lo] + BLOCK, "right")) - 1), lo + ROWS, len(text))
            size = int(ends[hi] - ends[lo])
            raw = data.slice(int(ends[lo]), size) if size else b""
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([got.column(0)[lo:hi].to_pylist()], pa.list_(pa.int64())),
                 pa.array([np.diff(ends[lo:hi + 1])], pa.list_(pa.int64())),
                 pa.array([pa.compress(raw, codec="zstd", asbytes=True)], pa.binary())], schema=_BLOCKS)
            block, lo = block + 1, hi


class _Block:
    """A block's bytes, and where its documents stand."""

    def __init__(self, got: pa.RecordBatch, row: int):
        column = dict(zip(got.schema.names, got.columns, strict=True))
        self.id = column["block"][row].as_py()
        self.ids = column["ids"][row].values
        self.lengths = column["lengths"][row].values.to_numpy().astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.raw = pa.decompress(column["data"][row].as_buffer(), decompressed_size=int(self.lengths.sum()), codec="zstd", asbytes=True)

    def rank(self) -> np.ndarray:
        """Order of the documents: by id, null last, then as read."""
        order = pc.array_sort_indices(self.ids).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return rank


RECORD = "key long, ab long, span long, doc_id long, row long, p long"


def _records(columns: list, piece: list | None = None) -> pa.RecordBatch:
    names = ["key", "ab", "span", "doc_id", "row", "p"]
    arrays = [c if isinstance(c, pa.Array) else pa.array(c.view(np.int64) if c.dtype == np.uint64 else c, pa.int64()) for c in columns]
    if piece is not None:
        return pa.RecordBatch.from_arrays([*arrays, pa.array(piece, pa.binary())], names=[*names, "piece"])
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for lo in range(0, batch.num_rows, PART):
        yield batch.slice(lo, PART)


def _first_runs(threshold: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            for i in range(got.num_rows):
                block = _Block(got, i)
                run = runs(block.raw, block.starts, block.lengths, threshold)
                first = first_in_block(run, block.rank())
                run = {c: x[first] for c, x in run.items()}
                yield from _parts(_records([run["key"], _ab(run), run["span"], block.ids.take(pa.array(run["doc"])), (block.id << 20) + run["doc"],
                                            run["p"] - block.starts[run["doc"]]]))

    return emit


KIND = "kind long, doc_id long, row long, p long, ab long"


def _sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digit pass over records sorted by key, offsets, span and order: kind 1 are
    records after the first of equal ones, kind 2 first ones that share their group."""
    before = None  # the last record's key, offsets and span
    waiting = None  # a group's first record while nothing else of the group was seen

    def table(got: pa.RecordBatch, kind: np.ndarray) -> pa.RecordBatch:
        rest = ["doc_id", "row", "p", "ab", *(["piece"] if "piece" in got.schema.names else [])]
        return pa.RecordBatch.from_arrays([pa.array(kind, pa.int64()), *[got.column(c) for c in rest]], names=["kind", *rest])

    for got in batches:
        if not got.num_rows:
            continue
        key, ab, span = (got.column(c).to_numpy() for c in ("key", "ab", "span"))
        head = before or (None, None, None)
        new_key = np.append(head[0] is None or key[0] != head[0], key[1:] != key[:-1])
        new = new_key.copy()
        for column, was in ((ab, head[1]), (span, head[2])):
            new |= np.append(was is not None and column[0] != was, column[1:] != column[:-1])
        before = (key[-1], ab[-1], span[-1])
        firsts = np.flatnonzero(new)
        kind = np.where(new, 0, 1)
        if len(firsts):
            if waiting is not None and not new_key[firsts[0]]:
                yield table(waiting, np.full(1, 2))
            waiting = None
            followed = np.append(~new_key[firsts[1:]], False)
            kind[firsts[~new_key[firsts] | followed]] = 2
            if new_key[firsts[-1]]:
                waiting = got.slice(firsts[-1], 1)
        keep = np.flatnonzero(kind)
        if len(keep):
            yield table(got.take(pa.array(keep)), kind[keep])


def _cells(threshold: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            for i in range(got.num_rows):
                block = _Block(got, i)
                asked = got.column(got.schema.get_field_index("asked"))[i].values
                row, p, ab = (asked.field(c).to_numpy() for c in ("row", "p", "ab"))
                doc = row & (ROWS - 1)
                a, b = ab >> 20, ab & (ROWS - 1)
                many = b // CELL - a // CELL + 1
                upto = np.cumsum(many)
                words = _words(block.raw)
                for lo in range(0, int(many.sum()), PART):
                    nth = np.arange(lo, min(lo + PART, upto[-1]))
                    of = np.searchsorted(upto, nth, "right")
                    cell = a[of] // CELL + nth - (upto - many)[of]
                    low, high = np.maximum(a[of], cell * CELL), np.minimum(b[of], cell * CELL + CELL - 1)
                    place = p[of] + block.starts[doc[of]]
                    core = _hash_ranges(words, place - cell * CELL, np.full(len(of), threshold - CELL + 1), 2)
                    start, end = place - high, place - low + threshold
                    key = _mix(core + cell.astype(np.uint64) * _A)
                    yield _records([key, (low << 20) + high, _hash_ranges(words, start, end - start, 3), block.ids.take(pa.array(doc[of])),
                                    row[of], p[of]], [block.raw[x:y] for x, y in zip(start.tolist(), end.tolist(), strict=True)])

    return emit


def _windows(threshold: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            if not got.num_rows:
                continue
            column = dict(zip(got.schema.names, got.columns, strict=True))
            pieces = column["piece"].to_pylist()
            row, p, ab = (column[c].to_numpy() for c in ("row", "p", "ab"))
            low, high = ab >> 20, ab & (ROWS - 1)
            many = high - low + 1
            of = np.repeat(np.arange(len(row)), many)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
            sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
            words = _words(b"".join(pieces))
            start, length = (np.cumsum(sizes) - sizes)[of] + nth, np.full(len(of), threshold)
            yield from _parts(_records([_hash_ranges(words, start, length, 4), np.zeros(len(of), np.int64), _hash_ranges(words, start, length, 5),
                                        column["doc_id"].take(pa.array(of)), row[of], p[of] - high[of] + nth]))

    return emit


def _pass(records: DataFrame, schema: str, what: str) -> DataFrame:
    order = ["key", "ab", "span", F.asc_nulls_last("doc_id"), "row", "p"]
    return written(records.repartition("key").sortWithinPartitions(*order).mapInArrow(_sorted_groups, schema), what)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _cut(threshold: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            for i in range(got.num_rows):
                block = _Block(got, i)
                run = runs(block.raw, block.starts, block.lengths, threshold)
                again = ~first_in_block(run, block.rank())
                starts, ends = [run["s0"][again]], [run["s1"][again] + threshold]
                given = got.column(got.schema.get_field_index("removed"))[i]
                if given.is_valid:
                    base = block.starts[given.values.field("row").to_numpy() & (ROWS - 1)]
                    starts.append(base + given.values.field("start").to_numpy())
                    ends.append(base + given.values.field("end").to_numpy())
                yield _cut_block(block, np.concatenate(starts), np.concatenate(ends))

    return emit


def _cut_block(block: _Block, starts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    # maximal runs; documents part them
    of = np.searchsorted(block.starts, starts, "right") - 1
    first = np.flatnonzero(np.append(True, (starts[1:] > reach[:-1]) | (of[1:] != of[:-1]))[:len(starts)])
    begin, stop, of = starts[first], reach[np.append(first[1:], len(starts))[:len(first)] - 1], of[first]
    counts = np.bincount(of, minlength=len(block.lengths))
    spans = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.StructArray.from_arrays(
        [pa.array(begin - block.starts[of]), pa.array(stop - block.starts[of])], names=["start", "end"]), type=_SPANS)
    raw, gone = memoryview(block.raw), np.zeros(len(block.lengths), np.int64)
    np.add.at(gone, of, stop - begin)
    kept = b"".join(raw[x:y] for x, y in zip([0, *stop.tolist()], [*begin.tolist(), len(raw)], strict=True))
    at = np.append(0, np.cumsum(block.lengths - gone)).astype(np.int64)
    texts = pa.Array.from_buffers(pa.large_binary(), len(block.lengths), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(kept)])
    return pa.RecordBatch.from_arrays([block.ids, pa.array(block.lengths), spans, texts.cast(pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_bytes, spans (removed runs of bytes: start, end) and kept (the other
    bytes) of every document, without the strings of ``threshold`` bytes that
    start earlier too."""
    if not 16 <= threshold < 1 << 16:
        raise ValueError("threshold is from 16 to 65535 bytes")
    ship(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blocks = written(slim.mapInArrow(_to_blocks, "block long, ids array<long>, lengths array<long>, data binary"), "repeat-blocks")
    block = F.shiftright("row", 20).alias("block")

    run_kinds = _pass(blocks.mapInArrow(_first_runs(threshold), RECORD), KIND, "repeat-runs")
    asked = run_kinds.where("kind = 2").groupBy(block).agg(F.collect_list(F.struct("row", "p", "ab")).alias("asked"))
    cells = blocks.join(asked, "block").mapInArrow(_cells(threshold), RECORD + ", piece binary")
    cell_kinds = _pass(cells, KIND + ", piece binary", "repeat-cells")
    windows = cell_kinds.where("kind = 2").select("doc_id", "row", "p", "ab", "piece").mapInArrow(_windows(threshold), RECORD)
    window_kinds = _pass(windows, KIND, "repeat-windows")

    removed = None
    for kinds in (run_kinds, cell_kinds, window_kinds):
        low, high = F.shiftright("ab", 20), F.col("ab") % ROWS
        one = kinds.where("kind = 1").select("row", (F.col("p") - high).alias("start"), (F.col("p") - low + threshold).alias("end"))
        removed = one if removed is None else removed.unionByName(one)
    removed = removed.groupBy(block).agg(F.collect_list(F.struct("row", "start", "end")).alias("removed"))
    return blocks.join(removed, "block", "left").mapInArrow(
        _cut(threshold), "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")
