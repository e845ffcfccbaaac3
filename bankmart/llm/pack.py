"""Packing of token sequences by Karmarkar-Karp multiway differencing.

Every document is tokenized and closed by an end id.  Full windows are cut
off the front; what remains (shorter than a window) is cut into pieces that
halve down to ``smallest`` ids, so that each batch of remainders holds many
small pieces.  Batches are partitioned into windows by multiway
differencing: every piece starts as a partial partition, and the two partial
partitions with the largest imbalance are merged largest sum against
smallest sum.  The windows come out nearly equal; when the fullest exceeds
the capacity, the window count rises and the batch is partitioned again.

The work is local to the scan's partitions: no shuffle, and memory is one
batch of remainders whatever the size of the table.

Defined results: null text counts as empty, and an empty document is its end
id alone; null or repeated document ids are packed like any other row; an
empty table gives no pieces; other columns of the input are ignored; very
long texts fill windows of their own and leave one remainder; pieces of equal
length are dealt in the order in which they come.  The special strings of a
vocabulary file become the ids that the ``tokenizers`` library gives them.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmart.llm.common import ship

WINDOW = 1024
#: A remainder is halved while its half is at least so long.
SMALLEST = 32
#: Pieces of a batch that is partitioned at once.
BATCH = 800
#: Bytes of ids in a record batch, about.
BYTES = 32 << 20

#: The pattern that splits text before merges (fixed by the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long")


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: visible Latin-1
    characters stand for themselves, the other bytes for U+0100 onwards."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Byte-level BPE ids of a ``tokenizers`` vocabulary file.

    Merges run through ``tiktoken`` with the file's ranks; a text with one of
    the vocabulary's special strings goes to the library itself.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        self.path = path
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        of = _byte_of_char()
        ranks = {bytes(of[c] for c in tok): i for tok, i in spec["model"]["vocab"].items() if tok not in self.special}
        self.bpe = tiktoken.Encoding("pack", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.library = None

    def encode(self, text: str) -> np.ndarray:
        if not any(s in text for s in self.special):
            return self.bpe.encode_to_numpy(text)
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def differencing(sizes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Multiway differencing of ``sizes`` into ``k`` parts: (part of each
    piece, sums of the parts)."""
    n = len(sizes)
    heap = []
    for i, size in enumerate(sizes.tolist()):
        sums = np.zeros(k, np.int64)
        sums[-1] = size
        heap.append((-size, i, sums))
    heapq.heapify(heap)
    merged: dict[int, tuple[int, int, np.ndarray]] = {}
    while len(heap) > 1:
        _, a, left = heapq.heappop(heap)
        _, b, right = heapq.heappop(heap)
        total = left + right[::-1]  # largest against smallest
        order = np.argsort(total, kind="stable")
        total = total[order]
        node = n + len(merged)
        merged[node] = (a, b, order)
        heapq.heappush(heap, (int(total[0] - total[-1]), node, total))
    _, root, sums = heap[0]
    part = np.zeros(n, np.int64)
    todo = [(root, np.arange(k))]  # a node, and where each of its slots went
    while todo:
        node, at = todo.pop()
        if node < n:
            part[node] = at[-1]
            continue
        a, b, order = merged.pop(node)
        went = np.empty(k, np.int64)
        went[order] = at
        todo += [(a, went), (b, went[::-1])]
    return part, sums


def windows(sizes: list[int], capacity: int) -> tuple[np.ndarray, int]:
    """Window of each piece and the number of windows, none above ``capacity``.

    The count starts where the smallest piece leaves some room in each window."""
    arr = np.asarray(sizes, np.int64)
    k = max(1, -(-int(arr.sum()) // max(1, capacity - int(arr.min()) // 4)))
    while True:
        part, sums = differencing(arr, k)
        if sums[-1] <= capacity:
            return part, k
        k += 1


def halves(length: int, smallest: int) -> list[int]:
    out = []
    while length >= 2 * smallest:
        out.append(length - length // 2)
        length //= 2
    return [*out, length]


def _packer(path: str, end_id: int, capacity: int, smallest: int, batch: int):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        context = TaskContext.get()
        sequence = (context.partitionId() if context else 0) << 36
        docs: list[int | None] = []
        ids: list[np.ndarray] = []
        pieces: list[list[int]] = []  # lengths of each document's pieces, full windows first
        waiting = held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal sequence, waiting, held
            counts = np.array([len(p) for p in pieces], np.int64)
            lengths = np.concatenate(pieces).astype(np.int64)
            doc = np.repeat(np.arange(len(docs)), counts)
            totals = np.array([len(x) for x in ids], np.int64)
            ends = np.cumsum(lengths)
            start = ends - lengths - (np.cumsum(totals) - totals)[doc]
            full = lengths == capacity
            where, offset = np.empty(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            where[full] = sequence + np.arange(full.sum())
            sequence += int(full.sum())
            rest = np.flatnonzero(~full)
            if len(rest):
                part, k = windows(lengths[rest], capacity)
                order = np.argsort(part, kind="stable")
                before = np.cumsum(lengths[rest][order]) - lengths[rest][order]
                offset[rest[order]] = before - before[np.searchsorted(part[order], part[order])]
                where[rest] = sequence + part
                sequence += k
            raw = pa.py_buffer(np.concatenate(ids).astype("<u4", copy=False).tobytes())
            bounds = np.append(0, 4 * ends)
            names = pa.array(docs, pa.int64())
            lo = 0
            while lo < len(lengths):
                hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + BYTES, "right")) - 1)
                at = slice(lo, hi)
                part_ids = pa.Array.from_buffers(pa.binary(), hi - lo, [
                    None, pa.py_buffer((bounds[lo:hi + 1] - bounds[lo]).astype(np.int32).tobytes()), raw.slice(int(bounds[lo]))])
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(doc[at])), pa.array(start[at]), pa.array(lengths[at]), part_ids,
                     pa.array(totals[doc[at]]), pa.array(where[at]), pa.array(offset[at])], schema=schema)
                lo = hi
            docs.clear(), ids.clear(), pieces.clear()
            waiting = held = 0

        for got in batches:
            for doc, text in zip(got.column(0).to_pylist(), got.column(1), strict=True):
                own = np.append(enc.encode(text.as_py() or ""), np.uint32(end_id))
                full, rest = divmod(len(own), capacity)
                cut = halves(rest, smallest) if rest else []
                docs.append(doc), ids.append(own), pieces.append([capacity] * full + cut)
                waiting, held = waiting + len(cut), held + 4 * len(own)
                if waiting >= batch or held >= BYTES:
                    yield from flush()
        if docs:
            yield from flush()

    return pack


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, end_id: int = 0, smallest: int = SMALLEST, batch: int = BATCH) -> DataFrame:
    """Pieces of all documents in windows of at most ``window`` ids.

    ``tokenizer`` is a byte-level BPE file of the ``tokenizers`` library, at
    the same path on every machine.  ``ids`` holds the piece's ids as
    little-endian unsigned 32-bit numbers.  ``sequence_id`` is unique;
    ``offset`` runs gapless from 0 in each sequence.
    """
    ship(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(_packer(tokenizer, end_id, window, smallest, batch), SCHEMA)
