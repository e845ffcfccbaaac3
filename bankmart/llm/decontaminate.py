"""Benchmark decontamination by CGK embedding and bit sampling.

Texts are sequences of lower-case words; an item leaks into a document when
some passage of it is within ``TAU`` times the item's words in word edit
distance.  Items are grouped by length.  Every place of a document starts a
window of the length of each group; a window with too few words of the
group's vocabulary is farther than that and goes (an exact test).  For the
others a CGK random walk - at each step the symbol read decides by a shared
random bit whether to move on - turns edit distance into Hamming distance,
and equal symbols at the ``SAMPLED`` sampled steps make a window and an item
candidates.  The walk is repeated with new bits; each group has the least
number of repetitions with which trial copies of its items, all with as many
edits as the bound allows and embedded in other words, are found at
``RECALL`` by the search itself.  A group that does not get there with
``MOST_REPEATS`` is searched exactly: an item is cut into one piece more than
its edits, one of which must stand in the passage unchanged.  Candidates are
verified by the exact edit distance of the item to the best passage around
the window.

Work is local to the scan's partitions.  Items are sent to the tasks in
blocks of about ``ITEMS``, a pass over the documents for each block.

Defined results: null and empty texts hold no item, items without a word are
in no document; repeated documents and items are each reported; every window of
a very long text is searched; of places with equally many edits the first
counts; null ids pass through; an empty table on either side gives no rows; other columns are
ignored by ``leaks`` and kept by ``without_leaks``.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmart.llm.common import ship, written

TAU = 0.2
SAMPLED = 3
RECALL = 0.99
MOST_REPEATS = 64
ITEMS = 20_000
TRIALS = 500  # of a group, over all its lengths
GROWTH = 1.12  # of the lengths in a group
WORDS_AT_ONCE = 1_500_000

_SPLIT = bytes(32 if not (48 <= b < 58 or 97 <= b < 123 or b >= 128) else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(_SPLIT).split()


def edits_within(item: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """Edit distance of an item to its best passage of a region, and the passage's end."""
    steps = np.arange(len(region) + 1)
    row = np.zeros(len(region) + 1, np.int64)  # a passage may start anywhere
    for i, symbol in enumerate(item):
        nxt = np.empty_like(row)
        nxt[0] = i + 1
        nxt[1:] = np.minimum(row[1:] + 1, row[:-1] + (region != symbol))
        row = np.minimum.accumulate(nxt - steps) + steps
    end = int(row.argmin())
    return int(row[end]), end


class Group:
    """Items of similar length, their walks and sampled symbols."""

    def __init__(self, number: int, items: list[int], symbols: list[np.ndarray], rng: np.random.Generator):
        self.number, self.items = number, items
        lengths = [len(symbols[i]) for i in items]
        self.least, self.most = min(lengths), max(lengths)
        self.steps = 2 * self.least
        self.need = self.least - int(TAU * self.least)
        k = min(SAMPLED, self.steps)
        self.at = [np.sort(rng.choice(self.steps, k, replace=False)) for _ in range(MOST_REPEATS)]


class Index:
    def __init__(self, items: list[tuple[object, str | None]], repeats: list[int] | None = None):
        rng = np.random.default_rng(11)
        split = [words_of(t) for _, t in items]
        self.ids = [i for i, _ in items]
        self.of = {w: i + 1 for i, w in enumerate(sorted({w for ws in split for w in ws}))}  # 0: any other word
        self.symbols = [np.array([self.of[w] for w in ws], np.int64) for ws in split]
        order = sorted((i for i, s in enumerate(self.symbols) if len(s)), key=lambda i: (len(self.symbols[i]), i))
        self.groups: list[Group] = []
        self.flags: list[np.ndarray] = []
        at = 0
        while at < len(order):
            most = max(len(self.symbols[order[at]]) * GROWTH, len(self.symbols[order[at]]))
            end = at
            while end < len(order) and len(self.symbols[order[end]]) <= most:
                end += 1
            group = Group(len(self.groups), order[at:end], self.symbols, rng)
            flag = np.zeros(len(self.of) + 1, bool)
            for i in group.items:
                flag[self.symbols[i]] = True
            self.groups.append(group)
            self.flags.append(flag)
            at = end
        self.pad = max([2 * g.most + 2 for g in self.groups], default=0)
        self.bits = rng.integers(0, 1 << 63, (MOST_REPEATS, -(-max([g.steps for g in self.groups], default=1) // 60), len(self.of) + 1))
        self.lead = max([int(TAU * g.most) for g in self.groups], default=0)
        #: Of each group; 0: searched exactly.
        self.repeats = [self.needed(g, rng) for g in self.groups] if repeats is None else repeats
        self.tables = [self.table(g, range(n)) for g, n in zip(self.groups, self.repeats, strict=True)]
        self.pieces = [{} if n else self.cut(g) for g, n in zip(self.groups, self.repeats, strict=True)]

    def walk(self, stream: np.ndarray, starts: np.ndarray, group: Group, repeat: int) -> np.ndarray:
        """Sampled symbols of the walks from ``starts``, folded to a number."""
        place, sampled = starts.copy(), set(group.at[repeat].tolist())
        out = np.zeros(len(starts), np.uint64)
        last = int(group.at[repeat][-1])
        for t in range(last + 1):
            symbol = stream[place]
            if t in sampled:
                out = (out ^ symbol.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                out ^= out >> np.uint64(29)
            place += (self.bits[repeat, t // 60][symbol] >> (t % 60)) & 1
        return out

    def trial(self, item: np.ndarray, rng: np.random.Generator) -> list[int]:
        """A copy with as many edits as the bound allows, at different places."""
        copy = item.tolist()
        for j in sorted(rng.choice(len(item), int(TAU * len(item)), replace=False).tolist(), reverse=True):
            copy[j:j + 1] = [[0], [], [copy[j], 0]][int(rng.integers(0, 3))]
        return copy

    def needed(self, group: Group, rng: np.random.Generator) -> int:
        """Repetitions with which the search finds trial copies at ``RECALL``, or 0."""
        tried = [group.items[j] for j in np.linspace(0, len(group.items) - 1, TRIALS).astype(int)]

        def others(n: int) -> list[int]:
            return (rng.integers(1, len(self.of) + 1, n) * rng.integers(0, 2, n)).tolist()

        texts = [[*others(self.pad), *self.trial(self.symbols[i], rng), *others(self.pad)] for i in tried]
        bounds, stream = self.laid(texts)
        starts = self.starts(stream, bounds, texts, group)
        trial = np.searchsorted(bounds, starts, "right") - 1
        near = np.abs(starts - bounds[trial] - self.lead - self.pad) <= int(TAU * group.least)
        starts, trial = starts[near], trial[near]
        missed = np.ones(TRIALS, bool)
        for r in range(MOST_REPEATS):
            ((keys, items),) = self.table(group, [r])
            key_of = {i: key for key, held in items.items() for i in held}
            want = np.array([key_of[i] for i in tried], np.uint64)
            left = missed[trial]
            starts, trial = starts[left], trial[left]
            missed[trial[self.walk(stream, starts, group, r) == want[trial]]] = False
            if r >= 3 and missed.mean() <= 1 - RECALL:
                return r + 1
            if r >= 7 and missed.mean() ** (MOST_REPEATS / (r + 1)) > 1 - RECALL:  # what the rest can do at best
                break
        return 0

    def table(self, group: Group, repeats: Iterable[int]) -> list[tuple[np.ndarray, dict[int, list[int]]]]:
        streams = [np.concatenate([self.symbols[i], np.zeros(self.pad, np.int64)]) for i in group.items]
        starts = np.cumsum([0, *[len(s) for s in streams[:-1]]])
        out = []
        for r in repeats:
            keys = defaultdict(list)
            for i, key in zip(group.items, self.walk(np.concatenate(streams), starts, group, r).tolist(), strict=True):
                keys[key].append(i)
            out.append((np.array(sorted(keys), np.uint64), dict(keys)))
        return out

    @staticmethod
    def rolled(stream: np.ndarray, n: int) -> np.ndarray:
        """A number for the ``n`` words from each place."""
        out = np.zeros(max(0, len(stream) - n + 1), np.uint64)
        for j in range(n):
            out = (out ^ stream[j:j + len(out)].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out

    def cut(self, group: Group) -> dict[int, tuple[np.ndarray, dict[int, list[tuple[int, int]]]]]:
        """By length, the pieces of the items and their places."""
        held: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for i in group.items:
            at = 0
            for piece in np.array_split(self.symbols[i], int(TAU * len(self.symbols[i])) + 1):
                held[len(piece)][int(self.rolled(piece, len(piece))[0])].append((i, at))
                at += len(piece)
        return {n: (np.array(sorted(keys), np.uint64), dict(keys)) for n, keys in held.items()}

    def laid(self, texts: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Texts one after another, each with ``lead`` empty places before it."""
        bounds = np.cumsum([0, *[len(t) + self.pad for t in texts]])
        stream = np.zeros(bounds[-1] + self.lead, np.int64)
        for t, lo in zip(texts, (bounds + self.lead).tolist(), strict=False):
            stream[lo:lo + len(t)] = t
        return bounds, stream

    def starts(self, stream: np.ndarray, bounds: np.ndarray, texts: list[list[int]], group: Group) -> np.ndarray:
        """Starts of the windows with enough words of the group's vocabulary."""
        hits = np.cumsum(self.flags[group.number][stream], dtype=np.int32)
        hits = np.concatenate([[0], hits])
        starts = np.flatnonzero(hits[group.most:] - hits[:-group.most] >= max(1, group.need))
        doc = np.searchsorted(bounds, starts, "right") - 1
        ends = bounds[:-1] + self.lead + np.array([len(t) for t in texts])
        return starts[starts < np.append(ends, 0)[doc]]

    def found(self, texts: list[list[int]]) -> list[list[tuple[int, int, int]]]:
        """For each document (its symbols) the items in it: place of the item, edits, first word."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        if not self.groups or not texts:
            return out
        bounds, stream = self.laid(texts)
        candidates: dict[tuple[int, int], set[int]] = defaultdict(set)

        def look(got: np.ndarray, keys: np.ndarray) -> np.ndarray:
            return np.flatnonzero(keys[np.minimum(np.searchsorted(keys, got), len(keys) - 1)] == got)

        for n, (keys, pieces) in ((n, held) for cut in self.pieces for n, held in cut.items()):
            got = self.rolled(stream, n)
            hit = look(got, keys)
            doc = np.searchsorted(bounds, hit, "right") - 1
            for s, d, key in zip(hit.tolist(), doc.tolist(), got[hit].tolist(), strict=True):
                for i, at in pieces[key]:
                    candidates[d, i].add(s - at)
        for group, tables in zip(self.groups, self.tables, strict=True):
            starts = self.starts(stream, bounds, texts, group) if tables else ()
            if not len(starts):
                continue
            for r, (keys, items) in enumerate(tables):
                got = self.walk(stream, starts, group, r)
                hit = look(got, keys)
                doc = np.searchsorted(bounds, starts[hit], "right") - 1
                for s, d, key in zip(starts[hit].tolist(), doc.tolist(), got[hit].tolist(), strict=True):
                    for i in items[key]:
                        candidates[d, i].add(s)
        for (d, i), places in candidates.items():
            item, bound = self.symbols[i], int(TAU * len(self.symbols[i]))
            lo = int(bounds[d]) + self.lead
            hi = lo + len(texts[d])
            best, covered = None, -1
            for s in sorted(places):
                if s <= covered:
                    continue
                a, b = max(lo, s - bound), min(hi, s + len(item) + 3 * bound + 1)
                covered = s + bound  # the region holds every passage that starts so near
                if np.isin(stream[a:b], item).sum() < len(item) - bound:
                    continue
                edits, end = edits_within(item, stream[a:b])
                if edits <= bound and (best is None or edits < best[0]):
                    best = (edits, max(0, a + end - len(item) - lo))
            if best:
                out[d].append((i, *best))
        return out


_INDEXES: dict[str, Index] = {}


def _index(shared) -> Index:
    key, items, repeats = shared.value
    if key not in _INDEXES:  # a worker keeps the last index
        _INDEXES.clear()
        _INDEXES[key] = Index(items, repeats)
    return _INDEXES[key]


def _searched(index: Index, texts: pa.Array) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """Row and findings of a batch, some documents at a time."""
    of, held, first, n = index.of, [], 0, 0
    for row, text in enumerate(texts):
        held.append([of.get(w, 0) for w in words_of(text.as_py())])
        n += len(held[-1]) + index.pad
        if n > WORDS_AT_ONCE or row == len(texts) - 1:
            yield from enumerate(index.found(held), first)
            held, first, n = [], row + 1, 0


LEAKS = "doc_id long, item_id long, n_words long, edits long, first_word long"
_LEAKS = pa.schema([(c, pa.int64()) for c in ("doc_id", "item_id", "n_words", "edits", "first_word")])


def _report(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(shared)
        for got in batches:
            ids = got.column(0)
            rows = [(ids[row].as_py(), index.ids[i], len(index.symbols[i]), edits, first)
                    for row, found in _searched(index, got.column(1)) for i, edits, first in found]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=_LEAKS)

    return run


def _keep(shared, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(shared)
        for got in batches:
            clean = [row for row, found in _searched(index, got.column(text_at)) if not found]
            yield got.take(pa.array(clean, pa.int64()))

    return run


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, items: int) -> Iterator:
    """Broadcasts of the items, about ``items`` of them each."""
    sc = benchmark.sparkSession.sparkContext
    slim = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    n = -(-slim.count() // items)
    for b in range(n):
        part = slim.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).orderBy("item_id", "text")
        held = [(r.item_id, r.text) for r in part.collect()]
        yield sc.broadcast((uuid.uuid4().hex, held, Index(held).repeats))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", items: int = ITEMS) -> DataFrame:
    """doc_id, item_id, n_words of the item, edits and first_word of the best
    passage, for every document and item that leaks into it."""
    ship(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for shared in _blocks(benchmark, item_col, item_text_col, items):
        part = slim.mapInArrow(_report(shared), LEAKS)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], LEAKS)


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", items: int = ITEMS) -> DataFrame:
    """The rows of ``docs``, all columns, into which no item leaks."""
    ship(docs.sparkSession)
    for n, shared in enumerate(_blocks(benchmark, item_col, item_text_col, items)):
        docs = (written(docs, "clean") if n else docs).mapInArrow(_keep(shared, docs.columns.index(text_col)), docs.schema)
    return docs
