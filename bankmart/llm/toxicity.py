"""Toxicity of texts by noisy-channel deobfuscation.

1. A character language model (trigrams over letters and word bounds, with
   interpolated lower orders) is counted over every text.
2. A token that leetspeak, spacing or repetition may disguise becomes a
   lattice: each character offers the letters it may stand for, each run of
   one letter one or two of it, each separator nothing or a word bound, at a
   channel cost.  Viterbi decoding under the language model restores it,
   a long one in overlapping pieces.  Runs of single letters or leetspeak
   symbols, white space of any kind and length or a separator between them,
   are joined and decoded with free word bounds.
3. Restored words and their first 4 and 5 letters carry evidence: the
   log-odds of their document counts, less a standard error, among labelled rows.  A
   document's strongest evidence and the sum of the next two are mapped to a
   probability by a logistic fit on evidence from the half of
   the labelled rows that the row isn't in.

The labelled sample holds at most ``LABELLED`` rows, one for each labelled id
(a deterministic fraction of the ids when there are more); the driver sees
counts of its words and a row of evidence for each.  The language model and
the scores cover every row and whole texts, very long ones too.

Defined results: null and empty texts get the score of no evidence; a null
document id is never held out nor labelled; of several labels of one id a
positive one counts, null ones don't; without labels of both kinds every
score is the share of positive labels, or 0.  Of rows that share a labelled id
the text with the least hash is learnt from.  Repeated rows score alike; of
readings at equal cost the first in order counts; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmart.llm.common import ship, written

LABELLED = 20_000
THRESHOLD = 0.7
#: Documents of one class that an entry of the evidence table must be in.
SUPPORT = 3
REMEMBERED = 50_000

LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
SIZE = len(LETTERS) + 1  # 0 is the word bound
NUMBER = {c: i + 1 for i, c in enumerate(LETTERS)}
#: What a character may stand for besides itself (fixed values).
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
        "!": "il", "|": "li", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou", "#": "h"}
CYRILLIC = str.maketrans("асеіорухкмт", "aceiopyxkmt")
SEPARATORS = ".-_~'’·•/\\,:; "
COST = {"same": 0.0, "leet": 1.0, "squeeze": 0.7, "drop": 0.7, "bound": 1.5, "noise": 4.0}

#: Places of a lattice that are decoded at once; the next piece begins in the middle.
PIECE = 128

_SPACED = re.compile(r"(?<!\w)(?:[^\W_]|[@$!|+(€£*#])(?:(?:\s++|[.\-_*~]\s*+)(?:[^\W_]|[@$!|+(€£*#])){3,}(?!\w)")
_RUN = re.compile(r"(.)\1*", re.S)
_LETTERS = re.compile("[a-z]+[.,;:?]*")
#: One letter three times, or three letters twice.
_REPEATED = re.compile(r"(.)\1\1|(.)\2.*(.)\3.*(.)\4")
_HIDDEN = re.compile("[­​-‏⁠﻿]")


class Model:
    """Log-probabilities of a letter after two others."""

    def __init__(self, counts: np.ndarray):
        tri = counts.reshape(SIZE, SIZE, SIZE).astype(np.float64)
        bi, uni = tri.sum(0), tri.sum((0, 1))
        p1 = (uni + 1) / (uni.sum() + SIZE)
        p2 = (bi + 5 * p1) / (bi.sum(1, keepdims=True) + 5)
        self.logp = np.log((tri + 5 * p2[None]) / (tri.sum(2, keepdims=True) + 5)).tolist()

    def decode(self, lattice: list[list[tuple[str, float]]]) -> str:
        """The cheapest reading of a lattice of (letters or bound, cost)."""
        best = {(0, 0): (0.0, "")}
        for options in [*lattice, [(" ", 0.0)]]:
            after: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (cost, read) in best.items():
                for letters, price in options:
                    x, y, total = a, b, cost + price
                    for c in letters:
                        z = NUMBER.get(c, 0)
                        if z or y:  # no bound after a bound
                            total -= self.logp[x][y][z]
                            x, y = y, z
                    if (x, y) not in after or total < after[x, y][0]:
                        after[x, y] = (total, read + letters)
            best = after
        return min(best.values())[1]


def lattice_of(token: str, free_bounds: bool = False) -> list[list[tuple[str, float]]]:
    out = []
    for m in _RUN.finditer(token):
        c, n = m[1], len(m[0])
        options: list[tuple[str, float]] = []
        if c in NUMBER:
            options = [(c * k, COST["same"] if k == n else COST["squeeze"]) for k in (1, 2) if k <= n]
        else:
            for letter in LEET.get(c, ""):
                options += [(letter * k, COST["leet"] + (k < n) * COST["squeeze"]) for k in (1, 2) if k <= n]
            if c in SEPARATORS:
                options.append(("", COST["drop"]))
            options.append((" ", COST["bound"] if c in SEPARATORS else COST["noise"]))
        out.append(options)
        if free_bounds:
            out.append([("", 0.0), (" ", COST["bound"])])
    return out


def plain(text: str) -> str:
    text = _HIDDEN.sub("", text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return text.lower()


_EDGE = "\"'.,;:?!()[]{}<>%&#*$…«»“”„‘’|-_=+/\\~`^"


def undisguised(token: str) -> bool:
    """Plain letters, perhaps before a stop: neither leetspeak nor repetition."""
    return _LETTERS.fullmatch(token) is not None and _REPEATED.search(token) is None


class Restorer:
    def __init__(self, model: Model):
        self.model = model

    def words(self, token: str) -> set[str]:
        """Readings of a token between spaces: as written, and restored."""
        if undisguised(token):
            return {token.rstrip(".,;:?")}
        token = token.translate(CYRILLIC) if not token.isascii() else token
        core = token.strip(_EDGE)
        found = set(re.findall(r"[^\W\d_]+", core)) if not core.isalpha() else {core}
        bare = token.strip(".,;:?\"'()[]{}<>%&#…")
        if len(bare) >= 3 and self.disguised(bare):
            found |= self.readings(lattice_of(bare))
        return found

    def readings(self, lattice: list[list[tuple[str, float]]]) -> set[str]:
        """Words of the reading; those at a cut are read whole in the piece beside."""
        found: set[str] = set()
        for k in range(0, max(1, len(lattice) - PIECE // 2), PIECE // 2):
            words = self.model.decode(lattice[k:k + PIECE]).split()
            first, last = int(k > 0), len(words) - (k + PIECE < len(lattice))
            found |= set(words[first:last] if first < last else words)
        return found

    @staticmethod
    def disguised(token: str) -> bool:
        if token.isalpha():
            runs = [len(m[0]) for m in _RUN.finditer(token)]
            return max(runs) >= 3 or sum(n > 1 for n in runs) >= 3
        letters = sum(c in NUMBER for c in token)
        odd = sum(c in LEET or c in SEPARATORS for c in token)
        return letters >= 1 and odd >= 1 and letters + odd == len(token)

    def spaced(self, text: str) -> set[str]:
        found: set[str] = set()
        for m in _SPACED.finditer(text):
            run = re.sub(r"[\s.\-_~]", "", m[0])
            if re.search(r"\w", run):
                found |= self.readings(lattice_of(run, True)) | {run}
        return found


def features_of(word: str) -> tuple[str, ...]:
    n = len(word)
    return (word, word[:4] + "~", word[:5] + "~") if n > 5 else (word, word[:4] + "~") if n == 5 else (word,) if n > 2 else ()


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    to = np.zeros(256, np.int64)
    for c, i in NUMBER.items():
        to[c.encode("latin-1")[0]] = i
        if len(c.upper()) == 1 and c.upper().encode("latin-1", "replace") != b"?":
            to[c.upper().encode("latin-1")[0]] = i
    total = np.zeros(SIZE ** 3, np.int64)

    def add(texts: list[str]) -> None:
        raw = np.frombuffer((" " + " ".join(texts) + " ").encode("latin-1", "replace"), np.uint8)
        ids = to[raw]
        keep = np.ones(len(ids), bool)
        keep[1:] = (ids[1:] > 0) | (ids[:-1] > 0)
        ids = ids[keep]
        ids = np.concatenate([[0], ids])
        np.add(total, np.bincount((ids[:-2] * SIZE + ids[1:-1]) * SIZE + ids[2:], minlength=len(total)), out=total)

    for got in batches:
        texts, n = [], 0
        for text in got.column(0):
            if text.is_valid:
                texts.append(text.as_py())
                n += len(texts[-1])
            if n > 2_000_000:
                add(texts)
                texts, n = [], 0
        if texts:
            add(texts)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["k", "n"])


def language_model(texts: DataFrame) -> np.ndarray:
    """Trigram counts over every text; the driver sees SIZE ** 3 numbers at most."""
    counted = texts.select("text").mapInArrow(_count_trigrams, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
    out = np.zeros(SIZE ** 3, np.int64)
    for k, n in counted.collect():
        out[k] = n
    return out


def _restorer(shared) -> Restorer:
    return Restorer(Model(shared.value[0]))


def _text_words(restorer: Restorer, text: str | None) -> set[str]:
    text = plain(text or "")
    found: set[str] = set()
    for token in set(text.split()):
        found |= restorer.words(token)
    return found | restorer.spaced(text)


def _count_features(shared):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = _restorer(shared)
        counts: Counter = Counter()

        def table() -> pa.RecordBatch:
            keys = list(counts)
            out = pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                 pa.array(list(counts.values()), pa.int64())], names=["feature", "cell", "n"])
            counts.clear()
            return out

        for got in batches:
            for text, cell in zip(got.column(0), got.column(1).to_pylist(), strict=True):
                counts.update({(f, cell) for w in _text_words(restorer, text.as_py()) for f in features_of(w)})
                if len(counts) > 500_000:
                    yield table()
        yield table()

    return count


class Evidence(dict):
    """Evidence of a token between spaces, remembered; when there are many, those
    that were met since the last time are kept."""

    def __init__(self, restorer: Restorer, weights: dict[str, float]):
        self.restorer, self.weights = restorer, weights
        self.before: dict[str, float] = {}

    def of_word(self, word: str) -> float:
        get, n = self.weights.get, len(word)
        if n > 5:
            return max(get(word, 0.0), get(word[:4] + "~", 0.0), get(word[:5] + "~", 0.0))
        return max((get(f, 0.0) for f in features_of(word)), default=0.0)

    def __missing__(self, token: str) -> float:
        value = self.before.get(token)
        if value is None:
            if undisguised(token):
                value = self.of_word(token.rstrip(".,;:?"))
            else:
                value = max(map(self.of_word, self.restorer.words(token)), default=0.0)
        if len(self) >= REMEMBERED:
            self.before = dict(self)
            self.clear()
        self[token] = value
        return value

    def strongest(self, text: str | None) -> tuple[float, float]:
        """The strongest evidence of a text, and the sum of the next two."""
        text = plain(text or "")
        values = [v for v in map(self.__getitem__, set(text.split())) if v > 0]
        values += [v for v in map(self.of_word, self.restorer.spaced(text)) if v > 0]
        top = sorted(values, reverse=True)[:3]
        return (top[0], sum(top[1:])) if top else (0.0, 0.0)


def _labelled_evidence(shared):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = _restorer(shared)
        halves = [Evidence(restorer, shared.value[1][h]) for h in (0, 1)]
        for got in batches:
            pairs = [halves[cell & 1].strongest(t.as_py()) for t, cell in zip(got.column(0), got.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], pa.float64()), pa.array([p[1] for p in pairs], pa.float64()), got.column(1)],
                names=["top", "next", "cell"])

    return measure


def _score(evidence: Evidence, fit: tuple[float, ...], text: str | None) -> float:
    top, more = evidence.strongest(text)
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, fit[0] + fit[1] * top + fit[2] * more))))


def _scorer(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = Evidence(_restorer(shared), shared.value[1])
        for got in batches:
            scores = [_score(evidence, shared.value[2], text.as_py()) for text in got.column(1)]
            yield pa.RecordBatch.from_arrays([got.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return score


def _keeper(shared, text_at: int, threshold: float):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = Evidence(_restorer(shared), shared.value[1])
        for got in batches:
            clean = [i for i, text in enumerate(got.column(text_at)) if _score(evidence, shared.value[2], text.as_py()) < threshold]
            yield got.take(pa.array(clean, pa.int64()))

    return keep


def _weights(rows: list, cells: dict[int, int], use: tuple[int, ...]) -> dict[str, float]:
    """Log-odds of the entries less a standard error, from the halves in
    ``use``; a cell is 2 * label + half."""
    pos, neg = sum(cells.get(2 + h, 0) for h in use), sum(cells.get(h, 0) for h in use)
    out = {}
    for feature, *n in rows:
        p, q = sum(n[2 + h] for h in use), sum(n[h] for h in use)
        if p + q >= SUPPORT and p > 0:
            odds = math.log((p + 0.5) / (pos + 1)) - math.log((q + 0.5) / (neg + 1))
            weight = odds - math.sqrt(1 / (p + 0.5) + 1 / (q + 0.5))
            if weight > 0.5:
                out[feature] = weight
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps; columns that would count
    against evidence get no weight."""
    full, use = np.column_stack([np.ones(len(x)), x]), list(range(x.shape[1] + 1))
    while True:
        z, w = full[:, use], np.zeros(len(use))
        ridge = np.array([1e-3, *[0.05] * (len(use) - 1)])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge), z.T @ (y - p) - ridge * w)
            w += step
            if abs(step).max() < 1e-8:
                break
        if len(use) == 1 or w[1:].min() >= 0:
            return tuple(float(w[use.index(i)]) if i in use else 0.0 for i in range(full.shape[1]))
        use.pop(1 + int(w[1:].argmin()))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_id_col: str = "doc_id", label_col: str = "toxic", train_on=None,
                 labelled: int = LABELLED):
    """A broadcast of trigram counts, evidence and fit; in its place the score
    of every text where the labels don't have both kinds.

    ``train_on(column)`` says from which document ids labels may be learnt.
    """
    spark = docs.sparkSession
    ship(spark)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = labels.select(F.col(label_id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
    known = known.where("doc_id is not null and y is not null")
    if train_on is not None:
        known = known.where(train_on(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(F.when(F.col("y") > 0, 1).otherwise(0)).alias("y"))
    n = known.count()
    if n > labelled:  # a little under the bound, as the share is by hash
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * 0.97 * labelled / n))
    known = known.select("doc_id", (F.col("y") * 2 + F.pmod(F.hash(F.col("doc_id") + 7), F.lit(2))).cast("int").alias("cell"))

    counts = language_model(slim)
    sc = spark.sparkContext
    train = slim.join(F.broadcast(known), "doc_id")  # at most ``labelled`` rows of two numbers
    train = train.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"), F.min("cell").alias("cell")).select("t.text", "cell")
    train = written(train, "toxicity-train")
    lm = sc.broadcast((counts,))
    cell_n = {r.cell: r.n for r in train.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = cell_n.get(2, 0) + cell_n.get(3, 0), cell_n.get(0, 0) + cell_n.get(1, 0)
    if not pos or not neg:
        return float(pos > 0)
    counted = train.mapInArrow(_count_features(lm), "feature string, cell int, n long").groupBy("feature").agg(
        *[F.sum(F.when(F.col("cell") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in range(4)])
    p, q = F.col("n2") + F.col("n3"), F.col("n0") + F.col("n1")
    lift = (p + 0.25) / (pos + 0.5) / ((q + 0.25) / (neg + 0.5))
    rows = counted.where(((p + q) >= 2) & (p > 0) & (lift > math.e)).collect()  # words of the sample alone
    lm.destroy()
    halves = [_weights(rows, cell_n, (1,)), _weights(rows, cell_n, (0,))]  # for a row, evidence from the other half
    known_halves = sc.broadcast((counts, halves))
    measured = train.mapInArrow(_labelled_evidence(known_halves), "top double, next double, cell int").collect()
    known_halves.destroy()
    fit = _logistic(np.array([[r.top, r.next] for r in measured]), np.array([r.cell >> 1 for r in measured], float))
    return sc.broadcast((counts, _weights(rows, cell_n, (0, 1)), fit))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """doc_id and score of every row of ``docs``; ``how`` as for ``fit_toxicity``."""
    model = fit_toxicity(docs, labels, id_col, text_col, **how)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if isinstance(model, float):
        return slim.select("doc_id", F.lit(model).alias("score"))
    return slim.mapInArrow(_scorer(model), "doc_id long, score double")


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = THRESHOLD, **how) -> DataFrame:
    """The rows of ``docs``, all columns, that score under ``threshold``."""
    model = fit_toxicity(docs, labels, id_col, text_col, **how)
    if isinstance(model, float):
        return docs.where(F.lit(model < threshold))
    return docs.mapInArrow(_keeper(model, docs.columns.index(text_col), threshold), docs.schema)
