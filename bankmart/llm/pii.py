"""Personal data by boosted trees over candidate spans, in DataFrame functions.

Base spans (email, ip, card, phone) are regular expressions with checks.
Two broad generators propose further spans that may overlap them: runs of
digits with separators, and tokens that look like addresses or secrets.

Trees learn from two views of a candidate that know nothing of each other.
The label is its context: whether a word for its kind ("tel", "card", "mail")
stands before it.  The features are its format: kind, digits, separators,
lead, groups, and its form (a checksum that holds, an address written out,
and so on).  All candidates of all documents are grouped by their features into
a table of counts; gradient boosting, in which every kind weighs the same,
fits trees of depth two to it, whose size is bounded by the features and not by
the data.  Personal data stand without such a word, too: how often with one is
read off the candidates that pass their kind's strict check (Luhn, octets, a
full address, the length of an international number), and a format's share of
labels divided by that is the share of personal data in it.  A kind's threshold
is the least score from which that share is ``PRECISION``, however many the
candidates are; a kind without labels has none.  Candidates from there on are
spans, with or without such a word.

Spans at any score are keys and phone numbers of a known form, and grouped
numbers of 7 to 15 digits after a word for phones.

Positions count code points, ends are exclusive.  Repeated groups in the
patterns are possessive, which changes no match and bounds the matcher's
stack on long texts; ``\\G`` stands for the end of the last match, where a
match may start inside a run.

Defined results: null text is empty and has no spans; null and repeated ids
pass through; spans that start together stand in the order of their kinds; the
places of matches are summed up in blocks of ``BLOCK``, so very long texts with
very many matches take time in proportion; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "secret", "number")
PRECISION = 0.9
ROUNDS = 30
RATE = 0.4
BLOCK = 256

_LOCAL = "A-Za-z0-9._%+-"
#: The base patterns; each equals the plain pattern of its kind.
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Broad generators of candidates.
GENERATORS = (
    r"[+(]{0,2}[0-9][0-9 ().:/-]{4,}[0-9]",
    rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9.-]++"
    r"|(?i:password|passwd|token|secret|api[_-]?key)[\"']? ?[=:] ?[\"']?[A-Za-z0-9+/_-]{8,}"
    r"|(?<![A-Za-z0-9])[A-Z]{4}[0-9A-Z]{16}(?![A-Za-z0-9])",
)
#: Forms of phone numbers without +, and of dates, which have similar ones.
PHONES = (
    r"\A\([0-9]{1,5}\)[ .-]?[0-9]{2,}(?:[ .-][0-9]{2,})*+\z",
    r"\A0[0-9]{1,4}(?:[ ./-][0-9]{2,})++\z",
    r"\A[2-9][0-9]{2}([ .-])[0-9]{3}\1[0-9]{4}\z",
)
DATE = r"\A\(?(?:[0-9]{4}([./-])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([./-])[0-9]{1,2}\2[0-9]{2,4})(?![0-9])"
#: Keys of a known form.
SECRET = r"\AAKIA|[=:] ?[\"']?(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{12,}"
CONTEXTS = (
    r"(?i)phone|tel|call|mobile|fax", r"(?i)card|visa|account|iban|konto|cuenta|compte", r"(?i)pass|token|secret|key",
    r"(?i)mail|contact", r"(?i)\bip\b|addr|host|server",
)
_SPANS = "array<struct<start:long,end:long,t:string>>"


def _matches(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Column ``name``: start, end and text of all matches in column ``text``."""
    df = df.withColumn("_m", F.regexp_extract_all("text", F.lit(pattern), 0))
    df = df.withColumn("_p", F.arrays_zip(F.transform(F.slice(F.split("text", pattern), 1, F.size("_m")), F.length).alias("g"), F.col("_m").alias("m")))
    none = F.array().cast(_SPANS)

    def block(of: str, i: Column) -> Column:
        return F.slice(of, i * BLOCK + 1, F.lit(BLOCK))

    def add(acc: Column, pair: Column) -> Column:
        start = acc["at"] + pair["g"]
        end = start + F.length(pair["m"])
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(F.struct(start.alias("start"), end.alias("end"), pair["m"].alias("t")))).alias("found"))

    zero = F.lit(0).cast("long")
    few = F.size("_m") <= BLOCK
    blocks = F.sequence(F.lit(0), F.floor((F.size("_m") - 1) / BLOCK).cast("int"))
    # what lies before each block, then the places within it
    df = df.withColumn("_s", F.when(~few, F.transform(blocks, lambda i: F.aggregate(
        block("_p", i), zero, lambda acc, pair: acc + pair["g"] + F.length(pair["m"])))))
    many = F.flatten(F.transform(blocks, lambda i: F.aggregate(
        block("_p", i), F.struct(F.aggregate(F.slice("_s", F.lit(1), i), zero, lambda acc, x: acc + x).alias("at"), none.alias("found")),
        add, lambda acc: acc["found"])))
    found = F.aggregate("_p", F.struct(zero.alias("at"), none.alias("found")), add, lambda acc: acc["found"])
    return df.withColumn(name, F.when(F.size("_m") == 0, none).when(few, found).otherwise(many)).drop("_m", "_p", "_s")


def _digits(t: Column) -> Column:
    return F.regexp_replace(t, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        d = F.when((n - i) % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)
        return acc + d

    return F.when(n.between(12, 19), F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0).otherwise(False)


def _octets(t: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(t, r"\."), small)


_CHECKS = {
    "email": None,
    "ip": lambda s: _octets(s["t"]),
    "card": lambda s: _luhn(_digits(s["t"])),
    "phone": lambda s: F.length(_digits(s["t"])).between(9, 15),
}


def base_spans(df: DataFrame) -> DataFrame:
    """A column of checked spans for each base kind."""
    for kind, pattern in BASE.items():
        df = _matches(df, kind, pattern)
        if _CHECKS[kind]:
            df = df.withColumn(kind, F.filter(kind, _CHECKS[kind]))
    return df


def _first_of(*cases: tuple[Column, int], otherwise: int) -> Column:
    out = None
    for condition, value in cases:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(otherwise)


FEATURES = ("kind", "digits", "separators", "lead", "groups", "form")
#: The context that names each kind.
_CONTEXT_OF = {"email": 3, "ip": 4, "card": 1, "phone": 0, "secret": 2, "number": 0}
#: Kinds that are told apart by their form alone share how often they have a context.
_LIKE = {"number": "phone", "secret": "email"}


def _seen(text: Column, s: Column, generator: int) -> Column:
    """What several features of a candidate are made of, worked out once."""
    t = s["t"]
    before = F.substr(text, F.greatest(s["start"] - 23, F.lit(1)).cast("int"), F.least(s["start"], F.lit(24)).cast("int"))
    after = F.substr(text, (s["end"] + 1).cast("int"), F.lit(1))
    return F.struct(s["start"].alias("start"), s["end"].alias("end"), t.alias("t"), _digits(t).alias("d"), before.alias("before"),
                    (t.rlike(DATE) if generator == 0 else F.lit(False)).alias("date"), after.alias("after"))


def _checked(s: Column, generator: int) -> Column:
    t, digits = s["t"], F.length(s["d"])
    if generator == 0:
        strict_ip = t.rlike(r"\A[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+\z")
        kind = _first_of((strict_ip, 1), (t.rlike(r"\A[+(]"), 3), (digits.between(12, 19), 2), otherwise=5)
        strict = F.when(strict_ip, _octets(t)).when(t.startswith("+"), digits.between(9, 15)).otherwise(
            digits.between(12, 19) & t.rlike(r"\A[0-9](?:[\x20-]?[0-9])++\z") & _luhn(s["d"]))
        alone = ~s["before"].rlike(r"[\w.]\z") & ~s["after"].rlike(r"\w") & ~s["date"]
        grouped = digits.between(7, 15) & t.rlike(r"\A\(?[0-9]++(?:[ ().-]++[0-9]++)++\z")
    else:
        kind = _first_of((t.rlike(r"@|\(at\)|\[at\]"), 0), otherwise=4)
        strict = t.rlike(r"\A[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++\z")
        alone, grouped = F.lit(True), F.lit(False)
    context = _first_of(*[(s["before"].rlike(c), i) for i, c in enumerate(CONTEXTS)], otherwise=len(CONTEXTS))
    return F.struct(s["start"].alias("start"), s["end"].alias("end"), t.alias("t"), digits.alias("digits"), s["date"].alias("date"),
                    kind.alias("kind"), strict.alias("strict"), alone.alias("alone"), grouped.alias("grouped"), context.alias("context"))


def _features(s: Column, generator: int) -> Column:
    t, digits, kind = s["t"], s["digits"], s["kind"]
    if generator == 0:
        paren, trunk, plain = (t.rlike(form) for form in PHONES)
        known = (t.startswith("(") | (kind == 5)) & s["alone"] & (
            (digits.between(7, 15) & paren) | (digits.between(9, 15) & trunk) | plain | (s["grouped"] & (s["context"] == 0)))
        form = _first_of((s["strict"], 0), (s["date"], 1), (~s["alone"], 2), (s["grouped"], 3), otherwise=4)
    else:
        known = (kind == 4) & t.rlike(SECRET)
        spelt = t.rlike(r"(?:\(at\)|\[at\]|@) ?[A-Za-z0-9-]") & t.rlike(r"\.[A-Za-z]{2,24}\z")
        form = _first_of((s["strict"], 0), (spelt, 1), (kind == 0, 2), (t.rlike(SECRET), 3), otherwise=4)
    own = F.array(*[F.lit(_CONTEXT_OF[k]) for k in KINDS])[kind]
    return F.struct(
        s["start"].alias("start"), s["end"].alias("end"), kind.alias("kind"),
        _first_of((digits < 6, 0), (digits < 9, 1), (digits < 12, 2), (digits < 16, 3), (digits < 20, 4), otherwise=5).alias("digits"),
        _first_of((t.rlike(r"\A[0-9A-Za-z]+\z"), 0), (~t.rlike("[^0-9.]"), 1), (~t.rlike("[^0-9 ]"), 2), (~t.rlike("[^0-9-]"), 3),
                  (~t.rlike("[^0-9:/]"), 4), otherwise=5).alias("separators"),
        _first_of((t.startswith("+"), 0), (t.startswith("("), 1), (t.startswith("0"), 4), (t.rlike(r"\A[0-9]"), 2), otherwise=3).alias("lead"),
        F.least(F.size(F.split(t, "[^0-9]+")), F.lit(6)).alias("groups"), form.alias("form"),
        (s["context"] == own).cast("int").alias("named"), known.alias("known"))


def with_candidates(df: DataFrame) -> DataFrame:
    for i, pattern in enumerate(GENERATORS):
        df = _matches(df, f"_c{i}", pattern)

    def featured(i: int) -> Column:
        seen = F.transform(f"_c{i}", lambda s: _seen(F.col("text"), s, i))
        return F.transform(F.transform(seen, lambda s: _checked(s, i)), lambda s: _features(s, i))

    parts = [featured(i) for i in range(len(GENERATORS))]
    return df.withColumn("candidates", F.concat(*parts)).drop(*[f"_c{i}" for i in range(len(GENERATORS))])


class Boosted:
    """Trees of depth two on equality tests, fitted to a table of counts."""

    def __init__(self, x: np.ndarray, n: np.ndarray, pos: np.ndarray):
        self.bias = math.log((pos.sum() + 1) / (n.sum() - pos.sum() + 1))
        self.trees = []
        score = np.full(len(x), self.bias)
        tests = [(f, int(v)) for f in range(x.shape[1]) for v in np.unique(x[:, f])]
        masks = {t: x[:, t[0]] == t[1] for t in tests}
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-score))
            g, h = pos - n * p, n * p * (1 - p)

            def gain(mask, g=g, h=h):
                return g[mask].sum() ** 2 / (h[mask].sum() + 1)

            def best(rows):
                return max(tests, key=lambda t: (round(gain(rows & masks[t]) + gain(rows & ~masks[t]), 9), t))

            every = np.ones(len(x), bool)
            root = best(every)
            tree = [root]
            for rows in (masks[root], ~masks[root]):
                test = best(rows)
                leaves = []
                for leaf in (rows & masks[test], rows & ~masks[test]):
                    value = RATE * float(g[leaf].sum() / (h[leaf].sum() + 1))
                    score = score + value * leaf
                    leaves.append(value)
                tree.append((test, *leaves))
            self.trees.append(tree)
        self.scores = 1 / (1 + np.exp(-score))

    def column(self, s: Column) -> Column:
        """The score of a candidate as an expression."""
        def holds(test):
            return s[FEATURES[test[0]]] == test[1]

        total = F.lit(self.bias)
        for root, yes, no in self.trees:
            total = total + F.when(holds(root), F.when(holds(yes[0]), yes[1]).otherwise(yes[2])).otherwise(
                F.when(holds(no[0]), no[1]).otherwise(no[2]))
        return F.lit(1.0) / (F.exp(-total) + 1)


def named_shares(x: np.ndarray, n: np.ndarray, pos: np.ndarray) -> dict[int, float]:
    """How often a kind's personal data stand after a word for it: among the
    candidates that pass its strict check (form 0)."""
    out = {}
    for k, kind in enumerate(KINDS):
        rows = (x[:, 0] == KINDS.index(_LIKE.get(kind, kind))) & (x[:, 5] == 0)
        if pos[rows].sum():
            out[k] = float(pos[rows].sum() / n[rows].sum())
    return out


def thresholds(x: np.ndarray, n: np.ndarray, pos: np.ndarray, scores: np.ndarray) -> dict[int, float]:
    """Least score of each kind from which PRECISION of the candidates are personal data."""
    out, named = {}, named_shares(x, n, pos)
    for kind in np.unique(x[:, 0]):
        rows = np.flatnonzero(x[:, 0] == kind)
        rows = rows[np.argsort(-scores[rows], kind="stable")]
        if int(kind) not in named:
            continue
        share = np.cumsum(pos[rows]) / np.cumsum(n[rows]) / named[int(kind)]
        edge = np.append(scores[rows][1:] < scores[rows][:-1] - 1e-12, True)  # equal scores stay together
        good = np.flatnonzero((share >= PRECISION) & edge)
        if len(good):
            out[int(kind)] = float(scores[rows][good[-1]])
    return out


def fit(df: DataFrame) -> tuple[Boosted, dict[int, float]] | None:
    table = (with_candidates(df.select("text")).select(F.explode("candidates").alias("c")).select("c.*")
             .groupBy(*FEATURES).agg(F.count(F.lit(1)).alias("n"), F.sum("named").alias("pos")).orderBy(*FEATURES).collect())
    if not table:
        return None
    x = np.array([[r[f] for f in FEATURES] for r in table])
    n, pos = np.array([r.n for r in table], float), np.array([r.pos for r in table], float)
    each = np.bincount(x[:, 0], n)[x[:, 0]] * len(np.unique(x[:, 0])) / n.sum()  # a rare kind is learnt too
    model = Boosted(x, n / each, pos / each)
    return model, thresholds(x, n, pos, model.scores)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, a column of base spans per kind, ``base`` and ``spans``
    (arrays of start, kind number, end by start, then kind)."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    fitted = fit(slim)
    df = base_spans(slim)

    def numbered(kind: int, spans: str) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))

    df = df.withColumn("base", F.array_sort(F.concat(*[numbered(i, kind) for i, kind in enumerate(BASE)])))
    if not fitted:
        return df.withColumn("spans", F.col("base"))
    model, least = fitted
    df = with_candidates(df)

    def chosen(s: Column) -> Column:
        bound = F.lit(2.0)
        for k, t in least.items():
            bound = F.when(s["kind"] == k, t - 1e-9).otherwise(bound)
        return s["known"] | (model.column(s) >= bound)

    extra = F.transform(F.filter("candidates", chosen), lambda s: F.struct(s["start"], s["kind"].alias("kind"), s["end"]))
    return df.withColumn("spans", F.array_sort(F.array_union("base", extra))).drop("candidates")


def joined(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")
