"""Row-local cleaning rules as Spark column expressions.

Every function here returns a ``Column`` built from built-in functions, so
the rules stay inside whole-stage codegen and work unchanged on batch and
streaming DataFrames.  Null handling follows the source pipeline (pandas):

* a synonym lookup leaves unknown values and nulls as they are;
* a negated value-list test keeps nulls;
* a numeric coercion turns anything pandas would not parse into null, and
  NaN into null;
* whitespace stripping removes every character Python's ``str.strip`` removes.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.isspace() accepts - what pandas .str.strip()
# removes.  Java's \s and Spark's trim() only know ASCII whitespace.  Built
# from the rule itself rather than written out.
WHITESPACE_CHARS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

# Text pandas.to_numeric accepts: optional sign, digits with an optional
# fraction (or a bare fraction), optional exponent, optional surrounding
# whitespace, or an infinity.  Java's Double parser (behind Spark's cast) would
# also accept "12d" / "12f", DuckDB would accept "1_000"; the gate rejects both.
NUMERIC_PATTERN = (
    r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))$"
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """Remove leading and trailing whitespace (``str.strip`` semantics).

    ``btrim`` with an explicit character set, no regular expression.  Most
    values are not padded, so the first and last characters are tested
    first and ``btrim`` (which copies and searches character by character)
    only runs on padded values.
    """
    x = _col(c)
    ws = F.lit(WHITESPACE_CHARS)
    padded = ws.contains(F.substring(x, 1, 1)) | ws.contains(F.substring(x, -1, 1))
    return F.when(padded, F.btrim(x, ws)).otherwise(x)


def standardise(c: str | Column, mapping: Mapping[str, str]) -> Column:
    """Replace known dirty spellings with their canonical value.

    ``coalesce(map[x], x)``: an unknown value stays, a null stays null.  The
    map is a literal folded into the plan, so no join or broadcast is needed.
    """
    x = _col(c)
    lookup = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    return F.coalesce(lookup[x], x)


def to_number(c: str | Column) -> Column:
    """Text -> DOUBLE; text pandas would not parse, NaN and empty give null."""
    x = strip_ws(c)
    # The gate admits no NaN spelling, so a parsed value is never NaN.
    return F.when(x.rlike(NUMERIC_PATTERN), x.try_cast("double"))


def to_bool(c: str | Column) -> Column:
    """'True' / 'False' text (any case) -> BOOLEAN, anything else null."""
    x = F.lower(strip_ws(c))
    return F.when(x == "true", F.lit(True)).when(x == "false", F.lit(False))


def to_date(c: str | Column) -> Column:
    """ISO date text -> DATE; unparseable text gives null."""
    return strip_ws(c).try_cast("date")


def not_in_keep_null(c: str | Column, values: Iterable) -> Column:
    """Predicate ``x NOT IN values`` that is true for null x (pandas ``~isin``)."""
    return F.coalesce(~_col(c).isin(list(values)), F.lit(True))


def null_outside(c: str | Column, low: float, high: float) -> Column:
    """Null when x is outside the closed range [low, high]; null stays null."""
    x = _col(c)
    return F.when((x < low) | (x > high), F.lit(None)).otherwise(x)


def null_if_negative(c: str | Column) -> Column:
    """Null when x < 0 (zero is kept)."""
    x = _col(c)
    return F.when(x < 0, F.lit(None)).otherwise(x)


def null_if_greater(c: str | Column, other: str | Column) -> Column:
    """Null when x > other; rows with a null on either side are unchanged."""
    x = _col(c)
    return F.when(x > _col(other), F.lit(None)).otherwise(x)


def is_missing(c: str | Column) -> Column:
    """Null flag column (row retained)."""
    return _col(c).isNull()


def null_tokens(c: str, tokens: Iterable[str]) -> Column:
    """Cells whose whole text is a missing-value spelling become null.

    One SQL predicate per column (an ``InSet`` hash lookup), built from text so
    a wide table does not cost a driver round trip per token and column.
    """
    listed = ", ".join("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in tokens)
    return F.expr(f"CASE WHEN `{c}` IN ({listed}) THEN CAST(NULL AS STRING) ELSE `{c}` END")


def round_half_even(c: str | Column, scale: int) -> Column:
    """pandas ``Series.round`` (banker's rounding on the decimal text)."""
    return F.bround(_col(c), scale)
