"""Exact gold-layer arithmetic.

Floating-point sums depend on the order of addition, which on a cluster
depends on partitioning.  Amounts are therefore added as decimals (the decimal
text of the double, not its binary tail) and rounded once, at the end, half
away from zero with exact integer division, so a total or a mean is the same
on 8 or 8,000 tasks.  A value goes into two sums: its units of 10**-DECIMALS,
and what those leave, in units of 10**-FINEST.  Doubles whose text has more
than FINEST decimals are rounded there (only those below 1e-5 have so many):

* ``money_sum``     - sum, rounded half-up to ``scale`` decimals;
* ``mean_round``    - mean, rounded half-up to ``scale`` decimals;
* ``ratio_pct``     - ``100 * num / den`` rounded half-up to ``scale`` decimals;
* ``round_half_up`` - one value rounded half-up through a decimal.

Infinities (and NaN) are carried as floating-point addition carries them; a
finite value of ``LARGEST`` or more does not fit and fails the query.

All are aggregate-safe ``Column`` expressions returning DOUBLE, the output
type of the source queries.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT = "decimal(38,0)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


DECIMALS = 12
FINEST = 21
LARGEST = 1e16
_VALUE = f"decimal(30,{DECIMALS})"


def _is_finite(x: Column) -> Column:
    return F.abs(x) < float("inf")  # false for NaN, which Spark orders above infinity


def exact_units(c: str | Column) -> Column:
    """A finite value as an integer number of 10**-DECIMALS units; null for
    null and for what is not finite."""
    x = _col(c).cast("double")
    too_large = F.raise_error(F.concat(F.lit("amount does not fit exact arithmetic: "), x.cast("string")))
    units = (x.cast(_VALUE) * F.lit(10 ** DECIMALS).cast("decimal(13,0)")).cast("decimal(28,0)")
    return F.when(F.abs(x) < LARGEST, units).when(_is_finite(x), too_large.cast("decimal(28,0)"))


def rest_units(c: str | Column) -> Column:
    """What ``exact_units`` leaves of a finite value, as an integer number of
    10**-FINEST units; 0 for nearly all values, null for null and what is not finite."""
    x = _col(c).cast("double")
    near = x.cast(_VALUE)
    fine = f"decimal({16 + FINEST},{FINEST})"
    rest = F.round((x.cast(fine) - near.cast(fine)).cast("double") * 10.0 ** FINEST).cast("decimal(10,0)")
    return F.when(F.abs(x) < LARGEST, F.when(near.cast("double") == x, F.lit(0).cast("decimal(10,0)")).otherwise(rest))


def not_finite(c: str | Column) -> Column:
    """The infinities and NaN of a column, null for any other value."""
    x = _col(c).cast("double")
    return F.when(~_is_finite(x), x)


def floor_div(a: Column, b: Column) -> Column:
    """Exact ``floor(a / b)`` for integral a >= 0, b > 0.

    Decimal division rounds to 6 places, so the floor can be one too high or
    too low; the remainder check corrects it.
    """
    q0 = F.floor(a / b).cast(_INT)
    r = a - q0 * b
    return F.when(r < 0, q0 - 1).when(r >= b, q0 + 1).otherwise(q0)


def div_half_up(num: Column, den: Column) -> Column:
    """``num / den`` rounded half away from zero, for integral num and den > 0."""
    num = num.cast(_INT)
    den = den.cast(_INT)
    up = floor_div(num * 2 + den, den * 2)
    down = -floor_div(-num * 2 + den, den * 2)
    return F.when(den <= 0, F.lit(None)).when(num >= 0, up).otherwise(down)


def _twice(units: Column, rest: Column | None) -> Column:
    """Twice a sum in units of 10**-DECIMALS; odd if something is left between two
    units, which is never a tie then (all divisors are even)."""
    units = units.cast(_INT)
    if rest is None:
        return units * 2
    rest = F.coalesce(rest, F.lit(0)).cast("decimal(20,0)")
    part = F.lit(10 ** (FINEST - DECIMALS)).cast("decimal(10,0)")
    over = F.pmod(rest, part)
    return (units + F.call_function("div", rest - over, part).cast(_INT)) * 2 + (over != 0).cast("int")


def _divided(num: Column, den: Column) -> Column:
    """``div_half_up`` of expressions that are worked out once."""
    pair = F.struct(num.cast(_INT).alias("n"), den.cast(_INT).alias("d"))
    return F.transform(F.array(pair), lambda x: div_half_up(x["n"], x["d"]))[0]


def rounded_total(units: Column, odd: Column, scale: int = 2, rest: Column | None = None) -> Column:
    """A total from its sums of ``exact_units``, ``not_finite`` and ``rest_units``."""
    rounded = _divided(_twice(units, rest), F.lit(2 * 10 ** (DECIMALS - scale))).cast("double") / (10 ** scale)
    return F.coalesce(odd, rounded)


def money_sum(c: str | Column, scale: int = 2) -> Column:
    """Exact ``round(sum(c), scale)`` (half-up), as DOUBLE (null if no values)."""
    return rounded_total(F.sum(exact_units(c)), F.sum(not_finite(c)), scale, F.sum(rest_units(c)))


def rounded_mean(units: Column, n: Column, odd: Column, scale: int, rest: Column | None = None) -> Column:
    """A mean from the sums and the count of ``exact_units``, and the sums of
    ``not_finite`` and ``rest_units``."""
    den = n * (2 * 10 ** (DECIMALS - scale))
    return F.coalesce(odd, _divided(_twice(units, rest), den).cast("double") / (10 ** scale))


def mean_round(c: str | Column, scale: int) -> Column:
    """Exact ``round(avg(c), scale)`` (half-up), as DOUBLE (null if no values)."""
    units = exact_units(c)
    return rounded_mean(F.sum(units), F.count(units), F.sum(not_finite(c)), scale, F.sum(rest_units(c)))


def ratio_pct(num: str | Column, den: str | Column, scale: int = 2) -> Column:
    """``round(100 * num / den, scale)`` half-up, exact for integer counts."""
    return div_half_up(_col(num) * (100 * 10 ** scale), _col(den)).cast("double") / (10 ** scale)


def round_half_up(c: str | Column, scale: int) -> Column:
    """One value rounded half away from zero at ``scale`` decimals, as DOUBLE."""
    x = _col(c)
    return rounded_total(exact_units(x), not_finite(x), scale, rest_units(x))
