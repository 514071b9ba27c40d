"""Numeric expressions: money, ratios and the rounding rule of the reports.

Money is DECIMAL so sums are exact and identical on every engine; ratios are
the double quotient of the two (decimal) operands, rounded half away from
zero on the binary value, which is what the reference's SQL engine does for
``ROUND(double, n)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
RATE = "decimal(4,2)"
# wide enough for all money before it is rounded
WIDE = "decimal(38,6)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(c: Column | str) -> Column:
    return _col(c).cast("double")


def round_half_away(c: Column | str, scale: int) -> Column:
    """ROUND(x, scale) for doubles: half away from zero on x * 10^scale.

    ``F.round`` rounds the shortest decimal representation instead (1.005 ->
    1.01, whereas the report engine gives 1.0); this keeps the two equal.
    ``+ 0.0`` turns a negative zero into zero.
    """
    # round(v, 0) works on the shortest decimal form of v = x * 10^scale, which
    # is never exactly k.5 unless v is, so it equals half-away rounding of v.
    m = F.lit(float(10 ** scale))
    return F.round(as_double(c) * m, 0) / m + F.lit(0.0)


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den as double; NULL when den is NULL or 0 (never raises under ANSI)."""
    d = as_double(den)
    return as_double(num) / F.nullif(d, F.lit(0.0))


def pct(num: Column | str, den: Column | str, scale: int = 2) -> Column:
    """ROUND(100.0 * num / NULLIF(den, 0), scale); 100 * num is exact (decimal)."""
    hundred = F.lit(100).cast("decimal(4,1)")
    return round_half_away(ratio(hundred * _col(num), den), scale)


def margin(num: Column | str, den: Column | str, scale: int = 4) -> Column:
    """ROUND(num / NULLIF(den, 0), scale) as double."""
    return round_half_away(ratio(num, den), scale)


def to_money(c: Column | str, half_even: bool = False) -> Column:
    """Anything -> DECIMAL(18,2): unparsable -> NULL, rounded to cents.

    Default rounding is half-up on the decimal value; ``half_even=True``
    rounds ties to even (what the original float pipeline did for exact
    binary halves).
    """
    d = _col(c).try_cast(WIDE)
    r = F.bround(d, 2) if half_even else F.round(d, 2)
    return r.try_cast(MONEY)


def to_whole(c: Column | str, kind: str = "bigint") -> Column:
    """Anything -> whole number: '3' and '3.0' are 3; fractions, other text
    and numbers too large for ``kind`` -> NULL."""
    d = _col(c).try_cast(WIDE)
    return F.when(d == F.floor(d), d).try_cast(kind)


def profit_margin(profit: Column | str, sales: Column | str) -> Column:
    """Line margin = round(profit / sales, 4); NULL if sales is NULL or 0."""
    return margin(profit, sales, 4)


def null_out_of_range(c: Column | str, lo: float = 0.0, hi: float = 1.0) -> Column:
    """Value outside [lo, hi] -> NULL (NULL stays NULL)."""
    x = _col(c)
    return F.when(x.between(F.lit(lo), F.lit(hi)), x)
