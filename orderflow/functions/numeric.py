"""Exact numeric helpers (JVM-side column expressions).

Spark's ``round`` on DOUBLE rounds the shortest decimal text of the value,
while other engines round ``x * 10^n`` in binary floating point; the two can
disagree on ties. Everything reported as a rounded ratio or mean is therefore
computed here from integer numerators and denominators with an exact
half-away-from-zero rule, and money is rounded as DECIMAL. Both are exact, so
the result does not depend on the engine or on the order of partial sums.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def idiv(a: Column, b: Column | int) -> Column:
    """Floor division of integers (b > 0), exact for every BIGINT."""
    b = b if isinstance(b, Column) else F.lit(b)
    a = a.cast("long")
    return F.call_function("div", a - F.pmod(a, b.cast("long")), b.cast("long"))


def _half_away(num: Column, den: Column, times: int) -> Column:
    """round(num * times / den) as an integral DECIMAL, half away from zero, NULL when den is
    0 / NULL. Products are DECIMAL, so sums up to 10^28 stay exact."""
    n = num.cast("decimal(28,0)")
    d = F.when(den.cast("decimal(28,0)") != 0, den.cast("decimal(28,0)"))
    x = F.abs(n) * F.lit(2 * times).cast("decimal(9,0)") + F.abs(d)
    y = F.abs(d) * F.lit(2).cast("decimal(1,0)")
    q = ((x - x % y) / y).cast("decimal(32,0)")  # the division is exact
    return F.when((n < 0) != (d < 0), -q).otherwise(q)


def round_ratio(num: Column, den: Column, digits: int = 0, times: int = 1) -> Column:
    """round(num * times / den, digits), half away from zero, NULL when den is 0/NULL.

    ``num`` and ``den`` must be integral (counts, day sums, whole cents).
    Returns DOUBLE holding the exact decimal nearest to the rounded value.
    """
    unit = F.lit(Decimal(1).scaleb(-digits))
    return (_half_away(num, den, times * 10 ** digits) * unit).cast("double")


def pct(num: Column, den: Column, digits: int = 1) -> Column:
    """round(100 * num / den, digits) for integral num / den."""
    return round_ratio(num, den, digits, 100)


def tenths(num: Column, den: Column) -> Column:
    """round(1000 * num / den) as an integer count of tenths of a percent."""
    return _half_away(num, den, 1000).cast("long")


def money(col: Column, digits: int = 0) -> Column:
    """Round an exact DECIMAL amount half away from zero, report as DOUBLE."""
    return F.round(col, digits).cast("double")


def cents_to_decimal(cents: Column) -> Column:
    """Integer cents -> DECIMAL(18,2) without floating point."""
    return (cents.cast("decimal(20,0)") * F.lit(0.01).cast("decimal(3,2)")).cast(
        "decimal(18,2)")


def milli_to_decimal(thousandths: Column) -> Column:
    """Integer thousandths -> DECIMAL(18,3) without floating point."""
    return (thousandths.cast("decimal(20,0)") * F.lit("0.001").cast("decimal(4,3)")).cast(
        "decimal(18,3)")
