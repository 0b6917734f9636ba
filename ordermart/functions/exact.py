"""Money and ratios without floating point.

Sums over doubles depend on shuffle order, and averages of decimals are typed
differently by every engine. All reports therefore add up integer cents, and
round exact decimal quotients half away from zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
_WIDE = "decimal(20,0)"  # holds every BIGINT


def cents(amount: str) -> Column:
    """A two-decimal amount as BIGINT cents: sums stay in codegen and are exact."""
    return (F.col(amount).cast(MONEY) * 100).cast("bigint")


def money(total_cents: Column | str) -> Column:
    """BIGINT cents back to an amount."""
    column = F.col(total_cents) if isinstance(total_cents, str) else total_cents
    return column.cast(_WIDE) * F.expr("0.01")


def rounded_ratio(numerator: Column, denominator: Column, decimals: int) -> Column:
    """Quotient of two integers, half away from zero; null over zero.

    Spark divides DECIMAL(20,0) to 18 places, so the rounding is exact for
    denominators up to 10 ** (17 - decimals).
    """
    return F.round(F.try_divide(numerator.cast(_WIDE), denominator.cast(_WIDE)), decimals)


def mean_money(total_cents: Column, count: Column) -> Column:
    return rounded_ratio(total_cents, count, 0) * F.expr("0.01")


def mean_tenths(total: Column, count: Column) -> Column:
    return rounded_ratio(total, count, 1)


def percentage(part: Column, whole: Column) -> Column:
    """Percent to two places."""
    return rounded_ratio(part, whole, 4) * 100


def growth_pct(current: Column, previous: Column) -> Column:
    """Change against ``previous`` in percent; null on the first row and over zero."""
    return percentage(current - previous, previous)
