"""Exact, order-independent money and ratio arithmetic.

Amounts have two decimals by schema, so sums run over whole cents in ``bigint``. Floating
point sums would depend on the order in which shuffled rows arrive and could flip a rounded
digit when a task is run again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(c: str | Column) -> Column:
    """A finite two-decimal amount as whole cents; NULL stays NULL.

    ``floor`` compiles to plain arithmetic, while ``round`` of a double goes through decimals.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * 100 + 0.5)


def from_cents(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c / F.lit(100.0)


def ratio(numerator: Column, denominator: Column, digits: int = 0) -> Column:
    """``numerator / denominator`` of two integers, rounded half up to ``digits`` decimals."""
    scale = 10**digits
    doubled = F.abs(numerator) * (2 * scale) + denominator
    whole = F.call_function("div", doubled, denominator * 2)
    signed = F.when(numerator < 0, -whole).otherwise(whole)
    return F.when(denominator > 0, signed / F.lit(float(scale)))


def mean_amount(total_cents: Column, n: Column) -> Column:
    """Mean of ``n`` amounts given their sum in cents, rounded half up to two decimals."""
    return ratio(total_cents, n) / F.lit(100.0)
