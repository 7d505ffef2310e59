"""Column expressions on prices: ending rule, taxes, promotion flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CLEARANCE_PERCENT = 60.0
DEFAULT_PROMO_PERCENT = 20


def ending_price(price: Column) -> Column:
    """Price moved to an allowed ending.

    Below 100 the price goes to the nearest five cents; from 100 on to a whole number,
    going up from about .45. The cut is decided in double arithmetic on purpose, so
    100.45 goes up and 200.45 goes down.
    """
    cents = F.floor(price * 100 + 0.5)
    five_cents = F.floor((cents + 2) / 5) * 5 / 100.0
    exact = cents / 100.0
    whole = F.floor(exact)
    up = (exact - whole) * 10 + 0.5 >= 5
    return F.when(price < 100, five_cents).otherwise(whole + F.when(up, 1.0).otherwise(0.0))


def clearance_ending(price: Column) -> Column:
    """True where the price is written with the ending .01, .02 or .03."""
    return price.cast("string").rlike(r"\.0[1-3]$")


def gross(amount: Column, iva: Column, ieps: Column) -> Column:
    """Amount with both taxes, which are given per mille."""
    return amount + amount * (iva + ieps) / 1000.0


def unit_price(amount: Column, units: Column, positive_only: bool = False) -> Column:
    """Amount per unit; null for zero units, or for any non-positive part if asked."""
    if positive_only:
        return F.when((units <= 0) | (amount <= 0), None).otherwise(F.try_divide(amount, units))
    return F.try_divide(amount, units)


def drop_flag(price: Column, reference: Column, percent: Column | float) -> Column:
    """1 where ``price`` lies at least ``percent`` below ``reference``, else 0.

    Any null input gives null.
    """
    percent = percent if isinstance(percent, Column) else F.lit(float(percent))
    fall = F.coalesce(F.try_divide(100 * F.abs(reference - price), reference), F.lit(float("inf")))
    flag = F.when((reference > price) & (fall >= percent), 1).otherwise(0)
    return F.when(price.isNotNull() & reference.isNotNull() & percent.isNotNull(), flag)


def clearance_flag(price: Column, reference: Column) -> Column:
    return drop_flag(price, reference, CLEARANCE_PERCENT)


def percent_of(part: Column, whole: Column) -> Column:
    """Whole percent, halves going up."""
    return F.floor(F.try_divide(100.0 * part, whole) + 0.5).cast("long")
