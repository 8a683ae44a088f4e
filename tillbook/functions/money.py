"""Money arithmetic. Amounts travel as DOUBLE and are added as DECIMAL, so a sum does not depend on
the order in which partitions are merged."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schema import TAX_RATE

MONEY = "decimal(18,2)"

# Amounts are added in units of a ten-thousandth, as two whole numbers: the upper bits and the lower 25. The
# sums of either stay within a long for more than 10^11 rows, in generated code and without decimals.
_UNITS = 10_000
_LOW_BITS = 25
_LARGEST = 1e11  # amounts from here on are not exact in units


def as_money(amount: Column) -> Column:
    """Exact cents of a DOUBLE; NULL for NaN, infinities and amounts that do not fit."""
    return amount.try_cast(MONEY)


def _addable(amount: Column) -> Column:
    return F.coalesce(F.abs(amount) < _LARGEST, F.lit(False)) & ~F.isnan(amount)


def rounded_sum(amount: Column) -> Column:
    """SUM at four decimals, rounded once to cents. What cannot be added is counted by ``not_addable``."""
    units = F.when(_addable(amount), F.rint(amount * _UNITS).cast("bigint"))
    low, high = units.bitwiseAND(F.lit((1 << _LOW_BITS) - 1)), F.shiftright(units, _LOW_BITS)
    whole = F.sum(high).cast("decimal(28,0)") * F.lit(1 << _LOW_BITS).cast("decimal(9,0)") + F.sum(low).cast("decimal(28,0)")
    return F.round(whole * F.expr("0.0001BD"), 2).cast("double")


def not_addable(amount: Column) -> Column:
    """How many amounts ``rounded_sum`` left out: NaN, infinities, 10^11 and more."""
    return F.count_if(amount.isNotNull() & ~_addable(amount))


def basket_subtotal(items: Column) -> Column:
    """Sum of price times quantity over an array of items; NULL if any factor is missing."""
    return F.aggregate(
        items,
        F.lit(0).cast(MONEY),
        lambda total, item: (total + item["unit_price"].try_cast("decimal(12,2)") * item["quantity"]).try_cast(MONEY),
    )


def tax_on(subtotal: Column) -> Column:
    """Flat tax on a DECIMAL subtotal, rounded half up to cents."""
    return F.round(subtotal * F.expr(f"{TAX_RATE}BD"), 2).cast(MONEY)


def tax_share(subtotal: Column) -> Column:
    """Tax on a part of a subtotal, not rounded: the sum over all parts is rounded."""
    return (subtotal * F.expr(f"{TAX_RATE}BD")).cast("decimal(24,4)")
