"""Amounts as DECIMAL, quantities as INT. No DOUBLE is ever summed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from posloom.functions.text import strip
from posloom.schema import MONEY


def dash_to_zero(c: Column) -> Column:
    """A ``--`` cell means no sales."""
    return F.when(c == "--", F.lit("0")).otherwise(c)


def money(c: Column, is_text: bool = True) -> Column:
    """DECIMAL amount; text that is no number becomes NULL, and so does NaN."""
    return (strip(c) if is_text else c).try_cast(MONEY)


def unreadable(c: Column, is_text: bool = True, dash: bool = False) -> Column:
    """Is there something in the cell that is no number? Blank cells are unknown, not unreadable."""
    if not is_text:
        return F.lit(False)
    # Nearly all cells are numbers: one cast settles them.
    said = c.isNotNull() & c.try_cast(MONEY).isNull() & (F.trim(c) != "")
    said = said & (c != "--") if dash else said
    return said & money(c).isNull()


def beyond_whole(c: Column) -> Column:
    """A known number that no INT holds."""
    return F.abs(c.try_cast(MONEY)) >= 2**31


def money_or_dash(c: Column) -> Column:
    """``money(dash_to_zero(c))``, with a look for the dash only in cells that
    are no number."""
    return F.coalesce(money(c), F.when(c == "--", F.lit(0).cast(MONEY)))


def whole(c: Column) -> Column:
    """INT by cutting the fraction off."""
    return c.try_cast("int")


def round_cents(c: Column) -> Column:
    """Two decimals, ties to the even cent."""
    return F.bround(c, 2).cast(MONEY)


def extended_amount(units: Column, price: Column) -> Column:
    return (units * price).cast(MONEY)
