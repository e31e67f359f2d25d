"""Row predicates and two-way tags, with their NULL rules spelled out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from posloom.schema import PREMIUM_BRANDS


def nonzero(c: Column) -> Column:
    """Not zero; an unknown amount passes."""
    return ~c.eqNullSafe(F.lit(0))


def known_nonzero(c: Column) -> Column:
    """Not zero and not NULL."""
    return c.isNotNull() & (c != 0)


def positive(c: Column) -> Column:
    return c > 0


def not_sentinel(c: Column, sentinel: str) -> Column:
    """Not the marker of a total row; NULL passes."""
    return ~c.eqNullSafe(F.lit(sentinel))


def brand_tier(short_brand: Column) -> Column:
    """An unknown brand is mainline."""
    return F.when(short_brand.isin(*PREMIUM_BRANDS), "Premium").otherwise("Mainline")


def clicks_when(c: Column, online_value: str) -> Column:
    return F.when(c == online_value, "Clicks").otherwise("Bricks")


def bricks_when(c: Column, store_value: str) -> Column:
    return F.when(c == store_value, "Bricks").otherwise("Clicks")


def keep_where(c: Column, condition: Column, other: Column) -> Column:
    """``c`` where the condition holds, ``other`` elsewhere (NULL included)."""
    return F.when(condition, c).otherwise(other)


def zero_one(missing: Column) -> Column:
    """1 where ``missing`` holds, else 0."""
    return F.when(missing, F.lit(1)).otherwise(F.lit(0))
