"""String columns: item numbers, descriptions, UPCs, names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters counted as white space at the ends of a cell.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Leading pairs of digits that mark a UPC whose zero was lost.
SHORTENED_UPC_PREFIXES = ("19", "44", "52", "65", "72", "93")


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    """An empty or all-blank cell carries no value."""
    return F.when(strip(c) != "", c)


def part(c: Column, sep: str, index: int) -> Column:
    """``index``-th piece of ``c`` (0-based); NULL when there are fewer pieces."""
    return F.try_element_at(F.split(c, re.escape(sep)), F.lit(index + 1))


def after_first(c: Column, sep: str) -> Column:
    """All but the first piece, joined again."""
    pieces = F.split(c, re.escape(sep))
    return F.array_join(F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1))), sep)


def with_prefix(prefix: str, c: Column) -> Column:
    """NULL stays NULL."""
    return F.concat(F.lit(prefix), c)


def from_offset(c: Column, offset: int) -> Column:
    """Characters from 0-based ``offset`` to the end."""
    return F.substring(c, F.lit(offset + 1), F.length(c))


def without(c: Column, literal: str) -> Column:
    return F.replace(c, F.lit(literal), F.lit(""))


def lstrip_chars(c: Column, chars: str) -> Column:
    return F.ltrim(c, F.lit(chars))


def starts_with_any(c: Column, prefixes: tuple[str, ...]) -> Column:
    """Prefix set of equal widths, tested as one IN."""
    return F.substring(c, 1, len(prefixes[0])).isin(*prefixes)


def pad_upc(c: Column) -> Column:
    """Give a shortened UPC its leading zero back; others pass unchanged."""
    return F.when(
        starts_with_any(c, SHORTENED_UPC_PREFIXES), F.concat(F.lit("0"), strip(c))
    ).otherwise(c)


def normalise_name(c: Column) -> Column:
    """Lower case with everything but letters, digits, ``_`` and blanks removed."""
    return F.regexp_replace(F.lower(c), r"(?U)[^\p{L}\p{N}_\s]", "")


def name_has_token(name: Column, token: Column | str) -> Column:
    """Does a file name, normalised, contain an account token, normalised?"""
    token = F.lit(token) if isinstance(token, str) else token
    return normalise_name(name).contains(normalise_name(token))


def digits(c: Column) -> Column:
    """Every digit of ``c`` in order, as an array."""
    return F.regexp_extract_all(c, F.lit(r"\d"), F.lit(0))


def joined_digits(c: Column) -> Column:
    return F.array_join(digits(c), "")


def line_record(line: Column, names: list[str], sep: str = ",") -> Column:
    """One delimited line as a map of name to trimmed value.

    Names and values pair up by position; the longer side's rest is left out.
    """
    values = F.transform(F.split(line, re.escape(sep)), strip)
    keys = F.array(*[F.lit(n) for n in names])
    width = F.least(F.size(values), F.lit(len(names)))
    return F.map_from_arrays(F.slice(keys, F.lit(1), width), F.slice(values, F.lit(1), width))
