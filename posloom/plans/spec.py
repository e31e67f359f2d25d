"""What one account's feed looks like and how its rows are matched."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRICT = "strict"
REFERENCE = "reference"

Prepare = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class Layout:
    """Where the rows are in a workbook. ``header_row`` None: first complete row."""

    sheet_name: str | None = None
    sheet_idx: int | None = 0
    header_row: int | None = 0
    columns: str | None = None
    signature: str | None = None


@dataclass(frozen=True)
class Containing:
    """The last column whose header contains ``token`` and not ``unless``."""

    token: str
    unless: str | None = None


@dataclass(frozen=True)
class Pass:
    """One attempt to match: feed column, master column, and the master column
    that must be filled for the row to count as matched."""

    feed_key: str
    master_key: str
    flag: str


@dataclass(frozen=True)
class AccountSpec:
    name: str
    account_major: str
    layout: Layout
    columns: Mapping[str, str | Containing]
    prepare: Prepare
    passes: tuple[Pass, ...]
    # A constant, or None where the feed brings the column itself.
    account: str | None
    channel: str | None
    # Final columns set to a constant whatever the feed holds.
    constants: Mapping[str, str] = field(default_factory=dict)
    # When duplicates are dropped: none, always, rows, amount or final.
    dedup: str = "none"
    dedup_keys: tuple[str, ...] = ()
    # Order of duplicates where it is not the file order.
    dedup_order: tuple[str, ...] = ()
    # Of several master rows prefer one with the flag filled (strict mode).
    prefer_flagged: bool = False
    # Feed keys and sums before matching.
    group_by: tuple[str, ...] = ()
    # Column whose filled cells the control total counts.
    counted: str = "BricksClicks"
    # File name tokens, normalised, that mark the account's files.
    tokens: tuple[str, ...] = ()
    # Differences kept in reference mode.
    stamps_week: bool = True
    appends_unmatched: bool = False
    second_pass_blanks: tuple[str, ...] = ()
    # Columns computed with as exact decimals; all others but the quantity are text.
    money_columns: tuple[str, ...] = ("POSAmount",)
    # Text columns that ``prepare`` reads as numbers (``--`` for none): what an
    # unreadable cell is reported as.
    dashed_numbers: Mapping[str, str] = field(default_factory=dict)
    # The sheet's last row is its grand total.
    drops_last_row: bool = False


ASIDE = "_aside"


class SetAside:
    """A feed whose rows set aside pass every filter.

    A row that cannot be judged (``_aside`` says why) must not vanish in a
    filter over a cell it does not have. It offers what ``prepare`` uses.
    """

    def __init__(self, df: DataFrame):
        self.df = df

    @property
    def columns(self) -> list[str]:
        return [c for c in self.df.columns if c != ASIDE]

    @property
    def na(self) -> SetAside:
        return self

    def filter(self, condition: Column) -> SetAside:
        return SetAside(self.df.filter(condition | F.col(ASIDE).isNotNull()))

    def fill_filter(self, how: str, subset: list[str]) -> Column:
        known = [F.col(f"`{c}`").isNotNull() for c in subset]
        return reduce(lambda a, b: a | b if how == "all" else a & b, known)

    def drop(self, *columns: str, subset: list[str] | None = None) -> SetAside:
        """Columns to drop, or ``na.drop("any" | "all", subset=…)``."""
        if subset is not None:
            return self.filter(self.fill_filter(columns[0], subset))
        return SetAside(self.df.drop(*columns))

    def withColumn(self, name: str, value: Column) -> SetAside:
        return SetAside(self.df.withColumn(name, value))

    def withColumns(self, values: dict[str, Column]) -> SetAside:
        return SetAside(self.df.withColumns(values))
