"""The item master, prepared and measured once and shared by all accounts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posloom.functions.text import blank_to_null, strip
from posloom.operators.lookup import ROW_OVERHEAD_BYTES, measured_columns
from posloom.schema import MASTER_HEADERS
from posloom.sources import grid as g


@dataclass(frozen=True)
class Master:
    """Master rows in sheet order (``master_row``) and their size in bytes, in all and by column."""

    rows: DataFrame
    size: int
    count: int = 0
    columns: Mapping[str, int] = field(default_factory=dict)

    def bytes_of(self, *columns: str, derived: int = 0) -> int:
        """Size of a dimension of these columns and ``derived`` bytes a row of others;
        that of the whole master if its columns were not measured."""
        if not set(columns) <= set(self.columns):
            return self.size
        return self.count * (ROW_OVERHEAD_BYTES + derived) + sum(self.columns[c] for c in set(columns))


def master_columns(
    raw: DataFrame, headers: dict[str, str] = MASTER_HEADERS, row: str = "master_row"
) -> DataFrame:
    """Known columns as trimmed text; a header the sheet lacks gives NULLs."""
    is_map = "row" in raw.columns
    present = set(raw.columns)

    def column(header: str):
        if is_map:
            return g.cell(header)
        return F.col(f"`{header}`").cast("string") if header in present else F.lit(None).cast("string")

    return raw.select(
        *[strip(blank_to_null(column(h))).alias(name) for name, h in headers.items()],
        F.col(row).cast("bigint").alias("master_row"),
    )


def master_from_grid(
    grid: DataFrame, sheet: str, header_row: int = 6, headers: dict[str, str] = MASTER_HEADERS
) -> DataFrame:
    """Master rows of one workbook sheet; ``sheet`` is the caller's sheet name."""
    rows = g.named_rows(g.sheet_named(grid, sheet), header_row)
    return master_columns(rows, headers, "row_idx")


def measured(rows: DataFrame) -> Master:
    count, columns = measured_columns(rows)
    return Master(rows, ROW_OVERHEAD_BYTES * count + sum(columns.values()), count, columns)
