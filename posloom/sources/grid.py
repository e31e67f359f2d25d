"""From a grid of cells to named columns, as column expressions.

A grid row is (sheet keys, ``row_idx``, ``cells``). A sheet's header meets its
rows in one join on the sheet keys. The header side has one row per sheet;
nothing measures it beforehand, adaptive execution sends it to all tasks when it
turns out small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posloom.sources.workbook import column_index

SHEET_KEYS = ("path", "sheet_idx")


def sheet_named(grid: DataFrame, name: str) -> DataFrame:
    """A delimited export has one sheet without a name, which is the one asked for."""
    return grid.filter((F.col("sheet_name") == name) | F.col("sheet_name").isNull())


def sheet_at(grid: DataFrame, index: int) -> DataFrame:
    """0-based; or the one sheet of a delimited export."""
    return grid.filter((F.col("sheet_idx") == index) | F.col("sheet_name").isNull())


def sheets_without(grid: DataFrame, token: str) -> DataFrame:
    """Sheets whose name does not contain ``token``."""
    return grid.filter(~F.coalesce(F.col("sheet_name"), F.lit("")).contains(token))


def positions(ranges: str) -> list[int]:
    """Column letters such as ``E:I, K:L`` as 0-based positions."""
    found: list[int] = []
    for piece in ranges.split(","):
        first, _, last = piece.strip().partition(":")
        found.extend(range(column_index(first), column_index(last or first) + 1))
    return found


def pick_positions(cells: Column, ranges: str) -> Column:
    """The cells of the listed columns; a missing cell is NULL."""
    return F.array(*[F.get(cells, F.lit(i)) for i in positions(ranges)])


def header_names(header: Column) -> Column:
    """Names as used afterwards: blanks become ``Unnamed: n``, repeats get ``.k``."""
    named = F.transform(
        header,
        lambda name, i: F.when(F.trim(name) != "", name).otherwise(
            F.concat(F.lit("Unnamed: "), i.cast("string"))
        ),
    )
    def unrepeated(name: Column, i: Column) -> Column:
        before = F.size(F.filter(F.slice(named, F.lit(1), i), lambda n: n == name))
        return F.when(before > 0, F.concat(name, F.lit("."), before.cast("string"))).otherwise(name)

    return F.transform(named, unrepeated)


def row_map(header: Column, cells: Column) -> Column:
    """Name to cell. Short rows are filled up with NULL; cells to the right of
    the header row's end stand under a blank header."""
    beyond = F.transform(
        F.sequence(F.size(header), F.size(cells) - 1),
        lambda i: F.concat(F.lit("Unnamed: "), i.cast("string")),
    )
    names = F.when(F.size(cells) <= F.size(header), header).otherwise(F.concat(header, beyond))
    values = F.transform(names, lambda _, i: F.get(cells, i))
    return F.map_from_arrays(names, values)


def complete(cells: Column) -> Column:
    """No cell is empty."""
    return F.forall(cells, lambda c: c.isNotNull())


def header_at(grid: DataFrame, row: int, keys: tuple[str, ...] = SHEET_KEYS) -> DataFrame:
    """Per sheet: the names in row ``row`` (0-based)."""
    return grid.filter(F.col("row_idx") == row).select(
        *keys, F.col("row_idx").alias("_header_row"), header_names(F.col("cells")).alias("header")
    )


def promoted_header(grid: DataFrame, keys: tuple[str, ...] = SHEET_KEYS) -> DataFrame:
    """Per sheet: the names in the first row without an empty cell.

    A row is complete only at the sheet's full width. Both are aggregates of
    numbers that are hashed and combine before the shuffle; no sheet is ever
    sorted. The cells are fetched for the rows so found.
    """
    by_width = grid.groupBy(*keys, F.size("cells").alias("_width")).agg(
        F.min(F.when(complete(F.col("cells")), F.col("row_idx"))).alias("_first")
    )
    widest = by_width.groupBy(*keys).agg(
        F.max_by("_first", "_width").alias("_header_row"), F.max("_width").alias("_width")
    )
    place = widest.filter(F.col("_header_row").isNotNull()).withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    same += [F.col("row_idx") == F.col("_header_row"), F.size("cells") == F.col("_width")]
    # Met by row, so that a long sheet spreads; with the places hashed, no rows are sorted.
    found = grid.filter(complete(F.col("cells"))).join(place.hint("shuffle_hash"), same)
    first = found.groupBy(*keys, "_header_row", "_width").agg(F.min("cells").alias("_cells"))
    return first.select(*keys, "_header_row", header_names(F.col("_cells")).alias("header"), "_width")


# A column by its name, or the last one containing a token and not another.
Wanted = str | tuple[str, str | None]


def lacking(header: Column, wanted: dict[str, Wanted]) -> Column:
    """Labels of the wanted columns that a header does not have."""
    def absent(column: Wanted) -> Column:
        if isinstance(column, tuple):
            return last_name_with(header, *column).isNull()
        return ~F.array_contains(header, column)

    return F.array_compact(F.array(*[F.when(absent(c), F.lit(label)) for label, c in wanted.items()]))


def checked(header: DataFrame, wanted: dict[str, Wanted], keys: tuple[str, ...]) -> DataFrame:
    """Headers, one row per sheet; one that lacks a wanted column fails the job by name."""
    missing = lacking(F.col("header"), wanted)
    where = F.concat_ws(" ", *[F.col(k).cast("string") for k in keys])
    message = F.concat(F.lit("layout error: sheet "), where, F.lit(" has no column "), F.array_join(missing, ", "))
    right = F.when(F.size(missing) == 0, F.col("header"))
    return header.withColumn("header", right.otherwise(F.raise_error(message).cast("array<string>")))


def named_rows(
    grid: DataFrame,
    row: int | None = 0,
    keys: tuple[str, ...] = SHEET_KEYS,
    wanted: dict[str, Wanted] | None = None,
    complete_only: bool = True,
) -> DataFrame:
    """Rows below the header as a map of name to cell.

    ``row`` is the header's row number. With None the header is the first
    complete row, and rows with an empty cell are left out as well unless
    ``complete_only`` is off. With ``wanted`` a header must have these columns.
    """
    if row is None:
        header = promoted_header(grid, keys)
    else:
        header = header_at(grid, row, keys)
    if wanted:
        header = checked(header, wanted, keys)
    below = grid.join(header, list(keys)).filter(F.col("row_idx") > F.col("_header_row"))
    if row is None:
        if complete_only:
            below = below.filter((F.size("cells") == F.col("_width")) & complete(F.col("cells")))
        below = below.drop("_width")
    return below.withColumn("row", row_map(F.col("header"), F.col("cells"))).drop(
        "cells", "_header_row"
    )


def cell(name: str, row: Column | None = None) -> Column:
    """A named cell; NULL if the sheet has no such column (see ``named_rows`` for the check)."""
    return F.try_element_at(F.col("row") if row is None else row, F.lit(name))


def last_name_with(header: Column, token: str, unless: str | None = None) -> Column:
    """The last column name containing ``token`` (and not ``unless``)."""
    def wanted(name: Column) -> Column:
        hit = name.contains(token)
        return hit & ~name.contains(unless) if unless else hit

    return F.try_element_at(F.filter(header, wanted), F.lit(-1))


def cell_with(token: str, unless: str | None = None) -> Column:
    """The cell under the last column whose name contains ``token``."""
    return F.try_element_at(F.col("row"), last_name_with(F.col("header"), token, unless))


def layout_of(
    grid: DataFrame, signatures: dict[str, tuple[int, str]], keys: tuple[str, ...] = SHEET_KEYS
) -> DataFrame:
    """Per sheet: the first layout whose signature name stands in its header row.

    ``signatures`` maps a layout to (header row, name), in order of preference.
    A sheet of no known layout fails the job by name.
    """
    candidates = grid.filter(F.col("row_idx").isin(*{r for r, _ in signatures.values()}))
    ranks = [
        F.when((F.col("row_idx") == r) & F.array_contains("cells", name), F.lit(rank))
        for rank, (r, name) in enumerate(signatures.values())
    ]
    best = candidates.groupBy(*keys).agg(F.min(F.least(*ranks, F.lit(len(ranks)))).alias("_rank"))
    names = F.array(*[F.lit(n) for n in signatures])
    unknown = F.raise_error(
        F.concat(F.lit("unknown layout: "), F.concat_ws(" ", *[F.col(k).cast("string") for k in keys]))
    )
    layout = F.when(F.col("_rank") < len(ranks), F.get(names, F.col("_rank"))).otherwise(
        unknown.cast("string")
    )
    return best.select(*keys, layout.alias("layout"))


def of_layout(
    grid: DataFrame,
    signatures: dict[str, tuple[int, str]],
    layout: str,
    keys: tuple[str, ...] = SHEET_KEYS,
) -> DataFrame:
    chosen = layout_of(grid, signatures, keys).filter(F.col("layout") == layout)
    return grid.join(chosen.drop("layout"), list(keys), "left_semi")
