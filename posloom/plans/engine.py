"""One account from raw rows to outcomes, as one lazy plan.

``run_account`` reads top to bottom: conform the feed, match it to the master,
lay out the outcome. Final rows, exceptions and control totals are filters and
aggregates of that one outcome table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posloom.functions import conditions as cond
from posloom.functions import numbers as num
from posloom.functions.calendar import week_values
from posloom.functions.text import strip
from posloom.operators import control, dedup, fanout
from posloom.operators.filters import drop_last_row
from posloom.operators.lookup import fan_out_join, first_match, lookup, null_key_once
from posloom.plans.master import Master
from posloom.plans.spec import ASIDE, REFERENCE, STRICT, AccountSpec, Containing, Pass, SetAside
from posloom.schema import CANONICAL, EXCEPTION, FINAL, MONEY, OUTCOME, SOURCE_ORDER
from posloom.sources import grid as g

NUMERIC = ("decimal", "double", "float", "integer", "long", "short", "byte")


@dataclass(frozen=True)
class AccountResult:
    """``rows`` holds every outcome; the rest are views of it."""

    spec: AccountSpec
    feed: DataFrame
    rows: DataFrame

    @property
    def final(self) -> DataFrame:
        return final_rows(self.rows)

    @property
    def exceptions(self) -> DataFrame:
        return exception_rows(self.rows)

    @property
    def control(self) -> DataFrame:
        return control.control_totals(self.rows.filter(F.col("outcome") == FINAL))


def final_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("outcome") == FINAL).select(*CANONICAL)


def exception_rows(rows: DataFrame) -> DataFrame:
    blank = ("ItemID", "ItemNumber", "MainlinePremium")
    kept = [c for c in CANONICAL if c not in blank]
    return rows.filter(F.col("outcome") == EXCEPTION).select(
        *[c for c in SOURCE_ORDER if c in rows.columns], *kept, "reason"
    )


def run_account(
    spec: AccountSpec,
    rows: DataFrame,
    master: Master,
    run_date: dt.date,
    mode: str = STRICT,
    watch: Callable[[DataFrame], DataFrame] | None = None,
) -> AccountResult:
    """``watch`` may count the feed as it passes by. ``rows`` are named rows of a sheet (see ``sources.grid``) or a wide table
    with the raw headers, either with the ``src_`` columns that order it."""
    if mode not in (STRICT, REFERENCE):
        raise ValueError(f"mode must be {STRICT!r} or {REFERENCE!r}: {mode!r}")
    feed = conform(spec, rows, mode)
    if watch:
        feed = watch(feed)
    if mode == STRICT:
        matched = match_strict(spec, feed, master)
    else:
        matched = match_reference(spec, feed, master, ungrouped(spec, rows, mode))
    return AccountResult(spec, feed, lay_out(spec, matched, run_date, mode))


def account_sheet(spec: AccountSpec, grid: DataFrame) -> DataFrame:
    """The cells of the account's sheet and columns."""
    layout = spec.layout
    if layout.sheet_name is not None:
        grid = g.sheet_named(grid, layout.sheet_name)
    elif layout.sheet_idx is not None:
        grid = g.sheet_at(grid, layout.sheet_idx)
    if layout.columns:
        grid = grid.withColumn("cells", g.pick_positions(F.col("cells"), layout.columns))
    return grid


def wanted_columns(spec: AccountSpec) -> dict[str, g.Wanted]:
    """Name, or token, of each raw column of the account and how to know it.

    A column without a name of its own is not asked for: it has no header cell.
    """
    return {
        (s.token if isinstance(s, Containing) else s): ((s.token, s.unless) if isinstance(s, Containing) else s)
        for s in spec.columns.values()
        if isinstance(s, Containing) or not s.startswith("Unnamed: ")
    }


def layout_errors(spec: AccountSpec, grid: DataFrame) -> DataFrame:
    """A row per file and thing its sheet lacks: the sheet, its header row, a column."""
    layout = spec.layout
    sheet = account_sheet(spec, grid)
    header = g.promoted_header(sheet) if layout.header_row is None else g.header_at(sheet, layout.header_row)
    lacking = g.lacking(F.col("header"), wanted_columns(spec))
    where = layout.sheet_name if layout.sheet_name is not None else f"number {layout.sheet_idx}"
    problem = F.when(F.col("header").isNull(), F.array(F.lit(f"no sheet {where} with a header row"))).otherwise(
        F.transform(lacking, lambda name: F.concat(F.lit("no column "), name))
    )
    found = grid.select("path").distinct().join(header.drop("_width"), "path", "left")
    return found.select("path", F.lit(spec.name).alias("account"), F.explode(problem).alias("problem"))


def sheet_rows(spec: AccountSpec, grid: DataFrame, mode: str = STRICT) -> DataFrame:
    """The account's named rows out of a workbook grid; a sheet without one of
    its columns fails by name. In strict mode rows with empty cells stay."""
    layout = spec.layout
    grid = account_sheet(spec, grid)
    named = g.named_rows(grid, layout.header_row, wanted=wanted_columns(spec), complete_only=mode == REFERENCE)
    return named.withColumns(
        {"src_file": F.col("path"), "src_sheet": F.col("sheet_idx"), "src_row": F.col("row_idx")}
    )


def conform(spec: AccountSpec, rows: DataFrame, mode: str = STRICT) -> DataFrame:
    """The feed as it is matched: typed, filtered, derived and grouped."""
    feed = ungrouped(spec, rows, mode)
    if spec.group_by:
        alone = []
        if ASIDE in feed.columns:
            # A row set aside stays by itself.
            row = F.col("src_row") if "src_row" in feed.columns else F.lit(0)
            feed = feed.withColumn("_alone", F.when(F.col(ASIDE).isNotNull(), row))
            alone = [ASIDE, "_alone"]
        # Each file is grouped by itself: it is judged and published by itself.
        by_file = [c for c in ("src_file",) if c in feed.columns]
        source_columns = [c for c in SOURCE_ORDER if c in feed.columns and c not in by_file]
        feed = control.pre_aggregate(
            feed,
            [*by_file, *alone, *spec.group_by],
            ["POSAmount", "POSQuantity"],
            **{c: F.min(c) for c in source_columns},
        ).withColumns({"POSAmount": F.col("POSAmount").cast(MONEY), "POSQuantity": F.col("POSQuantity").cast("bigint")}).drop("_alone")
    return feed


def ungrouped(spec: AccountSpec, rows: DataFrame, mode: str = STRICT) -> DataFrame:
    """Typed feed columns under their common names, filtered and derived."""
    keys = {p.feed_key for p in spec.passes}
    if spec.drops_last_row:
        sheet = [c for c in ("src_file", "src_sheet") if c in rows.columns]
        rows = drop_last_row(rows, sheet, "src_row")
    columns = {}
    for name, source in spec.columns.items():
        value, is_text = _raw(rows, source)
        if name in spec.money_columns:
            columns[name] = num.money(value, is_text)
        elif name == "POSQuantity":
            columns[name] = num.money(value) if is_text else value
        else:
            shown = value if is_text else value.cast("string")
            columns[name] = strip(shown) if name in keys else shown
    source_columns = [c for c in SOURCE_ORDER if c in rows.columns]
    if mode == STRICT:
        aside = _aside(spec, rows)
        numbers = {*spec.money_columns, *spec.dashed_numbers, "POSQuantity"} & set(spec.columns)
        if any(_raw(rows, spec.columns[name])[1] for name in numbers):
            # Cells are judged once, here: without this every later use of the
            # reason, in filters and in the outcome, would parse them again.
            aside = F.when(F.monotonically_increasing_id() >= 0, aside)
        feed = rows.select(*source_columns, *[c.alias(n) for n, c in columns.items()], aside.alias(ASIDE))
        if spec.layout.header_row is None:
            told = [F.col(f"`{n}`").isNotNull() for n in columns]
            feed = feed.filter(_any(told))  # a row without any cell the account asks for is no sale
        feed = spec.prepare(SetAside(feed), mode).df
    else:
        if spec.layout.header_row is None and "row" not in rows.columns:
            # As when its header is promoted: a row with an empty cell is no data.
            rows = rows.na.drop("any", subset=[c for c in rows.columns if c not in SOURCE_ORDER])
        feed = rows.select(*source_columns, *[c.alias(n) for n, c in columns.items()])
        feed = spec.prepare(feed, mode)
    if spec.group_by and mode == REFERENCE:
        # Grouping loses rows with a NULL key there.
        feed = feed.na.drop("any", subset=list(spec.group_by))
    return feed.withColumn("POSQuantity", num.whole(F.col("POSQuantity")))


def _aside(spec: AccountSpec, rows: DataFrame) -> Column:
    """Why a row cannot be judged: a cell that is no number, or a missing one; else NULL.

    Where the header is the first complete row, a sale has all the cells that
    the account asks for; only these are read.
    """
    reason = F.lit(None).cast("string")
    if spec.layout.header_row is None:
        empty = _any([_raw(rows, source)[0].isNull() for source in spec.columns.values()])
        reason = F.when(empty, "incomplete_row")
    checks = [(n, "bad_quantity" if n == "POSQuantity" else "bad_amount", False) for n in spec.money_columns]
    checks += [(n, why, True) for n, why in spec.dashed_numbers.items()]
    if "POSQuantity" in spec.columns and "POSQuantity" not in spec.money_columns:
        checks.append(("POSQuantity", "bad_quantity", False))
    for name, why, dash in checks:
        value, is_text = _raw(rows, spec.columns[name])
        bad = num.unreadable(value, is_text, dash)
        if why == "bad_quantity":
            bad = bad | F.coalesce(num.beyond_whole(value), F.lit(False))
        reason = F.when(bad, why).otherwise(reason)
    return reason


def _raw(rows: DataFrame, source: str | Containing) -> tuple[Column, bool]:
    """A raw cell and whether it is text."""
    if "row" in rows.columns:
        if isinstance(source, Containing):
            return g.cell_with(source.token, source.unless), True
        return g.cell(source), True
    if isinstance(source, Containing):
        named = [
            c
            for c in rows.columns
            if source.token in c and not (source.unless and source.unless in c)
        ]
        if not named:
            raise ValueError(f"no column contains {source.token!r}")
        source = named[-1]
    is_text = rows.schema[source].dataType.typeName() not in NUMERIC
    return F.col(f"`{source}`"), is_text


def _dimension(master: DataFrame, step: Pass, number: int) -> DataFrame:
    """The key of a pass and, as one struct, what a match brings along.

    The brand tier and the flag are settled here, once per item, not per sale.
    """
    return master.select(
        F.col(step.master_key).alias(f"m{number}_key"),
        F.struct(
            F.col("item_number"),
            cond.brand_tier(F.col("short_brand")).alias("tier"),
            F.col(step.flag).isNotNull().alias("flagged"),
            F.col("master_row"),
        ).alias(f"m{number}"),
    )


TIER_AND_FLAG = 3 * 8  # bytes a row: two cells, one with a tier's name


def _dimension_bytes(master: Master, step: Pass) -> int:
    """Size of what a pass sends: its key, the item and its row, tier and flag."""
    return master.bytes_of(step.master_key, "item_number", "master_row", derived=TIER_AND_FLAG)


def _first_dimension(master: Master, step: Pass, number: int, prefer_flagged: bool) -> DataFrame:
    row = F.col("master_row")
    order = [F.col(step.flag).isNull(), row] if prefer_flagged else [row]
    return _dimension(first_match(master.rows, step.master_key, order), step, number)


def _hit(number: int) -> Column:
    """Did pass ``number`` find an item with its flag filled? Never NULL."""
    return F.coalesce(F.col(f"m{number}.flagged"), F.lit(False))


def match_strict(spec: AccountSpec, feed: DataFrame, master: Master) -> DataFrame:
    """One outcome per feed row; a NULL key matches nothing.

    Each pass joins the first master row per key, so nothing fans out and no
    feed row is ever dropped. A later pass asks only for rows still unmatched:
    the others carry a NULL key and find nothing.
    """
    matched = feed
    numbers = range(1, len(spec.passes) + 1)
    for number, step in zip(numbers, spec.passes):
        dim = _first_dimension(master, step, number, spec.prefer_flagged)
        key = step.feed_key
        if number > 1:
            key = f"_key{number}"
            still_open = ~_any([_hit(n) for n in range(1, number)])
            matched = matched.withColumn(key, F.when(still_open, F.col(step.feed_key)))
        matched = lookup(matched, dim, [(key, f"m{number}_key")], dim_bytes=_dimension_bytes(master, step))
    return _decide(matched, feed.columns, list(numbers))


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _decide(matched: DataFrame, feed_columns: list[str], passes: list[int]) -> DataFrame:
    """The feed with item, tier and outcome: those of the first pass that hit."""
    choice = reduce(
        lambda rest, n: F.when(_hit(n), F.struct(F.lit(n).alias("number"), f"m{n}.item_number", f"m{n}.tier"))
        .otherwise(rest),
        passes[::-1],
        F.lit(None),
    )
    found = _any([F.col(f"m{n}").isNotNull() for n in passes])
    aside = F.col(ASIDE) if ASIDE in feed_columns else F.lit(None).cast("string")
    choice = F.when(aside.isNull(), choice)
    chosen = matched.select(*feed_columns, choice.alias("hit"), found.alias("found"))
    is_final = F.col("hit").isNotNull()
    return chosen.select(
        *feed_columns,
        F.col("hit.item_number").alias("item_number"),
        F.col("hit.tier").alias("tier"),
        F.when(is_final, FINAL).otherwise(EXCEPTION).alias("outcome"),
        F.when(~is_final, F.coalesce(aside, F.when(F.col("found"), "null_flag").otherwise("no_key"))).alias("reason"),
        F.col("hit.number").alias("match_pass"),
    )


def match_reference(
    spec: AccountSpec, feed: DataFrame, master: Master, flag_feed: DataFrame | None = None
) -> DataFrame:
    """Outcomes of a plain merge: a NULL key matches the first master row without
    a key, repeated master keys multiply rows, and duplicates go only where the
    account says so.

    ``flag_feed`` has the same keys and amount totals as the feed but may be
    cheaper to read; the question whether duplicates go is put to it.
    """
    joined = _first_pass(spec, feed, master, feed if flag_feed is None else flag_feed)
    if len(spec.passes) == 1:
        return _decide(joined, feed.columns, [1])

    done = _decide(joined.filter(_hit(1)), feed.columns, [1])
    if spec.appends_unmatched:
        done = done.withColumn("item_number", F.lit(None).cast("string"))
    step = spec.passes[1]
    retried = fan_out_join(
        joined.filter(~_hit(1)).select(*feed.columns),
        _dimension(null_key_once(master.rows, step.master_key), step, 2),
        [(step.feed_key, "m2_key")],
        master_bytes=_dimension_bytes(master, step),
    )
    again = _decide(retried, feed.columns, [2])
    if spec.appends_unmatched:
        again = again.unionByName(_appended(retried, feed.columns))
    for column in spec.second_pass_blanks:
        again = again.withColumn(column, F.when(F.col("outcome") == EXCEPTION, F.col(column)))
    return done.unionByName(again)


def _appended(retried: DataFrame, feed_columns: list[str]) -> DataFrame:
    """Rows the second pass did not match, as final rows all the same."""
    return retried.filter(~_hit(2)).select(
        *feed_columns,
        F.col("m2.item_number").alias("item_number"),
        F.coalesce(F.col("m2.tier"), cond.brand_tier(F.lit(None).cast("string"))).alias("tier"),
        F.lit(FINAL).alias("outcome"),
        F.lit(None).cast("string").alias("reason"),
        F.lit(None).cast("int").alias("match_pass"),
    )


def _first_pass(
    spec: AccountSpec, feed: DataFrame, master: Master, flag_feed: DataFrame
) -> DataFrame:
    """The first merge with its duplicate handling.

    Where duplicates are dropped by feed columns, "merge, keep first" equals
    "keep first of the feed, look up the first master row", which never
    multiplies anything. The plain merge is left for the cases that keep
    every copy.
    """
    step = spec.passes[0]
    on = [(step.feed_key, "m1_key")]
    keys = list(spec.dedup_keys)
    order = [c for c in spec.dedup_order or SOURCE_ORDER if c in feed.columns]

    items = null_key_once(master.rows, step.master_key)
    size = _dimension_bytes(master, step)
    key_size = master.bytes_of(step.master_key, derived=8)  # a key and its number of rows

    def plain(part: DataFrame) -> DataFrame:
        return fan_out_join(part, _dimension(items, step, 1), on, master_bytes=size)

    def single(part: DataFrame) -> DataFrame:
        dim = _first_dimension(master, step, 1, prefer_flagged=False)
        return lookup(part, dim, on, null_safe=True, dim_bytes=size)

    def kept_first(part: DataFrame) -> DataFrame:
        if set(keys) <= set(feed.columns):
            return single(dedup.first_per_key(part, keys, order))
        return dedup.first_per_key(single(part), keys, order)

    if spec.dedup == "none":
        return plain(feed)
    if spec.dedup == "always":
        return kept_first(feed)
    if spec.dedup == "final":
        joined = plain(feed)
        once = dedup.first_per_key(joined.filter(_hit(1)), keys, [*order, "m1.master_row"])
        return once.unionByName(joined.filter(~_hit(1)))
    # Whether duplicates go is a scalar subquery of the plan: the same rows then
    # go through one keep-first and one join, steered by it.
    in_feed = set(keys) <= set(feed.columns)
    if spec.dedup == "rows":
        flag = fanout.rows_multiply(
            flag_feed, items, step.feed_key, step.master_key, master_bytes=key_size
        )
        if in_feed:
            return single(dedup.first_per_key_if(feed, flag, keys, order))
        return dedup.first_per_key_if(single(feed), flag, keys, order)
    flag = fanout.amount_changes(
        flag_feed, items, step.feed_key, step.master_key, master_bytes=key_size
    )
    steered = dedup.first_per_key_if(items, flag, [step.master_key], ["master_row"])

    def joined_to(part: DataFrame) -> DataFrame:
        return fan_out_join(part, _dimension(steered, step, 1), on, master_bytes=size)

    if in_feed:
        return joined_to(dedup.first_per_key_if(feed, flag, keys, order))
    return dedup.first_per_key_if(joined_to(feed), flag, keys, order)


def lay_out(
    spec: AccountSpec, matched: DataFrame, run_date: dt.date, mode: str = STRICT
) -> DataFrame:
    """The canonical columns with where the row came from and what became of it."""
    is_final = F.col("outcome") == FINAL
    have = set(matched.columns)
    nothing = F.lit(None).cast("string")

    def feed_column(name: str) -> Column:
        fed = F.col(name) if name in have else nothing
        if name in spec.constants:
            return F.when(is_final, F.lit(spec.constants[name])).otherwise(fed)
        return fed

    week = None if mode == REFERENCE and not spec.stamps_week else week_values(run_date)[0]
    values = {
        "AccountMajor": F.lit(spec.account_major),
        "Account": feed_column("Account") if spec.account is None else F.lit(spec.account),
        "BricksClicks": feed_column("BricksClicks") if spec.channel is None else F.lit(spec.channel),
        "ItemID": F.when(is_final, F.lit("")),
        "ItemNumber": F.when(is_final, F.col("item_number")),
        "MainlinePremium": F.when(is_final, F.col("tier")),
        "POSAmount": F.col("POSAmount"),
        "POSQuantity": F.col("POSQuantity"),
        "WeekEnding": F.lit(week).cast("date"),
    }
    return matched.select(
        *[c for c in SOURCE_ORDER if c in have],
        *[(values[c] if c in values else feed_column(c)).alias(c) for c in CANONICAL],
        *OUTCOME,
    ).withColumn("counted", F.when(F.col(spec.counted).isNotNull(), 1))
