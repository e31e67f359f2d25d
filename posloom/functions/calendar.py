"""Sales weeks run Monday to Sunday and are named by their Saturday."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def previous_week_saturday(d: Column) -> Column:
    """Saturday of the Monday-to-Sunday week before the one holding ``d``."""
    return F.date_add(F.trunc(F.date_sub(d, 7), "week"), 5)


def week_saturday(d: Column) -> Column:
    """Saturday of the Monday-to-Sunday week holding ``d``."""
    return F.date_add(F.trunc(d, "week"), 5)


def roll_to_saturday(d: Column) -> Column:
    """``d`` itself on a Saturday, else the next Saturday."""
    return F.next_day(F.date_sub(d, 1), "SAT")


def previous_week_start(d: Column) -> Column:
    return F.date_sub(F.trunc(d, "week"), 7)


def previous_week_end(d: Column) -> Column:
    return F.date_sub(F.trunc(d, "week"), 1)


def year_of(d: Column) -> Column:
    return F.year(d).cast("int")


def quarter_of(d: Column) -> Column:
    return F.quarter(d).cast("int")


def us_date(text: Column) -> Column:
    """``MM-dd-yyyy`` text as a date; other text is NULL."""
    return F.try_to_timestamp(text, F.lit("MM-dd-yyyy")).cast("date")


def week_values(run_date: dt.date) -> tuple[dt.date, int, int]:
    """Week ending, year and quarter of the week ending, for one run date."""
    monday = run_date - dt.timedelta(days=7 + run_date.weekday())
    saturday = monday + dt.timedelta(days=5)
    return saturday, saturday.year, (saturday.month - 1) // 3 + 1
