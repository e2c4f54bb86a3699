"""Calendar expressions: ISO weeks, date parts, tolerant parsing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_date(text: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Text to date; anything unreadable becomes null instead of failing."""
    return F.try_to_date(F.trim(text), fmt)


def iso_year_week(date: Column) -> Column:
    """ISO label such as ``2022-W52`` (ISO year, so 2023-01-01 is 2022-W52)."""
    week = F.lpad(F.weekofyear(date).cast("string"), 2, "0")
    return F.concat(F.extract(F.lit("YEAROFWEEK"), date).cast("string"), F.lit("-W"), week)


def iso_week_start(date: Column) -> Column:
    """Monday of the date's ISO week."""
    return F.date_sub(date, F.weekday(date))


def week_label_to_monday(label: Column) -> Column:
    """``YYYY-Www`` back to its Monday: 4 January always lies in week 1."""
    year = F.substring(label, 1, 4).cast("int")
    week = F.substring(label, 7, 2).cast("int")
    return F.date_add(iso_week_start(F.make_date(year, F.lit(1), F.lit(4))), (week - 1) * 7)


def date_parts(date: Column) -> dict[str, Column]:
    """The seven calendar columns every cleaned table carries."""
    weekday = F.weekday(date).cast("int")
    return {
        "year": F.year(date).cast("int"),
        "month": F.month(date).cast("int"),
        "quarter": F.quarter(date).cast("int"),
        "week_number": F.weekofyear(date).cast("int"),
        "day_of_week": weekday,
        "year_week": iso_year_week(date),
        "is_weekend": (weekday >= 5).cast("int"),
    }


def inclusive_days(start: Column, end: Column) -> Column:
    return F.datediff(end, start) + 1
