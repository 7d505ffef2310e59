"""ISO weeks written as the number YYYYWW, as columns and as plain numbers."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_of(day: Column) -> Column:
    """YYYYWW of a date."""
    return (F.extract(F.lit("YEAROFWEEK"), day) * 100 + F.weekofyear(day)).cast("int")


def monday_of(week: Column) -> Column:
    # 4 January always lies in week 1
    fourth = F.make_date(F.floor(week / 100).cast("int"), F.lit(1), F.lit(4))
    days = F.weekday(fourth) - 7 * (F.pmod(week, F.lit(100)) - 1)
    return F.date_sub(fourth, days.cast("int"))


def shift_week(week: Column, back: Column | int) -> Column:
    """Week ``back`` weeks earlier (later if negative)."""
    back = back if isinstance(back, Column) else F.lit(back)
    return week_of(F.date_sub(monday_of(week), (back * 7).cast("int")))


def midweek_day(week: Column) -> Column:
    """Friday of the week, the day inventories are taken as of."""
    return F.date_add(monday_of(week), 4)


def week_before(week: int, back: int) -> int:
    """``shift_week`` for a number known while the plan is built, so filters stay literal."""
    monday = date.fromisocalendar(week // 100, week % 100, 1) - timedelta(weeks=back)
    year, number, _ = monday.isocalendar()
    return year * 100 + number


def midweek_date(week: int) -> date:
    return date.fromisocalendar(week // 100, week % 100, 5)


def rebase_week(week: Column, year: int) -> Column:
    """Put the week number of ``week`` into ``year``."""
    return (F.lit(year * 100) + F.pmod(week, F.lit(100))).cast("int")
