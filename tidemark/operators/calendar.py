"""Calendar dimension."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_range(sources: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One row (first, last): earliest and latest day in any of the given tables' columns.

    ``YYYY-MM`` text stands for the first day of its month. Every table is
    scanned once and reduced to one row before the union.
    """
    parts = []
    for df, columns in sources:
        types = dict(df.dtypes)
        days = [_as_day(name, types[name] == "string") for name in columns]
        lows = [F.min(day) for day in days]
        highs = [F.max(day) for day in days]
        parts.append(df.agg(_pick(F.least, lows).alias("first"), _pick(F.greatest, highs).alias("last")))
    united = reduce(DataFrame.union, parts)
    return united.agg(F.min("first").alias("first"), F.max("last").alias("last"))


def _as_day(name: str, is_text: bool) -> Column:
    return F.concat(F.col(name), F.lit("-01")).try_cast("date") if is_text else F.col(name).cast("date")


def _pick(choose, values: list[Column]) -> Column:
    return values[0] if len(values) == 1 else choose(*values)


def _number(c: Column) -> Column:
    return c.cast("long")


def build_calendar(bounds: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """A row per day of whole months between the bounds; the year of ``as_of`` when there are none."""
    today = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    year_start = F.trunc(today, "year")
    start = F.coalesce(F.trunc("first", "month"), year_start)
    end = F.coalesce(F.last_day("last"), F.date_sub(F.add_months(year_start, 12), 1))
    days = bounds.select(F.explode(F.sequence(start, end, F.expr("interval 1 day"))).alias("date"))
    day = F.col("date")
    numbers = days.select(
        day,
        _number(F.date_format(day, "yyyyMMdd")).alias("date_key"),
        _number(F.year(day)).alias("year"),
        _number(F.quarter(day)).alias("quarter_number"),
        _number(F.month(day)).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_name_short"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.date_format(day, "yyyy-MMM").alias("year_month_label"),
        _number(F.ceil(F.month(day) / 6)).alias("semester_number"),
        _number(F.ceil(F.month(day) / 2)).alias("bimester_number"),
        _number(F.weekofyear(day)).alias("week_of_year"),
        _number(F.dayofmonth(day)).alias("day"),
        _number(F.weekday(day) + 1).alias("day_of_week_number"),
        F.date_format(day, "EEEE").alias("day_of_week_name"),
    )

    def label(letter: str, name: str) -> Column:
        return F.concat(F.lit(letter), F.col(name).cast("string"))

    year = F.col("year").cast("string")
    return numbers.select(
        "date",
        "date_key",
        "year",
        "quarter_number",
        "month_number",
        "month_name",
        "month_name_short",
        "year_month",
        "year_month_label",
        "semester_number",
        label("S", "semester_number").alias("semester_label"),
        "bimester_number",
        label("B", "bimester_number").alias("bimester_label"),
        "week_of_year",
        "day",
        "day_of_week_number",
        "day_of_week_name",
        F.col("day_of_week_number").isin(6, 7).alias("is_weekend"),
        label("Q", "quarter_number").alias("quarter_label"),
        F.concat(year, F.lit("-"), label("S", "semester_number")).alias("half_year_label"),
        F.concat(year, F.lit("-"), label("B", "bimester_number")).alias("bimester_year_label"),
        year.alias("year_label"),
    )


def orphan_days(calendar: DataFrame, fact: DataFrame, day: str) -> DataFrame:
    """Fact days without a calendar row."""
    days = fact.select(F.col(day).cast("date").alias("date")).where(F.col("date").isNotNull()).distinct()
    return days.join(calendar.select("date"), "date", "left_anti")


def facts_per_calendar(calendar: DataFrame, fact: DataFrame, day: str, attributes: Sequence[str], count: str) -> DataFrame:
    """Fact rows counted per calendar attribute through the one-way date relationship.

    The fact is reduced to days before the join, so its volume never meets the
    calendar.
    """
    per_day = fact.groupBy(F.col(day).cast("date").alias("date")).agg(F.count(F.lit(1)).alias("__rows"))
    return calendar.join(per_day, "date", "inner").groupBy(*attributes).agg(F.sum("__rows").alias(count))
