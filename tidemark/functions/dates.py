"""Date columns: zone-free parsing, calendar differences, month keys.

Parsed values are ``timestamp_ntz``: they carry wall-clock time and never
depend on the session zone. One pattern decides which shape a text has, so at
most one parser runs per row, and an impossible date is NULL instead of an
error. Parsers are kept short: together they must stay within what the JVM
compiles as one generated method.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import as_text, col, nullif_trim_text

CLOCK = r"(0?[1-9]|1[0-2]):[0-5]?\d (AM|PM)"
ISO_SHAPE = r"^\d{4}(-\d{1,2}(-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,9})?)?( ?UTC|Z)?)?)?)?$"
US_SHAPE = rf"(?i)^\d{{1,2}}/\d{{1,2}}/\d{{2}}, {CLOCK}$"
US_ANY_SHAPE = rf"(?i)^\d{{1,2}}/\d{{1,2}}/(\d{{2}}|\d{{4}})(,? {CLOCK})?$"
MONTH_FIRST_AT = rf"(?i)^[a-z]{{3,9}} \d{{1,2}}, \d{{4}} {CLOCK}$"
NAMED_SHAPE = rf"(?i)^((\d{{1,2}} )?[a-z]{{3,9}} \d{{4}}|[a-z]{{3,9}} \d{{1,2}}, \d{{4}}( {CLOCK})?)$"


_MONTHS = "jan,feb,mar,apr,may,jun,jul,aug,sep,oct,nov,dec"


def _day(year: Column, month: Column, day: Column) -> Column:
    """Midnight of a day given by numbers, which costs less than a parser; NULL if there is none."""
    none = F.lit(0)
    return F.try_make_timestamp_ntz(year, month, day, none, none, none.cast("decimal(16,6)"))


def _named_day(c: Column) -> Column:
    """``05 Jan 2020``, ``Jan 2020`` or ``January 5, 2020`` in the first words of a text."""
    first = F.substring_index(c, " ", 1)
    second = F.substring_index(F.substring_index(c, " ", 2), " ", -1)
    day_first = first < "A"
    month = F.find_in_set(F.lower(F.left(F.when(day_first, second).otherwise(first), F.lit(3))), F.lit(_MONTHS))
    day = F.when(day_first, first).when(F.right(second, F.lit(1)) == ",", F.substring_index(second, ",", 1)).otherwise("1")
    year = F.substring_index(F.substring_index(c, " ", 3), " ", -1)
    return _day(year.cast("int"), month, day.cast("int"))


def _clock(c: Column) -> Column:
    """The time of day of a text ending in ``h:mm AM``, as an interval."""
    clock = F.substring_index(c, " ", -2)
    hour = F.substring_index(clock, ":", 1).cast("int") % 12
    minute = F.substr(F.substring_index(clock, ":", -1), F.lit(1), F.lit(2)).cast("int")
    afternoon = F.when(F.upper(F.right(c, F.lit(2))) == "PM", 12).otherwise(0)
    return F.make_dt_interval(F.lit(0), hour + afternoon, minute)


def _us_day(c: Column) -> Column:
    """``M/d/yy`` or ``M/d/yyyy``; of two digits 69..99 belong to the 1900s, 00..68 to the 2000s."""
    year = F.substring_index(c, "/", -1)
    century = F.when(F.length(year) > 2, 0).when(year >= "69", 1900).otherwise(2000)
    day = F.substring_index(F.substring_index(c, "/", 2), "/", -1)
    return _day(year.cast("int") + century, F.substring_index(c, "/", 1).cast("int"), day.cast("int"))


def parse_us_datetime(c: Column | str) -> Column:
    """``04/05/26, 09:15 AM``; anything else is NULL."""
    text = as_text(c)
    return F.when(text.rlike(US_SHAPE), _us_day(F.substring_index(text, ",", 1)) + _clock(text))


def parse_month_name_datetime(c: Column | str) -> Column:
    """``Apr 10, 2025 08:00 AM``; anything else is NULL."""
    text = as_text(c)
    return F.when(text.rlike(MONTH_FIRST_AT), _named_day(text) + _clock(text))


def split_range(c: Column | str, separator: str = " - ") -> tuple[Column, Column]:
    """Both ends of ``"a - b"``; the second is NULL without a separator."""
    parts = F.split(as_text(c), separator, 2)
    return F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2))


def parse_mixed(c: Column | str) -> Column:
    """The documented list of date shapes; unknown text is NULL.

    ISO date, month, year or date-time (optional ``T``, fraction, trailing
    UTC), ``dd MMM yyyy``, ``MMM yyyy``, ``MMM d, yyyy [h:mm a]``,
    ``M/d/yy[, h:mm a]`` and ``M/d/yyyy[ h:mm a]``. The text must already be
    stripped; see ``parse_date_columns``.
    """
    text = as_text(c)
    clock = F.when(F.upper(F.right(text, F.lit(2))).isin("AM", "PM"), _clock(text)).otherwise(F.make_dt_interval())
    us_text = F.substring_index(F.substring_index(text, ",", 1), " ", 1)
    day = F.when(text.rlike(NAMED_SHAPE), _named_day(text)).when(text.rlike(US_ANY_SHAPE), _us_day(us_text))
    iso = F.substring_index(text, "UTC", 1).try_cast("timestamp_ntz")
    return F.when(text.rlike(ISO_SHAPE), iso).otherwise(day + clock)


def to_date(c: Column | str) -> Column:
    """Date of ISO text; blank text is NULL."""
    return nullif_trim_text(c).cast("date")


def to_timestamp(c: Column | str) -> Column:
    return nullif_trim_text(c).cast("timestamp_ntz")


def year_of(c: Column | str) -> Column:
    return F.year(col(c)).cast("long")


def month_of(c: Column | str) -> Column:
    return F.month(col(c)).cast("long")


def year_month(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM")


def year_month_from_parts(year: Column | str, month: Column | str) -> Column:
    return F.concat(F.lpad(as_text(year), 4, "0"), F.lit("-"), F.lpad(as_text(month), 2, "0"))


def months_between(start: Column | str, end: Column | str) -> Column:
    """Calendar month boundaries crossed, not elapsed months: 31 Jan to 1 Feb is 1."""
    return (F.year(col(end)) * 12 + F.month(col(end)) - F.year(col(start)) * 12 - F.month(col(start))).cast("long")


def years_between(start: Column | str, end: Column | str) -> Column:
    return (F.year(col(end)) - F.year(col(start))).cast("long")


def month_end(ym: Column | str) -> Column:
    return F.last_day(F.concat(col(ym), F.lit("-01")).cast("date"))


def month_start(c: Column | str) -> Column:
    return F.trunc(col(c).cast("date"), "month")


def as_of_column(as_of: dt.date | str | None) -> Column:
    """The day open periods are measured to; today unless pinned."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
