"""Date expressions and the refresh-window rule."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesabc import config
from salesabc.functions.text import strip

# Day-first and ISO dates, each with an optional time (seconds, fractions and a zone may follow).
_TIME = r"(?:[ T]+(?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:[.,]\d+)?)?\s*(?:Z|[+-]\d{2}:?\d{2})?)?"
DAY_FIRST = r"^(\d{1,2})/(\d{1,2})/(\d{4})" + _TIME + "$"
YEAR_FIRST = r"^(\d{4})-(\d{1,2})-(\d{1,2})" + _TIME + "$"


def parse_sheet_date(c: Column) -> Column:
    """Text -> date: day first with slashes or ISO, with or without padding and time; unreadable -> null.

    The date is taken as written, without a zone shift.  One pattern decides
    on the form, so a value is parsed once.
    """
    txt = strip(c.cast("string"))

    def part(pattern: str, i: int) -> Column:
        return F.lpad(F.regexp_extract(txt, pattern, i), 2, "0")

    iso = (F.when(txt.rlike(DAY_FIRST), F.concat_ws("-", F.regexp_extract(txt, DAY_FIRST, 3), part(DAY_FIRST, 2), part(DAY_FIRST, 1)))
            .when(txt.rlike(YEAR_FIRST), F.concat_ws("-", F.regexp_extract(txt, YEAR_FIRST, 1), part(YEAR_FIRST, 2), part(YEAR_FIRST, 3))))
    return F.to_date(F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")))


def iso_wall_date(c: Column) -> Column:
    """Date as written in an ISO-8601 text with offset (no zone shift)."""
    return F.to_date(F.try_to_timestamp(F.substring(c, 1, 10), F.lit("yyyy-MM-dd")))


def iso_wall_time(c: Column) -> Column:
    """HH:MM:SS as written in an ISO-8601 text, seconds 00 if it has none; '' without a time."""
    pattern = r"^.{10}[T ](\d{2}:\d{2})(:\d{2})?"
    seconds = F.regexp_extract(c, pattern, 2)
    return F.when(c.rlike(pattern), F.concat(F.regexp_extract(c, pattern, 1), F.when(seconds == "", ":00").otherwise(seconds))).otherwise(F.lit(""))


def month_key(d: Column) -> Column:
    """Sortable month 'yyyy-MM'."""
    return F.date_format(d, "yyyy-MM")


def month_label(d: Column) -> Column:
    """'MM/<month name>/YYYY' with the fixed Portuguese names."""
    names = F.array(*[F.lit(n) for n in config.MONTH_NAMES_PT])
    label = F.concat_ws("/", F.date_format(d, "MM"), F.element_at(names, F.month(d)),
                        F.date_format(d, "yyyy"))
    return F.when(d.isNotNull(), label)


def refresh_window(as_of: dt.date, has_current_sheet: bool) -> tuple[dt.date, dt.date]:
    """Days the order feed re-reads for a run on ``as_of``.

    Day 1: only that day (last month's sheet is complete).  Other days
    with a sheet for the month: yesterday and today (removed from the
    sheet).  Without a sheet: the month so far.
    """
    if as_of.day == 1:
        return as_of, as_of
    if has_current_sheet:
        return as_of - dt.timedelta(days=1), as_of
    return as_of.replace(day=1), as_of
