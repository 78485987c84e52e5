"""Strict dates and instants as Column functions. Parsers give null for what they do not take."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import trim_text

FIRST_YEAR, LAST_YEAR = 1990, 2100


def parse_iso_date(x: Column) -> Column:
    t = trim_text(x)
    return F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(t, "yyyy-MM-dd"))


def parse_flexible_date(x: Column, month_year: bool = False) -> Column:
    """ISO dates, the date of ISO timestamps without an offset, D.M.YYYY and D.M.YY; with month_year also M/YYYY and M/YY, as the first day."""
    t = trim_text(x)
    german = F.when(t.rlike(r"^\d{1,2}\.\d{1,2}\.\d{4}$"), F.try_to_date(t, "d.M.yyyy")).when(t.rlike(r"^\d{1,2}\.\d{1,2}\.\d{2}$"), F.try_to_date(F.regexp_replace(t, r"\.(\d{2})$", ".20$1"), "d.M.yyyy"))
    if month_year:
        day = F.concat(F.lit("1/"), t)
        german = F.coalesce(german, F.when(t.rlike(r"^\d{1,2}/\d{4}$"), F.try_to_date(day, "d/M/yyyy")).when(t.rlike(r"^\d{1,2}/\d{2}$"), F.try_to_date(F.regexp_replace(day, r"/(\d{2})$", "/20$1"), "d/M/yyyy")))
    plausible = F.when(F.year(german).between(FIRST_YEAR, LAST_YEAR), german)
    stamp = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?$"), parse_iso_date(F.substring(t, 1, 10)))
    return F.coalesce(parse_iso_date(t), stamp, plausible)


_LOCAL = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?$"


def local_to_utc(local: Column, zone: str = "Europe/Berlin") -> Column:
    """The UTC wall time of a local one; null where clocks skip or repeat it."""
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), local)
    back = lambda u: F.convert_timezone(F.lit("UTC"), F.lit(zone), u)
    hour = F.expr("interval 1 hour")
    fair = (back(utc) == local) & (back(utc - hour) != local) & (back(utc + hour) != local)
    return F.when(fair, utc)


def parse_local_timestamp(x: Column, zone: str = "Europe/Berlin") -> Column:
    """A UTC timestamp from naive local text; text with an offset, and times that are not unique, give null."""
    t = trim_text(x)
    local = F.when(t.rlike(_LOCAL), F.replace(t, F.lit(" "), F.lit("T"))).try_cast("timestamp_ntz")
    return local_to_utc(local, zone).cast("timestamp")


def parse_utc_timestamp(x: Column) -> Column:
    """A timestamp from ISO text; Z and offsets count, text without either is UTC."""
    t = trim_text(x)
    return F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?$"), t).try_cast("timestamp")


def quarter_start(x: Column) -> Column:
    return F.trunc(x.cast("date"), "quarter")


def quarter_label(x: Column) -> Column:
    return F.concat(F.date_format(x, "yyyy"), F.lit("-Q"), F.quarter(x).cast("string"))


def in_running_quarter(x: Column, as_of: Column) -> Column:
    """Whether the day lies in the quarter of as_of or later, so that its figures are not final. Null if either is."""
    return quarter_start(x) >= quarter_start(as_of)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("bigint")
