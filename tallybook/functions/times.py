"""Date arithmetic on zone-free timestamps; none of it depends on the session's time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F


def moment(at: datetime) -> Column:
    """A zone-free constant; a plain literal would be read in the session's zone."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


_ISO = r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?)$"


def parse_iso(text: Column) -> Column:
    """ISO text, with a ``T`` or a blank between date and time, to a zone-free timestamp.

    Seconds may be missing or have up to six digits of a fraction; what is no such time is NULL.
    """
    return F.when(F.rlike(text, F.lit(_ISO)), F.regexp_replace(text, _ISO, "$1 $2")).try_cast("timestamp_ntz")


def iso_text(at: Column) -> Column:
    """ISO text; a fraction of a second shows as six digits, and only if there is one."""
    return F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.date_format(at, "SSSSSS") != "000000", F.date_format(at, ".SSSSSS")).otherwise(""))


def year_text(at: Column) -> Column:
    return F.lpad(F.year(at).cast("string"), 4, "0")


def month_text(at: Column) -> Column:
    return F.lpad(F.month(at).cast("string"), 2, "0")


def _second_of_day(at: Column) -> Column:
    return F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)


def days_between(earlier: Column, later: Column) -> Column:
    """Days with a fraction, down to the second."""
    whole = F.date_diff(F.to_date(later), F.to_date(earlier))
    return whole + (_second_of_day(later) - _second_of_day(earlier)) / 86400.0


def months_30d(earlier: Column, later: Column) -> Column:
    """Whole months counted as 30 days each, rounded; not calendar months."""
    return F.round(days_between(earlier, later) / 30.0)
