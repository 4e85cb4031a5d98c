"""Two clocks: the month-rule stamp of stored texts, and the real London calendar."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules
from .base import at, blank_to_null, c, instant, let

LONDON = "Europe/London"


def normalize_uk_date(raw: str | Column) -> Column:
    """``YYYY-MM-DDTHH:MM:00`` with the month-rule offset; a bare day closes at 20:00.

    Any offset of the source is dropped and stamped anew; other texts pass through.
    """
    clock = r"(?s)^\s*(\d{4}-\d{2}-\d{2})[T ](\d{1,2}:\d{2}).*$"
    bare = r"(?i)^\s*(\d{4}-\d{2}-\d{2})(?:z|[+-]\d{2}:?\d{2})?\s*$"

    def stamp(text: Column) -> Column:
        # one replacement brings both forms to "day T time"; anything else stays as it is
        joined = F.regexp_replace(F.regexp_replace(text, clock, "$1T$2"), bare, f"$1T{rules.DEFAULT_TIME}")
        return let(joined, finish)

    def finish(t: Column) -> Column:
        summer = F.substring(t, 6, 2).between("04", "09")
        offset = F.when(summer, F.lit("+01:00")).otherwise(F.lit("+00:00"))
        time = F.lpad(F.substring(t, 12, 5), 5, "0")
        ready = t.rlike(r"^\d{4}-\d{2}-\d{2}T\d{1,2}:\d{2}$")
        return F.when(ready, F.concat(F.substring(t, 1, 11), time, F.lit(":00"), offset)).otherwise(t)

    return let(blank_to_null(raw), stamp)


def london_day(ts: str | Column) -> Column:
    """Calendar day in London of a timestamp, as ``YYYY-MM-DD``."""
    return F.date_format(F.from_utc_timestamp(c(ts), LONDON), "yyyy-MM-dd")


def uk_day_key(text: str | Column) -> Column:
    """Calendar day in London of an ISO text, NULL when blank or unreadable."""
    return london_day(instant(text))


def days_since(text: str | Column, now) -> Column:
    seconds = F.unix_timestamp(at(now)) - F.unix_timestamp(instant(text))
    return F.floor(seconds / 86400)


def closes_label(text: str | Column, now) -> Column:
    """CLOSES TONIGHT, TOMORROW or a day, by London calendar days."""
    local = F.from_utc_timestamp(instant(text), LONDON)
    gap = F.datediff(F.to_date(local), F.to_date(F.from_utc_timestamp(at(now), LONDON)))
    weekday = F.upper(F.date_format(local, "EEE"))
    day = F.upper(F.date_format(local, "d MMM"))
    return (
        F.when(gap <= 0, F.lit("CLOSES TONIGHT"))
        .when(gap == 1, F.concat(F.lit("CLOSES TOMORROW ("), weekday, F.lit(")")))
        .otherwise(F.concat(F.lit("CLOSES "), weekday, F.lit(" "), day))
    )


def long_uk_date(text: str | Column) -> Column:
    return F.date_format(F.from_utc_timestamp(instant(text), LONDON), "EEEE d MMMM yyyy")


def week_parity(day: str | Column) -> Column:
    """Whole weeks since 1 January, modulo two."""
    return F.floor((F.dayofyear(c(day)) - 1) / 7) % 2
