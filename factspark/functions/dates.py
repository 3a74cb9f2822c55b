"""Date functions. Dates stay text where the rules compare them as text."""

from __future__ import annotations

import datetime
import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(literal: Column) -> Column:
    """The first ten characters: the day of an ISO time."""
    return F.substring(literal, 1, 10)


def signed_day(time: Column) -> Column:
    """The day of a signed time, ``+2026-02-01T00:00:00Z``; the sign is dropped. Null for an empty text."""
    return F.when(time != "", F.substring(time, 2, 10))


def as_date(text: Column) -> Column:
    """A date, or null if the text is none (such as ``2026-00-00``, a year)."""
    return F.when(text.rlike(r"\A\d{4}-\d{2}-\d{2}\z"), text.try_cast("date"))


def spelled(text: Column) -> Column:
    """``22 January 1988``"""
    return F.date_format(as_date(day(text)), "d MMMM yyyy")


def settled(date: Column, run_date: Column | str) -> Column:
    """Whether the day isn't after the day of the run; null if it is no day."""
    run = F.lit(run_date) if isinstance(run_date, str) else run_date
    return as_date(day(date)) <= as_date(run)


def in_window(day: Column, first: str, last: str) -> Column:
    """Whether a day as text lies within the window, both ends included."""
    return day.between(first, last)


def moment_in_window(moment: Column, first: str, last: str, kind: str = "timestamp_ntz") -> Column:
    """The same for a time of day; as it compares the bare column, the bounds reach the scan."""
    after = (datetime.date.fromisoformat(last) + datetime.timedelta(days=1)).isoformat()
    return (moment >= F.lit(first).cast(kind)) & (moment < F.lit(after).cast(kind))


def age_on(birth: Column, event: Column) -> Column:
    """Whole years, a birthday later in the event's year not counted yet."""
    later = F.struct(F.month(event), F.day(event)) < F.struct(F.month(birth), F.day(birth))
    return F.year(event) - F.year(birth) - later.cast("int")


def age_gap(birth1: Column, birth2: Column, event: Column) -> Column:
    """The difference of the ages at the event; null if someone is born after it, or a text is no day."""
    a, b, e = as_date(birth1), as_date(birth2), as_date(event)
    return F.when((a <= e) & (b <= e), F.abs(age_on(a, e) - age_on(b, e)))


def start_of(target_time: str) -> str:
    """The first day of a year, a month or a day; ``ValueError`` if it is none of them."""
    found = re.fullmatch(r"([0-9]{4})(?:-([0-9]{2}))?(?:-([0-9]{2}))?", target_time.strip())
    if not found:
        raise ValueError(f"{target_time!r} isn't of the form YYYY, YYYY-MM or YYYY-MM-DD")
    return datetime.date(*(int(x or 1) for x in found.groups())).isoformat()
