"""Date parsing, zones and default bounds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First day with measurements, and the zone calendar dates are taken in.
EPOCH = "2020-02-23"
ZONE = "Europe/Vatican"

# The date layouts of the landed files.
DAY_FIRST = ("dd/MM/yyyy", "dd/MM/yy")
ISO_DAY = ("yyyy-MM-dd",)
STATION_STAMP = ("HH:mm:ss dd/MM/yyyy",)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c: Column | str, *formats: str) -> Column:
    """First layout that parses wins; text no layout fits becomes NULL."""
    return F.coalesce(*[F.try_to_timestamp(_col(c), F.lit(f)) for f in formats])


def parse_date(c: Column | str, *formats: str) -> Column:
    return parse_timestamp(c, *(formats or DAY_FIRST)).cast("date")


def format_date(c: Column | str, layout: str = "yyyy-MM-dd") -> Column:
    return F.date_format(_col(c), layout)


def local_date(c: Column | str, tz: str = ZONE) -> Column:
    """Calendar date of a UTC instant in ``tz``."""
    return F.to_date(F.from_utc_timestamp(_col(c), tz))


def date_bounds(lo=None, hi=None, epoch: str = EPOCH, tz: str = ZONE) -> tuple[Column, Column]:
    """Closed date bounds: no lower bound means ``epoch``, no upper bound means today in ``tz``."""
    today = F.to_date(F.convert_timezone(F.current_timezone(), F.lit(tz), F.current_timestamp()
                                         .cast("timestamp_ntz")))
    low = F.lit(epoch).cast("date") if lo is None else F.lit(lo).cast("date")
    high = today if hi is None else F.lit(hi).cast("date")
    return low, high


def partial_date(text: str) -> Column:
    """``2021``, ``2021-03`` and ``2021-03-04`` as the first day they name."""
    parts = text.split("-")
    return F.lit("-".join(parts + ["01"] * (3 - len(parts)))).cast("date")


def days_between(first: Column | str, last: Column | str) -> Column:
    """Array of the calendar days of a closed range; an empty array when it is reversed."""
    first, last = _col(first), _col(last)
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<date>"))
