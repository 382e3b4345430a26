"""Event time, zones and calendar periods."""

from __future__ import annotations

import datetime as dt
from functools import lru_cache
from zoneinfo import available_timezones

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: end of validity of a row that is still valid.
OPEN_END = "2099-12-31 00:00:00"


def parse_time(*texts: Column) -> Column:
    """The first of the texts that reads as a timestamp (a bad text is skipped, not an error)."""
    return F.coalesce(*[F.try_to_timestamp(t) for t in texts])


@lru_cache(maxsize=None)
def zone_ids(region: str) -> tuple[str, ...]:
    """Time-zone ids of one region of the IANA database."""
    return tuple(sorted(z for z in available_timezones() if z.startswith(region + "/")))


def city_zone(city: Column, region: str, default: str) -> Column:
    """``Region/City_Name`` when the database knows it, else ``default``."""
    candidate = F.concat(F.lit(region + "/"), F.regexp_replace(city, " ", "_"))
    return F.when(candidate.isin(*zone_ids(region)), candidate).otherwise(F.lit(default))


def local_time(ts: Column, zone: Column, as_text: bool = False) -> Column:
    """Wall-clock time in ``zone`` of a UTC timestamp. ``zone`` must be valid (see ``city_zone``)."""
    shifted = F.from_utc_timestamp(ts, zone)
    return F.date_format(shifted, "yyyy-MM-dd HH:mm:ss") if as_text else shifted


def previous_month(today: dt.date | None = None) -> tuple[Column, Column]:
    """Year and month of the calendar month before ``today`` (the current date when not given)."""
    day = F.current_date() if today is None else F.lit(today)
    before = F.add_months(day, -1)
    return F.year(before), F.month(before)


def date_parts(ts: Column) -> list[Column]:
    return [
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
        F.to_date(ts).alias("date"),
        F.date_format(ts, "HH:mm:ss").alias("time"),
    ]
