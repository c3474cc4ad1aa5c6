"""Calendar arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_week(c) -> Column:
    """Monday of the ISO week, as DATE (``date_trunc`` would give a timestamp)."""
    return F.trunc(F.to_date(_col(c)), "week")


def week_bucket(c, anchor: str = "iso") -> Column:
    """Label of the 7-day bin of a date.

    ``iso``: Monday..Sunday, labelled by its Monday.
    ``mon_left``: Tuesday..Monday, labelled by the Monday before it.
    ``mon_period``: the same bin, labelled by its first day (the Tuesday).
    """
    day = F.to_date(_col(c))
    if anchor == "iso":
        return F.trunc(day, "week")
    left = F.trunc(F.date_sub(day, 1), "week")
    if anchor == "mon_left":
        return left
    if anchor == "mon_period":
        return F.date_add(left, 1)
    raise ValueError(f"unknown week anchor {anchor!r}")


def parse_instant(c) -> Column:
    """ISO-8601 text with ``Z`` or an offset to a zone-less UTC timestamp; unreadable text is NULL.

    Zone-less, so that days and weeks do not depend on the session's time zone.
    """
    text = _col(c)
    # Spark would also read words such as "yesterday"
    return utc_time(F.try_to_timestamp(F.when(text.rlike(r"^\d{4}"), text)))


def utc_instant(c) -> Column:
    """Zone-less UTC time to a TIMESTAMP (what watermarks need), whatever the session's zone."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), _col(c)).cast("timestamp")


def utc_time(c) -> Column:
    """TIMESTAMP to zone-less UTC time."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), _col(c).cast("timestamp_ntz"))


def earliest_instant(created, indexed) -> Column:
    """Earlier of two ISO-8601 texts; one missing value does not hide the other."""
    return F.least(parse_instant(created), parse_instant(indexed))


def iso_seconds(ts, suffix: str = "Z") -> Column:
    return F.concat(F.date_format(_col(ts), ISO_SECONDS), F.lit(suffix))


def season(month) -> Column:
    m = _col(month)
    return (
        F.when(m.isin(12, 1, 2), "Winter")
        .when(m.between(3, 5), "Spring")
        .when(m.between(6, 8), "Summer")
        .otherwise("Autumn")
    )


def _sunday(day: Column) -> Column:
    return F.date_sub(day, F.dayofweek(day) - 1)


def mmwr_week_start(year, week) -> Column:
    """Sunday of epidemiological week ``week``: week 1 holds 4 January."""
    return F.date_add(_sunday(F.make_date(_col(year), F.lit(1), F.lit(4))), ((_col(week) - 1) * 7).cast("int"))


def mmwr_year(c) -> Column:
    """Year of the epidemiological week: that of its Wednesday."""
    return F.year(F.date_add(_sunday(F.to_date(_col(c))), 3))


def mmwr_week(c) -> Column:
    start = _sunday(F.to_date(_col(c)))
    first = mmwr_week_start(F.year(F.date_add(start, 3)), F.lit(1))
    return (F.datediff(start, first) / 7 + 1).cast("int")


def iso_week_start(year, week) -> Column:
    """Monday of ISO week ``week`` of ``year``; NULL where the year has no such week."""
    y, w = _col(year).cast("int"), _col(week).cast("int")
    valid = y.between(1, 9999) & w.between(1, 53)
    first = F.trunc(F.make_date(F.when(valid, y), F.lit(1), F.lit(4)), "week")
    monday = F.date_add(first, F.when(valid, (w - 1) * 7))
    return F.when(F.year(F.date_add(monday, 3)) == y, monday)


def week_number_start(c) -> Column:
    """Integer ``YYYYWW`` to the Monday of that ISO week."""
    number = _col(c).cast("int")
    return iso_week_start(F.floor(number / 100), number % 100)


def week_text_start(c, legacy: bool = False) -> Column:
    """Text ``YYYY-Www`` to a Monday, NULL if it is no such text.

    ``legacy`` counts weeks from the first Monday of the year (C's ``%W``), which
    is a week late against ISO in years such as 2025.
    """
    text = _col(c)
    year = F.nullif(F.regexp_extract(text, r"^(\d{4})-W(\d{1,2})$", 1), F.lit("")).cast("int")
    week = F.nullif(F.regexp_extract(text, r"^(\d{4})-W(\d{1,2})$", 2), F.lit("")).cast("int")
    if not legacy:
        return iso_week_start(year, week)
    valid = (year >= 1) & (week <= 53)
    new_year = F.make_date(F.when(valid, year), F.lit(1), F.lit(1))
    first_monday = F.next_day(F.date_sub(new_year, 1), "Mon")
    return F.when(week == 0, F.trunc(new_year, "week")).otherwise(F.date_add(first_monday, (week - 1) * 7))
