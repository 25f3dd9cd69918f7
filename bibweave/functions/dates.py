"""Date formats and conference dates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def compact_date(col: Column) -> Column:
    return F.date_format(col, "yyyyMMdd")


def display_date(col: Column) -> Column:
    """``Jun 5 2023``: abbreviated month, day without padding, year."""
    return F.date_format(col, "MMM d yyyy")


def parse_compact(col: Column) -> Column:
    return F.try_to_date(col, "yyyyMMdd")


def parse_iso_stamp(col: Column) -> Column:
    """``2023-06-05T07:08:09.123456Z`` to a timestamp, fraction optional."""
    return F.try_to_timestamp(F.regexp_replace(col, "Z$", ""))


def stamp_utc(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def date_range(col: Column, sep: str = " - ") -> Column:
    """``2020-01-01 - 2020-02-01`` to a struct of two dates."""
    parts = F.split(col, sep)
    return F.struct(
        F.try_to_date(F.try_element_at(parts, F.lit(1))).alias("beg"),
        F.try_to_date(F.try_element_at(parts, F.lit(2))).alias("end"),
    )


def safe_date(year: Column, month: Column, day: Column) -> Column:
    """Date from pieces, missing instead of an error when they do not form one."""
    return F.try_to_date(
        F.concat_ws(
            "-",
            F.lpad(year.cast("string"), 4, "0"),
            F.lpad(month.cast("string"), 2, "0"),
            F.lpad(day.cast("string"), 2, "0"),
        ),
        "yyyy-MM-dd",
    )


def conference_details(title: Column, city: Column, country: Column, beg: Column, end: Column) -> Column:
    """``title, city, country, dates`` from begin and end dates of which one
    may be missing; when both are missing the result is missing (a problem row)."""
    both = beg.isNotNull() & end.isNotNull()
    span = F.concat_ws(
        " - ", display_date(F.least(beg, end)), display_date(F.greatest(beg, end))
    )
    one = display_date(F.coalesce(end, beg))
    dates = F.when(both, span).otherwise(one)
    na = lambda c: F.coalesce(c.cast("string"), F.lit("NA"))
    return F.when(
        beg.isNotNull() | end.isNotNull(),
        F.concat_ws(", ", na(title), na(city), na(country), dates),
    )
