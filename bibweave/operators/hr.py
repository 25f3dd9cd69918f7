"""Staff records: extended table, current employment, summary and checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from bibweave.functions.text import is_researcher
from bibweave.operators.groups import with_count
from bibweave.operators.joins import absent_from, rejoin_latest

c = F.col
YEAR_DAYS = 365.25


def extended(hr: DataFrame, titles: DataFrame | None, areas: DataFrame) -> DataFrame:
    """Staff rows with title group and subject area."""
    out = hr if titles is None else hr.join(titles, "emp_code", "left")
    named = areas.select(
        c("id").alias("scb_topic"), c("swe").alias("scb_topic_swe"), c("eng").alias("scb_topic_eng"),
        c("level").alias("scb_topic_level"),
    )
    return out.join(named, "scb_topic", "left")


def current(hr: DataFrame, as_of: dt.date) -> DataFrame:
    """Open employments that carry the person's latest dates."""
    running = hr.where((c("emp_beg") <= F.lit(as_of)) & (c("emp_end") > F.lit(as_of)))
    return rejoin_latest(running, "staffid", ["emp_lastmod", "emp_end", "emp_beg"])


def employed_at(hr: DataFrame, day: dt.date) -> DataFrame:
    return hr.where((c("emp_beg") <= F.lit(day)) & (c("emp_end") >= F.lit(day)))


def summary(hr: DataFrame, as_of: dt.date) -> DataFrame:
    per = hr.groupBy("staffid").agg(
        F.max("emp_lastmod").alias("elm"), F.min("emp_beg").alias("ebeg"), F.max("emp_end").alias("eend"),
        F.count(F.lit(1)).alias("n"), F.max("yob").alias("yob"),
    )
    return per.withColumns({"duration": F.datediff("eend", "ebeg"), "ttl": F.datediff("eend", F.lit(as_of))})


def periods(hr: DataFrame) -> DataFrame:
    """First start and last end per person and unit."""
    return hr.groupBy("staffid", "unit_abbr").agg(F.min("emp_beg").alias("beg"), F.max("emp_end").alias("end"))


def check_age(hr: DataFrame, as_of: dt.date, max_age: int = 100) -> DataFrame:
    """Started too long ago, before birth, or born in 1900."""
    per = summary(hr, as_of)
    odd = (
        (c("ebeg") < F.lit(as_of - dt.timedelta(days=max_age * 365)))
        | (F.year("ebeg") - c("yob") < 0)
        | (c("yob") == 1900)
    )
    detail = hr.select("staffid", "yob", "unit_abbr", "lastname", "firstname")
    return per.where(odd).join(detail, ["staffid", "yob"], "left").select(
        "staffid", "ebeg", "yob", "duration", "ttl", "unit_abbr", "lastname", "firstname"
    )


def check_long_end(hr: DataFrame, as_of: dt.date, years_from: float = 6, years_to: float = 100) -> DataFrame:
    per = summary(hr, as_of).where((c("ttl") > years_from * YEAR_DAYS) & (c("ttl") < years_to * YEAR_DAYS))
    now = current(hr, as_of).select("staffid", "unit_abbr", "lastname", "firstname")
    return per.join(now, "staffid", "left").select(
        "staffid", "eend", "duration", "ttl", "unit_abbr", "lastname", "firstname"
    )


def check_last_modified(hr: DataFrame, as_of: dt.date, offset: int = 60) -> DataFrame:
    late = F.lit(as_of + dt.timedelta(days=offset))
    per = summary(hr, as_of).where((c("elm") > late) | (c("elm") < c("ebeg")))
    detail = hr.select("staffid", "unit_abbr", "lastname", "firstname")
    return per.join(detail, "staffid", "left").select(
        "staffid", "elm", "ebeg", "duration", "ttl", "unit_abbr", "lastname", "firstname"
    )


def check_topics(hr: DataFrame, areas: DataFrame, as_of: dt.date) -> DataFrame:
    """Current employments with an unknown subject code, with the code's frequency."""
    now = current(hr, as_of).where(c("scb_topic").isNotNull() & (c("scb_topic") != "999"))
    unknown = absent_from(now, areas, "scb_topic", "id")
    return with_count(unknown, ["scb_topic"], "n").select(
        "scb_topic", "n", "staffid", "unit_abbr", "unit_name", "lastname", "firstname"
    )


def check_full_names(hr: DataFrame) -> DataFrame:
    odd = r"\s{2,}|\p{Cntrl}|.*?\s+$"
    return hr.where(c("lastname").rlike(odd) | c("firstname").rlike(odd)).select(
        "staffid", "unit_abbr", "firstname", "lastname"
    )


def check_research_areas(hr: DataFrame, areas: DataFrame) -> DataFrame:
    """Unknown subject codes and how often they occur."""
    rows = hr.where(c("scb_topic").isNotNull() & (c("scb_topic") != "999"))
    return absent_from(rows, areas, "scb_topic", "id").groupBy("scb_topic").agg(F.count(F.lit(1)).alias("n"))


def researchers_without_orcid(hr: DataFrame, pairs: DataFrame, as_of: dt.date) -> DataFrame:
    now = current(hr, as_of).where(is_researcher(c("emp_desc")))
    return absent_from(now, pairs, "staffid").select("staffid", "unit_abbr", "lastname", "firstname").distinct()


def orcid_coverage(hr: DataFrame, pairs: DataFrame, as_of: dt.date) -> DataFrame:
    """People and people with an ORCID per unit among current researchers."""
    now = current(hr, as_of).where(is_researcher(c("emp_desc"))).select("staffid", "unit_abbr").distinct()
    known = pairs.select("staffid").distinct().withColumn("has", F.lit(True))
    return now.join(known, "staffid", "left").groupBy("unit_abbr").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(c("has")).alias("n_orcid")
    )
