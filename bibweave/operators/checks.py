"""The data-quality checks. Each returns the offending rows, unlinked and
unsorted; ``CHECKS`` tells a report how to sort and link them.

``pubs`` and ``authors`` follow :mod:`bibweave.sources.schemas`. "Today" is
always the argument ``as_of``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F

from bibweave.functions import identifiers as ids, text
from bibweave.functions.nulls import matching, n_distinct, not_in, not_matching, nullsafe_join, paste
from bibweave.operators.groups import (
    collapse, counts, initials, joined_sorted, nullsafe_outer, top_rows, with_count, with_group_values,
)
from bibweave.operators.setops import stack
from bibweave.session import cut_lineage

# Publication types, statuses and note marks the checks test for.
ARTICLE = "Artikel i tidskrift"
CONFERENCE = "Konferensbidrag"
CHAPTER = "Kapitel i bok, del av antologi"
MANUSCRIPT = "Manuskript (preprint)"
NOT_PUBLISHED = ["accepted", "aheadofprint", "inPress"]
IMPORT_MARK = r"Imported from Scopus\. VERIFY"
NOT_DUPLICATE = (
    "Not duplicate with|not duplicate with|Non-duplicate with|Not dublicate|No duplicate"
    "|Not a duplicate with|No duplikate|Nondupe with|Non-duplicate in|No dublicate with|No dupe"
)
STOP_TITLES = (
    "Background|Chairs'+ [Ww]elcome|Commentary|Conclusions|Conclusion|Editorial|Editor's foreword"
    "|Editors' foreword|Editors’ foreword|Examples|Foreword|Förord|Guest editorial|Introduction"
    "|Message from the [Cc]hairs|Preface|Preliminaries|Preview|Untitled"
)
AUTHOR_ID_FIELDS = ["staffid", "orcid", "DOI", "ScopusId"]
PUBLICATION_ID_FIELDS = [
    "JournalISSN", "JournalEISSN", "SeriesISSN", "JournalEISSN", "ISBN", "ISI", "PMID",
]

c = F.col


def days_before(as_of: dt.date, days: int) -> Column:
    return F.lit(as_of - dt.timedelta(days=days))


def prefilter(pubs: DataFrame, as_of: dt.date) -> DataFrame:
    """Leave out unverified imports and the last 30 days."""
    return pubs.where(within_prefilter(as_of))


def within_prefilter(as_of: dt.date) -> Column:
    return not_matching(c("Notes"), IMPORT_MARK) & (c("CreatedDate") < days_before(as_of, 30))


def has_any(*names: str) -> Column:
    out = c(names[0]).isNotNull()
    for n in names[1:]:
        out = out | c(n).isNotNull()
    return out


# --- row checks: one boolean per row, so any number of them fuse in one scan --

def submission_status_invalid() -> Column:
    return (c("Status") == "submitted") & has_any("DOI", "ISI", "ScopusId")


def missing_date() -> Column:
    return c("PublicationDate").isNull() & c("Year").isNull()


def missing_journal_ids() -> Column:
    return (
        (c("PublicationType") == ARTICLE)
        & c("JournalISSN").isNull()
        & c("JournalEISSN").isNull()
        & not_matching(text.tidy_html(c("Notes")), "No ISSN")
        & not_in(c("Status"), ["submitted", "accepted"])
    )


def bad_format(name: str, pattern: str) -> Column:
    return c(name).isNotNull() & ~c(name).rlike(pattern)


def invalid_staff_id() -> Column:
    return bad_format("staffid", ids.STAFF_ID_FORMAT) & ~c("staffid").rlike(ids.TEMPORARY_ID_FORMAT)


def invalid_use_isbn() -> Column:
    return c("ISBN").isNotNull() & (c("Year") >= 2019) & c("PublicationType").isin([CHAPTER, CONFERENCE, ARTICLE])


def invalid_author_name() -> Column:
    return matching(c("name"), r"^\p{Punct}{2,}")


def published_by_note() -> Column:
    return matching(text.tidy_html(c("Notes")), "QP") & F.coalesce(c("Status").isin(NOT_PUBLISHED), F.lit(False))


def published_by_check() -> Column:
    return (c("Status") == "submitted") & (
        matching(text.tidy_html(c("Notes")), "QC|NQC") | (c("PublicationType") == MANUSCRIPT)
    )


def manuscript_with_identifier() -> Column:
    return (
        matching(c("PublicationType"), "Manuskript")
        & has_any("DOI", "ISI", "ScopusId", "PMID")
        & not_matching(c("DOI"), ids.PREPRINT_DOI)
    )


def not_checked(as_of: dt.date) -> Column:
    return (c("CreatedDate") < days_before(as_of, 30)) & not_matching(c("Notes"), "QC ")


def not_checked_since(as_of: dt.date, since: dt.date = dt.date(2023, 1, 1)) -> Column:
    return (c("CreatedDate") > F.lit(since)) & not_checked(as_of)


def missing_staff_id() -> Column:
    return c("orgid").isNotNull() & c("staffid").isNull()


def bad_issn(name: str) -> Column:
    return c(name).isNotNull() & (~ids.issn_ok(c(name)) | ~c(name).rlike(ids.ISSN_FORMAT))


def isbn_flags(isbn: Column) -> tuple[Column, Column]:
    """(bad format, bad check digit) of one ISBN."""
    n = F.length(F.regexp_replace(isbn, "-", ""))
    bad_check = F.when(n == 10, ~ids.isbn10_ok(isbn)).when(n == 13, ~ids.isbn13_ok(isbn)).otherwise(F.lit(False))
    return (n != 10) & (n != 13), bad_check


def n_bad_isbn() -> Column:
    """Bad ISBNs among the separated ones of a record."""
    bad = F.filter(F.split(c("ISBN"), ";"), lambda x: isbn_flags(x)[0] | isbn_flags(x)[1])
    return F.coalesce(F.size(bad), F.lit(0))


# --- the checks as tables ------------------------------------------------------

def check_submission_status(pubs: DataFrame) -> DataFrame:
    return pubs.where(submission_status_invalid()).select("PID", "Year", "ISI", "DOI", "ScopusId")


def _authors_with_dates(authors: DataFrame, pubs: DataFrame, how: str) -> DataFrame:
    return authors.join(pubs.select("PID", "Year", "LastUpdated"), "PID", how)


def check_missing_staff_id(authors: DataFrame, pubs: DataFrame) -> DataFrame:
    rows = _authors_with_dates(authors.where(missing_staff_id()), pubs, "inner")
    return rows.select("PID", "Year", "name", "LastUpdated", "staffid", "orcid", "DOI", "ScopusId")


def check_missing_aid(authors: DataFrame, pubs: DataFrame) -> DataFrame:
    return check_missing_staff_id(authors, pubs).withColumnRenamed("staffid", "aid")


def check_missing_orcids(authors: DataFrame, more_than: int = 9) -> DataFrame:
    """People with exactly one known ORCID that more than ``more_than`` rows lack."""
    known = authors.where(c("staffid").isNotNull() & ~c("staffid").rlike("00000*|-"))
    per_id = known.groupBy("staffid").agg(
        F.count_if(c("orcid").isNull()).alias("n_na_pubs"),
        F.min("orcid").alias("orcid"),
        F.max("orcid").alias("__max"),
    )
    # one distinct value is the same as equal extremes, and cheaper to aggregate
    return per_id.where((c("orcid") == c("__max")) & (c("n_na_pubs") > more_than)).select(
        "staffid", "orcid", "n_na_pubs"
    )


def check_missing_date(pubs: DataFrame) -> DataFrame:
    return pubs.where(missing_date()).drop("ISRN", "NBN")


def check_missing_journal_ids(pubs: DataFrame) -> DataFrame:
    journal = [n for n in pubs.columns if n.startswith("Journal")]
    return pubs.where(missing_journal_ids()).select(
        "PID", "Year", "Title", "LastUpdated", *journal, "PublicationType", "Status", "DOI", "ScopusId", "Name",
        text.tidy_html(c("Notes")).alias("clean_notes"),
    )


def check_book_chapter_titles(pubs: DataFrame) -> DataFrame:
    """Short chapter titles that occur more than once, with their records."""
    chapters = pubs.where((c("PublicationType") == CHAPTER) & (F.length("Title") < 20))
    repeated = with_count(chapters.select("PID", "Title"), ["Title"], "n", at_least=2)
    return collapse(repeated, ["Title", "n"], "PID", "pids")


def check_invalid_isi(pubs: DataFrame) -> DataFrame:
    return pubs.where(bad_format("ISI", ids.ISI_FORMAT)).select("PID", "Year", "ISI", "DOI", "ScopusId")


def check_invalid_doi(pubs: DataFrame) -> DataFrame:
    return pubs.where(bad_format("DOI", ids.DOI_FORMAT)).select("PID", "Year", "DOI", "ISI", "ScopusId")


def _duplicates(pubs: DataFrame, key: str, normal: Callable[[Column], Column], against: DataFrame | None) -> DataFrame:
    """Records that share an identifier. Counts run on ``pubs``; the rows come
    from ``against`` when given, so a prefilter does not hide half of a pair."""
    keyed = pubs.where(c(key).isNotNull()).select(normal(c(key)).alias("__key"))
    repeated = counts(keyed, ["__key"], "n_pids", at_least=2)
    rows = (pubs if against is None else against).withColumn("__key", normal(c(key)))
    return rows.join(repeated, "__key").select(
        "PID", "Year", "Title", "n_pids", "DOI", "ISI", "ScopusId", "LastUpdated"
    )


def check_duplicate_doi(pubs: DataFrame) -> DataFrame:
    return _duplicates(pubs, "DOI", F.lower, None)


def check_duplicate_scopus_id(pubs: DataFrame, expand_against: DataFrame | None = None) -> DataFrame:
    return _duplicates(pubs, "ScopusId", lambda x: x, expand_against)


def check_duplicate_isi(pubs: DataFrame, expand_against: DataFrame | None = None) -> DataFrame:
    return _duplicates(pubs, "ISI", lambda x: x, expand_against)


def check_invalid_aid(authors: DataFrame) -> DataFrame:
    return authors.where(bad_format("staffid", ids.AUTHORITY_ID_FORMAT)).withColumnRenamed("staffid", "aid")


def check_invalid_staff_id(authors: DataFrame) -> DataFrame:
    return authors.where(invalid_staff_id()).drop("ISRN", "NBN")


def check_invalid_orcid(authors: DataFrame, pubs: DataFrame, strict: bool = False) -> DataFrame:
    """Malformed ORCIDs; ``strict`` also verifies the check digit."""
    bad = bad_format("orcid", ids.ORCID_FORMAT)
    if strict:
        bad = bad | (c("orcid").isNotNull() & ~ids.orcid_checksum_ok(c("orcid")))
    return _authors_with_dates(authors.where(bad), pubs, "left").drop("ISRN", "NBN")


def check_ambiguous_orcid(authors: DataFrame, examples: int = 10) -> DataFrame:
    """ORCIDs used with several staff ids.

    The label lists all staff ids of the ORCID, in each of its rows, as the result asks for; so what is returned for one ORCID
    grows with the square of its staff ids. Its rows are chosen and written once, and every part is made from those.
    """
    person = ["orcid", "staffid", "name", "autid"]
    rows = authors.where(c("orcid").isNotNull() & not_matching(c("staffid"), "^PI")).select(*person, "PID")
    many = (
        rows.groupBy("orcid")
        .agg(F.count_distinct("staffid").alias("n_staff"), F.count_distinct("PID").alias("tot_pids"))
        .where(c("n_staff") > 1)
    )
    kept = cut_lineage(rows.join(many.select("orcid", "tot_pids"), "orcid").distinct(), "ambiguous")
    listed = kept.select("orcid", "staffid", "tot_pids").distinct()
    labels = listed.groupBy("orcid", "tot_pids").agg(joined_sorted(c("staffid"), " ").alias("staffids"))
    label = F.concat(
        c("orcid"), F.format_string(" (tot=%03d ids=", c("tot_pids")), c("staffids"), F.lit(")"),
    )
    per_person = kept.groupBy(*person).agg(F.count(c("PID")).alias("n_pids"))
    shown = (
        top_rows(kept, person, [c("PID").asc_nulls_last()], examples)
        .groupBy(*person)
        .agg(F.array_join(F.array_sort(F.collect_list("PID")), " ").alias("example_pids"))
    )
    joined = nullsafe_join(per_person, shown, person, "left").join(labels.select("orcid", label.alias("combo")), "orcid")
    return joined.select("combo", "staffid", "name", "autid", "n_pids", "example_pids")


def check_invalid_scopus_id(pubs: DataFrame) -> DataFrame:
    return pubs.where(bad_format("ScopusId", ids.SCOPUS_FORMAT)).select(
        "Title", "Year", "ScopusId", "PID", "ISI", "DOI"
    )


def check_invalid_issn(pubs: DataFrame) -> DataFrame:
    """Distinct bad print and electronic ISSNs of a record, stacked."""

    def bad(name: str) -> DataFrame:
        rows = pubs.where(bad_issn(name)).select(name, "PID", "Year").distinct()
        return rows.withColumns(
            {"has_bad_check": ~ids.issn_ok(c(name)), "has_bad_format": ~c(name).rlike(ids.ISSN_FORMAT)}
        )

    both = stack(bad("JournalEISSN"), bad("JournalISSN"))
    return both.select("PID", "Year", "JournalEISSN", "JournalISSN", "has_bad_check", "has_bad_format")


def check_invalid_isbn(pubs: DataFrame) -> DataFrame:
    rows = pubs.where(c("ISBN").isNotNull()).select("PID", "ISBN", "Year").distinct()
    pieces = rows.withColumn("ISBN", F.explode(F.split("ISBN", ";")))
    bad_form, bad_check = isbn_flags(c("ISBN"))
    flagged = pieces.withColumns(
        {
            "n_chars": F.length(F.regexp_replace("ISBN", "-", "")),
            "has_bad_format": bad_form,
            "has_bad_check": bad_check,
        }
    )
    return flagged.where(c("has_bad_check") | c("has_bad_format"))


def check_invalid_use_isbn(pubs: DataFrame) -> DataFrame:
    return pubs.where(invalid_use_isbn()).select("PID", "Title", "Year", "PublicationType", "ISBN", "LastUpdated")


def check_invalid_author_name(authors: DataFrame) -> DataFrame:
    return authors.where(invalid_author_name()).select("PID", "name", "staffid", "extorg")


def check_uncertain_published(pubs: DataFrame) -> DataFrame:
    """Two reasons for a doubtful status in one pass; a record with both is
    listed twice, and each row leaves the other reason's columns empty."""
    yes, no_flag = F.lit(True), F.lit(None).cast("boolean")
    unpublished = F.coalesce(c("Status").isin(NOT_PUBLISHED), F.lit(False))
    reason = lambda a, b, q: F.struct(
        a.alias("has_notes"), b.alias("is_not_published"), q.alias("is_QCorNQC")
    )
    reasons = F.array_compact(
        F.array(
            F.when(published_by_note(), reason(yes, unpublished, no_flag)),
            F.when(
                published_by_check(),
                reason(no_flag, no_flag, matching(text.tidy_html(c("Notes")), "QC|NQC")),
            ),
        )
    )
    rows = pubs.where(published_by_note() | published_by_check()).withColumn("__r", F.explode(reasons))
    return rows.select(
        "PID", "Year", "PublicationType", "__r.has_notes", "__r.is_not_published",
        text.tidy_html(c("Notes")).alias("Notes"), "__r.is_QCorNQC",
    )


def check_manuscripts_with_identifiers(pubs: DataFrame) -> DataFrame:
    return pubs.where(manuscript_with_identifier()).select(
        "PID", "Year", "Title", "DOI", "ISI", "ScopusId", "PMID", "LastUpdated"
    )


def _keyed_by_initials(rows: DataFrame, authors: DataFrame) -> DataFrame:
    """Attach the author initials and count rows per initials and year.

    ``rows`` are few beside the corpus and needed several times, so they are written once, without and with initials.
    """
    rows = cut_lineage(rows, "titles")
    listed = authors.join(rows.select("PID").distinct(), "PID", "left_semi")
    keyed = rows.join(initials(listed), "PID").withColumn("check_key", paste(c("initials"), c("Year"), sep="_"))
    return with_count(cut_lineage(keyed, "initials"), ["check_key"], "n_check")


def check_duplicate_article_titles(pubs: DataFrame, authors: DataFrame) -> DataFrame:
    articles = pubs.where(matching(c("PublicationType"), "^Artikel")).select(
        "PID", "Year", "Title", "LastUpdated", text.title_key(c("Title")).alias("lc_title")
    )
    rows = with_count(articles, ["lc_title"], "n", at_least=2)
    return _keyed_by_initials(rows, authors).select(
        "PID", "Year", "Title", "check_key", "n", "n_check", "LastUpdated"
    )


def check_duplicate_titles(
    pubs: DataFrame, authors: DataFrame, stop_list: DataFrame | None = None, parity: bool = True
) -> DataFrame:
    """Same title and type. ``parity`` keeps the table-wide reading of the ISSN
    rule, by which one record without an ISSN lets every record through;
    otherwise the rule is applied record by record."""
    # one element, so that the optimizer does not copy the clean-up into the filter
    cleaned = pubs.withColumns(
        {"clean_notes": F.explode(F.array(text.tidy_html(c("Notes")))), "lc_title": text.title_key(c("Title"))}
    ).where(not_matching(c("clean_notes"), NOT_DUPLICATE))
    lacks = c("JournalISSN").isNull() | c("JournalEISSN").isNull()
    key = ["lc_title", "PublicationType"]
    groups = cleaned.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.bool_or(lacks).alias("any_missing")).where("n > 1")
    groups = cut_lineage(groups, "title-groups")
    rows = nullsafe_join(cleaned, groups.drop("any_missing"), key)
    if parity:
        lacks = F.lit(bool(groups.agg(F.bool_or("any_missing")).first()[0]))
    rows = rows.where((c("JournalISSN") == c("JournalEISSN")) | lacks).select(
        "PID", "Year", "Title", "PublicationType", "LastUpdated", "n", "JournalISSN", "JournalEISSN", "clean_notes"
    )
    keyed = _keyed_by_initials(rows, authors).where(not_matching(c("Title"), STOP_TITLES))
    if stop_list is not None:
        listed = stop_list.select(c("PID").cast("bigint").alias("PID"), "Title")
        same = keyed["PID"].eqNullSafe(listed["PID"]) & keyed["Title"].eqNullSafe(listed["Title"])
        keyed = keyed.join(listed, same, "left_anti")
    return keyed.select(
        "PID", "Year", "Title", "PublicationType", "n_check", "n", "LastUpdated", "JournalISSN", "JournalEISSN",
        "check_key", "clean_notes",
    )


def check_missing_affiliations(parsed: DataFrame) -> DataFrame:
    """People without any affiliation in the parsed name strings."""
    return parsed.where(c("staffid").isNotNull() & c("n_aff_own").isNull() & c("n_aff_ext").isNull()).select(
        "PID", "name", "staffid", "orcid", "n_pid"
    )


def check_unicode_identifiers(pubs: DataFrame, authors: DataFrame, strict: bool = False) -> DataFrame:
    """Identifiers with characters above ASCII, one row per field."""

    def issues(df: DataFrame, fields: list[str], dataset: str) -> DataFrame:
        cells = F.array(
            *[
                F.struct(F.lit(f).alias("field"), text.unicode_escapes(c(f).cast("string"), strict).alias("issue"))
                for f in fields
            ]
        )
        found = F.filter(cells, lambda x: x["issue"].isNotNull())
        any_outside = F.concat_ws("", *[c(f).cast("string") for f in fields]).rlike(r"[^\x00-\x7F]")
        return (
            df.where(any_outside)
            .select("PID", F.lit(dataset).alias("dataset"), F.explode(found).alias("x"))
            .select("PID", "dataset", "x.field", c("x.issue").alias("unicode_issue"))
        )

    return issues(authors, AUTHOR_ID_FIELDS, "authors").unionByName(
        issues(pubs, PUBLICATION_ID_FIELDS, "publications")
    )


def check_stale_organisations(
    authors: DataFrame, pubs: DataFrame, organisations: DataFrame, overdue: int = 540, more_than: int = 10
) -> DataFrame:
    """People registered on closed units who have exactly one open unit with
    more than ``more_than`` publications; their record lists come in pieces."""
    person = ["name", "orcid", "staffid"]
    orgs = organisations.withColumn("orgid", c("orgid").cast("string"))
    closed = orgs.where("is_closed").select("orgid", "unit_en", c("closed_date").cast("date").alias("cd"))
    opened = orgs.where(~c("is_closed")).select("orgid")
    stale = (
        authors.join(closed, "orgid")
        .select(*person, "PID", "orgid", "cd")
        .distinct()
        .join(pubs.select("PID", "Year"), "PID", "left")
        .where(F.datediff(F.make_date("Year", F.lit(1), F.lit(1)), c("cd")) > overdue)
    )
    # both sides of the few people concerned are written once; all that follows reads those
    stale = cut_lineage(stale, "stale")
    who = stale.select(*person).distinct()
    elsewhere = authors.join(opened, "orgid", "left_semi").select(*person, "PID", "orgid")
    alternatives = cut_lineage(nullsafe_join(elsewhere, who, person).distinct(), "alternatives")
    single = (
        alternatives.groupBy(*person)
        .agg(
            F.min("orgid").alias("alt_orgids"), F.max("orgid").alias("__max"),
            F.count_distinct("PID").alias("alt_n_pids"),
        )
        .where((c("alt_orgids") == c("__max")) & (c("alt_n_pids") > more_than))
        .drop("__max")
        .withColumn("alt_n_orgs", F.lit(1).cast("bigint"))
    )
    mine = lambda t: nullsafe_join(t, single.select(*person), person)
    stale_orgs = mine(stale).groupBy(*person).agg(
        joined_sorted_set(c("orgid")).alias("stale_orgids")
    )
    stale_pids = collapse(mine(stale), person, "PID", "stale_pids")
    alt_pids = collapse(mine(alternatives), person, "PID", "alt_pids")
    pieces = nullsafe_outer(stale_pids, alt_pids, [*person, "piece"])
    return nullsafe_join(nullsafe_join(single, stale_orgs, person), pieces, person).select(
        *person, "stale_orgids", "alt_orgids", "alt_n_orgs", "alt_n_pids", "piece", "stale_pids", "alt_pids"
    )


def joined_sorted_set(value: Column, sep: str = " ") -> Column:
    """Aggregate for a value with a bounded domain, such as a unit id."""
    return F.array_join(F.array_sort(F.collect_set(value)), sep)


def check_not_checked(pubs: DataFrame, as_of: dt.date, since: dt.date = dt.date(2023, 1, 1)) -> DataFrame:
    return pubs.where(not_checked_since(as_of, since)).select("PID", "CreatedDate", "LastUpdated")


def check_not_checked_stale(pubs: DataFrame, as_of: dt.date) -> DataFrame:
    rows = pubs.where(not_checked(as_of))
    return rows.groupBy("PublicationType", F.year("CreatedDate").alias("y")).agg(F.count(F.lit(1)).alias("n"))


def shape_external_checks(rows: DataFrame) -> DataFrame:
    """Check rows delivered by an outside service: output address, link by type."""
    target = (
        F.when(c("flag_type") == "ORCID", F.concat(F.lit("https://orcid.org/"), c("value")))
        .when(c("flag_type") == "DOI", F.concat(F.lit("https://doi.org/"), c("value")))
        .when(c("flag_type") == "ISSN", F.concat(F.lit("https://portal.issn.org/resource/ISSN/"), c("value")))
        .otherwise(c("value"))
    )
    return rows.withColumns(
        {"repo_url": F.regexp_replace("repo_url", "term/swepub", "term/swepub/output"), "link": target}
    ).drop("record_id")


# --- identity checks -------------------------------------------------------------

def shared_orcids(authors: DataFrame) -> DataFrame:
    """Distinct (orcid, staffid) of ORCIDs that have more than one staff id."""
    pairs = authors.where(c("orcid").isNotNull() & c("staffid").isNotNull()).select("orcid", "staffid").distinct()
    return with_count(pairs, ["orcid"], "__n", at_least=2).drop("__n")


def shared_orcid_overview(details: DataFrame) -> DataFrame:
    return details.groupBy("orcid", "staffid").agg(F.count(F.lit(1)).alias("n"))


def conflicting_orcids(authors: DataFrame) -> DataFrame:
    """(staffid, orcid): every ORCID of each staff id that occurs with more than one."""
    pairs = authors.where(c("orcid").isNotNull() & c("staffid").isNotNull()).select("staffid", "orcid").distinct()
    several = pairs.groupBy("staffid").agg(F.count(F.lit(1)).alias("__n")).where(c("__n") > 1)
    return pairs.join(several, "staffid").select("staffid", "orcid")


def conflicting_orcid_rows(authors: DataFrame) -> DataFrame:
    """Author rows whose staff id also occurs with another ORCID, once each, with the number of other ORCIDs.

    ``conflicting_orcids`` names them all; kept apart, both tables follow the
    size of the input and not rows times ORCIDs.
    """
    others = conflicting_orcids(authors).groupBy("staffid").agg((F.count(F.lit(1)) - 1).alias("n_other"))
    return authors.where(c("orcid").isNotNull()).join(others, "staffid")


def orcids_with_several_staff_ids(authors: DataFrame) -> DataFrame:
    details = shared_orcids(authors)
    n = details.groupBy("orcid").agg(F.count(F.lit(1)).alias("n_staff"))
    return collapse(details, ["orcid"], "staffid", "staffids").join(n, "orcid")


def orcids_without_authority(authors: DataFrame) -> DataFrame:
    per = authors.where(c("orcid").isNotNull()).groupBy("orcid").agg(
        F.count_distinct("autid").alias("n_autids"), F.count_distinct("staffid").alias("n_staff"),
        F.count_distinct("PID").alias("n_pids"),
    )
    return per.where((c("n_autids") == 0) & (c("n_staff") >= 1))


def orcids_partly_without_staff_id(authors: DataFrame) -> DataFrame:
    per = authors.where(c("orcid").isNotNull()).groupBy("orcid").agg(
        n_distinct(c("staffid")).alias("n_ids"), F.count_if(c("staffid").isNull()).alias("n_missing"),
        F.max("staffid").alias("staffid"),
    )
    return per.where((c("n_missing") > 0) & (c("n_ids") > 1))


def orcids_unlike_directory(authors: DataFrame, directory: DataFrame) -> DataFrame:
    """Registered ORCID differs from the directory's by more than letter case."""
    mine = authors.where(c("orcid").isNotNull() & c("staffid").isNotNull()).select("staffid", "orcid").distinct()
    theirs = directory.select("staffid", c("orcid").alias("directory_orcid")).distinct()
    return mine.join(theirs, "staffid").where(F.lower("orcid") != F.lower("directory_orcid"))


# --- checks named in the catalogue only ------------------------------------------

def check_article_without_journal(pubs: DataFrame) -> DataFrame:
    return pubs.where((c("PublicationType") == ARTICLE) & c("Journal").isNull()).select("PID", "Year", "Title")


def check_chapter_without_book(pubs: DataFrame, book: str = "HostPublication") -> DataFrame:
    return pubs.where((c("PublicationType") == CHAPTER) & c(book).isNull()).select("PID", "Year", "Title")


def check_same_staff_id_twice(authors: DataFrame) -> DataFrame:
    return counts(authors.where(c("staffid").isNotNull()), ["PID", "staffid"], "n", at_least=2)


def check_unit_before_start(authors: DataFrame, pubs: DataFrame, organisations: DataFrame, year: int = 2005) -> DataFrame:
    """Records older than ``year`` on a unit of the later structure, and later
    records on a unit closed before it."""
    units = organisations.select(c("orgid").cast("string").alias("orgid"), F.year("closed_date").alias("__closed"))
    rows = authors.select("PID", "name", "orgid").join(units, "orgid").join(pubs.select("PID", "Year"), "PID")
    late = (c("Year") >= year) & (c("__closed") < year)
    early = (c("Year") < year) & c("__closed").isNull()
    return rows.where(late | early).select(
        "PID", "name", "orgid", "Year", F.when(late, "closed unit").otherwise("later unit").alias("issue")
    )


# --- registry ----------------------------------------------------------------------

@dataclass(frozen=True)
class Groups:
    """How many rows a check has for each group of publications of one key.

    ``key`` has the parts of the key, ``where`` the rows that belong to a group. A group has ``value`` rows, an expression over
    ``n`` (its publications within the prefilter), ``n_all`` (all of them) and ``amount`` (the largest ``amount`` of its rows).
    """

    key: tuple[Column, ...]
    where: Column
    value: str
    amount: Column | None = None


def _repeats(key: Callable[[], Column], value: str) -> Callable[[], list[Groups]]:
    return lambda: [Groups((key(),), key().isNotNull(), value)]


def _issn_groups() -> list[Groups]:
    return [Groups((F.lit(n), c(n), c("PID"), c("Year")), bad_issn(n), "if(n > 0, 1, 0)") for n in ("JournalISSN", "JournalEISSN")]


def _isbn_groups() -> list[Groups]:
    return [Groups((c("PID"), c("ISBN"), c("Year")), n_bad_isbn() > 0, "if(n > 0, amount, 0)", n_bad_isbn())]


def _chapter_groups() -> list[Groups]:
    return [Groups((c("Title"),), (c("PublicationType") == CHAPTER) & (F.length("Title") < 20), "if(n > 1, 1, 0)")]


def _stale_groups(as_of: dt.date) -> list[Groups]:
    return [Groups((c("PublicationType"), F.year("CreatedDate")), not_checked(as_of), "if(n_all > 0, 1, 0)")]


@dataclass(frozen=True)
class Check:
    """How one check is run, sorted and linked.

    ``weight`` counts a row check's rows per source row, which is what lets the
    statistics of all row checks come from one scan. ``groups`` does the same for
    checks whose rows are groups of publications, see :class:`Groups`; ``linked``
    for rows of authors that are joined with their publications.
    """

    run: Callable[..., DataFrame]
    needs: tuple[str, ...]
    weight: Callable[..., Column] | None = None
    groups: Callable[..., list[Groups]] | None = None
    linked: tuple[Callable[[], Column], str] | None = None
    order: tuple[str, ...] = ()
    links: dict[str, str] = field(default_factory=dict)


_PID = {"PID": "PID"}
_IDS = {"PID": "PID", "ISI": "ISI", "DOI": "DOI", "ScopusId": "ScopusID"}
_TITLED = {**_IDS, "Title": "titlesearch"}
_flag = lambda col: col.cast("int")

CHECKS: dict[str, Check] = {
    "article_title_multiplettes": Check(
        check_duplicate_article_titles, ("pubs", "authors"),
        order=("-LastUpdated", "-check_key", "-n_check", "-Title"), links={"PID": "PID", "Title": "titlesearch"}),
    "title_multiplettes": Check(
        check_duplicate_titles, ("pubs", "authors", "stop_list"),
        order=("-n_check", "-check_key", "-Title", "-LastUpdated"), links={"PID": "PID", "Title": "titlesearch"}),
    "submission_status_invalid": Check(
        check_submission_status, ("pubs",), lambda: _flag(submission_status_invalid()), links=_IDS),
    "missing_staffid": Check(
        check_missing_staff_id, ("authors", "pubs"), linked=(missing_staff_id, "inner"), order=("-LastUpdated",),
        links={**_PID, "name": "freetextsearch", "orcid": "ORCID", "DOI": "DOI", "ScopusId": "ScopusID"}),
    "missing_aid": Check(
        check_missing_aid, ("authors", "pubs"), linked=(missing_staff_id, "inner"), order=("-LastUpdated",), links=_PID),
    "missing_orcids": Check(check_missing_orcids, ("authors",), order=("-n_na_pubs",), links={"orcid": "ORCID"}),
    "missing_confpubdate": Check(check_missing_date, ("pubs",), lambda: _flag(missing_date())),
    "missing_journal_ids": Check(
        check_missing_journal_ids, ("pubs",), lambda: _flag(missing_journal_ids()),
        links={"PID": "PID", "Title": "titlesearch", "DOI": "DOI", "ScopusId": "ScopusID", "Name": "freetextsearch"}),
    "odd_book_chapters": Check(check_book_chapter_titles, ("pubs",), groups=_chapter_groups, order=("-n",)),
    "invalid_ISI": Check(check_invalid_isi, ("pubs",), lambda: _flag(bad_format("ISI", ids.ISI_FORMAT)), links=_IDS),
    "invalid_DOI": Check(check_invalid_doi, ("pubs",), lambda: _flag(bad_format("DOI", ids.DOI_FORMAT)), links=_IDS),
    "invalid_ISSN": Check(
        check_invalid_issn, ("pubs",),
        lambda: _flag(bad_issn("JournalISSN")) + _flag(bad_issn("JournalEISSN")), groups=_issn_groups, links=_PID),
    "invalid_staffid": Check(check_invalid_staff_id, ("authors",), lambda: _flag(invalid_staff_id()), links=_IDS),
    "invalid_aid": Check(
        check_invalid_aid, ("authors",), lambda: _flag(bad_format("staffid", ids.AUTHORITY_ID_FORMAT)), links=_IDS),
    "invalid_orcid": Check(
        check_invalid_orcid, ("authors", "pubs"), lambda: _flag(bad_format("orcid", ids.ORCID_FORMAT)),
        linked=(lambda: bad_format("orcid", ids.ORCID_FORMAT), "left"), links=_IDS),
    "invalid_scopusid": Check(
        check_invalid_scopus_id, ("pubs",), lambda: _flag(bad_format("ScopusId", ids.SCOPUS_FORMAT)),
        order=("-Year",), links=_IDS),
    "invalid_isbn": Check(check_invalid_isbn, ("pubs",), n_bad_isbn, groups=_isbn_groups, links={"PID": "PID", "ISBN": "ISBN"}),
    "invalid_use_isbn": Check(
        check_invalid_use_isbn, ("pubs",), lambda: _flag(invalid_use_isbn()), order=("-LastUpdated",),
        links={"PID": "PID", "Title": "titlesearch", "ISBN": "ISBN"}),
    "invalid_authorname": Check(
        check_invalid_author_name, ("authors",), lambda: _flag(invalid_author_name()), links=_PID),
    "uncertain_published": Check(
        check_uncertain_published, ("pubs",), lambda: _flag(published_by_note()) + _flag(published_by_check())),
    "multiplettes_scopusid": Check(
        check_duplicate_scopus_id, ("pubs", "expand_against"), groups=_repeats(lambda: c("ScopusId"), "if(n > 1, n_all, 0)"),
        order=("-n_pids", "-ScopusId", "-LastUpdated"), links=_TITLED),
    # the established report shows the bare Scopus id in this one
    "multiplettes_DOI": Check(
        check_duplicate_doi, ("pubs",), groups=_repeats(lambda: F.lower("DOI"), "if(n > 1, n, 0)"), order=("-n_pids", "-DOI", "-LastUpdated"),
        links={k: v for k, v in _TITLED.items() if k != "ScopusId"}),
    "multiplettes_ISI": Check(
        check_duplicate_isi, ("pubs", "expand_against"), groups=_repeats(lambda: c("ISI"), "if(n > 1, n_all, 0)"), order=("-n_pids", "-ISI", "-LastUpdated"), links=_TITLED),
    "manuscripts_with_identifiers": Check(
        check_manuscripts_with_identifiers, ("pubs",), lambda: _flag(manuscript_with_identifier()),
        order=("-LastUpdated",), links={**_TITLED, "PMID": "PMID"}),
    "non_qc": Check(
        check_not_checked, ("pubs", "as_of", "since"), lambda as_of, since: _flag(not_checked_since(as_of, since)), links=_PID),
    "non_qc_stale": Check(
        check_not_checked_stale, ("pubs", "as_of"), lambda as_of: _flag(not_checked(as_of)), groups=_stale_groups,
        order=("-y",)),
}
