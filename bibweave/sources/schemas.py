"""Canonical table layouts as DDL text (fixed by name; other columns are strings)."""

from __future__ import annotations

PUBLICATIONS = (
    "PID bigint, Year int, Title string, Name string, PublicationType string, Status string, Notes string, "
    "DOI string, ISI string, ScopusId string, PMID bigint, ISBN string, JournalISSN string, JournalEISSN string, "
    "SeriesISSN string, Journal string, HostPublication string, Keywords string, Contributor string, "
    "Abstract string, NumberOfAuthors int, ISRN string, NBN string, CreatedDate date, PublicationDate date, "
    "LastUpdated date"
)

AUTHORS = (
    "PID bigint, name string, staffid string, orcid string, orgid string, extorg string, pos int, autid string, "
    "role string, `group` string, DOI string, ISI string, ScopusId string, uses_etal boolean, is_extorg boolean"
)

# Columns of the author export and their short names.
AUTHOR_RENAMES = {
    "LocalId": "staffid",
    "ORCID": "orcid",
    "OrganisationId": "orgid",
    "AuthorityPid": "autid",
    "UncontrolledOrganisation": "extorg",
    "Position": "pos",
    "ResearchGroup": "group",
    "Role": "role",
}

HR = (
    "staffid string, yob int, unit_abbr string, unit_name string, firstname string, lastname string, "
    "gender string, emp_code string, emp_desc string, emp_nr int, emp_beg date, emp_end date, emp_lastmod date, "
    "emp_degree double, scb_topic string, is_public string, emp_title_swe string, emp_title_eng string, "
    "unit_school string, unit_status string, email string"
)

ORGANISATIONS = (
    "orgid int, p_orgid int, n_pubs double, level int, unit_en string, unit_sv string, is_closed boolean, "
    "closed_date date, url string"
)

STOP_LIST = "PID double, Title string"

LINKS = "`from` string, from_id string, `to` string, to_id string, strength double, curated boolean, date date"

CHECK_STATS = "name string, value bigint"
