"""HTML anchors for reports. Applied only where a table leaves the engine."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from bibweave.functions.text import shorten

# Address prefixes and suffixes per link target; ``{portal}``
# is filled in by the caller.
PREFIX = {
    "PID": "{portal}/smash/record.jsf?dswid=-310&pid=diva2%3A",
    "DOI": "https://doi.org/",
    "ScopusID": "https://www.scopus.com/record/display.url?origin=inward&partnerID=40&eid=",
    "ISSN": "https://portal.issn.org/api/search?search[]=MUST=allissnbis=%22",
    "ISBN": "https://www.worldcat.org/search?q=bn%3A",
    "ISI": "https://www.webofscience.com/wos/woscc/full-record/WOS:",
    "ORCID": "https://orcid.org/",
    "PMID": "https://pubmed.ncbi.nlm.nih.gov/",
    "titlesearch": (
        "{portal}/smash/resultList.jsf?aq2=%5B%5B%5D%5D&af=%5B%5D&searchType=RESEARCH"
        "&sortOrder2=title_sort_asc&language=en&aq=%5B%5B%7B%22titleAll%22%3A%22"
    ),
    "freetextsearch": (
        "{portal}/smash/resultList.jsf?language=en&searchType=RESEARCH&query=&af=%5B%5D"
        "&aq=%5B%5B%7B%22freeText%22%3A%22"
    ),
}
SUFFIX = {
    "ISSN": "%22",
    "ISBN": "&qt=advanced&dblist=638",
    "titlesearch": (
        "%22%7D%5D%5D&sf=all&aqe=%5B%5D&sortOrder=author_sort_asc&onlyFullText=false"
        "&noOfRows=50&dswid=-4347"
    ),
    "freetextsearch": (
        "%22%7D%5D%5D&aq2=%5B%5B%5D%5D&aqe=%5B%5D&noOfRows=50&sortOrder=author_sort_asc"
        "&sortOrder2=title_sort_asc&onlyFullText=false&sf=all"
    ),
}
SEARCHES = ("titlesearch", "freetextsearch")


def percent_encoded(col: Column) -> Column:
    return F.replace(F.url_encode(col), F.lit("+"), F.lit("%20"))


def address(col: Column, target: str = "href", portal: str = "") -> Column:
    """Address for an identifier; an unknown target gives the raw value."""
    value = col.cast("string")
    if target not in PREFIX:
        return value
    body = percent_encoded(value) if target in SEARCHES else value
    return F.concat(
        F.lit(PREFIX[target].replace("{portal}", portal)), body, F.lit(SUFFIX.get(target, ""))
    )


def anchor(href: Column, text: Column, title: Column) -> Column:
    return F.concat(
        F.lit("<a href='"), href, F.lit("' target='_blank' rel='noopener noreferrer' title='"),
        title, F.lit("'>"), text, F.lit("</a>"),
    )


def linkify(
    col: Column, target: str = "href", portal: str = "", text: Column | None = None, title: Column | None = None
) -> Column:
    """Anchor for a value; a missing value gives a missing anchor."""
    value = col.cast("string")
    return anchor(
        address(col, target, portal),
        shorten(value) if text is None else text,
        value if title is None else title,
    )


def link_nonempty(col: Column, target: str = "href", portal: str = "", text: Column | None = None) -> Column:
    """The older link form: an empty address or text gives a missing anchor."""
    value = col.cast("string")
    shown = value if text is None else text.cast("string")
    made = anchor(address(col, target, portal), shorten(shown), shown)
    return F.when((F.length(value) > 0) & (F.length(shown) > 0), made)
