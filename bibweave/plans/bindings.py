"""Bibliographic tables derived from the test tables.

The same select texts build the Spark views and the SQL counterparts, so both
sides start from equal rows; only the operators under test differ. Gaps and
faults are spread over all rows by key arithmetic, no row is left out.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from bibweave.plans.registry import table

AS_OF = dt.date(2001, 8, 1)

PUBS = """
SELECT
  o_orderkey AS "PID",
  CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS INT) + 20 END AS "Year",
  CASE WHEN o_orderkey % 5 = 1 THEN upper(concat('Study of ', o_custkey, ' in ', year(o_orderdate)))
       WHEN o_orderkey % 5 = 2 THEN concat(' study of ', o_custkey, ' in ', year(o_orderdate), ' ')
       WHEN o_orderkey % 29 = 3 THEN 'Introduction to systems'
       WHEN o_orderkey % 31 = 4 THEN concat('Chapter ', o_custkey % 50)
       ELSE concat('Study of ', o_custkey, ' in ', year(o_orderdate)) END AS "Title",
  concat('Author', o_custkey, ', A. [u1', lpad(CAST(o_custkey AS VARCHAR(20)), 6, '0'), ']') AS "Name",
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Artikel i tidskrift' WHEN '2-HIGH' THEN 'Konferensbidrag'
       WHEN '3-MEDIUM' THEN 'Kapitel i bok, del av antologi' WHEN '5-LOW' THEN 'Manuskript (preprint)'
       ELSE 'Artikel, forskningsöversikt' END AS "PublicationType",
  CASE WHEN o_orderkey % 6 = 5 THEN NULL WHEN o_orderstatus = 'F' THEN 'submitted'
       WHEN o_orderstatus = 'P' THEN 'accepted' ELSE 'published' END AS "Status",
  CASE o_orderkey % 11 WHEN 0 THEN NULL WHEN 1 THEN '<p>QC 2024</p>' WHEN 2 THEN '<b>Q</b>P &amp; more'
       WHEN 3 THEN 'NQC <i>x</i>' WHEN 4 THEN 'Imported from Scopus. VERIFY.' WHEN 5 THEN 'Not duplicate with 12'
       WHEN 6 THEN '<p>No ISSN</p>' WHEN 7 THEN '' WHEN 8 THEN 'QC 1' ELSE 'plain &lt;note&gt;' END AS "Notes",
  CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 13 = 1 THEN concat('doi:10.5/', o_orderkey)
       WHEN o_orderkey % 17 = 2 THEN concat('10.1101/', o_orderkey)
       WHEN o_orderkey % 2 = 0 THEN concat('10.1000/ABC.', o_custkey, '.', year(o_orderdate))
       ELSE concat('10.1000/abc.', o_custkey, '.', year(o_orderdate)) END AS "DOI",
  CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 19 = 1 THEN concat('bad', o_orderkey)
       WHEN o_orderkey % 23 = 1 THEN concat('A1981ABCDE', lpad(CAST(o_custkey % 100000 AS VARCHAR(20)), 5, '0'))
       ELSE concat('000', lpad(CAST(o_custkey * 100 + month(o_orderdate) AS VARCHAR(20)), 12, '0')) END AS "ISI",
  CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 37 = 1 THEN concat('2-s2.0-', o_orderkey)
       ELSE concat('2-s2.0-', lpad(CAST(o_custkey * 10 + month(o_orderdate) % 5 AS VARCHAR(20)), 11, '0')) END AS "ScopusId",
  CASE WHEN o_orderkey % 9 = 0 THEN o_orderkey + 1000000 ELSE NULL END AS "PMID",
  CASE o_orderkey % 10 WHEN 0 THEN '978-0-306-40615-7;0-306-40615-2' WHEN 1 THEN '978-0-306-40615-8'
       WHEN 2 THEN '0306406152' WHEN 3 THEN ' 0306406152' WHEN 4 THEN '080442957X;97803064061571'
       ELSE NULL END AS "ISBN",
  CASE WHEN o_orderkey % 8 = 0 THEN NULL WHEN o_orderkey % 8 = 1 THEN '0378-5955' WHEN o_orderkey % 8 = 2 THEN '0378-5956'
       WHEN o_orderkey % 8 = 3 THEN '03785955' WHEN o_orderkey % 8 = 4 THEN '0378_5955' WHEN o_orderkey % 8 = 5 THEN NULL
       ELSE '2434-561X' END AS "JournalISSN",
  CASE WHEN o_orderkey % 8 IN (0, 5) THEN NULL WHEN o_orderkey % 8 = 1 THEN '0378-5955'
       WHEN o_orderkey % 8 = 6 THEN '2434-561x' WHEN o_orderkey % 8 = 7 THEN '1234å5678' ELSE '1234-5679' END AS "JournalEISSN",
  CASE WHEN o_orderkey % 50 = 7 THEN '1234–567ö' ELSE NULL END AS "SeriesISSN",
  CASE WHEN o_orderkey % 12 = 0 THEN NULL ELSE concat('Journal ', o_custkey % 97) END AS "Journal",
  CASE WHEN o_orderkey % 15 = 0 THEN NULL ELSE concat('Book ', o_custkey % 89) END AS "HostPublication",
  CAST(o_orderdate AS DATE) AS "CreatedDate",
  CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS "PublicationDate",
  CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INT) AS "LastUpdated"
FROM orders
"""

AUTHORS = """
SELECT
  l_orderkey AS "PID",
  l_linenumber AS pos,
  CASE WHEN l_partkey % 101 = 0 THEN concat('$$$Last', l_suppkey, ', F')
       ELSE concat(chr(CAST(65 + l_suppkey % 26 AS INT)), 'last', l_suppkey, ', F', l_partkey % 3) END AS name,
  CASE WHEN l_partkey % 4 = 0 THEN NULL WHEN l_partkey % 59 = 1 THEN concat('PI', l_suppkey)
       WHEN l_partkey % 61 = 1 THEN concat('zz', l_suppkey) WHEN l_partkey % 67 = 1 THEN 'ab12'
       ELSE concat('u1', chr(CAST(97 + l_suppkey % 26 AS INT)), lpad(CAST(l_suppkey AS VARCHAR(20)), 5, '9')) END AS staffid,
  CASE WHEN l_partkey % 5 IN (0, 1) THEN NULL
       WHEN l_partkey % 71 = 2 AND l_suppkey % 3 <> 0 THEN concat('0000-0002-1825-', l_suppkey % 10)
       WHEN l_partkey % 73 = 2 AND l_suppkey % 3 <> 0 THEN concat('0000-0001-0000-', lpad(CAST((l_suppkey + 1) % 10000 AS VARCHAR(20)), 4, '0'))
       ELSE concat('0000-0001-0000-', lpad(CAST(l_suppkey % 10000 AS VARCHAR(20)), 4, '0')) END AS orcid,
  CASE WHEN l_partkey % 6 = 0 THEN NULL WHEN l_partkey % 7 = 3 THEN CAST(l_suppkey + 1 AS VARCHAR(20))
       ELSE CAST(l_suppkey AS VARCHAR(20)) END AS orgid,
  CASE WHEN l_partkey % 6 = 0 THEN concat('Ext ', l_partkey % 10) ELSE NULL END AS extorg,
  CASE WHEN l_partkey % 2 = 0 OR l_suppkey % 9 = 0 THEN NULL ELSE concat('aut', l_suppkey) END AS autid,
  CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE concat('10.1000/', CASE WHEN l_partkey % 83 = 0 THEN 'å' ELSE 'a' END, l_orderkey) END AS "DOI",
  CAST(NULL AS VARCHAR(20)) AS "ISI",
  concat('2-s2.0-', l_orderkey) AS "ScopusId"
FROM lineitem
"""

ORGANISATIONS = """
SELECT
  CAST(s_suppkey AS INT) AS orgid,
  CAST(CASE WHEN s_suppkey < 10 THEN NULL ELSE floor(s_suppkey / 10) END AS INT) AS p_orgid,
  concat('Unit ', s_suppkey) AS unit_en,
  concat('Enhet ', s_suppkey) AS unit_sv,
  s_acctbal < 3000 AS is_closed,
  CASE WHEN s_acctbal < 3000 THEN CAST('2010-06-30' AS DATE) + CAST(floor(s_acctbal) AS INT) ELSE NULL END AS closed_date
FROM supplier
"""

HR = """
SELECT
  concat('u1', lpad(CAST(o_custkey AS VARCHAR(20)), 6, '0')) AS staffid,
  CASE WHEN o_custkey % 97 = 0 THEN 1900 WHEN o_custkey % 89 = 1 THEN 2010 ELSE CAST(1930 + o_custkey % 60 AS INT) END AS yob,
  concat('A/B/u', o_custkey % 40) AS unit_abbr,
  concat('Unit ', o_custkey % 40) AS unit_name,
  CASE WHEN o_custkey % 53 = 0 THEN concat('F  x', o_custkey) ELSE concat('F', o_custkey) END AS firstname,
  CASE WHEN o_custkey % 47 = 0 THEN concat('L', o_custkey, ' ') ELSE concat('L', o_custkey) END AS lastname,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'PROFESSOR' WHEN '2-HIGH' THEN 'DOKTORAND' WHEN '3-MEDIUM' THEN 'INGENJÖR'
       ELSE 'ADMINISTRATÖR' END AS emp_desc,
  substr(o_orderpriority, 1, 1) AS emp_code,
  CAST(o_orderdate AS DATE) AS emp_beg,
  CAST(o_orderdate AS DATE) + CAST(floor(o_totalprice / 100) AS INT) AS emp_end,
  CAST(o_orderdate AS DATE) + CAST(o_orderkey % 900 - 50 AS INT) AS emp_lastmod,
  CASE WHEN o_custkey % 31 = 0 THEN NULL WHEN o_custkey % 29 = 0 THEN '999' ELSE CAST(101 + o_custkey % 60 AS VARCHAR(20)) END AS scb_topic,
  concat('l', o_custkey, '@example.org') AS email,
  o_orderkey AS emp_key
FROM orders
"""

# Subject codes: one per part size.
RESEARCH_AREAS = """
SELECT DISTINCT CAST(100 + p_size AS VARCHAR(20)) AS id, concat('Area ', p_size) AS eng, concat('Omrade ', p_size) AS swe,
  2 AS level
FROM part
"""

BATCH_PUBS = """
SELECT concat('SCOPUS_ID:', o_orderkey) AS sid,
  concat('2-s2.0-', lpad(CAST(o_custkey * 10 + month(o_orderdate) % 7 AS VARCHAR(20)), 11, '0')) AS eid,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE concat('10.1000/aBc.', o_custkey, '.', year(o_orderdate)) END AS doi,
  CAST(o_orderdate AS DATE) AS cover_date,
  CASE WHEN o_orderstatus = 'F' THEN 'Journal' WHEN o_orderstatus = 'P' THEN 'Conference Proceeding' ELSE 'Book' END AS aggregation,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Article' WHEN '2-HIGH' THEN 'Conference Paper' WHEN '3-MEDIUM' THEN 'Erratum'
       WHEN '5-LOW' THEN 'Book Chapter' ELSE 'Review' END AS subtype,
  concat('Title & <', o_orderkey, '>') AS title
FROM orders
"""

BOUND = {
    "pubs": (PUBS, ["orders"]),
    "authors": (AUTHORS, ["lineitem"]),
    "organisations": (ORGANISATIONS, ["supplier"]),
    "hr": (HR, ["orders"]),
    "areas": (RESEARCH_AREAS, ["part"]),
    "batch": (BATCH_PUBS, ["orders"]),
}


def bound(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived table as a DataFrame."""
    text, sources = BOUND[name]
    body = text.replace('"', "`")
    for s in sources:
        body = body.replace(f"FROM {s}", "FROM {%s}" % s)
    return spark.sql(body, **{s: table(spark, sf_dir, s) for s in sources})


def with_bound(*names: str, sql: str) -> str:
    """SQL text with the derived tables as leading common table expressions;
    ``sql`` is a select, or further expressions followed by a select."""
    heads = ", ".join(f"{n} AS ({BOUND[n][0].strip()})" for n in names)
    body = sql.strip()
    return f"WITH {heads}{' ' if body.upper().startswith('SELECT') else ', '}{body}"
