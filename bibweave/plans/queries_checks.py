"""Quality checks (Q series) over the derived corpus."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from bibweave.operators import checks as q
from bibweave.operators.names import parse_records
from bibweave.plans.bindings import AS_OF, BOUND, bound, with_bound
from bibweave.plans.check_run import OTHER, STANDARD, CheckRun
from bibweave.plans.registry import ORACLES, query, table
from bibweave.session import spread

SINCE = dt.date(1999, 1, 1)

# Text clean-up as SQL, for the counterparts.
CLEAN = (
    "replace(replace(replace(replace(regexp_replace(\"Notes\", '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), "
    "'&quot;', '\"'), '&amp;', '&')"
)
PRE = (
    "pre AS (SELECT * FROM pubs WHERE NOT coalesce(regexp_matches(\"Notes\", 'Imported from Scopus\\. VERIFY'), false) "
    "AND \"CreatedDate\" < DATE '2001-07-02')"
)
INITIALS = (
    "ini AS (SELECT \"PID\", string_agg(letter, '' ORDER BY pos, letter) AS initials FROM (SELECT \"PID\", pos, "
    "substr(regexp_replace(name, '(.+?)(,.*)', '\\1'), 1, 1) AS letter FROM authors) GROUP BY \"PID\")"
)
ISSN_BARE = "replace({c}, '-', '')"


def digit(expr: str, i: int) -> str:
    ch = f"upper(substr({expr}, {i}, 1))"
    return f"(CASE WHEN {ch} = 'X' THEN 10 ELSE TRY_CAST({ch} AS INT) END)"


def issn_sql(col: str) -> str:
    bare = f"replace({col}, '-', '')"
    total = " + ".join(f"{digit(bare, i)} * {9 - i}" for i in range(1, 9))
    return f"coalesce(regexp_matches({bare}, '^\\d{{7}}[\\dXx]$') AND ({total}) % 11 = 0, false)"


def isbn10_sql(col: str) -> str:
    bare = f"replace({col}, '-', '')"
    total = " + ".join(f"{digit(bare, i)} * {11 - i}" for i in range(1, 11))
    return f"coalesce(regexp_matches({bare}, '^\\d{{9}}[\\dXx]$') AND ({total}) % 11 = 0, false)"


def isbn13_sql(col: str) -> str:
    bare = f"replace({col}, '-', '')"
    total = " + ".join(f"{digit(bare, i)} * {1 if i % 2 else 3}" for i in range(1, 14))
    return f"coalesce(regexp_matches({bare}, '^\\d{{13}}$') AND ({total}) % 10 = 0, false)"


BAD_ISSN_J = f"NOT {issn_sql('\"JournalISSN\"')} OR NOT regexp_matches(\"JournalISSN\", '^\\d{{4}}-?\\d{{3}}(X|x|\\d)$')"
BAD_ISSN_E = f"NOT {issn_sql('\"JournalEISSN\"')} OR NOT regexp_matches(\"JournalEISSN\", '^\\d{{4}}-?\\d{{3}}(X|x|\\d)$')"

Q12_SQL = with_bound("pubs", sql="""
k AS (SELECT lower("DOI") AS k, count(*) AS n_pids FROM pubs WHERE "DOI" IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
SELECT "PID", "Year", "Title", n_pids, "DOI", "ISI", "ScopusId", CAST("LastUpdated" AS VARCHAR) AS "LastUpdated"
FROM pubs JOIN k ON lower("DOI") = k.k""")


@query("q12_duplicate_doi", Q12_SQL)
def q12(spark, d):
    return q.check_duplicate_doi(bound(spark, d, "pubs"))


@query("q12_duplicate_document_text", """
WITH k AS (SELECT lower(trim(text)) AS k, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1)
SELECT doc_id, n FROM documents JOIN k ON lower(trim(text)) = k.k""")
def q12_documents(spark, d):
    from bibweave.functions.text import title_key
    from bibweave.operators.groups import with_count

    docs = table(spark, d, "documents").select("doc_id", F.xxhash64(title_key(F.col("text"))).alias("h1"),
                                               F.md5(title_key(F.col("text"))).alias("h2"))
    return with_count(docs, ["h1", "h2"], "n", at_least=2).select("doc_id", "n")


for _name, _key, _fn in [
    ("q13_duplicate_scopus_id", "ScopusId", q.check_duplicate_scopus_id),
    ("q14_duplicate_isi", "ISI", q.check_duplicate_isi),
]:
    _sql = with_bound("pubs", sql=PRE + f""",
k AS (SELECT "{_key}" AS k, count(*) AS n_pids FROM pre WHERE "{_key}" IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
SELECT "PID", "Year", "Title", n_pids, "DOI", "ISI", "ScopusId", CAST("LastUpdated" AS VARCHAR) AS "LastUpdated"
FROM pubs JOIN k ON "{_key}" = k.k""")

    @query(_name, _sql)
    def _dup(spark, d, _fn=_fn):
        pubs = bound(spark, d, "pubs")
        return _fn(q.prefilter(pubs, AS_OF), pubs)


def _keyed_sql(rows: str) -> str:
    return f"""{rows}, {INITIALS},
keyed AS (SELECT r.*, concat(ini.initials, '_', coalesce(CAST("Year" AS VARCHAR), 'NA')) AS check_key
  FROM rws r JOIN ini USING ("PID")),
nk AS (SELECT check_key, count(*) AS n_check FROM keyed GROUP BY 1)"""


@query("q01_duplicate_article_titles", with_bound("pubs", "authors", sql=_keyed_sql("""
t AS (SELECT *, trim(lower("Title")) AS lc FROM pubs WHERE "PublicationType" LIKE 'Artikel%'),
rws AS (SELECT t.*, n FROM t JOIN (SELECT lc, count(*) AS n FROM t GROUP BY 1 HAVING count(*) > 1) USING (lc))""") + """
SELECT "PID", "Year", "Title", check_key, n, n_check, CAST("LastUpdated" AS VARCHAR) AS "LastUpdated"
FROM keyed JOIN nk USING (check_key)"""))
def q01(spark, d):
    return q.check_duplicate_article_titles(bound(spark, d, "pubs"), bound(spark, d, "authors"))


# Stop list: the records whose note says that they have been looked at.
STOP_SQL = "SELECT \"PID\", \"Title\" FROM pubs WHERE \"Notes\" = '<p>QC 2024</p>'"


def _stop_list(spark, d):
    seen = bound(spark, d, "pubs").where(F.col("Notes") == "<p>QC 2024</p>")
    return seen.select(F.col("PID").cast("double").alias("PID"), "Title")


def _q02_sql(rule: str) -> str:
    return with_bound("pubs", "authors", sql=_keyed_sql(f"""
t AS (SELECT *, trim(lower("Title")) AS lc, {CLEAN} AS clean_notes FROM pubs),
u AS (SELECT * FROM t WHERE NOT coalesce(regexp_matches(clean_notes, '{q.NOT_DUPLICATE}'), false)),
w AS (SELECT u.*, n FROM u JOIN (SELECT lc, "PublicationType", count(*) AS n FROM u GROUP BY 1, 2 HAVING count(*) > 1)
  USING (lc, "PublicationType")),
rws AS (SELECT * FROM w WHERE "JournalISSN" = "JournalEISSN" OR {rule})""") + f"""
SELECT "PID", "Year", "Title", "PublicationType", n_check, n, CAST("LastUpdated" AS VARCHAR) AS "LastUpdated",
  "JournalISSN", "JournalEISSN", check_key, clean_notes
FROM keyed JOIN nk USING (check_key)
WHERE NOT regexp_matches("Title", '{q.STOP_TITLES.replace("'", "''")}')
  AND NOT EXISTS (SELECT 1 FROM ({STOP_SQL}) s WHERE s."PID" = keyed."PID" AND s."Title" = keyed."Title")""")


@query("q02_duplicate_titles", _q02_sql(
    "(SELECT bool_or(\"JournalISSN\" IS NULL OR \"JournalEISSN\" IS NULL) FROM w)"))
def q02(spark, d):
    return q.check_duplicate_titles(bound(spark, d, "pubs"), bound(spark, d, "authors"), _stop_list(spark, d))


@query("q02_duplicate_titles_by_row", _q02_sql("\"JournalISSN\" IS NULL OR \"JournalEISSN\" IS NULL"))
def q02_row(spark, d):
    return q.check_duplicate_titles(
        bound(spark, d, "pubs"), bound(spark, d, "authors"), _stop_list(spark, d), parity=False)


def pub_check(name: str, fn, sql: str):
    query(name, with_bound("pubs", sql=sql))(lambda spark, d: fn(bound(spark, d, "pubs")))


def author_check(name: str, fn, sql: str):
    query(name, with_bound("authors", sql=sql))(lambda spark, d: fn(bound(spark, d, "authors")))


IDS = '"PID", "Year", "ISI", "DOI", "ScopusId"'
LU = 'CAST("LastUpdated" AS VARCHAR) AS "LastUpdated"'

pub_check("q03_submission_status", q.check_submission_status, f"""SELECT {IDS} FROM pubs
WHERE "Status" = 'submitted' AND ("DOI" IS NOT NULL OR "ISI" IS NOT NULL OR "ScopusId" IS NOT NULL)""")

for _name, _fn, _id in [
    ("q04_missing_staffid", q.check_missing_staff_id, "staffid"), ("q05_missing_aid", q.check_missing_aid, "aid"),
]:
    @query(_name, with_bound("pubs", "authors", sql=f"""SELECT a."PID", "Year", a.name, {LU}, staffid AS {_id}, orcid,
a."DOI", a."ScopusId" FROM authors a JOIN pubs p ON a."PID" = p."PID" WHERE orgid IS NOT NULL AND staffid IS NULL"""))
    def _missing(spark, d, _fn=_fn):
        return _fn(bound(spark, d, "authors"), bound(spark, d, "pubs"))

author_check("q06_missing_orcids", q.check_missing_orcids, """
SELECT staffid, min(orcid) AS orcid, count(*) FILTER (WHERE orcid IS NULL) AS n_na_pubs FROM authors
WHERE staffid IS NOT NULL AND NOT regexp_matches(staffid, '00000*|-') GROUP BY staffid
HAVING count(DISTINCT orcid) = 1 AND count(*) FILTER (WHERE orcid IS NULL) > 9""")

pub_check("q07_missing_date", lambda p: q.check_missing_date(p).select("PID", "Title", "PublicationType"), """
SELECT "PID", "Title", "PublicationType" FROM pubs WHERE "PublicationDate" IS NULL AND "Year" IS NULL""")

pub_check("q08_missing_journal_ids", q.check_missing_journal_ids, f"""
SELECT "PID", "Year", "Title", {LU}, "JournalISSN", "JournalEISSN", "Journal", "PublicationType", "Status", "DOI",
"ScopusId", "Name", {CLEAN} AS clean_notes FROM pubs WHERE "PublicationType" = 'Artikel i tidskrift'
AND "JournalISSN" IS NULL AND "JournalEISSN" IS NULL
AND NOT coalesce({CLEAN} LIKE '%No ISSN%', false) AND ("Status" IS NULL OR "Status" NOT IN ('submitted', 'accepted'))""")

pub_check("q09_book_chapter_titles", q.check_book_chapter_titles, """
SELECT "Title", count(*) AS n, CAST(0 AS INT) AS piece, string_agg(CAST("PID" AS VARCHAR), ' ' ORDER BY "PID") AS pids
FROM pubs WHERE "PublicationType" = 'Kapitel i bok, del av antologi' AND length("Title") < 20
GROUP BY "Title" HAVING count(*) > 1""")

pub_check("q10_invalid_isi", q.check_invalid_isi, f"""SELECT {IDS} FROM pubs WHERE "ISI" IS NOT NULL
AND NOT regexp_matches("ISI", '^A19\\d{{2}}[A-Z\\d]{{5}}\\d{{5}}$|^000\\d{{12}}$|^001\\d{{12}}$')""")
pub_check("q11_invalid_doi", q.check_invalid_doi,
          f"""SELECT {IDS} FROM pubs WHERE "DOI" IS NOT NULL AND NOT starts_with("DOI", '10.')""")

AUT = '"PID", pos, name, {id}, orcid, orgid, extorg, autid, "DOI", "ISI", "ScopusId"'
author_check("q15_invalid_aid", q.check_invalid_aid, f"""SELECT {AUT.format(id="staffid AS aid")} FROM authors
WHERE staffid IS NOT NULL AND NOT regexp_matches(staffid, '^[a-z0-9]{{4}}$')""")
author_check("q16_invalid_staffid", q.check_invalid_staff_id, f"""SELECT {AUT.format(id="staffid")} FROM authors
WHERE staffid IS NOT NULL AND NOT regexp_matches(staffid, '^u1[a-z0-9]{{6}}$')
AND NOT regexp_matches(staffid, '^PI\\d+|P\\d+|pi\\d+|p\\d+|Pi\\d+|PI \\d+|-')""")


@query("q17_invalid_orcid", with_bound("pubs", "authors", sql=f"""
SELECT a.*, "Year", {LU} FROM authors a LEFT JOIN pubs p ON a."PID" = p."PID" WHERE orcid IS NOT NULL
AND NOT regexp_matches(orcid, '^([0-9]{{4}})+(-)+([0-9]{{4}})+(-)+([0-9]{{4}})+(-)+([0-9]{{3}}[0-9Xx])$')"""))
def q17(spark, d):
    return q.check_invalid_orcid(bound(spark, d, "authors"), bound(spark, d, "pubs"))


def _orcid_sum() -> str:
    total = "0"
    bare = "replace(upper(orcid), '-', '')"
    for i in range(1, 16):
        total = f"(({total} + TRY_CAST(substr({bare}, {i}, 1) AS BIGINT)) * 2)"
    last = f"(CASE WHEN substr({bare}, 16, 1) = 'X' THEN 10 ELSE TRY_CAST(substr({bare}, 16, 1) AS INT) END)"
    return f"coalesce(regexp_matches({bare}, '^\\d{{15}}[\\dX]$') AND (12 - {total} % 11) % 11 = {last}, false)"


@query("q17_invalid_orcid_strict", with_bound("pubs", "authors", sql=f"""
SELECT a."PID", pos, orcid, "Year" FROM authors a LEFT JOIN pubs p ON a."PID" = p."PID" WHERE orcid IS NOT NULL AND (
NOT regexp_matches(orcid, '^([0-9]{{4}})+(-)+([0-9]{{4}})+(-)+([0-9]{{4}})+(-)+([0-9]{{3}}[0-9Xx])$')
OR NOT {_orcid_sum()})"""))
def q17_strict(spark, d):
    out = q.check_invalid_orcid(bound(spark, d, "authors"), bound(spark, d, "pubs"), strict=True)
    return out.select("PID", "pos", "orcid", "Year")


author_check("q18_ambiguous_orcid", q.check_ambiguous_orcid, """
many AS (SELECT orcid, staffid, name, autid, "PID" FROM authors WHERE orcid IS NOT NULL
  AND NOT coalesce(starts_with(staffid, 'PI'), false)),
o AS (SELECT orcid, count(DISTINCT staffid) AS n, count(DISTINCT "PID") AS tot,
  concat_ws(' ', string_agg(DISTINCT staffid, ' ' ORDER BY staffid), CASE WHEN bool_or(staffid IS NULL) THEN 'NA' END) AS ids
  FROM many GROUP BY orcid HAVING count(DISTINCT staffid) > 1),
p AS (SELECT orcid, staffid, name, autid, list_sort(list(DISTINCT "PID")) AS l FROM many GROUP BY ALL)
SELECT concat(orcid, ' (tot=', CASE WHEN length(CAST(tot AS VARCHAR)) < 3 THEN lpad(CAST(tot AS VARCHAR), 3, '0')
  ELSE CAST(tot AS VARCHAR) END, ' ids=', ids, ')') AS combo, staffid, name, autid, CAST(len(l) AS BIGINT) AS n_pids,
  array_to_string(l[1:10], ' ') AS example_pids
FROM p JOIN o USING (orcid)""")

pub_check("q19_invalid_scopus_id", q.check_invalid_scopus_id, """SELECT "Title", "Year", "ScopusId", "PID", "ISI", "DOI"
FROM pubs WHERE "ScopusId" IS NOT NULL AND NOT regexp_matches("ScopusId", '^2-s2\\.0-\\d{10,11}$')""")

pub_check("q20_invalid_issn", q.check_invalid_issn, f"""
SELECT "PID", "Year", "JournalEISSN", NULL AS "JournalISSN", NOT {issn_sql('"JournalEISSN"')} AS has_bad_check,
NOT regexp_matches("JournalEISSN", '^\\d{{4}}-?\\d{{3}}(X|x|\\d)$') AS has_bad_format
FROM pubs WHERE "JournalEISSN" IS NOT NULL AND ({BAD_ISSN_E})
UNION ALL
SELECT "PID", "Year", NULL, "JournalISSN", NOT {issn_sql('"JournalISSN"')},
NOT regexp_matches("JournalISSN", '^\\d{{4}}-?\\d{{3}}(X|x|\\d)$')
FROM pubs WHERE "JournalISSN" IS NOT NULL AND ({BAD_ISSN_J})""")

pub_check("q21_invalid_isbn", q.check_invalid_isbn, f"""
x AS (SELECT "PID", unnest(string_split("ISBN", ';')) AS isbn, "Year" FROM pubs WHERE "ISBN" IS NOT NULL),
y AS (SELECT "PID", isbn AS "ISBN", "Year", CAST(length(replace(isbn, '-', '')) AS INT) AS n_chars,
  length(replace(isbn, '-', '')) NOT IN (10, 13) AS has_bad_format,
  CASE length(replace(isbn, '-', '')) WHEN 10 THEN NOT {isbn10_sql('isbn')} WHEN 13 THEN NOT {isbn13_sql('isbn')}
  ELSE false END AS has_bad_check FROM x)
SELECT * FROM y WHERE has_bad_format OR has_bad_check""")

pub_check("q22_invalid_use_isbn", q.check_invalid_use_isbn, f"""SELECT "PID", "Title", "Year", "PublicationType", "ISBN", {LU}
FROM pubs WHERE "ISBN" IS NOT NULL AND "Year" >= 2019
AND "PublicationType" IN ('Kapitel i bok, del av antologi', 'Konferensbidrag', 'Artikel i tidskrift')""")

author_check("q23_invalid_author_name", q.check_invalid_author_name, """SELECT "PID", name, staffid, extorg FROM authors
WHERE regexp_matches(name, '^[[:punct:]]{2,}')""")

pub_check("q24_uncertain_published", q.check_uncertain_published, f"""
t AS (SELECT *, {CLEAN} AS n FROM pubs)
SELECT "PID", "Year", "PublicationType", true AS has_notes, true AS is_not_published, n AS "Notes", NULL AS "is_QCorNQC"
FROM t WHERE n LIKE '%QP%' AND "Status" IN ('accepted', 'aheadofprint', 'inPress')
UNION ALL
SELECT "PID", "Year", "PublicationType", NULL, NULL, n, coalesce(n LIKE '%QC%', false)
FROM t WHERE "Status" = 'submitted' AND (coalesce(n LIKE '%QC%', false) OR "PublicationType" = 'Manuskript (preprint)')""")

pub_check("q25_manuscripts_with_identifiers", q.check_manuscripts_with_identifiers, f"""
SELECT "PID", "Year", "Title", "DOI", "ISI", "ScopusId", "PMID", {LU} FROM pubs WHERE "PublicationType" LIKE '%Manuskript%'
AND ("DOI" IS NOT NULL OR "ISI" IS NOT NULL OR "ScopusId" IS NOT NULL OR "PMID" IS NOT NULL)
AND NOT coalesce(regexp_matches("DOI", '^10.1101|^10.48550|^10.2139|^10.31219|^10.20944|^10.21203'), false)""")


@query("q26_missing_affiliations", """
WITH n AS (SELECT s_suppkey AS k, concat('Last', s_suppkey, ', F') AS name,
  concat('u1', lpad(CAST(s_suppkey AS VARCHAR), 6, '0')) AS staffid FROM supplier)
SELECT l_orderkey AS "PID", n.name, n.staffid, CAST(NULL AS VARCHAR) AS orcid, CAST(t.n AS BIGINT) AS n_pid
FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) l JOIN n ON l_suppkey = k
JOIN (SELECT l_suppkey AS k, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY 1) t ON t.k = n.k
WHERE l_suppkey % 3 = 0""")
def q26(spark, d):
    return q.check_missing_affiliations(parse_records(_name_strings(spark, d)))


def _name_strings(spark, d):
    """One name string per order, an author per distinct supplier; every third
    supplier comes without affiliation."""
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("PID"), "l_suppkey").distinct()
    k = F.col("l_suppkey").cast("string")
    # a format string is slow; the usual keys need none
    padded = F.when(F.col("l_suppkey").between(0, 999999), F.lpad(k, 6, "0")).otherwise(F.format_string("%06d", F.col("l_suppkey")))
    person = F.concat(F.lit("Last"), F.coalesce(k, F.lit("null")), F.lit(", F [u1"), padded, F.lit("]"))
    place = F.when(F.col("l_suppkey") % 3 == 1, F.concat(F.lit(" (Home [1], Unit; x (sub) ["), k, F.lit("])"))
                   ).when(F.col("l_suppkey") % 3 == 2, F.lit(" (Ext Univ; City (A))")).otherwise(F.lit(""))
    named = li.select("PID", F.struct("l_suppkey", F.concat(person, place).alias("t")).alias("x"))
    joined = named.groupBy("PID").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), ";").alias("Name"))
    return spread(joined, "PID")


@query("q27_unicode_identifiers", with_bound("pubs", "authors", sql="""
a AS (SELECT "PID", 'authors' AS dataset, unnest([staffid, orcid, "DOI", "ScopusId"]) AS v,
  unnest(['staffid', 'orcid', 'DOI', 'ScopusId']) AS field FROM authors),
p AS (SELECT "PID", 'publications' AS dataset,
  unnest(["JournalISSN", "JournalEISSN", "SeriesISSN", "JournalEISSN", "ISBN", "ISI", CAST("PMID" AS VARCHAR)]) AS v,
  unnest(['JournalISSN', 'JournalEISSN', 'SeriesISSN', 'JournalEISSN', 'ISBN', 'ISI', 'PMID']) AS field FROM pubs),
s AS (SELECT * FROM a UNION ALL SELECT * FROM p),
e AS (SELECT "PID", dataset, field, list_filter(list_transform(list_filter(string_split(v, ''), lambda x: ord(x) > 127),
  lambda x: concat('\\u', lpad(lower(to_hex(ord(x))), 4, '0'))), lambda x: regexp_matches(x, '^\\\\u[0-9a-e]{4,}$')) AS l
  FROM s WHERE v IS NOT NULL)
SELECT "PID", dataset, field, array_to_string(l, ' ') AS unicode_issue FROM e WHERE len(l) > 0"""))
def q27(spark, d):
    return q.check_unicode_identifiers(bound(spark, d, "pubs"), bound(spark, d, "authors"))


@query("q28_stale_organisations", with_bound("pubs", "authors", "organisations", sql="""
oc AS (SELECT CAST(orgid AS VARCHAR) AS orgid, closed_date FROM organisations WHERE is_closed),
oo AS (SELECT CAST(orgid AS VARCHAR) AS orgid FROM organisations WHERE NOT is_closed),
st AS (SELECT DISTINCT a.name, a.orcid, a.staffid, a."PID", a.orgid FROM authors a JOIN oc USING (orgid)
  JOIN pubs p ON p."PID" = a."PID" WHERE date_diff('day', closed_date, make_date("Year", 1, 1)) > 540),
al AS (SELECT DISTINCT name, orcid, staffid, "PID", orgid FROM authors JOIN oo USING (orgid)),
ag AS (SELECT name, orcid, staffid, min(orgid) AS alt_orgids, count(DISTINCT orgid) AS alt_n_orgs,
  count(DISTINCT "PID") AS alt_n_pids, string_agg(DISTINCT CAST("PID" AS VARCHAR), ' ' ORDER BY lpad(CAST("PID" AS VARCHAR), 20, '0')) AS ap
  FROM (SELECT *, lpad(CAST("PID" AS VARCHAR), 20, '0') AS pp FROM al) GROUP BY ALL),
sg AS (SELECT name, orcid, staffid, string_agg(DISTINCT orgid, ' ' ORDER BY orgid) AS stale_orgids,
  list_sort(list(DISTINCT "PID")) AS sp FROM st GROUP BY ALL),
ax AS (SELECT name, orcid, staffid, min(orgid) AS alt_orgids, count(DISTINCT orgid) AS alt_n_orgs,
  count(DISTINCT "PID") AS alt_n_pids, list_sort(list(DISTINCT "PID")) AS ap FROM al GROUP BY name, orcid, staffid)
SELECT sg.name, sg.orcid, sg.staffid, stale_orgids, alt_orgids, alt_n_orgs, alt_n_pids, CAST(0 AS INT) AS piece,
  array_to_string(sp, ' ') AS stale_pids, array_to_string(ap, ' ') AS alt_pids
FROM sg JOIN ax ON sg.name IS NOT DISTINCT FROM ax.name AND sg.orcid IS NOT DISTINCT FROM ax.orcid
  AND sg.staffid IS NOT DISTINCT FROM ax.staffid WHERE alt_n_orgs = 1 AND alt_n_pids > 2"""))
def q28(spark, d):
    return q.check_stale_organisations(_by_organisation(spark, d), bound(spark, d, "pubs"),
                                       bound(spark, d, "organisations"), more_than=2)


def _by_organisation(spark, d):
    return bound(spark, d, "authors")


pub_check("q29_not_checked", lambda p: q.check_not_checked(p, AS_OF, SINCE), f"""
SELECT "PID", CAST("CreatedDate" AS VARCHAR) AS "CreatedDate", {LU} FROM pubs WHERE "CreatedDate" > DATE '1999-01-01'
AND "CreatedDate" < DATE '2001-07-02' AND NOT coalesce("Notes" LIKE '%QC %', false)""")
pub_check("q30_not_checked_stale", lambda p: q.check_not_checked_stale(p, AS_OF), """
SELECT "PublicationType", CAST(year("CreatedDate") AS INT) AS y, count(*) AS n FROM pubs
WHERE "CreatedDate" < DATE '2001-07-02' AND NOT coalesce("Notes" LIKE '%QC %', false) GROUP BY 1, 2""")


@query("q31_external_checks", """
SELECT event_id AS "PID", concat('https://x.example/term/swepub/output/', event_id) AS repo_url,
  CASE event_type WHEN 'click' THEN 'ORCID' WHEN 'view' THEN 'DOI' WHEN 'error' THEN 'ISSN' ELSE 'other' END AS flag_type,
  CAST(user_id AS VARCHAR) AS value,
  concat(CASE event_type WHEN 'click' THEN 'https://orcid.org/' WHEN 'view' THEN 'https://doi.org/'
    WHEN 'error' THEN 'https://portal.issn.org/resource/ISSN/' ELSE '' END, user_id) AS link
FROM events""")
def q31(spark, d):
    ev = table(spark, d, "events")
    kind = F.when(F.col("event_type") == "click", "ORCID").when(F.col("event_type") == "view", "DOI").when(
        F.col("event_type") == "error", "ISSN").otherwise("other")
    rows = ev.select(F.col("event_id").alias("PID"), F.concat(F.lit("https://x.example/term/swepub/"), "event_id").alias("repo_url"),
                     kind.alias("flag_type"), F.col("user_id").cast("string").alias("value"), F.lit("r").alias("record_id"))
    return q.shape_external_checks(rows)


ROW_COUNTS = {
    "submission_status_invalid": ("pre", """"Status" = 'submitted' AND ("DOI" IS NOT NULL OR "ISI" IS NOT NULL OR "ScopusId" IS NOT NULL)"""),
    "missing_confpubdate": ("pre", '"PublicationDate" IS NULL AND "Year" IS NULL'),
    "missing_journal_ids": ("pre", f""""PublicationType" = 'Artikel i tidskrift' AND "JournalISSN" IS NULL AND "JournalEISSN" IS NULL
      AND NOT coalesce({CLEAN} LIKE '%No ISSN%', false) AND ("Status" IS NULL OR "Status" NOT IN ('submitted', 'accepted'))"""),
    "invalid_ISI": ("pre", """"ISI" IS NOT NULL AND NOT regexp_matches("ISI", '^A19\\d{2}[A-Z\\d]{5}\\d{5}$|^000\\d{12}$|^001\\d{12}$')"""),
    "invalid_DOI": ("pre", """"DOI" IS NOT NULL AND NOT starts_with("DOI", '10.')"""),
    "invalid_scopusid": ("pre", """"ScopusId" IS NOT NULL AND NOT regexp_matches("ScopusId", '^2-s2\\.0-\\d{10,11}$')"""),
    "invalid_use_isbn": ("pre", """"ISBN" IS NOT NULL AND "Year" >= 2019
      AND "PublicationType" IN ('Kapitel i bok, del av antologi', 'Konferensbidrag', 'Artikel i tidskrift')"""),
    "manuscripts_with_identifiers": ("pre", """"PublicationType" LIKE '%Manuskript%'
      AND ("DOI" IS NOT NULL OR "ISI" IS NOT NULL OR "ScopusId" IS NOT NULL OR "PMID" IS NOT NULL)
      AND NOT coalesce(regexp_matches("DOI", '^10.1101|^10.48550|^10.2139|^10.31219|^10.20944|^10.21203'), false)"""),
    "non_qc": ("pubs", """"CreatedDate" > DATE '1999-01-01' AND "CreatedDate" < DATE '2001-07-02' AND NOT coalesce("Notes" LIKE '%QC %', false)"""),
    "invalid_staffid": ("authors", """staffid IS NOT NULL AND NOT regexp_matches(staffid, '^u1[a-z0-9]{6}$')
      AND NOT regexp_matches(staffid, '^PI\\d+|P\\d+|pi\\d+|p\\d+|Pi\\d+|PI \\d+|-')"""),
    "invalid_orcid": ("authors", """orcid IS NOT NULL
      AND NOT regexp_matches(orcid, '^([0-9]{4})+(-)+([0-9]{4})+(-)+([0-9]{4})+(-)+([0-9]{3}[0-9Xx])$')"""),
    "invalid_authorname": ("authors", "regexp_matches(name, '^[[:punct:]]{2,}')"),
}
_ROW_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS name, count(*) AS value FROM {t} WHERE {w}" for n, (t, w) in ROW_COUNTS.items())


@query("q36_row_check_statistics", with_bound("pubs", "authors", sql=PRE + " " + _ROW_SQL.replace("SELECT", "SELECT", 1)))
def q36_rows(spark, d):
    """Statistics of the row checks: one aggregate per table."""
    run = CheckRun(bound(spark, d, "pubs"), bound(spark, d, "authors"), AS_OF, names=list(ROW_COUNTS), since=SINCE)
    return run.statistics()


@query("q36_hits", with_bound("pubs", sql=PRE + " " + " UNION ALL ".join(
    f"SELECT \"PID\", '{n}' AS \"check\" FROM pre WHERE {w}" for n, (t, w) in ROW_COUNTS.items() if t == "pre")))
def q36_hits(spark, d):
    names = [n for n, (t, _) in ROW_COUNTS.items() if t == "pre"]
    return CheckRun(bound(spark, d, "pubs"), bound(spark, d, "authors"), AS_OF, names=names).hits()


# The named query that has the rows of each check, for runs that count them.
PARTS = {
    "article_title_multiplettes": "q01_duplicate_article_titles", "title_multiplettes": "q02_duplicate_titles",
    "submission_status_invalid": "q03_submission_status", "missing_staffid": "q04_missing_staffid", "missing_aid": "q05_missing_aid",
    "missing_orcids": "q06_missing_orcids", "missing_confpubdate": "q07_missing_date", "missing_journal_ids": "q08_missing_journal_ids",
    "odd_book_chapters": "q09_book_chapter_titles", "invalid_ISI": "q10_invalid_isi", "invalid_DOI": "q11_invalid_doi",
    "invalid_ISSN": "q20_invalid_issn", "invalid_staffid": "q16_invalid_staffid", "invalid_aid": "q15_invalid_aid",
    "invalid_orcid": "q17_invalid_orcid", "invalid_scopusid": "q19_invalid_scopus_id", "invalid_isbn": "q21_invalid_isbn",
    "invalid_use_isbn": "q22_invalid_use_isbn", "invalid_authorname": "q23_invalid_author_name",
    "uncertain_published": "q24_uncertain_published", "multiplettes_DOI": "q12_duplicate_doi",
    "manuscripts_with_identifiers": "q25_manuscripts_with_identifiers", "non_qc": "q29_not_checked", "non_qc_stale": "q30_not_checked_stale",
}


def _run_sql(names: list[str], filtered: bool) -> str:
    """The rows of every part, counted; all parts but two read the publications that the prefilter leaves."""
    tables = with_bound("pubs", "authors", sql="SELECT 1").rsplit("SELECT 1", 1)[0]
    heads = tables.replace("WITH pubs AS (", "WITH all_pubs AS (", 1) + f""",
pubs AS (SELECT * FROM all_pubs {"WHERE " + PRE.split("WHERE ", 1)[1] if filtered else ")"}"""
    counts = []
    for name in names:
        if name in ("multiplettes_scopusid", "multiplettes_ISI"):
            key = "ScopusId" if name == "multiplettes_scopusid" else "ISI"
            body = f"""SELECT 1 FROM all_pubs JOIN (SELECT "{key}" AS k FROM pubs WHERE "{key}" IS NOT NULL GROUP BY 1 HAVING count(*) > 1) ON "{key}" = k"""
        else:
            body = ORACLES[PARTS[name]]
            for t in ("pubs", "authors"):  # the tables are those of the run
                text = f"{t} AS ({BOUND[t][0].strip()})"
                body = body.replace(text + ", ", "").replace(text, "")
            body = body.replace("WITH  ", "").replace("WITH SELECT", "SELECT").strip()
            body = body[5:].strip() if body.startswith("WITH") and body[5:].lstrip().startswith("SELECT") else body
            if name in ("non_qc", "non_qc_stale"):
                body = body.replace("FROM pubs", "FROM all_pubs")
        counts.append(f"SELECT '{name}' AS name, count(*) AS value FROM ({body})")
    return heads + " " + " UNION ALL ".join(counts)


@query("q36_standard_run", _run_sql(STANDARD, True))
def q36(spark, d):
    run = CheckRun(bound(spark, d, "pubs"), bound(spark, d, "authors"), AS_OF, _stop_list(spark, d), STANDARD, since=SINCE)
    return run.statistics()


@query("q37_other_institution_run", _run_sql(OTHER, False))
def q37(spark, d):
    run = CheckRun(bound(spark, d, "pubs"), bound(spark, d, "authors"), AS_OF, _stop_list(spark, d), OTHER, filtered=False)
    return run.statistics()


SHARED = """
pr AS (SELECT DISTINCT orcid, staffid FROM authors WHERE orcid IS NOT NULL AND staffid IS NOT NULL),
sh AS (SELECT orcid, staffid FROM pr WHERE orcid IN (SELECT orcid FROM pr GROUP BY orcid HAVING count(*) > 1))"""
author_check("q38_shared_orcids", q.shared_orcids, SHARED + " SELECT * FROM sh")
author_check("q38_overview", lambda a: q.shared_orcid_overview(q.shared_orcids(a)),
             SHARED + " SELECT orcid, staffid, count(*) AS n FROM sh GROUP BY ALL")
author_check("q38_conflicting_rows", lambda a: q.conflicting_orcid_rows(a).select("PID", "pos", "staffid", "orcid", "n_other"), """
g AS (SELECT staffid, count(DISTINCT orcid) AS n FROM authors WHERE orcid IS NOT NULL AND staffid IS NOT NULL GROUP BY 1 HAVING count(DISTINCT orcid) > 1)
SELECT "PID", pos, a.staffid, a.orcid, n - 1 AS n_other FROM authors a JOIN g ON a.staffid = g.staffid WHERE orcid IS NOT NULL""")
author_check("q38_conflicting_orcids", q.conflicting_orcids, """
pr AS (SELECT DISTINCT staffid, orcid FROM authors WHERE orcid IS NOT NULL AND staffid IS NOT NULL)
SELECT staffid, orcid FROM pr QUALIFY count(*) OVER (PARTITION BY staffid) > 1""")

author_check("q39_several_staff_ids", q.orcids_with_several_staff_ids, """
SELECT orcid, CAST(0 AS INT) AS piece, string_agg(DISTINCT staffid, ' ' ORDER BY staffid) AS staffids,
count(DISTINCT staffid) AS n_staff FROM authors WHERE orcid IS NOT NULL AND staffid IS NOT NULL
GROUP BY orcid HAVING count(DISTINCT staffid) > 1""")
author_check("q39_without_authority", q.orcids_without_authority, """
SELECT orcid, count(DISTINCT autid) AS n_autids, count(DISTINCT staffid) AS n_staff, count(DISTINCT "PID") AS n_pids
FROM authors WHERE orcid IS NOT NULL GROUP BY orcid HAVING count(DISTINCT autid) = 0 AND count(DISTINCT staffid) >= 1""")
author_check("q39_partly_without_staff_id", q.orcids_partly_without_staff_id, """
SELECT orcid, count(DISTINCT staffid) + CAST(max(CASE WHEN staffid IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_ids,
count(*) FILTER (WHERE staffid IS NULL) AS n_missing, max(staffid) AS staffid FROM authors WHERE orcid IS NOT NULL
GROUP BY orcid HAVING count(*) FILTER (WHERE staffid IS NULL) > 0 AND count(DISTINCT staffid) >= 1""")


@query("q39_unlike_directory", with_bound("authors", sql="""
dir AS (SELECT concat('u1', chr(CAST(97 + s_suppkey % 26 AS INT)), lpad(CAST(s_suppkey AS VARCHAR), 5, '9')) AS staffid,
  concat('0000-0001-0000-', lpad(CAST(s_suppkey % 10000 AS VARCHAR), 4, '0')) AS directory_orcid FROM supplier)
SELECT DISTINCT a.staffid, orcid, directory_orcid FROM authors a JOIN dir USING (staffid)
WHERE orcid IS NOT NULL AND lower(orcid) <> lower(directory_orcid)"""))
def q39_directory(spark, d):
    s = table(spark, d, "supplier")
    directory = s.select(
        F.concat(F.lit("u1"), F.char(97 + F.col("s_suppkey") % 26), F.lpad(F.col("s_suppkey").cast("string"), 5, "9")).alias("staffid"),
        F.format_string("0000-0001-0000-%04d", F.col("s_suppkey") % 10000).alias("orcid"))
    return q.orcids_unlike_directory(bound(spark, d, "authors"), directory)


pub_check("q40_article_without_journal", q.check_article_without_journal, """SELECT "PID", "Year", "Title" FROM pubs
WHERE "PublicationType" = 'Artikel i tidskrift' AND "Journal" IS NULL""")
pub_check("q40_chapter_without_book", q.check_chapter_without_book, """SELECT "PID", "Year", "Title" FROM pubs
WHERE "PublicationType" = 'Kapitel i bok, del av antologi' AND "HostPublication" IS NULL""")
author_check("q40_same_staff_id_twice", q.check_same_staff_id_twice, """SELECT "PID", staffid, count(*) AS n FROM authors
WHERE staffid IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1""")


@query("q40_unit_before_start", with_bound("pubs", "authors", "organisations", sql="""
SELECT a."PID", a.name, a.orgid, "Year", CASE WHEN "Year" >= 2014 AND year(closed_date) < 2014 THEN 'closed unit' ELSE 'later unit' END AS issue
FROM authors a JOIN organisations o ON a.orgid = CAST(o.orgid AS VARCHAR) JOIN pubs p ON p."PID" = a."PID"
WHERE ("Year" >= 2014 AND year(closed_date) < 2014) OR ("Year" < 2014 AND closed_date IS NULL)"""))
def q40_units(spark, d):
    return q.check_unit_before_start(bound(spark, d, "authors"), bound(spark, d, "pubs"), bound(spark, d, "organisations"), 2014)


@query("p03_prefilter", with_bound("pubs", sql=PRE + " SELECT \"PID\", \"Notes\" FROM pre"))
def p03(spark, d):
    return q.prefilter(bound(spark, d, "pubs"), AS_OF).select("PID", "Notes")
