"""Scalar functions (F series) over whole columns of the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from bibweave.functions import dates, identifiers as ids, links, text
from bibweave.functions.distance import jaro_winkler_similarity, levenshtein_similarity
from bibweave.operators import crosscheck, lookups, setops
from bibweave.plans.bindings import bound, with_bound
from bibweave.plans.queries_checks import isbn10_sql, isbn13_sql, issn_sql
from bibweave.plans.registry import query, table

c = F.col
PORTAL = "https://portal.example.org"


def on_pubs(name: str, sql: str | None, /, **cols):
    """A query that computes columns over the publications; the SQL gets the same names."""
    q = with_bound("pubs", sql=f'SELECT "PID", {sql} FROM pubs') if sql else None
    query(name, q)(lambda spark, d: bound(spark, d, "pubs").select("PID", *[f(spark).alias(n) for n, f in cols.items()]))


def on_table(name: str, source: str, id_col: str, sql: str | None, /, **cols):
    q = f"SELECT {id_col}, {sql} FROM {source}" if sql else None
    query(name, q)(lambda spark, d: table(spark, d, source).select(id_col, *[f(spark).alias(n) for n, f in cols.items()]))


def _anchor(addr: str, text_sql: str, title: str) -> str:
    return f"concat('<a href=''', {addr}, ''' target=''_blank'' rel=''noopener noreferrer'' title=''', {title}, '''>', {text_sql}, '</a>')"


SHORT = "CASE WHEN length({x}) > 25 THEN concat(substr({x}, 1, 22), '...') ELSE {x} END"


def _link(col: str, prefix: str, suffix: str = "") -> str:
    v = f'CAST("{col}" AS VARCHAR)'
    made = _anchor(f"concat('{prefix}', {v}, '{suffix}')", SHORT.format(x=v), v)
    return f'CASE WHEN "{col}" IS NULL THEN NULL ELSE {made} END'


on_pubs("f01_linkify", ", ".join([
    _link("DOI", "https://doi.org/") + " AS doi",
    _link("ISI", "https://www.webofscience.com/wos/woscc/full-record/WOS:") + " AS isi",
    _link("PMID", "https://pubmed.ncbi.nlm.nih.gov/") + " AS pmid",
    _link("JournalISSN", "https://portal.issn.org/api/search?search[]=MUST=allissnbis=%22", "%22") + " AS issn",
    _link("ISBN", "https://www.worldcat.org/search?q=bn%3A", "&qt=advanced&dblist=638") + " AS isbn",
    _link("Journal", "") + " AS plain"]),
    doi=lambda s: links.linkify(c("DOI"), "DOI"), isi=lambda s: links.linkify(c("ISI"), "ISI"),
    pmid=lambda s: links.linkify(c("PMID"), "PMID"), issn=lambda s: links.linkify(c("JournalISSN"), "ISSN"),
    isbn=lambda s: links.linkify(c("ISBN"), "ISBN"), plain=lambda s: links.linkify(c("Journal")))

on_pubs("f01_search_links", "concat('https://portal.example.org/smash/resultList.jsf?aq2=%5B%5B%5D%5D&af=%5B%5D&searchType=RESEARCH"
        "&sortOrder2=title_sort_asc&language=en&aq=%5B%5B%7B%22titleAll%22%3A%22', replace(\"Title\", ' ', '%20'), "
        "'%22%7D%5D%5D&sf=all&aqe=%5B%5D&sortOrder=author_sort_asc&onlyFullText=false&noOfRows=50&dswid=-4347') AS address",
        address=lambda s: links.address(c("Title"), "titlesearch", PORTAL))

on_pubs("f02_links_of_nonempty", f"""CASE WHEN "Notes" <> '' THEN {_anchor('"Notes"', SHORT.format(x='"Notes"'), '"Notes"')} END AS link""",
        link=lambda s: links.link_nonempty(c("Notes")))
on_pubs("f03_shorten", f"""{SHORT.format(x='"Title"')} AS short""", short=lambda s: text.shorten(c("Title")))

TAGS = ("replace(replace(regexp_replace(regexp_replace(regexp_replace(html, '<(script)[^>]*>.*?</script\\s*>|<(style)[^>]*>.*?</style\\s*>', '', 'gis'), "
        "'<!--.*?-->', '', 'gs'), '<[^>]*>', '', 'gs'), '&lt;', '<'), '&gt;', '>')")
on_table("f04_tidy_html", "pages", "page_id", None, body=lambda s: text.tidy_html(c("html")))
on_pubs("f04_tidy_notes", "replace(replace(replace(regexp_replace(\"Notes\", '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS clean",
        clean=lambda s: text.tidy_html(c("Notes")))
on_table("f05_title_key", "documents", "doc_id", "md5(trim(lower(text))) AS key", key=lambda s: F.md5(text.title_key(c("text"))))
on_pubs("f06_issn", f"""CASE WHEN "JournalISSN" IS NULL THEN false ELSE {issn_sql('"JournalISSN"')} END AS ok""", ok=lambda s: ids.issn_ok(c("JournalISSN")))
on_pubs("f07_isbn", f"""coalesce({isbn10_sql('"ISBN"')}, false) AS ok10, coalesce({isbn13_sql('"ISBN"')}, false) AS ok13""",
        ok10=lambda s: ids.isbn10_ok(c("ISBN")), ok13=lambda s: ids.isbn13_ok(c("ISBN")))


@query("f08_ids_in_text", with_bound("authors", sql="""SELECT "PID", pos, nullif(regexp_extract(concat(name, ' ', coalesce(orcid, '')),
'\\d{4}-\\d{4}-\\d{4}-\\d{3}[1-9Xx]'), '') AS orcid, nullif(regexp_extract(concat(name, '[', coalesce(staffid, ''), ']'), 'u1.{6}'), '') AS id FROM authors"""))
def f08(spark, d):
    return bound(spark, d, "authors").select(
        "PID", "pos", ids.orcid_in_text(F.concat_ws(" ", "name", F.coalesce("orcid", F.lit("")))).alias("orcid"),
        ids.first_hit(F.concat(c("name"), F.lit("["), F.coalesce("staffid", F.lit("")), F.lit("]")), "u1.{6}").alias("id"))


@query("f09_staff_ids", with_bound("authors", sql="""SELECT "PID", pos, nullif(regexp_extract(staffid, 'u[12][a-z0-9]{6}'), '') AS a,
nullif(regexp_extract(staffid, 'u2[a-z0-9]{6}'), '') AS u FROM authors"""))
def f09(spark, d):
    return bound(spark, d, "authors").select("PID", "pos", ids.staff_id_in_text(c("staffid")).alias("a"),
                                             ids.staff_id_in_text(c("staffid"), "unit").alias("u"))


VAT = "concat(CASE c_custkey % 4 WHEN 0 THEN 'SE' WHEN 1 THEN 'DE' WHEN 2 THEN 'US' ELSE 'se' END, lpad(CAST(c_custkey AS VARCHAR), 10, '2'), CASE c_custkey % 3 WHEN 0 THEN '01' ELSE '1' END)"


@query("f10_vat", f"""WITH v AS (SELECT c_custkey, {VAT} AS v FROM customer), w AS (SELECT *, regexp_replace(v, '(^[A-Z]{{2}}).*$', '\\1') AS country,
regexp_replace(v, '^[A-Z]{{2}}(\\d{{12}})$', '\\1') AS num FROM v)
SELECT c_custkey, length(v) = 14 AS valid, country, country IN ('SE', 'DE') AS is_eu, country = 'SE' AS is_swe, num AS vat_number, substr(num, 1, 10) AS swe_org FROM w""")
def f10(spark, d):
    k = c("c_custkey")
    lead = F.when(k % 4 == 0, "SE").when(k % 4 == 1, "DE").when(k % 4 == 2, "US").otherwise("se")
    v = F.concat(lead, F.lpad(k.cast("string"), 10, "2"), F.when(k % 3 == 0, "01").otherwise("1"))
    return table(spark, d, "customer").select("c_custkey", ids.vat_parts(v).alias("x")).select("c_custkey", "x.*")


@query("f11_typed_lookup", with_bound("pubs", sql="""q AS (SELECT event_id, CASE WHEN user_id % 2 = 0 THEN concat('PID:', user_id) ELSE concat('PMID:', user_id + 1000000) END AS t FROM events)
SELECT event_id, p."PID" FROM q JOIN pubs p ON (t LIKE 'PID:%' AND substr(t, 5) = CAST(p."PID" AS VARCHAR)) OR (t LIKE 'PMID:%' AND substr(t, 6) = CAST(p."PMID" AS VARCHAR))"""))
def f11(spark, d):
    u = c("user_id")
    asked = table(spark, d, "events").select("event_id", F.when(u % 2 == 0, F.concat(F.lit("PID:"), u)).otherwise(F.concat(F.lit("PMID:"), u + 1000000)).alias("t"))
    return crosscheck.find_records(bound(spark, d, "pubs"), asked, "t").select("event_id", "PID")


on_table("f12_unicode", "documents", "doc_id",
         "regexp_matches(text, '[^\\x00-\\x7F]') AS has, md5(coalesce(array_to_string(list_transform(list_filter(string_split(text, ''), "
         "lambda x: ord(x) > 127), lambda x: concat('\\u', lpad(lower(to_hex(ord(x))), 4, '0'))), ' '), '')) AS escapes",
         has=lambda s: text.has_unicode(c("text"), strict=True),
         escapes=lambda s: F.md5(F.coalesce(text.unicode_escapes(c("text"), strict=True), F.lit(""))))
on_table("f13_first_words", "benchmark", "item_id",
         "trim(regexp_replace(lower(regexp_replace(text, '^((?:\\S+\\s+){4}\\S+).*', '\\1', 's')), '[[:punct:]]', ' ', 'g')) AS term",
         term=lambda s: text.first_words(c("text"), 4))


@query("f14_page_extent", """WITH p AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN concat(p_partkey, '-', p_size) WHEN 1 THEN concat('e', p_size) ELSE concat('pp. ', p_size, ' to ', p_partkey) END AS r FROM part),
n AS (SELECT p_partkey, list_sort(list_transform(regexp_extract_all(r, '\\d+'), lambda x: CAST(x AS INT))) AS l FROM p)
SELECT p_partkey, CAST(l[1] AS VARCHAR) AS extent_beg, CAST(l[2] AS VARCHAR) AS extent_end FROM n""")
def f14(spark, d):
    k, s = c("p_partkey"), c("p_size")
    r = F.when(k % 3 == 0, F.concat_ws("-", k, s)).when(k % 3 == 1, F.concat(F.lit("e"), s)).otherwise(F.concat(F.lit("pp. "), s, F.lit(" to "), k))
    return table(spark, d, "part").select("p_partkey", text.page_extent(r).alias("x")).select("p_partkey", "x.*")


on_table("f15_dates", "orders", "o_orderkey",
         "strftime(o_orderdate, '%Y%m%d') AS compact, strftime(o_orderdate, '%b %-d %Y') AS shown, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS stamp, "
         "CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS parsed",
         compact=lambda s: dates.compact_date(c("o_orderdate")), shown=lambda s: dates.display_date(c("o_orderdate")),
         stamp=lambda s: dates.stamp_utc(c("o_orderdate")), parsed=lambda s: dates.parse_compact(dates.compact_date(c("o_orderdate"))))


@query("f16_conference", """WITH t AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS b, CAST(o_orderdate AS DATE) + 4 AS e FROM orders)
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN concat('Conf ', o_orderkey, ', City, NA, ', strftime(b, '%b %-d %Y'), ' - ', strftime(e, '%b %-d %Y'))
WHEN 1 THEN concat('Conf ', o_orderkey, ', City, NA, ', strftime(b, '%b %-d %Y')) WHEN 2 THEN concat('Conf ', o_orderkey, ', City, NA, ', strftime(e, '%b %-d %Y')) END AS details FROM t""")
def f16(spark, d):
    k, day = c("o_orderkey"), c("o_orderdate").cast("date")
    piece = lambda x: dates.safe_date(F.year(x), F.month(x), F.day(x))
    beg = F.when(k % 4 < 2, piece(day))
    end = F.when((k % 4 == 0) | (k % 4 == 2), piece(F.date_add(day, 4)))
    title = F.concat(F.lit("Conf "), k)
    return table(spark, d, "orders").select("o_orderkey", dates.conference_details(title, F.lit("City"), F.lit(None), beg, end).alias("details"))


ESC = "replace(replace(replace(replace({x}, '\"', '&quot;'), '''', '&apos;'), '<', '&lt;'), '>', '&gt;')"
on_table("f17_tidy_xml", "pages", "page_id",
         f"md5(replace({ESC.format(x='html')}, '&', '&amp;')) AS escaped, md5(concat('<![CDATA[', replace(html, ']]>', ''), ']]>')) AS cdata, "
         f"md5({ESC.format(x=chr(114)+'eplace(html, ' + chr(39) + '&' + chr(39) + ', ' + chr(39) + '&amp;' + chr(39) + ')')}) AS single",
         escaped=lambda s: F.md5(text.tidy_xml(c("html"))), cdata=lambda s: F.md5(text.tidy_xml(c("html"), cdata=True)),
         single=lambda s: F.md5(text.tidy_xml(c("html"), ampersand_first=True)))


@query("f18_clean_organisation", """SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE concat(s_name, 'Street', 'Town', '123', 'Land') END AS org FROM supplier""")
def f18(spark, d):
    n = c("s_name")
    raw = F.when(c("s_suppkey") % 2 == 0, F.concat(n, F.lit(" https://ror.org/000abc123"))).otherwise(
        F.concat(F.lit("organization="), n, F.lit("addressline=Streetcity=Townpostcode=123country=Land")))
    return table(spark, d, "supplier").select("s_suppkey", text.clean_organisation(raw).alias("org"))


on_table("f19_match_text", "documents", "doc_id",
         "md5(regexp_replace(replace(replace(translate(lower(text), 'åäáàâãöóòôõøéèêëíìîïúùûüçñýÿ', 'aaaaaaooooooeeeeiiiiuuuucnyy'), 'æ', 'ae'), 'ß', 'ss'), '\\s+', ' ', 'g')) AS t",
         t=lambda s: F.md5(text.match_text(c("text"))))


@query("f20_single_node", """SELECT event_id, CASE WHEN user_id % 2 = 1 THEN event_type END AS single, concat_ws(' ', event_type, CASE WHEN user_id % 2 = 0 THEN CAST(user_id AS VARCHAR) END) AS every
FROM events""")
def f20(spark, d):
    from bibweave.sources.xml import every_node, single_node

    e = table(spark, d, "events")
    extra = F.when(c("user_id") % 2 == 0, F.concat(F.lit("<t>"), "user_id", F.lit("</t>"))).otherwise(F.lit(""))
    doc = F.concat(F.lit("<r><t>"), "event_type", F.lit("</t>"), extra, F.lit("</r>"))
    return e.select("event_id", single_node(doc, "r/t").alias("single"), every_node(doc, "r/t").alias("every"))


@query("f21_grant_numbers", """SELECT o_orderkey, concat(year(o_orderdate), '-', lpad(CAST(o_custkey AS VARCHAR), 5, '0')) AS number, concat('p', o_orderkey) AS prefix FROM orders""")
def f21(spark, d):
    num = F.concat(F.year("o_orderdate").cast("string"), F.lit("-"), F.lpad(c("o_custkey").cast("string"), 5, "0"))
    return table(spark, d, "orders").select(
        "o_orderkey", ids.grant_number(F.concat(F.lit("Dnr "), num, F.lit(" B"))).alias("number"),
        ids.before_last_underscore(F.concat(F.lit("p"), c("o_orderkey"), F.lit("_X"))).alias("prefix"))


on_pubs("f22_publication_class", """CASE WHEN "PublicationType" LIKE 'Artikel%' THEN 'Article' WHEN regexp_matches("PublicationType", '[Bb]ok') THEN 'Book'
WHEN regexp_matches("PublicationType", '[Kk]onferens') THEN 'Conference' ELSE 'Other' END AS class""", **{"class": lambda s: text.publication_class(c("PublicationType"))})


@query("f23_researchers", with_bound("hr", sql="SELECT emp_key, regexp_matches(emp_desc, 'PROFESSOR|DOKTORAND') AS researcher FROM hr"))
def f23(spark, d):
    return bound(spark, d, "hr").select("emp_key", text.is_researcher(c("emp_desc")).alias("researcher"))


@query("f24_people", with_bound("hr", sql="""SELECT emp_key, upper(string_split(unit_abbr, '/')[-1]) AS unit, split_part(email, '@', 1) AS username, trim(concat(lastname, ', ', firstname)) AS fullname FROM hr"""))
def f24(spark, d):
    return bound(spark, d, "hr").select("emp_key", text.last_path_part(c("unit_abbr")).alias("unit"), text.user_name(c("email")).alias("username"),
                                        text.full_name(c("lastname"), c("firstname")).alias("fullname"))


on_table("f25_sizes", "part", "p_partkey", "CAST(p_size AS DOUBLE) * CASE p_partkey % 4 WHEN 0 THEN 1073741824 WHEN 1 THEN 1048576 WHEN 2 THEN 1024 ELSE 1 END AS bytes",
         bytes=lambda s: text.size_in_bytes(F.concat(c("p_size").cast("string"), F.when(c("p_partkey") % 4 == 0, "GiB").when(c("p_partkey") % 4 == 1, "MiB").when(c("p_partkey") % 4 == 2, "KiB").otherwise("B"))))


@query("f26_genre", with_bound("batch", sql="""SELECT sid, CASE WHEN aggregation = 'Journal' AND subtype = 'Article' THEN 'article' WHEN aggregation = 'Journal' AND subtype = 'Review' THEN 'review'
WHEN aggregation = 'Journal' AND subtype = 'Conference Paper' THEN 'articleConferencePaper' WHEN aggregation = 'Journal' AND subtype = 'Erratum' THEN 'articleErratum'
WHEN aggregation = 'Conference Proceeding' AND subtype = 'Conference Paper' THEN 'conferencePaperPublished' WHEN aggregation = 'Conference Proceeding' AND subtype = 'Book Chapter' THEN 'conferencePaperPublished'
WHEN aggregation = 'Book' AND subtype = 'Book Chapter' THEN 'chapter' ELSE 'other' END AS genre FROM batch"""))
def f26(spark, d):
    return lookups.with_genre(bound(spark, d, "batch"), "aggregation", "subtype").select("sid", "genre")


on_table("f27_subject_level", "part", "p_partkey", "CASE p_partkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS level",
         level=lambda s: text.subject_level(F.when(c("p_partkey") % 3 == 0, "1").when(c("p_partkey") % 3 == 1, "101").otherwise("10101")))


@query("f28_closed_units", """SELECT s_suppkey, s_suppkey % 2 = 0 AS is_closed, CASE WHEN s_suppkey % 2 = 0 THEN '2012-12-31' END AS closed_date, s_name AS unit, CAST(s_suppkey % 3 AS INT) AS level FROM supplier""")
def f28(spark, d):
    label = F.when(c("s_suppkey") % 2 == 0, F.concat("s_name", F.lit(" (Closed 2012-12-31)"))).otherwise(c("s_name"))
    key = F.concat(F.lit("0"), F.repeat(F.lit("_1"), (c("s_suppkey") % 3).cast("int")))
    return table(spark, d, "supplier").select("s_suppkey", text.closed_unit(label).alias("x"), text.tree_level(key).alias("level")).select("s_suppkey", "x.*", "level")


on_table("f29_without_notes", "nation", "n_nationkey", "n_name AS name", name=lambda s: text.without_notes(F.concat(c("n_name"), F.lit(" (note) [2]"))))
on_table("f30_keywords", "part", "p_partkey", "concat(p_type, '/', p_brand) AS k, p_name AS w",
         k=lambda s: F.array_join(text.keyword_list(F.concat_ws(" | ", "p_type", "p_brand")), "/"),
         w=lambda s: F.array_join(text.words(c("p_name")), " "))
on_pubs("f31_fingerprint", None, fp=lambda s: text.fingerprint(c("Name")))


@query("l02_similarities", """SELECT p_partkey, round(1 - levenshtein(p_type, p_name) / greatest(length(p_type), length(p_name)), 6) AS lev,
round(jaro_winkler_similarity(p_brand, 'Brand#12'), 6) AS jw FROM part""")
def l02(spark, d):
    return table(spark, d, "part").select("p_partkey", F.round(levenshtein_similarity(c("p_type"), c("p_name")), 6).alias("lev"),
                                          F.round(jaro_winkler_similarity(c("p_brand"), F.lit("Brand#12")), 6).alias("jw"))
