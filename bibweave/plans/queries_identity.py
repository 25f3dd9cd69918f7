"""Identities, linkage, search, staff records, cross-checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from bibweave.functions import text
from bibweave.operators import crosscheck as x, hr, identity, linkage, names, search
from bibweave.plans.bindings import AS_OF, bound, with_bound
from bibweave.plans.queries_checks import _name_strings
from bibweave.plans.registry import query, table

c = F.col
HR_DAY = dt.date(2001, 8, 1)

# --- names ---------------------------------------------------------------------------

N_BASE = """WITH p AS (SELECT DISTINCT l_orderkey AS "PID", l_suppkey AS k FROM lineitem),
o AS (SELECT "PID", k, row_number() OVER (PARTITION BY "PID" ORDER BY k) AS pos FROM p),
u AS (SELECT "PID", list(k ORDER BY k) FILTER (WHERE k % 3 = 1) AS home, count(*) FILTER (WHERE k % 3 <> 0) AS n_aff FROM p GROUP BY 1)"""
# org ids of the record: own affiliations in name order, each giving 1 and its own number
ORGS = ("(SELECT string_agg(v, ' ' ORDER BY i) FROM (SELECT v, min(i) AS i FROM (SELECT unnest(list_concat(['1'], list_transform(list_sort("
        "list_transform(home, lambda y: concat('Last', y))), lambda y: substr(y, 5)))) AS v, generate_subscripts(list_concat(['1'], "
        "list_transform(home, lambda y: concat('Last', y))), 1) AS i) GROUP BY v))")


@query("n01_simple_names", N_BASE + """,
s AS (SELECT "PID", string_agg(concat('Last', k, ', F [u1', lpad(CAST(k AS VARCHAR), 6, '0'), ']',
  CASE k % 3 WHEN 1 THEN concat(' (Home [1], Unit; x (sub) [', k, '])') WHEN 2 THEN ' (Ext Univ; City (A))' ELSE '' END), ';' ORDER BY k) AS n FROM p GROUP BY 1),
e AS (SELECT "PID", unnest(string_split(n, ';')) AS "Name", generate_subscripts(string_split(n, ';'), 1) AS pos FROM s)
SELECT "PID", CAST(pos AS INT) AS pos, "Name", trim(regexp_extract("Name", '^([^(\\[|]*)', 1)) AS name_only,
  nullif(array_to_string(regexp_extract_all("Name", '\\[(u1.{6})\\]', 1), ' '), '') AS staffid, CAST(NULL AS VARCHAR) AS orcid,
  nullif(array_to_string(regexp_extract_all("Name", '\\[(\\d+)\\]', 1), ' '), '') AS orgids,
  nullif(regexp_extract("Name", '\\(([^(\\[|]*)\\)$', 1), '') AS extorg, false AS has_etal FROM e""")
def n01(spark, d):
    """Every author, also those whose affiliation this reading cuts in two."""
    return names.parse_simple_names(_name_strings(spark, d))


@query("n02_parse_names", N_BASE + f""" SELECT o."PID", CAST(pos AS INT) AS pos, concat('Last', k, ', F') AS name, concat('u1', lpad(CAST(k AS VARCHAR), 6, '0')) AS staffid,
CAST(NULL AS VARCHAR) AS orcid, CASE WHEN k % 3 = 1 THEN {ORGS} END AS orgids, CASE WHEN k % 3 = 2 THEN 'Ext Univ; City (A)' END AS extorg,
false AS uses_etal, CAST(CASE WHEN k % 3 = 2 THEN 2 END AS INT) AS n_aff_ext, CAST(CASE WHEN k % 3 = 1 THEN 2 END AS INT) AS n_aff_own FROM o JOIN u ON o."PID" = u."PID" """)
def n02(spark, d):
    return names.parse_names(_name_strings(spark, d))


@query("n02_nested_parentheses", """WITH t AS (SELECT s_suppkey AS k, CAST(s_suppkey % 14 AS INT) AS depth FROM supplier)
SELECT k AS "PID", CAST(1 AS INT) AS pos, concat('Last', k, ', F') AS name, concat('Place ', k, '; x',
  array_to_string(list_transform(range(1, depth + 1), lambda i: concat(' (l', i, '; y')), ''), repeat(')', depth)) AS extorg, CAST(2 + depth AS INT) AS n_aff_ext FROM t
UNION ALL SELECT k, 2, concat('Next', k, ', G'), 'Other (p)', 1 FROM t""")
def n02_nested(spark, d):
    """Affiliations of up to 14 levels, separators on each, followed by another author."""
    k, depth = c("s_suppkey").cast("string"), (c("s_suppkey") % 14).cast("int")
    levels = F.array_join(F.transform(F.filter(F.sequence(F.lit(0), depth), lambda i: i > 0), lambda i: F.concat(F.lit(" (l"), i.cast("string"), F.lit("; y"))), "")
    text = F.concat(F.lit("Last"), k, F.lit(", F (Place "), k, F.lit("; x"), levels, F.repeat(F.lit(")"), depth), F.lit(");Next"), k, F.lit(", G (Other (p))"))
    rows = table(spark, d, "supplier").select(c("s_suppkey").alias("PID"), text.alias("Name"))
    return names.parse_names(rows).select("PID", "pos", "name", "extorg", "n_aff_ext")


@query("n03_person_records", N_BASE + """ SELECT concat('u1', lpad(CAST(k AS VARCHAR), 6, '0')) AS staffid, CAST(NULL AS VARCHAR) AS orcid, concat('Last', k, ', F') AS name,
CASE WHEN k % 3 = 2 THEN 'Ext Univ; City (A)' END AS extorg, CAST(0 AS INT) AS piece, string_agg(CAST("PID" AS VARCHAR), ' ' ORDER BY "PID") AS pids FROM p GROUP BY k""")
def n03(spark, d):
    return names.person_records(names.parse_names(_name_strings(spark, d)))


@query("n04_organisation_combinations", """SELECT DISTINCT CAST(1990 + l_orderkey % 30 AS INT) AS "Year", CASE WHEN l_suppkey = 1 THEN '1 1' ELSE concat('1 ', l_suppkey) END AS orgids,
'Home, Unit; x (sub)' AS units FROM lineitem WHERE l_suppkey % 3 = 1""")
def n04(spark, d):
    pubs = _name_strings(spark, d).withColumn("Year", (1990 + c("PID") % 30).cast("int"))
    return names.organisation_combinations(pubs)


# --- identities ------------------------------------------------------------------------

ALIAS = """ak AS (SELECT DISTINCT staffid, name FROM authors WHERE staffid IS NOT NULL AND name IS NOT NULL),
k AS (SELECT staffid, name, count(*) OVER (PARTITION BY staffid) AS n FROM ak QUALIFY n > 1),
ao AS (SELECT DISTINCT orcid, name FROM authors WHERE orcid IS NOT NULL AND name IS NOT NULL),
o AS (SELECT orcid, name, count(*) OVER (PARTITION BY orcid) AS n FROM ao QUALIFY n > 1)"""


@query("n05_aliases", with_bound("authors", sql=ALIAS + """
SELECT k.staffid, (SELECT string_agg(orcid, ' ' ORDER BY orcid) FROM o WHERE o.name = k.name AND o.n = k.n) AS orcids, k.n, k.name, CAST(0 AS INT) AS piece FROM k"""))
def n05(spark, d):
    return identity.aliases(bound(spark, d, "authors"))


@query("n06_search_index", with_bound("authors", sql=ALIAS + """
SELECT a.name, a.staffid, a.orcid, coalesce(n, 1) AS n_names FROM (SELECT DISTINCT name, staffid, orcid FROM authors WHERE name IS NOT NULL) a
LEFT JOIN (SELECT DISTINCT staffid, n FROM k) k ON a.staffid = k.staffid"""))
def n06(spark, d):
    return identity.search_index(bound(spark, d, "authors"))


def _mode_sql(col: str) -> str:
    return (f"(SELECT staffid, {col} FROM (SELECT staffid, {col}, count(*) AS n, min(\"PID\") AS f FROM r GROUP BY 1, 2) "
            f"QUALIFY row_number() OVER (PARTITION BY staffid ORDER BY n DESC, f, {col} DESC) = 1)")


@query("n07_name_variations", with_bound("authors", sql=f"""
r AS (SELECT staffid, "PID", name, string_split(name, ', ')[1] AS last, string_split(name, ', ')[2] AS first FROM authors WHERE staffid IS NOT NULL AND name IS NOT NULL),
m AS (SELECT staffid, last, first, name FROM {_mode_sql('last')} JOIN {_mode_sql('first')} USING (staffid) JOIN {_mode_sql('name')} USING (staffid))
SELECT * FROM m WHERE concat_ws(', ', last, first) <> name"""))
def n07(spark, d):
    return identity.name_variations(bound(spark, d, "authors"))


PAIRS = """v AS (SELECT staffid, orcid, "PID" FROM authors WHERE regexp_matches(staffid, '^u1[a-z0-9]{6}$')
AND regexp_matches(orcid, '^([0-9]{4})+(-)+([0-9]{4})+(-)+([0-9]{4})+(-)+([0-9]{3}[0-9Xx])$')),
pr AS (SELECT staffid, min(orcid) AS orcid, count(DISTINCT "PID") AS n_pubs FROM v GROUP BY 1 HAVING count(DISTINCT orcid) = 1)"""


@query("n08_one_to_one", with_bound("authors", sql=PAIRS + " SELECT * FROM pr"))
def n08(spark, d):
    return identity.one_to_one_pairs(bound(spark, d, "authors"))


@query("n08_one_to_one_both_ways", with_bound("authors", sql=PAIRS + """ SELECT * FROM pr WHERE orcid IN
(SELECT orcid FROM v GROUP BY 1 HAVING count(DISTINCT staffid) = 1)"""))
def n08_both(spark, d):
    return identity.one_to_one_pairs(bound(spark, d, "authors"), both_ways=True)


@query("n11_staff_id_by_orcid", with_bound("authors", sql=PAIRS + """, sg AS (SELECT orcid, min(staffid) AS found FROM pr GROUP BY 1)
SELECT "PID", pos, a.orcid, found FROM authors a LEFT JOIN sg ON a.orcid = sg.orcid"""))
def n11(spark, d):
    a = bound(spark, d, "authors")
    rows = a.select("PID", "pos", "orcid")
    return identity.staff_id_by_orcid(rows, identity.one_to_one_pairs(a)).withColumnRenamed("staffid", "found")


@query("n11_known_pairs", with_bound("authors", sql=PAIRS + """ SELECT staffid, orcid FROM pr UNION SELECT DISTINCT staffid, orcid FROM authors WHERE autid IS NOT NULL"""))
def n11_pairs(spark, d):
    a = bound(spark, d, "authors")
    return identity.known_pairs(identity.one_to_one_pairs(a), a.where(c("autid").isNotNull()))


@query("n10_best_ids_by_name", with_bound("authors", sql="""t AS (SELECT name, staffid, orcid, orgid, count(*) AS n FROM authors GROUP BY ALL)
SELECT name, staffid, orcid, orgid, n FROM t QUALIFY row_number() OVER (PARTITION BY name ORDER BY n DESC, coalesce(staffid, '') DESC, coalesce(orcid, '') DESC, coalesce(orgid, '') DESC) = 1"""))
def n10_best(spark, d):
    return identity.best_ids_by_name(bound(spark, d, "authors"))


# --- search ------------------------------------------------------------------------------

FOLD = "regexp_replace(replace(replace(translate(lower({x}), 'åäáàâãöóòôõøéèêëíìîïúùûüçñýÿ', 'aaaaaaooooooeeeeiiiiuuuucnyy'), 'æ', 'ae'), 'ß', 'ss'), '\\s+', ' ', 'g')"
WORDS = "list_filter(regexp_split_to_array({x}, '[^\\p{{L}}\\p{{N}}]+'), lambda t: length(t) > 0)"
_FIRST = "trim(regexp_replace(lower(regexp_replace(text, '^((?:\\S+\\s+){4}\\S+).*', '\\1', 's')), '[[:punct:]]', ' ', 'g'))"
SEARCH = f"""
qt AS (SELECT item_id AS query, unnest({WORDS.format(x=FOLD.format(x=_FIRST))}) AS term FROM benchmark),
d AS (SELECT doc_id AS doc, {WORDS.format(x=FOLD.format(x='text'))} AS w FROM documents),
st AS (SELECT count(*) AS n, avg(len(w)) AS al FROM d),
tk AS (SELECT doc, len(w) AS len, unnest(w) AS term, generate_subscripts(w, 1) AS pos FROM d),
oc AS (SELECT * FROM tk WHERE term IN (SELECT term FROM qt)),
fr AS (SELECT term, count(DISTINCT doc) AS df FROM oc GROUP BY 1),
wq AS (SELECT query, term, count(*) AS times FROM qt GROUP BY 1, 2),
nq AS (SELECT query, count(*) AS nt FROM wq GROUP BY 1),
cd AS (SELECT wq.query, td.doc, any_value(nt) AS nt FROM wq JOIN (SELECT DISTINCT term, doc FROM oc) td ON wq.term = td.term JOIN nq ON nq.query = wq.query
  GROUP BY 1, 2 HAVING count(*) = any_value(nt)),
rw AS (SELECT cd.query, cd.doc, nt, oc.term, oc.pos, oc.len FROM cd JOIN wq ON wq.query = cd.query JOIN oc ON oc.doc = cd.doc AND oc.term = wq.term),
op AS (SELECT *, len(list_distinct(list(term) OVER (PARTITION BY query, doc ORDER BY pos RANGE BETWEEN CURRENT ROW AND 11 FOLLOWING))) = nt AS opens FROM rw),
ins AS (SELECT *, bool_or(opens) OVER (PARTITION BY query, doc ORDER BY pos RANGE BETWEEN 11 PRECEDING AND CURRENT ROW) AS inside FROM op),
tf AS (SELECT query, doc, term, count(*) AS tf, max(len) AS len FROM ins WHERE inside GROUP BY 1, 2, 3),
hits AS (SELECT tf.query, doc, sum(times * CASE WHEN ln((n - df + 0.5) / (df + 0.5)) > 0 THEN ln((n - df + 0.5) / (df + 0.5)) ELSE 1e-6 END
  * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / al))) AS score
  FROM tf JOIN wq ON tf.query = wq.query AND tf.term = wq.term JOIN fr ON fr.term = tf.term, st GROUP BY 1, 2)"""


@query("n09_search", "WITH " + SEARCH.strip() + " SELECT item_id, doc, round(score, 6) AS score FROM benchmark LEFT JOIN hits ON query = item_id")
def n09(spark, d):
    out = search.search_names(table(spark, d, "benchmark"), "item_id", "text", table(spark, d, "documents"), "doc_id", "text")
    return out.select("item_id", "doc", F.round("score", 6).alias("score"))


@query("n10_suggestions", "WITH " + SEARCH.strip() + """, s AS (SELECT query AS rowid, doc, score FROM hits WHERE score > 10)
SELECT rowid, CAST(0 AS INT) AS piece, string_agg(DISTINCT lang, ' ' ORDER BY lang) AS lang, string_agg(DISTINCT source, ' ' ORDER BY source) AS source,
round(avg(score), 6) AS score, count(DISTINCT score) AS n FROM s JOIN documents ON doc_id = doc GROUP BY 1""")
def n10(spark, d):
    docs = table(spark, d, "documents")
    hits = search.search(docs, "doc_id", "text", search.query_terms(table(spark, d, "benchmark"), "item_id", "text"))
    people = docs.select(c("doc_id").alias("doc"), "lang", "source")
    out = identity.suggestions(hits.withColumnRenamed("query", "rowid"), people)
    return out.withColumn("score", F.round("score", 6))


# --- linkage -----------------------------------------------------------------------------

LEFT_T = "SELECT c_custkey AS id, concat('grant ', md5(CAST(c_custkey AS VARCHAR))) AS title, concat('2000-', lpad(CAST(c_custkey AS VARCHAR), 5, '0')) AS number FROM customer"
RIGHT_T = """SELECT s_suppkey AS id, CASE s_suppkey % 4 WHEN 0 THEN concat('grant ', md5(CAST(s_suppkey AS VARCHAR)))
WHEN 1 THEN concat('grnat ', md5(CAST(s_suppkey AS VARCHAR))) WHEN 2 THEN concat('grant x', substr(md5(CAST(s_suppkey AS VARCHAR)), 2), 'yz')
ELSE concat('a grant ', substr(md5(CAST(s_suppkey AS VARCHAR)), 4)) END AS title, concat('2000-', lpad(CAST(s_suppkey * 3 AS VARCHAR), 5, '0')) AS number FROM supplier"""


def _titles(spark, d):
    as_spark = lambda q, t: spark.sql(q.replace("AS VARCHAR)", "AS STRING)").replace(f"FROM {t}", "FROM {t}"), t=table(spark, d, t))
    return as_spark(LEFT_T, "customer"), as_spark(RIGHT_T, "supplier")


LINKED = f"""l AS ({LEFT_T}), r AS ({RIGHT_T}),
fz AS (SELECT l.id AS from_id, r.id AS to_id, l.title AS left_title, r.title AS right_title, damerau_levenshtein(l.title, r.title) AS dist,
  1 - levenshtein(l.title, r.title) / greatest(length(l.title), length(r.title)) AS lev FROM l JOIN r ON damerau_levenshtein(l.title, r.title) <= 3),
ex AS (SELECT l.id AS from_id, r.id AS to_id, r.title AS right_title FROM l JOIN r USING (number)),
al AS (SELECT from_id, to_id, right_title, lev AS strength, 0 AS o FROM fz UNION ALL SELECT from_id, to_id, right_title, 1.0, 1 FROM ex),
lk AS (SELECT * FROM al QUALIFY row_number() OVER (PARTITION BY right_title ORDER BY o, strength DESC, from_id, to_id) = 1)"""


@query("l01_title_links", "WITH " + LINKED + " SELECT from_id, to_id, CAST(dist AS INT) AS osa_dist, round(lev, 6) AS levenshtein_score FROM fz")
def l01(spark, d):
    out = linkage.title_links(*_titles(spark, d), k=3)
    return out.select("from_id", "to_id", "osa_dist", F.round("levenshtein_score", 6).alias("levenshtein_score"))


@query("l03_exact_links", f"WITH l AS ({LEFT_T}), r AS ({RIGHT_T}) SELECT l.id AS from_id, r.id AS to_id, r.title AS right_title, CAST(1.0 AS DOUBLE) AS strength FROM l JOIN r USING (number)")
def l03(spark, d):
    return linkage.exact_links(*_titles(spark, d))


for _name, _parity, _where in [("l04_link_table", False, ""), ("l04_link_table_scored_only", True, "AND o = 0")]:
    @query(_name, "WITH " + LINKED + f""" SELECT 'case' AS "from", CAST(from_id AS VARCHAR) AS from_id, 'agency' AS "to", CAST(to_id AS VARCHAR) AS to_id,
round(CAST(strength AS DOUBLE), 6) AS strength, CAST(NULL AS BOOLEAN) AS curated, '2001-08-01' AS date FROM lk WHERE strength <> 0 {_where}""")
    def _l04(spark, d, _parity=_parity):
        a, b = _titles(spark, d)
        out = linkage.link_table(linkage.title_links(a, b, k=3), linkage.exact_links(a, b), "case", "agency", AS_OF, _parity)
        return out.withColumn("strength", F.round("strength", 6))


@query("l05_master_links", "WITH " + LINKED + """, m AS (SELECT 'case' AS "from", from_id, 'agency' AS "to", to_id, 1.0 AS strength FROM ex
UNION ALL SELECT 'agency', to_id, 'case', from_id, 1.0 FROM ex) SELECT "from", from_id, "to", to_id, CAST(strength AS DOUBLE) AS strength FROM m""")
def l05(spark, d):
    ex = linkage.exact_links(*_titles(spark, d))
    a = ex.select(F.lit("case").alias("from"), "from_id", F.lit("agency").alias("to"), "to_id", "strength")
    b = ex.select(F.lit("agency").alias("from"), c("to_id").alias("from_id"), F.lit("case").alias("to"), c("from_id").alias("to_id"), "strength")
    return linkage.master_links(a, b)


UNIT_A = "SELECT DISTINCT concat(upper(p_type), ' ', p_name) AS name FROM part"
UNIT_B = "SELECT DISTINCT concat(p_type, ' ', p_name, 's') AS name FROM part"


# Six sources with a row per supplier (and some titles twice), titles up to five edits apart, numbers of their own.
SOURCES = {"case": (0, 1), "swecris": (1, 3), "cordis": (0, 2), "openaire": (2, 2), "vinnova": (3, 2), "formas": (1, 5)}
SOURCE_T = """SELECT s_suppkey AS id, CASE (s_suppkey + {shift}) % 4 WHEN 0 THEN concat('grant ', md5(CAST(s_suppkey AS VARCHAR(20))))
WHEN 1 THEN concat('grnat ', md5(CAST(s_suppkey AS VARCHAR(20)))) WHEN 2 THEN concat('a grant ', md5(CAST(s_suppkey AS VARCHAR(20))))
ELSE concat('grant ', substr(md5(CAST(s_suppkey AS VARCHAR(20))), 1, 29)) END AS title, concat('2000-', lpad(CAST(s_suppkey * {times} AS VARCHAR(20)), 5, '0')) AS number
FROM supplier UNION ALL SELECT s_suppkey + 1000000, concat('grant ', md5(CAST(s_suppkey AS VARCHAR(20)))), NULL FROM supplier WHERE s_suppkey % 7 = {shift}"""


def _sources(spark, d):
    read = lambda shift, times: spark.sql(SOURCE_T.format(shift=shift, times=times).replace("FROM supplier", "FROM {s}"), s=table(spark, d, "supplier"))
    return {name: read(*how) for name, how in SOURCES.items()}


def _sources_sql(master: bool) -> str:
    heads = ", ".join(f"from_{n} AS ({SOURCE_T.format(shift=a, times=b)})" for n, (a, b) in SOURCES.items())
    parts = []
    for p in linkage.SOURCE_PAIRS:
        if master and not p.master:
            continue
        exact = f"SELECT a.id AS f, b.id AS t, b.title AS tt, 1.0 AS strength, 1 AS o FROM from_{p.source} a JOIN from_{p.target} b ON a.number = b.number"
        one = "QUALIFY row_number() OVER (PARTITION BY title ORDER BY id) = 1" if p.first else ""
        # titles of different suppliers are never near
        fuzzy = f"""SELECT a.id AS f, b.id AS t, b.title AS tt, 1 - levenshtein(a.title, b.title) / greatest(length(a.title), length(b.title)) AS strength, 0 AS o
          FROM (SELECT * FROM from_{p.source} {one}) a JOIN (SELECT * FROM from_{p.target} {one}) b ON a.id % 1000000 = b.id % 1000000 AND damerau_levenshtein(a.title, b.title) <= {p.edits}"""
        rows = exact if p.edits is None else f"{fuzzy} UNION ALL {exact}" if p.number else fuzzy
        pick = "QUALIFY row_number() OVER (PARTITION BY tt ORDER BY o, strength DESC, f, t) = 1" if p.first else ""
        parts.append(f"""SELECT '{p.source}' AS "from", CAST(f AS VARCHAR) AS from_id, '{p.target}' AS "to", CAST(t AS VARCHAR) AS to_id, round(CAST(strength AS DOUBLE), 6) AS strength,
          CAST(NULL AS BOOLEAN) AS curated, '2001-08-01' AS date FROM (SELECT * FROM ({rows}) {pick})""")
    return f"WITH {heads} " + " UNION ALL ".join(parts)


for _name, _master in [("l05_master_table", True), ("l05_all_source_pairs", False)]:
    @query(_name, _sources_sql(_master))
    def _l05(spark, d, _master=_master):
        """Ten pairs of sources, each with its own distance; the master table leaves one out."""
        out = linkage.linked_sources(_sources(spark, d), AS_OF, master=_master)
        return out.withColumn("strength", F.round("strength", 6))


@query("l06_best_matches", f"""WITH a AS ({UNIT_A}), b AS ({UNIT_B}),
j AS (SELECT a.name, b.name AS match, 1 - jaro_similarity(upper(a.name), upper(b.name)) AS distance FROM a, b)
SELECT name, match, round(distance, 6) AS distance FROM j WHERE distance <= 0.1 QUALIFY row_number() OVER (PARTITION BY name ORDER BY round(distance, 9), match) = 1""")
def l06(spark, d):
    p = table(spark, d, "part")
    a = p.select(F.concat_ws(" ", F.upper("p_type"), "p_name").alias("name"))
    b = p.select(F.concat(c("p_type"), F.lit(" "), c("p_name"), F.lit("s")).alias("name"))
    return linkage.best_matches(a, b, "name").withColumn("distance", F.round("distance", 6))


@query("l06_match_units", with_bound("organisations", sql="""SELECT orgid, concat('slug', orgid) AS slug FROM organisations"""))
def l06_units(spark, d):
    """Units whose English name is listed as it is, or whose Swedish name is."""
    o = bound(spark, d, "organisations")
    slug = F.concat(F.lit("slug"), c("orgid")).alias("slug")
    en = o.where(c("is_closed")).select(c("unit_en").alias("name"), slug)
    sv = o.where(~c("is_closed")).select(c("unit_sv").alias("name"), slug)
    units = o.select("orgid", F.when(c("is_closed"), c("unit_en")).alias("unit_en"), F.when(~c("is_closed"), c("unit_sv")).alias("unit_sv"))
    return linkage.match_units(units, en, sv, 0.0).select("orgid", "slug")


@query("l07_majority_units", """WITH s AS (SELECT c_nationkey AS unit, o_custkey AS staffid, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2),
t AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY unit ORDER BY n DESC, staffid) <= 5),
v AS (SELECT unit, c_mktsegment AS candidate, count(*) AS votes FROM t JOIN customer ON c_custkey = staffid GROUP BY 1, 2)
SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY unit ORDER BY votes DESC, candidate) = 1""")
def l07(spark, d):
    o, cu = table(spark, d, "orders"), table(spark, d, "customer")
    staff = o.join(cu, o.o_custkey == cu.c_custkey).groupBy(c("c_nationkey").alias("unit"), c("o_custkey").alias("staffid")).agg(F.count(F.lit(1)).alias("n"))
    return identity.majority_units(staff, cu.select(c("c_custkey").alias("staffid"), c("c_mktsegment").alias("candidate")))


# --- staff records ---------------------------------------------------------------------------

D = "DATE '2001-08-01'"
HSUM = f"""hs AS (SELECT staffid, max(emp_lastmod) AS elm, min(emp_beg) AS ebeg, max(emp_end) AS eend, count(*) AS n, max(yob) AS yob,
CAST(date_diff('day', min(emp_beg), max(emp_end)) AS INT) AS duration, CAST(date_diff('day', {D}, max(emp_end)) AS INT) AS ttl FROM hr GROUP BY 1),
run AS (SELECT * FROM hr WHERE emp_beg <= {D} AND emp_end > {D}),
tops AS (SELECT staffid, max(emp_lastmod) AS a, max(emp_end) AS b, max(emp_beg) AS c FROM run GROUP BY 1),
cur AS (SELECT run.* FROM run JOIN tops ON run.staffid = tops.staffid AND emp_lastmod = a AND emp_end = b AND emp_beg = c)"""
txt = lambda *n: ", ".join(f"CAST({i} AS VARCHAR) AS {i}" for i in n)


@query("g13_staff_summary", with_bound("hr", sql=HSUM + f" SELECT staffid, {txt('elm', 'ebeg', 'eend')}, n, yob, duration, ttl FROM hs"))
def g13(spark, d):
    return hr.summary(bound(spark, d, "hr"), HR_DAY)


@query("q32_staff_age", with_bound("hr", sql=HSUM + f""" SELECT hs.staffid, {txt('ebeg')}, hs.yob, duration, ttl, unit_abbr, lastname, firstname
FROM hs LEFT JOIN hr ON hr.staffid = hs.staffid AND hr.yob = hs.yob WHERE ebeg < {D} - 36500 OR year(ebeg) - hs.yob < 0 OR hs.yob = 1900"""))
def q32(spark, d):
    return hr.check_age(bound(spark, d, "hr"), HR_DAY)


@query("q33_staff_long_end", with_bound("hr", sql=HSUM + f""" SELECT hs.staffid, {txt('eend')}, duration, ttl, unit_abbr, lastname, firstname
FROM hs LEFT JOIN cur ON cur.staffid = hs.staffid WHERE ttl > 6 * 365.25 AND ttl < 36525"""))
def q33(spark, d):
    return hr.check_long_end(bound(spark, d, "hr"), HR_DAY)


@query("q34_staff_last_modified", with_bound("hr", sql=HSUM + f""" SELECT hs.staffid, {txt('elm', 'ebeg')}, duration, ttl, unit_abbr, lastname, firstname
FROM hs LEFT JOIN hr ON hr.staffid = hs.staffid WHERE elm > {D} + 60 OR elm < ebeg"""))
def q34(spark, d):
    return hr.check_last_modified(bound(spark, d, "hr"), HR_DAY)


@query("q35_staff_topics", with_bound("hr", "areas", sql=HSUM + """, bad AS (SELECT DISTINCT * FROM cur WHERE scb_topic IS NOT NULL AND scb_topic <> '999' AND scb_topic NOT IN (SELECT id FROM areas))
SELECT scb_topic, count(*) OVER (PARTITION BY scb_topic) AS n, staffid, unit_abbr, unit_name, lastname, firstname FROM bad"""))
def q35(spark, d):
    return hr.check_topics(bound(spark, d, "hr"), bound(spark, d, "areas"), HR_DAY)


@query("q35_staff_names", with_bound("hr", sql="""SELECT staffid, unit_abbr, firstname, lastname FROM hr WHERE regexp_matches(lastname, '\\s{2,}|[[:cntrl:]]|\\s$')
OR regexp_matches(firstname, '\\s{2,}|[[:cntrl:]]|\\s$')"""))
def q35_names(spark, d):
    return hr.check_full_names(bound(spark, d, "hr"))


@query("q35_unknown_areas", with_bound("hr", "areas", sql="""SELECT scb_topic, count(*) AS n FROM hr WHERE scb_topic <> '999' AND scb_topic NOT IN (SELECT id FROM areas) GROUP BY 1"""))
def q35_areas(spark, d):
    return hr.check_research_areas(bound(spark, d, "hr"), bound(spark, d, "areas"))


@query("x09_extended", with_bound("hr", "areas", sql="""SELECT emp_key, scb_topic, swe AS scb_topic_swe, eng AS scb_topic_eng, level AS scb_topic_level FROM hr LEFT JOIN areas ON id = scb_topic"""))
def x09(spark, d):
    return hr.extended(bound(spark, d, "hr").select("emp_key", "scb_topic"), None, bound(spark, d, "areas"))


@query("x09_current", with_bound("hr", sql=HSUM + " SELECT DISTINCT staffid, emp_key FROM cur"))
def x09_current(spark, d):
    return hr.current(bound(spark, d, "hr"), HR_DAY).select("staffid", "emp_key")


@query("x09_periods", with_bound("hr", sql="SELECT staffid, unit_abbr, CAST(min(emp_beg) AS VARCHAR) AS beg, CAST(max(emp_end) AS VARCHAR) AS \"end\" FROM hr GROUP BY 1, 2"))
def x09_periods(spark, d):
    return hr.periods(bound(spark, d, "hr"))


@query("x09_point_in_time", with_bound("hr", sql="SELECT emp_key FROM hr WHERE emp_beg <= DATE '1999-06-30' AND emp_end >= DATE '1999-06-30'"))
def x09_at(spark, d):
    return hr.employed_at(bound(spark, d, "hr"), dt.date(1999, 6, 30)).select("emp_key")


KNOWN = "kp AS (SELECT DISTINCT concat('u1', lpad(CAST(s_suppkey AS VARCHAR), 6, '0')) AS staffid FROM supplier)"


def _staff_pairs(spark, d):
    return table(spark, d, "supplier").select(F.format_string("u1%06d", "s_suppkey").alias("staffid"), F.lit("x").alias("orcid"))


@query("x10_researchers_without_orcid", with_bound("hr", sql=HSUM + ", " + KNOWN + """ SELECT DISTINCT staffid, unit_abbr, lastname, firstname FROM cur
WHERE regexp_matches(emp_desc, 'PROFESSOR|DOKTORAND') AND staffid NOT IN (SELECT staffid FROM kp)"""))
def x10(spark, d):
    return hr.researchers_without_orcid(bound(spark, d, "hr"), _staff_pairs(spark, d), HR_DAY)


@query("x10_coverage", with_bound("hr", sql=HSUM + ", " + KNOWN + """, w AS (SELECT DISTINCT staffid, unit_abbr FROM cur WHERE regexp_matches(emp_desc, 'PROFESSOR|DOKTORAND'))
SELECT unit_abbr, count(*) AS n, count(*) FILTER (WHERE staffid IN (SELECT staffid FROM kp)) AS n_orcid FROM w GROUP BY 1"""))
def x10_coverage(spark, d):
    return hr.orcid_coverage(bound(spark, d, "hr"), _staff_pairs(spark, d), HR_DAY)


# --- cross-checks ----------------------------------------------------------------------------

CROSS = """imp AS (SELECT DISTINCT "ScopusId" AS e FROM pubs WHERE "ScopusId" IS NOT NULL),
fresh AS (SELECT * FROM batch WHERE eid NOT IN (SELECT e FROM imp)),
upd AS (SELECT p."PID", p."DOI", eid FROM fresh JOIN (SELECT "PID", "DOI", lower("DOI") AS k FROM pubs) p ON lower(fresh.doi) = p.k)"""


def cross(name: str, sql: str, fn):
    query(name, with_bound("pubs", "batch", sql=CROSS + " " + sql))(lambda spark, d: fn(bound(spark, d, "pubs"), bound(spark, d, "batch")))


cross("x01_already_imported", 'SELECT "PID", "ScopusId" FROM pubs WHERE "ScopusId" IN (SELECT eid FROM batch)',
      lambda p, b: x.already_imported(p, b).select("PID", "ScopusId"))
cross("x02_updatable", 'SELECT * FROM upd', x.updatable)
cross("x03_importable", 'SELECT sid, eid FROM fresh WHERE doi IS NULL OR NOT EXISTS (SELECT 1 FROM pubs WHERE lower("DOI") = lower(fresh.doi))',
      lambda p, b: x.importable(p, b).select("sid", "eid"))
cross("x04_import_groups", """SELECT CASE subtype WHEN 'Conference Paper' THEN 'conference' WHEN 'Article' THEN 'article' WHEN 'Erratum' THEN 'erratum' ELSE 'other' END AS import_group, count(*) AS n FROM batch GROUP BY 1""",
      lambda p, b: x.with_import_group(b).groupBy("import_group").agg(F.count(F.lit(1)).alias("n")))
cross("x05_type_table", """SELECT aggregation, subtype, count(*) AS n, CASE WHEN aggregation = 'Journal' AND subtype = 'Article' THEN 'article' WHEN aggregation = 'Journal' AND subtype = 'Review' THEN 'review'
WHEN aggregation = 'Journal' AND subtype = 'Conference Paper' THEN 'articleConferencePaper' WHEN aggregation = 'Journal' AND subtype = 'Erratum' THEN 'articleErratum'
WHEN aggregation = 'Conference Proceeding' AND subtype IN ('Conference Paper', 'Book Chapter') THEN 'conferencePaperPublished'
WHEN aggregation = 'Book' AND subtype = 'Book Chapter' THEN 'chapter' ELSE 'other' END AS genre FROM batch GROUP BY 1, 2""", lambda p, b: x.type_table(b))
cross("x07_due_for_import", "SELECT sid, eid FROM fresh WHERE cover_date <= DATE '2001-07-01'",
      lambda p, b: x.due_for_import(b, p, dt.date(2001, 7, 1)).select("sid", "eid"))


@query("x06_institution_authors", """SELECT l_orderkey AS sid, l_suppkey AS afid, l_linenumber AS seq, s_name AS affilname, o_orderstatus AS status FROM lineitem
JOIN supplier ON s_suppkey = l_suppkey JOIN orders ON o_orderkey = l_orderkey WHERE starts_with(s_name, 'Supplier#00000000')""")
def x06(spark, d):
    li = table(spark, d, "lineitem").select(c("l_orderkey").alias("sid"), c("l_suppkey").alias("afid"), c("l_linenumber").alias("seq"))
    aff = li.select("sid", "afid").distinct().join(table(spark, d, "supplier").select(c("s_suppkey").alias("afid"), c("s_name").alias("affilname")), "afid")
    pubs = table(spark, d, "orders").select(c("o_orderkey").alias("sid"), c("o_orderstatus").alias("status"))
    return x.authors_of_institution(li, aff, pubs, "Supplier#00000000")


@query("x08_snapshot_changes", """WITH a AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_custkey AS cu FROM orders WHERE o_orderdate < DATE '2000-01-01'),
b AS (SELECT o_orderkey AS k, CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderstatus END AS s, CASE WHEN o_orderpriority = '2-HIGH' THEN o_custkey + 1 ELSE o_custkey END AS cu
  FROM orders WHERE o_orderdate >= DATE '1996-01-01'),
j AS (SELECT coalesce(a.k, b.k) AS k, a.k AS ak, b.k AS bk, a.s AS sa, b.s AS sb, CAST(a.cu AS VARCHAR) AS ca, CAST(b.cu AS VARCHAR) AS cb FROM a FULL JOIN b ON a.k = b.k)
SELECT k, 'added' AS change, NULL AS field, NULL AS old, NULL AS new FROM j WHERE ak IS NULL UNION ALL SELECT k, 'removed', NULL, NULL, NULL FROM j WHERE bk IS NULL
UNION ALL SELECT k, 'changed', 's', sa, sb FROM j WHERE ak = bk AND sa IS DISTINCT FROM sb UNION ALL SELECT k, 'changed', 'cu', ca, cb FROM j WHERE ak = bk AND ca IS DISTINCT FROM cb""")
def x08(spark, d):
    o = table(spark, d, "orders").withColumn("k", c("o_orderkey"))
    old = o.where(c("o_orderdate") < F.lit(dt.date(2000, 1, 1))).select("k", c("o_orderstatus").alias("s"), c("o_custkey").alias("cu"))
    new = o.where(c("o_orderdate") >= F.lit(dt.date(1996, 1, 1))).select(
        "k", F.when(c("o_orderpriority") != "1-URGENT", c("o_orderstatus")).alias("s"),
        F.when(c("o_orderpriority") == "2-HIGH", c("o_custkey") + 1).otherwise(c("o_custkey")).alias("cu"))
    return x.snapshot_changes(old, new, "k", ["s", "cu"])


@query("x08_one_changed_row", """SELECT max(o_orderkey) AS k, 'changed' AS change, 's' AS field, max_by(o_orderstatus, o_orderkey) AS old,
concat(max_by(o_orderstatus, o_orderkey), '!') AS new FROM orders""")
def x08_one(spark, d):
    """A snapshot and the same with one cell changed: one bucket is joined."""
    o = table(spark, d, "orders").select(c("o_orderkey").alias("k"), c("o_orderstatus").alias("s"), c("o_custkey").alias("cu"))
    last = o.agg(F.max("k")).first()[0]
    new = o.withColumn("s", F.when(c("k") == last, F.concat("s", F.lit("!"))).otherwise(c("s")))
    return x.snapshot_changes(o, new, "k", ["s", "cu"])


@query("x12_missing_places", """SELECT l_suppkey AS place, count(DISTINCT l_orderkey) AS n FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_acctbal > 5000
WHERE s_suppkey IS NULL AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey = 3) GROUP BY 1""")
def x12(spark, d):
    s = table(spark, d, "supplier")
    rows = table(spark, d, "lineitem").select(c("l_suppkey").alias("place"), "l_orderkey")
    places = s.where(c("s_acctbal") > 5000).select(c("s_suppkey").alias("place"), F.lit(1.0).alias("lat"))
    return x.missing_places(rows, places, "place", [s.where(c("s_nationkey") == 3).select(c("s_suppkey").alias("place"))], "l_orderkey")


@query("x13_issue_texts", """SELECT o_custkey, CAST(0 AS INT) AS piece, string_agg(concat('- [ ] https://p.example/smash/record.jsf?dswid=-310&pid=diva2%3A', o_orderkey), chr(10)
ORDER BY CAST(o_orderkey AS VARCHAR)) AS text FROM orders GROUP BY 1""")
def x13(spark, d):
    return x.issue_texts(table(spark, d, "orders").select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey", "https://p.example")


@query("x14_programme_projects", """SELECT o_orderkey AS id, round(o_totalprice, 2) AS cost, CASE o_orderstatus WHEN 'F' THEN 'FP7' WHEN 'O' THEN 'H2020' ELSE 'HE' END AS programme,
CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS topic FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_suppkey <= 50)""")
def x14(spark, d):
    o = table(spark, d, "orders")
    cost = F.replace(F.format_string("%.2f", "o_totalprice"), F.lit("."), F.lit(",")).alias("cost")
    part = lambda s, *extra: o.where(c("o_orderstatus") == s).select(c("o_orderkey").alias("id"), cost, *extra)
    org = table(spark, d, "lineitem").where(c("l_suppkey") <= 50).select(c("l_orderkey").alias("project_id"))
    tables = {"FP7": part("F", c("o_orderpriority").alias("topic")), "H2020": part("O"), "HE": part("P")}
    return x.programme_projects(tables, {n: org for n in tables})


@query("x15_wrangled_projects", """SELECT c_nationkey AS department, o_orderkey AS id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS beg, CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) + 30 AS VARCHAR) END AS "end",
CASE WHEN o_orderstatus <> 'P' THEN CAST(30 AS INT) END AS duration, n_name FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey""")
def x15(spark, d):
    return _wrangled(spark, d)[0]


@query("x15_date_problems", """SELECT o_orderkey AS id, 'end' AS field, 'soon' AS value FROM orders WHERE o_orderstatus = 'P'""")
def x15_problems(spark, d):
    return _wrangled(spark, d)[1]


def _wrangled(spark, d):
    o, cu = table(spark, d, "orders"), table(spark, d, "customer")
    end = F.when(c("o_orderstatus") == "P", F.lit("soon")).otherwise(F.concat(F.date_add(c("o_orderdate").cast("date"), 30).cast("string"), F.lit("T00:00")))
    raw = o.join(cu, o.o_custkey == cu.c_custkey).select(
        c("o_orderkey").alias("Project Id"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm").alias("Start"), end.alias("End"),
        c("c_nationkey").alias("Department"), c("o_orderstatus").alias("Unused"))
    mapping = {"Project Id": "id", "Start": "beg", "End": "end", "Department": "department"}
    depts = table(spark, d, "nation").select(c("n_nationkey").alias("department"), "n_name")
    return x.wrangle_projects(raw, mapping, depts)


@query("n21_funder_resolution", """WITH lk AS (SELECT s_nationkey AS v, s_name AS name, s_suppkey AS id FROM supplier QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_name, s_suppkey) = 1)
SELECT c_custkey, concat('SE ', c_nationkey) AS vat, lk.name AS funder, id AS funder_id FROM customer LEFT JOIN lk ON v = c_nationkey""")
def n21(spark, d):
    f = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("SE "), "c_nationkey").alias("vat"))
    lk = table(spark, d, "supplier").select(F.concat(F.lit("se"), "s_nationkey").alias("vat"), c("s_name").alias("name"), c("s_suppkey").alias("funder_id"))
    return x.resolve_funders(f, lk)
