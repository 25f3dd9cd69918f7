"""Reshaping, joins, aggregates, ordered computations and set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from bibweave.functions import nulls, text
from bibweave.operators import calendar, groups, joins, ordered, reshape, setops
from bibweave.plans.bindings import AS_OF, bound, with_bound
from bibweave.plans.registry import query, table

c = F.col

# --- projections and reshaping ---------------------------------------------------


@query("p01_projection", "SELECT o_orderpriority, o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
       "CAST(o_orderdate AS VARCHAR) AS o_orderdate FROM orders")
def p01(spark, d):
    return reshape.pick(table(spark, d, "orders"), ["o_orderpriority", "no_such_column", "o_orderkey"], rest=True)


@query("p02_derived_columns", "SELECT o_orderkey, lower(o_orderpriority) AS o_orderpriority, lower(o_orderstatus) AS "
       "o_orderstatus, round(o_totalprice * 2, 2) AS twice FROM orders")
def p02(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    low = {n: F.lower(n) for n in ["o_orderpriority", "o_orderstatus"]}
    return o.withColumns({**low, "twice": F.round(c("o_totalprice") * 2, 2)}).drop("o_totalprice")


@query("p04_filters", with_bound("pubs", sql="""SELECT "PID", "Status", "DOI" FROM pubs WHERE ("Status" IS NULL OR "Status" NOT IN
('submitted', 'accepted')) AND NOT coalesce(regexp_matches("DOI", '^10'), false) AND "Year" >= 2015"""))
def p04(spark, d):
    p = bound(spark, d, "pubs")
    keep = nulls.not_in(c("Status"), ["submitted", "accepted"]) & nulls.not_matching(c("DOI"), "^10") & (c("Year") >= 2015)
    return p.where(keep).select("PID", "Status", "DOI")


@query("p05_rename_by_mapping", "SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS amount FROM orders")
def p05(spark, d):
    names = {"o_orderkey": "id", "o_orderstatus": "status", "o_totalprice": "amount"}
    return reshape.rename_by_mapping(table(spark, d, "orders"), names)[0]


@query("p06_describe_columns", """SELECT DISTINCT event_type AS name, CASE event_type WHEN 'click' THEN 'klick' WHEN 'view' THEN
'visning' ELSE event_type END AS description FROM events""")
def p06(spark, d):
    known = spark.createDataFrame([("click", "klick"), ("view", "visning")], "name string, description string")
    return reshape.describe_columns(table(spark, d, "events").select(c("event_type").alias("name")).distinct(), known)


@query("p07_longer", """SELECT l_orderkey, l_linenumber, name, value FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM lineitem) UNPIVOT (value FOR name IN (l_partkey, l_suppkey))""")
def p07(spark, d):
    return reshape.longer(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


@query("p08_wider", """SELECT l_orderkey, CAST(0 AS INT) AS piece,
string_agg(CAST(l_partkey AS VARCHAR), '|' ORDER BY l_partkey) FILTER (WHERE l_returnflag = 'A') AS "A",
string_agg(CAST(l_partkey AS VARCHAR), '|' ORDER BY l_partkey) FILTER (WHERE l_returnflag = 'N') AS "N",
string_agg(CAST(l_partkey AS VARCHAR), '|' ORDER BY l_partkey) FILTER (WHERE l_returnflag = 'R') AS "R"
FROM lineitem GROUP BY l_orderkey""")
def p08(spark, d):
    return reshape.wider(table(spark, d, "lineitem"), ["l_orderkey"], "l_returnflag", "l_partkey", ["A", "N", "R"])


@query("p09_flatten", """SELECT event_id, user_id AS who_id, event_type AS who_what_kind, value AS who_what_amount FROM events""")
def p09(spark, d):
    ev = table(spark, d, "events")
    what = F.struct(c("event_type").alias("kind"), c("value").alias("amount"))
    return reshape.flatten(ev.select("event_id", F.struct(c("user_id").alias("id"), what.alias("what")).alias("who")))


@query("p10_split_rows", with_bound("pubs", sql="""SELECT "PID", unnest(coalesce(string_split("ISBN", ';'), [NULL])) AS "ISBN" FROM pubs"""))
def p10(spark, d):
    return reshape.split_rows(bound(spark, d, "pubs").select("PID", "ISBN"), "ISBN", ";")


@query("p10_split_rows_drop", with_bound("pubs", sql="""SELECT "PID", unnest(string_split("ISBN", ';')) AS "ISBN" FROM pubs"""))
def p10_drop(spark, d):
    return reshape.split_rows(bound(spark, d, "pubs").select("PID", "ISBN"), "ISBN", ";", keep_missing=False)


@query("p11_parallel_unnest", """WITH a AS (SELECT l_orderkey, list(l_partkey ORDER BY l_partkey, l_suppkey) AS part,
list(l_suppkey ORDER BY l_partkey, l_suppkey) AS supp FROM lineitem GROUP BY 1)
SELECT l_orderkey, unnest(part) AS part, unnest(supp) AS supp, l_orderkey AS one FROM a""")
def p11(spark, d):
    pair = F.array_sort(F.collect_list(F.struct("l_partkey", "l_suppkey")))
    a = table(spark, d, "lineitem").groupBy("l_orderkey").agg(pair.alias("x"))
    a = a.select("l_orderkey", F.transform("x", lambda p: p["l_partkey"]).alias("part"),
                 F.transform("x", lambda p: p["l_suppkey"]).alias("supp"), F.array("l_orderkey").alias("one"))
    return reshape.unnest(a, ["part", "supp", "one"])


@query("p12_split_columns", """SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS b,
c_mktsegment AS a FROM customer""")
def p12(spark, d):
    both = F.when(c("c_custkey") % 2 == 0, F.concat_ws("|", "c_mktsegment", "c_name")).otherwise(c("c_mktsegment"))
    return reshape.split_columns(table(spark, d, "customer").select("c_custkey", both.alias("x")), "x", ["a", "b"])


@query("p13_paste", with_bound("pubs", sql="""SELECT "PID", concat_ws('_', "DOI", "ISI") AS present,
concat(coalesce("DOI", 'NA'), ', ', coalesce("ISI", 'NA')) AS pasted FROM pubs"""))
def p13(spark, d):
    return bound(spark, d, "pubs").select(
        "PID", nulls.paste_present(c("DOI"), c("ISI")).alias("present"), nulls.paste(c("DOI"), c("ISI"), sep=", ").alias("pasted"))


@query("p14_drop_empty_columns", with_bound("authors", sql="""SELECT "PID", pos, "DOI", "ScopusId" FROM authors"""))
def p14(spark, d):
    return reshape.drop_empty_columns(bound(spark, d, "authors").select("PID", "pos", "DOI", "ISI", "ScopusId"))


@query("p15_empty_to_missing", with_bound("pubs", sql="""SELECT "PID", nullif("Notes", '') AS "Notes",
CASE WHEN length("Status") >= 9 THEN "Status" END AS "Status" FROM pubs"""))
def p15(spark, d):
    rows = nulls.strip_empty(bound(spark, d, "pubs").select("PID", "Notes", "Status"))
    return nulls.strip_short(rows, ["Status"], 9)


@query("p16_recode", """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE o_orderstatus END
AS status FROM orders""")
def p16(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", reshape.recode(c("o_orderstatus"), {"F": "Finished", "O": "Open"}).alias("status"))


@query("p17_tidy_names", "SELECT o_orderkey AS dc_identifier, o_custkey AS citedby_count, o_orderstatus AS seq FROM orders")
def p17(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return reshape.tidy_names(o.toDF("dc:identifier", "citedby-count", "@seq"))


# --- joins ---------------------------------------------------------------------------


@query("j01_inner", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def j01(spark, d):
    o, cu = table(spark, d, "orders"), table(spark, d, "customer")
    return o.join(cu, o.o_custkey == cu.c_custkey).select("o_orderkey", "c_name")


@query("j02_lookup", "SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey "
       "LEFT JOIN region ON n_regionkey = r_regionkey")
def j02(spark, d):
    nation = table(spark, d, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = table(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    out = joins.lookup(table(spark, d, "customer"), nation, ["c_nationkey"])
    return joins.lookup(out, region, ["n_regionkey"]).select("c_custkey", "n_name", "r_name")


@query("j03_many_to_many", with_bound("pubs", "authors", sql="""SELECT p."PID", "Title", a.name FROM pubs p LEFT JOIN authors a ON p."PID" = a."PID" """))
def j03(spark, d):
    titles = bound(spark, d, "pubs").select("PID", "Title")
    return titles.join(bound(spark, d, "authors").select("PID", "name"), "PID", "left")


@query("j04_anti", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def j04(spark, d):
    o = table(spark, d, "orders").where(c("o_orderstatus") == "P")
    return joins.absent_from(table(spark, d, "customer"), o, "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query("j05_semi", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def j05(spark, d):
    o = table(spark, d, "orders").where(c("o_orderstatus") == "P")
    return joins.present_in(table(spark, d, "customer"), o, "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query("j06_not_in_with_missing", with_bound("pubs", "batch", sql="""SELECT "PID", "ScopusId" FROM pubs
WHERE NOT EXISTS (SELECT 1 FROM batch WHERE eid = "ScopusId")"""))
def j06(spark, d):
    return joins.absent_from(bound(spark, d, "pubs"), bound(spark, d, "batch"), "ScopusId", "eid").select("PID", "ScopusId")


@query("j07_nullsafe_join", with_bound("authors", sql="""k AS (SELECT name, orcid, staffid, count(*) AS n FROM authors GROUP BY ALL)
SELECT a."PID", a.pos, k.name, k.orcid, k.staffid, n FROM authors a JOIN k ON a.name IS NOT DISTINCT FROM k.name
AND a.orcid IS NOT DISTINCT FROM k.orcid AND a.staffid IS NOT DISTINCT FROM k.staffid"""))
def j07(spark, d):
    a = bound(spark, d, "authors").select("PID", "pos", "name", "orcid", "staffid")
    return groups.with_count(a, ["name", "orcid", "staffid"])


@query("j08_parent", with_bound("organisations", sql="""SELECT o.orgid, o.p_orgid, p.unit_en AS parent FROM organisations o
LEFT JOIN organisations p ON o.p_orgid = p.orgid"""))
def j08(spark, d):
    return joins.with_parent(bound(spark, d, "organisations"), "orgid", "p_orgid", "unit_en", "parent").select("orgid", "p_orgid", "parent")


@query("j09_case_insensitive", with_bound("pubs", "batch", sql="""SELECT "PID", "DOI", sid FROM pubs JOIN
(SELECT sid, doi AS bdoi FROM batch) b ON lower("DOI") = lower(bdoi)"""))
def j09(spark, d):
    batch = bound(spark, d, "batch").select("sid", c("doi").alias("batch_doi"))
    return joins.by_lower(bound(spark, d, "pubs").select("PID", "DOI"), batch, "DOI", "batch_doi")


@query("j10_residual", """SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON c_nationkey = s_nationkey AND
c_acctbal > s_acctbal""")
def j10(spark, d):
    cu = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    return joins.above(cu, s, ("c_nationkey", "s_nationkey"), ("c_acctbal", "s_acctbal")).select("c_custkey", "s_suppkey")


@query("j11_point_in_time", with_bound("hr", sql="""SELECT emp_key, staffid FROM hr WHERE emp_beg <= DATE '1999-01-01' AND emp_end >= DATE '1999-01-01'"""))
def j11(spark, d):
    return joins.valid_at(bound(spark, d, "hr"), "emp_beg", "emp_end", F.lit(dt.date(1999, 1, 1))).select("emp_key", "staffid")


@query("j11_calendar_range", with_bound("hr", sql="""days AS (SELECT CAST(unnest(generate_series(DATE '1996-01-01', DATE '2001-01-01', INTERVAL 1 YEAR)) AS DATE) AS day)
SELECT CAST(day AS VARCHAR) AS day, emp_desc, count(*) AS n FROM hr JOIN days ON day BETWEEN emp_beg AND emp_end GROUP BY day, emp_desc"""))
def j11_range(spark, d):
    days = spark.range(1).select(F.explode(F.expr("sequence(date'1996-01-01', date'2001-01-01', interval 1 year)")).alias("day"))
    rows = joins.valid_on_days(bound(spark, d, "hr").select("emp_desc", "emp_beg", "emp_end"), days, "day", "emp_beg", "emp_end")
    return rows.groupBy("day", "emp_desc").agg(F.count(F.lit(1)).alias("n"))


@query("j13_natural_join", """SELECT a.l_orderkey, a.l_linenumber, a.l_partkey, b.l_suppkey FROM lineitem a JOIN
(SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey FROM lineitem) b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber""")
def j13(spark, d):
    li = table(spark, d, "lineitem")
    return nulls.natural_join(li.select("l_orderkey", "l_linenumber", "l_partkey"),
                              li.select("l_orderkey", "l_linenumber", "l_suppkey").distinct())


@query("j14_grid", """SELECT n_name, yr, coalesce(n, 0) AS n FROM (SELECT n_nationkey, n_name, unnest([1996, 1997, 1998]) AS yr FROM nation)
LEFT JOIN (SELECT c_nationkey, CAST(year(o_orderdate) AS INT) AS y, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
ON n_nationkey = c_nationkey AND yr = y""")
def j14(spark, d):
    """All combinations of two small sets by exploding a literal array."""
    grid = table(spark, d, "nation").select("n_nationkey", "n_name", F.explode(F.array(*[F.lit(y) for y in (1996, 1997, 1998)])).alias("yr"))
    o, cu = table(spark, d, "orders"), table(spark, d, "customer")
    n = o.join(cu, o.o_custkey == cu.c_custkey).groupBy(c("c_nationkey").alias("n_nationkey"), F.year("o_orderdate").alias("yr")).agg(F.count(F.lit(1)).alias("n"))
    return grid.join(n, ["n_nationkey", "yr"], "left").select("n_name", "yr", F.coalesce("n", F.lit(0)).alias("n"))


@query("j15_rejoin_latest", with_bound("hr", sql="""g AS (SELECT staffid, max(emp_lastmod) AS a, max(emp_end) AS b, max(emp_beg) AS c FROM hr GROUP BY 1)
SELECT DISTINCT hr.staffid, emp_key FROM hr JOIN g ON hr.staffid = g.staffid AND emp_lastmod = a AND emp_end = b AND emp_beg = c"""))
def j15(spark, d):
    cols = ["emp_lastmod", "emp_end", "emp_beg"]
    return joins.rejoin_latest(bound(spark, d, "hr").select("staffid", "emp_key", *cols), "staffid", cols).select("staffid", "emp_key")


@query("j16_first_match", """SELECT c_custkey, coalesce(p.p_type, s.s_name) AS slug FROM customer LEFT JOIN part p ON p_partkey = c_custkey
AND p_size <= 25 LEFT JOIN supplier s ON s_suppkey = c_custkey""")
def j16(spark, d):
    first = table(spark, d, "part").where(c("p_size") <= 25).select(c("p_partkey").alias("key"), c("p_type").alias("value"))
    second = table(spark, d, "supplier").select(c("s_suppkey").alias("key"), c("s_name").alias("value"))
    cu = table(spark, d, "customer").select("c_custkey", c("c_custkey").alias("k1"), c("c_custkey").alias("k2"))
    return joins.first_match(cu, first, second, ("k1", "k2"), "slug").select("c_custkey", "slug")


# --- aggregates -----------------------------------------------------------------------


@query("g01_counts", "SELECT p_name, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 1")
def g01(spark, d):
    return groups.counts(table(spark, d, "part"), ["p_name"], "n", at_least=2)


@query("g02_count_on_rows", "SELECT p_partkey, p_name, n FROM part JOIN (SELECT p_name, count(*) AS n FROM part GROUP BY 1) USING (p_name)")
def g02(spark, d):
    return groups.with_count(table(spark, d, "part").select("p_partkey", "p_name"), ["p_name"])


@query("g03_distinct_counts", with_bound("authors", sql="""SELECT name, count(DISTINCT orcid) AS without_na,
count(DISTINCT orcid) + CAST(max(CASE WHEN orcid IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS with_na FROM authors GROUP BY name"""))
def g03(spark, d):
    return bound(spark, d, "authors").groupBy("name").agg(
        nulls.n_distinct(c("orcid"), na_rm=True).alias("without_na"), nulls.n_distinct(c("orcid")).alias("with_na"))


@query("g04_conditional_counts", with_bound("authors", sql="""SELECT orgid, count(*) FILTER (WHERE orcid IS NULL) AS n_na, count(*) AS n FROM authors GROUP BY orgid"""))
def g04(spark, d):
    return bound(spark, d, "authors").groupBy("orgid").agg(F.count_if(c("orcid").isNull()).alias("n_na"), F.count(F.lit(1)).alias("n"))


@query("g05_extremes", """SELECT o_custkey, CAST(min(o_orderdate) AS VARCHAR) AS first_at, CAST(max(o_orderdate) AS VARCHAR) AS last_at,
round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1""")
def g05(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_at"), F.max("o_orderdate").alias("last_at"), F.round(F.avg("o_totalprice"), 4).alias("mean"))


@query("g06_collapse", """SELECT o_custkey, CAST(0 AS INT) AS piece, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities
FROM orders GROUP BY 1""")
def g06(spark, d):
    return groups.collapse(table(spark, d, "orders"), ["o_custkey"], "o_orderpriority", "priorities", ", ")


@query("g07_initials", with_bound("authors", sql="""SELECT "PID", string_agg(letter, '' ORDER BY pos, letter) AS initials FROM
(SELECT "PID", pos, substr(regexp_replace(name, '(.+?)(,.*)', '\\1'), 1, 1) AS letter FROM authors) GROUP BY 1"""))
def g07(spark, d):
    return groups.initials(bound(spark, d, "authors"))


@query("g08_first_of_group", """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1""")
def g08(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return groups.first_row(o, ["o_custkey"], [c("o_orderkey")])


@query("g09_mode", """WITH t AS (SELECT o_custkey, o_orderpriority, count(*) AS n, min(o_orderkey) AS f FROM orders GROUP BY 1, 2)
SELECT o_custkey, o_orderpriority AS mode FROM t QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, f) = 1""")
def g09(spark, d):
    return groups.most_frequent(table(spark, d, "orders"), ["o_custkey"], "o_orderpriority", "o_orderkey")


@query("g10_collapse_strings", """SELECT o_custkey, CAST(0 AS INT) AS piece, string_agg(DISTINCT o_orderpriority, '; ' ORDER BY o_orderpriority) AS o_orderpriority,
string_agg(DISTINCT o_orderstatus, '; ' ORDER BY o_orderstatus) AS o_orderstatus FROM orders GROUP BY 1""")
def g10(spark, d):
    return groups.collapse_strings(table(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus"), ["o_custkey"])


@query("g11_distinct", with_bound("authors", sql="SELECT DISTINCT name, orcid, staffid FROM authors"))
def g11(spark, d):
    return bound(spark, d, "authors").select("name", "orcid", "staffid").distinct()


@query("g12_coverage", with_bound("authors", sql="""t AS (SELECT orgid, staffid, bool_or(orcid IS NOT NULL) AS has FROM authors
WHERE staffid IS NOT NULL GROUP BY 1, 2)
SELECT orgid, count(*) AS n, count(*) FILTER (WHERE has) AS n_orcid, round(count(*) FILTER (WHERE has) / count(*), 6) AS share FROM t GROUP BY 1"""))
def g12(spark, d):
    per = bound(spark, d, "authors").where(c("staffid").isNotNull()).groupBy("orgid", "staffid").agg(F.bool_or(c("orcid").isNotNull()).alias("has"))
    out = per.groupBy("orgid").agg(F.count(F.lit(1)).alias("n"), F.count_if("has").alias("n_orcid"))
    return out.withColumn("share", F.round(F.try_divide(c("n_orcid"), c("n")), 6))


@query("g14_two_levels", with_bound("authors", sql="""t AS (SELECT DISTINCT staffid, orgid FROM authors WHERE staffid IS NOT NULL AND orgid IS NOT NULL)
SELECT n_orgs, count(*) AS n_people FROM (SELECT staffid, count(*) AS n_orgs FROM t GROUP BY 1) GROUP BY 1"""))
def g14(spark, d):
    pairs = bound(spark, d, "authors").where(c("staffid").isNotNull() & c("orgid").isNotNull()).select("staffid", "orgid").distinct()
    return groups.counts(groups.counts(pairs, ["staffid"], "n_orgs"), ["n_orgs"], "n_people")


@query("g15_presence", with_bound("pubs", sql="""SELECT count("PID") AS "PID", count("DOI") AS "DOI", count("ISI") AS "ISI", count("Year") AS "Year" FROM pubs"""))
def g15(spark, d):
    return groups.presence(bound(spark, d, "pubs").select("PID", "DOI", "ISI", "Year"))


@query("g15_separator_hits", with_bound("pubs", sql="""SELECT CAST(coalesce(sum(len("ISBN") - len(replace("ISBN", ';', ''))), 0) AS BIGINT) AS "ISBN",
CAST(coalesce(sum(len("Name") - len(replace("Name", ';', ''))), 0) AS BIGINT) AS "Name" FROM pubs"""))
def g15_sep(spark, d):
    return groups.separator_hits(bound(spark, d, "pubs").select("ISBN", "Name"), ";")


@query("g16_table_sizes", """SELECT 'orders' AS name, count(*) AS value FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'part', count(*) FROM part""")
def g16(spark, d):
    return groups.table_sizes({n: table(spark, d, n) for n in ("orders", "lineitem", "part")})


PERIOD = """SELECT CASE WHEN "PublicationType" LIKE 'Artikel%' THEN 'Article' WHEN regexp_matches("PublicationType", '[Bb]ok') THEN 'Book'
WHEN regexp_matches("PublicationType", '[Kk]onferens') THEN 'Conference' ELSE 'Other' END AS class,
CAST(CAST(date_trunc('{u}', "CreatedDate") AS DATE) AS VARCHAR) AS period, count(DISTINCT "PID") AS n FROM pubs GROUP BY 1, 2"""
for _unit in ("year", "quarter", "month", "week"):
    @query(f"g17_per_{_unit}", with_bound("pubs", sql=PERIOD.format(u=_unit)))
    def _g17(spark, d, _unit=_unit):
        p = bound(spark, d, "pubs").withColumn("class", text.publication_class(c("PublicationType")))
        return calendar.counts_by_period(p, "class", "CreatedDate", "PID", _unit)


@query("g18_last_days", with_bound("pubs", sql="""SELECT CAST("CreatedDate" AS VARCHAR) AS day, count(*) AS n FROM pubs
WHERE "CreatedDate" > DATE '2001-07-02' AND "CreatedDate" <= DATE '2001-08-01' GROUP BY 1"""))
def g18(spark, d):
    return calendar.last_days(bound(spark, d, "pubs"), "CreatedDate", AS_OF, 30)


@query("g19_text_frequency", """SELECT p_name, count(DISTINCT p_size) AS n_sizes, count(DISTINCT p_brand) AS n_brands, CAST(0 AS INT) AS piece,
string_agg(DISTINCT p_brand, ' | ' ORDER BY p_brand) AS brands FROM part GROUP BY 1""")
def g19(spark, d):
    p = table(spark, d, "part")
    n = p.groupBy("p_name").agg(F.count_distinct("p_size").alias("n_sizes"), F.count_distinct("p_brand").alias("n_brands"))
    return groups.collapse(p, ["p_name"], "p_brand", "brands", " | ").join(n, "p_name")


# --- ordered computations ---------------------------------------------------------------


@query("w01_group_values_on_rows", with_bound("authors", sql="""g AS (SELECT orcid, count(DISTINCT name) AS n1, count(DISTINCT staffid) AS n2 FROM authors WHERE orcid IS NOT NULL GROUP BY 1)
SELECT "PID", pos, orcid, n1, n2 FROM authors JOIN g USING (orcid)"""))
def w01(spark, d):
    a = bound(spark, d, "authors").where(c("orcid").isNotNull()).select("PID", "pos", "orcid", "name", "staffid")
    return groups.with_group_values(a, ["orcid"], n1=F.count_distinct("name"), n2=F.count_distinct("staffid")).drop("name", "staffid")


@query("w02_running_total", """SELECT o_orderkey, CAST(sum(o_custkey) OVER (ORDER BY o_orderkey) AS BIGINT) AS total FROM orders""")
def w02(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return ordered.running_total(o, "o_custkey", ["o_orderkey"], ordered.by_width("o_orderkey", 4096)).drop("o_custkey")


@query("w03_previous_value", """SELECT conv_id, turn, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS previous,
lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS following FROM conversations""")
def w03(spark, d):
    t = table(spark, d, "conversations").select("conv_id", "turn", "role")
    cut = ordered.by_width("turn", 4)
    t = ordered.neighbour(t, "role", ["turn"], cut, ["conv_id"], "previous")
    return ordered.neighbour(t, "role", ["turn"], cut, ["conv_id"], "following", ahead=True)


@query("w04_fill_down", """SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM events""")
def w04(spark, d):
    e = table(spark, d, "events").select("event_id", F.when(c("event_type") == "purchase", c("value")).alias("v"))
    return ordered.fill_down(e, "v", ["event_id"], ordered.by_width("event_id", 1000), name="filled").drop("v")


@query("w05_row_numbers", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders")
def w05(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return ordered.row_numbers(o, ["o_orderdate", "o_orderkey"], F.trunc("o_orderdate", "month")).drop("o_orderdate")


@query("w06_top_of_group", """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3""")
def w06(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return groups.top_rows(o, ["o_custkey"], [c("o_totalprice").desc(), c("o_orderkey")], 3)


@query("w07_first_and_last", """SELECT CASE WHEN a = 1 THEN 'first' ELSE 'last' END AS "end", o_custkey, o_orderkey FROM (
SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS a FROM orders) WHERE a = 1
UNION ALL SELECT 'last', o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS b FROM orders) WHERE b = 1""")
def w07(spark, d):
    return groups.extremes(table(spark, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], c("o_orderkey"))


@query("w08_latest_by_key", """SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def w08(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    return groups.first_row(e, ["user_id"], [c("ts").desc(), c("event_id").desc()]).drop("ts")


@query("w09_fill_gaps", """WITH t AS (SELECT event_type AS class, date_trunc('hour', ts) AS h, count(DISTINCT user_id) AS n FROM events GROUP BY 1, 2),
r AS (SELECT class, unnest(generate_series(min(h), max(h), INTERVAL 1 HOUR)) AS h FROM t GROUP BY 1)
SELECT class, CAST(h AS VARCHAR) AS period, coalesce(n, 0) AS n FROM r LEFT JOIN t USING (class, h)""")
def w09(spark, d):
    e = table(spark, d, "events")
    t = e.groupBy(c("event_type").alias("class"), F.date_trunc("hour", "ts").alias("period")).agg(F.count_distinct("user_id").alias("n"))
    return calendar.fill_gaps(t, "class", "period", "n", "1 hour")


@query("w10_chunks", """SELECT o_orderkey, CAST(ceil(row_number() OVER (ORDER BY o_orderkey) / 25) AS INT) AS part FROM orders""")
def w10(spark, d):
    o = table(spark, d, "orders").select("o_orderkey")
    return ordered.chunk_numbers(o, ["o_orderkey"], ordered.by_width("o_orderkey", 4096), 25)


@query("w10_chunks_short_first", """SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderkey) // 25 + 1 AS INT) AS part FROM orders""")
def w10_short(spark, d):
    o = table(spark, d, "orders").select("o_orderkey")
    return ordered.chunk_numbers(o, ["o_orderkey"], ordered.by_width("o_orderkey", 4096), 25, short_first=True)


# --- sorts and set operations -----------------------------------------------------------


@query("o01_report_order", with_bound("pubs", sql="""SELECT "PID", "Year" FROM pubs ORDER BY "Year" DESC NULLS LAST, "PID" NULLS LAST"""))
def o01(spark, d):
    return setops.in_report_order(bound(spark, d, "pubs").select("PID", "Year"), ["-Year", "PID"])


@query("o02_first_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def o02(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(c("o_totalprice").desc(), "o_orderkey").limit(5)


@query("o03_top_by_score", "SELECT event_id, value FROM events WHERE value > 10 ORDER BY value DESC, event_id LIMIT 20")
def o03(spark, d):
    return table(spark, d, "events").where(c("value") > 10).select("event_id", "value").orderBy(c("value").desc(), "event_id").limit(20)


@query("o04_sort_by_length", """SELECT p_partkey, array_to_string(list_sort(list_transform(string_split(concat(p_type, ' ', p_name), ' '),
lambda x: concat(lpad(CAST(length(x) AS VARCHAR), 6, '0'), x))).list_transform(lambda x: substr(x, 7)), ' ') AS words FROM part""")
def o04(spark, d):
    w = setops.by_length(F.split(F.concat_ws(" ", "p_type", "p_name"), " "))
    return table(spark, d, "part").select("p_partkey", F.array_join(w, " ").alias("words"))


@query("o05_stack", """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""")
def o05(spark, d):
    a = table(spark, d, "customer").select(c("c_custkey").alias("id"), c("c_name").alias("name"), c("c_mktsegment").alias("segment"))
    return setops.stack(a, table(spark, d, "supplier").select(c("s_suppkey").alias("id"), c("s_name").alias("name")))


CUST = "SELECT c_nationkey AS k FROM customer"
SUPP = "SELECT s_nationkey AS k FROM supplier"


def _keys(spark, d):
    return (table(spark, d, "orders").select(c("o_custkey").alias("k")),
            table(spark, d, "lineitem").select(c("l_partkey").alias("k")))


@query("o06_union_distinct", "SELECT o_custkey AS k FROM orders UNION SELECT l_partkey FROM lineitem")
def o06(spark, d):
    return setops.union_distinct(*_keys(spark, d))


@query("o07_intersect", "SELECT o_custkey AS k FROM orders INTERSECT SELECT l_partkey FROM lineitem")
def o07(spark, d):
    a, b = _keys(spark, d)
    return a.intersect(b)


@query("o08_except", "SELECT l_partkey AS k FROM lineitem EXCEPT SELECT o_custkey FROM orders")
def o08(spark, d):
    a, b = _keys(spark, d)
    return b.subtract(a)


@query("o09_compare_pairs", """WITH a AS (SELECT DISTINCT l_partkey AS k, l_suppkey AS v FROM lineitem WHERE l_returnflag = 'A'),
b AS (SELECT DISTINCT l_partkey AS k, l_suppkey AS v FROM lineitem WHERE l_returnflag = 'R'),
p AS (SELECT k, v, CAST(max(l) AS INT) AS in_left, CAST(max(r) AS INT) AS in_right FROM (SELECT k, v, 1 AS l, 0 AS r FROM a UNION ALL SELECT k, v, 0, 1 FROM b) GROUP BY 1, 2)
SELECT k, v, in_left, in_right, CASE WHEN in_left + in_right = 2 THEN 'same'
WHEN k IN (SELECT k FROM a) AND k IN (SELECT k FROM b) THEN 'differs' WHEN in_left = 1 THEN 'left' ELSE 'right' END AS status FROM p""")
def o09(spark, d):
    li = table(spark, d, "lineitem").select(c("l_partkey").alias("k"), c("l_suppkey").alias("v"), "l_returnflag")
    return setops.compare_pairs(li.where(c("l_returnflag") == "A"), li.where(c("l_returnflag") == "R"), "k", "v")
