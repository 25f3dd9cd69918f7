"""Scans, sinks and the incremental harvest over files written from the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from bibweave.operators import mods
from bibweave.operators.ordered import by_width
from bibweave.plans.bindings import bound, with_bound
from bibweave.plans.queries_records import _mods_texts
from bibweave.plans.registry import query, table
from bibweave.session import run_dir
from bibweave.sources import delimited as s, graph, nested, xml
from bibweave.sources.collections import collections, write_collections
from bibweave.streaming import harvest

c = F.col


@query("s01_publications", with_bound("pubs", sql='SELECT "PID", "Year", "Title", "DOI", CAST("CreatedDate" AS VARCHAR) AS "CreatedDate" FROM pubs'))
def s01(spark, d):
    path = s.write_table(bound(spark, d, "pubs"), run_dir(spark, "pubs"))
    return s.read_publications(spark, path).select("PID", "Year", "Title", "DOI", "CreatedDate")


def _author_export(spark, d):
    li = table(spark, d, "lineitem")
    k = c("l_suppkey").cast("string")
    return li.select(
        c("l_orderkey").alias("PID"), F.concat(F.lit("L"), k).alias("LastName"), F.when(c("l_suppkey") % 5 > 0, "F").alias("FirstName"),
        F.when(c("l_suppkey") % 2 == 0, F.concat(F.lit("u1"), k)).alias("LocalId"), F.lit(None).cast("string").alias("ORCID"),
        k.alias("OrganisationId"), c("l_linenumber").alias("Position"), F.when(c("l_suppkey") % 3 == 0, "Ext").alias("UncontrolledOrganisation"))


@query("s02_authors", """SELECT l_orderkey AS "PID", concat('L', l_suppkey, ', ', CASE WHEN l_suppkey % 5 > 0 THEN 'F' ELSE 'NA' END) AS name, CASE WHEN l_suppkey % 2 = 0 THEN concat('u1', l_suppkey) END AS staffid,
CAST(l_suppkey AS VARCHAR) AS orgid, l_linenumber AS pos, CASE WHEN l_suppkey % 3 = 0 THEN 'Ext' END AS extorg, l_suppkey % 3 = 0 AS is_extorg FROM lineitem""")
def s02(spark, d):
    path = s.write_table(_author_export(spark, d), run_dir(spark, "authors"))
    return s.read_authors(spark, path).select("PID", "name", "staffid", "orgid", "pos", "extorg", "is_extorg")


@query("s03_yearly_files", "SELECT CAST(year(o_orderdate) AS INT) AS file_year, count(*) AS n FROM orders GROUP BY 1")
def s03(spark, d):
    """One folder of files per year, read back as one table."""
    o = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"))
    folder = run_dir(spark, "years")
    o.repartition("y").write.partitionBy("y").option("header", True).csv(folder)
    rows = s.read_strings(spark, folder)
    return s.with_year_of_file(rows).groupBy("file_year").agg(F.count("o_orderkey").alias("n"))


@query("s04_newest_file", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O'")
def s04(spark, d):
    """Three dated extracts of several files each; all files of the newest one are read."""
    o = table(spark, d, "orders")
    folder = run_dir(spark, "dated")
    for status, day in [("F", dt.date(2024, 5, 1)), ("O", dt.date(2024, 5, 3)), ("P", dt.date(2024, 5, 2))]:
        o.where(c("o_orderstatus") == status).select("o_orderkey").repartition(4).write.mode("overwrite").parquet(f"{folder}/staff_{day:%Y%m%d}")
    return spark.read.parquet(*s.choose_files(s.dated_files(spark, folder, "*.parquet")))


HR_NAMES = {"STAFF_NO": "staffid", "BIRTH": "yob", "FIRST": "firstname", "LAST": "lastname", "BEG": "emp_beg", "END": "emp_end", "DEG": "emp_degree"}


def _staff_file(spark, d):
    o = table(spark, d, "orders")
    k = c("o_orderkey")
    raw = o.select(
        F.concat(F.lit("u1"), k).alias("STAFF_NO"), F.when(k % 7 == 0, "unknown").otherwise((1950 + k % 50).cast("string")).alias("BIRTH"),
        F.lit("F").alias("FIRST"), F.lit("L").alias("LAST"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("BEG"), F.lit("9999-99-99").alias("END"),
        F.concat((k % 100).cast("string"), F.lit(",5")).alias("DEG"), F.lit("x").alias("OTHER"))
    return s.write_table(raw, run_dir(spark, "staff"))


@query("s05_staff", """SELECT concat('u1', o_orderkey) AS staffid, CASE WHEN o_orderkey % 7 > 0 THEN CAST(1950 + o_orderkey % 50 AS INT) END AS yob, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS emp_beg,
CAST(NULL AS VARCHAR) AS emp_end, o_orderkey % 100 + 0.5::DOUBLE AS emp_degree FROM orders""")
def s05(spark, d):
    return s.read_staff(spark, _staff_file(spark, d), HR_NAMES)[0].select("staffid", "yob", "emp_beg", "emp_end", "emp_degree")


@query("s12_problems", """SELECT concat('u1', o_orderkey) AS key, 'emp_end' AS field, '9999-99-99' AS value FROM orders UNION ALL SELECT concat('u1', o_orderkey), 'yob', 'unknown' FROM orders WHERE o_orderkey % 7 = 0""")
def s12(spark, d):
    return s.read_staff(spark, _staff_file(spark, d), HR_NAMES)[1]


@query("s06_semicolon", "SELECT o_orderkey, round(o_totalprice, 2) AS amount FROM orders")
def s06(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.translate(F.format_number("o_totalprice", 2), ".,", ",.").alias("amount"))
    path = run_dir(spark, "semicolon")
    o.write.options(header=True, sep=";").csv(path)
    return s.read_semicolon(spark, path, ["amount"]).withColumn("o_orderkey", c("o_orderkey").cast("bigint"))


@query("s06_pipe_latin1", "SELECT CAST(n_nationkey AS VARCHAR) AS code, concat(n_name, ' åäö') AS name FROM nation")
def s06_pipe(spark, d):
    path = run_dir(spark, "pipe")
    table(spark, d, "nation").select("n_nationkey", F.concat("n_name", F.lit(" åäö"))).write.options(sep="|", encoding="ISO-8859-1").csv(path)
    return s.read_pipe(spark, path, ["code", "name"])


@query("s06_tabs", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS label FROM customer")
def s06_tabs(spark, d):
    path = run_dir(spark, "tabs")
    table(spark, d, "customer").select("c_custkey", "c_name").write.options(sep="\t", header=True).csv(path)
    return s.read_tabs(spark, path, ["id", "label"])


EVENT = "event_id bigint, who struct<id:bigint,kind:string>, value double"


@query("s07_json_lines", """SELECT event_id, user_id AS "who.id", event_type AS "who.kind", value FROM events WHERE event_type = 'purchase'""")
def s07(spark, d):
    e = table(spark, d, "events").select("event_id", F.struct(c("user_id").alias("id"), c("event_type").alias("kind")).alias("who"), "value")
    path = run_dir(spark, "lines")
    e.write.option("compression", "bzip2").json(path)
    return nested.read_json_lines(spark, path, EVENT, c("who.kind") == "purchase", flat=True)


@query("s08_exported_tables", with_bound("authors", sql="""SELECT DISTINCT staffid, orcid FROM authors WHERE staffid IS NOT NULL"""))
def s08(spark, d):
    pairs = bound(spark, d, "authors").where(c("staffid").isNotNull()).select("staffid", "orcid").distinct()
    path = run_dir(spark, "pairs")
    pairs.write.options(header=True, nullValue="NA").csv(path)
    return s.read_exported(spark, path)


@query("s09_graph_nodes", with_bound("authors", "pubs", sql="""SELECT 'rels' AS file, count(*) AS n_rows, count(DISTINCT "PID") AS n_ids FROM (SELECT DISTINCT "PID", staffid, name, orcid, orgid, extorg FROM authors)
UNION ALL SELECT 'authors', count(*), count(*) FROM (SELECT DISTINCT "PID", staffid, name, orcid, orgid, extorg FROM authors)
UNION ALL SELECT 'pubs', count(*), count(DISTINCT "PID") FROM pubs"""))
def s09(spark, d):
    """All three files read back: rows and distinct ids, by the id columns that their headers name."""
    folder = run_dir(spark, "graph")
    headers = graph.bulk_extract(bound(spark, d, "pubs"), bound(spark, d, "authors"), folder)

    def counted(name, mark):
        at = [mark in x for x in headers[name].split(",")].index(True)
        rows = spark.read.csv(f"{folder}/{name}", escape='"', multiLine=True)
        # ids with 64 hexadecimal digits meet as the 32 bytes those stand for
        digest = c(f"_c{at}").rlike("^m[0-9a-f]{64}$")
        short = F.when(digest, F.unhex(F.substring(f"_c{at}", 2, 64))).otherwise(F.encode(f"_c{at}", "UTF-8"))
        return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(digest, short).alias("n_ids")).select(F.lit(name).alias("file"), "n_rows", "n_ids")

    return counted("rels", ":START_ID").unionByName(counted("authors", ":ID")).unionByName(counted("pubs", ":ID"))


@query("s10_graph_headers", """SELECT unnest(['c_custkey:ID(C),c_name:STRING[],c_nationkey:IGNORE,c_acctbal,c_mktsegment:LABEL', 'o_orderkey:END_ID,o_custkey:START_ID,o_orderstatus,o_totalprice:IGNORE,o_orderdate,o_orderpriority:TYPE']) AS header,
unnest([(SELECT count(*) FROM customer), (SELECT count(*) FROM orders)]) AS n""")
def s10(spark, d):
    cu, o = table(spark, d, "customer"), table(spark, d, "orders")
    a = graph.node_header(cu.columns, "c_custkey", "c_mktsegment", ["c_name"], ["c_nationkey"], "C")
    b = graph.relation_header(o.columns, "o_orderpriority", "o_custkey", "o_orderkey", ["o_totalprice"])
    n = lambda t, h: t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(h).alias("header"), "n")
    return n(cu, a).unionByName(n(o, b))


@query("s11_csv_to_parquet", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM customer")
def s11(spark, d):
    folder = run_dir(spark, "projects")
    s.write_tables({"projects_case": table(spark, d, "customer").select("c_custkey", "c_name")}, folder)
    # the sink appends the extension, so the converter finds projects_case.csv
    done = s.csv_to_parquet(spark, folder, ["projects_case"], f"{folder}/parquet")
    return spark.read.parquet(done["projects_case"])


@query("s13_written_tables", "SELECT 'customer' AS name, count(*) AS value, count(*) FILTER (WHERE c_custkey % 4 = 0) AS empty FROM customer UNION ALL SELECT 'supplier', count(*), 0 FROM supplier")
def s13(spark, d):
    folder = run_dir(spark, "sinks")
    cu = table(spark, d, "customer").select(c("c_custkey").alias("k"), F.when(c("c_custkey") % 4 > 0, c("c_name")).alias("v"))
    su = table(spark, d, "supplier").select(c("s_suppkey").alias("k"), c("s_name").alias("v"))
    paths = s.write_tables({"customer": cu, "supplier": su}, folder)
    n = lambda name: s.read_strings(spark, paths[name]).agg(F.count("k").alias("value"), F.count_if(c("v").isNull()).alias("empty")).select(F.lit(name).alias("name"), "value", "empty")
    return n("customer").unionByName(n("supplier"))


@query("s14_collection_files", "SELECT o_orderkey, concat('Title ', o_orderkey) AS title FROM orders")
def s14_files(spark, d):
    """Collections of five hundred records written and scanned back, one row per record."""
    parts = collections(_mods_texts(spark, d), "o_orderkey", by_width("o_orderkey", 4096), 500)
    folder = write_collections(parts, run_dir(spark, "collections"), compression="gzip")
    rows = xml.read_collection(spark, folder, "titleInfo array<struct<title:string>>, recordInfo struct<recordIdentifier:string>")
    key = F.regexp_extract("recordInfo.recordIdentifier", r"(\d+)$", 1).cast("bigint")
    return rows.select(key.alias("o_orderkey"), F.get(c("titleInfo"), 0)["title"].alias("title"))


@query("s15_stop_list", """SELECT CAST(p_partkey AS DOUBLE) AS "PID", p_name AS "Title" FROM part""")
def s15(spark, d):
    path = s.write_table(table(spark, d, "part").select(c("p_partkey").alias("PID"), c("p_name").alias("Title")), run_dir(spark, "stop"))
    return s.read_stop_list(spark, path)


@query("s15_eid_list", "SELECT concat('2-s2.0-', o_orderkey) AS eid FROM orders")
def s15_eids(spark, d):
    path = run_dir(spark, "eids")
    table(spark, d, "orders").select(F.concat(F.lit("2-s2.0-"), c("o_orderkey").cast("string")).alias("value")).write.text(path)
    return s.read_eid_list(spark, path)


@query("s16_query_file", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM customer ORDER BY c_name LIMIT 5")
def s16(spark, d):
    path = s.write_table(table(spark, d, "customer").select("c_custkey", "c_name"), run_dir(spark, "file"))
    return s.query_file(spark, path, "SELECT * FROM {file} ORDER BY c_name LIMIT 5")


@query("s18_snapshot_age", "SELECT DISTINCT o_orderstatus AS snapshot, true AS is_stale, false AS was_stale, true AS has_stamp FROM orders")
def s18(spark, d):
    """A file per order status, judged long after and before it was written."""
    path = run_dir(spark, "snapshot")
    table(spark, d, "orders").withColumn("status", c("o_orderstatus")).repartition("status").write.partitionBy("status").parquet(path)
    at = lambda year: s.snapshot_age(spark, f"{path}/*/*.parquet", dt.datetime(year, 1, 1))
    before = at(2000).select("path", c("is_stale").alias("was_stale"))
    ages = at(2100).join(before, "path").withColumn("snapshot", F.regexp_extract("path", "status=([^/]*)/", 1))
    return ages.select("snapshot", "is_stale", "was_stale", c("timestamp").isNotNull().alias("has_stamp")).distinct()


@query("s20_cited_authors", """SELECT l_orderkey AS doc, l_suppkey AS author FROM (SELECT DISTINCT o_custkey AS isi FROM orders WHERE o_orderstatus = 'P') i
JOIN (SELECT o_orderkey AS doc, o_custkey AS ut FROM orders) d ON d.ut = i.isi JOIN lineitem ON l_orderkey = d.doc""")
def s20(spark, d):
    o = table(spark, d, "orders")
    ids = o.where(c("o_orderstatus") == "P").select(c("o_custkey").alias("ISI"))
    docs = o.select(c("o_orderkey").alias("doc"), c("o_custkey").alias("ut"))
    addr = table(spark, d, "lineitem").select(c("l_orderkey").alias("doc"), c("l_suppkey").alias("author"))
    folder = run_dir(spark, "extracts")
    path = s.dated_extract(s.cited_authors(ids, docs, addr), folder, "authors", dt.date(2024, 5, 1))
    return spark.read.parquet(path)


# --- incremental harvest -----------------------------------------------------------------------------


def _record(doc_id, stamp, status=None):
    head = F.concat(F.lit("<record><header"), F.coalesce(F.concat(F.lit(' status="'), status, F.lit('"')), F.lit("")), F.lit("/>"))
    body = F.concat(F.lit("<mods><titleInfo><title>"), stamp.cast("string"), F.lit("</title></titleInfo><recordInfo><recordIdentifier>rec:"), doc_id.cast("string"), F.lit("</recordIdentifier></recordInfo></mods></record>"))
    return F.concat(head, body)


def _harvest(spark, d):
    """Events as harvested records, an id per user, streamed week by week."""
    e = table(spark, d, "events")
    stamp = c("ts").cast("timestamp")
    status = F.when(c("event_type") == "error", F.lit("deleted"))
    doc = F.when(c("event_type") == "view", F.concat(F.lit("<record><header/><mods><x>"), c("event_id").cast("string"), F.lit("</x></mods></record>"))).otherwise(_record(c("user_id"), c("event_id"), status))
    feed = e.select(F.concat(F.lit("oai:"), c("user_id").cast("string")).alias("identifier"), stamp.alias("datestamp"), doc.alias("mods"), F.date_trunc("week", stamp).cast("date").alias("week"))
    folder, store, mark = run_dir(spark, "feed"), run_dir(spark, "store"), run_dir(spark, "mark")
    feed.repartition("week").write.partitionBy("week").parquet(folder)
    source = spark.readStream.schema("identifier string, datestamp timestamp, mods string, week date").option("maxFilesPerTrigger", 8).parquet(folder)
    harvest.run(source.drop("week"), store, mark).awaitTermination()
    return store


LATEST = "l AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1)"


@query("t01_high_water_mark", "SELECT strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') AS last_modified FROM events")
def t01(spark, d):
    return harvest.high_water_mark(table(spark, d, "events").select(c("ts").cast("timestamp").alias("datestamp")))


@query("t02_changes", """SELECT concat('oai:', o_orderkey) AS identifier, CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS v FROM orders WHERE o_orderstatus <> 'P'""")
def t02(spark, d):
    o = table(spark, d, "orders")
    ident = F.concat(F.lit("oai:"), c("o_orderkey").cast("string")).alias("identifier")
    day = lambda n: F.date_add(c("o_orderdate").cast("date"), n).cast("timestamp").alias("datestamp")
    stored = o.where(c("o_orderstatus") != "O").select(ident, day(0))
    fetched = o.select(ident, F.when(c("o_orderstatus") == "F", day(1)).otherwise(day(0)).alias("datestamp"), F.when(c("o_orderstatus") == "F", 2).otherwise(1).alias("v"))
    return harvest.changes(fetched, stored).select("identifier", "v")


@query("t03_upserted_ids", "WITH " + LATEST + " SELECT concat('oai:', user_id) AS identifier, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM l")
def t03(spark, d):
    ids = harvest.current(spark, _harvest(spark, d), "ids")
    return ids.select("identifier", F.date_format("datestamp", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("t04_refreshed_tables", "SELECT 'ids' AS name, count(DISTINCT user_id) AS value FROM events UNION ALL SELECT 'mods', count(DISTINCT user_id) FROM events UNION ALL SELECT 'extra', count(DISTINCT user_id) FROM events WHERE event_type <> 'view'")
def t04(spark, d):
    store = _harvest(spark, d)
    n = lambda t: harvest.current(spark, store, t).agg(F.count(F.lit(1)).alias("value")).select(F.lit(t).alias("name"), "value")
    return n("ids").unionByName(n("mods")).unionByName(n("extra"))


@query("t05_enriched", """WITH r AS (SELECT * FROM events WHERE event_type <> 'view' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1)
SELECT concat('oai:', user_id) AS identifier, CAST(user_id AS VARCHAR) AS "PID", false AS "PID_many", CASE WHEN event_type = 'error' THEN 'deleted' END AS status, CAST(event_id AS VARCHAR) AS title FROM r""")
def t05(spark, d):
    """The store's enrichment: of every id the newest version that has a record id."""
    rich = harvest.current(spark, _harvest(spark, d), "extra")
    return rich.select("identifier", "PID", "PID_many", "status", F.get_json_object("json", "$.titleInfo[0].title").alias("title"))


@query("s17_collection_scan", "SELECT CAST(o_orderkey AS BIGINT) AS pid, 2 AS n_titles, concat(CASE WHEN o_orderkey % 2 = 1 THEN 'text' ELSE 'moving image' END, CASE WHEN o_orderkey % 3 = 0 THEN '; cartographic' ELSE '' END) AS resource_types FROM orders")
def s17(spark, d):
    """Collection files scanned by their record element, with the whole schema."""
    parts = collections(_mods_texts(spark, d), "o_orderkey", by_width("o_orderkey", 4096), 500)
    rows = xml.read_collection(spark, write_collections(parts, run_dir(spark, "records"), compression="gzip"), mods.SCHEMA)
    pid = F.regexp_extract(F.get("recordInfo", 0)["recordIdentifier"], r"(\d+)$", 1).cast("bigint")
    return rows.select(pid.alias("pid"), F.size("titleInfo").alias("n_titles"), F.array_join("typeOfResource", "; ").alias("resource_types"))
