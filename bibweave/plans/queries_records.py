"""Nested records: flattening, XML parsing and rendering, linked data."""

from __future__ import annotations

from pyspark.sql import functions as F

from bibweave.operators import mods, ordered, records as r
from bibweave.plans.bindings import bound, with_bound
from bibweave.plans.registry import query, table
from bibweave.session import spread
from bibweave.sources.collections import collections

c = F.col
T = lambda name, *cols: F.struct(*[F.lit(v).alias(k) if isinstance(v, str) else v.alias(k) for k, v in cols]).alias(name)

# --- tagged citation records --------------------------------------------------------

TAGS = {"UT": "accession_number", "C1": "author_address", "AF": "authors", "ID": "keywords", "TC": "times_cited_count", "PY": "year_published"}


def _tagged(spark, d):
    o = table(spark, d, "orders")
    k, cu = c("o_orderkey"), c("o_custkey")
    s = lambda x: x.cast("string")
    last = F.when(k % 2 == 0, F.lit("; ")).otherwise(F.lit(""))
    addr = F.concat(F.lit("[A"), s(cu), F.lit("; B"), s(cu), F.lit("] Inst "), s(cu % 10), F.lit(", City; [C"), s(k), F.lit("] Other "), s(k % 5), last)
    raw = o.select(
        s(k).alias("UT"), addr.alias("C1"), F.concat(F.lit("A"), s(cu), F.lit("; C"), s(k)).alias("AF"),
        F.when(k % 3 > 0, F.lower("o_orderpriority")).alias("ID"), s(k % 100).alias("TC"),
        F.when(k % 5 == 0, F.lit("n.d.")).otherwise(s(F.year("o_orderdate"))).alias("PY"), F.lit("x").alias("ZZ"))
    return r.typed_records(raw, TAGS)


@query("n12_typed_records", """SELECT CAST(o_orderkey AS VARCHAR) AS accession_number, CAST(o_orderkey % 100 AS INT) AS times_cited_count,
CASE WHEN o_orderkey % 5 > 0 THEN CAST(year(o_orderdate) AS INT) END AS year_published FROM orders""")
def n12(spark, d):
    return _tagged(spark, d).select("accession_number", "times_cited_count", "year_published")


@query("n12_value_table", """SELECT CAST(o_orderkey AS VARCHAR) AS accession_number, unnest([concat('A', o_custkey), concat('C', o_orderkey)]) AS authors FROM orders""")
def n12_values(spark, d):
    rec = _tagged(spark, d)
    return r.tagged_tables(rec, r.nested_fields(rec))["authors"]


_INST = """SELECT CAST(o_orderkey AS VARCHAR) AS accession_number, concat('Inst ', o_custkey % 10, ', City') AS inst, unnest([concat('A', o_custkey), concat('B', o_custkey)]) AS auth FROM orders
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), concat('Other ', o_orderkey % 5), concat('C', o_orderkey) FROM orders"""


@query("n12_author_institutions", _INST + " WHERE o_orderkey % 2 = 0")
def n12_inst(spark, d):
    return r.author_institutions(_tagged(spark, d))


@query("n12_author_institutions_all", _INST)
def n12_inst_all(spark, d):
    return r.author_institutions(_tagged(spark, d), keep_last=True).distinct()


# --- search entries ------------------------------------------------------------------


def _entries(spark, d):
    o = table(spark, d, "orders")
    k, cu = c("o_orderkey").cast("string"), c("o_custkey").cast("string")
    val = lambda x: T("v", ("$", x))
    afid1, afid2 = F.concat(F.lit("a"), cu), F.concat(F.lit("b"), cu)
    a1 = T("a1", ("authid", k), ("surname", F.concat(F.lit("Sur"), cu)), ("given-name", F.lit("G")), ("afid", F.array(val(afid1))))
    a2 = T("a2", ("authid", F.concat(k, F.lit("x"))), ("surname", F.concat(F.lit("Two"), cu)), ("given-name", F.lit("H")), ("afid", F.array(val(afid1), val(afid2))))
    place = lambda x: T("p", ("afid", x), ("affilname", F.concat(F.lit("Uni "), x)))
    head = [("dc:identifier", F.concat(F.lit("SCOPUS_ID:"), k)), ("eid", F.concat(F.lit("2-s2.0-"), k)), ("dc:title", F.concat(F.lit("T "), k)),
            ("prism:isbn", F.array(val(F.concat(F.lit("978"), k)), val(F.concat(F.lit("979"), k)))),
            ("affiliation", F.array(place(afid1), place(afid2)))]
    several = F.to_json(F.struct(*[v.alias(n) for n, v in head], F.array(a1, a2).alias("author")))
    none = F.to_json(F.struct(*[v.alias(n) for n, v in head]))
    one = F.replace(F.to_json(F.struct(*[v.alias(n) for n, v in head], a1.alias("author"))), F.lit('"afid":[{"$":"'), F.lit('"afid":[{"$":"'))
    m = c("o_orderkey") % 3
    return o.select(F.when(m == 0, none).when(m == 1, one).otherwise(several).alias("json"))


@query("n13_publications", """SELECT concat('SCOPUS_ID:', o_orderkey) AS dc_identifier, concat('2-s2.0-', o_orderkey) AS eid, concat('T ', o_orderkey) AS dc_title,
concat('978', o_orderkey, ' 979', o_orderkey) AS prism_isbn, CAST(NULL AS VARCHAR) AS prism_doi FROM orders""")
def n13(spark, d):
    return r.search_entries(_entries(spark, d))["publications"].select("dc_identifier", "eid", "dc_title", "prism_isbn", "prism_doi")


@query("n13_authors", """SELECT concat('SCOPUS_ID:', o_orderkey) AS sid, CAST(o_orderkey AS VARCHAR) AS authid, concat('Sur', o_custkey) AS surname, 'G' AS given_name, concat('a', o_custkey) AS afid FROM orders WHERE o_orderkey % 3 > 0
UNION ALL SELECT concat('SCOPUS_ID:', o_orderkey), concat(o_orderkey, 'x'), concat('Two', o_custkey), 'H', unnest([concat('a', o_custkey), concat('b', o_custkey)]) FROM orders WHERE o_orderkey % 3 = 2""")
def n13_authors(spark, d):
    return r.search_entries(_entries(spark, d))["authors"].select("sid", "authid", "surname", "given_name", "afid")


@query("n13_affiliations", """SELECT concat('SCOPUS_ID:', o_orderkey) AS sid, unnest([concat('a', o_custkey), concat('b', o_custkey)]) AS afid, unnest([concat('Uni a', o_custkey), concat('Uni b', o_custkey)]) AS affilname FROM orders""")
def n13_affiliations(spark, d):
    return r.search_entries(_entries(spark, d))["affiliations"].select("sid", "afid", "affilname")


# --- extended abstracts -----------------------------------------------------------------


def _abstracts(spark, d):
    o = table(spark, d, "orders")
    k, cu = c("o_orderkey").cast("string"), c("o_custkey").cast("string")
    person = lambda seq, x: T("a", ("@seq", seq), ("@auid", x), ("ce:surname", x), ("preferred-name", T("p", ("ce:surname", F.concat(F.lit("S"), x)), ("ce:given-name", "G"))))
    org = F.array(T("v", ("$", F.concat(F.lit("Dept "), cu))), T("v", ("$", "Uni https://ror.org/000abc123")))
    g1 = T("g", ("author", F.array(person("1", cu), person("2", k))), ("affiliation", T("p", ("@afid", cu), ("@country", "swe"), ("organization", org), ("address-part", "Street 1"))))
    text = F.concat(F.lit("organization=Org "), k, F.lit("addressline=Acity=Bpostcode=1country=C"))
    g2 = T("g", ("author", person("3", F.concat(k, F.lit("z")))), ("affiliation", T("p", ("@afid", k), ("ce:source-text", text), ("$", "x"))))
    core = T("coredata", ("dc:publisher", F.concat(F.lit("Pub "), cu)), ("subtype", F.when(c("o_orderkey") % 4 == 0, "cp").otherwise("ar")),
             ("dc:description", F.concat(F.lit("a < b & "), k)), ("prism:startingPage", "1"), ("prism:endingPage", k), ("prism:coverDate", "2020-01-01"))
    day = lambda n: T(n, ("@year", F.date_format("o_orderdate", "yyyy")), ("@month", F.date_format("o_orderdate", "MM")), ("@day", F.date_format("o_orderdate", "dd")))
    event = T("confevent", ("confname", F.concat(F.lit("Conf "), cu)), ("conflocation", T("l", ("city", "X"), ("@country", "swe"))), ("confdate", F.struct(day("enddate"))))
    source = T("source", ("issuetitle", F.concat(F.lit("Proc "), cu)), ("additional-srcinfo", F.struct(F.struct(event).alias("conferenceinfo"))))
    letter = T("correspondence", ("person", T("p", ("ce:surname", cu), ("ce:given-name", "G"))))
    kw = T("citation-info", ("author-keywords", F.struct(F.array(T("v", ("$", "k1")), T("v", ("$", k))).alias("author-keyword"))))
    doc = lambda grp: F.to_json(F.struct(F.struct(core, F.struct(F.struct(F.struct(grp.alias("author-group"), source, letter, kw).alias("head")).alias("bibrecord")).alias("item"),
                                                  F.struct(F.lit("swe").alias("@xml:lang")).alias("language")).alias("abstracts-retrieval-response")))
    single = c("o_orderkey") % 2 == 1
    two = doc(F.array(F.struct(F.to_json(g1["author"]).alias("author"), F.to_json(g1["affiliation"]).alias("affiliation")),
                      F.struct(F.to_json(g2["author"]).alias("author"), F.to_json(g2["affiliation"]).alias("affiliation"))))
    # the two groups have different shapes, so their texts are put in as they are
    raw = lambda x: F.to_json(x)
    both = F.concat(F.lit("["), raw(g1), F.lit(","), raw(g2), F.lit("]"))
    filled = F.replace(doc(F.lit("@@")), F.lit('"@@"'), F.when(single, raw(g1)).otherwise(both))
    return o.select(k.alias("sid"), filled.alias("json"))


@query("n14_author_groups", """SELECT CAST(o_orderkey AS VARCHAR) AS sid, CAST(unnest([1, 2]) AS INT) AS seq, unnest([CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR)]) AS auid,
unnest([concat('S', o_custkey), concat('S', o_orderkey)]) AS surname, CAST(o_custkey AS VARCHAR) AS afid, concat('Dept ', o_custkey, ', Uni, Street 1') AS raw_org FROM orders
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), CAST(3 AS INT), concat(o_orderkey, 'z'), concat('S', o_orderkey, 'z'), CAST(o_orderkey AS VARCHAR), concat('Org ', o_orderkey, 'AB1C') FROM orders WHERE o_orderkey % 2 = 0""")
def n14(spark, d):
    return r.extended_abstracts(_abstracts(spark, d))["authorgroup"].select("sid", "seq", "auid", "surname", "afid", "raw_org")


@query("n14_abstracts", """SELECT CAST(o_orderkey AS VARCHAR) AS sid, concat('Pub ', o_custkey) AS dc_publisher, concat('a &amp;lt; b &amp; ', o_orderkey) AS dc_description, 'swe' AS lang,
concat('k1, ', o_orderkey) AS keywords FROM orders""")
def n14_abstracts(spark, d):
    return r.extended_abstracts(_abstracts(spark, d))["abstract"].select("sid", "dc_publisher", "dc_description", "lang", "keywords")


@query("n14_conferences", """SELECT CAST(o_orderkey AS VARCHAR) AS sid, concat('Proc ', o_custkey) AS conf_title, concat('Conf ', o_custkey, ', X, swe, ', strftime(o_orderdate, '%b %-d %Y')) AS conf_details,
'1' AS conf_ext_start, CAST(o_orderkey AS VARCHAR) AS conf_ext_end FROM orders WHERE o_orderkey % 4 = 0""")
def n14_conferences(spark, d):
    return r.extended_abstracts(_abstracts(spark, d))["confinfo"]


@query("n14_correspondence", """SELECT CAST(o_orderkey AS VARCHAR) AS sid, CAST(o_custkey AS VARCHAR) AS ce_surname, 'G' AS ce_given_name, CAST(NULL AS VARCHAR) AS ce_initials FROM orders""")
def n14_correspondence(spark, d):
    return r.extended_abstracts(_abstracts(spark, d))["correspondence"]


# --- trees --------------------------------------------------------------------------------


@query("n15_deep_leaves", """SELECT s_suppkey, concat(repeat('/k/000000', 6), '/k') AS path, s_name AS value FROM supplier""")
def n15_deep(spark, d):
    """A value below thirteen levels of objects and arrays."""
    t = table(spark, d, "supplier")
    deep = F.concat(F.lit('{"k":['  * 6 + '{"k":'), F.to_json(F.struct(c("s_name").alias("v"))).substr(F.lit(6), F.length(F.to_json(F.struct(c("s_name").alias("v")))) - 6), F.lit("}" + "]}" * 6))
    return r.find_in_tree(r.tree_leaves(t.select("s_suppkey", deep.alias("json")), "s_suppkey", "json"), "s_suppkey", "k")


@query("n22_long_chain", """SELECT a.s_suppkey AS orgid, b.s_suppkey AS ancestor, CAST(a.s_suppkey - b.s_suppkey AS INT) AS distance
FROM supplier a JOIN supplier b ON b.s_suppkey < a.s_suppkey AND b.s_suppkey // 12 = a.s_suppkey // 12""")
def n22_long(spark, d):
    """Chains of twelve units, each below the one before."""
    k = c("s_suppkey")
    return r.ancestors(table(spark, d, "supplier").select(k.alias("orgid"), F.when(k % 12 > 0, k - 1).alias("p_orgid")))


@query("n15_find_in_tree", """SELECT event_id, '/k' AS path, CAST(json_extract(props, '$.k') AS VARCHAR) AS value FROM events""")
def n15(spark, d):
    leaves = r.tree_leaves(table(spark, d, "events").select("event_id", "props"), "event_id", "props")
    return r.find_in_tree(leaves, "event_id", "k")


def _portal_trees(spark, d):
    s = table(spark, d, "supplier")
    k = c("s_suppkey").cast("string")
    leaf = lambda n, v: F.to_json(F.struct(F.lit(n).alias("name"), v.alias("value")))
    node = lambda n, *kids: F.concat(F.lit('{"name":"%s","children":[' % n), F.concat_ws(",", *kids), F.lit("]}"))
    closed = F.when(c("s_acctbal") < 3000, leaf("closedDate", F.lit("2012-12-31")))
    doc = F.concat(F.lit('{"data":'), node(
        "organisation", leaf("id", k), node("organisationName", leaf("name", F.concat(F.lit("Zenhet "), k)), leaf("language", F.lit("swe"))),
        node("organisationAlternativeName", leaf("name", F.concat(F.lit("Unit "), k)), leaf("language", F.lit("eng"))),
        leaf("organisationType", F.lit("unit")), closed, node("parent", leaf("linkedRecordId", F.concat(F.lit("org:"), (c("s_suppkey") % 10).cast("string")))),
        leaf("tsCreated", F.lit("2020-01-02T03:04:05.123456Z"))), F.lit("}"))
    return s.select("s_suppkey", doc.alias("json"))


@query("n16_portal_organisations", """SELECT CAST(s_suppkey AS INT) AS orgid, 'unit' AS org_type, CAST(s_suppkey % 10 AS INT) AS p_orgid, CAST(NULL AS VARCHAR) AS org_code, CAST(s_suppkey % 10 AS VARCHAR) AS l_orgid,
concat('Zenhet ', s_suppkey) AS unit_sv, concat('Unit ', s_suppkey) AS unit_en, CASE WHEN s_acctbal < 3000 THEN '2012-12-31' END AS closed_date FROM supplier""")
def n16(spark, d):
    leaves = r.tree_leaves(_portal_trees(spark, d), "s_suppkey", "json")
    return r.portal_organisations(r.labelled_values(leaves, "s_suppkey")).drop("ts_created", "ts_updated")


@query("n16_portal_persons", """SELECT CAST(c_custkey AS VARCHAR) AS author_id, c_acctbal > 0 AS public, concat('F', c_custkey, ', ', g) AS name_variation, CASE WHEN c_custkey % 2 = 0 THEN concat('0000-', c_custkey) END AS orcid
FROM (SELECT *, unnest([c_mktsegment, 'Zed']) AS g FROM customer)""")
def n16_persons(spark, d):
    cu = table(spark, d, "customer")
    k = c("c_custkey").cast("string")
    row = lambda n, v, at: F.struct(F.lit(at).alias("node"), F.lit(n).alias("nme"), v.alias("val"))
    vals = F.array_compact(F.array(
        row("givenName", c("c_mktsegment"), "1"), row("givenName", F.lit("Zed"), "2"), row("familyName", F.concat(F.lit("F"), k), "3"),
        row("public", F.when(c("c_acctbal") > 0, "yes").otherwise("no"), "4"), F.when(c("c_custkey") % 2 == 0, row("ORCID_ID", F.concat(F.lit("0000-"), k), "5"))))
    labelled = cu.select(k.alias("id"), F.explode(vals).alias("x")).select("id", "x.*")
    return r.portal_persons(labelled).select("author_id", "public", "name_variation", "orcid")


# --- XML records ------------------------------------------------------------------------------


def _mods_texts(spark, d):
    """One full record per order. The keys are small and the texts long, so the
    keys are spread before the texts are made."""
    o = spread(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")
    k, cu = c("o_orderkey").cast("string"), c("o_custkey").cast("string")
    e = lambda text: F.lit(text)
    odd = c("o_orderkey") % 2 == 1
    more = lambda text: F.when(c("o_orderkey") % 3 == 0, text).otherwise("")
    doc = F.concat(
        e(mods.HEAD), e('<genre authority="reg" type="publicationTypeCode">article</genre><genre authority="svep">art</genre>'),
        e('<name type="personal" authority="x" xlink:href="u1'), cu, e('"><namePart type="family">Fam'), cu, e('</namePart><namePart type="given">G</namePart><role><roleTerm type="code" authority="marcrelator">aut</roleTerm></role>'),
        more('<role><roleTerm type="code" authority="marcrelator">edt</roleTerm></role>'), e('<affiliation>Aff A'), cu, e('</affiliation><affiliation>Aff B</affiliation>'), F.when(odd, F.concat(e("<description>orcid.org="), k, e("</description>"))).otherwise(e("")), e("</name>"),
        e('<name type="corporate" xlink:href="'), cu, e('"><namePart>Org '), cu, e('</namePart><role><roleTerm type="code" authority="marcrelator">pbl</roleTerm></role><description>Group</description></name>'),
        e('<titleInfo lang="eng"><title>Title '), k, e('</title><subTitle>Sub</subTitle></titleInfo><titleInfo type="alternative" lang="swe"><title>Alt</title></titleInfo>'),
        e('<language objectPart="defence"><languageTerm type="code" authority="iso639-2b">eng</languageTerm></language>'),
        e("<originInfo><publisher>P"), cu, e('</publisher><dateIssued>2001</dateIssued><dateOther type="availableFrom">2002</dateOther></originInfo>'),
        more("<originInfo><publisher>Q</publisher><dateIssued>2003</dateIssued></originInfo>"),
        e('<physicalDescription><form authority="marcform">print</form><extent>12</extent></physicalDescription>'),
        e('<identifier type="doi">10.1/'), k, e('</identifier><identifier type="isbn" displayLabel="Print" invalid="yes">978'), k, e("</identifier>"),
        F.when(odd, e("<typeOfResource>text</typeOfResource>")).otherwise(e("<typeOfResource>moving image</typeOfResource>")),
        more("<typeOfResource>cartographic</typeOfResource>"),
        e('<relatedItem type="host"><titleInfo><title>J'), cu, e('</title></titleInfo><identifier type="issn">0378-5955</identifier><identifier type="eissn">1234-5679</identifier><part><detail type="volume"><number>'),
        k, e('</number></detail><detail type="issue"><number>2</number></detail><extent><start>1</start><end>9</end></extent></part></relatedItem>'),
        e('<subject lang="eng"><topic>t1</topic><topic>t2</topic></subject><subject lang="eng" authority="uka.se" xlink:href="'), cu, e('"><topic>Area</topic></subject>'),
        e('<abstract lang="eng">About '), k, e('</abstract><note>Free</note><note type="publicationStatus" lang="eng">Accepted</note>'),
        e('<location><url displayLabel="fulltext">http://x/'), k, e("</url></location>"),
        e("<recordInfo><recordOrigin>u1x</recordOrigin><recordContentSource>src</recordContentSource><recordCreationDate>2001-01-01</recordCreationDate><recordChangeDate>2002-01-01</recordChangeDate><recordIdentifier>rec:"),
        k, e("</recordIdentifier></recordInfo></mods>"))
    return o.select("o_orderkey", doc.alias("mods"))


_PID = "CAST(o_orderkey AS BIGINT) AS pid"
_EXPLODE = {
    "genre": f"""SELECT {_PID}, 'article' AS "desc", 'reg' AS aut, 'publicationTypeCode' AS type, CAST(NULL AS VARCHAR) AS lang FROM orders UNION ALL SELECT o_orderkey, 'art', 'svep', NULL, NULL FROM orders""",
    "orgs": f"""SELECT {_PID}, CAST(2 AS INT) AS id, CAST(NULL AS VARCHAR) AS aut, CAST(o_custkey AS VARCHAR) AS href, 'pbl' AS role, concat('Org ', o_custkey) AS org, CAST(NULL AS VARCHAR) AS aff, 'Group' AS "desc" FROM orders""",
    "authors": f"""SELECT {_PID}, CAST(1 AS INT) AS id, 'x' AS aut, concat('u1', o_custkey) AS href, role, concat('Fam', o_custkey) AS family, 'G' AS given, unnest([concat('Aff A', o_custkey), 'Aff B']) AS affiliation,
      CASE WHEN o_orderkey % 2 = 1 THEN concat('orcid.org=', o_orderkey) END AS description FROM (SELECT *, unnest(CASE WHEN o_orderkey % 3 = 0 THEN ['aut', 'edt'] ELSE ['aut'] END) AS role FROM orders)""",
    "titleInfo": f"""SELECT {_PID}, concat('Title ', o_orderkey) AS title, 'Sub' AS subtitle, 'eng' AS lang, CAST(NULL AS VARCHAR) AS type FROM orders UNION ALL SELECT o_orderkey, 'Alt', NULL, 'swe', 'alternative' FROM orders""",
    "language": f"""SELECT {_PID}, 'eng' AS language_term, 'code' AS language_type, 'iso639-2b' AS language_authority, 'defence' AS object_part FROM orders""",
    "originInfo": f"""SELECT {_PID}, concat('P', o_custkey) AS publisher, '2001' AS date_issued, '2002' AS date_other, 'availableFrom' AS date_other_type FROM orders UNION ALL SELECT o_orderkey, 'Q', '2003', NULL, NULL FROM orders WHERE o_orderkey % 3 = 0""",
    "physicalDescription": f"""SELECT {_PID}, 'print' AS form, 'marcform' AS form_authority, '12' AS extent FROM orders""",
    "identifier": f"""SELECT {_PID}, 'doi' AS id_name, concat('10.1/', o_orderkey) AS id_value, CAST(NULL AS VARCHAR) AS id_label FROM orders UNION ALL SELECT o_orderkey, 'isbn', concat('978', o_orderkey), 'Print' FROM orders""",
    "typeOfResource": f"""SELECT {_PID}, CASE WHEN o_orderkey % 2 = 1 THEN 'text' ELSE 'moving image' END AS resource_type FROM orders UNION ALL SELECT o_orderkey, 'cartographic' FROM orders WHERE o_orderkey % 3 = 0""",
    "relatedItem": f"""SELECT {_PID}, 'host' AS relateditem_type, concat('J', o_custkey) AS title, CAST(o_orderkey AS VARCHAR) AS volume, '2' AS issue, '1' AS part_extent_start, '9' AS part_extent_end,
      unnest(['issn', 'eissn']) AS identifier_type, unnest(['0378-5955', '1234-5679']) AS identifier FROM orders""",
    "subjects": f"""SELECT {_PID}, 'eng' AS lang, CAST(NULL AS VARCHAR) AS authority, CAST(NULL AS VARCHAR) AS href, unnest(['t1', 't2']) AS topic FROM orders UNION ALL SELECT o_orderkey, 'eng', 'uka.se', CAST(o_custkey AS VARCHAR), 'Area' FROM orders""",
    "abstract": f"""SELECT {_PID}, concat('About ', o_orderkey) AS abstract, 'eng' AS lang FROM orders""",
    "note": f"""SELECT {_PID}, 'Free' AS note, CAST(NULL AS VARCHAR) AS note_type, CAST(NULL AS VARCHAR) AS note_lang FROM orders UNION ALL SELECT o_orderkey, 'Accepted', 'publicationStatus', 'eng' FROM orders""",
    "location": f"""SELECT {_PID}, concat('http://x/', o_orderkey) AS url, 'fulltext' AS url_display FROM orders""",
    "recordInfo": f"""SELECT {_PID}, 'u1x' AS record_origin, 'src' AS record_source, '2001-01-01' AS record_created, '2002-01-01' AS record_changed, concat('rec:', o_orderkey) AS record_id FROM orders""",
}
for _t, _sql in _EXPLODE.items():
    @query(f"n17_{_t.lower()}", f"SELECT * REPLACE (CAST(pid AS BIGINT) AS pid) FROM ({_sql})")
    def _n17(spark, d, _t=_t):
        return mods.tables(mods.parse(_mods_texts(spark, d), fields=[mods.TABLE_FIELDS[_t]]))[_t]


@query("n18_linked_data", """SELECT CAST(o_orderkey AS BIGINT) AS pid, CASE WHEN o_orderkey % 2 = 1 THEN 'Text' ELSE 'MovingImage' END AS work_type, concat('Title ', o_orderkey) AS title, 'VariantTitle' AS second_title,
concat('About ', o_orderkey) AS summary, concat('Fam', o_custkey) AS family, concat('Org ', o_custkey) AS org, 't1 t2' AS topic, CAST(o_custkey AS VARCHAR) AS class_code,
'https://id.kb.se/term/swepub/Accepted' AS status, concat('10.1/', o_orderkey) AS doi, concat('978', o_orderkey) AS invalid_isbn, concat('J', o_custkey) AS host FROM orders""")
def n18(spark, d):
    docs = mods.linked_data(mods.parse(_mods_texts(spark, d)))
    work = ("struct<`@type`:string,hasTitle:array<struct<`@type`:string,mainTitle:string>>,summary:array<struct<label:string>>,"
            "contribution:array<struct<agent:struct<familyName:string,name:string>>>,subject:array<struct<prefLabel:string>>,"
            "classification:array<struct<code:string>>,hasNote:array<struct<`@id`:string>>>")
    ids = "array<struct<value:string>>"
    # every document is read once; the explode keeps the optimizer from a reading per column
    read = F.from_json("json", f"instanceOf {work}, identifiedBy {ids}, incorrectlyIdentifiedBy {ids}, isPartOf array<struct<mainTitle:string>>")
    at = lambda field, i: F.get(c(f"j.{field}"), i)
    w = "instanceOf"
    return docs.select("pid", F.explode(F.array(read)).alias("j")).select(
        "pid", c(f"j.{w}.`@type`").alias("work_type"), at(f"{w}.hasTitle", 0)["mainTitle"].alias("title"), at(f"{w}.hasTitle", 1)["@type"].alias("second_title"),
        at(f"{w}.summary", 0)["label"].alias("summary"), at(f"{w}.contribution", 0)["agent"]["familyName"].alias("family"), at(f"{w}.contribution", 1)["agent"]["name"].alias("org"),
        at(f"{w}.subject", 0)["prefLabel"].alias("topic"), at(f"{w}.classification", 0)["code"].alias("class_code"), at(f"{w}.hasNote", 0)["@id"].alias("status"),
        at("identifiedBy", 0)["value"].alias("doi"), at("incorrectlyIdentifiedBy", 0)["value"].alias("invalid_isbn"), at("isPartOf", 0)["mainTitle"].alias("host"))


# --- rendering -----------------------------------------------------------------------------------

OWN = "own university"


def _rendered(spark, d):
    o = spread(table(spark, d, "orders"), "o_orderkey")
    k, cu = c("o_orderkey").cast("string"), c("o_custkey").cast("string")
    genre = F.when(c("o_orderstatus") == "F", "article").when(c("o_orderstatus") == "P", "conferencePaperPublished").otherwise("chapter")
    recs = o.select(
        c("o_orderkey").alias("sid"), genre.alias("genre"), F.concat(F.lit("T <"), k, F.lit("> & more")).alias("title"), F.concat(F.lit("10.1/<"), k, F.lit(">")).alias("doi"),
        F.concat(F.lit("2-s2.0-"), k).alias("eid"), F.lit("978 979").alias("isbn"), F.concat(F.lit("P & "), cu).alias("publisher"), F.year("o_orderdate").alias("year_issued"),
        F.concat(F.lit("9-"), k).alias("page_range"), F.lit("a | b").alias("keywords"), F.concat(F.lit("x ]]> < "), k).alias("abstract"),
        F.when(c("o_orderkey") % 2 == 0, F.concat(F.lit("Conf "), k)).alias("conf_details"), F.concat(F.lit("rec:"), k).alias("record_id"), F.concat(F.lit("J "), cu).alias("publication_name"))
    li = table(spark, d, "lineitem").select(c("l_orderkey").alias("sid"), c("l_linenumber").alias("seq"), "l_suppkey").groupBy("sid", "seq").agg(F.min("l_suppkey").alias("s"))
    s = c("s").cast("string")
    authors = li.select(
        "sid", "seq", F.concat(F.lit("Sur & "), s).alias("surname"), F.lit("G").alias("given_name"), F.when(c("s") % 4 == 0, F.concat(F.lit("Own University, D"), s)).otherwise(F.lit("Ext; X")).alias("raw_org"),
        F.when(c("s") % 4 == 0, F.concat(F.lit("u1"), s)).alias("staffid"), F.when(c("s") % 5 == 0, F.concat(F.lit("0000-"), s)).alias("orcid"))
    return recs, mods.render(recs, authors, OWN, "src", many_authors=4)


_LI = """li AS (SELECT l_orderkey AS sid, l_linenumber AS seq, min(l_suppkey) AS s FROM lineitem GROUP BY 1, 2),
n AS (SELECT sid, count(*) AS n, min(seq) AS lo, max(seq) AS hi FROM li GROUP BY 1),
sp AS (SELECT li.*, n, 0 AS r FROM li JOIN n USING (sid) WHERE n >= 4 AND seq = lo UNION ALL SELECT li.*, n, 1 FROM li JOIN n USING (sid) WHERE n < 4 OR s % 4 = 0
  UNION ALL SELECT li.*, n, 2 FROM li JOIN n USING (sid) WHERE n >= 4 AND seq = hi UNION ALL SELECT li.*, n, 3 FROM li JOIN n USING (sid) WHERE n >= 4 AND seq = hi)"""


@query("x11_rendered_authors", f"""WITH {_LI} SELECT CAST(sid AS BIGINT) AS pid, CAST(row_number() OVER (PARTITION BY sid ORDER BY r, seq) AS INT) AS id,
CASE WHEN r = 3 THEN 'et al.' WHEN s % 4 = 0 THEN concat('$$$Sur & ', s) ELSE concat('Sur & ', s) END AS family,
CASE WHEN r <> 3 THEN CASE WHEN s % 4 = 0 THEN concat('Own University, D', s) ELSE 'Ext; X' END END AS affiliation,
CASE WHEN r <> 3 AND s % 5 = 0 THEN concat('orcid.org=0000-', s) END AS description FROM sp JOIN orders ON o_orderkey = sid""")
def x11(spark, d):
    parsed = mods.parse(_rendered(spark, d)[1], fields=["name"])
    out = mods.tables(parsed)["authors"]
    return out.select("pid", "id", "family", F.nullif("affiliation", F.lit("")).alias("affiliation"), "description")


@query("x11_rendered_records", f"""WITH {_LI} SELECT o_orderkey AS sid, concat('T &lt;', o_orderkey, '&gt; & more') AS title, concat('10.1/<', o_orderkey, '>') AS doi,
CASE WHEN o_orderstatus = 'F' THEN 'article' WHEN o_orderstatus = 'P' THEN 'conferencePaper' ELSE 'chapter' END AS code,
CASE WHEN o_orderstatus <> 'F' THEN 'Part of ISBN 978 979' END AS isbn_note, CASE WHEN n >= 4 THEN CAST(n AS VARCHAR) END AS creator_count, concat('x  < ', o_orderkey) AS abstract,
CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN concat('Conf ', o_orderkey) END AS conference FROM orders LEFT JOIN n ON sid = o_orderkey""")
def x11_records(spark, d):
    rec = mods.parse(_rendered(spark, d)[1], fields=["genre", "name", "titleInfo", "identifier", "abstract", "note"])
    first = lambda field, test: F.get(F.filter(f"m.{field}", test), 0)
    conference = first("name", lambda n: n["@type"] == "conference")
    return rec.select(
        "sid", F.get("m.titleInfo", 0)["title"].alias("title"), first("identifier", lambda i: i["@type"] == "doi")["#"].alias("doi"),
        first("genre", lambda g: g["@type"] == "publicationTypeCode")["#"].alias("code"),
        first("note", lambda n: n["#"].startswith("Part of ISBN"))["#"].alias("isbn_note"),
        first("note", lambda n: n["@type"] == "creatorCount")["#"].alias("creator_count"), F.get("m.abstract", 0)["#"].alias("abstract"),
        F.get(conference["namePart"], 0)["#"].alias("conference"))


@query("x11_failures", """SELECT o_orderkey AS sid FROM orders WHERE o_orderstatus = 'P' UNION SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'""")
def x11_failures(spark, d):
    """Records never rendered, and records cut off before the end tag."""
    recs, doc = _rendered(spark, d)
    status = table(spark, d, "orders").select(c("o_orderkey").alias("sid"), "o_orderstatus")
    broken = doc.join(status, "sid").where(c("o_orderstatus") != "P")
    broken = broken.withColumn("mods", F.when(c("o_orderstatus") == "F", F.replace("mods", F.lit("</mods>"), F.lit(""))).otherwise(c("mods")))
    return mods.failures(recs, broken.select("sid", "mods"))


@query("s14_collections", """SELECT part, count(*) AS n, count(*) AS n_records FROM (SELECT CAST(ceil(row_number() OVER (ORDER BY o_orderkey) / 25) AS INT) AS part FROM orders) GROUP BY 1""")
def s14(spark, d):
    parts = collections(_rendered(spark, d)[1], "sid", ordered.by_width("sid", 4096))
    return parts.select("part", "n", F.size(F.split("value", "</mods>")).cast("bigint").alias("k")).select("part", "n", (c("k") - 1).alias("n_records"))


# --- registries, projects, hierarchies --------------------------------------------------------------


@query("n19_funders", """SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, concat('http://f/', s_suppkey) AS uri, CASE WHEN s_suppkey % 2 = 0 THEN concat('alt|', s_name, '|third|fourth') ELSE 'alt' END AS alt_names,
CASE WHEN s_suppkey % 3 = 0 THEN 'r' END AS replaced_by, CAST(NULL AS VARCHAR) AS replaces FROM supplier""")
def n19(spark, d):
    s = table(spark, d, "supplier")
    k = c("s_suppkey").cast("string")
    alt = F.when(c("s_suppkey") % 2 == 0, F.array(F.lit("alt"), c("s_name"), F.lit("third"), F.lit("fourth"))).otherwise(F.array(F.lit("alt")))
    item = T("i", ("id", k), ("name", c("s_name")), ("uri", F.concat(F.lit("http://f/"), k)), ("alt-names", alt), ("replaced-by", F.when(c("s_suppkey") % 3 == 0, F.array(F.lit("r")))))
    found = r.registry_funders(s.select(F.to_json(F.struct(F.struct(F.array(item).alias("items")).alias("message"))).alias("json")))
    return found.select("id", "name", "uri", *[F.array_join(n, "|").alias(n) for n in ("alt_names", "replaced_by", "replaces")])


@query("n19_prefixes", "SELECT concat(s_name, ' & Co') AS publisher, CAST(s_suppkey AS INT) AS cr_id, unnest([concat('10.', s_suppkey), concat('10.9', s_suppkey)]) AS doi_prefix FROM supplier")
def n19_prefixes(spark, d):
    k = c("s_suppkey").cast("string")
    item = T("i", ("name", F.concat("s_name", F.lit(" &amp; Co"))), ("memberId", c("s_suppkey")), ("prefixes", F.array(F.concat(F.lit("10."), k), F.concat(F.lit("10.9"), k))))
    return r.registry_prefixes(table(spark, d, "supplier").select(F.to_json(item).alias("json")))


@query("n19_assertions", "SELECT s_suppkey AS doi, s_name AS conference_name, CASE WHEN s_suppkey % 2 = 0 THEN 'Sweden' END AS conference_country FROM supplier")
def n19_assertions(spark, d):
    a = T("a", ("name", "conference_name"), ("value", c("s_name")))
    b = T("b", ("name", "conference_country"), ("value", "Sweden"))
    doc = F.to_json(F.struct(F.struct(F.when(c("s_suppkey") % 2 == 0, F.array(a, b)).otherwise(F.array(a)).alias("assertion")).alias("message")))
    return r.work_assertions(table(spark, d, "supplier").select(c("s_suppkey").alias("doi"), doc.alias("json")), ["conference_name", "conference_country"])


@query("n19_events", """SELECT o_orderkey AS doi, concat('Ev ', o_custkey) AS name, CAST(NULL AS VARCHAR) AS location, CAST(NULL AS VARCHAR) AS acronym, CAST(year(o_orderdate) AS INT) AS start_date_1, CAST(month(o_orderdate) AS INT) AS start_date_2,
CAST(day(o_orderdate) AS INT) AS start_date_3, CAST(year(o_orderdate) AS INT) AS end_date_1, CAST(NULL AS INT) AS end_date_2, CAST(NULL AS INT) AS end_date_3 FROM orders""")
def n19_events(spark, d):
    day = c("o_orderdate")
    start = F.struct(F.array(F.array(F.year(day), F.month(day), F.day(day))).alias("date-parts"))
    end = F.struct(F.array(F.array(F.year(day))).alias("date-parts"))
    ev = T("event", ("name", F.concat(F.lit("Ev "), c("o_custkey").cast("string"))), ("start", start), ("end", end))
    return r.work_events(table(spark, d, "orders").select(c("o_orderkey").alias("doi"), F.to_json(F.struct(F.struct(ev).alias("message"))).alias("json")))


@query("n20_project_people", """SELECT o_orderkey AS project, CAST(o_custkey AS VARCHAR) AS "personId", 'leader' AS role FROM orders UNION ALL SELECT o_orderkey, concat(o_custkey, 'b'), 'member' FROM orders WHERE o_orderstatus = 'F'""")
def n20(spark, d):
    cu = c("o_custkey").cast("string")
    a = T("a", ("personId", cu), ("role", "leader"))
    b = T("b", ("personId", F.concat(cu, F.lit("b"))), ("role", "member"))
    people = F.when(c("o_orderstatus") == "F", F.array(a, b)).otherwise(F.array(a))
    return r.project_parts(table(spark, d, "orders").select(c("o_orderkey").alias("project"), people.alias("people")), "project", "people")


@query("n22_organisation_tree", with_bound("organisations", sql="""SELECT orgid, p_orgid, CAST(CASE WHEN p_orgid IS NULL THEN 0 ELSE len(CAST(orgid AS VARCHAR)) - 1 END AS INT) AS level FROM organisations"""))
def n22(spark, d):
    """Position keys are spelled from the digits of the unit number."""
    o = bound(spark, d, "organisations")
    digits = F.array_join(F.split(c("orgid").cast("string"), ""), "_")
    tree = r.organisation_tree(o.select("orgid", digits.alias("rowkey")))
    return tree.select("orgid", "p_orgid", "level")


@query("n22_ancestors", with_bound("organisations", sql="""a AS (SELECT orgid, p_orgid AS ancestor, 1 AS distance FROM organisations WHERE p_orgid IS NOT NULL),
b AS (SELECT a.orgid, o.p_orgid AS ancestor, 2 AS distance FROM a JOIN organisations o ON o.orgid = a.ancestor WHERE o.p_orgid IS NOT NULL),
e AS (SELECT b.orgid, o.p_orgid AS ancestor, 3 AS distance FROM b JOIN organisations o ON o.orgid = b.ancestor WHERE o.p_orgid IS NOT NULL)
SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM e"""))
def n22_ancestors(spark, d):
    return r.ancestors(bound(spark, d, "organisations"))


LINES = """WITH t AS (SELECT o_orderkey AS n, o_orderkey % 5 AS m FROM orders),
g AS (SELECT n, m, n - m AS head FROM t)
SELECT n, concat('9', lpad(CAST(head % 1000 AS VARCHAR), 3, '0')) AS old_code, concat('Old ', chr(CAST(97 + head % 26 AS INT))) AS old_desc,
concat('10', lpad(CAST(n % 1000 AS VARCHAR), 3, '0')) AS scb_code, CASE WHEN m = 1 THEN 'New text rest of it' ELSE 'New text' END AS scb_desc FROM g WHERE m <> 2"""


@query("n23_recognised_lines", LINES)
def n23(spark, d):
    """Five lines per block: a full record, a record that runs on, its rest, two short records."""
    k = c("o_orderkey")
    m = k % 5
    head = F.concat(F.lit("Old "), F.char(97 + k % 26), F.lit(" 9"), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit(" "))
    code = F.concat(F.lit("10"), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit(" New text"))
    line = F.when(m == 0, F.concat(head, code)).when(m == 2, F.lit("rest of it")).otherwise(code)
    lines = table(spark, d, "orders").select(k.alias("n"), line.alias("text"))
    return r.recognised_lines(lines, "n", "text", ordered.by_width("n", 1000))
