"""Nested records (JSON, tagged text, labelled trees) to relational tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bibweave.functions.dates import conference_details, parse_iso_stamp, safe_date
from bibweave.functions.text import clean_organisation, tidy_html, tidy_xml
from bibweave.session import cut_lineage
from bibweave.operators.groups import separator_hits
from bibweave.operators.joins import with_parent
from bibweave.operators.ordered import fill_down, neighbour
from bibweave.operators.reshape import flatten, record_columns, split_columns, tidy_names

c = F.col


def listed(json_text: Column, element: str) -> Column:
    """JSON array of ``element`` from text that may hold one bare object."""
    trimmed = F.trim(json_text)
    wrapped = F.when(trimmed.startswith("["), trimmed).otherwise(F.concat(F.lit("["), trimmed, F.lit("]")))
    return F.from_json(wrapped, f"array<{element}>")


def once(col: Column) -> Column:
    """Pass an expensive parse through a one-element explode, so the optimizer
    keeps one evaluation per row instead of one per use."""
    return F.explode(F.array(col))


# --- tagged citation records ------------------------------------------------------

NUMERIC_PARTS = ("_count", "year_published", "volume", "pubmed_id")


def typed_records(raw: DataFrame, tags: dict[str, str]) -> DataFrame:
    """Tag columns renamed to field names, count-like fields as numbers."""
    named = [c(f"`{t}`").alias(tags[t]) for t in raw.columns if t in tags]
    df = raw.select(*named)
    numeric = [n for n in df.columns if any(p in n for p in NUMERIC_PARTS)]
    return df.withColumns({n: c(n).try_cast("int") for n in numeric})


def nested_fields(records: DataFrame, sep: str = "; ", skip: tuple[str, ...] = ("author_address",)) -> list[str]:
    """Fields whose text holds the separator anywhere. Runs one aggregate."""
    hits = separator_hits(records, sep).first().asDict()
    return [n for n, k in hits.items() if k and n not in skip]


def value_table(records: DataFrame, field: str, key: str = "accession_number", sep: str = "; ") -> DataFrame:
    """(key, field) with one row per separated value."""
    return records.where(c(field).isNotNull()).select(key, F.explode(F.split(field, sep)).alias(field))


def author_institutions(
    records: DataFrame, key: str = "accession_number", address: str = "author_address", keep_last: bool = False
) -> DataFrame:
    """(key, inst, auth) from ``[A; B] Inst; [C] Inst; `` text.

    The established reading needs the separator after an institution, so a
    last address without one is lost; ``keep_last`` reads it too.
    """
    value = F.concat(c(address), F.lit("; ")) if keep_last else c(address)
    pattern = F.lit(r"(\[.*?\])?(?:\s+)(.*?; )")
    found = F.arrays_zip(
        F.regexp_extract_all(value, pattern, F.lit(1)).alias("a"), F.regexp_extract_all(value, pattern, F.lit(2)).alias("i")
    )
    rows = records.where(c(address).isNotNull()).select(key, F.explode(found).alias("x"))
    authors = F.nullif(F.regexp_replace("x.a", r"\[(.*?)\]", "$1"), F.lit(""))
    return rows.select(
        key,
        F.regexp_replace("x.i", r"(.*?);\s+", "$1").alias("inst"),
        F.explode_outer(F.split(authors, "; ")).alias("auth"),
    )


def tagged_tables(records: DataFrame, fields: list[str], key: str = "accession_number") -> dict[str, DataFrame]:
    """Main table, author addresses, and one table per multi-valued field."""
    main = records.drop(*fields, "author_address")
    tables = {"publications": main, "inst_auth": author_institutions(records, key)}
    return tables | {f: value_table(records, f, key) for f in fields}


# --- search entries ------------------------------------------------------------------

# Scalar fields of a search entry.
ENTRY_FIELDS = (
    "prism:url dc:identifier eid dc:title dc:creator prism:publicationName prism:issn prism:eIssn prism:isbn "
    "prism:volume prism:issueIdentifier prism:pageRange prism:coverDate prism:coverDisplayDate prism:doi "
    "dc:description citedby-count prism:aggregationType subtype subtypeDescription authkeywords article-number "
    "source-id fund-no openaccess openaccessFlag"
).split()
_VALUE = "struct<`$`:string>"
_ENTRY_AUTHOR = "struct<authid:string,surname:string,`given-name`:string,initials:string,orcid:string,afid:string>"
_ENTRY_PLACE = "struct<afid:string,affilname:string,`affiliation-city`:string,`affiliation-country`:string>"


def search_entries(df: DataFrame, json: str = "json") -> dict[str, DataFrame]:
    """Publications, authors and affiliations of search entries, keyed by ``sid``.

    Authors come once per affiliation id; a record without authors has rows in
    the publications table only.
    """
    schema = ", ".join(f"`{f}` string" for f in [*ENTRY_FIELDS, "author", "affiliation"])
    entry = df.select(once(F.from_json(json, schema)).alias("e")).select("e.*").withColumn("sid", c("`dc:identifier`"))
    isbn = F.array_join(F.transform(listed(c("`prism:isbn`"), _VALUE), lambda x: x["$"]), " ")
    scalars = [c(f"`{f}`") if f != "prism:isbn" else isbn.alias(f) for f in ENTRY_FIELDS]
    people = entry.select("sid", F.explode(listed(c("author"), _ENTRY_AUTHOR)).alias("a"))
    places = F.explode(listed(c("a.afid"), _VALUE))
    authors = people.select("sid", "a.authid", "a.surname", "a.given-name", "a.initials", "a.orcid", places.alias("p"))
    return {
        "publications": tidy_names(entry.select(*scalars)),
        "authors": tidy_names(
            authors.select("sid", "authid", "surname", "`given-name`", "initials", "orcid", c("p.`$`").alias("afid"))
        ).where(c("afid") != "true"),
        "affiliations": tidy_names(
            entry.select("sid", F.explode(listed(c("affiliation"), _ENTRY_PLACE)).alias("p")).select("sid", "p.*")
        ),
    }


# --- extended abstracts -----------------------------------------------------------------

_GROUP = "struct<author:string,affiliation:string>"
_GROUP_AUTHOR = (
    "struct<`@seq`:string,`@auid`:string,`@orcid`:string,`ce:surname`:string,`ce:given-name`:string,"
    "`preferred-name`:struct<`ce:surname`:string,`ce:given-name`:string>>"
)
_PLACE = (
    "struct<`@afid`:string,`@country`:string,organization:string,`ce:source-text`:string,`ce:text`:string,"
    "`$`:string,`address-part`:string>"
)
_DAY = "struct<`@year`:string,`@month`:string,`@day`:string>"
_EVENT = (
    "struct<confname:string,conflocation:struct<city:string,`@country`:string>,"
    f"confdate:struct<startdate:{_DAY},enddate:{_DAY}>>"
)
# author groups, correspondence and keywords may be one object or an array, so
# they are kept as text at first
_ABSTRACT = (
    "`abstracts-retrieval-response` struct<item:struct<bibrecord:struct<head:struct<`author-group`:string,"
    f"correspondence:string,`citation-info`:struct<`author-keywords`:struct<`author-keyword`:string>>,"
    f"source:struct<issuetitle:string,`additional-srcinfo`:struct<conferenceinfo:struct<confevent:{_EVENT}>>>>>>,"
    "coredata:struct<`dc:publisher`:string,`prism:coverDate`:string,subtype:string,`prism:startingPage`:string,"
    "`prism:endingPage`:string,`dc:description`:string>,language:struct<`@xml:lang`:string>>"
)


def _texts(col: Column) -> Column:
    """Texts of a value that is a string, an object or an array of objects."""
    raw = F.trim(col)
    structured = raw.startswith("{") | raw.startswith("[")
    return F.when(raw.isNull(), F.array().cast("array<string>")).when(
        structured, F.filter(F.transform(listed(col, _VALUE), lambda x: x["$"]), lambda x: x.isNotNull())
    ).otherwise(F.array(raw))


def raw_organisation(place: Column) -> Column:
    """Best available organisation text of an affiliation."""
    joined = lambda x: F.nullif(F.array_join(_texts(x), ", "), F.lit(""))
    source = F.regexp_replace(
        joined(place["ce:source-text"]),
        r"organization=(.*?)addressline=(.*?)city=(.*?)postcode=(.*?)country=(.*?)",
        "$1$2$3$4$5",
    )
    raw = place["$"]
    raw = F.when(F.coalesce(F.length(source) > F.length(raw), F.lit(False)), F.lit(None)).otherwise(raw)
    pieces = F.concat_ws(
        ", ", joined(place["organization"]), source, raw, joined(place["address-part"]), joined(place["ce:text"])
    )
    return F.nullif(clean_organisation(pieces), F.lit(""))


def extended_abstracts(df: DataFrame, json: str = "json", sid: str = "sid") -> dict[str, DataFrame]:
    """Abstract, author groups, correspondence and conference data of a record."""
    root = df.select(sid, once(F.from_json(json, _ABSTRACT)).alias("j")).select(sid, "j.abstracts-retrieval-response.*")
    head = root.select(sid, "item.bibrecord.head.*")
    groups = head.select(sid, F.posexplode(listed(c("`author-group`"), _GROUP)).alias("id", "g"))
    people = groups.select(sid, "id", F.explode(listed(c("g.author"), _GROUP_AUTHOR)).alias("a"))
    authors = people.select(
        sid, "id", c("a.`@seq`").try_cast("int").alias("seq"), c("a.`@auid`").alias("auid"),
        c("a.`@orcid`").alias("orcid"), c("a.`preferred-name`.`ce:surname`").alias("surname"),
        c("a.`preferred-name`.`ce:given-name`").alias("given_name"),
    )
    places = groups.select(sid, "id", F.explode(listed(c("g.affiliation"), _PLACE)).alias("p")).select(
        sid, "id", c("p.`@afid`").alias("afid"), c("p.`@country`").alias("country3"),
        raw_organisation(c("p")).alias("raw_org"),
    )
    keyword = listed(c("item.bibrecord.head.`citation-info`.`author-keywords`.`author-keyword`"), _VALUE)
    core = lambda n: c(f"coredata.`{n}`")
    abstract = root.select(
        sid, core("dc:publisher").alias("dc_publisher"), core("prism:coverDate").alias("prism_coverDate"), core("subtype"),
        core("prism:startingPage").alias("prism_startingPage"), core("prism:endingPage").alias("prism_endingPage"),
        tidy_xml(core("dc:description")).alias("dc_description"),
        F.coalesce("language.`@xml:lang`", F.lit("eng")).alias("lang"),
        F.nullif(F.array_join(F.transform(keyword, lambda x: x["$"]), ", "), F.lit("")).alias("keywords"),
    )
    person = "struct<person:struct<`ce:surname`:string,`ce:given-name`:string,`ce:initials`:string>>"
    letters = head.select(sid, F.explode(listed(c("correspondence"), person)).alias("x"))
    source = "item.bibrecord.head.source"
    event = f"{source}.`additional-srcinfo`.conferenceinfo.confevent"
    day = lambda end: safe_date(*[c(f"{event}.confdate.{end}.`@{p}`") for p in ("year", "month", "day")])
    conference = root.where(core("subtype") == "cp").select(
        sid, c(f"{source}.issuetitle").alias("conf_title"),
        conference_details(
            c(f"{event}.confname"), c(f"{event}.conflocation.city"), c(f"{event}.conflocation.`@country`"),
            day("startdate"), day("enddate"),
        ).alias("conf_details"),
        core("prism:startingPage").alias("conf_ext_start"), core("prism:endingPage").alias("conf_ext_end"),
    )
    return {
        "abstract": abstract,
        "authors": authors,
        "authorgroup": authors.join(places, [sid, "id"], "left"),
        "correspondence": tidy_names(letters.select(sid, "x.person.*")),
        "confinfo": conference,
    }


# --- trees of unknown shape ----------------------------------------------------------------

#: Levels that one written step of ``tree_leaves`` opens.
LEVELS = 8


def tree_leaves(df: DataFrame, key: str, json: str) -> DataFrame:
    """(key, path, name, value): all scalar leaves of JSON texts, however deep.

    Each level opens objects and arrays in place and lets scalars through. Some
    levels make one step over all rows; steps follow until none is left to open.
    """
    level = df.select(key, F.lit("").alias("path"), F.parse_json(json).alias("v"), F.lit("").alias("name"))
    container = F.schema_of_variant("v").rlike("^(OBJECT|ARRAY)")
    while True:
        for _ in range(LEVELS):
            level = level.sparkSession.sql(
                f"""SELECT `{key}`,
                  CASE WHEN x.value IS NULL THEN path ELSE concat(path, '/', coalesce(x.key, lpad(CAST(x.pos AS STRING), 6, '0'))) END AS path,
                  coalesce(x.value, v) AS v, coalesce(x.key, name) AS name
                FROM {{level}}, LATERAL variant_explode_outer(v) AS x""",
                level=level,
            )
        level = cut_lineage(level, "tree")
        if level.where(container & ~F.to_json("v").isin("{}", "[]")).isEmpty():
            break
    scalar = F.try_variant_get("v", "$", "string")
    return level.select(key, "path", "name", scalar.alias("value")).where(c("value").isNotNull() & ~container)


def find_in_tree(leaves: DataFrame, key: str, name: str, parent: str | None = None) -> DataFrame:
    """Values of all leaves with a name, optionally below a named parent."""
    hit = c("name") == name
    if parent:
        hit = hit & c("path").rlike(f"/{parent}(/|$)")
    return leaves.where(hit).select(key, "path", "value")


def labelled_values(leaves: DataFrame, key: str) -> DataFrame:
    """(key, id, nme, val) of a tree whose nodes have ``name`` and ``value`` leaves."""
    node = F.regexp_replace("path", "/[^/]*$", "")
    pairs = (
        leaves.where(c("name").isin("name", "value"))
        .groupBy(key, node.alias("node"))
        .agg(
            F.max(F.when(c("name") == "name", c("value"))).alias("nme"),
            F.max(F.when(c("name") == "value", c("value"))).alias("val"),
        )
        .where(c("nme").isNotNull() & c("val").isNotNull())
    )
    ids = pairs.where(c("nme") == "id").groupBy(key).agg(F.min("val").alias("id"))
    return pairs.join(ids, key).where(c("nme") != "id").select(key, "id", "node", "nme", "val").distinct()


def portal_organisations(labelled: DataFrame) -> DataFrame:
    """Organisation rows: names in two languages, parent, closing date, time stamps."""
    wide = record_columns(
        labelled, "id", "nme", "val", "node",
        ["name", "organisationType", "organisationCode", "closedDate", "linkedRecordId", "tsCreated", "tsUpdated"],
    )
    numbers = F.regexp_extract_all("linkedRecordId", F.lit(r"(\d+)"), F.lit(1))
    named = split_columns(wide, "name", ["unit_sv", "unit_en"])
    return named.select(
        c("id").cast("int").alias("orgid"), c("organisationType").alias("org_type"),
        F.get(numbers, 0).try_cast("int").alias("p_orgid"), c("organisationCode").alias("org_code"),
        F.array_join(numbers, ",").alias("l_orgid"), "unit_sv", "unit_en", c("closedDate").alias("closed_date"),
        parse_iso_stamp(c("tsCreated")).alias("ts_created"), parse_iso_stamp(c("tsUpdated")).alias("ts_updated"),
    )


def portal_persons(labelled: DataFrame) -> DataFrame:
    """Person rows, one per combination of given and family name variants."""
    wide = record_columns(
        labelled, "id", "nme", "val", "node",
        ["givenName", "familyName", "public", "domain", "ORCID_ID", "academicTitle", "URL", "tsCreated"],
    )
    pairs = wide.withColumn("given", F.explode_outer(F.split("givenName", r"\|"))).withColumn(
        "family", F.explode_outer(F.split("familyName", r"\|"))
    )
    return pairs.select(
        c("id").alias("author_id"), parse_iso_stamp(c("tsCreated")).alias("ts"), (c("public") == "yes").alias("public"),
        "domain", F.concat_ws(", ", "family", "given").alias("name_variation"), c("ORCID_ID").alias("orcid"),
        c("academicTitle").alias("title"), c("URL").alias("url"),
    )


# --- registry and project answers -----------------------------------------------------------

def registry_funders(df: DataFrame, json: str = "json") -> DataFrame:
    """Funder items with all their alternative and replacing names as arrays."""
    item = "struct<id:string,name:string,uri:string,`alt-names`:array<string>,`replaced-by`:array<string>,replaces:array<string>>"
    rows = df.select(F.explode(F.from_json(F.get_json_object(json, "$.message.items"), f"array<{item}>")).alias("x")).select("x.*")
    return rows.select("id", "name", "uri", c("`alt-names`").alias("alt_names"), c("`replaced-by`").alias("replaced_by"), "replaces")


def registry_prefixes(df: DataFrame, json: str = "json") -> DataFrame:
    """(publisher, cr_id, doi_prefix) with one row per prefix."""
    item = "struct<name:string,memberId:int,prefixes:array<string>>"
    rows = df.select(F.explode(listed(c(json), item)).alias("x")).select("x.*", F.explode("x.prefixes").alias("doi_prefix"))
    return rows.select(tidy_html(c("name")).alias("publisher"), c("memberId").alias("cr_id"), "doi_prefix")


def work_assertions(df: DataFrame, names: list[str], json: str = "json", doi: str = "doi") -> DataFrame:
    """Assertion names as columns, one row per work."""
    rows = df.select(doi, F.explode(listed(F.get_json_object(json, "$.message.assertion"), "struct<name:string,value:string>")).alias("x"))
    return record_columns(rows.select(doi, "x.name", "x.value"), doi, "name", "value", "value", names)


def work_events(df: DataFrame, json: str = "json", doi: str = "doi") -> DataFrame:
    """Conference event of a work with its date pieces."""
    schema = (
        "struct<message:struct<event:struct<name:string,location:string,acronym:string,"
        "start:struct<`date-parts`:array<array<int>>>,`end`:struct<`date-parts`:array<array<int>>>>>>"
    )
    e = df.select(doi, F.from_json(json, schema).alias("j")).select(doi, "j.message.event.*")
    part = lambda side, i: F.get(F.get(c(f"`{side}`.`date-parts`"), 0), i).alias(f"{side}_date_{i + 1}")
    return e.where(c("name").isNotNull()).select(
        doi, "name", "location", "acronym", *[part(s, i) for s in ("start", "end") for i in range(3)]
    )


def project_parts(df: DataFrame, key: str, column: str) -> DataFrame:
    """One row per struct of a list column (people, subject codes)."""
    return flatten(df.select(key, F.explode(column).alias("x")).select(key, "x.*"))


# --- hierarchies and recognised text ---------------------------------------------------------

def organisation_tree(units: DataFrame, rowkey: str = "rowkey") -> DataFrame:
    """Level and parent id from the position key (``0_3_1``)."""
    parent = F.when(F.length(rowkey) > 1, F.regexp_replace(rowkey, r"_\d+$", ""))
    keyed = units.withColumns({"level": F.regexp_count(rowkey, F.lit("_")), "p_rowkey": parent})
    return with_parent(keyed, rowkey, "p_rowkey", "orgid", "p_orgid").drop("p_rowkey")


def ancestors(units: DataFrame) -> DataFrame:
    """(orgid, ancestor, distance) of all ancestors, by one join per level until
    no unit has a higher one. A unit that is its own ancestor is an error."""
    parents = units.where(c("p_orgid").isNotNull()).select(c("orgid").alias("__child"), c("p_orgid").alias("__parent"))
    level = parents.select(c("__child").alias("orgid"), c("__parent").alias("ancestor"), F.lit(1).alias("distance"))
    level = cut_lineage(level, "ancestors")
    out = level
    while not level.isEmpty():
        if not level.where(c("orgid") == c("ancestor")).isEmpty():
            raise ValueError("the hierarchy has a cycle")
        level = level.join(parents, c("ancestor") == c("__child")).select(
            "orgid", c("__parent").alias("ancestor"), (c("distance") + 1).alias("distance")
        )
        level = cut_lineage(level, "ancestors")
        out = out.unionByName(level)
    return out


RECORD_LINE = r"((.*?)\s+(\d{4}))*\s*(\d{5})+\s+(.*?)$"


def recognised_lines(lines: DataFrame, number: str, text: str, chunk: Column) -> DataFrame:
    """Code table from recognised text lines.

    A line without digits right below a record line belongs to it; the old
    code and description carry on downwards until the next ones appear.
    """
    valid = F.coalesce(c(text).rlike(RECORD_LINE), F.lit(False))
    rows = neighbour(lines.withColumn("__ok", valid), "__ok", [number], chunk, name="__above")
    orphan = ~c("__ok") & F.coalesce("__above", F.lit(False)) & ~c(text).rlike(r"\d+")
    rows = rows.withColumn("__tail", F.when(orphan, c(text)))
    rows = neighbour(rows, "__tail", [number], chunk, name="__below", ahead=True)
    whole = rows.withColumn("__t", F.concat_ws(" ", c(text), c("__below"))).where(c("__t").rlike(RECORD_LINE))
    pick = lambda i: F.nullif(F.regexp_extract("__t", RECORD_LINE, i), F.lit(""))
    table = whole.select(
        number, pick(3).alias("old_code"), pick(2).alias("old_desc"), pick(4).alias("scb_code"), pick(5).alias("scb_desc")
    )
    for col in ("old_code", "old_desc"):
        table = fill_down(table, col, [number], chunk)
    return table
