"""Bibliographic XML records: rendering, parsing to tables, linked data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bibweave.functions.text import keyword_list, page_extent, tidy_xml
from bibweave.operators.groups import joined_in_order, with_group_values

c = F.col

# Genre elements per genre key, as (authority, type, language, text).
_CODE, _SUB, _KIND = "publicationTypeCode", "publicationSubTypeCode", "publicationType"


def _genre(content: str | None, code: str, svep: str, label: str, kev: str | None, sub: str | None = None) -> list[tuple]:
    rows = [("diva", "contentTypeCode", None, content)] if content else []
    rows += [("diva", _CODE, None, code)]
    rows += [("diva", _SUB, None, sub)] if sub else []
    rows += [("svep", _KIND, None, svep), ("diva", _KIND, "eng", label)]
    return rows + ([("kev", _KIND, "eng", kev)] if kev else [])


GENRE_ELEMENTS = {
    "article": _genre("referee", "article", "art", "Article in journal", "article"),
    "articleOther": _genre("other", "article", "art", "Article in journal", "article"),
    "articleLetter": _genre("science", "article", "art", "Article in journal", "article", "letter"),
    "articleErratum": _genre("science", "article", "art", "Article in journal", "article"),
    "articleConferencePaper": _genre("science", "article", "art", "Article in journal", "article", "meetingAbstract"),
    "editorialMaterial": _genre("science", "article", "art", "Article in journal", "article", "editorialMaterial"),
    "meetingAbstract": _genre("science", "article", "art", "Article in journal", "article", "meetingAbstract"),
    "conferencePaper": _genre("refereed", "conferencePaper", "kon", "Conference paper", "proceeding"),
    "conferencePaperPublished": _genre(
        "refereed", "conferencePaper", "kon", "Conference paper", "proceeding", "publishedPaper"),
    "chapter": _genre("science", "chapter", "kap", "Chapter in book", "bookitem"),
    "review": _genre("refereed", "review", "for", "Article, review/survey", "article"),
    "report": _genre("science", "report", "rap", "Report", "book"),
    "manuscript": _genre("science", "manuscript", "ovr", "Manuscript (preprint)", "preprint"),
    "conferenceProceedings": _genre(
        "science", "conferenceProceedings", "pro", "Conference proceedings (editor)", "conference"),
    "collection": _genre("science", "collection", "sam", "Collection (editor)", "book"),
    "bookReview": _genre("science", "bookReview", "rec", "Article, book review", "article"),
    "book": _genre("science", "book", "bok", "Book", "book"),
    "patent": _genre(None, "patent", "pat", "Patent", "patent"),
    "other": _genre("other", "other", "ovr", "Other", None),
}
CONFERENCE_GENRES = ["conferencePaperPublished", "articleConferencePaper", "conferenceProceedings"]
ISBN_IN_NOTE = ["chapter", "conferencePaperPublished", "articleConferencePaper"]
MANY_AUTHORS = 30
HEAD = (
    '<mods xmlns="http://www.loc.gov/mods/v3" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" '
    'xmlns:xlink="http://www.w3.org/1999/xlink" version="3.7" '
    'xsi:schemaLocation="http://www.loc.gov/mods/v3 http://www.loc.gov/standards/mods/v3/mods-3-7.xsd">'
)
COLLECTION_HEAD = (
    '<?xml version="1.0" encoding="UTF-8"?>\n<modsCollection xmlns="http://www.loc.gov/mods/v3" '
    'xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" '
    'xsi:schemaLocation="http://www.loc.gov/mods/v3 http://www.loc.gov/standards/mods/v3/mods-3-2.xsd">\n'
)
COLLECTION_TAIL = "\n</modsCollection>"


def element(name: str, value: Column, **attributes: str) -> Column:
    """Element with a text; a missing text gives an empty element."""
    attrs = "".join(f' {k.rstrip("_")}="{v}"' for k, v in attributes.items())
    return F.concat(F.lit(f"<{name}{attrs}>"), F.coalesce(value.cast("string"), F.lit("")), F.lit(f"</{name}>"))


def optional(name: str, value: Column, **attributes: str) -> Column:
    return F.when(value.isNotNull(), element(name, value, **attributes))


def genre_elements(genre: Column) -> Column:
    def text(rows):
        lang = lambda x: f' lang="{x}"' if x else ""
        return "".join(f'<genre authority="{a}" type="{t}"{lang(l)}>{v}</genre>' for a, t, l, v in rows)

    out = None
    for key, rows in GENRE_ELEMENTS.items():
        out = F.when(genre == key, text(rows)) if out is None else out.when(genre == key, text(rows))
    return out.otherwise(text(GENRE_ELEMENTS["other"]))


def person_elements(
    authors: DataFrame, own: str, source: str, key: str = "sid", many_authors: int = MANY_AUTHORS
) -> DataFrame:
    """(key, persons, n_authors): personal names of a record in order.

    Own authors, recognised by the organisation text, are marked ``$$$``. From
    thirty authors on only the first, the own and the last are kept, followed
    by "et al."; the others are dropped before anything is gathered.
    """
    # the first and the last are found by extremes, so no record is sorted whole
    counted = with_group_values(
        authors, [key], n_authors=F.count_distinct("seq"), lo=F.min("seq"), hi=F.max("seq")
    )
    mine = F.coalesce(F.lower("raw_org").rlike(own), F.lit(False))
    many = c("n_authors") >= many_authors
    spot = lambda rank, when: F.when(when, F.struct(F.lit(rank).alias("r"), c("seq").alias("s")))
    spots = F.array_compact(
        F.array(
            spot(0, many & (c("seq") == c("lo"))), spot(1, ~many | mine), spot(2, many & (c("seq") == c("hi"))),
            F.when(many & (c("seq") == c("hi")), F.struct(F.lit(3).alias("r"), c("seq").alias("s"))),
        )
    )
    kept = counted.withColumn("spot", F.explode(spots))
    et_al = c("spot.r") == 3
    name = F.when(et_al, F.lit("et al.")).otherwise(
        F.concat(F.when(mine, F.lit("$$$")).otherwise(F.lit("")), F.coalesce("surname", F.lit("")))
    )
    text = lambda col: F.when(~et_al, col)
    person = F.concat(
        F.lit(f'<name type="personal" authority="{source}" xlink:href="'), F.coalesce(text(c("staffid")), F.lit("")),
        F.lit('">'), element("namePart", tidy_xml(name, ampersand_first=True), type="family"),
        element("namePart", tidy_xml(text(c("given_name")), ampersand_first=True), type="given"),
        F.lit('<role><roleTerm type="code" authority="marcrelator">aut</roleTerm></role>'),
        element("affiliation", tidy_xml(text(c("raw_org")), cdata=True)),
        F.coalesce(optional("description", F.concat(F.lit("orcid.org="), text(c("orcid")))), F.lit("")),
        F.lit("</name>"),
    )
    placed = kept.select(key, (c("spot.r").cast("bigint") * 10**9 + c("spot.s")).alias("at"), person.alias("person"))
    joined = joined_in_order(placed, [key], "person", "at", "persons", "\n")
    return joined.join(authors.groupBy(key).agg(F.count_distinct("seq").alias("n_authors")), key)


def render(
    records: DataFrame, authors: DataFrame, own: str, source: str, key: str = "sid", many_authors: int = MANY_AUTHORS
) -> DataFrame:
    """(key, mods): one XML record per row, fragments in the import order.

    ``records`` may lack any of the optional columns. A record without authors
    is rendered without names.
    """
    have = set(records.columns)
    col = lambda n: c(n) if n in have else F.lit(None).cast("string")
    df = records.join(person_elements(authors, own, source, key, many_authors), key, "left")
    in_note = col("genre").isin(ISBN_IN_NOTE)
    isbns = F.transform(
        F.split(F.coalesce(col("isbn"), F.lit("")), " "),
        lambda x: F.concat(F.lit('<identifier type="isbn" displayLabel="Undefined">'), x, F.lit("</identifier>")),
    )
    identifiers = F.concat(
        element("identifier", tidy_xml(col("doi"), ampersand_first=True), type="doi"),
        element("identifier", col("eid"), type="scopus"), element("identifier", col("eissn"), type="eissn"),
        element("identifier", col("issn"), type="issn"), element("identifier", col("article_number"), type="articleId"),
        F.when(in_note, F.lit("")).otherwise(F.array_join(isbns, "")),
    )
    notes = F.concat(
        F.lit("<note>Imported from Scopus. VERIFY.\n</note>"),
        F.when(in_note, element("note", F.concat(F.lit("Part of ISBN "), F.coalesce(col("isbn"), F.lit("NA"))))).otherwise(F.lit("")),
        F.when(c("n_authors") >= many_authors, element("note", c("n_authors"), type="creatorCount")).otherwise(F.lit("")),
    )
    origin = F.concat(
        F.lit("<originInfo>"),
        F.concat_ws(
            "", optional("publisher", tidy_xml(col("publisher"))), optional("dateIssued", col("year_issued")),
            optional("dateOther", col("available_from"), type="availableFrom"),
        ),
        F.lit("</originInfo>"),
    )
    pages = page_extent(col("page_range"))
    plain = lambda n: tidy_xml(col(n), ampersand_first=True)
    journal = F.concat(
        F.lit('<relatedItem type="host"><titleInfo>'), element("title", plain("publication_name")), F.lit("</titleInfo>"),
        element("identifier", col("issn"), type="issn"), element("identifier", col("eissn"), type="eissn"),
        F.lit('<part><detail type="volume">'), element("number", plain("volume")), F.lit('</detail><detail type="issue">'),
        element("number", plain("issue")), F.lit("</detail><extent>"), element("start", pages["extent_beg"]),
        element("end", pages["extent_end"]), F.lit("</extent></part></relatedItem>"),
    )
    conference = F.concat(
        F.lit('<relatedItem type="host"><titleInfo>'), element("title", plain("conf_title")),
        F.lit("<subTitle></subTitle></titleInfo><part><extent>"), element("start", plain("conf_ext_start")),
        element("end", plain("conf_ext_end")), F.lit('</extent></part></relatedItem><name type="conference">'),
        element("namePart", plain("conf_details")), F.lit("</name>"),
    )
    related = F.when(
        col("genre").isin(CONFERENCE_GENRES) & col("conf_details").isNotNull(), conference
    ).otherwise(journal)
    topics = F.transform(keyword_list(col("keywords")), lambda x: element("topic", tidy_xml(x, ampersand_first=True)))
    subject = F.when(
        col("keywords").isNotNull(), F.concat(F.lit('<subject lang="eng">'), F.array_join(topics, ""), F.lit("</subject>"))
    )
    parts = [
        genre_elements(col("genre")), c("persons"),
        F.concat(F.lit('<titleInfo lang="eng">'), element("title", tidy_xml(col("title"))), F.lit("</titleInfo>")),
        origin, F.lit('<physicalDescription><form authority="marcform">print</form></physicalDescription>'),
        identifiers, F.lit("<typeOfResource>text</typeOfResource>"), subject,
        element("abstract", tidy_xml(col("abstract"), cdata=True), lang="eng"), notes, related,
    ]
    if "record_id" in have:
        parts.append(F.concat(F.lit("<recordInfo>"), element("recordIdentifier", col("record_id")), F.lit("</recordInfo>")))
    return df.select(key, F.concat_ws("\n", F.lit(HEAD), *parts, F.lit("</mods>")).alias("mods"))


def failures(wanted: DataFrame, rendered: DataFrame, key: str = "sid") -> DataFrame:
    """Keys without a well-formed record: never rendered, or not readable back."""
    bad = rendered.where(~well_formed(c("mods"))).select(key)
    absent = wanted.select(key).distinct().join(rendered, key, "left_anti")
    return absent.unionByName(bad).distinct()


def well_formed(doc: Column) -> Column:
    """Can the text be read as XML? A malformed text is an answer, not an error."""
    probe = F.from_xml(doc, "`@version` string, `__bad` string", {"columnNameOfCorruptRecord": "__bad", "attributePrefix": "@"})
    return doc.isNotNull() & probe.isNotNull() & probe["__bad"].isNull()


# --- parsing ------------------------------------------------------------------------------

_TEXT = "struct<`#`:string,`@type`:string,`@lang`:string,`@authority`:string,`@displayLabel`:string,`@invalid`:string>"
_TITLE = "struct<`@lang`:string,`@type`:string,title:string,subTitle:string>"
FIELDS = {
    "genre": f"array<{_TEXT}>",
    "name": f"array<struct<`@type`:string,`@authority`:string,`@xlink:href`:string,namePart:array<{_TEXT}>,"
    f"role:array<struct<roleTerm:array<{_TEXT}>>>,affiliation:array<string>,description:array<string>>>",
    "titleInfo": f"array<{_TITLE}>",
    "language": f"array<struct<`@objectPart`:string,languageTerm:array<{_TEXT}>>>",
    "originInfo": f"array<struct<publisher:array<string>,dateIssued:array<string>,dateOther:array<{_TEXT}>>>",
    "physicalDescription": f"array<struct<form:array<{_TEXT}>,extent:array<string>>>",
    "identifier": f"array<{_TEXT}>",
    "typeOfResource": "array<string>",
    "relatedItem": f"array<struct<`@type`:string,titleInfo:{_TITLE},note:array<{_TEXT}>,identifier:array<{_TEXT}>,"
    f"genre:array<{_TEXT}>,part:struct<detail:array<struct<`@type`:string,number:string>>,extent:struct<start:string,`end`:string>>>>",
    "subject": f"array<struct<`@lang`:string,`@authority`:string,`@xlink:href`:string,topic:array<string>,genre:string>>",
    "abstract": f"array<{_TEXT}>",
    "note": f"array<{_TEXT}>",
    "location": f"array<struct<url:array<{_TEXT}>>>",
    "recordInfo": f"array<struct<recordOrigin:string,recordContentSource:string,recordCreationDate:string,"
    f"recordChangeDate:string,recordIdentifier:string>>",
}


def schema_of(fields: list[str] | None = None) -> str:
    """Schema of a record with all its fields or some; the id's field is always there."""
    return ", ".join(f"{n} {t}" for n, t in FIELDS.items() if fields is None or n in fields or n == "recordInfo") + ", `__bad` string"


SCHEMA = schema_of()
OPTIONS = {"attributePrefix": "@", "valueTag": "#", "columnNameOfCorruptRecord": "__bad"}


def parse(records: DataFrame, doc: str = "mods", fields: list[str] | None = None) -> DataFrame:
    """Records as structs with their numeric id; unreadable ones are left out.

    Every text is read to its end, whatever the ``fields``, but only the values of those (default: all) are built.
    The parsed struct is passed through a one-element explode, so the optimizer
    cannot copy the expensive parse into the filter and every later use.
    """
    struct = F.explode(F.array(F.from_xml(c(doc), schema_of(fields), OPTIONS))).alias("m")
    m = records.select("*", struct).where(c("m").isNotNull() & c("m.__bad").isNull())
    identifier = F.get(F.filter("m.recordInfo", lambda r: r["recordIdentifier"].isNotNull()), 0)["recordIdentifier"]
    pid = F.regexp_replace(identifier, "^.*?:", "").try_cast("bigint")
    return m.withColumn("pid", pid)


def _all_of(rows: Column, field: str) -> Column:
    """The elements of an array field of all rows."""
    return F.flatten(F.filter(F.transform(rows, lambda r: r[field]), lambda a: a.isNotNull()))


# The field that each table is made of.
TABLE_FIELDS = {n: n for n in FIELDS if n not in ("name", "subject")} | {"authors": "name", "orgs": "name", "subjects": "subject"}


def tables(parsed: DataFrame) -> dict[str, DataFrame]:
    """The fifteen tables of parsed records, each led by ``pid``. Of an element that repeats every one is a row.

    Records parsed with some fields only give the tables of these (``TABLE_FIELDS``).
    """
    have = set(parsed.schema["m"].dataType.names)

    def each(field: str, **cols: str) -> DataFrame:
        rows = parsed.select("pid", F.explode(f"m.{field}").alias("x"))
        return rows.select("pid", *[c(p).alias(n) for n, p in cols.items()])

    part = lambda kind: F.get(F.transform(F.filter("namePart", lambda p: p["@type"] == kind), lambda p: p["#"]), 0)
    names = lambda: parsed.select("pid", F.posexplode("m.name").alias("id", "x")).select(
        "pid", (c("id") + 1).alias("id"), c("x.`@type`").alias("type"), c("x.`@authority`").alias("aut"),
        c("x.`@xlink:href`").alias("href"), F.explode_outer(_all_of(c("x.role"), "roleTerm")["#"]).alias("role"), "x.namePart",
        c("x.affiliation").alias("affs"), c("x.description").alias("descs"),
    )
    people = lambda: names().where(c("type") == "personal").select(
        "pid", "id", "aut", "href", "role", part("family").alias("family"), part("given").alias("given"),
        F.explode_outer("affs").alias("affiliation"), "descs",
    )
    orgs = lambda: names().where(c("type") == "corporate").select(
        "pid", "id", "aut", "href", "role", F.explode_outer("namePart").alias("np"), "affs", "descs"
    )
    hosts = lambda: parsed.select("pid", F.explode("m.relatedItem").alias("x"))
    detail = lambda kind: F.get(F.transform(F.filter("x.part.detail", lambda p: p["@type"] == kind), lambda p: p["number"]), 0)
    made = {
        "genre": lambda: each("genre", desc="x.`#`", aut="x.`@authority`", type="x.`@type`", lang="x.`@lang`"),
        "orgs": lambda: orgs().select("pid", "id", "aut", "href", "role", c("np.`#`").alias("org"), F.explode_outer("affs").alias("aff"), "descs")
        .select("pid", "id", "aut", "href", "role", "org", "aff", F.explode_outer("descs").alias("desc")),
        "authors": lambda: people().select(
            "pid", "id", "aut", "href", "role", "family", "given", "affiliation", F.explode_outer("descs").alias("description")),
        "titleInfo": lambda: each("titleInfo", title="x.title", subtitle="x.subTitle", lang="x.`@lang`", type="x.`@type`"),
        "language": lambda: parsed.select("pid", F.explode("m.language").alias("x")).select("pid", "x", F.explode_outer("x.languageTerm").alias("t")).select(
            "pid", c("t.`#`").alias("language_term"), c("t.`@type`").alias("language_type"),
            c("t.`@authority`").alias("language_authority"), c("x.`@objectPart`").alias("object_part")),
        "originInfo": lambda: parsed.select("pid", F.explode("m.originInfo").alias("x"))
        .select("pid", "x", F.explode_outer("x.publisher").alias("publisher"))
        .select("pid", "x", "publisher", F.explode_outer("x.dateIssued").alias("date_issued"))
        .select("pid", "publisher", "date_issued", F.explode_outer("x.dateOther").alias("o"))
        .select("pid", "publisher", "date_issued", c("o.`#`").alias("date_other"), c("o.`@type`").alias("date_other_type")),
        "physicalDescription": lambda: parsed.select("pid", F.explode("m.physicalDescription").alias("x"))
        .select("pid", "x", F.explode_outer("x.form").alias("f"))
        .select("pid", c("f.`#`").alias("form"), c("f.`@authority`").alias("form_authority"), F.explode_outer("x.extent").alias("extent")),
        "identifier": lambda: each("identifier", id_name="x.`@type`", id_value="x.`#`", id_label="x.`@displayLabel`"),
        "typeOfResource": lambda: parsed.select("pid", F.explode("m.typeOfResource").alias("resource_type")),
        "relatedItem": lambda: hosts().select(
            "pid", c("x.`@type`").alias("relateditem_type"), c("x.titleInfo.title").alias("title"),
            detail("volume").alias("volume"), detail("issue").alias("issue"),
            c("x.part.extent.start").alias("part_extent_start"), c("x.part.extent.end").alias("part_extent_end"),
            F.explode_outer("x.identifier").alias("i")).select(
            "pid", "relateditem_type", "title", "volume", "issue", "part_extent_start", "part_extent_end",
            c("i.`@type`").alias("identifier_type"), c("i.`#`").alias("identifier")),
        "subjects": lambda: parsed.select("pid", F.explode("m.subject").alias("x")).select(
            "pid", c("x.`@lang`").alias("lang"), c("x.`@authority`").alias("authority"), c("x.`@xlink:href`").alias("href"),
            F.explode_outer("x.topic").alias("topic")),
        "abstract": lambda: each("abstract", abstract="x.`#`", lang="x.`@lang`"),
        "note": lambda: each("note", note="x.`#`", note_type="x.`@type`", note_lang="x.`@lang`"),
        "location": lambda: parsed.select("pid", F.explode("m.location").alias("x")).select("pid", F.explode_outer("x.url").alias("u")).select(
            "pid", c("u.`#`").alias("url"), c("u.`@displayLabel`").alias("url_display")),
        "recordInfo": lambda: each("recordInfo", record_origin="x.recordOrigin", record_source="x.recordContentSource",
                           record_created="x.recordCreationDate", record_changed="x.recordChangeDate", record_id="x.recordIdentifier"),
    }
    return {name: make() for name, make in made.items() if TABLE_FIELDS[name] in have}


# --- linked data ------------------------------------------------------------------------------

# Work type by resource type, and publication status terms.
WORK_TYPES = {
    "text": "Text", "stillimage": "StillImage", "sound recording - nonmusical": "NonMusicalAudio",
    "sound recording - musical": "Music", "sound recording": "Audio", "software, multimedia": "Multimedia",
    "notated music": "NotatedMusic", "mixed material": "MixedMaterial", "cartographic": "Cartography",
    "three dimensional object": "Object", "moving image": "MovingImage",
}
STATUS_TERMS = {
    "Published": "Published", "Preprint": "Preprint", "Submitted": "Submitted", "Accepted": "Accepted",
    "In press": "InPress", "Epub ahead of print/Online first": "EpubAheadOfPrintOnlineFirst", "Retracted": "Retracted",
}
STATUS_BASE = "https://id.kb.se/term/swepub/"
LANGUAGE_BASE = "https://id.kb.se/language/"
CLASS_SCHEME = "https://id.kb.se/term/ssif"
CLASS_AUTHORITY = "uka.se"


def linked_data(parsed: DataFrame) -> DataFrame:
    """(pid, json): instance and work document of every parsed record."""
    lit = lambda v: F.lit(v)
    kind = lambda v: lit(v).alias("@type")
    rows = lambda field: F.coalesce(c(f"m.{field}"), F.from_json(F.lit("[]"), parsed.select(f"m.{field}").schema[0].dataType))
    language = lambda code: F.struct(kind("Language"), F.concat(lit(LANGUAGE_BASE), code).alias("@id"), code.alias("code"))
    work = None
    for resource, label in WORK_TYPES.items():
        test = F.get("m.typeOfResource", 0) == resource
        work = F.when(test, label) if work is None else work.when(test, label)
    title = F.transform(
        rows("titleInfo"),
        lambda t: F.struct(
            F.when(t["@type"] == "alternative", "VariantTitle").otherwise("Title").alias("@type"),
            t["title"].alias("mainTitle"), t["subTitle"].alias("subtitle"),
        ),
    )
    summary = F.transform(
        rows("abstract"),
        lambda a: F.struct(kind("Summary"), a["#"].alias("label"), F.when(a["@lang"].isNotNull(), language(a["@lang"])).alias("language")),
    )
    person = lambda n, part: F.get(F.transform(F.filter(n["namePart"], lambda p: p["@type"] == part), lambda p: p["#"]), 0)
    contribution = F.transform(
        F.filter(rows("name"), lambda n: n["@type"].isin("personal", "corporate")),
        lambda n: F.struct(
            kind("Contribution"),
            F.struct(
                F.when(n["@type"] == "personal", "Person").otherwise("Organization").alias("@type"),
                person(n, "family").alias("familyName"), person(n, "given").alias("givenName"),
                F.when(n["@type"] == "corporate", F.get(n["namePart"], 0)["#"]).alias("name"),
            ).alias("agent"),
            F.transform(
                n["affiliation"], lambda a: F.struct(kind("Organization"), a.alias("name"))
            ).alias("hasAffiliation"),
            _all_of(n["role"], "roleTerm")["#"].alias("role"),
        ),
    )
    classified = lambda s: F.coalesce(s["@authority"] == CLASS_AUTHORITY, F.lit(False))
    subject = F.transform(
        F.filter(rows("subject"), lambda s: ~classified(s)),
        lambda s: F.struct(kind("Topic"), s["@xlink:href"].alias("code"), F.array_join(s["topic"], " ").alias("prefLabel")),
    )
    classification = F.transform(
        F.filter(rows("subject"), lambda s: classified(s) & s["@xlink:href"].isNotNull()),
        lambda s: F.struct(
            F.concat(lit(CLASS_SCHEME + "/"), s["@xlink:href"]).alias("@id"), kind("Classification"),
            s["@xlink:href"].alias("code"), F.element_at(s["topic"], -1).alias("prefLabel"),
            F.struct(kind("ConceptScheme"), lit(CLASS_SCHEME).alias("@id")).alias("inScheme"),
        ),
    )
    of_type = lambda t: F.get(F.transform(F.filter(rows("note"), lambda n: n["@type"] == t), lambda n: n["#"]), 0)
    status = of_type("publicationStatus")
    term = F.when(status.isNull(), STATUS_BASE + "Published")
    for label, code in STATUS_TERMS.items():
        term = term.when(status == label, STATUS_BASE + code)
    note = lambda k, label, ident: F.struct(lit(k).alias("@type"), ident.alias("@id"), label.alias("label"))
    none = F.lit(None).cast("string")
    notes = F.concat(
        F.array_compact(F.array(F.when(of_type("creatorCount").isNotNull(), note("CreatorCount", of_type("creatorCount"), none)))),
        F.array(note("PublicationStatus", F.when(term.isNull(), status), term)),
        F.transform(F.filter(rows("note"), lambda n: n["@type"].isNull()), lambda n: note("Note", n["#"], none)),
    )
    ident = lambda keep: F.transform(
        F.filter(rows("identifier"), lambda i: (F.coalesce(i["#"], lit("")) != "") & keep(i)),
        lambda i: F.struct(i["@type"].alias("@type"), i["#"].alias("value")),
    )
    valid, invalid = ident(lambda i: i["@invalid"].isNull()), ident(lambda i: i["@invalid"] == "yes")
    present = lambda arr: F.when(F.size(arr) > 0, arr)
    hosts = F.transform(
        F.filter(rows("relatedItem"), lambda r: r["@type"] == "host"),
        lambda r: F.struct(kind("Work"), r["titleInfo"]["title"].alias("mainTitle")),
    )
    genre = F.transform(rows("genre"), lambda g: F.struct(F.concat(lit(STATUS_BASE), g["#"]).alias("@id")))
    codes = F.filter(_all_of(rows("language"), "languageTerm"), lambda t: F.coalesce(t["@type"], lit("code")) == "code")
    languages = F.transform(codes, lambda t: language(t["#"]))
    document = F.struct(
        lit("https://id.kb.se/context.jsonld").alias("@context"), lit("").alias("@id"), kind("Instance"),
        F.struct(
            work.otherwise("Text").alias("@type"), genre.alias("genreForm"), languages.alias("language"),
            title.alias("hasTitle"), present(summary).alias("summary"), contribution.alias("contribution"),
            present(subject).alias("subject"), present(classification).alias("classification"), notes.alias("hasNote"),
        ).alias("instanceOf"),
        present(F.transform(_all_of(rows("physicalDescription"), "extent"), lambda x: F.struct(kind("Extent"), x.alias("label")))).alias("extent"),
        valid.alias("identifiedBy"), present(invalid).alias("incorrectlyIdentifiedBy"), present(hosts).alias("isPartOf"),
    )
    return parsed.select("pid", F.to_json(document).alias("json"))
