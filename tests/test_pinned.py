"""Pinned behaviour: name strings, identifiers, and the traps of the checks."""

import datetime as dt

from pyspark.sql import functions as F

from bibweave.functions import identifiers as ids, text
from bibweave.operators import checks as q, names
from bibweave.operators.groups import initials
from bibweave.operators.reshape import conform
from bibweave.sources.schemas import AUTHORS, PUBLICATIONS

c = F.col

EIGHT = (
    "Berg, Alva [u1aaaa11] [0000-0001-1111-1111] (UNI [10], Faculty of Stones (FS) [20], Pebbles [30], Gravel [40]) "
    "(Quarry Studies (QS), Wing B, North Hill, Northtown, Noland; Department of Rocks, East College, Easttown, Noland)"
    ";Dahl, Bo;Ek, Cia;Falk, Dan;Gran, Eva;"
    "Holm, Finn [u1bbbb22] (UNI [10], Faculty of Waves (FW) [50], Ripples [60], Foam [70]);Ivar, Gro;Jung, Hal"
)
TIGHT = (
    "Kvist, Ida [u1cccc33][0000-0002-2222-2222](UNI [10], Faculty (FS))(West Inst (p (q; r)); Annex., Noland.);"
    "Lind, Jon (South Inst; Hill Inst.) et al."
)


def pubs(spark, rows):
    names_ = sorted({k for r in rows for k in r})
    kinds = {f.name: f.dataType.simpleString() for f in spark.createDataFrame([], PUBLICATIONS).schema}
    df = spark.createDataFrame([[r.get(n) for n in names_] for r in rows], ", ".join(f"{n} {kinds[n]}" for n in names_))
    return conform(df, PUBLICATIONS)


def authors(spark, rows):
    kinds = {f.name: f.dataType.simpleString() for f in spark.createDataFrame([], AUTHORS).schema}
    names_ = sorted({k for r in rows for k in r})
    df = spark.createDataFrame([[r.get(n) for n in names_] for r in rows], ", ".join(f"`{n}` {kinds[n]}" for n in names_))
    return conform(df, AUTHORS)


def pids(df, name="PID"):
    return sorted(r[name] for r in df.collect())


def test_eight_authors_and_record_level_org_ids(spark):
    df = spark.createDataFrame([(1, EIGHT)], "PID bigint, Name string")
    rows = names.parse_names(df, home="UNI").orderBy("pos").collect()
    assert len(rows) == 8
    first = rows[0]
    assert (first.name, first.staffid, first.orcid) == ("Berg, Alva", "u1aaaa11", "0000-0001-1111-1111")
    assert first.orgids.split(" ") == ["10", "20", "30", "40", "50", "60", "70"]
    assert first.n_aff_ext == 2 and first.n_aff_own == 1
    assert rows[1].orgids is None and rows[1].extorg is None


def test_nested_groups_without_blanks_and_et_al(spark):
    df = spark.createDataFrame([(1, TIGHT)], "PID bigint, Name string")
    rows = names.parse_names(df, home="UNI").orderBy("pos").collect()
    assert len(rows) == 2
    assert rows[0].orgids == "10" and rows[0].orcid == "0000-0002-2222-2222"
    assert rows[0].extorg == "West Inst (p (q; r)); Annex., Noland."
    assert all(r.uses_etal for r in rows)
    assert rows[1].n_aff_ext == 2


def test_shared_internal_group(spark):
    people = [f"A{i}, B" for i in range(12)]
    text_ = ";".join(people[:6] + ["Moe, K [u1dddd44] (UNI [10], FW [50])"] + people[6:] + ["Nord, L (UNI [10], FW [50])"])
    rows = names.parse_names(spark.createDataFrame([(1, text_)], "PID bigint, Name string"), home="UNI").collect()
    assert len(rows) == 14
    assert {r.orgids for r in rows if r.n_aff_own} == {"10 50"}


def test_record_without_affiliation_keeps_ids_next_to_names(spark):
    rows = names.parse_names(spark.createDataFrame([(1, "Ohm, N [u1eeee55] [12]")], "PID bigint, Name string")).collect()
    assert rows[0].orgids == "12" and rows[0].n_aff_own is None


def test_vat(spark):
    v = spark.range(1).select(ids.vat_parts(F.lit("SE555555555501")).alias("v")).select("v.*").first()
    assert v.valid and v.is_eu and v.is_swe and v.country == "SE" and v.swe_org == "5555555555"


def test_organisation_text(spark):
    out = spark.range(1).select(
        text.clean_organisation(F.lit("organization=NI addressline=Xcity=Ypostcode=1country=Noland https://ror.org/000abc123")).alias("t")
    ).first().t
    assert "ror.org" not in out and "country=" not in out


def test_missing_notes_and_doi_are_kept(spark):
    base = {"CreatedDate": dt.date(2023, 5, 1), "LastUpdated": dt.date(2023, 5, 1)}
    p = pubs(spark, [
        {**base, "PID": 1, "PublicationType": "Artikel i tidskrift"},
        {**base, "PID": 2, "PublicationType": "Manuskript (preprint)", "ISI": "000123456789012"},
        {**base, "PID": 3, "PublicationType": "Artikel i tidskrift", "Notes": "QC 1", "JournalISSN": "0378-5955"},
    ])
    day = dt.date(2024, 1, 1)
    assert pids(q.check_missing_journal_ids(p)) == [1]
    assert pids(q.check_manuscripts_with_identifiers(p)) == [2]
    assert pids(q.check_not_checked(p, day)) == [1, 2]
    assert pids(q.prefilter(p, day)) == [1, 2, 3]


def test_doi_case_is_ignored(spark):
    p = pubs(spark, [{"PID": 1, "DOI": "10.1/ABC"}, {"PID": 2, "DOI": "10.1/abc"}, {"PID": 3, "DOI": "10.1/x"}, {"PID": 4}])
    rows = q.check_duplicate_doi(p).collect()
    assert sorted((r.PID, r.n_pids) for r in rows) == [(1, 2), (2, 2)]


def test_duplicates_expand_against_the_unfiltered_table(spark):
    every = pubs(spark, [{"PID": i, "ScopusId": "s", "Status": "x"} for i in (1, 2, 3)])
    assert pids(q.check_duplicate_scopus_id(every.where("PID < 3"), every)) == [1, 2, 3]


def test_staff_id_patterns(spark):
    a = authors(spark, [{"PID": i, "staffid": s} for i, s in enumerate(["u1abcdef", "PI000123", "x-y", "zzz", None])])
    assert pids(q.check_invalid_staff_id(a)) == [3]


def test_orcid_patterns(spark):
    a = authors(spark, [{"PID": i, "orcid": s} for i, s in enumerate(["0000-0002-1825-0097", "0000-0002-1825-009", "0000--0002-1825-0097", "0000-0002-1825-0098", None])])
    p = pubs(spark, [{"PID": 0}])
    assert pids(q.check_invalid_orcid(a, p)) == [1]
    assert pids(q.check_invalid_orcid(a, p, strict=True)) == [1, 2, 3] or pids(q.check_invalid_orcid(a, p, strict=True)) == [1, 3]


def test_issn_and_isbn(spark):
    p = pubs(spark, [{"PID": i, "JournalISSN": s} for i, s in enumerate(["0378-5955", "0378-5956", "03785955", "0378_5955", None])])
    assert pids(q.check_invalid_issn(p)) == [1, 3]
    b = pubs(spark, [{"PID": 1, "ISBN": "978-0-306-40615-7;0-306-40615-2"}, {"PID": 2, "ISBN": "978-0-306-40615-8"}, {"PID": 3, "ISBN": " 0306406152"}])
    assert pids(q.check_invalid_isbn(b)) == [2, 3]
    assert [r.n for r in b.orderBy("PID").select(q.n_bad_isbn().alias("n")).collect()] == [0, 1, 1]


def test_unicode_parity_and_strict(spark):
    p = pubs(spark, [{"PID": 1, "ISBN": "1234å"}, {"PID": 2, "ISBN": "1234ö"}, {"PID": 3}])
    a = authors(spark, [{"PID": 9, "DOI": "10.1/x"}])
    assert pids(q.check_unicode_identifiers(p, a)) == [1]
    assert pids(q.check_unicode_identifiers(p, a, strict=True)) == [1, 2]


def test_titles_stop_words_stop_list_and_initials(spark):
    p = pubs(spark, [
        {"PID": 1, "Title": "Same", "PublicationType": "x", "Year": 2000}, {"PID": 2, "Title": " same ", "PublicationType": "x"},
        {"PID": 3, "Title": "Introduction to X", "PublicationType": "x"}, {"PID": 4, "Title": "introduction to x", "PublicationType": "x"},
        {"PID": 5, "Title": "Listed", "PublicationType": "x"}, {"PID": 6, "Title": "Listed", "PublicationType": "x"},
        {"PID": 7, "Title": "Apart", "PublicationType": "x"}, {"PID": 8, "Title": "Apart", "PublicationType": "y"},
    ])
    a = authors(spark, [{"PID": i, "name": n, "pos": k} for i in range(1, 9) for k, n in enumerate(["Berg, A", "Ek, B"])])
    stop = spark.createDataFrame([(5.0, "Listed")], "PID double, Title string")
    rows = q.check_duplicate_titles(p, a, stop).collect()
    assert sorted(r.PID for r in rows) == [1, 2, 4, 6]
    assert {r.check_key for r in rows} == {"BE_2000", "BE_NA"}


def test_initials_follow_positions_not_rows(spark):
    a = authors(spark, [{"PID": 1, "name": "Z, a", "pos": 1}, {"PID": 1, "name": "B, a", "pos": 12}, {"PID": 1, "name": "C, a", "pos": 2}])
    assert initials(a).first().initials == "ZCB"


def test_shared_orcid_overview_counts_one(spark):
    a = authors(spark, [{"PID": i, "orcid": "o", "staffid": s} for i, s in enumerate("aab")] + [{"PID": 9, "orcid": "p", "staffid": "a"}])
    d = q.shared_orcids(a)
    assert sorted((r.orcid, r.staffid) for r in d.collect()) == [("o", "a"), ("o", "b")]
    assert {r.n for r in q.shared_orcid_overview(d).collect()} == {1}


def test_ambiguous_orcid_lists_missing_last(spark):
    a = authors(spark, [{"PID": 1, "orcid": "o", "staffid": "b"}, {"PID": 2, "orcid": "o", "staffid": "a"}, {"PID": 2, "orcid": "o"}])
    combos = {r.combo for r in q.check_ambiguous_orcid(a).collect()}
    assert combos == {"o (tot=002 ids=a b NA)"}


def test_shorten_and_pages(spark):
    row = spark.createDataFrame([("x" * 25, "x" * 26)], "a string, b string").select(text.shorten(c("a")).alias("a"), text.shorten(c("b")).alias("b")).first()
    assert row.a == "x" * 25 and row.b == "x" * 22 + "..."
    got = spark.createDataFrame([("99-101",), ("101-99",), ("e12",)], "p string").select(text.page_extent(c("p")).alias("e")).select("e.*").collect()
    assert [tuple(r) for r in got] == [("99", "101"), ("99", "101"), ("12", None)]


def test_xml_escape_order(spark):
    row = spark.range(1).select(text.tidy_xml(F.lit("a<b")).alias("p"), text.tidy_xml(F.lit("a<b"), ampersand_first=True).alias("s"), text.tidy_xml(F.lit("x]]>y"), cdata=True).alias("c")).first()
    assert (row.p, row.s, row.c) == ("a&amp;lt;b", "a&lt;b", "<![CDATA[xy]]>")


def test_tidy_html(spark):
    df = spark.createDataFrame([("<p>a &amp; b<br/>&lt;x&gt;</p><script>1<2</script>",), ("",), (None,)], "t string")
    assert [r.t for r in df.select(text.tidy_html(c("t")).alias("t")).collect()] == ["a & b<x>", "", None]


def test_all_entities_and_latin_letters(spark):
    import html

    notes = ["&copy; &middot; &#246;&#x2013;&amp;lt; &nope; &", "a&ouml;b&amp;&#0;&#xD800;", None, "x < 1 & y", "&Lstrok;&NotEqualTilde;"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(notes)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(text.decode_entities(c("t"))).collect()]
    assert got[0] == html.unescape(notes[0]) and got[1] == "aöb&&#0;&#xD800;" and got[2] is None and got[3] == notes[3] and got[4] == html.unescape(notes[4])
    names_ = spark.createDataFrame([("Łódź Şimşek Čapek Øre Ægir Straße ﬀ Ȝ e\u0301",)], "t string")
    assert names_.select(text.match_text(c("t"))).first()[0].startswith("lodz simsek capek ore aegir strasse")


def test_cycles_are_an_error(spark):
    import pytest

    from bibweave.operators.records import ancestors

    with pytest.raises(ValueError):
        ancestors(spark.createDataFrame([(1, 2), (2, 1)], "orgid int, p_orgid int")).count()
