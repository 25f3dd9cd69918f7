"""An incoming batch against the corpus, snapshots, and project tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from bibweave.functions import identifiers as ids
from bibweave.functions.links import address
from bibweave.operators.groups import collapse, first_row
from bibweave.operators.joins import absent_from, by_lower, present_in
from bibweave.operators.lookups import with_genre
from bibweave.operators.reshape import rename_by_mapping
from bibweave.operators.setops import stack
from bibweave.session import cut_lineage

c = F.col


def find_records(pubs: DataFrame, asked: DataFrame, column: str) -> DataFrame:
    """Records for a table of typed identifiers (``PID:``, ``DOI:``, ``PMID:``, ``ISI:``).

    The identifier columns become one (kind, value) key, so a batch of look-ups
    is a single equi join."""
    kinds = ["PID", "DOI", "PMID", "ISI"]
    keyed = pubs.select(
        *pubs.columns,
        F.explode(
            F.array(*[F.struct(F.lit(k).alias("kind"), c(k).cast("string").alias("value")) for k in kinds])
        ).alias("__key"),
    ).where(c("__key.value").isNotNull())
    wanted = asked.withColumn("__asked", ids.typed_identifier(c(column)))
    same = (c("__key.kind") == c("__asked.kind")) & (c("__key.value") == c("__asked.value"))
    return wanted.join(keyed, same).drop("__key", "__asked")


def already_imported(pubs: DataFrame, batch: DataFrame, scopus: str = "ScopusId", eid: str = "eid") -> DataFrame:
    """Corpus rows whose identifier occurs in the batch."""
    return present_in(pubs, batch, scopus, eid)


def updatable(pubs: DataFrame, batch: DataFrame, doi: str = "doi", eid: str = "eid", any_case: bool = True) -> DataFrame:
    """(PID, DOI, eid): batch records found by DOI that are not yet imported."""
    fresh = absent_from(batch, pubs.where(c("ScopusId").isNotNull()), eid, "ScopusId").select(c(eid).alias("eid"), c(doi).alias("__doi"))
    known = pubs.where(c("DOI").isNotNull()).select("PID", "DOI")
    if any_case:
        return by_lower(known, fresh, "DOI", "__doi").select("PID", "DOI", "eid")
    return known.join(fresh, known["DOI"] == c("__doi")).select("PID", "DOI", "eid")


def importable(pubs: DataFrame, batch: DataFrame, doi: str = "doi", eid: str = "eid") -> DataFrame:
    """Batch records that are neither imported nor found by DOI."""
    fresh = absent_from(batch, pubs.where(c("ScopusId").isNotNull()), eid, "ScopusId")
    known = pubs.where(c("DOI").isNotNull()).select(F.lower("DOI").alias("__known"))
    return fresh.join(known, F.lower(fresh[doi]) == c("__known"), "left_anti")


def with_import_group(batch: DataFrame, subtype: str = "subtype") -> DataFrame:
    """Label for the separate import files."""
    label = (
        F.when(c(subtype) == "Conference Paper", "conference")
        .when(c(subtype) == "Article", "article")
        .when(c(subtype) == "Erratum", "erratum")
        .otherwise("other")
    )
    return batch.withColumn("import_group", label)


def type_table(batch: DataFrame, aggregation: str = "aggregation", subtype: str = "subtype") -> DataFrame:
    """Batch records per type combination, with the genre they import as."""
    n = batch.groupBy(aggregation, subtype).agg(F.count(F.lit(1)).alias("n"))
    return with_genre(n, aggregation, subtype)


def authors_of_institution(authors: DataFrame, affiliations: DataFrame, pubs: DataFrame, prefix: str) -> DataFrame:
    """Batch authors whose affiliation name starts with ``prefix``, with the record."""
    mine = affiliations.where(c("affilname").startswith(prefix))
    return authors.join(mine, ["sid", "afid"]).join(pubs, "sid", "left")


def due_for_import(batch: DataFrame, pubs: DataFrame, as_of: dt.date, eid: str = "eid", cover: str = "cover_date") -> DataFrame:
    """Not in the corpus and with a cover date that has come."""
    return absent_from(batch, pubs.where(c("ScopusId").isNotNull()), eid, "ScopusId").where(c(cover) <= F.lit(as_of))


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(c(key).cast("string")), F.lit(buckets)).cast("int")


def snapshot_digests(table: DataFrame, key: str, columns: list[str], buckets: int) -> DataFrame:
    """(bucket, n, d0, d1): rows of each bucket of keys and the sums of two 64-bit hashes of their cells.

    Digests of a snapshot can be kept beside it, so that a later comparison doesn't read its rows.
    """
    cells = [c(x).cast("string") for x in [key, *columns]]
    # a missing cell is told from an empty one, and sums, unlike exclusive or, tell repeated rows
    marked = [F.coalesce(F.concat(F.lit("="), x), F.lit("-")) for x in cells]
    total = lambda salt: F.sum(F.xxhash64(F.lit(salt), *marked).cast("decimal(38,0)"))
    rows = table.select(_bucket(key, buckets).alias("bucket"), key, *[x for x in columns if x != key])
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), total(0).alias("d0"), total(1).alias("d1"))


def differing_buckets(old: DataFrame, new: DataFrame) -> DataFrame:
    """(bucket) of every bucket whose digests are not the same on both sides.

    Two different buckets would pass for equal with a chance of about one in 2**128.
    """
    both = old.withColumn("side", F.lit(1)).unionByName(new.withColumn("side", F.lit(-1)))
    return both.groupBy("bucket", "n", "d0", "d1").agg(F.sum("side").alias("balance")).where("balance != 0").select("bucket").distinct()


def snapshot_changes(
    old: DataFrame, new: DataFrame, key: str, columns: list[str], buckets: int = 4096, old_digests: DataFrame | None = None
) -> DataFrame:
    """(key, change, field, old, new): added and removed rows, changed cells.

    Both snapshots are digested by buckets of keys, without a shuffle of rows; only rows of buckets that differ are joined.
    """
    parts = old_digests if old_digests is not None else snapshot_digests(old, key, columns, buckets)
    differing = cut_lineage(differing_buckets(parts, snapshot_digests(new, key, columns, buckets)), "differing")

    def side(table: DataFrame, tag: str) -> DataFrame:
        rows = table.withColumn("__bucket", _bucket(key, buckets)).join(differing, c("__bucket") == c("bucket"), "left_semi")
        return rows.select(key, F.struct(*[c(x).cast("string").alias(x) for x in columns]).alias(tag))

    both = side(old, "a").join(side(new, "b"), key, "full")
    cells = F.filter(
        F.array(
            *[
                F.struct(F.lit(x).alias("field"), c(f"a.{x}").alias("old"), c(f"b.{x}").alias("new"))
                for x in columns
            ]
        ),
        lambda x: ~x["old"].eqNullSafe(x["new"]),
    )
    none = F.lit(None).cast("string")
    whole = F.array(F.struct(none.alias("field"), none.alias("old"), none.alias("new")))
    change = F.when(c("a").isNull(), "added").when(c("b").isNull(), "removed").otherwise("changed")
    rows = both.select(key, change.alias("change"), F.when(change == "changed", cells).otherwise(whole).alias("x"))
    return rows.select(key, "change", F.explode("x").alias("x")).select(key, "change", "x.field", "x.old", "x.new")


def missing_places(rows: DataFrame, places: DataFrame, place: str, ignored: list[DataFrame], record: str) -> DataFrame:
    """Distinct records per place without coordinates, minus the listed exceptions."""
    open_rows = rows.join(places, place, "left").where(c("lat").isNull())
    left = reduce(lambda t, x: t.join(x.select(place), place, "left_anti"), ignored, open_rows)
    return left.groupBy(place).agg(F.count_distinct(record).alias("n"))


def issue_texts(rows: DataFrame, person: str, record: str, portal: str) -> DataFrame:
    """Checklist text per person, one line per record, in pieces."""
    line = F.concat(F.lit("- [ ] "), address(c(record), "PID", portal))
    return collapse(rows.select(person, line.alias("__line")), [person], "__line", "text", "\n")


def programme_projects(programmes: dict[str, DataFrame], organisations: dict[str, DataFrame], cost: str = "cost") -> DataFrame:
    """Project tables of several programmes, kept where an own organisation
    takes part, with the decimal comma of the cost column read."""
    parts = []
    for name, projects in programmes.items():
        mine = present_in(projects, organisations[name], "id", "project_id")
        parts.append(
            mine.withColumns(
                {"programme": F.lit(name), cost: F.replace(c(cost).cast("string"), F.lit(","), F.lit(".")).try_cast("double")}
            )
        )
    return stack(*parts)


def wrangle_projects(
    raw: DataFrame, mapping: dict[str, str], departments: DataFrame | None = None, schools: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Mapped, dated projects and the rows whose dates could not be read."""
    named, _ = rename_by_mapping(raw, mapping)
    day = lambda x: F.try_to_date(F.substr(c(x), F.lit(1), F.lit(10)))
    dated = named.withColumns({"__beg": day("beg"), "__end": day("end")})
    problems = stack(
        *[
            dated.where(c(x).isNotNull() & c(f"__{x}").isNull()).select(
                "id", F.lit(x).alias("field"), c(x).alias("value")
            )
            for x in ("beg", "end")
        ]
    )
    out = dated.withColumns({"beg": c("__beg"), "end": c("__end"), "duration": F.datediff("__end", "__beg")}).drop("__beg", "__end")
    if departments is not None:
        out = out.join(departments, "department", "left")
    if schools is not None:
        out = out.join(schools, "school", "left")
    return out, problems


def resolve_funders(funders: DataFrame, lookup: DataFrame, vat: str = "vat") -> DataFrame:
    """One entry per VAT number from the lookup, joined back; blanks and dots in
    the number do not matter."""
    bare = lambda x: F.regexp_replace(F.upper(x), r"[\s.]", "")
    keyed = lookup.withColumn("__v", bare(c(vat)))
    single = first_row(keyed, ["__v"], [c("name"), c("funder_id")]).select("__v", c("name").alias("funder"), "funder_id")
    return funders.withColumn("__v", bare(c(vat))).join(single, "__v", "left").drop("__v")
