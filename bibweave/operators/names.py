"""Author name strings to rows.

A record's string lists authors separated by ``;``, each with optional ids in
brackets and affiliations in parentheses, which may nest and may contain ``;``
themselves. Everything is an expression over the record's own row: no shuffle,
no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bibweave.functions.identifiers import ORCID_IN_TEXT
from bibweave.operators.groups import collapse, with_group_values
from bibweave.session import cut_lineage

c = F.col
ET_AL = r";?\s*et al\.?,?"
NAME_END = r"^([^(\[|]*)"


def balanced(depth: int) -> str:
    """Pattern of a parenthesised group with at most ``depth`` inner levels.

    Possessive repeats keep the matcher from backtracking through long texts.
    """
    inner = r"\([^()]*+\)"
    for _ in range(depth):
        inner = rf"\((?:[^()]++|{inner})*+\)"
    return inner


# Stand for the parentheses of an outermost group; no text has these characters of the private use area.
OPEN, CLOSE = "\ue000", "\ue001"
GROUP = rf"{OPEN}[^{CLOSE}]*+{CLOSE}"
# A range of the two marks: a class that lists single characters outside Latin-1 takes ten times as long.
PIECE = rf"((?:[^;{OPEN}-{CLOSE}]++|{GROUP})++)"
_SHALLOW = balanced(3)


def _matched(tokens: Column) -> Column:
    """Outermost pairs (o, c) of matching parentheses among tokens, by their places; ones without a partner are text."""
    state = F.struct(F.expr("cast(array() as array<int>)").alias("open"), F.expr("cast(array() as array<struct<o: int, c: int>>)").alias("pairs"))
    places = F.sequence(F.lit(1), F.size(tokens))

    def step(s: Column, i: Column) -> Column:
        token, last = F.element_at(tokens, i), F.element_at(s["open"], -1)
        # what a pair encloses is no outermost pair any more
        outer = F.concat(F.filter(s["pairs"], lambda p: p["o"] < last), F.array(F.struct(last.alias("o"), i.alias("c"))))
        return F.when(token == "(", F.struct(F.array_append(s["open"], i).alias("open"), s["pairs"].alias("pairs"))).when(
            (token == ")") & (F.size(s["open"]) > 0),
            F.struct(F.slice(s["open"], F.lit(1), F.size(s["open"]) - 1).alias("open"), outer.alias("pairs"))).otherwise(s)

    return F.aggregate(places, state, step, lambda s: s["pairs"])


def with_groups_marked(col: Column) -> Column:
    """The text with the parentheses of every outermost group replaced by ``OPEN`` and ``CLOSE``, however deep groups nest.

    Groups of a few levels are found by a pattern; a text that has parentheses left beside those is read token by token.
    """
    tokens = F.regexp_extract_all(col, F.lit(r"[()]|[^()]++"), F.lit(0))
    mark = lambda pairs: F.array_join(F.transform(tokens, lambda t, i: F.when(
        F.exists(pairs, lambda p: p["o"] == i + 1), OPEN).when(F.exists(pairs, lambda p: p["c"] == i + 1), CLOSE).otherwise(t)), "")
    shallow = F.regexp_replace(col, rf"\(((?:[^()]++|{_SHALLOW})*+)\)", f"{OPEN}$1{CLOSE}")
    deep = F.get(F.transform(F.array(_matched(tokens)), mark), F.lit(0))
    return F.when(F.regexp_replace(shallow, GROUP, "").rlike(r"[()]"), deep).otherwise(shallow)


def _all(col: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(col, F.lit(pattern), F.lit(group))


def _joined(values: Column) -> Column:
    return F.nullif(F.array_join(values, " "), F.lit(""))


def _first(col: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(col, pattern, group), F.lit(""))


def without_et_al(col: Column) -> Column:
    return F.regexp_replace(col, ET_AL, "")


def _author(piece: Column, outside: Column, home: str) -> Column:
    """One author's struct: name, ids and affiliation groups; ``outside`` is the piece without its groups."""
    bare = lambda g: F.regexp_replace(g, rf"^{OPEN}\s*|\s*{CLOSE}$", "")
    groups = F.filter(F.transform(_all(piece, GROUP), bare), lambda g: F.length(g) > 0)
    name = F.trim(F.regexp_extract(F.translate(piece, OPEN, "("), NAME_END, 1))
    affiliation = lambda g: F.struct(
        g.alias("text"),
        F.size(F.split(g, ";")).alias("n_aff"),
        _all(g, r"\[(\d+)\]", 1).alias("orgs"),
        (~g.contains(home)).alias("is_extorg"),
    )
    return F.struct(
        name.alias("name"),
        _joined(_all(outside, r"\[(u1.{6})\]", 1)).alias("staffid"),
        _first(outside, rf"\[({ORCID_IN_TEXT})\]").alias("orcid"),
        _joined(_all(outside, r"\[(\d+)\]", 1)).alias("own_orgids"),
        F.transform(groups, affiliation).alias("affs"),
    )


def split_authors(pubs: DataFrame, record: str = "PID", column: str = "Name", home: str = "Home") -> DataFrame:
    """(record, uses_etal, authors): the record's authors as an array of structs."""
    rows = pubs.where(F.col(record).isNotNull() & F.col(column).isNotNull())
    pieces = F.filter(
        F.transform(_all(c("__marked"), PIECE, 1), F.trim), lambda p: F.length(p) > 0
    )
    # one element, so that the optimizer copies neither the marking into every use nor the authors into a filter of who explodes them
    rows = rows.withColumn("__marked", F.explode(F.array(with_groups_marked(without_et_al(c(column))))))
    parts = F.transform(pieces, lambda p: F.struct(p.alias("piece"), F.regexp_replace(p, GROUP, "").alias("outside")))
    return rows.select(
        record,
        F.coalesce(F.col(column).rlike(ET_AL), F.lit(False)).alias("uses_etal"),
        F.explode(F.array(F.transform(parts, lambda p: _author(p["piece"], p["outside"], home)))).alias("authors"),
    )


def parse_names(pubs: DataFrame, record: str = "PID", column: str = "Name", home: str = "Home") -> DataFrame:
    """One row per author and external affiliation.

    Affiliations belong to the name, and the org ids of an author with an own
    affiliation are the union over the record. A record without any
    affiliation keeps the ids found next to the names.
    """
    split = split_authors(pubs, record, column, home)
    affs = F.flatten(
        F.transform(
            "authors",
            lambda a: F.transform(a["affs"], lambda g: F.struct(a["name"].alias("name"), g.alias("g"))),
        )
    )
    own = F.filter("affs", lambda x: ~x["g"]["is_extorg"])
    ordered = F.array_sort(
        F.transform(own, lambda x, i: F.struct(x["name"].alias("n"), i.alias("i"), x["g"]["orgs"].alias("o")))
    )
    with_affs = split.withColumn("affs", affs)
    with_affs = with_affs.withColumn(
        "record_orgs", F.array_distinct(F.flatten(F.transform(ordered, lambda x: x["o"])))
    )
    rows = with_affs.select(
        record, "uses_etal", "affs", "record_orgs", F.posexplode("authors").alias("pos", "a")
    )
    mine = F.filter("affs", lambda x: x["name"] == F.col("a.name"))
    rows = rows.withColumns({"mine": mine, "none": F.size("affs") == 0})
    inner = F.filter("mine", lambda x: ~x["g"]["is_extorg"])
    outer = F.filter("mine", lambda x: x["g"]["is_extorg"])
    n_own = F.aggregate(inner, F.lit(0), lambda acc, x: acc + x["g"]["n_aff"])
    rows = rows.withColumns({"n_aff_own": F.when(F.size(inner) > 0, n_own), "ext": F.explode_outer(outer)})
    orgs = F.when(F.col("none"), F.col("a.own_orgids")).when(
        F.col("n_aff_own").isNotNull(), _joined(F.col("record_orgs"))
    )
    return rows.select(
        record,
        (F.col("pos") + 1).alias("pos"),
        F.col("a.name").alias("name"),
        F.col("a.staffid").alias("staffid"),
        F.col("a.orcid").alias("orcid"),
        orgs.alias("orgids"),
        F.col("ext.g.text").alias("extorg"),
        "uses_etal",
        F.col("ext.g.n_aff").alias("n_aff_ext"),
        "n_aff_own",
    )


PERSON = ["staffid", "orcid", "name", "extorg"]


def parse_records(pubs: DataFrame, record: str = "PID", column: str = "Name", home: str = "Home") -> DataFrame:
    """Parsed names with the number of records each person combination has.

    The parsed rows are written to the shared folder: they are counted and then met with their counts, and parsing is the cost.
    """
    rows = cut_lineage(parse_names(pubs, record, column, home), "names")
    return with_group_values(rows, PERSON, n_pid=F.count_distinct(F.col(record)))


def person_records(parsed: DataFrame, record: str = "PID") -> DataFrame:
    """Record lists per person combination, in pieces."""
    return collapse(parsed, PERSON, record, "pids")


def parse_simple_names(pubs: DataFrame, record: str = "PID", column: str = "Name") -> DataFrame:
    """The simple reading: every ``;`` separates, ids are picked per piece, and
    the external organisation is a last group without inner brackets."""
    pieces = F.split(without_et_al(F.col(column)), ";")
    rows = pubs.select(
        record,
        F.coalesce(F.col(column).rlike(ET_AL), F.lit(False)).alias("has_etal"),
        F.posexplode(pieces).alias("pos", "Name"),
    )
    n = F.col("Name")
    return rows.select(
        record, (F.col("pos") + 1).alias("pos"), n.alias("Name"),
        F.trim(F.regexp_extract(n, NAME_END, 1)).alias("name_only"),
        _joined(_all(n, r"\[(u1.{6})\]", 1)).alias("staffid"),
        _first(n, rf"\[({ORCID_IN_TEXT})\]").alias("orcid"),
        _joined(_all(n, r"\[(\d+)\]", 1)).alias("orgids"),
        _first(n, r"\(([^(\[|]*)\)$").alias("extorg"),
        "has_etal",
    )


def organisation_combinations(pubs: DataFrame, record: str = "PID", column: str = "Name", year: str = "Year", home: str = "Home") -> DataFrame:
    """Distinct (year, org ids, unit text) of the own affiliations."""
    split = split_authors(pubs, record, column, home).join(pubs.select(record, year), record)
    group = F.explode(F.flatten(F.transform("authors", lambda a: a["affs"])))
    rows = split.select(year, group.alias("g")).where(~F.col("g.is_extorg"))
    text = F.trim(F.regexp_replace(F.regexp_replace("g.text", r"\s*\[\d+\]", ""), r"\s+", " "))
    return rows.select(year, _joined(F.col("g.orgs")).alias("orgids"), text.alias("units")).distinct()
