"""Node and relation files for a graph database's bulk import."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bibweave.session import cut_lineage

c = F.col


def node_header(
    columns: list[str], id_field: str, label_field: str | None = None, arrays: list[str] = (),
    ignore: list[str] = (), namespace: str | None = None,
) -> str:
    """Header line of a node file from the roles of its columns."""
    required = [id_field, *arrays, *([label_field] if label_field else [])]
    _present(columns, required)
    role = {a: f"{a}:STRING[]" for a in arrays}
    role |= {i: f"{i}:IGNORE" for i in ignore if i not in required}
    if label_field:
        role[label_field] = f"{label_field}:LABEL"
    role[id_field] = f"{id_field}:ID({namespace})" if namespace else f"{id_field}:ID"
    return ",".join(role.get(x, x) for x in columns)


def relation_header(
    columns: list[str], type_field: str, src_field: str, dst_field: str, ignore: list[str] = (), arrays: list[str] = ()
) -> str:
    """Header line of a relation file; the three roles need three columns."""
    required = [src_field, dst_field, type_field]
    if len(set(required)) != 3:
        raise ValueError("source, target and type must be three columns")
    _present(columns, [*required, *arrays])
    role = {a: f"{a}:STRING[]" for a in arrays}
    role |= {i: f"{i}:IGNORE" for i in ignore if i not in required}
    role |= {type_field: f"{type_field}:TYPE", src_field: f"{src_field}:START_ID", dst_field: f"{dst_field}:END_ID"}
    return ",".join(role.get(x, x) for x in columns)


def _present(columns: list[str], needed: list[str]) -> None:
    absent = [n for n in needed if n not in columns]
    if absent:
        raise ValueError(f"columns not in the table: {absent}")


def author_nodes(authors: DataFrame, columns: list[str]) -> DataFrame:
    """Authors with a synthetic id that depends on the row's content only, so a
    rerun or a lost task gives the same ids. Equal rows are one node; they meet
    without their ids, which are longer than the rows."""
    return _with_ids(authors.select(*columns).distinct())


def _with_ids(rows: DataFrame) -> DataFrame:
    key = F.concat(F.lit("m"), F.sha2(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}), 256))
    return rows.select(key.alias("mid"), "*", F.lit("Author").alias("label"))


def write_nodes(df: DataFrame, folder: str, name: str, header: str) -> None:
    """Data files (gzip) without a header next to a one-line header file."""
    df.write.mode("overwrite").options(
        compression="gzip", header=False, nullValue="", emptyValue="", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(f"{folder}/{name}")
    spark = df.sparkSession
    spark.createDataFrame([(header,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/{name}-header")


def bulk_extract(pubs: DataFrame, authors: DataFrame, folder: str) -> dict[str, str]:
    """Publication nodes, author nodes and relations; returns the headers.

    Distinct author rows are written once to the shared folder, nodes and relations are both made from there.
    """
    nodes = pubs.drop("Abstract").withColumn("label", F.lit("Publication"))
    columns = [x for x in ("PID", "staffid", "name", "orcid", "orgid", "extorg") if x in authors.columns]
    people = _with_ids(cut_lineage(authors.select(*columns).distinct(), "people"))
    rels = people.select("PID", "mid", *[x for x in people.columns if x not in ("PID", "mid", "label")]).withColumn(
        "reltype", F.lit("AUTHOR")
    )
    many = [x for x in ("Keywords", "Name", "Contributor") if x in nodes.columns]
    headers = {
        "pubs": node_header(nodes.columns, "PID", "label", many),
        "authors": node_header(people.columns, "mid", "label"),
        "rels": relation_header(rels.columns, "reltype", "PID", "mid", ignore=["extorg"]),
    }
    for name, df in (("pubs", nodes), ("authors", people), ("rels", rels)):
        write_nodes(df, folder, name, headers[name])
    return headers
