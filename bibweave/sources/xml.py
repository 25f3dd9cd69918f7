"""XML in string columns and XML collection files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def nodes(doc: Column, path: str) -> Column:
    """Texts of all nodes of a path. Prefixed tags are written with
    ``local-name()`` by the caller."""
    return F.xpath(doc, F.lit(f"{path}/text()"))


def single_node(doc: Column, path: str) -> Column:
    """Text of the only node of a path; none or several give a missing value."""
    found = nodes(doc, path)
    return F.when(F.size(found) == 1, found[0])


def every_node(doc: Column, path: str, sep: str = " ") -> Column:
    return F.nullif(F.array_join(nodes(doc, path), sep), F.lit(""))


def read_collection(spark: SparkSession, path: str, schema: T.StructType, row_tag: str = "mods") -> DataFrame:
    """One row per record element of collection files."""
    return (
        spark.read.format("xml")
        .option("rowTag", row_tag)
        .option("attributePrefix", "@")
        .option("valueTag", "#")
        .schema(schema)
        .load(path)
    )
