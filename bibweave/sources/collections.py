"""Rendered records to files: collections of a fixed number, or one per record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bibweave.operators.mods import COLLECTION_HEAD, COLLECTION_TAIL
from bibweave.operators.ordered import chunk_numbers

c = F.col


def collections(records: DataFrame, key: str, chunk: Column, size: int = 25, doc: str = "mods") -> DataFrame:
    """(part, n, value): collection documents of ``size`` records in key order."""
    numbered = chunk_numbers(records.select(key, doc), [key], chunk, size)
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, doc))), lambda x: x[doc]), "\n")
    return numbered.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.concat(F.lit(COLLECTION_HEAD), body, F.lit(COLLECTION_TAIL)).alias("value")
    )


def write_collections(parts: DataFrame, folder: str, prefix: str = "mods", compression: str = "none") -> str:
    """One file per collection, in a folder named by its number.

    ``parts`` has one row per collection, as ``collections`` gives them, so whole documents need not be shuffled once more.
    Records repeat the same tags: compressed files (``gzip``) take a small part of the room.
    """
    name = F.format_string(f"{prefix}_%02d", c("part"))
    parts.select(name.alias("collection"), "value").write.mode("overwrite").partitionBy("collection").options(
        lineSep="\n", compression=compression
    ).text(folder)
    return folder


def write_records(records: DataFrame, folder: str, key: str, doc: str = "mods") -> str:
    """One folder per record."""
    records.select(c(key).cast("string").alias("record"), c(doc).alias("value")).repartition("record").write.mode(
        "overwrite"
    ).partitionBy("record").text(folder)
    return folder
