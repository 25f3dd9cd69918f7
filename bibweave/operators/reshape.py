"""Renames, projections, pivots, explodes and splits."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from bibweave.operators.groups import presence, with_piece


def pick(df: DataFrame, first: list[str], rest: bool = False) -> DataFrame:
    """Project columns in the given order; names the table lacks are ignored.
    With ``rest`` all other columns follow."""
    lead = [c for c in first if c in df.columns]
    tail = [c for c in df.columns if c not in lead] if rest else []
    return df.select(*[F.col(f"`{c}`") for c in lead + tail])


def without(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*[c for c in names if c in df.columns])


def starting_with(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def rename_by_mapping(df: DataFrame, mapping: dict[str, str]) -> tuple[DataFrame, list[str]]:
    """Keep and rename the mapped columns; also return the names dropped."""
    known = [c for c in df.columns if c in mapping]
    unknown = [c for c in df.columns if c not in mapping]
    return df.select(*[F.col(f"`{c}`").alias(mapping[c]) for c in known]), unknown


def conform(df: DataFrame, schema: str, mapping: dict[str, str] | None = None) -> DataFrame:
    """View a table under a canonical schema: mapped names, missing columns null."""
    source = {v: k for k, v in (mapping or {}).items()}
    have = set(df.columns)
    out = []
    for f in T.StructType.fromDDL(schema).fields:
        name = source.get(f.name, f.name)
        col = F.col(f"`{name}`").try_cast(f.dataType) if name in have else F.lit(None).cast(f.dataType)
        out.append(col.alias(f.name))
    return df.select(*out)


def describe_columns(names: DataFrame, mapping: DataFrame, name: str = "name", described: str = "description") -> DataFrame:
    """Descriptions for column names, the name itself where none is known."""
    return names.join(mapping, name, "left").withColumn(
        described, F.coalesce(F.col(described), F.col(name))
    )


def longer(df: DataFrame, ids: list[str], values: list[str], name: str = "name", value: str = "value") -> DataFrame:
    return df.unpivot(ids, values, name, value)


def wider(df: DataFrame, ids: list[str], name: str, value: str, names: list[str], sep: str = "|") -> DataFrame:
    """Names to columns; several values of one cell are joined in value order.

    The names are given, so no job is needed to discover them. Repeated values
    are counted before the shuffle, and a key with very many values comes in
    pieces, numbered by ``piece``, like any collapsed group.
    """
    cells = (
        df.where(F.col(name).isin(names) & F.col(value).isNotNull())
        .groupBy(*ids, name, value)
        .agg(F.count(F.lit(1)).cast("int").alias("__times"))
    )

    def cell(n: str) -> Column:
        hit = F.when(F.col(name) == n, F.struct(F.col(value).alias("v"), F.col("__times").alias("t")))
        copies = F.transform(F.array_sort(F.collect_list(hit)), lambda x: F.array_repeat(x["v"].cast("string"), x["t"]))
        return F.nullif(F.array_join(F.flatten(copies), sep), F.lit("")).alias(n)

    return with_piece(cells, ids, value).groupBy(*ids, "piece").agg(*[cell(n) for n in names])


def record_columns(df: DataFrame, key: str, name: str, value: str, order: str, names: list[str], sep: str = "|") -> DataFrame:
    """Names to columns for the parts of single records, joined in part order.

    A record's parts come out of one text, so they are few by nature."""

    def cell(n: str) -> Column:
        hit = F.when(F.col(name) == n, F.struct(F.col(order).alias("r"), F.col(value).alias("v")))
        parts = F.transform(F.array_sort(F.collect_list(hit)), lambda x: x["v"].cast("string"))
        return F.nullif(F.array_join(parts, sep), F.lit("")).alias(n)

    return df.groupBy(key).agg(*[cell(n) for n in names])


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested structs to flat columns named by their path."""

    def leaves(schema: T.StructType, path: tuple[str, ...]):
        for f in schema.fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, here)
            else:
                yield here

    dotted = lambda p: ".".join(f"`{x}`" for x in p)
    return df.select(*[F.col(dotted(p)).alias(sep.join(p)) for p in leaves(df.schema, ())])


def split_rows(df: DataFrame, column: str, sep: str, keep_missing: bool = True) -> DataFrame:
    """One row per separated piece; a missing text stays as one row unless told otherwise."""
    spread = F.explode_outer if keep_missing else F.explode
    return df.withColumn(column, spread(F.split(F.col(column), sep)))


def unnest(df: DataFrame, columns: list[str], keep_empty: bool = False) -> DataFrame:
    """Explode parallel arrays together; an array of length one is recycled."""
    longest = reduce(F.greatest, [F.size(c) for c in columns]) if len(columns) > 1 else F.size(columns[0])
    grown = {
        c: F.when((F.size(c) == 1) & (longest > 1), F.array_repeat(F.col(c)[0], longest)).otherwise(F.col(c))
        for c in columns
    }
    spread = F.explode_outer if keep_empty else F.explode
    zipped = F.arrays_zip(*[grown[c].alias(c) for c in columns])
    out = df.withColumn("__z", spread(zipped))
    return out.withColumns({c: F.col("__z")[c] for c in columns}).drop("__z")


def split_columns(df: DataFrame, column: str, into: list[str], sep: str = r"\|") -> DataFrame:
    """Separated text into fixed columns; pieces that are absent are missing."""
    parts = F.split(F.col(column), sep)
    return df.withColumns(
        {n: F.try_element_at(parts, F.lit(i)) for i, n in enumerate(into, 1)}
    ).drop(column)


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns without any value. Runs one aggregate to find them."""
    seen = presence(df).first()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if seen[c]])


def recode(col: Column, pairs: dict[str, str]) -> Column:
    """Replace listed values, keep the others."""
    out = None
    for old, new in pairs.items():
        out = F.when(col == old, new) if out is None else out.when(col == old, new)
    return out.otherwise(col)


def tidy_names(df: DataFrame) -> DataFrame:
    """Column names with ``.``, ``:`` and ``-`` as underscores and no ``@``."""
    return df.toDF(*[re.sub("[.:-]", "_", c).replace("@", "") for c in df.columns])
