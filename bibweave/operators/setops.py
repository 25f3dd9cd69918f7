"""Set operations and comparison reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from bibweave.operators.groups import with_group_values


def stack(*tables: DataFrame) -> DataFrame:
    """All rows; a column a table lacks is missing there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def union_distinct(*tables: DataFrame) -> DataFrame:
    return stack(*tables).distinct()


def compare_pairs(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Every distinct (key, value) of two tables with its status: ``same`` in
    both, only ``left`` or only ``right``, or ``differs`` where the other table
    has the key with other values. Grows with the pairs, never with their product."""
    tag = lambda t, l, r: t.select(key, value, F.lit(l).alias("in_left"), F.lit(r).alias("in_right"))
    pairs = (
        tag(left, 1, 0)
        .unionByName(tag(right, 0, 1))
        .groupBy(key, value)
        .agg(F.max("in_left").alias("in_left"), F.max("in_right").alias("in_right"))
    )
    known = with_group_values(
        pairs, [key], key_left=F.max("in_left"), key_right=F.max("in_right")
    )
    status = (
        F.when(F.col("in_left") + F.col("in_right") == 2, "same")
        .when(F.col("key_left") + F.col("key_right") == 2, "differs")
        .when(F.col("in_left") == 1, "left")
        .otherwise("right")
    )
    return known.select(key, value, "in_left", "in_right", status.alias("status"))


def in_report_order(df: DataFrame, order: list[str]) -> DataFrame:
    """Sort as reports do: ``-name`` descends; missing values come last."""
    cols = [
        F.col(o[1:]).desc_nulls_last() if o.startswith("-") else F.col(o).asc_nulls_last() for o in order
    ]
    return df.orderBy(*cols)


def by_length(values: Column) -> Column:
    """Array sorted by text length, then alphabetically."""
    keyed = F.transform(values, lambda v: F.struct(F.length(v).alias("n"), v.alias("v")))
    return F.transform(F.array_sort(keyed), lambda k: k["v"])
