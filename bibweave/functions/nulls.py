"""Missing-value rules shared by all operators.

Missing equals missing in joins and grouping, a negated pattern or membership
test keeps missing values, and distinct counts may or may not count a missing
value. Spark's defaults differ on each point, so the rules are named here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def matching(col: Column, pattern: str) -> Column:
    """Pattern test that is false, not null, on a missing value."""
    return F.coalesce(col.rlike(pattern), F.lit(False))


def not_matching(col: Column, pattern: str) -> Column:
    """Negated pattern test; rows with a missing value stay."""
    return ~matching(col, pattern)


def not_in(col: Column, values: list) -> Column:
    """Negated membership test; rows with a missing value stay."""
    return ~F.coalesce(col.isin(values), F.lit(False))


def n_distinct(col: Column, na_rm: bool = False) -> Column:
    """Distinct count; a missing value counts once unless ``na_rm``."""
    counted = F.count_distinct(col)
    if na_rm:
        return counted
    return counted + F.coalesce(F.max(col.isNull().cast("int")), F.lit(0)).cast("bigint")


def paste(*cols: Column, sep: str = "") -> Column:
    """Concatenate with the text ``NA`` standing for a missing piece."""
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("NA")) for c in cols])


def paste_present(*cols: Column, sep: str = "_") -> Column:
    """Concatenate only the pieces that are present."""
    return F.concat_ws(sep, *cols)


def same_key(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality on every key. Spark still plans an equi join."""
    return reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys]
    )


def nullsafe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys where missing matches missing; key columns appear once."""
    marked = right.select(
        *[F.col(k).alias(f"__r_{k}") for k in keys],
        *[F.col(c) for c in right.columns if c not in keys],
    )
    cond = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    )
    return left.join(marked, cond, how).drop(*[f"__r_{k}" for k in keys])


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on all columns the two sides share."""
    keys = [c for c in left.columns if c in right.columns]
    return nullsafe_join(left, right, keys, how)


def strip_empty(df: DataFrame) -> DataFrame:
    """Empty strings become missing in every string column."""
    return df.select(
        *[
            F.nullif(F.col(f"`{n}`"), F.lit("")).alias(n) if t == "string" else F.col(f"`{n}`")
            for n, t in df.dtypes
        ]
    )


def strip_short(df: DataFrame, columns: list[str], least: int = 2) -> DataFrame:
    """Strings shorter than ``least`` characters become missing."""
    return df.withColumns(
        {c: F.when(F.length(F.col(c)) >= least, F.col(c)) for c in columns}
    )
