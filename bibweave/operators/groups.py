"""Grouped results that stay bounded when one group holds much of the table.

Counts, sums, minima and distinct counts are merged before the shuffle, so a
hot key costs one row per task. Three things are not, and are built here from
parts that are: a count kept on the detail rows, one chosen row per group, and
a group's values collapsed into a string.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from bibweave.functions.nulls import nullsafe_join

PIECE_SIZE = 5000


def counts(df: DataFrame, keys: list[str], name: str = "n", at_least: int = 1) -> DataFrame:
    """Rows per key, optionally only the keys with ``at_least`` rows."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return out.where(F.col(name) >= at_least) if at_least > 1 else out


def with_count(df: DataFrame, keys: list[str], name: str = "n", at_least: int = 1) -> DataFrame:
    """Keep the group's count on every row.

    An aggregate joined back, not a window: the count has one row per key, so
    a hot key is split by adaptive skew handling instead of being sorted whole
    in one task.
    """
    return nullsafe_join(df, counts(df, keys, name, at_least), keys)


def with_group_values(df: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    """Keep several group aggregates on every row."""
    per_group = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])
    return nullsafe_join(df, per_group, keys)


def first_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``; ranks are pruned before the shuffle."""
    return top_rows(df, keys, order, 1)


def top_rows(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str | None = None) -> DataFrame:
    """First ``n`` rows per key. Spark cuts each task to ``n`` rows per key
    before shuffling (window group limit), so the group size does not matter."""
    name = rank or "__rank"
    out = df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    out = out.where(F.col(name) <= n)
    return out if rank else out.drop(name)


def extremes(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """First and last row of every ordered group, marked ``first``/``last``."""
    body = F.struct(*df.columns)
    ends = df.groupBy(*keys).agg(
        F.min_by(body, order).alias("lo"), F.max_by(body, order).alias("hi")
    )
    pair = F.explode(
        F.array(
            F.struct(F.lit("first").alias("end"), F.col("lo").alias("row")),
            F.struct(F.lit("last").alias("end"), F.col("hi").alias("row")),
        )
    )
    return ends.select(pair.alias("p")).select("p.end", "p.row.*")


def with_piece(pairs: DataFrame, keys: list[str], value: str, size: int = PIECE_SIZE) -> DataFrame:
    """Number the piece each distinct (key, value) belongs to.

    Groups of up to ``size`` values have the single piece 0. A larger group is
    divided by a hash of the value, so no task ever holds it whole and no value
    is left out. Only the oversized keys are joined back, which is a small table
    (at most rows / size keys).
    """
    large = counts(pairs, keys, "__n").where(F.col("__n") > size)
    marked = nullsafe_join(pairs, large, keys, "left")
    spread = F.pmod(F.xxhash64(F.col(value)), F.ceil(F.col("__n") / size).cast("bigint"))
    return marked.withColumn("piece", F.coalesce(spread, F.lit(0)).cast("int")).drop("__n")


def collapse(
    df: DataFrame,
    keys: list[str],
    value: str,
    name: str,
    sep: str = " ",
    size: int = PIECE_SIZE,
    keep_missing: bool = False,
) -> DataFrame:
    """Distinct values per key as sorted, separated text: (keys, piece, name).

    With ``keep_missing`` a missing value is listed last as ``NA``.
    """
    pairs = df.select(*keys, value).distinct()
    if not keep_missing:
        pairs = pairs.where(F.col(value).isNotNull())
    pieces = with_piece(pairs, keys, value, size)
    return pieces.groupBy(*keys, "piece").agg(joined_sorted(F.col(value), sep).alias(name))


def joined_sorted(value: Column, sep: str) -> Column:
    """Aggregate: the group's values sorted, missing last as ``NA``, joined."""
    pair = F.struct(value.isNull().alias("m"), value.alias("v"))
    ordered = F.array_sort(F.collect_list(pair))
    return F.array_join(
        F.transform(ordered, lambda p: F.coalesce(p["v"].cast("string"), F.lit("NA"))), sep
    )


def joined_in_order(df: DataFrame, keys: list[str], text: str, position: str, name: str, sep: str = "", block: int = 1000) -> DataFrame:
    """Texts of a group joined in order of ``position``.

    Blocks of positions are joined first, so the second step sees one short
    string per thousand members.
    """
    blocks = (
        df.withColumn("__b", F.floor(F.col(position) / block))
        .groupBy(*keys, "__b")
        .agg(F.array_sort(F.collect_list(F.struct(position, text))).alias("__l"))
        .select(*keys, "__b", F.array_join(F.transform("__l", lambda x: x[text]), sep).alias("__t"))
    )
    return blocks.groupBy(*keys).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("__b", "__t"))), lambda x: x["__t"]), sep
        ).alias(name)
    )


def initials(authors: DataFrame, record: str = "PID", name: str = "name", position: str = "pos") -> DataFrame:
    """First letter of every author's last name, in author order, per record."""
    last = F.regexp_replace(F.col(name), "(.+?)(,.*)", "$1")
    letter = F.coalesce(F.substr(last, F.lit(1), F.lit(1)), F.lit("NA"))
    return joined_in_order(
        authors.select(record, position, letter.alias("letter")), [record], "letter", position, "initials"
    )


def most_frequent(df: DataFrame, keys: list[str], value: str, first_seen: str, name: str = "mode") -> DataFrame:
    """Most frequent value per key; a tie goes to the value seen first."""
    tallies = df.groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("__n"), F.min(first_seen).alias("__at")
    )
    return tallies.groupBy(*keys).agg(
        F.min_by(F.col(value), F.struct(-F.col("__n"), F.col("__at"))).alias(name)
    )


def collapse_strings(df: DataFrame, keys: list[str], sep: str = "; ", size: int = PIECE_SIZE) -> DataFrame:
    """All string columns of a group collapsed to their distinct values; an
    empty result is missing. Columns are packed one by one and joined on the
    key and piece, so each column may be large in its own way."""
    texts = [n for n, t in df.dtypes if t == "string" and n not in keys]
    parts = [collapse(df, keys, c, c, sep, size) for c in texts]
    wide = reduce(lambda a, b: nullsafe_outer(a, b, [*keys, "piece"]), parts)
    return wide.select(*keys, "piece", *[F.nullif(F.col(c), F.lit("")).alias(c) for c in texts])


def nullsafe_outer(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join on keys where missing matches missing."""
    tagged = right.select(
        *[F.col(k).alias(f"__r_{k}") for k in keys],
        *[F.col(c) for c in right.columns if c not in keys],
        F.lit(True).alias("__right"),
    )
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    both = left.withColumn("__left", F.lit(True)).join(tagged, cond, "full")
    return both.select(
        *[F.when(F.col("__left"), F.col(k)).otherwise(F.col(f"__r_{k}")).alias(k) for k in keys],
        *[c for c in left.columns if c not in keys],
        *[c for c in right.columns if c not in keys],
    )


def presence(df: DataFrame) -> DataFrame:
    """Non-missing values per column, one row, one scan."""
    return df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])


def separator_hits(df: DataFrame, sep: str = "; ") -> DataFrame:
    """Occurrences of a separator per string column, one row, one scan."""
    texts = [n for n, t in df.dtypes if t == "string"]
    hit = lambda c: (F.length(c) - F.length(F.replace(c, F.lit(sep), F.lit("")))) / len(sep)
    return df.agg(
        *[F.coalesce(F.sum(hit(F.col(f"`{c}`"))), F.lit(0)).cast("bigint").alias(c) for c in texts]
    )


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, value) row counts of a set of tables, as one union of aggregates."""
    parts = [
        t.agg(F.count(F.lit(1)).alias("value")).select(F.lit(n).alias("name"), "value")
        for n, t in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)
