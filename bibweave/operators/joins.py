"""Join shapes that are more than one call of ``DataFrame.join``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bibweave.functions.nulls import nullsafe_join

#: Rows of a run in ``above``.
RUN = 64


def lookup(df: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Left join against a lookup table. No hint: Spark broadcasts it when its
    measured size is below the session's limit and shuffles it otherwise."""
    return df.join(table, keys, "left")


def absent_from(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows whose key does not occur in the other table; a missing key stays."""
    right = other.select(F.col(other_key or key).alias("__k"))
    return df.join(right, df[key] == right["__k"], "left_anti")


def present_in(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    right = other.select(F.col(other_key or key).alias("__k"))
    return df.join(right, df[key] == right["__k"], "left_semi")


def by_lower(df: DataFrame, other: DataFrame, key: str, other_key: str, how: str = "inner") -> DataFrame:
    """Case-insensitive equality; the right key column is dropped."""
    right = other.withColumn("__k", F.lower(F.col(other_key))).drop(other_key)
    return df.join(right, F.lower(df[key]) == F.col("__k"), how).drop("__k")


def with_parent(df: DataFrame, key: str, parent_key: str, value: str, name: str) -> DataFrame:
    """Value of the parent row of the same table."""
    parents = df.select(F.col(key).alias("__p"), F.col(value).alias(name))
    return df.join(parents, F.col(parent_key) == F.col("__p"), "left").drop("__p")


def valid_at(df: DataFrame, beg: str, end: str, at: Column) -> DataFrame:
    """Rows whose interval holds the point in time."""
    return df.where((F.col(beg) <= at) & (F.col(end) >= at))


def valid_on_days(df: DataFrame, days: DataFrame, day: str, beg: str, end: str, width: int = 90) -> DataFrame:
    """Range join of intervals with a calendar.

    Both sides are put into buckets of ``width`` days, so the join is an equi
    join on the bucket with the exact test on top; a calendar day lies in one
    bucket, hence no pair is found twice. Open-ended intervals are cut to the
    calendar's span first, so they do not spread over centuries.
    """
    first, last = days.agg(F.min(day)).scalar(), days.agg(F.max(day)).scalar()
    number = lambda c: F.floor(F.datediff(c, F.lit("1970-01-01").cast("date")) / width)
    inside = df.where((F.col(beg) <= F.col(end)) & (F.col(beg) <= last) & (F.col(end) >= first))
    spans = F.sequence(number(F.greatest(F.col(beg), first)), number(F.least(F.col(end), last)))
    left = inside.withColumn("__b", F.explode(spans))
    right = days.select(day, number(F.col(day)).alias("__b"))
    return left.join(right, "__b").where(F.col(day).between(F.col(beg), F.col(end))).drop("__b")


def above(df: DataFrame, other: DataFrame, on: tuple[str, str], value: tuple[str, str], size: int = RUN) -> DataFrame:
    """Inner equi join on ``on`` with the residual ``df.value > other.value``; all column names of both sides differ.

    For few rows that make many pairs. Rows of ``df`` that follow each other in (key, value) are packed to runs of
    ``size``; a run meets a row of ``other`` once and is opened again, so most pairs cost no comparison. Pairs come out
    run after run with the same row of ``other``, and the same run for one row of it after the other, so that written
    pairs take a fraction of a byte where the pairs of a hash join take several. Every task gets a share of the runs of
    every key and the rows of ``other`` with that key; no side is broadcast.
    """
    (key, other_key), (high, low) = on, value
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = [c for c in df.columns if c not in (key, high)]
    rows = df.where(F.col(key).isNotNull() & F.col(high).isNotNull())
    rows = rows.repartitionByRange(n, key, high, *rest).sortWithinPartitions(key, high, *rest)
    runs = rows.withColumn("__run", F.expr(f"monotonically_increasing_id() div {size}"))
    runs = runs.groupBy(key, "__run").agg(F.sort_array(F.collect_list(F.struct(high, *rest))).alias("__rows"))
    runs = runs.withColumn("__cell", F.expr(f"pmod(xxhash64(__run), {n}L)")).repartition(n, key, "__cell")
    each = other.where(F.col(other_key).isNotNull() & F.col(low).isNotNull())
    each = each.withColumn("__to", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    each = each.repartition(n, other_key, "__to").hint("merge")
    some = F.element_at("__rows", -1)[high] > F.col(low)
    met = runs.join(each, (F.col(key) == F.col(other_key)) & (F.col("__cell") == F.col("__to")) & some)
    pairs = met.select(key, *other.columns, F.inline("__rows")).where(F.col(high) > F.col(low))
    return pairs.select(*df.columns, *other.columns)


def first_match(df: DataFrame, first: DataFrame, second: DataFrame, keys: tuple[str, str], value: str) -> DataFrame:
    """Two left joins, the first lookup wins. Lookups have ``key`` and ``value``."""
    a = first.select(F.col("key").alias(keys[0]), F.col("value").alias("__a"))
    b = second.select(F.col("key").alias(keys[1]), F.col("value").alias("__b"))
    out = df.join(a, keys[0], "left").join(b, keys[1], "left")
    return out.withColumn(value, F.coalesce("__a", "__b")).drop("__a", "__b")


def rejoin_latest(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows that carry the column-wise maxima of their group, each once."""
    tops = df.groupBy(key).agg(*[F.max(c).alias(c) for c in columns])
    return nullsafe_join(df, tops, [key, *columns]).distinct()
