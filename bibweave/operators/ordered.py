"""Ordered computations that do not need a whole group in one task.

A window over a hot key (or over the whole table) sorts all its rows in one
place. Here the order is cut into chunks: rows are processed per (key, chunk),
a summary with one row per chunk carries the state across chunk borders, and
the two are joined. ``chunk`` is any number or date that never decreases along
the order, such as ``floor(id / 100000)`` or the month of a date.

The summaries themselves are scanned in levels: ``FAN`` chunk values make one
of the next level, and so on, ``LEVELS`` times. No window sees more than ``FAN``
values of a level but the last one, which has one row for ``FAN ** LEVELS``
chunks: with chunks of 4,096 rows, one row for 4 * 10**9 rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from bibweave.functions.nulls import nullsafe_join
from bibweave.session import cut_lineage

CHUNK, UP = "__chunk", "__up"
FAN, LEVELS = 1024, 2


def by_width(col: str, width: int) -> Column:
    """Chunk expression for a numeric order column."""
    return F.floor(F.col(col) / width)


def _cut(df: DataFrame, keys: list[str], order: list[str], chunk: Column):
    cut = df.withColumn(CHUNK, chunk)
    return cut, W.partitionBy(*keys, CHUNK).orderBy(*order)


def _coarser(df: DataFrame) -> Column:
    """The chunk's value on the next level."""
    kind = df.schema[CHUNK].dataType.typeName()
    value = F.unix_date(F.col(CHUNK).cast("date")) if kind in ("date", "timestamp", "timestamp_ntz") else F.col(CHUNK)
    return F.floor(value / FAN)


def _carried(parts: DataFrame, keys: list[str], value: str, add: bool, name: str, back: bool = False) -> DataFrame:
    """(keys, chunk, name): what the chunks before each one hand on.

    That is the sum of their values (``add``), else the last one present; ``back`` takes the chunks after it, nearest first. The
    summaries are written, so that the levels read them and not the table again.
    """
    return _scanned(cut_lineage(parts, "chunks"), keys, value, add, name, back, LEVELS)


def _scanned(parts: DataFrame, keys: list[str], value: str, add: bool, name: str, back: bool, levels: int) -> DataFrame:
    def before(*partition: str) -> Column:
        order = F.col(CHUNK).desc() if back else F.col(CHUNK)
        span = W.partitionBy(*partition).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
        return F.sum(value).over(span) if add else F.last(value, ignorenulls=True).over(span)

    if levels == 0:
        return parts.select(*keys, CHUNK, before(*keys).alias(name))
    leveled = parts.withColumn(UP, _coarser(parts))
    present = F.when(F.col(value).isNotNull(), F.col(CHUNK))
    reach = (F.min_by if back else F.max_by)(F.col(value), present)
    upper = leveled.groupBy(*keys, F.col(UP)).agg((F.sum(value) if add else reach).alias(value)).withColumnRenamed(UP, CHUNK)
    above = _scanned(upper, keys, value, add, "__above", back, levels - 1).withColumnRenamed(CHUNK, UP)
    here = leveled.select(*keys, CHUNK, UP, before(*keys, UP).alias("__here"))
    both = nullsafe_join(here, above, [*keys, UP])
    zero = lambda c: F.coalesce(c, F.lit(0))
    carried = zero(F.col("__here")) + zero(F.col("__above")) if add else F.coalesce("__here", "__above")
    return both.select(*keys, CHUNK, carried.alias(name))


def row_numbers(df: DataFrame, order: list[str], chunk: Column, keys: list[str] = (), name: str = "rn") -> DataFrame:
    """Position of each row along the order, from 1."""
    keys = list(keys)
    cut, inside = _cut(df, keys, order, chunk)
    offsets = _carried(cut.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("__n")), keys, "__n", True, "__off")
    out = nullsafe_join(cut, offsets, [*keys, CHUNK])
    return out.withColumn(name, F.row_number().over(inside) + F.col("__off")).drop(CHUNK, "__off")


def chunk_numbers(df: DataFrame, order: list[str], chunk: Column, size: int, name: str = "part", short_first: bool = False) -> DataFrame:
    """Number parts of ``size`` rows from 1. ``short_first`` gives the variant
    whose first part has one row less."""
    out = row_numbers(df, order, chunk, name="__rn")
    part = F.floor(F.col("__rn") / size) + 1 if short_first else F.ceil(F.col("__rn") / size)
    return out.withColumn(name, part.cast("int")).drop("__rn")


def running_total(df: DataFrame, value: str, order: list[str], chunk: Column, keys: list[str] = (), name: str = "total") -> DataFrame:
    """Cumulative sum along the order."""
    keys = list(keys)
    cut, inside = _cut(df, keys, order, chunk)
    offsets = _carried(cut.groupBy(*keys, CHUNK).agg(F.sum(value).alias("__s")), keys, "__s", True, "__off")
    out = nullsafe_join(cut, offsets, [*keys, CHUNK])
    local = F.sum(value).over(inside.rowsBetween(W.unboundedPreceding, 0))
    return out.withColumn(name, F.coalesce(local, F.lit(0)) + F.col("__off")).drop(CHUNK, "__off")


def fill_down(df: DataFrame, value: str, order: list[str], chunk: Column, keys: list[str] = (), name: str | None = None) -> DataFrame:
    """Replace missing values by the last present one along the order."""
    keys = list(keys)
    cut, inside = _cut(df, keys, order, chunk)
    present = F.when(F.col(value).isNotNull(), F.struct(*order))
    lasts = cut.groupBy(*keys, CHUNK).agg(F.max_by(F.col(value), present).alias("__last"))
    carried = _carried(lasts, keys, "__last", False, "__carry")
    out = nullsafe_join(cut, carried, [*keys, CHUNK])
    local = F.last(value, ignorenulls=True).over(inside.rowsBetween(W.unboundedPreceding, 0))
    return out.withColumn(name or value, F.coalesce(local, F.col("__carry"))).drop(CHUNK, "__carry")


def neighbour(
    df: DataFrame, value: str, order: list[str], chunk: Column, keys: list[str] = (), name: str = "previous", ahead: bool = False
) -> DataFrame:
    """Value of the previous (or next, with ``ahead``) row along the order."""
    keys = list(keys)
    cut, inside = _cut(df, keys, order, chunk)
    boxed = F.struct(F.col(value).alias("v"))
    edge = F.min_by(boxed, F.struct(*order)) if ahead else F.max_by(boxed, F.struct(*order))
    edges = cut.groupBy(*keys, CHUNK).agg(edge.alias("__edge"))
    step = F.lead if ahead else F.lag
    across = _carried(edges, keys, "__edge", False, "__edge", back=ahead)
    out = nullsafe_join(cut, across, [*keys, CHUNK])
    local = step(boxed).over(inside)
    return out.withColumn(name, F.coalesce(local, F.col("__edge"))["v"]).drop(CHUNK, "__edge")
