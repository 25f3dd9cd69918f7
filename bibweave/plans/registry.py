"""Named queries over the test tables, each with its SQL counterpart."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: dates_as_text(fn(spark, sf_dir))
        if sql:
            ORACLES[name] = sql
        return fn

    return keep


def dates_as_text(df: DataFrame) -> DataFrame:
    """Dates leave a query as ISO text, the form every client reads alike."""
    return df.select(
        *[
            F.col(f"`{n}`").cast("string").alias(n) if t in ("date", "timestamp", "timestamp_ntz") else F.col(f"`{n}`")
            for n, t in df.dtypes
        ]
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
