"""Line-delimited JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from bibweave.operators.reshape import flatten


def read_json_lines(
    spark: SparkSession, path: str, schema: str, keep: Column | None = None, flat: bool = False
) -> DataFrame:
    """Records of a (possibly compressed) JSON lines file.

    ``keep`` selects records while reading; ``flat`` names nested fields by
    their dotted path.
    """
    df = spark.read.schema(schema).json(path)
    df = df if keep is None else df.where(keep)
    return flatten(df, ".") if flat else df
