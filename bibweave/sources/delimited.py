"""Delimited files: typed scans, problem reports, sinks."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from bibweave.functions.nulls import paste
from bibweave.operators.reshape import conform, pick, rename_by_mapping
from bibweave.sources.schemas import AUTHOR_RENAMES, AUTHORS, HR, PUBLICATIONS, STOP_LIST

c = F.col


def read_strings(spark: SparkSession, paths: str | list[str], **options) -> DataFrame:
    """CSV files with every column as text; the header decides the names, and no
    pass over the data is spent on guessing types."""
    reader = spark.read.option("header", True).option("multiLine", options.pop("multi_line", False))
    return reader.options(**options).option("escape", '"').csv(paths)


def typed(df: DataFrame, schema: str, mapping: dict[str, str] | None = None) -> DataFrame:
    """Text columns cast to a layout; what cannot be read becomes missing."""
    return conform(df, schema, mapping)


def problems(df: DataFrame, schema: str, key: str, mapping: dict[str, str] | None = None) -> DataFrame:
    """(key, field, value) of the cells that do not fit their type.

    All cells of a row are tested in one pass over the table."""
    source = {v: k for k, v in (mapping or {}).items()}
    cells = []
    for f in T.StructType.fromDDL(schema).fields:
        name = source.get(f.name, f.name)
        if name in df.columns and not isinstance(f.dataType, T.StringType):
            raw = c(f"`{name}`")
            bad = raw.isNotNull() & raw.try_cast(f.dataType).isNull()
            cells.append(F.when(bad, F.struct(F.lit(f.name).alias("field"), raw.cast("string").alias("value"))))
    found = df.select(c(f"`{key}`").alias("key"), F.explode(F.array_compact(F.array(*cells))).alias("x"))
    return found.select("key", "x.field", "x.value")


def read_publications(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Publication export with explicit types; several yearly files make one table."""
    return typed(read_strings(spark, paths), PUBLICATIONS)


def shape_authors(raw: DataFrame) -> DataFrame:
    """Author export under short names, with the composed name and derived flags."""
    renamed = raw.withColumnsRenamed({k: v for k, v in AUTHOR_RENAMES.items() if k in raw.columns})
    named = renamed.withColumns(
        {
            "name": paste(c("LastName"), c("FirstName"), sep=", "),
            "uses_etal": F.lit(None).cast("boolean"),
            "is_extorg": c("extorg").isNotNull(),
        }
    )
    return pick(typed(named, AUTHORS), ["PID", "name", "staffid", "orcid", "orgid", "extorg", "pos"], rest=True)


def read_authors(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return shape_authors(read_strings(spark, paths))


def with_year_of_file(df: DataFrame) -> DataFrame:
    """Add the year named by the file's folder (``.../1996/``, ``y=1996/``), else by the file itself."""
    path = c("_metadata.file_path")
    folder = F.regexp_extract(path, r"[/=_-]((?:19|20)\d{2})/[^/]*$", 1)
    name = F.regexp_extract(path, r"/[^/]*?(?<!\d)((?:19|20)\d{2})(?!\d)[^/]*$", 1)
    return df.withColumn("file_year", F.coalesce(folder.try_cast("int"), name.try_cast("int")))


def dated_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(path, file_date) of the files whose name, or else whose folder's name, holds an eight-digit date."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    parts = F.split("path", "/")
    day = lambda level: F.try_to_date(F.regexp_extract(F.get(parts, F.size(parts) - level), r"(?<!\d)(\d{8})(?!\d)", 1), "yyyyMMdd")
    return listing.select("path", "modificationTime", "length", F.coalesce(day(1), day(2)).alias("file_date")).where(
        c("file_date").isNotNull()
    )


def choose_files(files: DataFrame, offset_days: int = 0) -> list[str]:
    """Paths of all files of the newest date, or of the one ``offset_days`` before.

    Collects the listing of one extract."""
    newest = files.agg(F.date_sub(F.max("file_date"), offset_days).alias("d"))
    paths = sorted(r["path"] for r in files.join(newest, c("file_date") == c("d")).select("path").collect())
    if not paths:
        raise FileNotFoundError(f"no file dated {offset_days} days before the newest")
    return paths


def read_staff(spark: SparkSession, path: str | list[str], mapping: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Staff rows under the short names, and the cells that could not be read.
    The degree of employment has a decimal comma."""
    raw, _ = rename_by_mapping(read_strings(spark, path), mapping)
    fixed = raw.withColumn("emp_degree", F.replace("emp_degree", F.lit(","), F.lit("."))) if "emp_degree" in raw.columns else raw
    return typed(fixed, HR), problems(fixed, HR, "staffid")


def read_semicolon(spark: SparkSession, path: str | list[str], numbers: list[str] = ()) -> DataFrame:
    """``;`` separated text with decimal commas and grouping dots."""
    df = read_strings(spark, path, sep=";", encoding="UTF-8")
    plain = lambda n: F.replace(F.replace(c(n), F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")
    return df.withColumns({n: plain(n) for n in numbers})


def read_pipe(spark: SparkSession, path: str | list[str], names: list[str]) -> DataFrame:
    """``|`` separated Latin-1 text without a header."""
    return spark.read.options(sep="|", encoding="ISO-8859-1").schema(", ".join(f"`{n}` string" for n in names)).csv(path)


def read_tabs(spark: SparkSession, path: str | list[str], names: list[str] | None = None) -> DataFrame:
    """Tab separated text; with ``names`` the first line is skipped."""
    if names is None:
        return read_strings(spark, path, sep="\t")
    return spark.read.options(sep="\t", header=True, enforceSchema=True).schema(", ".join(f"`{n}` string" for n in names)).csv(path)


def read_exported(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV of the object store, where ``NA`` is missing."""
    return read_strings(spark, path, nullValue="NA")


def read_stop_list(spark: SparkSession, path: str) -> DataFrame:
    """Stop list of (PID, Title); any other layout is refused."""
    raw = read_strings(spark, path)
    if sorted(raw.columns) != ["PID", "Title"]:
        raise ValueError(f"stop list has columns {raw.columns}")
    return typed(raw, STOP_LIST)


def read_eid_list(spark: SparkSession, path: str) -> DataFrame:
    """Lines of Scopus identifiers; one that is none refuses the file."""
    lines = spark.read.text(path).where(F.length("value") > 0)
    checked = F.when(c("value").contains("2-s2.0-"), c("value")).otherwise(
        F.raise_error(F.concat(F.lit("not an identifier: "), c("value")))
    )
    return lines.select(checked.alias("eid"))


def snapshot_age(spark: SparkSession, path: str, as_of: dt.datetime, stale_hours: int = 23) -> DataFrame:
    """File, time stamp, age in hours, and whether it is stale."""
    files = spark.read.format("binaryFile").load(path).select("path", c("modificationTime").alias("timestamp"))
    hours = (F.unix_timestamp(F.lit(as_of)) - F.unix_timestamp("timestamp")) / 3600
    return files.withColumns({"age_hours": hours, "is_stale": hours > stale_hours})


def write_table(df: DataFrame, path: str) -> str:
    """CSV with a header, missing values empty."""
    df.write.mode("overwrite").options(
        header=True, nullValue="", emptyValue="", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return path


def write_tables(tables: dict[str, DataFrame], folder: str, prefix: str = "") -> dict[str, str]:
    return {n: write_table(t, f"{folder}/{prefix}{n}.csv") for n, t in tables.items()}


def csv_to_parquet(spark: SparkSession, folder: str, names: list[str], out: str) -> dict[str, str]:
    """Convert the project tables of a folder, one Parquet table per CSV."""
    done = {}
    for n in names:
        read_strings(spark, f"{folder}/{n}.csv").write.mode("overwrite").parquet(f"{out}/{n}.parquet")
        done[n] = f"{out}/{n}.parquet"
    return done


def query_file(spark: SparkSession, path: str, sql: str) -> DataFrame:
    """Run SQL over a CSV file, which the text calls ``{file}``."""
    return spark.sql(sql, file=read_strings(spark, path))


def dated_extract(df: DataFrame, folder: str, name: str, day: dt.date) -> str:
    """Write an extract under a dated name."""
    path = f"{folder}/{name}_{day:%Y%m%d}.parquet"
    df.write.mode("overwrite").parquet(path)
    return path


def cited_authors(identifiers: DataFrame, documents: DataFrame, addresses: DataFrame) -> DataFrame:
    """Author addresses of the documents whose index number is in the list."""
    return documents.sparkSession.sql(
        """SELECT ra.* FROM (SELECT DISTINCT ISI FROM {i} WHERE ISI IS NOT NULL) i
        JOIN {d} d ON d.ut = i.ISI JOIN {a} ra ON ra.doc = d.doc""",
        i=identifiers, d=documents, a=addresses,
    )


def union_files(tables: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
