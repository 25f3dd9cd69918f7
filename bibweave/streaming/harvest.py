"""Incremental harvest: changes, upserts and enrichment in micro-batches.

A store holds four folders. ``mods`` and ``extra`` are logs: a micro-batch writes the texts it brought, and what was made of
them, below its own number. ``ids`` is the state: one row per identifier with its newest time stamp and the numbers of the
batches that hold its text and its enrichment, divided into buckets by a hash of the identifier. A batch reads and rewrites only
the buckets in which something changes. ``commits`` holds one manifest per batch, a single file that names for every bucket the
batch that wrote it last. So the cost of a batch depends on its own rows and the identifiers of its buckets, not on the versions
and batches before; of those only the names of the manifests are listed.

Readers see what the newest manifest names. A batch that is run again overwrites its own rows, so a replay changes nothing, and a
lost executor leaves nothing half visible. :func:`compact` writes the current rows as the first batch of a new store. A store
goes with one checkpoint, as its batches are known by their numbers.

Of several versions the newest counts; one without a time stamp is older than all others. A version that is not newer than the
stored one changes nothing. The enrichment shown is that of the newest version with a record id, in whatever order they came.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from bibweave.functions.dates import stamp_utc
from bibweave.operators.mods import parse

c = F.col
KEY, STAMP = "identifier", "datestamp"
#: Buckets of a new store, a parameter: choose them so that one holds about a million identifiers.
BUCKETS = 16
STATE = "identifier string, datestamp timestamp, body bigint, extra_stamp timestamp, extra bigint"
VERSION = "identifier string, datestamp timestamp, mods string, newest boolean, rich boolean"
EXTRA = "identifier string, datestamp timestamp, PID string, PID_many boolean, status string, json string"
MANIFEST = "bucket int, version bigint, buckets int"


def ensure_store(spark: SparkSession, store: str, buckets: int = BUCKETS) -> None:
    """Create the logs and the first manifest, which names no bucket yet, unless they are there already."""
    for table, schema in (("mods", VERSION), ("extra", EXTRA)):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{store}/{table}/batch_id=-2")
    first = spark.createDataFrame([(None, None, buckets)], MANIFEST)
    first.coalesce(1).write.mode("ignore").parquet(f"{store}/commits/batch_id=-2")


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")


def commits(spark: SparkSession, store: str) -> list[int]:
    """Numbers of the committed batches, from the names of their manifests."""
    names = spark.read.schema(MANIFEST).parquet(f"{store}/commits").inputFiles()
    return sorted({int(n) for name in names for n in re.findall(r"/batch_id=(-?\d+)/", name)})


def manifest(spark: SparkSession, store: str) -> tuple[int, dict[int, int]]:
    """The number of buckets, and for each that has rows the batch that wrote it last."""
    rows = spark.read.schema(MANIFEST).parquet(f"{store}/commits/batch_id={commits(spark, store)[-1]}").collect()
    return rows[0]["buckets"], {r["bucket"]: r["version"] for r in rows if r["bucket"] is not None}


def state(spark: SparkSession, store: str, only: set[int] | None = None) -> DataFrame:
    """The committed state, all of it or that of some buckets."""
    named = manifest(spark, store)[1]
    paths = [f"{store}/ids/batch_id={v}/bucket={b}" for b, v in sorted(named.items()) if only is None or b in only]
    return spark.read.schema(STATE).parquet(*paths) if paths else spark.createDataFrame([], STATE)


def _log(spark: SparkSession, store: str, table: str, schema: str) -> DataFrame:
    """All rows of a log, with the number of their batch, committed or not."""
    return spark.read.schema(schema + ", batch_id bigint").parquet(f"{store}/{table}")


def current(spark: SparkSession, store: str, table: str) -> DataFrame:
    """Newest row per identifier of ``ids``, ``mods`` or ``extra``."""
    known = state(spark, store)
    if table == "ids":
        return known.select(KEY, STAMP)
    place, schema = {"mods": ("body", VERSION), "extra": ("extra", EXTRA)}[table]
    wanted = known.where(c(place).isNotNull()).select(c(KEY).alias("of"), c(place).alias("at"))
    rows = _log(spark, store, table, schema)
    if table == "mods":
        rows = rows.where("newest").drop("newest", "rich")
    return rows.join(wanted, c(KEY).eqNullSafe(c("of")) & (c("batch_id") == c("at")), "left_semi").drop("batch_id")


def high_water_mark(ids: DataFrame) -> DataFrame:
    """Largest time stamp seen, as UTC text."""
    return ids.agg(stamp_utc(F.max(STAMP)).alias("last_modified"))


def changes(fetched: DataFrame, stored: DataFrame) -> DataFrame:
    """Fetched ids that are new or carry another time stamp."""
    return fetched.join(stored.select(KEY, STAMP), [KEY, STAMP], "left_anti")


def _record_id(doc: str) -> Column:
    """The record ids of a text joined with blanks, each without its prefix; missing if there is none."""
    ids = F.transform(F.xpath(doc, F.lit("//recordIdentifier/text()")), lambda x: F.regexp_replace(x, "^.*?:", ""))
    return F.nullif(F.array_join(ids, " "), F.lit(""))


def enrich(records: DataFrame) -> DataFrame:
    """Record id, status and JSON of harvested records. Several ids or statuses
    are joined with blanks; a record without an id is left out."""
    found = lambda path: F.nullif(F.array_join(F.array_distinct(F.xpath("mods", F.lit(path))), " "), F.lit(""))
    body = F.regexp_extract("mods", r"(?s)(<mods\b.*</mods>)", 1)
    parsed = parse(records.withColumns({"__doc": body}), "__doc").select(KEY, STAMP, F.to_json("m").alias("json"))
    heads = records.select(
        KEY, STAMP, _record_id("mods").alias("PID"),
        (F.size(F.xpath("mods", F.lit("//recordIdentifier/text()"))) > 1).alias("PID_many"), found("//header/@status").alias("status"),
    )
    return heads.where(c("PID").isNotNull()).join(parsed, [KEY, STAMP], "left")


def _newer(stamp: Column, stored: Column, known: Column) -> Column:
    """Whether a version replaces what is stored (``known``: whether anything is)."""
    return F.coalesce(~known | (stamp > stored) | (stored.isNull() & stamp.isNotNull()), F.lit(False))


def versions(batch: DataFrame, known: DataFrame) -> DataFrame:
    """What a batch changes: per identifier its newest version and its newest one with a record id, if newer than the known ones.

    Both are chosen before the shuffle, so an identifier with very many versions costs two rows per task.
    """
    row = F.struct(STAMP, "mods")
    order = F.struct(c(STAMP).isNull(), -F.unix_micros(STAMP), c("mods"))
    best = batch.groupBy(KEY).agg(
        F.min_by(row, order).alias("last"), F.min_by(row, F.when(_record_id("mods").isNotNull(), order)).alias("full")
    )
    old = known.select(c(KEY).alias("of"), c(STAMP).alias("stamp"), "body", "extra_stamp", "extra")
    both = best.join(old, c(KEY).eqNullSafe(c("of")), "left").select(
        KEY, "last", "full",
        _newer(c("last")[STAMP], c("stamp"), c("body").isNotNull()).alias("newest"),
        (c("full").isNotNull() & _newer(c("full")[STAMP], c("extra_stamp"), c("extra").isNotNull())).alias("rich"),
    )
    same = c("last").eqNullSafe(c("full"))
    version = lambda row, newest, rich: F.struct(row[STAMP].alias(STAMP), row["mods"].alias("mods"), newest.alias("newest"), rich.alias("rich"))
    kept = F.array(
        version(c("last"), c("newest"), c("rich") & same),
        version(c("full"), F.lit(False), c("rich") & ~same),
    )
    return both.select(KEY, F.explode(F.filter(kept, lambda v: v["newest"] | v["rich"])).alias("v")).select(KEY, "v.*")


def _merged(known: DataFrame, kept: DataFrame, batch_id: int) -> DataFrame:
    """The state after a batch: what it changed replaces what was known, all else stays."""
    stamp = lambda flag: F.max(F.when(c(flag), c(STAMP)))
    new = kept.groupBy(c(KEY).alias("of")).agg(
        stamp("newest").alias("at"), F.max("newest").alias("newest"), stamp("rich").alias("rich_at"), F.max("rich").alias("rich")
    )
    both = known.withColumn("there", F.lit(True)).join(new, c(KEY).eqNullSafe(c("of")), "full")
    either = lambda flag, value, name: F.when(c(flag), value).otherwise(c(name)).alias(name)
    return both.select(
        F.when(c("there"), c(KEY)).otherwise(c("of")).alias(KEY), either("newest", c("at"), STAMP), either("newest", F.lit(batch_id), "body"),
        either("rich", c("rich_at"), "extra_stamp"), either("rich", F.lit(batch_id), "extra"),
    )


def _commit(spark: SparkSession, store: str, batch_id: int, buckets: int, named: dict[int, int]) -> None:
    """One file, moved into place at once."""
    rows = [(b, v, buckets) for b, v in sorted(named.items())] or [(None, None, buckets)]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{store}/commits/batch_id={batch_id}")


def _write_state(rows: DataFrame, store: str, batch_id: int, buckets: int) -> None:
    placed = rows.withColumn("bucket", bucket_of(c(KEY), buckets)).repartition("bucket")
    placed.write.mode("overwrite").partitionBy("bucket").parquet(f"{store}/ids/batch_id={batch_id}")


def apply_batch(batch: DataFrame, batch_id: int, store: str) -> None:
    """Upsert one micro-batch of (identifier, datestamp, mods) into the store."""
    spark = batch.sparkSession
    if batch_id in commits(spark, store):
        return
    buckets, named = manifest(spark, store)
    of = lambda df: {r["bucket"] for r in df.select(bucket_of(c(KEY), buckets)).distinct().collect()}  # at most all buckets
    rows = batch.select(KEY, STAMP, "mods")
    # written once, then read back for the other two tables
    path = f"{store}/mods/batch_id={batch_id}"
    versions(rows, state(spark, store, of(rows))).write.mode("overwrite").parquet(path)
    kept = spark.read.schema(VERSION).parquet(path)
    enrich(kept.where("rich")).select(KEY, STAMP, "PID", "PID_many", "status", "json").write.mode("overwrite").parquet(
        f"{store}/extra/batch_id={batch_id}"
    )
    changed = of(kept)
    if changed:
        _write_state(_merged(state(spark, store, changed), kept, batch_id), store, batch_id, buckets)
    _commit(spark, store, batch_id, buckets, named | {b: batch_id for b in changed})


def run(source: DataFrame, store: str, checkpoint: str) -> StreamingQuery:
    """Process everything that is available, batch by batch."""
    ensure_store(source.sparkSession, store)
    return (
        source.writeStream.foreachBatch(lambda df, n: apply_batch(df, n, store))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def compact(spark: SparkSession, store: str, into: str) -> None:
    """Write the current rows as the first batch of a new store, without the versions that newer ones replaced."""
    buckets, named = manifest(spark, store)
    ensure_store(spark, into, buckets)
    newest = current(spark, store, "mods").withColumns({"newest": F.lit(True), "rich": F.lit(False)})
    newest.write.mode("overwrite").parquet(f"{into}/mods/batch_id=-1")
    current(spark, store, "extra").write.mode("overwrite").parquet(f"{into}/extra/batch_id=-1")
    moved = lambda name: F.when(c(name).isNotNull(), F.lit(-1)).cast("bigint")
    _write_state(state(spark, store).withColumns({"body": moved("body"), "extra": moved("extra")}), into, -1, buckets)
    _commit(spark, into, -1, buckets, {b: -1 for b in named})
