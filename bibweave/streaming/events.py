"""Event-time streams: windows, late rows, repeats and running totals.

All of it is Structured Streaming with watermarks. State lives in Spark's state store and is given up once the watermark has
passed it, so it is bounded by the delay and not by the length of the stream; a query that is started again from its
checkpoint goes on where it ended.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

c = F.col
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_TOTALS = "name string, part int, total bigint, latest timestamp, quiet boolean"


# --- windows

def tumbling(time: str, size: str) -> Column:
    return F.window(time, size)


def sliding(time: str, size: str, step: str) -> Column:
    return F.window(time, size, step)


def session(time: str, gap: str) -> Column:
    return F.session_window(time, gap)


def windowed(stream: DataFrame, time: str, window: Column, delay: str, keys: list[str], **aggregates: Column) -> DataFrame:
    """Aggregates per window and key: window_start, window_end, keys, aggregates.

    In append mode a window comes out once, when the watermark (latest event less ``delay``) has passed its end; a row whose
    windows are all out by then is late and left out, see :func:`write_late`. Works on a table, too: all windows come out.
    """
    marked = stream.withWatermark(time, delay)
    out = marked.groupBy(window.alias("window"), *keys).agg(*[a.alias(n) for n, a in aggregates.items()])
    return out.select(c("window.start").alias("window_start"), c("window.end").alias("window_end"), *keys, *aggregates)


def once_within(stream: DataFrame, time: str, keys: list[str], delay: str) -> DataFrame:
    """Rows without those that repeat the keys of an earlier row of at most ``delay`` before them.

    A key is forgotten at the end of the batch whose watermark has passed its first row's time by ``delay``; after that it counts
    as new. So no repeat within the delay gets through, and one somewhat beyond it may still be dropped.
    """
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


# --- sinks

def _available(writer, checkpoint: str) -> StreamingQuery:
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append(result: DataFrame, into: str, checkpoint: str) -> StreamingQuery:
    """Process what is available and append final rows to a Parquet folder; the sink's log makes that exactly once."""
    return _available(result.writeStream.outputMode("append").format("parquet").option("path", into), checkpoint)


def _numbered(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """What batches have written below their numbers."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{folder}/batch_id=-1")
    return spark.read.schema(f"{schema}, batch_id bigint").parquet(folder)


def write_late(stream: DataFrame, time: str, end: Column, delay: dt.timedelta, into: str, checkpoint: str) -> StreamingQuery:
    """Write the rows that are late for the window that ends at ``end`` to ``into/late``.

    Spark leaves a row out if its window had come out before the batch began: the watermark that decides is the one with which
    the batch before it ended its windows, the latest event of all batches up to the last but one, less the delay. A batch writes
    its late rows and its latest event under its own number, so a batch that runs again overwrites its own.
    """

    def apply(batch: DataFrame, n: int) -> None:
        marks = _numbered(batch.sparkSession, f"{into}/marks", "latest timestamp")
        latest = marks.where(c("batch_id") < n - 1).agg(F.max("latest")).first()[0]  # one row per earlier batch
        late = F.lit(False) if latest is None else end <= F.lit(latest - delay)
        batch.where(late).write.mode("overwrite").parquet(f"{into}/late/batch_id={n}")
        batch.agg(F.max(time).alias("latest")).write.mode("overwrite").parquet(f"{into}/marks/batch_id={n}")

    return _available(stream.writeStream.foreachBatch(apply), checkpoint)


# --- running totals

class RunningTotal(StatefulProcessor):
    """Keeps, per key, a total and the latest event; a timer tells when no row has come for ``idle``."""

    def __init__(self, idle: dt.timedelta):
        self.idle = idle

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("total", "total bigint, latest timestamp")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        total, latest = self.state.get() if self.state.exists() else (0, None)
        for part in rows:
            total += int(part["amount"].sum())
            last, arrived = part["latest"].max().to_pydatetime(), part["arrived"].max()
            latest = last if latest is None else max(latest, last)
        self.state.update((total, latest))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(int((arrived + self.idle).tz_localize("UTC").timestamp() * 1000))
        yield self._row(key, total, latest, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._row(key, *self.state.get(), True)

    @staticmethod
    def _row(key, total, latest, quiet) -> pd.DataFrame:
        return pd.DataFrame({"name": [key[0]], "part": [key[1]], "total": [total], "latest": [latest], "quiet": [quiet]})

    def close(self) -> None:
        pass


def _summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.groupby(["name", "part"], as_index=False).agg(amount=("amount", "sum"), latest=("latest", "max"))


def running_totals(
    stream: DataFrame, name: str, amount: str, time: str, spread_by: str, idle: dt.timedelta, into: str, checkpoint: str,
    parts: int = 16,
) -> StreamingQuery:
    """Add ``amount`` to the total of ``name``, row by row of the stream; :func:`totals` reads them.

    A name that holds most rows does not go to one task: rows are added up where they are read, and each name has ``parts``
    states, told apart by the hash of ``spread_by``. Every batch writes the states it changed under its own number. Watermark
    and timers go by the time of arrival, so that a row counts however old it is. Needs the RocksDB state store (``ROCKS``) and
    a session in UTC.
    """
    part = F.pmod(F.xxhash64(spread_by), F.lit(parts)).cast("int").alias("part")
    rows = stream.select(c(name).alias("name"), part, c(amount).cast("bigint").alias("amount"), c(time).cast("timestamp").alias("latest"))
    rows = rows.where("name is not null and amount is not null and latest is not null")
    summed = rows.mapInPandas(_summed, "name string, part int, amount bigint, latest timestamp")
    summed = summed.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", "0 seconds")
    states = summed.groupBy("name", "part").transformWithStateInPandas(RunningTotal(idle), _TOTALS, "update", "eventTime")

    def apply(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{into}/batch_id={n}")

    return _available(states.writeStream.outputMode("update").foreachBatch(apply), checkpoint)


def totals(spark: SparkSession, into: str) -> DataFrame:
    """(name, total, latest, quiet): the newest state of every part, added up; quiet if all parts have become so."""
    rows = _numbered(spark, into, _TOTALS)
    newest = rows.groupBy("name", "part").agg(F.max_by(F.struct("total", "latest", "quiet"), F.struct("batch_id", "quiet")).alias("s"))
    return newest.groupBy("name").agg(F.sum("s.total").alias("total"), F.max("s.latest").alias("latest"), F.bool_and("s.quiet").alias("quiet"))
