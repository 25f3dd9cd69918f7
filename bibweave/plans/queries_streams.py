"""Graph of ids (L08) and event-time streams (T08) over the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from bibweave.operators import components as graph
from bibweave.plans.bindings import AS_OF, bound, with_bound
from bibweave.plans.check_run import CheckRun
from bibweave.plans.queries_checks import PRE, ROW_COUNTS
from bibweave.plans.registry import query, table
from bibweave.session import run_dir
from bibweave.streaming import events as s

c = F.col

# --- L08: chains of 50 suppliers, half of all orders around one hub, the other half in pairs, and ids that stand alone

EDGES = """
SELECT concat('s', lpad(CAST(s_suppkey AS VARCHAR(20)), 9, '0')) AS a,
  CASE WHEN s_suppkey % 50 = 0 THEN NULL ELSE concat('s', lpad(CAST(s_suppkey + 1 AS VARCHAR(20)), 9, '0')) END AS b FROM supplier
UNION ALL SELECT concat('o', lpad(CAST(o_orderkey AS VARCHAR(20)), 9, '0')),
  CASE WHEN o_orderkey % 2 = 0 THEN 'hub' ELSE concat('o', lpad(CAST(o_orderkey + 2 * (o_orderkey % 4) - 4 AS VARCHAR(20)), 9, '0')) END FROM orders
"""
KEYED = """
ends AS (SELECT a AS n, coalesce(b, a) AS m FROM edges WHERE a IS NOT NULL UNION SELECT b, coalesce(a, b) FROM edges WHERE b IS NOT NULL),
cc(n, m) USING KEY (n) AS (
  SELECT n, least(n, min(m)) FROM ends GROUP BY n
  UNION SELECT u.n, min(u.m) FROM (SELECT ends.n, cc.m FROM cc JOIN ends ON cc.n = ends.m) u JOIN recurring.cc r ON r.n = u.n
  WHERE u.m < r.m GROUP BY u.n)"""


def _edges(spark: SparkSession, d: str) -> DataFrame:
    body = EDGES.replace("FROM supplier", "FROM {supplier}").replace("FROM orders", "FROM {orders}")
    return spark.sql(body, supplier=table(spark, d, "supplier"), orders=table(spark, d, "orders"))


@query("l08_components", f"WITH RECURSIVE edges AS ({EDGES}), {KEYED} SELECT n AS id, m AS component FROM cc")
def l08(spark, d):
    return graph.components(_edges(spark, d), "a", "b")


@query("l08_merge_candidates", with_bound("authors", sql=f"""
edges AS (SELECT DISTINCT concat('orcid:', orcid) AS a, concat('staffid:', staffid) AS b FROM authors
  WHERE orcid IS NOT NULL OR staffid IS NOT NULL), {KEYED.strip()},
r AS (SELECT m AS component, regexp_extract(n, '^([^:]*):', 1) AS kind, regexp_replace(n, '^[^:]*:', '') AS value FROM cc),
z AS (SELECT component, count(*) AS n_ids, count(*) FILTER (kind = 'staffid') AS n_persons FROM r GROUP BY 1),
u AS (SELECT 'orcid' AS kind, orcid AS value, count(DISTINCT "PID") AS n_records FROM authors GROUP BY 2
  UNION ALL SELECT 'staffid', staffid, count(DISTINCT "PID") FROM authors GROUP BY 2)
SELECT component, kind, value, n_ids, n_persons, n_records FROM r JOIN z USING (component) JOIN u USING (kind, value)
WHERE n_persons > 1""").replace("WITH ", "WITH RECURSIVE ", 1).replace("concat('orcid:', orcid)", "'orcid:' || orcid").replace("concat('staffid:', staffid)", "'staffid:' || staffid"))
def l08_merge(spark, d):
    """Staff ids that ORCIDs tie together, directly or over others."""
    return graph.merge_candidates(bound(spark, d, "authors"), ["orcid", "staffid"], "staffid")


# --- T08: the events arrive in four batches; every 13th comes two batches late

DELAY = dt.timedelta(hours=12)
ARRIVAL = "least(3, event_id * 4 div (1 + (SELECT max(event_id) FROM {events})) + CASE WHEN event_id % 13 = 0 THEN 2 ELSE 0 END)"
ARRIVED = f"""e AS (SELECT *, CAST({ARRIVAL.replace(" div ", " // ").format(events="events")} AS BIGINT) AS batch FROM events),
mark AS (SELECT b.batch, (SELECT max(ts) FROM e WHERE e.batch < b.batch - 1) - INTERVAL 12 HOUR AS mark FROM (SELECT DISTINCT batch FROM e) b),
last AS (SELECT max(ts) - INTERVAL 12 HOUR AS mark FROM e),
m AS (SELECT e.*, mark.mark FROM e JOIN mark USING (batch))"""


def arriving(spark: SparkSession, d: str, files: int = 4) -> DataFrame:
    """The table of events as a stream of files, one per batch, in the order of their arrival."""
    folder = run_dir(spark, "arriving")
    rows = table(spark, d, "events").withColumn("ts", c("ts").cast("timestamp")).withColumn("event_id", c("event_id").cast("bigint"))
    last = rows.agg(F.max("event_id")).first()[0]
    batch = F.least(F.lit(files - 1), F.expr(f"event_id * {files} div {(last or 0) + 1}") + F.when(c("event_id") % 13 == 0, 2).otherwise(0))
    for n in range(files):  # one after the other, as a file source takes files by their time
        rows.where(batch == n).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def _appended(spark: SparkSession, result: DataFrame) -> DataFrame:
    into = run_dir(spark, "windows")
    s.append(result, into, run_dir(spark, "windows-log")).awaitTermination()
    return spark.read.schema(result.schema).parquet(into)


def _window_sql(spans: str, keys: str) -> str:
    return f"""WITH {ARRIVED}, w AS ({spans})
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(we, '%Y-%m-%d %H:%M:%S') AS window_end, {keys}, count(*) AS n,
  round(sum(value), 2) AS total FROM w, last WHERE (w.mark IS NULL OR we > w.mark) AND we <= last.mark GROUP BY ALL"""


def _windows(spark, d, window, keys):
    return _appended(spark, s.windowed(
        arriving(spark, d), "ts", window, "12 hours", keys, n=F.count(F.lit(1)), total=F.round(F.sum("value"), 2)))


@query("t08_tumbling", _window_sql(
    "SELECT m.*, time_bucket(INTERVAL 6 HOUR, ts) AS ws, time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS we FROM m", "event_type"))
def t08_tumbling(spark, d):
    return _windows(spark, d, s.tumbling("ts", "6 hours"), ["event_type"])


@query("t08_sliding", _window_sql("""SELECT m.*, time_bucket(INTERVAL 4 HOUR, ts) - INTERVAL 4 HOUR * k AS ws,
  time_bucket(INTERVAL 4 HOUR, ts) - INTERVAL 4 HOUR * k + INTERVAL 12 HOUR AS we FROM m, (VALUES (0), (1), (2)) t(k)""", "event_type"))
def t08_sliding(spark, d):
    return _windows(spark, d, s.sliding("ts", "12 hours", "4 hours"), ["event_type"])


@query("t08_late_rows", f"""WITH {ARRIVED} SELECT event_id, event_type, strftime(time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end
FROM m WHERE time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR <= mark""")
def t08_late(spark, d):
    """The rows that the tumbling windows leave out."""
    into = run_dir(spark, "late")
    end = F.window("ts", "6 hours")["end"]
    stream = arriving(spark, d).withColumn("window_end", end)
    s.write_late(stream, "ts", c("window_end"), DELAY, into, run_dir(spark, "late-log")).awaitTermination()
    late = spark.read.schema(stream.schema).parquet(f"{into}/late")
    return late.select("event_id", "event_type", "window_end")


def in_order(spark: SparkSession, d: str, files: int = 4) -> DataFrame:
    """The events as a stream of files without late rows."""
    folder = run_dir(spark, "in-order")
    rows = table(spark, d, "events").withColumn("ts", c("ts").cast("timestamp"))
    first, last = rows.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    step = ((last or 0) - (first or 0)) // files + 1
    for n in range(files):
        rows.where(F.floor((F.unix_micros("ts") - (first or 0)) / step) == n).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)


@query("t08_sessions", """WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)),
n AS (SELECT *, sum(new) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM g),
v AS (SELECT event_type, min(ts) AS window_start, max(ts) + INTERVAL 30 MINUTE AS window_end, count(*) AS n, round(sum(value), 2) AS total FROM n GROUP BY event_type, k)
SELECT CAST(epoch_us(window_start) AS BIGINT) AS start_us, CAST(epoch_us(window_end) AS BIGINT) AS end_us, event_type, n, total FROM v
WHERE window_end <= (SELECT max(ts) - INTERVAL 12 HOUR FROM events)""")
def t08_sessions(spark, d):
    """Runs of events of one kind without a gap of half an hour."""
    out = _appended(spark, s.windowed(
        in_order(spark, d), "ts", s.session("ts", "30 minutes"), "12 hours", ["event_type"], n=F.count(F.lit(1)), total=F.round(F.sum("value"), 2)))
    return out.select(F.unix_micros("window_start").alias("start_us"), F.unix_micros("window_end").alias("end_us"), "event_type", "n", "total")


@query("t08_once_within", "SELECT DISTINCT user_id, event_type, strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS hour FROM events")
def t08_once(spark, d):
    """The first event of every user, kind and hour; the rest of the hour is a repeat."""
    stream = in_order(spark, d).withColumn("hour", F.date_trunc("hour", "ts"))
    once = s.once_within(stream, "ts", ["user_id", "event_type", "hour"], "2 hours")
    return _appended(spark, once.select("user_id", "event_type", "hour"))


_ROWS = {n: w for n, (t, w) in ROW_COUNTS.items() if t == "pre"}


@query("t08_running_statistics", with_bound("pubs", sql=PRE + " SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{n}' AS name, count(*) AS total, CAST(max(\"LastUpdated\") AS VARCHAR) AS latest FROM pre WHERE {w}" for n, w in _ROWS.items()) + ") WHERE total > 0"))
def t08_statistics(spark, d):
    """The row checks of the publications, counted while these arrive."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", s.ROCKS)
    folder = run_dir(spark, "pubs-arriving")
    pubs = bound(spark, d, "pubs")
    for n in range(3):
        pubs.where(c("PID") % 3 == n).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(pubs.schema).parquet(folder)
    hits = CheckRun(stream, stream, AS_OF, names=list(_ROWS)).weighted_hits("LastUpdated")
    into = run_dir(spark, "statistics")
    s.running_totals(hits, "check", "n", "LastUpdated", "PID", dt.timedelta(hours=1), into, run_dir(spark, "statistics-log")).awaitTermination()
    return s.totals(spark, into).select("name", "total", c("latest").cast("date").alias("latest"))
