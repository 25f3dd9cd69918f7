"""Graph of ids against union-find; event-time streams: late rows, repeats that expire, totals that a replay leaves alone."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from bibweave.operators import components as graph
from bibweave.plans.bindings import AS_OF, bound
from bibweave.plans.check_run import CheckRun
from bibweave.plans.queries_checks import ROW_COUNTS
from bibweave.session import run_dir
from bibweave.streaming import events as s

T0 = dt.datetime(2024, 1, 1)


def joined(pairs):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        for x in (a, b):
            if x is not None:
                root(x)
        if a is not None and b is not None:
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(up)}


@pytest.mark.parametrize("salts", [1, 7])
def test_components(spark, salts):
    rng = random.Random(salts)
    pairs = [(f"c{i:03}", f"c{i + 1:03}") for i in range(50)]  # a chain
    pairs += [("hub", f"h{i:04}") for i in range(1500)] + [(f"h{i:04}", "hub") for i in range(40)]  # a hub, some pairs twice
    pairs += [(f"r{rng.randrange(400):03}", f"r{rng.randrange(400):03}") for _ in range(300)]
    pairs += [("alone", None), (None, "single"), ("self", "self"), (None, None)]
    rng.shuffle(pairs)
    df = spark.createDataFrame(pairs, "a string, b string").withColumn("m", F.lit("x")).withColumn("salt", F.lit(1))
    got = graph.components(df, "a", "b", salts).collect()
    assert len(got) == len({r[0] for r in got})
    assert {r["id"]: r["component"] for r in got} == joined(pairs)
    assert graph.components(df.limit(0), "a", "b").count() == 0


def test_rounds_of_components_shrink(spark, monkeypatch):
    rng = random.Random(3)
    names = [f"c{i:04}" for i in rng.sample(range(9000), 1200)]
    pairs = list(zip(names, names[1:])) + [("hub", f"h{i:04}") for i in range(1200)]
    written, write = [], graph.cut_lineage

    def noted(df, purpose):
        out = write(df, purpose)
        if out.columns == ["a", "b"]:
            written.append(out.count())
        return out

    monkeypatch.setattr(graph, "cut_lineage", noted)
    got = dict(graph.components(spark.createDataFrame(pairs, "a string, b string"), "a", "b").collect())
    assert got == joined(pairs)
    assert written[0] == len(pairs) and written[-1] == 0 and sum(written) < 4 * len(pairs)


def test_merge_candidates(spark):
    rows = [(1, "o1", "s1"), (2, "o1", "s2"), (3, "o2", "s2"), (4, "o3", "s3"), (4, "o3", "s3"), (5, None, "s4"), (6, "o4", None), (7, None, None), (8, "o2", None)]
    df = spark.createDataFrame(rows, "PID long, orcid string, staffid string")
    got = {tuple(r) for r in graph.merge_candidates(df, ["orcid", "staffid"], "staffid").collect()}
    first = "orcid:o1"
    assert got == {(first, "orcid", "o1", 4, 2, 2), (first, "orcid", "o2", 4, 2, 2), (first, "staffid", "s1", 4, 2, 1), (first, "staffid", "s2", 4, 2, 2)}


def arriving(spark, batches):
    """A stream whose batches are the lists of (minutes, key)."""
    folder = run_dir(spark, "arriving")
    for rows in batches:
        spark.createDataFrame([(T0 + dt.timedelta(minutes=m), k) for m, k in rows], "ts timestamp, k string").coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema("ts timestamp, k string").option("maxFilesPerTrigger", 1).parquet(folder)


def minutes(t):
    return int((t - T0).total_seconds() // 60)


def test_windows_and_late_rows_add_up(spark):
    rng = random.Random(4)
    batches = [[(rng.randrange(60 * b, 60 * b + 90), "k") for _ in range(40)] + [(rng.randrange(30 * b + 1), "old") for _ in range(10)] for b in range(6)]
    batches.append([(10_000, "end")])
    into, log = run_dir(spark, "late"), run_dir(spark, "log")
    end = F.window("ts", "10 minutes")["end"]
    s.write_late(arriving(spark, batches).withColumn("end", end), "ts", F.col("end"), dt.timedelta(minutes=20), into, log).awaitTermination()
    late = spark.read.parquet(f"{into}/late").collect()
    out = run_dir(spark, "windows")
    s.append(s.windowed(arriving(spark, batches), "ts", s.tumbling("ts", "10 minutes"), "20 minutes", ["k"], n=F.count(F.lit(1))), out, run_dir(spark, "log")).awaitTermination()
    counted = spark.read.parquet(out).collect()
    left, marks = defaultdict(int), [max((m for b in batches[: n - 1] for m, _ in b), default=None) if n > 1 else None for n in range(len(batches))]
    for n, batch in enumerate(batches):
        for m, k in batch:
            e = m // 10 * 10 + 10
            left[(e, k, marks[n] is not None and e <= marks[n] - 20)] += 1
    assert sum(v for (_, _, is_late), v in left.items() if is_late) == len(late) > 20
    expected = {(e, k): v for (e, k, is_late), v in left.items() if not is_late and k != "end"}
    assert {(minutes(r["window_end"]), r["k"]): r["n"] for r in counted} == expected
    assert len(counted) == len(expected)  # no window comes out twice


def test_sessions(spark):
    batches = [[(0, "a"), (5, "a"), (30, "a")], [(12, "a"), (39, "a"), (50, "b")], [(500, "z")]]
    out = run_dir(spark, "sessions")
    s.append(s.windowed(arriving(spark, batches), "ts", s.session("ts", "10 minutes"), "60 minutes", ["k"], n=F.count(F.lit(1))), out, run_dir(spark, "log")).awaitTermination()
    got = {(minutes(r["window_start"]), minutes(r["window_end"]), r["k"], r["n"]) for r in spark.read.parquet(out).collect()}
    assert got == {(0, 22, "a", 3), (30, 49, "a", 2), (50, 60, "b", 1)}


def test_repeats_are_dropped_within_the_delay_only(spark):
    batches = [[(0, "a"), (1, "b")], [(8, "a"), (30, "z")], [(32, "z")], [(33, "b"), (60, "a")]]
    once = s.once_within(arriving(spark, batches), "ts", ["k"], "10 minutes")
    out = run_dir(spark, "once")
    s.append(once, out, run_dir(spark, "log")).awaitTermination()
    got = sorted((minutes(r["ts"]), r["k"]) for r in spark.read.parquet(out).collect())
    assert got == [(0, "a"), (1, "b"), (30, "z"), (33, "b"), (60, "a")]  # a at 8 is within, b at 33 and a at 60 are beyond


def test_running_statistics(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", s.ROCKS)
    pubs = bound(spark, "/root/testdata/sf0.001", "pubs")
    names = [n for n, (t, _) in ROW_COUNTS.items() if t == "pre"] + ["invalid_ISSN"]
    folder, into, log = run_dir(spark, "pubs"), run_dir(spark, "totals"), run_dir(spark, "log")

    def arrive(part):
        pubs.where(F.col("PID") % 3 == part).write.mode("append").parquet(folder)

    def go():
        stream = spark.readStream.schema(pubs.schema).option("maxFilesPerTrigger", 3).parquet(folder)
        hits = CheckRun(stream, stream, AS_OF, names=names).weighted_hits("LastUpdated")
        s.running_totals(hits, "check", "n", "LastUpdated", "PID", dt.timedelta(hours=1), into, log, parts=3).awaitTermination()
        return {r["name"]: r["total"] for r in s.totals(spark, into).collect()}

    def expected():
        now = spark.read.parquet(folder)
        return {r["name"]: r["value"] for r in CheckRun(now, now, AS_OF, names=names).statistics().collect() if r["value"]}

    arrive(0)
    arrive(1)
    assert go() == expected()
    assert go() == expected()  # nothing new: a start from the checkpoint changes nothing
    arrive(2)
    first = go()
    assert first == expected()
    last = max(int(p.rsplit("=", 1)[1]) for p in _folders(spark, into))
    copy = run_dir(spark, "copy")
    spark.read.parquet(f"{into}/batch_id={last}").write.parquet(copy)
    spark.read.parquet(copy).write.mode("overwrite").parquet(f"{into}/batch_id={last}")  # a batch that runs again
    assert {r["name"]: r["total"] for r in s.totals(spark, into).collect()} == first


def _folders(spark, path):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [str(f.getPath()) for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path) if "batch_id=" in str(f.getPath())]


def test_timers_tell_what_has_become_quiet(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", s.ROCKS)
    into, log, folder = run_dir(spark, "totals"), run_dir(spark, "log"), run_dir(spark, "arriving")

    def go(rows, idle):
        spark.createDataFrame([(T0 + dt.timedelta(minutes=m), k, 2) for m, k in rows], "ts timestamp, k string, n int").coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema("ts timestamp, k string, n int").parquet(folder)
        s.running_totals(stream, "k", "n", "ts", "ts", idle, into, log, parts=2).awaitTermination()
        return {r["name"]: (r["total"], minutes(r["latest"]), r["quiet"]) for r in s.totals(spark, into).collect()}

    assert go([(0, "old")], dt.timedelta(0)) == {"old": (2, 0, True)}
    assert go([(100, "busy"), (99, "busy")], dt.timedelta(hours=1)) == {"old": (2, 0, True), "busy": (4, 100, False)}
    # a row older than all others counts, and wakes its name again
    assert go([(-7, "old")], dt.timedelta(hours=1)) == {"old": (4, 0, False), "busy": (4, 100, False)}
