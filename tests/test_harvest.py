"""The store takes each version once, the newer one wins, a replay is silent."""

import datetime as dt

from bibweave.operators import mods
from bibweave.session import run_dir
from bibweave.streaming import harvest


def _batch(spark, rows):
    doc = "<record><header{s}/><mods><titleInfo><title>{t}</title></titleInfo><recordInfo><recordIdentifier>rec:{i}</recordIdentifier></recordInfo></mods></record>"
    data = [(f"oai:{i}", dt.datetime(2024, 1, day), doc.format(i=i, t=t, s=s)) for i, day, t, s in rows]
    return spark.createDataFrame(data, "identifier string, datestamp timestamp, mods string")


def test_upsert_replay_and_compaction(spark):
    store = run_dir(spark, "store")
    harvest.ensure_store(spark, store)
    harvest.apply_batch(_batch(spark, [(1, 1, "a", ""), (1, 2, "b", ""), (2, 1, "c", "")]), 0, store)
    harvest.apply_batch(_batch(spark, [(2, 3, "d", ' status="deleted"'), (3, 1, "e", "")]), 1, store)
    harvest.apply_batch(_batch(spark, [(9, 9, "never", "")]), 1, store)  # a replayed number
    rows = {r.identifier: r.datestamp.day for r in harvest.current(spark, store, "ids").collect()}
    assert rows == {"oai:1": 2, "oai:2": 3, "oai:3": 1}
    extra = {r.identifier: (r.PID, r.status) for r in harvest.current(spark, store, "extra").collect()}
    assert extra == {"oai:1": ("1", None), "oai:2": ("2", "deleted"), "oai:3": ("3", None)}
    n = lambda t: harvest.current(spark, store, t).count()
    assert n("ids") == n("mods") == n("extra") == 3
    smaller = run_dir(spark, "compact")
    harvest.compact(spark, store, smaller)
    assert sorted(map(tuple, harvest.current(spark, smaller, "ids").collect())) == sorted(map(tuple, harvest.current(spark, store, "ids").collect()))


def test_uncommitted_rows_are_not_seen(spark):
    store = run_dir(spark, "store")
    harvest.ensure_store(spark, store)
    _batch(spark, [(1, 1, "a", "")]).select("identifier", "datestamp").write.parquet(f"{store}/ids/batch_id=7")
    assert harvest.current(spark, store, "ids").count() == 0


def test_versions_in_any_order(spark):
    """The newest version wins, the newest one with an id is enriched; a late, a repeated and an undated one change nothing."""
    store = run_dir(spark, "store")
    harvest.ensure_store(spark, store, buckets=3)
    without = "<record><header/><mods><x>{}</x></mods></record>"
    at = lambda day: dt.datetime(2024, 1, day)
    bare = lambda rows: spark.createDataFrame([(f"oai:{i}", d and at(d), without.format(t)) for i, d, t in rows], "identifier string, datestamp timestamp, mods string")
    harvest.apply_batch(_batch(spark, [(1, 5, "e", ""), (1, 4, "d", "")]).union(bare([(1, 6, "f"), (2, None, "n")])), 0, store)
    harvest.apply_batch(_batch(spark, [(1, 3, "late", ""), (1, 5, "again", ""), (2, 1, "a", "")]).union(bare([(2, None, "m")])), 1, store)
    harvest.apply_batch(bare([(2, 7, "g"), (3, 1, "h")]).union(_batch(spark, [(2, 6, "b", "")])), 2, store)
    assert {r.identifier: r.datestamp.day for r in harvest.current(spark, store, "ids").collect()} == {"oai:1": 6, "oai:2": 7, "oai:3": 1}
    assert {r.identifier: r.mods for r in harvest.current(spark, store, "mods").collect()} == {f"oai:{i}": without.format(t) for i, t in ((1, "f"), (2, "g"), (3, "h"))}
    extra = lambda where: {(r.identifier, r.PID, r.datestamp.day) for r in harvest.current(spark, where, "extra").collect()}
    assert extra(store) == {("oai:1", "1", 5), ("oai:2", "2", 6)}
    smaller = run_dir(spark, "compact")
    harvest.compact(spark, store, smaller)
    assert extra(smaller) == extra(store)
    harvest.apply_batch(_batch(spark, [(1, 6, "same day", ""), (3, 2, "i", "")]), 0, smaller)
    assert extra(smaller) == {("oai:1", "1", 6), ("oai:2", "2", 6), ("oai:3", "3", 2)}
    assert {r.identifier: r.datestamp.day for r in harvest.current(spark, smaller, "ids").collect()} == {"oai:1": 6, "oai:2": 7, "oai:3": 2}


def test_a_batch_reads_its_buckets_only(spark):
    """However many batches there were, the state has one file set per bucket, and a batch rewrites only those it changes."""
    store = run_dir(spark, "store")
    harvest.ensure_store(spark, store, buckets=8)
    harvest.apply_batch(_batch(spark, [(i, 1, "a", "") for i in range(100)]), 0, store)
    assert set(harvest.manifest(spark, store)[1].values()) == {0}
    for n in range(1, 4):
        harvest.apply_batch(_batch(spark, [(7, n, "b", "")]), n, store)
    buckets, named = harvest.manifest(spark, store)
    (changed,) = [b for b, v in named.items() if v != 0]  # the first of these batches brought nothing new
    assert buckets == len(named) == 8 and named[changed] == 3 and sorted(named.values())[:7] == [0] * 7
    assert len(harvest.state(spark, store, {changed}).inputFiles()) == 1
    assert harvest.current(spark, store, "ids").count() == 100


def test_malformed_records_are_listed_not_raised(spark):
    good = mods.HEAD + "<titleInfo><title>x</title></titleInfo></mods>"
    df = spark.createDataFrame([(1, good), (2, good[:-4]), (3, "no xml")], "sid int, mods string")
    wanted = spark.createDataFrame([(i,) for i in range(1, 6)], "sid int")
    assert sorted(r.sid for r in mods.failures(wanted, df).collect()) == [2, 3, 4, 5]
