"""Hot groups are divided and stay whole; blocked results equal brute force."""

import math
import random
import string

import pytest
from pyspark.sql import Window as W, functions as F

from bibweave.functions.distance import jaro_winkler, osa
from bibweave.operators import crosscheck, joins, linkage, ordered, search
from bibweave.operators.checks import check_ambiguous_orcid
from bibweave.operators.groups import collapse, with_count
from bibweave.operators.setops import compare_pairs

c = F.col


def test_collapse_divides_a_hot_key_and_loses_nothing(spark):
    df = spark.range(3000).select(F.when(c("id") < 2000, "hot").otherwise(F.concat(F.lit("k"), c("id") % 50)).alias("k"), c("id").alias("v"))
    rows = collapse(df, ["k"], "v", "vs", size=100).collect()
    hot = [r for r in rows if r.k == "hot"]
    assert len(hot) > 10 and max(len(r.vs.split()) for r in hot) < 300
    assert sorted(int(x) for r in hot for x in r.vs.split()) == list(range(2000))
    assert all(r.piece == 0 for r in rows if r.k != "hot")


def test_collapse_missing_key_and_value(spark):
    df = spark.createDataFrame([(None, "b"), (None, "a"), ("x", None), ("x", "c")], "k string, v string")
    got = {(r.k, r.vs) for r in collapse(df, ["k"], "v", "vs", keep_missing=True).collect()}
    assert got == {(None, "a b"), ("x", "c NA")}


def test_label_of_an_ambiguous_orcid_lists_all_its_staff_ids(spark):
    n = 5100
    authors = spark.range(n).select(
        c("id").alias("PID"), F.lit("0000-0001").alias("orcid"), F.format_string("u%05d", "id").alias("staffid"), F.lit("A, B").alias("name"), F.lit("x").alias("autid"),
    )
    labels = check_ambiguous_orcid(authors).groupBy("combo").agg(F.count("*").alias("rows")).collect()
    assert [r.rows for r in labels] == [n]
    assert labels[0].combo == f"0000-0001 (tot={n} ids={' '.join(f'u{i:05d}' for i in range(n))})"


def test_with_count_matches_missing_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("x", 3)], "k string, v int")
    assert sorted((r.v, r.n) for r in with_count(df, ["k"]).collect()) == [(1, 2), (2, 2), (3, 1)]


def _series(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice("abc") if i % 3 else "a", i * rnd.choice([1, 1, 7]) + i, rnd.choice([None, 1, 2, 3])) for i in range(400)]
    rows = list({(k, t): (k, t, v) for k, t, v in rows}.values())
    return spark.createDataFrame(rows, "k string, t int, v int")


@pytest.mark.parametrize("fan", [2, 1024])
def test_chunked_windows_equal_plain_windows(spark, monkeypatch, fan):
    monkeypatch.setattr(ordered, "FAN", fan)  # two chunks a level, so that values come over several levels
    df = _series(spark)
    cut = ordered.by_width("t", 37)
    w = W.partitionBy("k").orderBy("t")
    up_to = w.rowsBetween(W.unboundedPreceding, 0)
    want = df.select(
        "k", "t", F.row_number().over(w).alias("rn"), F.sum("v").over(up_to).alias("total"),
        F.last("v", ignorenulls=True).over(up_to).alias("filled"), F.lag("v").over(w).alias("prev"), F.lead("v").over(w).alias("next"))
    got = ordered.row_numbers(df, ["t"], cut, ["k"])
    got = ordered.running_total(got, "v", ["t"], cut, ["k"])
    got = ordered.fill_down(got, "v", ["t"], cut, ["k"], "filled")
    got = ordered.neighbour(got, "v", ["t"], cut, ["k"], "prev")
    got = ordered.neighbour(got, "v", ["t"], cut, ["k"], "next", ahead=True)
    key = lambda rows: {(r.k, r.t): (r.rn, r.total or 0, r.filled, r.prev, r.next) for r in rows}
    assert key(got.collect()) == key(want.collect())


def test_chunks_by_date(spark, monkeypatch):
    monkeypatch.setattr(ordered, "FAN", 40)
    df = spark.sql("SELECT date_add(DATE'2020-01-01', cast(id * 3 as int)) AS t, if(id % 5 = 0, id, null) AS v FROM range(300)")
    w = W.orderBy("t").rowsBetween(W.unboundedPreceding, 0)
    want = df.select("t", F.sum("v").over(w).alias("total"), F.last("v", ignorenulls=True).over(w).alias("filled")).collect()
    got = ordered.fill_down(ordered.running_total(df, "v", ["t"], F.trunc("t", "month")), "v", ["t"], F.trunc("t", "month"), name="filled")
    assert sorted((r.t, r.total, r.filled) for r in got.collect()) == sorted((r.t, r.total, r.filled) for r in want)


def test_chunk_numbers(spark):
    df = spark.range(51).withColumnRenamed("id", "i")
    sizes = lambda short: [r.n for r in ordered.chunk_numbers(df, ["i"], ordered.by_width("i", 7), 25, short_first=short).groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()]
    assert sizes(False) == [25, 25, 1]
    assert sizes(True) == [24, 25, 2]


def _variants(n, seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcde ") for _ in range(rnd.randint(2, 24))) for _ in range(n)]

    def edit(s):
        s = list(s)
        for _ in range(rnd.randint(0, 3)):
            i = rnd.randrange(len(s)) if s else 0
            kind = rnd.randrange(4)
            if kind == 0:
                s.insert(i, rnd.choice("abcde"))
            elif kind == 1 and s:
                del s[i]
            elif kind == 2 and s:
                s[i] = rnd.choice("abcde")
            elif len(s) > i + 1:
                s[i], s[i + 1] = s[i + 1], s[i]
        return "".join(s)

    return base, [edit(s) for s in base]


def test_fuzzy_pairs_find_every_pair_also_in_hot_groups(spark):
    a, b = _variants(60, 3)
    a += ["shared start of a title " + x for x in ("alpha", "beta", "gamma")] + ["ab"]
    b += ["shared start of a title " + x for x in ("alpah", "betta", "gam", "delta")] + ["ba", ""]
    left = spark.createDataFrame([(x,) for x in a], "t string")
    right = spark.createDataFrame([(x,) for x in b], "t string")
    for k in (1, 2, 3):
        want = {(x, y, osa(x, y)) for x in set(a) for y in set(b) if osa(x, y) <= k}
        for hot in (10**6, 0):
            got = {tuple(r) for r in linkage.fuzzy_pairs(left, right, "t", k, hot_pairs=hot).collect()}
            assert got == want, (k, hot, got ^ want)


def test_transposition_is_one_edit():
    assert osa("ab", "ba") == 1 and osa("ca", "abc") == 3


def test_best_matches_equal_brute_force(spark):
    rnd = random.Random(8)
    names = ["".join(rnd.choice(string.ascii_uppercase[:9]) for _ in range(rnd.randint(3, 12))) for _ in range(60)]
    other = [n[:-1] + rnd.choice("ABC") if rnd.random() < 0.6 else "".join(rnd.sample(n, len(n))) for n in names]
    got = {r.name: round(r.distance, 9) for r in linkage.best_matches(
        spark.createDataFrame([(x,) for x in names], "name string"), spark.createDataFrame([(x,) for x in other], "name string"), "name").collect()}
    want = {}
    for x in set(names):
        best = min(1 - jaro_winkler(x, y, scale=0.0) for y in other)
        if best <= 0.1 + 1e-12:
            want[x] = round(best, 9)
    assert got == want


def test_search_equals_brute_force(spark):
    rnd = random.Random(2)
    docs = [(i, " ".join(rnd.choice(["aa", "bb", "cc", "dd", "ee", "ff"]) if rnd.random() < 0.4 else f"w{rnd.randrange(40)}" for _ in range(rnd.randint(5, 60)))) for i in range(40)]
    asked = [(0, ["aa", "bb"]), (1, ["cc", "dd", "ee"]), (2, ["aa", "zz"]), (3, ["ff", "ff", "aa"])]
    terms = spark.createDataFrame([(q, i, t) for q, ts in asked for i, t in enumerate(ts)], "query int, idx int, term string")
    got = {(r.query, r.doc): r.score for r in search.search(spark.createDataFrame(docs, "id int, body string"), "id", "body", terms, near=4).collect()}
    avg = sum(len(b.split()) for _, b in docs) / len(docs)
    want = {}
    for q, ts in asked:
        for i, body in docs:
            words = body.split()
            spots = [p for p, w in enumerate(words) if w in ts]
            opens = [p for p in spots if set(ts) <= set(words[p:p + 6])]
            kept = [p for p in spots if any(o <= p <= o + 5 for o in opens)]
            if not kept:
                continue
            score = 0
            for t in ts:
                df = sum(t in b.split() for _, b in docs)
                idf = math.log((len(docs) - df + 0.5) / (df + 0.5))
                tf = sum(words[p] == t for p in kept)
                score += max(idf, 1e-6) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / avg))
            want[(q, i)] = score
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_compare_pairs_is_linear(spark):
    a = spark.createDataFrame([("k", i) for i in range(50)], "k string, v int")
    b = spark.createDataFrame([("k", i + 25) for i in range(50)] + [("only", 1)], "k string, v int")
    n = {r.status: r["count"] for r in compare_pairs(a, b, "k", "v").groupBy("status").count().collect()}
    assert n == {"same": 25, "differs": 50, "right": 1}


def test_wider_divides_a_hot_key_and_keeps_repetitions(spark):
    from bibweave.operators.reshape import wider

    df = spark.range(12000).select(F.lit("hot").alias("k"), F.when(c("id") % 2 == 0, "a").otherwise("b").alias("n"), c("id").alias("v"))
    twice = df.unionByName(df.where(c("v") < 10))
    rows = wider(twice, ["k"], "n", "v", ["a", "b"]).collect()
    assert len(rows) > 1
    values = sorted(int(x) for r in rows for cell in (r.a, r.b) if cell for x in cell.split("|"))
    assert values == sorted([*range(12000), *range(10)])


def test_snapshots_join_only_the_buckets_that_differ(spark):
    rows = [(i, f"v{i}", None if i % 7 else "") for i in range(3000)]
    old = spark.createDataFrame(rows + [(None, "n", None)], "k long, a string, b string")
    changed = [(k, a + "!" if k == 5 else a, None if k == 14 else b) for k, a, b in rows if k != 9] + [(None, "n", None), (9000, "new", None)]
    new = spark.createDataFrame(changed, "k long, a string, b string").repartition(3)
    digests = lambda t: crosscheck.snapshot_digests(t, "k", ["a", "b"], 512)
    assert crosscheck.differing_buckets(digests(old), digests(old.repartition(7))).count() == 0
    assert crosscheck.differing_buckets(digests(old), digests(new)).count() == 4
    twice = old.union(old.where("k = 3"))  # a row that repeats
    assert crosscheck.differing_buckets(digests(old), digests(twice)).count() == 1
    expected = {(5, "changed", "a", "v5", "v5!"), (14, "changed", "b", "", None), (9, "removed", None, None, None), (9000, "added", None, None, None)}
    for kept in (None, digests(old)):
        got = {tuple(r) for r in crosscheck.snapshot_changes(old, new, "k", ["a", "b"], 512, kept).collect() if r["k"] is not None}
        assert got == expected


def test_title_links_pass_nothing_through_the_driver(spark, tmp_path):
    def rows(titles, name):  # read from files, whose sizes Spark knows
        df = spark.createDataFrame(list(enumerate(titles)), "id int, title string").withColumn("number", c("id").cast("string"))
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    a, b = _variants(40, 4)
    left, right = rows(a, "left"), rows(b + b[:5], "right")
    for one, other in ((left, right), (right, left)):  # either side may be the smaller one
        got = linkage.title_links(one, other, k=2)
        plans = got._jdf.queryExecution().toString() + linkage.exact_links(one, other)._jdf.queryExecution().toString()
        assert "BroadcastExchange" not in plans
        pairs = {(r.left_title, r.right_title) for r in got.collect()}
        assert pairs == {(x, y) for x in set(r.title for r in one.collect()) for y in set(r.title for r in other.collect()) if osa(x, y) <= 2}


def test_join_with_many_pairs_is_divided_over_tasks(spark, tmp_path):
    from bibweave.plans.catalogue import QUERIES

    bal = ((c("id") * 37) % 101).cast("double")
    spark.range(200).select(c("id").alias("c_custkey"), (c("id") % 2).alias("c_nationkey"), bal.alias("c_acctbal")).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(30).select(c("id").alias("s_suppkey"), (c("id") % 2).alias("s_nationkey"), bal.alias("s_acctbal")).coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    pairs = QUERIES["j10_residual"](spark, str(tmp_path))
    assert pairs.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(map(tuple, pairs.collect())) == [(i, j) for i in range(200) for j in range(30) if i % 2 == j % 2 and i * 37 % 101 > j * 37 % 101]


def test_pairs_of_runs_equal_those_of_a_plain_join(spark):
    r = random.Random(2)
    value = lambda: r.choice([None, float("nan"), 0.0, -0.0, float("inf"), *(r.randrange(-9, 9) / 2 for _ in range(12))])
    left = [(r.randrange(40), r.choice([None, 1, 1, 1, 2, 3]), value()) for _ in range(300)] * 2
    right = [(r.randrange(20), r.choice([None, 1, 1, 2, 4]), value()) for _ in range(60)]
    a, b = spark.createDataFrame(left, "a long, k int, x double").repartition(5), spark.createDataFrame(right, "b long, l int, y double")
    expected = sorted(map(str, a.join(b, (c("k") == c("l")) & (c("x") > c("y"))).collect()))
    assert len(expected) > 3000
    for size in (1, 7, 64, 5000):
        got = joins.above(a, b, ("k", "l"), ("x", "y"), size)
        assert got.columns == [*a.columns, *b.columns] and sorted(map(str, got.collect())) == expected
    assert joins.above(a.limit(0), b, ("k", "l"), ("x", "y")).count() == joins.above(a, b.limit(0), ("k", "l"), ("x", "y")).count() == 0


def test_written_pairs_take_less_than_a_third_of_a_byte(spark, tmp_path):
    # in the order of a hash join these take twice that, and more with more suppliers (F2)
    from bibweave.plans.catalogue import QUERIES

    bal = lambda odd: ((c("id") * odd) % 10007).cast("double")
    spark.range(4000).select(c("id").alias("c_custkey"), (c("id") % 2).alias("c_nationkey"), bal(37).alias("c_acctbal")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(1000).select(c("id").alias("s_suppkey"), (c("id") % 2).alias("s_nationkey"), bal(101).alias("s_acctbal")).write.parquet(f"{tmp_path}/supplier.parquet")
    QUERIES["j10_residual"](spark, str(tmp_path)).write.parquet(f"{tmp_path}/pairs")
    rows = spark.read.parquet(f"{tmp_path}/pairs").count()
    assert rows > 900_000 and sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet")) < rows // 3


def test_search_looks_for_the_places_of_a_word_once(spark):
    # a lambda that uses an expression repeats it for every element, so each step must be a column of its own (F19)
    docs = spark.createDataFrame([(1, "alpha beta gamma"), (2, "alpha x x x x x x x x x x x x x x beta gamma"), (3, "beta alpha"), (3, "beta alpha"), (None, "alpha beta")], "doc long, text string")
    terms = spark.createDataFrame([(7, 0, "alpha"), (7, 1, "beta"), (8, 0, "gamma"), (None, 0, "alpha"), (9, 0, "absent"), (9, 1, "alpha")], "query long, idx int, term string")
    hits = search.search(docs, "doc", "text", terms)
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("exists(") == 3
    found = {(r["query"], r["doc"]) for r in hits.collect()}
    assert found == {(7, 1), (7, 3), (8, 1), (8, 2)}
