"""Name strings with parentheses of any depth, matched and unmatched, against a plain stack."""

import random

from pyspark.sql import functions as F

from bibweave.operators import names


def marked(text):
    """Outermost matched parentheses marked, by a stack."""
    stack, pairs = [], []
    for i, ch in enumerate(text):
        if ch == "(":
            stack.append(i)
        elif ch == ")" and stack:
            pairs.append((stack.pop(), i))
    outer = [p for p in pairs if not any(q[0] < p[0] and p[1] < q[1] for q in pairs)]
    out = list(text)
    for o, c in outer:
        out[o], out[c] = names.OPEN, names.CLOSE
    return "".join(out)


def test_outermost_groups(spark):
    rng = random.Random(7)
    deep = lambda n: "(" * n + "x;y" + ")" * n
    texts = ["", "a", "()", ")(", "((", "))", "(a (b) c", "a) (b) (c", "(a) b) (c (d)"] + [f"n {deep(n)} m {deep(2)};z" for n in range(1, 40)]
    texts += ["".join(rng.choice("((()));;ab") for _ in range(rng.randrange(60))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)) + [(-1, None)], "i int, t string")
    got = dict(df.select("i", names.with_groups_marked(F.col("t"))).collect())
    assert got == {i: marked(t) for i, t in enumerate(texts)} | {-1: None}


def test_authors_behind_deep_groups(spark):
    text = "A, B [u1abcdef] (" + "p (" * 30 + "core; x" + ")" * 30 + ") (Home [12]; unit);C, D (open;E, F"
    rows = names.parse_names(spark.createDataFrame([(1, text)], "PID long, Name string")).collect()
    assert [r["name"] for r in sorted(rows, key=lambda r: r["pos"])] == ["A, B", "C, D", "E, F"]
    first = min(rows, key=lambda r: r["pos"])
    assert first["extorg"] == "p (" * 30 + "core; x" + ")" * 30 and first["n_aff_ext"] == 2 and first["n_aff_own"] == 2 and first["staffid"] == "u1abcdef"


def test_a_record_is_parsed_once(spark):
    df = spark.createDataFrame([(1, "A, B [u1abcdef] (Ext; C);D, E"), (2, "D, E"), (3, None)], "PID long, Name string")
    plan = names.parse_names(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(__marked") == 1
    records = names.parse_records(df)
    assert "regexp" not in records._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["PID"], r["name"], r["n_pid"]) for r in records.collect()} == {(1, "A, B", 1), (1, "D, E", 2), (2, "D, E", 2)}
