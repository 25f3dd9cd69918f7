"""Check digits: a generated number is accepted, one wrong digit is not."""

from hypothesis import given, settings, strategies as st

from bibweave.functions import identifiers as ids
from pyspark.sql import functions as F


def issn(body):
    r = (11 - sum(int(d) * (8 - i) for i, d in enumerate(body)) % 11) % 11
    return body + ("X" if r == 10 else str(r))


def isbn10(body):
    r = (11 - sum(int(d) * (10 - i) for i, d in enumerate(body)) % 11) % 11
    return body + ("X" if r == 10 else str(r))


def isbn13(body):
    return body + str(-sum(int(d) * (3 if i % 2 else 1) for i, d in enumerate(body)) % 10)


def digits(n):
    return st.text("0123456789", min_size=n, max_size=n)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(digits(7), digits(9), digits(12), st.integers(0, 6), st.integers(1, 9)), min_size=20, max_size=40))
def test_one_wrong_digit_is_found(spark, cases):
    def spoil(s, at, by):
        return s[:at] + str((int(s[at]) + by) % 10) + s[at + 1:]

    rows = []
    for a, b, c13, at, by in cases:
        good = issn(a), isbn10(b), isbn13(c13)
        rows.append((*good, True))
        rows.append((*[spoil(g, at, by) for g in good], False))
    df = spark.createDataFrame(rows, "a string, b string, c string, want boolean")
    got = df.select("want", ids.issn_ok(F.col("a")).alias("a"), ids.isbn10_ok(F.col("b")).alias("b"), ids.isbn13_ok(F.col("c")).alias("c")).collect()
    assert all(r.a == r.b == r.c == r.want for r in got)
