"""Suffix deduplication against brute force: repeated ids, and minimisers that many texts share."""

import hashlib
import random

import pytest

from bibweave.llm import suffix_dedup


def without_repeats(rows, length):
    """By (id, SHA-256 of the text): kept bytes of each row."""
    seen, kept = set(), {}
    for k, t in sorted({(k, t) for k, t in rows if k is not None}, key=lambda x: (x[0], hashlib.sha256(x[1].encode()).digest())):
        data = t.encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if data[i : i + length] in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(data[i : i + length])
        kept[k, t] = bytes(x for x, g in zip(data, gone) if not g)
    return sorted(((k, kept.get((k, t), t.encode())) for k, t in rows), key=str)


def noise(r, n):
    return "".join(r.choices("abcdefghijklmnopqrstuvwxyz ", k=n))


@pytest.mark.parametrize("parts", [1, 7])
def test_repeated_ids(spark, parts):
    r = random.Random(6)
    a, b, c = noise(r, 700), noise(r, 400), noise(r, 300)
    rows = [(3, a), (3, a), (3, a), (4, a), (4, noise(r, 800)), (5, b + c), (5, noise(r, 200) + c), (5, b + c), (None, a), (None, a), (6, "x" * 300), (6, "x" * 300), (1, c)]
    got = suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts))
    assert sorted(((x["doc_id"], bytes(x["kept"])) for x in got.collect()), key=str) == without_repeats(rows, 100)


def test_a_passage_that_many_texts_share(spark):
    r = random.Random(7)
    passage = noise(r, 250)
    rows = [(i, noise(r, r.randint(0, 150)) + passage[r.randint(0, 3) :] + noise(r, r.randint(60, 150))) for i in range(400)]
    rows += [(400 + i, rows[i][1][:-20]) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for heavy in (20, suffix_dedup.HEAVY):
        got = suffix_dedup.without_repeats(df, heavy=heavy)
        assert sorted(((x["doc_id"], bytes(x["kept"])) for x in got.collect()), key=str) == without_repeats(rows, 100)
    largest, most = {}, suffix_dedup.MOST
    for heavy in (20, suffix_dedup.HEAVY):
        size = {}
        docs = df.selectExpr("doc_id as doc", "text")
        for owner, _, body in suffix_dedup.sent(docs, 100, suffix_dedup.SET_BITS, suffix_dedup.GRAM, most, heavy).where("kind").collect():
            size[owner] = size.get(owner, 0) + len(suffix_dedup._unpacked(body, 4)[0][0])
        largest[heavy] = max(size.values()) / sum(size.values())
    assert largest[20] < 0.1 < largest[suffix_dedup.HEAVY]
