"""Merkle manifest, license scans and hard negatives on awkward rows, against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from bibweave.llm import hard_negatives, license_scan, merkle_manifest, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_text(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple(map(str, r)))


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# --- Merkle manifest


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def climb(nodes):
    """The levels above ``nodes`` and, per node, the siblings level by level."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[i : i + 16]) for i in range(0, len(below), 16)])
    paths = []
    for at in range(len(nodes)):
        path = []
        for below in levels[:-1]:
            begin = at - at % 16
            path.append((below[begin:at], below[at + 1 : begin + 16]))
            at //= 16
        paths.append(path)
    return levels[-1][0], paths


def manifest(rows):
    trees = defaultdict(list)
    for doc_id, source, lang, n_chars, text in rows:
        head = "".join(map(field, (doc_id, source, lang, n_chars)))
        leaf = sha(head, field(text))
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        trees[source].append(((doc_id is not None, doc_id or 0, leaf), doc_id, leaf, sha(head, field(text and text.translate(LOWER))) if hit else leaf))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for source in order:
        trees[source].sort(key=lambda r: r[0])
    lower = {s: climb([r[2] for r in trees[s]]) for s in order}
    root, upper = climb([lower[s][0] for s in order])
    for s, above in zip(order, upper):
        for (_, doc_id, leaf, other), path in zip(trees[s], lower[s][1]):
            for before, after in path + above:
                other = sha(*before, other, *after)
            yield doc_id, leaf, lower[s][0], root, sha(*(x for pair in path + above for side in pair for x in side)), other, other == root


ODD = [(None, None, None, None, None), (None, "b", "en", 3, "Ab"), (7, "b", None, 0, ""), (7, "b", None, 0, ""), (7, "b", None, 1, "x"), (5, "é", "en", 2, "LONG " * 20_000), (-9, "", "en", 2, "ÉA")]


def test_merkle_manifest(spark):
    rows = ODD + [(i, f"s{i % 19}" if i % 3 else "hot", "en", i, f"Text {i} ABC"[: i % 12]) for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    df = df.selectExpr("*", "'x' tree", "'x' node", "'x' pos", "'x' row", "'x' seq", "'x' part", "'x' members")
    got = merkle_manifest.build(merkle_manifest.leaves(df)).verified()
    assert by_text(got.collect()) == by_text(manifest(rows))
    one = df.where("doc_id = 5")
    assert by_text(merkle_manifest.build(merkle_manifest.leaves(one)).verified().collect()) == by_text(manifest([r for r in rows if r[0] == 5]))
    assert merkle_manifest.build(merkle_manifest.leaves(df.limit(0))).verified().count() == 0


def test_merkle_versions_share_nodes(spark):
    rows = [(i, "a" if i < 5000 else "b", "en", 1, f"Text {i}") for i in range(5400)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    made = merkle_manifest.build(merkle_manifest.leaves(df))
    nodes = {(r["source"], r["level"], r["place"]): r["node"] for r in made.nodes().collect()}
    assert sum(1 for s, level, _ in nodes if (s, level) == ("a", 0)) == 5000
    per_level = [sum(1 for s, level, _ in nodes if s == "a" and level == k) for k in range(5)]
    assert per_level == [5000, 313, 20, 2, 1]  # four levels: two blocks and one above them
    copied = defaultdict(dict)
    for r in made.versions().collect():
        copied[(r["source"], r["place"], r["doc_id"])][r["level"]] = r["node"]
    assert {k[2] for k in copied} == {i for i in range(5400) if zlib.crc32(str(i).encode()) % 5 == 0}
    for (source, place, _), path in random.Random(1).sample(sorted(copied.items()), 60):
        levels = 4 if source == "a" else 3
        assert len(path) == levels + 2  # from the leaf to the subroot, then the root
        for level in range(levels):  # every copied node is made of one copied node below and the base's others
            at = place // 16**level
            begin = at - at % 16
            run = [path[level] if i == at else nodes.get((source, level, i), "") for i in range(begin, begin + 16)]
            assert path[level + 1] == sha(*run)


# --- license scans

PHRASES = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}


def words_of(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER)) if w]


def base_places(words):
    return sorted((i, label) for label, p in PHRASES.items() for q in [p.split()] for i in range(len(words) - len(q) + 1) if words[i : i + len(q)] == q)


def scanned(text, drift=2, least=0.8):
    words, scores, labels = words_of(text), [0.0], set()
    for label, phrase in license_scan.NOTICES:
        t = words_of(phrase)
        k = min(3, len(t))
        cover = defaultdict(set)
        for i in range(len(words) - k + 1):
            for p in range(len(t) - k + 1):
                if words[i : i + k] == t[p : p + k]:
                    cover[i - p] |= set(range(p, p + k))
        for d in cover:
            scores.append(len(set().union(*(cover.get(d + e, set()) for e in range(-drift, drift + 1)))) / len(t))
            if scores[-1] >= least:
                labels.add(label)
    for phrase in PHRASES.values():  # what an exact template has on one diagonal
        t = phrase.split()
        k = min(3, len(t))
        scores += [1.0 for i in range(len(words) - len(t) + 1) if words[i : i + len(t)] == t]
    base = base_places(words)
    names = {label for _, label in base}
    return len(words), len(base), *((base[0][0], base[-1][0]) if base else (None, None)), ",".join(sorted(names)), ",".join(sorted(names | labels)), max(scores)


LICENSES = [
    None, "", "!!!", "cc", "cc by", "CC-BY, cc by cc by", "All rights\nreserved all rights reserved.", "all rights", "GNU General Public License", "general public",
    "Released under the MIT License.", "Released under a MIT License", "x Licensed under the Apache licence, Version 2.0 y", "Licensed under the great Apache License, Version 2.0",
    "Permission is hereby granted free of any charge, to any person obtaining a copy of this software and associated documentation files",
    "Permission is granted, free of charge, to any person obtaining a copy of software and associated documentation files",
    "all rights reserved " * 20_000, "é" * 50_000 + " cc by", "ccé by", "all rights reserved all rights", "This work is licensed under the GNU General Public License, version 3.",
]


def test_license_scan(spark):
    rng = random.Random(3)
    bits = [w for p in [*PHRASES.values(), *(p for _, p in license_scan.NOTICES)] for w in words_of(p)]
    texts = LICENSES + [" ".join(rng.choice(bits[:30]) for _ in range(rng.randrange(200))) for _ in range(60)]
    for _, p in license_scan.NOTICES:  # whole, with a word more, a word less, another word
        w = words_of(p)
        at = rng.randrange(1, len(w))
        texts += ["pad " * rng.randrange(5) + " ".join(x) for x in (w, w[:at] + ["extra"] + w[at:], w[:at] + w[at + 1 :], w[:at] + ["other"] + w[at + 1 :])]
    rows = [(i % 70 if i % 9 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    df = df.selectExpr("*", *(f"'x' {c}" for c in "label row words place diagonal exact key first template".split()))
    expected = by_text((k, *scanned(t)) for k, t in rows)
    templates = license_scan.templates(spark)
    assert by_text(license_scan.scan(df, templates).collect()) == expected
    found = license_scan.spans(license_scan.hits(df, templates, broadcast_bytes=0))  # the templates shuffled instead
    assert found.where("exact and whole").count() == sum(len(base_places(words_of(t))) for _, t in rows)
    assert license_scan.scan(df.limit(0), templates).count() == 0
    none = license_scan.templates(spark, [("x", "one")], [(None, "two words"), ("y", "")])
    assert license_scan.scan(df, none).where("score > 0 or labels != ''").count() == 0


def test_license_scan_plan_is_native(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = queries.op12_license_scan(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and docs.count()


# --- hard negatives


def mined(rows, scale=256, positives=5, negatives=10):
    sound = [(k, label, [math.floor(scale * float(np.float32(x))) for x in v]) for k, label, v in rows if None not in (k, label, v) and all(x is not None and math.isfinite(x) for x in v)]
    for a, (anchor, label, v) in enumerate(sound):
        if anchor % 100:
            continue
        scores = sorted(((-sum(x * y for x, y in zip(v, w)), k, other) for b, (k, other, w) in enumerate(sound) if b != a), key=lambda r: r[:2])
        for s, k, other in [r for r in scores if r[2] == label][:positives]:
            near = [(n, j) for n, j, o in scores if o != label and 30 * -s <= 100 * -n <= 90 * -s][:negatives]
            for rank, (n, j) in enumerate(near, 1):
                yield anchor, k, rank, j, -s, -n


def check_negatives(spark, rows, **sizes):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(5)
    df = df.selectExpr("*", *(f"'x' {c}" for c in "id number v cell block key score".split()))
    got = hard_negatives.mine(df, F.expr("id % 100 = 0"), **sizes)
    assert by_text(got.collect()) == by_text(mined(rows))
    return df


def test_hard_negatives(spark):
    rng = np.random.default_rng(5)
    odd = [(None, 1, [1.0]), (100, None, [1.0]), (200, 1, None), (300, 1, [1.0, None]), (300, 1, [1.0, float("nan")]), (400, 2, [float("inf")]), (500, 2, []), (-100, 3, [0.5, 0.25]), (-100, 3, [0.5, 0.25]), (600, 1, [2e13, 1e13])]
    rows = odd + [(1000 + i, int(rng.integers(4)) if i % 3 else 1, rng.normal(0, 0.3, 4 + i % 2).round(1).tolist()) for i in range(260)]
    rows += [(5000 + i, i % 2, [0.5, 0.5, 0.0, 0.0]) for i in range(150)]  # one vector many times: ties
    for sizes in ({}, {"block": 16, "anchors": 2}):
        df = check_negatives(spark, rows, **sizes)
    assert hard_negatives.mine(df.limit(0), F.expr("id % 100 = 0")).count() == 0
    assert hard_negatives.mine(df, F.expr("id < -1000")).count() == 0


def test_hard_negatives_scores_of_zero(spark):
    """A positive of score 0 takes negatives of score 0, also those of smaller id."""
    check_negatives(spark, [(100, 1, [1.0, 0.0]), (7, 2, [0.0, 1.0]), (8, 1, [0.0, 2.0]), (9, 2, [0.0, 3.0]), (10, 2, [-1.0, 0.0]), (11, 1, [-1.0, 0.0])], block=2)


def test_hard_negatives_copies_of_anchors_are_not_broadcast(spark):
    # a copy of all anchors goes to every cell, which Spark's estimate leaves out; broadcast, they filled the driver (F1)
    rows = [(i * 50, i % 3, [0.5, i / 300]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(4)
    got = hard_negatives.mine(df, F.expr("id % 100 = 0"), block=16, anchors=4)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [cell" in plan and "BroadcastHashJoin [cell" not in plan
    assert by_text(got.collect()) == by_text(mined(rows))


def test_hard_negatives_windows():
    rule = hard_negatives.Rule()
    for score in range(-50, 400):
        low, high = rule.window(score)
        assert [s for s in range(-60, 400) if 30 * score <= 100 * s <= 90 * score] == list(range(low, high + 1))
    with pytest.raises(ValueError):
        hard_negatives.Rule(low=50, high=120)
    scores = np.array([[1 << 62, -(1 << 63), 5, 1 << 62]])
    assert list(zip(*hard_negatives.best(scores, np.ones((1, 4), bool), 3))) == [(0, 0), (0, 3), (0, 2)]
