"""Hard negatives of anchors by a secondary-sort shuffle.

An anchor's positives are its best rows of the same label; a row of another label is a hard negative of a positive if its score
lies in the window that the positive's score opens. Scores are integer inner products. The pairs of an anchor reach one partition
under keys packed of (anchor, descending score, kind, id), so that sorting bytes sorts pairs: ``repartition`` on the anchor and
``sortWithinPartitions`` on the key, the DataFrame form of repartitionAndSortWithinPartitions. One pass over the sorted pairs
opens a window at each positive and hands out negatives until the window has enough; it holds an anchor's open windows, never
its pairs.

Rows are packed to blocks of ``BLOCK`` rows where they lie, anchors likewise. Blocks of rows are dealt to as many cells as there
are shuffle partitions, every block of anchors goes to every cell, and a merge join on the cell lets each block of rows meet each
block of anchors once; neither side is broadcast. A meeting is one product of matrices, and it hands on only pairs that can still
win: first the best ``positives`` rows per anchor; then, when all positives and so all windows are known, the best ``negatives``
rows per window. What is left out has as many better rows in its own block, so the result is that of all pairs.

Rows with a null label or vector, or with a null or non-finite component (also one that ``scale`` times it is no finite double),
take no part; nor do rows without an id. Rows that repeat an id are rows of their own, each an anchor if its id says so, and don't
count as the same row. Vectors of unlike lengths are compared over what both have; an empty vector scores 0 with all. Scores beyond 64 bits are set to the nearest long.
Ties go to the smaller id, then to the row that comes first in its table. Columns besides the three play no part, whatever
their names. An anchor without positives, or a positive without negatives, has no rows; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from bibweave.session import cut_lineage

#: Rows of a block, and of a block of anchors: a meeting takes some 100 bytes per pair of them.
BLOCK, ANCHORS = 4_096, 512
_SIGN, _LOWEST, _HIGHEST = np.uint64(1 << 63), -(1 << 63), (1 << 63) - 1
_PACKED = "ids binary, numbers binary, labels binary, kind string, wide int, vectors binary"
_PAIRS = "block long, anchor long, key binary"
#: A sort key: every field is big-endian with the sign turned, the score inverted.
_KEY = np.dtype([("anchor", ">u8"), ("row", ">u8"), ("score", ">u8"), ("negative", "u1"), ("id", ">u8"), ("number", ">u8")])


@dataclass(frozen=True)
class Rule:
    """How many positives and negatives, and the window in hundredths of the positive's score."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90

    def __post_init__(self):
        if not 0 <= self.low < self.high <= 100:  # else negatives could come before the positive that wants them
            raise ValueError("a window lies between 0 and 100 hundredths")

    def window(self, score: int) -> tuple[int, int]:
        """The lowest and highest score s with ``low * score <= 100 * s <= high * score``."""
        return -(-self.low * score // 100), self.high * score // 100


def chosen(rows: DataFrame, key: str, vector: str, label: Column, scale: int) -> DataFrame:
    """id, number (of its own), label, v of the rows that take part."""
    own = rows.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    unsound = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x * scale) == float("inf")))
    return own.where("id is not null and label is not null and v is not null").where(~unsound).select("id", F.monotonically_increasing_id().alias("number"), "label", "v")


def _matrix(v: pa.ListArray, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, short vectors filled with zeros."""
    lengths = np.diff(v.offsets.to_numpy())
    out = np.zeros((len(lengths), int(lengths.max(initial=0))))
    out[np.arange(out.shape[1]) < lengths[:, None]] = v.flatten().to_numpy()
    return np.floor(scale * out)


def _packing(size: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                ids, numbers, labels = (part.column(c).to_numpy(zero_copy_only=False) for c in ("id", "number", "label"))
                order = np.lexsort((numbers, ids))
                v = _matrix(part.column("v"), scale)[order]
                most = np.abs(v).max(initial=0)
                kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"
                packed = {"ids": ids[order].astype("<i8"), "numbers": numbers[order].astype("<i8"), "labels": labels[order].astype("<i8"), "vectors": v.astype(kind)}
                row = {k: x.tobytes() for k, x in packed.items()} | {"kind": kind, "wide": v.shape[1]}
                yield pa.RecordBatch.from_pylist([row], schema)

    schema = pa.schema([("ids", pa.binary()), ("numbers", pa.binary()), ("labels", pa.binary()), ("kind", pa.string()), ("wide", pa.int32()), ("vectors", pa.binary())])
    return run


class Block:
    """A packed block: ids, numbers and labels in the order of (id, number), and the vectors."""

    def __init__(self, row: dict, prefix: str = ""):
        self.ids, self.numbers, self.labels = (np.frombuffer(row[f"{prefix}{c}"], "<i8") for c in ("ids", "numbers", "labels"))
        self.v = np.frombuffer(row[f"{prefix}vectors"], row[f"{prefix}kind"]).reshape(len(self.ids), row[f"{prefix}wide"])

    def scores(self, rows: Block) -> np.ndarray:
        """All inner products, as longs."""
        wide = min(self.v.shape[1], rows.v.shape[1])
        a, b = self.v[:, :wide].astype(float), rows.v[:, :wide].astype(float)
        if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * wide < 1 << 53:  # every sum is exact
            return (a @ b.T).astype(np.int64)
        whole = lambda m: np.array([[int(x) for x in line] for line in m.tolist()], object).reshape(m.shape)
        exact = whole(a) @ whole(b).T
        return np.array([[min(max(x, _LOWEST), _HIGHEST) for x in line] for line in exact.tolist()], np.int64).reshape(exact.shape)


def best(scores: np.ndarray, allowed: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, column) of the ``most`` highest allowed scores of every line; of equal ones the first columns."""
    n = scores.shape[1]
    lines = np.flatnonzero(allowed.any(axis=1))
    if scores.max(initial=0) >= 1 << 48 or scores.min(initial=0) <= -(1 << 48):  # too large to carry the column along
        found = [(i, j) for i in lines.tolist() for j in sorted(np.flatnonzero(allowed[i]).tolist(), key=lambda j: (-int(scores[i, j]), j))[:most]]
        return tuple(np.array(found, np.int64).reshape(-1, 2).T)
    ranked = np.where(allowed[lines], scores[lines] * n + np.arange(n - 1, -1, -1), _LOWEST)
    columns = np.argpartition(ranked, n - most, axis=1)[:, n - most :] if n > most else np.broadcast_to(np.arange(n), ranked.shape)
    i, j = np.nonzero(np.take_along_axis(ranked, columns, axis=1) > _LOWEST)
    return lines[i], columns[i, j]


def _keys(block: int, anchors: Block, rows: Block, scores: np.ndarray, i: np.ndarray, j: np.ndarray, negative: bool) -> pa.RecordBatch:
    turned = lambda x: x.view(np.uint64) ^ _SIGN
    keys = np.empty(len(i), _KEY)
    keys["anchor"], keys["row"] = turned(anchors.ids)[i], turned(anchors.numbers)[i]
    keys["score"], keys["negative"] = ~turned(np.ascontiguousarray(scores[i, j])), negative
    keys["id"], keys["number"] = turned(rows.ids)[j], turned(rows.numbers)[j]
    packed = pa.Array.from_buffers(pa.binary(_KEY.itemsize), len(keys), [None, pa.py_buffer(keys.tobytes())]).cast(pa.binary())
    return pa.RecordBatch.from_pydict({"block": pa.array(np.full(len(i), block)), "anchor": pa.array(anchors.numbers[i]), "key": packed})


def _read(keys: pa.Array) -> dict[str, list[int]]:
    found = np.frombuffer(b"".join(keys.to_pylist()), _KEY)
    turned = lambda c: (found[c].astype(np.uint64) ^ _SIGN).view(np.int64).tolist()
    return {c: turned(c) for c in ("anchor", "row", "id", "number")} | {
        "score": (~found["score"].astype(np.uint64) ^ _SIGN).view(np.int64).tolist(), "negative": found["negative"].tolist(),
    }


def _meetings(batches: Iterator[pa.RecordBatch], found) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            anchors, rows = Block(row, "a_"), Block(row)
            yield found(row, anchors, rows, anchors.scores(rows))


def _positives(rule: Rule):
    def found(row: dict, anchors: Block, rows: Block, scores: np.ndarray) -> pa.RecordBatch:
        alike = (anchors.labels[:, None] == rows.labels) & (anchors.numbers[:, None] != rows.numbers)
        return _keys(row["block"], anchors, rows, scores, *best(scores, alike, rule.positives), False)

    return lambda batches: _meetings(batches, found)


def _negatives(rule: Rule):
    def found(row: dict, anchors: Block, rows: Block, scores: np.ndarray) -> pa.RecordBatch:
        low, high = np.full((len(anchors.ids), rule.positives), _HIGHEST), np.full((len(anchors.ids), rule.positives), _LOWEST)
        at, used = {x: i for i, x in enumerate(anchors.numbers.tolist())}, [0] * len(anchors.ids)
        for w in row["windows"]:
            i = at[w["anchor"]]
            low[i, used[i]], high[i, used[i]] = rule.window(w["score"])
            used[i] += 1
        other, pairs = anchors.labels[:, None] != rows.labels, np.zeros(0, np.int64)
        for p in range(rule.positives):
            i, j = best(scores, other & (scores >= low[:, p, None]) & (scores <= high[:, p, None]), rule.negatives)
            pairs = np.union1d(pairs, i * len(rows.ids) + j)
        return _keys(row["block"], anchors, rows, scores, pairs // len(rows.ids), pairs % len(rows.ids), True)

    return lambda batches: _meetings(batches, found)


def _first(rule: Rule):
    """The first positives of every anchor, from its sorted pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, taken = None, 0
        for batch in batches:
            pairs, keep = _read(batch.column("key")), []
            for i, anchor in enumerate(pairs["row"]):
                if anchor != current:
                    current, taken = anchor, 0
                if taken < rule.positives:
                    taken += 1
                    keep.append(i)
            yield pa.RecordBatch.from_pydict({
                **{c: batch.column(c).take(pa.array(keep, pa.int64())) for c in ("block", "anchor", "key")},
                "score": pa.array([pairs["score"][i] for i in keep], pa.int64()),
            })

    return run


def _mined(rule: Rule):
    """Opens a window at each positive of the sorted pairs and hands out the negatives that fall into open ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, windows = None, []
        for batch in batches:
            pairs, out = _read(batch.column("key")), []
            for anchor, row, score, negative, other in zip(*(pairs[c] for c in ("anchor", "row", "score", "negative", "id"))):
                if row != current:
                    current, windows = row, []
                if not negative:
                    windows.append([other, score, *rule.window(score), 0])
                    continue
                for w in windows:
                    if w[2] <= score <= w[3] and w[4] < rule.negatives:
                        w[4] += 1
                        out.append((anchor, w[0], w[4], other, w[1], score))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, schema.types)], schema=schema)

    schema = pa.schema([(c, pa.int32() if c == "rank" else pa.int64()) for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")])
    return run


def _sorted(pairs: DataFrame) -> DataFrame:
    """The secondary sort: an anchor's pairs in one partition, in the order of their keys."""
    return pairs.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "anchor").sortWithinPartitions("key")


def mine(
    rows: DataFrame, anchor: Column, key: str = "vec_id", vector: str = "embedding", label: Column | None = None, scale: int = 256,
    rule: Rule = Rule(), block: int = BLOCK, anchors: int = ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` is a condition on the column ``id``; components become floor(``scale`` * x); ``label`` is the column ``label`` if not given.
    """
    sound = chosen(rows, key, vector, F.col("label") if label is None else label, scale)
    packed = cut_lineage(sound.mapInArrow(_packing(block, scale), _PACKED), "negatives-rows")
    # the anchors are found among the packed rows, so that a row has one number, however often the table is read
    opened = packed.mapInArrow(_unpacked, "id long, number long, label long, v array<double>").where(anchor)
    few = cut_lineage(opened.mapInArrow(_packing(anchors, 1), _PACKED).withColumn("block", F.monotonically_increasing_id()), "negatives-anchors")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = packed.withColumn("cell", F.expr(f"pmod(xxhash64(monotonically_increasing_id()), {parts}L)"))

    def met(few: DataFrame) -> DataFrame:
        sent = few.select(*(F.col(c).alias(f"a_{c}") for c in packed.columns), *(c for c in few.columns if c not in packed.columns))
        sent = sent.withColumn("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
        # merged: Spark takes the copies of the anchors for no larger than the anchors, and would broadcast them through the driver
        return sent.repartition(parts, "cell").join(dealt.repartition(parts, "cell").hint("merge"), "cell").drop("cell")

    first = _sorted(met(few).mapInArrow(_positives(rule), _PAIRS)).mapInArrow(_first(rule), _PAIRS + ", score long")
    first = cut_lineage(first, "negatives-positives")
    windows = first.groupBy("block").agg(F.collect_list(F.struct("anchor", "score")).alias("windows"))  # as many as a block of anchors has positives
    pairs = met(few.join(windows, "block")).mapInArrow(_negatives(rule), _PAIRS).union(first.select("block", "anchor", "key"))
    return _sorted(pairs).mapInArrow(
        _mined(rule), "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long",
    )


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            b = Block(row)
            v = pa.ListArray.from_arrays(np.arange(len(b.ids) + 1, dtype=np.int32) * b.v.shape[1], pa.array(b.v.astype(float).ravel()))
            yield pa.RecordBatch.from_pydict({"id": pa.array(b.ids), "number": pa.array(b.numbers), "label": pa.array(b.labels), "v": v})
