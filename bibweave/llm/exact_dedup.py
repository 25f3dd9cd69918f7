"""Exact deduplication by an exchange of Golomb-coded fingerprints.

Every partition sorts its 64-bit fingerprints, and sends each owner (a range of fingerprint space) the distinct ones that fall
into its range as one Golomb-Rice coded run. The owner answers each sender with a bitmap of those that another sender has too.
Only the texts behind a set bit, or met twice inside their partition, are suspects; their bytes are compared by grouping
whole normalised texts, where copies merge before the shuffle.

Texts are equal if identical after each run of blank, tab, line feed, vertical tab, form feed and carriage return became one
space; a null text counts as empty. The row with the smallest id stays (null ids last). Of rows that repeat both id and text
one stays. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from bibweave.llm.shared import chosen
from bibweave.session import cut_lineage

#: Bits of the filter that picks the texts to compare. It is broadcast; its size does not depend on the data.
FILTER_BITS = 1 << 23


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def golomb_encode(values: np.ndarray, space: int) -> bytes:
    """Sorted distinct integers below ``space`` as gaps: a quotient in unary, then ``k`` bits of remainder."""
    n = len(values)
    if n == 0:
        return b""
    k = max(0, int(space // n).bit_length() - 1)
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    high = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(high + 1)
    unary = np.zeros(int(ends[-1]), np.uint8)
    unary[ends - 1] = 1
    low = ((gaps[:, None] >> np.arange(k, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    head = np.array([k, n, len(unary)], "<u4").tobytes()
    return head + np.packbits(unary).tobytes() + np.packbits(low.ravel()).tobytes()


def golomb_decode(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, np.uint64)
    k, n, bits = (int(x) for x in np.frombuffer(blob, "<u4", 3))
    cut = 12 + (bits + 7) // 8
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(blob, np.uint8, cut - 12, 12), count=bits))
    high = np.diff(ends, prepend=-1).astype(np.uint64) - np.uint64(1)
    low = np.unpackbits(np.frombuffer(blob, np.uint8, offset=cut), count=n * k).reshape(n, k).astype(np.uint64)
    gaps = (high << np.uint64(k)) | (low << np.arange(k, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


_SENT = "sender long, owner int, run binary, doc_ids array<long>, shas array<binary>, places array<int>, fps array<long>, twice array<boolean>"


def _sender(owners: int):
    """One row per (partition, owner) that has rows: the coded run, and what stays behind for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        t = pa.Table.from_batches(tables)
        ids, shas = t.column("doc_id").combine_chunks(), t.column("sha").combine_chunks()
        fp = t.column("fp").combine_chunks().to_numpy(zero_copy_only=False).view(np.uint64)
        span = -(-(1 << 64) // owners)
        order = np.argsort(fp, kind="stable")
        fp = fp[order]
        owner = (fp // np.uint64(span)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(owner, prepend=-1, append=owners))
        for a, b in zip(cuts[:-1], cuts[1:]):
            distinct, place, count = np.unique(fp[a:b], return_inverse=True, return_counts=True)
            base = np.uint64(int(owner[a]) * span)
            rows = pa.array(order[a:b])
            yield pa.RecordBatch.from_pydict({
                "sender": pa.array([TaskContext.get().partitionId()], pa.int64()), "owner": pa.array([owner[a]], pa.int32()),
                "run": pa.array([golomb_encode(distinct - base, span)], pa.binary()),
                "doc_ids": pa.array([ids.take(rows)], pa.list_(pa.int64())), "shas": pa.array([shas.take(rows)], pa.list_(pa.binary())),
                "places": pa.array([place.astype(np.int32)], pa.list_(pa.int32())), "fps": pa.array([fp[a:b].view(np.int64)], pa.list_(pa.int64())),
                "twice": pa.array([(count > 1)[place]], pa.list_(pa.bool_())),
            })

    return run


def _answers(pdf):
    """An owner: all runs of its range, a bitmap of 64-bit words back to each sender."""
    runs = [golomb_decode(x) for x in pdf["run"]]
    everything, count = np.unique(np.concatenate(runs), return_counts=True)
    shared = everything[count > 1]
    maps = []
    for run in runs:
        bits = np.zeros(-(-len(run) // 64) * 64, np.uint8)
        bits[: len(run)] = np.isin(run, shared, assume_unique=True)
        maps.append(np.packbits(bits, bitorder="little").view("<i8"))
    return pdf[["sender", "owner"]].assign(bitmap=maps)


def _may_be_suspect(suspects: DataFrame, bits: int):
    """A filter on fingerprints that passes every suspect, as a bit set of fixed size."""
    slot = F.expr(f"pmod(fp, {bits}L)")
    words = suspects.select(slot.alias("s")).groupBy(F.expr("s div 64").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s % 64 as int))")).alias("m"))
    pdf = words.toPandas()  # at most bits / 64 rows, whatever the input
    table = np.zeros(bits // 64, np.uint64)
    table[pdf["w"].to_numpy(np.int64)] = pdf["m"].to_numpy(np.int64).view(np.uint64)
    shared = suspects.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def passes(fp):
        import pandas as pd

        s = np.mod(fp.to_numpy(np.int64), bits).astype(np.uint64)
        return pd.Series((shared.value[(s >> np.uint64(6)).astype(np.int64)] >> (s & np.uint64(63))) & np.uint64(1) == 1)

    return passes


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    owners = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = chosen(docs, key, text).select("doc_id", normalised(F.col("text")).alias("norm")).select("doc_id", "norm", F.xxhash64("norm").alias("fp"))
    skinny = rows.select("doc_id", "fp", F.unhex(F.sha2("norm", 256)).alias("sha"))
    sent = cut_lineage(skinny.mapInArrow(_sender(owners), _SENT), "fingerprints")
    answers = sent.select("sender", "owner", "run").groupBy("owner").applyInPandas(_answers, "sender long, owner int, bitmap array<long>")
    each = cut_lineage(
        sent.drop("run").join(answers, ["sender", "owner"])
        .select("sender", "owner", "bitmap", F.posexplode(F.arrays_zip("doc_ids", "shas", "places", "fps", "twice")).alias("seq", "r"))
        .select(
            F.col("r.doc_ids").alias("doc_id"), F.col("r.shas").alias("sha"), F.col("r.fps").alias("fp"),
            F.struct(F.col("r.doc_ids").isNull(), F.col("r.doc_ids"), "sender", "owner", "seq").alias("row"),
            (F.col("r.twice") | (F.expr("getbit(bitmap[r.places div 64], r.places % 64)") == 1)).alias("suspect"),
        ), "exchanged",
    )
    suspects = each.where("suspect")
    compared = rows.where(_may_be_suspect(suspects, filter_bits)("fp")).groupBy("norm").agg(F.count("*").alias("n"))
    compared = compared.groupBy(F.unhex(F.sha2("norm", 256)).alias("sha")).agg(F.count("*").alias("texts"))
    classes = (
        suspects.groupBy("sha").agg(F.min("row").alias("first"), F.count("*").alias("group_size"))
        .join(compared, "sha")
        .select("sha", "first", F.when(F.col("texts") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("two texts with one SHA-256"))).alias("group_size"))
    )
    return each.join(classes, "sha", "left").select(
        "doc_id", F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_ids")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("first").isNull() | (F.col("first") == F.col("row"))).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )
