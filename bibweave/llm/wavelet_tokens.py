"""Token ids as one wavelet matrix file per shard.

Documents are encoded in ascending ``doc_id`` order (null ids first) and packed into shards of whole documents. A shard file
holds a bit-plane for each bit of the ids, most significant first; every plane is a stable partition of the one above it. Each
plane is compressed on its own and carries the number of ones before every block of 512 bits, so that access, counting (rank)
and finding the k-th occurrence (select) of an id take one step per plane, without decoding the shard.

File format: ``WVM1``, the length of a JSON header (u32, little endian), the header, then its parts one after the other, each
compressed with zstandard: ``doc_ids`` (i64), ``doc_null`` (u8), ``doc_lengths`` (i64), then for each plane ``plane`` (packed
bits) and ``ones`` (u32). Files are written under names that no other task attempt uses; a file counts once the written index
names it, so a task that runs again leaves only an unnamed file behind.

A null or empty text has just the end id. Rows that repeat an id are separate documents; an empty table gives an empty index.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from bibweave.llm.shared import chosen, new_name, open_fs
from bibweave.llm.word_cache import WordCache
from bibweave.session import cut_lineage, run_dir

#: Ids after which a shard is closed; a longer document makes a longer shard.
SHARD_IDS = 2_000_000
BLOCK = 512


class WaveletMatrix:
    """Bit-planes of a sequence of unsigned integers, with rank support."""

    def __init__(self, n: int, planes: list[np.ndarray], ones: list[np.ndarray]):
        self.n, self.planes, self.ones = n, planes, ones

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        n, levels = len(ids), max(1, int(ids.max()).bit_length()) if len(ids) else 1
        row = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        planes, ones = [], []
        for level in reversed(range(levels)):
            mask = (row & row.dtype.type(1 << level)) != 0
            packed = np.packbits(np.concatenate([mask, np.zeros(-n % BLOCK, bool)]))
            planes.append(packed)
            ones.append(cls._directory(packed))
            row = np.concatenate([row[np.flatnonzero(~mask)], row[np.flatnonzero(mask)]])  # places are gathered faster than by a mask
        return cls(n, planes, ones)

    @staticmethod
    def _directory(packed: np.ndarray) -> np.ndarray:
        per_block = np.bitwise_count(packed.reshape(-1, BLOCK // 8)).sum(axis=1, dtype=np.uint32)
        return np.concatenate([[np.uint32(0)], np.cumsum(per_block, dtype=np.uint32)])

    def _rank1(self, level: int, at: int) -> int:
        block = at // BLOCK
        inside = self.planes[level][block * BLOCK // 8 : (block + 1) * BLOCK // 8]
        return int(self.ones[level][block]) + int(np.unpackbits(inside, count=at - block * BLOCK).sum())

    def _bit(self, level: int, at: int) -> int:
        return int(self.planes[level][at >> 3]) >> (7 - (at & 7)) & 1

    def _zeros(self, level: int) -> int:
        return self.n - int(self.ones[level][-1])

    def access(self, at: int) -> int:
        value = 0
        for level in range(len(self.planes)):
            bit = self._bit(level, at)
            value = value << 1 | bit
            at = self._zeros(level) + self._rank1(level, at) if bit else at - self._rank1(level, at)
        return value

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """Where the token's occurrences among the first ``end`` ids stand below the last plane."""
        start = 0
        if token >> len(self.planes):
            return 0, 0
        for level in range(len(self.planes)):
            if token >> (len(self.planes) - 1 - level) & 1:
                start, end = (self._zeros(level) + self._rank1(level, x) for x in (start, end))
            else:
                start, end = (x - self._rank1(level, x) for x in (start, end))
        return start, end

    def count(self, token: int, end: int | None = None) -> int:
        """Occurrences of ``token`` among the first ``end`` ids."""
        start, stop = self._range(token, self.n if end is None else end)
        return stop - start

    def _select(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) given bit in a plane."""
        ones = self.ones[level].astype(np.int64)
        before = ones if bit else np.arange(len(ones)) * BLOCK - ones
        block = int(np.searchsorted(before, k, side="right")) - 1
        bits = np.unpackbits(self.planes[level][block * BLOCK // 8 : (block + 1) * BLOCK // 8])
        return block * BLOCK + int(np.flatnonzero(bits == bit)[k - before[block]])

    def find(self, token: int, k: int) -> int | None:
        """Position of the k-th (from 0) occurrence of ``token``."""
        start, stop = self._range(token, self.n)
        if k >= stop - start:
            return None
        at = start + k
        for level in reversed(range(len(self.planes))):
            bit = token >> (len(self.planes) - 1 - level) & 1
            at = self._select(level, bit, at - self._zeros(level) if bit else at)
        return at

    def all(self) -> np.ndarray:
        """The whole sequence, merged upwards from the last plane in sequential passes."""
        row = None
        for depth, level in enumerate(reversed(range(len(self.planes)))):
            mask = np.unpackbits(self.planes[level], count=self.n).view(bool)
            above = np.zeros(self.n, np.uint32 if len(self.planes) > 16 else np.uint16)
            if row is not None:
                zeros = self._zeros(level)
                above[np.flatnonzero(~mask)], above[np.flatnonzero(mask)] = row[:zeros], row[zeros:]
            above |= mask.astype(above.dtype) << above.dtype.type(depth)
            row = above
        return row

    def to_bytes(self, doc_ids: list[int | None], lengths: list[int]) -> bytes:
        press = zstandard.ZstdCompressor(level=1).compress
        parts = [
            press(np.array([x or 0 for x in doc_ids], "<i8").tobytes()), press(np.array([x is None for x in doc_ids], "u1").tobytes()),
            press(np.array(lengths, "<i8").tobytes()),
        ]
        for plane, ones in zip(self.planes, self.ones):
            parts += [press(plane.tobytes()), press(ones.astype("<u4").tobytes())]
        head = json.dumps({"n": self.n, "planes": len(self.planes), "parts": [len(p) for p in parts]}).encode()
        return b"".join([b"WVM1", np.array([len(head)], "<u4").tobytes(), head, *parts])

    @classmethod
    def from_bytes(cls, blob: bytes) -> tuple[WaveletMatrix, list[int | None], np.ndarray]:
        if blob[:4] != b"WVM1":
            raise ValueError("not a wavelet matrix file")
        size = int(np.frombuffer(blob, "<u4", 1, 4)[0])
        head = json.loads(blob[8 : 8 + size])
        at, parts = 8 + size, []
        for n in head["parts"]:
            parts.append(zstandard.ZstdDecompressor().decompress(blob[at : at + n]))
            at += n
        ids, null = np.frombuffer(parts[0], "<i8").tolist(), np.frombuffer(parts[1], "u1")
        planes = [np.frombuffer(p, np.uint8) for p in parts[3::2]]
        ones = [np.frombuffer(p, "<u4") for p in parts[4::2]]
        return cls(head["n"], planes, ones), [None if z else i for i, z in zip(ids, null)], np.frombuffer(parts[2], "<i8")


def _written(folder: str, tokenizer: str, end_id: int, shard_ids: int):
    def flush(ids: list[bytes], doc_ids: list, seq: int) -> pa.RecordBatch:
        lengths = [len(x) // 4 for x in ids]
        fs, path = open_fs(folder)
        fs.create_dir(path, recursive=True)
        name = new_name(".wvm")
        with fs.open_output_stream(f"{path}/{name}") as out:
            out.write(WaveletMatrix.of(np.frombuffer(b"".join(ids), "<u4")).to_bytes(doc_ids, lengths))
        row = {"part": TaskContext.get().partitionId(), "seq": seq, "file": f"{folder}/{name}", "n_docs": len(ids), "n_tokens": sum(lengths)}
        return pa.RecordBatch.from_pylist([row], schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, end = WordCache.named(tokenizer), np.array([end_id], "<u4").tobytes()
        ids, doc_ids, size, seq = [], [], 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                encoded = cache.encode([x or "" for x in part.column("text").to_pylist()])
                for doc_id, got in zip(part.column("doc_id").to_pylist(), encoded):
                    ids.append(got + end)
                    doc_ids.append(doc_id)
                    size += len(got) // 4 + 1
                    if size >= shard_ids:
                        yield flush(ids, doc_ids, seq)
                        ids, doc_ids, size, seq = [], [], 0, seq + 1
        if ids:
            yield flush(ids, doc_ids, seq)

    return run


def write(docs: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text", shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encodes and writes all documents; the index: file, n_docs, n_tokens, start (ids in all shards before)."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = chosen(docs, key, text).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", F.octet_length("text"))
    index = cut_lineage(
        ordered.mapInArrow(_written(run_dir(spark, "wavelet"), tokenizer, end_id, shard_ids), "part int, seq int, file string, n_docs long, n_tokens long"),
        "wavelet-index",
    )
    # one row per range partition in the undivided window, one row per shard in the other
    parts = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n_tokens").over(W.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    return index.withColumn("inside", inside).join(parts, "part").select("file", "n_docs", "n_tokens", (F.col("before") + F.col("inside")).alias("start"))


def open_shard(file: str) -> tuple[WaveletMatrix, list[int | None], np.ndarray]:
    fs, path = open_fs(file)
    with fs.open_input_stream(path) as stream:
        return WaveletMatrix.from_bytes(stream.read())


def read(index: DataFrame) -> DataFrame:
    """Per document of the indexed shards: doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian 32-bit integers)."""
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                matrix, doc_ids, lengths = open_shard(file)
                ids = matrix.all().astype("<u4")
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(ids[e - k : e]) for e, k in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(doc_ids, pa.int64()), "start": pa.array(start + ends - lengths, pa.int64()),
                    "n_tokens": pa.array(lengths, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                })

    return index.select("file", "start").repartition(n, "file").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def occurrences(index: DataFrame, token: int) -> DataFrame:
    """Per shard how often ``token`` occurs and the global position of its first occurrence, without decoding the shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                matrix = open_shard(file)[0]
                first = matrix.find(token, 0)
                yield pa.RecordBatch.from_pydict({
                    "file": [file], "n": pa.array([matrix.count(token)], pa.int64()), "first": pa.array([None if first is None else start + first], pa.int64()),
                })

    return index.select("file", "start").mapInArrow(run, "file string, n long, first long")
