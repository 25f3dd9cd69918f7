"""Byte-level BPE with Spark's higher-order functions.

A text is cut into words by the tokenizer's pattern. The merges of a word are a fold over its byte array: the state holds the
pieces with the ranks of neighbouring pairs; every step joins the leftmost pair of lowest rank and looks up the two new pairs.
The ranks are one constant: for every two pieces that make a third its rank, addressed by their ids. A piece that its own bytes
do not merge to would need an id of its own beside the fold; a rank file with such a piece is refused. Constants of this size are
session variables: spelled out as literals they would stand in the text of every plan, which the driver keeps and logs.

Each distinct word that occurs twice or more is folded once for the whole corpus. The most frequent of them go to the tasks as
a table of hashes and ids (``CACHED_WORDS`` at most); every other word is folded in its row, once per text. Both give the same
ids, so the bound is a matter of speed only. ``encode`` compares every text with its decoded ids, so that two words with one
64-bit hash could not pass unseen. Decoding concatenates the binary pieces of the ids.

A null or empty text has no ids. Rows that repeat are encoded each; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import uuid

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bibweave.llm.shared import chosen
from bibweave.session import cut_lineage, spread

#: Words whose ids are broadcast: 8 bytes of hash, 4 of offset and 4 an id, below 32 bytes a word on average.
CACHED_WORDS = 400_000
#: Bits of an id or rank, and of what stands below the rank in an entry: 27 bits of place (a word has less than 128 MiB) and the id.
BITS, LOW_BITS = 18, 45
#: No such pair; the id at both ends of a word.
NONE = (1 << BITS) - 1
LOW, LAST = (1 << LOW_BITS) - 1, NONE << LOW_BITS
#: Rows of a batch that are worked on at once.
PART = 256
#: Shifts tried at once when the table is built.
TRIED = 256
#: What \s stands for in the patterns (the property White_Space); Java's own \s is ASCII only.
WHITE_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}


def java_pattern(pattern: str) -> str:
    """The pattern with \\s and \\S spelled out."""
    return pattern.replace(r"[^\s", "[^" + WHITE_SPACE).replace(r"\s", f"[{WHITE_SPACE}]").replace(r"\S", f"[^{WHITE_SPACE}]")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once (as the start of an empty fold, which copies nothing)."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda kept, _: kept, body)


def constant(values: list, kind: str, session: SparkSession | None = None) -> Column:
    """An array that every row sees, as a variable of the session; plans don't show its elements."""
    spark, name = session or SparkSession.builder.getOrCreate(), f"bibweave_{uuid.uuid4().hex}"
    spark.createDataFrame(pa.table({"value": pa.array([values])})).select(F.col("value").cast(kind)).createTempView(name)
    spark.sql(f"DECLARE VARIABLE {name} {kind}")
    spark.sql(f"SET VARIABLE {name} = (SELECT value FROM {name})")
    spark.catalog.dropTempView(name)
    return F.expr(f"session.{name}")


def opened(table: dict[str, Column], body, **fields: Column) -> Column:
    """``body`` of the table's fields, each looked up once."""
    if len(fields) == len(table):
        return body(fields)
    name = list(table)[len(fields)]
    return let(table[name], lambda x: opened(table, body, **fields, **{name: x}))


def merged_pieces(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The plain rule: join the leftmost neighbours of lowest rank until no two of them make a piece."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(x + y, NONE), i) for i, (x, y) in enumerate(zip(parts, parts[1:])))
        if rank == NONE:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def pair_table(ranks: dict[bytes, int]) -> tuple[int, list[int], list[int]]:
    """``salt``, ``shifts`` and ``cells``. The pair of ids (a, b) has the key ``a << BITS | b``; with h, the hash of key xor salt, its
    cell (key and rank) is at place (h >> 32) xor ``shifts[h]``, each taken modulo the size. Pairs that share a shift get the first
    one that leads them to free cells; the salt is the first with which no two of them have one place.
    """
    rank_of: dict[int, int] = {}
    for piece, rank in ranks.items():
        for cut in range(1, len(piece)):
            a, b = ranks.get(piece[:cut]), ranks.get(piece[cut:])
            if a is not None and b is not None:
                rank_of[a << BITS | b] = rank
    size = 1 << max(4, (len(rank_of) * 5 // 4).bit_length())
    keys, salt = np.array(sorted(rank_of), np.int64), -1
    apart = False
    while not apart:
        salt += 1
        h = np.array([xxhash.xxh64_intdigest((key ^ salt).to_bytes(8, "little"), 42) for key in keys.tolist()], np.uint64)
        group, place = (h & np.uint64(size // 4 - 1)).astype(np.int64), (h >> np.uint64(32) & np.uint64(size - 1)).astype(np.int64)
        apart = len(np.unique(group * size + place)) == len(keys)
    shifts, cells, groups = np.zeros(size // 4, np.int64), np.full(size, -1), {}
    for i, g in enumerate(group.tolist()):
        groups.setdefault(g, []).append(i)
    for g, members in sorted(groups.items(), key=lambda x: (-len(x[1]), x[0])):
        for first in range(0, size, TRIED):
            tried = np.arange(first, min(first + TRIED, size))
            free = (cells[place[members][:, None] ^ tried] < 0).all(axis=0)
            if free.any():
                break
        else:
            raise ValueError("too many pairs for the table")
        shifts[g] = tried[int(free.argmax())]
        cells[place[members] ^ shifts[g]] = [k << BITS | rank_of[k] for k in keys[members].tolist()]
    return salt, shifts.tolist(), cells.tolist()


def rank_literal(ranks: dict[bytes, int], session: SparkSession | None = None) -> dict[str, Column]:
    """The rank map as constants: ``single`` (ids of the 256 bytes) and the parts of ``pair_table``, with sizes as masks."""
    if max(ranks.values()) >= NONE:
        raise ValueError(f"ranks must be below {NONE}")
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"bytes without a rank: {missing}")
    salt, shifts, cells = pair_table(ranks)
    numbers = {"salt": salt, "shift_mask": len(shifts) - 1, "cell_mask": len(cells) - 1}
    arrays = {"single": [ranks[bytes([b])] for b in range(256)], "shifts": shifts, "cells": cells}
    return {k: F.lit(v).cast("long") for k, v in numbers.items()} | {k: constant(v, "array<long>", session) for k, v in arrays.items()}


def _pair(table: dict[str, Column], a: Column, b: Column) -> Column:
    """The rank (and id) of two neighbouring ids together, else NONE; beside a word's end there is no id."""

    def found(key: Column, h: Column) -> Column:
        place = F.shiftrightunsigned(h, 32).bitwiseXOR(F.get(table["shifts"], h.bitwiseAND(table["shift_mask"]))).bitwiseAND(table["cell_mask"])
        return let(F.get(table["cells"], place), lambda c: F.when(F.shiftright(c, BITS) == key, c.bitwiseAND(F.lit(NONE))).otherwise(F.lit(NONE)))

    return let(F.shiftleft(a, BITS).bitwiseOR(b), lambda key: let(F.xxhash64(key.bitwiseXOR(table["salt"])), lambda h: found(key, h)))


def _id(entry: Column) -> Column:
    return entry.bitwiseAND(F.lit(NONE))


def _entry(rank: Column, low: Column) -> Column:
    return F.shiftleft(rank, LOW_BITS).bitwiseOR(low)


def _step(table: dict[str, Column], s: Column) -> Column:
    """One merge: the entry of lowest rank takes in its right neighbour, and both pairs beside it are looked up."""

    def joined(lowest: Column, p: Column) -> Column:
        def beside(rank: Column) -> Column:
            before, after = F.get(s, p - 2), F.get(s, p + 1)
            left = _entry(_pair(table, _id(before), rank), before.bitwiseAND(F.lit(LOW)))
            own = _entry(_pair(table, rank, _id(after)), lowest.bitwiseAND(F.lit(LOW - NONE)).bitwiseOR(rank))
            return F.concat(F.slice(s, F.lit(1), p - 2), F.array(left, own), F.slice(s, p + 2, F.size(s)))

        return let(F.shiftright(lowest, LOW_BITS), beside)

    return let(F.array_min(s), lambda lowest: F.when(lowest >= F.lit(LAST), s).otherwise(let(F.array_position(s, lowest).cast("int"), lambda p: joined(lowest, p))))


def fold(word: Column, table: dict[str, Column]) -> Column:
    """The ids of one non-empty word. ``table``: the rank map, ``opened`` outside, as each step looks at it.

    An entry of the state is one long: rank of the pair it begins, place of its first byte, id. So the smallest entry is the
    leftmost pair of lowest rank. An entry without rank stands at both ends.
    """
    end = F.array(F.lit(LAST | NONE))

    def entries(ids: Column) -> Column:
        low = lambda x, i: F.shiftleft(i.cast("long"), BITS).bitwiseOR(x)
        return F.concat(end, F.transform(ids, lambda x, i: _entry(_pair(table, x, F.get(ids, i + 1)), low(x, i))), end)

    def merged(ids: Column) -> Column:
        steps = F.sequence(F.lit(1), F.size(ids))
        return F.aggregate(steps, entries(ids), lambda s, _: _step(table, s), lambda s: F.transform(F.slice(s, F.lit(2), F.size(s) - 2), lambda e: _id(e).cast("int")))

    # one character for each byte
    single = F.split(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), "")
    return let(F.transform(single, lambda c: F.get(table["single"], F.ascii(c))), merged)


def in_parts(lists: pa.Array, work) -> pa.Array:
    """``work`` done on a bounded number of rows at a time, so that its temporary arrays stay small beside a batch."""
    return pa.concat_arrays([work(lists.slice(at, PART)) for at in range(0, max(len(lists), 1), PART)])


class Codec:
    """A rank file and its pattern as column functions."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, session: SparkSession | None = None):
        if apart := [piece for piece in ranks if len(merged_pieces(piece, ranks)) > 1]:
            raise ValueError(f"{len(apart)} pieces do not come out of their own bytes, such as {apart[0]!r}")
        self.pattern, self.literal = java_pattern(pattern), rank_literal(ranks, session)
        self.pieces = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            self.pieces[rank] = piece
        self.texts = self._table(self.pieces, session)
        self.numbers = self._table([i.to_bytes(4, "little") for i in range(len(self.pieces))], session)

    @staticmethod
    def _table(values: list[bytes], session: SparkSession | None) -> Column:
        """A constant of byte strings by id, a character for each byte."""
        return constant([v.decode("latin-1") for v in values], "array<string>", session)

    def _with_ranks(self, body) -> Column:
        return opened(self.literal, body)

    def words(self, text: Column) -> Column:
        return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(self.pattern), F.lit(0))

    def cache(self, rows: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes (sorted), offsets and ids of the most frequent words: as many whole frequency classes as fit into ``most``."""
        counts = rows.select(F.explode(self.words(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n")).where("n > 1")
        counts = cut_lineage(counts, "words")
        classes = counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).toLocalIterator()
        least, total = None, 0
        for row in classes:
            total += row["words"]
            if total > most:
                break
            least = row["n"]
        frequent = counts.where(F.lit(False) if least is None else F.col("n") >= least)
        ids = self._with_ranks(lambda table: fold(F.col("word"), table))
        table = spread(frequent, "word").select(F.xxhash64("word").alias("h"), ids.alias("ids")).toArrow()
        h, lists = table.column("h").combine_chunks().to_numpy(), table.column("ids").combine_chunks()
        order = np.argsort(h)
        lists = lists.take(pa.array(order)) if len(h) else lists
        lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        found = h[order], np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32), lists.flatten().to_numpy().astype(np.int32)
        del table, lists, h
        pa.default_memory_pool().release_unused()  # the driver keeps the arrays, not what Arrow read them from
        return found

    def encode(self, docs: DataFrame, key: str = "doc_id", text: str = "text", cached_words: int = CACHED_WORDS) -> DataFrame:
        """Per row: doc_id, text, ids (array of int)."""
        rows = chosen(docs, key, text)
        shared = docs.sparkSession.sparkContext.broadcast(self.cache(rows, cached_words))

        @F.arrow_udf("struct<parts: array<array<int>>, cold: array<int>, holes: array<int>>")
        def looked_up(hashes: pa.Array) -> pa.Array:
            return in_parts(hashes, some)

        def some(hashes: pa.Array) -> pa.Array:
            """``parts``: the ids between words whose hash is unknown; ``cold``: where the distinct unknown words of the text stand;
            ``holes``: for each part but the last the number of the unknown word that follows.
            """
            h, offsets, ids = shared.value
            flat, ends = hashes.flatten().to_numpy(), np.concatenate([[0], np.cumsum(pc.list_value_length(hashes).to_numpy())])
            at = np.minimum(np.searchsorted(h, flat), max(len(h) - 1, 0))
            known = h[at] == flat if len(h) else np.zeros(len(flat), bool)
            first, length = (offsets[at], offsets[at + 1] - offsets[at]) if len(h) else (np.zeros(len(flat), np.int32),) * 2
            length = np.where(known, length, 0)
            begins = np.concatenate([[0], np.cumsum(length)])
            out = ids[np.repeat(first - begins[:-1], length) + np.arange(begins[-1])] if len(ids) else np.zeros(0, np.int32)
            unknown = np.flatnonzero(~known)
            before = np.searchsorted(unknown, ends)
            cold, cold_ends, holes = [], [0], []
            for a, i, j in zip(ends[:-1], before[:-1], before[1:]):
                if i < j:
                    _, place, which = np.unique(flat[unknown[i:j]], return_index=True, return_inverse=True)
                    cold.append(unknown[i:j][place] - a)
                    holes.append(which)
                cold_ends.append(cold_ends[-1] + (len(cold[-1]) if i < j else 0))
            lists = lambda ends, values: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            joined = lambda parts: pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int32())
            # a part begins with each text and after each unknown word, which has no ids
            cuts = begins[np.sort(np.concatenate([ends[:-1], unknown + 1]))]
            parts = lists(np.append(cuts, begins[-1]), pa.array(out, pa.int32()))
            return pa.StructArray.from_arrays([
                lists(before + np.arange(len(ends)), parts), lists(cold_ends, joined(cold)), lists(before, joined(holes)),
            ], ["parts", "cold", "holes"])

        cut = rows.withColumn("words", self.words(F.col("text")))
        found = cut.withColumn("found", looked_up(F.transform("words", lambda w: F.xxhash64(w))))
        folded = self._with_ranks(lambda table: F.transform("found.cold", lambda i: fold(F.get("words", i), table)))
        nothing = F.array().cast("array<int>")
        filled = lambda cold: F.transform("found.parts", lambda part, i: F.array(part, F.coalesce(F.get(cold, F.get("found.holes", i)), nothing)))
        whole = let(folded, lambda cold: F.flatten(F.flatten(filled(cold))))
        ids = F.when(F.size("found.cold") == 0, F.flatten("found.parts")).otherwise(whole)
        return found.select("doc_id", "text", F.explode(F.array(ids)).alias("ids"))  # one element: so no use of ids repeats its making

    @staticmethod
    def _joined(ids: Column, table: Column) -> Column:
        return F.encode(F.array_join(let(table, lambda t: F.transform(ids, lambda i: F.get(t, i))), ""), "ISO-8859-1")

    def decode(self, ids: Column) -> Column:
        """The bytes that the ids stand for: their pieces joined."""
        return self._joined(ids, self.texts)

    def packed(self, ids: Column) -> Column:
        """The ids as little-endian unsigned 32-bit integers."""
        return self._joined(ids, self.numbers)


def public_codec(session: SparkSession | None = None) -> Codec:
    """The rank file and pattern of the public vocabulary; made once per session, as its tables are large."""
    return _codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, session or SparkSession.builder.getOrCreate())


@functools.lru_cache(maxsize=1)
def _codec(path: str, pattern: str, session: SparkSession) -> Codec:
    return Codec(read_ranks(path), pattern, session)


def digests(docs: DataFrame, codec: Codec, key: str = "doc_id", text: str = "text", cached_words: int = CACHED_WORDS) -> DataFrame:
    """Encodes, decodes and compares: doc_id, n_tokens, ids_sha256 (of little-endian 32-bit ids), decoded_sha256."""
    coded = codec.encode(docs, key, text, cached_words)
    full = coded.select("doc_id", "text", F.size("ids").cast("long").alias("n_tokens"), codec.packed(F.col("ids")).alias("packed"), codec.decode(F.col("ids")).alias("decoded"))
    same = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return full.select(
        "doc_id", "n_tokens", F.sha2("packed", 256).alias("ids_sha256"),
        F.when(same, F.sha2("decoded", 256)).otherwise(F.raise_error(F.lit("a text differs from its decoded ids"))).alias("decoded_sha256"),
    )
