"""Benchmark decontamination with suffix arrays of the training texts.

Texts stay where they are: every task packs the words of a bounded number of whole documents into a shard and sorts the shard's
suffixes (those that share their first words with some test suffix; no other can match). Every suffix of every benchmark item
that is at least one window long is binary-searched in the shard's array, which gives all places of its first window. Places
that follow each other along one diagonal of item and document are one match, so the longest verbatim matches come with their
length and location, and the words they cover are hit.

Words are lower-cased (A-Z) runs of digits, letters and all non-ASCII characters. A window is ``window`` consecutive words of an
item; an item of fewer words, but not none, is one window. Null texts have no words; items without words never occur; items
with a null id hit words but are not named; rows that repeat are judged each, repeated items count once by id. The benchmark is
read in blocks of a bounded number of words; if there is more than one block, each takes its own pass over the documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bibweave.llm.shared import Ranges, chosen
from bibweave.session import cut_lineage

#: Bytes of text in a shard (a longer document makes a longer shard), and benchmark words that are broadcast at once.
SHARD_BYTES, BLOCK_WORDS = 4_000_000, 1_000_000
_WORD = np.zeros(256, bool)
_WORD[list(range(0x30, 0x3A)) + list(range(0x61, 0x7B)) + list(range(0x80, 0x100))] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order (never zero), and the number of words of each text."""
    data = [(t or "").encode() for t in texts]
    sizes = np.array([len(d) + 1 for d in data], np.int64)
    if not len(sizes):
        return np.zeros(0, np.uint64), sizes
    flat = _LOWER[np.frombuffer(b" ".join(data) + b" ", np.uint8)]
    inside = np.concatenate([[False], _WORD[flat], [False]])
    change = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = change[::2], change[1::2]
    cuts = np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))
    return np.maximum(Ranges(flat).of(starts, ends), np.uint64(1)), np.diff(cuts)


class Tests:
    """The test suffixes of a block of items: their first window as words, its length, item and place in the item."""

    def __init__(self, ids: list[int | None], texts: list[str | None], window: int):
        words, counts = word_hashes(texts)
        begin = np.cumsum(counts) - counts
        width = np.minimum(counts, window)
        number = np.where(counts > 0, counts - width + 1, 0)
        self.ids, self.window = ids, window
        self.item = np.repeat(np.arange(len(counts)), number)
        self.place = np.arange(len(self.item)) - np.repeat(np.cumsum(number) - number, number)
        self.width = width[self.item]
        at = begin[self.item] + self.place
        padded = np.concatenate([words, np.zeros(window, np.uint64)])
        self.words = padded[at[:, None] + np.arange(window)] if len(at) else np.zeros((0, window), np.uint64)
        self.words[np.arange(window)[None, :] >= self.width[:, None]] = 0
        # what a suffix must begin with to be kept: as many words as every window has, three at most
        self.lead = int(min(3, self.width.min(initial=3)))
        self.leads = np.unique(_combined(self.words[:, : self.lead]))


def _combined(rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows), np.uint64)
    for column in rows.T:
        out = out * np.uint64(0x9E3779B97F4A7C15) + column
    return out


def _bound(rows: np.ndarray, tests: Tests, after: bool) -> np.ndarray:
    """Binary search of every test suffix among sorted suffixes: first one not before it, or (``after``) beyond its window."""
    low, high = np.zeros(len(tests.words), np.int64), np.full(len(tests.words), len(rows), np.int64)
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        smaller, equal = np.zeros(len(open_), bool), np.ones(len(open_), bool)
        for j in range(tests.window):
            mine, other = rows[middle, j], tests.words[open_, j]
            used = equal & (j < tests.width[open_])
            smaller |= used & (mine < other)
            equal &= ~used | (mine == other)
        up = smaller | (equal if after else False)
        low[open_[up]] = middle[up] + 1
        high[open_[~up]] = middle[~up]
    return low


def matches(texts: list[str | None], tests: Tests) -> tuple[np.ndarray, ...]:
    """Words of each text, then for each longest match: text, place in the text, item, place in the item, length in words."""
    words, counts = word_hashes(texts)
    doc = np.repeat(np.arange(len(counts)), counts)
    begin = np.cumsum(counts) - counts
    seq = np.zeros(len(words) + len(counts) + tests.window, np.uint64)  # a zero after each text
    home = np.arange(len(words)) + doc
    seq[home] = words
    lead = np.stack([seq[home + j] for j in range(tests.lead)], axis=1) if len(home) else np.zeros((0, tests.lead), np.uint64)
    kept = home[np.isin(_combined(lead), tests.leads)]
    rows = seq[kept[:, None] + np.arange(tests.window)]
    order = np.lexsort(rows.T[::-1]) if len(kept) else np.zeros(0, np.int64)
    array, rows = kept[order], rows[order]  # the suffix array, and the words its suffixes begin with
    first, last = _bound(rows, tests, False), _bound(rows, tests, True)
    number = last - first
    test = np.repeat(np.arange(len(number)), number)
    at = array[np.arange(len(test)) - np.repeat(np.cumsum(number) - number, number) + np.repeat(first, number)]
    item, place = tests.item[test], tests.place[test]
    owner = np.searchsorted(begin + np.arange(len(counts)), at, side="right") - 1 if len(at) else np.zeros(0, np.int64)
    order = np.lexsort((at, at - place, item))
    at, item, place, owner, width = at[order], item[order], place[order], owner[order], tests.width[test[order]]
    new = np.ones(len(at), bool)
    new[1:] = (item[1:] != item[:-1]) | (at[1:] - place[1:] != at[:-1] - place[:-1]) | (at[1:] != at[:-1] + 1)
    heads = np.flatnonzero(new)
    length = np.diff(np.append(heads, len(at))) - 1 + width[heads]
    owner = owner[heads]
    return counts, owner, at[heads] - owner - begin[owner], item[heads], place[heads], length


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = np.cumsum(batch.column("size").to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + SHARD_BYTES, side="right")))
            yield batch.slice(at, end - at)
            at = end


def _blocks(items: DataFrame, window: int, most: int) -> Iterator[Tests]:
    ids, texts, words = [], [], 0
    for item_id, text in items.toLocalIterator():
        ids.append(item_id)
        texts.append(text)
        words += len(text or "") // 2 + 1
        if words >= most:
            yield Tests(ids, texts, window)
            ids, texts, words = [], [], 0
    if ids:
        yield Tests(ids, texts, window)


_STATE = "spans array<struct<begin: long, end: long>>, items array<long>, unnamed long, n_words long"
_MATCHES = "matches array<struct<item_id: long, item_place: long, place: long, length: long>>"


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = 13, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: doc_id, n_words, spans (merged hit words), items (ids, sorted as strings) and matches, longest first."""
    spark = docs.sparkSession
    state = chosen(docs, key, text).select("doc_id", "text", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("size"), F.expr("cast(array() as array<struct<begin: long, end: long>>)").alias("spans"), F.expr("cast(array() as array<long>)").alias("items"), F.lit(0).cast("long").alias("unnamed"), F.lit(0).cast("long").alias("n_words"), F.expr("cast(array() as array<struct<item_id: long, item_place: long, place: long, length: long>>)").alias("matches"))
    schema = f"doc_id long, text string, size long, {_STATE}, {_MATCHES}"

    def one_pass(tests: Tests, last: bool):
        shared = spark.sparkContext.broadcast(tests)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tests = shared.value
            for shard in _shards(batches):
                counts, owner, place, item, item_place, length = matches(shard.column("text").to_pylist(), tests)
                rows = [{"spans": [], "items": set(), "unnamed": 0, "matches": []} for _ in range(shard.num_rows)]
                for o, p, i, q, n in zip(owner.tolist(), place.tolist(), item.tolist(), item_place.tolist(), length.tolist()):
                    rows[o]["spans"].append((p, p + n))
                    rows[o]["items"].add(tests.ids[i])
                    rows[o]["matches"].append({"item_id": tests.ids[i], "item_place": q, "place": p, "length": n})
                before = shard.select(["spans", "items", "unnamed", "matches"]).to_pylist()
                for now, old in zip(rows, before):
                    now["spans"] = [{"begin": a, "end": b} for a, b in _merged(now["spans"] + [(s["begin"], s["end"]) for s in old["spans"]])]
                    now["unnamed"] = old["unnamed"] + (None in now["items"])
                    now["items"] = sorted((now["items"] | set(old["items"])) - {None}, key=str)
                    now["matches"] = sorted(now["matches"] + old["matches"], key=lambda m: (-m["length"], m["place"], str(m["item_id"]), m["item_place"]))
                new = pa.Table.from_pylist(rows, schema=pa.schema([(n, shard.schema.field(n).type) for n in ("spans", "items", "unnamed", "matches")]))
                text_out = pa.nulls(shard.num_rows, pa.string()) if last else shard.column("text").cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [shard.column("doc_id"), text_out, shard.column("size"), *(new.column(n).combine_chunks() for n in ("spans", "items", "unnamed")), pa.array(counts, pa.int64()), new.column("matches").combine_chunks()],
                    names=["doc_id", "text", "size", "spans", "items", "unnamed", "n_words", "matches"],
                )

        return run

    items = benchmark.select(F.col(item).cast("long"), F.col(item_text)).where(F.col(item_text).isNotNull())
    blocks = _blocks(items, window, block_words)
    tests = next(blocks, None) or Tests([], [], window)
    while tests is not None:
        after = next(blocks, None)
        state = state.mapInArrow(one_pass(tests, after is None), schema)
        if after is not None:
            state = cut_lineage(state, "decontaminate")
        tests = after
    return state.select("doc_id", "n_words", "spans", "items", "unnamed", "matches")


def verdicts(found: DataFrame) -> DataFrame:
    """Per row of ``contamination``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated (a twentieth of the words hit)."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["begin"])
    named = F.array_join(F.transform("items", lambda i: i.cast("string")), ",")
    return found.withColumn("n_hit", hit).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.encode(named, "UTF-8"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )
