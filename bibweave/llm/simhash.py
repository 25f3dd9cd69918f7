"""SimHash near-duplicates, found with BK-trees.

Fingerprints that differ in at most ``radius`` of 64 bits agree on one of ``radius`` + 1 bands of bits. So the distinct
fingerprints go, once per band, to shards of band values. A shard keeps a BK-tree for each band value: the children of a node
are keyed by their Hamming distance to it, and a search follows only edges within the radius of its own distance. Shard trees
are shipped, as rows, to the blocks of fingerprints that may have partners in them; a shard with too many fingerprints is cut
into several trees and as many blocks, and every block meets every tree of its shard. A search hands on one link per
fingerprint to the smallest one of its group in that cell, which keeps what is connected connected; the groups of all cells are
then joined by rounds of large-star and small-star, until nothing changes.

Texts without words have the fingerprint zero and link like any other; a null text has no words. Rows that repeat an id are
rows of their own; a null id is never the smallest of its component unless all ids are null. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from bibweave.llm.shared import chosen
from bibweave.session import cut_lineage

#: Fingerprints a shard should have, and those a single tree may have.
SHARD, TREE = 8_192, 16_384


def fingerprint(text: str | None, words: int = 3) -> int:
    """Bit i is set if more than half of the shingles' hashes have it set."""
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    if len(found) <= words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(words))))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), np.uint64)
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        set_bits += np.unpackbits(hashes[at : at + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """Per row: doc_id, fp (the 64 bits as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py(), words) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "fp": pa.array(values.view(np.int64))})

    return chosen(docs, key, text).mapInArrow(run, "doc_id long, fp long")


class BKTree:
    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []
        self.links: list[tuple[int, int]] = []  # (parent, distance) of each node

    def add(self, value: int) -> None:
        at, parent, distance = 0, -1, 0
        while at < len(self.values) and at >= 0:
            distance, parent = (self.values[at] ^ value).bit_count(), at
            at = self.children[parent].get(distance, -1)
        if parent >= 0:
            self.children[parent][distance] = len(self.values)
        self.values.append(value)
        self.children.append({})
        self.links.append((parent, distance))

    @classmethod
    def of_links(cls, values: list[int], parents: list[int], distances: list[int]) -> BKTree:
        tree = cls()
        tree.values, tree.children = values, [{} for _ in values]
        for node, (parent, distance) in enumerate(zip(parents, distances)):
            if parent >= 0:
                tree.children[parent][distance] = node
        return tree

    def within(self, value: int, radius: int) -> Iterator[int]:
        stack = [0] if self.values else []
        while stack:
            node = stack.pop()
            distance = (self.values[node] ^ value).bit_count()
            if distance <= radius:
                yield self.values[node]
            stack.extend(c for d, c in self.children[node].items() if distance - radius <= d <= distance + radius)


def _bands(radius: int) -> list[tuple[int, int]]:
    """(shift, mask) of each band."""
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    return [(a, (1 << (b - a)) - 1) for a, b in zip(cuts, cuts[1:])]


def _shard_trees(bands: list[tuple[int, int]]):
    """All trees of one shard piece in one row: nodes tree after tree, each node with its parent (within the row) and edge."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        band = int(pdf["band"].iloc[0])
        shift, mask = bands[band]
        trees: dict[int, BKTree] = {}
        for value in pdf["fp"].to_numpy().view(np.uint64).tolist():
            trees.setdefault(value >> shift & mask, BKTree()).add(value)
        values, parents, edges = [], [], []
        for tree in trees.values():
            base = len(values)
            values += tree.values
            parents += [p + base if p >= 0 else -1 for p, _ in tree.links]
            edges += [d for _, d in tree.links]
        row = {"band": band, "shard": int(pdf["shard"].iloc[0]), "piece": int(pdf["piece"].iloc[0])}
        return pd.DataFrame([row | {"nodes": np.array(values, "<u8").tobytes(), "parents": np.array(parents, "<i4").tobytes(), "edges": np.array(edges, "u1").tobytes()}])

    return run


def _search(bands: list[tuple[int, int]], radius: int):
    """A tree row meets a block of fingerprints; the links it adds, as (a, b) with b the smallest of the group."""

    def forest(row: dict, shift: int, mask: int) -> dict[int, BKTree]:
        values = np.frombuffer(row["nodes"], "<u8").tolist()
        parents, edges = np.frombuffer(row["parents"], "<i4").tolist(), np.frombuffer(row["edges"], "u1").tolist()
        roots = [i for i, p in enumerate(parents) if p < 0] + [len(values)]
        return {
            values[a] >> shift & mask: BKTree.of_links(values[a:b], [p - a if p >= 0 else -1 for p in parents[a:b]], edges[a:b])
            for a, b in zip(roots, roots[1:])
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shift, mask = bands[row["band"]]
                trees, parent = forest(row, shift, mask), {}

                def root(x: int) -> int:
                    while (up := parent.get(x, x)) != x:
                        parent[x] = parent.get(up, up)
                        x = up
                    return x

                for value in np.frombuffer(row["block"], "<u8").tolist():
                    tree = trees.get(value >> shift & mask)
                    for other in tree.within(value, radius) if tree else ():
                        a, b = root(value), root(other)
                        if a != b:
                            parent[max(a, b)] = min(a, b)
                pairs = np.array([(x, root(x)) for x in parent], np.uint64).reshape(-1, 2).view(np.int64)
                pairs = pairs[pairs[:, 0] != pairs[:, 1]]
                yield pa.RecordBatch.from_pydict({"a": pa.array(pairs[:, 0].copy()), "b": pa.array(pairs[:, 1].copy())})

    return run


def links(nodes: DataFrame, radius: int = 3, shard: int = SHARD, tree: int = TREE) -> DataFrame:
    """``nodes``: distinct fp. Links (a, b) that connect exactly what pairs within the radius connect."""
    bands = _bands(radius)
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-nodes.count() // shard))
    value = F.expr("CASE band " + " ".join(f"WHEN {i} THEN shiftrightunsigned(fp, {s}) & {m - (1 << 64) if m >> 63 else m}L" for i, (s, m) in enumerate(bands)) + " END")
    banded = nodes.select("fp", F.explode(F.array(*map(F.lit, range(len(bands))))).alias("band")).withColumn("shard", F.pmod(F.xxhash64(value), F.lit(shards)).cast("int"))
    sizes = banded.groupBy("band", "shard").agg(F.ceil(F.count("*") / tree).alias("pieces"))
    pieces = banded.join(sizes, ["band", "shard"]).withColumn("piece", F.expr("cast(pmod(xxhash64(fp), pieces) as int)"))
    trees = cut_lineage(
        pieces.groupBy("band", "shard", "piece").applyInPandas(_shard_trees(bands), "band int, shard int, piece int, nodes binary, parents binary, edges binary"), "trees",
    )
    blocks = trees.select("band", "shard", F.col("piece").alias("of"), F.col("nodes").alias("block"))
    cells = trees.join(blocks, ["band", "shard"]).where("of >= piece").repartition(n, F.xxhash64("band", "shard", "piece", "of"))
    return cells.mapInArrow(_search(bands, radius), "a long, b long").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(a, root) for every a that is linked and not the smallest of its component."""

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()

    pairs = cut_lineage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "links")
    seen = state(pairs)
    while True:
        both = pairs.union(pairs.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low).distinct()
        pairs = cut_lineage(small, "links")
        now = state(pairs)
        if now == seen:
            return pairs.select("a", F.col("b").alias("root"))
        seen = now


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, radius: int = 3) -> DataFrame:
    """Per row: doc_id, fingerprint (hex), component_id (smallest doc_id reachable over links)."""
    each = cut_lineage(fingerprints(docs, key, text, words), "simhash")
    nodes = cut_lineage(each.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    roots = connected(links(nodes.select("fp"), radius))
    members = roots.select(F.col("a").alias("fp"), "root").union(roots.select("root", "root").distinct())
    lowest = nodes.join(members, "fp").groupBy("root").agg(F.min("first").alias("lowest"))
    groups = members.join(lowest, "root").select("fp", "lowest")
    labels = nodes.join(groups, "fp", "left").select("fp", F.coalesce("lowest", "first").alias("component_id"))
    return each.join(labels, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
