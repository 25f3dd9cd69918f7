"""A Merkle manifest of a table of documents, as a persistent tree whose versions copy paths.

A row's leaf is a digest of its fields. Per source the leaves, in the order of their ids, are nodes; every ``RUN`` consecutive
nodes are digested to one until one remains, the subroot; the subroots, in the order of their sources, give the root alike.

Leaves get their places by a range partitioning of the whole table and counts per partition, so a source of any size is spread.
Nodes are then grouped to aligned blocks of ``SPAN`` places, each a small tree of ``LEVELS`` levels that one task builds; the
tops of the blocks are the nodes of the next stage, and so on to the root. Blocks are written and never changed. Tampering with
a leaf makes a version: the nodes on the path from the leaf upwards, first within its block, then on through the blocks above.
Every other node is the base's. The versions of a block go up from that block, each with the runs it passes, so those above
aren't met by all versions below them.

Null ids come before all others of their source, null sources before all others; rows that repeat an id are ordered by their
leaf; equal rows are leaves of their own. A row without an id is never tampered with. Columns besides the five fields play no
part, whatever their names. An empty text is a value of no bytes, unlike null. No rows give no rows. A text must be shorter than
half of what one row of Spark can hold (1 GB).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from bibweave.llm.shared import ascii_lower
from bibweave.session import cut_lineage

#: Nodes that are digested to one, levels of a block, and so the nodes of a block.
RUN, LEVELS = 16, 3
SPAN = RUN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<place: int, others: string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` nodes until one remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // RUN), levels + 1
    return levels


class Tree:
    """The nodes of one block and what they are digested to; a version is a path of new nodes beside them."""

    def __init__(self, nodes: list[str], levels: int):
        self.levels = [nodes]
        for _ in range(levels):
            below = self.levels[-1]
            self.levels.append([digest("".join(below[i : i + RUN])) for i in range(0, len(below), RUN)])

    def path(self, at: int) -> list[tuple[int, str]]:
        """From node ``at`` upwards: its place in its run and the siblings, joined."""
        out = []
        for nodes in self.levels[:-1]:
            begin = at - at % RUN
            out.append((at - begin, "".join(nodes[begin:at]) + "".join(nodes[at + 1 : begin + RUN])))
            at //= RUN
        return out

    def version(self, at: int, node: str) -> list[str]:
        """The copied nodes of the version in which node ``at`` is another, from that node to the top of the block."""
        return continued(self.path(at), node)


def continued(path: list[tuple[int, str]], node: str) -> list[str]:
    """``node`` and its new ancestors along a path."""
    out = [node]
    for place, others in path:
        cut = len(node) * place
        out.append(digest(others[:cut] + out[-1] + others[cut:]))
    return out


def leaf(*fields: Column) -> Column:
    """The digest of fields in order: ``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    parts = [F.coalesce(F.concat(F.octet_length(s := f.cast("string")).cast("string"), F.lit(":"), s), F.lit("-")) for f in fields]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def leaves(docs: DataFrame, tampered: Column | None = None, change: Column | None = None) -> DataFrame:
    """Per row: tree (its source), doc_id, node (its leaf), other (the leaf after tampering, null where a row is left alone).

    ``change`` is the text after tampering, ``tampered`` tells which rows it is for; by default letters A-Z are lower-cased where
    5 divides the CRC-32 of the id.
    """
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0 if tampered is None else tampered
    change = ascii_lower(F.col("text")) if change is None else change
    fields = [F.col(c) for c in FIELDS]
    return docs.select(
        F.col("source").cast("string").alias("tree"), "doc_id", leaf(*fields).alias("node"),
        F.when(tampered, leaf(*fields[:-1], change)).alias("other"),
    )


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with pos (place within its tree, from 0) and n (nodes of its tree), by tree and the columns of ``order``."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()), "merkle-rows")
    ranged = rows.repartitionByRange(parts, "tree", *order, "row").sortWithinPartitions("tree", *order, "row").drop("row")
    ranged = cut_lineage(ranged.withColumn("seq", F.monotonically_increasing_id()), "merkle-ranged").withColumn("part", F.shiftright("seq", 33))
    runs = ranged.groupBy("tree", "part").agg(F.min("seq").alias("first"), F.count("*").alias("size"))
    whole = W.partitionBy("tree")
    before = F.sum("size").over(whole.orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("size")
    runs = runs.select(F.col("tree").alias("of"), F.col("part").alias("within"), (before - F.col("first")).alias("shift"), F.sum("size").over(whole).alias("n"))
    met = ranged.join(runs, F.col("tree").eqNullSafe(F.col("of")) & (F.col("part") == F.col("within")))
    return met.withColumn("pos", F.col("seq") + F.col("shift")).drop("of", "within", "shift", "seq", "part")


def _blocked(nodes: DataFrame, *carried: str) -> DataFrame:
    """One row per aligned block: tree, n, block, members (in order)."""
    members = F.sort_array(F.collect_list(F.struct("pos", "node", *carried)))
    return nodes.groupBy("tree", "n", F.expr(f"pos div {SPAN}L").alias("block")).agg(members.alias("members"))


def _hex(nodes: pa.Array) -> list[str | None]:
    return [None if x is None else x.hex() for x in nodes.to_pylist()]


def _trees(batch: pa.RecordBatch) -> Iterator[tuple[dict, pa.StructArray, Tree]]:
    """Each block of a batch: its other columns, its members and its tree."""
    members = batch.column("members")
    for i, row in enumerate(batch.drop_columns(["members"]).to_pylist()):
        inside = members[i].values
        yield row, inside, Tree(_hex(inside.field("node")), min(LEVELS, height(row["n"])))


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [{"tree": row["tree"], "n": -(-row["n"] // SPAN), "pos": row["block"], "node": bytes.fromhex(tree.levels[-1][0])} for row, _, tree in _trees(batch)]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("tree", pa.string()), ("n", pa.int64()), ("pos", pa.int64()), ("node", pa.binary())]))


def _climbed(nodes: DataFrame, *carried: str) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of all stages, and (tree, node) of the one node that remains of every tree."""
    stages, tops = [], None
    while True:
        stages.append(cut_lineage(_blocked(nodes, *(carried if not stages else ())), "merkle-blocks"))
        nodes = cut_lineage(stages[-1].mapInArrow(_tops, "tree string, n long, pos long, node binary"), "merkle-tops")
        done = nodes.where("n = 1").select("tree", "node")
        tops = done if tops is None else tops.union(done)
        nodes = nodes.where("n > 1")
        if nodes.isEmpty():
            return stages, tops


def _above(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """Blocks with the path, marks and level of what lies above them."""
    to = paths.select(*(F.col(c).alias(f"to_{c}") for c in ("tree", "pos", "last")), "path", "marks")
    last = F.col("n") <= SPAN
    return blocks.join(to, F.col("tree").eqNullSafe(F.col("to_tree")) & (F.col("block") == F.col("to_pos")) & (last == F.col("to_last"))).drop("to_tree", "to_pos", "to_last")


def _descended(stages: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The paths above the blocks of the first stage: (tree, pos, last, path, marks).

    ``tops`` has them for the one node that remains of each tree; ``last`` tells such rows from nodes with blocks above them.
    """

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, inside, tree in _trees(batch):
                upper = [(p["place"], p["others"]) for p in row["path"]]
                for i, pos in enumerate(inside.field("pos").to_pylist()):
                    path = [{"place": p, "others": o} for p, o in tree.path(i) + upper]
                    yield pa.RecordBatch.from_pylist([{"tree": row["tree"], "pos": pos, "last": False, "path": path, "marks": row["marks"]}], schema)

    schema = pa.schema([
        ("tree", pa.string()), ("pos", pa.int64()), ("last", pa.bool_()),
        ("path", pa.list_(pa.struct([("place", pa.int32()), ("others", pa.string())]))), ("marks", pa.list_(pa.string())),
    ])
    paths = tops
    for blocks in reversed(stages[1:]):
        lower = _above(blocks, paths).mapInArrow(down, f"tree string, pos long, last boolean, path {_PATH}, marks array<string>")
        paths = cut_lineage(lower, "merkle-paths").union(tops)
    return paths


@dataclass
class Manifest:
    """The written tree: blocks of every stage of the sources (``lower``) and of the tree of subroots (``upper``)."""

    lower: list[DataFrame]
    upper: list[DataFrame]
    paths: DataFrame

    def nodes(self) -> DataFrame:
        """All nodes of the sources' trees: source, level (0 for leaves), place, node (hex); a block's top is a node above."""

        def run(first: int):
            def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for row, _, tree in _trees(batch):
                        for up, level in enumerate(tree.levels[:-1] if row["n"] > SPAN else tree.levels):
                            begin = row["block"] * (SPAN // RUN**up)
                            rows = [{"source": row["tree"], "level": first + up, "place": begin + i, "node": x} for i, x in enumerate(level)]
                            yield pa.RecordBatch.from_pylist(rows, schema)

            return nodes

        schema = pa.schema([("source", pa.string()), ("level", pa.int32()), ("place", pa.int64()), ("node", pa.string())])
        out = None
        for i, blocks in enumerate(self.lower):
            found = blocks.mapInArrow(run(i * LEVELS), "source string, level int, place long, node string")
            out = found if out is None else out.union(found)
        return out

    def versions(self) -> DataFrame:
        """The nodes that each tampered leaf copied: doc_id, source, place (of the leaf), level, node (hex), up to the root.

        Levels go on through the tree of subroots; the last one is the root of the version.
        """

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row, inside, tree in _trees(batch):
                    upper = [(p["place"], p["others"]) for p in row["path"]]
                    ids, others = inside.field("doc_id").to_pylist(), _hex(inside.field("other"))
                    for i, (doc, other) in enumerate(zip(ids, others)):
                        if other is not None:
                            copied = tree.version(i, other)
                            copied += continued(upper, copied[-1])[1:]
                            place = row["block"] * SPAN + i
                            rows = [{"doc_id": doc, "source": row["tree"], "place": place, "level": k, "node": x} for k, x in enumerate(copied)]
                            yield pa.RecordBatch.from_pylist(rows, schema)

        schema = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("place", pa.int64()), ("level", pa.int32()), ("node", pa.string())])
        return _above(self.lower[0], self.paths).mapInArrow(run, "doc_id long, source string, place long, level int, node string")

    def verified(self) -> DataFrame:
        """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root (of its version, if tampered with), verified."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row, inside, tree in _trees(batch):
                    upper = [(p["place"], p["others"]) for p in row["path"]]
                    proved = "".join(others for _, others in upper)
                    subroot, root = row["marks"]
                    ids, own, others = inside.field("doc_id").to_pylist(), tree.levels[0], _hex(inside.field("other"))
                    out = []
                    for i, (doc, mine, other) in enumerate(zip(ids, own, others)):
                        path = tree.path(i)
                        folded = continued(upper, continued(path, other or mine)[-1])[-1]
                        proof = digest("".join([*(o for _, o in path), proved]))
                        out.append({"doc_id": doc, "leaf": mine, "subroot": subroot, "root": root, "proof_sha256": proof, "folded_root": folded, "verified": folded == root})
                    yield pa.RecordBatch.from_pylist(out, schema)

        schema = pa.schema([("doc_id", pa.int64())] + [(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")] + [("verified", pa.bool_())])
        return _above(self.lower[0], self.paths).mapInArrow(
            run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
        )


def build(leaves: DataFrame) -> Manifest:
    """The manifest of leaves (tree, doc_id, node, other)."""
    nodes = placed(leaves.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id", "node")
    lower, subroots = _climbed(nodes, "doc_id", "other")
    # the tree of subroots: one more tree, whose nodes carry their source
    sources = placed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "node"), "source")
    upper, root = _climbed(sources, "source")
    top = root.select("tree", F.lit(0).cast("long").alias("pos"), F.lit(True).alias("last"), F.expr(f"cast(array() as {_PATH})").alias("path"), F.array(F.lower(F.hex("node"))).alias("marks"))

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, inside, tree in _trees(batch):
                above = [(p["place"], p["others"]) for p in row["path"]]
                names = inside.field("source").to_pylist()
                for i, (name, node) in enumerate(zip(names, tree.levels[0])):
                    path = [{"place": p, "others": o} for p, o in tree.path(i) + above]
                    yield pa.RecordBatch.from_pylist([{"tree": name, "pos": 0, "last": True, "path": path, "marks": [node, *row["marks"]]}], schema)

    schema = pa.schema([
        ("tree", pa.string()), ("pos", pa.int64()), ("last", pa.bool_()),
        ("path", pa.list_(pa.struct([("place", pa.int32()), ("others", pa.string())]))), ("marks", pa.list_(pa.string())),
    ])
    tops = _above(upper[0], _descended(upper, top)).mapInArrow(down, f"tree string, pos long, last boolean, path {_PATH}, marks array<string>")
    return Manifest(lower, upper, _descended(lower, cut_lineage(tops, "merkle-paths")))
