"""Connected components of a graph of ids, and the clusters of ids that are candidates for merging.

The graph is a table of pairs. In a round every id takes the one of least hash among itself and its neighbours as its label, and
pairs of ids become pairs of labels; those within one label are done and leave. The hash makes the order of ids random, so a round
leaves a part of the ids only, whatever the shape of the graph (local contraction), and all rounds together cost little more
than the first. Labels and pairs of each round are written to the shared folder, so a lost executor repeats one round at most.
At the end labels are followed from the last round to the first.

An id with very many neighbours (a placeholder that half of the records carry) would bring all its pairs to one task, as the
least of its neighbours has to meet each of them. So an id's pairs are divided into ``salts`` parts by the hash of the
neighbour; the least is taken per part, then over the parts, and handed to every part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bibweave.session import cut_lineage

c = F.col
SALTS = 32


def _salt(other: str, salts: int):
    return F.pmod(F.xxhash64(other), F.lit(salts)).cast("int")


def _labels(pairs: DataFrame, salts: int, seed: int) -> DataFrame:
    """(id, label, salts) of every id in ``pairs`` (a, b): the id of least hash among itself and its neighbours, and its parts."""
    least = lambda x: F.struct(F.xxhash64(x, F.lit(seed)).alias("h"), c(x).alias("label"))
    ends = pairs.select(c("a").alias("id"), c("b").alias("n")).union(pairs.select("b", "a")).withColumn("salt", _salt("n", salts))
    parts = ends.groupBy("id", "salt").agg(F.min(least("n")).alias("m"))
    # an id has at most ``salts`` parts, so the list is short
    whole = parts.groupBy("id").agg(F.min("m").alias("m"), F.collect_list("salt").alias("salts"))
    return whole.select("id", F.least("m", least("id"))["label"].alias("label"), "salts")


def _labelled(pairs: DataFrame, labels: DataFrame, salts: int) -> DataFrame:
    """The pairs of different labels that the pairs of ids become."""
    for end, other in (("a", "b"), ("b", "a")):
        parts = labels.select(c("id").alias(end), c("label").alias(f"{end}_label"), F.explode("salts").alias("salt"))
        pairs = pairs.withColumn("salt", _salt(other, salts)).join(parts, [end, "salt"]).drop("salt")
    apart = pairs.where("a_label != b_label")
    return apart.select(F.greatest("a_label", "b_label").alias("a"), F.least("a_label", "b_label").alias("b")).distinct()


def components(edges: DataFrame, left: str, right: str, salts: int = SALTS) -> DataFrame:
    """(id, component) of every id of either column; the component is its smallest id.

    A pair with a missing side brings its other side in as an id of its own; a pair of an id with itself likewise.
    """
    both = edges.select(c(left).alias("a"), c(right).alias("b"))
    whole = both.where("a is not null and b is not null and a != b")
    ids = both.select(c("a").alias("id")).union(both.select("b")).where("id is not null").distinct()
    pairs = cut_lineage(whole.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    rounds = []
    while not pairs.isEmpty():
        # two rounds have one order: the second ends what the first made of a hub
        rounds.append(cut_lineage(_labels(pairs, salts, len(rounds) // 2), "components"))
        pairs = cut_lineage(_labelled(pairs, rounds[-1], salts), "components")
    if not rounds:
        return ids.select("id", c("id").alias("component"))
    found = rounds.pop().select("id", c("label").alias("root"))
    while rounds:
        later = found.select(c("id").alias("label"), "root")
        found = rounds.pop().select("id", "label").join(later, "label", "left").select("id", F.coalesce("root", "label").alias("root"))
    found = cut_lineage(found, "components")
    least = found.groupBy("root").agg(F.min("id").alias("component"))
    return ids.join(found.join(least, "root").select("id", "component"), "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def id_pairs(authors: DataFrame, ids: list[str]) -> DataFrame:
    """Pairs (a, b) of the ids that stand on one author row, each written as ``column:value``.

    The first id present is paired with every other, which connects all ids of the row.
    """
    named = F.filter(F.array(*[F.concat(F.lit(f"{x}:"), c(x)) for x in ids]), lambda x: x.isNotNull())
    rows = authors.select(named.alias("ids")).where("size(ids) > 0")
    rest = F.when(F.size("ids") > 1, F.slice("ids", 2, len(ids))).otherwise(F.array(F.lit(None).cast("string")))
    return rows.select(F.get("ids", F.lit(0)).alias("a"), F.explode(rest).alias("b")).distinct()


def merge_candidates(authors: DataFrame, ids: list[str], person: str, record: str = "PID", salts: int = SALTS) -> DataFrame:
    """Clusters of ids that name one person but hold several values of ``person``: one row per id of such a cluster.

    Columns: component, kind, value, n_ids (of the cluster), n_persons (values of ``person`` in it), n_records (of this id).
    """
    found = components(id_pairs(authors, ids), "a", "b", salts)
    kind, value = F.regexp_extract("id", "^([^:]*):", 1), F.regexp_replace("id", "^[^:]*:", "")
    found = found.select("component", kind.alias("kind"), value.alias("value"))
    sizes = found.groupBy("component").agg(
        F.count(F.lit(1)).alias("n_ids"), F.count(F.when(c("kind") == person, 1)).alias("n_persons")).where("n_persons > 1")
    uses = authors.select(record, F.explode(F.array(*[F.struct(F.lit(x).alias("kind"), c(x).alias("value")) for x in ids])).alias("u"))
    counted = uses.select(record, "u.*").where("value is not null").groupBy("kind", "value").agg(F.countDistinct(record).alias("n_records"))
    return found.join(sizes, "component").join(counted, ["kind", "value"]).select(
        "component", "kind", "value", "n_ids", "n_persons", "n_records")
