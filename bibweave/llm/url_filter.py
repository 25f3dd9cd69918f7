"""URL filter: a trie over reversed host labels and path segments; of the rules that fit a url the longest decides.

A rule is ``host/path``. It fits its host and every subdomain if the url's path starts with the rule's path. Length counts
the characters of host and path; of equally long rules the one with the longer host wins, then ``block``. A url that no rule
fits gets ``default``. A null url, or one without ``://``, has an empty host and path. Rules without a host fit empty hosts
only; repeated rules are one rule. Columns of the input named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from bibweave.llm.shared import ascii_lower

#: Characters of rules that may be broadcast; a longer list is joined instead, with the same result.
BROADCAST_CHARS = 32_000_000


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def split_rule(text: str) -> tuple[str, str]:
    host, slash, path = text.partition("/")
    return "".join(c.lower() if c.isascii() else c for c in host), slash + path


class Trie:
    """Host labels from the right lead to a node; below it, path segments lead to the prefixes that end a rule."""

    def __init__(self, rules: Sequence[tuple[str, str]]):
        self.root: dict = {}
        for text, verdict in rules:
            host, path = split_rule(text)
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault("labels", {}).setdefault(label, {})
            *whole, last = path.split("/")
            node = node.setdefault("paths", {})
            for segment in whole:
                node = node.setdefault("segments", {}).setdefault(segment, {})
            rank = (len(host) + len(path), len(host), verdict == "block")
            old = node.setdefault("ends", {}).get(last)
            if old is None or old[0] < rank:
                node["ends"][last] = (rank, host + path, verdict)
            node["lengths"] = sorted({len(x) for x in node["ends"]}, reverse=True)

    def best(self, host: str, path: str) -> tuple[str | None, str | None]:
        found, node, segments = None, self.root, path.split("/")
        for label in reversed(host.split(".")):
            node = node.get("labels", {}).get(label)
            if node is None:
                break
            below = node.get("paths")
            for segment in segments:
                if below is None:
                    break
                for n in below.get("lengths", ()):
                    hit = below["ends"].get(segment[:n]) if n <= len(segment) else None
                    if hit and (found is None or hit[0] > found[0]):
                        found = hit
                below = below.get("segments", {}).get(segment)
        return (found[1], found[2]) if found else (None, None)


def _by_trie(df: DataFrame, rules: list[tuple[str, str]], default: str) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(Trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def decided(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        trie = shared.value
        return pd.DataFrame([trie.best(h, p) for h, p in zip(host, path)], columns=["rule", "verdict"], dtype=object)

    hit = decided("host", "path")
    return df.withColumn("_hit", hit).withColumns({"rule": F.col("_hit.rule"), "verdict": F.coalesce("_hit.verdict", F.lit(default))}).drop("_hit")


def _by_join(df: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same decision as joins: host suffixes meet the rules' hosts, then path prefixes of the lengths that host has."""
    cut = F.instr("rule", "/")
    parts = rules.select(
        ascii_lower(F.when(cut > 0, F.substring("rule", F.lit(1), cut - 1)).otherwise(F.col("rule"))).alias("_host"),
        F.when(cut > 0, F.expr("substring(rule, instr(rule, '/'))")).otherwise(F.lit("")).alias("_path"), "verdict",
    ).groupBy("_host", "_path").agg(F.max("verdict").alias("_verdict"))  # 'block' > 'allow'
    lengths = parts.groupBy("_host").agg(F.collect_set(F.length("_path")).alias("_lengths"))
    labels = F.split("host", r"\.", -1)
    hits = (
        df.select("host", "path").distinct()
        .withColumn("_labels", labels)
        .withColumn("_n", F.explode(F.sequence(F.lit(1), F.size("_labels"))))
        .withColumn("_host", F.expr("array_join(slice(_labels, _n, size(_labels)), '.')"))
        .join(lengths, "_host")
        .withColumn("_length", F.explode("_lengths"))
        .where(F.col("_length") <= F.length("path"))
        .withColumn("_path", F.expr("substring(path, 1, _length)"))
        .join(parts, ["_host", "_path"])
        .withColumn("_rank", F.struct(F.length("_host") + F.length("_path"), F.length("_host"), F.col("_verdict") == "block"))
        .groupBy("host", "path")
        .agg(F.max_by(F.concat("_host", "_path"), "_rank").alias("rule"), F.max_by("_verdict", "_rank").alias("verdict"))
    )
    return df.join(hits, ["host", "path"], "left").withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def judge(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", broadcast_chars: int = BROADCAST_CHARS) -> DataFrame:
    """Every row of ``df`` with host, path, rule (null if none fits) and verdict. ``rules``: (rule, verdict)."""
    rules = rules.select("rule", "verdict").where("rule is not null and verdict in ('allow', 'block')")
    df = df.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))}).drop("rule", "verdict", "_hit")
    size = rules.agg(F.sum(F.length("rule"))).first()[0] or 0
    if size > broadcast_chars:
        return _by_join(df, rules, default)
    return _by_trie(df, [tuple(r) for r in rules.collect()], default)
