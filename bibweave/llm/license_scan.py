"""License scans by diagonal voting, in DataFrame functions alone.

A template is a run of words with a label. Every rolling word k-gram of every document is joined, by hash, to the places of the
templates' k-grams (k: ``gram``, or the whole template if it has fewer words) and compared word by word. A hit votes for its diagonal, the place
in the document minus the place in the template: the words of one copy vote alike. Votes are gathered per document, template and
diagonal, and diagonals at most ``drift`` apart are merged, so that a copy with a few words more or less is one span, no longer
than the template by twice the drift. Its score is the part of the template's words that its hits verified.

An exact template (a base phrase) counts where one diagonal has all its words: every such place is one. Any other adds its label
where a merged span scores ``least`` or more. Several templates may have one label.

Words are lower-cased (A-Z) runs of digits, letters and all non-ASCII characters. Null and empty texts have no words, no labels
and the score zero. Every row is judged by itself, also rows without an id or with a repeated one, and has one row in the result;
columns besides id and text play no part, whatever their names. Templates of fewer than two words, or without label, never occur.
A document's own hits meet in one task, those of different documents need not; a text must fit, with its words, into one row.
No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from bibweave.llm.shared import ascii_lower, chosen

_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The base phrases with their labels.
BASE = [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]

# Usual license notices, each with the label of its license.
NOTICES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
]

#: Bytes of the templates' k-grams up to which they are broadcast; beyond that they are shuffled with those of the documents.
BROADCAST_BYTES = 8_000_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _BETWEEN), "")


def templates(spark: SparkSession, base: list[tuple[str, str]] = BASE, notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """label, phrase, exact."""
    rows = [F.struct(F.lit(a).alias("label"), F.lit(p).alias("phrase"), F.lit(e).alias("exact")) for found, e in ((base, True), (notices, False)) for a, p in found]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _grams(templates: DataFrame, gram: int) -> DataFrame:
    """One row per place of a template: its k-gram as words, the hash of the first two and what tells the template."""
    each = templates.where("label is not null").select("label", "exact", words(F.col("phrase")).alias("all")).where("size(all) > 1").distinct()
    k = F.least(F.size("all"), F.lit(gram))
    placed = each.select("label", "exact", "all", k.alias("k"), F.explode(F.sequence(F.lit(0), F.size("all") - k)).alias("place"))
    return placed.select(
        F.xxhash64(F.get("all", F.col("place")), F.get("all", F.col("place") + 1)).alias("key"), F.slice("all", F.col("place") + 1, F.col("k")).alias("gram"),
        "label", "exact", F.xxhash64("all").alias("template"), F.size("all").alias("length"), "k", "place",
    )


def hits(docs: DataFrame, templates: DataFrame, key: str = "doc_id", text: str = "text", gram: int = 3, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Verified k-gram hits: row, doc_id, n_words, label, exact, template, length, k, place, diagonal.

    Every row of ``docs`` has at least one row here, with null from ``label`` on where it has no hit at its first word.
    """
    grams = _grams(templates, gram)
    size = grams.agg(F.sum(F.octet_length(F.concat_ws(" ", "gram", "label")) + 64)).first()[0] or 0
    each = chosen(docs, key, text).select(F.monotonically_increasing_id().alias("row"), "doc_id", words(F.col("text")).alias("words"))
    at = each.select("row", "doc_id", "words", F.size("words").alias("n_words"), F.posexplode_outer("words").alias("at", "word"))
    at = at.withColumn("first", F.xxhash64("word", F.get("words", F.col("at") + 1)))
    same = (F.col("first") == F.col("key")) & (F.slice("words", F.col("at") + 1, F.col("k")) == F.col("gram"))
    met = at.join(F.broadcast(grams) if size <= broadcast_bytes else grams, same, "left").where("label is not null or coalesce(at, 0) = 0")
    return met.select("row", "doc_id", "n_words", "label", "exact", "template", "length", "k", "place", (F.col("at") - F.col("place")).alias("diagonal"))


def spans(hits: DataFrame, drift: int = 2) -> DataFrame:
    """Per row, template and diagonal: whole (all words of the template on it) and score (with the diagonals near it).

    Rows without any hit stay, with null from ``label`` on.
    """
    lines = hits.repartition("row").groupBy("row", "doc_id", "n_words", "label", "exact", "template", "length", "k", "diagonal").agg(F.collect_list("place").alias("places"))
    covered = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + F.col("k") - 1))))
    near = W.partitionBy("row", "template", "label", "exact").orderBy("diagonal").rangeBetween(-drift, drift)
    lines = lines.withColumn("covered", covered)
    merged = F.size(F.array_distinct(F.flatten(F.collect_list("covered").over(near))))
    part = F.when(F.col("exact"), F.size("covered")).otherwise(merged) / F.col("length")
    return lines.withColumn("whole", F.size("covered") == F.col("length")).withColumn("score", part).drop("places", "covered", "k")


def scan(docs: DataFrame, templates: DataFrame, key: str = "doc_id", text: str = "text", gram: int = 3, drift: int = 2, least: float = 0.8) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (of the best span)."""
    base = F.col("exact") & F.col("whole")
    found = spans(hits(docs, templates, key, text, gram), drift)
    names = lambda where: F.array_join(F.sort_array(F.collect_set(F.when(where, F.col("label")))), ",")
    per = found.groupBy("row", "doc_id", "n_words").agg(
        F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("diagonal"))).cast("long").alias("last_word"), names(base).alias("base_labels"),
        names(base | (~F.col("exact") & (F.col("score") >= least))).alias("labels"), F.coalesce(F.max("score"), F.lit(0.0)).alias("score"),
    )
    return per.drop("row").withColumn("n_words", F.col("n_words").cast("long"))
