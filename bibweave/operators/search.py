"""Ranked text search for a batch of queries over a whole corpus.

A query matches a text when all its words occur within a short stretch; the
score is BM25 over the occurrences inside such stretches. Texts are read once
into postings, one row per text and query word with its places; a query is
looked up by its rarest word only, so a common word never meets every text that
has it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bibweave.functions.text import first_words, fold_text
from bibweave.session import cut_lineage

c = F.col

# BM25 constants and the default stretch between first and last word.
K1, B, NEAR = 1.2, 0.75, 10


def tokens(col):
    """Words of a text: letters and digits, lower case, accents folded."""
    return F.array_remove(F.split(fold_text(col), r"[^\p{L}\p{N}]+"), "")


def query_terms(queries: DataFrame, key: str, text: str, n_words: int = 4) -> DataFrame:
    """(query, idx, term) of the first ``n_words + 1`` words of each query text."""
    return queries.select(
        c(key).alias("query"), F.posexplode(tokens(first_words(c(text), n_words))).alias("idx", "term")
    )


def postings(corpus: DataFrame, doc: str, text: str, vocabulary: DataFrame) -> DataFrame:
    """(doc, len, term, places, first): the places of each word of the vocabulary in each text, in order, from one reading.

    Every text has one row that is ``first``, also one without any of the words (its term is missing), so the rows tell the
    number of texts and their mean length as well.
    """
    texts = corpus.select(c(doc).alias("doc"), F.explode(F.array(tokens(c(text)))).alias("words"))
    placed = texts.select("doc", F.size("words").alias("len"), F.posexplode_outer("words").alias("pos", "word"))
    known = vocabulary.select(c("term").alias("wanted"))
    met = placed.join(known, c("word") == c("wanted"), "left").where("wanted is not null or coalesce(pos, 0) = 0")
    return met.groupBy("doc", "len", c("wanted").alias("term")).agg(
        F.sort_array(F.collect_list("pos")).alias("places"), F.max(F.coalesce("pos", F.lit(0)) == 0).alias("first"))


def _within(places: Column, around: Column, low: int, high: int) -> Column:
    """The places that have one of ``around`` at most ``low`` before or ``high`` behind them."""
    return F.filter(places, lambda p: F.exists(around, lambda r: (r >= p - low) & (r <= p + high)))


def _once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """The rows with a column that is computed once: a lambda that uses it would repeat an expression for every element."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def _together(rows: DataFrame, spread: int) -> DataFrame:
    """(query, doc, len, term, tf): how often each word of a query stands in a stretch that has all its words.

    ``rows`` (query, doc, len, found) have structs (n, term, places), fewest places first. Only places near one of the rarest
    word's are looked at; a text that lacks a word there has no such stretch.
    """
    rare = F.get(c("found"), F.lit(0))["places"]
    near = F.transform("found", lambda f: F.struct(f["term"].alias("term"), _within(f["places"], c("rare"), spread, spread).alias("places")))
    close = _once(_once(rows, "rare", rare), "near", near).where(F.forall("near", lambda f: F.size(f["places"]) > 0))
    every = F.array_distinct(F.flatten(c("near.places")))
    opens = F.filter(every, lambda p: F.forall("near", lambda f: F.exists(f["places"], lambda x: (x >= p) & (x <= p + spread))))
    met = _once(close, "opens", opens).where(F.size("opens") > 0)
    counts = F.transform("near", lambda f: F.struct(f["term"].alias("term"), F.size(_within(f["places"], c("opens"), spread, 0)).alias("tf")))
    return met.select("query", "doc", "len", F.explode(counts).alias("x")).select("query", "doc", "len", "x.*").where("tf > 0")


def search(corpus: DataFrame, doc: str, text: str, terms: DataFrame, near: int = NEAR) -> DataFrame:
    """(query, doc, score) of all matches. ``terms`` has (query, idx, term).

    Runs one job: the postings of the query words are written to the shared folder, because the later steps read them and
    reading texts is the cost.
    """
    wanted = terms.select("query", "term").distinct()
    stored = cut_lineage(postings(corpus, doc, text, wanted.select("term").distinct()), "postings")
    size = stored.where("first").agg(F.count(F.lit(1)).alias("n_docs"), F.avg("len").alias("avg_len"))
    listed = stored.where("term is not null")
    frequency = listed.select("term", "doc").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    known = wanted.join(frequency, "term", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    # a group has as many rows as its query has words
    lead = known.where("query is not null").groupBy("query").agg(F.min_by("term", F.struct("df", "term")).alias("term"), F.collect_list("term").alias("words"))
    candidates = lead.join(listed.select("term", "doc", "len"), "term").select("query", "words", "doc", "len")
    # a group has as many rows as its text has different words
    texts = listed.groupBy("doc", "len").agg(F.collect_list(F.struct(F.size("places").alias("n"), "term", "places")).alias("has"))
    rows = candidates.join(texts, ["doc", "len"]).where(F.size(F.array_except("words", c("has.term"))) == 0)
    found = F.sort_array(F.filter("has", lambda f: F.array_contains("words", f["term"])))
    tf = _together(_once(rows.select("query", "doc", "len", "words", "has"), "found", found).select("query", "doc", "len", "found"), near + 1)
    weights = terms.groupBy("query", "term").agg(F.count(F.lit(1)).alias("times")).join(frequency, "term")
    n, avg_len = size.select("n_docs").scalar(), size.select("avg_len").scalar()
    idf = F.log((n - c("df") + 0.5) / (c("df") + 0.5))
    idf = F.when(idf > 0, idf).otherwise(F.lit(1e-6))
    part = idf * c("tf") * (K1 + 1) / (c("tf") + K1 * (1 - B + B * c("len") / avg_len))
    scored = tf.join(weights, ["query", "term"])
    return scored.groupBy("query", "doc").agg(F.sum(part * c("times")).alias("score"))


def search_names(
    queries: DataFrame, key: str, text: str, corpus: DataFrame, doc: str, body: str, n_words: int = 4, near: int = NEAR
) -> DataFrame:
    """Every query row with its matches; a query without any stays once."""
    hits = search(corpus, doc, body, query_terms(queries, key, text, n_words), near)
    return queries.select(key, text).join(hits.withColumnRenamed("query", key), key, "left")
