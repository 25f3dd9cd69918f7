"""The operators of this subpackage as named queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from bibweave.llm import byte_bpe, decontaminate, exact_dedup, hard_negatives, language_id, license_scan, merkle_manifest, simhash, suffix_dedup, token_counts, url_filter, warc, wavelet_tokens

RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_url_trie(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    return url_filter.judge(_table(spark, folder, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


def op2_wavelet_tokens(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return wavelet_tokens.read(wavelet_tokens.write(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.counts(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048)


def op4_golomb_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.groups(_table(spark, folder, "documents"))


def op5_warc_members(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(_table(spark, folder, "pages"))


def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.digests(_table(spark, folder, "documents"), byte_bpe.public_codec(spark))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    pieces = language_id.Pieces.of_model(public_tokenizers.path("piece_bpe_32k.model"))
    langs, probability = language_id.train(docs.where(~held_out), pieces)
    return language_id.predict(docs, pieces, langs, probability).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_simhash_bktree(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.components(_table(spark, folder, "documents"))


def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = suffix_dedup.without_repeats(_table(spark, folder, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.verdicts(decontaminate.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark")))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle_manifest.build(merkle_manifest.leaves(_table(spark, folder, "documents"))).verified()


def op12_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(_table(spark, folder, "documents"), license_scan.templates(spark))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(_table(spark, folder, "embeddings"), F.expr("id % 100 = 0"), label=label)


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_url_trie, op2_wavelet_tokens, op3_token_counts, op4_golomb_dedup, op5_warc_members, op6_byte_bpe, op7_language_id, op8_simhash_bktree, op9_suffix_dedup, op10_decontaminate, op11_merkle_manifest, op12_license_scan, op13_hard_negatives, pipeline)
}



def _merkle_levels(name: str, levels: int) -> str:
    """CTEs that climb from ``{name}0`` (tree, pos, n, h, place, f) by ``levels`` levels, 16 nodes to one while a tree has several.

    ``place`` tells the first node below, ``f`` is the node folded from each leaf below, ``p`` the siblings met so far.
    """
    out = []
    for k in range(levels):
        a, b = f"{name}{k}", f"{name}{k + 1}"
        out.append(f"""
        {a}_runs AS (SELECT tree, pos // 16 AS run, n, string_agg(h, '' ORDER BY pos) AS joined, list(h ORDER BY pos) AS hs
            FROM (SELECT DISTINCT tree, pos, n, h FROM {a}) GROUP BY ALL),
        {b} AS (SELECT leaf, a.tree, CASE WHEN a.n > 1 THEN a.pos // 16 ELSE a.pos END AS pos, CASE WHEN a.n > 1 THEN (a.n + 15) // 16 ELSE a.n END AS n,
            CASE WHEN a.n > 1 THEN sha256(joined) ELSE h END AS h,
            CASE WHEN a.n > 1 THEN sha256(array_to_string(hs[: a.pos % 16], '') || f || array_to_string(hs[a.pos % 16 + 2 :], '')) ELSE f END AS f,
            CASE WHEN a.n > 1 THEN p || array_to_string(hs[: a.pos % 16], '') || array_to_string(hs[a.pos % 16 + 2 :], '') ELSE p END AS p
            FROM {a} a JOIN {a}_runs r ON a.tree = r.tree AND a.pos // 16 = r.run)""")
    return ",".join(out)


def _field(c: str) -> str:
    return f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c}, '-')"


_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LEAF = " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))
#: CRC-32 of a text of at most 20 bytes, bit by bit.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: [-ascii(x) - 1, -1000, -1000, -1000, -1000, -1000, -1000, -1000, -1000]))),
            lambda c, x: CASE WHEN x > -1000 THEN xor(c, -x - 1) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END), 4294967295)"""
_RULES = license_scan.BASE, license_scan.NOTICES
_TEMPLATES = ", ".join(f"('{label}', '{phrase}', {exact})" for found, exact in zip(_RULES, ("true", "false")) for label, phrase in found)
_WORDS = r"list_filter(regexp_split_to_array({}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"

ORACLES = {
    "op11_merkle_manifest": f"""
        WITH d AS (SELECT row_number() OVER () AS leaf, doc_id, source, sha256({_LEAF} || {_field("text")}) AS h,
            CASE WHEN {_CRC32} % 5 = 0 THEN sha256({_LEAF} || {_field("t")}) END AS other
            FROM (SELECT *, {_ASCII_LOWER.format("text")} AS t FROM documents)),
        trees AS (SELECT *, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT source FROM d)),
        s0 AS (SELECT leaf, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h, leaf) - 1 AS pos,
            count(*) OVER (PARTITION BY tree) AS n, h, coalesce(other, h) AS f, '' AS p FROM d JOIN trees ON d.source IS NOT DISTINCT FROM trees.source),
        {_merkle_levels("s", 5)},
        r0 AS (SELECT leaf, 0 AS tree, tree AS pos, (SELECT count(*) FROM trees) AS n, h, f, p FROM s5),
        {_merkle_levels("r", 5)}
        SELECT doc_id, d.h AS leaf, s5.h AS subroot, r5.h AS root, sha256(r5.p) AS proof_sha256, r5.f AS folded_root, r5.f = r5.h AS verified
        FROM d JOIN s5 USING (leaf) JOIN r5 USING (leaf)""",
    "op12_license_scan": rf"""
        WITH t AS (SELECT label, exact, {_WORDS.format(_ASCII_LOWER.format("phrase"))} AS w FROM (VALUES {_TEMPLATES}) x(label, phrase, exact)),
        g AS (SELECT label, exact, w, least(len(w), 3) AS k, unnest(generate_series(0, len(w) - least(len(w), 3))) AS place FROM t),
        d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(_ASCII_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
        places AS (SELECT r, w, unnest(generate_series(0, len(w) - 2)) AS i FROM d),
        lines AS (SELECT r, label, exact, g.w AS tw, i - place AS diagonal, flatten(list(generate_series(place, place + k - 1))) AS c
            FROM places s JOIN g ON s.w[i + 1] = g.w[place + 1] AND s.w[i + 2] = g.w[place + 2] AND s.w[i + 1 : i + k] = g.w[place + 1 : place + k] GROUP BY ALL),
        spans AS (SELECT r, label, exact, diagonal, len(list_distinct(c)) = len(tw) AS whole,
            len(list_distinct(CASE WHEN exact THEN c ELSE flatten(list(c) OVER (PARTITION BY r, label, exact, tw ORDER BY diagonal RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING)) END)) / len(tw) AS score FROM lines),
        f AS (SELECT r, count(*) FILTER (exact AND whole) AS n_base, min(diagonal) FILTER (exact AND whole) AS first_word, max(diagonal) FILTER (exact AND whole) AS last_word,
            string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact AND whole) AS base_labels,
            string_agg(DISTINCT label, ',' ORDER BY label) FILTER (CASE WHEN exact THEN whole ELSE score >= 0.8 END) AS labels, max(score) AS score FROM spans GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
            coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score FROM d LEFT JOIN f USING (r)""",
    "op13_hard_negatives": """
        WITH e AS (SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
            list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
            WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
            FROM e a, e b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
        SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
        FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
        WINDOW w AS (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) QUALIFY row_number() OVER w <= 10""",
    "op1_url_trie": r"""
        WITH rules(r, rh, rp, rv) AS (VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
            ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
        cut AS (SELECT page_id,
            translate(coalesce(regexp_extract(url, '(?s)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)
        SELECT page_id, host, path, arg_max(r, length(r)) AS rule, coalesce(arg_max(rv, length(r)), 'allow') AS verdict
        FROM cut LEFT JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
        GROUP BY page_id, host, path""",
    "op4_golomb_dedup": r"""
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
        WINDOW w AS (PARTITION BY norm)""",
    "op5_warc_members": r"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
        f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY h) ELSE page_id END AS first FROM p)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
            CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> first THEN first END AS refers_to FROM f""",
}
