"""The operators on awkward rows (nulls, empty and long texts, ties, repeated rows, clashing columns, no rows) against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from bibweave.llm import byte_bpe, decontaminate, exact_dedup, language_id, queries, simhash, suffix_dedup, token_counts, url_filter, warc, wavelet_tokens

SF = "/root/testdata/sf0.001"
ODD = [(None, None), (None, "a  b"), (1, ""), (2, None), (3, "a\tb"), (3, "a\tb"), (4, "A b"), (5, "long word " * 3000), (6, "x" * 4000), (7, "ÉÀ 漢字 \u0301"), (8, "!!! 123"), (9, "long word " * 3000 + "!")]


def by_text(rows):
    return sorted(rows, key=lambda r: tuple(map(str, r)))


@pytest.fixture(scope="module")
def docs(spark):
    real = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = ODD + [(100 + k, t) for k, t in real[:120]] + [(400 + k, t + " more") for k, t in real[:20]]
    clashing = "string as doc, string as kept, string as ids, string as fp, string as file, string as host"
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    return rows, df.selectExpr("*", *(f"'x' {c.strip()[7:]}" for c in clashing.split(",")))


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_wavelet_tokens(docs):
    rows, df = docs
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    index = wavelet_tokens.write(df, public_tokenizers.path("byte_bpe_50k.json"), 2, shard_ids=500)
    got = sorted(wavelet_tokens.read(index).collect(), key=lambda r: r["start"])
    ids = [library.encode(t or "", add_special_tokens=False).ids + [2] for _, t in rows]
    expected = [(k, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (k, _), x in zip(rows, ids)]
    assert by_text((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == by_text(expected)
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1].tolist()]
    order = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert order == sorted(order)
    assert wavelet_tokens.occurrences(index, 2).agg(F.sum("n")).first()[0] == len(rows)
    assert wavelet_tokens.read(wavelet_tokens.write(df.limit(0), public_tokenizers.path("byte_bpe_50k.json"), 2)).count() == 0


def test_token_counts(docs):
    rows, df = docs
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = [(k, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 2048) for k, t in rows]
    for chunk in (token_counts.CHUNK, 300):
        got = token_counts.counts(df, public_tokenizers.path("word_bpe_49k.json"), 2048, chunk=chunk)
        assert by_text(map(tuple, got.collect())) == by_text(expected)
    assert token_counts.counts(df.limit(0), public_tokenizers.path("word_bpe_49k.json"), 1).count() == 0


def test_exact_dedup(docs):
    rows, df = docs
    groups = defaultdict(list)
    for k, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(k)
    expected = []
    for text, ids in groups.items():
        ids.sort(key=lambda k: (k is None, k or 0))
        expected += [(k, ids[0], len(ids), i == 0, sha(text.encode())) for i, k in enumerate(ids)]
    for bits in (exact_dedup.FILTER_BITS, 64):
        assert by_text(map(tuple, exact_dedup.groups(df, filter_bits=bits).collect())) == by_text(expected)
    assert exact_dedup.groups(df.limit(0)).count() == 0


def test_byte_bpe_plans_do_not_spell_out_its_tables(docs):
    coded = byte_bpe.digests(docs[1], byte_bpe.public_codec())
    assert len(coded._jdf.queryExecution().executedPlan().toString()) < 100_000


def test_byte_bpe(docs):
    rows, df = docs
    codec = byte_bpe.public_codec()
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for k, t in rows:
        ids = library.encode_ordinary(t or "")
        expected.append((k, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((t or "").encode())))
    for words in (byte_bpe.CACHED_WORDS, 3):
        assert by_text(map(tuple, byte_bpe.digests(df, codec, cached_words=words).collect())) == by_text(expected)
    assert byte_bpe.digests(df.limit(0), codec).count() == 0


def test_language_id(spark, docs):
    rows, df = docs
    out = queries.op7_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = out.where("held_out")
    assert held.where("lang = lang_pred").count() >= 0.95 * held.count() > 0
    assert out.where("score < 0 or score > 1").count() == 0
    pieces = language_id.Pieces(["▁a", "b"])
    assert language_id.train(df.withColumn("lang", F.lit(None).cast("string")), pieces)[0] == []
    got = language_id.predict(df, pieces, ["q"], np.full((3, 1), 1 / 3))
    assert {r["doc_id"] for r in got.where("lang_pred = 'und'").collect()} == {None, 1, 2, 8}
    assert got.count() == len(rows) and language_id.predict(df.limit(0), pieces, [], np.zeros((3, 0))).count() == 0


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def test_simhash(spark, docs):
    rows, df = docs
    prints, root = [plain_fingerprint(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        return i if root[i] == i else find(root[i])

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    low = {}
    for i, (k, _) in enumerate(rows):
        low[find(i)] = min((x for x in (low.get(find(i)), k) if x is not None), default=None)
    expected = [(k, f"{prints[i]:016x}", low[find(i)]) for i, (k, _) in enumerate(rows)]
    assert by_text(map(tuple, simhash.components(df).collect())) == by_text(expected)
    assert simhash.components(df.limit(0)).count() == 0
    nodes = spark.createDataFrame([(int(np.array(p, np.uint64).view(np.int64)),) for p in {*prints, *range(1, 40)}], "fp long")
    small, large = (set(map(tuple, simhash.connected(simhash.links(nodes, 3, *sizes)).collect())) for sizes in ((10, 4), (8192, 16384)))
    assert small == large and small


@pytest.mark.parametrize("length", [100, 20])
def test_suffix_dedup(spark, length):
    r = random.Random(5)
    words = ["".join(r.choices("abcdefgh é", k=r.randint(1, 60))) for _ in range(40)]
    rows = [(i, "".join(r.choice(words) for _ in range(r.randint(0, 12)))) for i in range(200)]
    rows += [(500, None), (501, ""), (502, "a" * 500), (503, "a" * 130), (504, "ab" * 300), (505, "x" * 99), (506, "x" * 100), (507, rows[7][1])]
    seen, expected = set(), []
    for k, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if data[i : i + length] in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(data[i : i + length])
        runs = sum(1 for i in range(len(data)) if gone[i] and not (i and gone[i - 1]))
        expected.append((k, len(data), sum(gone), runs, sha(bytes(x for x, g in zip(data, gone) if not g))))
    r.shuffle(rows)
    df = spark.createDataFrame(rows + [(None, words[0] * 30)], "doc_id long, text string").repartition(7)
    got = suffix_dedup.without_repeats(df.withColumn("doc", F.lit("x")), length)
    got = got.select("doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)).collect()
    assert sorted(tuple(x) for x in got if x[0] is not None) == expected
    assert [x[2] for x in got if x[0] is None] == [0]
    assert suffix_dedup.without_repeats(df.limit(0), length).count() == 0


def test_decontaminate(spark, docs):
    rows, df = docs
    items = [(1, rows[20][1][:200]), (2, "long word"), (3, None), (4, "!!"), (None, "b"), (5, rows[30][1][:90]), (5, rows[30][1][:90])]
    windows, pattern = defaultdict(set), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words_of = lambda t: pattern.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    for k, t in items:
        words = words_of(t)
        n = min(13, len(words))
        for i in range(len(words) - n + 1 if words else 0):
            windows[tuple(words[i : i + n])].add(k)
    expected = []
    for k, t in rows:
        words, found = words_of(t), set()
        hit = [False] * len(words)
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if ids := windows.get(tuple(words[i : i + n])):
                    found |= ids
                    hit[i : i + n] = [True] * n
        named = sorted(str(i) for i in found if i is not None)
        expected.append((k, len(words), sum(hit), len(named), sha(",".join(named).encode()), any(hit) and 20 * sum(hit) >= len(words)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for words in (decontaminate.BLOCK_WORDS, 3):
        got = decontaminate.verdicts(decontaminate.contamination(df, benchmark, block_words=words))
        assert by_text(map(tuple, got.collect())) == by_text(expected)
    longest = decontaminate.contamination(df, benchmark).where("doc_id = 5").first()["matches"][0]
    assert (longest["item_id"], longest["length"]) == (2, 2)
    assert decontaminate.contamination(df, benchmark.limit(0)).where("size(items) > 0").count() == 0
    assert decontaminate.contamination(df.limit(0), benchmark).count() == 0


def test_warc(spark):
    rows = [(None, None, None), (1, "u", "é" * 60), (2, "u\n", "é" * 60), (3, "u", "é" * 10), (4, "u", "é" * 10), (None, "u", "é" * 60), (5, "", ""), (1, "u", "é" * 60), (6, "u", "z" * 3_000_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("file", F.lit(1)).repartition(3)
    got = warc.archived(df)
    expected, first = [], True
    for k, _, h in rows:
        again = h == "é" * 60 and not (k == 1 and first)
        first = first and not (k == 1)
        data = (h or "").encode()
        expected.append((k, len(data), sha(data), "revisit" if again else "response", 1 if again else None))
    assert by_text(map(tuple, got.collect())) == by_text(expected)
    assert warc.archived(df.limit(0)).count() == 0


def test_url_filter(spark):
    urls = [None, "", "a://", "http://A.org", "x http://a.ORG/en?q", "http://b.a.org/x/y#z", "http://borg/x", "http://a.org:80/x", "no scheme", "http://a.org/\n/x"]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls * 2)], "page_id long, url string, rule string")
    rules = spark.createDataFrame([("a.org/x", "block"), ("org/", "allow"), ("a.org/en", "allow"), ("a.org/en", "block"), ("org", "block"), (None, "block"), ("/", "block")], "rule string, verdict string")
    names = ["page_id", "host", "path", "rule", "verdict"]
    trie, join = (by_text(map(tuple, url_filter.judge(df, rules, broadcast_chars=n).select(names).collect())) for n in (10**6, 0))
    assert trie == join
    found = {r[0]: r[1:] for r in trie}
    assert found[3] == ("a.org", "", "org", "block") and found[4] == ("a.org", "/en", "a.org/en", "block") and found[5] == ("b.a.org", "/x/y", "a.org/x", "block")
    assert found[0] == ("", "", None, "allow") and found[7][0] == "a.org:80"
    assert url_filter.judge(df.limit(0), rules).count() == 0 and url_filter.judge(df, rules.limit(0)).where("verdict != 'allow'").count() == 0


def test_pipeline(spark, docs, tmp_path):
    rows, df = docs
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    df = df.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(0).cast("long").alias("n_chars"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    state = df
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, state, str(tmp_path)).cache()
        assert after.columns == df.columns
        if name == "language":
            assert by_text(r[:2] for r in after.collect()) == by_text((k, t) for k, t in rows if any(c.isalpha() for c in t or ""))
        if name == "exact":
            kept = exact_dedup.groups(state).where("kept").select("doc_id")
            assert by_text(r[:1] for r in after.collect()) == by_text(map(tuple, kept.collect()))
        state = after
    out = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(out) == {r["doc_id"] for r in state.collect()} and all(n > 0 for n in out.values())


def test_ids_are_packed_by_one_look_up_each(spark):
    codec, ids = byte_bpe.public_codec(), [0, 255, 256, 10, 49_000]
    packed = spark.createDataFrame([(ids,), ([],), (None,)], "ids array<int>").select(codec.packed(F.col("ids")).alias("x"))
    assert [None if r.x is None else bytes(r.x) for r in packed.collect()] == [np.array(ids, "<u4").tobytes(), b"", None]
    assert "char(" not in packed._jdf.queryExecution().optimizedPlan().toString()
