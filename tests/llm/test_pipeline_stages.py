"""Stages of the pipeline against plain Python."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from bibweave.llm import byte_bpe, language_id, near_copies, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], SCHEMA).repartition(parts)


def kept(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def shingle_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def without_near_copies(rows):
    sets, root = [shingle_set(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        return i if root[i] == i else find(root[i])

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j])):
                root[find(i)] = find(j)
    first = {}
    for i, (k, _) in enumerate(rows):
        order = (k is None, k or 0)
        if find(i) not in first or order < first[find(i)][0]:
            first[find(i)] = (order, i)
    return sorted((rows[i] for _, i in first.values()), key=str)


def planted(r, copies):
    """Texts, and copies of each with words replaced, from a hundredth to a tenth of them."""
    rows = []
    for size in (3, 5, 12, 40, 150, 600):
        for _ in range(8):
            base = [f"w{r.randrange(3000)}" for _ in range(size)]
            rows.append(" ".join(base))
            for k in range(copies):
                words = list(base)
                for at in r.sample(range(size), min(size, k * size // (10 * copies) // 2)):
                    words[at] = f"x{r.randrange(10**6)}"
                rows.append(" ".join(words) + (f" end{r.randrange(10**6)}" if k % 2 else ""))
    return rows


def test_near(spark):
    r = random.Random(3)
    texts = planted(r, 6)
    # a large group, a line that many share, and words in other case
    base = [f"h{i}" for i in range(200)]
    texts += [" ".join(base[:i] + [f"y{i}"] + base[i + 1 :]) for i in range(0, 200, 4)]
    texts += ["a line that many texts have in front " + " ".join(f"z{r.randrange(10**6)}" for _ in range(r.randint(1, 9))) for _ in range(60)]
    texts += [texts[20].upper(), "Same  words\tagain here now", "same words AGAIN here now"]
    ids = list(range(len(texts)))
    r.shuffle(ids)
    rows = list(zip(ids, texts))
    expected = without_near_copies(rows)
    assert len(expected) < len(rows) - 100
    assert kept(corpus_pipeline.near(spark, frame(spark, rows), "")) == expected
    assert corpus_pipeline.near(spark, frame(spark, rows).limit(0), "").count() == 0
    few = frame(spark, rows[:120])
    assert sorted(near_copies.components(few, set_bits=64).collect()) == sorted(near_copies.components(few).collect())


def test_null_and_repeated_ids(spark, tmp_path):
    r = random.Random(4)
    text = lambda n: " ".join(f"w{r.randrange(10**6)}" for _ in range(n))
    a, b, c, item = text(60), text(60), text(60), text(20)
    near_a, near_c = a + " end", c + " end"
    rows = [(1, a), (None, a), (None, b), (2, b), (2, c), (None, text(50)), (2, text(50)), (2, text(50)), (5, near_a), (None, near_a), (None, near_c), (2, near_c + " x"), (None, item), (7, item + " y"), (7, text(9)), (None, item), (None, None)]
    groups = {}
    for k, t in rows:
        groups[t] = min(groups.get(t, (k is None, k or 0)), (k is None, k or 0))
    expected = sorted(((None if null else k, t) for t, (null, k) in groups.items()), key=str)
    for parts in (1, 4):
        assert kept(corpus_pipeline.exact(spark, frame(spark, rows, parts), "")) == expected
    expected = without_near_copies(expected)
    few = corpus_pipeline.near(spark, frame(spark, sorted(set(rows), key=str)), "")
    assert len(few.collect()) == len(without_near_copies(sorted(set(rows), key=str)))
    assert (None, near_c) not in expected and (None, near_c) not in kept(few)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    expected = sorted(((k, t) for k, t in rows if not (t or "").startswith(item)), key=str)
    assert kept(corpus_pipeline.clean(spark, frame(spark, rows), str(tmp_path))) == expected


class PlainLanguages:
    """Training and prediction piece by piece, over all lengths of the vocabulary."""

    def __init__(self, rows):
        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        normal = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.pieces = {model.id_to_piece(i).lower() for i in normal}
        self.longest = max(map(len, self.pieces))
        words = defaultdict(Counter)
        for text, lang in rows:
            if text is not None and lang is not None:
                words[lang].update(text.lower().split())
        counts = {lang: Counter() for lang in sorted(words)}
        for lang, found in words.items():
            for word, n in found.items():
                for _, _, piece in self.places(word):
                    counts[lang][piece] += n
        self.total = {lang: sum(c.values()) + language_id.SMOOTHING * (len(self.pieces) + 1) for lang, c in counts.items()}
        self.counts, self.known = counts, {}

    def places(self, word):
        word = language_id.START + word
        for start in range(len(word)):
            for end in range(start + 1, min(start + self.longest, len(word)) + 1):
                if word[start:end] in self.pieces or end == start + 1:
                    yield start, end, word[start:end] if word[start:end] in self.pieces else None

    def word(self, word):
        if word not in self.known:
            found, sums = sorted(self.places(word), key=lambda p: p[1]), {}
            for lang, counts in self.counts.items():
                ahead = [1.0] + [0.0] * (len(word) + 1)
                for start, end, piece in found:
                    ahead[end] += ahead[start] * (counts[piece] + language_id.SMOOTHING) / self.total[lang]
                sums[lang] = math.log(ahead[-1])
            self.known[word] = sums
        return self.known[word]

    def predict(self, text):
        if not any(c.isalpha() for c in text or ""):
            return "und", 0.0
        sums = {lang: sum(self.word(w)[lang] for w in text.lower().split()) for lang in self.counts}
        best = max(sorted(sums), key=sums.get)
        return best, 1 / sum(math.exp(s - sums[best]) for s in sums.values())


def test_language_id_by_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = [r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    plain = PlainLanguages([(r["text"], r["lang"]) for r in docs if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2])
    got = {r["doc_id"]: r for r in queries.op7_language_id(spark, folder).collect()}
    assert len(got) == len(docs)
    for r in docs:
        lang, score = plain.predict(r["text"])
        mine = got[r["doc_id"]]
        assert mine["lang_pred"] == lang and mine["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert math.isclose(mine["score"], score, rel_tol=1e-9)


CLASHING = "row number of equal sha found place gone first root members kept _id _of _sha _n _row".split()


def test_clashing_columns_stay(spark, tmp_path):
    rows = [(1, "one two three four five six"), (2, "one two three four five six"), (3, "one two three four five six seven seven seven"), (None, "!!"), (4, None), (5, "")]
    df = frame(spark, rows).select("*", *(F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in CLASHING))
    spark.createDataFrame([(1, "six seven seven seven")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, df, str(tmp_path))
        assert after.columns == df.columns
        for r in after.collect():
            assert all(r[c] == (None if r["doc_id"] is None else f"{c}-{r['doc_id']}") for c in CLASHING), name


def test_language_fills_missing_labels(spark):
    rows = [(i, "the cat and the dog of the house", "en", "s", 0) for i in range(9)] + [(20 + i, "le chat et le chien de la maison", "fr", "s", 0) for i in range(9)]
    rows += [(50, "the dog of the cat", None, "s", 0), (51, "la maison de le chien", None, "s", 0), (52, "123", "en", "s", 0), (None, "le chat", "en", "s", 0)]
    got = corpus_pipeline.language(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), "").collect()
    langs = {r["doc_id"]: r["lang"] for r in got}
    assert len(got) == len(rows) - 1 and langs[50] == "en" and langs[51] == "fr" and 52 not in langs and langs[None] == "en"
    nothing = spark.createDataFrame(rows, SCHEMA).withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language(spark, nothing, "").count() == 0


def test_encode(spark):
    texts = [None, "", "Hello  world\n\nÉté 漢字 " * 3, "x" * 500, "aé\x00\x7f"]
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r for r in corpus_pipeline.encode(spark, frame(spark, list(enumerate(texts))), "").collect()}
    for k, t in enumerate(texts):
        ids = library.encode_ordinary(t or "")
        assert got[k]["n_tokens"] == len(ids) and got[k]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[k]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_near_judges_what_linked_fingerprints_suggest(spark, monkeypatch):
    calls, method = [], corpus_pipeline.simhash.components
    monkeypatch.setattr(corpus_pipeline.simhash, "components", lambda *a, **k: calls.append(a) or method(*a, **k))
    r = random.Random(8)
    rows = list(enumerate(planted(r, 2)))
    assert kept(corpus_pipeline.near(spark, frame(spark, rows), "")) == without_near_copies(rows)
    assert len(calls) == 1
    wrong = spark.createDataFrame([(r.randrange(len(rows)), r.randrange(len(rows))) for _ in range(200)], "a long, b long")
    assert sorted(near_copies.components(frame(spark, rows), suggested=wrong).collect()) == sorted(near_copies.components(frame(spark, rows)).collect())


def test_near_copies_whose_suggested_partner_is_unlike_are_found(spark):
    # the smallest id of a linked component may be like none of the others; no link among those is lost (F3)
    r = random.Random(10)
    other, base = ([f"w{r.randrange(10**6)}" for _ in range(80)] for _ in range(2))
    rows = [(0, " ".join(other)), *((i, " ".join([*base, f"x{i}"])) for i in range(1, 6)), *((i, f"{' '.join(base[:40])} y{i} {' '.join(base[40:])}") for i in range(6, 9))]
    star = spark.createDataFrame([(i, 0) for i in range(1, 6)], "a long, b long")
    assert sorted(map(tuple, near_copies.components(frame(spark, rows), suggested=star).collect())) == [(i, 1) for i in range(2, 9)]


def test_sketches_differ_in_no_more_bits_than_the_sets(spark):
    r = random.Random(9)
    base = [r.randrange(1 << 64) for _ in range(300)]
    sets = [set(base[: r.randint(1, 300)]) | {r.randrange(1 << 64) for _ in range(r.randint(0, 40))} for _ in range(40)]
    number = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    rows = near_copies._sketches(np.array([h for s in sets for h in s], np.uint64), number, len(sets)).view(np.uint64).tolist()
    for a, x in zip(sets, rows):
        for b, y in zip(sets, rows):
            assert sum((i ^ j).bit_count() for i, j in zip(x, y)) <= len(a ^ b)
