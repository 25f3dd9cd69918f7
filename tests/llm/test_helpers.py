"""The parts without Spark against plain versions."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from bibweave.llm import byte_bpe, exact_dedup, language_id, simhash, suffix_dedup, url_filter, warc
from bibweave.llm.token_counts import Counter
from bibweave.llm.wavelet_tokens import WaveletMatrix
from bibweave.llm.word_cache import WordCache

ALPHABET = [" ", "  ", "\n", "\n\n", " \n", "a", "bc", "É", "ñ", "1", "23", ".", ",", "'s", "'", "!?", "\u00a0", "\x1c", "<|endoftext|>", "<|startoftext|>", "漢字", "\u0301", "\t", "\r\n", "İ", "Σ", "ﬁ", "ab."]


def texts(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 40))) for _ in range(n)]


def test_word_cache_gives_the_library_ids():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, cache = Tokenizer.from_file(path), WordCache(path)
    some = texts(3000)
    assert cache.encode(some) == [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(some, add_special_tokens=False)]
    cache.LIMIT = 10  # the tables turn over
    for at in range(0, 300, 30):
        part = some[at : at + 30]
        assert cache.encode(part) == [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(part, add_special_tokens=False)]


@pytest.mark.parametrize("chunk,overlap", [(10**9, 1), (64, 8), (20, 3)])
def test_counts_and_splices_give_the_library_number(chunk, overlap):
    path = public_tokenizers.path("word_bpe_49k.json")
    library, counter = Tokenizer.from_file(path), Counter(path)
    some = [*texts(1500, 2), "x" * 5000, "漢" * 900 + " b"]
    expected = [len(e.ids) for e in library.encode_batch(some, add_special_tokens=False)]
    assert counter.counts(some, chunk) == expected
    assert [counter.spliced(t, chunk, overlap) for t in some] == expected


def test_wavelet_matrix_round_trip_rank_and_select():
    r = random.Random(1)
    for ids in (np.array(r.choices(range(70_000), k=3000), np.uint32), np.zeros(5, np.uint32), np.zeros(0, np.uint32)):
        matrix, doc_ids, lengths = WaveletMatrix.from_bytes(WaveletMatrix.of(ids).to_bytes([None, 3], [0, len(ids)]))
        assert doc_ids == [None, 3] and lengths.tolist() == [0, len(ids)]
        assert len(ids) == 0 or (matrix.all() == ids).all()
        for i in range(0, len(ids), 37):
            token = int(ids[i])
            assert matrix.access(i) == token and matrix.count(token, i) == int((ids[:i] == token).sum())
            assert matrix.find(token, matrix.count(token, i)) == i
        assert matrix.find(69_999, 10**6) is None and matrix.count(1 << 30) == 0


def test_golomb_round_trip():
    r = random.Random(2)
    for n in (0, 1, 2, 500):
        values = np.unique(np.array([r.randrange(1 << 58) for _ in range(n)], np.uint64))
        assert (exact_dedup.golomb_decode(exact_dedup.golomb_encode(values, 1 << 58)) == values).all()


def test_bk_tree_finds_all_within_the_radius():
    r = random.Random(3)
    values = [r.getrandbits(64) for _ in range(50)]
    values += [v ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for v in values] + [0]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for v in values:
        assert sorted(tree.within(v, 3)) == sorted(w for w in values if (v ^ w).bit_count() <= 3)


@pytest.mark.parametrize("length", [3, 10, 100])
def test_collection_transform_finds_equal_strings(length, tmp_path):
    r = random.Random(length)
    for _ in range(25):
        strings = [bytes(r.choice(b"ab\x00\xf4"[: r.choice((1, 2, 4))]) for _ in range(r.randint(length, length + 12))) for _ in range(r.randint(1, 12))]
        got, expected = defaultdict(set), defaultdict(set)
        for c, s, p in zip(*(x.tolist() for x in suffix_dedup.equal_strings(strings, length))):
            got[c].add((s, p))
        for i, s in enumerate(strings):
            for j in range(len(s) - length + 1):
                expected[s[j : j + length]].add((i, j))
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_forward_algorithm_sums_all_segmentations():
    pieces = language_id.Pieces(["▁", "▁a", "a", "b", "ab", "ba", "▁ab", "ababababa", "babababab", "▁abababab", "abababab"])
    probability = np.random.default_rng(1).random((pieces.unknown + 1, 2))
    index = {p: i for i, p in enumerate(pieces.pieces)}

    def total(word, column):
        if not word:
            return 1.0
        out = 0.0
        for k in range(1, min(pieces.longest, len(word)) + 1):
            if word[:k] in index:
                out += probability[index[word[:k]], column] * total(word[k:], column)
            elif k == 1:
                out += probability[-1, column] * total(word[1:], column)
        return out

    words = ["ab", "abba", "a", "xyz", "aé", "abababababab", "xabababababab"]
    assert np.allclose(pieces.scores(words, probability), [[np.log(total("▁" + w, c)) for c in (0, 1)] for w in words])
    assert np.isfinite(pieces.scores(["ab" * 3000], probability)).all()


def test_trie_precedence():
    trie = url_filter.Trie([("org/", "allow"), ("a.org/x", "block"), ("a.org/x/y", "allow"), ("a.org/x", "allow"), ("", "block")])
    assert trie.best("www.a.org", "/xyz") == ("a.org/x", "block")  # block wins a tie
    assert trie.best("a.org", "/x/yes") == ("a.org/x/y", "allow")
    assert trie.best("b.org", "/") == ("org/", "allow") and trie.best("b.org", "") == (None, None)
    assert trie.best("borg", "/") == (None, None) and trie.best("", "/q") == ("", "block")


def test_records_of_a_stream_of_members():
    import gzip
    import io

    one = warc.response("f", 0, 1, "http://a/\r\n", b"x" * 300_000, "2024-01-01T00:00:00Z")
    two = warc.response("f", 1, None, None, b"", "2024-01-01T00:00:00Z")
    stream = io.BytesIO(gzip.compress(one + two) + gzip.compress(two))
    got = list(warc.records(warc.inflated(stream, 1000)))
    assert [len(block.partition(b"\r\n\r\n")[2]) for _, block in got] == [300_000, 0, 0]
    assert warc.read_record(gzip.compress(one))["url"] == "http://a/%0D%0A"
    with pytest.raises(ValueError):
        list(warc.records(iter([one[:-10]])))


def test_pair_table_leads_every_pair_to_its_rank():
    pieces = [bytes([b]) for b in range(256)] + [b"ab", b"bc", b"abc", b"cc", b"abcc"]
    ranks = {p: i for i, p in enumerate(pieces)}
    salt, shifts, cells = byte_bpe.pair_table(ranks)

    def looked_up(a, b):
        key = a << byte_bpe.BITS | b
        h = xxhash.xxh64_intdigest((key ^ salt).to_bytes(8, "little"), 42)
        cell = cells[(h >> 32 ^ shifts[h & (len(shifts) - 1)]) & (len(cells) - 1)]
        return cell & byte_bpe.NONE if cell >> byte_bpe.BITS == key else None

    for x, a in ranks.items():
        for y, b in ranks.items():
            assert looked_up(a, b) == ranks.get(x + y)
    assert byte_bpe.merged_pieces(b"abccab", ranks) == [b"abcc", b"ab"]


def test_codec_refuses_pieces_that_no_merge_gives():
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256}
    with pytest.raises(ValueError, match="own bytes"):
        byte_bpe.Codec(ranks, r"\S+")
    with pytest.raises(ValueError, match="without a rank"):
        byte_bpe.rank_literal({b"a": 0})


def test_a_stream_that_is_cut_off_is_an_error():
    import gzip
    import io

    whole = gzip.compress(b"a" * 5000) + gzip.compress(b"b" * 10)
    assert b"".join(warc.inflated(io.BytesIO(whole))) == b"a" * 5000 + b"b" * 10
    assert b"".join(warc.inflated(io.BytesIO(b""))) == b""
    for cut in (1, 8, 20, len(gzip.compress(b"b" * 10)) + 3):  # within the trailer, the data and the first member
        with pytest.raises((EOFError, zlib.error)):
            list(warc.inflated(io.BytesIO(whole[:-cut])))


class Looked(dict):
    """Counts what is asked of it."""

    asked = 0

    def get(self, key, default=None):
        self.asked += 1
        return super().get(key, default)

    def __contains__(self, key):
        self.asked += 1
        return super().__contains__(key)

    def __getitem__(self, key):
        self.asked += 1
        return super().__getitem__(key)


def test_word_cache_looks_up_a_known_piece_once():
    cache = WordCache(public_tokenizers.path("byte_bpe_50k.json"))
    before = cache.encode(["ab cd ef gh"] * 50)
    cache.known = Looked(cache.known)
    assert cache.encode(["ab cd ef gh"] * 50) == before
    assert cache.known.asked == 200
