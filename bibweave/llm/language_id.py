"""Language identification by unigrams over word pieces, summed over every way to cut a word.

The vocabulary is fixed and public: the pieces of a sentencepiece model, in lower case. Training counts, for each language, how
often each piece stands anywhere in the words of the labelled texts; smoothed, the counts are the piece probabilities. A text's
probability is the product over its words, a word's the sum over all its segmentations into pieces (forward algorithm; a
character that is no piece counts as one unknown piece). All languages are equally likely before; the score is the posterior.

A text that is null or has no letter is ``und`` with score 0, as is every text if nothing was learned. Labels that are null are
not learned from; of languages that tie the first in alphabetical order is taken. Rows that repeat are judged each; columns besides
the ones named play no part. A model has at most ``MOST_LANGUAGES`` languages; a table with more labels raises, as its labels
are no languages. A text takes some 50 bytes of memory for each of its characters while its words are scored, a word of n
characters n steps.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bibweave.llm.shared import Ranges, chosen

#: The weight added to each count, and how many languages a model may have.
SMOOTHING, MOST_LANGUAGES = 0.1, 500
START = "▁"
#: Distinct words whose scores a task remembers (when full the table starts anew), and words that are scored at once.
REMEMBERED, TAKE = 200_000, 8_192
#: Characters up to which every place of a text is looked up; longer pieces only where one of them begins with these.
SHORT = 6


class Pieces:
    """A fixed vocabulary; finds all pieces in many words at once."""

    def __init__(self, pieces: list[str]):
        self.pieces = sorted({p for p in pieces if p})
        self.unknown, self.longest = len(self.pieces), max(map(len, self.pieces), default=1)
        self.tables = []
        for k in range(1, self.longest + 1):
            ids = np.array([i for i, p in enumerate(self.pieces) if len(p) == k], np.int32)
            h = self._hashes([self.pieces[i] for i in ids], k)
            order = np.argsort(h)
            self.tables.append((h[order], ids[order]))
        self.beginnings = np.unique(self._hashes([p[:SHORT] for p in self.pieces if len(p) > SHORT], SHORT))

    @staticmethod
    def _hashes(pieces: list[str], k: int) -> np.ndarray:
        at = np.arange(len(pieces)) * k
        return Ranges(np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)).of(at, at + k)

    @classmethod
    def of_model(cls, path: str) -> Pieces:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        return cls([model.id_to_piece(i).lower() for i in normal])

    def found(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[tuple[np.ndarray, np.ndarray]]]:
        """Offsets and lengths of the words (with their start mark) and, per piece length k, the pieces.

        Up to ``SHORT`` characters that is the piece at each place (or -1), beyond that the places that have one, and the pieces.
        """
        text = START + START.join(words)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        lengths = np.array([len(w) + 1 for w in words])
        offsets = np.cumsum(lengths) - lengths
        ends = np.repeat(offsets + lengths, lengths)
        ranges, place, long, at = Ranges(codes), [], [], np.arange(len(codes))
        for k, (hashes, ids) in enumerate(self.tables, 1):
            if k > SHORT:  # ``inside`` has the places of the length before, which begin as some long piece does
                inside = inside[inside + k <= ends[inside]]
                h = ranges.of(inside, inside + k)
                hit = np.minimum(np.searchsorted(hashes, h), max(len(hashes) - 1, 0))
                some = np.flatnonzero(hashes[hit] == h) if len(hashes) else np.zeros(0, np.int64)
                long.append((inside[some], ids[hit[some]] if len(hashes) else np.zeros(0, np.int32)))
                continue
            out = np.full(len(codes), -1, np.int32)
            inside = at[at + k <= ends]
            if len(hashes) and len(inside):
                h = ranges.of(inside, inside + k)
                hit = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                out[inside] = np.where(hashes[hit] == h, ids[hit], -1)
            if k == 1:
                out[out < 0] = self.unknown
            place.append(out)
            if k == SHORT and len(self.beginnings) and len(inside):
                h = ranges.of(inside, inside + k)
                inside = inside[self.beginnings[np.minimum(np.searchsorted(self.beginnings, h), len(self.beginnings) - 1)] == h]
        return offsets, lengths, place, long

    def counts(self, words: list[str], weights: np.ndarray) -> np.ndarray:
        """How often each piece, and last the unknown one, stands in the words, each taken ``weights`` times."""
        total = np.zeros(self.unknown + 1)
        _, lengths, place, long = self.found(words)
        each = np.repeat(weights, lengths)
        for ids in place:
            known = ids >= 0
            total += np.bincount(ids[known], each[known], minlength=len(total))
        for at, ids in long:
            total += np.bincount(ids, each[at], minlength=len(total))
        return total

    def scores(self, words: list[str], probability: np.ndarray) -> np.ndarray:
        """Log-probabilities, one row per word and one column per language. ``probability``: a row per piece."""
        parts = [self._scores(words[at : at + TAKE], probability) for at in range(0, len(words), TAKE)]
        return np.concatenate([np.zeros((0, probability.shape[1])), *parts])

    def _scores(self, words: list[str], probability: np.ndarray) -> np.ndarray:
        offsets, lengths, place, long = self.found(words)
        factor, ring = 32.0, self.longest + 1  # a factor per character, so that no word of usual length comes near the smallest number
        order = np.argsort(-lengths, kind="stable")
        offsets, lengths = offsets[order], lengths[order]
        # the long pieces by the place in the word that they end at: rows of ``ahead``, lengths and pieces
        starts, pieces = (np.concatenate([x[i] for x in long] + [np.zeros(0, np.int64)]).astype(np.int64) for i in (0, 1))
        sizes = np.repeat(np.arange(SHORT + 1, SHORT + 1 + len(long)), [len(x[0]) for x in long])
        by_offset = np.argsort(offsets)
        rows = by_offset[np.searchsorted(offsets[by_offset], starts, side="right") - 1]
        ends = starts - offsets[rows] + sizes
        grouped = np.argsort(ends, kind="stable")
        rows, sizes, pieces = rows[grouped], sizes[grouped], pieces[grouped]
        cuts = np.searchsorted(ends[grouped], np.arange(int(lengths.max(initial=0)) + 2))
        ahead = np.zeros((ring, len(words), probability.shape[1]))  # a ring of the last places
        ahead[0], logs, out = 1.0, *np.zeros((2, len(words), probability.shape[1]))
        for p in range(1, int(lengths.max(initial=0)) + 1):
            active = int(np.searchsorted(-lengths, -p, side="right"))
            now = np.zeros((active, probability.shape[1]))
            for k in range(1, min(len(place), p) + 1):
                ids = place[k - 1][offsets[:active] + (p - k)]
                some = np.flatnonzero(ids >= 0)
                now[some] += ahead[(p - k) % ring, some] * probability[ids[some]] * factor**k
            if (at := slice(cuts[p], cuts[p + 1])).start < at.stop:
                k = sizes[at]
                np.add.at(now, rows[at], ahead[(p - k) % ring, rows[at]] * probability[pieces[at]] * (factor**k)[:, None])
            ahead[p % ring, :active] = now
            if p % 16 == 0:
                ahead[:, :active] /= now
                logs[:active] += np.log(now)
                now = now / now
            done = np.flatnonzero(lengths[:active] == p)
            out[order[done]] = np.log(now[done]) + logs[done] - p * np.log(factor)
        return out


def _words(text: str) -> list[str]:
    return text.lower().split()


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def train(labelled: DataFrame, pieces: Pieces, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in alphabetical order and the piece probabilities, a row per piece. Reads every labelled row."""
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    shared = labelled.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, total = {}, {}

        def settle() -> None:
            for lang, count in words.items():
                if count:
                    total[lang] = total.get(lang, 0) + shared.value.counts(list(count), np.fromiter(count.values(), float))
                    count.clear()

        for batch in batches:
            for t, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                words.setdefault(lang, Counter()).update(_words(t))
                if sum(map(len, words.values())) > REMEMBERED:
                    settle()
        settle()
        for lang, count in total.items():
            ids = np.flatnonzero(count)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(ids)), "piece": pa.array(ids, pa.int32()), "n": pa.array(count[ids].astype(np.int64))})

    counts = rows.mapInArrow(run, "lang string, piece int, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
    langs = sorted(r[0] for r in rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(langs) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: the model would not be small")
    table = counts.toArrow()  # at most languages x (pieces + 1) rows
    matrix = np.full((pieces.unknown + 1, len(langs)), SMOOTHING)
    column = np.searchsorted(langs, table.column("lang").to_pylist()) if langs else []
    np.add.at(matrix, (table.column("piece").to_numpy(), column), table.column("n").to_numpy())
    return langs, matrix / matrix.sum(axis=0)


def judged(text: Column, pieces: Pieces, langs: list[str], probability: np.ndarray, spark: SparkSession) -> Column:
    """struct<lang: string, score: double> of a text. Other columns stay where they are, so rows need no key."""
    shared = spark.sparkContext.broadcast((pieces, langs, probability))

    @F.arrow_udf("struct<lang: string, score: double>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        pieces, langs, probability = shared.value
        known: dict[str, int] = {}
        table = np.zeros((0, len(langs)))
        for texts, letters in batches:
            best, score = [], []
            for at in range(0, len(texts), 64):
                split = [_words(t) if ok else [] for t, ok in zip(texts.slice(at, 64).to_pylist(), letters.slice(at, 64).to_pylist())]
                if len(known) > REMEMBERED:
                    known, table = {}, table[:0]
                new = list({w for ws in split for w in ws}.difference(known))
                known.update(zip(new, range(len(table), len(table) + len(new))))
                if new:
                    table = np.concatenate([table, pieces.scores(new, probability)])
                for ws in split:
                    if not ws or not langs:
                        best.append("und")
                        score.append(0.0)
                        continue
                    sums = table[list(map(known.__getitem__, ws))].sum(axis=0)
                    top = int(sums.argmax())
                    best.append(langs[top])
                    score.append(float(1 / np.exp(sums - sums[top]).sum()))
            yield pa.StructArray.from_arrays([pa.array(best, pa.string()), pa.array(score, pa.float64())], ["lang", "score"])

    return run.asNondeterministic()(text, has_letter(text))  # so that no filter on it judges a text twice


def predict(docs: DataFrame, pieces: Pieces, langs: list[str], probability: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred, score. Reads the text only; the id is carried along."""
    rows = chosen(docs, key, text)
    found = rows.select("doc_id", judged(F.col("text"), pieces, langs, probability, docs.sparkSession).alias("p"))
    return found.select("doc_id", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
