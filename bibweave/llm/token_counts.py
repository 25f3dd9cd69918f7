"""Token counts of whole texts; huge documents are encoded in overlapping chunks that are spliced where they provably agree.

A boundary is stable if a blank, tab, line feed or the like stands before it and something else behind it, and a token of both
chunks starts there: the tokenizer drops white space before it merges, composes no character with a blank, and no added token
holds one, so what stands behind such a place is encoded alike whatever stands before. If two chunks share no stable boundary
their overlap is widened, fourfold each time; if it has grown to the whole chunk, the chunk is made longer instead. So a text
without any white space ends as one chunk.

A null or empty text has no tokens. Rows that repeat are counted each; input columns named like an output column are replaced.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from bibweave.llm.shared import chosen

#: Characters of a chunk and of the first overlap.
CHUNK, OVERLAP = 32_768, 256
_SPACE = frozenset(" \t\n\r\x0b\x0c")


class Counter:
    """Counts with the tokenizers library; one per worker process and file."""

    #: Words in the younger of two tables per worker; when it is full it becomes the older one, and what is still in use moves over.
    LIMIT = 500_000
    _open: dict[str, Counter] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[bytes, int] = {}
        self.older: dict[bytes, int] = {}

    @classmethod
    def named(cls, path: str) -> Counter:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _starts(self, text: str, begin: int) -> list[int]:
        return [begin + a for a, _ in self.tokenizer.encode(text, add_special_tokens=False).offsets]

    def spliced(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        total, settled, begin, end = 0, 0, 0, chunk
        starts = self._starts(text[:end], 0)
        while end < len(text):
            width = overlap
            while True:
                width = min(width, end - settled)
                after = self._starts(text[end - width : end + chunk], end - width)
                common = [o for o in set(starts).intersection(after) if settled < o < end and text[o - 1] in _SPACE and text[o] not in _SPACE]
                if common:
                    break
                if width == end - settled:
                    end += max(chunk, end - begin)
                    starts, width = self._starts(text[begin:end], begin), overlap
                    if end >= len(text):
                        break
                else:
                    width *= 4
            if end >= len(text):
                break
            cut = max(common)
            total += sum(settled <= o < cut for o in starts)
            settled, begin, end, starts = cut, end - width, end + chunk, after
        return total + sum(o >= settled for o in starts)

    def counts(self, texts: list[str], chunk: int) -> list[int]:
        """Texts within one chunk are sums over their words, each distinct word encoded once; longer ones are spliced."""
        words = [t.encode().split() if len(t) <= chunk else None for t in texts]
        if len(self.known) > self.LIMIT:
            self.known, self.older = {}, self.known
        new = {w for ws in words if ws for w in ws}.difference(self.known)
        self.known.update((w, self.older[w]) for w in new if w in self.older)
        new = list(new.difference(self.known))
        for at in range(0, len(new), 4096):
            some = new[at : at + 4096]
            encoded = self.tokenizer.encode_batch_fast([w.decode() for w in some], add_special_tokens=False)
            self.known.update(zip(some, map(len, encoded)))
        get = self.known.__getitem__
        return [self.spliced(t, chunk) if ws is None else sum(map(get, ws)) for t, ws in zip(texts, words)]


def counts(docs: DataFrame, tokenizer: str, limit: int, key: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter.named(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                got = counter.counts([x or "" for x in part.column("text").to_pylist()], chunk)
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "n_bytes": part.column("n_bytes"), "n_tokens": pa.array(got, pa.int64())})

    rows = chosen(docs, key, text).select("doc_id", "text", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
