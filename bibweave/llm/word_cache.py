"""Whole texts through a byte-level BPE tokenizer of the tokenizers library, each distinct piece encoded once per worker.

The pre-tokenizer starts a token at a blank that a non-blank follows, and at both sides of a single line feed between
non-blanks; a full stop or comma at a piece's end is a token of its own after a letter. Cutting there cannot change the ids
(the tests compare with the library on whole texts), so pieces are looked up and only new ones are given to the library. Those
without white space go there many at a time, as one text: its tokens that begin with a blank are where the pieces begin.
"""

from __future__ import annotations

import os
import re

import numpy as np
from tokenizers import Tokenizer

_LINES = re.compile(r"\n(?<=\S\n)(?=\S)")  # a line feed first: it is searched for as such
_BLANKS = re.compile(r" (?=\S)")
_UNSURE = re.compile(r" \s| \Z")
_SPACE = re.compile(r"\s")
#: A blank at the begin of a token, as byte-level vocabularies write it (fixed value).
BLANK = "Ġ"


class WordCache:
    #: Pieces in the younger of two tables per worker; when it is full it becomes the older one, and what is still in use moves over.
    LIMIT = 1_000_000
    #: What stands for the line feed between two lines; no piece is empty.
    BETWEEN = ""
    #: Pieces given to the library as one text.
    TOGETHER = 4096
    _open: dict[str, WordCache] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.blank = np.zeros(max(vocabulary.values()) + 1, bool)
        self.blank[[i for token, i in vocabulary.items() if token.startswith(BLANK)]] = True
        self.newline, self.marks = self._library(["\n"])[0], dict(zip(".,", self._library([".", ","])))
        self.known: dict[str, bytes] = {self.BETWEEN: self.newline}
        self.older: dict[str, bytes] = {}

    @classmethod
    def named(cls, path: str) -> WordCache:
        """One table per worker process and tokenizer; a worker serves many tasks."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, words: list[str]) -> list[bytes]:
        """The ids of words that each follow a blank and hold no white space; one by one where the parts of the whole don't tell."""
        ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        begins = np.flatnonzero(self.blank[ids])
        if len(begins) != len(words) or begins[0] != 0:
            return self._library([" " + w for w in words])
        cuts, data = [*(begins * 4).tolist(), len(ids) * 4], ids.tobytes()
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    def _learn(self, new: set[str]) -> None:
        """Puts the ids of pieces that the younger table lacks into it."""
        new, known = new - self._moved(new), self.known
        ended = [p for p in new if p[-1] in ".," and p[-2:-1].isalpha()]
        bases = {p[:-1] for p in ended}.difference(known)
        bases = sorted((bases - self._moved(bases)) | new.difference(ended))
        plain, other = [p for p in bases if p[:1] != "\n"], [p for p in bases if p[:1] == "\n"]
        if len(_SPACE.findall(" ".join(plain))) != max(len(plain) - 1, 0):
            plain, other = [p for p in plain if not _SPACE.search(p)], [p for p in bases if _SPACE.search(p)]
        for at in range(0, len(plain), self.TOGETHER):
            some = plain[at : at + self.TOGETHER]
            known.update(zip(some, self._together(some)))
        for at in range(0, len(other), self.TOGETHER):
            some = other[at : at + self.TOGETHER]
            known.update(zip(some, self._library([p[1:] if p[0] == "\n" else " " + p for p in some])))
        for p in ended:
            known[p] = known[p[:-1]] + self.marks[p[-1]]

    def _moved(self, pieces: set[str]) -> set[str]:
        """Those of the pieces that stood in the older table only, and now in the younger one."""
        found = {p for p in pieces if p in self.older} if self.older else set()
        self.known.update((p, self.older[p]) for p in found)
        return found

    @staticmethod
    def pieces(line: str) -> list[str]:
        """The line cut before each blank that a non-blank follows. A piece that begins with a line feed stands at the begin of the
        line, which it stands for; before each other piece, which begins with a non-blank, there was the blank."""
        parts = _BLANKS.split(line) if _UNSURE.search(line) else line.split(" ")
        parts[0] = "\n" + parts[0]
        return parts

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.known) > self.LIMIT:
            self.known, self.older = {self.BETWEEN: self.newline}, self.known
        pieces, ends = [], []
        for t in texts:
            for line in _LINES.split(t):
                pieces += self.pieces(line)
                pieces.append(self.BETWEEN)
            pieces.pop()
            ends.append(len(pieces))
        ids = list(map(self.known.get, pieces))
        new = [i for i, x in enumerate(ids) if x is None]
        self._learn({pieces[i] for i in new})
        for i in new:
            ids[i] = self.known[pieces[i]]
        return [b"".join(ids[a:b]) for a, b in zip([0, *ends], ends)]
