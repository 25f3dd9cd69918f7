"""Removal of repeated byte strings with a collection Burrows-Wheeler transform built column by column.

Byte ``x`` of a document goes if it lies in a string of ``length`` bytes that also starts earlier: in a document of smaller id,
or before in the same one. Overlaps count, and everything is judged on the input. Strings never cross documents.

1. Every string of ``length`` bytes has a minimiser, the smallest hash of its ``gram``-byte substrings. Maximal runs of
   neighbouring strings with one minimiser (``most`` strings at most) are one segment, so equal strings lie in segments of equal
   minimiser. Tasks count minimisers; owners mark those met more than once in a bit set of fixed size, which is broadcast. What
   it lets through by accident costs work only. Minimisers of more than ``heavy`` segments are told apart.
2. Segments with a marked minimiser go to the owner of the minimiser. Of segments with equal bytes in one task only the first
   goes; the later ones are repeats whatever comes, and their extent is sent to the owner of the document instead. Segments of a
   heavy minimiser are cut to their single strings, which go by their own hashes: equal ones still meet, and no owner gets all.
3. An owner merges equal segments (all but the first are repeats), narrows the others to the parts whose strings occur again
   by their hashes, merges equal parts, and sorts the parts that still differ as a collection: each round puts one more symbol
   of every part, from the last to the first, into the collection's Burrows-Wheeler transform, and updates the common prefixes
   of neighbours. A collection is bounded to about ``collection`` bytes and held in memory; a file carries its rows from one
   round to the next and is read whole. Neighbours that share ``length`` symbols hold equal strings; of each such class the earliest stays.
4. Extents are merged per document and cut from its bytes.

The symbols go in column by column as for short reads; whole documents would need as many rounds as the longest has bytes, each
over the whole collection, so the collection holds segments of at most ``length + most - 1`` bytes instead of documents.

A null text is empty. A row with a null id has no place in the order: it is neither compared nor cut. Rows that repeat an id and
text are one document, and each is cut alike; those that repeat an id with other texts are documents of their own, ordered by the
SHA-256 of the text. No rows: no rows.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from bibweave.llm.shared import Ranges, chosen, mixed
from bibweave.session import cut_lineage

#: Bits of the broadcast set of repeated minimisers; fixed, whatever the input.
SET_BITS = 1 << 27
#: Strings in a segment, bytes of the hashed substrings, bytes of text taken at once, and bytes of a sorted collection.
MOST, GRAM, TAKE, COLLECTION = 64, 48, 2_000_000, 4_000_000
#: Segments with one minimiser that may go to one owner; at most some 2.7 MB.
HEAVY = 16_384


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def segments(data: np.ndarray, sizes: np.ndarray, length: int, gram: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Minimiser, first string and number of strings of each segment in a run of documents (``sizes`` bytes each); the hashes."""
    if len(data) < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ends = np.cumsum(sizes)
    hashes = Ranges(data).windows(gram)
    smallest = _sliding_min(hashes, length - gram + 1)
    inside = np.ones(len(smallest) + 1, bool)  # strings that cross the end of a document are none
    for back in range(1, length):
        cross = ends - back
        inside[cross[(cross >= 0) & (cross < len(smallest))]] = False
    inside = inside[:-1]
    for end in np.flatnonzero(sizes < length):  # a short document: none of its places starts a string
        inside[max(0, ends[end] - sizes[end]) : ends[end]] = False
    new = np.ones(len(smallest), bool)
    new[1:] = (smallest[1:] != smallest[:-1]) | ~inside[:-1]
    starts = np.flatnonzero(new & inside)
    stop = np.flatnonzero(np.append(new, True) | np.append(~inside, True))
    counts = stop[np.searchsorted(stop, starts, side="right")] - starts
    pieces = -(-counts // most)
    rank = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = np.repeat(starts, pieces) + rank * most
    return np.repeat(smallest[starts], pieces), begin, np.minimum(most, np.repeat(starts + counts, pieces) - begin), hashes


def _met_within(key: np.ndarray, begin: np.ndarray, n: np.ndarray, hashes: np.ndarray, span: int) -> np.ndarray:
    """Which segments hold their minimiser twice, so that a string may stand twice in one of them. ``span``: grams in a string."""
    size = n + span - 1
    offset = np.cumsum(size) - size
    at = np.repeat(begin - offset, size) + np.arange(size.sum())
    return np.add.reduceat(hashes[at] == np.repeat(key, size), offset, dtype=np.int32) > 1 if len(key) else np.zeros(0, bool)


def _taken(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Order numbers, bytes and sizes of a bounded run of whole documents."""
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data, order = np.frombuffer(texts.buffers()[2] or b"", np.uint8), batch.column("doc").to_numpy(zero_copy_only=False)
        a = 0
        while a < len(order):
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + TAKE, side="right")) - 1)
            yield order[a:b], data[offsets[a] : offsets[b]], np.diff(offsets[a : b + 1])
            a = b


def _met(owners: int, bits: int, length: int, gram: int, most: int):
    """Per owner of a range of slots the distinct slots of a run, sorted, whether the run met one twice, and how often then."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, sizes in _taken(batches):
            key, begin, n, hashes = segments(data, sizes, length, gram, most)
            slots, place, count = np.unique((key % np.uint64(bits)).astype(np.int64), return_inverse=True, return_counts=True)
            repeats = np.zeros(len(slots), bool)
            repeats[place[_met_within(key, begin, n, hashes, length - gram + 1)]] = True
            owner = slots * owners // bits
            cuts = np.searchsorted(owner, np.arange(owners + 1))
            for o in range(owners):
                if cuts[o] < cuts[o + 1]:
                    part = slots[cuts[o] : cuts[o + 1]]
                    gaps = np.diff(part, prepend=-(-o * bits // owners)).astype("<u4")
                    number = count[cuts[o] : cuts[o + 1]]
                    twice = (number > 1) | repeats[cuts[o] : cuts[o + 1]]
                    yield pa.RecordBatch.from_pydict({"owner": pa.array([o], pa.int32()), "gaps": [gaps.view(np.uint8).reshape(-1, 4).T.tobytes()], "twice": [np.packbits(twice).tobytes()], "numbers": [number[twice].astype("<u4").tobytes()]})

    return run


def _marked(owners: int, bits: int, heavy: int):
    """The slots of an owner met more than once, as bits, and those of more than ``heavy`` segments, as numbers."""

    def run(key: tuple[pa.Scalar, ...], groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        o = int(key[0].as_py())
        base, end = -(-o * bits // owners), -(-(o + 1) * bits // owners)
        seen, again = np.zeros(end - base, np.uint32), np.zeros(end - base, bool)
        for batch in groups:
            for gaps, twice, numbers in zip(*(batch.column(c).to_pylist() for c in ("gaps", "twice", "numbers"))):
                slots = np.cumsum(np.ascontiguousarray(np.frombuffer(gaps, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64))
                twice = np.unpackbits(np.frombuffer(twice, np.uint8), count=len(slots)).view(bool)
                again[slots] |= (seen[slots] > 0) | twice
                number = np.ones(len(slots), np.uint32)
                number[twice] = np.frombuffer(numbers, "<u4")
                seen[slots] = np.minimum(seen[slots].astype(np.uint64) + number, np.uint64(0xFFFFFFFF))
        many = base + np.flatnonzero(seen > heavy)
        yield pa.RecordBatch.from_pydict({"base": pa.array([base], pa.int64()), "size": pa.array([end - base], pa.int64()), "marks": [np.packbits(again).tobytes()], "heavy": [many.astype("<i8").tobytes()]})

    return run


#: Bytes of segments that a task gathers before it packs them by owner.
PACK = 16_000_000


def _packed(owner: int, kind: bool, *columns: np.ndarray, tail: bytes = b"") -> pa.RecordBatch:
    body = b"".join([np.array([len(columns[0])], "<u4").tobytes(), *(c.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns), tail])
    return pa.RecordBatch.from_pydict({"owner": pa.array([owner], pa.int32()), "kind": [kind], "body": [zstandard.ZstdCompressor(level=3).compress(body)]})


def _unpacked(body: bytes, columns: int) -> tuple[list[np.ndarray], bytes]:
    body = zstandard.ZstdDecompressor().decompress(body)
    n = int(np.frombuffer(body, "<u4", 1)[0])
    cut = lambda i: np.ascontiguousarray(np.frombuffer(body, np.uint8, 8 * n, 4 + 8 * n * i).reshape(8, n).T).view("<i8").ravel()
    return [cut(i) for i in range(columns)], body[4 + 8 * n * columns :]


def _parted(parts: list[bytes], doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of equal parts the earliest in the order of documents goes, those at other places stay; one met again at its place does neither."""
    go, stay, first = [], [], {}
    for i in np.lexsort((start, doc)).tolist():
        j = first.setdefault(parts[i], i)
        if j == i:
            go.append(i)
        elif doc[i] != doc[j] or start[i] != start[j]:
            stay.append(i)
    return np.sort(np.array(go, np.int64)), np.sort(np.array(stay, np.int64))


def _sent(marks, owners: int, length: int, gram: int, most: int):
    """Marked segments, the first of equal ones in the run, with their bytes; the extents of the others, merged. Packed by owner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (table, heavy), held, strings, size = marks.value, [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            key, doc, start, n = (np.concatenate(x) for x in zip(*held))
            owner = (mixed(key) % np.uint64(owners)).astype(np.int64)
            order = np.argsort(owner, kind="stable")
            cuts = np.flatnonzero(np.diff(owner[order], prepend=-1, append=owners))
            for a, b in zip(cuts[:-1], cuts[1:]):
                part = order[a:b]
                yield _packed(int(owner[part[0]]), True, (key[part] >> np.uint64(40)).astype(np.int64), doc[part], start[part], n[part], tail=b"".join([strings[i] for i in part.tolist()]))

        for order, data, sizes in _taken(batches):
            key, begin, n, _ = segments(data, sizes, length, gram, most)
            slot = (key % np.uint64(len(table) * 8)).astype(np.int64)
            hit = np.flatnonzero(table[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & np.uint8(1))
            if not len(hit):
                continue
            key, begin, n, slot = key[hit], begin[hit], n[hit], slot[hit]
            ends = np.cumsum(sizes)
            doc = np.searchsorted(ends, begin, side="right")
            start = begin - (ends - sizes)[doc]
            raw = data.tobytes()
            parts = [raw[b : b + k + length - 1] for b, k in zip(begin.tolist(), n.tolist())]
            go, stay = _parted(parts, order[doc], start)
            large = np.isin(slot[go], heavy)
            if large.any():
                whole, go, light = go[large], go[~large], len(key)
                place = np.arange(n[whole].sum()) - np.repeat(np.cumsum(n[whole]) - n[whole], n[whole])
                at = np.repeat(begin[whole], n[whole]) + place
                key, n = np.append(key, Ranges(data).windows(length)[at]), np.append(n, np.ones(len(at), np.int64))
                doc, start = np.append(doc, np.repeat(doc[whole], n[whole])), np.append(start, np.repeat(start[whole], n[whole]) + place)
                single = [raw[a : a + length] for a in at.tolist()]
                parts += single
                first, later = _parted(single, order[doc[light:]], start[light:])
                go, stay = np.append(go, light + first), np.append(stay, light + later)
            held.append((key[go], order[doc[go]], start[go], n[go]))
            strings += [parts[i] for i in go.tolist()]
            size += int(n[go].sum()) + len(go) * (length - 1)
            if len(stay):
                heads, end = joined(doc[stay], start[stay], start[stay] + n[stay] + length - 1)
                owner = (mixed(order[heads[:, 0]].astype(np.uint64)) % np.uint64(owners)).astype(np.int64)
                for o in np.unique(owner):
                    some = owner == o
                    yield _packed(int(o), False, order[heads[some, 0]], heads[some, 1], end[some])
            if size >= PACK:
                yield from flush()
                held, strings, size = [], [], 0
        if held:
            yield from flush()

    return run


def joined(doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unions of extents that touch, per document: (document, begin) rows and ends."""
    order = np.lexsort((begin, doc))
    doc, begin, end = doc[order], begin[order], end[order]
    reach = end.copy()
    first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    shift = np.zeros(len(doc), np.int64)  # apart by document, so that one running maximum serves all
    shift[first] = 1
    shift = np.cumsum(shift) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + shift) - shift
    new = np.append(True, (doc[1:] != doc[:-1]) | (begin[1:] > reach[:-1]))
    heads = np.flatnonzero(new)
    return np.stack([doc[heads], begin[heads]], axis=1), reach[np.append(heads[1:], len(doc)) - 1]


class Collection:
    """Burrows-Wheeler transform and common prefixes of many strings, built one column at a time.

    The row of a suffix is one 64-bit word: the symbol before it (0 before a whole string; else byte + 1, which UTF-8 keeps below
    256), how many symbols it shares with the row above (counted up to ``cap``), how long it is and which string it belongs to.
    The rows lie in a file; a round reads the old ones whole and writes the next ones to another file. The caller bounds the size.
    """

    def __init__(self, strings: list[bytes], cap: int, folder: str):
        self.cap, self.folder = cap, folder
        self.lengths = np.array([len(s) for s in strings], np.int64)
        self.data, self.ends = np.frombuffer(b"".join(strings), np.uint8), np.cumsum(self.lengths)
        live = newest = np.arange(len(strings))  # strings not used up, and the rows of their longest suffixes so far
        self._rows(live, 0, np.zeros(len(live), np.uint8)).tofile(f"{folder}/0")
        for column in range(1, int(self.lengths.max(initial=0)) + 1):
            live, newest = self._insert(live, newest, column)
        rows = np.fromfile(f"{folder}/{int(self.lengths.max(initial=0)) % 2}", np.uint64)
        self.common, self.size, self.owner = self._part(rows, 1), (rows >> np.uint64(16)) & np.uint64(0xFFFF), (rows >> np.uint64(32)).astype(np.int64)

    @staticmethod
    def _part(rows: np.ndarray, byte: int) -> np.ndarray:
        return np.ascontiguousarray(rows.view(np.uint8)[byte::8])

    def _rows(self, strings: np.ndarray, size: int, common: np.ndarray) -> np.ndarray:
        """Rows of the suffixes of ``size`` symbols."""
        symbol = np.zeros(len(strings), np.uint64)
        more = self.lengths[strings] > size
        symbol[more] = self.data[self.ends[strings[more]] - size - 1].astype(np.uint64) + np.uint64(1)
        return symbol | common.astype(np.uint64) << np.uint64(8) | np.uint64(size << 16) | strings.astype(np.uint64) << np.uint64(32)

    def _insert(self, live: np.ndarray, newest: np.ndarray, column: int) -> tuple[np.ndarray, np.ndarray]:
        """Puts one more symbol of every string that has one before its suffix; the strings and where those rows now are."""
        rows = np.fromfile(f"{self.folder}/{(column - 1) % 2}", np.uint64)
        symbol, common = self._part(rows, 0), self._part(rows, 1)
        newest = newest[symbol[newest] > 0]
        # Suffixes that begin with one symbol follow in the order of the rows that have it before them: ``order``, group by group.
        order = np.argsort(symbol, kind="stable")
        groups = np.concatenate([[0], np.cumsum(np.bincount(symbol, minlength=256))])
        newest = np.sort(newest)
        mine = np.empty(len(newest), np.int64)
        for c in np.unique(symbol[newest]):
            some = symbol[newest] == c
            mine[some] = groups[c] + np.searchsorted(order[groups[c] : groups[c + 1]], newest[some])
        mine.sort()
        live = (rows[order[mine]] >> np.uint64(32)).astype(np.int64)
        base = len(self.lengths) - groups[1]  # the empty suffixes come first; rows without a symbol make no suffix

        def shared(at: np.ndarray) -> np.ndarray:
            """What the suffixes made at these places of ``order`` share with those of the place before: 1 + a range minimum."""
            out = np.zeros(len(at), np.uint8)
            same = np.flatnonzero(symbol[order[at]] == symbol[order[np.maximum(at - 1, 0)]])
            same = same[at[same] > 0]
            begin, end = order[at[same] - 1] + 1, order[at[same]] + 1
            by = np.argsort(begin, kind="stable")
            cuts = np.stack([begin[by], end[by]], axis=1).ravel()
            low = np.minimum.reduceat(np.append(common, np.uint8(0)), cuts)[::2] if len(cuts) else np.zeros(0, np.uint8)
            out[same[by]] = np.minimum(low.astype(np.int64) + 1, self.cap)
            return out

        follow = mine[np.append(mine[1:] != mine[:-1] + 1, True)[: len(mine)]] + 1
        follow = follow[follow < len(order)]  # old rows that get a new row above them
        below = base + follow - np.searchsorted(mine, follow)
        fresh = self._rows(live, column, shared(mine))
        rows[below] = rows[below] & ~np.uint64(0xFF00) | shared(follow).astype(np.uint64) << np.uint64(8)
        now = base + mine
        old = np.ones(len(rows) + len(mine), bool)
        old[now] = False
        out = np.empty(len(old), np.uint64)
        out[old], out[now] = rows, fresh
        out.tofile(f"{self.folder}/{column % 2}")
        return live, now


def equal_strings(strings: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class, string and place of every ``length``-byte string; equal ones have one class."""
    with tempfile.TemporaryDirectory() as folder:
        c = Collection(strings, length, folder)
    full = np.flatnonzero(c.size >= length)
    # neighbours among the long suffixes are neighbours among all where they share ``length`` symbols
    cls = np.cumsum(c.common < length)[full]
    string = c.owner[full]
    return cls, string, c.lengths[string] - c.size[full].astype(np.int64)


def _met_again(strings: list[bytes], length: int) -> list[tuple[int, int, int]]:
    """(string, begin, end) of the maximal parts made of ``length``-byte strings that occur more than once among all."""
    sizes = np.array([len(s) for s in strings], np.int64)
    begin = np.cumsum(sizes) - sizes
    hashes = Ranges(np.frombuffer(b"".join(strings), np.uint8)).windows(length)
    number = sizes - length + 1
    string = np.repeat(np.arange(len(sizes)), number)
    place = np.arange(len(string)) - np.repeat(np.cumsum(number) - number, number)
    hashes = hashes[begin[string] + place]
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    again = np.zeros(len(order) + 1, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    at = np.flatnonzero(again)
    if not len(at):
        return []
    new = np.append(True, (at[1:] != at[:-1] + 1) | (string[at[1:]] != string[at[:-1]]))
    head, tail = at[new], at[np.append(new[1:], True)]
    return list(zip(string[head].tolist(), place[head].tolist(), (place[tail] + length).tolist()))


def _resolved(length: int, collection: int):
    """What stands behind an owner's keys: (doc, begin, end) of bytes to remove."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extents: list[tuple] = []
        late: list[tuple[int, int, int]] = []

        def earliest(table: dict, string: bytes, at: tuple[int, int]) -> bool:
            """Keeps the earliest place of equal strings; the others are repeats. True if the string is new."""
            old = table.setdefault(string, at)
            if old != at:
                if at < old:
                    table[string], at = at, old
                late.append((*at, at[1] + len(string)))
            return old is at

        first: dict[bytes, tuple[int, int]] = {}
        keys: dict[int, list[bytes]] = {}
        for batch in batches:
            for kind, body in zip(batch.column("kind").to_pylist(), batch.column("body").to_pylist()):
                if not kind:
                    extents.append(tuple(_unpacked(body, 3)[0]))
                    continue
                (key, doc, start, n), strings = _unpacked(body, 4)
                stop = np.cumsum(n + length - 1)
                for k, b, e, d, s in zip(key.tolist(), (stop - n - length + 1).tolist(), stop.tolist(), doc.tolist(), start.tolist()):
                    if earliest(first, strings[b:e], (d, s)):
                        keys.setdefault(k, []).append(strings[b:e])

        def settled(strings: list[bytes], places: dict[bytes, tuple[int, int]]) -> None:
            cls, string, place = equal_strings(strings, length)
            doc, start = np.array([places[b] for b in strings], np.int64).T
            doc, at = doc[string], start[string] + place
            order = np.lexsort((at, doc, cls))
            cls, doc, at = cls[order], doc[order], at[order]
            head = np.maximum.accumulate(np.where(np.append(True, cls[1:] != cls[:-1]), np.arange(len(cls)), 0))
            repeat = (doc != doc[head]) | (at != at[head])
            extents.append((doc[repeat], at[repeat], at[repeat] + length))

        parts: dict[bytes, tuple[int, int]] = {}
        waiting: list[bytes] = []

        def narrowed(keys: list[int], strings: list[bytes]) -> None:
            """Only parts whose strings occur again go on; equal parts are merged, and what still differs waits to be sorted."""
            by_key: dict[int, list[bytes]] = {}
            for i, a, b in _met_again(strings, length):
                d, s = first[strings[i]]
                if earliest(parts, strings[i][a:b], (d, s + a)):
                    by_key.setdefault(keys[i], []).append(strings[i][a:b])
            waiting.extend(p for ps in by_key.values() if len(ps) > 1 or len(ps[0]) > length and _met_again(ps, length) for p in ps)
            if sum(map(len, waiting)) >= collection:
                settled(waiting, parts)
                waiting.clear()

        held_keys, held, size = [], [], 0
        for k, strings in keys.items():
            held_keys += [k] * len(strings)
            held += strings
            size += sum(map(len, strings))
            if size >= collection:
                narrowed(held_keys, held)
                held_keys, held, size = [], [], 0
        if held:
            narrowed(held_keys, held)
        if waiting:
            settled(waiting, parts)
        if late:
            extents.append(tuple(np.array(late, np.int64).T))
        doc, begin, end = (np.concatenate(x) for x in zip(*extents)) if extents else (np.zeros(0, np.int64),) * 3
        if len(doc):
            heads, end = joined(doc, begin, end)
            yield pa.RecordBatch.from_pydict({"doc": pa.array(heads[:, 0].copy()), "begin": pa.array(heads[:, 1].copy()), "end": pa.array(end)})

    return run


def sent(docs: DataFrame, length: int, set_bits: int, gram: int, most: int, heavy: int) -> DataFrame:
    """(owner, kind, body): what goes to each of four times as many owners as there are shuffle partitions."""
    spark = docs.sparkSession
    owners = int(spark.conf.get("spark.sql.shuffle.partitions"))
    gram = min(gram, length)
    met = docs.mapInArrow(_met(owners, set_bits, length, gram, most), "owner int, gaps binary, twice binary, numbers binary")
    table, many = np.zeros(set_bits, bool), [np.zeros(0, np.int64)]
    for base, size, marks, slots in met.groupBy("owner").applyInArrow(_marked(owners, set_bits, heavy), "base long, size long, marks binary, heavy binary").toLocalIterator():
        table[base : base + size] = np.unpackbits(np.frombuffer(marks, np.uint8), count=size).view(bool)
        many.append(np.frombuffer(slots, "<i8"))
    shared = spark.sparkContext.broadcast((np.packbits(table), np.concatenate(many)))
    return docs.mapInArrow(_sent(shared, 4 * owners, length, gram, most), "owner int, kind boolean, body binary")


def extents(docs: DataFrame, length: int = 100, set_bits: int = SET_BITS, gram: int = GRAM, most: int = MOST, collection: int = COLLECTION, heavy: int = HEAVY) -> DataFrame:
    """``docs``: doc (order numbers), text. (doc, begin, end): bytes to remove; parts of one document may touch."""
    owners = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sent(docs, length, set_bits, gram, most, heavy).repartition(owners, "owner").mapInArrow(_resolved(length, collection), "doc long, begin long, end long")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans"))):
            data, last, kept, spans_merged = (text or "").encode(), 0, [], []
            for s in sorted(spans or [], key=lambda s: s["begin"]):
                if spans_merged and s["begin"] <= spans_merged[-1][1]:
                    spans_merged[-1][1] = max(spans_merged[-1][1], s["end"])
                else:
                    spans_merged.append([s["begin"], s["end"]])
            spans_merged = [[a, min(b, len(data))] for a, b in spans_merged if a < len(data)]
            for a, b in spans_merged:
                kept.append(data[last:a])
                last = b
            kept = b"".join([*kept, data[last:]])
            rows.append({"doc_id": doc_id, "n_bytes": len(data), "n_removed": len(data) - len(kept), "spans": [{"begin": a, "end": b} for a, b in spans_merged], "kept": kept})
        yield pa.RecordBatch.from_pylist(rows, schema=_KEPT)


_KEPT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])


def _ordered(rows: DataFrame) -> DataFrame:
    """``rows`` with order numbers ``doc`` in place of ids (``doc_id``): one for each id and text, none for a null id."""
    if rows.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        return rows.withColumn("doc", F.col("doc_id"))
    rows = rows.withColumn("sha", F.unhex(F.sha2("text", 256)))
    keys = rows.where("doc_id is not null").select("doc_id", "sha").distinct().repartitionByRange("doc_id", "sha").sortWithinPartitions("doc_id", "sha")
    numbers = cut_lineage(keys.withColumn("doc", F.monotonically_increasing_id()), "order")
    return rows.join(numbers, ["doc_id", "sha"], "left").drop("sha")


def without_repeats(docs: DataFrame, length: int = 100, key: str = "doc_id", text: str = "text", set_bits: int = SET_BITS, heavy: int = HEAVY) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, spans (removed runs in bytes), kept (remaining bytes)."""
    rows = _ordered(chosen(docs, key, text).select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    spans = cut_lineage(extents(rows.where("doc is not null").select("doc", "text"), length, set_bits, heavy=heavy), "repeats").groupBy("doc").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    return rows.join(spans, "doc", "left").select("doc_id", "text", "spans").mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, spans array<struct<begin: long, end: long>>, kept binary")
