"""What the operators of this subpackage have in common: shared files, hashes of byte ranges, string stars."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, functions as F


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a location that every executor can reach."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def new_name(suffix: str) -> str:
    """A file name that no other attempt of a task uses; a file counts only once a written index names it."""
    return uuid.uuid4().hex + suffix


def chosen(df: DataFrame, key: str, text: str) -> DataFrame:
    """The two columns an operator reads, as ``doc_id`` (long) and ``text``; other columns stay out, whatever their names."""
    return df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mixed(x: np.ndarray) -> np.ndarray:
    """Scatters the bits of 64-bit values (xor-shift and multiply, twice)."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0x9FB21C651E98DF25)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class Ranges:
    """Hashes of any ranges of one buffer, from running sums of symbols times powers of an odd number (mod 2**64).

    A power is the product of one within a block and one of the block, so the tables that a process keeps have a fixed length.
    """

    BASE = 0xA24BAED4963EE407
    BLOCK = 1 << 16
    _TABLE = mixed(np.arange(256, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    _up = _down = None

    def __init__(self, data: np.ndarray):
        n = len(data)
        if Ranges._up is None:
            Ranges._up, Ranges._down = self._powers(self.BASE, self.BLOCK), self._powers(pow(self.BASE, -1, 1 << 64), self.BLOCK)
        blocks = n // self.BLOCK + 1
        self._block_up = self._powers(pow(self.BASE, self.BLOCK, 1 << 64), blocks)
        down = self._powers(pow(self.BASE, -self.BLOCK, 1 << 64), blocks)
        self.sums = np.zeros(n + 1, np.uint64)
        for b in range(blocks):
            part = data[b * self.BLOCK : (b + 1) * self.BLOCK]
            values = self._TABLE[part] if data.dtype == np.uint8 else mixed(part.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
            values *= self._down[: len(part)]
            values *= down[b]
            self.sums[b * self.BLOCK + 1 : b * self.BLOCK + 1 + len(part)] = values
        np.cumsum(self.sums, out=self.sums)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.empty(n, np.uint64)
        out[0], have, step = 1, 1, base
        while have < n:  # doubling: the next stretch is the first one times base**have
            take = min(have, n - have)
            out[have : have + take] = out[:take] * np.uint64(step)
            have += take
            step = step * step % (1 << 64)
        return out

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = self.sums[ends] - self.sums[starts]
        out *= self._up[starts & (self.BLOCK - 1)]
        if len(self._block_up) > 1:
            out *= self._block_up[starts >> 16]
        out += (ends - starts).astype(np.uint64)
        return mixed(out)

    def windows(self, size: int) -> np.ndarray:
        """The hashes of all ranges of ``size`` symbols."""
        out = self.sums[size:] - self.sums[:-size]
        for b in range(0, len(out), self.BLOCK):
            part = out[b : b + self.BLOCK]
            part *= self._up[: len(part)]
            part *= self._block_up[b >> 16]
        out += np.uint64(size)
        return mixed(out)
