"""Helpers shared by the operators: stored intermediate tables, word hashing.

Rows are told apart by ``(doc_id, xxhash64(text))``: a repeated row has the same
result as its copy, and two texts under one ``doc_id`` stay apart.
"""

from __future__ import annotations

import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payledger.session import checkpoint_dir

#: ``doc_id`` order of rows without one: after every id.
LAST_ID = (1 << 63) - 1


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a plan leaf that
    survives the loss of executors and is computed once."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_key(text: Column | str = "text") -> Column:
    return F.xxhash64(text)


def held_out(modulus: int, remainder: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text falls on ``remainder``; a null id never does."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(crc % modulus == remainder, F.lit(False))


def same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Null-safe equality of the named columns."""
    cond = F.lit(True)
    for n in names:
        cond = cond & left[n].eqNullSafe(right[n])
    return cond


class WordHash(dict):
    """64-bit hash of a word (bytes), remembered up to ``limit`` words; the
    limit bounds memory only, a forgotten word is hashed again."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < self.limit:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


_MULT, _MULT_CHECK = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_MASK = (1 << 64) - 1


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads the low bits of a polynomial hash over all 64."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def ngram_hashes(h: np.ndarray, n: int, mult: int = _MULT) -> np.ndarray:
    """Polynomial hash of every run of ``n`` word hashes (empty if fewer)."""
    size = len(h) - n + 1
    if size <= 0:
        return np.empty(0, dtype=np.uint64)
    out, done, power, width = None, 0, h, 1
    while done < n:
        if n & width:
            part = power[done : done + size]
            out = part.copy() if out is None else out * np.uint64(pow(mult, width, _MASK + 1)) + part
            done += width
        if done < n:
            power = power[:-width] * np.uint64(pow(mult, width, _MASK + 1)) + power[width:]
            width *= 2
    return mix(out)


def ngram_pairs(h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two polynomial hashes with unlike multipliers of every run: 128 bits."""
    return ngram_hashes(h, n), ngram_hashes(h, n, _MULT_CHECK)


def window_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values (empty if fewer)."""
    size = len(v) - width + 1
    if size <= 0:
        return v[:0]
    done, cur = 1, v
    while done * 2 <= width:
        cur = np.minimum(cur[:-done], cur[done:])
        done *= 2
    return np.minimum(cur[:size], cur[width - done : width - done + size])


def covered(hit: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a run of ``width`` that starts at a hit."""
    step = np.zeros(n + 1, dtype=np.int64)
    at = np.flatnonzero(hit)
    np.add.at(step, at, 1)
    np.add.at(step, at + width, -1)
    return np.cumsum(step[:-1]) > 0
