"""Word and window hashes in numpy, and filters of fixed size over 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.sources.staging import release, stage

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_KNOWN_WORDS = 100_000
_KNOWN_POWERS: dict[int, np.ndarray] = {}


class WordHashes(dict):
    """Hashes of words, kept while they are few."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers; those of texts of usual length are kept."""
    known = _KNOWN_POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 14), np.uint64(base))
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        if len(known) <= 1 << 21:
            _KNOWN_POWERS[base] = known
    return known[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A finaliser: the order of mixed hashes has nothing to do with how they were put together."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def windows(word_hashes: np.ndarray, width: int) -> np.ndarray:
    """Mixed hashes of all runs of ``width`` words."""
    n = len(word_hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(word_hashes) + 1, np.uint64)
    np.cumsum(word_hashes * _powers(_INVERSE, len(word_hashes)), out=sums[1:])
    return mixed((sums[width:] - sums[:n]) * _powers(_BASE, n))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


class Filter:
    """A Bloom filter of ``bits`` bits (a power of two) over signed 64-bit hashes that are evenly spread.

    Its size is a parameter and does not grow with the data; a fuller filter only says yes more often.
    """

    def __init__(self, words: np.ndarray):
        self.words = words
        self.bits = len(words) * 64

    @staticmethod
    def _places(h: Column, bits: int) -> list[Column]:
        return [h.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1))]

    @classmethod
    def build(cls, hashes: DataFrame, name: str, bits: int) -> Filter:
        """From a distributed column; the driver gets packed arrays of at most ``bits / 4`` bytes in all."""
        place = hashes.select(F.explode(F.array(*cls._places(F.col(name).cast("long"), bits))).alias("p"))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))
        filled = place.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(bit).alias("m"))

        def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield pd.DataFrame({"w": [b["w"].to_numpy(np.int64).tobytes()], "m": [b["m"].to_numpy(np.int64).tobytes()]})

        words = np.zeros(bits // 64, np.int64)
        packed = stage(filled.mapInPandas(pack, "w binary, m binary"))
        for w, m in packed.toLocalIterator():
            words[np.frombuffer(w, np.int64)] = np.frombuffer(m, np.int64)
        release(packed)
        return cls(words)

    def has(self, h: np.ndarray) -> np.ndarray:
        h = h.view(np.uint64)
        out = np.ones(len(h), bool)
        for p in (h, h >> np.uint64(32)):
            p = p & np.uint64(self.bits - 1)
            bit = np.uint64(1) << (p & np.uint64(63))
            out &= (self.words.view(np.uint64)[(p >> np.uint64(6)).astype(np.int64)] & bit) != 0
        return out


class Sections:
    """A filter in sections by the leading bits of evenly spread 64-bit hashes, each as large as its keys ask for.

    A key sets three bits of one word. At ``KEY_BITS`` bits a key about one other hash in a hundred passes, however many
    keys there are; only a section that would be larger than it may be is fuller, and says yes more often.
    """

    KEY_BITS = 16

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.starts = np.cumsum(sizes) - sizes

    @staticmethod
    def _word(h: np.ndarray, sections: int, sizes) -> np.ndarray:
        """The word of its section that a hash is in; in order of the hashes."""
        within = ((h >> np.uint64(32)) << np.uint64(sections.bit_length() - 1)) & np.uint64(0xFFFFFFFF)
        return (within * sizes) >> np.uint64(32)

    @staticmethod
    def _mask(h: np.ndarray) -> np.ndarray:
        one, six = np.uint64(1), np.uint64(63)
        return (one << (h & six)) | (one << ((h >> np.uint64(6)) & six)) | (one << ((h >> np.uint64(12)) & six))

    @classmethod
    def section(cls, keys: np.ndarray, sections: int, bits: int) -> np.ndarray:
        """The words of one of ``sections`` (a power of two), from its distinct keys in order; ``bits`` is the most all may have."""
        n = max(1, min(-(-len(keys) * cls.KEY_BITS // 64), bits // 64 // sections))
        words = np.zeros(n, np.uint64)
        if len(keys):
            word = cls._word(keys, sections, np.uint64(n)).astype(np.int64)
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            words[word[starts]] = np.bitwise_or.reduceat(cls._mask(keys), starts)
        return words

    @classmethod
    def build(cls, parts: DataFrame, sections: int) -> tuple[np.ndarray, np.ndarray]:
        """What a filter is made of, from rows ``bucket, words``; the driver gets the words once."""
        parts = stage(parts)
        sizes = np.ones(sections, np.uint64)
        for r in parts.select("bucket", F.octet_length("words").alias("n")).collect():
            sizes[r.bucket] = r.n // 8
        starts = np.r_[0, np.cumsum(sizes)].astype(np.int64)
        words = np.zeros(starts[-1], np.uint64)
        for bucket, w in parts.select("bucket", "words").toLocalIterator():
            words[starts[bucket] : starts[bucket + 1]] = np.frombuffer(w, np.uint64)
        release(parts)
        return sizes, words

    def has(self, h: np.ndarray) -> np.ndarray:
        h = h.view(np.uint64)
        n = len(self.sizes)
        section = ((h >> np.uint64(32)) >> np.uint64(33 - n.bit_length())).astype(np.int64)
        mask = self._mask(h)
        return self.words[(self.starts[section] + self._word(h, n, self.sizes[section])).astype(np.int64)] & mask == mask
