"""Word grams as 64-bit hashes, and the packed exchange of their counts.

A gram is known by a 64-bit hash: with a billion distinct grams the chance that any two agree is about 3 %, and such
a pair would shift one count. Sorted hashes travel as differences in byte planes, which Spark's shuffle compresses.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_A, _B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_P, _S = np.uint64(0x9E3779B97F4A7C15), np.uint64(33)


def tokens(text: str | None) -> list[bytes]:
    """Runs of other than ASCII white space, ASCII letters in lower case."""
    return text.encode().lower().split() if text else []


class Words:
    """Ids in order of first use, and the hash of each word."""

    def __init__(self):
        self.ids: dict[bytes, int] = {}

    def add(self, words: list[bytes]) -> list[int]:
        ids = self.ids
        return [ids.setdefault(w, len(ids)) for w in words]

    def hashes(self) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, self.ids), np.uint64, len(self.ids))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a combined hash."""
    h = (h ^ (h >> _S)) * _A
    h = (h ^ (h >> _S)) * _B
    return h ^ (h >> _S)


def follow(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """Hash of a sequence continued by one more word; not mixed."""
    return first * _P + then


def shard_ends(keys: np.ndarray, shards: int) -> np.ndarray:
    """Ends of the equal ranges of the hash space among sorted keys."""
    bounds = [(i << 64) // shards for i in range(1, shards)]
    return np.append(np.searchsorted(keys, np.array(bounds, np.uint64)), len(keys))


def planes(values: np.ndarray) -> bytes:
    """Bytes of an array, all first bytes, then all second bytes, and so on."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def unplanes(raw: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def pack(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as differences."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def unpack(raw: bytes) -> np.ndarray:
    return np.cumsum(unplanes(raw, np.uint64), dtype=np.uint64)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of text, with a few for each row."""
    found = docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 16)).first()[0]
    return int(found or 0)
