"""Word shingles as 64-bit hashes, vectorised over chunks of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

CHUNK_BYTES = 1 << 19
_CACHE = 1 << 19
_P = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S = np.uint64(33)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> _S)) * _M1
    x = (x ^ (x >> _S)) * _M2
    return x ^ (x >> _S)


class WordHashes(dict):
    """word -> 64-bit hash, remembering a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[range]:
    """Consecutive runs of ``texts`` of about ``limit`` bytes."""
    first = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= limit:
            yield range(first, i + 1)
            first, total = i + 1, 0
    if first < len(texts):
        yield range(first, len(texts))


def shingle_hashes(texts: list[bytes], hashes: WordHashes, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of ``texts`` end to end (repeats included), and the number of
    each text's.  Words are lower-cased (A-Z) and split at ASCII white space,
    which is what bytes.lower and bytes.split do; a text of fewer than
    ``width`` words is one shingle, one without words has none."""
    words = [t.lower().split() for t in texts]
    n = np.array([len(w) for w in words], dtype=np.int64)
    flat = np.fromiter((hashes[x] for w in words for x in w), dtype=np.uint64, count=int(n.sum()))
    counts = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    if not len(flat):
        return flat, counts
    start = np.cumsum(n) - n
    if len(flat) >= width:
        rolled = np.zeros(len(flat) - width + 1, dtype=np.uint64)
        for k in range(width):
            rolled = rolled * _P + mixed(flat[k : len(flat) - width + 1 + k])
    else:
        rolled = np.zeros(0, dtype=np.uint64)
    out = np.empty(int(counts.sum()), dtype=np.uint64)
    full = np.repeat(n >= width, counts)
    offset = np.cumsum(counts) - counts
    place = np.arange(len(out)) - np.repeat(offset, counts) + np.repeat(start, counts)
    out[full] = rolled[place[full]]
    for k in range(1, width):  # texts of fewer words, by their number
        few = np.flatnonzero(n == k)
        h = np.full(len(few), k, dtype=np.uint64)
        for j in range(k):
            h = h * _P + mixed(flat[start[few] + j])
        out[offset[few]] = h
    return mixed(out), counts
