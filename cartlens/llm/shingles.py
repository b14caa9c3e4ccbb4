"""Word shingles of a text as 64-bit hashes, computed with numpy on its bytes."""

from __future__ import annotations

import sys

import numpy as np

#: Words of a shingle, and bytes hashed at a time (words are never cut).
WORDS, CHUNK = 5, 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (two xor-shift multiplications)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class _Tables:
    """Word bytes (letters and digits in lower case, and every byte of a character
    beyond ASCII), byte values, and powers of an odd base and of its inverse."""

    def __init__(self):
        self.word = np.zeros(256, dtype=bool)
        self.word[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
        self.value = mix(np.arange(1, 257, dtype=np.uint64))
        self.base, self.stem = 0x9E3779B97F4A7C15, np.uint64(0xA24BAED4963EE407)
        self.grow(CHUNK)
        self.places = mix(np.arange(1001, 1001 + WORDS, dtype=np.uint64)) | np.uint64(1)

    def grow(self, n: int) -> None:
        def powers(b: int) -> np.ndarray:
            steps = np.full(n, b, dtype=np.uint64)
            steps[0] = 1
            return np.cumprod(steps, dtype=np.uint64)

        self.power, self.inverse = powers(self.base), powers(pow(self.base, -1, 1 << 64))


def tables() -> _Tables:
    """Kept by a Python worker from task to task."""
    if "_llm_shingle_tables" not in sys.__dict__:
        sys.__dict__["_llm_shingle_tables"] = _Tables()
    return sys.__dict__["_llm_shingle_tables"]


def word_hashes(text: str, stem: int = 0):
    """One hash per word: a maximal run of letters, digits and non-ASCII
    characters of the lower-cased text. With ``stem`` also, as a second array,
    one of the first ``stem`` bytes of every word with more."""
    t = tables()
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), dtype=np.uint8)
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = t.word[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    out, stems = np.empty(len(starts), dtype=np.uint64), []
    first = 0
    while first < len(starts):
        after = max(first + 1, int(np.searchsorted(ends, starts[first] + CHUNK)))
        lo, hi = int(starts[first]), int(ends[after - 1])
        if hi - lo > len(t.power):
            t.grow(hi - lo)
        sums = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum(t.value[data[lo:hi]] * t.power[:hi - lo], out=sums[1:])
        s, e = starts[first:after] - lo, ends[first:after] - lo
        out[first:after] = (sums[e] - sums[s]) * t.inverse[s]
        if stem:
            s = s[e - s > stem]
            stems.append((sums[s + stem] - sums[s]) * t.inverse[s])
        first = after
    if not stem:
        return mix(out)
    return mix(out), mix(np.concatenate(stems or [out]) ^ t.stem)


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted distinct hashes of all runs of five words. A text of one to four
    words has one shingle, all its words; one without words has none."""
    words = word_hashes(text or "")
    n = len(words)
    if not n:
        return words
    width = min(n, WORDS)
    places = tables().places
    total = np.full(n - width + 1, width, dtype=np.uint64)
    for j in range(width):
        total += words[j:n - width + 1 + j] * places[j]
    return np.unique(mix(total))
