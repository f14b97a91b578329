"""Elias-Fano sequences and a two-level n-gram trie in memory-mapped files."""

from __future__ import annotations

import os
import shutil
import tempfile

import numpy as np

_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)
#: Position of the k-th set bit of a byte (8: none).
_SELECT = np.full((256, 8), 8, np.uint8)
for _b in range(256):
    for _k, _i in enumerate(i for i in range(8) if _b >> i & 1):
        _SELECT[_b, _k] = _i


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits in unary.  ``arrays`` is all it
    holds, so it can be written to files and mapped again."""

    def __init__(self, arrays: dict[str, np.ndarray], n: int, low_bits: int):
        self.arrays, self.n, self.low_bits = arrays, n, low_bits

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        low_bits = max(0, int(universe // max(1, n)).bit_length() - 1)
        high = (values >> np.uint64(low_bits)).astype(np.int64)
        unary = np.zeros((int(universe) >> low_bits) + n + 2, bool)
        unary[high + np.arange(n)] = True
        upper = np.packbits(unary, bitorder="little")
        low = np.zeros((n * low_bits + 63) // 64 + 2, np.uint64)
        if low_bits and n:
            bit = np.arange(n, dtype=np.int64) * low_bits
            part = values & np.uint64((1 << low_bits) - 1)
            shift = (bit & 63).astype(np.uint64)
            np.bitwise_or.at(low, bit >> 6, part << shift)
            over = np.flatnonzero((bit & 63) + low_bits > 64)
            np.bitwise_or.at(low, (bit[over] >> 6) + 1, part[over] >> (np.uint64(64) - shift[over]))
        ones = np.r_[0, np.cumsum(_POP[upper], dtype=np.int64)]
        return cls({"low": low, "upper": upper, "ones": ones}, n, low_bits)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        low, bit = self.arrays["low"], i * self.low_bits
        shift = (bit & 63).astype(np.uint64)
        # a shift by 64 is undefined: two shifts instead
        out = (low[bit >> 6] >> shift) | ((low[(bit >> 6) + 1] << np.uint64(1)) << (np.uint64(63) - shift))
        return out & np.uint64((1 << self.low_bits) - 1)

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Place of the k-th one (or zero) of the unary bits."""
        upper, count = self.arrays["upper"], self.arrays["ones"]
        before = count if ones else 8 * np.arange(len(count)) - count
        byte = np.searchsorted(before, k, "right") - 1
        bits = upper[byte] if ones else ~upper[byte]
        return 8 * byte + _SELECT[bits, k - before[byte]]

    def get(self, i: np.ndarray) -> np.ndarray:
        """Elements at places ``i``."""
        i = np.asarray(i, np.int64)
        high = (self._select(i, True) - i).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self._low(i)

    def successor(self, values: np.ndarray) -> np.ndarray:
        """Place of the first element that is not below each value: select on the high bits finds
        the run of elements that share them, a binary search in the run finds the place."""
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        zeros = 8 * len(self.arrays["upper"]) - int(self.arrays["ones"][-1])
        inside = high < zeros
        h = np.minimum(high, zeros - 1)
        first = np.where(h > 0, self._select(np.maximum(h - 1, 0), False) - (h - 1), 0)
        last = self._select(h, False) - h
        lo, hi = np.where(inside, first, self.n), np.where(inside, last, self.n)
        part = values & np.uint64((1 << self.low_bits) - 1)
        while (active := np.flatnonzero(lo < hi)).size:
            mid = (lo[active] + hi[active]) >> 1
            below = self._low(mid) < part[active]
            lo[active] = np.where(below, mid + 1, lo[active])
            hi[active] = np.where(below, hi[active], mid)
        return lo


def _mapped(folder: str, name: str, a: np.ndarray) -> np.ndarray:
    path = os.path.join(folder, name)
    np.save(path, a)
    return np.load(path + ".npy", mmap_mode="r")


def quantise(values: np.ndarray, levels: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Codes of ``levels`` bins of equal width, and each bin's mean: no value is off by more than the
    width of a bin, however rare it is."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1)
    low, high = float(values.min()), float(values.max())
    code = np.minimum(levels - 1, ((values - low) * (levels / max(high - low, 1e-12))).astype(np.int64))
    return code.astype(np.uint8), np.bincount(code, values, levels) / np.maximum(np.bincount(code, minlength=levels), 1)


class Trie:
    """Contexts and their successors.

    Level 0 holds the sorted word hashes (a word's id is its rank), level 1 the context words'
    ids with monotone pointers to their successors and quantised backoff weights, level 2 the
    successors' ids with quantised log10 probabilities.  Level 2 is one monotone sequence:
    each context's ids are shifted by the context's number times the number of words, so a query
    is a successor search for the shifted id, which stays in the context's range.  The levels
    lie in files of a temporary folder, mapped into memory, until ``close``.
    """

    def __init__(self, contexts: np.ndarray, words: np.ndarray, log_p: np.ndarray, backoff: np.ndarray):
        """``contexts`` (sorted) and ``words`` are hashes of each distinct pair, sorted by pair;
        ``backoff`` belongs to the distinct contexts in order."""
        self.folder = tempfile.mkdtemp(prefix="trie-")
        vocabulary = np.unique(np.concatenate([contexts, words]))
        self.vocabulary = _mapped(self.folder, "vocabulary", vocabulary)
        first = np.flatnonzero(np.r_[True, contexts[1:] != contexts[:-1]]) if len(contexts) else np.zeros(0, np.int64)
        size = max(1, len(vocabulary))
        ids = np.searchsorted(vocabulary, contexts[first])
        self.context_ids = self._level("contexts", EliasFano.of(ids, size))
        self.pointers = self._level("pointers", EliasFano.of(np.r_[first, len(words)], len(words) + 1))
        number = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(words)]))
        shifted = number.astype(np.uint64) * np.uint64(size) + np.searchsorted(vocabulary, words).astype(np.uint64)
        self.size, self.n_contexts = size, len(first)
        self.successors = self._level("successors", EliasFano.of(shifted, size * max(1, len(first))))
        codes, self.p_bins = quantise(log_p)
        self.p_codes = _mapped(self.folder, "p_codes", codes)
        codes, self.b_bins = quantise(backoff)
        self.b_codes = _mapped(self.folder, "b_codes", codes)

    def _level(self, name: str, level: EliasFano) -> EliasFano:
        level.arrays = {k: _mapped(self.folder, f"{name}_{k}", a) for k, a in level.arrays.items()}
        return level

    def _ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ranks in level 0, -1 for unknown words."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def query(self, contexts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each pair (NaN where it was not seen) and log10 backoff weight of
        its context (0 where that was not seen)."""
        log_p, backoff = np.full(len(words), np.nan), np.zeros(len(words))
        c, w = self._ids(contexts), self._ids(words)
        known = np.flatnonzero(c >= 0)
        if not len(known) or not self.n_contexts:
            return log_p, backoff
        place = self.context_ids.successor(c[known].astype(np.uint64))
        place = np.minimum(place, self.n_contexts - 1)
        same = self.context_ids.get(place) == c[known].astype(np.uint64)
        known, place = known[same], place[same]
        backoff[known] = self.b_bins[self.b_codes[place]]
        seen = w[known] >= 0
        known, place = known[seen], place[seen]
        begin, end = self.pointers.get(place).astype(np.int64), self.pointers.get(place + 1).astype(np.int64)
        value = place.astype(np.uint64) * np.uint64(self.size) + w[known].astype(np.uint64)
        at = self.successors.successor(value)
        inside = (at >= begin) & (at < end)
        known, at, value = known[inside], at[inside], value[inside]
        same = self.successors.get(at) == value
        log_p[known[same]] = self.p_bins[self.p_codes[at[same]]]
        return log_p, backoff

    def close(self) -> None:
        shutil.rmtree(self.folder, ignore_errors=True)
