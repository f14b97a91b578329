"""Benchmark decontamination by greedy string tiling.

Words are lower-cased (A-Z).  Every run of ``min_tile`` words that a document shares with a
benchmark item is a seed; documents are scanned for the seeds of a block of items in one pass,
without a shuffle.  For each (document, item) pair with seeds, tiles are marked greedily: the
longest common run of unmarked words first, found by Karp-Rabin hashes at falling lengths,
then the next, until none has ``min_tile`` words.  Tiles never overlap, in either text, and
their order does not matter, so a reordered passage is covered all the same.  The pair is a leak
when the tiles cover at least ``percent`` of the item's words.

The benchmark is read in blocks of at most ``block_bytes`` of text (a longer item is a block of
its own).  A pass is written before the next block is broadcast, so more blocks mean more
passes, not more memory.

Null and empty texts match nothing.  An item with fewer than ``min_tile`` words is one tile of its
own length: it leaks where a document holds it whole.  Repeated
documents are reported again, repeated items each by their own row; rows with a null id are
reported with that null.  Empty tables give an empty result.  Extra columns are ignored, and
:func:`clean` keeps them as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandflow.llm.common import Scratch, slices, window_hashes, word_hashes

_B = np.uint64(0x9E3779B97F4A7C15 | 1)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(n, _B, np.uint64)], dtype=np.uint64)


class _Rolling:
    """Karp-Rabin hashes of all windows of any length of one word sequence."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.powers = _powers(self.n)
        # sum of words[i] * B^(n-1-i): window hashes are differences times a power of B
        self.sums = np.r_[np.uint64(0), np.cumsum(words * self.powers[self.n - 1::-1][:self.n], dtype=np.uint64)] if self.n else np.zeros(1, np.uint64)

    def windows(self, starts: np.ndarray, length: int) -> np.ndarray:
        return (self.sums[starts + length] - self.sums[starts]) * self.powers[starts]


def _open_starts(marked: np.ndarray, length: int) -> np.ndarray:
    """Starts of windows without a marked word."""
    if len(marked) < length:
        return np.zeros(0, np.int64)
    taken = np.r_[0, np.cumsum(marked)]
    return np.flatnonzero(taken[length:] == taken[:-length])


def tiles(item: np.ndarray, text: np.ndarray, min_tile: int) -> list[tuple[int, int, int]]:
    """Greedy tiling of two word sequences: ``(item start, text start, length)``, longest first
    (ties: first in the item, then in the text)."""
    p_marked, t_marked = np.zeros(len(item), bool), np.zeros(len(text), bool)
    p_hash, t_hash = _Rolling(item), _Rolling(text)
    out: list[tuple[int, int, int]] = []

    def common(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Open starts in the item that have a match, open starts in the text by hash, and the range
        of those for each of the former; None without any."""
        p, t = _open_starts(p_marked, length), _open_starts(t_marked, length)
        if not len(p) or not len(t):
            return None
        # sums carry B^(n - end); multiplying by B^start leaves B^(n - length) on either side
        hp = p_hash.windows(p, length) * t_hash.powers[t_hash.n - length]
        ht = t_hash.windows(t, length) * p_hash.powers[p_hash.n - length]
        order = np.argsort(ht, kind="stable")
        lo, hi = np.searchsorted(ht[order], hp, "left"), np.searchsorted(ht[order], hp, "right")
        some = hi > lo
        return (p[some], t[order], lo[some], hi[some]) if some.any() else None

    def mark(length: int, p: np.ndarray, t: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        # marks only grow, so what one window had to skip the next of its hash skips too
        upto: dict[int, int] = {}
        for a, first, end in zip(p.tolist(), lo.tolist(), hi.tolist(), strict=True):
            # tiles are at least this long: one that overlaps a window covers one of its ends
            if p_marked[a] or p_marked[a + length - 1]:
                continue
            j = upto.get(first, first)
            while j < end and (t_marked[t[j]] or t_marked[t[j] + length - 1]):
                j += 1
            upto[first] = j
            while j < end:
                b = int(t[j])
                if not (t_marked[b] or t_marked[b + length - 1]) and np.array_equal(item[a:a + length], text[b:b + length]):
                    p_marked[a:a + length] = True
                    t_marked[b:b + length] = True
                    out.append((a, b, length))
                    break
                j += 1  # only if unlike windows share a hash

    upper = min(len(item), len(text)) + 1  # no common open run has this length
    while True:
        # bisect on the longest length with a match: a run of length s has runs of s - 1
        low, high, best = min_tile, upper, None
        while low < high:
            mid = (low + high) // 2 if best else low
            got = common(mid)
            if got is not None:
                best, low = (mid, got), mid + 1
            else:
                high = mid
                if not best:
                    break
        if not best:
            return out
        upper, found = best
        mark(upper, *found)


#: Seeds at hits, one for each item that has it, that are worked on at once (more if one document has more).
HITS = 1_000_000


class _Block:
    """One block of items and the index of their seeds.  Items of the same words share one entry."""

    def __init__(self, ids: list, texts: list, min_tile: int):
        self.min_tile = min_tile
        words, offsets = word_hashes(pa.array(texts, pa.string()))
        same: dict[bytes, list[int]] = {}
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
            same.setdefault(words[a:b].tobytes(), []).append(i)
        self.ids, self.same = ids, list(same.values())
        self.words = [words[offsets[own[0]]:offsets[own[0] + 1]] for own in self.same]
        seeds = [np.unique(window_hashes(w, min_tile)) for w in self.words]
        item = np.repeat(np.arange(len(seeds)), [len(s) for s in seeds])
        seeds = np.concatenate(seeds) if seeds else np.zeros(0, np.uint64)
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.item = seeds[order], item[order]
        # items with fewer words than a tile are looked for whole, by their length
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in {len(w) for w in self.words if 0 < len(w) < min_tile}:
            own = [i for i, w in enumerate(self.words) if len(w) == n]
            h = np.concatenate([window_hashes(self.words[i], n) for i in own])
            order = np.argsort(h, kind="stable")
            self.short[n] = h[order], np.array(own)[order]

    def _short_leaks(self, words: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        for n, (seeds, item) in self.short.items():
            grams = window_hashes(words, n)
            if not len(grams):
                continue
            lo = np.searchsorted(seeds, grams, "left")
            hit = np.flatnonzero(seeds[np.minimum(lo, len(seeds) - 1)] == grams)
            row = np.searchsorted(offsets, hit, "right") - 1
            inside = hit + n <= offsets[row + 1]
            found = {(int(r), int(at)) for r, at in zip(row[inside], lo[hit[inside]], strict=True)}
            for r, at in sorted(found):
                for i in item[at:np.searchsorted(seeds, seeds[at], "right")].tolist():
                    yield r, i, n, n

    def leaks(self, texts: pa.Array, percent: int) -> Iterator[tuple[int, int, int, int]]:
        """``(row, item, covered words, words of the item)`` of the pairs that leak."""
        words, offsets = word_hashes(texts)
        for found in (self._short_leaks(words, offsets), self._long_leaks(words, offsets, percent)):
            for row, at, covered, n in found:
                for item in self.same[at]:
                    yield row, item, covered, n

    def _long_leaks(self, words: np.ndarray, offsets: np.ndarray, percent: int) -> Iterator[tuple[int, int, int, int]]:
        k = self.min_tile
        grams = window_hashes(words, k)
        if not len(grams) or not len(self.seeds):
            return
        lo = np.searchsorted(self.seeds, grams, "left")
        hit = np.flatnonzero(self.seeds[np.minimum(lo, len(self.seeds) - 1)] == grams)
        row = np.searchsorted(offsets, hit, "right") - 1
        inside = hit + k <= offsets[row + 1]
        hit, row = hit[inside], row[inside]
        if not len(hit):
            return
        lo, hi = lo[hit], np.searchsorted(self.seeds, grams[hit], "right")
        # whole documents at a time, so that a seed of many items fits as well
        last = np.flatnonzero(np.r_[row[1:] != row[:-1], True])
        part = (np.cumsum(hi - lo)[last] - 1) // HITS
        ends = last[np.r_[part[1:] != part[:-1], True]] + 1
        for a, b in zip(np.r_[0, ends[:-1]], ends, strict=True):
            yield from self._tiled(words, hit[a:b], row[a:b], lo[a:b], hi[a:b], percent)

    def _tiled(self, words: np.ndarray, hit: np.ndarray, row: np.ndarray, lo: np.ndarray, hi: np.ndarray, percent: int) -> Iterator[tuple[int, int, int, int]]:
        k = self.min_tile
        # one entry for each item that has the seed of a hit
        many = hi - lo
        at = np.repeat(np.arange(len(hit)), many)
        item = self.item[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + lo[at]]
        order = np.lexsort((hit[at], item, row[at]))
        hit, row, item = hit[at[order]], row[at[order]], item[order]
        pair = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (item[1:] != item[:-1])])
        # tiles cover no more words than lie under seeds
        under = np.minimum(np.r_[hit[1:] - hit[:-1], k], k)
        ends = np.r_[pair[1:], len(hit)]
        under[ends - 1] = k
        size = np.array([len(w) for w in self.words])[item[pair]]
        some = 100 * np.add.reduceat(under, pair) >= percent * size
        for a, b in zip(pair[some].tolist(), ends[some].tolist(), strict=True):
            own = self.words[item[a]]
            starts = hit[a:b]
            # all tiles lie in words under a seed; runs of such words are kept apart by a word of no text
            gap = np.r_[True, starts[1:] > starts[:-1] + k]
            upto = np.r_[np.minimum(starts[:-1] + k, np.where(gap[1:], starts[:-1] + k, starts[1:])), starts[-1] + k]
            text = []
            for s, e, g in zip(starts.tolist(), upto.tolist(), gap.tolist(), strict=True):
                if g and text:
                    text.append(np.array([_NO_WORD], np.uint64))
                text.append(words[s:e])
            covered = sum(x[2] for x in tiles(own, np.concatenate(text), k))
            if 100 * covered >= percent * len(own):
                yield int(row[a]), int(item[a]), covered, len(own)


_NO_WORD = np.uint64(0xFFFFFFFFFFFFFFFF)


def blocks(benchmark: DataFrame, min_tile: int, block_bytes: int) -> Iterator[_Block]:
    """The benchmark's items in blocks; the driver holds one at a time."""
    ids: list = []
    texts: list = []
    size = 0
    for r in benchmark.select(F.col("item_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))).toLocalIterator():
        if ids and size + len(r[1].encode()) > block_bytes:
            yield _Block(ids, texts, min_tile)
            ids, texts, size = [], [], 0
        ids.append(r[0])
        texts.append(r[1])
        size += len(r[1].encode())
    if ids:
        yield _Block(ids, texts, min_tile)


def leaks(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, percent: int = 50, min_tile: int = 5, block_bytes: int = 8_000_000) -> DataFrame:
    """``doc_id, item_id, covered_words, item_words`` of every pair that leaks."""
    text = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def one(block: _Block) -> tuple[DataFrame, object]:
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text"):
                    got = list(shared.value.leaks(part.column("text"), percent))
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": part.column("doc_id").take(pa.array([g[0] for g in got], pa.int64())),
                        "item_id": pa.array([shared.value.ids[g[1]] for g in got], pa.int64()),
                        "covered_words": pa.array([g[2] for g in got], pa.int64()), "item_words": pa.array([g[3] for g in got], pa.int64())})

        return text.mapInArrow(run, "doc_id long, item_id long, covered_words long, item_words long"), shared

    found, before = [], None
    for block in blocks(benchmark, min_tile, block_bytes):
        if before is not None:  # the pass before ends here, and its block goes
            found[-1] = scratch.write(found[-1], "leaks")
            before.unpersist()
        out, before = one(block)
        found.append(out)
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], "doc_id long, item_id long, covered_words long, item_words long")


def clean(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, percent: int = 50, min_tile: int = 5, block_bytes: int = 8_000_000) -> DataFrame:
    """``docs`` without the documents that leak an item; all columns as they are."""
    before = None
    for block in blocks(benchmark, min_tile, block_bytes):
        if before is not None:
            docs = scratch.write(docs, "clean")
            before.unpersist()
        before = shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text"):
                    keep = np.ones(part.num_rows, bool)
                    keep[[g[0] for g in shared.value.leaks(part.column("text"), percent)]] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
