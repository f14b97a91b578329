"""LM scoring: a Dirichlet-smoothed bigram model in Elias-Fano tries, one per shard.

``P(w | v) = (c(v w) + mu * c(w) / (N + 1)) / (c(v) + mu)``, where all words that training never
saw are one class with a count of one; the probabilities of all words after v sum to 1.  Its
logarithm is a *mass* of the pair and a *norm* of the context, and both are known where all
occurrences of one word meet: the mass of (v, w) and the norm of w as a context where the
occurrences of w do.

1. Words that make up over 1/1024 of the training tokens (of a part's, with over 256 shards) are
   found and counted in two scans; at most twice as many candidates reach the driver.
2. One scan cuts the documents into blocks and sends each block's distinct pairs, with the
   documents that hold them, to shards by the hash of w; pairs of a frequent w are dealt by v
   as well, as its count is already known.  So no shard holds more than its share, and a word or
   a pair that a third of all documents hold comes once per block and document.
3. Each of a shard's four parts sums the counts of its training pairs, writes its trie (predicted
   words, their left contexts, quantised masses) into memory-mapped levels, looks every pair of
   every block up by successor search in the word's range, and adds to sums per document.
4. A task takes its shards one part after the other, in order, and holds the messages of one part.
   Its sums per document lie in memory-mapped files and leave it once, for all its shards.
5. Sums are added up per block.

The number of shards follows the number of input partitions and of training tokens.  Left contexts
travel as 48-bit hashes, words as 64-bit ones.  Lower case is A-Z only; a text's tokens are its
words and an end.

Null text is empty (its one token is the end).  Repeated rows are scored and learned from as
often as they occur.  A null id counts as training data.  An empty table, or one without
training documents, gives rows with N = 0 where all words are unknown.  Extra columns are ignored.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandflow.llm.common import BATCH_BYTES, Scratch, mix, slices, word_codes
from demandflow.llm.elias_fano import Trie

BEGIN, END = np.uint64(0xB0), np.uint64(0xE0)
FREQUENT = 1024
#: Parts of a shard that are worked on one after the other, each with a trie of its own.
SUB = 4
#: Training tokens of a shard at most, on average.
SHARD_TOKENS = 4_000_000
#: Documents of pairs that are spread out at once.
ENTRIES = 500_000
V_BITS = np.uint64(16)  # dropped from a context's hash


def is_held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list, np.ndarray]]:
    """Distinct words of each block, its words' codes, their offsets per document, the ids and
    which ones train."""
    for batch in batches:
        for part in slices(batch, "text"):
            ids = part.column("doc_id").to_pylist()
            yield *word_codes(part.column("text")), ids, np.array([not is_held_out(i) for i in ids], bool)


def frequent_words(docs: DataFrame, scratch: Scratch, share: int = FREQUENT) -> tuple[dict[int, int], int, int]:
    """Counts of the words (and the end) above 1/``share`` of the training tokens, with the number of
    training tokens and documents."""
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for word, code, offsets, _, train in _blocks(batches):
            own = code[np.repeat(train, np.diff(offsets))]
            count = np.bincount(own, minlength=len(word))
            tokens = len(own) + int(train.sum())
            many = (count > 0) & (count * 2 * share >= tokens)
            # a word of more than 1/share overall has half of that share in blocks that report it
            yield pa.RecordBatch.from_pydict({"word": pa.array([None, *word[many].view(np.int64).tolist()], pa.int64()),
                                              "n": pa.array([tokens, *count[many].tolist()], pa.int64()),
                                              "d": pa.array([int(train.sum()), *[0] * int(many.sum())], pa.int64())})

    some = scratch.write(docs.mapInArrow(local, "word long, n long, d long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("d").alias("d")), "frequent")
    whole = some.where("word IS NULL").first()
    tokens, texts = (whole["n"], whole["d"]) if whole else (0, 0)
    got = some.where(f"word IS NOT NULL AND {2 * share} * n >= {tokens}").collect()  # at most 2 * share rows
    names = np.sort(np.array([r["word"] for r in got], np.int64).view(np.uint64))
    shared = docs.sparkSession.sparkContext.broadcast(names)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = shared.value
        counts = np.zeros(len(names), np.int64)
        for word, code, offsets, _, train in _blocks(batches):
            count = np.bincount(code[np.repeat(train, np.diff(offsets))], minlength=len(word))
            at = np.minimum(np.searchsorted(names, word), len(names) - 1)
            same = names[at] == word
            np.add.at(counts, at[same], count[same])
        yield pa.RecordBatch.from_pydict({"word": pa.array(names.view(np.int64)), "n": pa.array(counts)})

    rows = docs.mapInArrow(exact, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect() if len(names) else []
    out = {r["word"] % (1 << 64): r["n"] for r in rows if r["n"] * share > tokens}
    if texts * share > tokens:  # the end
        out[int(END)] = texts
    return out, tokens, texts


_MESSAGE = "shard long, sub long, block long, words binary, pairs_of binary, contexts binary, docs_of binary, docs binary, times binary, train binary"
_FIELDS = [c.split(" ")[0] for c in _MESSAGE.split(", ")]


def _pack48(h: np.ndarray) -> bytes:
    return (h >> V_BITS).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack48(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    return np.concatenate([raw, np.zeros((len(raw), 2), np.uint8)], axis=1).view("<u8").reshape(-1)


def messages(docs: DataFrame, frequent: list[int], shards: int) -> DataFrame:
    """The pairs of each block for each shard; ``words`` null: the block's documents."""
    hot = docs.sparkSession.sparkContext.broadcast(np.sort(np.array(frequent, np.uint64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for uniq, code, offsets, ids, train in _blocks(batches):
            n, size = len(ids), np.diff(offsets)
            uniq = np.concatenate([uniq, [BEGIN, END]])
            begin, end = len(uniq) - 2, len(uniq) - 1
            w = np.insert(code, offsets[1:], end)
            v = np.insert(code, offsets[:-1], begin)
            doc = np.repeat(np.arange(n), size + 1)
            key, times = np.unique((w * len(uniq) + v) * n + doc, return_counts=True)
            pair, doc = key // n, key % n
            first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
            docs_of = np.diff(np.r_[first, len(pair)])
            pw, pv = uniq[pair[first] // len(uniq)], uniq[pair[first] % len(uniq)]
            with np.errstate(over="ignore"):
                dealt = mix(pw)
                split = np.isin(pw, hot.value)
                dealt[split] = mix(dealt[split] ^ mix(pv[split]))
                shard = (dealt % np.uint64(shards * SUB)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            e_order = np.argsort(np.repeat(shard, docs_of), kind="stable")
            shard, pw, pv, docs_of = shard[order], pw[order], pv[order], docs_of[order]
            doc, times = doc[e_order].astype("<u2"), times[e_order].astype("<u4")
            e_at = np.r_[0, np.cumsum(docs_of)]
            cuts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True]) if len(shard) else np.zeros(1, np.int64)
            flags = np.packbits(train).tobytes()
            out: list[tuple] = [((block ^ block >> 32) % shards, 0, block, None, None, None, np.array([i is not None for i in ids], np.uint8).tobytes(),
                                 np.array([i or 0 for i in ids], "<i8").tobytes(), (size + 1).astype("<i8").tobytes(), flags)]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                own = pw[a:b]
                starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                out.append((int(shard[a]) // SUB, int(shard[a]) % SUB, block, own[starts].astype("<u8").tobytes(), np.diff(np.r_[starts, b - a]).astype("<u4").tobytes(), _pack48(pv[a:b]),
                            docs_of[a:b].astype("<u4").tobytes(), doc[e_at[a]:e_at[b]].tobytes(), times[e_at[a]:e_at[b]].tobytes(), flags))
            types = [pa.int64()] * 3 + [pa.binary()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=_FIELDS)
            block += 1

    return docs.mapInArrow(run, _MESSAGE)


_SUMS = "block long, kind string, ids binary, known binary, held binary, base binary, score binary, n_known binary, n long"
_SUM_TYPES = [pa.int64(), pa.string(), *[pa.binary()] * 6, pa.int64()]


class _Totals:
    """Base, score and known tokens per document, summed over the shards of a task, in mapped files
    that grow with the blocks that come."""

    def __init__(self):
        self.folder = tempfile.mkdtemp(prefix="sums-")
        self.at: dict[int, tuple[int, int]] = {}
        self.end = self.room = 0

    def starts(self, blocks: list[int], sizes: list[int]) -> np.ndarray:
        """The place of each block's first document."""
        for block, n in zip(blocks, sizes, strict=True):
            if block not in self.at:
                self.at[block] = (self.end, n)
                self.end += n
        if self.end > self.room:
            self.room = max(2 * self.end, 1 << 16)
            # score: of the shards that are done, own: of the one that is worked on
            self.base, self.score, self.own, self.n_known = (self._mapped(x, t) for x, t in (("base", "<f8"), ("score", "<f8"), ("own", "<f8"), ("n_known", "<u4")))
        return np.array([self.at[block][0] for block in blocks], np.int64)

    def _mapped(self, name: str, kind: str) -> np.ndarray:
        path = os.path.join(self.folder, name)
        with open(path, "ab") as f:
            f.truncate(self.room * np.dtype(kind).itemsize)  # what is new reads as zeros
        return np.asarray(np.memmap(path, kind, "r+", shape=(self.room,)))

    def end_shard(self) -> None:
        if self.end:
            self.score[:self.end] += self.own[:self.end].astype("<f4")
            self.own[:self.end] = 0

    def rows(self) -> Iterator[tuple]:
        for block, (a, n) in self.at.items():
            yield block, "sums", None, None, None, self.base[a:a + n].tobytes(), self.score[a:a + n].tobytes(), self.n_known[a:a + n].tobytes(), None

    def close(self) -> None:
        shutil.rmtree(self.folder, ignore_errors=True)


def _sums_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _SUM_TYPES, strict=True)],
                                      names=[c.split(" ")[0] for c in _SUMS.split(", ")])


def shard_sums(batches: Iterator[pa.RecordBatch], frequent: dict[int, int], tokens: int, mu: float) -> Iterator[pa.RecordBatch]:
    """Sums over the shards of one task per block and document, and the number of their known words.
    Messages come by shard and part."""
    totals, known_words, now, parts = _Totals(), 0, (-1, 0), []
    try:
        for batch in batches:
            out: list[tuple] = []
            for shard, sub, block, words, *rest in zip(*[batch.column(c) for c in _FIELDS], strict=True):
                if not words.is_valid:
                    _, _, has, ids, times, train = (x.as_py() for x in rest)
                    out.append((block.as_py(), "docs", ids, has, train, None, None, times, None))
                    continue
                own = shard.as_py(), sub.as_py()
                if own != now:
                    known_words += _add_part(totals, parts, frequent, tokens, mu)
                    if own[0] != now[0]:
                        totals.end_shard()
                    now, parts = own, []
                parts.append((block.as_py(), *[x.as_buffer() for x in (words, *rest)]))
            if out:
                yield _sums_batch(out)
        known_words += _add_part(totals, parts, frequent, tokens, mu)
        totals.end_shard()
        out, size = [(None, "words", None, None, None, None, None, None, known_words)], 0
        for row in totals.rows():
            out.append(row)
            size += 20 * totals.at[row[0]][1]
            if size > 4_000_000:
                yield _sums_batch(out)
                out, size = [], 0
        if out:
            yield _sums_batch(out)
    finally:
        totals.close()


def _add_part(totals: _Totals, parts: list, frequent: dict[int, int], tokens: int, mu: float) -> int:
    """Add the base, score and known tokens of one part of a shard, and return its known words."""
    if not parts:
        return 0
    words_of = [np.frombuffer(p[2], "<u4") for p in parts]
    w = np.concatenate([np.repeat(np.frombuffer(p[1], "<u8"), n) for p, n in zip(parts, words_of, strict=True)])
    v = np.concatenate([_unpack48(p[3]) for p in parts])
    docs_of = np.concatenate([np.frombuffer(p[4], "<u4") for p in parts]).astype(np.int64)
    pairs_at = np.cumsum([0, *[int(n.sum()) for n in words_of]])
    n_docs = [8 * len(p[7]) for p in parts]  # rounded up to whole bytes
    starts = totals.starts([p[0] for p in parts], n_docs)
    # messages that are spread out together
    group = np.cumsum([len(p[5]) // 2 for p in parts]) // ENTRIES
    cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(parts)]

    def spread() -> Iterator[tuple[slice, list, np.ndarray, np.ndarray, np.ndarray]]:
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            some, own = parts[a:b], slice(pairs_at[a], pairs_at[b])
            docs = [np.frombuffer(p[5], "<u2") for p in some]
            times = np.concatenate([np.frombuffer(p[6], "<u4") for p in some]).astype(np.int64)
            pair_of = np.repeat(np.arange(own.stop - own.start), docs_of[own])
            yield own, docs, times, pair_of, range(a, b)

    learned = np.empty(len(w))
    for own, docs, times, pair_of, at in spread():
        trains = np.concatenate([np.unpackbits(np.frombuffer(parts[i][7], np.uint8))[d] for i, d in zip(at, docs, strict=True)])
        learned[own] = np.bincount(pair_of, times * trains, own.stop - own.start)
    # distinct pairs and words, with what training holds of them
    with np.errstate(over="ignore"):
        _, one, same = np.unique(mix(w) + np.uint64(3) * v, return_index=True, return_inverse=True)
    c_pair = np.bincount(same, learned, len(one))
    word, w_of = np.unique(w, return_inverse=True)
    c_word = np.bincount(w_of, learned, len(word))
    hot = np.array([frequent.get(int(x), -1) for x in word], np.int64)
    known_words = int((c_word[hot < 0] > 0).sum())
    c_word = np.where(hot >= 0, hot, c_word)
    per_count = mu / (tokens + 1)
    seen = one[c_pair > 0]
    mass = np.log10(c_pair[c_pair > 0] + per_count * c_word[w_of[seen]])
    order = np.lexsort((v[seen], w[seen]))
    used = np.unique(w_of[seen])
    trie = Trie(w[seen][order], v[seen][order], mass[order], np.log10(per_count * np.maximum(c_word[used], 1)))
    try:
        log_p, backoff = trie.query(w, v)
    finally:
        trie.close()
    # a word without a seen pair here may still be known elsewhere (a frequent one) or not at all
    unseen = np.where(backoff != 0, backoff, np.log10(per_count * np.maximum(c_word[w_of], 1)))
    norm = np.where(w == END, 0.0, np.log10(c_word[w_of] + mu))
    score = np.where(np.isnan(log_p), unseen, log_p) - norm
    base, known = np.log10(c_word + 0.5)[w_of], (c_word > 0)[w_of]
    for own, docs, times, pair_of, at in spread():
        place = np.concatenate([starts[i] + d for i, d in zip(at, docs, strict=True)])
        np.add.at(totals.base, place, times * base[own][pair_of])
        np.add.at(totals.own, place, times * score[own][pair_of])
        np.add.at(totals.n_known, place, (times * known[own][pair_of]).astype("<u4"))
    return known_words


def score(docs: DataFrame, scratch: Scratch, mu: float = 500.0) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shards = 2 * max(4, docs.rdd.getNumPartitions())
    frequent, tokens, texts = frequent_words(docs, scratch, max(FREQUENT, SUB * shards))
    shards = max(shards, -(-tokens // SHARD_TOKENS))
    sent = messages(docs, list(frequent), shards).repartition("shard").sortWithinPartitions("shard", "sub")
    with scratch.small_batches(4 * BATCH_BYTES):
        sums = scratch.write(sent.mapInArrow(lambda batches: shard_sums(batches, frequent, tokens, mu), _SUMS), "sums")
    known = (sums.where("kind = 'words'").agg(F.sum("n")).first()[0] or 0) + sum(c > 0 for c in frequent.values())
    log_all, log_begin = np.log10(tokens + 0.5 * (known + 1)), np.log10(texts + mu)

    def assemble(rows: pa.Table) -> pa.Table:
        base = scores = n_known = ids = None
        for r in rows.to_pylist():
            if r["kind"] == "docs":
                ids, has = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["known"], np.uint8).astype(bool)
                n = len(ids)
                train = np.unpackbits(np.frombuffer(r["held"], np.uint8))[:n].astype(bool)
                n_tokens = np.frombuffer(r["n_known"], "<i8")
                continue
            got = np.frombuffer(r["base"], "<f8"), np.frombuffer(r["score"], "<f8"), np.frombuffer(r["n_known"], "<u4").astype(np.int64)
            base, scores, n_known = got if base is None else (base + got[0], scores + got[1], n_known + got[2])
        return pa.table({"doc_id": pa.array(ids, pa.int64(), mask=~has), "held_out": pa.array(~train), "n_tokens": pa.array(n_tokens),
                         "n_known": pa.array(n_known[:n]), "train_tokens": pa.array(np.full(n, tokens, np.int64)),
                         "base_score": pa.array(base[:n] - n_tokens * log_all), "score": pa.array(scores[:n] - log_begin)})

    return sums.where("kind <> 'words'").groupBy("block").applyInArrow(
        assemble, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
